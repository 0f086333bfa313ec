"""The queries of this package: each applies its operator to its whole table, and the SQL where SQL can say the same."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, fingerprints, jaccard, langid, quality, token_files, toxicity, warc
from .common import in_fold


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """A parameter of the token queries; DRIFTLINE_VOCABULARY overrides the file of the installed tokenizers package."""
    if at := os.environ.get("DRIFTLINE_VOCABULARY"):
        return at
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_sensitivity(_read(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    lexicon = toxicity.learn(docs, labels.where(~in_fold("doc_id", 4, 2)))
    scored = toxicity.score(docs, lexicon)
    return scored.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(_read(spark, sf_dir, "documents"), vocabulary())
    return token_files.read_token_files(spark, manifest, with_ids=False)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_read(spark, sf_dir, "documents"), vocabulary())


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, _read(spark, sf_dir, "labels")))


#: A conversation whose texts hold what templates use as marks.
ODD = (-7, "\\### Assistant: </turn> ok")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    odd = spark.range(2).select(F.lit(ODD[0]).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD[1]).alias("text"))
    formatted = chat.format_chats(chat.gather_turns(rows.unionByName(odd))).select("conv_id", "formatted", "loss_spans")
    return chat.chat_digests(chat.parse_chats(formatted))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_warc(_read(spark, sf_dir, "pages"), min_bytes=0)
    return warc.capture_digests(warc.assemble(warc.read_warc(spark, files, with_blocks=False)))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_read(spark, sf_dir, "documents"), n=4, percent=85)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~in_fold("doc_id", 3, 1)))
    return langid.predict(docs, model).select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "entropy", "rejected")


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_toxicity, op3_token_files, op4_bpe, op5_quality, op6_chat, op7_decontamination, op8_warc, op9_jaccard_join, op10_language_id)}

ORACLE_SQL = {
    "op6_chat": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
        SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(24 + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars
        FROM rows GROUP BY conv_id""",
    "op8_warc": """
        WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS hex, strlen(coalesce(html, '')) AS n FROM pages),
        m AS (SELECT hex, max(page_id) AS keeper FROM p GROUP BY hex)
        SELECT page_id::BIGINT AS page_id, n::BIGINT AS payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(hex, (5 * (i // 4) + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
            CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id < keeper THEN keeper END::BIGINT AS refers_to
        FROM p JOIN m USING (hex)""",
    "op9_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w),
        c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM o JOIN c cx ON cx.doc_id = x JOIN c cy ON cy.doc_id = y WHERE 100 * o >= 85 * (cx.n + cy.n - o)),
        r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
        SELECT doc_id::BIGINT AS doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m.y, doc_id))::BIGINT AS component_id
        FROM documents LEFT JOIN c USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS y FROM r GROUP BY x) m USING (doc_id)""",
}
