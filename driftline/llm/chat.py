"""Chat formatting by schema fingerprints; DataFrame functions only.

A record of any layout is a variant. Those of its nested field paths that some mapping names are hashed, and the
hash selects a declarative mapping (``LAYOUTS``) that turns prompt, instruction and message layouts into canonical turns
``array<struct<role, text>>``. Roles of the canonical layout stay as they are; those of other layouts are renamed (``ROLES``). Turns become one string per conversation by a template of three markers::

    <|turn|>role<|text|>the text<|end|>\\n

Inside roles and texts, ``<`` followed by backslashes and ``|`` gets one backslash more, so that no text can hold a marker and
the change can be taken back. The loss mask lists the spans (code points) of the assistant's texts.

Defined results: a null role or text is empty; turns are ordered by (turn, role, text), a null turn first; repeated rows
stay. Fields that no mapping names do not count, whatever their names; an empty message list has no turns. A record of no known layout, or with the fields of two, has null turns and keeps its fingerprint. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"

#: layout -> (its field paths in order, its turns: rule and paths). ``name[]`` is a list without known fields, ``name[].field`` a field of a list's objects.
LAYOUTS: dict[str, tuple[tuple[str, ...], str]] = {
    "messages_role_text": (("messages[].role", "messages[].text"), "rows:$.messages:role:text"),
    "messages_role_content": (("messages[].content", "messages[].role"), "list:$.messages:role:content"),
    "conversations_from_value": (("conversations[].from", "conversations[].value"), "list:$.conversations:from:value"),
    "messages_empty": (("messages[]",), "rows:$.messages:role:text"),
    "conversations_empty": (("conversations[]",), "rows:$.conversations:from:value"),
    "prompt_completion": (("completion", "prompt"), "pair:$.prompt:$.completion"),
    "prompt_response": (("prompt", "response"), "pair:$.prompt:$.response"),
    "instruction_output": (("instruction", "output"), "pair:$.instruction:$.output"),
    "instruction_input_output": (("input", "instruction", "output"), "triple:$.instruction:$.input:$.output"),
    "system_prompt_response": (("prompt", "response", "system"), "system:$.system:$.prompt:$.response"),
    "question_answer": (("answer", "question"), "pair:$.question:$.answer"),
}
_PATHS = sorted({p for paths, _ in LAYOUTS.values() for p in paths})
#: Turns whose spans are gathered at a time.
SPANS = 64
#: Names that layouts give to the three roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def field_paths(v: Column) -> Column:
    """Those of ``_PATHS`` that a variant has, in order. A field that is null counts as there."""

    def there(path: str) -> Column:
        name, list_, field = path.partition("[]")
        if not list_:
            return F.try_variant_get(v, f"$.{name}", "variant").isNotNull()
        items = F.try_variant_get(v, f"$.{name}", "array<variant>")
        if field:
            return F.exists(items, lambda x: F.try_variant_get(x, f"${field}", "variant").isNotNull())
        known = [p for p in _PATHS if p.startswith(f"{name}[].")]
        return items.isNotNull() & ~functools.reduce(lambda a, b: a | b, [F.coalesce(there(p), F.lit(False)) for p in known])

    return F.array_compact(F.array(*[F.when(there(p), F.lit(p)) for p in _PATHS]))


def fingerprint(v: Column) -> Column:
    return F.xxhash64(F.concat_ws(",", field_paths(v)))


def _turns(rule: str) -> str:
    """SQL over the variant ``v``: array<struct<role, text>>."""
    kind, *args = rule.split(":")
    text = lambda p: f"try_variant_get(v, '{p}', 'string')"
    turn = lambda role, p: f"struct('{role}' AS role, coalesce({text(p)}, '') AS text)"
    if kind in ("list", "rows"):
        path, role, body = args
        named = "coalesce(m.r, '')"
        if kind == "list":
            named = "CASE lower(m.r) " + " ".join(f"WHEN '{k}' THEN '{x}'" for k, x in ROLES.items()) + f" ELSE {named} END"
        items = f"transform(try_variant_get(v, '{path}', 'array<variant>'), x -> struct(try_variant_get(x, '$.{role}', 'string') AS r, try_variant_get(x, '$.{body}', 'string') AS t))"
        return f"transform({items}, m -> struct({named} AS role, coalesce(m.t, '') AS text))"
    if kind == "pair":
        return f"array({turn('user', args[0])}, {turn('assistant', args[1])})"
    if kind == "triple":
        joined = f"concat_ws('\\n', {text(args[0])}, nullif({text(args[1])}, ''))"
        return f"array(struct('user' AS role, {joined} AS text), {turn('assistant', args[2])})"
    if kind == "system":
        return f"array({turn('system', args[0])}, {turn('user', args[1])}, {turn('assistant', args[2])})"
    raise ValueError(rule)


def canonical_turns(records: DataFrame, record: str) -> DataFrame:
    """Adds ``layout_fingerprint`` and ``turns`` (canonical; null for unknown layouts) to records whose column ``record`` is a variant."""
    known = records.withColumn("layout_fingerprint", fingerprint(F.col(record)))
    chosen = None
    for paths, rule in LAYOUTS.values():
        turns = F.expr(_turns(rule).replace("(v,", f"(`{record}`,"))
        hit = F.col("layout_fingerprint") == F.xxhash64(F.lit(",".join(paths)))
        chosen = F.when(hit, turns) if chosen is None else chosen.when(hit, turns)
    return known.withColumn("turns", chosen)


def gather_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, record): rows by turn as message records, one per conversation. A conversation is one string in the end, so its turns meet in one row; the shuffle deals conversations by a hash."""
    messages = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(turn).cast("long"), F.lit(-(2**63))).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))))
    kept = F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text")))
    return rows.groupBy(F.col(conv).alias("conv_id")).agg(kept.alias("messages")).select("conv_id", F.to_variant_object(F.struct("messages")).alias("record"))


def format_chats(records: DataFrame, record: str = "record") -> DataFrame:
    """Adds ``formatted`` and ``loss_spans`` (array<struct<start, length>>, code points) to the records, by way of their canonical turns."""
    turned = canonical_turns(records, record)
    pieces = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"), escape(t["text"]).alias("body")))
    whole = turned.withColumn("_pieces", pieces)
    formatted = F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc, p):
        begin = acc["at"] + F.length(p["head"])
        size = F.length(p["body"]).cast("long")
        spans = F.when(p["role"] == "assistant", F.concat(acc["spans"], F.array(F.struct(begin.cast("long").alias("start"), size.alias("length"))))).otherwise(acc["spans"])
        return F.struct((begin + size + len(END)).cast("long").alias("at"), spans.alias("spans"))

    # spans of ``SPANS`` turns at a time, so that a long conversation's are not copied at each turn
    blocks = F.transform(F.sequence(F.lit(0), F.expr(f"(size(_pieces) - 1) div {SPANS}")), lambda b: F.slice("_pieces", b.cast("int") * SPANS + 1, SPANS))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<array<struct<start:bigint,length:bigint>>>").alias("parts"))

    def block(acc, pieces):
        own = F.aggregate(pieces, F.struct(acc["at"].alias("at"), start["spans"].alias("spans")), step)
        return F.struct(own["at"].alias("at"), F.concat(acc["parts"], F.array(own["spans"])).alias("parts"))

    spans = F.when(F.col("_pieces").isNotNull(), F.flatten(F.aggregate(blocks, begin, block)["parts"]))
    return whole.withColumn("formatted", formatted).withColumn("loss_spans", spans).drop("_pieces")


def parse_chats(formatted: DataFrame) -> DataFrame:
    """Reads ``formatted`` and ``loss_spans`` back: adds ``parsed`` (array<struct<role, text>>) and ``loss_texts`` (the text of each span, unescaped)."""
    parts = F.split(F.col("formatted"), r"<\|turn\|>")
    turns = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.struct(unescape(F.substring_index(p, TEXT, 1)).alias("role"), unescape(F.substring_index(F.substring_index(p, TEXT, -1), END, 1)).alias("text")))
    # a span is a code point range of the formatted text
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.withColumn("parsed", turns).withColumn("loss_texts", loss)


def chat_digests(parsed: DataFrame, conv: str = "conv_id") -> DataFrame:
    said = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return parsed.select(F.col(conv).alias("conv_id"), F.size("parsed").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
