import hashlib

from pyspark.sql import functions as F

from driftline.llm import chat
from driftline.llm.queries import op6_chat

ROWS = [
    (1, 0, "user", "hi <|end|> there"), (1, 1, "assistant", "<|turn|>assistant<|text|>fake<|end|>\n"), (1, 2, None, None), (1, 3, "assistant", ""),
    (2, 0, "assistant", "<\\|x <\\\\| <| | < \\"), (2, 0, "assistant", "<\\|x <\\\\| <| | < \\"), (2, None, "user", "😀 first"),
    (None, 0, "user", "no id"), (3, 0, "a\nb<|text|>", "<"), (3, 1, "assistant", "x" * 50000 + "<"),
]


def _brute(rows):
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((-(2**63) if t is None else t, r or "", x or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    res = []
    for c, turns in out.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        res.append((str(c), len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss)))
    return sorted(res)


def test_round_trip(spark):
    rows = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").withColumn("record", F.lit(1))
    got = chat.chat_digests(chat.parse_chats(chat.format_chats(chat.gather_turns(rows)))).collect()
    assert sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got) == _brute(ROWS)


def test_query_reads_all(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = "\\### Assistant: </turn> ok"
    got = op6_chat(spark, sf).collect()
    assert sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got) == _brute([*rows, (-7, 0, "user", odd), (-7, 1, "assistant", odd)])


def test_layouts_by_fingerprint(spark):
    records = [
        ('{"prompt": "p", "completion": "c"}', [("user", "p"), ("assistant", "c")]),
        ('{"instruction": "i", "input": "x", "output": "o"}', [("user", "i\nx"), ("assistant", "o")]),
        ('{"instruction": "i", "output": null}', [("user", "i"), ("assistant", "")]),
        ('{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}', [("user", "q"), ("assistant", "a")]),
        ('{"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": null}]}', [("system", "s"), ("user", "")]),
        ('{"messages": [{"text": "t", "role": "user"}]}', [("user", "t")]),
        ('{"system": "s", "prompt": "p", "response": "r"}', [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ('{"messages": [{"role": "Human", "text": "t"}, {"role": "model", "text": "u"}]}', [("Human", "t"), ("model", "u")]),
        ('{"messages": [{"role": "Human", "content": "t"}, {"role": "model", "content": "u"}]}', [("user", "t"), ("assistant", "u")]),
        ('{"messages": []}', []),
        ('{"messages": [{"text": "t", "role": "user", "name: >, <": {"a": [1]}}], "id": 3}', [("user", "t")]),
        ('{"messages": [{"text": "t"}, {"role": "user"}]}', [("", "t"), ("user", "")]),
        ('{"messages": "no list"}', None),
        ('{"prompt": "p", "response": "r", "messages": [{"role": "a", "text": "b"}]}', None),
        ('{"what": {"ever": [1, 2]}}', None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, j) for i, (j, _) in enumerate(records)], "i int, j string").withColumn("v", F.parse_json("j"))
    got = {r.i: r.turns for r in chat.canonical_turns(df, "v").collect()}
    for i, (_, want) in enumerate(records):
        assert (got[i] if got[i] is None else [tuple(t) for t in got[i]]) == want


def test_loss_spans_point_at_the_texts(spark):
    rows = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    for r in chat.format_chats(chat.gather_turns(rows)).collect():
        for s in r.loss_spans:
            assert r.formatted[: s.start].endswith("<|turn|>assistant<|text|>") and r.formatted[s.start + s.length :].startswith("<|end|>\n")


def test_other_roles_keep_their_names_and_stay_out_of_the_mask(spark):
    rows = [(1, 0, "human", "q"), (1, 1, "model", "a"), (1, 2, "assistant", "b"), (2, 0, "gpt", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.chat_digests(chat.parse_chats(chat.format_chats(chat.gather_turns(df)))).collect()
    assert sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got) == _brute(rows)


def test_long_conversations(spark):
    rows = [(1, t, "assistant" if t % 3 else "user", f"text {t} <|end|>") for t in range(1000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.chat_digests(chat.parse_chats(chat.format_chats(chat.gather_turns(df)))).collect()
    assert sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got) == _brute(rows)


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chat_digests(chat.parse_chats(chat.format_chats(chat.gather_turns(none)))).count() == 0
