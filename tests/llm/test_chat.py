import hashlib
import random

from pyspark.sql import functions as F

from seqloom.llm import chat
from seqloom.llm.queries import op5_chat

SF_DIR = "/root/testdata/sf0.001"
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]"]
PARTS = [*MARKS, "\\", "[", "<", "]", "s>", "/INST]", "x", "\n", "$1", "😀", "[\\INST]", "<\\\\s>", " "]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_source(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    wanted = {}
    for conv, _, role, text in sorted(rows):
        turns = wanted.setdefault(conv, [])
        turns.append((role, text or ""))
    found = {r.conv_id: r for r in op5_chat(spark, SF_DIR).collect()}
    assert set(found) == set(wanted)
    for conv, turns in wanted.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert tuple(found[conv])[1:5] == (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss))
        assert found[conv].formatted_chars > sum(len(t) for _, t in turns)


def test_hostile_texts_roles_and_mask(spark):
    draw = random.Random(4)
    some = lambda n: "".join(draw.choice(PARTS) for _ in range(draw.randrange(n)))
    rows = [
        (conv, turn, draw.choice(["user", "assistant", "system", "tool", "", None, some(4)]), draw.choice([None, some(8), some(30)]), "x", 1)
        for conv in range(150)
        for turn in range(draw.randrange(1, 6))
    ]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, formatted string, id int").repartition(3)
    found = chat.format_chats(frame).collect()
    wanted = {}
    for conv, _, role, text, *_ in rows:
        wanted.setdefault(conv, []).append((role or "", text or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in found} == wanted
    escaped = 0
    for r in found:
        assert sum(m.chars for m in r.mask) == len(r.formatted)
        at, masked = 0, []
        for m in r.mask:
            if m.loss:
                masked.append(r.formatted[at : at + m.chars])
            at += m.chars
        plain = [t for role, t in wanted[r.conv_id] if role == "assistant"]
        assert len(masked) == len(plain)
        escaped += masked != plain
        assert not any(m in text for text in masked for m in MARKS)
    assert escaped


def test_plain_texts_stay_plain(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a [x] \\ <b>"), (1, 1, "assistant", "b")]
    (row,) = chat.format_chats(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    assert row.formatted == "[INST]a [x] \\ <b>[/INST]<s>b</s><s>b</s>"


def test_empty_table_and_null_ids(spark):
    schema = "conv_id int, turn int, role string, text string"
    assert chat.format_chats(spark.createDataFrame([], schema)).collect() == []
    (row,) = chat.format_chats(spark.createDataFrame([(None, 2, "user", "b"), (None, None, "user", "a")], schema)).collect()
    assert row.conv_id is None and [t.text for t in row.turns] == ["a", "b"]


def test_escape_has_an_inverse(spark):
    draw = random.Random(9)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randrange(40))) for _ in range(500)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"))
    for r in frame.collect():
        assert r.u == r.t and not any(m in r.e for m in MARKS)
