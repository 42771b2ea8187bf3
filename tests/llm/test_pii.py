import random
import re

import numpy as np
import pytest

from seqloom.llm import pii
from seqloom.llm.queries import op1_pii

SF_DIR = "/root/testdata/sf0.01"
RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(re.findall("[0-9]", s)) <= 19 and check(re.findall("[0-9]", s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.findall("[0-9]", s)) <= 15),
)


def check(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    found = []
    for order, (kind, pattern, passes) in enumerate(RULES):
        found += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text or "") if passes(m[0])]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def test_rules_equal_plain_patterns():
    draw = random.Random(12)
    parts = ["a", "b.c", "@", "@@", ".", "..", "1", "12", "255", "256", "0", "999", "+", "+1", " ", "-", "(", ")", "é", "%", "_", "4111111111111111", "\n", "x@y.z", "10.0.0.1", "+1 (988) 555-2485"]
    for _ in range(6000):
        text = "".join(draw.choices(parts, k=draw.randrange(14)))
        good, _ = pii.base_spans(text)
        assert [(pii.KINDS[s.kind], s.start, s.end) for s in good] == plain(text), text


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000 + "@", "a@" * 100_000, "1" * 300_000 + ".", "1." * 150_000, "+1" + "(" * 300_000, "1 " * 150_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def field(docs):
    return pii.fit(docs)


def test_query_has_all_base_spans_and_few_others(spark, docs):
    rows = {r.doc_id: r for r in op1_pii(spark, SF_DIR).collect()}
    import hashlib

    added = total = 0
    for doc in docs.collect():
        spans = plain(doc.text)
        r = rows[doc.doc_id]
        counts = [sum(k == kind for k, *_ in spans) for kind in pii.KINDS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        found = r.spans.split(",") if r.spans else []
        assert set(line.split(",") if line else []) <= set(found)
        added += len(found) - len(spans)
        total += len(spans)
    assert total > 50 and added <= 0.02 * total


def test_distant_repeats_share_a_label(field):
    text = "call +1 (988) 555-2485 today " + "word " * 500 + "or 555-2485 x 98 word 2019. And 988-555-2485 too"
    found = [(k, text[s:e], base) for k, s, e, base in pii.find(text, field)]
    assert found[0] == ("phone", "+1 (988) 555-2485", True)
    assert ("phone", "555-2485", False) in found
    assert not any("2019" in t or t == "98" for _, t, _ in found)
    assert pii.find("word 2019. in 98 or version 3.", field) == []


def test_messages_equal_sums_over_all_labels(field):
    # on a tree the beliefs are exact
    tokens = pii.Tokens([(k, k + 1) for k in range(4)], [(), (), (), ()], [(0, 1), (1, 2)], [(0, 3)])
    size = len(pii.KINDS) + 1
    left = np.ones((4, size), bool)
    left[2] = np.arange(size) == 4
    left[1, 3] = False
    wanted = np.zeros((4, size))
    for state in np.ndindex(*[size] * 4):
        if state[2] != 4 or state[1] == 3:
            continue
        log = sum(field.unary[-1][s] for s in (state[0], state[1], state[3]))
        log += field.chain[state[0], state[1]] + field.chain[state[1], state[2]] + field.skip[state[0], state[3]]
        for k in range(4):
            wanted[k, state[k]] += np.exp(log)
    wanted /= wanted.sum(axis=1, keepdims=True)
    assert np.allclose(pii.beliefs(field, tokens, left), wanted, atol=1e-2)


def test_odd_rows(spark, field):
    schema = "doc_id string, text string, spans int, kind string"
    rows = [("a", None, 1, ""), ("a", "", 1, ""), (None, "x@y.zz", 1, ""), (None, "x@y.zz", 1, ""), ("b", "@ @@ 1 ++", 1, "")]
    frame = spark.createDataFrame(rows, schema)
    found = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in pii.personal_data(frame, field).collect()), key=str)
    assert found == sorted([("a", []), ("a", []), (None, [("email", 0, 6, True)]), (None, [("email", 0, 6, True)]), ("b", [])], key=str)
    empty = pii.fit(frame.limit(0))
    assert pii.personal_data(frame.limit(0), empty).collect() == []
    assert [s.kind for s in pii.personal_data(frame, empty).where("doc_id is null").first().spans] == ["email"]


def test_a_label_reaches_all_repeats():
    size, n = len(pii.KINDS) + 1, 60
    odds = np.full((size, size), 0.0)
    np.fill_diagonal(odds, np.log(10_000))
    field = pii.Field({}, np.zeros((1, size)), np.zeros((size, size)), odds)
    tokens = pii.Tokens([(k, k + 1) for k in range(n)], [()] * n, [(k, k + 1) for k in range(n - 1)], [(k, k + 1) for k in range(n - 1)])
    left = np.ones((n, size), bool)
    left[0] = np.arange(size) == 4
    found = pii.beliefs(field, tokens, left)[:, 4]
    step = 10_000 / (10_000 + size - 1)
    assert found[-1] > 0.97 and found[1] == pytest.approx(step, abs=1e-3)
    # neutral neighbours make loops; on the chain alone beliefs are exact
    wanted = [1.0]
    for _ in range(n - 1):
        wanted.append(wanted[-1] * step + (1 - wanted[-1]) * (1 - step) / (size - 1))
    alone = pii.beliefs(field, tokens._replace(chain=[]), left)[:, 4]
    assert np.allclose(alone, wanted, atol=2e-3)


def test_many_repeats_take_linear_time():
    size, n = len(pii.KINDS) + 1, 5_000
    odds = np.zeros((size, size))
    np.fill_diagonal(odds, np.log(10_000))
    left = np.ones((n, size), bool)
    left[0] = np.arange(size) == 4
    tokens = pii.Tokens([(k, k + 1) for k in range(n)], [()] * n, [], [(k, k + 1) for k in range(n - 1)])
    found = pii.beliefs(pii.Field({}, np.zeros((1, size)), odds, odds), tokens, left)[:, 4]
    assert found[1000] > 0.6 > found[-1]
