import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from seqloom.llm import simhash
from seqloom.llm.common import components
from seqloom.storage import stage
from tests.llm.brute import groups


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def texts(seed=7):
    draw = random.Random(seed)
    words = [f"w{k}é" if k % 9 == 0 else f"W{k}" for k in range(300)]
    found = [None, "", " \t\n", "one", "One two", "x  y\x0bz", "a b\x85c d\x1ce f g"]
    for _ in range(60):
        long = [draw.choice(words) for _ in range(draw.randrange(3, 400))]
        found.append(" ".join(long))
        for _ in range(draw.randrange(4)):
            copy = list(long)
            copy[draw.randrange(len(copy))] = draw.choice(words)
            found.append("\n".join(copy))
    return found + found[:20]


@pytest.mark.parametrize("tile", [4, 512])
def test_equals_brute_force(spark, tile):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, fingerprint int, component_id string")
    prints = stage(simhash.fingerprints(docs.repartition(5)), "t")
    found = {
        r.doc_id: (r.hex, r.component_id)
        for r in simhash.near_duplicates(prints, tile=tile).withColumn("hex", simhash.hex_print(F.col("fingerprint"))).collect()
    }
    wanted = {k: fingerprint(t) for k, t in rows}
    assert {k: v[0] for k, v in found.items()} == {k: f"{v:016x}" for k, v in wanted.items()}
    links = [(a, b) for a in wanted for b in wanted if a < b and (wanted[a] ^ wanted[b]).bit_count() <= 3]
    assert {k: v[1] for k, v in found.items()} == groups(wanted, links)
    assert any(wanted[a] != wanted[b] for a, b in links)


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = texts()[20]
    monkeypatch.setattr(simhash, "BLOCK", 50)
    assert simhash._fingerprint(text.encode()) == fingerprint(text)


def test_empty_table_null_and_repeated_ids(spark):
    schema = "doc_id long, text string"
    run = lambda rows: sorted(
        (r.doc_id, r.component_id)
        for r in simhash.near_duplicates(stage(simhash.fingerprints(spark.createDataFrame(rows, schema)), "t")).collect()
    )
    assert run([]) == []
    assert run([(3, "a b c"), (3, "a b c"), (2, "a b c")]) == [(2, 2), (3, 2), (3, 2)]
    rows = simhash.near_duplicates(stage(simhash.fingerprints(spark.createDataFrame([(None, "a"), (4, "a")], schema)), "t"))
    assert {(r.doc_id, r.component_id) for r in rows.collect()} == {(None, 4), (4, 4)}


def test_components_of_chains_stars_and_strings(spark):
    draw = random.Random(3)
    for size, count in ((300, 200), (50, 400), (1000, 999)):
        links = [(k, k + 1) for k in range(count)] if count == 999 else [(draw.randrange(size), draw.randrange(size)) for _ in range(count)]
        frame = spark.createDataFrame([(f"{a:05}", f"{b:05}") for a, b in links] + [(None, "x")], "a string, b string")
        found = {int(r.node): int(r.component) for r in components(frame, "t").collect()}
        nodes = {x for a, b in links if a != b for x in (a, b)}
        assert found == {k: v for k, v in groups(range(size + 1), links).items() if k in nodes}
