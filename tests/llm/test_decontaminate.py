import itertools
import random

from seqloom.llm import decontaminate
from seqloom.llm.queries import op9_decontamination

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, item_id string, words int"


def test_masks_hit_any_two_substitutions():
    for gone in itertools.chain.from_iterable(itertools.combinations(range(13), k) for k in range(3)):
        assert any(all(s + o not in gone for o in m) for m in decontaminate.MASKS for s in range(13 - m[-1]))


def brute(doc, item):
    """The longest tolerant stretch of each alignment."""
    a, b = list(decontaminate.words_of(doc or "")), list(decontaminate.words_of(item or ""))
    if len(b) < 5:
        return set()
    least, need = min(13, len(b)), (0.8 if len(b) >= 13 else 1.0)
    found = set()
    for shift in range(-len(b), len(a)):
        low, high = max(0, -shift), min(len(b), len(a) - shift)
        equal = [a[shift + k] == b[k] for k in range(low, high)]
        best = max((j - i for i in range(len(equal)) for j in range(i + least, len(equal) + 1) if sum(equal[i:j]) >= need * (j - i) - 1e-9), default=0)
        if best:
            found.add((shift, best))
    return found


def cases(seed=11):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    some = lambda n: [draw.choice(words) for _ in range(n)]
    items = [some(draw.choice([3, 5, 9, 12, 13, 14, 25, 40])) for _ in range(25)] + [["the"] * 20]
    docs = [None, "", "one", "the " * 30]
    for _ in range(60):
        part = list(draw.choice(items))
        part = part[draw.randrange(3) : len(part) - draw.randrange(3)]
        for k in range(len(part)):
            if draw.random() < draw.choice([0, 0.1, 0.3]):
                part[k] = draw.choice(words)
        docs.append(" ".join(some(draw.randrange(40)) + [w.upper() + draw.choice(["", ",", "!!"]) for w in part] + some(draw.randrange(40))))
    return docs, [None, "", *(" ".join(i) for i in items)]


def test_equals_brute_force(spark, monkeypatch):
    docs, items = cases()
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(docs)], SCHEMA).repartition(3)
    tests = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    wanted = {(d, i, shift, n) for d, doc in enumerate(docs) for i, item in enumerate(items) for shift, n in brute(doc, item)}
    run = lambda: {(r.doc_id, r.item_id, r.doc_start - r.item_start, r.words) for r in decontaminate.overlaps(frame, tests).collect()}
    assert run() == wanted and len(wanted) > 20
    kept = {r.doc_id for r in decontaminate.without_benchmark(frame, tests).collect()}
    assert kept == set(range(len(docs))) - {w[0] for w in wanted}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 700)
    assert run() == wanted
    assert {r.doc_id for r in decontaminate.without_benchmark(frame, tests).collect()} == kept


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = " ".join(f"A{k}," for k in range(200))
    whole = list(decontaminate.words_of(text))
    monkeypatch.setattr(decontaminate, "TEXT_BLOCK", 7)
    assert list(decontaminate.words_of(text)) == whole and len(whole) == 200


def test_empty_tables_and_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    tests = spark.createDataFrame([(None, "A b, c d e"), (1, "a b c d e")], "item_id long, text string")
    rows = decontaminate.overlaps(docs, tests).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.words) for r in rows) == sorted((d, i, 5) for d in ("None", "2", "2") for i in ("None", "1"))
    assert decontaminate.overlaps(docs, tests.limit(0)).collect() == [] and decontaminate.overlaps(docs.limit(0), tests).collect() == []
    assert decontaminate.without_benchmark(docs, tests.limit(0)).count() == 3 and decontaminate.without_benchmark(docs, tests).count() == 0


def test_query_finds_planted_passages(spark):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in op9_decontamination(spark, SF_DIR).collect()}
    exact = {(d, i) for d, t in docs.items() for i, p in items.items() if t and p in t}
    assert exact and exact <= found


def test_masks_hit_every_stretch_within_the_share():
    # a stretch of 26 words or more has a half of 13 or more words within the share
    for length in range(decontaminate.LEAST_WORDS, 2 * decontaminate.LEAST_WORDS):
        laid = [sum(1 << (o + s) for o in m) for m in decontaminate.MASKS for s in range(length - m[-1])]
        for gone in itertools.combinations(range(length), length - -(-length * 4 // 5)):
            bits = sum(1 << k for k in gone)
            assert any(not bits & m for m in laid), (length, gone)


def test_three_of_fifteen_words_changed_are_found():
    words = [f"w{k}" for k in range(15)]
    index = decontaminate.TestIndex([" ".join(words)])
    for gone in itertools.combinations(range(15), 3):
        text = " ".join("x" if k in gone else w for k, w in enumerate(words))
        assert [(o.words, o.equal) for o in index.overlaps(text)] == [(15, 12)]
