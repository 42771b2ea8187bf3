import hashlib
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from seqloom.llm import imatch
from seqloom.llm.queries import op12_imatch

SF_DIR = "/root/testdata/sf0.001"


def plain_terms(text):
    return {t for t in re.findall(r"[^\W_]+", (text or "").lower())}


def plain_lexicon(texts):
    counts = Counter(t for text in texts for t in plain_terms(text))
    return {t for t, c in counts.items() if c * imatch.MOST_IDF >= len(texts) and c * imatch.LEAST_IDF <= len(texts)}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_of(values, seed=42):
    """A chain of 64-bit hashes over strings or numbers, each seeded by the one before."""
    for v in values:
        data = v.encode() if isinstance(v, str) else v
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def long_bytes(x):
    return (x & (1 << 64) - 1).to_bytes(8, "little")


def plain_print(text, lexicon):
    """The fingerprint by sets and Python hashes: the bit test of every lexicon on its own."""
    found = plain_terms(text)
    kept = sorted((t for t in found if t in lexicon), key=lambda t: t.encode())
    whole = 0
    for t in found:
        whole ^= hash_of([t])
    first = f"{hash_of(kept) if kept else whole:016x}" if found else ""
    hashes = [first]
    for level in range(imatch.LEVELS):
        for one in (0, 1):
            for r in range(imatch.ORDERS):
                own = [hash_of([t], hash_of([r.to_bytes(4, "little")])) for t in kept]
                own = [h for h in own if h & (1 << level) - 1 == 0 and (h >> level & 1) == one]
                hashes.append(f"{hash_of(map(long_bytes, own)):016x}"[-imatch.DIGITS :] if own else "")
    return ",".join(hashes)


def plain_likeness(a, b):
    told = [(x, y) for x, y in zip(a.split(","), b.split(","), strict=True) if x or y]
    return sum(x == y for x, y in told) / len(told) if told else 1.0


def plain_rows(texts):
    """Rows by id of distinct ids, in ascending order."""
    ids = sorted(texts)
    lexicon = plain_lexicon(list(texts.values()))
    prints = {k: plain_print(texts[k], lexicon) for k in ids}
    for k, after in zip(ids, ids[1:] + ids[:1], strict=True):
        text = texts[k] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + (texts[after] or "")[:half]
        of_edited = plain_print(edited, lexicon)
        yield (
            k,
            len(text),
            hashlib.sha256(edited.encode()).hexdigest(),
            prints[k],
            of_edited,
            plain_likeness(prints[k], of_edited),
            plain_likeness(prints[k], prints[after]),
        )


ODD = [None, "", " .,; ", "a", "Ä ö ß 日本 語", "the the the The", "x" * 50_000, "lone1 lone2", "wörld_under score", "a b c " * 9000, "😀 smile 😀", "same text here", "same text here"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(10 * k, ODD[k % len(ODD)] if k < 60 else f"word{k % 7} word{k % 5} common{k} end", "x") for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string").repartition(5)
    path = docs.sparkSession.conf.get("spark.checkpoint.dir") + "/imatch-odd"
    docs.write.mode("overwrite").parquet(path)
    return {k: t for k, t, _ in rows}, spark.read.parquet(path)


@pytest.mark.parametrize("limit", [imatch.BROADCAST_BYTES, 0])
def test_equals_plain_version(odd, limit):
    texts, docs = odd
    found = imatch.match_next(docs, imatch.lexicon(docs), limit=limit).collect()
    assert sorted(map(tuple, found)) == list(plain_rows(texts))


def test_query_equals_plain_version(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    found = sorted(map(tuple, op12_imatch(spark, SF_DIR).collect()))
    wanted = list(plain_rows(texts))
    assert found == wanted
    # half the text is the same; the next document is another one
    assert sum(r[5] > r[6] for r in wanted) > 0.9 * len(wanted)


def test_repeated_and_missing_ids(spark, tmp_path):
    rows = [(1, "alpha beta gamma"), (1, "alpha beta gamma"), (1, "delta epsilon"), (2, None), (2, "zeta eta theta"), (None, "iota kappa"), (None, None)] + [(3, f"hot row {k}") for k in range(400)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = imatch.match_next(docs, imatch.lexicon(docs)).collect()
    assert Counter(r.doc_id for r in found) == {1: 3, 2: 2, 3: 400, None: 2}
    next_of = {k: min((t or "" for i, t in rows if i == k), key=lambda t: signed(xxhash.xxh64_intdigest(t.encode(), 42))) for k in (1, 2, 3)}
    digest = lambda text, after: hashlib.sha256((text[: len(text) - len(text) // 2] + after[: len(text) // 2]).encode()).hexdigest()
    after = {1: next_of[2], 2: next_of[3], 3: next_of[1]}
    wanted = Counter((k, digest(t or "", after.get(k, ""))) for k, t in rows)
    assert Counter((r.doc_id, r.edited_sha256) for r in found) == wanted
    assert all((r.near_next is None) == (r.doc_id is None) for r in found)


@pytest.mark.parametrize("rows", [[], [(5, "only one document")]])
def test_empty_and_single(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = imatch.match_next(docs, imatch.lexicon(docs)).collect()
    assert [(r.doc_id, r.near_next) for r in found] == [(k, 1.0) for k, _ in rows]


def test_likeness_bounds(spark):
    rows = spark.createDataFrame([("a,b,", "a,c,"), (",,", ",,"), ("a,,", ",,"), ("a,b,", "a,b,"), (None, "a,b,")], "a string, b string")
    assert [r[0] for r in rows.select(imatch.likeness(F.col("a"), F.col("b"))).collect()] == [0.5, 1.0, 0.0, 1.0, None]
