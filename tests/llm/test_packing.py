import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from seqloom.llm import packing
from seqloom.llm.queries import op8_packing, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


HARD = [
    "", " ", "\n", "Don't stop, it's we'll I'M", "a.b.c, d., e,. f", "ÀÉÎ, ß. ǅ, İstanbul, ΣΑΣ, ", "é e\u0301, \u0301x \u00a0y\u2003z", "<|endoftext|>, x<|startoftext|>.",
    "x\x1cy\x85z\tq\r\n\x0b", "1,2.3 4th, 5.", "😀, 日本語。ok", "A,\u0301 b.\u0327", "ﬁ, Ⅷ. ²,", "'s, 't. 're", "Ünder, fußweg. ÿ, Ÿ.",
]


def test_words_have_the_ids_of_the_text(plain, monkeypatch):
    ids_of = packing.WordIds(tokenizer_path())
    for texts in (HARD, HARD[::-1], ["\n".join(HARD), " ".join(HARD)]):
        for text, ids in zip(texts, ids_of(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == plain(text)[:-1], text
    monkeypatch.setattr(packing, "WORDS", 3)
    few = packing.WordIds(tokenizer_path())
    for _ in range(2):
        assert few(HARD) == ids_of(HARD)
    many = [w.upper() for text in HARD for w in text.split()] + [f"wörd{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(600)]
    for word, ids in zip(many, ids_of(many), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain(word)[:-1], word


def test_differencing_is_near_equal_and_complete():
    draw = random.Random(2)
    assert sorted(map(len, packing.differencing([8, 7, 6, 5, 4], 2))) == [2, 3]
    assert sorted(sum([8, 7, 6, 5, 4][k] for k in s) for s in packing.differencing([8, 7, 6, 5, 4], 2)) == [14, 16]
    for ways, count in ((1, 9), (5, 3), (16, 200), (40, 41)):
        sizes = [draw.randrange(1, 512) for _ in range(count)]
        sets = packing.differencing(sizes, ways)
        assert len(sets) == ways and sorted(k for s in sets for k in s) == list(range(count))
        if count == 200:
            sums = [sum(sizes[k] for k in s) for s in sets]
            assert max(sums) - min(sums) < 60


def test_windows_rise_until_all_fit():
    assert sorted(map(sorted, packing.windows_of([6, 6, 6], 10))) == [[0], [1], [2]]
    assert packing.windows_of([], 10) == []


def check(rows, docs, plain, capacity):
    """Every id of every document in exactly one piece, windows without gaps and within capacity."""
    whole, windows = {}, {}
    for r in rows:
        whole.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    assert len(whole) == len(docs)
    for doc, text in docs:
        ids, at = plain(text), 0
        for r in sorted(whole[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in windows.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(windows)


def test_query(spark, plain):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = op8_packing(spark, SF_DIR).collect()
    windows = check(rows, docs, plain, 2048)
    assert windows <= 1.01 * sum(r.length for r in rows) / 2048 + 1


def test_small_windows_nulls_and_clashing_columns(spark, plain):
    texts = [None, "", *HARD, " ".join(HARD * 9)]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame([(t, k, "x", 3) for k, t in docs], "text string, doc_id int, ids string, offset int").repartition(3)
    rows = packing.pack(frame, tokenizer_path(), capacity=16, piece=5, windows=4)
    rows = rows.selectExpr("*", "cast(octet_length(ids) / 4 as long) length", "crc32(ids) ids_crc32").collect()
    check(rows, docs, plain, 16)
    assert packing.pack(frame.limit(0), tokenizer_path()).collect() == []
