import hashlib

import pytest
from pyspark.sql import functions as F

from seqloom.llm import piece_table
from seqloom.llm.queries import ORACLE, op11_fim
from tests.compare import open_oracle

SF_DIR = "/root/testdata/sf0.001"


def plain_cut(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by the words of the contract."""
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def rows(spark):
    odd = [None, "", "a", "ab", "<P", "<<P", "<P>", "x<S>y", "z<M>", "P>a<", "wörld 😀 café", "line\nbreak\r\n\ttab", "<|P|>", "𝔘𝔫𝔦" * 7]
    made = [(k, text, "note", k) for k, text in enumerate(odd * 40)]
    made += [(None, "no id", "note", 1), (None, None, "note", 1), (7, "again", "note", 1), (7, "again", "note", 1), (10**15, "long ü " * 200_000, "note", 1)]
    # columns that clash with new ones
    docs = spark.createDataFrame(made, "doc_id bigint, text string, form string, n int")
    found = piece_table.restore(piece_table.fill_in_middle(docs.repartition(3)))
    return made, found.collect()


def test_equals_plain_version(rows):
    made, found = rows
    wanted = sorted(str((k, text, *plain_cut(k, text))) for k, text, _, _ in made)
    assert sorted(str((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in found) == wanted
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_restores_every_text(rows):
    assert all(r.restored == (r.text or "") for r in rows[1])


def test_descriptors_cover_the_text_once(rows):
    for r in rows[1]:
        own = sorted((p.start, p.length) for p in r.pieces if p.buffer == piece_table.TEXT)
        assert sum(length for _, length in own) == r.n
        ends = [0]
        for start, length in own:
            assert start == ends[-1]
            ends.append(start + length)
        assert [piece_table.SENTINELS[p.start : p.start + p.length] for p in r.pieces if p.buffer == piece_table.MARKS] == list(piece_table.ORDER.get(r.form, ()))


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, pieces int, keep string")
    found = piece_table.fill_in_middle(docs)
    assert found.columns == ["doc_id", "text", "keep", "n", "form", "prefix_chars", "middle_chars", "pieces", "output"]
    assert piece_table.restore(found).count() == 0


def test_unknown_form_restores_to_null(spark):
    rows = spark.createDataFrame([("<P>a<S>b<M>c", "other"), (None, "psm"), (None, "plain")], "output string, form string")
    assert [r.restored for r in piece_table.restore(rows).collect()] == [None] * 3


def test_cut_splits_a_descriptor(spark):
    part = piece_table.piece(piece_table.TEXT, F.lit(10), F.lit(5))
    cut = spark.range(1).select(F.explode(piece_table.cut(part, F.lit(0), F.lit(3))).alias("p")).select("p.start", "p.length")
    assert [tuple(r) for r in cut.collect()] == [(10, 0), (10, 3), (13, 2)]


def test_query_equals_sql(spark):
    found = {r.doc_id: r.asDict() for r in op11_fim(spark, SF_DIR).collect()}
    relation = open_oracle(SF_DIR).sql(ORACLE["op11_fim"])
    wanted = {dict(zip(relation.columns, r, strict=True))["doc_id"]: dict(zip(relation.columns, r, strict=True)) for r in relation.fetchall()}
    assert found == wanted
