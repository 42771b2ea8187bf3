import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.llm import language
from seqloom.llm.queries import op7_language

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language.fit(docs)


def test_text_alone_is_right_on_held_out_rows(docs):
    half = docs.where(F.pmod("doc_id", F.lit(2)) == 0)
    model = language.fit(half)
    rest = docs.where((F.pmod("doc_id", F.lit(2)) == 1) & (F.length("text") > 60))
    found = language.identify(rest, model).join(rest.select("doc_id", "lang"), "doc_id").collect()
    assert model.languages == ["de", "en", "es", "fr"]
    assert np.mean([r.language == r.lang for r in found]) > 0.97


def test_query_keeps_clean_documents(spark, docs):
    found = {r.doc_id: r for r in op7_language(spark, SF_DIR).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    assert np.mean([found[r.doc_id].kept for r in rows]) > 0.995
    assert np.mean([found[r.doc_id].language == r.lang for r in rows]) > 0.98


SCHEMA = "doc_id int, text string, declared string, suffix string, host string, scores int, kept string"
HOSTS = ["a.example.com", "b.example.com", "c.org", "org", "", None, "x..y"]


def evidence(model, seed=3):
    draw = random.Random(seed)
    texts = {"en": "the of and that with", "de": "der und nicht die einer", "fr": "les des dans pour que", "es": "los que para del una"}
    rows = []
    for k in range(240):
        lang = draw.choice(model.languages)
        words = draw.choices(texts[lang].split(), k=draw.choice([0, 1, 2, 4, 30]))
        text = draw.choice([" ".join(words), " ".join(words), None, "123 ... !!", "zqxj wkvq xxqz jjkw " * 6])
        rows.append((k, text, draw.choice([lang, lang, None, "xx"]), draw.choice([lang, None, "com"]), draw.choice(HOSTS), 1, "x"))
    return rows


def plain(model, rows):
    """The fusion as nested loops over the definition."""
    size, names = len(model.languages), [*model.languages, "und"]
    scores = [model.score(r[1] or "") for r in rows]
    votes = [int(s.argmax()) if s.any() and s.argmax() < size else None for s in scores]
    count = lambda keep: np.array([sum(v == k and keep(r) for r, v in zip(rows, votes, strict=True)) for k in range(size)], float)
    smooth = lambda c, above, w: (c + w * above) / (c.sum() + w)
    found = {}
    for r, s in zip(rows, scores, strict=True):
        logs = s.copy()
        prior = np.full(size, 1 / size)
        if r[4] is not None and count(lambda q, h=r[4]: q[4] == h).any():
            whole = count(lambda q: q[4] is not None)
            prior = (whole + 1) / (whole.sum() + size)
            labels = r[4].split(".")
            for k in range(1, len(labels) + 1):
                node = ".".join(labels[-k:])
                ends = lambda q, node=node, k=k: q[4] is not None and len(q[4].split(".")) >= k and ".".join(q[4].split(".")[-k:]) == node
                prior = smooth(count(ends), prior, language.HOST_WEIGHT)
        logs[:-1] += np.log(prior * (1 - language.OTHER_PRIOR))
        logs[-1] += math.log(language.OTHER_PRIOR)
        for at in (2, 3):
            own = count(lambda q, at=at, v=r[at]: q[at] == v)
            if r[at] is not None and own.any():
                whole = count(lambda q, at=at: q[at] is not None)
                base = (whole + 1) / (whole.sum() + size)
                logs[:-1] += np.log(smooth(own, base, language.HINT_WEIGHT) / base)
        p = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
        best = names[int(logs.argmax())]
        found[r[0]] = (best, p.max(), bool(s.any()) and best != "und" and p.max() >= language.LEAST_PROBABILITY)
    return found


def test_fusion_equals_plain_version(spark, model):
    rows = evidence(model)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = language.identify(frame, model, declared=F.col("declared"), suffix=F.col("suffix"), host=F.col("host")).collect()
    wanted = plain(model, rows)
    assert len(found) == len(wanted)
    for r in found:
        assert (r.language, r.kept) == (wanted[r.doc_id][0], wanted[r.doc_id][2])
        assert r.probability == pytest.approx(wanted[r.doc_id][1])
    assert {r.language for r in found} == {*model.languages, "und"}
    assert any(not r.kept for r in found)


def test_hints_decide_where_the_text_is_short(spark, model):
    rows = [(k, "die der und nicht einer", "de", None, "h.de", 1, "") for k in range(60)] + [(99, "in", "de", None, "h.de", 1, "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r.language for r in language.identify(frame, model, declared=F.col("declared"), host=F.col("host")).collect()}
    assert found[99] == "de"


def test_pages(spark, model):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    found = language.identify(pages, model, "page_id", "html", language.declared_language(F.col("html")), language.address_suffix(F.col("url")), F.split_part("url", F.lit("/"), F.lit(3)))
    right = found.join(pages.select("page_id", language.declared_language(F.col("html")).alias("lang")), "page_id")
    assert right.where("language = lang").count() > 0.95 * pages.count()
    assert [tuple(r) for r in spark.sql("select 'https://a.b/DE-at/x' u union all select 'x' union all select 'http://q.fr' union all select null").select(language.address_suffix(F.col("u"))).collect()] == [("de",), (None,), ("fr",), (None,)]


def test_empty_tables(spark, docs, model):
    none = docs.limit(0)
    empty = language.fit(none)
    assert empty.languages == []
    assert language.identify(none, model, declared=F.col("lang"), host=F.col("source")).collect() == []
    assert {r.kept for r in language.identify(docs.limit(3), empty).collect()} == {False}
    few = spark.createDataFrame([(None, None, None), (2, "", "en"), (2, "the", None)], "doc_id int, text string, lang string")
    assert [r.kept for r in language.identify(few, model, declared=F.col("lang")).orderBy("kept").collect()] == [False, False, True]


def test_rare_labels_are_known_or_kept(spark):
    # 30 of 10,000 rows are 0.3 %; 3 rows are too few for a model
    rows = [(k, "the of and that with this from", "en") for k in range(9967)]
    rows += [(20_000 + k, "και το της είναι για από", "el") for k in range(30)] + [(30_000 + k, "это был он как что", "ru") for k in range(3)]
    rows += [(40_000, "123 ...", "ru")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(3)
    model = language.fit(frame, rows=400)
    assert model.languages == ["el", "en"]
    found = {r.doc_id: r for r in language.identify(frame, model, declared=F.col("lang"), label=F.col("lang")).collect()}
    assert all(found[20_000 + k].language == "el" and found[20_000 + k].kept for k in range(30))
    assert all(found[30_000 + k].kept for k in range(3)) and not found[40_000].kept


def test_query_judges_pages_with_all_evidence(spark, monkeypatch):
    from seqloom.llm.queries import QUERIES

    seen = {}
    inner = language.identify
    monkeypatch.setattr(language, "identify", lambda rows, model, **hints: seen.update(hints) or inner(rows, model, **hints))
    found = QUERIES["op7_language_pages"](spark, SF_DIR)
    assert all(seen[h] is not None for h in ("declared", "suffix", "host"))
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    right = found.join(pages.select("page_id", language.declared_language(F.col("html")).alias("lang")), "page_id")
    assert found.count() == pages.count() and right.where("language = lang").count() > 0.95 * pages.count()
    text = spark.sql("select '<p class=a>one<script>var x=1;</script>two<!-- three\n--></p>' as html").select(language.page_text(F.col("html"))).first()[0]
    assert text.split() == ["one", "two"]
