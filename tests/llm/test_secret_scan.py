import random
import re

from pyspark.sql import functions as F

from seqloom.llm import secret_scan
from seqloom.llm.queries import op2_secrets

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id int, text string, source string, secret int, start string, label int"
PATTERN = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_-]{16,}={0,2}")


def key(draw, chars, n):
    return "".join(draw.choice(chars) for _ in range(n))


def samples(seed, n):
    """(text, secret, label): keys in code and look-alikes."""
    draw = random.Random(seed)
    words = ["alpha", "return", "value", "control", "simple", "table", "where", "number", "window", "reader"]
    rows = []
    for _ in range(n):
        hexes, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
        secret, form = draw.choice(
            [
                (key(draw, hexes, 40), 'token = "{}"'), (key(draw, alnum, 32), "api_key: {}"), ("AKIA" + key(draw, alnum[:26] + alnum[52:], 16), "{}"), (key(draw, hexes, 18), "password={}"),
            ]
        )
        rows.append((form.format(secret), secret, 1))
        other, form = draw.choice(
            [
                (key(draw, hexes, 40), "commit {}"), ("".join(draw.choices(words, k=3)) + "Reader2", "{} is"), (key(draw, "0123456789", 18), "number {}"), (key(draw, hexes, 32), "md5: {}"),
            ]
        )
        rows.append((form.format(other), other, 0))
    return [(" ".join(draw.choices(words, k=9)) + " é " + t + " " + " ".join(draw.choices(words, k=9)), s, y) for t, s, y in rows]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "src/tests/x.py" if k % 3 else None, 1, "x", 1) for k, t in enumerate(rows)], SCHEMA)


def test_candidates_equal_plain_pattern(spark):
    texts = [t for t, *_ in samples(1, 40)] + [None, "", "x" * 50, "aB" * 20 + "\n" + "1" * 20 + "==" + "\U0001f600 " + "a1-" * 9, "=" + "9" * 16 + "===", "A1" * 40_000]
    found = secret_scan.candidates(frame(spark, texts)).collect()
    wanted = {(k, m.start(), m[0], (t[m.end() :] or "")[:1]) for k, t in enumerate(texts) if t for m in PATTERN.finditer(t)}
    assert {(r.id, r.start, r.secret, r.after) for r in found} == wanted
    assert all(texts[r.id][: r.start].endswith(r.before) for r in found)


def test_held_out_findings_are_told_apart(spark):
    train, test = samples(2, 150), samples(3, 100)
    docs = frame(spark, [t for t, *_ in train + test])
    rows = secret_scan.with_features(secret_scan.candidates(docs), secret_scan.dictionary(docs)).persist()
    labels = spark.createDataFrame([(k, s, float(y)) for k, (_, s, y) in enumerate(train)], "id int, secret string, label double")
    model = secret_scan.fit(rows.join(labels, ["id", "secret"]))
    found = {r.id: r.is_secret for r in secret_scan.secrets(rows, model).collect()}
    held = range(len(train), len(train) + len(test))
    right = [found.get(k, False) == bool(y) for k, (_, _, y) in zip(held, test, strict=True)]
    assert sum(right) > 0.95 * len(right)


def test_query_finds_planted_secrets(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = {(r.doc_id, r.start, r.secret): r.is_secret for r in op2_secrets(spark, SF_DIR).collect()}
    wanted = {(d, m.start(), m[0]) for d, t in docs.items() if t for m in PATTERN.finditer(t)}
    assert set(found) == wanted
    planted = {(d, m.start(1), m[1]) for d, t in docs.items() if t for m in re.finditer(r'(?:token = "|password=)([0-9a-f]{18,40})|(?=x)x(AKIA[0-9A-Z]{16})', t) if m[1]}
    assert len(planted) > 10 and all(found[p] for p in planted if p in found)


def test_odd_rows(spark):
    assert secret_scan.scan(frame(spark, [])).collect() == []
    assert secret_scan.scan(frame(spark, [None, "", "plain words only"])).collect() == []
    rows = spark.createDataFrame([(None, "AKIA" + "A1" * 8), (4, "k " + "b2" * 9), (4, "k " + "b2" * 9)], "doc_id long, text string")
    found = secret_scan.scan(rows, path_col=None).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.is_secret) for r in found] == [(None, 0, True), (4, 2, False), (4, 2, False)]


def test_transitions_are_shares(spark):
    words = spark.createDataFrame([("abab", 2), ("acc", 1)], "word string, times long")
    found = {r.pair: round(float(2.718281828459045**r.weight), 6) for r in secret_scan.transitions(words).collect()}
    assert found == {"ab": 0.8, "ba": 1.0, "ac": 0.2, "cc": 1.0}
    assert secret_scan.dictionary(spark.createDataFrame([("One one ONE, one-one tw TWO1two",)], "text string")).where(F.col("times") == 5).first().word == "one"


def test_names_that_are_candidates_are_context(spark):
    value = "q8Zr3LmW0xTn5Vb2Kc7D"
    texts = [f'let awsSecretAccessKey = "{value}"', f"AWS_S3_SECRET_ACCESS_KEY={value}", f"é a1b2c3d4e5f6g7h8 i1b2c3d4e5f6g7h8 j1b2c3d4e5f6g7h8 k1b2c3d4e5f6g7h8 {value}"]
    docs = frame(spark, texts)
    found = secret_scan.candidates(docs)
    wanted = {(k, t[max(0, t.index(value) - 40) : t.index(value)]) for k, t in enumerate(texts)}
    assert {(r.id, r.before) for r in found.where(F.col("secret") == value).collect()} == wanted
    rows = secret_scan.with_features(found, secret_scan.dictionary(docs)).where(F.col("secret") == value).where("id < 2")
    assert [(r.words_for, r.assigned) for r in rows.collect()] == [(1.0, 1.0)] * 2
    assert [r.label for r in secret_scan.plain_labels(rows).collect()] == [1.0, 1.0]


def test_a_rare_class_is_in_the_sample(spark):
    # 4 secrets among 4,000 other strings, of which 50 are drawn
    zero = {f: 0.0 for f in secret_scan.FEATURES}
    rows = [(float(k % 1000 == 0), *{**zero, "length": float(k), "assigned": float(k % 1000 == 0)}.values()) for k in range(4000)]
    labelled = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in ("label", *secret_scan.FEATURES)))
    model = secret_scan.fit(labelled, rows=50)
    assert model is not None
    found = secret_scan.secrets(labelled, model).where("is_secret").count()
    assert found == 4
    assert secret_scan.fit(labelled.where("label = 0"), rows=50) is None
