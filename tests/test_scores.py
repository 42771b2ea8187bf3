import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.operators.evaluate import macro_average, regression_eval
from seqloom.operators.split import split_label, train_valid_split

SCHEMA = "y array<float>, p array<array<float>>"


def test_one_dimension(spark):
    rows = [([float(y)], [[float(p)]]) for y, p in zip([1, 2, 3], [1, 2, 4], strict=True)]
    score = regression_eval(spark.createDataFrame(rows, SCHEMA)).first()
    assert (score.dim, score.n) == (0, 3)
    assert score.mse == pytest.approx(1 / 3) and score.mae == pytest.approx(1 / 3)
    assert score.rmse == pytest.approx((1 / 3) ** 0.5) and score.r2 == pytest.approx(0.5)


def test_constant_labels_have_no_r2(spark):
    rows = [([2.0, 1.0], [[1.0, 1.0]]), ([2.0, 3.0], [[2.0, 3.0]])]
    scores = regression_eval(spark.createDataFrame(rows, SCHEMA)).orderBy("dim").collect()
    assert scores[0].r2 is None and scores[0].mse == 0.5
    assert scores[1].r2 == 1.0
    average = macro_average(spark.createDataFrame(scores)).first()
    assert (average.dims, average.r2_dims) == (2, 1)
    assert average.r2 == 1.0 and average.mse == 0.25


def test_scores_over_steps_and_groups(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(size=(60, 3)).astype(np.float32)
    p = rng.normal(size=(60, 4, 3)).astype(np.float32)
    rows = [(n % 2, y[n].tolist(), p[n].tolist()) for n in range(60)]
    df = spark.createDataFrame(rows, f"g int, {SCHEMA}").repartition(5)
    scores = regression_eval(df, by=["g"])
    found = {(r.g, r.dim): r for r in scores.collect()}
    for g in (0, 1):
        labels = np.repeat(y[g::2, None, :], 4, axis=1).reshape(-1, 3).astype(float)
        out = p[g::2].reshape(-1, 3).astype(float)
        mse = ((labels - out) ** 2).mean(axis=0)
        r2 = 1 - mse / labels.var(axis=0)
        for k in range(3):
            assert found[g, k].n == 120
            assert found[g, k].mse == pytest.approx(mse[k])
            assert found[g, k].rmse == pytest.approx(mse[k] ** 0.5)
            assert found[g, k].mae == pytest.approx(np.abs(labels - out).mean(axis=0)[k])
            assert found[g, k].r2 == pytest.approx(r2[k])
        average = macro_average(scores, by=["g"]).filter(F.col("g") == g).first()
        assert average.rmse == pytest.approx(np.sqrt(mse).mean())


def test_split_is_stable_and_complete(spark):
    ids = spark.range(10_000).withColumnRenamed("id", "example_id")
    sides = []
    for parts in (1, 3, 8):
        rows = train_valid_split(ids.repartition(parts)).collect()
        assert len(rows) == 10_000
        sides.append({r.example_id for r in rows if r.split == "valid"})
    assert sides[0] == sides[1] == sides[2]
    assert 1800 < len(sides[0]) < 2200
    other = ids.filter(split_label(F.col("example_id"), salt="other") == "valid")
    assert {r.example_id for r in other.collect()} != sides[0]
