import math

import numpy as np
import pytest

from seqloom.llm import whitening
from seqloom.llm.queries import op13_whitening
from seqloom.llm.whitening import inertia, leading, whiten

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<double>"


def plain(rows, components=16):
    """(n, deviation by row, whitened without sign, explained) with numpy's own eigenvalues."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    deviations = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    return n, deviations, np.abs((x - sums / n) @ vectors[:, order] / np.sqrt(values[order])), values[order] / values.sum()


def test_query_equals_plain_version(spark):
    rows = sorted(spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect())
    n, deviations, whitened, explained = plain([r.embedding for r in rows])
    found = op13_whitening(spark, SF_DIR).toPandas().sort_values(["vec_id", "component"])
    assert len(found) == 16 * len(rows) and (found.n == n).all() and found.certified.all()
    assert found.deviation.to_list() == np.repeat(deviations, 16).tolist()
    assert np.allclose(np.abs(found.whitened.to_numpy().reshape(-1, 16)), whitened, rtol=0, atol=1e-9)
    assert np.allclose(found.explained.to_numpy().reshape(-1, 16), explained, rtol=1e-10)
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9


def test_odd_rows(spark):
    draw = np.random.default_rng(3)
    good = draw.standard_normal((300, 5)).tolist()
    odd = [None, [], [None] * 5, [1.0, math.nan, 0.0, 0.0, 0.0], [math.inf, 0.0, 0.0, 0.0, 0.0], [1e300, 0.0, 0.0, 0.0, 0.0], [1.0], [1.0] * 6]
    # copies of one vector count once in the fit list, but come back each; ids repeat or are missing
    rows = [(k, v, "x") for k, v in enumerate(good)] + [(1, good[0], "x")] * 500 + [(None, good[1], "x")] + [(9000 + k, v, "x") for k, v in enumerate(odd)]
    vectors = spark.createDataFrame(rows, SCHEMA + ", component string").repartition(7)
    found = whiten(vectors, components=9).toPandas()
    n, deviations, whitened, explained = plain(good)
    assert n == 300 and len(found) == 801 * 5 and set(found.component) == {1, 2, 3, 4, 5}
    first = found[(found.vec_id == 0)].sort_values("component")
    assert np.allclose(np.abs(first.whitened), whitened[0], atol=1e-10) and (first.deviation == deviations[0]).all()
    assert np.allclose(first.explained, explained) and found.vec_id.isna().sum() == 5


def test_partials_are_added_in_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rows = np.random.default_rng(5).standard_normal((90, 4)).tolist()
    vectors = spark.createDataFrame(list(enumerate(rows)), SCHEMA).repartition(9)
    _, _, whitened, _ = plain(rows)
    found = whiten(vectors).toPandas().sort_values(["vec_id", "component"])
    assert np.allclose(np.abs(found.whitened.to_numpy().reshape(-1, 4)), whitened, atol=1e-10)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25])] * 4])
def test_no_spread_gives_no_components(spark, rows):
    found = whiten(spark.createDataFrame(rows, SCHEMA))
    assert found.columns[:3] == ["vec_id", "component", "n"] and found.count() == 0


def test_fewer_components_where_vectors_lie_in_a_plane(spark):
    draw = np.random.default_rng(4)
    rows = [(k, [float(a), float(b), float(a + b), 0.0]) for k, (a, b) in enumerate(draw.integers(-9, 9, (50, 2)))]
    found = whiten(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert set(found.component) == {1, 2} and found.identity_error[0] < 1e-12


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [0.0, 1.0]), (3, [5.0, -(2.0**40)])]
    assert whiten(spark.createDataFrame(rows, SCHEMA)).toPandas().deviation.isna().any()


def test_inertia_counts_eigenvalues():
    draw = np.random.default_rng(6)
    for dim in (1, 2, 3, 8, 33):
        for _ in range(10):
            a = draw.standard_normal((dim, dim))
            a = a + a.T
            values = np.linalg.eigvalsh(a)
            for shift in draw.uniform(values[0] - 1, values[-1] + 1, 12):
                assert inertia(a, shift) == (values > shift).sum()
    # zero diagonals need pivots of two rows
    assert inertia(np.array([[0.0, 2.0], [2.0, 0.0]]), 0.0) == 1


def test_equal_and_close_eigenvalues():
    draw = np.random.default_rng(7)
    basis, _ = np.linalg.qr(draw.standard_normal((20, 20)))
    values = np.array([7, 7, 7, 5, 5 - 1e-9, 5 - 2e-9, 3, 3, *[1.0] * 6, *[0.0] * 6])
    a = basis @ np.diag(values) @ basis.T
    found = leading((a + a.T) / 2, 16)
    assert np.allclose(found.values, values[values > 0], atol=1e-12) and found.certified.all()
    assert np.allclose(found.vectors @ found.vectors.T, np.eye(14), atol=1e-12)
    assert np.allclose(a @ found.vectors.T, found.vectors.T * found.values, atol=1e-11)
