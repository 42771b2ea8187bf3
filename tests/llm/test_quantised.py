import numpy as np
import pytest

from seqloom.llm import quantised
from tests.llm.brute import groups

SCHEMA = "vec_id long, embedding array<float>, label int, id string, copies int"


def rows(seed=5, dims=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    spread = rng.choice([0.05, 0.25, 0.32, 0.4], size=(260, 1))
    found = (centres[rng.integers(0, 12, 260)] + spread * rng.normal(size=(260, dims))).astype(np.float32).tolist()
    found += [found[0]] * 7 + [found[30]] + [[2 * x for x in found[3]]]
    odd = [None, [], [0.0] * dims, [float("nan")] * dims, [None] + [1.0] * (dims - 1), [float("inf")] + [1.0] * (dims - 1), found[0][:5]]
    return [(k, v, 0, "x", 1) for k, v in enumerate(found + odd)]


@pytest.mark.parametrize(("block", "tile"), [(2048, 1024), (64, 16)])
def test_equals_brute_force(spark, block, tile):
    data = rows()
    frame = spark.createDataFrame(data, SCHEMA).repartition(4)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in quantised.near_vectors(frame, block=block, tile=tile).collect()}
    good = {}
    for k, v, *_ in data:
        x = np.array([np.nan if p is None else p for p in v], float) if v else np.zeros(1)
        if v and np.isfinite(x).all() and x.any():
            good[k] = x
    cos = lambda a, b: len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.9
    links = [(a, b) for a in good for b in good if a < b and cos(good[a], good[b])]
    root = groups([k for k, *_ in data], links)
    count = {k: sum(k in x for x in links) for k in root}
    assert found == {k: (count[k], root[k], root[k] == k) for k in root}
    assert 0 < len(links) and any(0.88 < good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) < 0.92 for a in good for b in good if a < b and len(good[a]) == len(good[b]))


def test_bound_holds():
    rng = np.random.default_rng(1)
    for dims in (2, 64, 1500):
        u = rng.normal(size=(80, dims)) * rng.choice([1, 1e-3, 30], size=(80, dims))
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        q, s, r, e = quantised.quantise(u)
        gap = np.abs(quantised.tile_product(q, q) * s[:, None] * s - u @ u.T)
        assert (gap <= r[:, None] * e + e[:, None] + quantised.SLACK).all()


def test_empty_table_null_and_repeated_ids(spark):
    run = lambda data: sorted(map(tuple, quantised.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()), key=str)
    assert run([]) == []
    assert run([(1, None)]) == [(1, 0, 1, True)]
    assert run([(2, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.1]), (3, [0.0, 1.0])]) == [(2, 2, 2, True), (2, 2, 2, True), (3, 0, 3, True), (None, 2, 2, False)]
