import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.operators import checks, lookup
from seqloom.operators.examples import embed_windows, keep_complete, training_examples
from seqloom.operators.lookup import dedupe_last, fits_broadcast, lookup_embedding
from seqloom.operators.windows import sliding_window, window_rows


def f32(values):
    return [float(np.float32(v)) for v in values]


def code(p, dim):
    return np.array(
        [
            (math.cos if i % 2 else math.sin)(p / 10000 ** (2 * (i // 2) / dim))
            for i in range(dim)
        ],
        dtype=np.float32,
    )


def brute(tokens, table, size, dim):
    found = {}
    for i in range(size, len(tokens)):
        x = []
        for p, token in enumerate(tokens[i - size : i]):
            v = np.array(table.get(token, [0.0] * dim), dtype=np.float32)
            x.append((v + code(p, dim)) if len(v) == dim else np.zeros(dim, np.float32))
        found[i] = ([list(map(float, row)) for row in x], f32(table.get(tokens[i], [0.0] * dim)))
    return found


def collected(examples):
    return {r.example_id: (r.x, r.y) for r in examples.collect()}


TABLE = {5: [0.25, -0.5, 1.5], 8: [2.0, 0.75, -1.25], 9: [-0.375, 3.5, 0.125]}


def test_matrix_values(stream, vectors):
    found = collected(training_examples(stream([8, 5, 9]), vectors(TABLE), 2, 3))
    x, y = found[2]
    second = [0.25 + math.sin(1), -0.5 + math.cos(1), 1.5 + math.sin(1 / 10000 ** (2 / 3))]
    assert x[0] == pytest.approx([2.0, 1.75, -1.25], abs=1e-6)
    assert x[1] == pytest.approx(second, abs=1e-6)
    assert y == TABLE[9]


@pytest.mark.parametrize("limit", [2**28, 0])
@pytest.mark.parametrize("size", [2, 20])
def test_messy_tables_give_one_result(spark, stream, limit, size):
    rng = random.Random(size)
    dim = 3
    clean = {t: [rng.uniform(-1, 1) for _ in range(dim)] for t in range(8)}
    rows = [(t, [9.0] * dim, 0) for t in range(0, 8, 2)] + [(t, v, 1) for t, v in clean.items()]
    rows += [(20, [1.0] * dim, 0), (20, None, 1), (21, [1.0], 1), (None, [5.0] * dim, 1)]
    emb = spark.createDataFrame(rows, "token_id int, vec array<float>, line int").repartition(3)
    tokens = [rng.choice([*range(9), 20, 21]) for _ in range(120)]
    wanted = brute(tokens, {**clean, 20: [0.0] * dim, 21: [1.0]}, size, dim)
    options = {"limit": limit, "order_by": ["line"]}
    found = collected(training_examples(stream(tokens), emb, size, dim, block_rows=64, **options))
    windows = window_rows(sliding_window(stream(tokens), size))
    stored = collected(embed_windows(windows, emb, size, dim, **options))
    assert found.keys() == stored.keys() == wanted.keys()
    for i, (x, y) in wanted.items():
        np.testing.assert_allclose(found[i][0], x, atol=1e-6)
        assert found[i] == stored[i] and found[i][1] == y
    with pytest.raises(ValueError, match="repeated embedding ids"):
        training_examples(stream(tokens), emb, size, dim, limit=limit)
    with pytest.raises(ValueError, match="repeated embedding ids"):
        embed_windows(windows, emb, size, dim, limit=limit)


@pytest.mark.parametrize("limit", [2**28, 0])
@pytest.mark.parametrize("size", [2, 5, 20, 40])
def test_every_path_equals_brute_force(stream, vectors, limit, size):
    rng = random.Random(size)
    dim = 3
    # token 7 makes up a third of the stream, 0 and 9 are unknown, 8 has another length
    table = {t: [rng.uniform(-1, 1) for _ in range(dim)] for t in range(1, 8)}
    table[8] = [0.5, 0.25]
    tokens = [7 if rng.random() < 0.33 else rng.randrange(10) for _ in range(300)]
    emb = vectors(table)
    wanted = brute(tokens, table, size, dim)
    rows = training_examples(
        stream(tokens), emb, size, dim, limit=limit, block_rows=64
    )
    found = collected(rows)
    assert found.keys() == wanted.keys()
    for i, (x, y) in wanted.items():
        np.testing.assert_allclose(found[i][0], x, atol=1e-6)
        assert found[i][1] == y
    windows = window_rows(sliding_window(stream(tokens), size))
    stored = collected(embed_windows(windows, emb, size, dim, limit=limit))
    assert stored == found


def test_lookup_keeps_every_row(stream, vectors):
    tokens = [5, 99, 5, 8, 99, 5]
    for limit in (2**28, 0):
        found = lookup_embedding(stream(tokens), vectors(TABLE), 3, limit=limit)
        rows = sorted(found.collect(), key=lambda r: r.idx)
        assert [r.token_id for r in rows] == tokens
        assert [r.hit for r in rows] == [t != 99 for t in tokens]
        assert rows[1].vec == [0, 0, 0] and rows[0].vec == TABLE[5]


def test_large_table_is_shuffled_and_hot_tokens_are_salted(spark, vectors):
    emb = vectors({t: [float(t)] for t in range(400)})
    even = spark.range(4000).selectExpr("id as idx", "cast(id % 400 as int) as token_id")
    found = lookup_embedding(even, emb, 1, limit=0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    # a known, an unknown and a NULL token share most of the stream
    skewed = even.selectExpr(
        "idx",
        "case when idx % 3 = 0 then 7 when idx % 5 = 0 then 9999 when idx % 7 = 0 then null "
        "else token_id end as token_id",
    )
    hot = {str(r._hot): r._salts for r in lookup._hot_tokens(skewed, "token_id").collect()}
    # 4 partitions in quarters: a third of the rows fills six of sixteen
    assert hot == {"7": 6, "9999": 3, "None": 2}
    large = lookup_embedding(skewed, emb, 1, limit=0)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 4000") == 1
    assert plan.count("SortMergeJoin") == 1 and "Exchange hashpartitioning(token_id" in plan
    small = lookup_embedding(skewed, emb, 1)
    assert large.count() == 4000
    assert large.exceptAll(small.select(large.columns)).isEmpty()


def test_fits_broadcast_counts_rows_and_cells(vectors):
    table = vectors(TABLE)
    row = 64 + 2 * (32 + 4 * 3)
    assert fits_broadcast(table, 3, 2, 3 * row)
    assert not fits_broadcast(table, 3, 2, 3 * row - 1)
    assert not fits_broadcast(table, 3, 2, 0)
    longer = vectors({**TABLE, 4: [0.5] * 1000})
    assert not fits_broadcast(longer, 3, 2, 4 * row)
    assert fits_broadcast(longer, 3, 2, 4 * row + 2 * 4 * 997)


def test_last_vector_of_an_id_wins(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3]), [float(n)], n) for n in range(200)]
    df = spark.createDataFrame(rows, "token_id int, vec array<float>, line int").repartition(6)
    found = {r.token_id: r.vec for r in dedupe_last(df, ["line"]).collect()}
    assert found == {t: v for t, v, _ in rows}


def test_incomplete_examples_are_dropped(spark):
    rows = [
        (1, [[1.0], [2.0]], [1.0]),
        (2, [[1.0]], [1.0]),
        (3, None, [1.0]),
        (4, [[1.0], [2.0]], None),
        (5, [[1.0], [2.0]], [1.0, 2.0]),
    ]
    df = spark.createDataFrame(rows, "example_id bigint, x array<array<float>>, y array<float>")
    assert [r.example_id for r in keep_complete(df, 2).collect()] == [1, 5]
    assert [r.example_id for r in keep_complete(df, 2, 1).collect()] == [1]


def test_checks(spark, stream, vectors):
    rows = [(1, [1.0, 2.0]), (1, [1.0]), (None, [1.0, 2.0])]
    emb = spark.createDataFrame(rows, "token_id int, vec array<float>")
    found = checks.require_rows(checks.check_embeddings(emb, 2), "embeddings")
    assert found == {"n_rows": 3, "null_ids": 1, "repeated_ids": 1, "wrong_length": 1}
    with pytest.raises(ValueError, match="another length"):
        checks.require_vectors(checks.check_embeddings(emb, 2))
    with pytest.raises(ValueError, match="no tokens"):
        checks.require_rows(checks.check_tokens(stream([])), "tokens")
    lists = spark.createDataFrame([("[1]",), ("[x]",), (None,)], "tokens string")
    found = checks.check_lists(lists).first().asDict()
    assert found == {"n_rows": 3, "null_lists": 1, "bad_lists": 1}


def test_wide_windows_over_a_small_table_move_only_ids(spark, stream, vectors):
    rows = training_examples(stream(range(50)), vectors(TABLE), 20, 3)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    (exchange,) = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    below = plan[plan.index(exchange) + len(exchange) :].splitlines()[1:4]
    assert "BroadcastHashJoin" in plan[: plan.index(exchange)]
    assert not any("vec" in line for line in below)


def test_probe_plan_moves_only_ids(spark, stream, vectors):
    rows = training_examples(stream(range(50)), vectors(TABLE), 4, 3)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 5
    assert plan.count("Exchange hashpartitioning") == 1


def test_target_is_zero_for_unknown_tokens(stream, vectors):
    rows = training_examples(stream([1, 1, 99]), vectors(TABLE), 2, 3)
    assert rows.select(F.col("y")).first().y == [0, 0, 0]
