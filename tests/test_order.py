import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.operators import index
from seqloom.operators.index import running_start, sequence_index
from seqloom.operators.windows import sliding_window, sliding_window_by_key, window_rows


def brute(tokens, size):
    return {
        i: (list(tokens[i - size : i]), tokens[i]) for i in range(size, len(tokens))
    }


def as_dict(windows):
    rows = window_rows(windows).collect()
    found = {r.example_id: (list(r.input_tokens), r.target_token) for r in rows}
    assert len(found) == len(rows)
    return found


def test_small_stream(stream):
    found = as_dict(sliding_window(stream([1, 2, 3, 4, 1, 2]), 4))
    assert found == {4: ([1, 2, 3, 4], 1), 5: ([2, 3, 4, 1], 2)}


@pytest.mark.parametrize("n", [0, 1, 4])
def test_too_short_for_a_window(stream, n):
    assert sliding_window(stream(range(n)), 4).count() == 0


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(n=st.integers(0, 400), size=st.integers(1, 40), block=st.integers(1, 100))
def test_blocks_equal_brute_force(stream, n, size, block):
    rng = random.Random(n * 1000 + size)
    tokens = [rng.randrange(50) for _ in range(n)]
    found = as_dict(sliding_window(stream(tokens), size, block_rows=block))
    assert found == brute(tokens, size)
    assert len(found) == max(0, n - size)


def test_blocks_equal_the_unpartitioned_window(spark):
    size = 4
    rows = spark.range(20_000).select(
        F.col("id").alias("idx"), (F.col("id") * 7919 % 613).cast("int").alias("token_id")
    )
    spec = W.orderBy("idx").rowsBetween(-size, -1)
    naive = (
        rows.withColumn("input_tokens", F.collect_list("token_id").over(spec))
        .filter(F.size("input_tokens") == size)
        .select("idx", "input_tokens", F.col("token_id").alias("target_token"))
    )
    blocked = sliding_window(rows, size, block_rows=64).select(*naive.columns)
    assert naive.exceptAll(blocked).isEmpty() and blocked.exceptAll(naive).isEmpty()


def test_gap_in_the_numbering_raises(stream):
    rows = stream(range(100)).filter("idx != 50")
    with pytest.raises(Exception, match="without gaps"):
        sliding_window(rows, 4, block_rows=64).count()


def test_no_task_sees_the_whole_stream(spark, stream):
    plan = sliding_window(stream(range(100)), 4)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "hashpartitioning(_block" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_index_counts_every_row_in_order(spark):
    rng = random.Random(5)
    # one leading key holds a third of the rows
    rows = [(1 if rng.random() < 0.33 else rng.randrange(500), n) for n in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, n int").repartition(7)
    found = sequence_index(df, ["k", "n"], partitions=5).orderBy("idx").collect()
    assert [(r.k, r.n) for r in found] == sorted(rows)
    assert [r.idx for r in found] == list(range(len(rows)))


def test_index_splits_a_hot_key(spark):
    df = spark.range(30_000).select(F.lit(1).alias("k"), F.col("id").alias("n"))
    df = df.repartition(6)
    rows = df.repartitionByRange(6, "k", "n").groupBy(F.spark_partition_id().alias("p")).count()
    assert max(r["count"] for r in rows.collect()) < 10_000


def test_index_of_list_elements(spark):
    rng = random.Random(6)
    lists = [(d, [rng.randrange(9) for _ in range(rng.choice([0, 0, 1, 3, 200]))]) for d in range(80)]
    df = spark.createDataFrame(lists, "d int, items array<int>").repartition(5)
    found = sequence_index(df, ["d"], explode=F.col("items")).orderBy("idx").collect()
    wanted = [(d, p, x) for d, items in lists for p, x in enumerate(items)]
    assert [(r.d, r.pos, r.token_id) for r in found] == wanted
    assert [r.idx for r in found] == list(range(len(wanted)))


@pytest.mark.parametrize("small", [200_000, 10])
def test_running_start_in_one_and_two_levels(spark, monkeypatch, small):
    monkeypatch.setattr(index, "SMALL_BLOCKS", small)
    sizes = [(n, n * 37 % 11) for n in range(300)]
    df = spark.createDataFrame(sizes, "b int, size bigint").repartition(4)
    found = running_start(df, ["b"], "size", "start").orderBy("b").collect()
    total = 0
    for row, (b, size) in zip(found, sizes, strict=True):
        assert (row.b, row.start) == (b, total)
        total += size


def keyed_brute(rows, size):
    found = []
    for key in {k for k, _, _ in rows}:
        line = sorted((p, t) for k, p, t in rows if k == key)
        tokens = [t for _, t in line]
        for i in range(size, len(line)):
            found.append((key, line[i][0], tuple(tokens[i - size : i]), tokens[i]))
    return sorted(found, key=str)


@pytest.mark.parametrize("hot_rows", [10**9, 100, 0])
@pytest.mark.parametrize("size", [3, 35])
def test_windows_stop_at_sequence_ends(spark, hot_rows, size):
    rng = random.Random(7)
    rows = [
        (rng.choice([None, 1, 1, 1, 2, 3, 4 + n % 40]), n * 3, rng.randrange(90))
        for n in range(900)
    ]
    df = spark.createDataFrame(rows, "k int, p int, token_id int").repartition(5)
    windows = sliding_window_by_key(df, size, "k", ["p"], hot_rows=hot_rows, block_rows=64)
    found = [(r.k, r.p, tuple(r.input_tokens), r.target_token) for r in windows.collect()]
    assert sorted(found, key=str) == keyed_brute(rows, size)


def test_windows_over_two_short_lists(spark):
    rows = [(0, p, t) for p, t in enumerate([1, 2, 3])] + [(1, p, t) for p, t in enumerate([4, 5])]
    df = spark.createDataFrame(rows, "line int, pos int, token_id int")
    assert sliding_window_by_key(df, 4, "line", ["pos"]).isEmpty()
    found = as_dict(sliding_window(sequence_index(df, ["line", "pos"]), 4))
    assert found == {4: ([1, 2, 3, 4], 5)}
