import datetime as dt

import pytest

from seqloom.functions import lstm
from seqloom.operators import metrics

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


@pytest.fixture
def log(spark):
    rows = []
    for n in range(25):
        ts = T0 + dt.timedelta(seconds=10 * n, microseconds=1500 * n)
        epoch = 1 + n // 12
        rows.append(("a", epoch, n % 2, n, ts, 100.0 - n, 0.001, n / 2, 1.0 + n))
    rows.append(("b", 1, 0, 0, T0, 5.0, 0.001, 1.0, 2.0))
    return spark.createDataFrame(
        rows,
        "run_id string, epoch int, worker int, iteration bigint, ts timestamp, loss double, "
        "learning_rate double, gradient_norm double, parameter_norm double",
    ).repartition(3)


@pytest.fixture
def spans(spark):
    second = dt.timedelta(seconds=1)
    rows = [("a", e, T0 + 120 * e * second, T0 + (120 * e + 70 + e) * second) for e in range(3)]
    rows.append(("b", 1, T0, T0 + dt.timedelta(microseconds=900)))
    return spark.createDataFrame(rows, "run_id string, epoch int, start_ts timestamp, end_ts timestamp")


def test_epoch_durations_and_average(spans):
    rows = metrics.epoch_durations(spans).collect()
    durations = {(r.run_id, r.epoch): r.duration_ms for r in rows}
    assert durations == {("a", 0): 70_000, ("a", 1): 71_000, ("a", 2): 72_000, ("b", 1): 0}
    rows = metrics.average_epoch_time(metrics.epoch_durations(spans)).collect()
    assert {r.run_id: (r.epochs, r.average_epoch_ms) for r in rows} == {"a": (3, 71_000), "b": (1, 0)}


def test_final_metrics_are_the_last_seen(log):
    rows = metrics.epoch_final_metrics(log).collect()
    found = {(r.run_id, r.epoch): (r.loss, r.gradient_norm, r.parameter_norm) for r in rows}
    assert found[("a", 1)] == (89.0, 5.5, 12.0)
    assert found[("a", 3)] == (76.0, 12.0, 25.0)


def test_throughput_counts_from_the_start_of_the_run(log, spans):
    early = spans.withColumn("start_ts", spans.start_ts - dt.timedelta(seconds=10)).filter("run_id = 'a'")
    found = {r.run_id: r for r in metrics.throughput(log, early).collect()}
    assert found["a"].iterations == 25
    assert found["a"].iterations_per_second == pytest.approx(25 / 250.036)
    found = {r.run_id: r for r in metrics.throughput(log, spans).collect()}
    assert found["b"].iterations_per_second is None


def test_every_tenth_loss(log):
    rows = metrics.score_iterations(log).filter("run_id = 'a'").collect()
    assert sorted(r.iteration for r in rows) == [0, 10, 20]


def test_run_summary(spark, spans):
    settings = spark.createDataFrame([("a", 32)], "run_id string, batch_size int")
    rows = metrics.run_summary(metrics.epoch_durations(spans), settings).collect()
    found = {r.run_id: r for r in rows}
    assert (found["a"].total_minutes, found["a"].epochs, found["a"].batch_size) == (5, 3, 32)
    assert found["b"].total_minutes == 0 and found["b"].batch_size is None


def test_layer_info_counts_parameters(spark):
    # two dense layers 30 -> 20: 30 * 20 weights and 20 biases each
    cells = spark.range(620).selectExpr("explode(array(0, 1, 7)) as layer", "id as param_idx")
    layers = spark.createDataFrame(
        [(0, "dense", 30, 20, "sigmoid"), (1, "output", 30, 20, "identity")],
        "layer int, kind string, n_in int, n_out int, activation string",
    )
    found = {r.layer: r for r in metrics.layer_info(cells, layers).collect()}
    assert found[0].parameters == 620 and (found[0].n_in, found[0].n_out) == (30, 20)
    assert (found[7].kind, found[7].n_in, found[7].activation) == ("Unknown", 0, "Unknown")


def test_recurrent_layer_size():
    assert lstm.size(50, 128) == 4 * 128 * (50 + 128 + 1) + 128 * 50 + 50


def test_parameter_norms(spark):
    rows = [("r", e, 0, "w", i, v) for e, vs in [(1, [3.0, 4.0]), (2, [3.0, 1.0])]
            for i, v in enumerate(vs)]
    df = spark.createDataFrame(
        rows, "run_id string, epoch int, layer int, name string, param_idx bigint, value float"
    )
    found = {r.epoch: r for r in metrics.parameter_norms(df).collect()}
    assert (found[1].parameter_norm, found[1].parameter_update) == (5.0, 0.0)
    assert found[2].parameter_update == 3.0
