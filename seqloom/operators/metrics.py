"""Run metrics as aggregations over the iteration table.

The iteration table has one row per mini-batch of each worker:
``run_id, epoch, round, worker, iteration, ts, n, loss, learning_rate,
gradient_norm, parameter_norm, parameter_update, error``. The epoch table has one
row per epoch, ``run_id, epoch, start_ts, end_ts``: the time from before an epoch's
training to after its last average, without the scoring between epochs.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.config import MOST_WORKERS
from seqloom.functions.vectors import l2_norm

LAST_SEEN = ("loss", "learning_rate", "gradient_norm", "parameter_norm")
WORKER_BITS = MOST_WORKERS.bit_length() - 1


def vector_norms(table: DataFrame, vec: str, norm: str = "norm") -> DataFrame:
    return table.withColumn(norm, l2_norm(F.col(vec)))


def parameter_norms(params: DataFrame) -> DataFrame:
    """L2 norm of all parameters, and of their change since the epoch before (0 on the first).

    ``params`` has one row per (run, epoch, layer, name, param_idx).
    """
    spec = W.partitionBy("run_id", "layer", "name", "param_idx").orderBy("epoch")
    value = F.col("value").cast("double")
    next_epoch = F.lag("epoch").over(spec) + 1 == F.col("epoch")
    change = value - F.coalesce("_before", value)
    return (
        params.withColumn("_before", F.when(next_epoch, F.lag(value).over(spec)))
        .groupBy("run_id", "epoch")
        .agg(
            F.sqrt(F.sum(value * value)).alias("parameter_norm"),
            F.sqrt(F.sum(change * change)).alias("parameter_update"),
        )
    )


def score_iterations(iterations: DataFrame, every: int = 10) -> DataFrame:
    """The loss of every ``every``-th iteration."""
    return iterations.filter(F.col("iteration") % every == 0).select(
        "run_id", "epoch", "worker", "iteration", "loss"
    )


def _millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def throughput(iterations: DataFrame, spans: DataFrame) -> DataFrame:
    """Iterations of each run, and per second from its start to its last iteration; NULL when no time passed."""
    counts = iterations.groupBy("run_id").agg(
        F.count("*").alias("iterations"), F.max("ts").alias("_last")
    )
    starts = spans.groupBy("run_id").agg(F.min("start_ts").alias("_start"))
    seconds = (F.unix_micros("_last") - F.unix_micros("_start")) / F.lit(1e6)
    rate = F.try_divide(F.col("iterations"), seconds)
    return counts.join(starts, "run_id", "left").select(
        "run_id", "iterations", rate.alias("iterations_per_second")
    )


def epoch_durations(spans: DataFrame) -> DataFrame:
    """The epoch table with whole milliseconds from start to end."""
    duration = _millis(F.col("end_ts")) - _millis(F.col("start_ts"))
    return spans.select("run_id", "epoch", "start_ts", "end_ts", duration.alias("duration_ms"))


def layer_info(params: DataFrame, layers: DataFrame) -> DataFrame:
    """Parameter count and shape per layer; unknown layers show 0/0 and ``Unknown``.

    ``layers`` has one row per known layer: ``layer, kind, n_in, n_out, activation``.
    """
    counts = params.groupBy("layer").agg(F.count("*").alias("parameters"))
    known = counts.join(layers, "layer", "left")
    return known.select(
        "layer",
        F.coalesce("kind", F.lit("Unknown")).alias("kind"),
        "parameters",
        F.coalesce("n_in", F.lit(0)).alias("n_in"),
        F.coalesce("n_out", F.lit(0)).alias("n_out"),
        F.coalesce("activation", F.lit("Unknown")).alias("activation"),
    )


def epoch_final_metrics(iterations: DataFrame) -> DataFrame:
    """Loss, rate and norms last seen in each epoch: the highest worker of the last iteration."""
    # One number as order, so that the aggregate hashes instead of sorting its input.
    order = F.shiftleft(F.col("iteration").cast("bigint"), WORKER_BITS) + F.col("worker")
    columns = [c for c in LAST_SEEN if c in iterations.columns]
    return iterations.groupBy("run_id", "epoch").agg(
        *[F.max_by(c, order).alias(c) for c in columns]
    )


def epoch_validation(scores: DataFrame, durations: DataFrame) -> DataFrame:
    """Macro-averaged scores (one row per run and epoch) next to the epoch's duration."""
    return durations.select("run_id", "epoch", "duration_ms").join(
        scores, ["run_id", "epoch"], "left"
    )


def average_epoch_time(durations: DataFrame) -> DataFrame:
    """Whole milliseconds per epoch."""
    return durations.groupBy("run_id").agg(
        F.count("*").alias("epochs"),
        F.expr("cast(sum(duration_ms) as bigint) div count(*)").alias("average_epoch_ms"),
    )


def run_summary(durations: DataFrame, settings: DataFrame | None = None) -> DataFrame:
    """Start, end, whole minutes, epochs and average epoch time per run.

    ``settings`` (one row per ``run_id``) adds the run's knobs.
    """
    start, end = F.min("start_ts"), F.max("end_ts")
    rows = durations.groupBy("run_id").agg(
        start.alias("start_ts"),
        end.alias("end_ts"),
        F.expr(
            "(unix_millis(max(end_ts)) - unix_millis(min(start_ts))) div 60000"
        ).alias("total_minutes"),
        F.count("*").alias("epochs"),
        F.expr("cast(sum(duration_ms) as bigint) div count(*)").alias("average_epoch_ms"),
    )
    return rows if settings is None else rows.join(settings, "run_id", "left")
