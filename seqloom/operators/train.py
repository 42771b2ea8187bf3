"""Parameter averaging over partitions (Zinkevich et al. 2010)."""

import math
import time
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.config import Settings
from seqloom.functions import lstm
from seqloom.functions.text import hash_bucket
from seqloom.operators.predict import matrices, targets
from seqloom.storage import stage

# What a worker returns: a row per mini-batch, then one row with its parameters.
WORKER_ROWS = (
    "worker int, iteration bigint, ts timestamp, n bigint, loss double, learning_rate double, "
    "gradient_norm double, parameter_norm double, parameter_update double, error string, "
    "params array<float>, m array<float>, v array<float>"
)
_ARROW = pa.schema(
    [
        ("worker", pa.int32()),
        ("iteration", pa.int64()),
        ("ts", pa.timestamp("us", tz="UTC")),
        ("n", pa.int64()),
        ("loss", pa.float64()),
        ("learning_rate", pa.float64()),
        ("gradient_norm", pa.float64()),
        ("parameter_norm", pa.float64()),
        ("parameter_update", pa.float64()),
        ("error", pa.string()),
        ("params", pa.list_(pa.float32())),
        ("m", pa.list_(pa.float32())),
        ("v", pa.list_(pa.float32())),
    ]
)


class ModelState:
    """Parameters and optimizer moments: model-sized, the only thing a round sends back."""

    def __init__(self, params, m, v, step):
        self.params, self.m, self.v, self.step = params, m, v, step

    @classmethod
    def initial(cls, settings: Settings) -> "ModelState":
        flat = lstm.initial(settings.embedding_dim, settings.hidden_size, settings.seed)
        return cls(flat, np.zeros_like(flat), np.zeros_like(flat), 0)


def _mini_batches(batches, size, dim):
    held_x, held_y = [], []
    held = 0
    for batch in batches:
        x, y = matrices(batch.column("x"), dim), targets(batch.column("y"), dim)
        at = 0
        while at < len(x):
            take = min(size - held, len(x) - at)
            held_x.append(x[at : at + take])
            held_y.append(y[at : at + take])
            held, at = held + take, at + take
            if held == size:
                yield np.concatenate(held_x), np.concatenate(held_y)
                held_x, held_y, held = [], [], 0
    if held:
        yield np.concatenate(held_x), np.concatenate(held_y)


def _local_steps(state, settings: Settings):
    dim, hidden, rate = settings.embedding_dim, settings.hidden_size, settings.learning_rate

    def run(batches):
        params, m, v, step = state.value
        params, m, v = params.copy(), m.copy(), v.copy()
        worker, seen, rows = TaskContext.get().partitionId(), 0, []
        scratch = lstm.Scratch()
        for x, y in _mini_batches(batches, settings.batch_size, dim):
            loss, grad = lstm.loss_and_gradient(params, x, y, hidden, scratch)
            step += 1
            update = lstm.adam_step(params, grad, m, v, step, rate, scratch)
            seen += len(x)
            row = {
                "worker": worker, "iteration": step, "ts": int(time.time() * 1e6),
                "n": len(x), "loss": loss, "learning_rate": rate,
            }
            try:
                row["gradient_norm"] = float(np.linalg.norm(grad))
                row["parameter_norm"] = float(np.linalg.norm(params))
                row["parameter_update"] = float(np.linalg.norm(update))
            except Exception as failure:  # a metric that fails must not fail the training
                row["error"] = str(failure)
            rows.append(row)
            if len(rows) == 1000:
                yield _record_batch(rows)
                rows = []
        if seen:
            rows.append(
                {"worker": worker, "iteration": step, "n": seen, "params": params, "m": m, "v": v}
            )
            yield _record_batch(rows)

    return run


def _record_batch(rows):
    columns = [pa.array([r.get(f.name) for r in rows], type=f.type) for f in _ARROW]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class Workers(NamedTuple):
    """How many tasks train side by side, and whether rows must be dealt to them."""

    count: int
    deal: bool

    def of(self, examples: DataFrame) -> DataFrame:
        """``examples`` in one partition per worker; without a shuffle unless there are too few.

        Rows that were dealt are sorted, so that a worker sees the same rows in the same order every time.
        """
        if self.deal:
            return examples.repartition(self.count, "example_id").sortWithinPartitions("example_id")
        return examples.coalesce(self.count)


def plan_workers(examples: DataFrame, settings: Settings) -> Workers:
    """By default one worker for every scan partition of the stored table that holds rows, at most ``most_workers``.

    So the number follows the table and not the executors that happen to be there when it starts.
    """
    found = examples.select(F.spark_partition_id().alias("part")).distinct().count()
    count = settings.workers or min(max(found, 1), settings.most_workers)
    return Workers(count, found < count)


# Sums over workers of one vector each: total weight and, in doubles, weighted vectors.
_SUMS = "weight double, step bigint, params array<double>, m array<double>, v array<double>"
_VECTORS = ("params", "m", "v")

#: Partial sums that one task adds up.
FAN = 32


def _sum_vectors(batches):
    """One row per task, whatever the number of workers it has read."""
    weight, step, sums = 0.0, 0, None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        weights = batch.column("weight").to_numpy(zero_copy_only=False)
        found = []
        for name in _VECTORS:
            column = batch.column(name)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
            if len(values) % len(column) or (sums and len(values) // len(column) != len(sums[0])):
                raise ValueError("workers return vectors of different lengths")
            found.append(values.reshape(len(column), -1).sum(axis=0))
        weight, step = weight + weights.sum(), max(step, pc.max(batch.column("step")).as_py())
        sums = found if sums is None else [a + b for a, b in zip(sums, found, strict=True)]
    if sums is not None:
        yield pa.RecordBatch.from_pydict(
            {"weight": [weight], "step": [step], **{name: [s] for name, s in zip(_VECTORS, sums, strict=True)}},
            schema=_SUMS_ARROW,
        )


_SUMS_ARROW = pa.schema(
    [("weight", pa.float64()), ("step", pa.int64()), *((name, pa.list_(pa.float64())) for name in _VECTORS)]
)


def sum_workers(outputs: DataFrame, weighted: bool = False) -> DataFrame:
    """At most one row: the sum over workers of their vectors, each times its weight.

    Tasks add up the workers they read, then FAN tasks' sums at a time meet in one, so that no task
    holds more than some vectors and none is taken apart into cells.
    """
    factor = F.col("n").cast("double") if weighted else F.lit(1.0)
    scaled = [F.transform(name, lambda x: x.cast("double") * factor).alias(name) for name in _VECTORS]
    trained = outputs.filter(F.col("params").isNotNull())
    sums = trained.select(factor.alias("weight"), F.col("iteration").alias("step"), *scaled)
    sums = stage(sums.mapInArrow(_sum_vectors, _SUMS), "worker-sums")
    while (count := sums.count()) > 1:
        sums = stage(sums.repartition(-(-count // FAN)).mapInArrow(_sum_vectors, _SUMS), "worker-sums")
    return sums


def average(outputs: DataFrame, weighted: bool = False) -> DataFrame:
    """``(pos, params, m, v, step)``: the mean over workers of each parameter and moment."""
    cells = sum_workers(outputs, weighted).select(
        "weight", "step", F.posexplode(F.arrays_zip(*_VECTORS)).alias("pos", "cell")
    )
    means = [(F.col(f"cell.{name}") / F.col("weight")).cast("float").alias(name) for name in _VECTORS]
    return cells.select("pos", *means, "step")


def _collect_state(averaged: DataFrame) -> ModelState | None:
    """The averaged model, or None if no worker had a row."""
    table = averaged.toArrow().sort_by("pos")
    if table.num_rows == 0:
        return None
    flat = [table.column(c).to_numpy().astype(np.float32) for c in ("params", "m", "v")]
    return ModelState(*flat, table.column("step")[0].as_py())


class Rounds(NamedTuple):
    """Training rows stored by averaging round, and the number of rounds."""

    rows: DataFrame
    count: int


def round_of(example_id: Column, rounds: int) -> Column:
    """The averaging round of an example: a hash of its id."""
    key = F.concat(F.lit("round:"), example_id.cast("string"))
    return hash_bucket(key, rounds).cast("int")


def plan_rounds(examples: DataFrame, settings: Settings, workers: int) -> Rounds | None:
    """Rows cut into averaging rounds, or None when one round is an epoch.

    A round takes about ``workers * averaging_frequency * batch_size`` rows,
    chosen by a hash of the id; each epoch reads every round's folder once.
    """
    if settings.averaging_frequency is None:
        return None
    per_round = workers * settings.averaging_frequency * settings.batch_size
    rounds = math.ceil(examples.count() / per_round)
    if rounds <= 1:
        return None
    key = F.col("example_id").cast("string")
    rows = examples.withColumn("round", round_of(F.col("example_id"), rounds))
    worker = hash_bucket(F.concat(F.lit("worker:"), key), workers)
    rows = rows.withColumn("_worker", worker).repartition("round", "_worker")
    # in order, so that a run that is resumed deals the same batches
    rows = rows.sortWithinPartitions("round", "_worker", "example_id").drop("_worker")
    return Rounds(stage(rows, "rounds", partition_by=("round",)), rounds)


def train_epoch(
    spark: SparkSession,
    examples: DataFrame,
    rounds: Rounds | None,
    state: ModelState,
    settings: Settings,
    workers: Workers,
    path: str,
) -> tuple[ModelState, DataFrame]:
    """One pass over the rows; worker rows go to ``path/round=r``. Returns the averaged model.

    Each average is written once, and the model is read from what was written. A round without rows
    leaves the model as it is.
    """
    last = None
    for r in range(rounds.count if rounds else 1):
        rows = rounds.rows.filter(F.col("round") == r) if rounds else examples
        rows = workers.of(rows.select("example_id", "x", "y"))
        shared = spark.sparkContext.broadcast((state.params, state.m, state.v, state.step))
        target = f"{path}/round={r}"
        rows.mapInArrow(_local_steps(shared, settings), WORKER_ROWS).write.mode(
            "overwrite"
        ).parquet(target)
        outputs = spark.read.schema(WORKER_ROWS).parquet(target)
        averaged = stage(average(outputs, settings.weighted_average), "average")
        found = _collect_state(averaged)
        if found is not None:
            state, last = found, averaged
        shared.unpersist()
    if last is None:
        raise ValueError("no examples to train on")
    return state, last
