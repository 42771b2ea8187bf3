"""Train and score a next-vector model on stored examples; everything it learns is a table."""

import dataclasses
import datetime
import json
import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.config import Settings
from seqloom.functions import lstm
from seqloom.operators import metrics
from seqloom.operators.evaluate import macro_average, regression_eval
from seqloom.operators.predict import predict
from seqloom.operators.split import train_valid_split
from seqloom.operators.train import ModelState, plan_rounds, plan_workers, train_epoch
from seqloom.sources.published import exists, remove, write_small_file

ITERATIONS = (
    "worker int, iteration bigint, ts timestamp, n bigint, loss double, learning_rate double, "
    "gradient_norm double, parameter_norm double, parameter_update double, error string, "
    "run_id string, epoch int, round int"
)
PARAMS = (
    "layer int, name string, param_idx bigint, value float, m float, v float, step bigint, "
    "run_id string, epoch int"
)
SCORES = (
    "dims bigint, r2_dims bigint, mse double, rmse double, mae double, r2 double, "
    "run_id string, epoch int"
)
EPOCHS = "start_ts timestamp, end_ts timestamp, run_id string, epoch int"
SETTINGS = "batch_size int, hidden_size int, run_id string"
# One file per run and complete epoch; epoch 0 is the start of the run and holds its settings.
PROGRESS = "epoch int, workers int, knobs string, run_id string"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(",")]


def _knobs(settings: Settings) -> dict:
    """What a resumed run must share with the one it goes on from: all but the number of epochs."""
    return {k: v for k, v in dataclasses.asdict(settings).items() if k != "epochs"}


@dataclass(frozen=True)
class RunTables:
    """Where a run's tables lie: one folder each below ``root``, one subfolder per run."""

    root: str

    def _complete(self, spark: SparkSession, rows: DataFrame) -> DataFrame:
        """``rows`` of epochs whose every table is written; the last thing an epoch writes says so.

        Tables that no run of :func:`train` has started are taken as they are.
        """
        done = self.progress(spark)
        if done is None:
            return rows
        return rows.join(done.select("run_id", "epoch"), ["run_id", "epoch"], "left_semi")

    def progress(self, spark: SparkSession) -> DataFrame | None:
        """Starts and complete epochs of all runs: a row of a few numbers for each."""
        if not exists(spark, f"{self.root}/progress"):
            return None
        return spark.read.schema(PROGRESS).json(f"{self.root}/progress")

    def begin(self, spark: SparkSession, run_id: str, settings: Settings, workers: int) -> None:
        """Forget what a run of that name has done and note with which settings it starts."""
        remove(spark, f"{self.root}/progress/run_id={run_id}")
        self._note(spark, run_id, 0, workers, json.dumps(_knobs(settings), sort_keys=True))

    def finish_epoch(self, spark: SparkSession, run_id: str, epoch: int, workers: int) -> None:
        self._note(spark, run_id, epoch, workers, "")

    def _note(self, spark, run_id, epoch, workers, knobs) -> None:
        entry = json.dumps({"epoch": epoch, "workers": workers, "knobs": knobs})
        if not write_small_file(spark, f"{self.root}/progress/run_id={run_id}/{epoch:06d}.json", entry):
            raise RuntimeError(f"another job trains run {run_id} at {self.root}")

    def iterations(self, spark: SparkSession) -> DataFrame:
        rows = self._complete(spark, spark.read.schema(ITERATIONS).parquet(f"{self.root}/workers"))
        return rows.filter(F.col("ts").isNotNull()).select(*_names(ITERATIONS))

    def params(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.schema(PARAMS).parquet(f"{self.root}/params")
        return self._complete(spark, rows).select(*_names(PARAMS))

    def scores(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.schema(SCORES).parquet(f"{self.root}/scores")
        return self._complete(spark, rows).select(*_names(SCORES))

    def epoch_spans(self, spark: SparkSession) -> DataFrame:
        """When each epoch's training began and ended."""
        rows = spark.read.schema(EPOCHS).parquet(f"{self.root}/epochs")
        return self._complete(spark, rows).select(*_names(EPOCHS))

    def settings(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(SETTINGS).parquet(f"{self.root}/settings")

    def epochs(self, spark: SparkSession) -> DataFrame:
        """Duration and validation scores per epoch."""
        durations = metrics.epoch_durations(self.epoch_spans(spark))
        return metrics.epoch_validation(self.scores(spark), durations)

    def summary(self, spark: SparkSession) -> DataFrame:
        durations = metrics.epoch_durations(self.epoch_spans(spark))
        return metrics.run_summary(durations, self.settings(spark))

    def write_stats(self, spark: SparkSession, run_id: str) -> None:
        """Store a run's report: epochs, last-seen metrics, throughput and summary."""
        reports = run_reports(
            self.iterations(spark), self.epoch_spans(spark), self.scores(spark), self.settings(spark)
        )
        for name, report in reports.items():
            rows = report.filter(F.col("run_id") == run_id).drop("run_id")
            rows.coalesce(1).write.mode("overwrite").parquet(
                f"{self.root}/stats/{name}/run_id={run_id}"
            )


def run_reports(
    iterations: DataFrame, spans: DataFrame, scores: DataFrame, settings: DataFrame
) -> dict[str, DataFrame]:
    """Epochs, last-seen metrics, throughput and summary; one row per run or epoch."""
    durations = metrics.epoch_durations(spans)
    return {
        "epochs": metrics.epoch_validation(scores, durations),
        "final_metrics": metrics.epoch_final_metrics(iterations),
        "throughput": metrics.throughput(iterations, spans),
        "summary": metrics.run_summary(durations, settings),
    }


def layer_table(spark: SparkSession, settings: Settings) -> DataFrame:
    dim, hidden = settings.embedding_dim, settings.hidden_size
    return spark.createDataFrame(
        [(0, "recurrent", dim, hidden, "tanh"), (1, "output", hidden, dim, "identity")],
        "layer int, kind string, n_in int, n_out int, activation string",
    )


def parameter_table(averaged: DataFrame, settings: Settings) -> DataFrame:
    """Flat positions as (layer, name, index inside the named block)."""
    layer, name, base = F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(0)
    at = 0
    blocks = []
    for number, label, shape in lstm.layout(settings.embedding_dim, settings.hidden_size):
        blocks.append((at, number, label))
        at += math.prod(shape)
    for start, number, label in blocks:
        inside = F.col("pos") >= start
        layer = F.when(inside, number).otherwise(layer)
        name = F.when(inside, label).otherwise(name)
        base = F.when(inside, start).otherwise(base)
    return averaged.select(
        layer.alias("layer"),
        name.alias("name"),
        (F.col("pos") - base).cast("bigint").alias("param_idx"),
        F.col("params").alias("value"),
        "m",
        "v",
        "step",
    )


def load_model(
    spark: SparkSession, tables: RunTables, run_id: str, epoch: int, settings: Settings
) -> ModelState:
    """The stored model of one epoch (model-sized, so it may meet on the driver)."""
    rows = tables.params(spark).filter((F.col("run_id") == run_id) & (F.col("epoch") == epoch))
    blocks = {}
    at = 0
    for number, label, shape in lstm.layout(settings.embedding_dim, settings.hidden_size):
        blocks[(number, label)] = at
        at += math.prod(shape)
    table = rows.toArrow()
    if table.num_rows != at:
        raise ValueError(f"run {run_id} epoch {epoch} stores {table.num_rows} of {at} parameters")
    starts = [
        blocks[(number, label)]
        for number, label in zip(
            table.column("layer").to_pylist(), table.column("name").to_pylist(), strict=True
        )
    ]
    place = np.array(starts) + table.column("param_idx").to_numpy()
    order = np.argsort(place)
    flat = [table.column(c).to_numpy()[order].astype(np.float32) for c in ("value", "m", "v")]
    return ModelState(*flat, table.column("step")[0].as_py())


def last_epoch(spark: SparkSession, tables: RunTables, run_id: str, settings: Settings) -> tuple[int, int] | None:
    """The last complete epoch of a run and its number of workers; None for a run that never started.

    Raises when the run began with other settings: what it stored would not be a part of this run.
    """
    progress = tables.progress(spark)
    notes = [] if progress is None else progress.filter(F.col("run_id") == run_id).collect()
    if not notes:
        return None
    (start,) = (n for n in notes if n.epoch == 0)
    was, now = json.loads(start.knobs), _knobs(settings)
    other = sorted(k for k in now if was.get(k) != now[k])
    if other:
        raise ValueError(f"run {run_id} began with other settings: {', '.join(other)}")
    return max(n.epoch for n in notes), start.workers


def train(
    examples: DataFrame, settings: Settings, root: str, run_id: str, resume: bool = False
) -> tuple[RunTables, ModelState]:
    """``epochs`` passes of parameter averaging over a *stored* example table.

    The table's own ``split`` column decides what is trained on, if it has one.

    After each epoch the averaged parameters, the validation scores and the time
    that training took, first read to last average, are written below ``root``; worker metrics are written by the workers, the
    run's report at the end. A note is written last of all: an epoch without one was cut short, and no
    reader sees its rows.

    With ``resume`` a run that was cut short goes on after its last complete epoch, from the stored
    parameters, optimizer moments and step, and ends with the parameters that it would have had; a
    finished run may go on to more ``epochs``. Without it a run of that name starts anew.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id):
        raise ValueError(f"run id {run_id!r} is no folder name")
    spark = examples.sparkSession
    tables = RunTables(root)
    before = last_epoch(spark, tables, run_id, settings) if resume else None
    if before:
        settings_now = dataclasses.replace(settings, workers=before[1])
    else:
        settings_now = settings
    parts = examples
    if "split" not in examples.columns:
        parts = train_valid_split(
            examples, train_percent=settings.train_percent, salt=settings.split_salt
        )
    training = parts.filter("split = 'train'").drop("split")
    validation = parts.filter("split = 'valid'").drop("split")
    workers = plan_workers(training, settings_now)
    first, state = 1, ModelState.initial(settings)
    if before:
        first = before[0] + 1
        if before[0]:
            state = load_model(spark, tables, run_id, before[0], settings)
    else:
        tables.begin(spark, run_id, settings, workers.count)
        spark.createDataFrame(
            [(settings.batch_size, settings.hidden_size)], "batch_size int, hidden_size int"
        ).coalesce(1).write.mode("overwrite").parquet(f"{root}/settings/run_id={run_id}")
    rounds = plan_rounds(training, settings, workers.count) if first <= settings.epochs else None
    for epoch in range(first, settings.epochs + 1):
        here = f"run_id={run_id}/epoch={epoch}"
        start = datetime.datetime.now(datetime.UTC)
        state, averaged = train_epoch(
            spark, training, rounds, state, settings, workers, f"{root}/workers/{here}"
        )
        span = [(start, datetime.datetime.now(datetime.UTC))]
        spark.createDataFrame(span, "start_ts timestamp, end_ts timestamp").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{root}/epochs/{here}")
        parameter_table(averaged, settings).write.mode("overwrite").parquet(
            f"{root}/params/{here}"
        )
        predicted = predict(
            validation, state.params, settings.embedding_dim, settings.hidden_size
        )
        macro_average(regression_eval(predicted)).coalesce(1).write.mode("overwrite").parquet(
            f"{root}/scores/{here}"
        )
        tables.finish_epoch(spark, run_id, epoch, workers.count)
    tables.write_stats(spark, run_id)
    return tables, state
