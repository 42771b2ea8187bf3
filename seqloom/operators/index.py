"""Contiguous stream positions without gathering the stream in one task."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.operators.lookup import BROADCAST_BYTES
from seqloom.storage import stage

# monotonically_increasing_id() keeps the partition above this bit and the row number below it.
PARTITION_BIT = 33
ROW_MASK = (1 << PARTITION_BIT) - 1

# A block summary up to this many rows is summed in one task.
SMALL_BLOCKS = 200_000

# A row of the summary that rows are joined with: four whole numbers and what holds them.
SUMMARY_ROW_BYTES = 64


def running_start(blocks: DataFrame, order_by: list[str], size: str, start: str) -> DataFrame:
    """Sum of ``size`` over all earlier rows of a *block summary* (never of the stream itself).

    A small summary is summed in one task. A larger one is cut into ranges
    first, so that only one total per range meets in one task.
    """
    before = (W.unboundedPreceding, -1)

    def total(spec):
        return F.coalesce(F.sum(size).over(spec.rowsBetween(*before)), F.lit(0)).cast("bigint")

    if blocks.limit(SMALL_BLOCKS + 1).count() <= SMALL_BLOCKS:
        return blocks.withColumn(start, total(W.orderBy(*order_by)))
    ranges = stage(
        blocks.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    inside = ranges.withColumn("_inside", total(W.partitionBy("_range").orderBy(*order_by)))
    totals = ranges.groupBy("_range").agg(F.sum(size).alias(size))
    totals = totals.select("_range", total(W.orderBy("_range")).alias("_base"))
    return (
        inside.join(F.broadcast(totals), "_range")
        .withColumn(start, F.col("_base") + F.col("_inside"))
        .drop("_range", "_base", "_inside")
    )


def sequence_index(
    df: DataFrame,
    order_by: list[str],
    idx: str = "idx",
    explode: Column | None = None,
    value: str = "token_id",
    partitions: int | None = None,
) -> DataFrame:
    """Number rows ``0..N-1`` in the order of ``order_by``, which must be unique and not NULL.

    With ``explode`` every row holds a list: its elements become rows (column
    ``value``, position ``pos``) and are numbered instead. The list is computed
    after the shuffle, so it may be an expensive expression.

    Rows are range-partitioned, so a hot leading key is split like any other
    range; row numbers inside a partition come for free while the partition is
    written, and one count per partition is summed and broadcast: at most
    ``partitions`` rows, by default the session's shuffle partitions.
    """
    count = [partitions] if partitions else []
    rows = df.repartitionByRange(*count, *order_by).sortWithinPartitions(*order_by)
    if explode is not None:
        keep = [c for c in df.columns if c in order_by]
        rows = rows.select(*keep, F.posexplode(explode).alias("pos", value))
    rows = stage(rows.withColumn("_mid", F.monotonically_increasing_id()), "indexed")
    part = F.shiftright("_mid", PARTITION_BIT)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(idx, F.col("_start") + F.col("_mid").bitwiseAND(F.lit(ROW_MASK)))
        .drop("_part", "_start", "_mid")
    )


def index_scanned(df: DataFrame, split_by: list[str], idx: str = "idx") -> DataFrame:
    """Number rows of a file scan in file order, without a shuffle of the rows.

    Rows of one input split are scanned by one task in file order, so a row's
    place in its split is known while the scan is written. Splits are ordered
    by ``split_by`` (path, offset), which is dropped, and only their summary is
    summed. Rows find their split by scan task and row number, in a summary that
    is broadcast; only a summary above BROADCAST_BYTES (some millions of splits)
    is joined by a shuffle, in groups of one task's rows.
    """
    rows = stage(df.withColumn("_mid", F.monotonically_increasing_id()), "scanned")
    splits = stage(
        rows.groupBy(*split_by).agg(F.count("*").alias("_size"), F.min("_mid").alias("_first")),
        "splits",
    )
    starts = running_start(splits, split_by, "_size", "_start").select(
        F.shiftright("_first", PARTITION_BIT).alias("_task"), "_first", "_size", "_start"
    )
    if splits.count() * SUMMARY_ROW_BYTES <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    here = (
        (F.shiftright("_mid", PARTITION_BIT) == F.col("_task"))
        & (F.col("_mid") >= F.col("_first"))
        & (F.col("_mid") < F.col("_first") + F.col("_size"))
    )
    return (
        rows.drop(*split_by)
        .join(starts, here)
        .withColumn(idx, F.col("_start") + F.col("_mid") - F.col("_first"))
        .drop("_mid", "_task", "_first", "_size", "_start")
    )
