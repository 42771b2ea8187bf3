"""Scans that keep what they reject: one pass over the input splits its rows from a table of those left out, and why."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.functions.text import is_bad_id_list, parse_id_list
from seqloom.functions.vectors import pack_vector, vector_columns
from seqloom.operators.examples import keep_complete
from seqloom.operators.index import sequence_index
from seqloom.operators.lookup import dedupe_last
from seqloom.sources.tokens import read_token_lines
from seqloom.storage import stage

RAW = "_raw"


class Split(NamedTuple):
    """What a scan keeps, and (path, start, row, raw, reason) for each row that it does not.

    ``path`` and ``start`` name the piece of the file that one task scans, ``row`` counts its data rows from 0.
    """

    kept: DataFrame
    rejected: DataFrame


def _split(tagged: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept rows, rejected rows and (path, start, _first), the first line of every scanned piece.

    Rows are stored once, those with a ``reason`` in a folder of their own, so that neither side reads
    the other. ``path``, ``start`` and ``line``, a number that rises within a task, say where a row comes from.
    """
    rejected = F.col("reason").isNotNull().alias("_rejected")
    rows = stage(tagged.select("*", rejected), name, partition_by=("_rejected",))
    firsts = rows.groupBy("path", "start").agg(F.min("line").alias("_first"))
    kept = rows.filter("not _rejected").drop("_rejected", "reason", RAW)
    left = rows.filter("_rejected").select("path", "start", "line", F.col(RAW).alias("raw"), "reason")
    return kept, _placed(left, firsts), firsts


def _placed(left: DataFrame, firsts: DataFrame) -> DataFrame:
    row = (F.col("line") - F.col("_first")).alias("row")
    return left.join(firsts, ["path", "start"]).select("path", "start", row, "raw", "reason")


def scan_embeddings_csv(spark: SparkSession, path: str, dim: int) -> Split:
    """:func:`seqloom.sources.embeddings.scan_embeddings_csv`, and the rows it leaves out.

    Rejected are rows without a readable id, with the raw line where the reader has found it malformed,
    and rows that a later one of the same id replaces (reason ``replaced``, raw is the id).
    """
    fields = [T.StructField("tokenId", T.IntegerType())]
    fields += [T.StructField(f"embedding{k}", T.DoubleType()) for k in range(1, dim + 1)]
    schema = T.StructType([*fields, T.StructField(RAW, T.StringType())])
    wide = spark.read.schema(schema).csv(path, header=True, columnNameOfCorruptRecord=RAW)
    reason = F.when(F.col("tokenId").isNull(), F.when(F.col(RAW).isNull(), "no id").otherwise("unreadable id"))
    rows = wide.select(
        F.col("tokenId").alias("token_id"),
        pack_vector(*vector_columns(wide)).alias("vec"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        RAW,
        reason.alias("reason"),
    )
    kept, rejected, firsts = _split(rows, "embedding-rows")
    order = ["path", "start", "line"]
    places = kept.select("token_id", *order)
    last = places.groupBy("token_id").agg(F.max(F.struct(*order)).alias("_last"), F.count("*").alias("_rows"))
    # only ids that repeat have rows to report
    again = places.join(last.filter("_rows > 1"), "token_id").filter(F.struct(*order) < F.col("_last"))
    raw, why = F.col("token_id").cast("string").alias("raw"), F.lit("replaced").alias("reason")
    replaced = _placed(again.select(*order, raw, why), firsts)
    return Split(dedupe_last(kept, order), rejected.unionByName(replaced))


def scan_token_lists(spark: SparkSession, path: str, form: str = "csv") -> Split:
    """:func:`seqloom.sources.tokens.scan_token_lists`, and the lines that give no ids although they hold or lack text."""
    lines = read_token_lines(spark, path, form).withColumn("line", F.monotonically_increasing_id())
    text = F.col("tokens")
    reason = F.when(text.isNull(), "no list").when(is_bad_id_list(text), "unreadable list")
    kept, rejected, _ = _split(lines.select("*", text.alias(RAW), reason.alias("reason")), "token-lines")
    ids = kept.select("path", "start", "line", F.posexplode(parse_id_list(F.col("tokens"))).alias("pos", "token_id"))
    return Split(_in_file_order(ids), rejected)


def _in_file_order(ids: DataFrame) -> DataFrame:
    """A stored table may be scanned in other pieces than the files were, so lines are put in order by where they came from."""
    rows = sequence_index(ids, ["path", "start", "line", "pos"])
    return rows.select("idx", "token_id")


def why_incomplete(size: int, dim: int) -> Column:
    """Why :func:`seqloom.operators.examples.keep_complete` leaves an example out; null for one it keeps."""
    return (
        F.when(F.col("x").isNull(), "no input")
        .when(F.col("y").isNull(), "no target")
        .when(F.size("x") != size, "input of another height")
        .when(F.size("y") != dim, "target of another length")
        .when(F.exists("x", lambda row: F.size(row) != dim), "input row of another length")
    )


def split_examples(examples: DataFrame, size: int, dim: int) -> tuple[DataFrame, DataFrame]:
    """Complete examples, and (example_id, reason) of the others; examples are made once."""
    tagged = examples.select("*", why_incomplete(size, dim).alias("reason"))
    rejected = F.col("reason").isNotNull().alias("_rejected")
    rows = stage(tagged.select("*", rejected), "split-examples", partition_by=("_rejected",))
    kept = rows.filter("not _rejected").drop("_rejected", "reason")
    return keep_complete(kept, size, dim), rows.filter("_rejected").select("example_id", "reason")
