"""Helpers of the corpus operators: shared reads, connected components, local forests."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.storage import stage

#: Rows of a table that may be broadcast without a look at their bytes; only keys and counts travel so.
SMALL_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(df: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``, chosen by a hash of the whole row.

    Rows are counted first and all but about twice as many as wanted are left where they are, so what
    meets in one task does not grow with the table.
    """
    place = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30))
    share = min(1.0, 2 * rows / max(df.count(), 1))
    near = df.where(place < F.lit(int(share * (1 << 30)) + 1))
    return near.orderBy(place, *df.columns).limit(rows)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, component) per node.

    ``component`` is the smallest node reachable. Edges with a null end and loops are left out; no
    edges give no rows. Large stars and small stars alternate: every node sends its neighbours to the
    smallest of them. Each round is written to the shared folder, so no round is ever computed twice.
    A hub's rows are only summed (minimum) or meet one row in a join, which adaptive execution splits.
    """
    known = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    now = stage(
        known.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{name}-links",
    )
    mark = _mark(now)
    while mark[0]:
        now = stage(_small_star(_large_star(now)), f"{name}-stars")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def roots_of(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest position reachable from each of ``n`` positions by the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
