"""Near-duplicate vectors: int8 tile products with error bounds, doubles only for pairs in doubt."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import components, roots_of
from seqloom.storage import stage

THRESHOLD = 0.9
#: Vectors of a block. Two blocks of doubles meet in one task.
BLOCK = 2048
#: Vectors of a tile, the unit of one int8 product.
TILE = 1024
#: Products of int8 codes stay whole numbers in float32 sums over so many dimensions.
EXACT_DIMS = 1024
#: Covers the rounding of the bound itself.
SLACK = 1e-9


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, lengths of the decoded vectors and lengths of what quantising lost, by row."""
    scales = np.abs(units).max(axis=1) / 127
    codes = np.rint(units / scales[:, None])
    decoded = codes * scales[:, None]
    lost = np.linalg.norm(units - decoded, axis=1)
    return codes.astype(np.int8), scales, np.linalg.norm(decoded, axis=1), lost


def tile_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number products of int8 rows. float32 sums of EXACT_DIMS products stay below 2^24."""
    total = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], EXACT_DIMS):
        total += a[:, k : k + EXACT_DIMS].astype(np.float32) @ b[:, k : k + EXACT_DIMS].astype(np.float32).T
    return total


def links_of(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of rows of ``x`` and ``y`` with cosine >= ``threshold``; i < j if they are the same.

    With u = s q + e for each unit vector (scale s, codes q, error e), u.v differs from the product
    of the codes by at most |s q| |f| + |e|, as |v| = 1. Pairs whose product plus this bound reaches
    the threshold are computed again in doubles; no other pair can reach it.
    """
    lengths = [np.linalg.norm(m / (big := np.abs(m).max(axis=1))[:, None], axis=1) * big for m in (x, y)]
    units = [m / n[:, None] for m, n in zip((x, y), lengths, strict=True)]
    (qx, sx, rx, ex), (qy, sy, _, ey) = (quantise(u) for u in units)
    near = tile_product(qx, qy) * sx[:, None] * sy[None, :]
    maybe = near + rx[:, None] * ey[None, :] + ex[:, None] + SLACK >= threshold
    if same:
        maybe &= np.arange(len(x))[:, None] < np.arange(len(y))[None, :]
    i, j = np.nonzero(maybe)
    if len(i) > maybe.size // 16:
        sure = (units[0] @ units[1].T)[i, j] >= threshold
    else:
        sure = np.zeros(len(i), bool)
        for k in range(0, len(i), 1 << 16):
            part = slice(k, k + (1 << 16))
            sure[part] = np.einsum("nd,nd->n", units[0][i[part]], units[1][j[part]]) >= threshold
    return i[sure], j[sure]


def _compare(threshold: float, tile: int):
    def run(group: pa.Table) -> pa.Table:
        one = group.combine_chunks()
        ids, copies, blocks = (one[c].to_numpy() for c in ("id", "copies", "block"))
        dims = int(one["dims"][0].as_py())
        whole = one["vec"].combine_chunks()
        vectors = whole.flatten().to_numpy().reshape(-1, dims)
        first, second = one["first"][0].as_py(), one["second"][0].as_py()
        sides = [np.flatnonzero(blocks == b) for b in (first, second)]
        links, a, b = np.zeros(len(ids), np.int64), [], []
        for p in range(0, len(sides[0]), tile):
            for q in range(p if first == second else 0, len(sides[1]), tile):
                left, right = sides[0][p : p + tile], sides[1][q : q + tile]
                i, j = links_of(vectors[left], vectors[right], threshold, first == second and p == q)
                if not len(i):
                    continue
                i, j = left[i], right[j]
                links += np.bincount(i, weights=copies[j], minlength=len(ids)).astype(np.int64)
                links += np.bincount(j, weights=copies[i], minlength=len(ids)).astype(np.int64)
                # of a tile's links, only a spanning forest is kept
                root = roots_of(i, j, len(ids))
                own = np.flatnonzero(root != np.arange(len(ids)))
                a.append(own)
                b.append(root[own])
        some = np.flatnonzero(links)
        root = roots_of(np.concatenate(a), np.concatenate(b), len(ids)) if a else np.arange(len(ids))
        return pa.table({"id": ids[some], "links": links[some], "root": ids[root[some]]})

    return run


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, block: int = BLOCK, tile: int = TILE
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``rows``.

    Rows link at a cosine of ``threshold`` or more in double precision. Equal vectors are compared
    once and count as links of each other. Null, empty or zero vectors, vectors with a null or
    non-finite part, and vectors of different lengths link with nothing. ``component_id`` is the
    smallest id reachable; a null id never names a component of others. Repeated rows are returned
    each time. Other columns are not read.

    Distinct vectors are dealt to blocks by hash and every pair of blocks is one group, so tasks get
    equal shares whatever the labels or copies are. A group returns at most one row per vector.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    source = rows.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    # a sum of squares is not tested: it may overflow where the parts are finite
    usable = F.expr("vec is not null and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(vec, x -> x <> 0)")
    classes = (
        source.where(usable)
        .groupBy("vec")
        .agg(F.count("*").alias("copies"), F.min("id").alias("least"))
        .withColumn("class", F.monotonically_increasing_id())
    )
    classes = stage(classes, "vector-classes")
    sizes = {r.dims: -(-r.n // block) for r in classes.groupBy(F.size("vec").alias("dims")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return source.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    blocks = F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair))
    dealt = (
        classes.select(F.col("class").alias("id"), "copies", "vec", F.size("vec").alias("dims"))
        .withColumn("blocks", blocks[F.col("dims")])
        .withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("block", "other"))
        .withColumn("second", F.greatest("block", "other"))
        .drop("blocks", "other")
    )
    found = dealt.groupBy("dims", "first", "second").applyInArrow(_compare(threshold, tile), "id bigint, links bigint, root bigint")
    found = stage(found, "vector-links")
    counts = found.groupBy(F.col("id").alias("class")).agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "vectors")
    linked = classes.select("class", "least").join(groups.withColumnRenamed("node", "class"), "class")
    named = linked.groupBy("component").agg(F.min("least").alias("name"))
    names = linked.join(named, "component").select("class", "name")
    facts = classes.join(counts, "class", "left").join(names, "class", "left").select(
        "vec",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("name", "least").alias("component_id"),
    )
    result = source.join(facts, "vec", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return result.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
