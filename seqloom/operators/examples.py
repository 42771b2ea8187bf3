"""Training examples: input matrix and target vector of each window."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.vectors import ANGLE_BASE, keep_compiled, position_code, step_targets, vector_add, zeros
from seqloom.operators.lookup import (
    BROADCAST_BYTES,
    fits_broadcast,
    lookup_embedding,
    one_vector_per_id,
)
from seqloom.operators.windows import BLOCK_ROWS, sliding_window, stream_of_windows, window_rows

# One broadcast join per window position up to this width; beyond it vectors travel with the rows.
MAX_JOINS = 16


def target_vectors(tokens: DataFrame, embeddings: DataFrame, dim: int, **options) -> DataFrame:
    """The raw vector of each row's own token; zeros where it is unknown."""
    found = lookup_embedding(tokens, embeddings, dim, **options)
    return found.withColumnRenamed("vec", "y")


def input_matrix(vectors: Column, size: int, dim: int) -> Column:
    """``[size, dim]`` matrix: each window vector plus the encoding of its place."""
    codes = F.array(*[position_code(p, dim) for p in range(size)])
    return F.zip_with(vectors, codes, lambda vec, code: vector_add(vec, code, dim))


def _with_codes(examples: DataFrame, size: int, dim: int) -> DataFrame:
    """:func:`input_matrix` of column ``x``, a batch at a time: a lambda is interpreted for each cell of each example.

    What tasks run is a closure over numpy and Arrow alone, so that nothing has to be shipped to them.
    """
    angles = [[p / ANGLE_BASE ** (2 * (i // 2) / dim) for i in range(dim)] for p in range(size)]
    codes = [[math.cos(a) if i % 2 else math.sin(a) for i, a in enumerate(row)] for row in angles]
    codes = np.array(codes, dtype=np.float32).reshape(1, size, dim)

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            n, at = batch.num_rows, batch.schema.get_field_index("x")
            rows = batch.column(at).flatten()
            lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
            cells, bad = rows.flatten(), lengths != dim
            if bad.any():
                starts = np.cumsum(lengths, dtype=np.int64) - lengths
                take = (starts[:, None] + np.arange(dim)).ravel()
                cells = cells.take(pa.array(take, mask=np.repeat(bad, dim)))
            if cells.null_count or bad.any():
                sums = pc.add(cells, pa.array(np.repeat(codes, n, axis=0).ravel()))
                sums = pc.if_else(pa.array(np.repeat(bad, dim)), pa.scalar(0.0, pa.float32()), sums)
            else:
                sums = pa.array((cells.to_numpy().reshape(n, size, dim) + codes).ravel())
            inner = pa.ListArray.from_arrays(pa.array(np.arange(0, n * size * dim + 1, dim, dtype=np.int32)), sums)
            outer = pa.ListArray.from_arrays(pa.array(np.arange(0, n * size + 1, size, dtype=np.int32)), inner)
            columns = [outer if k == at else batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in examples.schema)
    return examples.mapInArrow(run, kinds)


def keep_complete(
    examples: DataFrame, size: int, dim: int | None = None, step_targets: bool = False
) -> DataFrame:
    """Drop examples with a missing side or a matrix of the wrong height; of either side with ``step_targets``."""
    whole = F.col("x").isNotNull() & F.col("y").isNotNull() & (F.size("x") == size)
    if step_targets:
        whole = whole & (F.size("y") == size)
    if dim is not None:
        target = F.forall("y", lambda row: F.size(row) == dim) if step_targets else F.size("y") == dim
        whole = whole & target & F.forall("x", lambda row: F.size(row) == dim)
    return examples.filter(whole)


def embed_windows(
    windows: DataFrame,
    embeddings: DataFrame,
    size: int,
    dim: int,
    limit: int = BROADCAST_BYTES,
    order_by: list[str] | None = None,
    step_targets: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(example_id, x, y)`` from stored windows.

    The table is made one row per id first (see :func:`one_vector_per_id`), so
    every plan below gives the same examples.

    Vector plus encoding depends only on (token, place), so it is computed once
    per embedding row and place instead of once per example: with a broadcast
    table every window place is one map-side probe and the windows never move.
    A larger table meets the stream that the windows were cut from: a token is
    looked up once, not once for each window that holds it, and vectors move once.
    """
    embeddings = one_vector_per_id(embeddings, dim, order_by)
    if size <= MAX_JOINS and fits_broadcast(embeddings, dim, size + 1, limit):
        return _probe_windows(windows, embeddings, size, dim, step_targets)
    stream = stream_of_windows(windows, size)
    found = lookup_embedding(stream, embeddings, dim, limit=limit).select("idx", "vec", "full")
    return _cut_vectors(found, size, dim, "idx", step_targets, block_rows, only="full")


def _cut_vectors(
    rows: DataFrame, size: int, dim: int, idx: str, by_step: bool, block_rows: int, **options
) -> DataFrame:
    """Examples from a stream of vectors."""
    keep_compiled(rows.sparkSession)
    rows = sliding_window(
        rows, size, idx, value="vec", inputs="_vectors", target="_y", block_rows=block_rows, **options
    )
    y = step_targets(F.col("_vectors"), F.col("_y")) if by_step else F.col("_y")
    rows = rows.select(F.col(idx).alias("example_id"), F.col("_vectors").alias("x"), y.alias("y"))
    return _with_codes(rows, size, dim)


def _probe_windows(
    windows: DataFrame, embeddings: DataFrame, size: int, dim: int, by_step: bool = False
) -> DataFrame:
    rows = windows
    matrix, plain = [], []
    for p in range(size):
        code = position_code(p, dim)
        coded = vector_add(F.col("vec"), code, dim).alias(f"_v{p}")
        # the vector itself is the target of the step before
        own = [F.col("vec").alias(f"_r{p}")] if by_step and p else []
        table = embeddings.select(F.col("token_id").alias(f"_t{p}"), coded, *own)
        rows = rows.join(
            F.broadcast(table), F.col("input_tokens")[p] == F.col(f"_t{p}"), "left"
        ).drop(f"_t{p}")
        matrix.append(F.coalesce(f"_v{p}", code))
        plain += [F.coalesce(f"_r{p}", zeros(dim)) for _ in own]
    table = embeddings.select(F.col("token_id").alias("_t"), F.col("vec").alias("_y"))
    rows = rows.join(F.broadcast(table), F.col("target_token") == F.col("_t"), "left")
    y = F.coalesce("_y", zeros(dim))
    return rows.select(
        "example_id", F.array(*matrix).alias("x"), (F.array(*plain, y) if by_step else y).alias("y")
    )


def _probe_in_blocks(embeddings: DataFrame, dim: int):
    table = embeddings.select(F.col("token_id").alias("_token"), "vec")

    def attach(rows: DataFrame) -> DataFrame:
        found = rows.join(F.broadcast(table), F.col("token_id") == F.col("_token"), "left")
        return found.withColumn("vec", F.coalesce("vec", zeros(dim))).drop("_token")

    return attach


def training_examples(
    tokens: DataFrame,
    embeddings: DataFrame,
    size: int,
    dim: int,
    idx: str = "idx",
    limit: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
    order_by: list[str] | None = None,
    unique: bool = False,
    step_targets: bool = False,
) -> DataFrame:
    """``(example_id, x, y)`` from a numbered token stream.

    ``y`` is the vector of the window's own token; with ``step_targets`` it is a
    matrix that holds for each step the vector of the token that follows it.

    The table is made one row per id first (see :func:`one_vector_per_id`), so
    every plan below gives the same examples. With a broadcast table only ids
    are shuffled: narrow windows probe it for each place, wide ones once per row
    that has reached its block. Otherwise each token's vector is looked up once
    and windows are built over vectors.
    """
    embeddings = one_vector_per_id(embeddings, dim, order_by, unique)
    rows = tokens.select(idx, "token_id")
    if size <= MAX_JOINS and fits_broadcast(embeddings, dim, size + 1, limit):
        windows = window_rows(sliding_window(rows, size, idx, block_rows=block_rows), idx)
        return _probe_windows(windows, embeddings, size, dim, step_targets)
    attach = None
    if fits_broadcast(embeddings, dim, limit=limit):
        attach = _probe_in_blocks(embeddings, dim)
    else:
        rows = lookup_embedding(rows, embeddings, dim, limit=limit).select(idx, "vec")
    return _cut_vectors(rows, size, dim, idx, step_targets, block_rows, attach=attach)
