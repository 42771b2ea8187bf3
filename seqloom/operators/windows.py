"""Look-back windows over ordered streams."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.operators.index import sequence_index
from seqloom.storage import stage

# Rows per block. Small blocks spread even a short stream over all tasks and fit in one array, while
# the halo adds only window/BLOCK_ROWS extra rows.
BLOCK_ROWS = 1024

# Offset functions cost one pass each: beyond this width a window is cut from its block's array.
MAX_OFFSETS = 16

# Most hot keys that are broadcast as a list.
HOT_KEYS = 100_000


def sliding_window(
    tokens: DataFrame,
    size: int,
    idx: str = "idx",
    value: str = "token_id",
    inputs: str = "input_tokens",
    target: str = "target_token",
    within: list[str] | None = None,
    block_rows: int = BLOCK_ROWS,
    attach: Callable[[DataFrame], DataFrame] | None = None,
    only: str | None = None,
) -> DataFrame:
    """One row per full window: the ``size`` values before a row, and the row's own value.

    ``idx`` must number the stream ``0..N-1`` (see :func:`sequence_index`); a
    gap raises. The stream is cut into blocks of consecutive rows, each block
    also receives the last ``size`` rows of the block before it, and blocks are
    shuffled apart, so no task sees the whole stream.

    ``within`` names columns the stream is sorted by; windows that cross a
    change of them are dropped. All other columns are kept.

    ``attach`` adds the value column to rows that have reached their block, by
    a join that does not move them, so that only narrow rows are shuffled.

    ``only`` names a boolean column: rows where it is true get a window and need
    the ``size`` rows before them; the others are context, and the stream may
    have gaps and begin anywhere.
    """
    if size < 1:
        raise ValueError("a window holds at least one row")
    block_rows = max(block_rows, 4 * size)
    own = F.expr(f"{idx} div {block_rows}")
    halo = F.when(
        F.col(idx) % block_rows >= block_rows - size, F.array(own, own + 1)
    ).otherwise(F.array(own))
    # A fixed number of partitions: a window row is many times the size of a stream row, so merging
    # partitions by their shuffled bytes would leave too few tasks.
    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = tokens.withColumn("_block", F.explode(halo)).repartition(parts, "_block")
    if attach is not None:
        rows = attach(rows)
    windows = _by_offsets if size <= MAX_OFFSETS else _by_slices
    keep = [c for c in tokens.columns if c not in (idx, value, only)]
    return windows(rows, size, idx, value, inputs, within or [], block_rows, only).select(
        idx, *keep, inputs, F.col(value).alias(target)
    )


def _gap() -> Column:
    return F.raise_error(F.lit("the stream is not numbered without gaps")).cast("boolean")


def _by_offsets(rows, size, idx, value, inputs, within, block_rows, only):
    spec = W.partitionBy("_block").orderBy(idx)
    first = F.lag(idx, size).over(spec)
    rows = rows.withColumn("_first", first).withColumn(
        inputs, F.array(*[F.lag(value, k).over(spec) for k in range(size, 0, -1)])
    )
    same = [F.lag(key, size).over(spec).eqNullSafe(F.col(key)) for key in within]
    rows = rows.withColumns({f"_same{n}": check for n, check in enumerate(same)})
    # the number under another name: a later condition on it must not be put into the check
    rows = rows.withColumn("_at", F.lag(idx, 0).over(spec))
    wanted = F.col(only) if only else F.col("_at") >= size
    full = (F.expr(f"_at div {block_rows}") == F.col("_block")) & wanted
    whole = F.coalesce(F.col("_first") == F.col("_at") - size, F.lit(False))
    rows = rows.filter(F.when(full, F.when(whole, F.lit(True)).otherwise(_gap())))
    for n, _ in enumerate(same):
        rows = rows.filter(f"_same{n}")
    return rows


def _by_slices(rows, size, idx, value, inputs, within, block_rows, only):
    columns = [c for c in rows.columns if c not in ("_block", idx)]
    blocks = rows.groupBy("_block").agg(
        F.sort_array(F.collect_list(F.struct(idx, *columns))).alias("_rows")
    )
    # One array per column: taken from the block once, not once per window.
    blocks = blocks.select("_block", *[F.col(f"_rows.{c}").alias(c) for c in (idx, *columns)])
    at = F.col("_at")
    if only:
        windows = blocks.select("_block", idx, *columns, F.posexplode(only).alias("_at", "_wanted"))
        here = F.expr(f"{idx}[_at] div {block_rows} = _block")
        windows = windows.filter(F.col("_wanted") & here)
        before = F.get(idx, at - size)
        whole = F.coalesce(before == F.col(idx)[at] - size, F.lit(False))
        windows = windows.filter(F.when(whole, F.lit(True)).otherwise(_gap()))
    else:
        first = F.greatest(F.lit(0), F.col("_block") * block_rows - size)
        whole = F.col(idx) == F.sequence(first, first + F.size(idx) - 1)
        blocks = blocks.filter(F.when(whole, F.size(idx) > size).otherwise(_gap()))
        places = F.sequence(F.lit(size), F.size(idx) - 1)
        windows = blocks.select(idx, *columns, F.explode(places).alias("_at"))
    for key in within:
        windows = windows.filter(F.col(key)[at].eqNullSafe(F.col(key)[at - size]))
    return windows.select(
        F.slice(value, at - size + 1, size).alias(inputs),
        *[F.col(c)[at].alias(c) for c in (idx, *columns)],
    )


def sliding_window_by_key(
    tokens: DataFrame,
    size: int,
    key: str,
    order_by: list[str],
    value: str = "token_id",
    inputs: str = "input_tokens",
    target: str = "target_token",
    hot_rows: int = 2_000_000,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Windows that stop at sequence boundaries; ``order_by`` is unique inside a key.

    Sequences are windowed where their key lands after one shuffle. A sequence
    of more than ``hot_rows`` rows would be one oversized group there, so such
    sequences are numbered as a stream of their own and cut into blocks; so are
    all sequences when windows are wide.
    """
    keep = [key, *order_by]
    tokens = tokens.select(*keep, value)

    def plain(df):
        spec = W.partitionBy(key).orderBy(*order_by)
        before = [F.lag(value, k).over(spec) for k in range(size, 0, -1)]
        rows = df.withColumn(inputs, F.array(*before))
        rows = rows.withColumn("_full", F.lag(F.lit(True), size).over(spec))
        return rows.filter("_full").select(*keep, inputs, F.col(value).alias(target))

    def blocked(df):
        rows = sequence_index(df, keep, idx="_idx")
        rows = sliding_window(
            rows, size, "_idx", value, inputs, target, within=[key], block_rows=block_rows
        )
        return rows.select(*keep, inputs, target)

    if size > MAX_OFFSETS:
        return blocked(tokens)
    sizes = tokens.groupBy(key).agg(F.count("*").alias("_size"))
    hot = stage(sizes.filter(F.col("_size") > hot_rows).select(F.col(key).alias("_hot")), "hot")
    n_hot = hot.count()
    if n_hot == 0:
        return plain(tokens)
    if n_hot > HOT_KEYS:
        return blocked(tokens)
    same = F.col(key).eqNullSafe(F.col("_hot"))
    cold_rows = tokens.join(F.broadcast(hot), same, "left_anti")
    hot_rows_only = tokens.join(F.broadcast(hot), same, "left_semi")
    return plain(cold_rows).unionByName(blocked(hot_rows_only))


def stream_of_windows(windows: DataFrame, size: int) -> DataFrame:
    """``(idx, token_id, full)``: the stream that stored windows were cut from.

    The target of window ``i`` is token ``i``, so only the first window of each run of consecutive ids
    has to give its inputs, too: rows that are not ``full`` and have no window of their own. Windows of
    one run, the usual case, are told by their number and two ends, and nothing is shuffled; with gaps,
    the ids alone are, to find the runs.
    """
    inner = windows.select(F.col("example_id").alias("idx"), F.col("target_token").alias("token_id"), F.lit(True).alias("full"))
    low, high, count = windows.agg(F.min("example_id"), F.max("example_id"), F.count("*")).first()
    if not count:
        return inner
    if high - low + 1 == count:
        firsts = windows.filter(F.col("example_id") == low)
    else:
        after = windows.select((F.col("example_id") + 1).alias("example_id"))
        firsts = windows.join(after, "example_id", "left_anti")
    heads = firsts.select("example_id", F.posexplode("input_tokens").alias("_place", "token_id"))
    heads = heads.select((F.col("example_id") - size + F.col("_place")).alias("idx"), "token_id", F.lit(False).alias("full"))
    rows = inner.unionByName(heads)
    if high - low + 1 == count:
        return rows
    # inputs of one run may be windows of the run before
    return rows.groupBy("idx").agg(F.max("token_id").alias("token_id"), F.bool_or("full").alias("full"))


def window_rows(windows: DataFrame, idx: str = "idx") -> DataFrame:
    """The compact stored form of windows."""
    return windows.select(F.col(idx).alias("example_id"), "input_tokens", "target_token")
