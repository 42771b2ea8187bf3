"""Embedding table: one vector per token id, and the lookup of a stream in it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.vectors import zeros
from seqloom.storage import stage

# A table is broadcast only when its counted rows times its row size stay below this.
BROADCAST_BYTES = 256 * 1024 * 1024

# A token is hot when it holds more than 1/HOT_SHARE of an even shuffle partition; so there are
# fewer than HOT_SHARE hot tokens per partition, however long the stream.
HOT_SHARE = 4


def dedupe_last(embeddings: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per ``token_id``: the last one by ``order_by`` (not NULL).

    The aggregate combines on the map side, so copies of one id meet as one row
    per input partition.
    """
    order = F.struct(*order_by)
    return embeddings.groupBy("token_id").agg(F.max_by("vec", order).alias("vec"))


def one_vector_per_id(
    embeddings: DataFrame, dim: int, order_by: list[str] | None = None, unique: bool = False
) -> DataFrame:
    """The table that every plan sees: one row per id, zeros for a missing vector, no NULL id.

    With ``order_by`` the last row of an id wins. Without an order no row of a repeated id can be
    preferred, so one raises; ``unique`` says that the caller has counted none.
    """
    known = embeddings.filter("token_id is not null")
    if order_by:
        known = dedupe_last(known, order_by)
    elif not unique:
        repeated = known.agg(F.count("*") - F.count_distinct("token_id")).first()[0]
        if repeated:
            raise ValueError(f"{repeated} repeated embedding ids and no order to choose by")
    return known.select("token_id", F.coalesce("vec", zeros(dim)).alias("vec"))


def fits_broadcast(
    table: DataFrame, dim: int, copies: int = 1, limit: int = BROADCAST_BYTES
) -> bool:
    """Whether ``copies`` of the table's vectors stay below ``limit``.

    Rows and their real vector lengths are counted, in one job over at most one
    row more than vectors of ``dim`` would allow.
    """
    most = max(limit // _vector_bytes(dim, copies), 0)
    lengths = table.select(F.greatest(F.size("vec"), F.lit(dim)).cast("bigint").alias("_length"))
    found = lengths.limit(most + 1).agg(
        F.count("*").alias("rows"), F.sum("_length").alias("cells")
    ).first()
    if found.rows > most:
        return False
    return found.rows * _vector_bytes(0, copies) + 4 * copies * (found.cells or 0) <= limit


def _vector_bytes(dim: int, copies: int) -> int:
    """Upper estimate for a broadcast row of ``copies`` float vectors."""
    return 64 + copies * (32 + 4 * dim)


def lookup_embedding(
    tokens: DataFrame,
    embeddings: DataFrame,
    dim: int,
    token: str = "token_id",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds ``vec`` (zeros for an unknown token) and ``hit`` to every stream row.

    ``embeddings`` holds one row per ``token_id``. A small table is broadcast.
    With a large one both sides are shuffled. Hot tokens are counted first: their
    rows are dealt to salts by a hash of the row, which a retry repeats, and their
    vectors are copied to each salt. There are fewer copies than HOT_SHARE times
    the partitions, and one for each hot token. No vector of a large table is broadcast.
    """
    table = embeddings.select(F.col("token_id").alias("_token"), "vec")
    if fits_broadcast(table, dim, limit=limit):
        found = _probe(tokens, F.broadcast(table), token)
    else:
        hot = _hot_tokens(tokens, token)
        if hot.isEmpty():
            found = _probe(tokens, table.hint("merge"), token)
        else:
            found = _probe_salted(tokens, table, token, hot)
    return found.withColumn("vec", F.coalesce("vec", zeros(dim)))


def _probe(tokens: DataFrame, table: DataFrame, token: str) -> DataFrame:
    found = tokens.join(table, F.col(token) == F.col("_token"), "left")
    return found.withColumn("hit", F.col("_token").isNotNull()).drop("_token")


def _probe_salted(
    tokens: DataFrame, table: DataFrame, token: str, hot: DataFrame
) -> DataFrame:
    salts = F.coalesce("_salts", F.lit(1))
    place = F.pmod(F.xxhash64(*tokens.columns), salts).cast("int")
    rows = tokens.join(F.broadcast(hot), F.col(token).eqNullSafe(F.col("_hot")), "left")
    rows = rows.withColumn("_salt", place).drop("_hot", "_salts")
    copies = F.explode(F.sequence(F.lit(0), salts - 1)).alias("_copy")
    copied = table.join(F.broadcast(hot), F.col("_token") == F.col("_hot"), "left")
    copied = copied.select("_token", "vec", copies).hint("merge")
    same = (F.col(token) == F.col("_token")) & (F.col("_salt") == F.col("_copy"))
    found = rows.join(copied, same, "left")
    return found.withColumn("hit", F.col("_token").isNotNull()).drop("_token", "_salt", "_copy")


def _hot_tokens(tokens: DataFrame, token: str) -> DataFrame:
    """Hot tokens and how many quarters of an even partition each one fills."""
    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = tokens.groupBy(F.col(token).alias("_hot")).agg(F.count("*").alias("_rows"))
    counts = stage(counts, "counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    shares = F.col("_rows") * (HOT_SHARE * parts)
    salts = F.ceil(shares / max(total, 1)).cast("int").alias("_salts")
    return stage(counts.filter(shares > total).select("_hot", salts), "hot")
