"""Lookups in an embedding table that is stored in buckets of its id and so does not move."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.vectors import zeros
from seqloom.operators.lookup import _hot_tokens, _probe, _probe_salted, one_vector_per_id


def store_bucketed(
    embeddings: DataFrame, name: str, dim: int, buckets: int, path: str, order_by: list[str] | None = None
) -> DataFrame:
    """Write one row per id (see :func:`one_vector_per_id`) as the catalog table ``name``: a sorted file for each bucket.

    A good number of buckets is that of the shuffle partitions of the jobs that will join the table: with
    fewer, Spark may prefer to shuffle both sides. A table of that name is replaced.
    """
    rows = one_vector_per_id(embeddings, dim, order_by).repartition(buckets, "token_id")
    writer = rows.write.bucketBy(buckets, "token_id").sortBy("token_id").mode("overwrite")
    writer.option("path", path).saveAsTable(name)
    return embeddings.sparkSession.table(name)


def lookup_bucketed(tokens: DataFrame, name: str, dim: int, token: str = "token_id") -> DataFrame:
    """:func:`seqloom.operators.lookup.lookup_embedding` in a table of :func:`store_bucketed`.

    Only the stream is shuffled, to the table's buckets. The rows of hot tokens would meet in one
    bucket; they go apart, dealt to salts, and of the table only the hot rows are copied to them.
    """
    spark: SparkSession = tokens.sparkSession
    table = spark.table(name).select(F.col("token_id").alias("_token"), "vec")
    hot = _hot_tokens(tokens, token)
    if hot.isEmpty():
        found = _probe(tokens, table.hint("merge"), token)
    else:
        same = F.col(token).eqNullSafe(F.col("_hot"))
        # there are fewer hot tokens than HOT_SHARE for each partition
        cold_rows = tokens.join(F.broadcast(hot), same, "left_anti")
        hot_rows = tokens.join(F.broadcast(hot), same, "left_semi")
        few = table.join(F.broadcast(hot), F.col("_token") == F.col("_hot"), "left_semi")
        found = _probe(cold_rows, table.hint("merge"), token)
        found = found.unionByName(_probe_salted(hot_rows, few, token, hot))
    return found.withColumn("vec", F.coalesce("vec", zeros(dim)))
