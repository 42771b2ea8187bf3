"""Embedding tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.functions.vectors import pack_vector, vector_columns
from seqloom.operators.lookup import dedupe_last


def read_wide_embeddings(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """Headered CSV ``tokenId, embedding1..embeddingN`` as ``(token_id, vec)`` with file order.

    Columns bind by place under a declared schema. A missing or unreadable
    element is 0. A row without a readable id keeps a NULL ``token_id``.
    """
    fields = [T.StructField("tokenId", T.IntegerType())]
    fields += [T.StructField(f"embedding{k}", T.DoubleType()) for k in range(1, dim + 1)]
    wide = spark.read.schema(T.StructType(fields)).csv(path, header=True)
    return wide.select(
        F.col("tokenId").alias("token_id"),
        pack_vector(*vector_columns(wide)).alias("vec"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )


def drop_bad_rows(embeddings: DataFrame) -> DataFrame:
    return embeddings.filter(F.col("token_id").isNotNull())


def scan_embeddings_csv(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """The embedding table of a CSV: one vector per id, the last row of an id wins."""
    rows = drop_bad_rows(read_wide_embeddings(spark, path, dim))
    return dedupe_last(rows, ["path", "start", "line"])


def embedding_table(table: DataFrame, key: str, vec: str) -> DataFrame:
    """``(token_id, vec)`` from a stored table that holds one row per key."""
    return table.select(
        F.col(key).cast("int").alias("token_id"), F.col(vec).cast("array<float>").alias("vec")
    ).filter("token_id is not null")
