"""Reproducible training/validation split."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.text import hash_bucket


def split_label(key: Column, train_percent: int = 80, salt: str = "split") -> Column:
    """``train`` or ``valid`` from a hash of the key: the same at any partitioning."""
    bucket = hash_bucket(F.concat_ws(":", F.lit(salt), key.cast("string")), 100)
    return F.when(bucket < train_percent, "train").otherwise("valid")


def train_valid_split(
    examples: DataFrame, key: str = "example_id", train_percent: int = 80, salt: str = "split"
) -> DataFrame:
    return examples.withColumn("split", split_label(F.col(key), train_percent, salt))
