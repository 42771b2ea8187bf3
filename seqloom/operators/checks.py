"""Input checks: one aggregation over each input."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.text import is_bad_id_list


def check_embeddings(embeddings: DataFrame, dim: int) -> DataFrame:
    """Rows, unusable ids, repeated ids and vectors of another length, as one row."""
    ids = F.count("token_id")
    return embeddings.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("token_id").isNull()).alias("null_ids"),
        (ids - F.count_distinct("token_id")).alias("repeated_ids"),
        F.count_if(F.coalesce(F.size("vec") != dim, F.lit(True))).alias("wrong_length"),
    )


def check_tokens(tokens: DataFrame, token: str = "token_id") -> DataFrame:
    return tokens.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(token).isNull()).alias("null_ids"),
        F.count_distinct(token).alias("distinct_ids"),
    )


def check_lists(lines: DataFrame, text: str = "tokens") -> DataFrame:
    return lines.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(text).isNull()).alias("null_lists"),
        F.count_if(is_bad_id_list(F.col(text))).alias("bad_lists"),
    )


def require_rows(check: DataFrame, what: str) -> dict:
    """The check as a dict; raises when the input is empty."""
    counts = check.first().asDict()
    if counts["n_rows"] == 0:
        raise ValueError(f"no {what} to work on")
    return counts


def require_vectors(check: DataFrame) -> dict:
    """The strict form: a vector of another length is an error instead of a zero row."""
    counts = require_rows(check, "embeddings")
    if counts["wrong_length"]:
        raise ValueError(f"{counts['wrong_length']} vectors have another length")
    return counts
