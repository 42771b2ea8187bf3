"""Token streams."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.text import parse_id_list
from seqloom.operators.index import index_scanned

# A noncharacter that no text file carries: used as separator it leaves the line whole.
NO_SEPARATOR = "￿"


def read_token_lines(spark: SparkSession, path: str, form: str = "csv") -> DataFrame:
    """Headered one-column file of lists like ``[1, 2, 3]`` as ``(tokens, path, start)``.

    ``csv`` reads a quoted list; an unquoted one is cut at its first comma.
    ``text`` takes the whole line.
    """
    reader = spark.read.schema("tokens string")
    if form == "csv":
        lines = reader.csv(path, header=True)
    elif form == "text":
        lines = reader.csv(path, header=True, sep=NO_SEPARATOR, quote="", escape="")
    else:
        raise ValueError(f"unknown token file form {form!r}")
    return lines.select(
        "tokens",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def scan_token_lists(spark: SparkSession, path: str, form: str = "csv") -> DataFrame:
    """``(idx, token_id)``: all ids of all lines as one stream in file order."""
    lines = read_token_lines(spark, path, form)
    ids = lines.select("path", "start", F.explode(parse_id_list(F.col("tokens"))).alias("token_id"))
    return index_scanned(ids, ["path", "start"]).select("idx", "token_id")


def token_table(table: DataFrame, idx: str, token: str) -> DataFrame:
    """``(idx, token_id)`` from a stored table whose order column runs ``0..N-1``."""
    return table.select(F.col(idx).alias("idx"), F.col(token).cast("int").alias("token_id"))
