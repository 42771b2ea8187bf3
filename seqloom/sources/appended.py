"""Token streams that grow: added files are numbered from where the stream ended, and no numbered row is read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.sources.published import Version, file_lengths, publish, versions
from seqloom.sources.tokens import scan_token_lists

STREAM = "idx bigint, token_id int"

#: The number that the next row will get, in the details of every part.
NEXT = "next"
_FILE = "file:"


def append_token_lists(spark: SparkSession, source: str, path: str, form: str = "csv") -> Version | None:
    """Number the files of the folder ``source`` that the stream at ``path`` does not hold yet; None if there are none.

    Files of one call are numbered in the order of their paths, after those of all calls before. So a
    stream that is built in parts equals one built at once where each part's files sort behind the
    last. Every part is published with the files it was made of and the next free number. A file that
    has another length than when it was numbered raises, and so does a second job that appends
    meanwhile; either leaves the stream as it was.
    """
    parts = versions(spark, path)
    held = {k.removeprefix(_FILE): n for part in parts for k, n in part.details.items() if k.startswith(_FILE)}
    found = file_lengths(spark, source)
    changed = sorted(name for name, length in found.items() if held.get(name, length) != length)
    if changed:
        raise ValueError(f"{changed[0]} has changed since it was numbered")
    added = {name: length for name, length in found.items() if name not in held}
    if not added:
        return None
    start = parts[-1].details[NEXT] if parts else 0
    rows = scan_token_lists(spark, sorted(added), form)
    return publish(
        rows.select((F.col("idx") + start).alias("idx"), "token_id"),
        path,
        counts={NEXT: F.count(F.lit(1)) + start},
        notes={_FILE + name: length for name, length in added.items()},
        after=parts[-1].number if parts else 0,
    )


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """``(idx, token_id)`` of all parts."""
    parts = versions(spark, path)
    if not parts:
        return spark.createDataFrame([], STREAM)
    return spark.read.schema(STREAM).parquet(*(f"{path}/{part.folder}" for part in parts))
