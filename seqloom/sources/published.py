"""Tables that a failed overwrite cannot harm: a folder per version, named by a manifest that is written last.

``path/versions/<id>`` holds the rows of one version, ``path/manifest/<number>.json`` names it. A
manifest appears whole or not at all, by a rename; until then readers see the version before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version bigint, folder string, rows bigint, details map<string,bigint>"

#: A name that a writer may lose to another writer so often before it gives up.
TRIES = 20


class Version(NamedTuple):
    """One published state of a table; ``details`` holds what the writer counted besides the rows."""

    number: int
    folder: str
    rows: int
    details: dict[str, int]


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def write_small_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``text`` to a new file ``path`` that appears whole; False if there is one already."""
    fs, target = _file_system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/_{uuid.uuid4().hex}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    # a local rename would replace a file of that name
    if not fs.exists(target) and fs.rename(part, target):
        return True
    fs.delete(part, False)
    return False


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return bool(fs.exists(target))


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def file_lengths(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and bytes of the data files in a folder, without those that readers skip."""
    fs, folder = _file_system(spark, path)
    statuses = [s for s in fs.listStatus(folder) if s.isFile()]
    return {str(s.getPath().toString()): s.getLen() for s in statuses if s.getPath().getName()[0] not in "_."}


def _manifests(spark: SparkSession, path: str) -> list[Version]:
    if not exists(spark, f"{path}/manifest"):
        return []
    rows = spark.read.schema(MANIFEST).json(f"{path}/manifest").collect()
    return sorted(Version(r.version, r.folder, r.rows, r.details or {}) for r in rows)


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The published versions by rising number; a table that was never published has none."""
    return _manifests(spark, path)


def publish(
    rows: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    counts: dict | None = None,
    check: Callable[[int], None] | None = None,
    notes: dict[str, int] | None = None,
    after: int | None = None,
) -> Version:
    """Write ``rows`` as the next version of the table at ``path`` and make it the one that is read.

    Rows are counted while they are written. ``counts`` names more aggregates to take on the way
    (no distinct ones). ``check`` gets the number of rows written and may raise; then, too, nothing is
    published. A writer that fails leaves a folder that no manifest names; ``drop_versions`` removes it. Of two writers at
    a time, both versions are kept and the last to finish is read; one that says ``after`` which
    version it was made raises if another has come since. ``notes`` are kept with the counts.
    """
    spark = rows.sparkSession
    folder = f"versions/{uuid.uuid4().hex}"
    seen = Observation()
    more = [column.cast("bigint").alias(name) for name, column in (counts or {}).items()]
    observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *more)
    # overlapping windows repeat the same vectors a few hundred rows apart, which only a codec with a wide window sees
    observed.write.partitionBy(*partition_by).parquet(f"{path}/{folder}", compression="zstd")
    found = {k: int(v or 0) for k, v in seen.get.items()}
    total = found.pop("rows")
    if check:
        check(total)
    found |= notes or {}
    for _ in range(TRIES):
        number = max((v.number for v in _manifests(spark, path)), default=0) + 1
        if after is not None and number != after + 1:
            raise RuntimeError(f"another writer has published {path} meanwhile")
        entry = {"version": number, "folder": folder, "rows": total, "details": found}
        if write_small_file(spark, f"{path}/manifest/{number:012d}.json", json.dumps(entry)):
            return Version(number, folder, total, found)
    raise RuntimeError(f"{TRIES} other writers published {path} first")


def read_published(spark: SparkSession, path: str, schema: str | None = None, version: int | None = None) -> DataFrame:
    """The rows of the last version, or of a given one.

    A folder that was never written by ``publish`` is read as it is; one whose first version is not complete raises.
    """
    known = _manifests(spark, path)
    if not known and exists(spark, f"{path}/versions"):
        raise ValueError(f"{path} has no published version")
    if version is not None:
        known = [v for v in known if v.number == version]
        if not known:
            raise ValueError(f"{path} has no version {version}")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{path}/{known[-1].folder}" if known else path)


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` versions and what failed writers left. Call it when no writer is at work.

    A manifest goes before its folder, so no reader is sent to a folder that is gone.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    known = _manifests(spark, path)
    fs, top = _file_system(spark, f"{path}/versions")
    old, kept = known[:-keep], {v.folder.split("/")[-1] for v in known[-keep:]}
    for v in old:
        remove(spark, f"{path}/manifest/{v.number:012d}.json")
    gone = 0
    if fs.exists(top):
        for status in fs.listStatus(top):
            if status.getPath().getName() not in kept:
                gone += int(fs.delete(status.getPath(), True))
    return gone
