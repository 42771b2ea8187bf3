"""Staged tables in the shared folder of the session.

A staged table cuts lineage: its rows are written once and read back, so a lost
executor costs a task retry, never a second evaluation that could order or
sample its input differently.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH_KEY = "spark.checkpoint.dir"


# Temporary folders of local applications that named none; they go when Python ends.
_local_roots: dict[str, tempfile.TemporaryDirectory] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session.

    Only a local session that names none gets a temporary folder; a cluster
    session must name one that every executor can reach.
    """
    context = spark.sparkContext
    root = spark.conf.get(SCRATCH_KEY, None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SCRATCH_KEY} to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.TemporaryDirectory(prefix="seqloom-", ignore_cleanup_errors=True)
    return _local_roots[app].name


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for this application in the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/seqloom/{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as parquet and return the stored table."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application staged. Call it when no staged result is needed any more."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{scratch_root(spark)}/seqloom/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
