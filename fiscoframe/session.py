"""Session settings that the plans rely on.

Nothing here is required on a cluster that already sets these values; the
builder only exists so that tests, the bench and ad-hoc scripts agree.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fiscoframe")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Stored bytes of input for each partition that a shuffle starts with: small enough that what a task sorts or groups stays
#: in its memory, as rows of item jobs take up to 25 times their stored size there, and several steps hold them at a time.
PARTITION_BYTES = 8 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def sized(spark: SparkSession, *paths: str) -> int:
    """Let shuffles of this session start with partitions for the size of the given tables; their number.

    With a fixed number, tasks grow with the input until they spill.  Adaptive execution merges what turns out to be
    small.  Never fewer than the session names; small tables leave it as it is.
    """
    named = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = max(named, -(-sum(folder_bytes(spark, path) for path in paths) // PARTITION_BYTES))
    if number > named:
        spark.conf.set(_INITIAL, str(number))
    else:
        spark.conf.unset(_INITIAL)
    return number


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions that a shuffle of this session starts with."""
    adaptive = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
    initial = spark.conf.get(_INITIAL, None) if all(spark.conf.get(c) == "true" for c in adaptive) else None
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a table, none if it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(target).getLength() if files.exists(target) else 0


def by_leading_keys(df: DataFrame) -> DataFrame:
    """Let joins of this session find rows where an earlier move by some of their keys put them.

    Rows of one ledger file, or of one part of a taxpayer, then move once for all joins inside it, as such a
    group is bounded.  By default Spark moves both sides of a join again unless they lie by all of its keys.
    """
    df.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return df


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the checkpoint folder that the session names.

    Where none is named, a folder below the warehouse, which all executors share as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work").rstrip("/")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder through Spark's own file system layer."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame) -> DataFrame:
    """Hand a table to several later steps: stored once, lineage cut.

    Used where a step reads its input more than once and the input is not already a
    stored table.  The copy is a Parquet table below the shared work folder, so losing
    executors loses nothing and later steps read only the columns they need.  The copy is
    removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    remove_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, *keys: str, moved: bool = True) -> DataFrame:
    """:func:`stage` for rows that lie by ``keys``: later steps by them, and more, find the copy in the same places.

    The copy is bucketed by the keys, as many buckets as a shuffle has partitions.  ``moved`` is false for rows that do
    not lie by the keys: every task then writes to most buckets, so they are only as many as the session names.
    """
    spark = df.sparkSession
    name = f"stage_{uuid.uuid4().hex}"
    path = f"{work_folder(spark)}/{name}"
    buckets = shuffle_partitions(spark) if moved else int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, *keys).saveAsTable(name)
    remove_at_end(spark, path)
    return spark.table(name)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Delete ``path`` when the application ends; results that read it stay valid until then."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
