"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; everything else stays with the cluster."""
    builder = (
        SparkSession.builder.appName("patronage")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def _setting(spark: SparkSession, key: str) -> str | None:
    """A setting of the session, or None where it is unset or empty."""
    return spark.conf.get(key, "") or None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the session names in spark.checkpoint.dir, or
    else a folder below the warehouse, which every session has and a cluster shares."""
    configured = _setting(spark, "spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark)}/patronage-{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the scratch folders this process wrote; for the end of a run, when no frame that reads
    them is needed any more. Returns their number."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    done = 0
    while _scratch:
        path = hadoop.Path(_scratch.pop())
        done += path.getFileSystem(conf).delete(path, True)
    return done


def cut_lineage(df: DataFrame) -> DataFrame:
    """A frame that several later jobs read, written once to the shared folder and read back.

    No later job recomputes it, a lost executor costs a re-read of files and not a re-run of the
    plan, and the file sizes tell Spark which side of a join is small.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
