"""Session set-up and shared scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillflow.options import TIME_ZONE


def build_session(app_name: str = "tillflow", time_zone: str = TIME_ZONE, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    The master and the cluster sizes come from the submit command.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in spark.checkpoint.dir."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tillflow-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tillflow-{spark.sparkContext.applicationId}"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives later steps column pruning
    and true sizes.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; nothing built on them can be read afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
