"""Session set-up and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app="zonarium", master=None, **conf):
    """Session with the settings the library relies on.

    The data has no time zone, so the session runs in UTC.  AQE stays on: it
    coalesces small shuffle partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """Folder every executor can reach, used for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="zonarium-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark, label):
    """New, unused path inside the shared folder."""
    return f"{shared_dir(spark)}/zonarium/{label}-{uuid.uuid4().hex}"


def checkpointed(df):
    """``df`` stored once in the shared folder, with its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df, label):
    """``df`` written once as Parquet in the shared folder and read again, some columns at a time."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
