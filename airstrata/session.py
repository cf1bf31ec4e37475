"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Only settings whose Spark default is wrong for this workload.
DEFAULTS = {
    # Shuffles start wide and AQE merges what turns out small, so one setting serves both
    # a laptop and a large cluster.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Dimensions are measured at run time; beyond this size AQE keeps the shuffle join.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.session.timeZone": "UTC",
}


def build_session(name: str = "airstrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword options use ``__`` for the dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    options = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for materialized intermediates, one of this application's own.

    It lies in what ``spark.checkpoint.dir`` names. Where that is unset, a folder in the
    warehouse stands in, which every executor reaches as well; a warehouse on the driver's own
    disk is refused on a cluster.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or None
    if configured is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        check_shared(warehouse, context.master)
        configured = f"{warehouse}/_intermediate"
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def check_shared(warehouse: str, master: str) -> None:
    """Fail if the warehouse is a folder that other machines of this master do not have."""
    here = warehouse.startswith(("file:", "/"))
    if here and not master.startswith("local"):
        raise ValueError(
            f"set spark.checkpoint.dir to a folder that all executors share; {warehouse} is local"
        )


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written as parquet into the working folder and read back.

    Unlike ``checkpoint`` the copy is columnar: later scans prune columns and push filters.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_stored(spark: SparkSession) -> None:
    """Delete all intermediates of this application; call it when results are read.

    These are the copies made by ``stored``, the tables and files of operators, and
    checkpoints, which all lie in the application's working folder.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(path, True)
    files.mkdirs(path)
