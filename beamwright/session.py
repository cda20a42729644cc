"""Session building and the shared scratch location."""

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Image groups are small in bytes and long in compute: without this, adaptive
# execution would merge many of them into one task.
KERNEL_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB"}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: str = "8", app: str = "beamwright") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own.

    Python workers import this package too, wherever the session was started from.
    """
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if here not in known:
        os.environ["PYTHONPATH"] = os.pathsep.join([here, *filter(None, known)])
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> None:
    """Runtime settings the library wants in any session."""
    for key, value in KERNEL_CONF.items():
        spark.conf.set(key, value)


def shared(master: str, folder: str) -> bool:
    """Whether all executors reach the folder: they are threads of one machine, or it is in a store."""
    one_machine = master == "local" or master.startswith("local[")
    return one_machine or ("://" in folder and not folder.startswith("file:"))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder the cluster names, else below the warehouse.

    A warehouse on a machine's own disk serves a local session only: elsewhere each executor would write to its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not shared(spark.conf.get("spark.master", "local"), warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{warehouse}/scratch"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Cut lineage with a written table, which outlives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
