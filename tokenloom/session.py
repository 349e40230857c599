"""Session settings, and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tokenloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew-join handling on, UTC time, and stream state on disk."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, wherever the session was started.

    Spark copies the file to the executors, as with `--py-files`.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    if package.is_dir():  # not when the package itself was shipped as a file
        staged = Path(tempfile.mkdtemp(prefix="tokenloom-ship-")) / package.name
        spark.sparkContext.addPyFile(shutil.make_archive(str(staged), "zip", package.parent, package.name))
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    `spark.checkpoint.dir` decides. Only a local session without one gets a
    folder of its own; a cluster session without one is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tokenloom-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below this application's part of the shared folder."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}/{name}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tokenloom/{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> bool:
    """Remove every intermediate table that this application wrote; False if there was none.

    To be called when no DataFrame that reads one is needed any more, such as
    after the results are written. Tables of other applications stay.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and leaves a
    columnar table whose later readers still get column pruning and statistics.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)
