"""Session settings, shipping of the package to workers, and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import atexit
import os
import uuid
import zipfile
from collections.abc import Callable
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
PACKAGE = Path(__file__).resolve().parent

# Settings every plan here relies on: UTC event time, adaptive re-planning and skew splitting.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows may be whole books: a batch to a Python worker ends by its bytes, not only by its rows; several copies of a batch
    # are in an executor's memory at once, on both sides of the pipe
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # the state of a stream may outgrow memory, and map state with timers needs it
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# paths staged by this process and not yet removed
_STAGED: list[str] = []


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers once per application; they import it wherever the driver was started."""
    context = spark.sparkContext
    name = f"{PACKAGE.name}-{context.applicationId}.zip"
    if any(os.path.basename(path) == name for path in context._python_includes):
        return
    # Spark's file server reads it from the driver and hands it to the executors
    archive = os.path.join(context._temp_dir, name)
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(archive)


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "12g",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vigilake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    if checkpoint_dir:
        builder = builder.config(CHECKPOINT_KEY, checkpoint_dir)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; in local mode, where none is set, a folder in the warehouse."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for checkpoints and staged tables; removed when the process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _STAGED:
        atexit.register(_sweep)
    _STAGED.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table in the shared folder, for results that several later jobs read.

    Unlike a cache it outlives lost executors, and unlike recomputing it reads the source once.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables whose readers are done."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        if path in _STAGED:
            _STAGED.remove(path)


@contextmanager
def staging(spark: SparkSession):
    """Everything staged inside the block is deleted at its end; for callers that consume their result inside it."""
    before = set(_STAGED)
    try:
        yield
    finally:
        release(spark, [path for path in _STAGED if path not in before])


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``staged`` of what ``build`` returns; whatever is staged on the way there is deleted once the rows are written."""
    path = staging_path(spark, name)
    with staging(spark):
        made = build()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def _sweep() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    try:
        release(spark, list(_STAGED))
    except Exception:  # noqa: BLE001 - the application may already have ended
        _STAGED.clear()
