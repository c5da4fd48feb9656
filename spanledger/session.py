"""Session settings the operators rely on, and folders for tables that later steps read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime-settable, so they can also be applied to a session made elsewhere.
# Shuffle partitions and the broadcast limit are left to the cluster's own
# configuration: AQE coalesces, splits skewed partitions and re-plans joins.
# ANSI is pinned because strict casts must raise rather than give NULL.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Decoded logs take ten to twenty times their shuffled bytes in a sort, so a task
# gets fewer of them than Spark's default of 64 MB, or it would spill them.
ADVISORY, ADVISED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 16 << 20

# For a write that runs once: its shuffles are removed when it ends, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on (UTC, ANSI) and adaptive planning; a smaller advised size of the cluster's own stays."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    size_of = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if size_of(spark.conf.get(ADVISORY)) > ADVISED_BYTES:
        spark.conf.set(ADVISORY, f"{ADVISED_BYTES}b")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for what runs inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_session(cpus: int | str = "*", app: str = "spanledger") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    partitions = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", partitions)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """A new folder for tables that later steps read back, removed when the application ends.

    A cluster names a folder every executor can reach in
    ``spark.checkpoint.dir``. Without it a local folder is made, but only on a
    single machine: elsewhere each executor would write to its own disk, so
    that case raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        path = f"{base.rstrip('/')}/spanledger-{uuid.uuid4()}"
    elif _one_machine(spark.sparkContext.master):
        path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    else:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder made by ``shared_folder`` before the application ends."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that a DataFrame reads."""
    spark = df.sparkSession
    jvm, conf, total = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    for name in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet to a shared folder and read back: its lineage is cut, and its shuffles go."""
    spark = df.sparkSession
    path = path or shared_folder(spark)
    with settings(spark, {SHUFFLE_CLEANUP: "true"}):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
