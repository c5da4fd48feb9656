"""The landed table of decoded logs: one Parquet table, partitioned by chain."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.functions.numbers import text_to_bigint
from spanledger.functions.times import text_to_timestamp
from spanledger.schemas import LANDED
from spanledger.session import SHUFFLE_CLEANUP, settings


def fit_columns(df: DataFrame, columns: dict[str, str] = LANDED) -> DataFrame:
    """Keep a fixed column list in order; columns the input lacks become NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns.items()
        ]
    )


def refresh_landing(decoded: DataFrame, path: str, chains: list[str] | None = None) -> list[str]:
    """Full refresh: each chain in the input, and each of ``chains`` also if it has no row, replaces that chain's rows.

    Rows are written to a folder beside the table, which readers do not see,
    so a load that fails leaves the table as it was. Then the chains that the
    load has written, as their folders show, take the place of the old ones.
    A swap that was cut short is undone by the next refresh. Returns the chains replaced.

    The rebalance gathers each chain into few files, yet lets the adaptive
    planner split a chain that holds much of the data over many tasks. Within a
    file logs are ordered by event and time, so that a reader of one event skips
    the row groups of the others. What was shuffled goes when the rows are written.
    """
    swap = Swap(decoded.sparkSession, path)
    rows = (
        fit_columns(decoded)
        .withColumn("loaded_at", F.current_timestamp())
        .hint("rebalance", "blockchain")
        .sortWithinPartitions("blockchain", "topic_0", "timestamp_datetime")
    )
    with settings(decoded.sparkSession, {SHUFFLE_CLEANUP: "true"}):
        rows.write.partitionBy("blockchain").option("compression", "zstd").parquet(swap.loading)
    return swap.finish([f"blockchain={c}" for c in chains or []])


class Swap:
    """Sub-folders of a table replaced by ones that were written beside it.

    ``loading`` is where to write. Names with an underscore in front are no
    part of the table. Old folders are set aside, new ones put in their
    place, and only when all of them are in are the old ones removed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self.files = self.jvm_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        name = uuid.uuid4().hex
        self.loading, self.aside = f"{path}/_loading-{name}", f"{path}/_aside-{name}"
        self._undo()

    def _folders(self, path: str) -> list[str]:
        at = self.jvm_path(path)
        return [f.getPath().getName() for f in self.files.listStatus(at) if f.isDirectory()] if self.files.exists(at) else []

    def _move(self, old: str, new: str) -> None:
        self.files.mkdirs(self.jvm_path(new).getParent())
        if not self.files.rename(self.jvm_path(old), self.jvm_path(new)):
            raise OSError(f"could not move {old} to {new}")

    def _undo(self) -> None:
        """Put back what a broken swap had set aside, and drop what broken loads have written."""
        for name in self._folders(self.path):
            if name.startswith("_aside-"):
                for folder in self._folders(f"{self.path}/{name}"):
                    self.files.delete(self.jvm_path(f"{self.path}/{folder}"), True)
                    self._move(f"{self.path}/{name}/{folder}", f"{self.path}/{folder}")
        for name in self._folders(self.path):
            if name.startswith(("_loading-", "_aside-", "_done-")):
                self.files.delete(self.jvm_path(f"{self.path}/{name}"), True)

    def present(self) -> list[str]:
        """The folders of the table that readers see."""
        return [f for f in self._folders(self.path) if "=" in f]

    def finish(self, also: list[str]) -> list[str]:
        """Swap the folders that were written, and take out those of ``also`` that were not."""
        written = [f for f in self._folders(self.loading) if "=" in f]
        present = set(self._folders(self.path))
        for folder in dict.fromkeys([*written, *also]):
            if folder in present:
                self._move(f"{self.path}/{folder}", f"{self.aside}/{folder}")
            if folder in written:
                self._move(f"{self.loading}/{folder}", f"{self.path}/{folder}")
        if self.files.exists(self.jvm_path(self.aside)):
            done = self.aside.replace("_aside-", "_done-")  # from here on the swap stands
            self._move(self.aside, done)
            self.files.delete(self.jvm_path(done), True)
        self.files.delete(self.jvm_path(self.loading), True)
        return sorted({f.split("=", 1)[1] for f in [*written, *also]})


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """The landed table, also where no load has left a row."""
    fields = ", ".join(f"{n} {t}" for n, t in LANDED.items())
    return spark.read.schema(f"{fields}, loaded_at timestamp").parquet(path).select(*LANDED, "loaded_at")


def load_status(landing: DataFrame) -> DataFrame:
    """Rows per chain and source file: what is loaded, and how much of it."""
    return landing.groupBy("blockchain", "source_file").agg(F.count("*").alias("row_count"))


def table_status(spark: SparkSession, table: str, source_file: str | None = None) -> dict:
    """Whether a catalog table exists, its row count, and whether a file is in it."""
    if not spark.catalog.tableExists(table):
        return {"exists": False, "row_count": 0, "file_loaded": None}
    rows = spark.table(table)
    wanted = F.lit(None).cast("boolean")
    if source_file is not None:
        wanted = F.count_if(F.col("source_file") == source_file) > 0
    counted = rows.agg(F.count("*").alias("n"), wanted.alias("loaded")).first()
    return {"exists": True, "row_count": counted["n"], "file_loaded": counted["loaded"]}


def files_status(spark: SparkSession, table: str, files: DataFrame) -> DataFrame:
    """For every ``source_file`` asked for: is the table there, is the file in it, and with how many rows."""
    none = F.lit(0).cast("bigint")
    if not spark.catalog.tableExists(table):
        return files.select("source_file", F.lit(False).alias("table_exists"), none.alias("row_count"), F.lit(False).alias("loaded"))
    rows = spark.table(table).groupBy("source_file").agg(F.count("*").alias("n"))
    counted = F.coalesce(F.col("n"), none)
    return files.join(rows, "source_file", "left").select("source_file", F.lit(True).alias("table_exists"), counted.alias("row_count"), (counted > 0).alias("loaded"))


def retype_text(df: DataFrame, *keep: str) -> DataFrame:
    """An all-TEXT landing table to the typed columns (strict on junk), after further columns to ``keep`` as they are."""

    def typed(name: str, kind: str):
        col = F.col(name)
        if kind == "timestamp":
            return text_to_timestamp(col, strict=True)
        if kind == "bigint":
            return text_to_bigint(col)
        return col.cast(kind)

    return df.select(*keep, *[typed(name, kind).alias(name) for name, kind in LANDED.items()])
