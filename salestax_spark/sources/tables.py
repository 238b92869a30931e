"""Where results live: Parquet folders under a shared location, or catalog tables.

Every write is a full refresh, and a refresh is one step for readers: tables are written beside the former ones, and only when all of
them are complete does one small change make them the current ones. A run that ends in the middle leaves the former set as it was.
A written table also cuts lineage, so a lost executor never forces the stages before it to run again.
"""

from __future__ import annotations

import json
import tempfile
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _generation() -> str:
    """A name that sorts by time."""
    return f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


class _Refreshed:
    """What both stores share: a refresh that takes in all tables replaced while it lasts."""

    def __init__(self) -> None:
        self._generation: str | None = None
        self._pending: dict[str, str] = {}

    @contextmanager
    def refresh(self) -> Iterator[None]:
        """Tables replaced inside become the current ones together at the end; after an error none does. Inner refreshes join the outer one."""
        if self._generation is not None:
            yield
            return
        self._generation, self._pending = _generation(), {}
        try:
            yield
            self._publish(self._pending)
        except BaseException:
            self._discard(self._generation)
            raise
        finally:
            self._generation, self._pending = None, {}


class FolderStore(_Refreshed):
    """Tables as Parquet folders below one location on shared storage.

    Each refresh has a folder of its own below ``generations``. The file ``_current.json`` names the folder of every table; it is written under
    another name and renamed over the old one. The generation before the current one is kept for queries that still read it, older ones
    are deleted. One refresh at a time: two that overlap are not told apart.
    """

    POINTER = "_current.json"

    def __init__(self, spark: SparkSession, location: str):
        super().__init__()
        self.spark, self.location = spark, location.rstrip("/")

    def path(self, name: str) -> str:
        """Where the current table ``name`` lies."""
        if name not in (tables := self._current()):
            raise LookupError(f"table not found: {name}")
        return f"{self.location}/{tables[name]}"

    def replace(self, name: str, df: DataFrame, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` as the next ``name``; values of ``partition_by`` become folders."""
        with self.refresh():
            folder = f"generations/{self._generation}/{name}"
            df.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(f"{self.location}/{folder}")
            self._pending[name] = folder
        return self.spark.read.format(fmt).load(f"{self.location}/{folder}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _files(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.location}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _current(self) -> dict[str, str]:
        path, files = self._files(self.POINTER)
        if not files.exists(path):
            return {}
        stream = files.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, tables: dict[str, str]) -> None:
        before = self._current()
        fresh, files = self._files(f"_next-{self._generation}.json")
        stream = files.create(fresh, True)
        stream.write(bytearray(json.dumps({**before, **tables}, indent=1).encode()))
        stream.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self.spark._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        qualified = files.makeQualified(fresh)
        context.rename(qualified, files.makeQualified(self._files(self.POINTER)[0]), how)
        self._clear({*before.values(), *{**before, **tables}.values()})

    def _clear(self, kept: set[str]) -> None:
        root, files = self._files("generations")
        used = {folder.split("/")[1] for folder in kept}
        for found in files.listStatus(root):
            if found.getPath().getName() not in used:
                files.delete(found.getPath(), True)

    def _discard(self, generation: str) -> None:
        path, files = self._files(f"generations/{generation}")
        files.delete(path, True)


class CatalogStore(_Refreshed):
    """Tables in the session catalog, looked up by bare name first and then in the given database.

    A table is written under a name with its generation; the plain name is a view, and replacing the view is one step per table, taken for
    all tables of a refresh after the last one is written. The generation before the current one is kept, older ones are dropped.

    ``buckets`` gives, by table, a number of buckets and the columns they follow: joins and rankings by these columns need no shuffle.
    """

    def __init__(self, spark: SparkSession, database: str = "default", buckets: Mapping[str, tuple] | None = None):
        super().__init__()
        self.spark, self.database, self.buckets = spark, database, dict(buckets or {})

    def replace(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` as the next ``name``; values of ``partition_by`` become folders."""
        with self.refresh():
            table = f"{self.database}.{name}__{self._generation}"
            writer = df.write.format("parquet").mode("overwrite").partitionBy(*partition_by)
            if name in self.buckets:
                number, *columns = self.buckets[name]
                writer = writer.bucketBy(number, *columns).sortBy(*columns)
            writer.saveAsTable(table)
            self._pending[name] = table
        return self.spark.table(table)

    def read(self, name: str) -> DataFrame:
        for candidate in (name, f"{self.database}.{name}"):
            if self.spark.catalog.tableExists(candidate):
                return self.spark.table(candidate)
        raise LookupError(f"table not found: {name}")

    def _tables(self, name: str) -> list[str]:
        """Generations of a table, the oldest first."""
        found = self.spark.sql(f"SHOW TABLES IN {self.database} LIKE '{name}__*'").collect()
        return sorted(f"{self.database}.{row.tableName}" for row in found if row.tableName.rsplit("__", 1)[0] == name)

    def _publish(self, tables: dict[str, str]) -> None:
        for name, table in tables.items():
            plain = f"{self.database}.{name}"
            if self.spark.catalog.tableExists(plain) and self.spark.catalog.getTable(plain).tableType != "VIEW":
                # Written by an earlier version of this class, without generations.
                self.spark.sql(f"ALTER TABLE {plain} RENAME TO {plain}__{0:020d}_former")
            self.spark.sql(f"CREATE OR REPLACE VIEW {plain} AS SELECT * FROM {table}")
            for old in self._tables(name)[:-2]:
                self.spark.sql(f"DROP TABLE {old}")

    def _discard(self, generation: str) -> None:
        for table in self._pending.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; a temporary one in local mode only."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="salestax-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def write_files(df: DataFrame, label: str, fmt: str = "parquet", **options: object) -> str:
    """Path of a fresh folder below the scratch folder that holds ``df``; deleted when the session ends."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**options).save(path)
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(location)
    return path


def write_once(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the scratch folder and read back: several consumers then share one computation.

    Parquet rather than a checkpoint, so that each consumer still reads only its columns.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_files(df, label))


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make DataFrames reachable from SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
