"""What several corpus operators share: words, shared scratch tables, prefix sums over large groups."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salestax_spark.sources.tables import scratch_folder

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def permutation_key(seed: int, *columns: Column) -> Column:
    """A repeatable pseudo-random 60-bit number; the same digits in every engine that has md5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def row_hash(*columns: Column, seed: int = 0) -> Column:
    """64 bits that name a row. xxhash64 skips NULLs, so which columns are NULL is hashed as well."""
    return F.xxhash64(F.lit(seed), *columns, *[c.isNull() for c in columns])


def row_key(docs: DataFrame) -> list[Column]:
    """128 bits that name a row; equal rows have equal names."""

    def plain(name: str, kind: T.DataType) -> Column:
        nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType))
        return F.to_json(F.struct(F.col(f"`{name}`")), {"ignoreNullFields": "false"}) if nested else F.col(f"`{name}`")

    columns = [plain(f.name, f.dataType) for f in docs.schema.fields]
    return [row_hash(*columns).alias("_row"), row_hash(*columns, seed=1).alias("_row2")]


def set_aside(docs: DataFrame, taken: tuple[str, ...], needed: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, Column]]:
    """Columns of ``docs`` that no operator reads get other names if theirs is one of ``taken`` or starts with an underscore.

    Returns the table and, by its name, each column as it was called. Columns in ``needed`` stay. Without a clash the table is as before.
    """
    names = {}
    for i, c in enumerate(docs.columns):
        clash = c not in needed and (c.lower() in taken or c.startswith("_"))
        names[c] = f"__aside_{i}" if clash else c
    return docs.withColumnsRenamed({c: n for c, n in names.items() if c != n}), {c: F.col(f"`{n}`").alias(c) for c, n in names.items()}


def others(named: dict[str, Column], outputs: tuple[str, ...]) -> list[Column]:
    """Columns of set_aside that no output column replaces."""
    return [column for name, column in named.items() if name.lower() not in outputs]


class Scratch:
    """Tables one operator writes below the shared folder: they cut lineage and survive lost executors.

    A table can be dropped once its reader has written its own; what is left goes when the session ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self._hadoop(self.root, lambda fs, path: (fs.mkdirs(path), fs.deleteOnExit(path)))

    def _hadoop(self, location: str, action) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(location)
        action(path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Let the cluster delete shuffle files of jobs that are done; it does so once the driver collects garbage."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *names: str) -> None:
        for name in names:
            self._hadoop(f"{self.root}/{name}", lambda fs, path: fs.delete(path, True))


def number_rows(df: DataFrame, order: list[Column], name: str, scratch: Scratch, table_name: str = "numbered") -> DataFrame:
    """``df`` plus ``name``: 0, 1, 2 ... over all its rows in the given order, without a gap.

    Rows are dealt by range and sorted inside their range; one count per range travels on. Rows that are equal in ``order`` are told apart by
    where they lie in the input, so that no value fills a range by itself. Which of them comes first is open.
    """
    kept = [f"`{c}`" for c in df.columns]
    placed = df.withColumn("_at", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*order, "_at").sortWithinPartitions(*order, "_at")
    placed = placed.select(
        *kept,
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_nth"),
    )
    placed = scratch.write(table_name, placed)
    sizes = placed.groupBy("_part").agg((F.max("_nth") + 1).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), "_part")  # one row per range
    return numbered.select(*kept, (F.col("_offset") + F.col("_nth")).alias(name))


def prefix_sums(
    df: DataFrame, group: str, key: str, ties: list[str], value: Column, name: str, key_bits: int, chunk_bits: int = 10
) -> DataFrame:
    """``df`` plus ``name``: the sum of ``value`` over the rows before this one in its group, by ``key`` and ``ties``.

    ``key`` is an evenly spread number of ``key_bits`` bits. Its top bits cut each group into 2**chunk_bits chunks;
    sums of chunks are carried by a small table, so that a group of a third of all rows is worked on by many tasks.
    """
    chunked = df.withColumn("_chunk", F.shiftright(key, key_bits - chunk_bits)).withColumn("_value", value)
    sums = chunked.groupBy(group, "_chunk").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(group, "_chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(group, "_chunk").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    ranked = chunked.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    joined = ranked.join(offsets, [group, "_chunk"])
    return joined.withColumn(name, F.col("_offset") + F.col("_inside")).drop("_chunk", "_value", "_inside", "_offset")
