"""Reading the inputs with declared schemas; no type is guessed from the data."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestax_spark.sources import schemas

#: What a schema that cannot be merged raises, by version.
_ERRORS = (PySparkException, Py4JJavaError)
FORMATS = ("json_array", "json_lines", "parquet", "parquet_declared")
#: What to do with records that cannot be parsed: stop the run, or go on without them. ``rejected_records`` lists them.
FAIL, SKIP = "fail", "skip"
_RAW = "_malformed"


def read_documents(spark: SparkSession, path: str, schema: str, fmt: str = "json_array", on_bad: str = FAIL) -> DataFrame:
    """Nested records from JSON arrays, JSON lines or Parquet.

    A JSON array has to be parsed from its first byte, so one array file is one task. For large feeds
    deliver many files, JSON lines (splittable) or Parquet (splittable, nested columns pruned).
    Malformed JSON records stop the run instead of turning into silent NULLs, unless ``on_bad`` is "skip".

    "parquet" looks at the footers of all files, in a job: it has the fields of all files with the types they were written with, and a
    declared column that no file has is NULL. Where files disagree about a type, see ``_by_footer``. "parquet_declared" looks at no
    footer: the files have to have the declared types, and other fields are left out.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown source format {fmt!r}, expected one of {FORMATS}")
    if fmt == "parquet_declared":
        return spark.read.schema(schema).parquet(path)
    if fmt == "parquet":
        return _read_parquet(spark, path, T.StructType.fromDDL(schema))
    if on_bad == SKIP:
        parsed = _json(spark, path, f"{schema}, {_RAW} string", fmt, "PERMISSIVE")
        return parsed.where(F.col(_RAW).isNull()).drop(_RAW)
    return _json(spark, path, schema, fmt, "FAILFAST")


def _json(spark: SparkSession, path: str, schema: str, fmt: str, mode: str) -> DataFrame:
    reader = spark.read.schema(schema).option("multiLine", fmt == "json_array").option("mode", mode)
    return reader.option("columnNameOfCorruptRecord", _RAW).json(path)


def _read_parquet(spark: SparkSession, path: str, declared: T.StructType) -> DataFrame:
    try:
        found = spark.read.option("mergeSchema", True).parquet(path)
    except _ERRORS as error:
        if not _types_differ(error):
            raise
        return _by_footer(spark, path, declared)
    missing = [f for f in declared if f.name not in found.columns]
    return found.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def _types_differ(error: Exception) -> bool:
    return "[CANNOT_MERGE" in str(error)


def _by_footer(spark: SparkSession, path: str, declared: T.StructType) -> DataFrame:
    """Files whose types agree are read as one group, each group cast to the declared types, and the groups put together.

    A cast that fails stops the run. Fields that are not declared are left out. A struct that is NULL becomes one of NULLs, so that a
    scan still reads no more than the leaves a query asks for.
    """
    files = sorted(spark.read.format("binaryFile").load(path).inputFiles())
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, members in _agreeing(spark, path, files):
        groups.setdefault(schema.json(), (schema, []))[1].extend(members)
    parts = None
    for schema, members in groups.values():
        rows = spark.read.option("basePath", path).schema(schema).parquet(*members)
        part = rows.select(*[_declared(f.name, _type_at(schema, f.name), f.dataType).alias(f.name) for f in declared])
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _agreeing(spark: SparkSession, path: str, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Neighbours by name whose footers can be merged: feeds change from one delivery to the next, so halving finds the change in few steps."""
    try:
        return [(spark.read.option("basePath", path).option("mergeSchema", True).parquet(*files).schema, files)]
    except _ERRORS as error:
        if len(files) == 1 or not _types_differ(error):
            raise
    half = len(files) // 2
    return _agreeing(spark, path, files[:half]) + _agreeing(spark, path, files[half:])


def _type_at(schema: T.StructType, name: str) -> T.DataType | None:
    return schema[name].dataType if name in schema.fieldNames() else None


def _declared(path: str, found: T.DataType | None, wanted: T.DataType) -> Column:
    """The field at ``path`` in its declared type."""
    if found is None:
        return F.lit(None).cast(wanted)
    if found == wanted:
        return F.col(path)
    if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
        return F.struct(*[_declared(f"{path}.{f.name}", _type_at(found, f.name), f.dataType).alias(f.name) for f in wanted])
    if isinstance(found, T.StringType) and isinstance(wanted, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(F.col(path), wanted, {"mode": "FAILFAST"})
    return F.col(path).cast(wanted)


def rejected_records(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame:
    """Records of a JSON or CSV delivery that cannot be parsed: file, record as it is written, and what could be read of it."""
    if fmt == "csv":
        parsed = _csv(spark, path, "PERMISSIVE", with_raw=True)
    elif fmt in ("json_array", "json_lines"):
        parsed = _json(spark, path, f"{schema}, {_RAW} string", fmt, "PERMISSIVE")
    else:
        raise ValueError(f"records of format {fmt!r} are not parsed one by one")
    read = F.to_json(F.struct(*[f"`{c}`" for c in parsed.columns if c != _RAW]))
    listed = parsed.select(F.input_file_name().alias("file"), F.col(_RAW).alias("record"), read.alias("read_as"))
    return listed.where(F.col("record").isNotNull())


def _csv(spark: SparkSession, path: str, mode: str, with_raw: bool = False) -> DataFrame:
    """A CSV file as text by the names in its header. Every row has to have as many cells as the header, in every file the same ones."""
    header = spark.read.option("header", True).csv(path).columns
    fields = [T.StructField(name, T.StringType()) for name in (*header, *([_RAW] if with_raw else []))]
    # Without columnPruning, because a parser that is asked for some cells does not count the others.
    options = {"header": True, "mode": mode, "columnPruning": False, "enforceSchema": False, "columnNameOfCorruptRecord": _RAW}
    return spark.read.schema(T.StructType(fields)).options(**options).csv(path)


def read_thresholds(spark: SparkSession, path: str, on_bad: str = FAIL) -> DataFrame:
    """Threshold CSV as text, columns by the names in its header; empty cells are NULL. ``clean_thresholds`` types it.

    A row with too few or too many cells, or with a quote that is not closed, stops the run unless ``on_bad`` is "skip".
    """
    found = _csv(spark, path, "FAILFAST") if on_bad == FAIL else _csv(spark, path, "PERMISSIVE", with_raw=True)
    if on_bad == SKIP:
        found = found.where(F.col(_RAW).isNull()).drop(_RAW)
    missing = [name for name in schemas.THRESHOLD_COLUMNS if name not in found.columns]
    if required := [name for name in missing if name not in schemas.THRESHOLD_OPTIONAL]:
        raise ValueError(f"threshold file {path} lacks {', '.join(required)}")
    columns = [F.lit(None).cast("string").alias(name) if name in missing else F.col(name) for name in schemas.THRESHOLD_COLUMNS]
    return found.select(*columns)


def check_state_codes(thresholds: DataFrame) -> None:
    """Two capital letters, each code once: another code would never meet a sale, a second one would count every sale twice. Runs a job."""
    code = F.col("state_code")
    counted = thresholds.groupBy(code).agg(F.count("*").alias("rows"))
    wrong = counted.where(code.isNull() | ~code.rlike("^[A-Z]{2}$") | (F.col("rows") > 1)).orderBy("state_code").limit(10).collect()
    if wrong:
        listed = ", ".join(f"{row.state_code!r} ({row.rows})" for row in wrong)
        raise ValueError(f"state codes of the threshold table that are not two capital letters or not unique (rows): {listed}")


def read_merchants(spark: SparkSession, path: str, on_bad: str = FAIL) -> DataFrame:
    """Merchant records as JSON lines: id, name, default currency, stores."""
    return read_documents(spark, path, schemas.MERCHANTS, "json_lines", on_bad)
