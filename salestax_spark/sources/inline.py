"""Small tables written down in code.

They become inline VALUES, whose exact size Spark knows, so it can decide by itself to broadcast them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return f"{value}L"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, (list, tuple)):
        return f"array({', '.join(map(sql_literal, value))})"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def inline_table(spark: SparkSession, columns: dict[str, str], rows: Iterable[tuple]) -> DataFrame:
    values = ", ".join(f"({', '.join(map(sql_literal, row))})" for row in rows)
    typed = ", ".join(f"CAST({name} AS {dtype}) AS {name}" for name, dtype in columns.items())
    return spark.sql(f"SELECT {typed} FROM VALUES {values} AS t({', '.join(columns)})")
