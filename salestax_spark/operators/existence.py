"""Existence lookups that stay even when one key owns a large share of the rows.

``mark_existing`` is NOT EXISTS / EXISTS as a column, in one lazy plan that scans the rows once:

* the ids are made distinct, so no row is doubled;
* rows and ids meet in one left join on a key of the join's own: the id behind a letter, or, for a row without a key, another letter and a
  hash of the row, which meets nothing and spreads such rows over all tasks. Since neither side is dealt by this key before, both are plain
  shuffles under the join, and Spark splits the tasks of any hot key, however many there are;
* nothing is broadcast by hand and no key is treated in a special way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_GIVEN, _NONE = "k", "n"


def _present(ids: DataFrame) -> DataFrame:
    """Each id once, with a marker. The marker comes last, so that the ids stay partitioned by key alone."""
    return ids.select(F.col(ids.columns[0]).alias("_key")).distinct().withColumn("_found", F.lit(True))


def mark_existing(rows: DataFrame, key: str, ids: DataFrame, flag: str) -> DataFrame:
    """``rows`` plus a boolean column: does ``rows[key]`` occur in the single column of ``ids``? A NULL key never does."""
    given = F.concat(F.lit(_GIVEN), F.col(key).cast("string"))
    spread = F.concat(F.lit(_NONE), F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("string"))
    keyed = rows.withColumn("_lookup", F.coalesce(given, spread))
    known = _present(ids).where(F.col("_key").isNotNull()).select(F.concat(F.lit(_GIVEN), F.col("_key").cast("string")).alias("_lookup"), "_found")
    return keyed.join(known, "_lookup", "left").select(*[f"`{c}`" for c in rows.columns], F.coalesce("_found", F.lit(False)).alias(flag))


def count_missing(rows: DataFrame, group: str, key: str, ids: DataFrame, count_name: str) -> DataFrame:
    """Per ``group``: how many rows have a key that ``ids`` does not hold (a NULL key never exists).

    Rows are counted per group and key before the join, so no hot key reaches it; of the NULL key there is
    one row per group. An outer join, because the optimizer moves an anti join below the aggregation and
    would bring the hot keys back into the shuffle.
    """
    counted = rows.groupBy(group, key).agg(F.count("*").alias("_rows"))
    joined = counted.join(_present(ids), F.col(key) == F.col("_key"), "left")
    return joined.where(F.col("_found").isNull()).groupBy(group).agg(F.sum("_rows").alias(count_name))
