"""Existence lookups against brute force, with a key that owns a third of the rows."""

import collections

import pytest
from pyspark.sql import functions as F

from salestax_spark.operators import existence


@pytest.fixture(scope="module")
def skewed(spark):
    """Thirds: one hot key, the NULL key, and distinct keys; one id repeated many times on the other side."""
    rows = spark.range(3000).select(
        F.col("id").alias("row"),
        (F.col("id") % 7).alias("grp"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id"))).alias("key"),
    )
    ids = spark.range(4000).select(
        F.when(F.col("id") < 1500, F.concat(F.lit("k"), F.col("id"))).otherwise("hot").alias("id")
    )
    return rows, ids


def _brute_force(rows, ids):
    known = {r.id for r in ids.collect()}
    return {r.row: r.key in known for r in rows.collect()}


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_flags_equal_brute_force(spark, skewed, monkeypatch, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    rows, ids = skewed
    marked = existence.mark_existing(rows, "key", ids, "found").collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(marked) == rows.count()
    assert {r.row: r.found for r in marked} == _brute_force(rows, ids)


def test_hot_key_that_does_not_exist(skewed):
    rows, ids = skewed
    ids = ids.where("id <> 'hot'")
    marked = existence.mark_existing(rows, "key", ids, "found").collect()
    assert {r.row: r.found for r in marked} == _brute_force(rows, ids)


def test_identical_rows_all_stay(spark):
    rows = spark.range(300).select(F.lit(1).alias("row"), F.lit("hot").alias("key"))
    ids = spark.createDataFrame([("hot",), ("hot",)], "id string")
    marked = existence.mark_existing(rows, "key", ids, "found")
    assert marked.where("found").count() == 300


def test_count_missing(skewed):
    rows, ids = skewed
    flags = _brute_force(rows, ids)
    want = collections.Counter(r.grp for r in rows.collect() if not flags[r.row])
    got = existence.count_missing(rows, "grp", "key", ids, "n")
    assert {r.grp: r.n for r in got.collect()} == dict(want)


def test_tasks_of_hot_keys_are_split(spark):
    """More than 500 keys, three of them with most rows; the final plan splits their tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    key = F.when(F.col("id") % 10 < 9, F.concat(F.lit("hot"), F.col("id") % 3)).otherwise(F.concat(F.lit("k"), F.col("id") % 997))
    rows = spark.range(120_000).repartition(6).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), key.alias("key"))
    ids = spark.range(500).select(F.concat(F.lit("k"), F.col("id")).alias("id")).union(spark.createDataFrame([("hot1",)], "id string"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        marked = existence.mark_existing(rows, "key", ids, "found")
        got = collections.Counter((r.key, r.found) for r in marked.collect())
        plan = marked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    known = {r.id for r in ids.collect()}
    want = collections.Counter((r.key, r.key in known) for r in rows.collect())
    assert got == want
    assert "skew=true" in plan


def test_rows_are_counted_before_the_join(skewed):
    rows, ids = skewed
    counted = existence.count_missing(rows, "grp", "key", ids, "n")
    lines = counted._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(lines) if "Join " in line)
    assert "Aggregate [grp" in lines[join + 1]


def test_ids_are_shuffled_once(spark, skewed):
    rows, ids = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = existence.count_missing(rows, "grp", "key", ids, "n")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(_key") == 1
