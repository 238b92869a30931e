"""A reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers, in SQL functions only.

1. Rows are numbered 0 to n - 1 by the given columns (see common.number_rows).
2. A number x is written as a pair (x div b, x mod b) with a = ceil(sqrt(n)) and b = ceil(n / a). Each of ROUNDS rounds adds to one half, modulo its
   size, a hash of the other half: a permutation of the a * b pairs for every seed. a * b exceeds n by less than a.
3. A result of n or more is permuted again until it is below n (cycle walking). The cycle of x holds at most a * b - n such numbers in a row,
   so a walk of that length plus one always ends; almost all end after the first step.
4. The new place p of a row gives shard p mod shards and slot p div shards: row counts of shards are at most one apart, slots have no gap.

Both ways are plain arithmetic: ``place_of`` tells where a row number goes and ``row_at`` which row lies in a slot, without any table.

Cases: rows that are equal in all columns get the numbers next to each other, in any order; equal texts of different documents are different
rows and are spread like all others. NULLs sort first. An empty table gives an empty result. Extra columns are carried along, but for
those called like an output column, which is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestax_spark.llm.common import Scratch, number_rows, others, permutation_key, row_key, set_aside

SHARDS = 24
ROUNDS = 6
SEED = 13
OUTPUTS = ("row_number", "shard", "slot")


def _sides(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def _permuted(x: Column, a: int, b: int, seed: int, backwards: bool) -> Column:
    """One application of the permutation of 0 to a * b - 1, or of its inverse."""

    def turn(halves: Column, k: Column) -> Column:
        left, right = halves["left"], halves["right"]
        sign = -1 if backwards else 1
        return F.when(
            k % 2 == 0, F.struct(F.pmod(left + sign * F.pmod(permutation_key(seed, k, right), F.lit(a)), F.lit(a)).alias("left"), right.alias("right"))
        ).otherwise(F.struct(left.alias("left"), F.pmod(right + sign * F.pmod(permutation_key(seed, k, left), F.lit(b)), F.lit(b)).alias("right")))

    rounds = F.array(*[F.lit(k) for k in (reversed(range(ROUNDS)) if backwards else range(ROUNDS))])
    start = F.struct(F.call_function("div", x, F.lit(b)).alias("left"), F.pmod(x, F.lit(b)).cast("long").alias("right"))
    return F.aggregate(rounds, start, turn, lambda halves: halves["left"] * b + halves["right"])


def _walked(df: DataFrame, x: Column, name: str, n: int, seed: int, backwards: bool) -> DataFrame:
    a, b = _sides(n)

    def again(y: Column, steps: int) -> Column:
        walk = F.aggregate(
            F.sequence(F.lit(1), F.lit(steps)), y, lambda v, _: F.when(v < n, v).otherwise(_permuted(v, a, b, seed, backwards))
        )
        return F.when(y < n, y).otherwise(walk)

    outside = a * b - n
    walked = df.withColumn(name, _permuted(x, a, b, seed, backwards))
    # A short walk first, because the sequence of the longest one would be built for every row that needs any.
    for steps in sorted({min(outside, 32), outside} - {0}):
        walked = walked.withColumn(name, again(F.col(name), steps))
    return walked


def place_of(df: DataFrame, n: int, shards: int = SHARDS, seed: int = SEED, row_column: str = "row_number") -> DataFrame:
    """``df`` plus shard and slot of the row whose number is in ``row_column``; ``n`` is the number of all rows."""
    placed = _walked(df, F.col(row_column).cast("long"), "_place", n, seed, backwards=False)
    place = F.col("_place")
    return placed.select(
        *[f"`{c}`" for c in df.columns],
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
        F.call_function("div", place, F.lit(shards)).alias("slot"),
    )


def row_at(df: DataFrame, n: int, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` plus row_number: which row lies in its shard and slot."""
    return _walked(df, F.col("slot") * shards + F.col("shard"), "row_number", n, seed, backwards=True)


def shard_rows(docs: DataFrame, order: tuple[str, ...] = ("doc_id",), shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Columns of ``docs`` plus row_number, shard and slot. Rows equal in ``order`` are ordered by 128 bits over all their columns."""
    docs, named = set_aside(docs, OUTPUTS, order)
    scratch = Scratch(docs.sparkSession, "sharding")
    hashed = docs.select("*", *row_key(docs))
    numbered = number_rows(hashed, [F.col(c).asc_nulls_first() for c in order] + [F.col("_row"), F.col("_row2")], "_number", scratch)
    n = numbered.count()
    placed = place_of(numbered, n, shards, seed, "_number")
    return placed.select(*others(named, OUTPUTS), F.col("_number").alias("row_number"), "shard", "slot")
