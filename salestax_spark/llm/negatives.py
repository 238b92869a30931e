"""Hard negatives for contrastive training, found by segment summary filtering.

Of every vector the mean and the deviation of each of its segments are stored, for 1, 4 and 16 segments. With the deviation taken as the length
of what is left once the mean is gone, the inner product of two segments of s components is at most s * mean * mean plus, and at least
that minus, the product of the deviations. The sums over the segments bound a score from both sides. An anchor that meets a block of rows
first drops those whose bounds rule them out at one segment, then at 4 and at 16, and only what is left is scored exactly.

Two passes: the positives of an anchor are its best rows of the same label; a negative is one of another label whose score lies between
``low`` and ``high`` percent of the positive's. In the first pass a row is out if its upper bound is below the k-th best lower bound
seen in the block, in the second if no positive's range is within its bounds.

Anchors and rows are dealt into blocks of bounded bytes, in the first pass by label; a task holds one block of either kind, so a label that owns any
share of the rows is many tasks. Each block pair hands on at most ``positives`` rows per anchor, or ``negatives`` per positive, and these meet in
a plain aggregation by anchor. The work is anchors times rows, as a search of every anchor against all rows has to be; no row is left out.

Cases: rows with a NULL label, a NULL vector or a NULL or non-finite component take no part. Vectors of different length are never compared; an
empty vector scores 0 with other empty ones. Components are whole numbers; scores are exact in 64 bits, those beyond are held at the end of that
range. Equal scores are ordered by id, a NULL id (kept as the largest long number, which is taken) last, then arbitrarily: rows that share an id
are rows of their own, as anchors too. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salestax_spark.llm.common import Scratch

LEVELS = (1, 4, 16)
#: Rows and anchors of a block, and the bytes of vectors that a block of rows holds at most (one vector at least).
ROWS, ANCHORS, BLOCK_BYTES = 4096, 512, 8 << 20
NO_ID = (1 << 63) - 1


def _segments(dim: int, level: int) -> np.ndarray:
    """Ends of the segments of a vector; none is empty."""
    return np.unique(np.linspace(0, dim, level + 1).astype(int))


def summarise(x: np.ndarray) -> np.ndarray:
    """Per row of ``x`` and level: sqrt(s) * mean of all segments, then their deviations."""
    x = x.astype(np.float64)
    parts = []
    for level in LEVELS:
        ends = _segments(x.shape[1], level)
        if len(ends) < 2:
            continue
        sizes = np.diff(ends)
        means = np.add.reduceat(x, ends[:-1], axis=1) / sizes
        rest = x - np.repeat(means, sizes, axis=1)
        parts += [means * np.sqrt(sizes), np.sqrt(np.add.reduceat(rest * rest, ends[:-1], axis=1))]
    return np.concatenate(parts, axis=1) if parts else np.empty((len(x), 0))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _summary(vectors: pd.Series) -> pd.Series:
    out = pd.Series([None] * len(vectors), dtype=object)
    sizes = vectors.map(len).to_numpy()
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        x = np.stack([np.asarray(vectors.iloc[i], np.int64) for i in at]).reshape(len(at), dim)
        for i, s in zip(at, summarise(x), strict=True):
            out.iloc[i] = s
    return out


def _bounds(a: np.ndarray, b: np.ndarray, dim: int):
    """Per level: lower and upper bounds of the scores of all pairs, widened by more than rounding can take."""
    at = 0
    for level in LEVELS:
        k = len(_segments(dim, level)) - 1
        if k < 1:
            continue
        middle = a[:, at : at + k] @ b[:, at : at + k].T
        reach = a[:, at + k : at + 2 * k] @ b[:, at + k : at + 2 * k].T
        slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
        yield middle - reach - slack, middle + reach + slack
        at += 2 * k


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: in doubles where these are exact, in Python's integers elsewhere."""
    largest = [max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0 for x in (a, b)]
    if largest[0] * largest[1] * max(1, a.shape[1]) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _best(scores: np.ndarray, eligible: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best eligible scores of each row; of equal ones the first columns."""
    if scores.size == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # Everything above the k-th best, and as many of those equal to it as are still free; columns are in order of id.
    low = np.iinfo(np.int64).min
    held = np.where(eligible, scores, low)
    nth = np.partition(held, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(held), low)
    above = eligible & (scores > nth[:, None])
    equal = eligible & (scores == nth[:, None])
    free = k - above.sum(axis=1)
    kept = above | (equal & (np.cumsum(equal, axis=1) <= free[:, None]))
    return np.nonzero(kept)


class _Block:
    """The arrays of one packed block: a list of structs in one Arrow value, rows sorted by id."""

    def __init__(self, packed: pa.Table, column: str, dim: int):
        self.items = packed.column(column).combine_chunks().flatten()
        self.order = np.lexsort([pc.struct_field(self.items, name).to_numpy(zero_copy_only=False) for name in ("row", "id")])
        self.row, self.id = self.plain("row"), self.plain("id")
        self.vector, self.summary = self.wide("vector", dim, np.int64), self.wide("summary", None, np.float64)

    def plain(self, name: str) -> np.ndarray:
        return pc.struct_field(self.items, name).to_numpy(zero_copy_only=False)[self.order]

    def wide(self, name: str, width: int | None, dtype: type) -> np.ndarray:
        flat = np.asarray(pc.struct_field(self.items, name).flatten().to_numpy(zero_copy_only=False), dtype)
        width = len(flat) // len(self.order) if width is None else width
        return flat.reshape(len(self.order), width)[self.order]


def _positives_of(table: pa.Table, k: int) -> pa.Table:
    dim = table.column("dim")[0].as_py()
    anchors, rows = _Block(table, "anchors", dim), _Block(table, "rows", dim)
    alive = anchors.row[:, None] != rows.row[None, :]
    for lower, upper in _bounds(anchors.summary, rows.summary, dim):
        if len(rows.row) > k:
            floor = np.partition(np.where(alive, lower, -np.inf), -k, axis=1)[:, -k]
            alive &= upper >= floor[:, None]
    used = np.flatnonzero(alive.any(axis=0))
    scores = exact_scores(anchors.vector, rows.vector[used])
    a, r = _best(scores, alive[:, used], k)
    return pa.table({"anchor": anchors.row[a], "score": scores[a, r], "id": rows.id[used[r]], "row": rows.row[used[r]]})


def _negatives_of(table: pa.Table, k: int) -> pa.Table:
    dim = table.column("dim")[0].as_py()
    anchors, rows = _Block(table, "anchors", dim), _Block(table, "rows", dim)
    labels = np.unique(np.concatenate([anchors.plain("label"), rows.plain("label")]).astype(str), return_inverse=True)[1]
    alive = labels[: len(anchors.row), None] != labels[None, len(anchors.row) :]
    ranges = pc.struct_field(anchors.items, "positives")
    positives = [ranges[int(i)].as_py() for i in anchors.order]
    lows = np.array([min((p["low"] for p in ps), default=0) for ps in positives])
    highs = np.array([max((p["high"] for p in ps), default=-1) for ps in positives])
    for lower, upper in _bounds(anchors.summary, rows.summary, dim):
        alive &= (upper >= lows[:, None]) & (lower <= highs[:, None])
    used = np.flatnonzero(alive.any(axis=0))
    scores = exact_scores(anchors.vector, rows.vector[used])
    alive = alive[:, used]
    out = []
    for nth in range(max(map(len, positives), default=0)):
        having = np.array([i for i, ps in enumerate(positives) if len(ps) > nth])
        low, high = (np.array([positives[i][nth][name] for i in having])[:, None] for name in ("low", "high"))
        fits = alive[having] & (scores[having] >= low) & (scores[having] <= high)
        a, r = _best(scores[having], fits, k)
        found = scores[having][a, r]
        out.append(pa.table({"anchor": anchors.row[having[a]], "nth": np.full(len(a), nth), "score": found, "id": rows.id[used[r]], "row": rows.row[used[r]]}))
    empty = np.empty(0, np.int64)
    return pa.concat_tables(out) if out else pa.table({c: empty for c in ("anchor", "nth", "score", "id", "row")})


def _met(rows: DataFrame, anchors: DataFrame, keys: list[str], scratch: Scratch, name: str) -> DataFrame:
    """One row per pair of an anchor block and a row block that agree in ``keys``; each block is an array of structs."""
    per_row = F.greatest(F.lit(1), F.least(F.lit(ROWS), F.call_function("div", F.lit(BLOCK_BYTES), 8 * F.greatest(F.lit(1), F.col("dim")))))
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    counts = counts.join(anchors.groupBy(*keys).agg(F.count("*").alias("_m")), keys)
    counts = counts.select(
        *keys,
        F.ceil(F.col("_n") / per_row).alias("_row_blocks"),
        F.ceil(F.col("_m") / F.least(F.lit(ANCHORS), per_row)).alias("_anchor_blocks"),
    )
    counts = scratch.write(f"{name}-blocks", counts)

    def packed(df: DataFrame, what: str, own: str, other: str) -> DataFrame:
        columns = F.struct(*[c for c in df.columns if c not in keys])
        block = F.pmod(F.xxhash64("row"), F.col(f"_{own}_blocks")).alias(f"_{own}_block")
        blocks = df.join(counts, keys).select(*keys, f"_{other}_blocks", block, columns.alias("_item"))
        blocks = blocks.groupBy(*keys, f"_{other}_blocks", f"_{own}_block").agg(F.collect_list("_item").alias(what))
        other_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_{other}_blocks") - 1)).alias(f"_{other}_block")
        return blocks.select(*keys, f"_{own}_block", what, other_block)

    on = [*keys, "_row_block", "_anchor_block"]
    return packed(rows, "rows", "row", "anchor").join(packed(anchors, "anchors", "anchor", "row"), on)


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    vector_column: str = "vector",
    label_column: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """Vectors of whole numbers to anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    scratch = Scratch(vectors.sparkSession, "negatives")
    vector = F.col("vector")
    rows = vectors.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).cast("array<bigint>").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    rows = rows.where(F.col("label").isNotNull() & vector.isNotNull() & ~F.exists(vector, lambda v: v.isNull()))
    rows = rows.withColumn("dim", F.size("vector")).withColumn("summary", _summary("vector"))
    # Written with their numbers, which then stay whatever is lost.
    rows = scratch.write("rows", rows.withColumn("row", F.monotonically_increasing_id()))
    of_rows = ("id", "row", "vector", "summary")
    anchors = rows.where("is_anchor")

    met = _met(rows.select("dim", "label", *of_rows), anchors.select("dim", "label", *of_rows), ["dim", "label"], scratch, "positives")
    found = met.groupBy("dim", "label", "_row_block", "_anchor_block").applyInArrow(
        lambda table: _positives_of(table, positives), "anchor long, score long, id long, row long"
    )
    better = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "row")
    best = found.withColumn("nth", F.row_number().over(better) - 1).where(F.col("nth") < positives)
    best = scratch.write("positives", best.drop("row"))

    # low * p <= 100 * n <= high * p, rounded to whole scores; decimals because 100 times a score may not fit a long.
    def share(percent: int, rounded) -> Column:
        exact = F.col("score").cast("decimal(20,0)") * F.lit(percent) / F.lit(100)
        return rounded(exact).cast("decimal(20,0)").cast("long")

    ranges = best.select("anchor", "nth", share(low, F.ceil).alias("low"), share(high, F.floor).alias("high")).where("low <= high")
    asked = ranges.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("nth", "low", "high"))).alias("positives"))
    asking = anchors.join(asked, F.col("row") == F.col("anchor"))
    met = _met(rows.select("dim", "label", *of_rows), asking.select("dim", "label", *of_rows, "positives"), ["dim"], scratch, "negatives")
    found = met.groupBy("dim", "_row_block", "_anchor_block").applyInArrow(
        lambda table: _negatives_of(table, negatives), "anchor long, nth long, score long, id long, row long"
    )
    better = Window.partitionBy("anchor", "nth").orderBy(F.col("score").desc(), "id", "row")
    ranked = found.withColumn("rank", F.row_number().over(better)).where(F.col("rank") <= negatives)
    named = ranked.join(best.select("anchor", "nth", F.col("score").alias("positive_score"), F.col("id").alias("positive_id")), ["anchor", "nth"])
    named = named.join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")

    def known(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(NO_ID))

    return named.select(
        "anchor_id", known("positive_id").alias("positive_id"), "rank", known("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def whole_components(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component; NULL where the vector holds a NULL or a number that is not finite."""
    doubles = vector.cast("array<double>")
    usable = F.forall(doubles, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(usable, F.transform(doubles, lambda v: F.floor(v * F.lit(scale)).cast("long")))
