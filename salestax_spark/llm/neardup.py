"""Embedding near-duplicates by sorted projection passes.

Equal vectors of one label are one point with a count, so that copies cost nothing. In every pass the points of a label are
sorted by the signs of BITS random projections, written one after the other, which puts vectors of a small angle close to each other;
each point is compared with its WINDOW next ones in that order, exactly, in double precision. What a block of the order links is handed on as
one edge per point, to the least point it reaches in the block, and edges of all passes are united into components.

Links are then counted inside the components, so that a group denser than the windows loses none: points are sorted by component and by their
angle to its least point, cut into blocks, and blocks that share a component are compared whole. Two points whose angles to the same third
one differ by more than the greatest angle of a link are not linked, which rules out most pairs of blocks of a long chain. Only sums of links
are written, never the links.

The order of a pass is cut into blocks of BLOCK points with the first WINDOW points of the next block repeated at their end, so a label of
any size is spread over many tasks; blocks hold a bounded number of bytes. Passes run in rounds of PASSES_A_ROUND, which bounds what is
shuffled at a time. The work of counting grows with the square of a component's size, in blocks, since each of its links has to be seen.

The search is approximate in one way: two components stay apart if none of their links lies within WINDOW places in any pass. More passes
or wider windows lower that risk; tests measure it against brute force. Nothing is reported that is not a link.

Cases: vectors that are NULL, empty, zero, or hold a NULL or a non-finite number, and those with a NULL label, link with nothing. Very large and
very small numbers count as they are: every vector is divided by its largest absolute component first. Vectors of different length never
link. A row with a NULL id takes part in counts; its class has no id only if all its rows have none. Rows that share an id are separate rows.
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salestax_spark.llm.common import Scratch, number_rows
from salestax_spark.llm.components import connected_components

BITS = 48
WINDOW = 128
BLOCK = 2048
PASSES = 12
PASSES_A_ROUND = 4
#: Points of a block when links are counted, and the bytes of its vectors at most (one point at least).
COUNT_BLOCK, COUNT_BYTES = 2048, 8 << 20


def _hyperplanes(dim: int, passes: list[int], seed: int) -> np.ndarray:
    return np.concatenate([np.random.default_rng([seed, p, dim]).standard_normal((dim, BITS)) for p in passes], axis=1)


def _sort_keys(points: DataFrame, passes: list[int], seed: int) -> DataFrame:
    """One row per point and pass: pass, sort_key, and the columns of ``points``."""

    @F.pandas_udf("array<bigint>")
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        planes: dict[int, np.ndarray] = {}
        weights = (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)).astype(np.int64)
        for vectors in batches:
            out: list[np.ndarray] = [np.empty(0, np.int64)] * len(vectors)
            sizes = np.array([len(v) for v in vectors])
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                if dim not in planes:
                    planes[dim] = _hyperplanes(int(dim), passes, seed)
                signs = (np.stack([np.asarray(vectors.iloc[i], np.float64) for i in rows]) @ planes[dim]) > 0
                values = signs.reshape(len(rows), len(passes), BITS) @ weights
                for i, value in zip(rows, values, strict=True):
                    out[i] = value
            yield pd.Series(out)

    keyed = points.withColumn("_keys", keys("vector"))
    return keyed.select("*", F.posexplode("_keys").alias("pass", "sort_key")).drop("_keys")


def _least_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the least one it reaches over the links (i, j)."""
    least = np.arange(n)
    while True:
        before = least.copy()
        low = np.minimum(least[i], least[j])
        np.minimum.at(least, i, low)
        np.minimum.at(least, j, low)
        least = least[least]
        if (least == before).all():
            return least


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. Divided by the largest component first, so that no square leaves the range of doubles."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _compare_windows(block: pd.DataFrame, window: int, threshold: float) -> pd.DataFrame:
    """Edges (x, y) from points to the least point they reach over links of one label within ``window`` places.

    Only links whose first point lies in the block proper count; the next block finds the others.
    """
    block = block.sort_values("rank", kind="stable")
    proper = int((~block["repeated"]).sum())
    ids = block["point"].to_numpy()
    group = pd.factorize(pd.MultiIndex.from_arrays([block["label"], block["vector"].map(len)]))[0]
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for g in np.unique(group):
        rows = np.flatnonzero(group == g)
        x = _unit(np.stack([np.asarray(v, np.float64) for v in block["vector"].iloc[rows]]))
        for a in range(0, len(rows), window):
            i, j = np.nonzero(x[a : a + window] @ x[a : a + 2 * window].T >= threshold)
            keep = (j > i) & (j - i <= window) & (rows[a + i] < proper)
            left.append(rows[a + i[keep]])
            right.append(rows[a + j[keep]])
    i, j = np.concatenate(left), np.concatenate(right)
    # Places in order of the points' names, so that the least place is the least name.
    by_name = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[by_name] = np.arange(len(ids))
    least = _least_reached(len(ids), place[i], place[j])
    moved = np.flatnonzero(least != np.arange(len(ids)))
    names = ids[by_name]
    return pd.DataFrame({"x": names[least[moved]], "y": names[moved]})


def _window_edges(points: DataFrame, passes: list[int], window: int, threshold: float, seed: int, scratch: Scratch) -> DataFrame:
    order = [F.col(c) for c in ("pass", "label", "sort_key", "point")]
    name = f"sorted-{passes[0]}"
    ranked = number_rows(_sort_keys(points, passes, seed), order, "rank", scratch, name)
    block = F.floor(F.col("rank") / BLOCK)
    homes = F.when(
        (F.pmod("rank", F.lit(BLOCK)) < window) & (F.col("rank") >= BLOCK), F.array(block, block - 1)
    ).otherwise(F.array(block))
    dealt = ranked.select("pass", "label", "point", "vector", "rank", block.alias("own"), F.explode(homes).alias("block"))
    dealt = dealt.withColumn("repeated", F.col("own") != F.col("block"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_compare_windows(p, window, threshold) for _, p in pdf.groupby("pass")]
        return pd.concat(parts)

    edges = dealt.groupBy("block").applyInPandas(compare, "x string, y string").distinct()
    edges = scratch.write(f"edges-{passes[0]}", edges)
    scratch.drop(name)
    return edges


def _angle_to(pivot: str, vector: str) -> Column:
    @F.pandas_udf(T.DoubleType())
    def angle(pivots: pd.Series, vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors))
        for k, (p, v) in enumerate(zip(pivots, vectors, strict=True)):
            both = _unit(np.stack([np.asarray(p, np.float64), np.asarray(v, np.float64)]))
            out[k] = math.acos(min(1.0, max(-1.0, float(both[0] @ both[1]))))
        return pd.Series(out)

    return angle(pivot, vector)


class _Points:
    """One packed block: an array of structs in one Arrow value."""

    def __init__(self, table: pa.Table, column: str):
        items = table.column(column).combine_chunks().flatten()
        self.name = pc.struct_field(items, "point")
        self.root = pc.struct_field(items, "root").to_numpy(zero_copy_only=False).astype(str)
        self.copies = pc.struct_field(items, "copies").to_numpy(zero_copy_only=False)
        flat = np.asarray(pc.struct_field(items, "vector").flatten().to_numpy(zero_copy_only=False), np.float64)
        self.vector = _unit(flat.reshape(len(self.copies), -1))


def _count_cell(table: pa.Table, threshold: float) -> pa.Table:
    """Linked copies of every point of two blocks, or of one block with itself."""
    one, other = _Points(table, "these"), _Points(table, "those")
    same = table.column("this")[0].as_py() == table.column("that")[0].as_py()
    roots = np.unique(np.concatenate([one.root, other.root]), return_inverse=True)[1]
    linked = one.vector @ other.vector.T >= threshold
    linked &= roots[: len(one.root), None] == roots[None, len(one.root) :]
    if same:
        np.fill_diagonal(linked, False)
    found = [(one.name, linked @ other.copies)] + ([] if same else [(other.name, one.copies @ linked)])
    parts = [pa.table({"point": name, "linked": pa.array(sums.astype(np.int64))}).filter(pa.array(sums > 0)) for name, sums in found]
    return pa.concat_tables(parts)


def _count_links(members: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """(point, root, copies, vector) of all points of components to (point, linked): copies of the other points linked with it."""
    pivots = members.where(F.col("point") == F.col("root")).select("root", F.col("vector").alias("pivot"))
    angled = members.join(pivots, "root").withColumn("angle", _angle_to("pivot", "vector")).drop("pivot")
    # Vectors of one component have one length, those of one block as well.
    dim = F.size("vector").alias("dim")
    ranked = number_rows(angled.select("*", dim), [F.col(c) for c in ("dim", "root", "angle", "point")], "rank", scratch, "by-angle")
    per_block = F.greatest(F.lit(1), F.least(F.lit(COUNT_BLOCK), F.call_function("div", F.lit(COUNT_BYTES), 8 * F.col("dim"))))
    block = F.struct("dim", F.call_function("div", F.col("rank"), per_block).alias("block"))
    placed = ranked.select(block.alias("block"), "point", "root", "copies", "vector", "angle")
    spans = placed.groupBy("root", "block").agg(F.min("angle").alias("low"), F.max("angle").alias("high"))
    spans = scratch.write("spans", spans)
    reach = math.acos(threshold) + 1e-6
    later = spans.select("root", F.col("block").alias("that"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    # One row per pair of blocks that have to be compared: as many as comparisons, few beside the rows of a block.
    meeting = spans.withColumnRenamed("block", "this").join(later, "root").where("this <= that")
    meeting = meeting.where((F.col("_low") - F.col("high") <= reach) & (F.col("low") - F.col("_high") <= reach)).select("this", "that").distinct()
    packed = placed.groupBy("block").agg(F.collect_list(F.struct("point", "root", "copies", "vector")).alias("points"))
    packed = scratch.write("blocks", packed)
    cells = meeting.join(packed.select(F.col("block").alias("this"), F.col("points").alias("these")), "this")
    cells = cells.join(packed.select(F.col("block").alias("that"), F.col("points").alias("those")), "that")
    counted = cells.groupBy("this", "that").applyInArrow(lambda table: _count_cell(table, threshold), "point string, linked long")
    return counted.groupBy("point").agg(F.sum("linked").alias("linked"))


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = 0.98,
    passes: int = PASSES,
    window: int = WINDOW,
    seed: int = 3,
) -> DataFrame:
    """Per row of ``vectors``: its id, n_links, component_id and kept."""
    scratch = Scratch(vectors.sparkSession, "vectors")
    vector = F.col("vector")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = vector.isNotNull() & F.col("label").isNotNull() & finite & F.exists(vector, lambda v: v != 0)
    rows = vectors.select(
        F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # 128 bits over label and vector name a point, with -0.0 as 0.0.
    plain = F.transform("vector", lambda v: v + F.lit(0.0))
    name = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), "label", plain)), 16, "0") for k in range(2)])
    named = rows.withColumn("point", F.when(F.col("usable"), name))
    narrow = scratch.write("rows", named.select("vec_id", "point"))
    points = named.where("usable").groupBy("point").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    counts = narrow.where("point is not null").groupBy("point").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    points = scratch.write("points", points)
    counts = scratch.write("counts", counts)
    rounds = [list(range(p, min(p + PASSES_A_ROUND, passes))) for p in range(0, passes, PASSES_A_ROUND)]
    found = [_window_edges(points, r, window, threshold, seed, scratch) for r in rounds]
    edges = scratch.write("edges", reduce(DataFrame.unionByName, found).distinct())
    components = connected_components(edges, "vector-components")
    rooted = counts.join(components.select(F.col("node").alias("point"), "root"), "point", "left")
    rooted = scratch.write("rooted", rooted)
    members = rooted.where("root is not null").join(points.select("point", "vector"), "point").select("point", "root", "copies", "vector")
    links = scratch.write("links", _count_links(members, threshold, scratch))
    # Both sides of the join below are plain written tables, so that the tasks of a large component can be split.
    rooted = scratch.write("in-components", rooted.select("point", "copies", "least", F.coalesce("root", "point").alias("root")))
    roots = scratch.write("roots", rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    classes = (
        rooted.join(roots, "root")
        .join(links, "point", "left")
        .select("point", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    )
    classes = scratch.write("classes", classes)
    alone = narrow.where("point is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = narrow.where("point is not null").join(classes, "point").select("vec_id", "n_links", "component_id")
    result = linked.unionByName(alone)
    return result.select(
        F.col("vec_id").alias(id_column), "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
