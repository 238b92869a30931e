"""Exact n-gram Jaccard join in metric space: which documents are linked by a Jaccard distance of at most ``1 - similarity``.

Unrelated texts are all at distance 1 of each other, so a fixed set of pivots would put nearly everything into one region. Pivots
are therefore taken where documents can be near each other, in these steps:

1. Documents with the same shingle set are one point (its class, a 64-bit hash of the set; a second hash tells whether two different sets
   got the same name, and if any did, all are named anew with another seed).
2. Regions. In any order of all shingles, two linked sets share at least one of their first ``n - ceil(s n) + 1`` shingles,
   and ``e`` more if both prefixes are longer by ``e``. A point none of whose prefix shingles, or too few of them, occur elsewhere has no
   neighbour. For every other shared prefix shingle the least point that has it is the pivot; the pivot's region is all points that
   share such a shingle with it. Linked points meet in the region of the pivot of any shingle they share. Very frequent
   shingles come last in the order, so they hardly make regions; the order changes the work, not the result.
3. Regions of up to REGION points are joined exactly, by one multiplication of their incidence matrix.
4. Larger ones are cut into pieces that also hold the region's pivots, and the pieces are joined like regions, which links most of
   a dense region in linear work. Of what is left only points of different components need comparing: those of the largest component
   stay in the window of their distance to the first pivot; all others also enter the windows next to theirs, as the
   triangle inequality asks, and each window is joined in blocks. This is complete for every distribution.

Joins emit a spanning forest of the links they find, not all pairs. Regions are dealt by plain joins of written tables, so
Spark can split hot ones. Tables of shingles and texts grow with the input and are merged, never broadcast, at any size.

Sizes: the list of frequent shingles has at most FREQUENT entries. Nothing else is gathered on the driver but counts. A task that joins regions
holds the texts of about BUCKET points or BUCKET_BYTES, whichever is less, and of one region at least; a region whose texts are longer than
POINT_BYTES each counts as one of so many more points, and is cut into pieces accordingly.

Cases: documents without words or with NULL text have no shingles and link with nothing. Fewer words than a shingle: all words are one
shingle. Repeated rows, and rows with equal ids, are one group if their texts are linked. A NULL id takes part; a group's
smallest id is NULL only if all are. An empty table gives an empty result; extra columns are ignored. Rows are named by 128 bits of id and
text. Shingles are compared by hashes of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestax_spark.llm.common import Scratch, set_aside
from salestax_spark.llm.components import connected_components
from salestax_spark.llm.shingles import Shingler

REGION = 256
PIVOTS = 16
FREQUENT = 65_536
OFTEN = 16  # documents a shingle must be counted in to be listed
BUCKET = 1500  # points a task of small regions holds, about
BUCKET_BYTES = 64 << 20  # and the bytes of their texts
POINT_BYTES = 128 << 10  # a text of a region may have without counting as several points
RING = 0.05  # slack on window borders against rounding, as a share of the distance


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """128 bits that name a row by its id and text."""
    name, text = F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.coalesce(F.col(text_column), F.lit(""))
    kinds = F.concat(F.col(id_column).isNull().cast("int").cast("string"), F.col(text_column).isNull().cast("int").cast("string"))
    return F.unhex(F.md5(F.concat(kinds, F.char_length(name).cast("string"), F.lit(":"), name, text)))


def _class(shingles: np.ndarray, seed: int) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes(), seed) - (1 << 63)


def _raw(text_column: str) -> Column:
    return F.encode(F.col(text_column), "UTF-8").alias("_raw")


def _scan(docs: DataFrame, text_column: str, words: int, seed: int) -> DataFrame:
    """kind 0: row, n, class, and a second hash to check it. kind 1: a shingle (in class) and in how many sets of a batch it occurs (in n)."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        schema = pa.schema([("kind", pa.int8()), ("row", pa.binary()), ("n", pa.int64()), ("cls", pa.int64()), ("check", pa.int64())])
        for batch in batches:
            rows, sizes, classes, checks, seen, sets = batch.column(0), [], [], [], set(), []
            for s in shingler.sets(batch.column(1).to_pylist()):
                sizes.append(len(s))
                classes.append(_class(s, seed) if len(s) else None)
                checks.append(_class(s, seed + 1000) if len(s) else None)
                if len(s) and classes[-1] not in seen:
                    seen.add(classes[-1])
                    sets.append(s)
            kinds = pa.array(np.zeros(len(rows), np.int8))
            numbers = [pa.array(column, pa.int64()) for column in (sizes, classes, checks)]
            yield pa.RecordBatch.from_arrays([kinds, rows.cast(pa.binary()), *numbers], schema=schema)
            if sets:
                values, counts = np.unique(np.concatenate(sets), return_counts=True)
                often = counts >= 3
                values, counts = values[often].view(np.int64), counts[often]
                nobody, nothing = pa.nulls(len(values), pa.binary()), pa.nulls(len(values), pa.int64())
                ones = pa.array(np.ones(len(values), np.int8))
                yield pa.RecordBatch.from_arrays([ones, nobody, pa.array(counts, pa.int64()), pa.array(values), nothing], schema=schema)

    rows = docs.select(F.col("_row"), _raw(text_column))
    return rows.mapInArrow(scan, "kind tinyint, row binary, n long, cls long, check long")


def _named(docs: DataFrame, text_column: str, words: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """The scan, and the seed by which its classes are named so that no two sets share one."""
    for seed in range(8):
        scan = scratch.write(f"scan-{seed}", _scan(docs, text_column, words, seed))
        ends = scan.where("kind = 0 and cls is not null").groupBy("cls").agg(F.min("check").alias("_low"), F.max("check").alias("_high"))
        if ends.where("_low <> _high").isEmpty():
            return scan, seed
    raise RuntimeError("sets can't be named")


def _prefixes(docs: DataFrame, text_column: str, words: int, percent: int, frequent: np.ndarray, seed: int) -> DataFrame:
    """(shingle, cls, n): the prefix of every set, once per task."""

    def prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(words), set()
        for batch in batches:
            parts, classes, sizes = [], [], []
            for s in shingler.sets(batch.column(0).to_pylist()):
                n = len(s)
                if not n or (c := _class(s, seed)) in seen:
                    continue
                seen.add(c)
                at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                late = frequent[at] == s if len(frequent) else np.zeros(n, bool)
                length = min(n, n - -(-percent * n // 100) + 1 + n // 10)
                ordered = s[~late][:length]
                if len(ordered) < length:
                    ordered = np.concatenate([ordered, s[late][: length - len(ordered)]])
                parts.append(ordered)
                classes.append(c)
                sizes.append((n, length))
            if parts:
                lengths = [length for _, length in sizes]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(parts).view(np.int64)),
                        pa.array(np.repeat(np.array(classes, np.int64), lengths)),
                        pa.array(np.repeat(np.array([n for n, _ in sizes], np.int64), lengths)),
                    ],
                    names=["shingle", "cls", "n"],
                )

    return docs.select(_raw(text_column)).mapInArrow(prefixes, "shingle long, cls long, n long")


def _shared(members: DataFrame) -> DataFrame:
    """Shingles that more than one class has, with the least of these as pivot."""
    ends = members.groupBy("shingle").agg(F.min("cls").alias("pivot"), F.max("cls").alias("_last"))
    return ends.where("pivot <> _last").select("shingle", "pivot")


def _enough(members: DataFrame, percent: int) -> DataFrame:
    """Classes with so many shared prefix shingles that a neighbour is possible."""
    least = 1 + F.floor(F.ceil(F.col("n") * percent / 100) / 10)
    counted = members.groupBy("cls", "n").agg(F.count("*").alias("_shared"))
    return counted.where(F.col("_shared") >= least).select("cls")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices of a bounded number of columns."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = counts[column] > 1
    owner, column = owner[several], column[several]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 8192
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [first, first + width])
        incidence = np.zeros((len(sets), width), np.float32)
        incidence[owner[a:b], column[a:b] - first] = 1
        out += incidence @ incidence.T
    np.fill_diagonal(out, sizes)
    return out.astype(np.int64)


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric matrix."""
    edges, todo = [], set(range(len(linked)))
    while todo:
        stack = [todo.pop()]
        while stack:
            i = stack.pop()
            near = [int(j) for j in np.flatnonzero(linked[i]) if int(j) in todo]
            edges += [(i, j) for j in near]
            todo.difference_update(near)
            stack += near
    return edges


def _joined(tasks: DataFrame, texts: DataFrame, words: int, percent: int, distances: bool) -> DataFrame:
    """tasks: (bucket, region, cls, first). Links inside each region as (region, a, b, NULL); with ``distances`` also
    (region, cls, NULL, distance to the point of the region marked ``first``)."""

    def join(table: pa.Table) -> pa.Table:
        shingler = Shingler(words)
        classes = table.column("cls").to_numpy()
        regions = table.column("region").to_numpy()
        marked = table.column("first").to_numpy(zero_copy_only=False)
        known, where = np.unique(classes, return_index=True)
        raws = table.column("_raw").take(pa.array(where)).to_pylist()
        sets = dict(zip(known.tolist(), shingler.sets(raws), strict=True))
        out: list[tuple] = []
        order = np.argsort(regions, kind="stable")
        cuts = np.flatnonzero(np.diff(regions[order])) + 1
        for rows in np.split(order, cuts):
            members = np.unique(classes[rows])
            if len(members) < 2 and not distances:
                continue
            own = [sets[c] for c in members.tolist()]
            sizes = np.array([len(s) for s in own])
            same = _overlaps(own)
            union = sizes[:, None] + sizes[None, :] - same
            linked = 100 * same >= percent * union
            np.fill_diagonal(linked, False)
            region = int(regions[rows[0]])
            out += [(region, int(members[i]), int(members[j]), None) for i, j in _forest(linked)]
            if distances:
                first = int(np.searchsorted(members, classes[rows][marked[rows]][0]))
                gaps = 1 - same[:, first] / np.maximum(union[:, first], 1)
                out += [(region, int(m), None, float(g)) for m, g in zip(members, gaps, strict=True)]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        names = ["region", "a", "b", "distance"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    loaded = tasks.join(texts.drop("size").hint("merge"), "cls").select("bucket", "region", "cls", "first", "_raw")
    return loaded.groupBy("bucket").applyInArrow(join, "region long, a long, b long, distance double")


def _dealt(tasks: DataFrame, points: int, size: int) -> DataFrame:
    """``bucket``: several small regions make one task. ``points`` and ``size``: points and bytes of all tasks."""
    return tasks.withColumn("bucket", F.pmod(F.xxhash64("region"), F.lit(max(1, points // BUCKET, size // BUCKET_BYTES))))


def _large_regions(large: DataFrame, texts: DataFrame, links: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) of regions with more than REGION points. large: (region, cls, points)."""
    # Pieces that all hold the region's pivots.
    order = F.xxhash64("cls", "region")
    pieces = F.ceil(F.col("points") / REGION).cast("long")
    keyed = scratch.write("large", large.select("region", "cls", pieces.alias("pieces"), order.alias("order")))
    # The pivot of the region and about PIVOTS more points, by hash, go with every piece.
    share = F.lit(2.0**63) * 2 * PIVOTS / (F.col("pieces") * REGION) - F.lit(2.0**63)
    is_pivot = F.col("cls") == F.col("region")
    chosen = keyed.where(is_pivot | (F.col("order").cast("double") <= share))
    piece = F.pmod(F.shiftright("order", 20), F.col("pieces"))
    name = lambda *parts: F.xxhash64("region", *parts)
    homes = keyed.select("region", "cls", piece.alias("piece"), F.lit(False).alias("first"))
    spread = chosen.select(
        "region", "cls", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"), is_pivot.alias("first")
    )
    tasks = homes.unionByName(spread).select(F.col("region").alias("whole"), name("piece").alias("region"), "cls", "first")
    tasks = scratch.write("pieces", tasks)
    found = _joined(tasks.drop("whole").withColumn("bucket", F.col("region")), texts, words, percent, distances=True)
    found = scratch.write("piece-links", found)
    star = found.where("b is not null").select("a", "b")
    so_far = connected_components(links.unionByName(star), "jaccard-first")
    wholes = tasks.select("whole", "region").distinct()
    gaps = found.where("b is null").join(wholes, "region").groupBy("whole", F.col("a").alias("cls")).agg(F.min("distance").alias("gap"))
    roots = so_far.select(F.col("node").alias("cls"), "root")
    placed = gaps.join(roots, "cls", "left").select(F.col("whole").alias("region"), "cls", "gap", F.coalesce("root", "cls").alias("root"))
    placed = scratch.write("placed", placed)
    counted = placed.groupBy("region", "root").agg(F.count("*").alias("_n"))
    most = counted.groupBy("region").agg(
        F.max(F.struct("_n", "root")).alias("_most"), F.sum("_n").alias("_points"), F.count("*").alias("_roots")
    )
    most = most.where("_roots > 1").select("region", F.col("_most.root").alias("main"), F.col("_most._n").alias("in_main"), "_points")
    most = scratch.write("most", most)
    # Windows of the distance to the first pivot, one threshold wide. Points outside the main component also enter those next to theirs.
    width = (1 - percent / 100) * (1 + RING)
    ring = F.floor(F.col("gap") / width).cast("long")
    split = placed.join(most, "region").select(
        "region", "cls", (F.col("root") == F.col("main")).alias("inside"), ring.alias("ring"),
        F.ceil(F.col("in_main") / REGION).cast("long").alias("main_blocks"),
        F.ceil((F.col("_points") - F.col("in_main")) / REGION).cast("long").alias("other_blocks"), F.xxhash64("cls", F.lit(5)).alias("order"),
    )
    rings = F.when(F.col("inside"), F.array("ring")).otherwise(F.array(F.col("ring") - 1, F.col("ring"), F.col("ring") + 1))
    split = split.select("*", F.explode(rings).alias("window"))
    # Every block of outsiders meets every block of the main component, and every block of outsiders. An outsider of another window
    # is compared there once more, which does no harm.
    main_block = F.pmod("order", F.col("main_blocks"))
    other_block = F.pmod("order", F.col("other_blocks"))
    count = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    meetings = F.when(
        F.col("inside"), F.transform(count(F.col("other_blocks")), lambda j: F.struct(F.lit(0).alias("kind"), main_block.alias("i"), j.alias("j")))
    ).otherwise(
        F.concat(
            F.transform(count(F.col("main_blocks")), lambda i: F.struct(F.lit(0).alias("kind"), i.alias("i"), other_block.alias("j"))),
            F.transform(
                count(F.col("other_blocks")),
                lambda j: F.struct(F.lit(1).alias("kind"), F.least(other_block, j).alias("i"), F.greatest(other_block, j).alias("j")),
            ),
        )
    )
    met = split.select("region", "cls", "window", F.explode(meetings).alias("_m"))
    rest = met.select(
        name("window", "_m.kind", "_m.i", "_m.j").alias("region"), "cls", F.lit(False).alias("first")
    ).withColumn("bucket", F.col("region"))
    more = _joined(scratch.write("rest", rest), texts, words, percent, distances=False)
    return scratch.write("rest-links", star.unionByName(more.select("a", "b")))


def keep_one_of_each_group(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``docs`` without all but one document of each group: the one with the smallest id stays. Repeated rows become one."""
    docs, named = set_aside(docs, (), (id_column, text_column))
    groups = jaccard_classes(docs, id_column, text_column, words, percent)
    # The group's id is that of one of its rows; of several rows with that id and other texts, one stays.
    linked = groups.where("n_shingles > 0").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    winners = linked.groupBy("component_id").agg(F.min("_row").alias("_row")).select("_row")
    wordless = groups.where("n_shingles = 0").select("_row")
    keyed = docs.withColumn("_row", row_key(id_column, text_column))
    kept = keyed.join(winners.unionByName(wordless).distinct(), "_row", "left_semi")
    return kept.dropDuplicates(["_row"]).select(*named.values())


def jaccard_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 4, percent: int = 85
) -> DataFrame:
    """_row (see row_key), doc_id, n_shingles, component_id for every row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    keyed = docs.withColumn("_row", row_key(id_column, text_column))
    scan, seed = _named(keyed, text_column, words, scratch)
    counts = scan.where("kind = 1").groupBy("cls").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
    top = counts.orderBy(F.desc("n"), "cls").limit(FREQUENT).toPandas()
    frequent = np.sort(top["cls"].to_numpy(np.int64).view(np.uint64))
    rows = scan.where("kind = 0").select("row", "n", "cls")

    prefixes = _prefixes(keyed, text_column, words, percent, frequent, seed)
    shared = scratch.write("shared", _shared(prefixes))
    members = scratch.write("members", prefixes.join(shared.select("shingle").hint("merge"), "shingle"))
    scratch.release()
    # Fewer classes make fewer shared shingles, so this is done twice.
    for step in range(2):
        alive = scratch.write(f"alive-{step}", _enough(members, percent))
        fewer = scratch.write(f"fewer-{step}", members.join(alive, "cls"))
        shared = scratch.write(f"shared-{step}", _shared(fewer))
        members = scratch.write(f"members-{step}", fewer.join(shared.select("shingle"), "shingle"))
        scratch.drop(f"fewer-{step}", f"alive-{step}", f"members-{step - 1}" if step else "members")
    alive = _enough(members, percent)
    near = scratch.write("near", members.join(alive, "cls").join(shared, "shingle").select("pivot", "cls").distinct())
    stars = scratch.write("regions", near.unionByName(near.select("pivot", F.col("pivot").alias("cls"))).distinct())
    sizes = scratch.write("sizes", stars.groupBy("pivot").agg(F.count("*").alias("points")).where("points > 1"))
    members_of = stars.join(sizes, "pivot").select(F.col("pivot").alias("region"), "cls", "points", F.lit(False).alias("first"))
    members_of = scratch.write("dealt", members_of)

    scratch.drop("near", "regions", "members-1")
    scratch.release()
    wanted = members_of.select("cls").distinct()
    chosen = rows.join(wanted, "cls").groupBy("cls").agg(F.min("row").alias("_row"))
    texts = keyed.select("_row", _raw(text_column)).join(scratch.write("chosen", chosen).hint("merge"), "_row").select("cls", "_raw")
    texts = scratch.write("texts", texts.dropDuplicates(["cls"]).withColumn("size", F.octet_length("_raw").cast("long")))
    scratch.release()

    # Long texts make a region larger than its points: see POINT_BYTES.
    heavy = texts.where(F.col("size") > POINT_BYTES).select("cls", F.call_function("div", F.col("size"), F.lit(POINT_BYTES)).alias("_more"))
    more = members_of.join(heavy, "cls").groupBy("region").agg(F.sum("_more").alias("_more"))
    weighed = members_of.join(more, "region", "left")
    regions = scratch.write("weighed", weighed.select("region", "cls", (F.col("points") + F.coalesce("_more", F.lit(0))).alias("points"), "first"))
    small = regions.where(F.col("points") <= REGION)
    held = small.join(texts.select("cls", "size"), "cls").agg(F.count("*").alias("points"), F.sum("size").alias("size")).first()
    links = _joined(_dealt(small, held.points, held.size or 0), texts, words, percent, distances=False)
    links = scratch.write("links", links.select("a", "b"))
    large = regions.where(F.col("points") > REGION).select("region", "cls", "points")
    if not large.isEmpty():
        links = links.unionByName(_large_regions(large, texts, links, words, percent, scratch))
    scratch.drop("texts")
    scratch.release()
    roots = connected_components(links, "jaccard-components").withColumnRenamed("node", "cls")

    ids = keyed.select("_row", F.col(id_column).alias("doc_id")).dropDuplicates(["_row"])
    numbered = scratch.write("rows", rows.join(ids, rows["row"] == ids["_row"]).select("_row", "doc_id", "n", "cls"))
    by_class = numbered.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
    rooted = scratch.write("rooted", by_class.join(roots, "cls", "left").select("cls", "least", F.coalesce("root", "cls").alias("root")))
    groups = scratch.write("groups", rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    classes = scratch.write("classes", rooted.join(groups, "root").select("cls", "component_id"))
    linked = numbered.where("cls is not null").join(classes, "cls").select("_row", "doc_id", "n", "component_id")
    alone = numbered.where("cls is null").select("_row", "doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumnRenamed("n", "n_shingles")
