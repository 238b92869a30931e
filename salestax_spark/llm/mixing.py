"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree, in SQL functions only.

1. Sizes: words per document and source. Targets: weights by source rank share ``share`` times all words; a target stops
   at ``max_repeat`` times its source's size and the excess is shared again, by weight, until none is above.
2. Each source gets a whole number of blocks of equal size that make up its target exactly: its quota.
3. The tree is a table of quotas by node and source. The root holds the quotas of all sources; a node deals half of its blocks to either child as
   an urn without replacement does, so the quotas of a child are multivariate hypergeometric and those of all shards add up. The blocks that go
   left are dealt in two steps: first to groups of sources by the groups' sums, then inside each group to its sources. With as many groups as
   sources in a group, no row holds more than about the root of the number of sources, however many there are.
4. The documents of a source, in pseudo-random order and repeated as often as the target asks, lie on a line of words.
   A document belongs to the block its middle falls into; a shard takes the next blocks of its quota.
5. Inside a shard the order is pseudo-random again.

A source, and a shard, of a third of all rows is cut into chunks for prefix sums (see common.prefix_sums). Sources are ranked by a sort over
ranges, their targets found by passes over a table of one row per source: no task and no row holds all of them. The plan of the mix
is made of narrow rows; texts are joined to it once, at the end.

Cases: a NULL text has size 0 and is never taken. A NULL source is a source of its own, ranked last. Rows with the same id
are separate documents; NULL ids are allowed. A document of any length is one document: it is taken whole or not. An empty table, or one
without any word, gives an empty mix. Extra columns of the input are carried along, but for those called like an output column, which
replaces them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salestax_spark.llm.common import Scratch, number_rows, others, permutation_key, prefix_sums, row_key, set_aside, word_count

WEIGHTS = (5, 2, 1)
KEY_BITS = 60
OUTPUTS = ("size", "pass", "shard", "position")


def _source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


def source_targets(
    sizes: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, max_repeat: int = 2
) -> tuple[DataFrame, float]:
    """Per source (columns _key, source, _size): _rank, source_size and target; and the sum of all targets."""
    by_source = sizes.groupBy("_key", "source").agg(F.sum("_size").alias("source_size"))
    ranked = number_rows(by_source, [F.col("source").asc_nulls_last()], "_nth", scratch, "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_nth"), len(weights)) + 1).cast("int"))
    ranked = ranked.select(
        "_key", (F.col("_nth") + 1).alias("_rank"), "source_size", weight.cast("long").alias("_weight"), (F.col("source_size") * max_repeat).alias("_cap")
    )
    ranked = scratch.write("ranked", ranked)
    total, all_weight, all_caps = ranked.agg(F.sum("source_size"), F.sum("_weight"), F.sum("_cap")).first()
    words = (total or 0) * share
    # Words per weight of the sources that are not full. The more are full, the more the others get, so this only rises, and ends.
    level, full = words / max(all_weight or 0, 1), 0
    while True:
        is_full = F.col("_cap") / F.col("_weight") < F.lit(level)
        number, caps, weight_of_full = ranked.where(is_full).agg(F.count("*"), F.sum("_cap"), F.sum("_weight")).first()
        if number == full or weight_of_full == all_weight:
            break
        level, full = (words - caps) / (all_weight - weight_of_full), number
    target = F.least(F.col("_cap").cast("double"), F.lit(level) * F.col("_weight"))
    return ranked.select("_key", "_rank", "source_size", target.alias("target")), min(words, float(all_caps or 0))


def _urn(quotas: Column, places: Column, path: Column, seed: int) -> Column:
    """How many of its blocks each entry of ``quotas`` (id, quota) sends left, if ``places`` of all blocks go there, drawn at random.

    Every block goes left with the chance of the places left there among the blocks left.
    """
    blocks = F.aggregate(quotas, F.lit(0).cast("long"), lambda total, q: total + q["quota"])
    start = F.struct(places.cast("long").alias("places"), blocks.alias("blocks"), F.array().cast("array<bigint>").alias("left"))

    def deal(state: Column, entry: Column) -> Column:
        def deal_block(inner: Column, j: Column) -> Column:
            draw = F.pmod(F.xxhash64(F.lit(seed), path, entry["id"], j), F.lit(1 << 40)) / float(1 << 40)
            goes = F.when((j > 0) & (draw * inner["blocks"] < inner["places"]), 1).otherwise(0).cast("long")
            return F.struct(
                (inner["places"] - goes).alias("places"),
                (inner["blocks"] - F.when(j > 0, 1).otherwise(0)).cast("long").alias("blocks"),
                (inner["got"] + goes).alias("got"),
            )

        first = F.struct(state["places"].alias("places"), state["blocks"].alias("blocks"), F.lit(0).cast("long").alias("got"))
        dealt = F.aggregate(F.sequence(F.lit(0).cast("long"), entry["quota"]), first, deal_block)
        return F.struct(dealt["places"].alias("places"), dealt["blocks"].alias("blocks"), F.array_append(state["left"], dealt["got"]).alias("left"))

    return F.aggregate(quotas, start, deal, lambda state: state["left"])


def _urns(seed: int) -> tuple[Column, Column]:
    """Left children of the groups of a node, and of the sources of a group; built once, since each is a large expression."""
    return (
        _urn(F.col("_groups"), F.col("_places"), F.concat(F.col("_path"), F.lit("g")), seed),
        _urn(F.col("_sources"), F.col("_places"), F.col("_path"), seed),
    )


def _split(tree: DataFrame, level: int, seed: int, urns: tuple[Column, Column]) -> DataFrame:
    """Quotas (shard, _group, _rank, _quota) of a level to those of the next one; a node's children are 2 * shard and 2 * shard + 1."""
    path = F.concat_ws("/", F.lit(str(level)), F.col("shard").cast("string"))
    entries = F.array_sort(F.collect_list(F.struct(F.col("_rank").alias("id"), F.col("_quota").alias("quota"))))
    groups = tree.groupBy("shard", "_group").agg(entries.alias("_sources"), F.sum("_quota").alias("_blocks"))
    sums = F.array_sort(F.collect_list(F.struct(F.col("_group").alias("id"), F.col("_blocks").alias("quota"))))
    nodes = groups.groupBy("shard").agg(sums.alias("_groups"), F.sum("_blocks").alias("_all")).withColumn("_path", path)
    # Of an odd number the spare block goes to a side by chance.
    spare = F.pmod(F.xxhash64(F.lit(seed), "_path", F.lit("spare")), F.lit(2))
    nodes = nodes.withColumn("_places", F.floor((F.col("_all") + spare) / 2)).withColumn("_left", urns[0])
    places = nodes.select("shard", "_path", F.explode(F.arrays_zip("_groups", "_left")).alias("_x"))
    places = places.select("shard", "_path", F.col("_x._groups.id").alias("_group"), F.col("_x._left").alias("_places"))
    dealt = groups.join(places, ["shard", "_group"]).withColumn("_left", urns[1])
    each = dealt.select("shard", "_group", F.explode(F.arrays_zip("_sources", "_left")).alias("_x"))
    left, quota = F.col("_x._left"), F.col("_x._sources.quota")
    children = F.array(
        F.struct((F.col("shard") * 2).alias("shard"), left.alias("quota")),
        F.struct((F.col("shard") * 2 + 1).alias("shard"), (quota - left).alias("quota")),
    )
    split = each.select("_group", F.col("_x._sources.id").alias("_rank"), F.explode(children).alias("_child"))
    return split.select(F.col("_child.shard").alias("shard"), "_group", "_rank", F.col("_child.quota").alias("_quota")).where("_quota > 0")


def shard_quotas(quotas: DataFrame, shards: int, seed: int, scratch: Scratch) -> DataFrame:
    """(_rank, _quota) to (shard, _rank, _quota): how many blocks of each source a shard takes; rows of 0 are left out."""
    if shards & (shards - 1):
        raise ValueError("the number of shards must be a power of two")
    width = max(1, math.isqrt(quotas.count()))
    group = F.call_function("div", F.col("_rank"), F.lit(width))
    tree = quotas.where("_quota > 0").select(F.lit(0).cast("long").alias("shard"), group.alias("_group"), "_rank", "_quota")
    urns = _urns(seed)
    for level in range(shards.bit_length() - 1):
        tree = scratch.write(f"level-{level}", _split(tree, level, seed, urns))
        if level:
            scratch.drop(f"level-{level - 1}")
    return tree.select("shard", "_rank", "_quota")


def shard_blocks(shares: DataFrame) -> DataFrame:
    """(_rank, _block, shard): a shard takes the next blocks of each source, as many as its quota."""
    before = Window.partitionBy("_rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranges = shares.withColumn("_first", F.coalesce(F.sum("_quota").over(before), F.lit(0)))
    return ranges.select("_rank", "shard", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_quota") - 1)).alias("_block"))


class Mix:
    """The plan of a mix. Sizes and quotas are written once, since several steps read them."""

    def __init__(
        self,
        docs: DataFrame,
        id_column: str = "doc_id",
        source_column: str = "source",
        text_column: str = "text",
        weights: tuple[int, ...] = WEIGHTS,
        share: float = 1.5,
        max_repeat: int = 2,
        shards: int = 64,
        blocks_per_shard: int = 64,
        seed: int = 20,
    ):
        scratch = Scratch(docs.sparkSession, "mix")
        sized = docs.select(
            *row_key(docs),
            F.col(id_column).alias("_id"),
            F.col(source_column).alias("source"),
            _source_key(source_column).alias("_key"),
            word_count(F.col(text_column)).alias("_size"),
            permutation_key(seed, F.col(id_column)).alias("_perm"),
        )
        self.sized = scratch.write("sizes", sized)
        targets, words = source_targets(self.sized, scratch, weights, share, max_repeat)
        per_block = F.lit(words / (shards * blocks_per_shard))
        some = F.greatest(F.lit(1), F.round(F.col("target") / per_block))
        quotas = targets.withColumn("_quota", F.when(F.col("target") > 0, some).otherwise(0).cast("long"))
        self.quotas = scratch.write("quotas", quotas)
        self.shares = shard_quotas(self.quotas.select("_rank", "_quota"), shards, seed, scratch)
        self.blocks = scratch.write("blocks", shard_blocks(self.shares))
        self.max_repeat, self.seed = max_repeat, seed

    def plan(self) -> DataFrame:
        """One narrow row per document taken and pass: _row, _row2, size, pass, shard, position."""
        placed = prefix_sums(
            self.sized.where(F.col("_size") > 0), "_key", "_perm", ["_id", "_row", "_row2"], F.col("_size"), "_before", KEY_BITS
        )
        lined = placed.join(self.quotas, "_key").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(self.max_repeat - 1))))
        middle = F.col("pass") * F.col("source_size") + F.col("_before") + F.col("_size") / 2
        taken = lined.withColumn("_middle", middle).where(F.col("_middle") < F.col("target"))
        block = F.least(F.floor(F.col("_middle") * F.col("_quota") / F.col("target")), F.col("_quota") - 1)
        dealt = taken.withColumn("_block", block.cast("long")).join(self.blocks, ["_rank", "_block"])
        shuffled = permutation_key(self.seed + 1, F.col("shard"), F.col("pass"), F.col("_id"))
        dealt = dealt.select("_row", "_row2", F.col("_size").alias("size"), "pass", "shard", shuffled.alias("_order"), "_id")
        local = prefix_sums(dealt, "shard", "_order", ["_id", "pass", "_row", "_row2"], F.lit(1), "_before", KEY_BITS)
        return local.select("_row", "_row2", "size", "pass", "shard", (F.col("_before") + 1).alias("position"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mix (options as in Mix): the columns of ``docs`` plus size, pass, shard and position; texts are shuffled once."""
    needed = tuple(options.get(f"{c}_column", name) for c, name in (("id", "doc_id"), ("source", "source"), ("text", "text")))
    docs, named = set_aside(docs, OUTPUTS, needed)
    once = docs.select("*", *row_key(docs)).dropDuplicates(["_row", "_row2"])
    return once.join(Mix(docs, **options).plan(), ["_row", "_row2"]).select(*others(named, OUTPUTS), *OUTPUTS)


def shard_report(docs: DataFrame, **options) -> DataFrame:
    """Per shard and source that meet: blocks the tree deals to the shard, documents and words it takes."""
    mix = Mix(docs, **options)
    key = mix.sized.select("_row", "_row2", "_key").distinct()
    words = mix.plan().join(key, ["_row", "_row2"]).join(mix.quotas.select("_key", "_rank"), "_key")
    words = words.groupBy("shard", "_rank").agg(F.count("*").alias("documents"), F.sum("size").alias("words"))
    named = mix.shares.join(words, ["shard", "_rank"], "left")
    return named.select(
        "shard", F.col("_rank").alias("source_rank"), F.col("_quota").alias("blocks"),
        F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("words", F.lit(0)).alias("words"),
    )


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, and the words the mix takes of it."""
    mix = Mix(docs, **options)
    # Equal rows share what is taken of them.
    copies = mix.sized.groupBy("_row", "_row2", F.col("_id").alias("doc_id"), "_key", F.col("_size").alias("size")).agg(
        F.count("*").alias("_copies")
    )
    taken = mix.plan().groupBy("_row", "_row2").agg(F.count("*").alias("_times"))
    joined = copies.join(taken, ["_row", "_row2"], "left").join(mix.quotas, "_key")
    times = F.coalesce("_times", F.lit(0))
    expanded = joined.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    each = F.floor(times / F.col("_copies")) + F.when(F.col("_nth") <= F.pmod(times, F.col("_copies")), 1).otherwise(0)
    return expanded.select("doc_id", "size", "source_size", "target", (each * F.col("size")).cast("long").alias("taken"))
