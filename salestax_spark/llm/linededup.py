"""Repeated runs of lines, found by a suffix array over line ids; later copies are deleted. SQL functions only.

1. A line is an id (128 bits of hash), a document a sequence of the ids of its lines that have a word. Blank lines do not count.
2. Suffix array by prefix doubling. The suffixes are sorted by their first line, then by their first 2, 4, 8 ... lines: the rank of the first
   2**k lines is the place of the pair of ranks of its two halves among all pairs, sorted over ranges whose sizes are carried on as offsets.
   So equal ranks are equal prefixes, and a smaller rank is a smaller prefix in the order of line ids. Only suffixes whose prefix occurs
   more than once stay, so the tables shrink with every step.
3. Longest-common-prefix intervals. Suffixes of one rank at level k lie next to each other in the suffix array and share 2**k lines at least. For
   any number of lines l between two powers, the interval of suffixes that share their first l lines is that of two ranks of the lower
   power, of the first 2**k and of the last 2**k of the l lines, which overlap. A run of l lines counts if it has at least ``min_words``
   words. Every such repeated run is covered by the shortest runs of ``min_words`` words that begin or end at one of its lines, and
   these have no more than ``min_words`` lines: doubling ends there, however long the documents are.
4. In every interval the copy that comes first, by doc_id and line, stays; the lines of all others go. Runs that overlap or touch
   make one maximal run.

Hot lines are counted before they are shuffled, and joined tables are read from written ones, so that Spark can
split the tasks of a line that a third of all documents hold. Ranks are numbers of whole tables: only pairs that occur more than once are sorted.

Cases: a NULL text stays NULL, an empty one empty. A run may repeat within one document. Rows with equal id and text are one document and
lose the same lines. NULL ids come first. Lines are compared as they are, end of line is ``\\n``. Blank lines go only inside a
deleted run. Empty tables give empty results; extra columns are carried along, but for those called like an output column, which replaces them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salestax_spark.llm.common import WORD, Scratch, number_rows, others, set_aside

MIN_WORDS = 20
OUTPUTS = ("n_lines", "removed_runs")


def _document_key(id_column: str, text_column: str) -> Column:
    """128 bits over id and text; NULL for a NULL text."""
    name = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    kind = F.when(F.col(id_column).isNull(), "n").otherwise("i")
    return F.unhex(F.md5(F.concat(kind, F.char_length(name).cast("string"), F.lit(":"), name, F.col(text_column))))


def _lines(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """_doc, _id, _i (number among the lines with words), _pos (line number), _line, _line2, _words, _end (words up to here)."""
    measured = F.transform(
        F.split(F.col(text_column), "\n"),
        lambda line, i: F.struct(
            i.alias("pos"),
            F.xxhash64(line).alias("line"),
            F.xxhash64(F.lit(1), line).alias("line2"),
            F.regexp_count(line, F.lit(WORD)).cast("long").alias("words"),
        ),
    )
    wordy = F.filter(measured, lambda line: line["words"] > 0)
    once = (
        docs.where(F.col(text_column).isNotNull())
        .select(_document_key(id_column, text_column).alias("_doc"), F.col(id_column).alias("_id"), wordy.alias("_all"))
        .dropDuplicates(["_doc"])
    )
    rows = once.select("_doc", "_id", F.posexplode("_all").alias("_i", "_x"))
    running = Window.partitionBy("_doc").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(
        "_doc", "_id", "_i", F.col("_x.pos").alias("_pos"), F.col("_x.line").alias("_line"), F.col("_x.line2").alias("_line2"), F.col("_x.words").alias("_words"),
        F.sum("_x.words").over(running).alias("_end"),
    )


def _shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(_doc, _id, _start, _length): for every line the shortest run of min_words words that begins, and that ends, there."""
    begin = F.col("_end") - F.col("_words")
    spaced = lines.withColumn("_begin", begin)
    ahead = Window.partitionBy("_doc").orderBy("_begin").rangeBetween(0, min_words - 1)
    behind = Window.partitionBy("_doc").orderBy("_end").rangeBetween(1 - min_words, 0)
    sized = spaced.select(
        "_doc", "_id", "_i", "_begin", "_end",
        F.count("*").over(ahead).alias("_ahead"), F.max("_end").over(ahead).alias("_reach"),
        F.count("*").over(behind).alias("_behind"), F.min("_begin").over(behind).alias("_from"),
    )
    runs = F.array(
        F.when(F.col("_reach") - F.col("_begin") >= min_words, F.struct(F.col("_i").alias("s"), F.col("_ahead").alias("n"))),
        F.when(
            F.col("_end") - F.col("_from") >= min_words,
            F.struct((F.col("_i") - F.col("_behind") + 1).cast("int").alias("s"), F.col("_behind").alias("n")),
        ),
    )
    both = sized.select("_doc", "_id", F.explode(F.array_distinct(F.filter(runs, lambda r: r.isNotNull()))).alias("_r"))
    return both.select("_doc", "_id", F.col("_r.s").alias("_start"), F.col("_r.n").cast("int").alias("_length"))


def _sorted_ranks(pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(_doc, _i, _first, _second) to (_doc, _i, _rank) of the rows whose pair occurs more than once: its place among these pairs, sorted."""
    rows = scratch.write(f"{name}-all", pairs)
    often = rows.groupBy("_first", "_second").agg(F.count("*").alias("_n")).where("_n > 1").select("_first", "_second")
    often = scratch.write(f"{name}-often", often)
    places = number_rows(often, [F.col("_first"), F.col("_second")], "_rank", scratch, f"{name}-sorted")
    kept = scratch.write(name, rows.join(places, ["_first", "_second"]).select("_doc", "_i", "_rank"))
    scratch.drop(f"{name}-all", f"{name}-often", f"{name}-sorted")
    return kept


def doubled_ranks(lines: DataFrame, longest: int, scratch: Scratch) -> list[DataFrame]:
    """Level k: (_doc, _i, _rank) of every suffix whose first 2**k lines occur more than once, up to 2**k <= longest.

    Ranks are in the order of these lines' ids, and without a gap.
    """
    levels = [_sorted_ranks(lines.select("_doc", "_i", F.col("_line").alias("_first"), F.col("_line2").alias("_second")), scratch, "ranks-0")]
    while 2 ** len(levels) <= longest:
        k = len(levels)
        half = levels[-1]
        second = half.select("_doc", (F.col("_i") - 2 ** (k - 1)).alias("_i"), F.col("_rank").alias("_second"))
        pairs = half.join(second, ["_doc", "_i"]).select("_doc", "_i", F.col("_rank").alias("_first"), "_second")
        levels.append(_sorted_ranks(pairs, scratch, f"ranks-{k}"))
    return levels


def repeated_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Maximal runs to delete: _doc, from_line, to_line (line numbers from 0, inclusive)."""
    scratch = Scratch(docs.sparkSession, "lines")
    lines = scratch.write("lines", _lines(docs, id_column, text_column))
    runs = scratch.write("runs", _shortest_runs(lines, min_words))
    longest = runs.agg(F.max("_length")).first()[0] or 0
    levels = doubled_ranks(lines, longest, scratch) if longest else []
    named = []
    for k, ranks in enumerate(levels):
        own = runs.where((F.col("_length") >= 2**k) & (F.col("_length") < 2 ** (k + 1)))
        first = ranks.select("_doc", F.col("_i").alias("_start"), F.col("_rank").alias("_a"))
        found = own.join(first, ["_doc", "_start"])
        if k == 0:
            found = found.withColumn("_b", F.col("_a"))
        else:
            last = ranks.select("_doc", (F.col("_i")).alias("_tail"), F.col("_rank").alias("_b"))
            found = found.withColumn("_tail", F.col("_start") + F.col("_length") - 2**k).join(last, ["_doc", "_tail"])
        named.append(found.select("_doc", "_id", "_start", "_length", "_a", "_b"))
    if not named:
        empty = lines.limit(0)
        return empty.select("_doc", F.col("_pos").alias("from_line"), F.col("_pos").alias("to_line"))
    # An interval of the suffix array: its number of lines and the ranks of their first and last 2**k.
    interval = ["_length", "_a", "_b"]
    members = scratch.write("members", reduce(DataFrame.unionByName, named))
    place = F.struct("_id", "_doc", "_start")
    intervals = members.groupBy(*interval).agg(F.min(place).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    intervals = scratch.write("intervals", intervals.select(*interval, "_first"))
    later = members.join(intervals, interval).where(~F.col("_first").eqNullSafe(place))
    gone = later.select("_doc", F.explode(F.sequence(F.col("_start"), F.col("_start") + F.col("_length") - 1)).alias("_i")).distinct()
    island = F.col("_i") - F.row_number().over(Window.partitionBy("_doc").orderBy("_i"))
    placed = gone.join(lines.select("_doc", "_i", "_pos"), ["_doc", "_i"])
    return (
        placed.withColumn("_island", island)
        .groupBy("_doc", "_island")
        .agg(F.min("_pos").alias("from_line"), F.max("_pos").alias("to_line"))
        .select("_doc", "from_line", "to_line")
    )


def delete_repeated_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with the text shortened, plus n_lines and removed_runs (array of from_line, to_line)."""
    docs, named = set_aside(docs, OUTPUTS, (id_column, text_column))
    runs = repeated_runs(docs, id_column, text_column, min_words)
    by_document = runs.groupBy("_doc").agg(F.array_sort(F.collect_list(F.struct("from_line", "to_line"))).alias("_runs"))
    keyed = docs.withColumn("_doc", _document_key(id_column, text_column))
    joined = keyed.join(by_document, "_doc", "left")
    lines = F.split(F.col(text_column), "\n")
    removed = F.coalesce(F.col("_runs"), F.array().cast("array<struct<from_line:int,to_line:int>>"))

    def stretch(run: Column, k: Column) -> Column:
        """The lines between the run before and this one."""
        start = F.when(k == 0, 0).otherwise(F.get("_removed", k - 1)["to_line"] + 1)
        return F.slice("_lines", start + 1, run["from_line"] - start)

    rest_from = F.coalesce(F.element_at(F.col("_runs"), -1)["to_line"] + 1, F.lit(0))
    rest = F.slice("_lines", rest_from + 1, F.greatest(F.lit(0), F.size("_lines") - rest_from))
    shorter = F.array_join(F.concat(F.flatten(F.transform("_removed", stretch)), rest), "\n")
    cut = joined.withColumn("_lines", lines).withColumn("_removed", removed)
    text = F.when(F.col("_runs").isNull(), F.col(text_column)).otherwise(shorter)
    return cut.select(
        *others(named | {text_column: text.alias(text_column)}, OUTPUTS),
        F.coalesce(F.size("_lines"), F.lit(0)).alias("n_lines"),
        F.col("_removed").alias("removed_runs"),
    )
