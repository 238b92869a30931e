"""Spelling variants of words by permuterm rotations, in SQL functions only.

A word of length L gets a terminator and is rotated to every place. Written as a prefix that ends in front of the edited place::

    word  abcd$                full rotations:  abcd$  bcd$a  cd$ab  d$abc  $abcd
    edited character skipped:  bcd$  (a)        cd$a  (b)     d$ab  (c)     $abc  (d)

Words that differ by one replaced character share the prefix that skips it; a word that lacks this character has that very prefix as
a full rotation. So all rotations are sorted by their prefix, words with the same prefix lie next to each other, and any two of
them are exactly one edit apart. A scan over the groups emits for every member how many others it has and the best of them, never all pairs.
In a run of equal characters several places give the same shorter word; only the first place of the run counts for a pair.

A group holds a prefix's shorter word and at most one word per character of the alphabet. Words are numbered by code points first and
travel as numbers; a prefix longer than LONG is named by its MD5, so a rotation takes a bounded number of bytes however long the word is.

A word's form is its near word with the largest count, if that is at least ``factor`` times its own (ties: the first by code points). Counts
at least double from word to form, so chains end within 63 steps; roots are found by doubling pointers, at most 6 joins.

Cases: NULL and empty texts have no words. Repeated rows count each. A NULL id is written as nothing in front of the colon. Empty tables give
empty results; extra columns are ignored. Words of any length take part; the work for a word grows with the square of its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salestax_spark.llm.common import Scratch, number_rows

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = r"[a-zÀ-ÿ]+"
TERMINATOR = "$"
LONG = 48
FULL, FIRST_OF_RUN, LATER_OF_RUN = 0, 1, 2


def edited_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", every: int = 97) -> DataFrame:
    """One row (word) per maximal run of letters; where ``every`` divides the hash of id and run, the run lacks one code point."""
    run = F.explode(F.regexp_extract_all(F.translate(text_column, UPPER, LOWER), F.lit(RUN), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("_id"), run.alias("_run"))
    hashed = runs.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "_run")))
    place = F.pmod("_h", F.char_length("_run")).cast("int")
    shorter = F.concat(F.substring("_run", F.lit(1), place), F.substring("_run", place + 2, F.char_length("_run")))
    return hashed.select(F.when(F.col("_h") % every == 0, shorter).otherwise(F.col("_run")).alias("word"))


def frequent_words(words: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n)"""
    long_enough = words.where(F.char_length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def rotations(numbered: DataFrame) -> DataFrame:
    """(word, n, id) to one row per rotation: prefix, id, n and what lies behind the prefix (FULL: nothing)."""
    length = F.char_length("word")
    turned = numbered.select("*", F.explode(F.sequence(F.lit(0), 2 * length)).alias("_k"))
    # 0 to L: full rotations; L + 1 to 2 L: place k - L is skipped.
    full = F.col("_k") <= length
    place = F.when(full, F.col("_k")).otherwise(F.col("_k") - length)
    head = F.when(full, place).otherwise(place - 1)
    word = F.col("word")
    prefix = F.concat(F.substring(word, place + 1, length), F.lit(TERMINATOR), F.substring(word, F.lit(1), head))
    repeats = (place > 1) & (F.substring(word, place, F.lit(1)) == F.substring(word, place - 1, F.lit(1)))
    kind = F.when(full, FULL).when(repeats, LATER_OF_RUN).otherwise(FIRST_OF_RUN)
    key = F.when(F.char_length(prefix) <= LONG, prefix).otherwise(F.concat(F.lit(TERMINATOR * 2), F.md5(prefix), F.char_length(prefix).cast("string")))
    return turned.select(key.alias("prefix"), "id", "n", kind.cast("byte").alias("kind"))


def neighbours(numbered: DataFrame) -> DataFrame:
    """(word, n, id) to (id, n_near, best_id, best_n) of every word that has a near one."""
    in_order = rotations(numbered).repartitionByRange("prefix")
    ranked = Window.partitionBy("prefix").orderBy(F.col("n").desc(), F.col("id"))
    group = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def number(*kinds: int) -> Column:
        return F.count(F.when(F.col("kind").isin(*kinds), 1)).over(group)

    one = F.struct((-F.col("n")).alias("less"), F.col("id").alias("id"))
    scanned = in_order.select(
        "id",
        "kind",
        number(FULL).alias("_full"),
        number(FIRST_OF_RUN).alias("_first"),
        number(FIRST_OF_RUN, LATER_OF_RUN).alias("_skipping"),
        F.when(F.row_number().over(ranked) == 1, F.lead(one).over(ranked)).otherwise(F.first(one).over(group)).alias("_best"),
    )
    near = (
        F.when(F.col("kind") == FULL, F.col("_first"))
        .when(F.col("kind") == FIRST_OF_RUN, F.col("_skipping") - 1 + F.col("_full"))
        .otherwise(F.col("_skipping") - 1)
    )
    emitted = scanned.select("id", near.alias("_near"), "_best").where(F.col("_near") > 0)
    best = emitted.groupBy("id").agg(F.sum("_near").alias("n_near"), F.min("_best").alias("_best"))
    return best.select("id", "n_near", F.col("_best.id").alias("best_id"), (-F.col("_best.less")).alias("best_n"))


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, form_id) of all words with a form to (id, root_id)."""
    pointers, name = scratch.write("pointers", forms.select("id", F.col("form_id").alias("root_id"))), "pointers"
    for k in range(64):
        further = pointers.select(F.col("id").alias("root_id"), F.col("root_id").alias("_further"))
        moved = pointers.join(further, "root_id", "left").select(
            "id", F.coalesce("_further", "root_id").alias("root_id"), F.col("_further").isNotNull().alias("_moved")
        )
        moved = scratch.write(f"pointers-{k}", moved)
        scratch.drop(name)
        pointers, name = moved.select("id", "root_id"), f"pointers-{k}"
        if moved.where("_moved").isEmpty():
            return pointers
    raise RuntimeError("forms do not end")


def spelling_variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """(word, n), each word once, to word, n, n_near, form, form_n and root."""
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.write("words", words.select("word", "n"))
    numbered = scratch.write("ids", number_rows(words, [F.col("word")], "id", scratch))
    near = scratch.write("near", neighbours(numbered))
    found = numbered.join(near, "id", "left").withColumn("form_id", F.when(F.col("best_n") >= factor * F.col("n"), F.col("best_id")))
    found = scratch.write("found", found)
    roots = _roots(found.where("form_id IS NOT NULL").select("id", "form_id"), scratch)
    form = numbered.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = numbered.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    with_form = found.drop("best_id", "best_n").join(form, "form_id", "left").join(roots, "id", "left").join(root, "root_id", "left")
    return with_form.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")
    )
