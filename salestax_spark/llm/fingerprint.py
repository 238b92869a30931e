"""Document fingerprints by consistent weighted sampling, in SQL functions only.

The terms of a document are its words in lower case, their weights how often they occur. For sample ``k`` and term ``t`` three
numbers come from one hash of ``t`` and ``k``: r and c of a gamma distribution with shape 2, and b, uniform. With weight ``w``::

    q = floor(ln(w) / r + b);    ln a = ln(c) - r * (q - b) - r

The sample is the (term, q) with the least ``a``. Two documents have the same sample with a probability equal to their generalised
Jaccard similarity: the sum of the lesser weights over the sum of the greater ones. A fingerprint is SAMPLES samples of
NAME_BITS bits, in hexadecimal; likeness is the share of equal ones. Its standard error is at most 0.5 / sqrt(SAMPLES), 0.051, and different
samples look equal once in 256 times.

r and ln(c) are read off tables of quantiles, because logarithms were most of the time of a draw: CELLS equal shares of the
distribution, each by its middle, and where the end of it counts (large r, small c) that cell is divided once more. For weights that are all
1, any table gives exactly Jaccard's likeness; for others it is a sum in place of the integral over r and c.

The least value is kept as one whole number, ln(a) in its upper and the sample's name in its lower bits, so the samples of a
document come from plain minima. Documents are dealt by id once; counting terms and taking minima need no further shuffle. Samples depend on
term and weight alone, so a term that weighs the same in several columns is drawn for once, with bits for these columns, and the minima of
equal bits are brought together by column at the end; logarithms are taken once a term, before it is repeated for its samples.

Cases: a document without words (NULL, empty or blank text) has the fingerprint of zeros; two such documents have likeness 1. Rows that share
an id are documents of their own, one after the other in order of a hash; equal rows as well. A NULL id comes first. Ids are of any
type that can be ordered. A text of any length is one row of its own; its words are counted by many rows. Empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestax_spark.llm.common import WORD, Scratch, number_rows, row_hash

SAMPLES = 96
#: Samples whose minima one row updates; the rows of a term are repeated SAMPLES / TOGETHER times. The generated method has some 1,200
#: bytes for each, and one of more than 8,000 is not compiled, which makes it ten times slower.
TOGETHER = 3
NAME_BITS = 8
DIGITS = NAME_BITS // 4
#: ln(a) is stored as (ln(a) + SHIFT) * SCALE; it lies between about -60 and 10.
SHIFT, SCALE = 128.0, float(1 << 40)
#: Bits of a hash, from the top: cell of c, part of its first cell; cell of r, part of its last cell; b, whose last ones also name the term.
CELL_BITS, B_BITS = 10, 24
CELLS = 1 << CELL_BITS


def _quantiles(share: np.ndarray, upper: bool) -> np.ndarray:
    """Where a gamma distribution with shape 2 reaches ``share``, counted from below or from above; by bisection."""
    low, high = np.zeros(len(share)), np.full(len(share), 64.0)
    for _ in range(80):
        middle = (low + high) / 2
        above = (1 + middle) * np.exp(-middle)
        small = above > share if upper else -np.expm1(np.log1p(middle) - middle) < share
        low, high = np.where(small, middle, low), np.where(small, high, middle)
    return (low + high) / 2


@functools.cache
def _table(of_r: bool) -> str:
    """Middles of equal shares, then of those of the end cell, as r * SCALE or (ln(c) + SHIFT) * SCALE, with blanks between them."""
    middles = (np.arange(CELLS) + 0.5) / CELLS
    if of_r:
        value = np.concatenate([_quantiles(middles, upper=False), _quantiles(middles / CELLS, upper=True)]) * SCALE
    else:
        value = (np.log(_quantiles(np.concatenate([middles, middles / CELLS]), upper=False)) + SHIFT) * SCALE
    return " ".join(map(repr, value.tolist()))


def _look_up(of_r: bool, cell: Column, part: Column) -> Column:
    """``part`` counts from the end of the distribution. The table is a constant, folded once."""
    table = F.split(F.lit(_table(of_r)), " ").cast("array<double>")
    return F.coalesce(table[F.when(cell == (CELLS - 1 if of_r else 0), part.bitwiseOR(F.lit(CELLS))).otherwise(cell)], F.lit(0.0))


def _groups(samples: int) -> int:
    return -(-samples // TOGETHER)


def _bits(word: Column, above: int, count: int) -> Column:
    """``count`` bits of a long that lie over its last ``above`` ones."""
    return F.shiftrightunsigned(word, above).bitwiseAND(F.lit((1 << count) - 1))


def _distinct_weights(weights: list[str]) -> Column:
    """An array with an entry for each weight column: ln of the weight, times SCALE, and ``of``, with a bit for each column of that weight.

    NULL stands in it for a weight of 0 or NULL, and for one that an earlier column has as well. A term without any weight has an entry for no
    column, which keeps its key.
    """
    absent = F.lit(True)
    for w in weights:
        absent &= F.coalesce(F.col(w) <= 0, F.lit(True))
    entries = [F.when(absent, F.struct(F.lit(0.0).alias("ln"), F.lit(0).alias("of")))]
    for i, w in enumerate(weights):
        of = F.lit(1 << i)
        for j in range(i + 1, len(weights)):
            of = of.bitwiseOR(F.when(F.col(w) == F.col(weights[j]), F.lit(1 << j)).otherwise(F.lit(0)))
        is_new = F.col(w) > 0
        for earlier in weights[:i]:
            is_new &= ~F.col(w).eqNullSafe(F.col(earlier))
        entries.append(F.when(is_new, F.struct((F.log(F.col(w).cast("double")) * SCALE).alias("ln"), of.alias("of"))))
    return F.array(*entries)


def weighted_samples(counts: DataFrame, keys: list[str], weights: list[str], samples: int = SAMPLES, seed: int = 7) -> DataFrame:
    """``counts``: one row per key and term (a long) with one or more weight columns. Result: keys, one fingerprint per weight column.

    ``samples`` is rounded up to a multiple of TOGETHER. The fingerprint column of weight ``w`` is ``w_fingerprint``. A weight of 0 or NULL means that the term is absent. Keys without any
    weight over 0 in a column have NULL there.
    """
    js, sides = range(TOGETHER), len(weights)
    weighed = counts.select(*keys, "term", F.explode(_distinct_weights(weights)).alias("_e")).where("_e IS NOT NULL")
    weighed = weighed.select(*keys, "term", *[F.coalesce(F.col(f"_e.{x}"), F.lit(none)).alias(f"_{x}") for x, none in (("ln", 0.0), ("of", 0))])
    dealt = weighed.withColumn("_group", F.explode(F.array(*[F.lit(g) for g in range(_groups(samples))])))
    at = F.shiftleft("_group", sides).bitwiseOR(F.col("_of")).alias("_at")
    kept = [*keys, "_at", "_ln"]
    salted = dealt.select(*keys, at, "_ln", F.col("term").bitwiseXOR(F.xxhash64(F.lit(seed), "_group")).alias("_t"))
    hashed = salted.select(*kept, *[F.xxhash64(F.col("_t").bitwiseXOR(F.xxhash64(F.lit(seed + 1), F.lit(j)))).alias(f"_h{j}") for j in js])
    found, h = hashed, [F.col(f"_h{j}") for j in js]
    for which, of_r, above in (("r", True, B_BITS), ("c", False, B_BITS + 2 * CELL_BITS)):
        read = [_look_up(of_r, _bits(x, above + CELL_BITS, CELL_BITS), _bits(x, above, CELL_BITS)) for x in h]
        found = found.select("*", *[x.alias(f"_{which}{j}") for j, x in enumerate(read)])
    mask = F.lit((1 << NAME_BITS) - 1)
    bs = [((_bits(x, 0, B_BITS) + 0.5) * (1 / (1 << B_BITS))).alias(f"_b{j}") for j, x in enumerate(h)]
    found = found.select(*kept, *[f"_{x}{j}" for j in js for x in "rc"], *bs, *[x.bitwiseAND(mask).alias(f"_t{j}") for j, x in enumerate(h)])
    found = found.select("*", *[F.floor(F.col("_ln") / F.col(f"_r{j}") + F.col(f"_b{j}")).alias(f"_q{j}") for j in js])
    wholes = []
    for j in js:
        r, c, b, term, q = (F.col(f"_{x}{j}") for x in "rcbtq")
        once = F.shiftleft(F.floor(c - r * (1 - b)), NAME_BITS).bitwiseOR(term)
        often = F.shiftleft(F.floor(c - r * (q - b) - r), NAME_BITS).bitwiseOR(term.bitwiseXOR(q.bitwiseAND(mask)))
        wholes.append(F.when(F.col("_ln") == 0, once).otherwise(often).alias(f"_v{j}"))
    minima = found.select(*keys, "_at", *wholes).groupBy(*keys, "_at").agg(*[F.min(f"_v{j}").alias(f"_m{j}") for j in js])
    minima = minima.withColumn("_group", F.shiftright("_at", sides)).groupBy(*keys, "_group").agg(
        *[F.min(F.when(F.col("_at").bitwiseAND(F.lit(1 << i)) != 0, F.col(f"_m{j}"))).alias(f"_m{j}_{w}") for i, w in enumerate(weights) for j in js]
    )
    names = [
        F.concat(*[F.lpad(F.lower(F.hex(F.col(f"_m{j}_{w}").bitwiseAND(F.lit((1 << NAME_BITS) - 1)))), DIGITS, "0") for j in js]).alias(f"_s_{w}")
        for w in weights
    ]
    pieces = minima.select(*keys, "_group", *names)

    def in_order(column: str) -> Column:
        kept = F.collect_list(F.when(F.col(column).isNotNull(), F.struct("_group", F.col(column).alias("s"))))
        return F.array_join(F.transform(F.array_sort(kept), lambda x: x["s"]), "")

    joined = [F.nullif(in_order(f"_s_{w}"), F.lit("")).alias(f"{w}_fingerprint") for w in weights]
    return pieces.groupBy(*keys).agg(*joined)


def likeness(one: Column, other: Column) -> Column:
    """Share of equal samples of two fingerprints."""
    a, b = one.cast("binary"), other.cast("binary")  # cut by bytes, not by counted characters
    starts = F.sequence(F.lit(1), F.length(one), F.lit(DIGITS))
    same = F.filter(starts, lambda i: F.substring(a, i, F.lit(DIGITS)) == F.substring(b, i, F.lit(DIGITS)))
    return F.size(same) / (F.length(one) / DIGITS)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def fingerprints(docs: DataFrame, keys: list[str], texts: list[str], samples: int = SAMPLES) -> DataFrame:
    """keys and, for each text column, ``<text>_fingerprint``. Rows should be dealt by the keys already; no key may repeat."""
    def terms(text: str, which: int) -> Column:
        return F.transform(_words(F.col(text)), lambda w: F.struct(F.lit(which).alias("which"), F.xxhash64(w).alias("term")))

    words = F.flatten(F.array(*[terms(t, i) for i, t in enumerate(texts)]))
    rows = docs.select(*keys, F.explode(words).alias("_w")).select(*keys, F.col("_w.term").alias("term"), F.col("_w.which").alias("_which"))
    counts = rows.groupBy(*keys, "term").agg(*[F.count(F.when(F.col("_which") == i, 1)).alias(t) for i, t in enumerate(texts)])
    return weighted_samples(counts, keys, texts, samples)


KEY = ("_k1", "_k2")
NEXT = ("_n1", "_n2")
#: Equal rows of one task when they are given back one by one.
COPIES = 10_000


def _chained(plain: DataFrame, scratch: Scratch) -> DataFrame:
    """Which document follows which: _k1, _k2, doc_id, n_chars, the key of the next one, and of how many equal rows this holds.

    Equal rows are one entry with a count. Of c equal rows all but the last are followed by an equal one: a second row, with the entry as its own
    successor (_own), stands for these c - 1.
    """
    narrow = plain.groupBy(*KEY, "doc_id").agg(F.first(F.char_length("text").cast("long")).alias("n_chars"), F.count("*").alias("_copies"))
    numbered = number_rows(narrow, [F.col("doc_id").asc_nulls_first(), *map(F.col, KEY)], "_place", scratch, "places")
    numbered = scratch.write("order", numbered)
    last = numbered.agg(F.max("_place")).first()[0]
    following = F.when(F.col("_place") == F.lit(last), 0).otherwise(F.col("_place") + 1)
    ahead = numbered.select(F.col("_place").alias("_next"), *[F.col(k).alias(n) for k, n in zip(KEY, NEXT, strict=True)])
    chain = numbered.withColumn("_next", following.cast("long")).join(ahead, "_next")
    rows = chain.select(*KEY, "doc_id", "n_chars", *NEXT, F.lit(False).alias("_own"), F.lit(1).cast("long").alias("_times"))
    equal = numbered.where("_copies > 1").select(
        *KEY, "doc_id", "n_chars", *[F.col(k).alias(n) for k, n in zip(KEY, NEXT, strict=True)], F.lit(True).alias("_own"), (F.col("_copies") - 1).alias("_times")
    )
    return rows.unionByName(equal)


def _one_by_one(rows: DataFrame) -> DataFrame:
    """Rows with _times of 1 as they are; others as often as that says, COPIES to a task."""
    many = rows.where("_times > 1")
    parts = F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("_times") - 1, F.lit(COPIES)))
    many = many.withColumn("_part", F.explode(parts)).repartition("_part", *KEY)
    here = F.least(F.lit(COPIES).cast("long"), F.col("_times") - F.col("_part") * COPIES)
    many = many.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), here)))
    return rows.where("_times = 1").unionByName(many.select(*rows.columns))


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every document and of its edited text, whose last quarter is replaced by the opening of the next document."""
    scratch = Scratch(docs.sparkSession, "fingerprints")
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    plain = plain.select("*", *[row_hash(F.col("doc_id"), F.col("text"), seed=k).alias(name) for k, name in enumerate(KEY)])
    chain = scratch.write("chain", _chained(plain, scratch))
    texts = plain.groupBy(*KEY).agg(F.first("text").alias("text"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    openings = texts.select(*[F.col(k).alias(n) for k, n in zip(KEY, NEXT, strict=True)], F.col("text").alias("_next_text"))
    heads = openings.join(chain, list(NEXT)).select(*chain.columns, F.substring("_next_text", F.lit(1), quarter).alias("_head"))
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - quarter).cast("int"))
    edited = texts.join(heads, list(KEY)).select(*chain.columns, "text", F.concat(kept, "_head").alias("edited"))
    key = [*KEY, "_own"]
    prints = fingerprints(edited.select(*key, "text", "edited"), key, ["text", "edited"], samples)
    facts = edited.select(*chain.columns, F.sha2(F.col("edited"), 256).alias("edited_sha256"))
    nothing = F.lit("0" * (_groups(samples) * TOGETHER * DIGITS))
    joined = facts.join(prints, key, "left").select(
        *chain.columns, "edited_sha256",
        F.coalesce("text_fingerprint", nothing).alias("fingerprint"), F.coalesce("edited_fingerprint", nothing).alias("edited_fingerprint"),
    )
    done = scratch.write("done", joined)
    nexts = done.where("not _own").select(*[F.col(k).alias(n) for k, n in zip(KEY, NEXT, strict=True)], F.col("fingerprint").alias("_next_print"))
    likened = done.join(nexts, list(NEXT)).select(
        *KEY, "_times", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next_print")).alias("near_next"),
    )
    return _one_by_one(likened).drop(*KEY, "_times")
