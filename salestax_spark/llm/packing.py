"""Packing: length buckets that minimise padding, and batches of a token budget inside each bucket.

The histogram of all lengths goes to the driver, one row per distinct length. Documents of d distinct lengths hold at least d * d / 2 words, so
that is at most the root of twice the number of all words: 45,000 rows for a thousand million words, 6 million for twenty million million. Dynamic
programming over it finds the boundaries with the least padding, exactly, in whole numbers.

With k buckets the best cost up to length i is the least over j of cost(k - 1, j) + rows between j and i * length i. For a given j that is
a line in length i, and lines come in order of their slope, so each layer is one walk along the lower envelope of lines: time and memory
grow with the number of distinct lengths, not with its square.

Inside a bucket documents are numbered in pseudo-random order by chunked prefix sums, so a bucket may hold any share of
all rows; ``token_budget // bucket_length`` consecutive ones make a batch, and only the last batch of a bucket may be short.

Cases: a NULL or empty text has length 0 and is packed like any other. A document longer than the budget is a batch of its
own. Repeated rows are packed each; which of them gets which slot is open. An empty table gives an empty result. Extra columns
are carried along, but for those called like an output column, which replaces them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestax_spark.llm.common import others, permutation_key, prefix_sums, set_aside, word_count

OUTPUTS = ("length", "bucket", "bucket_length", "batch", "slot")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(_length) to (length, rows), shortest first."""
    return lengths.groupBy(F.col("_length").alias("length")).agg(F.count("*").alias("rows")).orderBy("length")


def _one_bucket_more(cost: list[int], before: list[int], lengths: list[int]) -> tuple[list[int], list[int]]:
    """Best costs with one bucket more than in ``cost``, and for each length the last one of the bucket before it (-1: no bucket before)."""
    best, choice = list(cost), [-1] * len(cost)
    envelope: list[int] = []  # lengths j whose lines are least somewhere, in order
    at = 0

    def value(j: int, i: int) -> int:
        return cost[j] + (before[i + 1] - before[j + 1]) * lengths[i]

    def useless(a: int, b: int, c: int) -> bool:
        """The line of b is nowhere below both others: c overtakes a before b does."""
        # Intersections of a with c and with b, multiplied out; slopes fall from a to c.
        return (cost[c] - cost[a]) * (before[b + 1] - before[a + 1]) <= (cost[b] - cost[a]) * (before[c + 1] - before[a + 1])

    for i in range(1, len(cost)):
        while len(envelope) >= 2 and useless(envelope[-2], envelope[-1], i - 1):
            envelope.pop()
        envelope.append(i - 1)
        at = min(at, len(envelope) - 1)
        while at + 1 < len(envelope) and value(envelope[at + 1], i) <= value(envelope[at], i):
            at += 1
        if (found := value(envelope[at], i)) < best[i]:
            best[i], choice[i] = found, envelope[at]
    return best, choice


def best_boundaries(lengths: list[int], rows: list[int], n_buckets: int) -> list[int]:
    """Bucket lengths, ascending, with the least total of padded lengths. ``lengths`` ascend, ``rows`` says how many documents have each."""
    if not lengths:
        return []
    before = [0]
    for number in rows:
        before.append(before[-1] + number)
    cost = [before[i + 1] * length for i, length in enumerate(lengths)]
    choices = []
    for _ in range(min(n_buckets, len(lengths)) - 1):
        cost, choice = _one_bucket_more(cost, before, lengths)
        choices.append(choice)
    i = len(lengths) - 1
    boundaries = [lengths[i]]
    for choice in reversed(choices):
        if choice[i] >= 0:
            i = choice[i]
            boundaries.append(lengths[i])
    return boundaries[::-1]


def pack_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    n_buckets: int = 8,
    token_budget: int = 16_384,
    seed: int = 9,
    carry_text: bool = False,
) -> DataFrame:
    """Columns of ``docs`` (the text only if asked for) plus length, bucket, bucket_length, batch and slot."""
    docs, named = set_aside(docs, OUTPUTS, (id_column, text_column))
    length = word_count(F.col(text_column))
    histogram = length_histogram(docs.select(length.alias("_length"))).toPandas()
    boundaries = best_boundaries(histogram["length"].tolist(), histogram["rows"].tolist(), n_buckets)
    if not carry_text:
        del named[text_column]
    kept = docs if carry_text else docs.drop(text_column)
    bucket = F.lit(len(boundaries) - 1)
    for k in reversed(range(len(boundaries) - 1)):
        bucket = F.when(F.col("length") <= boundaries[k], k).otherwise(bucket)
    ends = F.array(*[F.lit(b).cast("long") for b in boundaries or [0]])
    sized = docs.select(*kept.columns, length.alias("length"), permutation_key(seed, F.col(id_column)).alias("_perm"))
    sized = sized.withColumn("bucket", bucket.cast("int"))
    numbered = prefix_sums(sized, "bucket", "_perm", [id_column], F.lit(1), "_number", 60)
    bucket_length = F.get(ends, F.col("bucket"))
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.lit(1), bucket_length)))
    return numbered.select(
        *others(named, OUTPUTS),
        "length",
        "bucket",
        bucket_length.alias("bucket_length"),
        F.floor(F.col("_number") / per_batch).cast("long").alias("batch"),
        F.pmod(F.col("_number"), per_batch).cast("long").alias("slot"),
    )
