"""Language by compression: a text belongs to the language whose dictionary lets it be written in the fewest bytes.

Each language has a raw-content zstandard dictionary made from sampled texts of that language. Texts and samples are reduced to
lower-case words with one space between, for digits, marks and capitals say little about a language. A text is cut into blocks of
BLOCK bytes, so that a dictionary counts as much at the end of a long text as at its start, every block is compressed
with each dictionary and the sizes are added up. The smallest sum wins; if its lead over the next one, as a share of that one,
is under ``min_margin``, the text is rejected.

The sample is bounded: per language the SAMPLE_TEXTS labelled texts with the smallest hash, of each a stretch of at most
STRETCH characters, cut to DICTIONARY bytes. It is the only thing that goes through the driver: at most
MAX_LANGUAGES * SAMPLE_TEXTS * STRETCH characters; more languages are an error, not a silent choice.

Cases: a NULL text, or one without a letter, is ``und`` with score 0 and rejected. With one learned language every other text
is of that language with score 1; with none everything is ``und``. Equal sizes are decided by the language's name. Repeated rows are
judged alike. Empty tables give empty results; extra columns are carried along, but for those called like an output column, which replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salestax_spark.llm.common import others, set_aside

BLOCK = 4096
LEVEL = 5
SAMPLE_TEXTS = 256
STRETCH = 1024
DICTIONARY = 65_536
MAX_LANGUAGES = 256
UNDETERMINED = "und"
OUTPUTS = ("lang_pred", "score", "lang_rejected")


def letters_only(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{M}]+", " "))


def learn_dictionaries(
    labelled: DataFrame, lang_column: str = "lang", text_column: str = "text", order_column: str = "doc_id"
) -> dict[str, bytes]:
    """Dictionary per language, from a bounded sample of rows that have a language and a letter in their text."""
    by_hash = Window.partitionBy("lang").orderBy("_order", "piece")
    usable = labelled.where(F.col(lang_column).isNotNull() & F.col(text_column).rlike(r"\p{L}"))
    # The stretch starts at a pseudo-random place, so that openings all texts share do not fill the sample.
    room = F.greatest(F.lit(1), F.length(text_column) - STRETCH)
    begin = F.pmod(F.xxhash64(F.lit("begin"), order_column), room) + 1
    sample = (
        usable.select(
            F.col(lang_column).cast("string").alias("lang"),
            F.xxhash64(F.lit("sample"), order_column).alias("_order"),
            letters_only(F.substring(F.col(text_column), begin.cast("int"), F.lit(STRETCH))).alias("piece"),
        )
        .withColumn("_nth", F.row_number().over(by_hash))
        .where(F.col("_nth") <= SAMPLE_TEXTS)
        .groupBy("lang")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_nth", "piece"))), lambda p: p["piece"]), "\n").alias("sample"))
        .limit(MAX_LANGUAGES + 1)
        .toPandas()
    )
    if len(sample) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {lang: text.encode()[:DICTIONARY] for lang, text in zip(sample["lang"], sample["sample"], strict=True)}


class Judge:
    """Compressors of all languages, made once per task."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = sorted(dictionaries)
        self.compressors = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(dict_data=content, write_content_size=False, write_dict_id=False)
            )

    def sizes(self, raw: bytes) -> np.ndarray:
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        return np.array([sum(len(c.compress(b)) for b in blocks) for c in self.compressors], dtype=np.int64)

    def __call__(self, raw: bytes) -> tuple[str, float]:
        if not self.languages:
            return UNDETERMINED, 0.0
        sizes = self.sizes(raw)
        best = int(np.argmin(sizes))
        if len(sizes) == 1:
            return self.languages[0], 1.0
        following = int(np.partition(sizes, 1)[1])
        return self.languages[best], (following - int(sizes[best])) / following


def identify_languages(docs: DataFrame, dictionaries: dict[str, bytes], text_column: str = "text", min_margin: float = 0.002) -> DataFrame:
    """``docs`` plus lang_pred, score (the lead, 0 to 1) and lang_rejected."""

    @F.pandas_udf("lang string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        decide = Judge(dictionaries)
        for texts in batches:
            yield pd.DataFrame([(UNDETERMINED, 0.0) if t is None else decide(bytes(t)) for t in texts], columns=["lang", "score"])

    lettered = F.when(F.col(text_column).rlike(r"\p{L}"), F.encode(letters_only(F.col(text_column)), "UTF-8"))
    docs, named = set_aside(docs, OUTPUTS, (text_column,))
    judged = docs.withColumn("_judged", judge(lettered))
    return judged.select(
        *others(named, OUTPUTS),
        F.col("_judged.lang").alias("lang_pred"),
        F.col("_judged.score").alias("score"),
        ((F.col("_judged.lang") == UNDETERMINED) | (F.col("_judged.score") < min_margin)).alias("lang_rejected"),
    )


def held_out(id_column: str = "doc_id") -> Column:
    """Rows the classifier must not learn from. NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(4)) == 2
