"""A corpus pipeline: each stage is one operator of salestax_spark.llm, written and read again before the next.

1. language: documents whose language can't be told go.
2. lines: later copies of repeated runs of lines go, and with them documents that lose every word. n_chars follows the text.
3. near duplicates: of each group of documents linked by shingles of five words at a similarity of 0.8, one stays.
4. mix: sources are mixed to their target weights; a document taken twice is there twice.
5. packing: length buckets and batches, one row per document of the mix, without its text.

NULL texts go in the first stage; empty tables pass through all stages; other columns of the input stay up to the last stage,
whatever they are called; there, a column called like one of packing's is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestax_spark.llm import jaccard, language, linededup, mixing, packing
from salestax_spark.llm.common import Scratch, set_aside, table, word_count


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, named = set_aside(docs, language.OUTPUTS)
    judged = language.identify_languages(docs, language.learn_dictionaries(docs))
    return judged.where(~F.col("lang_rejected")).select(*named.values())


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, named = set_aside(docs, linededup.OUTPUTS)
    cut = linededup.delete_repeated_runs(docs)
    left = cut.where((F.size("removed_runs") == 0) | (word_count(F.col("text")) > 0))
    length = F.when(F.size("removed_runs") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    if "n_chars" in named:
        named["n_chars"] = length.alias("n_chars")
    return left.select(*named.values())


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, named = set_aside(docs, mixing.OUTPUTS)
    return mixing.mix_sources(docs).select(*named.values())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", dedup_near),
    ("source_mix", mix),
    ("packing", pack),
]

#: A classifier by compression is beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.write(name, stage(spark, docs, sf_dir))
        if before:
            scratch.drop(before)
        before = name
    return docs
