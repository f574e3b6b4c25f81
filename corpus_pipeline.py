"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark spans, token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``. ``n_chars`` follows the text a stage changes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import bpe, decontaminate, minhash, quality, repeats
from meterlake.llm.catalog import BPE_RANKS
from meterlake.llm.common import table, written


def _counted(before: DataFrame, after: DataFrame) -> DataFrame:
    """``n_chars`` brought up to the texts; an absent or null count stays so."""
    if "n_chars" not in before.columns:
        return after
    kind = before.schema["n_chars"].dataType
    return after.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.coalesce(F.char_length("text"), F.lit(0))).cast(kind))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one of lowest doc_id."""
    return minhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 50 words that occur anywhere else too are cut."""
    return _counted(docs, repeats.remove_repeats(docs))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside an occurrence of a benchmark window are cut."""
    return _counted(docs, decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark")))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each text, with the hashes of the ids and of what they decode to."""
    return bpe.encode_documents(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN, with_ids=True)


STAGES = [("quality", good_quality), ("near duplicates", one_of_near_duplicates), ("repeats", without_repeats),
          ("decontamination", without_benchmarks), ("tokens", token_ids)]

#: No stage but the decontamination can be said in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
