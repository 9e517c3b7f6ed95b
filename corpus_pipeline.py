"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, packing.

Each stage works on all rows that the one before it kept; between stages the rows are written to the shared folder
as Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import linededup, packing, quality, simhash
from panelspark.llm.common import store, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the blocks that an earlier one has; n_chars follows the text."""
    cut = linededup.dedup_lines(docs)
    columns = {"n_chars": F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))}
    return cut.withColumns(columns).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least doc_id of each group of near-duplicates."""
    return simhash.keep_one(docs, size=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and offset."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end=2)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("SimHash near-dedup", simhash_near_dedup), ("packing", pack)]
ORACLE_SQL = None  # SimHash components and tokenization have no SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
