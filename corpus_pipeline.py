"""The training-data pipeline: from ``documents`` to packed sequences.

Each stage takes (spark, docs, folder of tables) and returns a frame, which is written as Parquet and read again
as the next stage's docs; so docs are always read from files. All but the last keep the columns of ``documents``.

1. toxicity: documents predicted toxic go. The model learns from all labelled documents.
2. exact_dedup: of equal texts (runs of white space count as one space) the smallest doc_id stays.
3. near_dedup: of each group of documents linked by fingerprints of three-word shingles that differ in at most 3 bits the smallest
   doc_id stays.
4. decontamination: documents that contain a benchmark item go.
5. packing: what is left is packed into sequences of 2048 tokens.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from layerloom.llm import block_names, contamination, packing, simhash, toxicity
from layerloom.llm.scratch import Scratch, free_name, numbered_scan

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    row = free_name(docs)
    return block_names.drop_duplicates(numbered_scan(docs, row), row_column=row).drop(row)


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    row = free_name(docs)
    numbered = numbered_scan(docs, row)
    kept = simhash.drop_near_duplicates(numbered, words=simhash.WORDS, max_bits=simhash.MAX_BITS, row_column=row)
    return kept.drop(row)


def without_benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    row, items = free_name(docs), spark.read.parquet(f"{folder}/benchmark.parquet")
    return contamination.drop_contaminated(numbered_scan(docs, row), items, row_column=row).drop(row)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmarks),
    ("packing", packed),
]

#: SQL cannot decode words, hash with XXH64 or tokenize; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``: one row per piece, as ``packing.pack`` gives."""
    scratch = Scratch(spark)
    docs, last = spark.read.parquet(f"{folder}/documents.parquet"), None
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, folder))
        if last is not None:
            scratch.drop(last)
        last = docs
    return docs
