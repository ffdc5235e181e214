"""A corpus pipeline over `documents`: quality rules, exact dedup, near-dedup,
secret masking, packing.

Each stage takes `(spark, docs, sf_dir)` and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but the
last return the input's columns.

- quality rules: documents that the rules reject go.
- exact dedup: of equal texts the row with the smallest doc_id stays.
- near dedup: one document of each near-duplicate class stays.
- secret scans: every secret in a text is masked; `n_chars` follows the text.
- packing: length bucket, batch and slot of every document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from edicto.llm.common import importable, read_table, written
from edicto.llm.exact_dedup import exact_dedup
from edicto.llm.near_dedup import near_dedup
from edicto.llm.packing import pack_documents
from edicto.llm.quality_rules import quality_filter
from edicto.llm.secrets import mask_secrets

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return near_dedup(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return mask_secrets(spark, docs, RANK_FILE)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return pack_documents(spark, docs, BPE_FILE)


STAGES = [("quality_rules", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage),
          ("secret_scan", secret_stage), ("packing", packing_stage)]

#: Weighted MinHash classes and BPE lengths are beyond SQL; tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, over the whole `documents` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
