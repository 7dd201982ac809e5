"""A corpus from raw documents to token ids: five stages, each reading what the last one wrote.

Null and empty texts, repeated rows, ties, empty tables and further columns are treated as the
operators' docstrings say: the quality stages drop texts of fewer than 50 words, empty ones
included; of equal rows the near-dedup stage keeps one; empty tables give empty results; all
columns of ``documents`` stay up to the last stage.

``STAGES`` holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
All but the last return the columns of ``docs``. ``run`` writes each stage's rows as Parquet to the
shared folder and hands what it reads back to the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from miasma.llm import bpe, decontaminate, quality, rules, simhash
from miasma.llm.common import stored

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.select_good(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects. The list is learned from the
    labelled rows of all documents: the classifier has taken most bad ones away from ``docs``."""
    found = rules.train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rules.select_good(docs, found)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within two bits over three-word shingles."""
    return simhash.deduplicate(docs, width=3, radius=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words come from benchmark windows."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text they decode to. Batches are small:
    executors still hold memory of the stages before."""
    return bpe.encode(docs.select("doc_id", "text"), TOKENIZER,
                      outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"), batch_bytes=1 << 19).drop("text")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("bpe encoding and decoding", bpe_encoding),
]
# The learned stages have no SQL form; a brute-force version in the tests stands in for it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
