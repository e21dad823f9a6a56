"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

1. quality: documents that the classifier rejects go (scores below its threshold);
2. exact: of equal texts the row with the largest doc_id stays;
3. near: one document of each near-duplicate class stays;
4. pii: spans of personal data are replaced by their kind in brackets;
5. packing: the remaining texts are packed into sequences of at most 1024 tokens.

All stages but the last return the columns of ``documents``. Nulls, empty and
long texts, repeated rows and empty tables have the results that the
operators' own modules define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrina.llm import dedup, nearcopies, packing, pii, quality
from vitrina.llm.queries import table, vocab_path
from vitrina.llm.shared import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.keep_exact(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.keep_first(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(docs, vocab_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: A trained classifier, MinHash and packing can't be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, all stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
