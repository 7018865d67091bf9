"""The corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. So a lost
executor costs work within one stage only, and no stage plans more than its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronofold.llm import bpe, decontaminate, exact_dedup, jaccard_join, quality
from chronofold.llm.common import drop_folder, release, shared_folder, table
from chronofold.llm.queries import vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.drop_poor(docs, table(spark, sf_dir, "labels"))


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one of the largest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8; of each group the smallest doc_id stays."""
    return jaccard_join.drop_near_copies(docs, k=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, and the text's token ids with their digest and that of the text decoded from them."""
    return bpe.encode_digests(docs, vocabulary_path(), columns=["doc_id", "lang", "source"], with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_deduplication),
    ("ngram_jaccard_join", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: The classifier, the join's search and the encoding can't be said in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has written is deleted in the shared folder once the next one is done; the last one's files stay, as the result reads them."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_folder(spark, before)
        before = path
        release(spark)
    return docs
