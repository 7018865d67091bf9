"""What the two text classifiers have in common: labelled rows, and running a model over all documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, frugal, give_back, small_batches, text_or_empty


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int, id_column: str = "doc_id", text_column: str = "text") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts and 0/1 labels to learn from, and how many labelled rows each one stands for.

    At most `rows` labelled rows outside the held-out fold, half of them of
    either label, chosen by a hash of the id; all where there are no more. Of
    contradicting labels of one id the 1 counts, of several texts of one id the
    least. Only this documented sample reaches the driver, one text an id.
    """
    wanted = labels.where(F.col(label).isin(0, 1) & (fold(id_column, folds) != held)).groupBy(id_column).agg(F.max(label).alias("__label"))
    per_label = {r[0]: r[1] for r in wanted.groupBy("__label").count().collect()}
    order = F.xxhash64(id_column), F.col(id_column)
    chosen = wanted.where("__label = 0").orderBy(*order).limit(rows // 2).unionAll(wanted.where("__label = 1").orderBy(*order).limit(rows // 2))
    texts = docs.select(F.col(id_column), text_or_empty(text_column).alias("__text"))  # a column of either name is no clash: nothing else is selected
    found = texts.join(F.broadcast(chosen), id_column).groupBy(id_column, "__label").agg(F.min("__text").alias("__text"))
    got = sorted(found.select(id_column, "__text", "__label").collect())
    y = np.array([r[2] for r in got], dtype=np.int64)
    stands_for = np.array([per_label[k] / max(1, (y == k).sum()) for k in y.tolist()], dtype=np.float64)
    return [r[1] for r in got], y, stands_for


def score_all(docs: DataFrame, scorer: Callable[[pa.Array], np.ndarray], folds: int, held: int, threshold: float, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted. scorer: a column of texts -> scores from 0 to 1."""
    give_back()  # what fitting left
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value(batch.column(0))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], names=[id_column, "held_out", "score", "predicted"])

    kind = docs.schema[id_column].dataType.simpleString()
    held_out = F.coalesce(fold(id_column, folds) == held, F.lit(True)).alias("held_out")
    return small_batches(docs).select(F.col(text_column), F.col(id_column), held_out).mapInArrow(frugal(run), f"`{id_column}` {kind}, held_out boolean, score double, predicted int")


def keep_scored(docs: DataFrame, scorer: Callable[[pa.Array], np.ndarray], threshold: float, text_column: str = "text", below: bool = False) -> DataFrame:
    """The documents that score at least `threshold`, or those that score below it, all columns."""
    give_back()  # what fitting left
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    position = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array((shared.value(batch.column(position)) < threshold) == below))

    return small_batches(docs).mapInArrow(frugal(run), docs.schema)
