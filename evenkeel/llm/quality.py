"""Quality scores of whole texts by a byte-level convolutional network."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm import cnn
from evenkeel.llm.learning import Holdout, sample

HOLDOUT = Holdout(4, 2)
PER_CLASS = {0: 2_000, 1: 4_000}
LONGEST = 32_000
EPOCHS = 4
THRESHOLD = 0.7
SCORES = "doc_id long, held_out boolean, score double"


def train(
    documents: DataFrame,
    labels: DataFrame,
    per_class: dict[int, int] | None = None,
    longest: int = LONGEST,
    epochs: int = EPOCHS,
) -> cnn.Network | float:
    """A network fitted on at most ``per_class`` labelled texts of up to ``longest`` bytes, on the driver.

    With labels of one class only, or none, there is nothing to tell apart: the result is their share of 1, or one half.
    """
    rows = sample(documents, labels, "quality", per_class or PER_CLASS, HOLDOUT, longest)
    marks = np.array([m for _, m in rows])
    if len(set(marks.tolist())) < 2:
        return float(marks.mean()) if len(marks) else 0.5
    # Small samples are gone through more often, up to a bound.
    rounds = max(epochs, min(20, epochs * 2_000 // len(rows)))
    return cnn.fit([t for t, _ in rows], marks, epochs=rounds)


def score(
    documents: DataFrame,
    model: cnn.Network | float,
    threshold: float = THRESHOLD,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per document.

    Only the bytes of the text decide; null texts count as empty, and an empty text has a score like any other. Null and
    repeated keys stay; a null key is held out like empty text. Extra columns are left out. One scan, no shuffle.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(2)]
            scores = model.score(texts).astype(np.float64) if isinstance(model, cnn.Network) else np.full(
                len(texts), model
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores)], ["doc_id", "held_out", "score"]
            )

    rows = documents.select(
        F.col(key).cast("long").alias("doc_id"), HOLDOUT.column(key).alias("held_out"), F.col(text).alias("text")
    )
    scored = rows.mapInArrow(of_batches, SCORES)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score(documents, train(documents, labels))


def good_documents(
    documents: DataFrame, model: cnn.Network | float, threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """The rows, in all their columns and whatever their names, whose score reaches the threshold.

    Only the text decides: null counts as empty, equal texts get equal verdicts, nulls in other columns change nothing.
    Repeated rows stay or go together, a score equal to the threshold stays, an empty table stays empty.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(
                    batch.schema.get_field_index(text)
                )
            ]
            scores = model.score(texts).astype(np.float64) if isinstance(model, cnn.Network) else np.full(
                len(texts), model
            )
            yield batch.filter(pa.array(scores >= threshold, pa.bool_()))

    return documents.mapInArrow(of_batches, documents.schema)
