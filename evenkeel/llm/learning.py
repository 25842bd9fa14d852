"""Samples of labelled rows for the two classifiers, bounded in rows and in bytes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import crc32_of_key
from evenkeel.staging import stage


@dataclass(frozen=True)
class Holdout:
    """Rows that labels are never learned from: those whose key, as text, has this remainder of its CRC-32."""

    modulus: int
    remainder: int

    def column(self, key: str):
        return F.pmod(crc32_of_key(key), F.lit(self.modulus)) == self.remainder


def sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    per_class: dict[int, int],
    holdout: Holdout,
    longest: int,
    key: str = "doc_id",
    text: str = "text",
) -> list[tuple[bytes, int]]:
    """Texts with their label, in the order of a hash of the key: at most ``per_class`` of each, none over ``longest``
    bytes, none held out.

    Null keys, labels and texts are left out; a key with several labels has the largest, one with several texts the
    least. The keys are chosen among the labels, so only the chosen texts are gathered; they are written once, so that
    the documents are scanned once for all classes.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~holdout.column(key))
    once = known.groupBy(F.col(key).cast("long").alias("_key")).agg(F.max(label).cast("int").alias("_label"))
    order = F.xxhash64("_key")
    picks = None
    for value, most in sorted(per_class.items()):
        # As many keys again, for those whose texts turn out to be missing or too long.
        some = once.where(F.col("_label") == value).orderBy(order, "_key").limit(2 * most)
        picks = some if picks is None else picks.unionByName(some)
    body = F.col(text).cast("binary")
    texts = documents.where(F.col(text).isNotNull() & (F.octet_length(text) <= longest)).select(
        F.col(key).cast("long").alias("_key"), body.alias("_text")
    )
    chosen = stage(
        texts.join(F.broadcast(picks), "_key").groupBy("_key", "_label").agg(F.min("_text").alias("_text")), "sample"
    )
    out: list[tuple[bytes, int]] = []
    for value, most in sorted(per_class.items()):
        rows = chosen.where(F.col("_label") == value).orderBy(order, "_key").limit(most).select("_text").collect()
        out += [(bytes(r[0]), value) for r in rows]
    return out
