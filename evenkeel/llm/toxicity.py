"""Toxicity of whole texts by compression distance.

Two zstandard dictionaries share their base, trained on ordinary text, and differ in their last part: one goes on with
more ordinary text, the other with what is typical of toxic text. A text is cut into short windows between words, and
each window is compressed with both. Where the second is shorter, the window holds something that the toxic part knows
and the base does not; on anything else the two agree. How large and how frequent these gains are gives the score, with
weights and so thresholds calibrated on texts that the dictionaries have not seen.

Most of a toxic text is ordinary, so the toxic part is distilled: it is made of the words that occur in many times as
large a share of toxic texts as of ordinary ones, then only of those found in windows that gain from them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.learning import Holdout, sample

HOLDOUT = Holdout(5, 0)
PER_CLASS = {0: 5_000, 1: 2_000}
LONGEST = 32_000
THRESHOLD = 0.5
WINDOW = 48
BASE_BYTES = 96 << 10
TOXIC_BYTES = (400, 800, 1_600, 3_200)  # and so on, for as long as words are found
PREFIX = 64
GAIN = 2
LEAST_TEXTS = 3
TIMES = 20
MOST_WINDOWS = 60_000
SCORES = "doc_id long, held_out boolean, score double"


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The whole text, A-Z lower-cased, in windows that begin at a space and have ``size`` bytes or the rest of a word more."""
    text, out, begin = text.lower(), [], 0
    while begin < len(text):
        end = begin + size
        if end < len(text):
            space = text.find(b" ", end, end + size)
            end = space if space >= 0 else end + size
        out.append(text[begin:end])
        begin = end
    return out


@lru_cache(maxsize=8)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_BTOPT, min_match=4, window_log=18, hash_log=17, chain_log=17, search_log=6,
        write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=settings)


@dataclass(frozen=True)
class Dictionaries:
    """Both contents end in the same few bytes. Every window is compressed behind these, which cost next to nothing and
    keep short windows from being stored as they are."""

    ordinary: bytes
    toxic: bytes

    @staticmethod
    def of(base: bytes, filler: bytes, toxic: bytes) -> Dictionaries:
        size = len(toxic) if filler else 0
        filler = filler * (1 + size // max(1, len(filler)))
        kept, prefix = base[:-PREFIX], base[-PREFIX:]
        return Dictionaries(kept + filler[:size] + prefix, kept + toxic[-size:] + prefix if size else kept + prefix)

    def gains(self, some: Sequence[bytes]) -> np.ndarray:
        """Bytes that each window is shorter with the toxic part."""
        prefix = self.ordinary[-PREFIX:]
        first, second = _compressor(self.ordinary).compress, _compressor(self.toxic).compress
        return np.array([len(first(prefix + w)) - len(second(prefix + w)) for w in some], dtype=np.int64)

    def features(self, text: bytes) -> np.ndarray:
        cut = windows(text)
        gains = self.gains(cut) if cut else np.zeros(1, dtype=np.int64)
        return np.array(
            [max(0, min(12, gains.max())), *[np.log1p((gains >= g).sum()) for g in (2, 3, 4)], np.log1p(len(cut))]
        )


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries | None
    weights: np.ndarray

    def score(self, texts: Sequence[bytes]) -> np.ndarray:
        if self.dictionaries is None:
            return np.full(len(texts), float(self.weights[0]))
        rows = np.array([self.dictionaries.features(t) for t in texts]).reshape(len(texts), -1)
        return _probability(rows, self.weights)


def _probability(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(rows @ weights[1:] + weights[0], -30, 30)))


def calibrate(rows: np.ndarray, marks: np.ndarray, strength: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's steps, with a penalty on all but the constant; weights and mean log loss."""
    x = np.c_[np.ones(len(rows)), rows]
    weights = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [strength] * rows.shape[1])
    for _ in range(rounds):
        p = _probability(rows, weights)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (marks - p) - penalty @ weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(_probability(rows, weights), 1e-9, 1 - 1e-9)
    return weights, float(-(marks * np.log(p) + (1 - marks) * np.log(1 - p)).mean())


def _trained(size: int, samples: Sequence[bytes], k: int) -> bytes:
    """Dictionary content from samples; too few of them are taken as they are."""
    whole = sum(map(len, samples))
    if whole > 10 * size:
        return zstandard.train_dictionary(size, list(samples), k=k, d=6).as_bytes()
    return b"".join(samples)[-size:]


def _evenly(items: list, most: int) -> list:
    return items if len(items) <= most else [items[int(i)] for i in np.linspace(0, len(items) - 1, most)]


def _words(cut: Sequence[bytes]) -> set[bytes]:
    return {word for w in cut for word in re.findall(rb" ?\S+", w) if len(word) >= 4}


def distil(base: bytes, filler: bytes, toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> bytes:
    """The toxic part, from texts cut into windows; the most frequent words last: nearest, so cheapest to refer to."""
    known = Counter(word for cut in ordinary for word in _words(cut))
    part, candidates = b"", toxic
    for last in (False, True):
        found = Counter(word for cut in candidates for word in _words(cut))
        kept = [w for w, n in found.items() if n >= LEAST_TEXTS and n / len(toxic) > TIMES * (known[w] + 0.5) / len(ordinary)]
        part = b"".join(w + b" " for w in sorted(kept, key=lambda w: (found[w], w)))
        if not part or last:
            break
        both = Dictionaries.of(base, filler, part)
        candidates = [[w for w, g in zip(cut, both.gains(cut), strict=True) if g >= GAIN] for cut in toxic]
    return part


def _sizes(length: int) -> list[int]:
    """The sizes of the toxic part to try, up to the first that has all of it."""
    sizes = [TOXIC_BYTES[0]]
    while 2 * sizes[-1] < 2 * length:
        sizes.append(2 * sizes[-1])
    return sizes


def train(rows: Sequence[tuple[bytes, int]]) -> Model:
    """A model from labelled texts; two of three go into the dictionaries, the third is for calibration.

    Labels of one class only leave nothing to tell apart; the score is then their share of 1, or one half without any.
    """
    marks = np.array([m for _, m in rows], dtype=float)
    if len(set(marks.tolist())) < 2 or len(rows) < 12:
        return Model(None, np.array([marks.mean() if len(marks) else 0.5]))
    by_mark = {m: [t for t, mark in rows if mark == m] for m in (0, 1)}
    learn = {m: [t for i, t in enumerate(texts) if i % 3 < 2] for m, texts in by_mark.items()}
    ordinary = [windows(t) for t in learn[0]]
    half = _evenly([w for cut in ordinary for w in cut], MOST_WINDOWS)
    base = _trained(BASE_BYTES, half[::2], 32)
    base = base + b" " * max(0, PREFIX - len(base))
    filler = b"".join(_evenly(half[1::2], 1_000))
    part = distil(base, filler, [windows(t) for t in learn[1]], ordinary)
    held = [(t, m) for m, texts in by_mark.items() for i, t in enumerate(texts) if i % 3 == 2]
    best = None
    for size in _sizes(len(part)):
        dictionaries = Dictionaries.of(base, filler, part[-size:])
        weights, loss = calibrate(
            np.array([dictionaries.features(t) for t, _ in held]), np.array([m for _, m in held], dtype=float)
        )
        if best is None or loss < best[0]:
            best = loss, Model(dictionaries, weights)
    return best[1]


def score(
    documents: DataFrame, model: Model, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per document.

    Only the bytes of the whole text decide; null texts count as empty, and an empty text has a score like any other.
    Null and repeated keys stay; a null key is held out like empty text. Extra columns are left out. One scan, no shuffle.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(2)]
            scores = pa.array(model.score(texts), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), scores], ["doc_id", "held_out", "score"]
            )

    rows = documents.select(
        F.col(key).cast("long").alias("doc_id"), HOLDOUT.column(key).alias("held_out"), F.col(text).alias("text")
    )
    scored = rows.mapInArrow(of_batches, SCORES)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score_documents(documents: DataFrame, labels: DataFrame, per_class: dict[int, int] | None = None) -> DataFrame:
    """Trains on at most ``per_class`` labelled texts of up to ``LONGEST`` bytes, on the driver, and scores all."""
    return score(documents, train(sample(documents, labels, "toxic", per_class or PER_CLASS, HOLDOUT, LONGEST)))


def clean_documents(documents: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows, in all their columns and whatever their names, whose score stays below the threshold.

    Only the text decides: null counts as empty, equal texts get equal verdicts, nulls in other columns change nothing.
    Repeated rows stay or go together, a score equal to the threshold goes, an empty table stays empty.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(
                    batch.schema.get_field_index(text)
                )
            ]
            scores = model.score(texts)
            yield batch.filter(pa.array(scores < threshold, pa.bool_()))

    return documents.mapInArrow(of_batches, documents.schema)
