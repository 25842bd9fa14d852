"""Token ids as Parquet list columns: sorted shards with chosen encodings, row groups and page indexes.

Documents are range-partitioned by their key, a shard to a task, and encoded in that order; a task writes its shard as
Parquet with one row per document. The ids are dictionary-coded (few distinct ids, many repeats) or delta-coded, the
numbers beside them delta-coded, so a reader that wants numbers only, or a range of keys, reads little: columns are
pruned, and row groups and pages outside the range are skipped by their statistics.

A row knows how many ids come before it in its shard; a small table with one row per shard has what comes before that.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import shares

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
SHARD_BYTES = 32 << 20
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 1_000
ENCODINGS = ("dictionary", "delta")
ROWS = "doc_id long, shard int, before long, n_tokens int, ids array<int>"

#: Words whose ids a worker remembers, and bytes of text it works on at once (a longer text is worked on alone).
MOST_WORDS = 100_000
AT_ONCE = 2 << 20

#: Where a Latin letter meets ASCII punctuation (but the apostrophe) or a digit, a piece ends. Letters that turn into a
#: letter and a mark when they are normalised or lower-cased are not among these.
_LETTER, _SIGN = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}])", r"([!-&(-@\[-`{-~])"
SIDES = ((_LETTER + _SIGN, r"\1 \2"), (_SIGN + _LETTER, r"\1 \2"))

#: Words that normalising and lower-casing leave as they are, and that are one piece.
PLAIN = r"^[a-z\x{DF}-\x{F6}\x{F8}-\x{FF}]+$"
WORD_END = "</w>"


@cache
def _tokenizer(vocabulary: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


def _byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable ones for themselves, the others in order
    for the signs from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@cache
def _merges(vocabulary: str):
    """A faster encoder with the same merges, the ids of its ranks, and which of the ids end a word.

    A word's end is a zero byte, and the lowest ranks join it to the byte before it.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as file:
        model = json.load(file)["model"]
    signs, ids_of = _byte_signs(), model["vocab"]
    name_of = {b: c for c, b in signs.items()}
    pieces = [name_of[b] for b in range(256)] + [name_of[b] + WORD_END for b in range(256)]
    pieces += ["".join(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
    table = {}
    for rank, piece in enumerate(pieces):
        ends = piece.endswith(WORD_END)
        table[bytes(signs[c] for c in piece.removesuffix(WORD_END)) + b"\x00" * ends] = rank
    encoder = tiktoken.Encoding("words", pat_str=r"[^\n]+", mergeable_ranks=table, special_tokens={})
    is_end = np.array([piece.endswith(WORD_END) for piece in pieces])
    return encoder, np.array([ids_of[piece] for piece in pieces], dtype="<u4"), is_end


class WordIds:
    """Ids of texts as ``tokenizers`` gives them, each distinct word encoded once.

    It holds for byte-level vocabularies with marked word ends whose pieces span neither ASCII white space nor ``SIDES``,
    and whose case is folded; ``check`` compares a text with the tokenizer's own ids. The merges of plain words are those
    of a second library that is several times as fast, other words go to ``tokenizers`` itself. Words with the opening
    sign of special tokens stay as they are.
    """

    def __init__(self, vocabulary: str = VOCABULARY, most_words: int = MOST_WORDS) -> None:
        self.tokenizer, self.most_words = _tokenizer(vocabulary), most_words
        self.merges, self.ids_of_rank, self.is_end = _merges(vocabulary)
        self.known: dict[str, list[int]] = {}

    def exact(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def check(self, text: str) -> None:
        if not np.array_equal(self(pa.array([text]))[0], self.exact(text)):
            raise RuntimeError("words by themselves have other ids than in their text")

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.empty(0, dtype="<u4"), np.empty(0, dtype=np.int64)
        ranks = self.merges.encode_to_numpy("\x00\n".join(words) + "\x00", disallowed_special=())
        ends = np.flatnonzero(self.is_end[ranks]) + 1
        return self.ids_of_rank[ranks], np.diff(ends, prepend=0)

    def _others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        missing = [w for w in words if w not in self.known]
        if len(self.known) + len(missing) > self.most_words:
            self.known, missing = {}, words
        found = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
        self.known.update((w, e.ids) for w, e in zip(missing, found, strict=True))
        lists = [self.known[w] for w in words]
        return np.fromiter(chain.from_iterable(lists), dtype="<u4"), np.array([len(i) for i in lists], dtype=np.int64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        special = pc.match_substring(words.dictionary, "<|")
        folded = pc.ascii_lower(words.dictionary)
        for side, apart in SIDES:
            folded = pc.replace_substring_regex(folded, side, apart)
        parts = pc.ascii_split_whitespace(pc.if_else(special, words.dictionary, folded))
        coded = parts.flatten().dictionary_encode()
        is_plain = pc.match_substring_regex(coded.dictionary, PLAIN)
        plain, plain_sizes = self._plain(coded.dictionary.filter(is_plain).to_pylist())
        others, other_sizes = self._others(coded.dictionary.filter(pc.invert(is_plain)).to_pylist())
        store, is_plain = np.concatenate([plain, others]), is_plain.to_numpy(zero_copy_only=False)
        size = np.empty(len(is_plain), dtype=np.int64)
        size[is_plain], size[~is_plain] = plain_sizes, other_sizes
        begin = np.empty(len(is_plain), dtype=np.int64)
        begin[is_plain] = np.cumsum(plain_sizes) - plain_sizes
        begin[~is_plain] = len(plain) + np.cumsum(other_sizes) - other_sizes
        # Ids of the distinct words, then of the texts' words.
        part = coded.indices.to_numpy()
        ids, sizes = _gathered(store, begin[part], size[part])
        bounds = np.concatenate([[0], np.cumsum(sizes)])[_offsets(parts)]
        at = words.indices.to_numpy()
        ids, sizes = _gathered(ids, bounds[at], bounds[at + 1] - bounds[at])
        return ids, np.diff(np.concatenate([[0], np.cumsum(sizes)])[_offsets(split)])


def _offsets(lists: pa.ListArray) -> np.ndarray:
    ends = lists.offsets.to_numpy().astype(np.int64)
    return ends - ends[0]


def _gathered(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``values`` one after the other, and their sizes."""
    upto = np.cumsum(size)
    total = int(upto[-1]) if len(upto) else 0
    return values[np.repeat(begin - (upto - size), size) + np.arange(total)], size


def _portions(texts: pa.Array, at_once: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``at_once`` bytes of text."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy())
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + at_once, side="right")))
        yield start, stop
        start = stop


def sharded(
    documents: DataFrame,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, shard, before, n_tokens, ids)``: every document's ids and the end id, ordered by key within and over
    shards of about ``shard_bytes`` of text; ``before`` counts the ids before the document in its shard.

    Null texts count as empty and have the end id alone. Null keys come first. Rows of one key are ordered by a hash of
    their text, and equal rows by their place, so a key or a row repeated any number of times is split over shards.
    Other columns are left out, whatever their names. An empty table has no shard.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    whole = documents.agg(F.sum(F.octet_length(body) + 64)).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), "_hash", "_place"]
    rows = documents.select(
        F.col(key).cast("long").alias("doc_id"),
        F.xxhash64(body).alias("_hash"),
        F.monotonically_increasing_id().alias("_place"),
        body.alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, shard, before = WordIds(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("text")
            if len(texts):
                ids_of.check(texts[0].as_py())
            for start, stop in _portions(texts, AT_ONCE):
                ids, lengths = ids_of(texts[start:stop])
                totals = lengths + 1
                upto = np.cumsum(totals)
                out = np.empty(int(upto[-1]), dtype=np.int32)
                is_end = np.zeros(len(out), dtype=bool)
                is_end[upto - 1] = True
                out[is_end], out[~is_end] = end_id, ids
                offsets = np.concatenate([[0], upto])
                rows_here = stop - start
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[start:stop],
                        pa.array(np.full(rows_here, shard, dtype=np.int32)),
                        pa.array(before + offsets[:-1]),
                        pa.array(totals.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out)),
                    ],
                    ["doc_id", "shard", "before", "n_tokens", "ids"],
                )
                before += int(upto[-1])

    ranged = rows.repartitionByRange(shares(int(whole), shard_bytes), *order).sortWithinPartitions(*order)
    return ranged.select("doc_id", "text").mapInArrow(encode, ROWS)


def write_tokens(
    documents: DataFrame,
    folder: str,
    encoding: str = "dictionary",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
    **settings,
) -> None:
    """Writes ``folder/tokens``, a file per shard, and ``folder/shards``, a row per shard: its first and last key, its
    documents and ids, and the ids before it. ``settings`` as for ``sharded``.

    ``encoding`` is that of the ids, "dictionary" or "delta". Pages hold about ``page_bytes`` and at most ``page_rows``
    documents; each file has the column and offset indexes that let a reader skip pages.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding is one of {', '.join(ENCODINGS)}, not {encoding!r}")
    coded = "true" if encoding == "dictionary" else "false"
    sharded(documents, **settings).write.options(**{
        "compression": "zstd",
        "parquet.writer.version": "v2",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": coded,
    }).parquet(f"{folder}/tokens")
    spark = documents.sparkSession
    # One row per shard from here on.
    per_shard = spark.read.schema(ROWS).parquet(f"{folder}/tokens").groupBy("shard").agg(
        F.min("doc_id").alias("first_id"),
        F.max("doc_id").alias("last_id"),
        F.count(F.lit(1)).alias("documents"),
        F.sum("n_tokens").alias("tokens"),
    )
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_shard.withColumn("start", F.coalesce(F.sum("tokens").over(earlier), F.lit(0).cast("long")))
    placed.coalesce(1).write.parquet(f"{folder}/shards")


def read_tokens(
    spark: SparkSession, folder: str, first: int | None = None, last: int | None = None, ids: bool = True
) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of the documents with keys from ``first`` to ``last``, both included and open
    if left out; without ``ids``, only the numbers are read. Null keys are in the range only if both ends are open.

    Bounds reach the scan, which skips files' row groups and pages by their statistics.
    """
    rows = spark.read.schema(ROWS).parquet(f"{folder}/tokens")
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    base = spark.read.schema("shard int, start long").parquet(f"{folder}/shards")
    kept = ["doc_id", (F.col("start") + F.col("before")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens")]
    # The shards' table has a row per shard of the files; Spark broadcasts it by its measured size.
    return rows.join(base, "shard").select(*kept, *(["ids"] if ids else []))


def checksums(tokens: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``, the last two from the ids themselves, for rows with ``ids``."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy().astype(np.int64)
            values = memoryview(np.ascontiguousarray(lists.values.to_numpy(), dtype="<i4")).cast("B")
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends)), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "ids").mapInArrow(
        of_batches, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
