"""Packing documents into windows of tokens with the help of a sharded BM25 index.

Documents are dealt out by a lexical key, so that a shard of neighbours in key order shares rare tokens; ties of the key are
split by document. Whole windows of a long document stand alone. What is left of it goes to its shard, where each seed
asks the index of the shard for unused neighbours, which fill its window from the best match on. The neighbour that no longer
fits is cut, and its rest stays in the shard, so that only the last window of a shard can have room left.
Document frequencies and the mean length are taken over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import library_tokens, ragged
from tallyworks.llm.bpe import vocabulary
from tallyworks.session import work_folder

WINDOW = 4096
SHARD_TOKENS = 1 << 21
SHARD_DOCS = 4096
K1, B = 1.2, 0.75
KEY_TERMS = 16

_PIECES = [
    ("start", T.LongType()),
    ("length", T.LongType()),
    ("ids", T.BinaryType()),
    ("doc_tokens", T.LongType()),
    ("sequence_id", T.LongType()),
    ("offset", T.LongType()),
]


def lexical_keys(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each document the smallest hash of its rarest tokens; tokens that were merged later have higher ids and are rarer."""
    keys = np.zeros(len(lengths), dtype=np.int64)
    rows = np.flatnonzero(lengths)
    if len(rows):
        owner = np.repeat(np.arange(len(rows), dtype=np.uint64), lengths[rows])
        pairs = np.sort(owner << np.uint64(32) | ids.astype(np.uint64))
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
        owner = (pairs >> np.uint64(32)).astype(np.int64)
        ends = np.cumsum(np.bincount(owner))
        rarest = np.flatnonzero(ends[owner] - np.arange(len(pairs)) <= KEY_TERMS)
        term, owner = pairs[rarest] & np.uint64(0xFFFFFFFF), owner[rarest]
        hashes = (term * np.uint64(0x9E3779B97F4A7C15) ^ (term << np.uint64(17))) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(1)
        keys[rows] = np.minimum.reduceat(hashes, np.flatnonzero(np.append(True, owner[1:] != owner[:-1])))
    return keys


def corpus_statistics(df: DataFrame, ids: str, kind: np.dtype, size: int) -> tuple[int, float, np.ndarray]:
    """Number of documents, mean length, and for each token the number of documents that hold it. Bounded by the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, there, docs, tokens = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=bool), 0, 0
        ragged.give_back()
        for batch in ragged.slices(batches, ids, ragged.BATCH_BYTES // 2):
            data, bounds = ragged.text_bytes(batch.column(ids))
            found = np.frombuffer(data.tobytes(), dtype=kind).astype(np.int64)
            lengths = np.diff(bounds) // kind.itemsize
            ends = ragged.offsets(lengths)
            for row in range(len(lengths)):
                term = found[ends[row] : ends[row + 1]]
                there[term] = True
                term = np.flatnonzero(there)
                held[term] += 1
                there[term] = False
            docs, tokens = docs + len(lengths), tokens + len(found)
        token = np.append(np.flatnonzero(held), [-1, -2])
        number = np.append(held[token[:-2]], [docs, tokens])
        yield pa.record_batch([pa.array(token), pa.array(number)], ["token", "n"])

    rows = df.select(ids).mapInArrow(ragged.lean(count), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    token, number = rows.column("token").to_numpy(), rows.column("n").to_numpy()
    frequencies = np.zeros(size, dtype=np.int64)
    frequencies[token[token >= 0]] = number[token >= 0]
    docs, tokens = (int(number[token == mark].sum()) for mark in (-1, -2))
    return docs, tokens / max(docs, 1), frequencies


class Shard:
    """The inverted index over the rests of documents of one shard, and the windows made from them."""

    def __init__(self, items: list[tuple], weights: np.ndarray, mean: float):
        self.items = items
        self.ids = [item[2] for item in items]
        self.begin = [item[1] for item in items]
        self.unused = np.ones(len(items), dtype=bool)
        self.lengths = np.array([len(ids) for ids in self.ids])
        bits = len(items).bit_length()
        narrow = np.uint32 if len(weights) << bits <= 1 << 32 else np.uint64
        rows = np.repeat(np.arange(len(items), dtype=narrow), self.lengths)
        pairs, times = np.unique(np.concatenate(self.ids).astype(narrow) << narrow(bits) | rows, return_counts=True)
        terms, rows = (pairs >> narrow(bits)).astype(np.int64), (pairs & narrow((1 << bits) - 1)).astype(np.int64)
        scale = K1 * (1 - B + B * self.lengths[rows] / max(mean, 1.0))
        self.posting_rows, self.posting_scores = rows, weights[terms] * times * (K1 + 1) / (times + scale)
        self.bounds = np.searchsorted(terms, np.arange(len(weights) + 1))
        order = np.argsort(rows.astype(np.uint16) if bits <= 16 else rows, kind="stable")
        self.terms, self.term_bounds = terms[order], np.searchsorted(rows[order], np.arange(len(items) + 1))
        self.indexed = len(items)

    def _drop_used(self) -> None:
        """Takes documents that are used up out of the index, once they are half of it."""
        left = int(self.unused.sum())
        if 2 * left <= self.indexed:
            kept = self.unused[self.posting_rows]
            self.posting_rows, self.posting_scores = self.posting_rows[kept], self.posting_scores[kept]
            self.bounds = ragged.offsets(kept.astype(np.int64))[self.bounds]
            self.indexed = left

    def scores(self, seed: int) -> np.ndarray:
        """The score of every document for a seed, below zero for used ones; without a common term it is zero."""
        self._drop_used()
        asked = self.terms[self.term_bounds[seed] : self.term_bounds[seed + 1]]
        runs = list(zip(self.bounds[asked].tolist(), self.bounds[asked + 1].tolist()))
        rows = np.concatenate([self.posting_rows[low:high] for low, high in runs])
        parts = np.concatenate([self.posting_scores[low:high] for low, high in runs])
        return np.where(self.unused, np.bincount(rows, weights=parts, minlength=len(self.items)), -1.0)

    def windows(self, window: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
        """Lists of (item, start in its document, ids), each list of at most the length of a window.

        The best unused neighbour that fits comes next, of equal ones the first; when none fits, the best is cut.
        """
        for seed in range(len(self.items)):
            if not self.unused[seed]:
                continue
            self.unused[seed] = False
            filled, room = [(seed, self.begin[seed], self.ids[seed])], window - len(self.ids[seed])
            scores = self.scores(seed) if room else None
            while room:
                fits = np.where(self.lengths <= room, scores, -1.0)
                row = int(fits.argmax())
                if fits[row] < 0:
                    break
                filled.append((row, self.begin[row], self.ids[row]))
                self.unused[row], scores[row] = False, -1.0
                room -= len(self.ids[row])
            row = int(scores.argmax()) if room else seed
            if room and scores[row] >= 0:
                filled.append((row, self.begin[row], self.ids[row][:room]))
                self.ids[row], self.begin[row] = self.ids[row][room:], self.begin[row] + room
                self.lengths[row] -= room
            yield filled


def pack(
    df: DataFrame,
    ids: str,
    kind: np.dtype,
    size: int,
    near: str,
    key: str = "doc_id",
    window: int = WINDOW,
    shards: int | None = None,
) -> DataFrame:
    """Packs the ids of every row into windows: one row per piece, with the key, start (ids of its document before it), length,
    ids (little-endian, 32 bits each), doc_tokens, sequence_id and offset (place in the sequence).

    The ids are little-endian bytes of the given type, of a vocabulary of the given size. Documents with a like value of near,
    their lexical key, come to one shard. A row without ids has no piece. Repeated rows and rows of one key are
    packed each for itself; a null key is kept. Other columns are dropped, so that their names cannot clash.
    An empty table gives no rows. The stored input is read twice.
    """
    spark = df.sparkSession
    kept = work_folder(spark, "packing")
    df.select(F.col(key), F.col(ids).alias("ids"), F.col(near).alias("__near")).write.parquet(kept)
    stored = spark.read.parquet(kept)
    docs, mean, frequencies = corpus_statistics(stored, "ids", kind, size)
    weights = np.log1p((docs - frequencies + 0.5) / (frequencies + 0.5))
    shared = spark.sparkContext.broadcast(weights)  # one number per token of the vocabulary
    count = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored.repartitionByRange(count, "__near", key, F.xxhash64("ids")).sortWithinPartitions("__near", key, "ids")
    key_type = df.schema[key]
    schema = T.StructType([key_type, *(T.StructField(name, one) for name, one in _PIECES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ragged.give_back()
        sequence = TaskContext.get().partitionId() << 32
        items, tokens, out = [], 0, []

        def emit() -> pa.RecordBatch:
            columns = list(zip(*out))
            kinds = [batch_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            found = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)
            out.clear()
            return found

        def piece(item: tuple, start: int, part: np.ndarray, offset: int) -> None:
            out.append((item[0], start, len(part), part.astype("<u4").tobytes(), item[3], sequence, offset))

        def finish() -> None:
            nonlocal sequence
            for filled in Shard(items, shared.value, mean).windows(window):
                offset = 0
                for row, start, part in filled:
                    piece(items[row], start, part, offset)
                    offset += len(part)
                sequence += 1

        batch_type = None
        for batch in ragged.slices(batches, "ids", ragged.BATCH_BYTES):
            batch_type = batch.column(key).type
            names = batch.column(key).to_pylist()
            data, bounds = ragged.text_bytes(batch.column("ids"))
            for row, name in enumerate(names):
                found = np.frombuffer(data[bounds[row] : bounds[row + 1]].tobytes(), dtype=kind)
                whole = len(found) // window * window
                for at in range(0, whole, window):
                    piece((name, 0, None, len(found)), at, found[at : at + window], 0)
                    sequence += 1
                if len(found) > whole:
                    items.append((name, whole, found[whole:], len(found)))
                    tokens += len(found) - whole
                if tokens >= SHARD_TOKENS or len(items) >= SHARD_DOCS:
                    finish()
                    items, tokens = [], 0
            if out:
                yield emit()
        if items:
            finish()
        if out:
            yield emit()

    return dealt.select(key, "ids").mapInArrow(ragged.lean(run), schema)


def op6_packing(spark: SparkSession, folder: str, path: str | None = None, end: int = 2) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return packed_documents(documents, path or vocabulary("word_bpe_49k.json"), end)


def packed_documents(documents: DataFrame, path: str, end: int) -> DataFrame:
    """Tokenizes and packs the texts of documents, and gives each piece with the checksum of its ids."""
    tokens = library_tokens.tokenize(documents.select("doc_id", "text"), path, end, key="near", key_of=lexical_keys)
    size = library_tokens.words(path).size
    return pack(tokens, "ids", library_tokens.id_type(path), size, "near").select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
