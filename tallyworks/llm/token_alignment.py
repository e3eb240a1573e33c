"""Aligning the tokens of two tokenizers over whole texts: links between tokens that share bytes, and cuts where both end.

Both token sequences of a text spell the same bytes, a space and the text. One vector holds a pair of pointers for every
document of a slice of documents, and each step links the two tokens that every pair points at, moves the pointer whose token ends
first (both at a common end, which is a cut) and drops the documents that are through. A long document takes several
places of the vector, each for a stretch between common ends that both tokenizers are known to have, so that the
number of steps does not follow from the longest document.

How many documents hold a pair of ids linked is counted over the corpus: a slice sends each of its pairs once, with the number
of its documents. Pairs that a large share of the slices holds go back to the slices as one small table, others by a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import ragged
from tallyworks.llm.bpe import CLEAR, merges, vocabulary
from tallyworks.llm.components import stored

SPACE = 0x20
SPACE_SIGN = "▁"
#: About so many bytes of a document share one place of the vector.
STRETCH = 1024
#: At most so many pairs of ids, those in the most slices, are sent to every task.
COMMON_PAIRS = 1 << 16
SLICE_BYTES = 3 << 20


class Pieces:
    """A sentencepiece model without normalisation, none of whose pieces has a space after another character."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(SPACE_SIGN in name.lstrip(SPACE_SIGN) for name in names):
            raise ValueError("a piece of the model goes on after a space")
        spelled = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(SPACE_SIGN, " ").encode() for i, name in enumerate(names)
        ]
        self.spelled = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.spelled_bounds = ragged.offsets(np.array([len(one) for one in spelled]))

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that begin with the space that the model adds, flat, and their lengths."""
        found = self.model.encode([word[1:].decode() for word in words.to_pylist()], num_threads=1)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter((i for one in found for i in one), dtype=np.int64, count=int(lengths.sum())), lengths


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, lanes_a: np.ndarray, lanes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of all lanes in order: token of A, token of B, and whether both end there.

    The ends are byte offsets that grow over all lanes; the bounds of the lanes are places in them. The last tokens of a lane
    end together. Lanes without tokens have no links.
    """
    there = lanes_a[:-1] < lanes_a[1:]
    a, b, last = lanes_a[:-1][there], lanes_b[:-1][there], lanes_a[1:][there]
    linked_a, linked_b = [], []
    # Where a link is in the order of all: every step of a lane moves at least one pointer, so that sums never repeat.
    while len(a):
        linked_a.append(a)
        linked_b.append(b)
        end_a, end_b = ends_a[a], ends_b[b]
        a = a + (end_a <= end_b)
        b = b + (end_b <= end_a)
        through = a == last
        if through.any():
            a, b, last = a[~through], b[~through], last[~through]
    if not linked_a:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)
    a, b = np.concatenate(linked_a), np.concatenate(linked_b)
    place = np.full(len(ends_a) + len(ends_b), -1, dtype=np.int64)
    place[a + b] = np.arange(len(a))
    order = place[place >= 0]
    a, b = a[order], b[order]
    return a, b, ends_a[a] == ends_b[b]


@dataclass
class Aligned:
    """The alignment of a slice of documents. Tokens and links of all documents stand in flat arrays, with bounds by document."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    bounds_a: np.ndarray
    bounds_b: np.ndarray
    a: np.ndarray
    b: np.ndarray
    cut: np.ndarray
    bounds: np.ndarray

    def group_digests(self) -> tuple[np.ndarray, list[str]]:
        """Groups of each document, and the digests of their text, '' without tokens."""
        last_a, last_b = np.zeros(len(self.ids_a), dtype=bool), np.zeros(len(self.ids_b), dtype=bool)
        last_a[self.a[self.cut]] = True
        last_b[self.b[self.cut]] = True
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        # The tokens of A of a group stand before its tokens of B.
        before = np.append(0, np.flatnonzero(last_b) + 1)
        upto = np.append(np.flatnonzero(last_a) + 1, len(self.ids_a))
        at_a = np.arange(len(self.ids_a)) + before[group_a]
        at_b = np.arange(len(self.ids_b)) + upto[group_b]
        ids = np.empty(len(at_a) + len(at_b), dtype=np.int64)
        marks = np.empty(len(ids), dtype=np.uint8)
        ids[at_a], ids[at_b] = self.ids_a, self.ids_b
        marks[at_a] = np.where(last_a, ord("|"), ord(","))
        marks[at_b] = np.where(last_b, ord(";"), ord(","))
        digits, digit_bounds = _decimals(1 << int(ids.max(initial=0)).bit_length())
        text, lengths = ragged.take(digits, digit_bounds, ids)
        ends = ragged.offsets(lengths)
        text[ends[1:] - 1] = marks
        bounds = ends[self.bounds_a + self.bounds_b]
        whole = memoryview(text.tobytes())
        found = [hashlib.sha256(whole[p : q - 1]).hexdigest() if q > p else "" for p, q in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        groups = ragged.offsets(last_a.astype(np.int64))
        return np.diff(groups[self.bounds_a]), found


@lru_cache(maxsize=4)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers below n in decimal digits, each with room for a mark after it."""
    names = [b"%d " % i for i in range(n)]
    return np.frombuffer(b"".join(names), dtype=np.uint8), ragged.offsets(np.array([len(one) for one in names]))


def _respelled(table, ids: np.ndarray, lengths: np.ndarray, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words their tokens spell byte by byte, and the lengths of the tokens in bytes."""
    spelled, sizes = ragged.take(table.spelled, table.spelled_bounds, ids)
    ends = ragged.offsets(sizes)[ragged.offsets(lengths)]
    same = np.diff(ends) == np.diff(bounds)
    for at in np.flatnonzero(same) if not same.all() else ():
        same[at] = np.array_equal(spelled[ends[at] : ends[at + 1]], flat[bounds[at] : bounds[at + 1]])
    if len(spelled) == len(flat) and same.all():
        same = np.diff(ragged.offsets((spelled != flat).astype(np.int64))[bounds]) == 0
    return same, sizes


def align(column: pa.Array, path_a: str, path_b: str) -> Aligned:
    """Aligns the tokens of each text by a byte-level BPE and by a sentencepiece model.

    A text that is null or empty, or whose bytes one of the two does not spell, has no tokens.
    """
    rows = len(column)
    data, row_bounds = ragged.text_bytes(column)
    sizes = np.diff(row_bounds)
    filled = np.flatnonzero(sizes)
    sizes = sizes[filled] + 1
    bounds = ragged.offsets(sizes)
    flat = np.full(int(bounds[-1]), SPACE, dtype=np.uint8)
    body = np.ones(len(flat), dtype=bool)
    body[bounds[:-1]] = False
    flat[body] = data
    # Both begin a token at a space between a character that is no space and one that is no blank.
    begins = np.zeros(len(flat) + 1, dtype=bool)
    begins[1:-2] = (flat[1:-1] == SPACE) & (flat[:-2] != SPACE) & CLEAR[flat[2:]]
    begins[bounds] = True
    cuts = np.flatnonzero(begins)
    if len(filled):
        coded = ragged.pieces(flat, cuts).dictionary_encode()
        word_of, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    else:
        word_of, words = np.empty(0, dtype=np.int64), pa.array([], pa.large_binary())
    word_flat, word_bounds = ragged.text_bytes(words)
    doc_words = np.searchsorted(cuts, bounds)
    good = np.ones(len(filled), dtype=bool)
    sides = []
    for table, (ids, lengths) in (
        (merges(path_a), merges(path_a).encode(word_flat, word_bounds)),
        (pieces(path_b), pieces(path_b).encode(words)),
    ):
        same, spelled = _respelled(table, ids, lengths, word_flat, word_bounds)
        sides.append((ids, ragged.offsets(lengths), spelled))
        wrong = ragged.offsets((~same)[word_of].astype(np.int64))
        good &= np.diff(wrong[doc_words]) == 0
    kept = np.repeat(good, np.diff(doc_words))
    # A lane ends with its document, and at the last word that begins within a stretch of bytes of it.
    start = np.repeat(cuts[doc_words[:-1]], np.diff(doc_words))
    stretch = (cuts[:-1] - start) // STRETCH
    doc = np.repeat(np.arange(len(filled)), np.diff(doc_words))
    word_of, stretch, doc = word_of[kept], stretch[kept], doc[kept]
    first = np.append(True, (stretch[1:] != stretch[:-1]) | (doc[1:] != doc[:-1])) if len(doc) else np.empty(0, dtype=bool)
    lanes = np.append(np.flatnonzero(first), len(doc))
    upto = np.zeros(rows + 1, dtype=np.int64)  # words of each row
    upto[filled + 1] = np.bincount(doc, minlength=len(filled))
    upto = np.cumsum(upto)
    out = []
    for ids, id_bounds, spelled in sides:
        tokens, lengths = ragged.take(ids, id_bounds, word_of)
        token_sizes, _ = ragged.take(spelled, id_bounds, word_of)
        ends = ragged.offsets(lengths)
        out.append((tokens, np.cumsum(token_sizes), ends[lanes], ends[upto]))
    (ids_a, ends_a, lanes_a, bounds_a), (ids_b, ends_b, lanes_b, bounds_b) = out
    a, b, cut = lockstep(ends_a, ends_b, lanes_a, lanes_b)
    return Aligned(ids_a, ids_b, bounds_a, bounds_b, a, b, cut, np.searchsorted(a, bounds_a))


def _lists(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))


_LINKS = ("a_ids", "b_ids", "link_a", "link_b", "cut_links")


def align_texts(df: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """Adds the alignment of each text: a_ids and b_ids, the links in order as link_a and link_b (places in these arrays, from 0),
    and cut_links, the places of the links after which both have a token end.

    A text that is null or empty, or that one of the two does not spell byte by byte, has empty arrays. Texts of any length are
    aligned whole, one document in one task; rows stand alone, so that repeated rows have the same links and an empty table
    gives no rows. Columns of the input with these names are replaced.
    """
    kept = [field for field in df.schema.fields if field.name not in _LINKS]
    schema = T.StructType([*kept, *(T.StructField(name, T.ArrayType(T.IntegerType())) for name in _LINKS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, text, SLICE_BYTES):
            one = align(batch.column(text), path_a, path_b)
            links = np.diff(one.bounds)
            cuts = ragged.offsets(one.cut.astype(np.int64))
            places = np.flatnonzero(one.cut)
            found = [
                _lists(one.ids_a, one.bounds_a),
                _lists(one.ids_b, one.bounds_b),
                _lists(one.a - np.repeat(one.bounds_a[:-1], links), one.bounds),
                _lists(one.b - np.repeat(one.bounds_b[:-1], links), one.bounds),
                _lists(places - np.repeat(one.bounds[:-1], np.diff(cuts[one.bounds])), cuts[one.bounds]),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(field.name) for field in kept), *found], schema.names)

    return df.mapInArrow(run, schema)


_SLICE = (
    "slice long, key binary, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, sha256 array<string>, "
    "rows array<long>, codes binary, times binary, pairs array<long>, docs array<int>"
)
_ROW = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _slice_rows(df: DataFrame, path_a: str, path_b: str, key: str, text: str) -> DataFrame:
    """One row per slice of documents: its distinct pairs with the number of documents that link them, and for each document
    the codes (places in the pairs, as steps) of its distinct pairs with the number of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in ragged.slices(batches, text, SLICE_BYTES):
            one = align(batch.column(text), path_a, path_b)
            n_links = np.diff(one.bounds)
            n_groups, digests = one.group_digests()
            pairs, code = np.unique(one.ids_a[one.a] << 32 | one.ids_b[one.b], return_inverse=True)
            row = np.repeat(np.arange(len(n_links)), n_links)
            held, times = np.unique(row * max(len(pairs), 1) + code, return_counts=True)
            row, code = np.divmod(held, max(len(pairs), 1))
            steps = np.diff(code, prepend=0).astype("<i4")
            keys = pa.RecordBatch.from_arrays([batch.column(key)], [key])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, keys.schema) as stream:
                stream.write_batch(keys)
            columns = [
                np.diff(one.bounds_a), np.diff(one.bounds_b), n_groups, n_links, digests,
                np.bincount(row, minlength=len(n_links)), steps.tobytes(), times.astype("<i4").tobytes(), pairs,
                np.bincount(code, minlength=len(pairs)),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip([number, sink.getvalue().to_pybytes(), *columns], kinds)], names
            )
            number += 1

    schema = T.StructType.fromDDL(_SLICE)
    names = schema.names
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    kinds = [pa.int64(), pa.binary(), longs, longs, longs, longs, pa.list_(pa.string()), longs, pa.binary(), pa.binary(), longs, ints]
    return df.select(key, text).mapInArrow(run, schema)


def count_links(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Aligns every text and weighs its links by the corpus: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The count of a pair of ids is the number of rows that hold it linked; n_best counts the links whose pair has the highest
    count of its id of A, ties included, and count_sum adds the counts over the links. A text that is null or empty, or that
    one of the two does not spell byte by byte, gives zeros and ''. Every row counts, so that repeated rows and rows of one
    key (also null) are rows of their own. Other columns are dropped, so that names cannot clash. An empty table gives no rows.
    """
    key_field = df.schema[key]
    slices = stored(_slice_rows(df, path_a, path_b, key, text), "aligned")
    sent = slices.select(F.col("slice").alias("of"), F.explode(F.arrays_zip("pairs", "docs")).alias("one"))
    sent = sent.select("of", F.col("one.pairs").alias("pair"), F.col("one.docs").alias("docs"))
    counts = stored(sent.groupBy("pair").agg(F.sum("docs").alias("n_docs"), F.count(F.lit(1)).alias("n_slices")), "pairs")
    # One row for each id of A: bounded by its vocabulary.
    best_rows = counts.groupBy((F.col("pair") / F.lit(1 << 32)).cast("long").alias("a")).agg(F.max("n_docs").alias("best")).toArrow()
    best = np.zeros(int(max(best_rows.column("a").to_numpy(), default=0)) + 1, dtype=np.int64)
    best[best_rows.column("a").to_numpy()] = best_rows.column("best").to_numpy()
    # No more than COMMON_PAIRS pairs can be in more than this many slices.
    share = int(counts.agg(F.sum("n_slices")).first()[0] or 0) // COMMON_PAIRS
    common = counts.filter(F.col("n_slices") > share)
    common_rows = common.select("pair", "n_docs").toArrow()
    order = np.argsort(common_rows.column("pair").to_numpy())
    shared = df.sparkSession.sparkContext.broadcast(
        (common_rows.column("pair").to_numpy()[order], common_rows.column("n_docs").to_numpy()[order], best)
    )
    rare = sent.join(F.broadcast(common.select("pair")), "pair", "left_anti").select("of", "pair")
    rare = rare.join(counts.filter(F.col("n_slices") <= share).select("pair", "n_docs"), "pair")

    def finish(group: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        known, known_docs, best = shared.value
        out = []
        for one in left.to_batches():
            for row in range(one.num_rows):
                held = {name: one.column(name)[row] for name in one.schema.names}
                pairs = held["pairs"].values.to_numpy()
                n_docs = np.zeros(len(pairs), dtype=np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
                    n_docs = np.where(known[at] == pairs, known_docs[at], 0)
                n_docs[np.searchsorted(pairs, right.column("pair").to_numpy())] = right.column("n_docs").to_numpy()
                code = np.cumsum(np.frombuffer(held["codes"].as_buffer(), dtype="<i4"), dtype=np.int64)
                times = np.frombuffer(held["times"].as_buffer(), dtype="<i4").astype(np.int64)
                weights = np.stack([times * (n_docs == best[pairs >> 32])[code], times * n_docs[code]])
                ends = ragged.offsets(held["rows"].values.to_numpy())
                sums = np.concatenate([np.zeros((2, 1), dtype=np.int64), np.cumsum(weights, axis=1)], axis=1)[:, ends]
                with pa.ipc.open_stream(held["key"].as_buffer()) as stream:
                    keys = stream.read_all().column(0).combine_chunks()
                n_best, count_sum = np.diff(sums, axis=1)
                columns = [keys, *(held[name].values for name in ("n_a", "n_b", "n_groups", "n_links"))]
                out.append(pa.Table.from_arrays([*columns, pa.array(n_best), pa.array(count_sum), held["sha256"].values], schema.names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], f.type) for f in empty], schema.names)

    schema = T.StructType([key_field, *T.StructType.fromDDL(_ROW)])
    kinds = [pa.int64()] * 7 + [pa.string()]
    empty = [pa.field(name, kind) for name, kind in zip(schema.names, kinds)]
    payload = slices.drop("docs")
    return payload.groupBy("slice").cogroup(rare.groupBy("of")).applyInArrow(finish, schema)


def op11_token_alignment(spark: SparkSession, folder: str, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The tokens of every document by a byte-level BPE (A) and by sentencepiece (B): their groups, links and counts."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return count_links(documents, path_a or vocabulary("byte_bpe_50k.json"), path_b or vocabulary("piece_bpe_32k.model"))
