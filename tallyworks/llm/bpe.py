"""Byte-level BPE: encoding and decoding of whole columns of text.

Texts are cut where a token always begins, distinct pieces are found once per batch,
and the symbols of all pieces stand in one flat array. Each round finds the rank of every
neighbouring pair by binary search over the sorted pair keys, and merges the lowest-ranked
pair of every piece at once. A pair that holds a new symbol ranks after the merge that made it,
so that all places of the lowest pair of a piece can be merged in one round.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tallyworks.llm import ragged

#: The pattern that byte-level BPE of this family splits text by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPLIT = regex.compile(PATTERN)
NO_RANK = np.iinfo(np.int32).max


def _bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


#: Bytes after which a space before them surely begins a token: none of the lead bytes of blanks beyond ASCII.
CLEAR = _bytes_in((0x21, 0x7E), (0xC3, 0xDF), (0xE4, 0xF4))
#: Bytes of ASCII and Latin letters with marks, which every version of the character tables treats alike.
PLAIN = _bytes_in((0x09, 0x0A), (0x0D, 0x0D), (0x20, 0x7E), (0x80, 0xBF), (0xC3, 0xC5))


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable bytes stand for themselves, others follow from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, extra = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in shown else extra))
        extra += byte not in shown
    return letters


class Merges:
    """The pairs of a vocabulary file as sorted keys, with ranks and results."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocab = content["model"]["vocab"]
        letters = byte_letters()
        self.byte_of = {letter: byte for byte, letter in enumerate(letters)}
        self.first = np.array([vocab[letter] for letter in letters], dtype=np.int64)
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in content["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        names = {number: bytes(self.byte_of[letter] for letter in token) for token, number in vocab.items() if token not in self.special}
        names |= {number: token.encode() for token, number in self.special.items()}
        words = [names.get(number, b"") for number in range(max(names) + 1)]
        self.spelled = np.frombuffer(b"".join(words), dtype=np.uint8)
        self.spelled_bounds = ragged.offsets(np.array([len(word) for word in words]))

    def merge(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges every run of symbols as far as it goes: flat ids and lengths."""
        n = len(bounds) - 1
        done_ids, done_runs = [], []
        runs = np.repeat(np.arange(n), np.diff(bounds))
        while len(symbols):
            inside = runs[:-1] == runs[1:]
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = inside & (self.keys[at] == key)
            rank = np.append(np.where(known, self.ranks[at], NO_RANK), NO_RANK).astype(np.int32)
            starts = np.flatnonzero(np.append(True, ~inside))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            low = np.repeat(lowest, sizes)
            over = low == NO_RANK
            if over.any():
                done_ids.append(symbols[over])
                done_runs.append(runs[over])
            chosen = (rank == low) & ~over
            # Neighbouring places of one pair overlap: every second one counts, from the left.
            follows = np.append(False, chosen[:-1]) & chosen
            if follows.any():
                index = np.arange(len(chosen))
                begin = np.maximum.accumulate(np.where(chosen & ~follows, index, 0))
                chosen &= (index - begin) % 2 == 0
            where = np.flatnonzero(chosen)
            symbols = symbols.copy()
            symbols[where] = self.made[at[where]]
            keep = ~over
            keep[where + 1] = False
            symbols, runs = symbols[keep], runs[keep]
        if not done_ids:
            return np.empty(0, dtype=np.int64), np.zeros(n, dtype=np.int64)
        ids, runs = np.concatenate(done_ids), np.concatenate(done_runs)
        order = np.argsort(runs, kind="stable")
        return ids[order], np.bincount(runs, minlength=n)

    def split(self, flat: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The words of pieces of text, with the bounds of the pieces in them and the place of each piece in these bounds.

        Pieces of plain characters that begin with a clear cut are split by one run of the pattern over all of them;
        the tokenizer's own splitter takes the others.
        """
        n = len(bounds) - 1
        sizes = np.diff(bounds)
        odd = np.append(np.add.reduceat(~PLAIN[flat], np.minimum(bounds[:-1], len(flat) - 1)), 0)[:n] > 0
        second = flat[np.minimum(bounds[:-1] + 1, len(flat) - 1)]
        plain = ~odd & (sizes > 1) & (flat[bounds[:-1]] == 0x20) & CLEAR[second]
        order = np.empty(n, dtype=np.int64)
        order[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(n)
        joined, lengths = ragged.take(flat, bounds, np.flatnonzero(plain))
        found = SPLIT.findall(joined.tobytes().decode())
        _, ends = ragged.text_bytes(pa.array(found, pa.large_string()))
        counts = [np.diff(np.searchsorted(ends, ragged.offsets(lengths)))]
        for at in np.flatnonzero(~plain):
            piece = flat[bounds[at] : bounds[at + 1]].tobytes().decode()
            parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)
            found.extend(bytes(self.byte_of[letter] for letter in part).decode() for part, _ in parts)
            counts.append(np.array([len(parts)]))
        return pa.array(found, pa.large_string()), ragged.offsets(np.concatenate(counts)), order

    def encode(self, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text, flat, and their lengths. Special tokens are ordinary text here."""
        if not len(flat):
            return np.empty(0, dtype=np.int64), np.zeros(len(bounds) - 1, dtype=np.int64)
        cuts = np.zeros(len(flat) + 1, dtype=bool)
        cuts[:-2] = (flat[:-1] == 0x20) & CLEAR[flat[1:]]
        cuts[bounds] = True
        cuts = np.flatnonzero(cuts)
        coded = ragged.pieces(flat, cuts).dictionary_encode()
        words, part_bounds, order = self.split(*ragged.text_bytes(coded.dictionary))
        words = words.dictionary_encode()
        spelled, spelled_bounds = ragged.text_bytes(words.dictionary)
        ids, lengths = self.merge(self.first[spelled], spelled_bounds)
        # From ids of words to ids of pieces, and from these to ids of texts.
        word_of = words.indices.to_numpy().astype(np.int64)
        ids, lengths = ragged.take(ids, ragged.offsets(lengths), word_of)
        word_ends = ragged.offsets(lengths)
        piece_bounds = word_ends[part_bounds]
        of = order[coded.indices.to_numpy()]
        ids, lengths = ragged.take(ids, piece_bounds, of)
        ends = ragged.offsets(lengths)
        return ids, np.diff(ends[np.searchsorted(cuts, bounds)])

    def encode_texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text, flat, and their lengths. Special tokens in a text become their ids, as in the library."""
        flat, bounds = ragged.text_bytes(column)
        whole = flat.tobytes()
        if not any(name.encode() in whole for name in self.special):
            return self.encode(flat, bounds)
        lengths, parts, owner, marks = [], [], [], []
        for row, text in enumerate(whole[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:])):
            begin = 0
            for found in [*self.specials.finditer(text), None]:
                part = text[begin : found.start() if found else len(text)].encode()
                parts.append(part)
                lengths.append(len(part))
                owner.append(row)
                marks.append(self.special[found[0]] if found else -1)
                begin = found.end() if found else 0
        ids, sizes = self.encode(np.frombuffer(b"".join(parts), dtype=np.uint8), ragged.offsets(np.array(lengths)))
        # Each part is followed by its special token, if it has one.
        marks = np.array(marks, dtype=np.int64)
        ends = np.cumsum(sizes)
        after = marks >= 0
        ids = np.insert(ids, ends[after], marks[after])
        return ids, np.bincount(np.array(owner), weights=sizes + after, minlength=len(bounds) - 1).astype(np.int64)

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """The texts that runs of ids spell."""
        spelled, sizes = ragged.take(self.spelled, self.spelled_bounds, ids)
        ends = ragged.offsets(sizes)[ragged.offsets(lengths)]
        whole = spelled.tobytes()
        return [whole[a:b].decode(errors="replace") for a, b in zip(ends[:-1], ends[1:])]


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), column], [*names, name])


def _added(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(field for field in df.schema.fields if field.name != name), T.StructField(name, kind)])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of each text as an array of int.

    A null or empty text has no ids. Texts of any length are encoded whole. Rows stand alone, so that repeated rows
    have the same ids and an empty table gives no rows. A column of the input with the name of the ids is replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merges(path)
        for batch in ragged.slices(batches, text):
            found, lengths = table.encode_texts(batch.column(text))
            column = pa.ListArray.from_arrays(pa.array(ragged.offsets(lengths), pa.int32()), pa.array(found, pa.int32()))
            yield _with(batch, ids, column)

    return df.mapInArrow(run, _added(df, ids, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text that each array of ids spells, special tokens included. Null ids and unknown ids spell nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merges(path)
        for batch in ragged.slices(batches, ids, ragged.BATCH_BYTES // 8):
            column = batch.column(ids)
            lengths = np.diff(ragged.list_bounds(column))
            found = column.flatten().to_numpy(zero_copy_only=False)
            known = found < len(table.spelled_bounds) - 1
            if not known.all():
                found = np.where(known, found, 0)
            yield _with(batch, text, pa.array(table.decode(found, lengths), pa.string()))

    return df.mapInArrow(run, _added(df, text, T.StringType()))


def op8_bpe(spark, folder: str, path: str | None = None) -> DataFrame:
    """Digests of the ids of every document and of the text that they decode to."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    path = path or vocabulary("byte_bpe_50k.json")
    coded = encode(documents, path).drop("text")
    return decode(coded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def vocabulary(name: str) -> str:
    """The place of one of the installed public vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path(name)
