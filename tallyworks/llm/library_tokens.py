"""Token ids of whole columns of text by the tokenizers library, each distinct word of a batch encoded once.

For vocabularies of words that drop white space and lower the case of letters: a text is cut at blanks of ASCII, and plain
words (letters of ASCII and of the Latin extension A) also from the ASCII punctuation that follows them. No token spans such
a cut. The ids of a text are then those of its pieces in turn, which are the ids of the text as a whole.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tallyworks.llm import ragged
from tallyworks.session import small_batches

JOINED = 200
#: Words that a worker keeps, over tasks; they take some 20 MB.
CACHED = 1 << 19
#: Encoding holds some forty times the bytes of a slice.
SLICE = 2 << 20


BLANK, PLAIN, MARK, LETTER, SIGN = (1 << bit for bit in range(5))
BLANKS = bytes([*range(0x09, 0x0E), 0x20])


def _kinds() -> bytes:
    """For each byte the bits of what it may be."""
    found = np.zeros(256, dtype=np.uint8)
    found[list(BLANKS)] |= BLANK
    # Bytes of ASCII and of letters U+00C0 to U+017F. Combining marks and blanks beyond ASCII have other lead bytes.
    for low, high in ((0x09, 0x0D), (0x20, 0x7E), (0x80, 0xBF), (0xC3, 0xC5)):
        found[low : high + 1] |= PLAIN
    # Punctuation of ASCII but the apostrophe, which may begin a token with the letters after it.
    for low, high in ((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)):
        found[low : high + 1] |= MARK
    for low, high in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xBF), (0xC3, 0xC5)):
        found[low : high + 1] |= LETTER
    found[[0x97, 0xB7, 0xB0]] |= SIGN
    return found.tobytes()


KINDS = _kinds()
#: Kept words have at most so many bytes.
LONGEST = 64
_PRINT = np.random.default_rng(49).integers(1, 1 << 63, LONGEST << 8, dtype=np.uint64)


def _kinds_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data.translate(KINDS), dtype=np.uint8)


def _letters(flat: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Which bytes belong to a plain letter."""
    letters = (kinds & LETTER) != 0
    # The signs of multiplication and division are no letters; the dotted capital I has a mark in lower case.
    at = np.flatnonzero(kinds[1:] & SIGN) + 1
    at = at[flat[at - 1] == np.where(flat[at] == 0xB0, 0xC4, 0xC3)]
    letters[at] = letters[at - 1] = False
    return letters


def _word_prints(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each word."""
    if not len(flat):
        return np.empty(0, dtype=np.uint64)
    place = np.arange(len(flat)) - np.repeat(bounds[:-1], np.diff(bounds))
    return np.add.reduceat(_PRINT[np.minimum(place, LONGEST - 1) << 8 | flat], bounds[:-1])


def _more(flat: np.ndarray, bounds: np.ndarray, added: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs with others after them."""
    return np.concatenate([flat, added]), np.concatenate([bounds, bounds[-1] + np.cumsum(lengths)])


class WordTokens:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(self.size, dtype=bool)
        for token, number in vocab.items():
            self.ends[number] = token.endswith("</w>")
        self.forget()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content.lower().encode() for token in added]

    def forget(self) -> None:
        """Drops the words that are kept."""
        self.prints, self.number = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int32)  # ascending, and whose they are
        self.known, self.known_bounds = np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
        self.kept, self.kept_bounds = np.empty(0, dtype=self.kind), np.zeros(1, dtype=np.int64)

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece, flat, and their lengths."""
        flat, bounds = ragged.text_bytes(words)
        kinds = _kinds_of(flat.tobytes())
        plain = np.ones(len(words), dtype=bool)
        plain[np.searchsorted(bounds, np.flatnonzero(~(_letters(flat, kinds) & ((kinds & PLAIN) != 0))), side="right") - 1] = False
        number = np.empty(len(words), dtype=np.int64)
        number[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(words))
        ids, lengths = self._letter_words(words.filter(pa.array(plain)))
        others = words.filter(pa.array(~plain)).cast(pa.large_string()).to_pylist()
        rest = [one.ids for one in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        ids = np.concatenate([ids, np.array([i for one in rest for i in one], dtype=self.kind)])
        lengths = np.concatenate([lengths, np.array([len(one) for one in rest], dtype=np.int64)])
        return ragged.take(ids, ragged.offsets(lengths), number)

    def _kept_index(self, flat: np.ndarray, bounds: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The number of each word among the kept ones, or -1. Words are compared whole, as two may have one hash."""
        if not len(self.prints):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.prints, codes), len(self.prints) - 1)
        index = np.where(self.prints[at] == codes, self.number[at], -1).astype(np.int64)
        sizes = np.diff(bounds)
        index[sizes != np.diff(self.known_bounds)[index]] = -1
        hit = np.flatnonzero(index >= 0)
        ours, _ = ragged.take(flat, bounds, hit)
        theirs, _ = ragged.take(self.known, self.known_bounds, index[hit])
        index[hit[np.searchsorted(ragged.offsets(sizes[hit]), np.flatnonzero(ours != theirs), side="right") - 1]] = -1
        return index

    def _letter_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words of letters, flat, and their lengths. The first CACHED words that come up are kept for later slices."""
        flat, bounds = ragged.text_bytes(words)
        codes = _word_prints(flat, bounds)
        index = self._kept_index(flat, bounds, codes)
        missing = np.flatnonzero(index < 0)
        flat, sizes = ragged.take(flat, bounds, missing)
        bounds = ragged.offsets(sizes)
        spaced = np.insert(flat, bounds[1:], 0x20).tobytes()
        cuts = (bounds + np.arange(len(bounds))).tolist()
        cuts = [*cuts[:-1:JOINED], cuts[-1]]
        joined = [spaced[begin:end].decode() for begin, end in zip(cuts, cuts[1:])]
        found = [np.array(one.ids, dtype=self.kind) for one in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate([np.empty(0, dtype=self.kind), *found])
        lengths = np.diff(np.append(-1, np.flatnonzero(self.ends[ids])))
        if len(lengths) != len(missing):
            raise ValueError("the vocabulary does not mark the ends of words")
        first = len(self.kept_bounds) - 1
        index[missing] = first + np.arange(len(missing))
        ends = ragged.offsets(lengths)
        result = ragged.take(np.concatenate([self.kept, ids]), np.concatenate([self.kept_bounds, self.kept_bounds[-1] + ends[1:]]), index)
        chosen = np.flatnonzero(sizes <= LONGEST)[: CACHED - first]
        if len(chosen):
            prints = np.concatenate([self.prints, codes[missing[chosen]]])
            number = np.concatenate([self.number, first + np.arange(len(chosen), dtype=np.int32)])
            self.prints, one = np.unique(prints, return_index=True)
            self.number = number[one]
            self.known, self.known_bounds = _more(self.known, self.known_bounds, *ragged.take(flat, bounds, chosen))
            self.kept, self.kept_bounds = _more(self.kept, self.kept_bounds, *ragged.take(ids, ends, chosen))
        return result

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text, flat, and their lengths; null counts as empty."""
        flat, bounds = ragged.text_bytes(column)
        data = flat.tobytes()
        lowered = data.lower()
        if any(name in lowered for name in self.special):
            return self._whole(column)
        kinds = _kinds_of(data)
        blank = (kinds & BLANK) != 0
        n = len(flat)
        if not n or blank.all():
            return np.empty(0, dtype=self.kind), np.zeros(len(bounds) - 1, dtype=np.int64)
        starts = ~blank
        starts[1:] &= blank[:-1]
        starts[bounds[:-1][bounds[:-1] < n]] = True
        starts &= ~blank
        # Words with a byte that is not plain stay as they are.
        at = np.flatnonzero(starts)
        odd = np.unique(np.searchsorted(at, np.flatnonzero((kinds & PLAIN) == 0), side="right") - 1)
        odd = ragged.places(at[odd], np.diff(np.append(at, n))[odd])
        cut = (kinds & MARK) != 0
        cut[odd] = False
        starts[1:] |= _letters(flat, kinds)[:-1] & cut[1:]
        if len(odd):
            mixed = np.frombuffer(lowered, dtype=np.uint8).copy()
            mixed[odd] = flat[odd]
            lowered = mixed.tobytes()
        # Blanks go; piece bounds move with the bytes that stay.
        shift = np.zeros(n + 1, dtype=np.int32)
        np.cumsum(~blank, out=shift[1:])
        kept = np.frombuffer(lowered.translate(None, BLANKS), dtype=np.uint8)
        cuts = shift[np.flatnonzero(starts)]
        coded = ragged.pieces(kept, np.append(cuts, np.int32(len(kept)))).dictionary_encode()
        ids, lengths = self._pieces(coded.dictionary)
        ids, lengths = ragged.take(ids, ragged.offsets(lengths), coded.indices.to_numpy())
        ends = ragged.offsets(lengths)
        return ids, np.diff(ends[np.searchsorted(cuts, shift[bounds])])

    def _whole(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Row by row: texts that hold a special token in any case go to the library as they are, the others the usual way."""
        ids, lengths = [np.empty(0, dtype=self.kind)], []
        for at in range(len(column)):
            text = column[at].as_py() or ""
            if any(name in text.encode().lower() for name in self.special):
                found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind)
            else:
                found, _ = self.encode(column.slice(at, 1))
            ids.append(found)
            lengths.append(len(found))
        return np.concatenate(ids), np.array(lengths, dtype=np.int64)

    def encode_ended(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """As encode, with the end id after each text."""
        ids, lengths = self.encode(column)
        return np.insert(ids, np.cumsum(lengths), end), lengths + 1


@lru_cache(maxsize=2)
def words(path: str) -> WordTokens:
    return WordTokens(path)


def tokenize(
    df: DataFrame,
    path: str,
    end: int,
    text: str = "text",
    ids: str = "ids",
    key: str | None = None,
    key_of: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """The columns of the table without the text, and the ids of each text with the end id, as little-endian bytes.

    The bytes hold 16 bits for an id if the vocabulary allows, else 32 bits (see id_type). A null or empty text gives the
    end id alone. Texts of any length are encoded whole, repeated rows alike; an empty table gives no rows.
    A column of the input with the name of the ids is replaced. key_of may give one more column of long, from all ids and the
    lengths of the texts.
    """
    small_batches(df.sparkSession)
    kept = [field for field in df.schema.fields if field.name not in (text, ids, key)]
    more = [T.StructField(key, T.LongType())] if key else []
    schema = T.StructType([*kept, T.StructField(ids, T.BinaryType()), *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokens = words(path)
        ragged.give_back()
        for batch in ragged.slices(batches, text, SLICE):
            found, lengths = tokens.encode_ended(batch.column(text), end)
            data = found.view(np.uint8)
            column = ragged.pieces(data, ragged.offsets(lengths * tokens.kind.itemsize)).cast(pa.binary())
            columns = [*(batch.column(field.name) for field in kept), column]
            if key:
                columns.append(pa.array(key_of(found, lengths)))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.mapInArrow(ragged.lean(run), schema)


def id_type(path: str) -> np.dtype:
    return words(path).kind
