"""Personal data by patterns and a skip-chain conditional random field.

The patterns give the base spans. The field labels words with a digit or an at sign: chain edges join neighbouring words,
skip edges join each word to the one before it in the text that repeats it or ends in the same seven digits, where the digits
of words that follow each other count as one number. Words in base spans are observed; loopy message passing carries their
labels to the other mentions, such as a number without its prefix. The potentials are fitted by pseudo-likelihood on a sample of documents, labelled by the patterns: each word is predicted from
its form and the labels of its neighbours in the chain and over skips.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import ragged
from tallyworks.llm.samples import by_hash
from tallyworks.session import small_batches

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 2000
SAMPLE_WORDS = 200
SURE = 0.9
ROUNDS = 12
ITERATIONS = 150
TAIL = 7

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")

ENTITY = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]
)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses from each at sign: the run of local characters before it, and the longest domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """The pattern matches of a text as (start, kind, end), in order."""
    found = [(start, 0, end) for start, end in _emails(text)]
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in match[0].split(".")):
            found.append((match.start(), 1, match.end()))
    for match in CARD.finditer(text):
        if 12 <= match.end() - match.start() <= 2 * 19:
            digits = match[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), 2, match.end()))
    for match in PHONE.finditer(text):
        if 9 <= sum(letter.isdigit() for letter in match[0]) <= 15:
            found.append((match.start(), 3, match.end()))
    return sorted(found)


@dataclass
class Words:
    """The words of a text that the field labels: their places, forms, edges and observed labels (-1: none)."""

    spans: list[tuple[int, int]]
    forms: np.ndarray
    chain: np.ndarray
    skips: np.ndarray
    seen: np.ndarray


def _form(word: str, digits: str, before: bool, after: bool) -> list[float]:
    n, has_at = len(digits), "@" in word
    bins = [n == 0, 1 <= n <= 3, 4 <= n <= 6, 7 <= n <= 8, 9 <= n <= 11, 12 <= n <= 19, n > 19]
    letters = sum(letter.isalpha() for letter in word)
    signs = [has_at, has_at and "." in word.rpartition("@")[2], word.count(".") >= 3 and not letters, word.startswith("+")]
    signs += ["(" in word or ")" in word, "-" in word and not letters, letters == 0, letters > n, before, after]
    return [1.0, *map(float, bins), *map(float, signs)]


FORM_SIZE = len(_form("1", "1", False, False))


def words_of(text: str, base: list[tuple[int, int, int]]) -> Words:
    spans, forms, chain, skips, seen = [], [], [], [], []
    last: dict[str, list[int]] = {}
    joined, owners = "", []
    matches = list(WORD.finditer(text))
    at = 0
    reach = 0
    for index, match in enumerate(matches):
        start, end = match.span()
        word = match[0]
        digits = "".join(letter for letter in word if "0" <= letter <= "9")
        near = index > 0 and start - matches[index - 1].end() == 1
        follows = index + 1 < len(matches) and matches[index + 1].start() - end == 1
        spans.append((start, end))
        forms.append(_form(word, digits, near, follows))
        if near:
            chain.append((index - 1, index))
        # The last digits up to this word, and the word that each of them is in.
        plain = "@" not in word and not any(letter.isalpha() for letter in word)
        joined, owners = (joined[-TAIL:], owners[-TAIL:]) if near and plain else ("", [])
        joined, owners = joined + digits, owners + [index] * len(digits)
        keys = {word.lower().strip(".,;:!?()[]<>\"'"): [index] * TAIL}
        if len(joined) >= TAIL:
            keys[joined[-TAIL:]] = owners[-TAIL:]
        for key, places in keys.items():
            if len(key) >= 4:
                skips += [(a, b) for a, b in zip(last.get(key, []), places) if a != b]
                last[key] = places
        if not plain:
            joined, owners = "", []
        while at < len(base) and base[at][2] <= start:
            at += 1
        label, reach = -1, at
        while reach < len(base) and base[reach][0] < end:
            if base[reach][2] > start:
                label = base[reach][1] + 1
                break
            reach += 1
        seen.append(label)
    pairs = [np.array(sorted(set(edges)), dtype=np.int64).reshape(-1, 2) for edges in (chain, skips)]
    return Words(spans, np.array(forms).reshape(-1, FORM_SIZE), *pairs, np.array(seen, dtype=np.int64))


LABELS = len(KINDS) + 1


def _neighbours(words: Words, labels: np.ndarray) -> np.ndarray:
    """For each word the labels of its neighbours: before, after and over skips, as counts."""
    one = np.eye(LABELS)[labels]
    found = np.zeros((len(labels), 3 * LABELS))
    np.add.at(found[:, :LABELS], words.chain[:, 1], one[words.chain[:, 0]])
    np.add.at(found[:, LABELS : 2 * LABELS], words.chain[:, 0], one[words.chain[:, 1]])
    for a, b in ((0, 1), (1, 0)):
        np.add.at(found[:, 2 * LABELS :], words.skips[:, a], one[words.skips[:, b]])
    return found


@dataclass(frozen=True)
class Field:
    """Log potentials of forms, of neighbours in the chain, and over skips."""

    form: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def posterior(self, words: Words) -> np.ndarray:
        """The label probabilities of each word after rounds of message passing."""
        n = len(words.seen)
        node = np.exp(words.forms @ self.form - (words.forms @ self.form).max(axis=1, keepdims=True))
        fixed = words.seen > 0
        node[fixed] = np.eye(LABELS)[words.seen[fixed]]
        edges = np.concatenate([words.chain, words.skips])
        if not len(edges):
            return node / node.sum(axis=1, keepdims=True)
        pair = np.concatenate(
            [np.repeat(np.exp(table - table.max())[None], len(some), axis=0) for table, some in ((self.chain, words.chain), (self.skip, words.skips))]
        )
        # One message for each direction of each edge; the second half runs backwards.
        source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        table = np.concatenate([pair, pair.transpose(0, 2, 1)])
        message = np.full((len(source), LABELS), 1.0 / LABELS)
        back = np.roll(np.arange(len(source)), len(edges))
        for _ in range(ROUNDS):
            total = np.log(node + 1e-300)
            np.add.at(total, target, np.log(message))
            out = total[source] - np.log(message[back])
            out = np.exp(out - out.max(axis=1, keepdims=True))
            message = np.einsum("ei,eij->ej", out, table) + 1e-12
            message /= message.sum(axis=1, keepdims=True)
        total = np.log(node + 1e-300)
        np.add.at(total, target, np.log(message))
        belief = np.exp(total - total.max(axis=1, keepdims=True))
        assert len(belief) == n
        return belief / belief.sum(axis=1, keepdims=True)


def fit(features: np.ndarray, labels: np.ndarray) -> Field:
    """Potentials by pseudo-likelihood with a squared penalty, by accelerated gradient steps."""
    size = FORM_SIZE + 3 * LABELS
    weights = np.zeros((size, LABELS))
    if len(features):
        wanted, ahead, penalty = np.eye(LABELS)[labels], weights.copy(), 1e-3
        step = 1.0 / (0.5 * (features**2).sum(axis=1).mean() + penalty)
        for k in range(ITERATIONS):
            score = features @ ahead
            score = np.exp(score - score.max(axis=1, keepdims=True))
            slope = features.T @ (score / score.sum(axis=1, keepdims=True) - wanted) / len(features) + penalty * ahead
            new = ahead - step * slope
            ahead, weights = new + k / (k + 3) * (new - weights), new
    before, after, skip = (weights[FORM_SIZE + k * LABELS : FORM_SIZE + (k + 1) * LABELS] for k in range(3))
    return Field(weights[:FORM_SIZE], (before + after.T) / 2, (skip + skip.T) / 2)


def even_steps(n: int, most: int) -> np.ndarray:
    """At most so many of n places, spread evenly from the first to the last."""
    return np.arange(n) if n <= most else np.arange(most) * (n - 1) // (most - 1)


def added_spans(text: str, base: list[tuple[int, int, int]], field: Field) -> list[tuple[int, int, int]]:
    """Runs of neighbouring words outside base spans that the field surely gives one kind.

    The field carries labels from base spans to other mentions, so a text without a base span has none: by forms alone, long
    runs of words with digits would pass for personal data.
    """
    words = words_of(text, base)
    if not (words.seen < 0).any() or not (words.seen > 0).any():
        return []
    belief = field.posterior(words)
    label = np.where((belief.max(axis=1) >= SURE) & (words.seen < 0), belief.argmax(axis=1), 0)
    joined = {(a, b) for a, b in words.chain.tolist() if label[a] == label[b] > 0}
    found, at = [], 0
    while at < len(label):
        end = at
        while (end, end + 1) in joined:
            end += 1
        if label[at]:
            start, stop = words.spans[at][0], words.spans[end][1]
            while stop > start and not (text[stop - 1].isalnum()):
                stop -= 1
            while start < stop and not (text[start].isalnum() or text[start] in "+("):
                start += 1
            digits = sum("0" <= letter <= "9" for letter in text[start:stop])
            if digits >= TAIL or (label[at] == 1 and "@" in text[start:stop]):
                found.append((start, int(label[at]) - 1, stop))
        at = end + 1
    return found


def _may_hold(column: pa.Array) -> np.ndarray:
    """Which texts have a digit or an at sign."""
    flat, bounds = ragged.text_bytes(column)
    hits = np.append(0, np.cumsum(((flat >= 0x30) & (flat <= 0x39)) | (flat == 0x40)))
    return hits[bounds[1:]] > hits[bounds[:-1]]


def train(df: DataFrame, text: str = "text", sample: int = SAMPLE_DOCS) -> Field:
    """The field, fitted on at most so many texts with a digit or an at sign: those with small hashes.

    Of each, at most SAMPLE_WORDS words are used, at even steps over the text, so that the sample is bounded. The documents of
    the sample are the same however the rows lie.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, labels = [], []
            for value in batch.column("text").to_pylist():
                base = base_spans(value)
                words = words_of(value, base)
                given = np.maximum(words.seen, 0)
                chosen = even_steps(len(given), SAMPLE_WORDS)
                features.extend(np.hstack([words.forms, _neighbours(words, given)])[chosen].tolist())
                labels.extend(given[chosen].tolist())
            yield pa.record_batch([pa.array(features, pa.list_(pa.float64())), pa.array(labels, pa.int32())], ["x", "y"])

    texts = df.select(F.col(text).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    table = by_hash(texts, ["text"], sample).mapInArrow(rows, "x array<double>, y int").toArrow()
    features = np.array(table.column("x").to_pylist()).reshape(-1, FORM_SIZE + 3 * LABELS)
    return fit(features, table.column("y").to_numpy().astype(np.int64))


def find_entities(df: DataFrame, field: Field, text: str = "text", entities: str = "entities") -> DataFrame:
    """Adds the personal data of each text: an array of (start, kind, end, base) in order, in code points, end exclusive.

    kind is the place in KINDS; base tells pattern matches from what the field adds, which is nothing in a text without a
    pattern match. A null or empty text has none. Texts of
    any length are searched whole. Rows stand alone, so that repeated rows have the same entities and an empty table gives no
    rows. A column of the input with the name of the entities is replaced.
    """
    run, schema = _finder(df.schema, field, text, entities)
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def _finder(given: T.StructType, field: Field, text: str, entities: str) -> tuple[Callable, T.StructType]:
    """What find_entities does to batches, and the columns that come of it."""
    fields = [one for one in given.fields if one.name != entities]
    schema = T.StructType([*fields, T.StructField(entities, T.ArrayType(ENTITY))])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, text):
            column = batch.column(text)
            found = [[] for _ in range(batch.num_rows)]
            for row in np.flatnonzero(_may_hold(column)).tolist():
                value = column[row].as_py()
                base = base_spans(value)
                rows = [(start, k, end, True) for start, k, end in base]
                rows += [(start, k, end, False) for start, k, end in added_spans(value, base, field)]
                found[row] = [dict(zip(ENTITY.names, one)) for one in sorted(rows)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(found, kind)], schema.names)

    return run, schema


def mask(df: DataFrame, text: str = "text", entities: str = "entities") -> DataFrame:
    """Replaces each entity in the text by its kind in square brackets, and drops the entities.

    Of overlapping entities, a later one begins where those before it end, and one that lies within them adds no mark.
    """
    run, schema = _masker(df.schema, text, entities)
    return df.mapInArrow(run, schema)


def find_and_mask(df: DataFrame, field: Field, text: str = "text", entities: str = "entities") -> DataFrame:
    """As mask of find_entities, by one worker for a task instead of two."""
    find, found = _finder(df.schema, field, text, entities)
    put, schema = _masker(found, text, entities)
    small_batches(df.sparkSession)
    return df.mapInArrow(ragged.lean(lambda batches: put(find(batches))), schema)


def _masker(given: T.StructType, text: str, entities: str) -> tuple[Callable, T.StructType]:
    """What mask does to batches, and the columns that come of it."""
    fields = [one for one in given.fields if one.name != entities]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(entities)
            values = batch.column(text).to_pylist()
            for row in np.flatnonzero(np.diff(ragged.list_bounds(lists))).tolist():
                parts, at = [], 0
                for one in lists[row].as_py():
                    if one["end"] > at:
                        parts += [values[row][at : one["start"]], f"[{KINDS[one['kind']].upper()}]"]
                        at = one["end"]
                values[row] = "".join([*parts, values[row][at:]])
            columns = [pa.array(values, pa.string()) if f.name == text else batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return run, schema


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of base spans by kind, their digest, and all spans, of every document."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = find_entities(documents, train(documents)).drop("text")
    base = F.filter("entities", lambda one: one["base"])
    names = F.array(*map(F.lit, KINDS))

    def written(entities):
        parts = F.transform(entities, lambda one: F.concat_ws(":", F.get(names, one["kind"]), one["start"], one["end"]))
        return F.array_join(parts, ",")

    def number(k: int):
        return F.size(F.filter(base, lambda one: one["kind"] == k)).cast("long")

    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(written(base), 256).alias("base_sha256"),
        written("entities").alias("spans"),
    )
