"""Jaccard join of word shingle sets, light sets by fixed-size subsets and heavy sets by inverted lists.

Two sets link when 100 * intersection >= THRESHOLD * union, so sets of a and b members must share at least
need(a, b) of them. Equal sets are one class, and only the first document of a class goes on.

* Light sets (up to a boundary) list all their subsets of the sizes that a partner may have in common with them. Partners
  meet in an equal subset.
* Heavy sets, and light ones that can link to a heavy one, put the rarest members of their set into inverted lists:
  n - need + 1 members in one order of all members, so that partners meet in a list. The order puts members of many documents
  last. Members that no other document holds are left out.
* The boundary is the one with the lowest cost, from the numbers of sets of each size and the mean length of a list.

No list gives all its pairs. In a few rounds, each member is compared with one other of its list. Only members of a list that
are not in one component by then are compared with each other. Size, place and a sketch of the sets rule out pairs that
cannot link; what is left is decided on the whole sets.
Members are 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import prints, ragged
from tallyworks.llm.components import components, stored
from tallyworks.session import small_batches

THRESHOLD = 85
WORDS = 4
FREQUENT = 32
LARGEST_LIGHT = 26
SLICE = 1 << 20
ROUNDS = 3
SKETCH_BITS = 256
SKETCH = [f"sketch{k}" for k in range(SKETCH_BITS // 64)]

_RANDOM = np.random.default_rng(85)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_STRIDE = 1 << 10


def need(a, b, threshold: int = THRESHOLD):
    """The smallest number of common members with which sets of a and b members link."""
    return -(-threshold * (a + b) // (100 + threshold))


def least_need(n, threshold: int = THRESHOLD):
    """The smallest need of a set of n members with any other set."""
    return -(-threshold * n // 100)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each; made for a slice, so that no worker keeps them."""
    strides = -(-n // _STRIDE)

    def powers(base: int) -> np.ndarray:
        near = np.cumprod(np.append(np.uint64(1), np.full(_STRIDE - 1, base, dtype=np.uint64)))
        far = np.cumprod(np.append(np.uint64(1), np.full(strides - 1, pow(base, _STRIDE, 1 << 64), dtype=np.uint64)))
        return (far[:, None] * near).ravel()[:n]

    return powers(_BASE), powers(_BASE_INVERSE)


def shingle_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, flat, and the bounds of the texts in them."""
    flat, bounds = ragged.text_bytes(column)
    n, rows = len(flat), len(bounds) - 1
    blank = _BLANK[flat]
    begins = ~blank & np.append(True, blank[:-1])[:n]
    inner = bounds[:-1][bounds[:-1] < n]
    begins[inner] = ~blank[inner]
    ends = ~blank & np.append(blank[1:], True)[:n]
    last = bounds[1:][bounds[1:] > 0] - 1
    ends[last] = ~blank[last]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    powers, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[_LOWER[flat]] * powers[:n], out=sums[1:])
    codes = prints.mix((sums[ends] - sums[begins]) * inverse[begins] + (ends - begins).astype(np.uint64))
    row = np.searchsorted(bounds, begins, side="right") - 1
    counts = np.bincount(row, minlength=rows)
    firsts = ragged.offsets(counts)
    # A text of fewer words is one shingle of as many words.
    width = np.minimum(counts, words)
    starts = ragged.places(firsts[:-1], np.maximum(counts - words + 1, np.minimum(counts, 1)))
    owner = row[starts]
    hashes = np.zeros(len(starts), dtype=np.uint64)
    for k in range(words):
        there = width[owner] > k
        hashes[there] = prints.mix(hashes[there] + codes[starts[there] + k] + np.uint64(k + 1))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[: len(hashes)]
    return hashes[new], ragged.offsets(np.bincount(owner[new], minlength=rows))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def set_prints(df: DataFrame, key: str, text: str, words: int = WORDS) -> DataFrame:
    """Of each row: doc_id, n_shingles and two hashes of its set, 128 bits together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, "text", SLICE):
            hashes, bounds = shingle_sets(batch.column("text"), words)
            sizes = np.diff(bounds)
            sums = [np.append(np.uint64(0), np.cumsum(prints.mix(hashes ^ np.uint64(seed)))) for seed in (0, _BASE)]
            codes = [prints.mix(s[bounds[1:]] - s[bounds[:-1]]) for s in sums]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(sizes), *map(_long, codes)], ["doc_id", "n_shingles", "code1", "code2"]
            )

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        ragged.lean(run), "doc_id long, n_shingles long, code1 long, code2 long"
    )


def subset_sizes(n: int, largest: int, threshold: int = THRESHOLD) -> list[int]:
    """The sizes of subsets that a light set of n members lists: the needs with all light partners."""
    partners = range(least_need(n, threshold), min(n * 100 // threshold, largest) + 1)
    return sorted({need(n, b, threshold) for b in partners if need(n, b, threshold) <= min(n, b)})


def light_boundary(sizes: dict[int, int], list_length: float, threshold: int = THRESHOLD) -> int:
    """The largest size of a light set: where listing subsets and scanning lists cost least together, in rows."""

    def cost(boundary: int) -> float:
        total = 0.0
        for n, count in sizes.items():
            if n <= boundary:
                total += count * sum(comb(n, c) for c in subset_sizes(n, boundary, threshold))
            if n * 100 >= threshold * (boundary + 1):
                total += count * (n - least_need(n, threshold) + 1) * (1 + list_length)
        return total

    return min(range(LARGEST_LIGHT + 1), key=cost)


def _list_rows(light: int, tables, words: int, threshold: int):
    """Of each text the rows (entry, doc_id, n, place, sketch) of its subsets and of the lists that it is in.

    A bit of the sketch tells whether an odd number of members falls on it, so that two sets differ in at least as many
    members as their sketches differ in bits.
    """
    heavy_from = -(-threshold * (light + 1) // 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, frequent = (table.value for table in tables)
        for batch in ragged.slices(batches, "text", SLICE):
            hashes, bounds = shingle_sets(batch.column("text"), words)
            sizes = np.diff(bounds)
            entries, rows, places = [], [], []
            for n in np.unique(sizes[(sizes > 0) & (sizes <= light)]).tolist():
                owners = np.flatnonzero(sizes == n)
                members = prints.mix(hashes[bounds[owners][:, None] + np.arange(n)] + np.uint64(_BASE))
                for c in subset_sizes(n, light, threshold):
                    chosen = np.array(list(combinations(range(n), n - c)), dtype=np.int64).reshape(comb(n, c), n - c)
                    left = members.sum(axis=1)[:, None] - members[:, chosen].sum(axis=2)
                    entries.append(prints.mix(left + np.uint64(c)).reshape(-1))
                    rows.append(np.repeat(owners, len(chosen)))
                    places.append(np.full(len(owners) * len(chosen), -1))
            # In one order of all members: those of one document first, the frequent ones last, else by hash.
            owner = np.repeat(np.arange(len(sizes)), sizes)
            slot = owner * SKETCH_BITS + (prints.mix(hashes) >> np.uint64(40)).astype(np.int64) % SKETCH_BITS
            odd = np.bincount(slot, minlength=len(sizes) * SKETCH_BITS).reshape(len(sizes), SKETCH_BITS) & 1
            sketch = np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)
            level = prints.marked(shared, hashes).astype(np.int8) + prints.marked(frequent, hashes)
            order = np.lexsort((hashes, level, owner))
            place = np.arange(len(hashes)) - bounds[owner]
            n = sizes[owner]
            hashes, level = hashes[order], level[order]
            listed = (place <= n - least_need(n, threshold)) & (n >= heavy_from) & (level > 0)
            entries.append(hashes[listed])
            rows.append(owner[listed])
            places.append(place[listed])
            row = np.concatenate(rows)
            yield pa.record_batch(
                [
                    _long(np.concatenate(entries)),
                    pa.array(batch.column("doc_id").to_numpy()[row]),
                    pa.array(sizes[row].astype(np.int32)),
                    pa.array(np.concatenate(places).astype(np.int32)),
                    *(pa.array(sketch[row, k]) for k in range(len(SKETCH))),
                ],
                ["entry", "doc_id", "n", "place", *SKETCH],
            )

    return run


def _may_link(a: str, b: str, threshold: int):
    """Whether two entries of a list pass the filters of size, place and sketch."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    common = F.ceil(F.lit(threshold) * (n + m) / F.lit(100 + threshold))
    rest = F.least(n - F.col(f"{a}.place"), m - F.col(f"{b}.place"))
    sizes = (F.lit(100) * F.least(n, m) >= F.lit(threshold) * F.greatest(n, m)) & (F.col(f"{a}.doc_id") != F.col(f"{b}.doc_id"))
    apart = sum((F.bit_count(F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))) for name in SKETCH), F.lit(0))
    sizes = sizes & (apart <= n + m - 2 * common)
    return sizes & ((F.col(f"{a}.place") < 0) | (F.col(f"{b}.place") < 0) | (rest >= common))


def _pairs(df: DataFrame, a, b) -> DataFrame:
    return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _linked(pairs: DataFrame, documents: DataFrame, words: int, threshold: int) -> DataFrame:
    """The pairs (a, b) of documents whose whole sets link."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, "text", SLICE):
            hashes, bounds = shingle_sets(batch.column("text"), words)
            data = hashes.astype("<u8").view(np.uint8)
            members = ragged.pieces(data, bounds * 8).cast(pa.binary())
            yield pa.record_batch([batch.column("doc_id"), members], ["doc_id", "members"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                one, two = (np.frombuffer(side.as_buffer(), dtype="<u8") for side in (left, right))
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * common >= threshold * (len(one) + len(two) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    found = stored(documents.join(wanted, "doc_id", "left_semi").mapInArrow(ragged.lean(sets), "doc_id long, members binary"), "sets")
    left = found.select(F.col("doc_id").alias("a"), F.col("members").alias("left"))
    right = found.select(F.col("doc_id").alias("b"), F.col("members").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(ragged.lean(compare), "a long, b long").distinct()


def link_documents(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: int = THRESHOLD
) -> DataFrame:
    """Of every row: key, n_shingles and component_id, the smallest key that it reaches over links, itself included.

    The components are whole, but not all links are found on the way: documents that are in one component by then are not
    compared. So there is no list of links, and no number of links of a document.
    A row with a null or empty text, or one of blanks, has an empty set and links with nothing. Rows with equal sets link.
    Rows of one key count as one document, which has the links of all of them. A row without a key has no component.
    Other columns are dropped, so that their names cannot clash. An empty table gives no rows.
    """
    spark = df.sparkSession
    small_batches(spark)
    sets = stored(set_prints(df, key, text, words), "set-prints")
    codes = ["n_shingles", "code1", "code2"]
    classes = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*codes).agg(F.min("doc_id").alias("first"))
    member = stored(sets.join(classes, codes, "left").select("doc_id", "n_shingles", "first"), "set-classes")
    documents = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")

    def hashes_of(batch: pa.RecordBatch) -> np.ndarray:
        return shingle_sets(batch.column("text"), words)[0]

    texts = documents.select("text")
    bits, ranges = prints.table_sizes(texts)
    found, n, n_distinct = prints.frequent(
        texts, hashes_of, [(2, bits), (FREQUENT, bits - 2)], ranges, limit=SLICE, bounded=(False, True)
    )
    # Sizes above the largest light one count as one, so that the driver gets a few numbers only.
    sizes = member.filter("first IS NOT NULL").select(F.least("n_shingles", F.lit(2 * LARGEST_LIGHT)).alias("n"))
    histogram = {row.n: row["count"] for row in sizes.groupBy("n").count().collect()}
    light = light_boundary(histogram, n / max(n_distinct, 1), threshold)
    tables = [spark.sparkContext.broadcast(table) for table in found]  # of a bounded number of bits
    rows = documents.mapInArrow(ragged.lean(_list_rows(light, tables, words, threshold)), ", ".join(["entry long, doc_id long, n int, place int", *(f"{name} long" for name in SKETCH)]))
    firsts = member.filter("first IS NOT NULL AND doc_id = first").select("doc_id").distinct()
    lists = rows.groupBy("entry", "doc_id", "n", *SKETCH).agg(F.min("place").alias("place")).join(firsts, "doc_id", "left_semi")
    lists = stored(lists, "lists")

    doubled = member.filter("first IS NOT NULL AND first <> doc_id").join(firsts, "doc_id", "left_semi")
    links = stored(_pairs(doubled, F.col("doc_id"), F.col("first")), "links")

    # In each round, one member of each list meets those in other components, the same one in lists of the same documents.
    member_of = F.struct("doc_id", "n", "place", *SKETCH)
    now, compared = lists.withColumn("component", F.col("doc_id")), None
    for number in range(ROUNDS):
        one = now.groupBy("entry").agg(
            F.min_by(F.struct(member_of.alias("o"), F.col("component").alias("c")), F.xxhash64("doc_id", F.lit(number))).alias("one"),
            F.min("component").alias("least"),
            F.max("component").alias("most"),
        )
        met = now.join(one.filter("least < most").select("entry", "one"), "entry").filter(F.col("component") != F.col("one.c"))
        met = met.select(member_of.alias("m"), F.col("one.o").alias("o")).filter(_may_link("m", "o", threshold))
        pairs = _pairs(met, F.col("m.doc_id"), F.col("o.doc_id"))
        pairs = stored(pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti"), "pairs")
        compared = pairs if compared is None else compared.union(pairs)
        links = stored(links.union(_linked(pairs, documents, words, threshold)).distinct(), "links")
        named = components(links, "a", "b").withColumnRenamed("node", "doc_id")
        # One link for each document says as much as all that were found; later rounds go on from these.
        links = named.filter("doc_id <> component").select(F.col("doc_id").alias("a"), F.col("component").alias("b"))
        now = lists.join(named, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        now = stored(now, "lists")
    # What is left: entries of one list in different components, each with each of the others.
    ends = now.groupBy("entry").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    mixed = now.join(ends.filter("least < most").select("entry"), "entry")
    rest = mixed.alias("m").join(
        mixed.alias("o"),
        (F.col("m.entry") == F.col("o.entry")) & (F.col("m.doc_id") < F.col("o.doc_id"))
        & (F.col("m.component") != F.col("o.component")) & _may_link("m", "o", threshold),
    )
    pairs = stored(_pairs(rest, F.col("m.doc_id"), F.col("o.doc_id")).join(compared, ["a", "b"], "left_anti"), "pairs")
    links = links.union(_linked(pairs, documents, words, threshold)).distinct()
    named = components(stored(links, "links"), "a", "b").withColumnRenamed("node", "first")
    return member.join(named, "first", "left").select(
        F.col("doc_id").alias(key), "n_shingles", F.coalesce("component", "first", "doc_id").alias("component_id")
    )


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document."""
    return link_documents(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
