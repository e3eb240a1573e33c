"""Repeated byte windows over all documents, by a depth-limited radix sort of suffixes, most significant digit first.

A window of WINDOW bytes is ordered through WINDOW bytes and no further. Its most significant digit is its anchor: of the
DIGIT-byte strings in the window, the one with the smallest hash. The digits of lower significance are the bytes to the
left and right of the anchor. Since all windows of a place share few anchors, a pass moves one row for some fourteen suffixes.

1. First digit: the number of documents with each anchor, from 40-bit prints. Groups of one document are done. The
   others are marked in a bit table of bounded size; a mark too many costs a row in the next pass and changes no result.
2. Second digit: the same for marked anchors with the NEXT bytes to the right, and with those to the left. Every window holds
   one of the two.
3. Further digits: the places that are still marked come together with a hash of the bytes around them. Where these are
   the same for all places of an anchor, all windows around it are equal, and the group is done as well.
4. For the anchors that are left, the bytes go to their group, one row for equal bytes. In the group, the windows at each
   offset to the anchor are sorted by the rest of their bytes. Each group of equal windows gets its smallest document.
5. The windows come back to their documents, where all bytes of windows of an earlier document are cut.

An anchor of HOT or more documents is not held in one task: its places are dealt out by document, and its groups are found by
sums that combine before they move, and joins that Spark can split. Bytes are compared by hashes of 64 bits, together with the 64-bit hash of the anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import prints, ragged
from tallyworks.llm.components import stored
from tallyworks.session import small_batches

WINDOW = 50
DIGIT = 25
SIDE = WINDOW - DIGIT
STEPS = SIDE + 1
SLICE = 1 << 20
BLOCK = 1 << 18
NEXT = SIDE // 2 + 1
HOT = 20_000
COMBINE_ROWS = 100_000
ALL_WINDOWS = (1 << STEPS) - 1
HOT_ROW = -1
NONE = np.iinfo(np.int64).max

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.default_rng(2024)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_LEFT = _RANDOM.integers(1, 1 << 63, SIDE, dtype=np.uint64) | np.uint64(1)
_RIGHT = _RANDOM.integers(1, 1 << 63, SIDE, dtype=np.uint64) | np.uint64(1)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        with np.errstate(over="ignore"):
            _powers = tuple(
                np.cumprod(np.append(np.uint64(1), np.full(size - 1, base, dtype=np.uint64))) for base in (_BASE, _BASE_INVERSE)
            )
    return _powers


def _sliding(values: np.ndarray, least) -> np.ndarray:
    """The least (or largest) of each STEPS neighbouring values."""
    width = 1
    while 2 * width <= STEPS:
        values = least(values[:-width], values[width:])
        width *= 2
    rest = STEPS - width
    return least(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all windows that lie in one text, and their hashes."""
    n = len(flat)
    if n < WINDOW:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    powers, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[flat] * powers[:n], out=sums[1:])
    grams = prints.mix((sums[DIGIT:] - sums[:-DIGIT]) * inverse[: n - DIGIT + 1])
    lowest = _sliding(grams, np.minimum)
    tails = np.minimum(np.diff(bounds), WINDOW - 1)
    ends = ragged.places(bounds[1:] - tails, tails)
    lowest[ends[ends < len(lowest)]] = 0
    padded = np.zeros(len(lowest) + 2 * SIDE, dtype=np.uint64)
    padded[SIDE : SIDE + len(lowest)] = lowest
    highest = _sliding(padded, np.maximum)
    at = np.flatnonzero((highest == grams) & (highest > 0))
    return at, grams[at]


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and bounds of the texts, the anchors with their rows and hashes."""
    flat, bounds = ragged.text_bytes(batch.column("text"))
    places, codes, begin = [], [], 0
    while begin < batch.num_rows:  # blocks that fit into the caches
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + BLOCK, side="right")) - 1)
        low = bounds[begin]
        at, hashes = anchors(flat[low : bounds[end]], bounds[begin : end + 1] - low)
        places.append(at + low)
        codes.append(hashes)
        begin = end
    at, hashes = np.concatenate(places), np.concatenate(codes)
    return flat, bounds, at, hashes, np.searchsorted(bounds, at, side="right") - 1


def _as_long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _once(codes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The codes of each row, each once for a row."""
    order = np.lexsort((rows, codes))
    codes, rows = codes[order], rows[order]
    return codes[np.append(True, (codes[1:] != codes[:-1]) | (rows[1:] != rows[:-1]))[: len(codes)]]


def _document_anchors(batch: pa.RecordBatch) -> np.ndarray:
    _, _, _, hashes, rows = _rows(batch)
    return _once(hashes, rows)


def _second_digits(flat: np.ndarray, bounds: np.ndarray, at: np.ndarray, hashes: np.ndarray, rows: np.ndarray):
    """Codes of each anchor with the NEXT bytes to its right, and to its left, and where there are as many."""
    right, left = prints.mix(hashes), prints.mix(hashes ^ np.uint64(_BASE))
    for k in range(NEXT):
        right += _BYTE[flat[np.minimum(at + DIGIT + k, len(flat) - 1)]] * _RIGHT[k]
        left += _BYTE[flat[np.maximum(at - 1 - k, 0)]] * _LEFT[k]
    return prints.mix(right), at + DIGIT + NEXT <= bounds[rows + 1], prints.mix(left), at - NEXT >= bounds[rows]


def _document_digits(first):
    def run(batch: pa.RecordBatch) -> np.ndarray:
        flat, bounds, at, hashes, rows = _rows(batch)
        chosen = prints.marked(first.value, hashes)
        at, hashes, rows = at[chosen], hashes[chosen], rows[chosen]
        if not len(at):
            return hashes
        right, has_right, left, has_left = _second_digits(flat, bounds, at, hashes, rows)
        return _once(np.concatenate([right[has_right], left[has_left]]), np.concatenate([rows[has_right], rows[has_left]]))

    return run


def _marked_rows(batch: pa.RecordBatch, first: bytes, second: bytes):
    """As _rows, with the anchors that are marked by both digits."""
    flat, bounds, at, hashes, rows = _rows(batch)
    chosen = prints.marked(first, hashes)
    at, hashes, rows = at[chosen], hashes[chosen], rows[chosen]
    if len(at):
        right, has_right, left, has_left = _second_digits(flat, bounds, at, hashes, rows)
        chosen = (prints.marked(second, right) & has_right) | (prints.marked(second, left) & has_left)
        at, hashes, rows = at[chosen], hashes[chosen], rows[chosen]
    return flat, bounds, at, hashes, rows


def _slots(hashes: np.ndarray, ids: np.ndarray, hot: np.ndarray, count: int) -> pa.Array:
    """The task of each row: by anchor, or by document for a hot anchor."""
    return pa.array((np.where(hot, prints.mix(ids.astype(np.uint64)), hashes) % np.uint64(count)).astype(np.int32))


def _around(flat: np.ndarray, bounds: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The bytes left of each anchor (nearest first) and right of it, 0 outside its text, and how many there are on each side."""
    left = np.minimum(at - bounds[rows], SIDE)
    right = np.minimum(bounds[rows + 1] - at - DIGIT, SIDE)
    steps = np.arange(SIDE)
    before = flat[np.maximum(at[:, None] - 1 - steps, 0)] * (steps < left[:, None])
    after = flat[np.minimum(at[:, None] + DIGIT + steps, len(flat) - 1)] * (steps < right[:, None])
    return np.hstack([before, after, left[:, None], right[:, None]]).astype(np.uint8)


def _context_hash(around: np.ndarray) -> np.ndarray:
    total = np.zeros(len(around), dtype=np.uint64)
    for k in range(SIDE):
        total += _BYTE[around[:, k]] * _LEFT[k] + _BYTE[around[:, SIDE + k]] * _RIGHT[k]
    total += around[:, 2 * SIDE].astype(np.uint64) * np.uint64(_BASE) + around[:, 2 * SIDE + 1].astype(np.uint64) * np.uint64(_BASE_INVERSE)
    return prints.mix(total)


def _merged(hashes, contexts, around, least, most):
    """One row for equal anchors in equal bytes, with the smallest and largest document."""
    order = np.lexsort((contexts, hashes))
    hashes, contexts, least, most = hashes[order], contexts[order], least[order], most[order]
    new = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (contexts[1:] != contexts[:-1])))
    return hashes[new], contexts[new], around[order[new]], np.minimum.reduceat(least, new), np.maximum.reduceat(most, new)


def _context_rows(tables, count: int):
    """Rows (slot, hot, anchor, context, around, least, most) of the open anchors of texts, combined for equal bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        first, second, hot_table, open_table = (table.value for table in tables)

        def combined() -> pa.RecordBatch:
            hashes, contexts, around, least, most = _merged(*(np.concatenate(part) for part in zip(*held)))
            flat = np.ascontiguousarray(around).reshape(-1)
            column = ragged.pieces(flat, np.arange(len(around) + 1) * around.shape[1]).cast(pa.binary())
            hot = prints.marked(hot_table, hashes)
            columns = [_slots(hashes, least, hot, count), pa.array(hot), _as_long(hashes), _as_long(contexts), column]
            return pa.record_batch(
                [*columns, pa.array(least), pa.array(most)], ["slot", "hot", "anchor", "context", "around", "least", "most"]
            )

        for batch in ragged.slices(batches, "text", SLICE):
            flat, bounds, at, hashes, rows = _marked_rows(batch, first, second)
            chosen = prints.marked(open_table, hashes)
            at, hashes, rows = at[chosen], hashes[chosen], rows[chosen]
            if not len(at):
                continue
            around = _around(flat, bounds, at, rows)
            ids = batch.column("doc_id").to_numpy()[rows]
            held.append((hashes, _context_hash(around), around, ids, ids))
            n += len(at)
            if n >= COMBINE_ROWS:
                yield combined()
                held, n = [], 0
        if n:
            yield combined()

    return run


def _place_rows(tables, count: int):
    """Rows (slot, hot, anchor, context, doc_id, place) of the shared anchors; the upper bits of a place tell the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, hot_table = (table.value for table in tables)
        for batch in ragged.slices(batches, "text", SLICE):
            flat, bounds, at, hashes, rows = _marked_rows(batch, first, second)
            if not len(at):
                continue
            contexts = _context_hash(_around(flat, bounds, at, rows))
            ids, keys = (batch.column(name).to_numpy()[rows] for name in ("doc_id", "text_key"))
            hot = prints.marked(hot_table, hashes)
            columns = [_slots(hashes, ids, hot, count), pa.array(hot), _as_long(hashes), _as_long(contexts), pa.array(ids)]
            place = pa.array(keys << 32 | at - bounds[rows])
            yield pa.record_batch([*columns, place], ["slot", "hot", "anchor", "context", "doc_id", "place"])

    return run


def _split_hot(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    hot = batch.column("hot")
    return batch.filter(hot), batch.filter(pc.invert(hot))


def _group_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of anchors that more than one document holds: all windows where their bytes are the same everywhere, else none yet.

    Rows of hot anchors pass, with a mark.
    """
    names, held = ["anchor", "context", "doc_id", "place"], []
    for batch in batches:
        hot, cold = _split_hot(batch)
        if hot.num_rows:
            yield pa.record_batch([*hot.select(names).columns, pa.array(np.full(hot.num_rows, HOT_ROW))], [*names, "windows"])
        held.append([cold.column(name).to_numpy() for name in names])
    if not sum(len(part[0]) for part in held):
        return
    anchor, context, document, place = (np.concatenate(part) for part in zip(*held))
    del held
    order = np.argsort(anchor, kind="stable")
    anchor, context, document, place = anchor[order], context[order], document[order], place[order]
    starts = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    sizes = np.diff(np.append(starts, len(anchor)))
    least = np.repeat(np.minimum.reduceat(document, starts), sizes)
    several = np.repeat(np.maximum.reduceat(document, starts), sizes) > least
    same = np.repeat(np.minimum.reduceat(context, starts) == np.maximum.reduceat(context, starts), sizes)
    keep = several & (~same | (document > least))
    columns = [part[keep] for part in (anchor, context, document, place, np.where(same, ALL_WINDOWS, 0))]
    for at in range(0, len(columns[0]), COMBINE_ROWS):
        yield pa.record_batch([pa.array(part[at : at + COMBINE_ROWS]) for part in columns], [*names, "windows"])


def _window_codes(hashes: np.ndarray, around: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each number of bytes left of the anchor: that number, the rows with such a window, and hashes of the windows."""
    n = len(hashes)
    left = np.zeros((n, STEPS), dtype=np.uint64)
    right = np.zeros((n, STEPS), dtype=np.uint64)
    for k in range(SIDE):
        left[:, k + 1] = left[:, k] + _BYTE[around[:, k]] * _LEFT[k]
        right[:, k + 1] = right[:, k] + _BYTE[around[:, SIDE + k]] * _RIGHT[k]
    anchor = prints.mix(hashes)
    for k in range(STEPS):
        rows = np.flatnonzero((around[:, 2 * SIDE] >= k) & (around[:, 2 * SIDE + 1] >= SIDE - k))
        if len(rows):
            yield k, rows, prints.mix(anchor[rows] + left[rows, k] + right[rows, SIDE - k] + np.uint64(k))


def _contexts(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    data, _ = ragged.text_bytes(batch.column("around"))
    anchor, context, least, most = (batch.column(name).to_numpy() for name in ("anchor", "context", "least", "most"))
    return anchor.view(np.uint64), context.view(np.uint64), data.reshape(-1, 2 * SIDE + 2), least, most


def _group_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each anchor in its bytes, the first documents of the windows around it: one row per document, with a bit per window.

    Rows of hot anchors pass as they are.
    """
    held, names = [], ["anchor", "context", "first", "found", "around", "least", "most"]
    for batch in batches:
        hot, cold = _split_hot(batch)
        if hot.num_rows:
            empty = pa.nulls(hot.num_rows, pa.int64())
            passed = [hot.column(name) for name in ("anchor", "context", "around", "least", "most")]
            yield pa.record_batch([*passed[:2], empty, empty, *passed[2:]], names)
        if cold.num_rows:
            held.append(_contexts(cold))
    if not held:
        return
    hashes, contexts, around, least, most = _merged(*(np.concatenate(part) for part in zip(*held)))
    first = np.full((len(hashes), STEPS), NONE)
    for k, rows, codes in _window_codes(hashes, around):
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        new = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        lowest = np.minimum.reduceat(least[rows[order]], new)
        first[rows[order], k] = np.repeat(lowest, np.diff(np.append(new, len(codes))))
    first[first >= most[:, None]] = NONE
    row, step = np.nonzero(first < NONE)
    if not len(row):
        return
    document = first[row, step]
    order = np.lexsort((document, row))
    row, step, document = row[order], step[order], document[order]
    new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (document[1:] != document[:-1])))
    bits = np.bitwise_or.reduceat(np.int64(1) << step, new)
    row, document = row[new], document[new]
    empty = [pa.nulls(len(row), kind) for kind in (pa.binary(), pa.int64(), pa.int64())]
    yield pa.record_batch(
        [_as_long(hashes[row]), _as_long(contexts[row]), pa.array(document), pa.array(bits), *empty], names
    )


def _spread_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each window of an anchor in its bytes."""
    for batch in batches:
        hashes, contexts, around, least, most = _contexts(batch)
        for k, rows, codes in _window_codes(hashes, around):
            columns = [hashes[rows].view(np.int64), contexts[rows].view(np.int64), codes.view(np.int64), least[rows], most[rows]]
            bit = np.full(len(rows), np.int64(1) << k)
            yield pa.record_batch([*map(pa.array, columns), pa.array(bit)], ["anchor", "context", "code", "least", "most", "bit"])


def _hot_places(places: DataFrame) -> DataFrame:
    """As _group_places, by sums and a join."""
    groups = places.groupBy("anchor").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), (F.min("context") == F.max("context")).alias("same")
    )
    joined = places.join(groups.filter("least < most"), "anchor").filter("NOT same OR doc_id > least")
    windows = F.when(F.col("same"), F.lit(ALL_WINDOWS)).otherwise(0).cast("long").alias("windows")
    return joined.select("anchor", "context", "doc_id", "place", windows)


def _hot_windows(contexts: DataFrame) -> DataFrame:
    """As _group_windows, by sums and a join."""
    spread = contexts.mapInArrow(ragged.lean(_spread_windows), "anchor long, context long, code long, least long, most long, bit long")
    firsts = spread.groupBy("code").agg(F.min("least").alias("first"))
    joined = spread.join(firsts, "code").filter(F.col("first") < F.col("most"))
    return joined.groupBy("anchor", "context", "first").agg(F.bit_or("bit").alias("found"))


def _cut(places: np.ndarray, windows: np.ndarray, n: int) -> np.ndarray:
    """Which of n bytes lie in one of the windows; bit k of a place means the window that begins k bytes before it."""
    step = np.arange(STEPS)
    row, k = np.nonzero((windows[:, None] >> step) & 1)
    starts = places[row] - k
    starts = starts[(starts >= 0) & (starts <= n - WINDOW)]
    change = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(starts + WINDOW, minlength=n + 1)[: n + 1]
    return np.cumsum(change)[:n] > 0


def cut_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", kept: str = "kept", hot: int = HOT, characters: bool = False
) -> DataFrame:
    """Cuts from each text all bytes of windows that also begin in a document with a smaller key.

    Adds n_bytes, n_removed, n_spans (runs of removed bytes) and the bytes that are left, as binary. Columns of the input with
    these names are replaced. Texts are taken as UTF-8 bytes; a null text is empty, and one shorter than a window stays.
    Rows with one key are not earlier than each other. A row without a key neither loses bytes nor makes others lose any.
    An empty table gives no rows. With characters, a character is cut only if all its bytes are, and what is left is text.
    """
    spark = df.sparkSession
    small_batches(spark)
    added = ("n_bytes", "n_removed", "n_spans", kept)
    base = df.drop(*(name for name in added if name != text))
    text_key = F.shiftrightunsigned(F.xxhash64(F.col(text)), 33)
    docs = base.filter(F.col(key).isNotNull() & (F.octet_length(text) >= WINDOW)).select(
        F.col(key).cast("long").alias("doc_id"), text_key.alias("text_key"), F.col(text).alias("text")
    )
    texts, context = docs.select("text"), spark.sparkContext
    bits, ranges = prints.table_sizes(texts)
    # The tables that go to all tasks have a bounded number of bits.
    found, _, _ = prints.frequent(
        texts, _document_anchors, [(2, bits), (hot, bits - 4)], ranges, limit=SLICE, bounded=(False, False)
    )
    first, heavy = map(context.broadcast, found)
    found, _, _ = prints.frequent(texts, _document_digits(first), [(2, bits)], ranges, limit=SLICE, bounded=(False,))
    tables = (first, context.broadcast(found[0]), heavy)
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.mapInArrow(
        ragged.lean(_place_rows(tables, count)), "slot int, hot boolean, anchor long, context long, doc_id long, place long"
    ).repartitionById(count, F.col("slot"))
    grouped = stored(
        rows.mapInArrow(ragged.lean(_group_places), "anchor long, context long, doc_id long, place long, windows long"), "anchors"
    )
    places = grouped.filter(F.col("windows") != HOT_ROW)
    places = places.union(_hot_places(grouped.filter(F.col("windows") == HOT_ROW).drop("windows")))
    unknown = places.filter("windows = 0")
    found, _, _ = prints.frequent(
        unknown.select("anchor"), lambda batch: batch.column("anchor").to_numpy().view(np.uint64), [(1, bits - 2)], ranges, text=None, bounded=(False,)
    )
    tables = (*tables, context.broadcast(found[0]))
    rows = docs.select("doc_id", "text").mapInArrow(
        ragged.lean(_context_rows(tables, count)), "slot int, hot boolean, anchor long, context long, around binary, least long, most long"
    ).repartitionById(count, F.col("slot"))
    windows = stored(
        rows.mapInArrow(
            ragged.lean(_group_windows), "anchor long, context long, first long, found long, around binary, least long, most long"
        ),
        "windows",
    )
    names = ["anchor", "context", "first", "found"]
    windows = windows.filter("around IS NULL").select(*names).union(
        _hot_windows(windows.filter("around IS NOT NULL").drop("first", "found")).select(*names)
    )
    found = unknown.join(windows, ["anchor", "context"]).filter(F.col("first") < F.col("doc_id"))
    found = found.select("doc_id", "place", F.col("found").alias("windows"))
    found = places.filter("windows <> 0").select("doc_id", "place", "windows").union(found)
    pair = F.struct((F.col("place") % F.lit(1 << 32)).alias("place"), "windows")
    cuts = found.groupBy("doc_id", F.shiftright("place", 32).alias("text_key")).agg(F.collect_list(pair).alias("__cuts"))
    named = base.withColumns({"__key": F.col(key).cast("long"), "__text_key": text_key})
    joined = named.join(cuts, (F.col("__key") == cuts["doc_id"]) & (F.col("__text_key") == cuts["text_key"]), "left")
    joined = joined.select(*[named[name] for name in base.columns], cuts["__cuts"])
    fields = [field for field in base.schema.fields if field.name != kept]
    longs = [T.StructField(name, T.LongType()) for name in added[:3]]
    schema = T.StructType([*fields, *longs, T.StructField(kept, T.StringType() if characters else T.BinaryType())])
    kind = pa.string() if characters else pa.binary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, text, SLICE):
            flat, bounds = ragged.text_bytes(batch.column(text))
            cuts = batch.column("__cuts")
            ends = ragged.list_bounds(cuts)
            inner = cuts.flatten()
            place, window = (inner.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            sizes, removed, spans, left = np.diff(bounds), [], [], []
            for row in range(batch.num_rows):
                data = flat[bounds[row] : bounds[row + 1]]
                if ends[row] == ends[row + 1]:
                    removed.append(0)
                    spans.append(0)
                    left.append(data.tobytes())
                    continue
                gone = _cut(place[ends[row] : ends[row + 1]], window[ends[row] : ends[row + 1]], len(data))
                if characters:
                    first = np.flatnonzero((data & 0xC0) != 0x80)
                    gone = np.repeat(np.logical_and.reduceat(gone, first), np.diff(np.append(first, len(data))))
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                left.append(data[~gone].tobytes())
            columns = [batch.column(field.name) for field in fields]
            columns += [pa.array(sizes), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(left, pa.binary()).cast(kind)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(ragged.lean(cut), schema)


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the passages of earlier ones."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return cut_repeats(documents).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
