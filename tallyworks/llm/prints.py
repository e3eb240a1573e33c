"""Counts of hashes over all documents, kept as bit tables of fixed size.

A task gathers the hashes of several slices, counts them, and sends each one once with its count, in one block for each range
of hashes. A task that has all blocks of one range adds them up. The number of ranges grows with the texts (GROUP_POWER), so
that a range holds the hashes of a bounded number of bytes, and one hash comes at most once from each GATHERED others.
What the driver gets is a bit table of bounded size.
Two hashes may share a bit, so a bit says that a hash may be frequent, and its absence that it is not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import ragged
from tallyworks.llm.components import stored

#: Of a hash count its range and so many bits below.
LOW_BITS = 32
#: Hashes that a task gathers before it sends them.
GATHERED = 1 << 20
#: A table has at most this share of its bits set; beyond it, only the most frequent hashes are marked.
FULL = 8


#: The bits of a table are about this power of two fewer than the bytes of the texts, within bounds.
BYTES_POWER, LEAST_BITS, MOST_BITS = 4, 20, 28
#: A range has the hashes of about 2**GROUP_POWER bytes. Tables of MOST_BITS have bits for ranges of 2**47 bytes of text.
GROUP_POWER, LEAST_RANGES, MOST_RANGES = 26, 8, MOST_BITS - 7


def table_sizes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """The size of a table for the hashes of texts, and the number of ranges, as powers of two.

    A table stops growing at MOST_BITS; the ranges go on with the texts.
    """
    total = int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 1).bit_length()
    bits = int(np.clip(total - BYTES_POWER, LEAST_BITS, MOST_BITS))
    return bits, int(np.clip(total - GROUP_POWER, LEAST_RANGES, min(MOST_RANGES, bits - 7)))


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of unsigned 64-bit values over all bits."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _new(values: np.ndarray) -> np.ndarray:
    """Where each value of sorted ones comes first."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])


def _blocks(hashes: list[np.ndarray], ranges: int) -> pa.RecordBatch:
    """Of each range the distinct prints, and those that come up again with the number of times more."""
    values = np.sort(np.concatenate(hashes)) >> np.uint64(64 - LOW_BITS - ranges)
    starts = _new(values)
    more = np.diff(np.append(starts, len(values))) - 1
    values = values[starts]
    owners, low = values >> np.uint64(LOW_BITS), values.astype("<u4")
    cuts = np.append(_new(owners), len(owners))
    again = np.flatnonzero(more)
    repeats = np.searchsorted(again, cuts) * 4
    columns = (low, cuts * 4), (low[again], repeats), (more[again].astype("<u4"), repeats)
    blocks = [ragged.pieces(flat.view(np.uint8), bounds).cast(pa.binary()) for flat, bounds in columns]
    return pa.record_batch([pa.array(owners[cuts[:-1]].astype(np.int32)), *blocks], ["bucket", "prints", "again", "times"])


def _counted(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct prints of the blocks of one range, ascending, and their counts."""
    values, again, times = (
        np.frombuffer(b"".join(table.column(name).to_pylist()), dtype="<u4") for name in ("prints", "again", "times")
    )
    values = np.sort(values)
    starts = _new(values)
    counts = np.diff(np.append(starts, len(values)))
    values = values[starts]
    return values, counts + np.bincount(np.searchsorted(values, again), weights=times, minlength=len(values)).astype(np.int64)


def frequent(
    docs: DataFrame,
    hashes_of: Callable[[pa.RecordBatch], np.ndarray],
    tables: list[tuple[int, int]],
    ranges: int,
    text: str | None = "text",
    limit: int = ragged.BATCH_BYTES // 2,
    bounded: tuple[bool, ...] = (True,),
) -> tuple[list[bytes], int, int]:
    """For each (count, bits) a table of 2**bits bits that marks the hashes with at least that count; also all hashes, and the
    distinct ones. Hashes are counted in 2**ranges ranges.

    hashes_of gives the hashes of a slice of documents (of a batch, without a text), one for each document that has it. A table that is not bounded leaves
    no frequent hash out, however full it gets.
    """

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0
        for batch in ragged.slices(batches, text, limit) if text else batches:
            gathered.append(hashes_of(batch))
            n += len(gathered[-1])
            if n >= GATHERED:
                yield _blocks(gathered, ranges)
                gathered, n = [], 0
        if n:
            yield _blocks(gathered, ranges)

    def mark(key, table):
        values, counts = _counted(table)
        found = []
        for (least, bits), few in zip(tables, bounded):
            slots = 1 << bits - ranges
            if few and (counts >= least).sum() > slots // FULL:
                least = int(np.partition(counts, -(slots // FULL))[-(slots // FULL)]) + 1
            marks = np.zeros(slots, dtype=np.uint8)
            marks[values[counts >= least] >> np.uint32(LOW_BITS + ranges - bits)] = 1
            found.append(np.packbits(marks).tobytes())
        columns = [pa.array([value], kind) for value, kind in ((key[0].as_py(), pa.int32()), (int(counts.sum()), pa.int64()), (len(values), pa.int64()))]
        return pa.table([*columns, pa.array([found], pa.list_(pa.binary()))], ["bucket", "n", "n_distinct", "marks"])

    blocks = docs.mapInArrow(ragged.lean(prints), "bucket int, prints binary, again binary, times binary").groupBy("bucket")
    # Written first, because rows that come to the driver one task after the other are also computed so.
    rows = stored(blocks.applyInArrow(mark, "bucket int, n long, n_distinct long, marks array<binary>"), "marks")
    made = [bytearray((1 << bits) // 8) for _, bits in tables]
    n = n_distinct = 0
    for row in rows.toLocalIterator():
        n, n_distinct = n + row.n, n_distinct + row.n_distinct
        for table, marks in zip(made, row.marks):
            table[row.bucket * len(marks) : (row.bucket + 1) * len(marks)] = marks
    return [bytes(table) for table in made], n, n_distinct


def marked(table: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which hashes are marked in a table."""
    bits = len(table).bit_length() + 2
    slot = hashes >> np.uint64(64 - bits)
    byte = np.frombuffer(table, dtype=np.uint8)[(slot >> np.uint64(3)).astype(np.int64)]
    return (byte >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & 1 > 0
