"""Exact deduplication against a history of texts, by a minimal perfect hash over its distinct digests.

The digests of the history are dealt into buckets by their first bits, evenly, as they are SHA-256. Each bucket has a minimal perfect
hash: level after level, digests that are alone in their place of a bit array are settled and the others move on; the number of
set bits before a digest's own is its slot. A slot holds the whole digest and where its winner is, so that a digest that
is not of the history, for which the hash names some slot too, is told by comparing all of its bytes. What an arrival finds in
a slot makes it a repeat; arrivals that find nothing are grouped among themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import ragged
from tallyworks.llm.components import stored
from tallyworks.llm.prints import mix

DIGEST = 32
#: About so many digests are in one bucket.
BUCKET_ROWS = 1 << 15
#: Places for each digest that is not settled yet.
ROOM = 2
#: At most so many digests, those with the most rows, are sent to every task.
COMMON_GROUPS = 1 << 12


def _hashed(digests: np.ndarray, level: int, places: int) -> np.ndarray:
    """A place for each digest (rows of four numbers), other ones on every level; all bytes count."""
    found = np.full(len(digests), (level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, dtype=np.uint64)
    for word in digests.T:
        found = mix(found ^ word)
    return (found % np.uint64(places)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash over distinct digests: sizes of the levels, and their bits one after the other."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes = sizes
        self.bits = bits
        self.before = ragged.offsets(bits.astype(np.int64))

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        sizes, bits = [], []
        while len(digests):
            places = ROOM * len(digests)
            at = _hashed(digests, len(sizes), places)
            alone = np.bincount(at, minlength=places) == 1
            sizes.append(places)
            bits.append(alone)
            digests = digests[~alone[at]]
        return cls(np.array(sizes, dtype=np.int64), np.concatenate([np.empty(0, dtype=bool), *bits]))

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; for one that is not in the set some slot or -1."""
        found = np.full(len(digests), -1, dtype=np.int64)
        left = np.arange(len(digests))
        for level, (size, start) in enumerate(zip(self.sizes.tolist(), ragged.offsets(self.sizes).tolist())):
            at = start + _hashed(digests[left], level, size)
            here = self.bits[at]
            found[left[here]] = self.before[at[here]]
            left = left[~here]
        return found


def _words(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of digests as rows of four numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, _ = ragged.text_bytes(column)
    return np.frombuffer(flat.tobytes(), dtype="<u8").reshape(-1, DIGEST // 8)


def _bucket(rows: int) -> F.Column:
    """The bucket of a digest, by so many first bits that a bucket has about BUCKET_ROWS of the rows."""
    bits = min(max(rows // BUCKET_ROWS, 1).bit_length(), 30)
    return F.shiftright(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"), 32 - bits)


def _standing(winner: tuple[int | None, int]) -> tuple[bool, int, int]:
    """The order in which Spark compares winners: null first."""
    doc_id, row = winner
    return doc_id is not None, doc_id or 0, row


def _groups(rows: DataFrame, total: int) -> DataFrame:
    """The distinct digests of rows with their winners, row counts and buckets."""
    winner = F.max(F.struct("doc_id", "row")).alias("winner")
    distinct = rows.groupBy("digest").agg(winner, F.count(F.lit(1)).alias("n")).select("digest", "winner.*", "n")
    return distinct.withColumn("bucket", _bucket(total))


def located(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The digest of each text (null: empty) with the key and the place of its row, in a table written once."""
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return stored(df.select(F.col(key).alias("doc_id"), digest.alias("digest"), F.monotonically_increasing_id().alias("row")), "digests")


def history(rows: DataFrame) -> DataFrame:
    """The perfect hash of the distinct digests of a table made by located, a row per bucket: the levels and their bits, and by
    slot the digests, the winner (largest doc_id, then row) and the number of rows. It can be written and kept."""

    def build(key: tuple, table: pa.Table) -> pa.Table:
        digests = _words(table.column("digest"))
        hashed = PerfectHash.build(digests)
        order = pa.array(np.argsort(hashed.slots(digests)))
        table = table.take(order).combine_chunks()
        columns = [
            key[0].as_py(), hashed.sizes, np.packbits(hashed.bits).tobytes(), digests[order.to_numpy()].tobytes(),
            *(table.column(name).to_pylist() for name in ("doc_id", "row", "n")),
        ]
        longs = pa.list_(pa.int64())
        kinds = [pa.int64(), longs, pa.binary(), pa.binary(), longs, longs, longs]
        return pa.Table.from_arrays([pa.array([value], kind) for value, kind in zip(columns, kinds)], _SLOTS)

    return _groups(rows, rows.count()).groupBy("bucket").applyInArrow(
        build, "bucket long, sizes array<long>, bits binary, digests binary, doc_ids array<long>, rows array<long>, ns array<long>"
    )


_SLOTS = ["bucket", "sizes", "bits", "digests", "doc_ids", "rows", "ns"]


def matched(slots: DataFrame, arrivals: DataFrame, rows: int) -> DataFrame:
    """All groups of equal digests of a history and of arrivals: digest, the winner's doc_id and row, and the number of rows.

    slots comes from history over a table of so many rows, arrivals from located.
    """

    def look_up(key: tuple, old: pa.Table, new: pa.Table) -> pa.Table:
        if not old.num_rows:
            return new.select(_GROUP).cast(kinds)
        one = {name: old.column(name).combine_chunks()[0] for name in old.column_names}
        sizes = one["sizes"].values.to_numpy()
        hashed = PerfectHash(sizes, np.unpackbits(np.frombuffer(one["bits"].as_buffer(), dtype=np.uint8), count=int(sizes.sum())).astype(bool))
        held = np.frombuffer(one["digests"].as_buffer(), dtype="<u8").reshape(-1, DIGEST // 8)
        digests = _words(new.column("digest"))
        slot = hashed.slots(digests)
        known = (slot >= 0) & (held[slot] == digests).all(axis=1)
        doc_ids, places, ns = (one[name].as_py() for name in ("doc_ids", "rows", "ns"))
        repeats = new.filter(pa.array(known))
        for at, doc_id, row, n in zip(slot[known].tolist(), *(repeats.column(name).to_pylist() for name in _GROUP[1:])):
            ns[at] += n
            doc_ids[at], places[at] = max((doc_ids[at], places[at]), (doc_id, row), key=_standing)
        old_groups = pa.table([ragged.pieces(held.view(np.uint8).ravel(), np.arange(len(held) + 1) * DIGEST).cast(pa.binary()), doc_ids, places, ns], _GROUP)
        return pa.concat_tables([old_groups.cast(kinds), new.filter(pa.array(~known)).select(_GROUP).cast(kinds)])

    kinds = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64())])
    found = slots.groupBy("bucket").cogroup(_groups(arrivals, rows).groupBy("bucket"))
    return found.applyInArrow(look_up, "digest binary, doc_id long, row long, n long")


_GROUP = ["digest", "doc_id", "row", "n"]


def dedup(old: DataFrame, new: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of a history and of arrivals: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the largest doc_id stays, null being
    the smallest, and of repeated rows of this id one. Keys are whole numbers. Either table may be empty. Texts of any length count whole.
    Other columns are dropped, so that names cannot clash.
    """
    before = located(old, key, text).withColumn("row", F.col("row") * 2)
    after = located(new, key, text).withColumn("row", F.col("row") * 2 + 1)
    groups = stored(matched(history(before), after, before.count()), "groups")
    rows = before.unionByName(after)
    # Rows meet their groups: those of a text that very many rows share by a small table, the others by digest.
    share = (groups.agg(F.sum("n")).first()[0] or 0) // COMMON_GROUPS
    groups = groups.withColumnsRenamed({"doc_id": "keep_id", "row": "keep_row", "n": "group_size"})
    common = groups.filter(F.col("group_size") > share)
    rest = rows.join(F.broadcast(common.select("digest")), "digest", "left_anti").join(groups.filter(F.col("group_size") <= share), "digest")
    return rows.join(F.broadcast(common), "digest").unionByName(rest).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op13_hashed_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and the one of its text that stays: the lower half of the ids is the history, the upper half arrives."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    bounds = documents.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    middle = 0 if bounds.low is None else (bounds.low + bounds.high) // 2
    older = F.coalesce(F.col("doc_id") <= middle, F.lit(True))
    return dedup(documents.filter(older), documents.filter(~older))


def oracle() -> str:
    return """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
