"""Nearest neighbours by inner product, from a forest of random-projection trees.

The trees are grown on a bounded sample and then take every row. Each inner node splits by a random direction, the difference
of two of its sample vectors, at the median of the sample. To search by inner product, each vector has one more component,
which lifts all of them to the largest norm; queries have 0 there. A query keeps one priority queue for all trees: the
branch that its path missed by the least margin comes next, until enough leaves are seen. The vectors of these leaves are ranked
by their exact inner product.

Rows, with their leaves, and queries, with the leaves that they see as bits, lie in packs of bounded size, written once each.
A task holds some packs of queries with the best rows so far, and the packs of rows stream past it. So no vector is
copied for each leaf, and what a task holds does not depend on the number of rows, queries or leaves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm.components import stored
from tallyworks.llm.ragged import lean
from tallyworks.llm.samples import by_hash
from tallyworks.session import small_batches

SAMPLE = 20_000
TREES = 8
LEAF_ROWS = 256
VISITED = 0.2
BLOCK = 4096
#: A pack holds a block of queries, or ROW_BLOCKS blocks of rows, but no more than so many bytes (or one).
ROW_BLOCKS, QUERY_PACK, ROW_PACK, PACKS_A_FILE = 8, 4 << 20, 8 << 20, 4
#: What a task holds of the queries in bytes, the queries that are worth a task, and tasks for each core.
HELD_BYTES, HELD_QUERIES, TASKS_A_CORE = 48 << 20, 1024, 2
#: Queries and rows whose products are formed at once, pairs that are summed at once, rows that a query meets first.
TILE, EXACT_PAIRS, FIRST_ROWS = (256, 1024), 1 << 15, 64


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """The rows (id, v) that take part: vectors of the most frequent length, none null, zero or with a component null or not finite."""
    v = F.col("v")
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == F.lit(length.n if length else 0))


class Forest:
    """Complete trees as arrays: node k has the children 2k + 1 and 2k + 2."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, norm: float, seed: int = 5):
        random = np.random.default_rng(seed)
        self.trees, self.depth, self.norm = trees, depth, norm
        self.leaves = 1 << depth
        points = self.lifted(sample)
        inner = self.leaves - 1
        self.directions = np.zeros((trees, inner, points.shape[1]))
        self.bounds = np.zeros((trees, inner))
        for tree in range(trees):
            node = np.zeros(len(points), dtype=np.int64)
            for k in range(inner):
                members = np.flatnonzero(node == k)
                direction = np.zeros(points.shape[1])
                if len(members) > 1:
                    a, b = random.choice(members, 2, replace=False)
                    direction = points[a] - points[b]
                if not direction.any():
                    direction = random.standard_normal(points.shape[1])
                direction /= np.linalg.norm(direction)
                self.directions[tree, k] = direction
                if len(members):
                    along = points[members] @ direction
                    self.bounds[tree, k] = np.median(along)
                    node[members] = 2 * k + 1 + (along > self.bounds[tree, k])

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm - (vectors**2).sum(axis=1), 0.0))
        return np.hstack([vectors, rest[:, None]])

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree; leaves are numbered through all trees."""
        points = self.lifted(vectors)
        found = np.empty((len(points), self.trees), dtype=np.int64)
        for tree in range(self.trees):
            node = np.zeros(len(points), dtype=np.int64)
            for _ in range(self.depth):
                along = (points * self.directions[tree, node]).sum(axis=1)
                node = 2 * node + 1 + (along > self.bounds[tree, node])
            found[:, tree] = node - (self.leaves - 1) + tree * self.leaves
        return found

    def search(self, queries: np.ndarray, visits: int) -> np.ndarray:
        """Which leaves each query sees, by one queue over all trees: smallest margin of a missed branch first.

        A leaf's place in the queue is the largest margin that its path missed. Leaves that share it come by tree, then by the
        node where their path last missed, as they would leave the queue.
        """
        count, inner = len(queries), self.leaves - 1
        points = np.hstack([queries, np.zeros((count, 1))])
        margins = (points @ self.directions.reshape(self.trees * inner, points.shape[1]).T).reshape(count, self.trees, inner) - self.bounds
        missed = np.zeros((count, self.trees, 1))
        for level in range(self.depth):
            margin = margins[:, :, (1 << level) - 1 : (2 << level) - 1]
            far, right = np.maximum(missed, np.abs(margin)), margin > 0
            missed = np.stack([np.where(right, far, missed), np.where(right, missed, far)], axis=-1).reshape(count, self.trees, -1)
        missed = missed.reshape(count, -1)
        last = np.partition(missed, visits - 1, axis=1)[:, visits - 1][:, None]
        seen, level_with = missed < last, missed == last
        left = visits - seen.sum(axis=1)
        seen |= level_with & (level_with.sum(axis=1) == left)[:, None]
        query, leaf = np.nonzero(level_with & ~seen)
        tree, node = np.divmod(leaf, self.leaves)
        node, turn = node + inner, np.zeros(len(leaf), dtype=np.int64)
        for _ in range(self.depth):
            above = (node - 1) // 2
            off = (turn == 0) & (node != 2 * above + 1 + (margins[query, tree, above] > 0))
            turn[off], node = node[off], above
        order = np.lexsort((turn, tree, query))
        nth = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order = order[nth < left[query[order]]]
        seen[query[order], leaf[order]] = True
        return seen


def _vectors(batch: pa.RecordBatch, name: str = "v") -> np.ndarray:
    values = batch.column(name).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query, each id once, with the best of its rows."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    pairs = np.sort((mixed ^ (mixed >> np.uint64(29))) + query.astype(np.uint64) * np.uint64(0xC4CEB9FE1A85EC53))
    order = np.arange(len(ids))
    if (pairs[1:] == pairs[:-1]).any():
        order = np.lexsort((-scores, ids, query))
        order = order[np.append(True, (query[order][1:] != query[order][:-1]) | (ids[order][1:] != ids[order][:-1]))]
    order = order[np.lexsort((ids[order], -scores[order], query[order]))]
    starts = np.flatnonzero(np.append(True, query[order][1:] != query[order][:-1])) if len(order) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(order)))
    return order[np.arange(len(order)) - np.repeat(starts, sizes) < k]


class Ranking:
    """The k best rows that each query of a pack has met so far, each id once.

    Single-precision products of queries of length 1 and rows of length 1 at most find the pairs that can be among them: their
    error is below the slack. Of these pairs, those in a leaf that the query sees are summed in double precision, all alike.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seen: np.ndarray, k: int, length: float):
        self.ids, self.vectors, self.seen, self.k, self.length = ids, vectors, seen, k, length
        largest = np.abs(vectors).max(axis=1, keepdims=True).astype(np.float64)
        scaled = vectors / largest
        self.lengths = np.linalg.norm(scaled, axis=1)
        self.unit = (scaled / self.lengths[:, None]).astype(np.float32)
        self.lengths *= largest[:, 0]
        self.slack = (vectors.shape[1] + 8) * 2.0**-23
        self.met, self.waiting = 0, 0
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        self.least = np.full(len(ids), -np.inf)
        self.bound = np.full((len(ids), 1), -np.inf, dtype=np.float32)

    def meet(self, ids: np.ndarray, vectors: np.ndarray, unit: np.ndarray, leaves: np.ndarray) -> None:
        low = 0
        while low < len(ids):
            high = min(low + max(FIRST_ROWS, self.met), len(ids))  # ever more, as the bounds get better
            pairs, count = [], 0
            for first in range(0, len(self.ids), TILE[0]):
                asked = self.unit[first : first + TILE[0]]
                bound = self.bound[first : first + TILE[0]]
                for begin in range(low, high, TILE[1]):
                    rough = asked @ unit[begin : min(begin + TILE[1], high)].T
                    at = np.flatnonzero(rough >= bound)
                    pairs.append((first + at // rough.shape[1], begin + at % rough.shape[1]))
                    count += len(at)
                    if count >= EXACT_PAIRS:
                        self._sum(pairs, ids, vectors, leaves)
                        pairs, count = [], 0
            self._sum(pairs, ids, vectors, leaves)
            self.met += high - low
            low = high
            if self.waiting * 2 > len(self.found[0][0]):
                self.merge()

    def _sum(self, pairs: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, vectors: np.ndarray, leaves: np.ndarray) -> None:
        queries, rows = (np.concatenate(part) for part in zip(*pairs, strict=True)) if pairs else (np.empty(0, np.int64),) * 2
        step = max(1, min(EXACT_PAIRS, (64 * EXACT_PAIRS) // vectors.shape[1]))
        for start in range(0, len(queries), step):
            query, row = queries[start : start + step], rows[start : start + step]
            leaf = leaves[row]
            good = (self.seen[query[:, None], leaf >> 3] >> (leaf & 7).astype(np.uint8) & 1).any(axis=1) & (self.ids[query] != ids[row])
            query, row = query[good], row[good]
            scores = (self.vectors[query].astype(np.float64) * vectors[row]).sum(axis=1)
            good = scores >= self.least[query]
            self.found.append((query[good], ids[row[good]], scores[good]))
            self.waiting += int(good.sum())
            if self.waiting > max(1 << 18, 2 * self.k * len(self.ids)):
                self.merge()

    def merge(self) -> None:
        query, vec, score = (np.concatenate(part) for part in zip(*self.found, strict=True))
        best = _best(query, vec, score, self.k)
        query, vec, score = query[best], vec[best], score[best]
        self.found, self.waiting = [(query, vec, score)], 0
        last = np.flatnonzero(np.bincount(query, minlength=len(self.ids)) == self.k)
        self.least[last] = score[np.searchsorted(query, last, side="right") - 1]
        if 1e-100 < self.length < 1e100:  # else products may be lost, and all pairs are summed
            self.bound = (self.least / self.length / self.lengths - self.slack).astype(np.float32)[:, None]

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.merge()
        query, vec, score = self.found[0]
        return self.ids[query], vec, score


def _packs(columns: Callable[[np.ndarray], list[np.ndarray]], kind: str, rows: int, size: int, step: int):
    """A function that packs rows (id, v): their number, ids, vectors and what the given function makes of some vectors at a time.

    A pack has at most so many rows, and bytes or one row.
    """

    def packed(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        whole = [np.ascontiguousarray(np.concatenate(column)) for column in zip(*parts, strict=True)]
        return pa.record_batch([pa.array([len(whole[0])]), *(pa.array([column.tobytes()]) for column in whole)], ["n", "ids", "vectors", "leaves"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch)
            for at in range(0, len(vectors), step):
                some = vectors[at : at + step]
                part = [batch.column("id").to_numpy()[at : at + step], some.astype(kind), columns(some)]
                most = max(1, min(rows, size // (sum(column.nbytes for column in part) // len(some))))
                begin = 0
                while begin < len(some):
                    end = min(begin + most - held, len(some))
                    parts.append([column[begin:end] for column in part])
                    held += end - begin
                    begin = end
                    if held >= most:
                        yield packed(parts)
                        parts, held = [], 0
        if parts:
            yield packed(parts)

    return lean(run)


PACK = "n long, ids binary, vectors binary, leaves binary"


def _number_kind(df: DataFrame, vector: str) -> str:
    """How a component is packed without loss."""
    kind = df.schema[vector].dataType
    return "f4" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "f8"


def nearest(
    df: DataFrame,
    queries: DataFrame,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    visited: float = VISITED,
    leaf_rows: int = LEAF_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """For each row of queries its k nearest rows of df by inner product: query_id, rank from 1, vec_id and score.

    A query does not find a row with its own key. Ties go to the smaller key; of rows with one key the best counts.
    Vectors that are null or zero, hold a null or a component that is not finite, or have another length than most, take no
    part, on either side. Other columns are dropped, so that their names cannot clash. Empty tables give no rows. Every row
    is indexed; the share of all leaves that a query visits sets how many of the true neighbours are found.
    """
    spark = df.sparkSession
    small_batches(spark)
    rows = usable(df, key, vector)
    size = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)).alias("norm")).first()
    if not size.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = by_hash(rows, ["id"], SAMPLE).select("v").toArrow()
    points = sample.column("v").combine_chunks().flatten().to_numpy().reshape(sample.num_rows, -1)
    depth = int(np.clip(np.floor(np.log2(max(size.n / leaf_rows, 1))), 0, np.log2(max(len(points) / 8, 1))))
    forest = Forest(points, trees, depth, size.norm)
    total = trees * forest.leaves
    visits = max(int(np.ceil(visited * total)), min(2 * trees, total))
    shared = spark.sparkContext.broadcast(forest)  # grown on a sample of fixed size
    width, length = points.shape[1], float(np.sqrt(size.norm))
    row_kind, query_kind, leaf_kind = _number_kind(df, vector), _number_kind(queries, vector), np.min_scalar_type(total - 1)

    def leaves_of(vectors: np.ndarray) -> np.ndarray:
        return shared.value.leaves_of(vectors).astype(leaf_kind)

    def seen_by(vectors: np.ndarray) -> np.ndarray:
        return np.packbits(shared.value.search(vectors, visits), axis=1, bitorder="little")

    held = stored(rows.mapInArrow(_packs(leaves_of, row_kind, block * ROW_BLOCKS, ROW_PACK, BLOCK), PACK), "vectors", PACKS_A_FILE)
    wanted = usable(queries, key, vector).filter(F.size("v") == width)
    step = max(1, (1 << 20) // total)
    asked = wanted.mapInArrow(_packs(seen_by, query_kind, block, QUERY_PACK, step), PACK)
    asked = stored(asked.withColumn("pack", F.monotonically_increasing_id()), "queries", PACKS_A_FILE)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rankings: dict[int, Ranking] = {}

        def unpacked(batch: pa.RecordBatch, at: int, side: str, kind: str, leaf: str) -> list[np.ndarray]:
            n = batch.column(f"{side}n")[at].as_py()
            flat = (np.frombuffer(batch.column(side + name)[at].as_buffer(), form) for name, form in (("ids", "i8"), ("vectors", kind), ("leaves", leaf)))
            return [column.reshape(n, -1) if place else column for place, column in enumerate(flat)]

        for batch in batches:
            for at in range(batch.num_rows):
                pack = batch.column("pack")[at].as_py()
                if pack not in rankings:
                    rankings[pack] = Ranking(*(column.copy() for column in unpacked(batch, at, "", query_kind, "u1")), k, length)
                ids, vectors, leaves = unpacked(batch, at, "row_", row_kind, leaf_kind)
                rankings[pack].meet(ids, vectors, (vectors / length).astype(np.float32), leaves)
        for ranking in rankings.values():
            yield pa.record_batch([pa.array(column) for column in ranking.best()], ["query_id", "vec_id", "score"])

    # A task holds a group of the queries and reads a share of the rows once. Few shares: each starts anew on its k best rows.
    number = asked.agg(F.sum("n")).first()[0] or 0
    tasks = TASKS_A_CORE * spark.sparkContext.defaultParallelism
    groups = -(-number * (width * np.dtype(query_kind).itemsize + total // 8) // HELD_BYTES)
    groups = max(1, min(max(groups, min(tasks, -(-number // HELD_QUERIES))), asked.rdd.getNumPartitions()))
    shares = -(-tasks // groups)
    held = held.select([F.col(name).alias(f"row_{name}") for name in held.columns]).coalesce(shares)
    met = held.hint("shuffle_replicate_nl").crossJoin(asked.coalesce(groups))
    found = met.mapInArrow(lean(rank), "query_id long, vec_id long, score double").repartition("query_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_projection_forest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(rows, rows.filter(F.col("vec_id") % 20 == 0), 20)
