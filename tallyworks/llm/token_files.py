"""Token ids in Arrow files of equal-length sequences, and reading them back.

A shard is a range of document ids. Its file holds one record batch after the other, each with a fixed-size list of ids and
one of mask values per sequence, so that any sequence is a view of the mapped file at a place known from its number. A second
file of the shard lists its documents with their places. Files are written under a name of the attempt and then moved, and
their content depends on the rows alone: a task that runs twice leaves the same file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm import library_tokens, ragged
from tallyworks.llm.bpe import vocabulary
from tallyworks.session import qualified, work_folder

LENGTH = 2048
BATCH_SEQUENCES = 256
DOC_BATCH = 1 << 16

_MANIFEST = "shard int, path string, n_docs long, n_tokens long, n_sequences long"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes them batch by batch."""

    def __init__(self, sink, length: int, kind: np.dtype, batch: int = BATCH_SEQUENCES):
        self.length, self.kind, self.room = length, kind, length * batch
        self.schema = pa.schema(
            [("tokens", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.uint8(), length))],
            metadata={"length": str(length), "batch": str(batch)},
        )
        self.file = pa.ipc.new_file(sink, self.schema)
        self.ids, self.held, self.n_sequences = [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        """Appends the ids of one document."""
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= self.room:
            ids = np.concatenate(self.ids)
            whole = len(ids) // self.room * self.room
            self._write(ids[:whole], whole)
            self.ids, self.held = [ids[whole:].copy()], len(ids) - whole

    def _write(self, ids: np.ndarray, n: int) -> None:
        """Writes whole sequences, of which the first n places hold ids."""
        mask = (np.arange(len(ids)) < n).view(np.uint8)
        for at in range(0, len(ids), self.room):
            parts = (ids[at : at + self.room].astype(self.kind), mask[at : at + self.room])
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(part), self.length) for part in parts]
            self.file.write_batch(pa.record_batch(columns, schema=self.schema))
        self.n_sequences += len(ids) // self.length

    def close(self) -> None:
        """Writes what is left, padded to whole sequences."""
        if self.held:
            ids = np.zeros(-(-self.held // self.length) * self.length, dtype=self.kind)
            ids[: self.held] = np.concatenate(self.ids)
            self._write(ids, self.held)
        self.file.close()


class SequenceReader:
    """Random access to the sequences of one file; one batch is held at a time."""

    def __init__(self, path: str):
        system, place = _open(path)
        mapped = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(place) if mapped else system.open_input_file(place)
        self.file = pa.ipc.open_file(self.source)
        settings = self.file.schema.metadata
        self.length, self.batch = int(settings[b"length"]), int(settings[b"batch"])
        self.at, self.views = -1, None

    def _views(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        if number != self.at:
            batch = self.file.get_batch(number)
            ids, mask = (batch.column(k).flatten().to_numpy(zero_copy_only=True) for k in (0, 1))
            # A mask value is a byte, which numpy takes as a truth value where it lies.
            self.views = ids, mask.view(bool)
            self.at = number
        return self.views

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a sequence, as views of the file."""
        at = number % self.batch * self.length
        ids, mask = self._views(number // self.batch)
        return ids[at : at + self.length], mask[at : at + self.length]

    def run(self, start: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of n tokens from a place of the file on, over the ends of sequences."""
        room, parts = self.batch * self.length, []
        while n > 0:
            ids, mask = self._views(start // room)
            at = start % room
            parts.append((ids[at : at + n], mask[at : at + n]))
            n -= len(parts[-1][0])
            start += len(parts[-1][0])
        return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.empty(0, np.int64), np.empty(0, bool))


def _shard_of(key: Column, bounds: list[int]) -> Column:
    """The number of sorted bounds below the key; null comes before all. Only the key goes to Python."""
    places = np.array(bounds, dtype=np.int64)

    @F.arrow_udf("int")
    def found(keys: pa.Array) -> pa.Array:
        known = pc.fill_null(keys, np.iinfo(np.int64).min).to_numpy()
        return pa.array(np.searchsorted(places, known, side="left"), pa.int32())

    return found(key.cast("long")) if bounds else F.lit(0)


def deal(df: DataFrame, key: str, shards: int | None = None) -> DataFrame:
    """Deals rows out to shards, which are ranges of an integer key of about equal rows, in ascending order inside each shard.

    Adds the number of the shard. The ranges are found from the key column alone. Rows with a null key come first, and rows
    of one key stand next to each other in one shard.
    """
    shards = shards or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = [k / shards for k in range(1, shards)]
    found = df.approxQuantile(key, wanted, 0.1 / shards) if wanted else []
    shard = _shard_of(F.col(key), sorted({int(bound) for bound in found})).cast("int")
    others = [F.xxhash64(name) for name in df.columns if name != key]
    dealt = df.withColumn("shard", shard).repartitionById(shards, F.col("shard"))
    return dealt.sortWithinPartitions("shard", F.col(key).asc_nulls_first(), *others)


def write_sequences(df: DataFrame, folder: str, key: str, ids: str, kind: np.dtype, length: int = LENGTH) -> DataFrame:
    """Writes the little-endian ids of dealt rows in their order, and returns one row per shard.

    Null ids count as none, and a document may have none. Rows of one key are documents each for itself. Columns other than
    shard, key and ids are dropped, so that their names cannot clash. An empty table writes no file.
    """
    spark = df.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        writer, shard, docs, place, attempt = None, None, [], 0, uuid.uuid4().hex

        def names() -> list[str]:
            return [f"{root}/shard-{shard:05d}.{part}" for part in ("arrow", "docs.arrow")]

        def finish() -> pa.RecordBatch:
            writer.close()
            sink.close()
            table = pa.table({"key": pa.array([d[0] for d in docs], pa.int64()), "n": pa.array([d[1] for d in docs], pa.int64())})
            with system.open_output_stream(f"{names()[1]}.{attempt}") as out, pa.ipc.new_file(out, table.schema) as file:
                file.write_table(table, max_chunksize=DOC_BATCH)
            for name in names():
                system.move(f"{name}.{attempt}", name)
            row = {"shard": [shard], "path": [f"{folder}/shard-{shard:05d}"], "n_docs": [len(docs)]}
            row |= {"n_tokens": [place], "n_sequences": [writer.n_sequences]}
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(v, k) for v, k in zip(row.values(), kinds)], list(row))

        system.create_dir(root, recursive=True)
        for batch in batches:
            data, ends = ragged.text_bytes(batch.column("ids"))
            numbers, keys = batch.column("shard").to_pylist(), batch.column("key").to_pylist()
            for at in range(batch.num_rows):
                if numbers[at] != shard:
                    if writer:
                        yield finish()
                    shard, docs, place = numbers[at], [], 0
                    sink = system.open_output_stream(f"{names()[0]}.{attempt}")
                    writer = SequenceWriter(sink, length, kind)
                one = np.frombuffer(data[ends[at] : ends[at + 1]].tobytes(), dtype=kind)
                writer.add(one)
                docs.append((keys[at], len(one)))
                place += len(one)
        if writer:
            yield finish()

    # Executors open the files without Spark, so the path has to name its file system.
    folder = qualified(spark, folder)
    dealt = df.select("shard", F.col(key).cast("long").alias("key"), F.col(ids).alias("ids"))
    manifest = work_folder(spark, "token-manifest")
    dealt.mapInArrow(run, _MANIFEST).write.parquet(manifest)
    return spark.read.parquet(manifest)


def read_documents(manifest: DataFrame) -> DataFrame:
    """Each document of the files: key, start (ids of all documents before it), n_tokens and ids_crc32 of what the file holds.

    Raises if a document lies in part in the padding.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                reader = SequenceReader(f"{path}.arrow")
                system, place = _open(f"{path}.docs.arrow")
                with system.open_input_file(place) as source:
                    listed = pa.ipc.open_file(source)
                    start = 0
                    for number in range(listed.num_record_batches):
                        docs = listed.get_batch(number)
                        lengths = docs.column("n").to_numpy()
                        starts = start + ragged.offsets(lengths)
                        sums = []
                        for at, n in zip(starts.tolist(), lengths.tolist()):
                            ids, mask = reader.run(at, n)
                            if not mask.all():
                                raise ValueError(f"the mask of {path} does not fit its documents")
                            sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        start = int(starts[-1])
                        columns = [docs.column("key"), pa.array(before + starts[:-1]), docs.column("n"), pa.array(sums, pa.int64())]
                        yield pa.record_batch(columns, ["key", "start", "n_tokens", "ids_crc32"])

    # One row per shard: the running sum goes over few rows.
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("shard", "path", F.coalesce(before, F.lit(0)).alias("before"))
    count = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartitionById(count, F.col("shard")).mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long")


def op4_token_files(spark: SparkSession, folder: str, path: str | None = None, end: int = 2) -> DataFrame:
    """Place, length and checksum of every document, as read from the files."""
    path = path or vocabulary("word_bpe_49k.json")
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    # The texts move, not their ids, which take more room.
    tokens = library_tokens.tokenize(deal(documents, "doc_id"), path, end)
    manifest = write_sequences(tokens, work_folder(spark, "sequences"), "doc_id", "ids", library_tokens.id_type(path))
    return read_documents(manifest).withColumnRenamed("key", "doc_id")
