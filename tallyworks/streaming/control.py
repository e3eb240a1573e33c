"""Start, run out, time-limit and stop streaming queries."""

from __future__ import annotations

import threading
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# Merges the sessions of a key inside each task before the shuffle, so that a hot key moves few rows.
LOCAL_SESSION_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"

# Lets a query run one more batch without input after the watermark has moved.
BATCH_WITHOUT_INPUT = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """Change a setting for the start of a query; a running query keeps what it started with."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def start_sink(
    stream: DataFrame, path: str, checkpoint: str, form: str = "parquet", continuous: str | None = None
) -> StreamingQuery:
    """Append the stream to a file topic.

    Takes in what is there and ends, or with ``continuous``, a trigger interval
    such as ``10 seconds``, runs until it is stopped.
    """
    writer = stream.writeStream.format(form).outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return triggered(writer, continuous).start()


def triggered(writer, continuous: str | None):
    return writer.trigger(availableNow=True) if continuous is None else writer.trigger(processingTime=continuous)


def run_out(query: StreamingQuery) -> None:
    """Wait for a query that ends by itself; stop it if the wait is broken off."""
    try:
        query.awaitTermination()
    finally:
        query.stop()


def listen(query: StreamingQuery, seconds: float) -> bool:
    """Let a query run for at most this long, then stop it. True if it ended by itself."""
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()


@dataclass
class Record:
    """What a listener saw of one run of a query."""

    batches: list[int] = field(default_factory=list)
    rows: int = 0
    reason: str | None = None
    ended: threading.Event = field(default_factory=threading.Event)


class StreamFailed(RuntimeError):
    """A query that ended by an error, with the batch in which it did."""

    def __init__(self, batch: int, reason: str):
        super().__init__(f"failed in batch {batch}: {reason}")
        self.batch, self.reason = batch, reason


class Watch(StreamingQueryListener):
    """Records the batches, the rows read and the reason of the end of every run on a session.

    A batch counts when Spark reports its progress, which it does for batches without
    input as well. Events come a little after the fact; ``record`` waits for the last one.
    """

    def __init__(self):
        self._records: dict[str, Record] = {}
        self._lock = threading.Lock()

    def _of(self, run) -> Record:
        with self._lock:
            return self._records.setdefault(str(run), Record())

    def onQueryStarted(self, event) -> None:
        self._of(event.runId)

    def onQueryProgress(self, event) -> None:
        found = self._of(event.progress.runId)
        if event.progress.batchId not in found.batches:
            found.batches.append(event.progress.batchId)
            found.rows += event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        found = self._of(event.runId)
        found.reason = event.exception
        found.ended.set()

    def record(self, query: StreamingQuery, seconds: float = 30.0) -> Record:
        """The record of a run that has ended."""
        found = self._of(query.runId)
        found.ended.wait(seconds)
        return found


@contextmanager
def watching(spark: SparkSession):
    """A listener for the queries started inside."""
    watch = Watch()
    spark.streams.addListener(watch)
    try:
        yield watch
    finally:
        spark.streams.removeListener(watch)


def run_all(queries: Sequence[StreamingQuery], watch: Watch, seconds: float | None = None) -> list[Record]:
    """Wait until all queries have ended, for at most this long, and give their records.

    If one fails, the others are stopped and StreamFailed names the batch: the one after the
    last that was completed, which the next run on the checkpoint repeats.
    """
    clock = threading.Event()
    waited, step = 0.0, 0.2
    try:
        while any(query.isActive for query in queries) and not any(query.exception() for query in queries):
            if seconds is not None and waited >= seconds:
                break
            clock.wait(step)
            waited += step
    finally:
        for query in queries:
            query.stop()
    for query in queries:
        error: StreamingQueryException | None = query.exception()
        if error is not None:
            done = _completed(query, watch)
            raise StreamFailed(done + 1, str(error).splitlines()[0]) from error
    return [watch.record(query) for query in queries]


def _completed(query: StreamingQuery, watch: Watch) -> int:
    """The last batch that a run completed or found completed; -1 if there is none."""
    seen = watch.record(query).batches
    return max(seen) if seen else -1
