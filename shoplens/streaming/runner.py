"""Starting, watching and stopping streams."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from shoplens.scratch import scratch_path

FILE_SINKS = ("parquet", "json", "csv")


class ProgressLog(StreamingQueryListener):
    """Keeps four numbers of every micro-batch, however many; a query itself remembers only the last hundred."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, int, int, int]] = []
        self._ended: set[str] = set()
        self._change = threading.Condition()

    @contextmanager
    def listening(self, spark: SparkSession) -> Iterator[None]:
        spark.streams.addListener(self)
        try:
            yield
        finally:
            spark.streams.removeListener(self)

    def wait(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Until the query's end has been reported, and so all of its batches."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, timeout):
                raise TimeoutError(f"the end of stream {query.runId} was not reported")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        total = sum(s.numRowsTotal for s in p.stateOperators)
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        with self._change:
            self.rows.append((p.batchId, p.numInputRows, total, late))

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()


def start_stream(
    df: DataFrame,
    sink: str | Callable[[DataFrame, int], None],
    mode: str = "append",
    path: str | None = None,
    checkpoint: str | None = None,
    name: str | None = None,
    live: bool = True,
    **options,
) -> StreamingQuery:
    """Start a stream and return at once.

    ``sink`` is a file format (with ``path``; append only), "console", "memory" (for small
    results: the rows live in the driver, and in update mode every revision of a window is
    one) or a function that gets each micro-batch. The checkpoint defaults to a fresh one in
    the shared folder. A stream that is not ``live`` ends when it has read what is there now.
    """
    writer = df.writeStream.outputMode(mode).options(**options)
    writer = writer.option("checkpointLocation", checkpoint or scratch_path(df.sparkSession, "stream-checkpoint"))
    if name:
        writer = writer.queryName(name)
    if callable(sink):
        writer = writer.foreachBatch(sink)
    else:
        writer = writer.format(sink)
    if sink in FILE_SINKS:
        writer = writer.option("path", path)
    if not live:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def finish(queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until the streams end, or ``timeout`` seconds in all, then stop them.

    A stream that failed raises its error here, after the others have been stopped too.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        for query in queries:
            query.awaitTermination(None if deadline is None else max(0.001, deadline - time.monotonic()))
    finally:
        for query in queries:
            query.stop()


def run_stream(df: DataFrame, sink, mode: str = "append", timeout: float | None = None, **settings) -> StreamingQuery:
    """Run one stream and return the stopped query; ``settings`` as for ``start_stream``.

    Without ``timeout`` what is there now is processed; with it the stream stays live that long.
    """
    query = start_stream(df, sink, mode, live=timeout is not None, **settings)
    finish([query], timeout)
    return query


def revisions_to(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for update mode: each micro-batch becomes one partition of a Parquet table.

    A batch that is run again after a failure replaces its own partition and nothing else.
    The table grows with every batch until ``compact_revisions`` is called, which may be between two runs.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/revision={2 * batch_id}")

    return write


def latest_revisions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest revision of every key: the state of the stream's result, free of repeats."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "revision")]
    return rows.groupBy(*keys).agg(*[F.max_by(c, "revision").alias(c) for c in values])


def compact_revisions(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Replace all revisions by the newest of every key.

    They go to a partition of their own, between the last batch and the next, before the older ones are deleted: a
    failure in between leaves both, and the newest revision of a key is the same in either. Not to be called while
    the stream runs.
    """
    last = spark.read.parquet(path).agg(F.max("revision")).first()[0]
    if last is None:
        return
    kept = last + 1 - last % 2
    if last % 2 == 0:
        latest_revisions(spark, path, keys).write.mode("overwrite").parquet(f"{path}/revision={kept}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("revision=") and int(name.removeprefix("revision=")) < kept:
            files.delete(status.getPath(), True)


def upsert_stream(
    df: DataFrame, keys: Sequence[str], name: str | None = None, path: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Run an aggregating stream over what is there now and return its final result.

    With ``path`` and ``checkpoint`` a later call goes on where this one ended. A source without rows gives no rows.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "stream-result")
    # Older than any batch and empty: it gives the table its columns.
    spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]).write.mode("overwrite").parquet(
        f"{path}/revision=-2"
    )
    run_stream(df, revisions_to(path), mode="update", name=name, checkpoint=checkpoint)
    return latest_revisions(spark, path, keys)


def append_stream(df: DataFrame, name: str | None = None) -> tuple[DataFrame, ProgressLog]:
    """Run a stream into a Parquet table; only windows that the watermark closed are in it. Its progress comes along."""
    spark = df.sparkSession
    path = scratch_path(spark, "stream-result")
    log = ProgressLog()
    with log.listening(spark):
        query = run_stream(df, "parquet", path=path, name=name)
        log.wait(query)
    return spark.read.schema(df.schema).parquet(path), log


def active_streams(spark: SparkSession) -> list[tuple[str | None, dict]]:
    """Name and status of each running stream."""
    return [(q.name, q.status) for q in spark.streams.active]


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()


def stream_progress(log: ProgressLog) -> DataFrame:
    """One row per micro-batch: rows read, rows of state, rows dropped as late."""
    return SparkSession.active().createDataFrame(
        log.rows, "batch_id BIGINT, input_rows BIGINT, state_rows BIGINT, late_rows_dropped BIGINT"
    )
