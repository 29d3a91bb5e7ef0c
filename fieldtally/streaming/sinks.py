"""Encode, publish, and start or stop streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager, suppress
from threading import Lock

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldtally.operators.results import build_documents, result_messages
from fieldtally.sources.messages import BROKER
from fieldtally.streaming.manifest import SnapshotTable

BatchWriter = Callable[[DataFrame, int], None]

# For state of a few rows per source: without it every trigger would run a task and keep a state
# file for each of the session's shuffle partitions.
SMALL_STATE = {"spark.sql.shuffle.partitions": "4"}

# For state that grows with the data: kept on the executors' disks instead of their heap, and each
# trigger uploads its changes only.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def message_key(*parts: Column) -> Column:
    """A key in the form of a UUID that is the same whenever the parts are; their texts are not null."""
    digest = F.md5(F.concat_ws("\x1f", *parts).cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def encode_messages(records: DataFrame, topic: str, key: Sequence[str] = ()) -> DataFrame:
    """One message per record: a key and its JSON text, members without value kept.

    The key is random, or worked out from the columns ``key``, so that a record sent again has it again.
    """
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    of_columns = [F.coalesce(F.to_json(F.struct(F.col(name))), F.lit("")) for name in key]
    own = message_key(F.lit(topic), *of_columns) if key else F.uuid()
    return records.select(own.alias("key"), value.alias("value"), F.lit(topic).alias("topic"))


def record_messages(records: DataFrame) -> DataFrame:
    """Messages of records that are JSON text already, such as unnested pages.

    The key is made from the record's page and its position there, if the records have them.
    """
    value = F.coalesce("value", F.lit("null")).alias("value")
    placed = {"page_key", "position"} <= set(records.columns)
    key = message_key(F.col("topic"), F.col("page_key"), F.col("position").cast("string")) if placed else F.uuid()
    return records.select(key.alias("key"), value, "topic")


def publish(
    messages: DataFrame, fmt: str = BROKER, options: Mapping[str, str] | None = None
) -> None:
    """Write a batch of messages from the executors; nothing passes through the driver."""
    messages.write.format(fmt).mode("append").options(**(options or {})).save()


def start_query(
    df: DataFrame,
    name: str,
    checkpoint: str,
    fmt: str | None = None,
    foreach_batch: BatchWriter | None = None,
    mode: str = "complete",
    every: str | None = None,
    options: Mapping[str, str] | None = None,
    settings: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start a named query into a sink format or a per-batch function.

    ``every`` is the processing-time trigger; without it the query takes what is there and ends.
    The ``console`` and ``memory`` sinks bring the whole result to the driver: they are for results
    of a known size, such as one row per source.
    ``settings`` are session settings for this query alone. State settings among them hold from
    the first start on; later starts from the same checkpoint keep the first ones.
    """
    if (fmt is None) == (foreach_batch is None):
        raise ValueError("give either a sink format or a function per batch")
    writer = (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    writer = writer.format(fmt) if fmt else writer.foreachBatch(foreach_batch)
    with _settings(df.sparkSession, settings or {}):
        return writer.start()


def run_for(query: StreamingQuery, seconds: float | None = None) -> bool:
    """Wait up to ``seconds``, or until the query ends, and stop it. True if it ended by itself."""
    try:
        if seconds is None:
            query.awaitTermination()
            return True
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()


class RunFailed(Exception):
    """At least one of several queries failed; ``failures`` has the message of each that did, by name."""

    def __init__(self, failures: dict[str, str]):
        super().__init__("; ".join(f"{name}: {message}" for name, message in failures.items()))
        self.failures = failures


def run_together(
    spark: SparkSession, queries: Sequence[StreamingQuery], seconds: float | None = None
) -> dict[str, bool]:
    """Wait up to ``seconds``, or until all queries have ended, and stop them.

    The first one that fails ends the run: the others are stopped and ``RunFailed`` reports all
    failures. Otherwise returns, by name, whether each query ended by itself.
    """
    deadline = None if seconds is None else time.monotonic() + seconds
    try:
        while not any(query.exception() for query in queries) and any(query.isActive for query in queries):
            left = None if deadline is None else deadline - time.monotonic()
            if left is not None and left <= 0:
                break
            with suppress(StreamingQueryException):  # of any query of the session; ours are looked at below
                # Forgotten before the wait, so that what ended earlier does not end it at once. What ends in
                # between is seen by the loop's condition at the latest a second later.
                spark.streams.resetTerminated()
                spark.streams.awaitAnyTermination(min(1.0, left or 1.0))
        ended = {query.name: not query.isActive for query in queries}
    finally:
        for query in queries:
            query.stop()
    failures = {query.name: str(query.exception()) for query in queries if query.exception()}
    if failures:
        raise RunFailed(failures)
    return ended


def snapshot_writer(path: str, keep: int | None = None, compact: int | None = None) -> BatchWriter:
    """Per-batch function that commits each trigger's rows to the ``SnapshotTable`` under ``path``.

    A batch may be handed over again after a failure; it then replaces its own rows. All epochs are
    kept in folders of their own unless ``keep`` or ``compact`` says otherwise.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        SnapshotTable(batch.sparkSession, path, keep, compact).commit(batch, epoch_id)

    return write


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All committed snapshots, with ``epoch_id``."""
    return SnapshotTable(spark, path).read()


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the last trigger only; the files of the others are not opened."""
    return SnapshotTable(spark, path).latest()


def result_writer(
    fmt: str = BROKER,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    part_bytes: int | None = None,
) -> BatchWriter:
    """Per-batch function that turns ``kingdom_sketches`` rows into documents and publishes them.

    A broker may receive a document twice after a failure, which leaves the latest one the same. A
    table under ``path`` gets one partition per topic and trigger, the trigger's number as
    ``offset``; a repeated trigger replaces its own partition. With ``part_bytes`` longer documents are
    published in parts, the trigger's number as their snapshot.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        documents = build_documents(batch, part_bytes=part_bytes, snapshot=F.lit(epoch_id))
        messages = result_messages(documents)
        if fmt == BROKER:
            publish(messages, BROKER, options)
            return
        (
            messages.withColumn("offset", F.lit(epoch_id).cast("bigint"))
            .write.format(fmt)
            .mode("overwrite")
            .options(**{"partitionOverwriteMode": "dynamic", **(options or {})})
            .partitionBy("topic", "offset")
            .save(path)
        )

    return write


# Queries may be started from several threads, and a session has one set of settings.
_STARTING = Lock()


@contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    # A query copies the session's settings when it starts, so they are put back right after.
    with _STARTING:
        before = {key: spark.conf.get(key, None) for key in settings}
        for key, value in settings.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)
