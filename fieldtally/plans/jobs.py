from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fieldtally.operators.aggregates import (
    category_counts,
    kingdom_counts,
    kingdom_exact_running,
    kingdom_sketches,
)
from fieldtally.operators.records import core_records
from fieldtally.operators.registry import RunningSources, find_source, mark_started
from fieldtally.operators.results import RESULT_SUFFIX
from fieldtally.schemas import SOURCES
from fieldtally.sources.messages import BROKER, decode_value, message_stream
from fieldtally.sources.pages import unnest_with_places
from fieldtally.streaming.sinks import (
    LARGE_STATE,
    SMALL_STATE,
    record_messages,
    result_writer,
    snapshot_writer,
    start_query,
)

# How often each job shows its result, and how long the report runs.
REPORT_TRIGGER = "120 seconds"
REPORT_SECONDS = 1200
LIVE_TRIGGER = "15 seconds"


class StartedSource(NamedTuple):
    query: StreamingQuery
    registry: DataFrame
    producer: StreamingQuery | None = None


def page_messages(
    pages: DataFrame,
    source: str,
    column: str = "page",
    mode: str = "FAILFAST",
    page_key: Sequence[str] = (),
) -> DataFrame:
    """Landed pages as messages to the source's topic, one per record; batch or stream.

    A page that cannot be read fails the job. With ``mode="PERMISSIVE"`` it is passed over, and
    ``rejected_pages`` of the same pages shows it. A message's key comes from its page and its
    position, so a page that is sent again gives the same messages, of which ``unique_messages``
    leaves one; ``page_key`` names the columns that tell pages of equal text apart.
    """
    return record_messages(unnest_with_places(pages, source, column, mode, page_key=page_key))


def start_producer(
    pages: DataFrame,
    source: str,
    checkpoint: str,
    fmt: str = BROKER,
    options: Mapping[str, str] | None = None,
    name: str = "producer",
    column: str = "page",
    every: str | None = LIVE_TRIGGER,
    mode: str = "FAILFAST",
    page_key: Sequence[str] = (),
) -> StreamingQuery:
    """Publish the records of a source's pages as they land; see ``page_messages`` for ``mode`` and ``page_key``."""
    messages = page_messages(pages, source, column, mode, page_key)
    return start_query(
        messages, name, checkpoint, fmt=fmt, mode="append", every=every, options=options
    )


def category_report(messages: DataFrame, topics: Sequence[str] = SOURCES) -> DataFrame:
    """One row per source with its category counts; batch or stream."""
    return category_counts(_core(messages, topics))


def start_category_report(
    messages: DataFrame,
    checkpoint: str,
    fmt: str = "console",
    name: str = "category_report",
    topics: Sequence[str] = SOURCES,
    every: str | None = REPORT_TRIGGER,
    settings: Mapping[str, str] = SMALL_STATE,
) -> StreamingQuery:
    """The report as a running query; ``run_for(query, REPORT_SECONDS)`` gives its ten windows."""
    report = category_report(messages, topics)
    return start_query(report, name, checkpoint, fmt=fmt, every=every, settings=settings)


def snapshot_series(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    name: str = "snapshot_series",
    topics: Sequence[str] = SOURCES,
    every: str | None = REPORT_TRIGGER,
    keep: int | None = None,
    compact: int | None = None,
) -> StreamingQuery:
    """The report at every trigger, kept by ``epoch_id``. Counts add up and never start over.

    ``keep`` and ``compact`` bound the epochs and folders that are kept, see ``SnapshotTable``.
    """
    return start_query(
        category_report(messages, topics),
        name,
        checkpoint,
        foreach_batch=snapshot_writer(path, keep, compact),
        every=every,
        settings=SMALL_STATE,
    )


def start_kingdom_counts(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    name: str = "kingdom_counts",
    topics: Sequence[str] = SOURCES,
    every: str | None = LIVE_TRIGGER,
    settings: Mapping[str, str] = SMALL_STATE,
    keep: int | None = None,
    compact: int | None = None,
) -> StreamingQuery:
    """Kingdom counts as spelled, kept by ``epoch_id``.

    Sources with a great many spellings are better served with ``LARGE_STATE``.
    """
    return start_query(
        kingdom_counts(_core(messages, topics)),
        name,
        checkpoint,
        foreach_batch=snapshot_writer(path, keep, compact),
        every=every,
        settings=settings,
    )


def start_kingdom_exact(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    name: str = "kingdom_exact",
    topics: Sequence[str] = SOURCES,
    every: str | None = LIVE_TRIGGER,
    settings: Mapping[str, str] = LARGE_STATE,
    keep: int | None = None,
    compact: int | None = None,
) -> StreamingQuery:
    """Records and exact distinct names per kingdom, kept by ``epoch_id``.

    The names seen so far are small rows of state, spread by hash and held outside the heap. A
    trigger reads and writes those of its own records; what it hands over is a row per kingdom.
    """
    return start_query(
        kingdom_exact_running(_core(messages, topics)),
        name,
        checkpoint,
        foreach_batch=snapshot_writer(path, keep, compact),
        every=every,
        settings=settings,
    )


def start_live_counts(
    messages: DataFrame,
    checkpoint: str,
    fmt: str = BROKER,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    name: str = "live_counts",
    topics: Sequence[str] = SOURCES,
    every: str | None = LIVE_TRIGGER,
    settings: Mapping[str, str] = SMALL_STATE,
    part_bytes: int | None = None,
) -> StreamingQuery:
    """Publish one result document per source at every trigger, in parts if it is longer than ``part_bytes``.

    Kingdom counts and totals come from one query, so a document never mixes two states. The state
    is a count and a sketch of fixed size per kingdom spelling; ``LARGE_STATE`` in ``settings``
    keeps it outside the heap for sources with a great many spellings.
    """
    return start_query(
        kingdom_sketches(_core(messages, topics)),
        name,
        checkpoint,
        foreach_batch=result_writer(fmt, path, options, part_bytes),
        every=every,
        settings=settings,
    )


def add_source(
    spark: SparkSession,
    url: str,
    registry: DataFrame,
    checkpoint: str,
    source: Mapping[str, object] | None = None,
    sink: Mapping[str, object] | None = None,
    every: str | None = LIVE_TRIGGER,
    pages: DataFrame | None = None,
    producer: Mapping[str, object] | None = None,
    running: RunningSources | None = None,
) -> StartedSource:
    """Start the source behind ``url``; unknown URLs raise ``ValueError``.

    Its live counts are started, and before them its producer if ``pages`` has its landed pages. Without
    a trigger (``every=None``) the producer has ended before the counts start, so that they see all it sent.
    ``source``, ``sink`` and ``producer`` are further arguments of ``message_stream``, ``start_live_counts``
    and ``start_producer``. The returned registry shows the source as active; ``running`` counts the
    queries for as long as they live, and its registry is returned instead.
    """
    name = find_source(registry, url)
    sending = None
    if pages is not None:
        sending = start_producer(
            pages, name, f"{checkpoint}/producer", name=name + "_producer", every=every, **(producer or {})
        )
        if running:
            running.watch(name, sending, producer=True)
    try:
        if sending is not None and every is None:
            sending.awaitTermination()
        query = start_live_counts(
            message_stream(spark, [name], **(source or {})),
            f"{checkpoint}/counts",
            name=name + RESULT_SUFFIX,
            topics=[name],
            every=every,
            **(sink or {}),
        )
    except Exception:
        if sending is not None:
            sending.stop()
        raise
    if running:
        running.watch(name, query)
        return StartedSource(query, running.registry(registry), sending)
    return StartedSource(query, mark_started(registry, name, sending is not None), sending)


def _core(messages: DataFrame, topics: Sequence[str]) -> DataFrame:
    return core_records(decode_value(messages), topics)
