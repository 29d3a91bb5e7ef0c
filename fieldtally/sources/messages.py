"""Message streams and result logs. The format is a parameter: a broker, or landed files.

A frame of messages has the columns of ``schemas.MESSAGE``; files may hold any subset of them that
includes ``topic`` and ``value``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldtally.operators.results import RESULT_SUFFIX
from fieldtally.schemas import MESSAGE

BROKER = "kafka"


def broker_options(servers: Sequence[str], topics: Sequence[str] = ()) -> dict[str, str]:
    """Options that name the brokers and, for a scan, the topics."""
    if not servers:
        raise ValueError("at least one broker address is needed")
    options = {"kafka.bootstrap.servers": ",".join(servers)}
    if topics:
        options["subscribe"] = ",".join(topics)
    return options


def message_stream(
    spark: SparkSession,
    topics: Sequence[str],
    fmt: str = BROKER,
    servers: Sequence[str] = (),
    path: str | None = None,
    starting_offsets: str | None = None,
    schema: str = MESSAGE,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Unbounded frame of the topics' messages, from the broker or from files under ``path``.

    The broker is read from ``starting_offsets`` on (``latest`` if not given); files from the first.
    ``options`` go to the source: ``minPartitions`` splits a topic of few partitions (or one that
    holds most of the records) over more tasks, ``maxOffsetsPerTrigger`` and ``maxFilesPerTrigger``
    bound a micro-batch.
    """
    if not topics:
        raise ValueError("at least one topic is needed")
    options = dict(options or {})
    if fmt == BROKER:
        scan = {**broker_options(servers, topics), "startingOffsets": starting_offsets or "latest", **options}
        return spark.readStream.format(BROKER).options(**scan).load()
    if starting_offsets is not None:
        raise ValueError("files are read from the beginning; a start is for the broker only")
    stream = file_stream(spark, _need(path), schema, fmt, options)
    return stream.where(F.col("topic").isin(list(topics)))


def file_stream(
    spark: SparkSession,
    path: str,
    schema,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stream over a folder of files; files that arrive later are in later micro-batches."""
    return spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(path)


def decode_value(messages: DataFrame) -> DataFrame:
    """Topic and text of each message; key and position are dropped."""
    return messages.select("topic", F.col("value").cast("string").alias("value"))


def unique_messages(messages: DataFrame) -> DataFrame:
    """Each message once by its topic and key, as a producer that starts again sends some twice.

    Messages without a key all stay. Of a stream the keys seen are state, spread by hash, which grows
    with the messages: run its query with ``sinks.LARGE_STATE``.
    """
    keyed = messages.where(F.col("key").isNotNull()).dropDuplicates(["topic", "key"])
    return keyed.unionByName(messages.where(F.col("key").isNull()))


def read_result_log(
    spark: SparkSession,
    names: Sequence[str],
    fmt: str = BROKER,
    servers: Sequence[str] = (),
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    after: Mapping[str, int] | None = None,
) -> DataFrame:
    """Every result message of the named sources from the beginning, as a batch.

    ``after`` names topics of one partition of which only the messages behind an offset are read.

    A source that has published nothing yet is skipped. From the broker the columns are ``topic,
    partition, offset, timestamp, value``. A table of results written by ``sinks.result_writer``
    has ``topic, offset, value``.
    """
    topics = [name + RESULT_SUFFIX for name in names]
    if not topics:
        raise ValueError("at least one source is needed")
    if fmt == BROKER:
        base = {**broker_options(servers), "endingOffsets": "latest", **(options or {})}
        known = {topic: {"0": offset + 1} for topic, offset in (after or {}).items() if topic in topics}
        rest = [topic for topic in topics if topic not in known]
        scans = []
        if known:
            assigned = json.dumps({topic: [0] for topic in known})
            scans.append({**base, "assign": assigned, "startingOffsets": json.dumps(known)})
        if rest:
            # A list of topics would fail on one that does not exist yet, a pattern passes over it.
            pattern = "|".join(re.escape(topic) for topic in rest)
            scans.append({"subscribePattern": pattern, "startingOffsets": "earliest", **base})
        value = F.col("value").cast("string").alias("value")
        logs = [
            spark.read.format(BROKER).options(**scan).load()
            .select("topic", "partition", "offset", "timestamp", value)
            for scan in scans
        ]
        return reduce(DataFrame.union, logs)
    schema = "topic string, offset bigint, value string"
    log = spark.read.format(fmt).schema(schema).options(**(options or {})).load(_need(path))
    # Topic and offset are the table's partitions, so what is not wanted is not opened.
    wanted = F.lit(False)
    for topic in topics:
        own = F.col("topic") == topic
        wanted = wanted | (own & (F.col("offset") > after[topic]) if topic in (after or {}) else own)
    return log.where(wanted)


def _need(path: str | None) -> str:
    if not path:
        raise ValueError("a file format needs a path")
    return path
