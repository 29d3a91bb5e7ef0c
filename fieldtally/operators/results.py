"""Result documents: build, read back, take the latest of each source, merge across sources.

A result log is a frame ``(topic, <order columns>, value)``; ``topic`` is the source's name plus
``_query`` and ``value`` the JSON text of one document. The order column is ``offset`` where a
topic has one partition; with several, name ``timestamp``, ``partition`` and ``offset``.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from fieldtally.functions import kingdom_label, source_label, source_url
from fieldtally.operators.aggregates import species_estimate
from fieldtally.operators.registry import active_sources
from fieldtally.schemas import RESULT_DOCUMENT

RESULT_SUFFIX = "_query"
COUNT_KINDS = ("kingdom", "species", "source")

_CORRUPT = "_corrupt_record"
_STRICT = {"allowSingleQuotes": "false"}


def result_topic(name: Column) -> Column:
    return F.concat(name, F.lit(RESULT_SUFFIX))


def build_documents(
    counts: DataFrame,
    keys: Sequence[str] = ("topic",),
    species: Column | None = None,
    part_bytes: int | None = None,
    snapshot: Column | None = None,
) -> DataFrame:
    """One ``document`` per topic from ``kingdom_sketches`` rows.

    The input is already aggregated, so a list holds one entry per kingdom spelling. ``keys`` may
    name further columns where the rows hold several snapshots of a topic; ``species`` is the
    aggregate that gives a document's number of species, if not that of the merged sketches.

    With ``part_bytes`` a topic whose list would be longer is split: its spellings are dealt by hash to
    documents of about that many bytes, which all hold the totals, the number ``snapshot`` and which of
    how many parts they are. No task then holds more than a part.
    """
    species = species_estimate() if species is None else species
    totals = [species.alias("species"), F.sum("count").alias("source_count")]
    fields = ["kingdom", "species", "source_count", source_label(F.col("topic")).alias("source_name")]
    entry = F.struct("kingdom", "count")
    entries = F.sort_array(F.collect_list(entry)).alias("kingdom")
    if part_bytes is None:
        documents = counts.groupBy(*keys).agg(entries, *totals)
        return documents.select(*keys, F.struct(*fields).alias("document"))
    size = F.octet_length(F.to_json(entry, {"ignoreNullFields": "false"})) + 1
    parts = F.ceil(F.sum(size) / part_bytes).alias("wanted")
    per_topic = counts.groupBy(*keys).agg(parts, *totals)
    hashed = F.pmod(F.xxhash64("kingdom"), F.col("wanted")).cast("int")
    dealt = counts.select(*keys, "kingdom", "count").join(per_topic, list(keys)).withColumn("part", hashed)
    # By chance a part may have no spelling and is then not there.
    there = dealt.groupBy(*keys).agg(F.count_distinct("part").cast("int").alias("parts"))
    documents = dealt.groupBy(*keys, "part", "species", "source_count").agg(entries).join(there, list(keys))
    number = (F.lit(0) if snapshot is None else snapshot).cast("bigint").alias("snapshot")
    return documents.select(*keys, F.struct(*fields, "part", "parts", number).alias("document"))


def result_messages(documents: DataFrame) -> DataFrame:
    """Documents as messages to the sources' result topics; members without value stay as null."""
    value = F.to_json("document", {"ignoreNullFields": "false"})
    messages = documents.withColumns({"topic": result_topic(F.col("topic")), "value": value})
    return messages.drop("document")


def readable(
    log: DataFrame, topics: Sequence[str], order_by: Sequence[str] = ("offset",)
) -> DataFrame:
    """The given topics' messages, each topic up to its first one that is no result document.

    A document is one strict JSON object, alone in its message, with all four members; a number that
    is no whole one, such as ``1.0`` for ``species``, counts as missing.
    What a topic holds from that message on is left out, as a reader that stops there would not
    see it either. The rest of the log is passed on as it is, without a shuffle. The log is read
    twice and may have grown in between; the second pass ends where the first one did.
    """
    log = log.where(F.col("topic").isin(list(topics)))
    bad = unreadable()
    position = _order(order_by)
    checked = log.select("topic", position.alias("position"), bad.alias("bad"))
    seen = checked.groupBy("topic").agg(
        F.min(F.when(F.col("bad"), F.col("position"))).alias("first_bad"),
        F.max("position").alias("last_seen"),
    )
    # At most one row per topic of the list, which the plan holds as literals anyway.
    seen = F.broadcast(seen)
    before = F.col("first_bad").isNull() | (position < F.col("first_bad"))
    within = before & (position <= F.col("last_seen"))
    return log.join(seen, "topic").where(within).drop("first_bad", "last_seen")


def unreadable() -> Column:
    """Whether a message is no result document."""
    document = F.from_json(
        "value",
        f"{RESULT_DOCUMENT}, {_CORRUPT} string",
        {"columnNameOfCorruptRecord": _CORRUPT, **_STRICT},
    )
    # As the only element of a list, a value must be one JSON text and nothing after it.
    alone = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>", _STRICT)
    bad = document.isNull() | document[_CORRUPT].isNotNull() | ~F.equal_null(F.size(alone), F.lit(1))
    for member in ("kingdom", "species", "source_count", "source_name"):
        bad = bad | document[member].isNull()
    return bad


def open_documents(log: DataFrame) -> DataFrame:
    """Replace each message's text by its ``document``."""
    return log.withColumn("document", F.from_json("value", RESULT_DOCUMENT)).drop("value")


def latest(log: DataFrame, order_by: Sequence[str] = ("offset",)) -> DataFrame:
    """The last message of each topic.

    The place of the last message is found first, from the order columns alone, in a hash table of one
    row per topic and task; the message itself is then fetched by its place. No text is sorted,
    aggregated or shuffled, and a columnar log is read without its texts in the first pass. A place
    holds one message, as in a broker and in a table of ``sinks.result_writer``.
    """
    place = _place(log, order_by)
    last = log.groupBy(F.col("topic").alias("last_topic")).agg(F.max(place).alias("last_place"))
    # At most one row per topic, and each of them is in the result.
    fetched = log.join(F.broadcast(last), (F.col("topic") == F.col("last_topic")) & (place == F.col("last_place")))
    return fetched.drop("last_topic", "last_place")


def latest_whole(log: DataFrame, order_by: Sequence[str] = ("offset",)) -> DataFrame:
    """The last messages of each topic, where a document may be in parts: all parts of the last whole one.

    A snapshot of which a part is missing, as a producer leaves it that has failed in between, is passed
    over for the one before. A part that has come twice is there once.
    """
    head = F.from_json("value", "part int, parts int, snapshot bigint")
    marked = log.withColumns({"place": _place(log, order_by), "head": head})
    # A document without parts is a snapshot of its own, known by its place.
    known = F.struct(F.col("head.snapshot").alias("snapshot"), F.when(F.col("head.parts").isNull(), F.col("place")).alias("alone"))
    heads = marked.select(
        "topic", known.alias("known"), "place",
        F.coalesce("head.part", F.lit(0)).alias("part"), F.coalesce("head.parts", F.lit(1)).alias("parts"),
    )
    parts = heads.groupBy("topic", "known", "parts", "part").agg(F.max("place").alias("place"))
    whole = parts.groupBy("topic", "known", "parts").agg(
        F.count("*").alias("there"), F.max("place").alias("last")
    ).where(F.col("there") == F.col("parts"))
    last = whole.groupBy("topic").agg(F.max_by("known", "last").alias("known"))
    places = parts.join(last, ["topic", "known"]).select("topic", "place", "part")
    fetched = marked.withColumn("part", F.coalesce("head.part", F.lit(0))).join(places, ["topic", "place", "part"])
    return fetched.select(*log.columns)


def active_results(log: DataFrame, registry: DataFrame) -> DataFrame:
    """Messages of the active sources; a source without any is simply not there."""
    topics = active_sources(registry).select(result_topic(F.col("name")).alias("topic"))
    return log.join(topics, "topic", "left_semi")


def count_by(
    log: DataFrame,
    by: str,
    registry: DataFrame,
    order_by: Sequence[str] = ("offset",),
    parts: bool = False,
) -> DataFrame:
    """Merge the latest document of every active source in a readable log.

    ``kingdom``: counts added by exact name, missing names together. ``species``: the sum of the
    sources' own estimates, one row, 0 without any document. ``source``: each source's record count.
    ``parts`` reads documents that may be in parts (``latest_whole``).
    """
    if by not in COUNT_KINDS:
        raise ValueError(f"cannot count by {by!r}; choose from {', '.join(COUNT_KINDS)}")
    last = (latest_whole if parts else latest)(active_results(log, registry), order_by)
    documents = open_documents(last)
    if by == "kingdom":
        entries = documents.select(F.explode("document.kingdom").alias("entry"))
        label = kingdom_label(F.col("entry.kingdom")).alias("kingdom")
        return entries.groupBy(label).agg(F.sum("entry.count").alias("count"))
    if by == "species":
        if parts:  # each of which has its source's number
            documents = documents.select("topic", F.struct("document.species").alias("document")).distinct()
        total = F.coalesce(F.sum("document.species"), F.lit(0).cast("bigint"))
        return documents.agg(total.alias("species"))
    counts = documents.groupBy(F.col("document.source_name").alias("name")).agg(
        F.max_by("document.source_count", _order(order_by)).alias("count")
    )
    return counts.select(source_url(F.col("name")).alias("source"), "count")


# Decimal places for a broker's partition number and offset, which go below the
# eighteen of a time in microseconds.
_PARTITION_DIGITS, _OFFSET_DIGITS = 5, 15
_BROKER_ORDER = ("timestamp", "partition", "offset")


def _place(log: DataFrame, order_by: Sequence[str]) -> Column:
    """The order columns as one value; a broker's as one number, which a hash aggregate can hold."""
    if tuple(order_by) != _BROKER_ORDER or dict(log.dtypes)["timestamp"] != "timestamp":
        return _order(order_by)
    whole = "decimal(38,0)"
    time, partition = F.unix_micros("timestamp").cast(whole), F.col("partition").cast(whole)
    above_time, above_partition = Decimal(10) ** (_PARTITION_DIGITS + _OFFSET_DIGITS), Decimal(10) ** _OFFSET_DIGITS
    return (time * F.lit(above_time) + partition * F.lit(above_partition) + F.col("offset").cast(whole)).cast(whole)


def _order(order_by: Sequence[str]) -> Column:
    return F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)
