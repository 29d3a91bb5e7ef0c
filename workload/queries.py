from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldtally.functions import source_name
from fieldtally.operators import aggregates, records, registry, results
from fieldtally.plans import jobs
from fieldtally.plans.reading import FollowedResults
from fieldtally.sources import pages as page_source
from fieldtally.sources.messages import decode_value, file_stream, read_result_log, unique_messages
from fieldtally.sources.pages import page_status, unnest_pages
from fieldtally.streaming import sinks
from fieldtally.workspace import run_folder
from workload import mirror

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}
RESULT_TOPICS = [name + results.RESULT_SUFFIX for name in mirror.TOPICS]


def registered(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mirror.table(spark, sf_dir, "events")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mirror.table(spark, sf_dir, "documents")


def _core(events: DataFrame) -> DataFrame:
    return records.core_records(decode_value(mirror.messages(events)))


# Parsing


@registered
def parse_core(spark, sf_dir):
    return _core(_events(spark, sf_dir))


@registered
def parse_malformed(spark, sf_dir):
    damaged = decode_value(mirror.damaged_messages(_events(spark, sf_dir)))
    return aggregates.kingdom_counts(records.core_records(damaged))


@registered
def parse_props(spark, sf_dir):
    props = records.parse_json(_events(spark, sf_dir), "k int", "props")
    return props.groupBy("k").agg(F.count("*").alias("count"))


@registered
def parse_full_gbif(spark, sf_dir):
    full = records.parse_records(mirror.full_messages(_events(spark, sf_dir), "gbif"), "gbif")
    return full.select(
        "key",
        F.col("taxonKey").alias("taxon_key"),
        F.col("crawlId").alias("crawl_id"),
        F.col("extensions")["props"].alias("props"),
        F.col("decimalLatitude").alias("latitude"),
        F.col("gadm")["level0"]["name"].alias("place"),
        "year",
        "month",
        "day",
        F.get("issues", F.lit(1)).alias("second_issue"),
        F.col("isSequenced").alias("is_sequenced"),
        F.get("identifiers", F.lit(0))["identifier"].alias("first_identifier"),
        F.col("`http://unknown.org/language`").alias("language"),
        "kingdom",
        F.col("scientificName").alias("scientific_name"),
    )


@registered
def parse_full_idigbio(spark, sf_dir):
    full = records.parse_records(mirror.full_messages(_events(spark, sf_dir), "idigbio"), "idigbio")
    return full.select(
        "id",
        F.col("dwc:group").alias("is_view"),
        F.col("dwc:individualCount").alias("individual_count"),
        F.col("dwc:higherClassification").alias("classification"),
        F.col("dwc:kingdom").alias("kingdom"),
        F.col("dwc:scientificName").alias("scientific_name"),
    )


@registered
def parse_full_obis(spark, sf_dir):
    full = records.parse_records(mirror.full_messages(_events(spark, sf_dir), "obis"), "obis")
    return full.select(
        "id",
        "sst",
        F.col("aphiaID").alias("aphia_id"),
        "depth",
        "dropped",
        F.get("node_id", F.lit(0)).alias("first_node"),
        "kingdom",
        F.col("scientificName").alias("scientific_name"),
    )


def _all_fields(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Of every field of a source's records, in how many it has a value, and the sum of all values."""
    full = records.parse_records(mirror.filled_messages(_events(spark, sf_dir), source), source)
    sums = [
        F.struct(
            F.lit(field.name).alias("field"),
            mirror.field_sum(field.dataType.simpleString(), F.col(f"`{field.name}`")).alias("value"),
        )
        for field in full.schema.fields
    ]
    values = full.select(F.inline(F.array(*sums)))
    return values.groupBy("field").agg(F.count("value").alias("filled"), F.sum("value").alias("total"))


@registered
def all_fields_gbif(spark, sf_dir):
    return _all_fields(spark, sf_dir, "gbif")


@registered
def all_fields_idigbio(spark, sf_dir):
    return _all_fields(spark, sf_dir, "idigbio")


@registered
def all_fields_obis(spark, sf_dir):
    return _all_fields(spark, sf_dir, "obis")


@registered
def union_sources(spark, sf_dir):
    decoded = decode_value(mirror.messages(_events(spark, sf_dir)))
    per_source = {
        name: records.parse_records(
            decoded.where(F.col("topic") == name), name, records.CORE_FIELDS[name].values()
        )
        for name in mirror.TOPICS
    }
    return aggregates.kingdom_counts(records.union_sources(per_source))


# Landed pages


def _page_records(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    pages = mirror.document_pages(_documents(spark, sf_dir), source)
    fields = [mirror.LINE_ID[source], *records.CORE_FIELDS[source].values()]
    lines = records.parse_records(unnest_pages(pages, source), source, fields)
    return lines.toDF("line_id", "kingdom", "scientific_name")


@registered
def unnest_results_pages(spark, sf_dir):
    return _page_records(spark, sf_dir, "gbif")


@registered
def unnest_items_pages(spark, sf_dir):
    return _page_records(spark, sf_dir, "idigbio")


@registered
def unnest_cursor_pages(spark, sf_dir):
    return _page_records(spark, sf_dir, "obis")


@registered
def page_status_results(spark, sf_dir):
    return page_status(mirror.document_pages(_documents(spark, sf_dir), "gbif"), "gbif")


@registered
def page_status_items(spark, sf_dir):
    pages = mirror.document_pages(_documents(spark, sf_dir), "idigbio")
    return page_status(pages, "idigbio", page_size=8)


@registered
def page_status_cursor(spark, sf_dir):
    return page_status(mirror.document_pages(_documents(spark, sf_dir), "obis"), "obis")


@registered
def rejected_pages(spark, sf_dir):
    """Pages of all sources, most of them damaged: those read with their records, the others as rejected."""
    found = []
    for source in mirror.TOPICS:
        pages = mirror.damaged_pages(_documents(spark, sf_dir), source)
        read = page_status(pages, source).where(F.col("record_count").isNotNull())
        found.append(read.select("doc_id", "record_count", F.lit(False).alias("rejected")))
        lost = page_source.rejected_pages(pages, source)
        found.append(lost.select("doc_id", F.lit(None).cast("int"), F.lit(True)))
        found[-2:] = [part.select(F.lit(source).alias("source"), "*") for part in found[-2:]]
    return reduce(DataFrame.union, found)


# Messages


@registered
def encode_messages(spark, sf_dir):
    seen = mirror.observations(_events(spark, sf_dir))
    sent = sinks.encode_messages(seen.select("event_id", "kingdom", "scientificName"), "gbif")
    return sent.select("topic", "value", F.length("key").alias("key_length"))


@registered
def text_round_trip(spark, sf_dir):
    sent = sinks.encode_messages(_documents(spark, sf_dir).select("doc_id", "lang", "text"), "gbif")
    back = records.parse_json(sent, "doc_id bigint, lang string, text string")
    digest = F.md5(F.col("text").cast("binary"))
    return back.select("doc_id", "lang", digest.alias("digest"), F.length("text").alias("chars"))


# Aggregates

# Relative errors of the two species estimates.
ESTIMATE_ERROR = 0.05
SKETCH_ERROR = 1.04 / 2 ** (aggregates.SKETCH_SIZE / 2)


def _exact_species(events: DataFrame, *keys: str) -> DataFrame:
    """Exact number of names per source, where ``keys`` are given also per their values."""
    seen = mirror.observations(events).withColumn("source", F.upper("topic"))
    names = seen.dropDuplicates(["source", *keys, "scientificName"])
    return names.groupBy("source", *keys).agg(F.count("scientificName").alias("exact"))


def _within_bound(
    events: DataFrame, report: DataFrame, estimate: str, error: float = ESTIMATE_ERROR, *keys: str
) -> DataFrame:
    """The report with its estimate replaced by whether it is within three errors of the exact number."""
    within = F.abs(F.col(estimate) - F.col("exact")) <= 3 * error * F.col("exact")
    joined = report.join(_exact_species(events, *keys), ["source", *keys])
    return joined.withColumn("species_within_bound", within).drop(estimate, "exact")


@registered
def kingdom_counts(spark, sf_dir):
    return aggregates.kingdom_counts(_core(_events(spark, sf_dir)))


@registered
def kingdom_exact(spark, sf_dir):
    return aggregates.kingdom_exact(_core(_events(spark, sf_dir)))


@registered
def category_report(spark, sf_dir):
    events = _events(spark, sf_dir)
    return _within_bound(events, jobs.category_report(mirror.messages(events)), "unique_species")


@registered
def species_bound(spark, sf_dir):
    """Totals, with the species estimate checked against the exact number."""
    events = _events(spark, sf_dir)
    totals = _within_bound(events, aggregates.source_totals(_core(events)), "distinct_count")
    return totals.withColumnRenamed("species_within_bound", "within_bound")


def _lineitem_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mirror.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("topic"),
        F.col("l_linestatus").alias("kingdom"),
        F.col("l_partkey").alias("scientificName"),
    )


@registered
def lineitem_kingdom_counts(spark, sf_dir):
    return aggregates.kingdom_counts(_lineitem_core(spark, sf_dir))


@registered
def lineitem_kingdom_exact(spark, sf_dir):
    return aggregates.kingdom_exact(_lineitem_core(spark, sf_dir))


@registered
def part_kingdom_exact(spark, sf_dir):
    core = mirror.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("topic"),
        F.col("p_type").alias("kingdom"),
        F.col("p_name").alias("scientificName"),
    )
    return aggregates.kingdom_exact(core)


@registered
def document_counts(spark, sf_dir):
    core = _documents(spark, sf_dir).select(
        F.col("source").alias("topic"), F.col("lang").alias("kingdom")
    )
    return aggregates.kingdom_counts(core)


# Result log


# Bytes of the documents that are published in parts.
PART_BYTES = 4096


def _readable(spark: SparkSession, log: DataFrame) -> DataFrame:
    """The readable part of a log that is published first and then read back.

    Reading it takes two passes, which should not each derive the log from the events again.
    """
    path = run_folder(spark, "results")
    sinks.publish(log, "parquet", {"path": path})
    published = read_result_log(spark, mirror.TOPICS, "parquet", path=path)
    return results.readable(published, RESULT_TOPICS)


@registered
def read_results(spark, sf_dir):
    """Each document of a log in which one source's messages become unreadable."""
    log = _readable(spark, mirror.broken_results(_events(spark, sf_dir)))
    document = F.col("document")
    return results.open_documents(log).select(
        "topic",
        "offset",
        F.array_size(document["kingdom"]).alias("kingdoms"),
        document["species"].alias("species"),
        document["source_count"].alias("source_count"),
        document["source_name"].alias("source_name"),
    )


@registered
def latest_results(spark, sf_dir):
    log = _readable(spark, mirror.broken_results(_events(spark, sf_dir)))
    last = results.open_documents(results.latest(log))
    return last.select("topic", "offset", F.explode("document.kingdom").alias("entry")).select(
        "topic", "offset", "entry.kingdom", "entry.count"
    )


def _count_by(spark: SparkSession, sf_dir: str, by: str, idle: str | None = None) -> DataFrame:
    events = _events(spark, sf_dir)
    log = _readable(spark, mirror.daily_results(events))
    return results.count_by(log, by, mirror.event_registry(events, idle))


@registered
def count_by_kingdom(spark, sf_dir):
    return _count_by(spark, sf_dir, "kingdom")


@registered
def count_by_species(spark, sf_dir):
    return _count_by(spark, sf_dir, "species")


@registered
def count_by_source(spark, sf_dir):
    return _count_by(spark, sf_dir, "source")


@registered
def count_by_source_active(spark, sf_dir):
    """As ``count_by_source``, with one source of the log not active."""
    return _count_by(spark, sf_dir, "source", idle="idigbio")


@registered
def count_by_kingdom_followed(spark, sf_dir):
    """As ``count_by_kingdom``, of a log that is read in two steps, each of what is new."""
    events = _events(spark, sf_dir)
    path = run_folder(spark, "results")
    daily = mirror.daily_results(events)
    first = F.dayofmonth(F.date_from_unix_date(F.col("offset").cast("int"))) <= 15
    followed = FollowedResults(spark, mirror.TOPICS, run_folder(spark, "followed"))
    for part in (first, ~first):
        daily.where(part).write.mode("append").partitionBy("topic", "offset").parquet(path)
        log = followed.advance("parquet", path=path)
    return results.count_by(log, "kingdom", mirror.event_registry(events))


@registered
def count_by_kingdom_in_parts(spark, sf_dir):
    """Customers' names as kingdoms: so many that a document is published in parts, and merged from them."""
    customers = mirror.table(spark, sf_dir, "customer")
    topic = F.get(F.array(*map(F.lit, mirror.TOPICS)), (F.col("c_custkey") % 3).cast("int"))
    core = customers.select(
        topic.alias("topic"), F.col("c_name").alias("kingdom"), F.col("c_mktsegment").alias("scientificName")
    )
    path = run_folder(spark, "results")
    write = sinks.result_writer("parquet", path, part_bytes=PART_BYTES)
    write(aggregates.kingdom_sketches(core), 0)
    log = read_result_log(spark, mirror.TOPICS, "parquet", path=path)
    sources = registry.known_sources(spark)
    for name in mirror.TOPICS:
        sources = registry.mark_started(sources, name)
    return results.count_by(results.readable(log, RESULT_TOPICS), "kingdom", sources, parts=True)


# Registry


@registered
def source_names(spark, sf_dir):
    pages = mirror.table(spark, sf_dir, "pages")
    return pages.select("page_id", source_name(F.col("url")).alias("name"))


@registered
def list_sources(spark, sf_dir):
    """Sources of the pages, active where a page came in through a feed."""
    fed = F.count_if(F.col("url").contains("utm_source=feed"))
    pages = mirror.table(spark, sf_dir, "pages")
    known = pages.groupBy(source_name(F.col("url")).alias("name")).agg(fed.alias("job_count"))
    return registry.list_sources(known)


# Streams


def _stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mirror.messages(mirror.table_stream(spark, sf_dir, "events"))


def _unique(name: str) -> str:
    return f"{name}_{uuid4().hex}"


@registered
def stream_kingdom_counts(spark, sf_dir):
    path = run_folder(spark, "kingdom-counts")
    query = jobs.start_kingdom_counts(
        _stream_messages(spark, sf_dir),
        path,
        run_folder(spark, "checkpoint"),
        name=_unique("kingdom_counts"),
        every=None,
    )
    sinks.run_for(query)
    return sinks.latest_snapshot(spark, path)


@registered
def stream_category_report(spark, sf_dir):
    """The report as a table in memory, which holds one row per source."""
    name = _unique("category_report")
    query = jobs.start_category_report(
        _stream_messages(spark, sf_dir),
        run_folder(spark, "checkpoint"),
        fmt="memory",
        name=name,
        every=None,
    )
    sinks.run_for(query)
    return _within_bound(_events(spark, sf_dir), spark.table(name), "unique_species")


@registered
def stream_triggered(spark, sf_dir):
    """The report as a query that stays up and is triggered by time, stopped when it has seen all there is."""
    name = _unique("category_report")
    query = jobs.start_category_report(
        _stream_messages(spark, sf_dir),
        run_folder(spark, "checkpoint"),
        fmt="memory",
        name=name,
        every="1 second",
    )
    query.processAllAvailable()
    sinks.run_for(query, 0.1)
    return _within_bound(_events(spark, sf_dir), spark.table(name), "unique_species")


@registered
def stream_kingdom_exact(spark, sf_dir):
    path = run_folder(spark, "kingdom-exact")
    partitions = str(spark.sparkContext.defaultParallelism)
    query = jobs.start_kingdom_exact(
        _stream_messages(spark, sf_dir),
        path,
        run_folder(spark, "checkpoint"),
        name=_unique("kingdom_exact"),
        every=None,
        settings={**sinks.LARGE_STATE, "spark.sql.shuffle.partitions": partitions},
    )
    sinks.run_for(query)
    return sinks.latest_snapshot(spark, path)


@registered
def stream_snapshots(spark, sf_dir):
    """The events land week by week; the query is stopped and resumed after each week."""
    events = _events(spark, sf_dir)
    landed, path = run_folder(spark, "landed"), run_folder(spark, "snapshots")
    checkpoint = run_folder(spark, "checkpoint")
    week_of = F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 7))
    sent = mirror.messages(events).withColumn("week", week_of)
    for number in range(4):
        part = sent.where(F.col("week") == number).select("topic", "value")
        part.write.mode("append").parquet(landed)
        stream = jobs.message_stream(
            spark, mirror.TOPICS, "parquet", path=landed, schema="topic string, value binary"
        )
        query = jobs.snapshot_series(
            stream, path, checkpoint, name=_unique("snapshot_series"), every=None
        )
        sinks.run_for(query)
    # Each snapshot holds the events of its week and of all before.
    week = F.col("week").cast("bigint")
    so_far = events.withColumn("week", week_of).withColumn("epoch_id", F.explode(F.sequence(week, F.lit(3).cast("bigint"))))
    return _within_bound(so_far, sinks.read_snapshots(spark, path), "unique_species", ESTIMATE_ERROR, "epoch_id")


@registered
def concurrent_queries(spark, sf_dir):
    """Two named queries over the same messages at once; both must have seen all of them."""
    path, report = run_folder(spark, "kingdom-counts"), _unique("category_report")
    running = [
        jobs.start_kingdom_counts(
            _stream_messages(spark, sf_dir),
            path,
            run_folder(spark, "checkpoint"),
            name=_unique("kingdom_counts"),
            every=None,
        ),
        jobs.start_category_report(
            _stream_messages(spark, sf_dir),
            run_folder(spark, "checkpoint"),
            fmt="memory",
            name=report,
            every=None,
        ),
    ]
    sinks.run_together(spark, running)
    counts = sinks.latest_snapshot(spark, path)
    by_kingdom = counts.groupBy(F.upper("topic").alias("source")).agg(
        F.sum("count").alias("kingdom_total")
    )
    return spark.table(report).join(by_kingdom, "source").select(
        "source", "kingdom_total", F.col("total_records").alias("report_total")
    )


@registered
def live_counts(spark, sf_dir):
    """Documents published by the live query, read back and opened."""
    path = run_folder(spark, "results")
    query = jobs.start_live_counts(
        _stream_messages(spark, sf_dir),
        run_folder(spark, "checkpoint"),
        fmt="parquet",
        path=path,
        name=_unique("live_counts"),
        every=None,
    )
    sinks.run_for(query)
    log = read_result_log(spark, mirror.TOPICS, "parquet", path=path)
    last = results.open_documents(results.latest(results.readable(log, RESULT_TOPICS)))
    opened = last.select("topic", "document", F.explode("document.kingdom").alias("entry")).select(
        "topic",
        F.col("document.source_name").alias("source"),
        "document.source_count",
        "document.species",
        "entry.kingdom",
        "entry.count",
    )
    within = _within_bound(_events(spark, sf_dir), opened, "species", SKETCH_ERROR)
    return within.withColumnRenamed("source", "source_name")


@registered
def stream_produce(spark, sf_dir):
    """Landed pages become messages of their source; the messages are then counted."""
    landed, sent = run_folder(spark, "pages"), run_folder(spark, "messages")
    mirror.document_pages(_documents(spark, sf_dir), "obis").write.parquet(landed)
    pages = file_stream(spark, landed, "doc_id bigint, page string")
    query = jobs.start_producer(
        pages,
        "obis",
        run_folder(spark, "checkpoint"),
        fmt="parquet",
        options={"path": sent},
        name=_unique("producer"),
        every=None,
    )
    sinks.run_for(query)
    return aggregates.kingdom_exact(records.core_records(decode_value(spark.read.parquet(sent))))


@registered
def add_source(spark, sf_dir):
    """Every source is added by its URL: its pages are published, counted and its counts published.

    Then the sources' documents are merged.
    """
    events, path = _events(spark, sf_dir), run_folder(spark, "results")
    sources = registry.known_sources(spark)
    for name in mirror.TOPICS:
        landed, sent = run_folder(spark, "pages"), run_folder(spark, "messages")
        mirror.event_pages(events, name).write.parquet(landed)
        started = jobs.add_source(
            spark,
            f"https://{name}.org/occurrences",
            sources,
            run_folder(spark, "checkpoint"),
            pages=file_stream(spark, landed, "number bigint, page string"),
            producer={"fmt": "parquet", "options": {"path": sent}, "page_key": ["number"]},
            source={"fmt": "parquet", "path": sent, "schema": "topic string, value string"},
            sink={"fmt": "parquet", "path": path},
            every=None,
        )
        sinks.run_for(started.query)
        sources = started.registry
    log = read_result_log(spark, mirror.TOPICS, "parquet", path=path)
    return results.count_by(results.readable(log, RESULT_TOPICS), "source", sources)


@registered
def replayed_messages(spark, sf_dir):
    """All pages are published, and every third one a second time; each record is then counted once."""
    documents, sent = _documents(spark, sf_dir), run_folder(spark, "messages")
    pages = mirror.document_pages(documents, "gbif")
    for part in (pages, pages.where(F.col("doc_id") % 3 == 0)):
        sinks.publish(jobs.page_messages(part, "gbif", page_key=["doc_id"]), "parquet", {"path": sent})
    counted = run_folder(spark, "kingdom-exact")
    partitions = str(spark.sparkContext.defaultParallelism)
    stream = file_stream(spark, sent, "key string, value string, topic string")
    query = jobs.start_kingdom_exact(
        unique_messages(stream),
        counted,
        run_folder(spark, "checkpoint"),
        name=_unique("replayed"),
        every=None,
        settings={**sinks.LARGE_STATE, "spark.sql.shuffle.partitions": partitions},
    )
    sinks.run_for(query)
    return sinks.latest_snapshot(spark, counted)
