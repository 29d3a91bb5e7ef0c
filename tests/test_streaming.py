import os
import time
from uuid import UUID

import pytest
from pyspark.sql import functions as F

from fieldtally.operators import aggregates, registry, results
from fieldtally.operators.records import core_records, parse_json
from fieldtally.plans import jobs
from fieldtally.sources.messages import (
    decode_value,
    file_stream,
    message_stream,
    read_result_log,
)
from fieldtally.streaming import sinks
from workload import mirror

SF_DIR = "/root/testdata/sf0.001"
LANDED = "topic string, value binary"
RESULT_TOPICS = ["gbif_query", "idigbio_query", "obis_query"]


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def rows_sorted(expected):
    return sorted(expected, key=str)


@pytest.fixture(scope="module")
def sent(spark):
    """All messages, the malformed ones among them."""
    events = mirror.table(spark, SF_DIR, "events")
    return mirror.messages(events).union(mirror.damaged_messages(events)).cache()


@pytest.fixture
def landed(spark, sent, tmp_path):
    """The messages as six files of different age, one per micro-batch."""
    path = tmp_path / "landed"
    parts = sent.withColumn("part", F.pmod(F.hash("event_id"), F.lit(6)))
    for number in range(6):
        part = parts.where(F.col("part") == number).select("topic", "value").coalesce(1)
        part.write.mode("append").parquet(str(path))
        for file in path.glob("*.parquet"):
            if file.stat().st_mtime > 2_000_000:
                os.utime(file, (1_000_000 + number, 1_000_000 + number))
    return str(path)


@pytest.fixture
def stream(spark, landed):
    return file_by_file(spark, landed)


def file_by_file(spark, path):
    return message_stream(
        spark, mirror.TOPICS, "parquet", path=path, schema=LANDED, options={"maxFilesPerTrigger": "1"}
    )


def batch_core(sent):
    return core_records(decode_value(sent))


def last_epoch(spark, path):
    epochs = sinks.read_snapshots(spark, path).agg(F.max("epoch_id")).first()[0]
    return epochs, sinks.latest_snapshot(spark, path)


def test_stream_equals_batch_over_several_batches(spark, sent, stream, tmp_path):
    path = str(tmp_path / "counts")
    query = jobs.start_kingdom_counts(stream, path, str(tmp_path / "c"), every=None)
    assert sinks.run_for(query)
    assert len(query.recentProgress) == 6
    last, counts = last_epoch(spark, path)
    assert last == 5
    assert rows(counts) == rows(aggregates.kingdom_counts(batch_core(sent)))


def test_a_table_in_memory(spark, sent, stream, tmp_path):
    counts = aggregates.source_totals(core_records(decode_value(stream)))
    sinks.run_for(sinks.start_query(counts, "totals", str(tmp_path / "c"), fmt="memory"))
    assert rows(spark.table("totals")) == rows(aggregates.source_totals(batch_core(sent)))


def kingdoms_of(sent):
    return batch_core(sent).select("topic", "kingdom").distinct().count()


def test_exact_stream_equals_batch_and_hands_over_kingdoms_only(spark, sent, stream, tmp_path):
    path = str(tmp_path / "exact")
    query = jobs.start_kingdom_exact(stream, path, str(tmp_path / "c"), every=None)
    sinks.run_for(query)
    snapshots = sinks.read_snapshots(spark, path)
    last, counts = last_epoch(spark, path)
    assert last == 5
    assert rows(counts) == rows(aggregates.kingdom_exact(batch_core(sent)))
    # Names stay in the state: it has all of them, and each trigger emits a row per kingdom.
    names = batch_core(sent).dropna(subset=["scientificName"]).distinct().count()
    operators = {op["operatorName"]: op for op in query.lastProgress["stateOperators"]}
    assert operators["dedupe"]["numRowsTotal"] == names
    assert operators["stateStoreSave"]["numRowsTotal"] == kingdoms_of(sent) < names / 4
    emitted = snapshots.groupBy("epoch_id").count().collect()
    assert len(emitted) == 6 and all(row["count"] <= kingdoms_of(sent) for row in emitted)


def test_exact_stream_goes_on_from_its_checkpoint(spark, sent, landed, tmp_path):
    path, checkpoint = str(tmp_path / "exact"), str(tmp_path / "c")
    first = jobs.start_kingdom_exact(file_by_file(spark, landed), path, checkpoint, every="0 seconds")
    deadline = time.time() + 60
    while not first.recentProgress and time.time() < deadline:
        time.sleep(0.05)
    assert not sinks.run_for(first, 0.1)
    sinks.run_for(jobs.start_kingdom_exact(file_by_file(spark, landed), path, checkpoint, every=None))
    last, counts = last_epoch(spark, path)
    assert last == 5
    assert rows(counts) == rows(aggregates.kingdom_exact(batch_core(sent)))


def test_snapshots_add_up(spark, sent, stream, tmp_path):
    path = str(tmp_path / "series")
    sinks.run_for(jobs.snapshot_series(stream, path, str(tmp_path / "c"), every=None))
    snapshots = sinks.read_snapshots(spark, path)
    sums = snapshots.groupBy("epoch_id").agg(F.sum("total_records").alias("records"))
    totals = [row["records"] for row in sums.orderBy("epoch_id").collect()]
    assert len(totals) == 6 and totals == sorted(set(totals)) and totals[-1] == sent.count()
    assert rows(last_epoch(spark, path)[1]) == rows(jobs.category_report(sent))


def test_a_query_goes_on_from_its_checkpoint(spark, sent, landed, tmp_path):
    path, checkpoint = str(tmp_path / "series"), str(tmp_path / "c")
    first = jobs.snapshot_series(file_by_file(spark, landed), path, checkpoint, every="0 seconds")
    deadline = time.time() + 60
    while not first.recentProgress and time.time() < deadline:
        time.sleep(0.05)
    assert not sinks.run_for(first, 0.1)
    begun = sinks.read_snapshots(spark, path).agg(F.max("epoch_id")).first()[0]
    sinks.run_for(jobs.snapshot_series(file_by_file(spark, landed), path, checkpoint, every=None))
    last, report = last_epoch(spark, path)
    assert begun <= last == 5
    assert rows(report) == rows(jobs.category_report(sent))


def test_live_documents_equal_the_batch_counts(spark, sent, stream, tmp_path):
    path = str(tmp_path / "results")
    query = jobs.start_live_counts(
        stream, str(tmp_path / "c"), fmt="parquet", path=path, every=None
    )
    sinks.run_for(query)
    log = read_result_log(spark, mirror.TOPICS, "parquet", path=path)
    assert rows(log.groupBy("topic").count()) == [(topic, 6) for topic in RESULT_TOPICS]
    last = results.open_documents(results.latest(results.readable(log, RESULT_TOPICS)))
    totals = last.select("document.source_name", "document.source_count", "document.species").collect()
    exact = batch_core(sent).groupBy(F.upper("topic")).agg(F.count("*"), F.count_distinct("scientificName"))
    expected = {name: numbers for name, *numbers in exact.collect()}
    assert {row["source_name"] for row in totals} == set(expected)
    for name, records, species in totals:
        assert records == expected[name][0]
        assert abs(species - expected[name][1]) <= 3 * 0.017 * expected[name][1]
    kingdoms = last.select(
        F.regexp_replace("topic", "_query$", "").alias("topic"), F.inline("document.kingdom")
    )
    assert rows(kingdoms) == rows(aggregates.kingdom_counts(batch_core(sent)))


def test_a_repeated_batch_replaces_its_own_rows(spark, sent, tmp_path):
    snapshot = aggregates.kingdom_sketches(batch_core(sent))
    path = str(tmp_path / "results")
    write = sinks.result_writer("parquet", path)
    for epoch in (0, 1, 1, 0):
        write(snapshot, epoch)
    log = read_result_log(spark, mirror.TOPICS, "parquet", path=path)
    assert rows(log.select("topic", "offset")) == [(t, n) for t in RESULT_TOPICS for n in (0, 1)]

    path = str(tmp_path / "snapshots")
    keep = sinks.snapshot_writer(path)
    for epoch in (0, 1, 1):
        keep(aggregates.source_totals(batch_core(sent)), epoch)
    assert sinks.read_snapshots(spark, path).count() == 6


def test_add_source(spark, sent, landed, tmp_path):
    known = registry.known_sources(spark)
    path = str(tmp_path / "results")
    files = {"fmt": "parquet", "path": landed, "schema": LANDED}
    started = jobs.add_source(
        spark,
        "https://obis.org/x",
        known,
        str(tmp_path / "c"),
        source=files,
        sink={"fmt": "parquet", "path": path},
        every=None,
    )
    assert started.query.name == "obis_query"
    sinks.run_for(started.query)
    log = results.readable(read_result_log(spark, ["obis"], "parquet", path=path), ["obis_query"])
    counted = results.count_by(log, "source", started.registry)
    expected = sent.where("topic = 'obis'").count()
    assert rows(counted) == [("http://OBIS.org", expected)]
    with pytest.raises(ValueError, match="no registered source"):
        jobs.add_source(spark, "https://ebird.org", known, str(tmp_path / "d"))


def test_a_bounded_run_is_stopped(spark, stream, tmp_path):
    query = jobs.start_category_report(stream, str(tmp_path / "c"), fmt="memory", name="bounded")
    assert not sinks.run_for(query, 1)
    assert not query.isActive


def test_report_on_the_console(stream, tmp_path):
    query = jobs.start_category_report(stream, str(tmp_path / "c"), every=None)
    assert sinks.run_for(query)
    assert "Console" in query.lastProgress["sink"]["description"]
    assert query.lastProgress["sink"]["numOutputRows"] == 3


def test_two_named_queries_at_once(spark, sent, landed, tmp_path):
    path = str(tmp_path / "counts")
    first = jobs.start_kingdom_counts(
        file_by_file(spark, landed), path, str(tmp_path / "a"), name="two_counts", every=None
    )
    second = jobs.start_category_report(
        file_by_file(spark, landed), str(tmp_path / "b"), fmt="memory", name="two_report", every=None
    )
    assert sinks.run_for(first) and sinks.run_for(second)
    counts = sinks.latest_snapshot(spark, path)
    assert counts.agg(F.sum("count")).first()[0] == sent.count()
    assert spark.table("two_report").agg(F.sum("total_records")).first()[0] == sent.count()


def test_messages_keep_missing_members_and_have_their_own_keys(spark):
    records = spark.range(500).select(
        F.col("id"), F.lit(None).cast("string").alias("kingdom"), F.lit('é"\n').alias("http://x.y/z")
    )
    encoded = sinks.encode_messages(records, "gbif")
    assert encoded.columns == ["key", "value", "topic"]
    found = encoded.collect()
    assert len({UUID(row["key"]) for row in found}) == 500
    assert '"kingdom":null' in found[0]["value"]
    back = parse_json(encoded, records.schema)
    assert rows(back) == rows(records)


def test_records_are_published_as_a_stream(spark, sent, stream, tmp_path):
    path = str(tmp_path / "published")
    core = core_records(decode_value(stream))
    query = sinks.start_query(
        sinks.encode_messages(core, "all"),
        "publish",
        str(tmp_path / "c"),
        fmt="parquet",
        mode="append",
        options={"path": path},
    )
    sinks.run_for(query)
    published = spark.read.parquet(path)
    assert published.count() == published.select("key").distinct().count() == sent.count()
    back = parse_json(published, "topic string, kingdom string, scientificName string")
    assert rows(back) == rows(batch_core(sent))


def test_pages_are_published_as_they_land(spark, tmp_path):
    pages = str(tmp_path / "pages")
    text = ['{"results":[{"kingdom":"A"},null]}', '{"results":[]}']
    spark.createDataFrame([(page,) for page in text], "page string").write.parquet(pages)
    sent = str(tmp_path / "sent")
    query = jobs.start_producer(
        file_stream(spark, pages, "page string"),
        "gbif",
        str(tmp_path / "c"),
        fmt="parquet",
        options={"path": sent},
        every=None,
    )
    sinks.run_for(query)
    published = spark.read.parquet(sent)
    assert rows(published.select("topic", "value")) == rows_sorted(
        [("gbif", "null"), ("gbif", '{"kingdom":"A"}')]
    )
    assert published.select("key").distinct().count() == 2
    assert rows(core_records(published)) == rows_sorted([("gbif", "A", None), ("gbif", None, None)])


def test_publish_a_batch(spark, tmp_path):
    path = str(tmp_path / "out")
    messages = sinks.encode_messages(spark.range(3), "gbif")
    for _ in range(2):
        sinks.publish(messages, "parquet", {"path": path})
    assert spark.read.parquet(path).count() == 6


def test_settings_of_a_query_are_put_back(spark, stream, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = jobs.start_kingdom_counts(stream, str(tmp_path / "s"), str(tmp_path / "c"), every=None)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before == "8"
    sinks.run_for(query)
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 4


def test_a_query_has_one_sink(spark, stream, tmp_path):
    with pytest.raises(ValueError):
        sinks.start_query(stream, "none", str(tmp_path / "c"))
    with pytest.raises(ValueError):
        sinks.start_query(
            stream, "both", str(tmp_path / "c"), fmt="console", foreach_batch=lambda df, n: None
        )
