import json
import time

import pytest
from pyspark.sql import functions as F

from fieldtally.operators import registry, results
from fieldtally.operators.records import parse_json
from fieldtally.plans import jobs
from fieldtally.sources.messages import file_stream, read_result_log, unique_messages
from fieldtally.streaming import sinks

MESSAGES = "key string, value string, topic string"
LANDED = "topic string, value binary"


def until(condition, seconds=30):
    deadline = time.time() + seconds
    while not condition() and time.time() < deadline:
        time.sleep(0.1)
    return condition()


def ticking(spark, name, tmp_path, every="0 seconds", fail=False):
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    if fail:
        ticks = ticks.select(F.raise_error(F.lit("out of order")).cast("string").alias("x"))
    return sinks.start_query(ticks, name, str(tmp_path / name), fmt="noop", mode="append", every=every)


def test_one_failure_stops_and_reports_all(spark, tmp_path):
    well = ticking(spark, "well", tmp_path)
    ill = ticking(spark, "ill", tmp_path, fail=True)
    with pytest.raises(sinks.RunFailed, match="ill: .*out of order") as raised:
        sinks.run_together(spark, [well, ill], 60)
    assert set(raised.value.failures) == {"ill"}
    assert not well.isActive and not ill.isActive


def test_runs_that_end_and_runs_that_are_stopped(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(5).selectExpr("'t' as topic", "cast(cast(id as string) as binary) as value").write.parquet(path)
    ends = sinks.start_query(
        file_stream(spark, path, LANDED), "ends", str(tmp_path / "e"), fmt="noop", mode="append"
    )
    goes_on = ticking(spark, "goes_on", tmp_path)
    assert sinks.run_together(spark, [ends, goes_on], 8) == {"ends": True, "goes_on": False}
    assert not goes_on.isActive
    # The failure of a query that is not among them does not end them.
    ill = ticking(spark, "stranger", tmp_path, fail=True)
    other = ticking(spark, "other", tmp_path)
    assert until(lambda: not ill.isActive)
    assert sinks.run_together(spark, [other], 2) == {"other": False}


@pytest.fixture
def running(spark):
    runs = registry.RunningSources(spark)
    yield runs
    runs.close()


def state(running, known, name):
    return next((r["job_count"], r["producer_online"]) for r in running.registry(known).collect() if r["name"] == name)


def test_the_registry_follows_the_queries(spark, running, tmp_path):
    known = registry.known_sources(spark)
    job, again = ticking(spark, "job", tmp_path), ticking(spark, "again", tmp_path)
    producer = ticking(spark, "producer", tmp_path)
    running.watch("obis", job)
    running.watch("obis", again)
    running.watch("obis", producer, producer=True)
    assert state(running, known, "obis") == (2, True) and state(running, known, "gbif") == (0, False)
    again.stop()
    assert until(lambda: state(running, known, "obis") == (1, True))
    producer.stop()
    assert until(lambda: state(running, known, "obis") == (1, False))
    job.stop()
    assert until(lambda: state(running, known, "obis") == (0, False))
    assert registry.list_sources(running.registry(known)).collect() == []
    assert running.failures == []


def test_the_registry_sees_failures(spark, running, tmp_path):
    known = registry.known_sources(spark)
    ill = ticking(spark, "failing", tmp_path, fail=True)
    running.watch("gbif", ill, producer=True)
    assert until(lambda: running.failures != [])
    assert running.failures[0][0] == "gbif" and "out of order" in running.failures[0][1]
    assert state(running, known, "gbif") == (0, False)
    # A query whose end was reported before it is watched does not count.
    running.watch("gbif", ill)
    assert state(running, known, "gbif") == (0, False)


def pages(spark, path, *texts):
    spark.createDataFrame([(text,) for text in texts], "page string").write.mode("append").parquet(path)


def test_add_source_starts_its_producer(spark, running, tmp_path):
    landed, sent, path = (str(tmp_path / name) for name in ("pages", "sent", "results"))
    record = json.dumps({"results": [{"kingdom": "A", "scientificName": "s"}] * 3})
    pages(spark, landed, record)
    started = jobs.add_source(
        spark,
        "https://obis.org",
        registry.known_sources(spark),
        str(tmp_path / "c"),
        pages=file_stream(spark, landed, "page string"),
        producer={"fmt": "parquet", "options": {"path": sent}},
        source={"fmt": "parquet", "path": sent, "schema": "topic string, value string"},
        sink={"fmt": "parquet", "path": path},
        every=None,
        running=running,
    )
    assert (started.producer.name, started.query.name) == ("obis_producer", "obis_query")
    sinks.run_for(started.query)
    log = results.readable(read_result_log(spark, ["obis"], "parquet", path=path), ["obis_query"])
    active = registry.mark_started(registry.known_sources(spark), "obis")
    assert [tuple(r) for r in results.count_by(log, "source", active).collect()] == [("http://OBIS.org", 3)]
    assert until(lambda: state(running, registry.known_sources(spark), "obis") == (0, False))


def test_without_a_producer_none_is_online(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([], LANDED).write.parquet(path)
    known = registry.known_sources(spark)
    files = {"fmt": "parquet", "path": path, "schema": LANDED}
    started = jobs.add_source(
        spark, "https://gbif.org", known, str(tmp_path / "c"), source=files,
        sink={"fmt": "parquet", "path": str(tmp_path / "r")}, every=None,
    )
    sinks.run_for(started.query)
    row = started.registry.where("name = 'gbif'").first()
    assert (row["job_count"], row["producer_online"], started.producer) == (1, False, None)


def test_the_producer_is_stopped_if_the_counts_do_not_start(spark, tmp_path):
    landed = str(tmp_path / "pages")
    pages(spark, landed, '{"results":[]}')
    with pytest.raises(ValueError, match="needs a path"):
        jobs.add_source(
            spark, "https://gbif.org", registry.known_sources(spark), str(tmp_path / "c"),
            pages=file_stream(spark, landed, "page string"),
            producer={"fmt": "noop"}, source={"fmt": "parquet"}, every="1 second",
        )
    assert "gbif_producer" not in {query.name for query in spark.streams.active}


def test_a_page_sent_again_adds_no_record(spark, tmp_path):
    landed, sent = str(tmp_path / "pages"), str(tmp_path / "sent")
    pages(spark, landed, '{"results":[{"id":"a"},{"id":"a"},null]}', '{"results":[{"id":"b"}]}', '{"results":[]}')
    for attempt in ("first", "again"):  # the second has lost its checkpoint and sends all pages anew
        stream = file_stream(spark, landed, "page string")
        target = {"path": f"{sent}/{attempt}"}
        query = jobs.start_producer(
            stream, "gbif", str(tmp_path / attempt), fmt="parquet", options=target, every=None
        )
        sinks.run_for(query)
    messages = spark.read.schema(MESSAGES).parquet(f"{sent}/first", f"{sent}/again")
    assert messages.count() == 8
    once = unique_messages(messages)
    assert sorted(row["value"] for row in once.collect()) == ["null", '{"id":"a"}', '{"id":"a"}', '{"id":"b"}']
    counted = str(tmp_path / "counted")
    again = str(tmp_path / "all")
    messages.repartition(3).write.parquet(again)
    streamed = unique_messages(file_stream(spark, again, MESSAGES, options={"maxFilesPerTrigger": "1"}))
    query = jobs.start_kingdom_counts(streamed, counted, str(tmp_path / "c"), topics=["gbif"], every=None)
    sinks.run_for(query)
    assert sinks.latest_snapshot(spark, counted).agg(F.sum("count")).first()[0] == 4


def test_keys_of_columns(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (2, None)], "id int, name string")
    keys = [row["key"] for row in sinks.encode_messages(rows, "gbif", key=("id", "name")).collect()]
    assert len(set(keys)) == 4 and all(len(key) == 36 and key.count("-") == 4 for key in keys)
    assert keys == [row["key"] for row in sinks.encode_messages(rows, "gbif", key=("id", "name")).collect()]
    other = [row["key"] for row in sinks.encode_messages(rows, "obis", key=("id", "name")).collect()]
    assert not set(keys) & set(other)
    assert parse_json(sinks.encode_messages(rows, "gbif"), rows.schema).count() == 4


def test_pages_of_equal_text_are_told_apart_by_their_columns(spark):
    twice = spark.createDataFrame([(1, '{"results":[{}]}'), (2, '{"results":[{}]}')], "n int, page string")
    assert jobs.page_messages(twice, "gbif").select("key").distinct().count() == 1
    assert jobs.page_messages(twice, "gbif", page_key=["n"]).select("key").distinct().count() == 2


def test_messages_without_key_all_stay(spark):
    messages = spark.createDataFrame([(None, "a", "t"), (None, "a", "t"), ("k", "a", "t"), ("k", "a", "u")], MESSAGES)
    assert unique_messages(messages.union(messages)).count() == 6
