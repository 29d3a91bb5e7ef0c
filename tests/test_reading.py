import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from fieldtally.operators import aggregates, registry, results
from fieldtally.plans.reading import FollowedResults
from fieldtally.sources.messages import read_result_log
from fieldtally.streaming import sinks
from fieldtally.streaming.manifest import SnapshotTable

LOG = "topic string, offset bigint, value string"


def document(n, kingdoms=None):
    kingdoms = kingdoms or {"A": n}
    return json.dumps(
        {
            "kingdom": [{"kingdom": k, "count": c} for k, c in kingdoms.items()],
            "species": n,
            "source_count": sum(kingdoms.values()),
            "source_name": "GBIF",
        }
    )


def land(spark, path, *rows):
    df = spark.createDataFrame([(f"{name}_query", offset, value) for name, offset, value in rows], LOG)
    df.write.mode("append").partitionBy("topic", "offset").parquet(path)


def known(spark, *names):
    out = registry.known_sources(spark)
    for name in names:
        out = registry.mark_started(out, name)
    return out


def follow(spark, tmp_path, names=("gbif", "obis")):
    """Read on, and return the messages and how many were scanned."""
    followed = FollowedResults(spark, names, str(tmp_path / "state"))
    seen = Observation()
    log = followed.advance(
        "parquet", path=str(tmp_path / "log"), scanned=lambda df: df.observe(seen, F.count(F.lit(1)).alias("rows"))
    )
    found = {row["topic"]: row["offset"] for row in log.collect()}
    return log, found, seen


def test_a_second_reading_scans_what_is_new(spark, tmp_path):
    path = str(tmp_path / "log")
    land(spark, path, *[("gbif", n, document(n + 1)) for n in range(5)], ("obis", 0, document(7)))
    log, found, seen = follow(spark, tmp_path)
    assert found == {"gbif_query": 4, "obis_query": 0}
    assert seen.get["rows"] == 6
    land(spark, path, ("gbif", 5, document(50)), ("gbif", 6, document(60)))
    log, found, seen = follow(spark, tmp_path)
    assert found == {"gbif_query": 6, "obis_query": 0}
    assert seen.get["rows"] == 2
    active = known(spark, "gbif", "obis")
    whole = read_result_log(spark, ["gbif", "obis"], "parquet", path=path)
    for by in results.COUNT_KINDS:
        full = results.count_by(results.readable(whole, ["gbif_query", "obis_query"]), by, active)
        assert sorted(results.count_by(log, by, active).collect()) == sorted(full.collect())


def test_new_messages_alone_are_opened(spark, tmp_path):
    path = str(tmp_path / "log")
    land(spark, path, *[("gbif", n, document(n + 1)) for n in range(5)])
    log = read_result_log(spark, ["gbif", "obis"], "parquet", path=path, after={"gbif_query": 3})
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and len(log.inputFiles()) >= 1
    assert [row["offset"] for row in log.collect()] == [4]


def test_a_topic_stays_where_it_stopped(spark, tmp_path):
    path = str(tmp_path / "log")
    land(spark, path, ("gbif", 0, document(1)), ("gbif", 1, "{}"), ("gbif", 2, document(3)), ("obis", 0, "x"))
    assert follow(spark, tmp_path)[1] == {"gbif_query": 0}
    land(spark, path, ("gbif", 3, document(4)), ("obis", 1, document(9)))
    log, found, seen = follow(spark, tmp_path)
    assert found == {"gbif_query": 0}
    state = SnapshotTable(spark, str(tmp_path / "state")).latest().collect()
    assert {row["topic"]: (row["high"], row["stopped"]) for row in state} == {
        "gbif_query": (2, True), "obis_query": (0, True)
    }


def test_sources_that_come_later(spark, tmp_path):
    path = str(tmp_path / "log")
    land(spark, path, ("gbif", 0, document(1)))
    assert follow(spark, tmp_path)[1] == {"gbif_query": 0}
    land(spark, path, ("obis", 0, document(2)), ("obis", 1, "bad"))
    assert follow(spark, tmp_path)[1] == {"gbif_query": 0, "obis_query": 0}
    assert follow(spark, tmp_path)[1] == {"gbif_query": 0, "obis_query": 0}
    with pytest.raises(ValueError, match="at least one source"):
        FollowedResults(spark, [], path)


# Documents in parts

def spellings(spark, n):
    core = spark.range(n).select(
        F.lit("gbif").alias("topic"),
        F.when(F.col("id") > 0, F.concat(F.lit("Kingdom with a name "), F.col("id") % (n // 2))).alias("kingdom"),
        F.concat(F.lit("s"), F.col("id") % 40).alias("scientificName"),
    )
    few = spark.createDataFrame([("obis", "A", "x"), ("obis", None, None)], core.schema)
    return core.union(few)


def published(spark, core, path, part_bytes, epochs=(0,)):
    write = sinks.result_writer("parquet", path, part_bytes=part_bytes)
    for epoch in epochs:
        write(aggregates.kingdom_sketches(core), epoch)
    return read_result_log(spark, ["gbif", "obis"], "parquet", path=path)


def answers(log, spark, parts):
    active = known(spark, "gbif", "obis")
    return [sorted(results.count_by(log, by, active, parts=parts).collect()) for by in results.COUNT_KINDS]


def test_many_spellings_are_published_in_parts(spark, tmp_path):
    core = spellings(spark, 400_000)
    whole = published(spark, core, str(tmp_path / "whole"), None)
    split = published(spark, core, str(tmp_path / "split"), 500_000)
    sizes = {row["topic"]: (row["n"], row["most"]) for row in split.groupBy("topic").agg(
        F.count("*").alias("n"), F.max(F.octet_length("value")).alias("most")).collect()}
    assert sizes["gbif_query"][0] >= 16 and sizes["gbif_query"][1] < 1.1 * 500_000
    assert sizes["obis_query"][0] == 1
    assert results.readable(split, ["gbif_query", "obis_query"]).count() == split.count()
    assert answers(split, spark, True) == answers(whole, spark, False) == answers(whole, spark, True)


def test_few_spellings_and_tiny_parts(spark, tmp_path):
    core = spellings(spark, 12)
    for size in (1, 60, 10**6):
        split = published(spark, core, str(tmp_path / str(size)), size, epochs=(0, 1))
        assert answers(split, spark, True) == answers(published(spark, core, str(tmp_path / f"w{size}"), None), spark, False)


def test_a_snapshot_without_all_its_parts_is_passed_over(spark, tmp_path):
    old, new = spellings(spark, 100), spellings(spark, 300)
    first = published(spark, old, str(tmp_path / "a"), 300).withColumn("n", F.monotonically_increasing_id())
    write = sinks.result_writer("parquet", str(tmp_path / "b"), part_bytes=300)
    write(aggregates.kingdom_sketches(new), 5)
    second = read_result_log(spark, ["gbif", "obis"], "parquet", path=str(tmp_path / "b"))
    # As in a broker every message has an offset of its own, and some have come twice.
    messages = [(r["topic"], r["value"]) for r in first.collect()]
    later = [(r["topic"], r["value"]) for r in second.collect()]

    def log(*parts):
        rows = [row for part in parts for row in part]
        return spark.createDataFrame([(t, n, v) for n, (t, v) in enumerate(rows)], LOG)

    missing = [row for n, row in enumerate(later) if n != 0 or row[0] != "gbif_query"]
    assert len(missing) == len(later) - 1
    before = answers(log(messages), spark, True)
    assert answers(log(messages, messages[:5]), spark, True) == before
    passed = answers(log(messages, missing), spark, True)
    assert passed[0] == before[0] and passed[2] == before[2]
    assert answers(log(messages, missing, later), spark, True) == answers(log(later), spark, True) != before


def test_no_task_holds_a_whole_list(spark):
    counts = aggregates.kingdom_sketches(spellings(spark, 1000))
    documents = results.build_documents(counts, part_bytes=1000)
    plan = documents._jdf.queryExecution().executedPlan().toString()
    lists = [line for line in plan.splitlines() if "collect_list" in line]
    assert lists and all("part#" in line for line in lists)
