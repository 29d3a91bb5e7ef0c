"""What must hold for the plans at any size of the data."""

import re

import pytest

from fieldtally.operators import aggregates, results
from fieldtally.operators.records import core_records
from fieldtally.sources.messages import decode_value
from workload import mirror
from workload.queries import REGISTERED

SF_DIR = "/root/testdata/sf0.001"
STREAMS = {"add_source", "concurrent_queries", "live_counts", "replayed_messages"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def core(spark):
    return core_records(decode_value(mirror.messages(mirror.table(spark, SF_DIR, "events"))))


@pytest.mark.parametrize(
    "name", [n for n in sorted(REGISTERED) if n not in STREAMS and "stream_" not in n]
)
def test_no_python_and_no_pairs(spark, name):
    text = plan(REGISTERED[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoopJoin", "Range("):
        assert operator not in text
    # One row of all sources is the answer to one query only.
    assert ("SinglePartition" in text) == (name == "count_by_species")


def test_json_is_parsed_once_per_message(core):
    for df in (core, aggregates.kingdom_exact(core), aggregates.kingdom_sketches(core)):
        parses = [line for line in plan(df).splitlines() if "from_json(" in line]
        assert len(parses) == 1


def test_only_needed_columns_are_read(core):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(aggregates.kingdom_counts(core)))[1]
    fields = {field.split(":")[0] for field in schema.split(",")}
    assert fields == {"event_id", "user_id", "event_type"}


def test_names_are_spread_before_they_are_counted(core):
    text = plan(aggregates.kingdom_exact(core))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert [re.findall(r"([A-Za-z]+)#", keys) for keys in exchanges] == [
        ["topic", "kingdom"],
        ["topic", "kingdom", "scientificName"],
    ]


def test_aggregates_are_combined_before_the_shuffle(core):
    for df in (
        aggregates.kingdom_counts(core),
        aggregates.category_counts(core),
        aggregates.source_totals(core),
        aggregates.kingdom_sketches(core),
    ):
        text = plan(df)
        assert text.count("Exchange") == 1
        assert "partial_count" in text[text.index("Exchange") :]
        assert "Expand" not in text


def test_the_log_itself_is_not_shuffled(spark):
    log = spark.createDataFrame(
        [("gbif_query", 0, "{}")], "topic string, offset bigint, value string"
    )
    text = plan(results.readable(log, ["gbif_query"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    many = [f"t{n}_query" for n in range(10_001)]
    assert "BroadcastHashJoin" in plan(results.readable(log, many))


BROKER_LOG = "topic string, partition int, offset bigint, timestamp timestamp, value string"


@pytest.mark.parametrize("order", [("offset",), ("timestamp", "partition", "offset")])
def test_the_latest_message_is_found_without_its_text(spark, tmp_path, order):
    path = str(tmp_path / "log")
    spark.createDataFrame([], BROKER_LOG).write.parquet(path)
    text = plan(results.latest(spark.read.parquet(path), order))
    assert "Sort" not in text and "ObjectHash" not in text
    assert text.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in text
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert len(schemas) == 2 and sum("value:" in schema for schema in schemas) == 1
