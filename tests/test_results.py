import json

import pytest
from pyspark.sql import functions as F

from fieldtally.operators import registry, results

LOG = "topic string, offset bigint, value string"
TOPICS = ["gbif_query", "idigbio_query", "obis_query"]


def document(source, kingdoms, species, count):
    return json.dumps(
        {
            "kingdom": [{"kingdom": name, "count": n} for name, n in kingdoms.items()],
            "species": species,
            "source_count": count,
            "source_name": source,
        }
    )


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [
            ("gbif_query", 0, document("GBIF", {"Animalia": 1}, 1, 1)),
            ("gbif_query", 2, document("GBIF", {"Animalia": 5, None: 2}, 4, 7)),
            ("gbif_query", 1, document("GBIF", {"Animalia": 3}, 2, 3)),
            ("obis_query", 9, document("OBIS", {"animalia": 4, "Animalia": 1, None: 3}, 3, 8)),
        ],
        LOG,
    )


def known(spark, *active):
    df = registry.known_sources(spark)
    for name in active:
        df = registry.mark_started(df, name)
    return df


def answers(df):
    return {row[0]: row[1] for row in df.collect()}


def test_count_by_kingdom_adds_missing_names(spark, log):
    merged = results.count_by(log, "kingdom", known(spark, "gbif", "obis"))
    assert answers(merged) == {"Animalia": 6, "animalia": 4, "Title Unavailable": 5}


def test_count_by_species_is_a_sum(spark, log):
    merged = results.count_by(log, "species", known(spark, "gbif", "obis"))
    assert [row.asDict() for row in merged.collect()] == [{"species": 7}]


def test_count_by_source(spark, log):
    merged = results.count_by(log, "source", known(spark, "gbif", "obis"))
    assert answers(merged) == {"http://GBIF.org": 7, "http://OBIS.org": 8}


def test_sources_without_document_or_not_active_are_left_out(spark, log):
    merged = results.count_by(log, "source", known(spark, "obis", "idigbio"))
    assert answers(merged) == {"http://OBIS.org": 8}


def test_no_active_source(spark, log):
    assert results.count_by(log, "kingdom", known(spark)).collect() == []
    assert results.count_by(log, "source", known(spark)).collect() == []
    assert results.count_by(log, "species", known(spark)).first()["species"] == 0


def test_count_by_something_else(spark, log):
    with pytest.raises(ValueError, match="'phylum'"):
        results.count_by(log, "phylum", known(spark))


def test_latest_message(log):
    last = results.latest(log)
    assert answers(last.select("topic", "offset")) == {"gbif_query": 2, "obis_query": 9}


def test_latest_message_over_several_partitions(spark):
    order = ["timestamp", "partition", "offset"]
    log = spark.createDataFrame(
        [("t", 1, 0, 7, "a"), ("t", 2, 0, 1, "b"), ("t", 2, 1, 0, "c"), ("u", 5, 0, 0, "d")],
        "topic string, timestamp int, partition int, offset bigint, value string",
    )
    assert answers(results.latest(log, order).select("topic", "value")) == {"t": "c", "u": "d"}


def test_latest_message_of_a_broker(spark):
    order = ("timestamp", "partition", "offset")
    rows = [("t", "2024-01-01 00:00:00.000001", 9, 2**40, "a"), ("t", "2024-01-01 00:00:00.000002", 99_999, 5, "c"),
            ("t", "2024-01-01 00:00:00.000002", 99_998, 999_999_999_999_999, "b"), ("u", "9999-12-31 23:59:59", 1, 0, "d"),
            ("v", "1969-12-31 23:59:59", 1, 1, "f"), ("v", "1969-12-31 23:59:59", 1, 0, "e")]
    log = spark.createDataFrame(rows, "topic string, time string, partition int, offset bigint, value string")
    log = log.withColumn("timestamp", F.col("time").cast("timestamp"))
    assert answers(results.latest(log, order).select("topic", "value")) == {"t": "c", "u": "d", "v": "f"}


GOOD = '{"kingdom":[],"species":1,"source_count":1,"source_name":"GBIF"}'
BAD = [
    "not json", "", None, "[1]", "null", '{"kingdom": [', '{"species":"x"}', "{}", GOOD + " junk", GOOD + GOOD,
    f"{GOOD},{GOOD}", GOOD.replace('"', "'"), GOOD.replace('"species":1,', ""),
]


@pytest.mark.parametrize("bad", BAD)
def test_a_topic_is_read_up_to_its_first_unreadable_message(spark, log, bad):
    more = spark.createDataFrame([("gbif_query", 1, bad), ("other_query", 0, bad)], LOG)
    read = results.readable(log.where("offset <> 1").union(more), TOPICS)
    assert sorted(tuple(r) for r in read.select("topic", "offset").collect()) == [
        ("gbif_query", 0),
        ("obis_query", 9),
    ]


def test_nothing_readable(spark):
    log = spark.createDataFrame([("gbif_query", 0, "x"), ("gbif_query", 1, "{}")], LOG)
    assert results.readable(log, TOPICS).collect() == []


def test_readable_by_several_columns(spark):
    order = ["timestamp", "offset"]
    good = document("GBIF", {}, 0, 0)
    log = spark.createDataFrame(
        [("gbif_query", 1, 9, good), ("gbif_query", 2, 0, "x"), ("gbif_query", 2, 1, good)],
        "topic string, timestamp int, offset bigint, value string",
    )
    assert [r["offset"] for r in results.readable(log, TOPICS, order).collect()] == [9]


def test_documents_survive_the_round_trip(spark):
    counts = spark.createDataFrame(
        [
            ("gbif", "Пла\"нты", 2, 2),
            ("gbif", None, 3, 2),
            ("obis", None, 1, 0),
        ],
        "topic string, kingdom string, count bigint, species bigint",
    )
    built = results.build_documents(counts, species=F.max("species"))
    sent = results.result_messages(built)
    assert sent.columns == ["topic", "value"]
    texts = answers(sent)
    assert json.loads(texts["gbif_query"]) == {
        "kingdom": [{"kingdom": None, "count": 3}, {"kingdom": "Пла\"нты", "count": 2}],
        "species": 2,
        "source_count": 5,
        "source_name": "GBIF",
    }
    opened = results.open_documents(sent)
    renamed = built.withColumn("topic", F.concat("topic", F.lit("_query")))
    assert sorted(opened.collect(), key=str) == sorted(renamed.collect(), key=str)
