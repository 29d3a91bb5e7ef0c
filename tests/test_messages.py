import pytest
from pyspark.sql import functions as F

from fieldtally.sources.messages import (
    broker_options,
    decode_value,
    message_stream,
    read_result_log,
)
from fieldtally.streaming.sinks import publish


def test_broker_options():
    assert broker_options(["a:9092", "b:9092"], ["gbif", "obis"]) == {
        "kafka.bootstrap.servers": "a:9092,b:9092",
        "subscribe": "gbif,obis",
    }
    assert "subscribe" not in broker_options(["a:9092"])
    with pytest.raises(ValueError):
        broker_options([], ["gbif"])


def test_missing_arguments(spark):
    with pytest.raises(ValueError, match="topic"):
        message_stream(spark, [], "parquet", path="/x")
    with pytest.raises(ValueError, match="path"):
        message_stream(spark, ["gbif"], "parquet")
    with pytest.raises(ValueError, match="source"):
        read_result_log(spark, [], "parquet", path="/x")
    with pytest.raises(ValueError, match="path"):
        read_result_log(spark, ["gbif"], "parquet")


def test_decode_drops_key_and_position(spark):
    message = spark.range(1).select(
        F.lit("k").alias("key"),
        F.lit("gbif").alias("topic"),
        F.encode(F.lit("é"), "UTF-8").alias("value"),
        F.lit(7).alias("offset"),
    )
    decoded = decode_value(message)
    assert decoded.columns == ["topic", "value"]
    assert decoded.first()["value"] == "é"


def test_result_log_of_files_holds_the_named_sources(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [("gbif_query", 0, "a"), ("obis_query", 1, "b"), ("gbif", 2, "c")]
    spark.createDataFrame(rows, "topic string, offset bigint, value string").write.partitionBy(
        "topic", "offset"
    ).parquet(path)
    log = read_result_log(spark, ["gbif", "idigbio"], "parquet", path=path)
    assert set(log.columns) == {"topic", "offset", "value"}
    assert [(r["topic"], r["offset"], r["value"]) for r in log.collect()] == [("gbif_query", 0, "a")]


class Recorder:
    """Stands in for a session's reader or a frame's writer and keeps what it is asked for."""

    def __init__(self):
        self.calls = {}
        self.read = self.readStream = self.write = self

    def format(self, name):
        self.calls["format"] = name
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def load(self):
        return self

    def save(self):
        self.calls["saved"] = True

    def select(self, *columns):
        return self


def test_stream_of_the_broker():
    asked = message_stream(
        Recorder(), ["gbif", "obis"], servers=["a:1", "b:2"], options={"minPartitions": "64"}
    ).calls
    assert asked == {
        "format": "kafka",
        "options": {
            "kafka.bootstrap.servers": "a:1,b:2",
            "subscribe": "gbif,obis",
            "startingOffsets": "latest",
            "minPartitions": "64",
        },
    }
    earliest = message_stream(Recorder(), ["gbif"], servers=["a:1"], starting_offsets="earliest")
    assert earliest.calls["options"]["startingOffsets"] == "earliest"


def test_result_log_of_the_broker(spark):
    asked = read_result_log(Recorder(), ["gbif", "obis"], servers=["a:1"]).calls
    assert asked == {
        "format": "kafka",
        "options": {
            "kafka.bootstrap.servers": "a:1",
            "subscribePattern": "gbif_query|obis_query",
            "startingOffsets": "earliest",
            "endingOffsets": "latest",
        },
    }


class Recorders(Recorder):
    """A session that remembers the options of every scan."""

    def __init__(self):
        super().__init__()
        self.scans = []

    def options(self, **options):
        self.scans.append(options)
        return self

    def union(self, other):
        return self


def test_new_messages_of_the_broker(spark, monkeypatch):
    asked = Recorders()
    monkeypatch.setattr("fieldtally.sources.messages.DataFrame", Recorders)
    read_result_log(asked, ["gbif", "obis"], servers=["a:1"], after={"obis_query": 41})
    base = {"kafka.bootstrap.servers": "a:1", "endingOffsets": "latest"}
    assert asked.scans == [
        {**base, "assign": '{"obis_query": [0]}', "startingOffsets": '{"obis_query": {"0": 42}}'},
        {**base, "subscribePattern": "gbif_query", "startingOffsets": "earliest"},
    ]


def test_publish_to_the_broker():
    recorder = Recorder()
    publish(recorder, options=broker_options(["a:1"]))
    assert recorder.calls == {
        "format": "kafka",
        "mode": "append",
        "options": {"kafka.bootstrap.servers": "a:1"},
        "saved": True,
    }


def test_files_have_no_start(spark, tmp_path):
    with pytest.raises(ValueError, match="beginning"):
        message_stream(spark, ["gbif"], fmt="parquet", path=str(tmp_path), starting_offsets="latest")
