"""Merged counts that read each result message once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldtally.operators.results import RESULT_SUFFIX, latest, unreadable
from fieldtally.sources.messages import BROKER, read_result_log
from fieldtally.streaming.manifest import SnapshotTable

STATE = "topic string, high bigint, stopped boolean, offset bigint, value string"


class FollowedResults:
    """The latest readable message of each topic, kept under ``path`` with how far the topic has been read.

    ``advance`` scans only what is behind that place. A topic that has had a message that is no result document
    stays where it stopped, as a reader of the whole log would, and is not scanned again. Topics
    have one partition, or are tables of ``sinks.result_writer``: their order is ``offset``.
    """

    def __init__(self, spark: SparkSession, names: Sequence[str], path: str):
        if not names:
            raise ValueError("at least one source is needed")
        self.spark, self.names = spark, list(names)
        self.table = SnapshotTable(spark, path, keep=2)

    def advance(
        self,
        fmt: str = BROKER,
        servers: Sequence[str] = (),
        path: str | None = None,
        options: Mapping[str, str] | None = None,
        scanned: Callable[[DataFrame], DataFrame] = lambda log: log,
    ) -> DataFrame:
        """Take in what is new, and return ``topic, offset, value`` of the latest messages for ``count_by``.

        ``scanned`` is applied to the new messages, for example to observe them.
        """
        state = self._state()
        known = {row["topic"]: row for row in state.select("topic", "high", "stopped").collect()}
        open_names = [n for n in self.names if not (n + RESULT_SUFFIX in known and known[n + RESULT_SUFFIX]["stopped"])]
        if open_names:
            after = {topic: row["high"] for topic, row in known.items() if not row["stopped"]}
            log = read_result_log(self.spark, open_names, fmt, servers, path, options, after)
            self._take(state, scanned(log.select("topic", "offset", "value")))
        return self._state().where(F.col("value").isNotNull()).select("topic", "offset", "value")

    def _take(self, state: DataFrame, new: DataFrame) -> None:
        checked = new.withColumn("bad", unreadable())
        # One row per topic of the list. What arrives while this runs is behind the place that is kept.
        seen = checked.groupBy("topic").agg(
            F.min(F.when(F.col("bad"), F.col("offset"))).alias("first_bad"), F.max("offset").alias("last")
        )
        marks = self.spark.createDataFrame(seen.collect(), "topic string, first_bad bigint, last bigint")
        seen = F.broadcast(marks)
        within = (F.col("offset") <= F.col("last")) & (F.col("first_bad").isNull() | (F.col("offset") < F.col("first_bad")))
        good = latest(new.join(seen, "topic").where(within).select("topic", "offset", "value"))
        fresh = marks.join(good, "topic", "left").select(
            "topic", F.col("last").alias("high"), F.col("first_bad").isNotNull().alias("stopped"), "offset", "value"
        )
        both = state.withColumn("turn", F.lit(0)).unionByName(fresh.withColumn("turn", F.lit(1)))
        merged = both.groupBy("topic").agg(
            F.max("high").alias("high"),
            F.bool_or("stopped").alias("stopped"),
            F.max_by(F.struct("offset", "value"), F.when(F.col("value").isNotNull(), F.col("turn"))).alias("last"),
        )
        kept = merged.select("topic", "high", "stopped", "last.offset", "last.value")
        epochs = self.table.epochs()
        self.table.commit(kept, epochs[-1][1] + 1 if epochs else 0)

    def _state(self) -> DataFrame:
        if not self.table.epochs():
            return self.spark.createDataFrame([], STATE)
        return self.table.latest()
