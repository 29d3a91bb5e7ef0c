"""Line deduplication over levelled sorted runs of line hashes.

Documents come in batches. The keys of a batch's lines are merge-anti-joined with the runs of all
levels: keys that no run holds make a new sorted run of level 0; keys that one holds add their
numbers to the table of repeats. When a level has ``fan`` runs they are merged into one run of the
next. No key is ever in two runs, so merging is a union, and a key's totals are its one row in the
runs and its rows among the repeats.

Runs and batches are tables in buckets by key, each bucket one sorted file. A batch is therefore merged with
a run bucket by bucket: neither is shuffled or sorted for it. What is shuffled is a batch's keys once, when they are
counted, and a level's runs when they become one.

Defined cases: a null or empty text is one empty line; short lines always stay; a line may repeat
within a document, which counts once; rows of one doc_id count as documents of their own, and all of
the largest doc_id keep their lines; a null doc_id's lines
are not counted and stay; an empty table gives no rows; columns beside ``doc_id`` and
``text`` go through, but for ``n_lines`` and ``n_dropped``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from uuid import uuid4

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm.common import others, plainly_named, quoted, written
from fieldtally.workspace import run_folder

BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the stripped line in lower case (A-Z only), None if it is short."""
    key = line.strip(BLANK)
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and len(key.decode("utf-8", "surrogatepass")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key.lower())


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, key``: each long enough key of a document once."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, found = [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = {line_key(line, min_chars) for line in _bytes(text).split(b"\n")} - {None}
                ids.extend([doc_id] * len(own))
                found.extend(own)
            yield pd.DataFrame({"doc_id": pd.Series(ids, dtype="int64"), "key": pd.Series(found, dtype=object)})

    return (
        docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
        .mapInPandas(keys, "doc_id long, key binary")
    )


class LineRuns:
    """Line keys seen so far: runs by level, and what was added to keys that were there already."""

    schema = "key binary, docs long, last_doc long"

    def __init__(self, spark: SparkSession, fan: int = 3):
        self.spark, self.fan = spark, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = [[]]
        self.added: list[DataFrame] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def absorb(self, keys: DataFrame) -> None:
        """Take in a batch of ``doc_id, key`` rows."""
        counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last_doc"))
        batch = self._in_buckets(counted.repartition(self.buckets, "key"))
        runs = self.runs()
        if runs:
            with sorted_buckets(self.spark):
                self.added.append(written(self.repeats(batch, runs), "repeats"))
                batch = self._in_buckets(self.new_keys(batch, runs))
        self._add(batch, 0)

    def new_keys(self, batch: DataFrame, runs: list[DataFrame]) -> DataFrame:
        """The batch's keys that no run holds."""
        for run in runs:
            batch = batch.join(run.select("key").hint("merge"), "key", "left_anti")
        return batch

    def repeats(self, batch: DataFrame, runs: list[DataFrame]) -> DataFrame:
        """The batch's keys that a run holds; none is in two."""
        return reduce(
            DataFrame.unionByName, [batch.join(run.select("key").hint("merge"), "key", "left_semi") for run in runs]
        )

    def _in_buckets(self, rows: DataFrame) -> DataFrame:
        """Rows that lie in their buckets' partitions already, as a table of sorted buckets."""
        name = f"run_{uuid4().hex}"
        (
            rows.sortWithinPartitions("key").write.format("parquet").bucketBy(self.buckets, "key").sortBy("key")
            .option("path", run_folder(self.spark, "run")).saveAsTable(name)
        )
        return self.spark.table(name)

    def _add(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan:
            merged = reduce(DataFrame.unionByName, self.levels[level])
            self.levels[level] = []
            self._add(self._in_buckets(merged.repartition(self.buckets, "key")), level + 1)

    def totals(self) -> DataFrame:
        """``key, docs, last_doc`` over all batches."""
        rows = reduce(DataFrame.unionByName, [*self.runs(), *self.added], self.spark.createDataFrame([], self.schema))
        return rows.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("last_doc").alias("last_doc"))


@contextmanager
def sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """While it lasts, plans know that a bucket of one file is sorted as it was written."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def repeated_keys(keys: DataFrame, min_docs: int, batches: int, fan: int) -> DataFrame:
    """``key, last_doc`` of keys in at least ``min_docs`` documents, found batch by batch; ``keys`` has the ``batch``."""
    runs = LineRuns(keys.sparkSession, fan)
    for i in range(batches):
        runs.absorb(keys.filter(F.col("batch") == i).select("doc_id", "key"))
    return runs.totals().filter(F.col("docs") >= min_docs).select("key", "last_doc")


def keys_by_batch(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """The written ``line_keys`` with their ``batch``, which is a folder: each batch is read on its own."""
    keys = line_keys(docs, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    path = run_folder(docs.sparkSession, "line-keys")
    keys.write.partitionBy("batch").parquet(path)
    return docs.sparkSession.read.schema(keys.schema).parquet(path)


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fan: int = 3
) -> DataFrame:
    """Documents with ``text`` less the repeated lines, ``n_lines`` (before) and ``n_dropped``.

    A key of at least ``min_chars`` code points in at least ``min_docs`` documents stays only in the
    largest doc_id that holds it.
    """
    keys = keys_by_batch(docs, min_chars, batches)
    found = written(repeated_keys(keys, min_docs, batches, fan), "repeated-keys")
    docs, named_back = plainly_named(docs.select(quoted(others(docs, "n_lines", "n_dropped"))), "doc_id", "text")
    gone = (
        keys.drop("batch").join(found, "key").filter(F.col("doc_id") != F.col("last_doc"))
        .groupBy("doc_id").agg(F.collect_set("key").alias("gone"))
    )
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )
    names = docs.columns

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, lines, drops = [], [], []
            for text, gone in zip(batch["text"], batch["gone"]):
                dropped, n = 0, (text.count("\n") if text else 0) + 1
                if gone is not None and len(gone):
                    keys, kept = set(map(bytes, gone)), []
                    for line in _bytes(text).split(b"\n"):
                        if line_key(line, min_chars) not in keys:
                            kept.append(line)
                    dropped = n - len(kept)
                    text = b"\n".join(kept).decode("utf-8", "surrogatepass")
                texts.append(text)
                lines.append(n)
                drops.append(dropped)
            out = batch[names].copy()
            out["text"] = pd.Series(texts, index=out.index, dtype=object)
            out["n_lines"] = np.array(lines, dtype=np.int64)
            out["n_dropped"] = np.array(drops, dtype=np.int64)
            yield out

    return named_back(docs.join(gone, "doc_id", "left").select(*names, "gone").mapInPandas(rewrite, schema))


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of what ``drop_repeated_lines`` returns."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
