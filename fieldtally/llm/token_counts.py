"""Token counts of documents in flat, unindexed token files, by a scan for the separator.

A flat file is one run of little-endian ids in which an end-of-document id closes every document;
nothing says where documents begin. Files are read in blocks of any cut. In each block one vectorised
search finds the separators; the counts between them are whole, the stretch before the first and
after the last belong to documents that cross blocks. A prefix scan over the blocks' summaries
(separators, open length) then gives every block the number of documents and the open length before
it: inside stretches of ``STRETCH`` blocks first, then over the stretches.

Defined cases: an empty document counts zero tokens beside its separator; what follows the last
separator of a file is an unclosed document if it is not empty; empty files and tables give no rows;
a null text has no tokens; rows of a null doc_id are left out, as counts go by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import written
from fieldtally.llm.tokens import encoder

#: Ids of a block, and blocks of a stretch.
BLOCK_IDS = 1 << 18
STRETCH = 1024


def flat_file_blocks(spark: SparkSession, path: str, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``file, block, data`` of flat token files; Spark reads a file whole, so shards up to 1 GB are meant."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"]):
                for block, at in enumerate(range(0, len(data), width * block_ids)):
                    own = bytes(data[at : at + width * block_ids])
                    yield pd.DataFrame({"file": [name], "block": [block], "data": [own]})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(split, "file string, block long, data binary")


def corpus_blocks(docs: DataFrame, vocabulary: str | None = None, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Flat token blocks of a table of texts, a file for each partition, 16-bit ids.

    ``doc_ids`` names the documents that end in the block, as bytes of longs; the scan does not see it.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = encoder(vocabulary)
        end = np.array([tokens.end], dtype="<u4").tobytes()
        file, block, held, ids = f"part-{TaskContext.get().partitionId()}", 0, [], []
        size, closed = 0, 0  # ids held; ids that are in blocks already
        ends: list[int] = []

        def out(last: bool) -> Iterator[pd.DataFrame]:
            nonlocal block, held, size, closed, ids, ends
            data = np.frombuffer(b"".join(held), dtype="<u4").astype("<u2")
            n = len(data) if last else len(data) // block_ids * block_ids
            for at in range(0, n, block_ids):
                own = data[at : min(at + block_ids, n)]
                upto = int(np.searchsorted(ends, closed + at + len(own), side="right"))
                names = np.array(ids[:upto], dtype="<i8").tobytes()
                yield pd.DataFrame({"file": [file], "block": [block], "data": [own.tobytes()], "doc_ids": [names]})
                block, ids, ends = block + 1, ids[upto:], ends[upto:]
            held, size, closed = [data[n:].astype("<u4").tobytes()], len(data) - n, closed + n

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = tokens.encode(text) + end
                held.append(own)
                size += len(own) // 4
                ids.append(doc_id)
                ends.append(closed + size)
                if size >= block_ids:
                    yield from out(False)
        yield from out(True)

    return docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull()).mapInPandas(
        encode, "file string, block long, data binary, doc_ids binary"
    )


def _scan(separator: int, width: int, named: bool):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            names = batch["doc_ids"] if named else [b""] * len(batch)
            for file, block, data, ids in zip(batch["file"], batch["block"], batch["data"], names):
                values = np.frombuffer(data, dtype=f"<u{width}")
                at = np.flatnonzero(values == separator)
                head = int(at[0]) if len(at) else len(values)
                tail = len(values) - int(at[-1]) - 1 if len(at) else len(values)
                inner = (np.diff(at) - 1).tolist()
                rows.append((file, block, len(values), len(at), head, tail, inner, np.frombuffer(ids, "<i8").tolist()))
            yield pd.DataFrame(
                rows, columns=["file", "block", "size", "closed", "head", "tail", "inner", "doc_ids"]
            )

    return scan


def count_tokens(blocks: DataFrame, separator: int, width: int = 2) -> DataFrame:
    """``file, ordinal, n_tokens, doc_id``: every document of every file in its order; the id where blocks name it."""
    named = "doc_ids" in blocks.columns
    schema = "file string, block long, size long, closed long, head long, tail long, inner array<long>, doc_ids array<long>"
    columns = ["file", "block", "data", *(["doc_ids"] if named else [])]
    found = written(blocks.select(columns).mapInPandas(_scan(separator, width, named), schema), "scan")

    stretch = found.withColumn("stretch", F.floor(F.col("block") / STRETCH))
    before = Window.partitionBy("file", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The open length before a block is the sum of tails from the last block with a separator on.
    upto = Window.partitionBy("file", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    inside = (
        stretch.withColumn("_to", F.sum("tail").over(upto))
        .withColumn("_mark", F.when(F.col("closed") > 0, F.col("_to") - F.col("tail")))
        .withColumn("_docs", F.coalesce(F.sum("closed").over(before), F.lit(0)))
        .withColumn("_last", F.max("_mark").over(before))
        .withColumn("_open", F.coalesce(F.max("_to").over(before), F.lit(0)) - F.coalesce("_last", F.lit(0)))
    )
    # The same once more over stretches: number of documents and open length at each one's end.
    ends = inside.groupBy("file", "stretch").agg(
        F.sum("closed").alias("closed"),
        (F.max("_to") - F.coalesce(F.max("_mark"), F.lit(0))).alias("tail"),
    )
    over = Window.partitionBy("file").orderBy("stretch")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        ends.withColumn("_to", F.sum("tail").over(over.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_mark", F.when(F.col("closed") > 0, F.col("_to") - F.col("tail")))
        .select(
            "file", "stretch",
            F.coalesce(F.sum("closed").over(earlier), F.lit(0)).alias("docs_before"),
            (F.coalesce(F.max("_to").over(earlier), F.lit(0)) - F.coalesce(F.max("_mark").over(earlier), F.lit(0))).alias("open_before"),
        )
    )
    joined = inside.join(ends, ["file", "stretch"])
    head = F.col("head") + F.col("_open") + F.when(F.col("_last").isNull(), F.col("open_before")).otherwise(0)
    counts = F.when(F.col("closed") > 0, F.concat(F.array(head), F.col("inner")))
    first = F.col("docs_before") + F.col("_docs")
    listed = joined.select("file", "doc_ids", first.alias("first"), F.posexplode(counts).alias("at", "n_tokens"))
    closed = listed.select(
        "file", (F.col("first") + F.col("at")).alias("ordinal"), "n_tokens", F.get("doc_ids", F.col("at")).alias("doc_id")
    )
    final = (
        joined.groupBy("file")
        .agg(
            F.max(F.struct(
                "block",
                (first + F.col("closed")).alias("ordinal"),
                F.when(F.col("closed") > 0, F.col("tail")).otherwise(
                    F.col("tail") + F.col("_open") + F.when(F.col("_last").isNull(), F.col("open_before")).otherwise(0)
                ).alias("n_tokens"),
            )).alias("end"),
        )
        .filter(F.col("end.n_tokens") > 0)
        .select("file", "end.ordinal", "end.n_tokens", F.lit(None).cast("long").alias("doc_id"))
    )
    return closed if named else closed.unionByName(final)
