"""What several operators share: written intermediate tables, runs of keyed rows, groups dealt in
parts, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.workspace import run_folder

#: More rows of a group than this are dealt into parts, and the parts compared pair by pair.
PART_ROWS = 2048


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors."""
    path = run_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(name: str, df: DataFrame) -> str:
    """The name, with strokes after it while the table has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def others(df: DataFrame, *own: str) -> list[str]:
    """The table's columns but for the names given, which are replaced in any case of letters."""
    return [c for c in df.columns if c.lower() not in own]


def quoted(names: list[str]) -> list[Column]:
    """Columns by their whole names, whatever signs are in them."""
    return [F.col(f"`{c.replace('`', '``')}`").alias(c) for c in names]


def plainly_named(df: DataFrame, *keep: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with plain names for all columns but those of ``keep``, so that none has a name used inside or one that
    Python functions can't be given; and what puts the names back in a table that begins with these columns."""
    names = df.columns
    inner = [c.lower() if c.lower() in keep else f"column_{i}" for i, c in enumerate(names)]
    return df.toDF(*inner), lambda out: out.toDF(*names, *out.columns[len(names):])


def keyed_runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Whole groups, one after the other, of batches that come sorted by the key."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        values = batch[key].to_numpy()
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(batch)]
        for at, to in zip(bounds, bounds[1:]):
            if held and held[-1][key].iat[-1] != values[at]:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(batch.iloc[at:to])
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Batches, which come sorted by the key, cut anew so that each holds all rows of its groups."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        values = batch[key].to_numpy()
        if held and held[-1][key].iat[-1] != values[0]:
            yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
            held = []
        cuts = np.flatnonzero(values[1:] != values[:-1])
        if len(cuts):
            cut = int(cuts[-1]) + 1
            yield pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
            held, batch = [], batch.iloc[cut:]
        held.append(batch)
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def neighbours(group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places with the same value of a sorted array, in bounded steps."""
    n = len(group)
    if not n:
        return
    begins = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    ends = np.repeat(np.append(begins[1:], n), np.diff(np.append(begins, n)))
    place, step = np.arange(n), 1
    while len(place := place[place + step < ends[place]]):
        yield place, place + step
        step += 1


def dealt(members: DataFrame, keys: DataFrame, ident: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Members of groups (column ``bucket``) as blocks to be compared, sorted by ``block``.

    A group of up to ``part_rows`` rows is one block. A larger one is dealt by hash into parts, and
    each row goes to one block for every other part (``part`` tells which side it is on; both sides
    are the same part where ``left_part = right_part``), so that every pair of the group meets in
    exactly one block if it is of different parts, and in the block of its part if not. ``keys`` has
    the buckets of all members, as often as they occur; the large ones are found by counting.
    """
    large = written(
        keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > part_rows),
        "large",
    )
    parts = F.coalesce(F.ceil(F.col("rows") / part_rows), F.lit(1)).cast("int")
    return (
        members.join(large, "bucket", "left")
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64(ident), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("left_part", F.least("part", "other"))
        .withColumn("right_part", F.greatest("part", "other"))
        .drop("rows", "parts", "other")
        .withColumn("block", F.xxhash64("bucket", "left_part", "right_part"))
        .transform(by_block)
    )


def by_block(members: DataFrame) -> DataFrame:
    """Rows of blocks dealt to as many tasks as the session shuffles to: their work goes by pairs, not by bytes,
    so small ones are not put together."""
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.repartition(tasks, "block").sortWithinPartitions("block", "bucket", "left_part", "right_part")


def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The blocks that ``dealt`` made; two of one hash are told apart."""
    for run in keyed_runs(batches, "block"):
        if len(run) < 2:
            continue
        bucket, left, right = (run[c].to_numpy() for c in ("bucket", "left_part", "right_part"))
        if (bucket == bucket[0]).all() and (left == left[0]).all() and (right == right[0]).all():
            yield run
        else:
            for _, block in run.groupby(["bucket", "left_part", "right_part"], sort=False):
                yield block


class Forest:
    """Union-find over positions; the root of a tree is its first position."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.parent))], dtype=np.int64)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of all nodes of the edges ``u, v``.

    Labels spread to neighbours and then jump to their label's label, until none changes. Messages
    are combined before they are shuffled, joins read written tables and can be split where a node
    has very many edges.
    """
    both = written(
        edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(),
        "edges",
    )
    labels = written(
        both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("label")), "labels"
    )
    total = None
    while True:
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels.withColumnRenamed("label", "component")
        total = now
        sent = both.join(labels, both["u"] == labels["node"]).select(F.col("v").alias("node"), "label")
        best = written(
            labels.unionByName(sent).groupBy("node").agg(F.min("label").alias("label")), "labels"
        )
        target = best.select(F.col("node").alias("at"), F.col("label").alias("far"))
        labels = written(
            best.join(target, best["label"] == target["at"]).select("node", F.col("far").alias("label")),
            "labels",
        )
