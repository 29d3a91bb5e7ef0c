"""Near-duplicate vectors by cross-polytope hashing.

A hash turns a vector by three rounds of random signs and fast Hadamard transform and takes the
nearest signed axis; ``HASHES`` of them make a bucket of a table. With multiprobe, a vector also goes
to the ``PROBES`` next best buckets of every table as a visitor; pairs in which one is at home are
candidates. Every candidate is verified by its cosine in double precision, and counted only in the
first table and bucket where it meets.

Vectors are hashed once. Through the buckets go ids and a sketch, the signs of ``SKETCH_BITS`` coordinates of
the rotated vector. Near vectors differ in few of them: at the threshold in 12 % on average, and in over
``SKETCH_APART`` with a probability of under 1e-12, so a pair above that is no candidate. Only members with a candidate in their
bucket get their vector and codes, and are verified there; nothing is emitted for each pair.

Equal vectors of a label are one class with a weight, so copies never make pairs. Large buckets are
dealt into parts that meet pair by pair: none is capped.

Defined cases: rows whose label or vector is null, whose vector is empty or zero or has a null or
non-finite component link with nothing and are their own component; vectors of different length are
not compared; rows that repeat an id are vectors of their own, each with its own links; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import by_block, components, dealt, neighbours, whole_groups, written

THRESHOLD = 0.93
TABLES, HASHES, PROBES = 10, 2, 2
#: Bits of the sketch, most that may differ, and the vectors' length from which rotations are rich enough for it.
SKETCH_BITS, SKETCH_APART, SKETCH_SIZE = 128, 48, 64
#: Shorter vectors are padded to this length, or their rotations would be few.
SMALLEST = 16
#: Rows that are hashed at a time: their rotations stay in a core's cache.
STEP_ROWS = 64


def usable(vector: Column) -> Column:
    """Whether all components are finite and one is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@cache
def signs(size: int) -> np.ndarray:
    return np.random.default_rng(3).choice(np.array([-1.0, 1.0]), (TABLES, HASHES, 3, size))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the last axis."""
    shape, size = x.shape, x.shape[-1]
    step = 1
    while step < size:
        pairs = x.reshape(-1, size // (2 * step), 2, step)
        turned = np.empty_like(pairs)
        np.add(pairs[:, :, 0], pairs[:, :, 1], out=turned[:, :, 0])
        np.subtract(pairs[:, :, 0], pairs[:, :, 1], out=turned[:, :, 1])
        x, step = turned, 2 * step
    return x.reshape(shape)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def hashed(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of unit vectors: for every table the home bucket and the probed ones, as numbers; the sketch."""
    n, dim = vectors.shape
    size = max(SMALLEST, 1 << (dim - 1).bit_length())
    codes, sketch = np.empty((n, TABLES, 1 + PROBES), np.int64), np.zeros((n, SKETCH_BITS // 64), np.int64)
    turns = signs(size)
    for at in range(0, n, STEP_ROWS):
        x = np.zeros((min(STEP_ROWS, n - at), 1, 1, size))
        x[:, 0, 0, :dim] = vectors[at : at + STEP_ROWS]
        for turn in range(3):
            x = hadamard(x * turns[None, :, :, turn])
        x /= size**1.5
        codes[at : at + STEP_ROWS] = _nearest(x, size)
        if size >= SKETCH_SIZE:
            bits = x.reshape(len(x), -1)[:, :SKETCH_BITS] > 0
            sketch[at : at + STEP_ROWS] = np.packbits(bits, axis=1).view(np.int64)
    return codes, sketch


def _nearest(x: np.ndarray, size: int) -> np.ndarray:
    """Home and probed buckets from rotated vectors (row, table, hash, coordinate)."""
    # Of an axis and its opposite only the nearer one can be among the few nearest.
    both = np.abs(x)
    near = np.argpartition(-both, PROBES, axis=3)[..., : PROBES + 1]
    values = np.take_along_axis(both, near, axis=3)
    order = np.argsort(-values, axis=3, kind="stable")
    near, values = np.take_along_axis(near, order, axis=3), np.take_along_axis(values, order, axis=3)
    near = near + size * (np.take_along_axis(x, near, axis=3) < 0)
    factor = (2 * size) ** np.arange(HASHES)[None, None, :, None]
    home = (near[..., :1] * factor).sum(axis=2)
    # A probe changes one hash of the bucket; the smaller its loss the better.
    change = ((near[..., 1:] - near[..., :1]) * factor).reshape(*x.shape[:2], -1)
    loss = (values[..., :1] ** 2 - values[..., 1:] ** 2).reshape(*x.shape[:2], -1)
    best = np.argsort(loss, axis=2, kind="stable")[..., :PROBES]
    return np.concatenate((home, home + np.take_along_axis(change, best, axis=2)), axis=2)


def _meeting(block: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of whole blocks that meet there: of the block's two parts, one of them at home."""
    keys = block[["block", "bucket", "left_part", "right_part"]].to_numpy()
    group = np.concatenate(([0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))))
    part, home = block["part"].to_numpy(), block["home"].to_numpy()
    across = keys[:, 2] != keys[:, 3]
    for i, j in neighbours(group):
        meet = (home[i] | home[j]) & (~across[i] | (part[i] != part[j]))
        yield i[meet], j[meet]


def _live(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members that have a candidate in their bucket, by sketch."""
    for block in whole_groups(batches, "block"):
        sketch = np.stack([block["s0"].to_numpy(), block["s1"].to_numpy()], axis=1).view(np.uint64)
        live = np.zeros(len(block), bool)
        for i, j in _meeting(block):
            near = np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1) <= SKETCH_APART
            live[i[near]] = live[j[near]] = True
        if live.any():
            yield block.loc[live, ["block", "bucket", "left_part", "right_part", "part", "class", "home"]]


def _first(own: np.ndarray, p: np.ndarray, q: np.ndarray, table: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Pairs that meet for the first time in the bucket of that table and number."""
    a, b = own[p], own[q]
    far = np.iinfo(np.int64).max
    # Buckets where they meet: of one's home, the other's any.
    at_a = np.where((b == a[:, :, :1]).any(axis=2), a[:, :, 0], far)
    at_b = np.where((a == b[:, :, :1]).any(axis=2), b[:, :, 0], far)
    least = np.minimum(at_a, at_b)
    first = (least != far).argmax(axis=1)
    return (first == table) & (least[np.arange(len(p)), first] == number)


def _roots(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Of each place the smallest one it is linked with, directly or through others."""
    root = np.arange(n)
    while len(p):
        low = np.minimum(root[p], root[q])
        before = root.copy()
        for x in (p, q):
            np.minimum.at(root, root[x], low)
            np.minimum.at(root, x, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _verified(threshold: float):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Weights of verified links and a spanning forest of them, for each block."""
        for block in whole_groups(batches, "block"):
            lengths = block["vector"].map(len).to_numpy()
            label = pd.factorize(block["label"])[0]
            table, number = block["table"].to_numpy(), block["number"].to_numpy()
            weights, links = block["copies"].to_numpy(), np.zeros(len(block), np.int64)
            own = np.stack(block["codes"].to_numpy()).reshape(-1, TABLES, 1 + PROBES)
            unified: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            place = np.zeros(len(block), np.int64)
            for length in np.unique(lengths).tolist():
                some = np.flatnonzero(lengths == length)
                place[some] = np.arange(len(some))
                unified[length] = unit(np.stack(block["vector"].iloc[some].to_numpy()).astype(np.float64))
            joined = []
            for i, j in _meeting(block):
                same = (label[i] == label[j]) & (lengths[i] == lengths[j])
                i, j = i[same], j[same]
                for length, vectors in unified.items():
                    of = slice(None) if len(unified) == 1 else lengths[i] == length
                    p, q = i[of], j[of]
                    near = np.einsum("ij,ij->i", vectors[place[p]], vectors[place[q]]) >= threshold
                    p, q = p[near], q[near]
                    first = _first(own, p, q, table[p], number[p])
                    p, q = p[first], q[first]
                    np.add.at(links, p, weights[q])
                    np.add.at(links, q, weights[p])
                    joined.append((p, q))
            if not joined:
                continue
            root = _roots(len(block), *(np.concatenate(x) for x in zip(*joined)))
            linked, names = np.flatnonzero(links), block["class"].to_numpy()
            yield pd.DataFrame({"u": names[linked], "v": names[root[linked]], "links": links[linked]})

    return links


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of ``vec_id, embedding, label`` rows."""
    wide = "double" if rows.schema["embedding"].dataType.elementType.simpleString() == "double" else "float"
    rows = rows.select("vec_id", "label", F.col("embedding").cast(f"array<{wide}>").alias("embedding"))
    rows = rows.withColumn("usable", F.col("label").isNotNull() & usable(F.col("embedding")))
    plus_zero = F.transform("embedding", lambda x: x + F.lit(0).cast(wide))  # -0 is 0
    marked = rows.withColumn("vector", F.when(F.col("usable"), plus_zero)).drop("embedding")
    grouped = (
        marked.filter("usable and vec_id is not null").groupBy("label", "vector")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        .withColumn("class", F.monotonically_increasing_id())
    )

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["vector"].map(len).to_numpy()
            for length in np.unique(lengths):
                some = batch[lengths == length].reset_index(drop=True)
                codes, sketch = hashed(unit(np.stack(some["vector"].to_numpy()).astype(np.float64)))
                some["codes"] = list(codes.reshape(len(some), -1))
                some["s0"], some["s1"] = sketch[:, 0], sketch[:, 1]
                yield some

    label = grouped.schema["label"].dataType.simpleString()
    classes = written(
        grouped.mapInPandas(
            coded,
            f"label {label}, vector array<{wide}>, rep long, copies long, class long, codes array<long>, s0 long, s1 long",
        ),
        "classes",
    )
    members = classes.select(
        "class", "label", F.size("vector").alias("length"), "s0", "s1", F.posexplode("codes").alias("place", "number")
    ).select(
        F.xxhash64("label", "length", F.floor(F.col("place") / (1 + PROBES)).cast("int"), "number").alias("bucket"),
        "class", "s0", "s1", (F.col("place") % (1 + PROBES) == 0).alias("home"),
    )
    live = written(
        dealt(members, members.select("bucket"), "class").mapInPandas(
            _live, "block long, bucket long, left_part int, right_part int, part int, class long, home boolean"
        ),
        "live",
    )
    # The place of a bucket among a member's own codes, of which a repeated number is one place.
    bucket_of = [
        F.xxhash64("label", F.size("vector"), F.lit(t), F.get("codes", F.lit(t * (1 + PROBES) + k)))
        for t in range(TABLES) for k in range(1 + PROBES)
    ]
    at = F.array_position(F.array(*bucket_of), F.col("bucket")) - 1
    fetched = (
        live.join(classes.drop("rep", "s0", "s1"), "class").withColumn("at", at.cast("int"))
        .withColumn("table", F.floor(F.col("at") / (1 + PROBES)).cast("int"))
        .withColumn("number", F.get("codes", F.col("at"))).drop("at").transform(by_block)
    )
    pairs = written(fetched.mapInPandas(_verified(threshold), "u long, v long, links long"), "links")
    found = components(pairs.filter("u <> v").select("u", "v"))
    numbers = pairs.groupBy(F.col("u").alias("linked")).agg(F.sum("links").alias("links"))
    reached = (
        classes.select("class", "rep", "copies").join(numbers, F.col("class") == F.col("linked"), "left")
        .join(found, F.col("class") == F.col("node"), "left")
        .select("class", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "class").alias("component"))
    )
    reached = written(reached, "reached")
    # Components are named by classes here, and in the result by the smallest id of any of their vectors.
    smallest = reached.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = written(
        classes.select("class", "label", "vector").join(reached.drop("rep"), "class").join(smallest, "component")
        .select("label", "vector", "n_links", "component_id"),
        "named",
    )
    component = F.coalesce("component_id", "vec_id")
    return marked.join(named, ["label", "vector"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
