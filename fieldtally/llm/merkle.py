"""Merkle manifest of a dataset, with a proof for every row.

Leaves are ordered within their source; every three consecutive nodes (the last run may be shorter) are
hashed into one until a source has one node, its subroot. Subroots, ordered by source, give the root in
the same way. Hashes are sha256 over hex texts.

Positions come from a global sort by range, so that a source of any size is spread over many tasks: a row's
place is its place in its partition plus the rows of the partitions before. Six levels at a time are
built from blocks of 729 consecutive nodes, at most one of which is in a task's hands at once.

Proofs come from pointer jumping. Every node holds the segment of siblings on its way to its parent. A
self-join appends to a node's segment that of the ancestor it reaches, which doubles the distance, until
all leaves reach the root; after r rounds only levels that are multiples of 2^r are needed and kept. High
up very many nodes share an ancestor: it is copied under several salts, by how many nodes of the largest tree
meet there, so copies stay few against the nodes. Each round is a written table.

Defined cases: null values hash as ``-``; a null doc_id comes first in its source and a null source first of all;
rows of one doc_id are leaves of their own, ordered by leaf hash; equal rows are equal leaves, each with its own
proof; a source with one row has that leaf as subroot, and an empty table gives no rows; columns
beside those hashed are ignored, but for those that ``carry`` names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldtally.llm.common import written

FAN = 3
#: Levels that are built from one block.
LEVELS = 6
BLOCK = FAN**LEVELS
#: Rows of a range of the global sort, and nodes that share one copy of an ancestor.
RANGE_ROWS = 250_000
MOST_RANGES = 20_000
SALT_ROWS = 100_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(values: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the values: of each ``-`` if null, else UTF-8 byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hashed(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, "").cast("binary"), 256)


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with ``index``, their place within their ``tree`` by ``order``, and ``size``, the tree's rows."""
    count = rows.count()
    ranges = min(max(1, -(-count // RANGE_ROWS)), MOST_RANGES)
    keys = ["tree", *order]
    ordered = written(
        rows.repartitionByRange(ranges, *[F.col(k).asc_nulls_first() for k in keys])
        .sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
        .withColumn("at", F.monotonically_increasing_id()),
        "ordered",
    )
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    # One row for each range, of which there are at most MOST_RANGES.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(
        ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
        .select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    trees = ordered.groupBy("tree").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("size"))
    firsts = written(
        trees.withColumn("part", part).join(offsets, "part")
        .select("tree", "size", (F.col("offset") + row).alias("first")),
        "trees",
    )
    place = ordered.withColumn("part", part).join(offsets, "part").withColumn("place", F.col("offset") + row)
    return (
        place.join(firsts, "tree").withColumn("index", F.col("place") - F.col("first"))
        .drop("part", "offset", "at", "place", "first")
    )


def _depth(size: Column) -> Column:
    """Levels above ``size`` nodes, at most those of a block."""
    depth = F.lit(0)
    for level in range(LEVELS):
        depth = F.when(size > FAN**level, F.lit(level + 1)).otherwise(depth)
    return depth


def _level_above(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: _hashed(F.slice(nodes, i * FAN + 1, FAN)))


def _nodes_with_siblings(nodes: Column, level: int, base: int) -> Column:
    """Of each node of one level of a block: its place, and how many siblings it has at its sides and which."""
    per_block = FAN ** (LEVELS - level)

    def entry(_, i):
        left = i % FAN
        right = F.least(F.lit(FAN - 1) - left, F.size(nodes) - 1 - i)
        siblings = F.concat(F.slice(nodes, i - left + 1, left), F.slice(nodes, i + 2, right))
        return F.struct(
            F.lit(base + level).alias("level"),
            (F.col("block") * per_block + i).alias("index"),
            F.unhex(F.lpad(F.hex(left * FAN + right), 2, "0")).alias("sides"),
            F.unhex(F.array_join(siblings, "")).alias("segment"),
        )

    return F.when(F.col("depth") > level, F.transform(nodes, entry)).otherwise(F.array())


def built(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of leaves ``tree, size, index, node``: all nodes below the roots with the segment to their parent
    (``tree, level, index, sides, segment``), and ``tree, size, depth, root``."""
    base, nodes, roots = 0, None, None
    current = leaves.select("tree", F.col("size").alias("leaves"), "size", "index", "node")
    while True:
        row = F.sort_array(F.collect_list(F.struct("index", "node")))
        blocks = (
            current.groupBy("tree", "leaves", "size", F.floor(F.col("index") / BLOCK).alias("block"))
            .agg(F.transform(row, lambda x: x["node"]).alias("l0"))
            .withColumn("depth", _depth(F.col("size")))
        )
        for level in range(LEVELS):
            above = F.when(F.col("depth") > level, _level_above(F.col(f"l{level}"))).otherwise(F.array().cast("array<string>"))
            blocks = blocks.withColumn(f"l{level + 1}", above)
        blocks = written(blocks, "blocks")
        entries = F.concat(*[_nodes_with_siblings(F.col(f"l{k}"), k, base) for k in range(LEVELS)])
        part = blocks.select("tree", F.explode(entries).alias("entry")).select("tree", "entry.*")
        top = F.element_at(F.array(*[F.get(f"l{k}", F.lit(0)) for k in range(LEVELS + 1)]), F.col("depth") + 1)
        ended = blocks.filter(F.col("size") <= BLOCK).select(
            "tree", F.col("leaves").alias("size"), (F.col("depth") + base).alias("depth"), top.alias("root")
        )
        nodes = part if nodes is None else nodes.unionByName(part)
        roots = ended if roots is None else roots.unionByName(ended)
        more = blocks.filter(F.col("size") > BLOCK)
        if more.isEmpty():
            return nodes, written(roots, "roots")
        current = more.select(
            "tree", "leaves", F.ceil(F.col("size") / BLOCK).alias("size"), F.col("block").alias("index"),
            F.get(f"l{LEVELS}", F.lit(0)).alias("node"),
        )
        base += LEVELS


def _salted(left: DataFrame, right: DataFrame, on: list[str], meet: int, spread: str) -> DataFrame:
    """Left join where up to ``meet`` rows of the left have one key of the right."""
    salts = max(1, -(-meet // SALT_ROWS))
    if salts > 1:
        left = left.withColumn("salt", F.pmod(F.col(spread), F.lit(salts)))
        right = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        on = [*on, "salt"]
    return left.join(right, on, "left").drop("salt")


def jumped(nodes: DataFrame, depth: int, largest: int) -> DataFrame:
    """``tree, index, sides, segment`` of all leaves, with all siblings up to the root of their tree."""
    nodes, distance = written(nodes, "segments"), 1
    nothing = F.lit(b"")
    while distance < depth:
        span = FAN**distance
        left = nodes.filter(F.col("level") % (2 * distance) == 0).select(
            "*", (F.col("level") + distance).alias("to"), F.floor(F.col("index") / span).alias("over")
        )
        right = nodes.filter(F.col("level") % (2 * distance) == distance).select(
            "tree", F.col("level").alias("to"), F.col("index").alias("over"),
            F.col("sides").alias("more_sides"), F.col("segment").alias("more"),
        )
        met = _salted(left, right, ["tree", "to", "over"], min(span, largest), "index")
        nodes = written(
            met.select(
                "tree", "level", "index",
                F.concat("sides", F.coalesce("more_sides", nothing)).alias("sides"),
                F.concat("segment", F.coalesce("more", nothing)).alias("segment"),
            ),
            "segments",
        )
        distance *= 2
    return nodes.filter(F.col("level") == 0).drop("level")


def prove(docs: DataFrame, leaf: Column, doc_id: str = "doc_id", source: str = "source", carry: Sequence[Column] = ()) -> DataFrame:
    """``doc_id, leaf, subroot, root, sides, segment`` and the columns of ``carry`` for each row.

    ``sides`` has a byte for each level, 3 times the siblings to the left plus those to the right;
    ``segment`` has their hashes, 32 bytes each, level by level, left to right.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    rows = docs.select(
        tree.alias("tree"), F.col(doc_id).alias("doc_id"), leaf.alias("node"), *carry,
        # Rows that are equal in all else are told apart, so that no range has to hold all of them.
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = written(placed(written(rows, "leaves"), ["doc_id", "node", "row"]).drop("row"), "placed")
    nodes, subroots = built(leaves)
    deepest, largest = subroots.agg(F.max("depth"), F.max("size")).first()
    tops = placed(
        subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("node")), ["source"]
    )
    tops = written(tops, "subroots")
    top_nodes, root = built(tops)
    top = root.select("depth", "size", "root").first()
    paths = jumped(nodes, deepest or 0, largest or 0)
    top_paths = jumped(top_nodes, top["depth"] if top else 0, top["size"] if top else 0)
    per_source = written(
        _salted(tops, top_paths, ["tree", "index"], 1, "index").select(
            F.col("source").alias("tree"), F.col("node").alias("subroot"),
            F.col("sides").alias("top_sides"), F.col("segment").alias("top_segment"),
        ),
        "top-paths",
    )
    nothing = F.lit(b"")
    own = leaves.join(paths, ["tree", "index"], "left")
    return _salted(own, per_source, ["tree"], largest or 0, "index").select(
        "doc_id", F.col("node").alias("leaf"), "subroot", F.lit(top["root"] if top else None).alias("root"),
        F.concat(F.coalesce("sides", nothing), F.coalesce("top_sides", nothing)).alias("sides"),
        F.concat(F.coalesce("segment", nothing), F.coalesce("top_segment", nothing)).alias("segment"),
        *[c for c in leaves.columns if c not in ("tree", "size", "index", "doc_id", "node")],
    )


def proof_hash() -> Column:
    """sha256 over all siblings of a proof."""
    return F.sha2(F.lower(F.hex("segment")).cast("binary"), 256)


@F.pandas_udf(T.StringType())
def folded_root(leaf: pd.Series, sides: pd.Series, segment: pd.Series) -> pd.Series:
    """The root that a leaf and its proof lead to."""

    def fold(node: str, levels: bytes, siblings: bytes) -> str:
        siblings, at = siblings.hex(), 0
        for level in levels:
            left, right = divmod(level, FAN)
            middle, end = at + 64 * left, at + 64 * (left + right)
            node = hashlib.sha256((siblings[at:middle] + node + siblings[middle:end]).encode()).hexdigest()
            at = end
        return node

    return pd.Series([fold(*row) for row in zip(leaf, sides, segment)], dtype=object)


def verified(proofs: DataFrame, claimed: str) -> DataFrame:
    """Proofs with ``folded_root`` of the column ``claimed`` and whether it is the ``root``."""
    folded = proofs.withColumn("folded_root", folded_root(claimed, "sides", "segment"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
