"""SimHash near-duplicates: Burkhard-Keller trees over shards of distinct fingerprints.

The trees' children are keyed by their integer Hamming distance to the parent, and a search follows
only edges within the radius. Fingerprints that differ in r bits agree in one of r + 1 stretches of
bits, so a shard holds the fingerprints of one value of one stretch, and its tree is searched by
its own members only. A shard too large for one task is dealt into parts; the tree of each part is
sent to (searched by) every other part of the shard, so nothing is lost or sent to all executors.

Defined cases: null and empty texts, and texts without words, have fingerprint zero and are linked
like others; fewer words than a shingle make one shingle of them all; repeated rows share their
component; an empty table gives no rows; columns beside the named ones are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import Forest, blocks, components, dealt, quoted, written

SEED = 42
BITS = 64


def fingerprint(text: str | None, words: int) -> int:
    """Bits set in over half of the hashes of all word shingles, as an unsigned number."""
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > words:
        starts, ends = starts[: len(parts) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    shingles = map(line.__getitem__, map(slice, starts.tolist(), ends.tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(starts))
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, fp`` of every row, the fingerprint as a signed long."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": found.astype(np.int64)})

    return docs.select("doc_id", "text").mapInPandas(texts, "doc_id long, fp long")


class BKTree:
    """Numbers under Hamming distance; each node has its children by their distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        place = len(self.values)
        self.values.append(value)
        self.children.append({})
        if place:
            node = 0
            while True:
                distance = (self.values[node] ^ value).bit_count()
                child = self.children[node].get(distance)
                if child is None:
                    self.children[node][distance] = place
                    return
                node = child

    def within(self, value: int, radius: int) -> list[int]:
        """Places of all values at most ``radius`` away."""
        found, values, children = [], self.values, self.children
        todo = [0] if values else []
        while todo:
            node = todo.pop()
            distance = (values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            for key, child in children[node].items():
                if distance - radius <= key <= distance + radius:
                    todo.append(child)
        return found


def _links(block: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Each linked member of a block with the first member of its tree of links."""
    values = [v & (2**BITS - 1) for v in block["fp"].tolist()]
    part, left, right = block["part"].to_numpy(), block["left_part"].iat[0], block["right_part"].iat[0]
    forest, tree = Forest(len(values)), BKTree()
    if left == right:
        for i, value in enumerate(values):
            for j in tree.within(value, radius):
                forest.join(i, j)
            tree.add(value)
    else:
        stored = np.flatnonzero(part == left).tolist()
        for i in stored:
            tree.add(values[i])
        for i in np.flatnonzero(part == right).tolist():
            for j in tree.within(values[i], radius):
                forest.join(i, stored[j])
    roots = forest.roots()
    linked = np.flatnonzero(roots != np.arange(len(roots)))
    rep = block["rep"].to_numpy()
    return pd.DataFrame({"u": rep[linked], "v": rep[roots[linked]]})


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id, fp, component_id``: one row per document, linked at ``radius`` or fewer bits."""
    marked = written(fingerprints(docs, words), "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")

    cuts = np.linspace(0, BITS, radius + 2).astype(int).tolist()
    stretches = F.array(
        *(
            F.xxhash64(
                F.lit(i), F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1))
            )
            for i, (low, high) in enumerate(zip(cuts, cuts[1:]))
        )
    )
    members = classes.filter(F.col("rep").isNotNull()).select("fp", "rep", F.explode(stretches).alias("bucket"))

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches):
            yield _links(block, radius)

    edges = dealt(members, members.select("bucket"), "fp").mapInPandas(linked, "u long, v long")
    found = components(edges)
    named = written(
        classes.join(found, classes["rep"] == found["node"], "left").select(
            "fp", F.coalesce("component", "rep").alias("component_id")
        ),
        "classes",
    )
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """The documents without those of whose component a smaller doc_id stays; of repeated rows all stay."""
    found = near_duplicates(docs, words, radius)
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(quoted(docs.columns))
