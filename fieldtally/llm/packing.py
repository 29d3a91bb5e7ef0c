"""Best-fit packing of tokenised documents into sequences, certified by lower bounds.

Documents are tokenised once, cut where they are longer than a sequence, and dealt into partitions of
bounded size. Each partition is packed best-fit decreasing. A dual-feasible-function lower bound on
its number of bins certifies it: if the packing needs no more bins, it is final. Partitions with a
gap keep their full bins and exchange the others, whole bins at a time, with partitions they have not
met, and are packed again; a repacking counts only if it takes fewer bins.

After ``rounds`` rounds what is left keeps its bins, certified or not, so that the work is bounded; ``certified``
tells them apart.

Defined cases: the text of the vocabulary's closing token is that token wherever it stands; null text is empty and has only the closing id; repeated rows are documents of their
own; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import keyed_runs, written
from fieldtally.llm.tokens import encoder

CAPACITY = 2048
#: Pieces of a partition on average.
PARTITION_PIECES = 100_000
ROUNDS = 3


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, closing: int = 0, vocabulary: str | None = None, ids: bool = False
) -> DataFrame:
    """``item, doc_id, piece, start, length, ids_crc32`` and, if asked for, the ids as bytes.

    A document's ids end with the closing id. Of a cut document all pieces but the first are full.
    """
    schema = "item long, doc_id long, piece int, start long, length long, ids_crc32 long"
    last = np.array([closing], dtype="<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary, added=True).encode
        item = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                data = encode(text) + last
                n = len(data) // 4
                start, end = 0, n - (n - 1) // capacity * capacity
                for piece in range((n - 1) // capacity + 1):
                    own = data[4 * start : 4 * end]
                    row = (item, doc_id, piece, start, end - start, zlib.crc32(own))
                    rows.append((*row, own) if ids else row)
                    item, start, end = item + 1, end, end + capacity
            names = [x.split()[0] for x in schema.split(", ")]
            yield pd.DataFrame(rows, columns=[*names, "ids"] if ids else names)

    return docs.select("doc_id", "text").mapInPandas(cut, schema + ", ids binary" * ids)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest bound of the dual-feasible functions that round sizes over ``capacity - a`` up to
    a whole bin and those under ``a`` down to nothing, for every ``a`` up to half a bin."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = count * np.arange(capacity + 1)
    n_to, size_to = np.cumsum(count), np.cumsum(size)
    a = np.arange(0, capacity // 2 + 1)
    half = capacity // 2
    whole = n_to[-1] - n_to[capacity - a]
    middle = size_to[capacity - a] - np.where(a > 0, size_to[np.maximum(a, 1) - 1], 0)
    bounds = whole + -(-middle // capacity)
    over_half = n_to[capacity - a] - n_to[half]
    return int(max(bounds.max(), (whole + over_half).max()))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every length, longest first into the fullest bin that holds it; the number of bins."""
    order = np.argsort(-lengths, kind="stable")
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, n_bins = 0, 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fits = open_rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                open_rooms ^= 1 << room
        else:
            room, at = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = at, capacity - room
        room -= length
        if room:
            if not rooms[room]:
                open_rooms |= 1 << room
            rooms[room].append(at)
    return bins, offsets, n_bins


def _packed(run: pd.DataFrame, turn: int, capacity: int) -> pd.DataFrame:
    """A partition with its bins; ``final`` where it is certified or a bin is full."""
    run = run.sort_values("item", kind="stable")
    lengths = run["length"].to_numpy()
    bound = lower_bound(lengths, capacity)
    bins, offsets, n = best_fit(lengths, capacity)
    run = run.copy()
    if not turn or n < run["sequence_id"].nunique():
        run["sequence_id"] = (turn << 60) + (int(run["share"].iat[0]) << 28) + bins
        run["offset"] = offsets
    else:
        n = run["sequence_id"].nunique()
    filled = run.groupby("sequence_id")["length"].transform("sum").to_numpy()
    run["certified"] = n == bound
    run["final"] = (n == bound) | (filled == capacity)
    return run


def pack(
    found: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES, rounds: int = ROUNDS
) -> DataFrame:
    """Pieces (``item``, ``length`` and any others) with ``sequence_id``, ``offset``, ``certified``."""
    columns = [c for c in found.columns if c not in ("sequence_id", "offset", "certified", "share", "final")]
    found = written(found.select(columns), "pieces")
    full = found.filter(F.col("length") == capacity).select(
        *columns, (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(True).alias("certified"),
    )
    rest = found.filter(F.col("length") < capacity).select(
        *columns, F.lit(None).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    done = [full]
    for turn in range(rounds):
        n = rest.count()
        if not n:
            break
        shares = max(1, -(-n // partition_pieces))
        by = F.xxhash64("sequence_id", F.lit(turn)) if turn else F.xxhash64("item")
        schema = rest.withColumn("share", F.lit(0)).schema.add("certified", "boolean").add("final", "boolean")

        def packed(batches: Iterator[pd.DataFrame], turn: int = turn) -> Iterator[pd.DataFrame]:
            for run in keyed_runs(batches, "share"):
                yield _packed(run, turn, capacity)

        result = written(
            rest.withColumn("share", F.pmod(by, F.lit(shares)).cast("int"))
            .repartition("share").sortWithinPartitions("share").mapInPandas(packed, schema),
            "packed",
        )
        last = turn + 1 == rounds or shares == 1  # no other partition to exchange with
        keep = result if last else result.filter("final")
        done.append(keep.select(*columns, "sequence_id", "offset", "certified"))
        if last:
            break
        rest = result.filter(~F.col("final")).select(*columns, "sequence_id", "offset")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified`` of every piece."""
    return pack(pieces(docs, capacity, 0, vocabulary), capacity).drop("item")
