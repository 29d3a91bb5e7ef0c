"""Exact top-k by inner product, over candidates sorted by length.

Candidates lie in blocks by descending length. They and the queries are turned by the singular vectors
of the candidates' Gram matrix, so the first coordinates hold most of every product. A task walks the
blocks of its share from the longest vectors on and keeps each query's k best. A block is skipped
where even its longest vector cannot reach the k-th best (Cauchy-Schwarz), and in a block a candidate
is multiplied out only if the product of the first coordinates and the product of the lengths of the
rest can. What is left is scored in whole numbers.

Each query starts with the k-th best score among one block of the longest candidates, so every
task prunes from the beginning, whatever its share.

Defined cases: vectors that are null or empty or have a null or non-finite component take no part;
ties go to the smaller id; a query's own id is no candidate, rows that repeat another id are
candidates each, and a repeated query is asked once; vectors are compared with those of their length; fewer than k candidates are all
returned; an empty table gives no rows; other columns are not looked at. Scores are 64-bit numbers: a product
beyond them, which takes components of over a hundred million, fails the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import keyed_runs, written

K, SCALE, QUERIES_EVERY = 20, 64, 20
CANDIDATE_ROWS, QUERY_ROWS, SHARE_BLOCKS = 4096, 1024, 64


def whole(vectors: list) -> np.ndarray:
    """floor(SCALE * x) of components read as doubles."""
    return np.floor(SCALE * np.stack(vectors).astype(np.float64))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all whole rows of ``a`` with all of ``b``, exact: in doubles where they hold every sum."""
    reach = _reach(a, b)
    if reach < 2**53:
        return (a @ b.T).astype(np.int64)
    if reach < 2**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return _as_long(_ints(a) @ _ints(b).T)


def row_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole rows of ``a`` and ``b`` at the same places, exact."""
    if _reach(a, b) < 2**63:
        return np.einsum("nd,nd->n", a.astype(np.int64), b.astype(np.int64))
    return _as_long((_ints(a) * _ints(b)).sum(axis=1))


def _reach(a: np.ndarray, b: np.ndarray) -> float:
    return np.abs(a).max() * np.abs(b).max() * a.shape[1] if a.size and b.size else 0.0


def _ints(rows: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in rows.tolist()], dtype=object).reshape(rows.shape)


def _as_long(scores: np.ndarray) -> np.ndarray:
    if any(abs(s) >= 2**63 for s in scores.ravel().tolist()):
        raise OverflowError("an inner product is beyond 64 bits, in which scores are returned")
    return scores.astype(np.int64)


def best(query: np.ndarray, ident: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query, by score and then the smaller id."""
    order = np.lexsort((ident, -score, query))
    q = query[order]
    starts = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return order[rank < k]


class Kept:
    """The k best of a block of queries so far."""

    def __init__(self, ids: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.floor, self.k = ids, floor.astype(np.float64), k
        self.query, self.ident, self.score = (np.empty(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, ident: np.ndarray, score: np.ndarray) -> None:
        own = ident != self.ids[query]
        query = np.concatenate((self.query, query[own]))
        ident = np.concatenate((self.ident, ident[own]))
        score = np.concatenate((self.score, score[own]))
        chosen = best(query, ident, score, self.k)
        self.query, self.ident, self.score = query[chosen], ident[chosen], score[chosen]
        ends = np.flatnonzero(np.append(self.query[1:] != self.query[:-1], True)) if len(self.query) else []
        counts = np.bincount(self.query, minlength=len(self.ids))
        full = [e for e in ends if counts[self.query[e]] >= self.k]
        self.floor[self.query[full]] = np.maximum(self.floor[self.query[full]], self.score[full])


def search(kept: Kept, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, turn: np.ndarray, lead: int) -> None:
    """Take a block of candidates, longest first, into what is kept."""
    lengths_q, longest = np.sqrt((queries**2).sum(axis=1)), np.sqrt((rows[0] ** 2).sum())
    live = np.flatnonzero(lengths_q * longest * (1 + 1e-9) + 1e-6 >= kept.floor)
    if not len(live):
        return
    q, x = queries[live] @ turn, rows @ turn
    rest_q, rest_x = (np.sqrt((v[:, lead:] ** 2).sum(axis=1)) for v in (q, x))
    most = q[:, :lead] @ x[:, :lead].T + rest_q[:, None] * rest_x[None, :]
    slack = 1e-9 * (lengths_q[live][:, None] * longest) + 1e-6
    i, j = np.nonzero(most + slack >= kept.floor[live][:, None])
    if not len(i):
        return
    if 4 * len(i) > len(live) * len(rows):
        scores = product(queries[live], rows)[i, j]
    else:
        scores = np.concatenate([
            row_products(queries[live[i[a : a + 50_000]]], rows[j[a : a + 50_000]])
            for a in range(0, len(i), 50_000)
        ])
    above = scores >= kept.floor[live[i]]
    kept.add(live[i[above]], ids[j[above]], scores[above])


def _bytes(vectors: np.ndarray) -> bytes:
    """Rows in two bytes a component where they fit, else eight."""
    small = not vectors.size or np.abs(vectors).max() < 2**15
    return vectors.astype("<i2" if small else "<f8").tobytes()


def _matrix(data: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, "<i2" if len(data) == 2 * n * dim else "<f8").reshape(n, dim).astype(np.float64)


def _packed(rows: pd.DataFrame) -> dict:
    vectors = np.stack(rows["whole"].to_numpy())
    return {"ids": rows["vec_id"].to_numpy().astype("<i8").tobytes(), "data": _bytes(vectors)}


def _slices(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Rows of one length in order, ``rows`` at a time."""
    held = pd.DataFrame()
    for batch in batches:
        for _, some in batch.groupby("dim", sort=True):
            if len(held) and held["dim"].iat[0] != some["dim"].iat[0]:
                yield held
                held = pd.DataFrame()
            held = pd.concat([held, some]) if len(held) else some
            while len(held) >= rows:
                yield held.iloc[:rows]
                held = held.iloc[rows:]
    if len(held):
        yield held


def top_k(rows: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score`` for queries ``vec_id % QUERIES_EVERY = 0`` against all rows."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    values = F.transform(x, lambda v: F.floor(F.lit(float(SCALE)) * v.cast("double")).cast("double"))
    whole_rows = written(
        rows.filter(F.col("vec_id").isNotNull() & (F.size(x) > 0) & finite)
        .select("vec_id", F.size(x).alias("dim"), values.alias("whole"))
        .withColumn("length", F.aggregate("whole", F.lit(0.0), lambda a, v: a + v * v)),
        "vectors",
    )

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, some in batch.groupby("dim"):
                m = np.stack(some["whole"].to_numpy())
                sums[dim] = sums.get(dim, 0) + m.T @ m
        for dim, gram in sums.items():
            yield pd.DataFrame({"dim": dim, "row": np.arange(dim), "total": [r.tobytes() for r in gram]})

    def added(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(r, "<f8") for r in group["total"]], axis=0)
        return pd.DataFrame({"dim": group["dim"].iloc[:1], "row": group["row"].iloc[:1], "total": [total.tobytes()]})

    # A matrix for each length of vectors in use, of which tables have few, however many rows there are.
    gram_row = "dim int, row long, total binary"
    totals = (
        whole_rows.select("dim", "whole").mapInPandas(grams, gram_row)
        .groupBy("dim", "row").applyInPandas(added, gram_row).toPandas()
    )
    turns, leads = {}, {}
    for dim, own in totals.groupby("dim"):
        gram = np.stack([np.frombuffer(r, "<f8") for r in own.sort_values("row")["total"]])
        weights, vectors = np.linalg.eigh(gram)
        turns[dim] = np.ascontiguousarray(vectors[:, ::-1])
        shares = np.cumsum(weights[::-1]) / max(weights.sum(), 1e-30)
        leads[dim] = int(min(dim, max(1, np.searchsorted(shares, 0.9) + 1)))

    def pack_candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        for part in _slices(batches, CANDIDATE_ROWS):
            yield pd.DataFrame([{
                "dim": part["dim"].iat[0], "number": number, "longest": part["length"].iat[0], **_packed(part)
            }])
            number += 1

    schema = "dim int, number long, longest double, ids binary, data binary"
    order = [F.col("dim"), F.col("length").desc(), F.col("vec_id")]
    candidates = written(
        whole_rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(pack_candidates, schema),
        "candidates",
    )
    # One block for each vector length in use, CANDIDATE_ROWS rows at most.
    first = candidates.groupBy("dim").agg(F.max_by(F.struct("ids", "data"), F.struct("longest", -F.col("number"))).alias("b"))
    starts = {}
    for row in first.collect():
        ids = np.frombuffer(row["b"]["ids"], "<i8")
        starts[row["dim"]] = ids, _matrix(row["b"]["data"], row["dim"], len(ids))

    queries = (
        whole_rows.filter(F.col("vec_id") % QUERIES_EVERY == 0)
        .groupBy("vec_id").agg(F.min(F.struct("dim", "whole")).alias("q")).select("vec_id", "q.dim", "q.whole")
    )
    groups = max(1, -(-queries.count() // QUERY_ROWS))

    def pack_queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in keyed_runs(batches, "group"):
            for dim, part in run.groupby("dim"):
                packed = _packed(part)
                ids, q = np.frombuffer(packed["ids"], "<i8"), np.stack(part["whole"].to_numpy())
                kept = Kept(ids, np.full(len(ids), -np.inf), k)
                c_ids, c = starts[dim]
                for at in range(0, len(ids), 256):
                    own = Kept(ids[at : at + 256], np.full(len(ids[at : at + 256]), -np.inf), k)
                    search(own, q[at : at + 256], c_ids, c, turns[dim], leads[dim])
                    kept.floor[at : at + 256] = own.floor
                floor = kept.floor.astype("<f8").tobytes()
                # The squared length that a candidate must have to reach any query's floor; none if one has none yet.
                size = np.sqrt((q * q).sum(axis=1))
                needed = np.where(kept.floor > 0, kept.floor * (1 - 1e-8) / np.maximum(size, 1e-300), 0).min()
                yield pd.DataFrame([{
                    "dim": dim, "group": run["group"].iat[0], "q_ids": packed["ids"], "q_data": packed["data"],
                    "floor": floor, "needed": float(needed) ** 2 * (1 - 1e-8),
                }])

    packed_queries = written(
        queries.withColumn("group", F.pmod(F.xxhash64("vec_id", F.lit("query")), F.lit(groups)).cast("int"))
        .repartition("group").sortWithinPartitions("group")
        .mapInPandas(pack_queries, "dim int, group int, q_ids binary, q_data binary, floor binary, needed double"),
        "queries",
    )
    n_blocks = candidates.count()
    shares = max(1, -(-n_blocks // SHARE_BLOCKS))
    # Stated queries against all rows, in blocks: a block of candidates goes to the blocks of queries that its
    # longest vector can still matter to, and a block of queries to each share of them.
    shared = candidates.withColumn("share", F.pmod(F.xxhash64("number", F.lit("share")), F.lit(shares)).cast("int"))
    wanted = packed_queries.select(F.col("dim").alias("d"), "group", "needed")
    tasks = packed_queries.drop("needed").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    met = (
        shared.join(wanted, (F.col("dim") == F.col("d")) & (F.col("longest") >= F.col("needed"))).drop("d", "needed")
        .join(tasks, ["dim", "group", "share"])
        .withColumn("task", F.xxhash64("dim", "group", "share"))
        .repartition("task").sortWithinPartitions("task", "dim", "group", "share", F.col("longest").desc(), "number")
    )

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, kept, q = None, None, None

        def out() -> pd.DataFrame:
            return pd.DataFrame({"query_id": kept.ids[kept.query], "vec_id": kept.ident, "score": kept.score})

        for batch in batches:
            for row in batch.itertuples(index=False):
                if at != (row.dim, row.group, row.share):
                    if kept is not None:
                        yield out()
                    at = (row.dim, row.group, row.share)
                    kept = Kept(np.frombuffer(row.q_ids, "<i8"), np.frombuffer(row.floor, "<f8"), k)
                    q = _matrix(row.q_data, row.dim, len(kept.ids))
                ids = np.frombuffer(row.ids, "<i8")
                c = _matrix(row.data, row.dim, len(ids))
                for a in range(0, len(c), 1024):
                    search(kept, q, ids[a : a + 1024], c[a : a + 1024], turns[row.dim], leads[row.dim])
        if kept is not None:
            yield out()

    found = met.mapInPandas(walk, "query_id long, vec_id long, score long")
    return ranked(found, k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """Of each query's finds, at most k for each share of the candidates, the k best."""
    from pyspark.sql import Window

    by = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )
