"""Maximal periodic runs of words, found from minimizers at many scales.

A run is a stretch of words with smallest period q that no neighbour extends and that is at least
``max(min_words, 2 q)`` words long. Periods below ``LAGS`` come from direct scans: words are compared with
the words one lag further on. Periods from 4 B to 8 B come from the scale of blocks of B words: of
every B neighbouring positions the one whose block has the smallest hash is a minimizer. Inside a run of
period q the minimizer of its first B positions is again one q words on, so that a pair of minimizers
with equal blocks, q apart, seeds it; seeds are extended word by word, so nothing rests on hashes.

Blocks that are themselves periodic with a period of at most B / 4 lie in runs already known, where
minimizers are many. They are left out, and such a run r seeds larger periods in three other ways. Either the run
looked for holds another copy of the place where r begins, or of the place where it ends: the first and the last block
of each known run are seeds. Or it holds neither: then r touches a second run of the same period and
root, and the lags that bring both into step are computed from where the two begin and end.

Each document is searched on its own, many of one task at a time in one array with unlike words between
them. The work of a task is about its words times the logarithm of its longest document.

Defined cases: a null or empty text has no words and no runs; blanks are space and U+0009 to U+000D; words
are compared byte by byte; rows of one doc_id are searched separately; an empty table gives no rows;
columns beside ``text`` go through, but for the result's own names, which are replaced in any case of letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm.common import others, plainly_named, quoted

#: Shorter periods are scanned directly; four blocks of the first scale.
LAGS = 32
BLOCK = LAGS // 4
#: Words that are searched at a time, unless one document has more.
SLICE_WORDS = 400_000

RESULT = (
    ("n_runs", T.LongType()), ("start", T.LongType()), ("length", T.LongType()), ("period", T.LongType()),
    ("runs", T.StringType()),
)

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(29)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _ODD
    x ^= x >> _HALF
    return x


def _wider(blocks: np.ndarray, size: int) -> np.ndarray:
    """Hashes of blocks of twice the size."""
    return _mixed(blocks[:-size] * _STEP + blocks[size:])


def _stretches(positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of consecutive numbers."""
    cuts = np.flatnonzero(np.diff(positions) != 1)
    first = positions[np.concatenate(([0], cuts + 1))]
    last = positions[np.concatenate((cuts, [len(positions) - 1]))]
    return first, last


class _Known:
    """Runs found so far as rows ``start, end, period``, one for each stretch: the smallest period's."""

    def __init__(self):
        self.rows = np.empty((0, 3), dtype=np.int64)
        self.fresh: list[np.ndarray] = []

    def add(self, start, end, period) -> None:
        if len(start):
            self.fresh.append(np.column_stack(np.broadcast_arrays(start, end, period)).astype(np.int64))

    def all(self) -> np.ndarray:
        if self.fresh:
            rows = np.concatenate([self.rows, *self.fresh])
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
            self.rows, self.fresh = rows[new], []
        return self.rows


def _scan_lags(ids: np.ndarray, known: _Known) -> None:
    for lag in range(1, min(LAGS, len(ids))):
        same = np.flatnonzero(ids[lag:] == ids[:-lag])
        if len(same):
            first, last = _stretches(same)
            # Repeats down to one block are kept: they are the known runs of the first scales.
            long = last - first + 1 >= max(lag, BLOCK - lag)
            known.add(first[long], last[long] + 1 + lag, lag)


def _minimizers(blocks: np.ndarray, window: int) -> np.ndarray:
    """Positions with the smallest hash (the first of equal ones) of some ``window`` neighbouring positions."""
    n = len(blocks)
    if n < window:
        return np.empty(0, dtype=np.int64)
    bits = np.uint64((1 << max(1, n.bit_length())) - 1)
    keys = (blocks & ~bits) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // window) * window, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = keys
    rows = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - window + 1], ahead[window - 1 : n])
    places = (least & bits).astype(np.int64)
    return places[np.concatenate(([True], places[1:] != places[:-1]))]


def _pairs(blocks: np.ndarray, seeds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``lag, position`` of seeds with equal blocks that are from 4 to 8 sizes apart.

    A block that is left in has no short period, so it cannot recur more than some thirty times that near.
    """
    key = blocks[seeds]
    order = np.lexsort((seeds, key))
    key, at = key[order], seeds[order]
    lags, places, step = [], [], 1
    while step < len(at):
        apart = at[step:] - at[:-step]
        near = (key[step:] == key[:-step]) & (apart < 8 * size)
        if not near.any():
            break
        chosen = np.flatnonzero(near & (apart >= 4 * size))
        lags.append(apart[chosen])
        places.append(at[chosen])
        step += 1
    if not lags:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(lags), np.concatenate(places)


def _right(ids: np.ndarray, at: int, lag: int) -> int:
    """Where the words from ``at`` on stop being those one lag further on."""
    step, end = 64, len(ids) - lag
    while at < end:
        to = min(at + step, end)
        unlike = ids[at:to] != ids[at + lag : to + lag]
        first = int(unlike.argmax())
        if unlike[first]:
            return at + first
        at, step = to, 2 * step
    return end


def _left(ids: np.ndarray, at: int, lag: int) -> int:
    """The first of the words up to ``at`` that are all those one lag further on."""
    step = 64
    while at > 0:
        to = max(at - step, 0)
        unlike = (ids[to:at] != ids[to + lag : at + lag])[::-1]
        first = int(unlike.argmax())
        if unlike[first]:
            return at - first
        at, step = to, 2 * step
    return 0


def _extend(ids: np.ndarray, lags: np.ndarray, places: np.ndarray, known: _Known) -> None:
    order = np.lexsort((places, lags))
    done_lag = done_to = -1
    rows = []
    for lag, at in zip(lags[order].tolist(), places[order].tolist()):
        if lag == done_lag and at < done_to:
            continue
        end = _right(ids, at, lag)
        start = _left(ids, at, lag)
        done_lag, done_to = lag, max(end, at + 1)
        if end - start >= lag:
            rows.append((start, end + lag, lag))
    if rows:
        known.add(*np.array(rows, dtype=np.int64).T)


def _touching(ids: np.ndarray, runs: np.ndarray, size: int, known: _Known) -> None:
    """Runs of periods from 4 to 8 sizes across two touching runs of one short period and root."""
    runs = runs[np.lexsort((runs[:, 0], runs[:, 2]))]
    one, two = runs[:-1], runs[1:]
    meet = (one[:, 2] == two[:, 2]) & (two[:, 0] <= one[:, 1])
    for (s1, e1, p), (s2, e2, _) in zip(one[meet].tolist(), two[meet].tolist()):
        longest = min(e1 - s1, e2 - s2, 8 * size - 1)
        if longest < 4 * size:
            continue
        doubled, root = ids[s1 : s1 + 2 * p], ids[s2 : s2 + p]
        for turn in np.flatnonzero(doubled[:p] == root[0]).tolist():
            if np.array_equal(doubled[turn : turn + p], root):
                break
        else:
            continue
        first = 4 * size + (s2 - s1 - turn - 4 * size) % p
        lags = np.arange(first, longest + 1, p, dtype=np.int64)
        aligned = (s2 - lags == s1) | (e2 - lags == e1)
        _extend(ids, lags[aligned], np.maximum(s1, s2 - lags[aligned]), known)
        lags = lags[~aligned]
        start, end = np.maximum(s1, s2 - lags), np.minimum(e1, e2 - lags)
        whole = end - start >= lags
        known.add(start[whole], (end + lags)[whole], lags[whole])


def find_runs(ids: np.ndarray, lengths: np.ndarray, min_words: int) -> np.ndarray:
    """Rows ``start, end, period`` of all runs, by start, then period.

    ``ids`` holds documents one after the other, longest first, each with one id of its own kind behind
    it; ``lengths`` are the documents' lengths with that id.
    """
    known = _Known()
    _scan_lags(ids, known)
    ends = np.cumsum(lengths)
    blocks, size = _mixed(ids.astype(np.uint64) + np.uint64(1)), 1
    while True:
        # Documents that can hold a run of this scale come first.
        fit = int(np.searchsorted(-lengths, -(8 * size), side="right"))
        if size >= BLOCK:
            if not fit or ends[fit - 1] < 8 * size:
                break
            part = ids[: ends[fit - 1]]
            blocks = blocks[: len(part) - size + 1]
            runs = known.all()
            runs = runs[(4 * runs[:, 2] <= size) & (runs[:, 1] - runs[:, 0] >= size) & (runs[:, 1] <= len(part))]
            seeds = _minimizers(blocks, size)
            if len(runs):
                inside = np.zeros(len(blocks) + 1, dtype=np.int64)
                np.add.at(inside, runs[:, 0], 1)
                np.add.at(inside, runs[:, 1] - size + 1, -1)
                seeds = seeds[np.cumsum(inside)[seeds] == 0]
            lags, places = _pairs(blocks, seeds, size)
            # Two blocks behind each other fit before the copy of the first seed of a run.
            after = np.minimum(places + size, len(blocks) - 1), np.minimum(places + lags + size, len(blocks) - 1)
            again = blocks[after[0]] == blocks[after[1]]
            _extend(part, lags[again], places[again], known)
            if len(runs):
                edges = np.unique(np.concatenate((runs[:, 0], runs[:, 1] - size)))
                _extend(part, *_pairs(blocks, edges, size), known)
                _touching(part, runs, size, known)
        elif len(blocks) <= size:
            break
        if len(blocks) <= size:
            break
        blocks, size = _wider(blocks, size), 2 * size
    runs = known.all()
    runs = runs[runs[:, 1] - runs[:, 0] >= np.maximum(min_words, 2 * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def runs_of(documents: list[list[bytes]], min_words: int) -> list[np.ndarray]:
    """Rows ``start, end, period`` for each list of words."""
    counts = np.array([len(words) for words in documents], dtype=np.int64)
    order = np.argsort(-counts, kind="stable")
    known, parts = _Ids(), []
    for place, i in enumerate(order.tolist()):
        parts.append(np.fromiter(map(known.__getitem__, documents[i]), dtype=np.int64, count=counts[i]))
        parts.append(np.array([-1 - place]))
    lengths = counts[order] + 1
    runs = find_runs(np.concatenate(parts), lengths, min_words) if parts else np.empty((0, 3), dtype=np.int64)
    begins = np.cumsum(lengths) - lengths
    owner = np.searchsorted(begins, runs[:, 0], side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(order) + 1))
    out: list[np.ndarray] = [runs[:0]] * len(documents)
    for place, i in enumerate(order.tolist()):
        own = runs[cuts[place] : cuts[place + 1]].copy()
        own[:, :2] -= begins[place]
        out[i] = own
    return out


def _collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds behind its first period."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        words = words_of(text)
        if held and size + len(words) > SLICE_WORDS:
            yield first, held
            first, held, size = i, [], 0
        held.append(words)
        size += len(words) + 1
    if held:
        yield first, held


def collapse_runs(docs: DataFrame, min_words: int = 12) -> DataFrame:
    """Documents with ``text`` less the repetitions (words joined by one space, empty for null).

    Further columns: ``n_runs``; ``start, length, period`` of the longest run (of equal ones the first, then
    the one of smallest period; null without any), in words from 0; ``runs``, a line ``start,length,period``
    for each run, by start and period.
    """
    docs, named_back = plainly_named(docs.select(quoted(others(docs, *(name for name, _ in RESULT)))), "text")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(name, kind) for name, kind in RESULT)])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, documents in _slices(batch["text"].tolist()):
                out = batch.iloc[first : first + len(documents)].copy()
                texts, rows = [], []
                for words, runs in zip(documents, runs_of(documents, min_words)):
                    if not len(runs):
                        texts.append(b" ".join(words))
                        rows.append((0, None, None, None, ""))
                        continue
                    texts.append(b" ".join(_collapsed(words, runs)))
                    lengths = runs[:, 1] - runs[:, 0]
                    best = int(lengths.argmax())
                    listed = "".join(f"{s},{e - s},{p}\n" for s, e, p in runs.tolist())
                    rows.append((len(runs), int(runs[best, 0]), int(lengths[best]), int(runs[best, 2]), listed))
                out["text"] = pd.Series([t.decode("utf-8", "surrogatepass") for t in texts], index=out.index, dtype=object)
                for (name, kind), values in zip(RESULT, zip(*rows)):
                    as_type = "object" if isinstance(kind, T.StringType) else "Int64"
                    out[name] = pd.Series(values, index=out.index, dtype=as_type)
                yield out

    return named_back(docs.mapInPandas(search, schema))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth (by crc32 of the decimal doc_id) ends in a repetition.

    With n words, h = crc32, g = h // 10, each word i >= a becomes word a + (i - a) % p of the text,
    a = g % n, p = 1 + (n - a) // (3 + g % 8). Words of these texts are joined by one space. A null doc_id plants
    nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % F.greatest(n, F.lit(1))
        p = 1 + F.floor((n - a) / (3 + g % 8))

        def place(i: Column) -> Column:
            return F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")

        return F.array_join(F.transform(words, lambda _, i: F.get(words, place(i))), " ")

    # As the only element of a list the words are a variable, which is worked out once and not for each word.
    planted = F.get(F.transform(F.array(words), repeated), F.lit(0))
    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.withColumn("text", F.when(chosen, planted).otherwise(F.col("text")))
