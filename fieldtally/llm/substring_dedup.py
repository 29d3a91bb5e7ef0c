"""Removal of word sequences that occur earlier in the corpus, through a count-min sketch.

A window is ``words`` consecutive words of one document. Documents lie in units, a few megabytes of text
each, in a table bucketed by unit, so that no later step shuffles a text. Three passes over it:

1. Every unit counts its windows in ``DEPTH`` rows of a count-min sketch and sends, for each shard of a row, the
   cells it touched. A shard adds up what all units sent and answers each with one bit for
   each of its cells: whether the merged count is 2 or more. A sketch only overestimates, so a window that
   has a twin has the bit in all rows; none is lost, and the sketch grows with the text, spread over shards.
2. Windows with the bit in all rows are taken up exactly, by 128-bit hashes of their bytes. Of equal windows within
   a unit the first asks for all; the shard of a hash keeps the first place of the whole corpus and
   answers, by a bit each, which unit has it.
3. Units work out the same windows again, read both answers and remove the words of all windows that
   have an earlier twin.

Every message is one row for a unit and a shard, so a window of very many copies costs a shard
one cell or hash for each unit. Answers are read by their order, which units can tell again from their text.

Defined cases: words are separated by space and U+0009 to U+000D and compared byte by byte; a null or empty text has no
words; a document shorter than a window stays whole; a null doc_id counts as smaller than all others;
places are doc_id and start, so that equal rows (or rows of one doc_id) whose windows have the same place are
not earlier than one another and both stay; an empty table gives no rows; columns beside ``doc_id`` and ``text``
go through, but for ``n_words`` and ``n_removed``, which are replaced in any case of letters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from uuid import uuid4

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm.common import keyed_runs, others, plainly_named, quoted, run_folder, written

#: Bytes of text in a unit, unless one document has more.
UNIT_BYTES = 4 << 20
#: Rows of the sketch, cells of one of its shards, and cells for each window.
DEPTH = 2
CELLS = 1 << 24
CELLS_PER_WINDOW = 4
#: Bytes of a word with its blank, as far as the number of shards goes.
WORD_BYTES = 6

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x5851F42D4C957F2D
_SALTS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0xA0761D6478BD642F))
_FIRST_ID = np.iinfo(np.int64).min

ASKED = "unit long, shard int, row int, asked binary, more binary"
ANSWERED = "unit long, row int, shard int, bits binary"


@cache
def _byte_values() -> np.ndarray:
    """A value for each byte; separators have none."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) | np.uint64(1)
    x[[10, 32]] = 0
    return x


@cache
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.full(count, _BASE, dtype=np.uint64)
    back = np.full(count, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    base[0] = back[0] = 1
    return np.cumprod(base, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _ODD
    x ^= x >> np.uint64(32)
    return x


def plain(text: str | None) -> bytes:
    """The words of a text, joined by one space."""
    return b" ".join(text.encode("utf-8", "surrogatepass").split()) if text else b""


class Windows:
    """All windows of some documents: where they are and a 64-bit hash of each."""

    def __init__(self, texts: list[str | None], words: int):
        self.words = words
        self.data = b"\n".join(map(plain, texts)) + b"\n"
        data = np.frombuffer(self.data, dtype=np.uint8)
        stops = np.flatnonzero((data == 32) | (data == 10))
        starts = np.concatenate(([0], stops[:-1] + 1))
        lines = np.cumsum(data[stops] == 10)
        lines = np.concatenate(([0], lines[:-1]))
        real = stops > starts
        #: Of each word: its bytes and its document.
        self.starts, self.stops, self.doc = starts[real], stops[real], lines[real]
        self.n_words = np.bincount(self.doc, minlength=len(texts))
        self.first_word = np.cumsum(self.n_words) - self.n_words
        n = len(self.starts) - words + 1
        if n <= 0:
            self.at, self.hash = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
            return
        #: Of each window: its first word.
        self.at = np.flatnonzero(self.doc[:n] == self.doc[words - 1 :])
        self.hash = self._combined(self._word_hashes(data), words)[self.at]

    def _word_hashes(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        values = _byte_values()
        step = 1 << 17
        for a in range(0, len(out), step):
            first, last = self.starts[a], self.stops[min(a + step, len(out)) - 1]
            part = values[data[first:last]]
            power, back = _powers(1 << max(20, int(len(part)).bit_length()))
            part *= power[: len(part)]
            begins = self.starts[a : a + step] - first
            out[a : a + step] = np.add.reduceat(part, begins) * back[begins]
        return _mixed(out)

    @staticmethod
    def _combined(hashes: np.ndarray, words: int) -> np.ndarray:
        """Hashes of ``words`` words from each position on, put together from blocks of powers of two."""
        blocks, size, total, done = hashes, 1, None, 0
        n = len(hashes) - words + 1
        while True:
            if words & size:
                part = blocks[done : done + n]
                total = part if total is None else _mixed(total * _STEP + part)
                done += size
            if done == words:
                return total
            blocks = _mixed(blocks[:-size] * _STEP + blocks[size:])
            size *= 2

    def cells(self, row: int, shards: int) -> np.ndarray:
        """Cell of each window in a row of the sketch, shard by shard."""
        x = _mixed(self.hash ^ _SALTS[row])
        shard = ((x >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        return shard * np.uint64(CELLS) + (_mixed(x) >> np.uint64(64 - CELLS.bit_length() + 1))

    def keys(self, chosen: np.ndarray) -> np.ndarray:
        """128-bit hashes of the bytes of the chosen windows, as pairs of numbers."""
        first = self.at[chosen]
        begins, ends = self.starts[first].tolist(), self.stops[first + self.words - 1].tolist()
        data, digest = memoryview(self.data), xxhash.xxh3_128_digest
        joined = b"".join([digest(data[a:b]) for a, b in zip(begins, ends)])
        return np.frombuffer(joined, dtype="<u8").reshape(-1, 2)


def narrow(values: np.ndarray) -> bytes:
    """Numbers that are not negative, in as few bytes each as the largest needs; the first byte tells how many."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    raw = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + raw.tobytes()


def wide(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def _by_shard(cells: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Shard, and from where to where its cells go, of sorted cells."""
    shard = (cells // np.uint64(CELLS)).astype(np.int64)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)])) if len(shard) else [0]
    for a, b in zip(cuts, cuts[1:]):
        yield int(shard[a]), int(a), int(b)


def sketched(windows: Windows, unit: int, shards: int) -> pd.DataFrame:
    """What a unit sends: of each shard of each row the cells it touched, and which of them twice."""
    out = []
    for row in range(DEPTH):
        cells, counts = np.unique(windows.cells(row, shards), return_counts=True)
        for shard, a, b in _by_shard(cells):
            own = cells[a:b] - np.uint64(shard * CELLS)
            steps = np.diff(own, prepend=np.uint64(0))
            out.append((unit, shard, row, narrow(steps), np.packbits(counts[a:b] > 1).tobytes()))
    return pd.DataFrame(out, columns=["unit", "shard", "row", "asked", "more"])


def merged(sent: pd.DataFrame) -> pd.DataFrame:
    """One shard of a row: the units' counts added up, and a bit for each cell of each unit: 2 or more."""
    counts = np.zeros(CELLS, dtype=np.uint8)
    for asked, more in zip(sent["asked"], sent["more"]):
        cells = np.cumsum(wide(asked)).astype(np.int64)
        twice = np.unpackbits(np.frombuffer(more, dtype=np.uint8), count=len(cells))
        # More than two is of no interest, and would not fit.
        counts[cells] = np.minimum(counts[cells] + 1 + twice, 2)
    bits = [np.packbits(counts[np.cumsum(wide(a)).astype(np.int64)] > 1).tobytes() for a in sent["asked"]]
    return pd.DataFrame({"unit": sent["unit"], "row": sent["row"], "shard": sent["shard"], "bits": bits})


def _bits(answers: pd.DataFrame, row: int) -> dict[int, bytes]:
    own = answers[answers["row"] == row]
    return dict(zip(own["shard"].tolist(), own["bits"].tolist()))


def estimated(windows: Windows, answers: pd.DataFrame, shards: int) -> np.ndarray:
    """Windows whose estimated count, the least of the rows', is 2 or more."""
    found = np.ones(len(windows.at), dtype=bool)
    for row in range(DEPTH):
        bits = _bits(answers, row)
        cells, place = np.unique(windows.cells(row, shards), return_inverse=True)
        often = np.empty(len(cells), dtype=bool)
        for shard, a, b in _by_shard(cells):
            often[a:b] = np.unpackbits(np.frombuffer(bits[shard], dtype=np.uint8), count=b - a)
        found &= often[place]
    return np.flatnonzero(found)


class Asking:
    """The estimated windows of a unit as questions: each different one once, by hash, with its first place."""

    def __init__(self, windows: Windows, chosen: np.ndarray, ids: np.ndarray, shards: int):
        self.all_ids = ids
        keys = windows.keys(chosen)
        first = windows.at[chosen]
        self.doc = windows.doc[first]
        self.start = first - windows.first_word[self.doc]
        place = np.lexsort((self.start, ids[self.doc], keys[:, 1], keys[:, 0]))
        keys = keys[place]
        new = np.ones(len(place), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        #: Question of each window in sorted order, and the window that asks.
        self.order, self.question = place, np.cumsum(new) - 1
        self.asking = place[new]
        self.keys = keys[new]
        self.ids = ids[self.doc[self.asking]]
        self.starts = self.start[self.asking]
        self.shard = ((self.keys[:, 0] >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)

    def sent(self, unit: int) -> pd.DataFrame:
        out = []
        cuts = np.searchsorted(self.shard, np.arange(self.shard[-1] + 2)) if len(self.shard) else [0]
        for shard, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                ids = self.ids[a:b]
                # Differences in unsigned arithmetic, since ids go from the smallest number to the largest.
                low = int(ids.min())
                above = ids.astype(np.uint64) - np.uint64(low & (2**64 - 1))
                places = low.to_bytes(8, "little", signed=True) + _two(narrow(above), narrow(self.starts[a:b]))
                out.append((unit, shard, -1, self.keys[a:b].tobytes(), places))
        return pd.DataFrame(out, columns=["unit", "shard", "row", "asked", "more"])

    def removed(self, answers: pd.DataFrame) -> np.ndarray:
        """Of the chosen windows, those with an earlier twin."""
        bits = _bits(answers, -1)
        first = np.empty(len(self.keys), dtype=bool)
        cuts = np.searchsorted(self.shard, np.arange(self.shard[-1] + 2)) if len(self.shard) else [0]
        for shard, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                first[a:b] = np.unpackbits(np.frombuffer(bits[shard], dtype=np.uint8), count=b - a)
        asker = self.asking[self.question]
        same = (self.ids[self.question] == self.all_ids[self.doc[self.order]]) & (
            self.start[asker] == self.start[self.order]
        )
        out = np.empty(len(self.order), dtype=bool)
        out[self.order] = ~(first[self.question] & same)
        return out


def _two(a: bytes, b: bytes) -> bytes:
    return len(a).to_bytes(8, "little") + a + b


def judged(sent: pd.DataFrame) -> pd.DataFrame:
    """One shard of hashes: of each question, whether its place is the first of the corpus."""
    keys = np.concatenate([np.frombuffer(a, dtype="<u8").reshape(-1, 2) for a in sent["asked"]])
    ids, starts, sizes = [], [], []
    for more in sent["more"]:
        low, cut = int.from_bytes(more[:8], "little", signed=True), int.from_bytes(more[8:16], "little")
        above = wide(more[16 : 16 + cut])
        ids.append((above + np.uint64(low & (2**64 - 1))).astype(np.int64))
        starts.append(wide(more[16 + cut :]).astype(np.int64))
        sizes.append(len(above))
    ids, starts = np.concatenate(ids), np.concatenate(starts)
    order = np.lexsort((starts, ids, keys[:, 1], keys[:, 0]))
    sorted_keys = keys[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (sorted_keys[1:] != sorted_keys[:-1]).any(axis=1)
    head = order[new][np.cumsum(new) - 1]
    first = np.empty(len(order), dtype=bool)
    first[order] = (ids[order] == ids[head]) & (starts[order] == starts[head])
    cuts = np.cumsum([0, *sizes])
    bits = [np.packbits(first[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
    return pd.DataFrame({"unit": sent["unit"], "row": sent["row"], "shard": sent["shard"], "bits": bits})


def _ids(docs: pd.DataFrame, name: str) -> np.ndarray:
    return np.array([_FIRST_ID if pd.isna(i) else int(i) for i in docs[name]], dtype=np.int64)


def in_units(docs: DataFrame) -> DataFrame:
    """The documents as a written table, bucketed by ``unit``; ``place`` is their number within it.

    Tasks cut their documents into units as they come; nothing is shuffled.
    """
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("unit", T.LongType()), T.StructField("place", T.IntegerType())])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, size, count = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            units, places = [], []
            for text in batch["text"]:
                length = len(text) if text else 0
                if count and size + length > UNIT_BYTES:
                    now, size, count = now + 1, 0, 0
                units.append(now)
                places.append(count)
                size, count = size + length, count + 1
            out = batch[names].copy()
            out["unit"], out["place"] = np.array(units, dtype=np.int64), np.array(places, dtype=np.int32)
            yield out

    spark = docs.sparkSession
    buckets = max(1, docs.rdd.getNumPartitions())
    name = f"units_{uuid4().hex}"
    (
        docs.mapInPandas(cut, schema).write.format("parquet").bucketBy(buckets, "unit")
        .option("path", run_folder(spark, "units")).option("compression", "zstd").saveAsTable(name)
    )
    return spark.table(name)


def answered(
    sent: DataFrame, number: Column, shards: int, answer: Callable[[pd.DataFrame], pd.DataFrame]
) -> DataFrame:
    """The answers of all shards, each of which is a task of its own: none has to do the work of two."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard in keyed_runs(batches, "number"):
            yield answer(shard)

    numbered = sent.withColumn("number", number.cast("int"))
    return numbered.repartitionById(shards, F.col("number")).mapInPandas(work, ANSWERED)


def drop_repeats(docs: DataFrame, words: int = 20) -> DataFrame:
    """Documents with ``text`` less the words of all windows that start earlier as well.

    Further columns: ``n_words`` before and ``n_removed``; the words that stay are joined by one space.
    """
    docs, named_back = plainly_named(docs.select(quoted(others(docs, "n_words", "n_removed"))), "doc_id", "text")
    units = in_units(docs)
    own = units.select("unit", "place", "doc_id", "text")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-int(total) * CELLS_PER_WINDOW // (WORD_BYTES * CELLS)))

    def windows(group: pd.DataFrame) -> tuple[pd.DataFrame, Windows]:
        group = group.sort_values("place")
        return group, Windows(group["text"].tolist(), words)

    def asking(group: pd.DataFrame, found: Windows, answers: pd.DataFrame) -> tuple[np.ndarray, Asking]:
        chosen = estimated(found, answers, shards)
        return chosen, Asking(found, chosen, _ids(group, "doc_id"), shards)

    def sketch(group: pd.DataFrame) -> pd.DataFrame:
        return sketched(windows(group)[1], int(group["unit"].iat[0]), shards)

    def ask(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if group.empty:
            return pd.DataFrame([], columns=["unit", "shard", "row", "asked", "more"])
        unit_id = int(group["unit"].iat[0])
        group, found = windows(group)
        return asking(group, found, answers)[1].sent(unit_id)

    rows = own.groupBy("unit").applyInPandas(sketch, ASKED)
    often = written(answered(rows, F.col("row") * shards + F.col("shard"), DEPTH * shards, merged), "often")
    questions = own.groupBy("unit").cogroup(often.groupBy("unit")).applyInPandas(ask, ASKED)
    firsts = written(answered(questions, F.col("shard"), shards, judged), "firsts")

    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    names = docs.columns

    def rewrite(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if group.empty:
            return pd.DataFrame([], columns=schema.names)
        group, found = windows(group)
        chosen, questions = asking(group, found, answers)
        change = np.zeros(len(found.starts) + 1, dtype=np.int64)
        gone = found.at[chosen[questions.removed(answers)]]
        np.add.at(change, gone, 1)
        np.add.at(change, gone + words, -1)
        kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
        cuts = np.searchsorted(kept, [*found.first_word, len(found.starts)])
        begins, ends = found.starts[kept].tolist(), found.stops[kept].tolist()
        texts = [
            b" ".join([found.data[begins[i] : ends[i]] for i in range(a, b)]).decode("utf-8", "surrogatepass")
            for a, b in zip(cuts, cuts[1:])
        ]
        out = group[names].copy()
        out["text"] = pd.Series(texts, index=out.index, dtype=object)
        out["n_words"] = found.n_words
        out["n_removed"] = found.n_words - np.diff(cuts)
        return out

    answers = often.unionByName(firsts)
    return named_back(units.groupBy("unit").cogroup(answers.groupBy("unit")).applyInPandas(rewrite, schema))
