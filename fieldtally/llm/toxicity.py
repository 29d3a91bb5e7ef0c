"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as its embedding in the vocabulary of the training rows beside the mean of its letter
trigrams' embeddings, so unknown spellings are read by their letters. Two gated recurrent layers read a
window of words forwards and backwards, attention weighs the states, and a logistic unit scores the
sum. All overlapping windows of the whole text are scored and the highest counts.

Training rows are a bounded sample, by parameters of ``train``: at most ``positives`` and ``negatives``
labelled documents by the hash of their ids, of each at most ``windows`` windows. Labels belong to documents;
after two rounds over all windows of the sample, each document teaches by its highest one. A fifth of the
sample chooses the round that is kept. Words of the vocabulary are in at least ``VOCABULARY_DOCS`` documents of
the sample, so a small sample is learned by letters alone. Scoring has no bounds: it reads every window.

Defined cases: null and empty texts are scored as an empty window; without labels of both kinds the score is the
share of label 1 (or 0); a document labelled twice has the higher label; repeated rows get the same score;
texts of any length are scored whole; other columns go through.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import others, quoted

#: Bounds of the training sample: documents with label 1 and 0, and windows of each.
POSITIVES, NEGATIVES, WINDOWS = 1500, 3000, 12
#: A word of the vocabulary is in at least ``VOCABULARY_DOCS`` documents of the sample.
VOCABULARY, VOCABULARY_DOCS, TRIGRAMS = 5000, 20, 4096
WINDOW, STRIDE = 40, 32
WORD, CHAR, HIDDEN = 8, 8, 8
RATE = 0.015
#: Share of the words that training shows as unknown, so that spelling is learned as well.
HIDE = 0.5
DECAY = 1e-4
WORDS = re.compile(r"\w+")
#: Words that a worker remembers before it starts over.
REMEMBERED = 300_000


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def windows_of(n: int) -> np.ndarray:
    """Starts of the windows that cover ``n`` words; at least one."""
    return np.arange(0, max(n - WINDOW + STRIDE, STRIDE), STRIDE) if n > WINDOW else np.zeros(1, np.int64)


def trigram_places(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the letter trigrams of framed words, and where each word's begin."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    grams = (codes[:-2] * 1_000_003 + codes[1:-1]) * 1_000_003 + codes[2:]
    grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    inside = np.ones(len(codes), bool)
    inside[ends - 1] = inside[ends - 2] = False
    starts = np.concatenate(([0], np.cumsum(lengths - 2)[:-1]))
    return (grams[inside[: len(grams)]] % np.uint64(TRIGRAMS)).astype(np.int64), starts


def shut(n: int) -> np.ndarray:
    """Projected inputs that leave the state as it is."""
    out = np.zeros((n, 3 * HIDDEN), np.float32)
    out[:, :HIDDEN] = -60
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Weights by name, forward and backward passes over windows of word numbers."""

    def __init__(self, vocabulary: list[str], seed: int = 4):
        rng = np.random.default_rng(seed)
        self.vocabulary = {w: i + 1 for i, w in enumerate(vocabulary)}  # 0: unknown
        size = WORD + CHAR
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.w = {
            "word": (rng.normal(0, 0.3, (len(vocabulary) + 1, WORD))).astype(np.float32),
            "char": (rng.normal(0, 0.6, (TRIGRAMS, CHAR))).astype(np.float32),
            "att": draw(2 * HIDDEN, 1)[:, 0],
            "out": draw(2 * HIDDEN, 1)[:, 0],
            "bias": np.full(1, -1, np.float32),
        }
        for side in "fb":
            self.w |= {
                f"x{side}": draw(size, 3 * HIDDEN), f"h{side}": draw(HIDDEN, 3 * HIDDEN),
                f"b{side}": np.zeros(3 * HIDDEN, np.float32),
            }

    def features(self, words: list[str], hidden: np.ndarray | None = None) -> tuple[np.ndarray, dict]:
        """Input vectors of words, those ``hidden`` as unknown; what the gradient needs."""
        ids = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        if hidden is not None:
            ids[hidden] = 0
        grams, starts = trigram_places(words)
        counts = np.diff(np.append(starts, len(grams))).astype(np.float32)[:, None]
        char = np.add.reduceat(self.w["char"][grams], starts, axis=0) / counts
        kept = {"ids": ids, "grams": grams, "counts": counts}
        return np.concatenate((self.w["word"][ids], char), axis=1), kept

    def run(self, inputs: dict[str, np.ndarray], index: np.ndarray, keep: bool = False):
        """Logits of windows. ``inputs``: projected vectors of words by side, the last row for places
        beyond a text's end; ``index``: windows of rows in them, -1 there."""
        n, steps = index.shape
        real = index >= 0
        states = {side: np.zeros((steps, n, HIDDEN), np.float32) for side in "fb"}
        trace: dict = {"f": [], "b": []}
        for side in "fb":
            h = np.zeros((n, HIDDEN), np.float32)
            weights = self.w[f"h{side}"]
            gate_weights, new_weights = weights[:, : 2 * HIDDEN], weights[:, 2 * HIDDEN :]
            source = inputs[side]
            for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
                x = source[index[:, t]]
                gates = sigmoid(x[:, : 2 * HIDDEN] + h @ gate_weights)
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                rh = r * h
                c = np.tanh(x[:, 2 * HIDDEN :] + rh @ new_weights)
                on = real[:, t, None]
                after = np.where(on, h + z * (c - h), h)
                if keep:
                    trace[side].append((t, h, z, r, c, rh, on))
                h = after
                states[side][t] = h
        both = np.concatenate((states["f"], states["b"]), axis=2)
        scores = both @ self.w["att"]
        scores[~real.T] = -1e4
        scores -= scores.max(axis=0)
        weight = np.exp(scores)
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, both)
        logits = pooled @ self.w["out"] + self.w["bias"][0]
        return (logits, (both, weight, pooled, trace)) if keep else logits

    def logits(self, inputs: dict[str, np.ndarray], index: np.ndarray) -> np.ndarray:
        """As ``run``, both directions in one step; where a text has ended the update gate is shut."""
        n, steps = index.shape
        two = 2 * HIDDEN
        gates, new = np.zeros((2 * two, two), np.float32), np.zeros((two, two), np.float32)
        for i, side in enumerate("fb"):  # rows: update f, b, reset f, b; columns: state f, b
            own, weights = slice(i * HIDDEN, (i + 1) * HIDDEN), self.w[f"h{side}"]
            gates[own, own] = weights[:, :HIDDEN].T
            gates[two:][own, own] = weights[:, HIDDEN:two].T
            new[own, own] = weights[:, two:].T
        h = np.zeros((two, n), np.float32)
        both = np.empty((steps, two, n), np.float32)
        x = np.empty((3, 2, HIDDEN, n), np.float32)
        flat = x.reshape(3 * two, n)
        turned = np.ascontiguousarray(index.T)
        for t in range(steps):
            x[:, 0] = inputs["f"].take(turned[t], axis=0, mode="wrap").T.reshape(3, HIDDEN, n)
            x[:, 1] = inputs["b"].take(turned[steps - 1 - t], axis=0, mode="wrap").T.reshape(3, HIDDEN, n)
            g = gates @ h
            g += flat[: 2 * two]
            np.negative(g, out=g)
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            c = new @ (g[two:] * h)
            c += flat[2 * two :]
            np.tanh(c, out=c)
            c -= h
            c *= g[:two]
            h = h + c
            both[t, :HIDDEN] = h[:HIDDEN]
            both[steps - 1 - t, HIDDEN:] = h[HIDDEN:]
        scores = np.einsum("thn,h->tn", both, self.w["att"])
        scores[(index < 0).T] = -1e4
        scores -= scores.max(axis=0)
        weight = np.exp(scores)
        weight /= weight.sum(axis=0)
        values = np.einsum("thn,h->tn", both, self.w["out"])
        return (values * weight).sum(axis=0) + self.w["bias"][0]

    def project(self, features: np.ndarray) -> dict[str, np.ndarray]:
        empty = shut(1)
        return {s: np.concatenate((features @ self.w[f"x{s}"] + self.w[f"b{s}"], empty)) for s in "fb"}

    def all_inputs(self, words: list[str], at_once: int = 20_000) -> dict[str, np.ndarray]:
        """The projected vectors of many words, in slices."""
        out = {s: shut(len(words) + 1) for s in "fb"}
        for at in range(0, len(words), at_once):
            features, _ = self.features(words[at : at + at_once])
            for side in "fb":
                out[side][at : at + len(features)] = features @ self.w[f"x{side}"] + self.w[f"b{side}"]
        return out

    def gradient(
        self, words: list[str], index: np.ndarray, labels: np.ndarray, hidden: np.ndarray | None = None
    ) -> tuple[float, dict]:
        """Mean logistic loss of the windows and its gradient by weight."""
        features, seen = self.features(words, hidden)
        logits, (both, weight, pooled, trace) = self.run(self.project(features), index, keep=True)
        n = len(labels)
        p = sigmoid(logits)
        loss = float(np.mean(np.logaddexp(0, logits) - labels * logits))
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        d_logit = ((p - labels) / n).astype(np.float32)
        g["bias"][0] = d_logit.sum()
        g["out"] = d_logit @ pooled
        d_pooled = d_logit[:, None] * self.w["out"]
        d_weight = np.einsum("tnh,nh->tn", both, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["att"] = np.einsum("tn,tnh->h", d_score, both)
        d_both = weight[:, :, None] * d_pooled + d_score[:, :, None] * self.w["att"]
        d_features = np.zeros_like(features)
        for side, at in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            weights, d_h = self.w[f"h{side}"], np.zeros((n, HIDDEN), np.float32)
            d_source = np.zeros((len(features) + 1, 3 * HIDDEN), np.float32)
            for t, h, z, r, c, rh, on in reversed(trace[side]):
                d_h = d_h + d_both[t][:, at]
                live = np.where(on, d_h, 0)
                d_c = live * z * (1 - c * c)
                d_z = live * (c - h) * z * (1 - z)
                d_rh = d_c @ weights[:, 2 * HIDDEN :].T
                d_r = d_rh * h * r * (1 - r)
                d_gates = np.concatenate((d_z, d_r), axis=1)
                g[f"h{side}"][:, : 2 * HIDDEN] += h.T @ d_gates
                g[f"h{side}"][:, 2 * HIDDEN :] += rh.T @ d_c
                np.add.at(d_source, index[:, t], np.concatenate((d_gates, d_c), axis=1))
                d_h = np.where(on, live * (1 - z) + d_rh * r + d_gates @ weights[:, : 2 * HIDDEN].T, d_h)
            d_source = d_source[:-1]
            g[f"x{side}"] = features.T @ d_source
            g[f"b{side}"] = d_source.sum(axis=0)
            d_features += d_source @ self.w[f"x{side}"].T
        np.add.at(g["word"], seen["ids"], d_features[:, :WORD])
        d_char = np.repeat(d_features[:, WORD:] / seen["counts"], seen["counts"][:, 0].astype(int), axis=0)
        np.add.at(g["char"], seen["grams"], d_char)
        return loss, g


def fit(windows: list[list[str]], labels: np.ndarray, rounds: int = 12, batch: int = 128) -> Network:
    """A network from documents' windows (words with a space between) and their labels."""
    seen: dict[str, int] = {}
    for doc in windows:
        for w in {w for window in doc for w in window.split(" ") if w}:
            seen[w] = seen.get(w, 0) + 1
    vocabulary = sorted((w for w, n in seen.items() if n >= VOCABULARY_DOCS), key=lambda w: (-seen[w], w))[:VOCABULARY]
    net = Network(vocabulary)
    places: dict[str, int] = {}
    flat = [(d, window) for d, doc in enumerate(windows) for window in doc]
    owner = np.array([d for d, _ in flat])
    index = np.full((len(flat), WINDOW), -1, np.int64)
    for i, (_, window) in enumerate(flat):
        own = [places.setdefault(w, len(places)) for w in window.split(" ") if w]
        index[i, : len(own)] = own
    words = list(places)
    rng = np.random.default_rng(44)
    first, second = ({k: np.zeros_like(v) for k, v in net.w.items()} for _ in range(2))
    checked = np.arange(len(labels)) % 5 == 4
    best, kept, since, turn = np.inf, net.w, 0, 0
    for epoch in range(rounds):
        inputs = net.all_inputs(words)
        logits = np.concatenate([net.logits(inputs, index[i : i + 1024]) for i in range(0, len(flat), 1024)])
        highest = np.full(len(labels), -np.inf)
        np.maximum.at(highest, owner, logits)
        loss = (np.logaddexp(0, highest) - labels * highest)[checked].mean()
        if epoch > 2:
            if loss < best:
                best, kept, since = loss, {k: v.copy() for k, v in net.w.items()}, 0
            elif (since := since + 1) > 2:
                break
        if epoch < 2:
            chosen = rng.permutation(len(flat))
            chosen = chosen[~checked[owner[chosen]]]
        else:
            order = np.lexsort((logits, owner))
            top = order[np.append(owner[order][1:] != owner[order][:-1], True)]
            chosen = rng.permutation(top[~checked[owner[top]]])
        for at in range(0, len(chosen), batch):
            some = chosen[at : at + batch]
            used, local = np.unique(index[some], return_inverse=True)
            local = local.reshape(len(some), WINDOW)
            if used[0] == -1:
                used, local = used[1:], local - 1
            own = [words[i] for i in used] or [""]
            _, g = net.gradient(
                own, local, labels[owner[some]].astype(np.float32), rng.random(len(own)) < HIDE
            )
            turn += 1
            for k, value in g.items():
                first[k] += 0.1 * (value - first[k])
                second[k] += 0.005 * (value * value - second[k])
                step = first[k] / (1 - 0.9**turn) / (np.sqrt(second[k] / (1 - 0.995**turn)) + 1e-7)
                net.w[k] -= (RATE * step + DECAY * net.w[k]).astype(np.float32)
    net.w = kept
    return net


def sample(
    docs: DataFrame, labels: DataFrame, label: str, positives: int, negatives: int, windows: int
) -> tuple[list[list[str]], np.ndarray]:
    """Windows and labels of the bounded sample of labelled documents."""
    rated = (
        labels.select("doc_id", F.col(label).cast("int").alias("rated"))
        .filter(F.col("doc_id").isNotNull() & F.col("rated").isin(0, 1))
        .groupBy("doc_id").agg(F.max("rated").alias("rated"))
    )
    order = F.md5(F.col("doc_id").cast("string"))
    chosen = [
        row for value, most in ((1, positives), (0, negatives))
        for row in rated.filter(F.col("rated") == value).orderBy(order).limit(most).collect()
    ]
    known = {row["doc_id"]: row["rated"] for row in chosen}
    ids = docs.sparkSession.createDataFrame([(k,) for k in known], "doc_id long")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = words_of(text)
                starts = windows_of(len(words))
                rng = np.random.default_rng(zlib.crc32(str(doc_id).encode()))
                for at in rng.permutation(starts)[:windows].tolist():
                    rows.append((doc_id, " ".join(words[at : at + WINDOW])))
            yield pd.DataFrame(rows, columns=["doc_id", "words"])

    # At most positives + negatives ids, so the broadcast is bounded; and of each id, however
    # often it is repeated, at most that many windows, so is what comes to the driver.
    own = Window.partitionBy("doc_id").orderBy("words")
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
        .mapInPandas(cut, "doc_id long, words string")
        .withColumn("place", F.row_number().over(own)).filter(F.col("place") <= windows)
        .select("doc_id", "words").toPandas()
    )
    by_doc = {doc_id: sorted(own) for doc_id, own in rows.groupby("doc_id")["words"]}
    ordered = sorted(by_doc)
    return [by_doc[d] for d in ordered], np.array([known[d] for d in ordered], np.int64)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    windows: int = WINDOWS,
) -> Network | float:
    """A network, or the share of label 1 where the sample has one kind only."""
    texts, rated = sample(docs, labels, label, positives, negatives, windows)
    if len(set(rated.tolist())) < 2:
        return float(rated.mean()) if len(rated) else 0.0
    return fit(texts, rated)


class Scorer:
    """Scores texts; words' projected inputs are remembered."""

    def __init__(self, net: Network):
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.new: list[str] = []
        self.filled = 0
        self.inputs = {s: shut(1 << 14) for s in "fb"}
        places, new = self.places, self.new

        class Known(dict):
            def __missing__(self, word: str) -> int:
                self[word] = place = len(self)
                new.append(word)
                return place

        self.places = Known(places)

    def _project(self) -> None:
        if not self.new:
            return
        features, _ = self.net.features(self.new)
        end = self.filled + len(self.new)
        for side in "fb":
            if end + 1 > len(self.inputs[side]):
                grown = shut(2 * end)
                grown[: self.filled] = self.inputs[side][: self.filled]
                self.inputs[side] = grown
            self.inputs[side][self.filled : end] = features @ self.net.w[f"x{side}"] + self.net.w[f"b{side}"]
        self.filled = end
        self.new.clear()

    def scores(self, texts: list[str | None], batch: int = 1024) -> np.ndarray:
        best = np.full(len(texts), -np.inf)
        held, owners, n = [], [], 0

        def flush() -> None:
            nonlocal held, owners, n
            self._project()
            index, owner = np.concatenate(held), np.concatenate(owners)
            for at in range(0, len(index), batch):
                np.maximum.at(best, owner[at : at + batch], self.net.logits(self.inputs, index[at : at + batch]))
            held, owners, n = [], [], 0
            if len(self.places) > REMEMBERED:
                self._forget()

        for i, text in enumerate(texts):
            words = words_of(text)
            ids = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
            starts = windows_of(len(ids))
            padded = np.concatenate((ids, np.full(WINDOW, -1, np.int64)))
            held.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts])
            owners.append(np.full(len(starts), i))
            n += len(starts)
            if n >= 4 * batch:
                flush()
        if held:
            flush()
        return 1 / (1 + np.exp(-best))


def score(docs: DataFrame, model: Network | float) -> DataFrame:
    """``docs`` with ``score``, 0 to 1."""
    kept = docs.select(quoted(others(docs, "score")))
    if isinstance(model, float):
        return kept.withColumn("score", F.lit(model))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series(scorer.scores(texts.tolist()))

    return kept.withColumn("score", scored("text"))
