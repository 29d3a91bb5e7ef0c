"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its letters' vectors (product)
after permuting each as often as its place says (a cyclic shift). A document is the bundle (sum) of its
n-grams' vectors, a language the bundle of its documents; a document's language is that of the
prototype with the highest cosine.

Letters outside a fixed alphabet share its places by their code, so the table of all n-gram vectors
has a fixed size.

Defined cases: texts that are null or have no letter are ``und`` with score 0; ties go to the
language first in order; repeated rows get the same answer; without labelled rows every text is
``und``; very long texts are counted in slices; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import free_name, others, quoted

#: Places of the alphabet: the gap between words, a-z, and the other letters by their code.
PLACES = 64
DIMENSIONS = 512
N = 3
UNKNOWN = "und"
SLICE = 1 << 20


@cache
def letter_places() -> np.ndarray:
    """The place of each code point of the basic plane: 0 for what is no letter."""
    places = np.zeros(1 << 16, np.int32)
    for code in range(1 << 16):
        letter = chr(code)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            places[code] = low - 96 if 97 <= low <= 122 else 27 + low % (PLACES - 27)
    return places


@cache
def ngram_vectors() -> np.ndarray:
    """The bound vectors of all n-grams, by their number in base ``PLACES``."""
    letters = np.random.default_rng(64).choice(np.array([-1, 1], np.int8), (PLACES, DIMENSIONS))
    out = np.ones((1, DIMENSIONS), np.int8)
    for place in range(N):
        turned = np.roll(letters, N - 1 - place, axis=1)
        out = (out[:, None, :] * turned[None, :, :]).reshape(-1, DIMENSIONS)
    return out


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams with a letter in them and how often each occurs; words are framed by gaps."""
    places, total = letter_places(), None
    step = SLICE
    for at in range(0, len(text), step):
        part = text[max(0, at - N + 1) : at + step]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        own = places[np.minimum(codes, (1 << 16) - 1)]
        if codes.max(initial=0) >= 1 << 16:
            own = own.copy()
            for i in np.flatnonzero(codes >= 1 << 16):
                own[i] = 27 + int(codes[i]) % (PLACES - 27) if chr(codes[i]).isalpha() else 0
        if at == 0:
            own = np.concatenate(([0], own))
        if at + step >= len(text):
            own = np.concatenate((own, [0]))
        if len(own) < N:
            continue
        grams = (own[:-2] * PLACES + own[1:-1]) * PLACES + own[2:]
        counts = np.bincount(grams[own[1:-1] > 0], minlength=0)
        if total is None:
            total = counts
        else:
            wide, narrow = (total, counts) if len(total) >= len(counts) else (counts, total)
            wide[: len(narrow)] += narrow
            total = wide
    if total is None:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    found = np.flatnonzero(total)
    return found, total[found].astype(np.float32)


def summed(found: np.ndarray, counts: np.ndarray, kind: type = np.float32) -> np.ndarray:
    """The sum of n-grams' vectors by their counts, a slice of n-grams at a time."""
    total, vectors = np.zeros(DIMENSIONS, kind), ngram_vectors()
    for at in range(0, len(found), 4096):
        total += counts[at : at + 4096].astype(kind) @ vectors[found[at : at + 4096]].astype(kind)
    return total


def bundle(text: str | None) -> np.ndarray | None:
    """The document's vector; None if it has no letter."""
    found, counts = ngrams(text) if text else ((), ())
    return summed(found, counts) if len(found) else None


def train(docs: DataFrame) -> dict[str, np.ndarray]:
    """Prototypes of all languages from every row of ``text, lang``.

    Only sums are shuffled and only a vector for each language comes to the driver. Languages are few
    (public code lists hold under 10,000: 40 MB of vectors).
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            # Of one batch's languages only: at a time there are as many dense counters as it has.
            counts: dict[str, np.ndarray] = {}
            for text, lang in zip(batch["text"], batch["lang"]):
                found, n = ngrams(text)
                if len(found):
                    if lang not in counts:
                        counts[lang] = np.zeros(PLACES**N, np.float64)
                    counts[lang][found] += n
            for lang, total in counts.items():
                found = np.flatnonzero(total)
                own = np.rint(summed(found, total[found], np.float64)).astype(np.int64)
                totals[lang] = totals[lang] + own if lang in totals else own
        if totals:
            rows = list(totals.items())
            place = np.tile(np.arange(DIMENSIONS), len(rows))
            yield pd.DataFrame({
                "lang": np.repeat([k for k, _ in rows], DIMENSIONS), "place": place,
                "total": np.concatenate([v for _, v in rows]),
            })

    rows = (
        docs.select("text", "lang").filter("text is not null and lang is not null")
        .mapInPandas(sums, "lang string, place int, total long")
        .groupBy("lang", "place").agg(F.sum("total").alias("total")).collect()
    )
    out: dict[str, np.ndarray] = {}
    for row in rows:
        out.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["place"]] = row["total"]
    return out


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine with that language's prototype, not under 0."""
    names = sorted(k for k, v in prototypes.items() if np.any(v))
    matrix = np.array([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names]).T

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for i, text in enumerate(texts):
            vector = bundle(text)
            if vector is None or not names:
                continue
            cosines = vector @ matrix / max(float(np.linalg.norm(vector)), 1e-9)
            best = int(cosines.argmax())
            langs[i], scores[i] = names[best], min(1.0, max(0.0, float(cosines[best])))
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    kept = docs.select(quoted(others(docs, "lang_pred", "score")))
    found = free_name("found", kept)
    named = kept.withColumn(found, predict("text"))
    return named.select(*quoted(kept.columns), f"{found}.lang_pred", f"{found}.score")


def remainder(column: str, by: int) -> Column:
    """crc32 of the id's text modulo ``by``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % by
