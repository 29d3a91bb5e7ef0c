"""Substring dedup, Merkle manifest and periodic runs against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldtally.llm import merkle, periodic_runs, substring_dedup
from fieldtally.llm.queries import REGISTERED
from tests.llm.helpers import documents

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (1, None), (2, ""), (3, " \n\t\x0b"), (4, "one"), (None, "no id " * 30), (None, "no id " * 30), (5, "é\x85ü\xa0 \x1c x " * 15),
    (6, "a b " * 40), (6, "a b " * 40), (7, "same place " * 12 + "end"), (7, "other text of one id " * 9), (8, "w " * 30_000),
]


def clash(spark, rows, *names):
    docs = documents(spark, rows)
    for name in names:
        docs = docs.withColumn(name, F.lit("kept"))
    return docs


def words(text):
    return BLANK.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


# --- Substring dedup ---------------------------------------------------------------------------------

def plain_dedup(rows, size):
    """Kept words of each row, by the smallest place (doc_id, start) of each window; a null id is the smallest."""
    split = [(-(2**63) if i is None else i, words(t)) for i, t in rows]
    first = {}
    for i, w in split:
        for at in range(len(w) - size + 1):
            key = tuple(w[at : at + size])
            first[key] = min(first.get(key, (i, at)), (i, at))
    out = []
    for i, w in split:
        gone = {k for at in range(len(w) - size + 1) if first[tuple(w[at : at + size])] < (i, at) for k in range(at, at + size)}
        out.append(" ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def check_dedup(spark, rows, size=20):
    docs = documents(spark, rows).repartition(3)
    out = substring_dedup.drop_repeats(docs, size)
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["text"]) for r in out.collect())
    expected = []
    for (i, text), kept in zip(rows, plain_dedup(rows, size)):
        expected.append((str(i), len(words(text)), len(words(text)) - len(words(kept)), kept))
    assert found == sorted(expected)
    return out


@pytest.mark.parametrize("shape", [(4 << 20, 1 << 24, 4), (2000, 1 << 10, 4), (500, 64, 1)])
def test_substrings(spark, monkeypatch, shape):
    """Also with tiny units, shards and a sketch so full that it estimates nearly everything repeated."""
    for name, value in zip(("UNIT_BYTES", "CELLS", "CELLS_PER_WINDOW"), shape):
        monkeypatch.setattr(substring_dedup, name, value)
    rng = random.Random(3)
    passages = [" ".join(f"p{k}w{rng.randrange(50)}" for _ in range(rng.randrange(15, 70))) for k in range(6)]
    rows = []
    for i in range(150):
        own = [f"own{rng.randrange(3000)}" for _ in range(rng.randrange(0, 60))]
        own[rng.randrange(len(own) + 1) : 0] = rng.choice(passages).split() if rng.random() < 0.7 else []
        rows.append((rng.randrange(-50, 1000), rng.choice([" ", "\n", "  "]).join(own)))
    rows += [(2000 + i, passages[0]) for i in range(40)] + ODD
    out = check_dedup(spark, rows)
    assert out.columns == [*documents(spark, []).columns, "n_words", "n_removed"]


def test_substrings_of_other_lengths(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for i in range(60)]
    for size in (1, 2, 7, 33):
        check_dedup(spark, rows, size)


def test_substrings_of_no_rows_and_clashing_columns(spark):
    docs = clash(spark, [(1, "x " * 50), (2, "x " * 50)], "unit", "unit_place", "N_Words", "a.b", "Text2")
    out = substring_dedup.drop_repeats(docs)
    assert out.columns == [c for c in docs.columns if c != "N_Words"] + ["n_words", "n_removed"]
    kept = {r["doc_id"]: (r["text"], r["unit"], r["a.b"]) for r in out.collect()}
    assert kept == {1: ("x " * 50, "kept", "kept")} or kept[2] == ("", "kept", "kept")
    assert substring_dedup.drop_repeats(documents(spark, [])).collect() == []
    assert substring_dedup.drop_repeats(documents(spark, [(1, None), (2, "")])).count() == 2


def test_texts_stay_in_their_buckets(spark):
    """No text is shuffled: only what units and shards say to each other is."""
    out = substring_dedup.drop_repeats(documents(spark, [(i, f"w{i} " * 30) for i in range(50)]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "FlatMapCoGroups" in plan


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**63 - 1), min_size=1))
def test_numbers_survive_packing(values):
    assert substring_dedup.wide(substring_dedup.narrow(np.array(values, np.uint64))).tolist() == values


def test_equal_windows_have_equal_hashes():
    texts = ["a b c d e f", "x  a\nb c\td e f y", "f e d c b a"]
    windows = substring_dedup.Windows(texts, 5)
    by_text = {}
    joined = [words(t) for t in texts]
    flat = [(d, at) for d, w in enumerate(joined) for at in range(len(w) - 4)]
    assert len(flat) == len(windows.at)
    for (d, at), h in zip(flat, windows.hash.tolist()):
        by_text.setdefault(tuple(joined[d][at : at + 5]), set()).add(h)
    assert all(len(hashes) == 1 for hashes in by_text.values())
    assert len({h for hashes in by_text.values() for h in hashes}) == len(by_text)


# --- Merkle manifest ---------------------------------------------------------------------------------

def plain_leaf(row):
    values = [None if v is None else str(v) for v in row]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def plain_tree(leaves):
    """Root, and of each leaf its siblings by level as (left, right)."""
    paths = [[] for _ in leaves]
    level, owners = list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, above_owners = [], []
        for at in range(0, len(level), 3):
            run = level[at : at + 3]
            for k in range(len(run)):
                for leaf in owners[at + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha("".join(run)))
            above_owners.append([o for k in range(len(run)) for o in owners[at + k]])
        level, owners = above, above_owners
    return level[0], paths


def plain_manifest(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the query's result."""
    def lost(row):
        i, text = row[0], row[4]
        return (*row[:4], text if text is None or i is None or zlib.crc32(str(i).encode()) % 2 else text.replace("\n", ""))

    if not rows:
        return []
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0], plain_leaf(row), plain_leaf(lost(row))))
    ordered = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in ordered:
        own = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[source] = own, *plain_tree([leaf for _, leaf, _ in own])
    root, tops = plain_tree([trees[s][1] for s in ordered])
    out = []
    for source, top in zip(ordered, tops):
        own, subroot, paths = trees[source]
        for (i, leaf, found), path in zip(own, paths):
            node = found
            for left, right in path + top:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path + top))
            out.append((i, leaf, subroot, root, proof, node, node == root))
    return out


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def manifest(spark, rows, tmp_path, columns=COLUMNS):
    path = str(tmp_path / f"sf{random.random()}")
    spark.createDataFrame(rows, columns).repartition(4).write.parquet(f"{path}/documents.parquet")
    return REGISTERED["op12_merkle"](spark, path).collect()


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("counts", [{}, {"a": 1}, {"a": 3, None: 1}, {"a": 2, "é": 28, "": 4, None: 9}, {"z": 2500, "a": 730, None: 729}])
def test_manifest(spark, tmp_path, counts):
    rng = random.Random(12)
    rows = []
    for source, n in counts.items():
        for k in range(n):
            text = rng.choice([None, "", "a\nb", "é\n\nü", f"text {k}\n"])
            rows.append((rng.randrange(10**9) * 4 + len(rows) % 4, source, rng.choice([None, "en"]), rng.choice([None, k]), text))
    assert sorted_rows(manifest(spark, rows, tmp_path)) == sorted_rows(plain_manifest(rows))


def test_manifest_of_ties_nulls_and_repeated_rows(spark, tmp_path):
    rows = [(None, "a", None, None, "x\ny"), (None, "a", None, None, None), (5, "a", "en", 3, "t\n"), (5, "a", "en", 3, "t\n"),
            (5, "a", "en", 3, "s"), (None, None, None, None, None)] * 2
    assert sorted_rows(manifest(spark, rows, tmp_path)) == sorted_rows(plain_manifest(rows))


def test_many_sources(spark, tmp_path):
    rows = [(i, f"s{i % 800}", "en", 1, f"line\n{i}") for i in range(1700)]
    assert sorted_rows(manifest(spark, rows, tmp_path)) == sorted_rows(plain_manifest(rows))


def test_hot_ancestors_are_salted(spark, tmp_path, monkeypatch):
    for name, value in (("RANGE_ROWS", 50), ("SALT_ROWS", 4)):
        monkeypatch.setattr(merkle, name, value)
    rows = [(i, "hot" if i % 3 else f"s{i}", None, i, "t\n" * (i % 2)) for i in range(900)]
    assert sorted_rows(manifest(spark, rows, tmp_path)) == sorted_rows(plain_manifest(rows))


def test_tampering_is_found_and_other_columns_are_carried(spark):
    docs = clash(spark, [(i, f"text\n{i}", "en", f"s{i % 2}") for i in range(50)], "tree", "index", "Leaf", "a.b")
    leaf = merkle.leaf_hash([F.col(c) for c in merkle.FIELDS])
    proofs = merkle.prove(docs, leaf, carry=[F.concat(leaf, F.lit("x")).alias("other"), leaf.alias("same")])
    assert [r["verified"] for r in merkle.verified(proofs, "same").collect()] == [True] * 50
    assert not any(r["verified"] for r in merkle.verified(proofs, "other").collect())


# --- Periodic runs -----------------------------------------------------------------------------------

def plain_runs(w, least=12):
    seen = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                seen.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e) for (s, e), q in seen.items())


def plain_result(doc_id, text):
    w = words(text)
    if w and doc_id is not None and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {k for s, q, e in runs for k in range(s + q, e)}
    best = min(runs, key=lambda r: (r[0] - r[2], r[0], r[1]), default=None)
    start, length, period = (best[0], best[2] - best[0], best[1]) if best else (None, None, None)
    listed = "".join(f"{s},{e - s},{q}\n" for s, q, e in runs)
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    return (doc_id, len(runs), start, length, period, 1000 * length // period if best else None, sha(listed), sha(kept))


def alphabet(rng, n):
    letters = rng.choice(["ab", "aab", "abcdefghijklmnop"])
    return [rng.choice(letters) for _ in range(n)]


def repetitive(rng):
    """Word lists in which short and long periods overlap, touch and nest."""
    kind, n = rng.randrange(8), rng.randrange(0, 700)
    if kind == 0:
        return alphabet(rng, n)
    if kind == 1:
        return (alphabet(rng, rng.randrange(1, 200)) * rng.randrange(1, 8))[:n] + alphabet(rng, 30)
    if kind == 2:
        run = (alphabet(rng, rng.randrange(1, 9)) * 200)[: rng.randrange(20, 300)]
        return alphabet(rng, 3) + run + run[: rng.randrange(len(run))] + run + alphabet(rng, 4)
    if kind == 3:
        a, b = ["a"], ["a", "b"]
        for _ in range(rng.randrange(3, 13)):
            a, b = b, b + a
        return b
    if kind == 4:
        root = alphabet(rng, rng.randrange(1, 6))
        out = []
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(len(root))
            out += (root * 100)[at : at + rng.randrange(2, 150)] + ["x"] * rng.randrange(2)
        return out * rng.randrange(1, 4)
    if kind == 5:
        return ((["a"] * rng.randrange(30, 150) + ["b"]) * rng.randrange(1, 6))[rng.randrange(20) :]
    if kind == 6:
        out = ["a"]
        while len(out) < n:
            out = out + [rng.choice("bc")] * (rng.random() < 0.4) + out
        return out[:700]
    u, v = alphabet(rng, rng.randrange(1, 60)), alphabet(rng, rng.randrange(1, 60))
    return ([x for _ in range(10) for x in rng.choice([u, v])] * 2)[:700]


def test_runs_of_repetitive_texts():
    rng = random.Random(13)
    for _ in range(60):
        docs = [repetitive(rng) for _ in range(6)]
        found = periodic_runs.runs_of([[w.encode() for w in d] for d in docs], 12)
        for d, runs in zip(docs, found):
            assert [(s, q, e) for s, e, q in runs.tolist()] == plain_runs(d), " ".join(d)


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.sampled_from("ab"), max_size=40), st.integers(1, 9), st.integers(0, 40), st.lists(st.sampled_from("ab"), max_size=9))
def test_runs_of_any_texts(root, times, cut, tail):
    text = (root * times)[cut:] + tail
    found = periodic_runs.runs_of([[w.encode() for w in text]], 12)[0]
    assert [(s, q, e) for s, e, q in found.tolist()] == plain_runs(text)


def result_rows(rows):
    return sorted(rows, key=lambda r: (str(r[0]), r[-2:]))


def run_query(spark, rows, tmp_path):
    path = str(tmp_path / "sf")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{path}/documents.parquet")
    return [tuple(r) for r in REGISTERED["op13_periodic_runs"](spark, path).collect()]


def test_runs_query(spark, tmp_path):
    rng = random.Random(14)
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(repetitive(rng))) for i in range(150)]
    # Few words differ, so that what is planted has to be worked out word by word.
    rows += [(1000 + i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(300)))) for i in range(300)]
    rows += [row for row in ODD if row[0] != 8]
    assert result_rows(run_query(spark, rows, tmp_path)) == result_rows([plain_result(i, t) for i, t in rows])


def test_runs_of_the_test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    short = [(i, t) for i, t in rows if len(words(t)) < 1500]
    found = {r[0]: tuple(r) for r in REGISTERED["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(rows) and len(short) > 150
    for i, t in short:
        assert found[i] == plain_result(i, t)


def test_very_long_runs():
    n = 200_000
    for text in (["a"] * n, ["a", "b"] * (n // 2), (["a"] * 999 + ["b"]) * (n // 1000)):
        found = periodic_runs.runs_of([[w.encode() for w in text]], 12)[0].tolist()
        assert [0, n, len(text) // n * (1 if text[1] == "a" and "b" not in text else 2 if text[1] == "b" else 1000)] in found
    half = (["a", "b"] * 2001)[:4001]
    found = periodic_runs.runs_of([[w.encode() for w in half + half]], 12)[0]
    assert len(found) > 1900 and [0, 8002, 4001] in found.tolist()


def test_runs_of_no_rows_and_clashing_columns(spark):
    docs = clash(spark, [(1, "x " * 50), (2, None)], "Start", "length", "a.b", "runs", "n_Runs")
    out = periodic_runs.collapse_runs(docs)
    own = ["n_runs", "start", "length", "period", "runs"]
    assert out.columns == [*documents(spark, []).columns, "a.b", *own]
    found = {r["doc_id"]: tuple(r[c] for c in ["text", *own, "a.b"]) for r in out.collect()}
    assert found == {1: ("x", 1, 0, 50, 1, "0,50,1\n", "kept"), 2: ("", 0, None, None, None, "", "kept")}
    assert periodic_runs.collapse_runs(documents(spark, [])).collect() == []
