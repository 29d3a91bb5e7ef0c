import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldtally.llm import language_id, line_dedup, mixing, packing, simhash, token_counts, tokens, toxicity
from tests.llm.helpers import documents, reachable

ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "One"), (5, "Two words"), (6, "éÉ İ mixed CASE text"),
    (7, "a b c d"), (8, "A  B\tC\nD"), (9, "long " * 40_000), (9, "long " * 40_000), (10, "\x1c odd \x85 space s"),
    (11, " lead and trail "), (12, "two  spaces"), (13, "it's 42 times... \n\n  indented"), (None, "no id"),
]
REPEATED = "this line repeats in many documents"


# --- SimHash -----------------------------------------------------------------------------------------

def plain_fingerprint(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_plain_ones():
    for _, text in ODD:
        assert simhash.fingerprint(text, 3) == plain_fingerprint(text)


def test_xxhash_is_spark_s(spark):
    row = spark.range(1).selectExpr("xxhash64('some shingle text') AS h").first()
    assert row["h"] & (2**64 - 1) == xxhash.xxh64_intdigest("some shingle text", 42)


def test_tree_finds_all_within_radius():
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(0, 2**63, 20)]
    values = base + [b ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 64, (8, 2))]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values:
        assert sorted(tree.within(v, 2)) == [i for i, w in enumerate(values) if (v ^ w).bit_count() <= 2]


@pytest.mark.parametrize("part_rows", [2048, 7])
def test_simhash_components(spark, monkeypatch, part_rows):
    from fieldtally.llm import common

    monkeypatch.setattr(common.dealt, "__defaults__", (part_rows,))
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    rows = list(ODD)
    for g in range(6):
        base = rng.choice(words, 250).tolist()
        for k in range(12):
            copy = list(base)
            for at in rng.integers(0, 250, k % 4):
                copy[at] = "x"
            rows.append((100 + 20 * g + k, " ".join(copy)))
    docs = documents(spark, rows)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    prints = {i: plain_fingerprint(t) for i, t in rows if i is not None}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert any(prints[a] != prints[b] for a, b in links)
    expected = reachable(prints, links)
    for row in found:
        if row["doc_id"] is not None:
            assert row["fp"] & (2**64 - 1) == prints[row["doc_id"]]
            assert row["component_id"] == expected[row["doc_id"]]
    stays = simhash.keep_first(docs)
    assert stays.columns == docs.columns
    ids = [r["doc_id"] for r in stays.collect() if r["doc_id"] is not None]
    assert set(ids) == set(expected.values())


# --- Lines -------------------------------------------------------------------------------------------

def plain_lines(rows, min_docs=3):
    blank = " \t\n\x0b\x0c\r"

    def key(line):
        k = line.strip(blank)
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k) if len(k) >= 20 else None

    docs, last = Counter(), {}
    for doc_id, text in rows:
        if doc_id is None:
            continue
        for k in {key(x) for x in (text or "").split("\n")} - {None}:
            docs[k] += 1
            last[k] = max(last.get(k, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or docs[key(x)] < min_docs or last[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def line_rows():
    rows = [r for r in ODD if r[0] != 9]
    for i in range(60):
        rows.append((200 + i, f"own line number {i} of this document\n  {REPEATED.upper()}\t\n{REPEATED}\nshort\n\n"))
    rows += [(300, "é" * 19 + "\n" + "é" * 20), (301, "é" * 20 + "\n" + "é" * 19), (302, "é" * 20)]
    rows += [(303, "É" * 20), (400, REPEATED), (400, REPEATED), (401, "x" * 100_000 + "\n" + REPEATED + "\n\n")]
    return rows


@pytest.mark.parametrize(("batches", "fan"), [(1, 3), (4, 3), (7, 2)])
def test_lines_equal_plain_ones(spark, batches, fan):
    rows = line_rows()
    docs = documents(spark, rows)
    out = line_dedup.drop_repeated_lines(docs, batches=batches, fan=fan)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    found = [tuple(r) for r in line_dedup.digest(out).collect()]
    assert sorted(found, key=str) == sorted(plain_lines(rows), key=str)


def test_runs_are_disjoint_and_merged(spark):
    runs = line_dedup.LineRuns(spark, fan=2)
    for b in range(3):
        keys = spark.createDataFrame([(i, bytes([k])) for i, k in enumerate(range(b, b + 3))], "doc_id long, key binary")
        runs.absorb(keys)
    assert [len(level) for level in runs.levels] == [1, 1]
    seen = [bytes(r["key"]) for run in runs.runs() for r in run.collect()]
    assert sorted(seen) == [bytes([k]) for k in range(5)]
    totals = {bytes(r["key"])[0]: (r["docs"], r["last_doc"]) for r in runs.totals().collect()}
    assert totals == {0: (1, 0), 1: (2, 1), 2: (3, 2), 3: (2, 2), 4: (1, 2)}


def test_batches_meet_runs_without_shuffle_or_sort(spark):
    runs = line_dedup.LineRuns(spark, fan=3)
    for b in range(2):
        keys = [(i, bytes([b, k])) for i, k in enumerate(range(60))]
        runs.absorb(spark.createDataFrame(keys, "doc_id long, key binary"))
    batch = runs._in_buckets(spark.createDataFrame([(bytes([0, 5]), 1, 1)], runs.schema).repartition(runs.buckets, "key"))
    assert len(runs.runs()) == 2
    with line_dedup.sorted_buckets(spark):
        for met in (runs.new_keys(batch, runs.runs()), runs.repeats(batch, runs.runs())):
            plan = met._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and "Sort [" not in plan
        assert runs.new_keys(batch, runs.runs()).count() == 0 and runs.repeats(batch, runs.runs()).count() == 1


# --- Mixing ------------------------------------------------------------------------------------------

def test_mix_equals_plain_poisson(spark):
    rows = [(i, f"t{i}", "en", "big" if i % 3 else ("small" if i % 2 else None)) for i in range(900)] + [(5, "again", "en", "big")]
    docs = documents(spark, rows)
    out = mixing.mix(docs, epochs=2.0)
    assert out.columns == [*docs.columns, "copy", "shuffle_key"]
    order = [r["shuffle_key"] for r in out.collect()]
    assert order == sorted(order) and out.rdd.getNumPartitions() == 8
    places = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(places) == 8 and max(r["count"] for r in places) < 2 * len(order) / 8
    sizes = Counter(r[3] or "" for r in rows)
    total = sum(math.sqrt(n) for n in sizes.values())
    expected = Counter()
    for doc_id, text, _, source in rows:
        rate = 2.0 * len(rows) * math.sqrt(sizes[source or ""]) / total / sizes[source or ""]
        u = int(hashlib.md5(f"mix|{doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        k, p = 0, math.exp(-rate)
        c = p
        while c <= u:
            k += 1
            p *= rate / k
            c += p
        for copy in range(k):
            expected[doc_id, text, copy] += 1
    found = out.collect()
    assert Counter((r["doc_id"], r["text"], r["copy"]) for r in found) == expected
    keys = [r["shuffle_key"] for r in found]
    assert keys == sorted(keys) and abs(len(found) / len(rows) - 2) < 0.2
    named = Counter(r["source"] for r in mixing.mix(docs, {"big": 1.0, "small": 3.0, "none": 2.0}).collect())
    assert set(named) == {"big", "small"} and named["small"] > 2 * named["big"]


# --- Tokens ------------------------------------------------------------------------------------------

def library_ids(texts, added=True):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    if not added:  # as text of a flat file, where the closing id stands for the end of a document alone
        own.encode_special_tokens = True
    return [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]


def test_ids_are_the_tokenizer_s(spark):
    texts = [t for _, t in ODD if t] + ["<|endoftext|> end", "a   b", "x\n y", "x \n", " ", "  ", "\n", " a"]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|><|endoftext|>", "x <|endoftext|>\n", "<|endoftext|"]
    for text, ids, plain in zip(texts, library_ids(texts), library_ids(texts, added=False)):
        assert np.frombuffer(tokens.encoder(added=True).encode(text), "<u4").tolist() == ids
        assert np.frombuffer(tokens.encoder().encode(text), "<u4").tolist() == plain


def test_token_counts(spark):
    rows = [(i, t) for i, (_, t) in enumerate(ODD)] + [(100 + i, f"word{i} " * (i % 50)) for i in range(200)]
    docs = documents(spark, rows).repartition(3)
    lengths = dict(zip((i for i, _ in rows), map(len, library_ids([t or "" for _, t in rows], added=False))))
    for block_ids in (64, 1 << 18):
        blocks = token_counts.corpus_blocks(docs, block_ids=block_ids)
        found = token_counts.count_tokens(blocks, tokens.encoder().end).collect()
        assert len(found) == len(rows)
        assert {r["doc_id"]: r["n_tokens"] for r in found} == lengths


@pytest.mark.parametrize("stretch", [2, 1024])
def test_flat_files(spark, tmp_path, monkeypatch, stretch):
    monkeypatch.setattr(token_counts, "STRETCH", stretch)
    rng = np.random.default_rng(9)
    expected = {}
    for f in range(4):
        counts = rng.integers(0, 90, 40).tolist()
        data = [x for n in counts for x in [*rng.integers(1, 60_000, n).tolist(), 0]]
        if f == 3:
            data += [7] * 33  # the last document is not closed
            counts.append(33)
        np.array(data, "<u2").tofile(tmp_path / f"{f}.bin")
        expected[f"{f}.bin"] = counts
    blocks = token_counts.flat_file_blocks(spark, str(tmp_path), block_ids=37)
    found = defaultdict(dict)
    for r in token_counts.count_tokens(blocks, 0).collect():
        found[r["file"].rsplit("/", 1)[1]][r["ordinal"]] = r["n_tokens"]
    assert {f: [n[i] for i in sorted(n)] for f, n in found.items()} == expected
    assert all(sorted(n) == list(range(len(n))) for n in found.values())


# --- Packing -----------------------------------------------------------------------------------------

def check_packing(rows, pieces, capacity=2048):
    ids = {i: [*own, 0] for (i, _), own in zip(rows, library_ids([t or "" for _, t in rows]))}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(ids)
    for doc_id, own in by_doc.items():
        own.sort(key=lambda p: p["piece"])
        assert [p["piece"] for p in own] == list(range(len(own)))
        at = 0
        for p in own:
            part = ids[doc_id][at : at + p["length"]]
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p["length"]
        assert at == len(ids[doc_id]) and all(p["length"] == capacity for p in own[1:])
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        at = 0
        for p in own:
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    return len(by_sequence)


def test_packing_is_whole_and_tight(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = packing.pack_documents(docs).collect()
    bins = check_packing(rows, found)
    assert bins <= 1.02 * packing.lower_bound(np.array([p["length"] for p in found]), 2048) + 1


def test_packing_of_odd_texts(spark):
    rows = [(i, t) for i, (_, t) in enumerate(ODD)]
    check_packing(rows, packing.pack_documents(documents(spark, rows)).collect())
    assert packing.pack_documents(documents(spark, [])).count() == 0
    twice = packing.pack_documents(documents(spark, [(1, "same"), (1, "same"), (None, "same")])).collect()
    assert sorted(p["offset"] for p in twice) == [0, 2, 4] and len({p["sequence_id"] for p in twice}) == 1


def test_partitions_exchange(spark):
    rng = np.random.default_rng(10)
    lengths = rng.integers(300, 1500, 3000).tolist()
    found = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "item long, length long, share string")
    out = packing.pack(found, partition_pieces=200).collect()
    fill = Counter()
    for r in out:
        fill[r["sequence_id"]] += r["length"]
    assert len(out) == 3000 and max(fill.values()) <= 2048
    once = packing.best_fit(np.array(lengths), 2048)[2]
    assert packing.lower_bound(np.array(lengths), 2048) <= once <= len(fill) <= 1.05 * once
    # Without an exchange the same partitions take more sequences.
    alone = {r["sequence_id"] for r in packing.pack(found, partition_pieces=200, rounds=1).collect()}
    assert len(fill) < len(alone)


def test_lower_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(11)
    for _ in range(200):
        lengths = rng.integers(1, 21, rng.integers(1, 12))
        assert packing.lower_bound(lengths, 20) <= packing.best_fit(lengths, 20)[2]
    assert packing.lower_bound(np.array([11, 11, 11]), 20) == 3


# --- Classifiers -------------------------------------------------------------------------------------

def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = language_id.remainder("doc_id", 4) == 2
    prototypes = language_id.train(docs.filter(~held_out))
    assert set(prototypes) == {"en", "de", "es", "fr"}
    found = language_id.identify(docs.filter(held_out), prototypes).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) > 0.97 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)
    odd = [(1, None), (2, ""), (3, "123 !?"), (4, "\U0001f600 42"), (5, "\U00010400"), (6, "the " * 500_000)]
    rows = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(documents(spark, odd), prototypes).collect()}
    assert [rows[i] for i in (1, 2, 3, 4)] == ["und"] * 4 and rows[6] == "en"
    assert language_id.train(documents(spark, [])) == {}
    assert language_id.identify(documents(spark, odd), {}).first()["lang_pred"] == "und"


def test_counts_in_slices_are_the_same(monkeypatch):
    text = "Some words, and ümläuts\n" * 50
    whole = language_id.ngrams(text)
    monkeypatch.setattr(language_id, "SLICE", 17)
    parts = language_id.ngrams(text)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()


def test_network_gradient():
    net = toxicity.Network(["a", "b"])
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    words = ["a", "b", "unknown"]
    index = np.full((3, toxicity.WINDOW), -1)
    index[0, :3], index[1, :2] = [0, 1, 2], [2, 0]
    labels = np.array([1.0, 0.0, 1.0])
    _, g = net.gradient(words, index, labels)
    for name, w in net.w.items():
        for i in np.flatnonzero(np.abs(g[name]) > 1e-3)[:2]:
            before, e = w.flat[i], 1e-3
            w.flat[i] = before + e
            up = net.gradient(words, index, labels)[0]
            w.flat[i] = before - e
            down = net.gradient(words, index, labels)[0]
            w.flat[i] = before
            assert abs((up - down) / 2 / e - g[name].flat[i]) < 2e-4 + 0.05 * abs(g[name].flat[i])
    inputs = net.project(net.features(words)[0])
    assert np.allclose(net.run(inputs, index), net.logits(inputs, index), atol=1e-3)


def test_toxicity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held_out = language_id.remainder("doc_id", 5) == 0
    model = toxicity.train(docs, labels.filter(~held_out))
    found = toxicity.score(docs.join(labels, "doc_id").filter(held_out), model).collect()
    right = sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in found)
    assert right > 0.95 * len(found)
    clean = [r["score"] for r in found if r["toxic"] == 0]
    assert sum(s >= 0.5 for s in clean) < 0.03 * len(clean)
    odd = documents(spark, ODD)
    scores = toxicity.score(odd, model)
    assert scores.columns == [*odd.columns, "score"]
    assert all(0 <= r["score"] <= 1 for r in scores.collect())
    # Prose of the corpus as background: one insult in a text of many windows.
    prose = next(r["text"] for r in found if r["toxic"] == 0 and r["lang"] == "en" and r["score"] < 0.3)
    worst = f"{prose} " * 30 + "you stupid idiot and worthless loser " + f"{prose} " * 30
    pair = toxicity.score(documents(spark, [(1, worst), (2, f"{prose} " * 60)]), model).collect()
    assert pair[0]["score"] > 0.5 > pair[1]["score"]
    assert toxicity.train(docs.limit(0), labels) == 0.0


def test_windows_cover_every_word():
    for n in range(1, 300):
        starts = toxicity.windows_of(n)
        assert {w for s in starts for w in range(s, s + toxicity.WINDOW)} >= set(range(n))


def test_columns_of_names_used_inside_go_through(spark):
    docs = documents(spark, [(i, f"{REPEATED}\nown {i}") for i in range(4)])
    for name, value in (("gone", 1), ("gone_", 2), ("found", 3)):
        docs = docs.withColumn(name, F.lit(value))
    lean = line_dedup.drop_repeated_lines(docs)
    assert lean.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert sorted((r["doc_id"], r["n_dropped"], r["gone"], r["gone_"]) for r in lean.collect()) == [
        (0, 1, 1, 2), (1, 1, 1, 2), (2, 1, 1, 2), (3, 0, 1, 2)
    ]
    named = language_id.identify(docs, {"en": np.ones(language_id.DIMENSIONS)})
    assert [r["found"] for r in named.collect()] == [3] * 4
