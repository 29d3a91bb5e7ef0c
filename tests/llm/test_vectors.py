import numpy as np
import pytest

from fieldtally.llm import common, embedding_dedup, topk
from tests.llm.helpers import reachable

SCHEMA = "vec_id long, embedding array<float>, label int, bucket long, copies int"
ODD = [
    (1, None, 1), (2, [], 1), (3, [0.0] * 8, 1), (4, [1.0] * 7 + [None], 1), (5, [float("nan")] + [1.0] * 7, 1),
    (6, [float("inf")] + [1.0] * 7, 1), (7, [1.0] * 8, None), (8, [1.0] * 8, 1), (9, [2.0] * 8, 1), (10, [1.0] * 8, 2),
    (11, [1.0, -0.0] * 4, 3), (12, [1.0, 0.0] * 4, 3), (13, [1.0] * 4, 1), (13, [1.0] * 4, 1), (20, [0.5] * 8, 2),
    (40, [3e38] * 8, 1), (60, None, 1), (80, [0.25] * 8, None), (100, [1.0], 5),
]


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 7, 7) for i, v, label in rows], SCHEMA)


def crowd(n, dim, seed, cosine=0.93):
    """Vectors with partners whose cosine lies around the threshold, on both sides."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    base /= np.linalg.norm(base, axis=1)[:, None]
    other = rng.normal(size=(n, dim))
    other -= (other * base).sum(axis=1)[:, None] * base
    other /= np.linalg.norm(other, axis=1)[:, None]
    c = cosine + rng.uniform(-0.03, 0.05, n)
    near = c[:, None] * base + np.sqrt(1 - c * c)[:, None] * other
    return np.concatenate((base, near)).astype(np.float32)


def plain_links(rows, threshold):
    good = [
        (i, np.array(v, np.float64), label) for i, v, label in rows
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = []
    for a, (i, x, p) in enumerate(good):
        for j, y, q in good[a + 1 :]:
            if p == q and len(x) == len(y):
                cosine = (x / np.abs(x).max()) @ (y / np.abs(y).max())
                cosine /= np.linalg.norm(x / np.abs(x).max()) * np.linalg.norm(y / np.abs(y).max())
                if cosine >= threshold:
                    links.append((i, j))
    return links


def test_odd_vectors(spark):
    found = embedding_dedup.near_duplicates(table(spark, ODD)).collect()
    links = plain_links(ODD, 0.93)
    best = reachable({r[0] for r in ODD}, links)
    assert len(found) == len(ODD)
    for r in found:
        assert r["component_id"] == best[r["vec_id"]] and r["kept"] == (r["vec_id"] == r["component_id"])
        expected = 1 if r["vec_id"] == 13 else sum(r["vec_id"] in pair for pair in links)
        assert r["n_links"] == expected, r
    assert embedding_dedup.near_duplicates(table(spark, [])).count() == 0


@pytest.mark.parametrize("part_rows", [2048, 40])
def test_recall_and_no_false_link(spark, monkeypatch, part_rows):
    monkeypatch.setattr(common.dealt, "__defaults__", (part_rows,))
    vectors = crowd(600, 64, 5)
    rng = np.random.default_rng(6)
    tight = vectors[0] + rng.normal(0, 0.002, (150, 64)).astype(np.float32)  # a group of near copies
    same = np.repeat(vectors[1:2], 100, axis=0)
    every = np.concatenate((vectors, tight, same))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(every)]
    found = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table(spark, rows)).collect()}
    unit = every.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    expected, total = near.sum(axis=1), sum(found[i]["n_links"] for i in range(len(every)))
    assert all(found[i]["n_links"] <= expected[i] for i in range(len(every)))
    assert total >= 0.99 * expected.sum()
    pairs = sum(found[i]["n_links"] for i in range(1200) if expected[i] == 1)
    assert pairs >= 0.97 * sum(1 for i in range(1200) if expected[i] == 1)
    assert {found[i]["component_id"] for i in range(1200, 1350)} == {0}


def test_rows_that_repeat_an_id_have_their_own_links(spark):
    rows = [(1, [1.0, 0.0, 0.0, 0.0], 1), (1, [0.0, 1.0, 0.0, 0.0], 1), (2, [1.0, 0.01, 0.0, 0.0], 1), (2, [0.0, 0.0, 1.0, 0.0], 1)]
    found = [tuple(r) for r in embedding_dedup.near_duplicates(table(spark, rows)).collect()]
    assert sorted(found) == [(1, 0, 1, True), (1, 1, 1, True), (2, 0, 2, True), (2, 1, 1, False)]


def test_sketches_lose_no_near_vectors():
    for dim in (64, 100, 300):
        vectors = embedding_dedup.unit(crowd(3000, dim, 9).astype(np.float64))
        sketch = embedding_dedup.hashed(vectors)[1].view(np.uint64)
        apart = np.bitwise_count(sketch[:3000] ^ sketch[3000:]).sum(axis=1)
        near = (vectors[:3000] * vectors[3000:]).sum(axis=1) >= 0.93
        assert apart[near].max() < embedding_dedup.SKETCH_APART - 6
        assert np.bitwise_count(sketch[:-1] ^ sketch[1:]).sum(axis=1).mean() > 55


def test_short_vectors_are_hashed_by_all_axes(spark):
    for dim in (1, 2, 3, 4, 5):
        vectors = crowd(60, dim, dim) if dim > 1 else np.linspace(-1, 1, 120, dtype=np.float32)[:, None]
        rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
        found = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(table(spark, rows)).collect()}
        links = plain_links(rows, 0.93)
        assert sum(found.values()) <= 2 * len(links) and sum(found.values()) >= 0.97 * 2 * len(links), dim


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose((embedding_dedup.hadamard(x) ** 2).sum(axis=1), 16 * (x**2).sum(axis=1))


def plain_top(rows, k=20):
    good = [(i, np.array([int(x) for x in np.floor(64 * np.array(v, np.float64))], object)) for i, v, _ in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, q in good:
        if i % 20 == 0:
            scores = sorted(((-int(sum(q * x)), j) for j, x in good if j != i and len(x) == len(q)))[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)}
    return out


@pytest.mark.parametrize("sizes", [(4096, 1024, 64), (50, 7, 3)])
def test_top_k(spark, monkeypatch, sizes):
    for name, value in zip(("CANDIDATE_ROWS", "QUERY_ROWS", "SHARE_BLOCKS"), sizes):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(800, 16)) * rng.gamma(1, 1, (800, 1)) * np.linspace(1, 0.05, 16)
    vectors[100:160] = vectors[99]  # ties
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(vectors)]
    rows += [(1000 + i, v, label) for i, v, label in ODD if i not in (13, 40)]
    found = [tuple(r) for r in topk.top_k(table(spark, rows)).collect()]
    assert len(found) == len(set(found)) and set(found) == plain_top(rows)
    assert topk.top_k(table(spark, [])).count() == 0


def test_products_beyond_exact_doubles(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.normal(size=(60, 4)) * 2e6).astype(np.float32)  # sums of up to 2^57
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    assert {tuple(r) for r in topk.top_k(table(spark, rows)).collect()} == plain_top(rows)
    a, b = np.array([[2.0**62, -(2.0**62), 1.0]]), np.array([[1.0, 1.0, 3.0], [0.5, 0.0, 2.0]])
    assert topk.product(np.floor(a), np.floor(b)).tolist() == [[3, 2]]
    assert topk.row_products(np.repeat(a, 2, axis=0), np.floor(b)).tolist() == [3, 2]
    far = [(0, [1e10] * 4, 1), (1, [1e10] * 4, 1)]
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.top_k(table(spark, far)).collect()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001 + i) for i in range(500)]
    found = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {found[i] for i in range(301)} == {0} and {found[i] for i in range(1000, 1501)} == {1000}
