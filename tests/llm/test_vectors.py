"""Hard negatives and near duplicates of embeddings, against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tslines.llm import embedding_dedup, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, node string, cell int, id int, score double"


def table(llm, rows):
    return llm.createDataFrame([(i, v, y, "own", 1, 2, 3.0) for i, v, y in rows], SCHEMA)


def clustered(rng, n, dims=8, spread=0.12):
    """Vectors around few directions, so that many pairs lie on either side of the threshold."""
    middles = rng.normal(size=(6, dims))
    x = middles[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dims)) * rng.integers(1, 5, (n, 1))
    return [[float(v) for v in r] for r in x.astype(np.float32)]


ODD = [
    (900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] + [1.0] * 7, 1), (903, [None] + [1.0] * 7, 2), (904, [], 1),
    (905, [float("inf")] + [1.0] * 7, 2), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], None), (None, [1.0, 2.0, 0.0], 3), (950, [1e-30, 2e-30], 3), (950, [1e-30, 2e-30], 3),
]


def brute_links(rows, threshold):
    dims = max([1, *(len(v) for _, v, _ in rows if v)])
    units = []
    for _, v, _ in rows:
        x = np.array([np.nan if c is None else c for c in v or []] + [0.0] * (dims - len(v or [])))
        ok = v is not None and np.isfinite(x).all() and x.any()
        units.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if ok else None)
    near = [{j for j, w in enumerate(units) if j != i and u is not None and w is not None and u @ w >= threshold} for i, u in enumerate(units)]
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            more = near[todo.pop()] - seen
            seen |= more
            todo += more
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((row[0], len(near[i]), least, row[0] == least))
    return Counter(out)


@pytest.mark.parametrize(("cells", "tile"), [(None, 1024), (7, 16), (40, 5), (1, 3)])
def test_near_vectors_agree_with_all_pairs(llm, cells, tile):
    rng = np.random.default_rng(3)
    vectors = clustered(rng, 260)
    rows = [(int(i), v, 0) for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)]
    # copies, one of them many times, and a scaled one
    rows += [(1000 + i, vectors[0], 0) for i in range(30)] + [(2000, [2 * c for c in vectors[1]], 0)] + ODD
    got = embedding_dedup.near_vectors(table(llm, rows), cells=cells, tile=tile)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = brute_links(rows, 0.95)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(n > 0 for _, n, _, _ in want.elements()) > 100


def test_near_vectors_of_nothing(llm):
    assert embedding_dedup.near_vectors(table(llm, [])).collect() == []
    got = embedding_dedup.near_vectors(table(llm, [(1, None, 1), (2, [0.0], 1)])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, True), (2, 0, 2, True)]
    with pytest.raises(ValueError, match="threshold"):
        embedding_dedup.near_vectors(table(llm, []), threshold=0.0)


def test_vectors_are_compared_where_they_lie(llm, monkeypatch):
    plans, shapes, write = {}, [], embedding_dedup.staged

    def staged(df, name="stage"):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        out = write(df, name)
        if name == "blocks":
            shapes.extend((len(r["cells"]), len(r["n"]) // 8, len(r["raw"])) for r in out.collect())
        return out

    monkeypatch.setattr(embedding_dedup, "staged", staged)
    key = "spark.sql.files.maxPartitionBytes"
    before = llm.conf.get(key)
    rows = [(i, v, 0) for i, v in enumerate(clustered(np.random.default_rng(4), 300))]
    got = embedding_dedup.near_vectors(table(llm, rows), cells=12, tile=50)
    # no copies of vectors for the comparison, and four bytes a component in all tables
    assert "CartesianProduct" in plans["met"] and "Exchange" not in plans["met"]
    assert sum(n for _, n, _ in shapes) == 300 and all(size == n * 8 * 4 for _, n, size in shapes)
    assert len(shapes) > 6 and max(n for _, n, _ in shapes) < 100 and llm.conf.get(key) == before
    assert Counter(map(tuple, got.collect())) == brute_links(rows, 0.95)


@pytest.mark.parametrize("cells", [1, 9])
def test_pairs_at_the_threshold_are_decided_in_doubles(llm, cells):
    rng, rows = np.random.default_rng(6), []
    for i in range(60):
        one, other = np.linalg.qr(rng.normal(size=(24, 2)))[0].T
        cos = 0.95 + (1e-10 if i % 2 else -1e-10)
        rows += [(2 * i, (3e40 * one).tolist(), 0), (2 * i + 1, (cos * one + math.sqrt(1 - cos * cos) * other).tolist(), 0)]
    df = llm.createDataFrame([(i, v) for i, v, _ in rows], "vec_id long, embedding array<double>")
    got = Counter(map(tuple, embedding_dedup.near_vectors(df, cells=cells, tile=40).collect()))
    assert got == brute_links(rows, 0.95) and sum(n == 1 for _, n, _, _ in got) == 60


def test_partners_meet_in_a_home_cell_of_one():
    rng = np.random.default_rng(5)
    unit, _ = embedding_dedup.directions(rng.normal(size=(400, 6)))
    close, _ = embedding_dedup.directions(unit + 0.12 * rng.normal(size=unit.shape))
    means = unit[:25]
    apart = np.sqrt(np.maximum(2 - 2 * means @ means.T, 0))
    linked = (unit * close).sum(axis=1) >= 0.9
    assert linked.sum() > 50
    (home, visits), (home_b, visits_b) = (embedding_dedup.cells_of(u, means, apart, 0.9) for u in (unit, close))
    for i in np.flatnonzero(linked):
        assert home[i] == home_b[i] or home_b[i] in visits[i] or home[i] in visits_b[i]


def test_exact_products():
    rng = np.random.default_rng(1)
    for size, dims in [(3, 1), (300, 64), (70_000, 200), (1 << 24, 65)]:
        a, x = rng.integers(-size, size + 1, (5, dims)), rng.integers(-size, size + 1, (7, dims))
        want = [[sum(int(p) * int(q) for p, q in zip(r, s, strict=True)) for s in x] for r in a]
        assert hard_negatives.exact_products(a, x).tolist() == want
    edge = np.full((1, 64), 510), np.full((1, 64), -510)
    assert hard_negatives.exact_products(*edge).tolist() == [[-510 * 510 * 64]]
    with pytest.raises(ValueError, match="too large"):
        hard_negatives.exact_products(np.array([[1 << 40]]), np.array([[1 << 20]]))


def brute_negatives(rows, every, shift=None):
    dims = max([1, *(len(v) for _, v, _ in rows if v)])
    part = []
    for i, v, y in rows:
        if y is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        if shift and i is not None and i % shift[0] == 0:
            y = (y + 1) % shift[1]
        part.append((i, [math.floor(256 * float(np.float32(c))) for c in v] + [0] * (dims - len(v)), y))
    out, order = [], lambda s: (-s[1], s[0] is None, s[0] or 0)
    for a, (i, v, y) in enumerate(part):
        if i is None or i % every:
            continue
        scored = [(j, sum(p * q for p, q in zip(v, w, strict=True)), z) for b, (j, w, z) in enumerate(part) if b != a]
        for j, top, _ in sorted((s for s in scored if s[2] == y), key=order)[:5]:
            fit = sorted((s for s in scored if s[2] != y and 50 * top <= 100 * s[1] <= 95 * top), key=order)[:3]
            out += [(i, j, r, k, top, s) for r, (k, s, _) in enumerate(fit, 1)]
    return Counter(out)


@pytest.mark.parametrize("sizes", [(4096, 1024, 500_000), (16, 4, 50)])
def test_hard_negatives_agree_with_all_pairs(llm, sizes):
    block, group, held = sizes
    rng, dice = np.random.default_rng(7), random.Random(7)
    vectors = clustered(rng, 240, spread=0.3)
    rows = [(i, v, dice.choice([0, 0, 1, 2, 3])) for i, v in enumerate(vectors)]
    # ties and repeated rows, anchors among them
    rows += [(i, vectors[10], 1) for i in range(300, 312)] + [rows[10], rows[20], rows[30], (400, [-v for v in vectors[3]], 2)] + ODD
    got = hard_negatives.mine(table(llm, rows), every=10, shift=(7, 4), block=block, group=group, held=held)
    want = brute_negatives(rows, 10, (7, 4))
    assert Counter(map(tuple, got.collect())) == want
    assert len(want) > 100


def test_hard_negatives_of_nothing(llm):
    assert hard_negatives.mine(table(llm, [])).collect() == []
    assert hard_negatives.mine(table(llm, [(0, [1.0], 1), (1, [1.0], None), (2, None, 1)])).collect() == []
    with pytest.raises(Exception, match="too large"):
        hard_negatives.mine(table(llm, [(0, [1e30], 1), (1, [1e30], 1)])).collect()
