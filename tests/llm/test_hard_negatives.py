"""Hard negatives against brute force."""

import numpy as np
import pytest

from marketlake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, q long"


def mined(rows, factor=256.0, positives=5, negatives=3, every=50):
    good = [
        (i, label, np.floor(factor * np.array(e, np.float64)).astype(np.int64))
        for i, e, label in rows
        if i is not None and label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)
    ]
    width = max((len(v) for *_, v in good), default=0)
    good = [(i, label, np.pad(v, (0, width - len(v)))) for i, label, v in good]
    out = []
    for a, tag, x in {(i, label, tuple(v)): (i, label, v) for i, label, v in good if i % every == 0}.values():
        scores = [(int(x @ v), i, label) for i, label, v in good if i != a]
        best = sorted((-s, i) for s, i, label in scores if label == tag)[:positives]
        for p, positive in best:
            window = sorted((-s, i) for s, i, label in scores if label != tag and -50 * p <= 100 * s <= -95 * p)[:negatives]
            out += [(a, positive, r + 1, i, -p, -s) for r, (s, i) in enumerate(window)]
    return sorted(out, key=repr)


def clustered(rng, n, d, spread, clusters=12):
    centres = rng.standard_normal((clusters, d))
    v = centres[rng.integers(0, clusters, n)] + spread * rng.standard_normal((n, d))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def frame(spark, data):
    return spark.createDataFrame([(i, e, label, 0, "clash", 1) for i, e, label in data], SCHEMA)


def found(spark, data, every=50, **how):
    vectors = hn.integers(frame(spark, data), 256.0)
    return sorted((tuple(r) for r in hn.mine(vectors, vectors.where(f"id % {every} = 0"), **how).collect()), key=repr)


@pytest.mark.parametrize("spread", [0.2, 1.0])
def test_equals_brute_force(spark, monkeypatch, spread):
    for name, value in {"SAMPLE": 300, "LEAF": 40, "PAGE": 64, "PACKET": 16}.items():
        monkeypatch.setattr(hn, name, value)
    monkeypatch.setattr(hn.build_index, "__defaults__", (300, 40, 4, 64, 7))
    rng = np.random.default_rng(3)
    data = [(i, e.tolist(), int(rng.integers(0, 4))) for i, e in enumerate(clustered(rng, 900, 10, spread))]
    copy = data[50][1]
    data += [(1000 + i, copy, i % 3) for i in range(300)]  # a hot group of equal vectors
    data += [(2000, None, 1), (2050, copy, None), (None, copy, 1), (2100, [None] + copy[1:], 1), (2150, [float("nan")] * 10, 1)]
    data += [(2200, [float("inf")] * 10, 1), (2250, [0.0] * 10, 2), (2300, [0.5, -0.25], 2), (2350, [], 0), (2400, [3.0] * 10, 1)]
    data += [data[100], data[100], (150, copy, 2)]  # repeated rows, and an id with two vectors
    assert found(spark, data) == mined(data)


def test_parameters_and_small_tables(spark):
    rng = np.random.default_rng(5)
    data = [(i, e.tolist(), int(i % 2)) for i, e in enumerate(clustered(rng, 60, 6, 1.0))]
    assert found(spark, data, every=10, positives=2, negatives=7) == mined(data, positives=2, negatives=7, every=10)
    assert found(spark, data[:1]) == [] and found(spark, []) == []
    assert found(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []


def test_large_numbers(spark):
    data = [(i, [float(2**18 + i * 1024), 1.0], int(i % 2)) for i in range(120)]
    assert found(spark, data) == mined(data)
    with pytest.raises(ArithmeticError):
        found(spark, [(0, [1e12], 1)])


def test_ranges_exclude_leaves(spark):
    """On clustered vectors most pages are never sent to a query; the rest still hold every answer."""
    rng = np.random.default_rng(9)
    x = clustered(rng, 6000, 16, 0.15, 40)
    data = [(i, e.tolist(), int(rng.integers(0, 3))) for i, e in enumerate(x)]
    vectors = hn.integers(frame(spark, data), 256.0)
    index = hn.build_index(vectors, leaf=100, page=128)
    assert len(index.tree.paths) > 20
    v = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    q, own = index.space.queries(v[::50]), (v[::50] ** 2).sum(1)
    low, high = hn.bounds(index.tree, index.ranges, q)
    d = hn._distances(q, index.space.lifted(v))
    cell, _ = hn.assign(index.tree, index.space.lifted(v))
    assert (d >= low[:, cell] - index.space.slack()).all() and (d <= high[:, cell] + index.space.slack()).all()
    least = np.sort(v[::50] @ v.T, axis=1)[:, -6]
    live = low <= index.space.radius(own, least)[:, None] + index.space.slack()
    assert live.mean() < 0.3
