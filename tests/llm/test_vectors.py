"""Top-k search and near-duplicate vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import embed_dedup, topk

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, label, 0, "clash") for i, e, label in rows], SCHEMA)


def usable(e):
    return e is not None and all(x is not None and np.isfinite(x) for x in e)


def awkward(rng, n=300, d=8):
    rows = [(i, rng.standard_normal(d).astype(np.float32).tolist(), int(i % 3)) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [None] + [1.0] * (d - 1), 1), (n + 2, [float("nan")] * d, 1), (n + 20, [float("inf")] * d, 1)]
    rows += [(n + 3, [0.0] * d, 1), (n + 4, [], 1), (n + 5, rows[0][1], 0), (n + 6, rows[0][1], None), (n + 7, rows[0][1], 0)]
    rows += [(None, rows[1][1], 1), (n + 8, [1.0, 2.0], 2)]
    return rows


def best(rows, k):
    found = []
    known = [(i, np.floor(64 * np.array(e, np.float64)).astype(int)) for i, e, _ in rows if i is not None and usable(e)]
    width = max((len(v) for _, v in known), default=0)
    known = [(i, np.pad(v, (0, width - len(v)))) for i, v in known]
    for q, x in known:
        if q % 20 == 0:
            scores = sorted((-int(x @ y), i) for i, y in known if i != q)[:k]
            found += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(found)


@pytest.mark.parametrize("step", [16, 1024])
def test_top_k_equals_brute_force(spark, rows, monkeypatch, step):
    monkeypatch.setattr(topk, "STEP", step)
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "HEAD", 40)
    data = awkward(np.random.default_rng(3))
    vectors = topk.scaled(frame(spark, data), "vec_id", "embedding")
    assert rows(topk.top_k(vectors, vectors.where("id % 20 = 0"), 20)) == sorted(best(data, 20), key=repr)


def test_top_k_with_ties_and_few_rows(spark, rows):
    data = [(20, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)]
    vectors = topk.scaled(frame(spark, data), "vec_id", "embedding")
    assert rows(topk.top_k(vectors, vectors.where("id % 20 = 0"), 2)) == [(20, 1, 1, 4096), (20, 2, 2, 4096)]
    few = rows(topk.top_k(vectors, vectors.where("id % 20 = 0"), 20))
    assert [r[2] for r in few] == [1, 2, 3]
    nothing = topk.scaled(frame(spark, []), "vec_id", "embedding")
    assert rows(topk.top_k(nothing, nothing, 20)) == []


def test_pruning_keeps_every_result():
    rng = np.random.default_rng(5)
    c = (rng.standard_normal((3000, 16)) * rng.gamma(1.0, 40.0, (3000, 1))).astype(np.int64)
    q = (rng.standard_normal((20, 16)) * 50).astype(np.int64)
    turned = np.linalg.eigh((c.T @ c).astype(float))[1][:, ::-1]
    owner, ident, score = topk.search(np.arange(20) - 100, q, np.full(20, -np.inf), np.arange(3000), c, turned, 10)
    for k in range(20):
        exact = sorted((-int(s), i) for i, s in enumerate(c @ q[k]))[:10]
        assert [(-s, i) for s, i in zip(score[owner == k], ident[owner == k], strict=True)] == exact


def linked(rows, threshold=0.93):
    """(vec_id, n_links, component_id, kept) by comparing all pairs of rows."""
    good = [
        k for k, (i, e, label) in enumerate(rows)
        if i is not None and label is not None and usable(e) and len(e) and any(x != 0 for x in e)
    ]
    links = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a < b and rows[a][2] == rows[b][2] and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    out, seen = [], {}
    for k in range(len(rows)):
        if k not in seen:
            group, todo = {k}, [k]
            while todo:
                new = links[todo.pop()] - group
                group |= new
                todo += new
            for g in group:
                seen[g] = min((rows[x][0] for x in group), key=lambda i: (i is None, i))
        i = rows[k][0]
        out.append((i, len(links[k]), seen[k] if i is not None else None, i is not None and i == seen[k]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [3, 1024])
def test_near_duplicate_vectors_equal_brute_force(spark, rows, monkeypatch, block):
    """Close copies are found in some table; a group larger than a block goes through pairs of blocks."""
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    rng = np.random.default_rng(7)
    data = awkward(rng, 120, 16)
    centre = rng.standard_normal(16)
    data += [(1000 + i, (centre + 0.02 * rng.standard_normal(16)).tolist(), 1) for i in range(40)]
    data += [(2000 + i, (centre * (i + 1)).tolist(), 2) for i in range(5)]
    df = frame(spark, data)
    kept = [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e], label) for i, e, label in data]
    assert rows(embed_dedup.near_duplicates(df)) == linked(kept)


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold: at least nine of ten are found, none below it."""
    rng = np.random.default_rng(11)
    data = []
    for k in range(400):
        x = rng.standard_normal(64)
        x /= np.linalg.norm(x)
        y = rng.standard_normal(64)
        y -= (x @ y) * x
        y /= np.linalg.norm(y)
        cosine = 0.9305 if k % 2 else 0.9295
        data += [(2 * k, x.tolist(), 0), (2 * k + 1, (cosine * x + np.sqrt(1 - cosine**2) * y).tolist(), 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    found = embed_dedup.near_duplicates(df).where("n_links > 0")
    pairs = {r[0] // 2 for r in found.select("vec_id").collect()}
    assert all(p % 2 for p in pairs)
    assert len(pairs) >= 0.9 * 200


def test_no_vectors(spark, rows):
    assert rows(embed_dedup.near_duplicates(frame(spark, []))) == []
    alone = embed_dedup.near_duplicates(frame(spark, [(1, None, None)]).withColumn("kept", F.lit("clash")))
    assert rows(alone) == [(1, 0, 1, True)]


def test_blocks_too_short_for_every_query_are_not_met(spark, monkeypatch):
    """Lengths fall by a factor of a thousand: fewer than half of the block pairs are searched, the result is whole."""
    monkeypatch.setattr(topk, "BLOCK", 100)
    monkeypatch.setattr(topk, "QUERIES", 20)
    monkeypatch.setattr(topk, "HEAD", 100)
    rng, seen, kept = np.random.default_rng(8), [], topk.long_enough

    def counted(asked, blocks, n_blocks):
        out = kept(asked, blocks, n_blocks)
        seen.append((out.count(), asked.count() * blocks.count()))
        return out

    monkeypatch.setattr(topk, "long_enough", counted)
    x = rng.normal(size=(2000, 8)) * np.logspace(0, 3, 2000)[:, None]
    x[:5] = 0
    df = topk.scaled(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>"), "id", "vector")
    got = topk.top_k(df, df.where("id % 20 = 1"), 5).collect()
    v = np.floor(x * 64).astype(np.int64)
    for q in range(1, 2000, 20):
        score = v @ v[q]
        order = [i for i in np.lexsort((np.arange(2000), -score)) if i != q][:5]
        assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q) == [(k + 1, i, score[i]) for k, i in enumerate(order)]
    assert seen[0][0] * 2 < seen[0][1]


def test_packed_blocks_are_never_broadcast(spark, rows, monkeypatch):
    """Their stored size says little about the size of their vectors, so no plan may go by it."""
    monkeypatch.setattr(topk, "BLOCK", 64)
    plans, mapped = [], topk.arrow_map

    def planned(df, function, schema):
        if "cids" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return mapped(df, function, schema)

    monkeypatch.setattr(topk, "arrow_map", planned)
    data = [(i, [float(i % 7), 1.0], 0) for i in range(400)]  # repeated vectors take next to no room when stored
    vectors = topk.scaled(frame(spark, data), "vec_id", "embedding")
    assert rows(topk.top_k(vectors, vectors.where("id % 20 = 0"), 20)) == sorted(best(data, 20), key=repr)
    assert len(plans) == 1 and "Broadcast" not in plans[0] and "SortMergeJoin" in plans[0]


def test_the_driver_gets_the_longest_rows_only(spark, monkeypatch):
    data = [(i, [float(i), 0.0, 1.0], 0) for i in range(1000)]
    vectors = topk.scaled(frame(spark, data), "vec_id", "embedding").orderBy(F.col("norm").desc()).coalesce(1)
    blocks = topk.stored(topk._packed(vectors, 3, 100), "blocks")
    ids, found = topk.longest(blocks, 3, 250)
    assert ids.tolist() == list(range(999, 749, -1)) and found.shape == (250, 3)
    assert (found[:, 0] == 64 * ids).all()
    assert len(topk.longest(blocks, 3, 5000)[0]) == 800  # 8 blocks at most
    assert len(topk.longest(blocks.where("false"), 3, 10)[0]) == 0
