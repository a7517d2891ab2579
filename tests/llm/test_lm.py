import collections
import math
import mmap
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.llm import ngram_lm as lm

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@given(st.lists(st.integers(0, 2**45), max_size=60, unique=True), st.integers(0, 2**45))
@settings(deadline=None, max_examples=200)
def test_elias_fano_holds_what_it_was_given(values, other):
    values = np.array(sorted(values), np.uint64)
    levels = lm.EliasFano.of(values, 2**45 + 1)
    assert (levels.get(np.arange(len(values))) == values).all()
    assert (levels.find(values) == np.arange(len(values))).all()
    at = levels.find(np.array([other], np.uint64))[0]
    assert at == (list(values).index(other) if other in values else -1)


def test_dense_and_repeated_pointers():
    values = np.array([0, 0, 0, 1, 5, 5, 9, 9])
    assert (lm.EliasFano.of(values, 10).get(np.arange(8)) == values).all()


def test_trie_is_read_in_place_from_a_file(tmp_path):
    rng = np.random.default_rng(2)
    pairs = np.unique(rng.integers(0, 500, (3000, 2)).astype(np.uint64), axis=0) * np.uint64(2**30 + 7)
    counts = rng.integers(1, 50_000, len(pairs))
    path = tmp_path / "trie"
    path.write_bytes(lm.Trie.build(pairs[:, 0], pairs[:, 1], counts).to_bytes())
    with open(path, "rb") as f:
        trie = lm.Trie.mapped(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    found = lm.CODES[trie.counts(pairs[:, 0], pairs[:, 1])]
    assert np.abs(found / counts - 1).max() <= 0.002
    assert not trie.counts(pairs[:, 0], pairs[:, 1] + np.uint64(1)).any()
    own, many = np.unique(pairs[:, 0], return_counts=True)
    assert (trie.branching(own) == many).all()
    assert not trie.branching(own + np.uint64(3)).any()


def expected(rows, discount=lm.DISCOUNT):
    tokens = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)) + [None] for _, t, _ in rows]
    c, pairs = collections.Counter(), collections.Counter()
    for w, (_, _, held) in zip(tokens, rows, strict=True):
        if not held:
            c.update(w)
            pairs.update(zip([None, *w[:-1]], w, strict=True))
    n, v, after = sum(c.values()), len(c), collections.Counter(a for a, _ in pairs)
    p1 = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))

    def p(a, b):
        return (max(pairs[a, b] - discount, 0) + discount * after[a] * p1(b)) / c[a] if c[a] else p1(b)

    return [
        (i, bool(held), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10(p1(x)) for x in w),
         sum(math.log10(p(a, b)) for a, b in zip([None, *w[:-1]], w, strict=True)))
        for (i, _, held), w in zip(rows, tokens, strict=True)
    ]


def check(df, rows):
    key = lambda r: (repr(r[:5]), round(r[5], 3))
    found, wanted = sorted(map(tuple, df.collect()), key=key), sorted(expected(rows), key=key)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    for a, b in zip(found, wanted, strict=True):
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] == pytest.approx(b[6], rel=1e-3)


@pytest.mark.parametrize(("block", "shard", "hot"), [(1_500_000, 1_500_000, 0.0005), (300, 200, 0.01)])
def test_scores_equal_brute_force(spark, sf_dir, monkeypatch, block, shard, hot):
    """In one block and shard, and in many, with frequent words dealt over the shards."""
    for name, value in (("BLOCK", block), ("SHARD", shard), ("HOT", hot)):
        monkeypatch.setattr(lm, name, value)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (F.col("doc_id") % 4 == 1).alias("held"))
    check(lm.score(docs.where("doc_id < 60")), [tuple(r) for r in docs.where("doc_id < 60").collect()])


def test_model_beats_the_base_on_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (F.col("doc_id") % 5 == 1).alias("held"))
    base, model = lm.score(docs).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert model > base


def test_awkward_rows(spark, awkward_docs, no_docs):
    docs = awkward_docs.select("doc_id", "text", F.col("doc_id").isin(8, 9).alias("held"), F.lit("clash").alias("block"))
    check(lm.score(docs), [(r["doc_id"], r["text"], bool(r["held"])) for r in docs.collect()])
    assert lm.score(no_docs.withColumn("held", F.lit(True))).count() == 0
    unlearned = lm.score(docs.withColumn("held", F.lit(True))).select("train_tokens", "n_known").distinct().collect()
    assert [tuple(r) for r in unlearned] == [(0, 0)]


def expected_of_order(rows, order, d=lm.DISCOUNT):
    texts = [[None, *re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)), None] for _, t, _ in rows]
    grams = collections.Counter()
    for w, (_, _, held) in zip(texts, rows, strict=True):
        if not held:
            grams.update(tuple(w[i - n + 1 : i + 1]) for i in range(1, len(w)) for n in range(1, order + 1) if n <= i + 1)
    total, v = sum(c for g, c in grams.items() if len(g) == 1), sum(len(g) == 1 for g in grams)
    after = collections.Counter(g[:-1] for g in grams)

    def p(g):
        if len(g) == 1:
            return (grams[g] + 0.5) / (total + 0.5 * (v + 1))
        c = grams[g[:-1]]
        return (max(grams[g] - d, 0) + d * after[g[:-1]] * p(g[1:])) / c if c else p(g[1:])

    return {i: sum(math.log10(p(tuple(w[max(0, k - order + 1) : k + 1]))) for k in range(1, len(w))) for (i, _, _), w in zip(rows, texts, strict=True)}


@pytest.mark.parametrize(("order", "block", "shard", "hot"), [(3, 1_500_000, 1_500_000, 0.0005), (3, 300, 200, 0.004), (4, 300, 200, 0.004)])
def test_longer_contexts_equal_brute_force(spark, sf_dir, monkeypatch, order, block, shard, hot):
    for name, value in (("BLOCK", block), ("SHARD", shard), ("HOT", hot)):
        monkeypatch.setattr(lm, name, value)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (F.col("doc_id") % 4 == 1).alias("held")).where("doc_id < 40")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(1000, "the end the end the end", False), (1001, "the end the", True), (1002, None, False)]
    wanted = expected_of_order(rows, order)
    found = {r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame(rows, docs.schema), order=order).collect()}
    assert found == pytest.approx(wanted, rel=1e-3)


def test_the_query_scores_with_trigrams(spark, sf_dir):
    from marketlake.llm.queries import op4_lm_scoring

    query, three, two = (
        {r["doc_id"]: r["score"] for r in df.collect()}
        for df in (op4_lm_scoring(spark, sf_dir), *(lm.score(_held(spark, sf_dir), order=n) for n in (3, 2)))
    )
    assert query == pytest.approx(three) and any(abs(three[i] - two[i]) > 1 for i in three)


def _held(spark, sf_dir):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", held.alias("held"))


def test_n_grams_of_a_block_of_many_words_stay_apart(spark):
    """Pairs times words pass 32 bits: every trigram keeps its own count, and none has probability 0."""
    rng = np.random.default_rng(5)
    learned = [f"w{i}" for i in rng.permutation(60_000)]
    mixed = [w for i in range(0, 3000, 3) for w in (*learned[i : i + 3], f"new{i}", learned[-i - 1])]
    rows = [(1, " ".join(learned), False), (2, " ".join(learned[20_000:30_000]), False), (3, " ".join(mixed), True), (4, " ".join(learned[:900]), True)]
    found = lm.score(spark.createDataFrame(rows, "doc_id long, text string, held boolean"), order=3).collect()
    assert {r["doc_id"]: r["score"] for r in found} == pytest.approx(expected_of_order(rows, 3), rel=1e-3)
    assert all(math.isfinite(r["score"]) for r in found)


@pytest.mark.parametrize(("columns", "top"), [(1, 7), (1, 2**63), (2, 9), (2, 2**40), (3, 2**20), (3, 2**48)])
@pytest.mark.parametrize("n", [0, 1, 2000])
def test_different_rows_and_their_ranks(columns, top, n):
    rng = np.random.default_rng(n + columns)
    rows = [np.concatenate([x, x[: n // 2]]) for x in rng.integers(0, top, (columns, n), dtype=np.uint64)]
    place, rank = lm._distinct(*rows)
    own = sorted(set(zip(*(r.tolist() for r in rows), strict=True)))
    assert list(zip(*(r[place].tolist() for r in rows), strict=True)) == own
    assert [own[k] for k in rank] == list(zip(*(r.tolist() for r in rows), strict=True))


@pytest.mark.parametrize("top", [3000, 2**45])  # by a table, by a search
def test_a_level_read_in_order_finds_the_same(top):
    rng = np.random.default_rng(4)
    values = np.unique(rng.integers(0, top, 2000, dtype=np.uint64))
    level, asked = lm.EliasFano.of(values, top), np.concatenate([values[::-1], rng.integers(0, 2 * top, 3000, dtype=np.uint64)])
    assert (level.all() == values).all()
    at = lm._found(level, asked)
    assert (at == level.find(asked)).all()
    assert (values[at[at >= 0]] == asked[at >= 0]).all() and (at[: len(values)] >= 0).all()


def test_what_many_blocks_ask_is_looked_for_once(monkeypatch):
    tokens = [0, 1, 2, 1, 2, 1, 3, 0]
    row = {
        "doc_id": [1], "held": [False], "size": [len(tokens)], "tokens": lm._squeezed(lm._planes(np.array([0, *tokens]), 4)),
        "words": lm._squeezed(lm._planes(np.array([5, 9, 2**31, 2**40], np.uint64), 6)),
    }
    none = np.zeros(0, np.uint64)
    data = lm._Block(row).questions(3, [1, 1], none)
    asked = [b.column("data")[0].as_py() for b in data]
    looked, answer = [], lm.Trie.answer
    monkeypatch.setattr(lm.Trie, "answer", lambda self, context, each, word: (looked.append(len(word)), answer(self, context, each, word))[1])
    for n, question in enumerate(asked, 2):
        own = {tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1)} | ({(0, 0)} if n == 2 else {(0, 0, 1)})
        once = [b.column("data")[0].as_py() for b in lm._gram_answers(none)(0, f"gram{n}", [1], [question])]
        twice = [b.column("data")[0].as_py() for b in lm._gram_answers(none)(0, f"gram{n}", [1, 2], [question] * 2)]
        contexts, _, word, seen = lm._question(question, n)
        codes = lambda d: lm._numbers(lm._opened(d)[contexts.shape[1] * 4 :], 2)  # noqa: B023, E731
        assert len(word) <= len(own) and looked[-2:] == [len(word)] * 2
        assert twice[0] == twice[1] and (codes(once[0]) == seen).all() and (codes(twice[0]) == 2 * seen).all()
