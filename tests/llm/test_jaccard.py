"""The Jaccard join against brute force, with short and long lists."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlake.llm import jaccard

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    group = {k: k for k in range(len(rows))}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and sets[a][0] is not None and sets[b][0] is not None:
                if 100 * len(x & y) >= 80 * len(x | y):
                    group[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, len(s), None if i is None else least[root(k)]) for k, (i, s) in enumerate(sets)), key=repr)


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(400))
    passage = [word() for _ in range(60)]
    rows, base = [], [[word() for _ in range(rng.randint(3, 90))] for _ in range(60)]
    for k in range(40):  # one group of near copies, chained: each differs a little more
        near = list(base[0] + base[1] + base[2])
        for _ in range(rng.randint(0, 3)):
            near[rng.randrange(len(near))] = word()
        rows.append(near)
    for b in base:
        rows += [b, b] if rng.random() < 0.3 else [b]
        if rng.random() < 0.5:
            rows.append(b[: max(1, int(len(b) * rng.uniform(0.7, 1)))])
        if rng.random() < 0.5:
            rows.append(b + passage)  # a passage that many documents share
        if rng.random() < 0.3:
            rows.append(passage + b[:4])
    rng.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize(("paired", "hot"), [(6, 200_000), (2, 200_000), (3, 4)])
def test_equals_brute_force(spark, rows, monkeypatch, paired, hot):
    """Short lists in full, all lists through hubs, and lists dealt over several tasks."""
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "HOT", hot)
    data = corpus()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert rows(jaccard.near_duplicates(df)) == components(data)


def test_awkward_rows(spark, rows, awkward_docs, no_docs):
    data = [(r["doc_id"], r["text"]) for r in awkward_docs.collect()]
    clash = awkward_docs.withColumn("one", F.lit(1)).withColumn("n", F.lit("x"))
    assert rows(jaccard.near_duplicates(clash)) == components(data)
    assert rows(jaccard.near_duplicates(no_docs)) == []
    empty = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id long, text string")
    assert rows(jaccard.near_duplicates(empty)) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_shingles_follow_the_word_rule():
    texts = pa.array(["A b\tc\x0bD e f", None, "", "x  y", "a b c d e f a b c d e"])
    assert [len(s) for s in jaccard.shingle_sets(texts)] == [2, 0, 0, 1, 6]
    a, b = jaccard.shingle_sets(pa.array(["a B c d E", "A b C D e"]))
    assert (a == b).all()
    # no blurring of word borders
    a, b = jaccard.shingle_sets(pa.array(["ab c d e f", "a bc d e f"]))
    assert (a != b).all()


def test_sets_of_one_name_are_told_apart(spark, rows, monkeypatch):
    """Different sets whose first numbers are equal get other names."""
    real, data = jaccard.signature, corpus(3)

    def weak(s, renamed=frozenset()):
        one, two = real(s)
        return (two if one % 50 in renamed else one % 50), two

    monkeypatch.setattr(jaccard, "signature", weak)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert rows(jaccard.near_duplicates(df)) == components(data)


def test_components_of_many_blocks(spark, rows, monkeypatch):
    """Groups of pairs by two blocks link what one group would."""
    monkeypatch.setattr(jaccard, "BLOCK", 300)
    data = corpus(4)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert rows(jaccard.near_duplicates(df)) == components(data)


def test_sets_move_once_for_all_pairs(spark, monkeypatch):
    """However many pairs a set is in, it goes to one group of a small component."""
    pairs = spark.createDataFrame([(a, b, 50, 50) for a in range(30) for b in range(a)], "a long, b long, na long, nb long")
    placed = jaccard._placed(pairs)
    assert placed.count() == 435 and placed.select("c", "i", "j").distinct().count() == 1
    monkeypatch.setattr(jaccard, "BLOCK", 500)  # three blocks
    placed = jaccard._placed(pairs)
    assert placed.count() == 435 and placed.select("c", "i", "j").distinct().count() == 6
    monkeypatch.setattr(jaccard, "BLOCK", 1 << 20)
    monkeypatch.setattr(jaccard, "PAIRS", 30)  # four blocks for 435 pairs
    placed = jaccard._placed(pairs)
    assert placed.count() == 435 and placed.select("c", "i", "j").distinct().count() == 10


def test_document_rows_of_copies_are_dealt(spark):
    """Neither copies of a text nor rows of one id get one key."""
    for ids in (range(200), [7] * 200):
        b = pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "text": ["a b c d e f"] * 200})
        run = jaccard._postings(jaccard.np.zeros(1 << jaccard.COUNTERS, jaccard.np.int32), 1, 80, 5, frozenset())
        docs = next(iter(run(iter([b]))))
        assert len(set(docs.column("key").to_pylist())) == 200
