import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from marketlake.llm import quality
from marketlake.llm.common import read


def test_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    labels = read(spark, big, "labels")
    out = quality.classify(read(spark, big, "documents"), labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (out.predicted == out.quality).mean() >= 0.95
    good, bad = out[out.quality == 1].score, out[out.quality == 0].score
    assert (good.to_numpy()[:, None] > bad.to_numpy()[None]).mean() > 0.97
    assert (out.predicted[out.quality == 1] == 1).mean() >= 0.98
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(out.doc_id, out.held_out, strict=True))


def test_ids_and_held_out_labels_are_no_inputs(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.classify(docs, x).orderBy("doc_id").toPandas() for x in (labels, flipped))
    assert a.equals(b)
    ours, theirs = (quality.train(docs, x) for x in (labels, flipped))  # parameters are chosen without them too
    assert ours.keys() == theirs.keys() and all((ours[k] == theirs[k]).all() for k in ours)


def test_the_weight_of_words_is_chosen_on_learned_rows():
    """Words decide here, shapes are noise: the largest weight; the other way round, the smallest."""
    rng = np.random.default_rng(2)
    y = (np.arange(300) % 2).astype(np.float32)
    words, shape = np.zeros((300, quality.WORD_TERMS)), np.zeros((300, quality.TERMS - quality.WORD_TERMS))
    told = lambda m: m[:, :20].__iadd__(rng.poisson(1 + 3 * np.arange(20)[None, :] % 2 == y[:, None], (300, 20)))
    noise = lambda m: m.__iadd__(rng.poisson(0.3, m.shape))
    noise(words), noise(shape), told(words)
    assert quality.choose_weight(np.hstack([words, shape]).astype(np.float32), y) in quality.WORD_WEIGHTS
    assert quality.choose_weight(np.zeros((3, quality.TERMS), np.float32), y[:3]) == max(quality.WORD_WEIGHTS)


def test_votes_equal_brute_force():
    rng = np.random.default_rng(1)
    counts = rng.poisson(1.0, (60, quality.TERMS)).astype(np.float32)
    model = quality.fit(counts[:40], (np.arange(40) % 3 > 0).astype(np.float32), 8)
    score = quality.vote(model, counts[40:], 5, 8)
    x = np.sqrt(counts[40:]) * model["idf"]
    x = x / np.linalg.norm(x, axis=1, keepdims=True) @ model["axes"]
    near = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ model["x"].T
    for k in range(20):
        at = np.argsort(-near[k])[:5]
        w = np.maximum(near[k][at], 1e-3) ** 8
        assert abs(score[k] - (w * model["y"][at]).sum() / w.sum()) < 1e-4


def test_counts_cover_whole_texts_and_do_not_leak():
    texts = ["ab AB  12!", "", None, "x x x y", "é" * 5000 + " end", "a\nb"]
    together = quality.term_counts(pa.array(texts))
    for k, t in enumerate(texts):
        assert (together[k] == quality.term_counts(pa.array([t], pa.string()))[0]).all()
    assert not together[1].any() and not together[2].any()
    assert together[:, -1].tolist() == [3, 0, 0, 4, 2, 2]  # words
    assert together[3, -2] == 2  # words equal to the one before


def test_awkward_rows(spark, awkward_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, None, 0), (None, 1, 0), (5, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    docs = awkward_docs.withColumn("score", F.lit("clash"))
    out = quality.classify(docs, labels).toPandas()
    assert len(out) == 12 and out.score.between(0, 1).all()
    assert out.held_out[out.doc_id.isna()].eq(False).all()
    none = quality.classify(docs, labels.limit(0)).toPandas()
    assert (none.score == 0.5).all() and (none.predicted == 0).all()
    assert quality.classify(no_docs, labels).count() == 0


def test_words_of_equal_shape_are_told_apart(spark):
    """Two vocabularies of the same word lengths and marks: only the words say which is labelled good."""
    rng = np.random.default_rng(5)
    names = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(400)]
    text = lambda good: " ".join(rng.choice(names[:200] if good else names[200:], 40)).capitalize() + "."
    rows = [(i, text(i % 2), i % 2) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    shape = quality.term_counts(pa.array([t for _, t, _ in rows]))[:, quality.WORD_TERMS :]
    shape = np.delete(shape, -2, axis=1)  # a word after itself comes by chance in both
    assert (shape == shape[0]).all()
    out = quality.classify(table.select("doc_id", "text"), table.select("doc_id", "quality")).where("held_out").toPandas()
    assert (out.predicted == out.doc_id % 2).mean() >= 0.95
