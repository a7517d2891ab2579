"""Quality classifier: similarity-weighted votes of nearest labelled latent-semantic vectors."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, batch, batch_rows, word_hashes, words

#: Labelled rows learned from at most, latent dimensions, neighbours that vote, the power of
#: a similarity in its vote, hashed pair terms, and the score from which a document is accepted.
SAMPLE, DIMENSIONS, NEIGHBOURS, POWER, PAIRS, ACCEPT = 4096, 48, 15, 8, 1024, 0.7
#: Documents scored in one product.
ROWS = 256


def _byte_classes() -> np.ndarray:
    """0 letters and bytes beyond ASCII, 1 capitals, 2 digits, 3 blanks, 4 line ends, then each mark its own."""
    kind = np.zeros(256, np.int64)
    for b in range(128):
        c = chr(b)
        kind[b] = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 4 if c == "\n" else 3 if b <= 32 else 5
    marks = np.flatnonzero(kind == 5)
    kind[marks] = 5 + np.arange(len(marks))
    return kind


CLASSES = _byte_classes()
RUNS = 3 * (int(CLASSES.max()) + 1)
#: Columns of hashed words; the weights tried for them, and the learned rows they are tried on at most.
WORD_TERMS, WORD_WEIGHTS, TRIED = 1024, (0.2, 0.5, 1.0), 1024
#: Terms: lower-cased words (hashed) and, as further columns, the shape of the text: runs of a class by
#: length (1, 2 or 3, more), pairs of runs (hashed), word lengths, words equal to the one before, words.
SHAPE = WORD_TERMS + RUNS + PAIRS
TERMS = SHAPE + 24 + 2


def term_counts(texts: pa.Array) -> np.ndarray:
    """(texts, TERMS) counts over the whole texts; nulls count as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    lengths = np.diff(offsets)
    out = np.zeros((n, TERMS), np.float32)
    if not len(data):
        return out
    kind = CLASSES.astype(np.uint8)[data]
    change = np.empty(len(data), bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change[offsets[:-1][lengths > 0]] = True
    start = np.flatnonzero(change)
    size = np.diff(np.append(start, len(data)))
    owner = np.searchsorted(offsets, start, "right") - 1
    run = kind[start].astype(np.int64) * 3 + np.minimum(size, 4) // 2
    flat, ends = words(texts)
    column = (word_hashes(flat) % np.uint64(WORD_TERMS)).astype(np.int64)
    column += np.repeat(np.arange(n), np.diff(ends)) * WORD_TERMS
    out[:, :WORD_TERMS] = np.bincount(column, minlength=n * WORD_TERMS).reshape(n, WORD_TERMS)
    at = WORD_TERMS
    out[:, at : at + RUNS] = np.bincount(owner * RUNS + run, minlength=n * RUNS).reshape(n, RUNS)
    same = owner[1:] == owner[:-1]
    pair = ((run[:-1] * RUNS + run[1:]) * 2654435761 >> 12) % PAIRS
    out[:, at + RUNS : SHAPE] = np.bincount((owner[:-1] * PAIRS + pair)[same], minlength=n * PAIRS).reshape(n, PAIRS)
    # words: stretches without blanks or line ends
    blank = (kind == 3) | (kind == 4)
    begins = ~blank
    begins[1:] &= blank[:-1]
    begins[offsets[:-1][lengths > 0]] = ~blank[offsets[:-1][lengths > 0]]
    first = np.flatnonzero(begins)
    if len(first):
        ends = np.append(first[1:], len(data))
        of = np.searchsorted(offsets, first, "right") - 1
        stop = np.minimum(ends, offsets[of + 1])
        # up to the next blank: the blanks before the next word are not part of it
        gaps = np.add.reduceat(blank.astype(np.int64), first)
        long = stop - first - np.minimum(gaps, stop - first)
        at = SHAPE
        out[:, at : at + 24] = np.bincount(of * 24 + np.minimum(long, 24) - 1, minlength=n * 24).reshape(n, 24)
        # words are told apart by length, first and last eight bytes
        pad = np.concatenate([data, np.zeros(8, np.uint8)])
        mark = long.copy()
        for k in range(4):
            mark = mark * 257 + np.where(long > k, pad[first + k], 0)
            mark = mark * 257 + np.where(long > k, pad[np.maximum(first + long - 1 - k, 0)], 0)
        again = np.flatnonzero((mark[1:] == mark[:-1]) & (of[1:] == of[:-1])) + 1
        out[:, at + 24] = np.bincount(of[again], minlength=n)
        out[:, at + 25] = np.bincount(of, minlength=n)
    return out


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts)
    x *= idf
    x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x))[:, None], 1e-9)
    return x


def choose_weight(counts: np.ndarray, labels: np.ndarray, weights: tuple[float, ...] = WORD_WEIGHTS, folds: int = 3) -> float:
    """The weight of words with the best ranking of learned rows that each fold leaves out.

    Only rows that may be learned from come here.  Of weights within a thousandth of the best
    the largest is taken, so that words count as much as these labels allow.
    """
    counts, labels = counts[:TRIED], labels[:TRIED]
    own = np.arange(len(labels)) % folds
    if len(labels) < 30 or any(len(np.unique(labels[own != k])) < 2 for k in range(folds)):
        return max(weights)
    reached = []
    for weight in weights:
        score = np.zeros(len(labels))
        for k in range(folds):
            score[own == k] = vote(fit(counts[own != k], labels[own != k], weight=weight), counts[own == k])
        good, bad = score[labels == 1], score[labels == 0]
        order = good[:, None] - bad[None, :]
        reached.append(((order > 0).mean() + 0.5 * (order == 0).mean(), weight))
    best = max(reached)[0]
    return max(w for r, w in reached if r >= best - 0.001)


def fit(counts: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS, weight: float = 1.0) -> dict:
    """The projection onto the leading singular vectors and the labelled vectors in that space."""
    if not len(labels):
        return {"idf": np.zeros(TERMS, np.float32), "axes": np.zeros((TERMS, 1), np.float32), "x": np.zeros((0, 1), np.float32), "y": labels}
    idf = np.log1p(len(counts) / (1.0 + (counts > 0).sum(axis=0))).astype(np.float32)
    idf[:WORD_TERMS] *= weight
    x = _weighted(counts, idf)
    kept = min(dimensions, *x.shape)
    # leading singular vectors by block power steps: no matrix of terms by terms
    axes = np.random.default_rng(7).standard_normal((x.shape[1], min(kept + 16, *x.shape))).astype(np.float32)
    for _ in range(40):
        axes, _ = np.linalg.qr(x.T @ (x @ axes))
    _, _, turn = np.linalg.svd(x @ axes, full_matrices=False)
    axes = axes @ turn[:kept].T
    axes = np.ascontiguousarray(axes).astype(np.float32)
    return {"idf": idf, "axes": axes, "x": _unit(x @ axes), "y": labels.astype(np.float32)}


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


def vote(model: dict, counts: np.ndarray, neighbours: int = NEIGHBOURS, power: float = POWER) -> np.ndarray:
    """The share of label 1 among the nearest labelled vectors, weighted by similarity."""
    y = model["y"]
    if not len(y):
        return np.full(len(counts), 0.5)
    near = _unit(_weighted(counts, model["idf"]) @ model["axes"]) @ model["x"].T
    k = min(neighbours, len(y))
    at = np.argpartition(-near, k - 1, axis=1)[:, :k]
    w = np.maximum(np.take_along_axis(near, at, axis=1), 1e-3).astype(np.float64) ** power
    return (w * y[at]).sum(axis=1) / w.sum(axis=1)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, fold: int = 2, folds: int = 4) -> dict:
    """Fit on the labelled documents outside the held-out fold, `sample` of them at most.

    The sample takes the rows of least hash, so it is the same in each run.  Rows with a
    null id or label aren't learned from; a document with several labels votes with each.
    """
    known = labels.where("doc_id is not null and quality is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")
    )
    known = known.where(~_held_out("doc_id", fold, folds)).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")

    def counted(b: pa.RecordBatch) -> pa.RecordBatch:
        counts = term_counts(b.column("text"))
        return batch(doc_id=b.column("doc_id"), y=b.column("y"), x=pa.array([zlib.compress(c.tobytes(), 1) for c in counts], pa.binary()))

    # at most `sample` labelled rows reach the driver, unless ids repeat among the documents
    rows = arrow_map(texts, counted, "doc_id long, y int, x binary").limit(sample).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["y"], r["x"]))
    counts = np.zeros((len(rows), TERMS), np.float32)
    for own, r in zip(counts, rows, strict=True):
        own[:] = np.frombuffer(zlib.decompress(r["x"]), np.float32)
    y = np.array([r["y"] for r in rows], np.float32)
    # rows come by id, so a shuffle of fixed seed makes the folds
    order = np.random.default_rng(11).permutation(len(rows))
    return fit(counts, y, weight=choose_weight(counts[order[:TRIED]], y[order[:TRIED]]))


def _held_out(doc_id: str, fold: int, folds: int):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted), and the `keep` columns, for each row of (doc_id, text).

    The labelled vectors are broadcast (SAMPLE rows of DIMENSIONS numbers at most); every
    document's whole text is projected and compared with all of them in blocks.  Labels,
    ids and other columns are no inputs of a score.  Null and empty texts get the votes
    for an empty vector, whose similarities are all equal; without labelled rows every
    score is 0.5.  Repeated rows and null ids are scored like others (held_out false for a null id).
    """
    spark = docs.sparkSession
    batch_rows(spark, ROWS)
    model = train(docs, labels)
    empty = float(model["y"].mean()) if len(model["y"]) else 0.5
    shared = spark.sparkContext.broadcast(model)
    keep = keep or []
    kinds = dict(docs.dtypes)

    def scored(b: pa.RecordBatch) -> pa.RecordBatch:
        counts = term_counts(b.column("text"))
        score = np.where(counts.any(axis=1), vote(shared.value, counts), empty)
        return batch(_id=b.column("_id"), score=np.clip(score, 0.0, 1.0), **{c: b.column(c) for c in keep})

    rows = docs.select(F.col("doc_id").alias("_id"), "text", *[c for c in keep if c != "text"])
    kept = "".join(f", `{c}` {kinds[c]}" for c in keep)
    found = arrow_map(rows, scored, f"_id {kinds['doc_id']}, score double{kept}")
    predicted = (F.col("score") >= accept).cast("int").alias("predicted")
    return found.select(F.col("_id").alias("doc_id"), _held_out("_id", 2, 4).alias("held_out"), "score", predicted, *[c for c in keep if c != "doc_id"])
