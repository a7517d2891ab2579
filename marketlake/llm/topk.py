"""Exact top-k inner products: norm-sorted blocks, rotated partial sums, residual bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, batch, batch_rows, stored

#: Candidates of a stored block, queries of a block, candidates of the first look, of a step.
BLOCK, QUERIES, HEAD, STEP = 8192, 2048, 4096, 1024
_BLOCKS = "part int, seq int, top double, ids binary, data binary"


def scaled(df: DataFrame, id: str, vector: str, factor: float = 64.0) -> DataFrame:
    """(id, v, norm): v holds floor(factor * x) of each component, computed in double.

    Vectors without id, null vectors and vectors with a null or non-finite component are
    left out.  Scores are exact while they and |v| stay below 2^53.
    """
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    good = F.col(vector).isNotNull() & F.col(id).isNotNull()
    # NaN sorts above infinity, so one comparison of the magnitude excludes both
    bad = F.exists(x, lambda e: e.isNull() | (F.abs(e) >= F.lit(float("inf"))))
    ints = df.where(good).where(~bad).select(
        F.col(id).cast("long").alias("id"), F.transform(x, lambda e: F.floor(e * factor)).alias("v")
    )
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e))
    return ints.withColumn("norm", norm)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix; shorter ones are padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), lengths), np.concatenate([np.arange(n) for n in lengths] or [[]]).astype(int)] = flat
    return out


def _packed(df: DataFrame, width: int, rows: int) -> DataFrame:
    """Each partition's rows, as they come, in stored blocks of packed ids and integers."""

    def run(batches):
        held, count, seq = [], 0, 0
        part = TaskContext.get().partitionId()

        def block():
            ids = np.concatenate([h[0] for h in held])
            m = np.concatenate([h[1] for h in held])
            top = float(np.sqrt((m.astype(float) ** 2).sum(1)).max())
            return batch(
                part=pa.array([part], pa.int32()), seq=pa.array([seq], pa.int32()), top=[top],
                ids=pa.array([ids.tobytes()], pa.binary()), data=pa.array([m.tobytes()], pa.binary()),
            )

        for b in batches:
            ids, m = b.column("id").to_numpy(), _matrix(b.column("v"), width)
            for i in range(0, len(ids), rows):
                held.append((ids[i : i + rows], m[i : i + rows]))
                count += len(held[-1][0])
                if count >= rows:
                    yield block()
                    held, count, seq = [], 0, seq + 1
        if held:
            yield block()

    return df.select("id", "v").mapInArrow(run, _BLOCKS)


def _best(owner: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Indices of each owner's k highest scores, ties to the smaller id, by owner and rank."""
    order = np.lexsort((ident, -score, owner))
    o = owner[order]
    first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]]) if len(o) else np.zeros(0, int)
    rank = np.arange(len(o)) - np.repeat(first, np.diff(np.r_[first, len(o)]))
    return order[rank < k]


def search(qid, q, least, cid, c, rotation, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, candidate id, score): all of each query's k best that reach `least`.

    Candidates are taken by descending length.  A step is left when the longest candidate
    times the longest query can't reach any threshold; within it a pair is left when the
    partial sum over the leading rotated dimensions plus the product of the residual
    lengths (Cauchy-Schwarz) stays below the query's threshold.  Survivors get the exact
    integer product.
    """
    least = least.astype(float).copy()
    length = np.sqrt((c.astype(float) ** 2).sum(1))
    order = np.argsort(-length, kind="stable")
    cid, c, length = cid[order], c[order], length[order]
    lead = max(1, c.shape[1] // 4) if c.shape[1] else 0
    qr, cr = q @ rotation, c @ rotation
    q_len = np.sqrt((q.astype(float) ** 2).sum(1))
    q_rest = np.sqrt((qr[:, lead:] ** 2).sum(1))
    c_rest = np.sqrt((cr[:, lead:] ** 2).sum(1))
    held = [np.zeros(0, np.int64)] * 3
    for at in range(0, len(cid), STEP):
        here = slice(at, at + STEP)
        slack = 1e-6 * (1 + length[at] * q_len)
        live = np.flatnonzero(length[at] * q_len + slack >= least)
        if not len(live):
            if (length[at] * q_len.max(initial=0) + slack.max(initial=0)) < least.min(initial=np.inf):
                break
            continue
        bound = qr[live, :lead] @ cr[here, :lead].T + np.outer(q_rest[live], c_rest[here])
        keep = bound + slack[live, None] >= least[live, None]
        keep &= cid[None, here] != qid[live, None]
        qi, ci = np.nonzero(keep)
        if len(qi) * 4 > keep.size and q.shape[1]:
            # the products of integers below 2^53 are exact in double
            score = (q[live].astype(float) @ c[here].T.astype(float))[qi, ci].astype(np.int64)
        else:
            score = np.concatenate(
                [np.einsum("ij,ij->i", q[live[qi[i : i + 65536]]], c[here][ci[i : i + 65536]]) for i in range(0, len(qi), 65536)]
                or [np.zeros(0, np.int64)]
            )
        good = score >= least[live[qi]]
        new = (live[qi[good]], cid[here][ci[good]], score[good])
        held = [np.concatenate(x) for x in zip(held, new, strict=True)]
        best = _best(held[0], held[2], held[1], k)
        held = [x[best] for x in held]
        # a query with k results needs at least the last one's score
        full = np.flatnonzero(np.bincount(held[0], minlength=len(qid)) == k)
        ends = np.searchsorted(held[0], full, "right") - 1
        least[full] = np.maximum(least[full], held[2][ends])
    return tuple(held)


def needed_length(q: np.ndarray, least: np.ndarray) -> float:
    """The least length with which a candidate can reach the threshold of some query, with the slack of `search`."""
    length = np.sqrt((q.astype(float) ** 2).sum(1))
    short = np.where(least <= 1e-6, -np.inf, np.inf)  # a query of length 0 scores 0
    needs = np.divide(least - 1e-6, length * (1 + 1e-6), out=short, where=length > 0)
    return float(needs.min(initial=np.inf))


def long_enough(asked: DataFrame, blocks: DataFrame, n_blocks: int) -> DataFrame:
    """(qb, cb) for asked (qb, needs) and blocks (cb, top) with top >= needs: numbers only, no vectors move."""
    every = asked.select("qb", "needs", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("cb"))
    return every.join(blocks, "cb").where("top >= needs").select("qb", "cb")


def longest(blocks: DataFrame, width: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) at the front of the stored blocks of the longest candidates: `rows` at most, from 8 blocks at most.

    Blocks are chosen by numbers, so no other block's vectors move, and only the rows wanted reach the driver.
    """
    order = [F.col("top").desc(), "part", "seq"]
    sizes = blocks.select("part", "seq", "top", (F.octet_length("ids") / 8).cast("int").alias("n")).orderBy(*order).limit(8).collect()
    ids, vectors = [np.zeros(0, np.int64)], [np.zeros((0, width), np.int64)]
    for part, seq, _, n in sizes:
        if rows <= 0:
            break
        take = min(n, rows)
        some = blocks.where((F.col("part") == part) & (F.col("seq") == seq))
        found = some.select(F.substring("ids", 1, take * 8), F.substring("data", 1, take * width * 8)).first()
        ids.append(np.frombuffer(found[0], np.int64))
        vectors.append(np.frombuffer(found[1], np.int64).reshape(take, width))
        rows -= take
    return np.concatenate(ids), np.concatenate(vectors)


def _rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """The right singular vectors of all candidates, from a Gram matrix summed on Spark."""

    def gram(batches):
        total = np.zeros((width, width))
        for b in batches:
            m = _matrix(b.column("v"), width).astype(float)
            total += m.T @ m
        i, j = np.indices(total.shape)
        yield batch(i=i.ravel().astype(np.int32), j=j.ravel().astype(np.int32), s=total.ravel())

    sums = vectors.select("v").mapInArrow(gram, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    total = np.zeros((width, width))
    for i, j, s in sums.collect():  # width * width numbers
        total[i, j] = s
    return np.linalg.eigh(total)[1][:, ::-1]


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query.

    Both sides come from `scaled`.  A candidate with the query's id is its own row and takes
    no part; a repeated query id counts once; equal scores go to the smaller id.  Shorter
    vectors count as padded with zeros.  Empty sides give no rows.

    Candidates are stored in blocks by descending length.  The longest few, the only vectors
    that reach the driver, give each query a first threshold.  A candidate block whose longest vector reaches no threshold of a
    query block (Cauchy-Schwarz) never meets it; each other pair is one row of bounded size,
    searched on its own, and the local results meet in a ranked window.
    """
    spark = vectors.sparkSession
    vectors, queries = stored(vectors, "candidates"), queries.dropDuplicates(["id"])
    size = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    width = size[1] or 0
    batch_rows(spark, 10_000)
    rotation = _rotation(vectors, width) if width else np.zeros((0, 0))
    ranged = vectors.repartitionByRange(max(1, -(-size[0] // BLOCK)), F.col("norm").desc(), "id")
    blocks = stored(_packed(ranged.sortWithinPartitions(F.col("norm").desc()), width, BLOCK), "blocks")
    n_queries = queries.count()
    asked = stored(_packed(queries.repartition(max(1, -(-n_queries // QUERIES))), width, QUERIES), "queries")

    head = longest(blocks, width, HEAD)
    shared = spark.sparkContext.broadcast((*head, rotation))

    def thresholds(b: pa.RecordBatch) -> pa.RecordBatch:
        hid, h, turned = shared.value
        least, needs = [], []
        for ids, data in zip(b.column("ids"), b.column("data"), strict=True):
            qid = np.frombuffer(ids.as_py(), np.int64)
            q = np.frombuffer(data.as_py(), np.int64).reshape(len(qid), width)
            owner, _, score = search(qid, q, np.full(len(qid), -np.inf), hid, h, turned, k)
            out, count = np.full(len(qid), -np.inf), np.bincount(owner, minlength=len(qid))
            full = np.flatnonzero(count == k)
            out[full] = score[np.searchsorted(owner, full, "right") - 1]
            least.append(out.tobytes())
            needs.append(needed_length(q, out))
        return batch(part=b.column("part"), seq=b.column("seq"), ids=b.column("ids"), data=b.column("data"), least=pa.array(least, pa.binary()), needs=needs)

    batch_rows(spark, 4)
    asked = stored(arrow_map(asked, thresholds, "part int, seq int, ids binary, data binary, least binary, needs double"), "asked")
    # a query block meets each candidate block that is long enough once, under a key that spreads the pairs
    asked, n_asked = _numbered(asked, "qb")
    blocks, n_blocks = _numbered(blocks, "cb")
    if not n_asked or not n_blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pairs = stored(long_enough(asked.select("qb", "needs"), blocks.select("cb", "top"), n_blocks), "pairs")
    # Packed blocks are many times their stored size, by which Spark would broadcast them: the lists of numbers are
    # what is hashed, and the blocks of a pair meet in a merge join.
    met = lambda own, other: pairs.groupBy(own).agg(F.collect_list(other).alias("met")).hint("shuffle_hash")
    left = asked.join(met("qb", "cb"), "qb").select("qb", F.explode("met").alias("cb"), F.col("ids").alias("qids"), F.col("data").alias("q"), "least")
    right = blocks.join(met("cb", "qb"), "cb").select(F.explode("met").alias("qb"), "cb", F.col("ids").alias("cids"), F.col("data").alias("c"))
    tasks = left.hint("merge").join(right, ["qb", "cb"]).select("qids", "q", "least", "cids", "c")

    def local(b: pa.RecordBatch) -> pa.RecordBatch:
        turned, found = shared.value[2], []
        for r in b.to_pylist():
            qid, cid = np.frombuffer(r["qids"], np.int64), np.frombuffer(r["cids"], np.int64)
            q = np.frombuffer(r["q"], np.int64).reshape(len(qid), width)
            c = np.frombuffer(r["c"], np.int64).reshape(len(cid), width)
            owner, ident, score = search(qid, q, np.frombuffer(r["least"]), cid, c, turned, k)
            found.append((qid[owner], ident, score))
        query, vec, score = (np.concatenate(x) for x in zip(*found, strict=True))
        return batch(query_id=query, vec_id=vec, score=score)

    found = stored(arrow_map(tasks, local, "query_id long, vec_id long, score long"), "found")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _numbered(blocks: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Number stored blocks from their partition and sequence; the numbers may have gaps."""
    parts, seqs = blocks.agg(F.max("part"), F.max("seq")).first()
    if parts is None:
        return blocks.withColumn(name, F.lit(0)), 0
    return blocks.withColumn(name, F.col("part") * (seqs + 1) + F.col("seq")), (parts + 1) * (seqs + 1)
