"""Near-duplicate vectors: Euclidean p-stable hashing in several tables, then exact cosines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, batch, batch_rows, connected_components, mix, stored

#: Tables, projections of a table, width of a quantisation step (unit vectors), seed.  Two
#: vectors of cosine 0.93 are 0.374 apart; they meet in some table with probability 0.975,
#: of cosine 0.95 with 0.996, and unrelated ones meet in one with about 0.003.
TABLES, PROJECTIONS, WIDTH, SEED = 32, 10, 1.5, 20250
#: Members of a block: larger buckets are compared as pairs of blocks.
BLOCK = 1024


def _codes(x: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """(rows, tables) bucket numbers: floor((a.x + b) / width) of each projection, mixed."""
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((x.shape[1], tables * projections))
    b = rng.uniform(0, width, tables * projections)
    steps = np.floor((x @ a + b) / width).astype(np.int64).reshape(len(x), tables, projections)
    out = np.zeros((len(x), tables), np.uint64)
    for k in range(projections):
        out = mix(out ^ steps[:, :, k].astype(np.uint64), k)
    return out.astype(np.int64)


def _links(x, codes, table, ids, copies, side, threshold):
    """Verified links of one bucket (pair of blocks): see `_bucket_links`."""
    n = len(ids)
    cosine = x @ x.T
    close = (cosine >= threshold) & ~np.eye(n, dtype=bool)
    if side.min() != side.max():  # two blocks: pairs inside a block belong to another task
        close &= side[:, None] != side[None, :]
    i, j = np.nonzero(np.triu(close))
    # a pair counts in the first table where it meets, so it counts once
    first = ~(codes[i, :table] == codes[j, :table]).any(axis=1)
    links = np.zeros(n, np.int64)
    np.add.at(links, i[first], copies[j[first]])
    np.add.at(links, j[first], copies[i[first]])
    label = np.arange(n)
    while True:  # the smallest index that links reach
        new = np.minimum(label, np.where(close, label[None, :], n).min(axis=1, initial=n))
        new = new[new]
        if (new == label).all():
            return links, label
        label = new


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.93,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    seed: int = SEED,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, label, embedding).

    Two vectors link when their labels are equal and not null, they meet in a table, and
    their exact cosine in double precision reaches the threshold.  A vector that is null,
    empty or zero, or holds null or non-finite components, or has no label, links with
    nothing, and so does one of another length.  Every row counts as a vector of its own,
    repeated rows included.  A row without vec_id links with nothing, its component is null
    and it isn't kept.  An empty table gives no rows.  Other columns are ignored.

    Equal vectors of a label are one class and hash once.  Buckets of one class are dropped
    before vectors move; a bucket above BLOCK classes is compared as pairs of blocks in
    separate tasks, without any bound on its size.  A task returns counts and a spanning
    forest of its links, never the pairs.
    """
    spark = vectors.sparkSession
    batch_rows(spark, 2048)
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>").alias("v")
    )
    good = (
        "vec_id is not null and label is not null and v is not null"
        " and not exists(v, e -> e is null or abs(e) >= double('infinity')) and exists(v, e -> e <> 0)"
    )
    classes = rows.where(good).groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    def hashed(b: pa.RecordBatch) -> pa.RecordBatch:
        lengths = pc.list_value_length(b.column("v")).to_numpy()
        codes, data = np.zeros((len(lengths), tables), np.int64), [b""] * len(lengths)
        flat = np.asarray(pc.list_flatten(b.column("v")))
        ends = np.cumsum(lengths)
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            x = flat[(ends[at] - n)[:, None] + np.arange(n)]
            x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of any finite component stay finite
            x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
            codes[at] = mix(_codes(x, tables, projections, width, seed).astype(np.uint64), int(n)).astype(np.int64)
            for k, row in zip(at, x, strict=True):
                data[k] = row.tobytes()
        offsets = pa.array(np.arange(len(lengths) + 1, dtype=np.int32) * tables)
        return batch(
            cid=b.column("cid"), label=b.column("label"), copies=b.column("copies"), x=pa.array(data, pa.binary()),
            codes=pa.ListArray.from_arrays(offsets, pa.array(codes.ravel())),
        )

    index = stored(
        arrow_map(
            classes.select("cid", "label", "copies", "v"), hashed,
            "cid long, label string, copies long, x binary, codes array<long>",
        ),
        "hashed",
    )
    members = index.select("cid", "label", F.posexplode("codes").alias("t", "code"))
    crowded = members.groupBy("label", "t", "code").agg(F.count("*").alias("n")).where("n > 1")
    crowded = crowded.withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    members = members.join(crowded, ["label", "t", "code"])
    own = F.pmod(F.xxhash64("cid", F.lit(seed)), F.col("blocks")).alias("own")
    members = members.select("cid", "t", F.xxhash64("label", "t", "code").alias("bucket"), own, "blocks")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    members = members.withColumn("other", other).select(
        "cid", "t", "bucket", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    members = members.join(index.select("cid", "copies", "x", "codes"), "cid")
    keys = ["t", "bucket", "i", "j"]

    def bucket_links(batches):
        held = None
        for b in batches:
            held = b if held is None else pa.concat_batches([held, b])
            key = np.stack([np.asarray(held.column(k)).astype(np.int64) for k in keys])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if len(cut):  # the last bucket may go on in the next batch
                yield from found(held.slice(0, int(cut[-1])), np.r_[0, cut])
                held = held.slice(int(cut[-1]))
        if held is not None and held.num_rows:
            yield from found(held, np.array([0, held.num_rows]))

    def found(b: pa.RecordBatch, starts: np.ndarray):
        ids, copies, t = (np.asarray(b.column(c)) for c in ("cid", "copies", "t"))
        i, own = np.asarray(b.column("i")), np.asarray(b.column("own"))
        j = np.asarray(b.column("j"))
        x = b.column("x").to_pylist()
        codes = np.asarray(pc.list_flatten(b.column("codes"))).reshape(len(ids), -1)
        a, other, count = [], [], []
        for at, end in zip(starts[:-1], starts[1:], strict=True):
            if end - at < 2 or (i[at] != j[at] and own[at:end].min() == own[at:end].max()):
                continue
            here, lengths = slice(at, end), {len(v) for v in x[at:end]}
            if len(lengths) > 1:
                continue  # of another length: the codes differ but for a clash of hashes
            m = np.frombuffer(b"".join(x[at:end])).reshape(end - at, -1)
            links, label = _links(m, codes[here], int(t[at]), ids[here], copies[here], own[here], threshold)
            some = np.flatnonzero((links > 0) | (label != np.arange(end - at)))
            a.append(ids[here][some])
            other.append(ids[here][label[some]])
            count.append(links[some])
        if a and sum(map(len, a)):
            yield batch(a=np.concatenate(a), b=np.concatenate(other), links=np.concatenate(count))

    batch_rows(spark, 2048)
    dealt = members.repartition(*keys).sortWithinPartitions(*keys)
    links = stored(dealt.select("cid", "t", "bucket", "own", "i", "j", "copies", "x", "codes").mapInArrow(bucket_links, "a long, b long, links long"), "links")
    parts = connected_components(links.where("a <> b"))
    direct = links.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "cid")
    classes = classes.join(direct, "cid", "left").join(parts.withColumnRenamed("node", "cid"), "cid", "left")
    classes = classes.withColumn("component", F.coalesce("component", "cid"))
    least = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    classes = classes.join(least, "component").select(
        F.col("label").alias("l"), F.col("v").alias("w"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    linked = rows.where(good).join(classes, (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")))
    linked = linked.select("vec_id", F.col("links").alias("n_links"), "component_id")
    alone = rows.where(f"not coalesce(({good}), false)").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    both = linked.union(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
