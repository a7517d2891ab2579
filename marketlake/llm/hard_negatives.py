"""Hard negatives from a GNAT-style hyperplane tree: sibling ranges against window annuli, exact leaves."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, batch, batch_rows, stored

#: The tree is fitted on at most SAMPLE distinct vectors, with FANOUT split points a node;
#: a node that stands for more than LEAF rows is split.  All rows are put into its leaves.
SAMPLE, FANOUT, LEAF, SEED = 4096, 8, 1024, 7
#: Rows of a page (a ring of one leaf) and queries of a packet, at most; bytes of either.
PAGE, PACKET, BYTES = 4096, 512, 1 << 22


class Tree(NamedTuple):
    """Split points (nodes, FANOUT, width + 1), padded with NaN; children as node numbers, or
    ~leaf; and for each leaf its path of (node, child)."""

    centres: np.ndarray
    children: np.ndarray
    paths: list[list[tuple[int, int]]]


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * (x @ centres.T)
    return np.sqrt(np.maximum(square, 0))


def fit_tree(sample: np.ndarray, share: float, leaf: int = LEAF, fanout: int = FANOUT, seed: int = SEED) -> Tree:
    """Split points chosen far from each other among random candidates, node by node.

    `share` rows stand behind each sampled one.  Rows belong to the nearest split point, so
    the cells are cut by the hyperplanes between them.
    """
    rng = np.random.default_rng(seed)
    centres, children, paths = [], [], []

    def grow(rows: np.ndarray, path: list[tuple[int, int]]) -> int:
        if len(rows) < 2 * fanout or len(rows) * share <= leaf:
            paths.append(path)
            return ~(len(paths) - 1)
        tried = sample[rng.choice(rows, min(3 * fanout, len(rows)), replace=False)]
        chosen, far = [0], _distances(tried, tried[:1])[:, 0]
        while len(chosen) < fanout and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, _distances(tried, tried[chosen[-1:]])[:, 0])
        if len(chosen) < 2:
            paths.append(path)
            return ~(len(paths) - 1)
        node = len(centres)
        points = np.full((fanout, sample.shape[1]), np.nan)
        points[: len(chosen)] = tried[chosen]
        centres.append(points)
        children.append(np.zeros(fanout, np.int64))
        nearest = _distances(sample[rows], tried[chosen]).argmin(1)
        for c in range(len(chosen)):
            children[node][c] = grow(rows[nearest == c], [*path, (node, c)])
        return node

    grow(np.arange(len(sample)), [])
    width = sample.shape[1]
    return Tree(np.array(centres).reshape(-1, fanout, width), np.array(children).reshape(-1, fanout), paths)


def _points(tree: Tree, node: int) -> np.ndarray:
    points = tree.centres[node]
    return points[~np.isnan(points[:, 0])]


def assign(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's leaf, and its distance to the split point that the leaf belongs to."""
    leaf, near = np.zeros(len(x), np.int64), np.zeros(len(x))
    todo = [(0, np.arange(len(x)))] if len(tree.children) else []
    while todo:
        node, rows = todo.pop()
        d = _distances(x[rows], _points(tree, node))
        child = d.argmin(1)
        near[rows] = d[np.arange(len(rows)), child]
        for c in np.unique(child):
            here, to = rows[child == c], int(tree.children[node, c])
            if to < 0:
                leaf[here] = ~to
            else:
                todo.append((to, here))
    return leaf, near


def bounds(tree: Tree, ranges: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(queries, leaves): the least and greatest distance that any row of the leaf can have.

    ranges[leaf, level, i] holds the least and greatest distance of the leaf's rows to split
    point i of the node at that level of its path: sibling ranges at every split point.
    """
    low = np.zeros((len(x), len(tree.paths)))
    high = np.full_like(low, np.inf)
    d = {node: _distances(x, _points(tree, node)) for node in range(len(tree.children))}
    for leaf, path in enumerate(tree.paths):
        for level, (node, _) in enumerate(path):
            own, (least, most) = d[node], ranges[leaf, level, :, : d[node].shape[1]]
            low[:, leaf] = np.maximum(low[:, leaf], np.maximum(least - own, own - most).max(1))
            high[:, leaf] = np.minimum(high[:, leaf], (own + most).min(1))
    return low, high


def integers(df: DataFrame, factor: float, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, v): floor(factor * x) of each component, computed in double.

    Rows without id or label, null vectors and those with a null or non-finite component are
    left out; labels are whole numbers.
    """
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    good = F.col(id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()
    bad = F.exists(x, lambda e: e.isNull() | (F.abs(e) >= F.lit(float("inf"))))
    return df.where(good).where(~bad).select(
        F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.transform(x, lambda e: F.floor(e * factor)).alias("v")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix of whole numbers; shorter ones are padded with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(pc.list_flatten(column))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), lengths), at] = flat
    return out


class Space(NamedTuple):
    """Width of the vectors, the greatest squared length, the type that holds the components."""

    width: int
    square: int
    kind: str

    def lifted(self, v: np.ndarray) -> np.ndarray:
        """One more component makes all lengths equal: then the distance falls as the inner product grows."""
        x = v.astype(float)
        return np.column_stack([x, np.sqrt(np.maximum(self.square - (x * x).sum(1), 0))])

    def queries(self, v: np.ndarray) -> np.ndarray:
        return np.column_stack([v.astype(float), np.zeros(len(v))])

    def radius(self, own: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance of rows with that score from queries of squared length `own`."""
        return np.sqrt(np.maximum(own + self.square - 2 * np.asarray(score, float), 0))

    def scores(self, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        if self.square < 1 << 52:  # sums of whole numbers below 2^53 are exact in double
            return (q.astype(float) @ c.T.astype(float)).astype(np.int64)
        return q.astype(np.int64) @ c.T.astype(np.int64)

    def slack(self) -> float:
        return 1e-6 * (1 + self.square**0.5)


class Index(NamedTuple):
    tree: Tree
    space: Space
    ranges: np.ndarray
    pages: DataFrame


def build_index(rows: DataFrame, sample: int = SAMPLE, leaf: int = LEAF, fanout: int = FANOUT, page: int = PAGE, seed: int = SEED) -> Index | None:
    """The tree over (id, label, v) and all rows in pages of its leaves; None if there are none.

    The split points come from a sample of bounded size (the rows of least hash); every row is
    assigned.  Rows are range-partitioned by leaf and by distance to the leaf's own split point
    and cut into pages, so a leaf of any size is many rings of bounded size.  The driver gets a
    pair of numbers for each leaf, level and split point, a count bounded by the sample.
    """
    spark = rows.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e)
    most = F.max(F.array_max(F.transform("v", lambda e: F.abs(e))))
    n, width, longest, largest = rows.agg(F.count("*"), F.max(F.size("v")), F.max(square), most).first()
    if not n:
        return None
    if longest is not None and longest >= 1 << 55:  # a hundred times a score has to fit 64 bits
        raise ArithmeticError("a vector's squared length passes 2^55: take a smaller factor")
    space = Space(width, int(longest or 0), "int16" if (largest or 0) < 1 << 15 else "int32" if largest < 1 << 31 else "int64")
    drawn = rows.select("v").orderBy(F.xxhash64("id", "v", F.lit(seed))).limit(sample).toArrow()["v"].combine_chunks()
    known = np.unique(_matrix(drawn, width), axis=0)
    tree = fit_tree(space.lifted(known), n / len(known), leaf, fanout, seed)
    depth = max(map(len, tree.paths))
    fitted = spark.sparkContext.broadcast(tuple(tree))  # plain: executors need not have this package
    page = max(64, min(page, BYTES // max(1, width * np.dtype(space.kind).itemsize)))

    def assigned(b: pa.RecordBatch) -> pa.RecordBatch:
        v = _matrix(b.column("v"), width)
        cell, near = assign(Tree(*fitted.value), space.lifted(v))
        data = [x.tobytes() for x in v.astype(space.kind)]
        return batch(leaf=cell, near=near, id=b.column("id"), label=b.column("label"), v=pa.array(data, pa.binary()))

    def paged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held = None
        for b in batches:
            held = b if held is None else pa.concat_batches([held, b])
            while held.num_rows:
                cells = np.asarray(held.column("leaf"))
                end = int(np.searchsorted(cells, cells[0], "right"))
                if end == held.num_rows and end < page:
                    break  # the ring may go on in the next batch
                end = min(end, page)
                yield one(held.slice(0, end), part, seq)
                held, seq = held.slice(end), seq + 1
        if held is not None and held.num_rows:
            yield one(held, part, seq)

    def one(b: pa.RecordBatch, part: int, seq: int) -> pa.RecordBatch:
        tree, cell = Tree(*fitted.value), b.column("leaf")[0].as_py()
        data = b"".join(b.column("v").to_pylist())
        x = space.lifted(np.frombuffer(data, space.kind).reshape(b.num_rows, width))
        ends = np.zeros((2, depth, fanout))
        for level, (node, _) in enumerate(tree.paths[cell]):
            d = _distances(x, _points(tree, node))
            ends[:, level, : d.shape[1]] = d.min(0), d.max(0)
        near = np.asarray(b.column("near"))
        return batch(
            part=pa.array([part], pa.int32()), seq=pa.array([seq], pa.int32()), leaf=[cell], low=[near.min()], high=[near.max()],
            least=pa.array([ends[0].ravel()], pa.list_(pa.float64())), most=pa.array([ends[1].ravel()], pa.list_(pa.float64())),
            ids=pa.array([np.asarray(b.column("id")).astype(np.int64).tobytes()], pa.binary()),
            labels=pa.array([np.asarray(b.column("label")).astype(np.int64).tobytes()], pa.binary()), data=pa.array([data], pa.binary()),
        )

    batch_rows(spark, 2048)
    cells = stored(arrow_map(rows.select("id", "label", "v"), assigned, "leaf long, near double, id long, label long, v binary"), "cells")
    ranged = cells.repartitionByRange(max(1, -(-n // (4 * page))), "leaf", "near", "id").sortWithinPartitions("leaf", "near", "id")
    fields = "part int, seq int, leaf long, low double, high double, least array<double>, most array<double>, ids binary, labels binary, data binary"
    pages = stored(ranged.mapInArrow(paged, fields), "pages")
    ends = pages.select("leaf", F.posexplode(F.arrays_zip("least", "most")).alias("at", "e"))
    ranges = np.zeros((len(tree.paths), 2, depth * fanout))
    for r in ends.groupBy("leaf", "at").agg(F.min("e.least").alias("least"), F.max("e.most").alias("most")).toLocalIterator():
        ranges[r["leaf"], :, r["at"]] = r["least"], r["most"]
    ranges = ranges.reshape(len(tree.paths), 2, depth, fanout).transpose(0, 2, 1, 3)
    return Index(tree, space, ranges, pages)


_FOUND = "q long, w int, id long, score long"


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q", "w").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _packets(index: Index, queries: DataFrame, home: bool, fill: int) -> DataFrame:
    """Queries packed for the leaves that may hold rows of their windows.

    home: only the leaf each query falls into; else all others that the ranges leave.
    """
    tree, space, ranges, _ = index
    shared = queries.sparkSession.sparkContext.broadcast((tuple(tree), ranges))
    slots = max(1, fill)

    def packed(b: pa.RecordBatch) -> pa.RecordBatch | None:
        tree, ranges = Tree(*shared.value[0]), shared.value[1]
        v = _matrix(b.column("v"), space.width)
        x = space.queries(v)
        q, own = np.asarray(b.column("q")), np.asarray(b.column("id"))
        labels, sizes = np.asarray(b.column("label")), pc.list_value_length(b.column("windows")).to_numpy(zero_copy_only=False)
        flat = pc.list_flatten(b.column("windows"))
        windows = np.zeros((len(q), slots, 4), np.int64)
        windows[:, :, 1], windows[:, :, 2] = 1, 0  # an empty window
        at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        for k, name in enumerate(("w", "low", "high", "least")):
            windows[np.repeat(np.arange(len(q)), sizes), at, k] = np.asarray(pc.struct_field(flat, name))
        square = (x * x).sum(1)[:, None]
        some = windows[:, :, 1] <= windows[:, :, 2]
        far = np.where(some, space.radius(square, windows[:, :, 3]) + space.slack(), -1.0)
        close = np.where(some, space.radius(square, windows[:, :, 2]) - space.slack(), np.inf)
        cell, _ = assign(tree, space.lifted(v))
        if home:
            live = cell[:, None] == np.arange(len(tree.paths))[None, :]
            live &= some.any(1)[:, None]
        else:
            low, high = bounds(tree, ranges, x)
            live = ((low[:, None, :] <= far[:, :, None]) & (high[:, None, :] >= close[:, :, None])).any(1)
            live[np.arange(len(q)), cell] = False
        out = []
        for leaf in np.flatnonzero(live.any(0)):
            here = np.flatnonzero(live[:, leaf])
            if tree.paths[leaf]:
                node, child = tree.paths[leaf][-1]
                d = _distances(x[here], tree.centres[node][child : child + 1])
                low = np.maximum(d - far[here], close[here] - d).clip(0).min(initial=np.inf)
                high = (d + far[here]).max(initial=0)
            else:
                low, high = 0.0, np.inf
            out.append((int(leaf), float(low), float(high), q[here].tobytes(), own[here].tobytes(), labels[here].tobytes(), v[here].astype(np.int64).tobytes(), windows[here].tobytes()))
        if not out:
            return None
        columns = zip(*out, strict=True)
        kinds = [pa.int64(), pa.float64(), pa.float64(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["leaf", "from", "to", "q", "ids", "labels", "data", "windows"])

    return arrow_map(queries.select("q", "id", "label", "v", "windows"), packed, "leaf long, from double, to double, q binary, ids binary, labels binary, data binary, windows binary")


def _searched(index: Index, packets: DataFrame, same: bool, k: int, fill: int) -> DataFrame:
    """Each page meets the packets of its leaf whose rings touch it: exact scores, k best a window."""
    space, slots = index.space, max(1, fill)
    pages = index.pages
    meta = pages.select(F.col("leaf").alias("l"), "part", "seq", "low", "high")
    asked = packets.join(meta, (F.col("leaf") == F.col("l")) & (F.col("from") <= F.col("high")) & (F.col("to") >= F.col("low")))
    names = ["part", "seq", "kind", "q", "ids", "labels", "data", "windows"]
    asked = asked.withColumn("kind", F.lit(1)).select(*names)
    nothing = F.lit(None).cast("binary")
    held = pages.select("part", "seq", F.lit(0).alias("kind"), nothing.alias("q"), "ids", "labels", "data", nothing.alias("windows"))
    dealt = held.union(asked).repartition("part", "seq").sortWithinPartitions("part", "seq", "kind")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = labels = c = None
        for b in batches:
            for r in b.to_pylist():
                own, tags = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                if r["kind"] == 0:
                    ids, labels, c = own, tags, np.frombuffer(r["data"], space.kind).reshape(len(own), space.width)
                    continue
                numbers = np.frombuffer(r["q"], np.int64)
                windows = np.frombuffer(r["windows"], np.int64).reshape(len(own), slots, 4)
                score = space.scores(np.frombuffer(r["data"], np.int64).reshape(len(own), space.width), c)
                fits = ((tags[:, None] == labels[None, :]) == same) & (own[:, None] != ids[None, :])
                for s in range(slots):
                    low = np.maximum(windows[:, s, 1], windows[:, s, 3])
                    i, j = np.nonzero(fits & (score >= low[:, None]) & (score <= windows[:, s, 2][:, None]))
                    if not len(i):
                        continue
                    got = score[i, j]
                    order = np.lexsort((ids[j], -got, i))
                    i, j, got = i[order], j[order], got[order]
                    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
                    keep = np.arange(len(i)) - np.repeat(first, np.diff(np.r_[first, len(i)])) < k
                    yield batch(q=numbers[i[keep]], w=windows[i[keep], s, 0].astype(np.int32), id=ids[j[keep]], score=got[keep])

    batch_rows(pages.sparkSession, 4)
    return dealt.mapInArrow(exact, _FOUND)


def search(index: Index, queries: DataFrame, same: bool, k: int, fill: int) -> DataFrame:
    """(q, w, id, score, rank): the k best rows of every window, exact.

    Queries are (q, id, label, v, windows), the windows an array of at most `fill` of
    (w, low, high) scores, ends included.  Only rows of the same label count, or only rows of
    another one; rows with the query's id never do.  Higher scores first, ties by smaller id.

    First each query searches the leaf it falls into.  The k-th best score found there narrows
    its windows; then it goes to every other leaf that the sibling ranges don't exclude.
    """
    shared, space = queries.sparkSession.sparkContext.broadcast(tuple(index.tree)), index.space

    def located(b: pa.RecordBatch) -> pa.RecordBatch:
        cell, _ = assign(Tree(*shared.value), space.lifted(_matrix(b.column("v"), space.width)))
        return batch(home=cell, **{c: b.column(c) for c in ("q", "id", "label", "v", "windows")})

    spark = queries.sparkSession
    packet = max(16, min(PACKET, BYTES // (8 * max(1, space.width))))
    batch_rows(spark, packet)
    windows = "array<struct<w: int, low: long, high: long, least: long>>"
    queries = queries.withColumn("windows", F.expr("transform(windows, x -> named_struct('w', cast(x.w as int), 'low', x.low, 'high', x.high, 'least', x.low))"))
    queries = arrow_map(queries.select("q", "id", "label", "v", "windows"), located, f"home long, q long, id long, label long, v array<long>, windows {windows}")
    queries = stored(queries, "queries")
    count = queries.count()
    near = lambda df: df.repartitionByRange(max(1, -(-count // packet)), "home", "q").sortWithinPartitions("home", "q")
    packets = stored(_packets(index, near(queries), True, fill), "packets")
    first = stored(_searched(index, packets, same, k, fill), "first")
    least = _best(first, k).groupBy("q", "w").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k)
    least = least.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("w", "least"))).alias("reached"))
    narrowed = queries.join(least, "q", "left").withColumn(
        "windows", F.expr("transform(windows, x -> named_struct('w', x.w, 'low', x.low, 'high', x.high, 'least', coalesce(reached[x.w], x.low)))")
    )
    batch_rows(spark, packet)
    packets = stored(_packets(index, near(narrowed), False, fill), "packets")
    rest = stored(_searched(index, packets, same, k, fill), "rest")
    return _best(first.union(rest), k)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows and anchors are (id, label, v) of `integers`.  An anchor's positives are its best
    other rows of the same label; for each, the best rows of another label whose score s has
    low * p <= 100 * s <= high * p, p being the positive's score, are its hard negatives
    (none if p is negative).  Equal scores go to the smaller id.  Shorter vectors count as
    padded with zeros, so an empty vector scores 0 with all; squared lengths of 2^55 and more
    raise an ArithmeticError.  Repeated rows are candidates of
    their own; rows with the anchor's id are the anchor; equal anchors count once.  Empty
    tables give no rows.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = stored(rows.select("id", "label", "v"), "rows")
    index = build_index(rows)
    if index is None:
        return spark.createDataFrame([], schema)
    anchors = anchors.select("id", "label", "v").distinct().withColumn("q", F.monotonically_increasing_id())
    anchors = stored(anchors, "anchors")
    limit = 1 << 62
    whole = F.expr(f"array(named_struct('w', 0, 'low', -{limit}, 'high', {limit}))")
    found = stored(search(index, anchors.withColumn("windows", whole), True, positives, 1), "positives")
    window = F.struct(
        F.col("rank").alias("w"), F.expr(f"({low} * score + 99) div 100").alias("low"), F.expr(f"{high} * score div 100").alias("high")
    )
    windows = found.where("score >= 0").groupBy("q").agg(F.collect_list(window).alias("windows"))
    hard = search(index, anchors.join(windows, "q"), False, negatives, positives)
    named = found.select("q", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    hard = hard.select("q", "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    owners = anchors.select("q", F.col("id").alias("anchor_id"))
    return hard.join(named, ["q", "w"]).join(owners, "q").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
