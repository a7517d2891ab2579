"""Helpers the operators share: stored intermediates, Arrow batches, words, components."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs of characters outside ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from `spark.checkpoint.dir`.

    Only a local session, whose executor is the driver, may go without: it gets a
    temporary folder of its own, deleted when the driver ends.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = _LOCAL.get(spark.sparkContext.applicationId)
        if path is None:
            folder = tempfile.mkdtemp(prefix="llm-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            path = _LOCAL[spark.sparkContext.applicationId] = f"file://{folder}"
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete a table made by `stored` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def batch_rows(spark: SparkSession, rows: int) -> None:
    """Rows of an Arrow batch.  Rows that hold whole texts or packed blocks need small batches.

    The setting has to hold when the caller runs the result, so it stays set.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def released(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """`function` of a task's batches; the memory it freed goes back to the system when the task ends.

    Spark keeps a task's Python worker for other tasks, and the allocators keep what was
    freed in it: without this, workers that have nothing to do hold the most that any task took.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim:
            trim(0)

    return run


def arrow_map(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """`mapInArrow` of a function from one batch to one batch (None: no rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(released(run), schema)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns)
    )


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased (A-Z) words of all texts in one array, and each text's offsets in it."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    flat, offsets = pc.list_flatten(split), np.concatenate(
        ([0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False)))
    )
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    return flat.filter(pa.array(real)), np.concatenate(([0], np.cumsum(real)))[offsets]


def numbered(df: DataFrame, key: str, order: list[str], rows: int, weight: str | None = None) -> DataFrame:
    """Add `slot`, the row's place within its key from 0 without gaps, and `before`, the
    weights of the places before it.

    Rows are dealt to about sqrt(rows) chunks by a hash of the order columns and numbered
    inside their (key, chunk); the chunks' counts are then summed along each key.  No task
    gets more than about sqrt(rows) rows, however many of them share a key.
    """
    chunks = max(1, int(rows**0.5))
    w = F.col(weight) if weight else F.lit(0)
    df = df.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks))).withColumn("_w", w.cast("long"))
    here = Window.partitionBy(key, "_chunk").orderBy(*order)
    df = df.withColumn("_n", F.row_number().over(here))
    df = df.withColumn("_s", F.sum("_w").over(here.rowsBetween(Window.unboundedPreceding, -1)))
    along = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(key, "_chunk").agg(F.count("*").alias("_rows"), F.sum("_w").alias("_sum"))
    sums = sums.select(
        F.col(key).alias("_numbered"), F.col("_chunk").alias("_of"), F.coalesce(F.sum("_rows").over(along), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_sum"),
    )
    df = df.join(sums, F.col(key).eqNullSafe(F.col("_numbered")) & (F.col("_chunk") == F.col("_of")))
    df = df.withColumn("slot", F.col("_n") - 1 + F.col("_rows"))
    df = df.withColumn("before", F.col("_sum") + F.coalesce("_s", F.lit(0)))
    return df.drop("_chunk", "_w", "_n", "_s", "_numbered", "_of", "_rows", "_sum")


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * _MIX[0]
        x = (x ^ (x >> np.uint64(27))) * _MIX[1]
        return x ^ (x >> np.uint64(31))


_ODD, _STEP = np.random.default_rng(41).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1), np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def word_hashes(flat: pa.Array, step: int = 1 << 20) -> np.ndarray:
    """64-bit hash of each string: a polynomial in its bytes, from running sums over `step` bytes at a time."""
    flat = flat.cast(pa.large_string())
    ends = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)
    out, at = np.zeros(len(flat), np.uint64), 0
    while at < len(flat):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + step, "right")) - 1)
        value = _ODD[data[ends[at] : ends[to]]]
        power = np.full(len(value) + 1, _STEP)
        power[0] = 1
        total = np.concatenate(([np.uint64(0)], np.cumsum(value * np.multiply.accumulate(power)[:-1], dtype=np.uint64)))
        power = np.full(len(value) + 1, _BACK)
        power[0] = 1
        here = ends[at : to + 1] - ends[at]
        out[at:to] = (total[here[1:]] - total[here[:-1]]) * np.multiply.accumulate(power)[here[:-1]]
        at = to
    return mix(out ^ np.diff(ends).astype(np.uint64))


def counted_buckets(keys: DataFrame, function: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> np.ndarray:
    """How many of the 64-bit numbers that `function` makes of each batch fall in each of 2^bits buckets.

    A fixed-size summary of any number of rows: each task sums its own counters, slices of
    them are shuffled and added up as they stream by, and 2^bits numbers reach the driver.
    """
    size, slices = 1 << bits, max(1, (1 << bits) >> 14)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount((function(b) >> np.uint64(64 - bits)).astype(np.int64), minlength=size)
        if total.any():
            yield batch(slice=np.arange(slices, dtype=np.int32), data=pa.array([x.tobytes() for x in total.reshape(slices, -1)], pa.binary()))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, data in zip(b.column("slice").to_pylist(), b.column("data"), strict=True):
                x = np.frombuffer(data.as_py(), np.int64)
                total[k] = total[k] + x if k in total else x
        if total:
            yield batch(slice=pa.array(list(total), pa.int32()), data=pa.array([x.tobytes() for x in total.values()], pa.binary()))

    parts = keys.mapInArrow(released(own), "slice int, data binary").repartition("slice").mapInArrow(released(added), "slice int, data binary")
    out = np.zeros((slices, size // slices), np.int64)
    for r in parts.collect():
        out[r["slice"]] = np.frombuffer(r["data"], np.int64)
    return out.ravel()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that links reach, for every node of an edge.

    Contraction with random, fixed priorities: each round points every node at the
    neighbour (or itself) of least hash, merges along the pointers and drops the edges
    inside merged nodes.  The graph shrinks by a constant factor a round whatever its shape
    (a star is gone after two), hubs are aggregated before the shuffle, and each round is
    stored, so nothing is collected.
    """
    pairs = stored(
        edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct(), "edges"
    )
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().withColumn("root", F.col("node"))
    rank = lambda c: F.struct(F.xxhash64(F.col(c)).alias("h"), F.col(c).alias("id"))
    turn = 0
    while not pairs.isEmpty():
        turn += 1
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        point = least.select(F.col("a").alias("v"), F.least(rank("a"), F.col("m"))["id"].alias("p"))
        jump = stored(point, "pointers")
        point = jump.join(jump.toDF("p", "q"), "p").select("v", F.col("q").alias("p"))
        nodes = nodes.join(point, nodes["root"] == point["v"], "left").select("node", F.coalesce("p", "root").alias("root"))
        if turn % 4 == 0:
            nodes = stored(nodes, "nodes")
        moved = pairs.join(point.toDF("a", "pa"), "a").join(point.toDF("b", "pb"), "b")
        moved = moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).where("a < b")
        old, pairs = pairs, stored(moved.distinct(), "edges")
        if turn > 1:  # the nodes still come from the first edges
            drop_stored(old)
    nodes = stored(nodes, "nodes")
    least = nodes.groupBy("root").agg(F.min("node").alias("component"))
    return nodes.join(least, "root").select("node", "component")
