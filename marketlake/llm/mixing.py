"""Mixing sources to target weights: packed blocks, multinomial draws, pseudorandom permutations."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, arrow_map, batch, batch_rows, mix, numbered, stored

#: Words of a block, least blocks of a source, slots of an output shard, seed of the draws.
BLOCK, LEAST_BLOCKS, SHARD_SLOTS, SEED = 128, 512, 4096, 7919
#: A mix takes no source more often than this, and names at most this many sources.
MAX_REPEATS, MAX_SOURCES = 3, 100_000
WEIGHTS = (1.0, 2.0, 3.0)


def word_count(text: str):
    """Number of words of a text column; null: 0."""
    pattern = WORD.replace("\\", "\\\\")
    return F.coalesce(F.expr(f"regexp_count({text}, '{pattern}')"), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], cap: float = MAX_REPEATS) -> list[float]:
    """Shares of the total by weight, none above cap times its size; the excess is reshared by weight."""
    out, open_ = [0.0] * len(sizes), [i for i, n in enumerate(sizes) if n > 0]
    left = float(sum(sizes))
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > cap * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(cap * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


def permuted(index: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1: a Feistel network, walked until inside the range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64(2**half - 1)
    out, open_ = index.astype(np.uint64), np.arange(len(index))
    while len(open_):
        x = out[open_]
        left, right = x >> np.uint64(half), x & mask
        for turn in range(4):
            left, right = right, left ^ (mix(right, seed * 4 + turn) & mask)
        out[open_] = (left << np.uint64(half)) | right
        open_ = open_[out[open_] >= n]
    return out.astype(np.int64)


def _plan(docs: DataFrame, weights: tuple[float, ...]) -> list[dict]:
    """Size, target, block length and slots of each source, in code point order, null last."""
    found = docs.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in found]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(found))])
    plan = []
    for i, r in enumerate(found):
        block = max(1, min(BLOCK, sizes[i] // LEAST_BLOCKS))
        blocks = -(-sizes[i] // block)
        whole = int(goal[i] // sizes[i]) if sizes[i] else 0
        rest = round((goal[i] - whole * sizes[i]) / sizes[i] * blocks) if sizes[i] else 0
        plan.append({"sid": i, "source": r["source"], "source_size": sizes[i], "target": goal[i], "block": block, "blocks": blocks, "slots": whole * blocks + rest})
    return plan


def _draws(spark, plan: list[dict], seed: int) -> DataFrame:
    """(shard, sid, from, count): the slots of each source in each output shard.

    Each shard draws its counts from a multinomial by the sources' slots.  The running
    number of a source's slots over the shards is what the permutation maps, so a slot
    beyond the source's total is handed to the sources that the draws left short: in the
    end each source has exactly its slots.
    """
    slots = np.array([p["slots"] for p in plan], np.int64)
    total = int(slots.sum())
    shards = -(-total // SHARD_SLOTS)

    def draw(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for shard in b.column("id").to_numpy():
            n = min(SHARD_SLOTS, total - int(shard) * SHARD_SLOTS)
            rows.append(np.random.default_rng([seed, int(shard)]).multinomial(n, slots / total))
        counts = np.array(rows)
        at, sid = np.nonzero(counts)
        return batch(shard=b.column("id").to_numpy()[at], sid=sid.astype(np.int32), count=counts[at, sid])

    drawn = arrow_map(spark.range(shards), draw, "shard long, sid int, count long")
    drawn = numbered(stored(drawn, "draws"), "sid", ["shard"], shards * len(plan), "count")
    return drawn.select("sid", F.col("before").alias("from"), "count")


def block_counts(spark, plan: list[dict], seed: int = SEED) -> DataFrame:
    """(sid, index, times): how often the mix takes each block; blocks it leaves out are absent."""
    if not sum(p["slots"] for p in plan):
        return spark.createDataFrame([], "sid int, index long, times long")
    slots = np.array([p["slots"] for p in plan], np.int64)
    blocks = np.array([p["blocks"] for p in plan], np.int64)
    drawn = _draws(spark, plan, seed)
    kept = F.least(F.col("from") + F.col("count"), F.element_at(F.array(*map(F.lit, slots.tolist())), F.col("sid") + 1)) - F.col("from")
    drawn = stored(drawn.withColumn("kept", F.greatest(kept, F.lit(0))).where("kept > 0"), "kept")
    made = {r["sid"]: r["n"] for r in drawn.groupBy("sid").agg(F.sum("kept").alias("n")).collect()}  # a row a source
    # slots the draws left open, as runs of the same bounded length
    short = [
        (p["sid"], at, min(SHARD_SLOTS, p["slots"] - at))
        for p in plan for at in range(made.get(p["sid"], 0), p["slots"], SHARD_SLOTS)
    ]
    runs = drawn.select("sid", "from", F.col("kept").alias("count"))
    if short:
        runs = runs.union(spark.createDataFrame(short, "sid int, from long, count long"))

    def mapped(b: pa.RecordBatch) -> pa.RecordBatch:
        out_sid, out_index = [], []
        for sid, start, n in zip(*(b.column(c).to_pylist() for c in ("sid", "from", "count")), strict=True):
            slot = np.arange(start, start + n)
            for turn in np.unique(slot // blocks[sid]):  # each time round has a permutation of its own
                place = slot[slot // blocks[sid] == turn] % blocks[sid]
                index = permuted(place, int(blocks[sid]), seed + 1009 * sid + int(turn))
                out_index.append(index)
                out_sid.append(np.full(len(index), sid, np.int32))
        return batch(sid=np.concatenate(out_sid), index=np.concatenate(out_index))

    # few bytes stand for many slots: the number of tasks goes by the slots
    spread = runs.repartition(max(8, -(-int(slots.sum()) // (16 * SHARD_SLOTS))), "sid", "from")
    taken = arrow_map(spread, mapped, "sid int, index long")
    return taken.groupBy("sid", "index").agg(F.count("*").alias("times"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED, key: list[str] | None = None) -> DataFrame:
    """`docs` (doc_id, source, size, ...) with source_size, target, taken and `runs`.

    Sources in code point order, null last, weigh `weights` in turn; the shares of the
    total are capped at MAX_REPEATS times a source's size.  The words of a source, its
    documents in a pseudorandom order, are packed into blocks of a fixed length; output
    shards draw multinomial counts of blocks, and each source's running slot numbers map
    to blocks through pseudorandom permutations.  A document takes, of each block, its
    words times the block's count: `runs` lists (start, end, times) in words of the document.

    No block is taken more often than its source's target asks (rounded up), so no
    document exceeds MAX_REPEATS times its size.  Draws depend on the seed and on the
    documents only.  Repeated rows count as documents of their own; documents without
    words take none.  An empty table gives no rows.  `key` names the columns that order
    documents first: with it, the mix does not depend on how these are stored.  Without it
    all columns order them, and then their places in the stored table.
    """
    spark, columns = docs.sparkSession, docs.columns
    order = [c for c in columns if c in (key or columns)]
    order += [c for c in columns if c not in order] + ["_copy" if key else "_row"]
    if key:  # equal rows are told apart by a number among them
        docs = docs.groupBy(*columns).agg(F.count("*").alias("_copies"))
        docs = docs.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).drop("_copies")
    docs = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "docs")
    plan = _plan(docs, weights)
    known = spark.createDataFrame(
        [(p["sid"], p["source"], p["source_size"], p["target"], p["block"]) for p in plan],
        "sid int, _source string, source_size long, target double, _block int",
    )
    docs = docs.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")  # MAX_SOURCES rows at most
    placed = numbered(docs.select("_row", "sid", "size", "_block", *[c for c in order if c not in ("size", "_row")]), "sid", order, docs.count(), "size")
    first, last = F.floor(F.col("before") / F.col("_block")), F.floor((F.col("before") + F.col("size") - 1) / F.col("_block"))
    pieces = placed.where("size > 0").select("_row", "sid", "size", "before", "_block", F.explode(F.sequence(first, last)).alias("index"))
    start = F.greatest(F.col("index") * F.col("_block") - F.col("before"), F.lit(0))
    end = F.least((F.col("index") + 1) * F.col("_block") - F.col("before"), F.col("size"))
    # the counts grow with the table, which no estimate of a mapped result shows: no broadcast
    pieces = pieces.join(block_counts(spark, plan, seed).hint("merge"), ["sid", "index"])
    pieces = pieces.select("_row", start.alias("start"), end.alias("end"), "times")
    taken = pieces.groupBy("_row").agg(
        F.sum((F.col("end") - F.col("start")) * F.col("times")).alias("taken"),
        F.array_sort(F.collect_list(F.struct("start", "end", "times"))).alias("runs"),
    )
    out = docs.join(taken, "_row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return out.drop("_row", "_copy", "_block", "sid")


_FIND = re.compile(WORD).finditer


def cut(text: str, runs: list[dict]) -> list[str]:
    """The texts a mix takes of a document: the words taken at least once, at least twice and so on.

    Neighbouring words stay as they stand in the text; what lies apart is joined by line ends.
    """
    spans = [m.span() for m in _FIND(text)]
    out = []
    for turn in range(max((r["times"] for r in runs), default=0)):
        pieces: list[list[int]] = []
        for r in runs:
            if r["times"] > turn:
                if pieces and pieces[-1][1] == r["start"]:
                    pieces[-1][1] = r["end"]
                else:
                    pieces.append([r["start"], r["end"]])
        if pieces == [[0, len(spans)]]:
            out.append(text)
        else:
            out.append("\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in pieces))
    return out


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix itself, in the columns of `docs` (doc_id, text, source, n_chars and others).

    Each document gives the texts of `cut`, as rows that share its other columns; n_chars
    is theirs.  Documents the mix leaves out, and those without words, give no row.  Rows
    are told apart by 128 bits over all their columns.  Fully equal rows are documents of
    their own, each with the runs that the mix takes of it.
    """
    spark = docs.sparkSession
    nulls = F.array(*[F.col(c).isNull() for c in docs.columns])  # a hash passes over nulls
    keys = {f"_key{k}": F.xxhash64(F.lit(k), nulls, *docs.columns) for k in range(2)}
    keyed = docs.withColumns(keys)
    sized = keyed.select(*keys, "doc_id", "source", word_count("text").alias("size"))
    taken = stored(mix_sources(sized, weights, seed, ["doc_id", *keys]).select(*keys, "runs"), "runs")
    kinds, columns = dict(docs.dtypes), docs.columns

    def texts(b: pa.RecordBatch) -> pa.RecordBatch:
        made = [cut(t, r) for t, r in zip(b.column("text").to_pylist(), b.column("runs").to_pylist(), strict=True)]
        at = pa.array(np.repeat(np.arange(len(made)), [len(m) for m in made]))
        flat = [t for m in made for t in m]
        fresh = {"text": pa.array(flat, b.schema.field("text").type), "n_chars": pa.array([len(t) for t in flat], pa.int64())}
        return pa.RecordBatch.from_arrays(
            [fresh[c].cast(b.schema.field(c).type) if c in fresh else b.column(c).take(at) for c in columns], columns
        )

    batch_rows(spark, 256)
    # one of equal rows has the text for the runs of all of them; where there are none, no text is grouped
    again = stored(taken.groupBy(*keys).count().where("count > 1").select(*keys), "again")
    if not again.isEmpty():
        keyed = keyed.join(again, list(keys), "left_anti").union(keyed.join(again, list(keys), "left_semi").dropDuplicates(list(keys)))
    # runs are small beside their text: texts stream past them and are never sorted
    chosen = keyed.join(taken.where("runs is not null").hint("shuffle_hash"), list(keys)).select(*docs.columns, "runs")
    return arrow_map(chosen, texts, ", ".join(f"`{c}` {t}" for c, t in kinds.items()))
