"""K-d tree partitioning: weighted medians along the widest dimension until leaves are small."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, numbered, stored

#: Bins of a histogram pass, and the share of a cell's weight below which a bin is cut as a whole.
BINS, TOLERANCE = 256, 0.0005


def _finite(name: str):
    x = F.col(name).cast("double")
    return F.when(F.abs(x) < F.lit(float("inf")), x)  # NaN is greater than infinity


def _coordinates(df: DataFrame, dims: dict[str, str]) -> list:
    """A finite number for each dimension that keeps the column's order.

    Null and NaN come one before the least finite number, infinite values one beyond the
    ends.  Of a text the first six bytes count, an exact double: only the place of a split
    depends on them, rows of equal bytes are split by the tie.
    """
    numbers = [name for name, kind in dims.items() if kind != "string"]
    ends = df.agg(*[f(_finite(n)) for n in numbers for f in (F.min, F.max)]).first() if numbers else ()
    out = []
    for name, kind in dims.items():
        if kind == "string":
            prefix = F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 6)), 12, "0")
            out.append(F.coalesce(F.conv(prefix, 16, 10).cast("double"), F.lit(-1.0)))
            continue
        at = 2 * numbers.index(name)
        lo, hi = ends[at] or 0.0, ends[at + 1] or 0.0
        x = F.col(name).cast("double")
        odd = F.when(x == F.lit(float("inf")), F.lit(hi + 1)).when(x == F.lit(-float("inf")), F.lit(lo - 1)).otherwise(F.lit(lo - 1))
        scale = 0.25 if max(abs(lo), abs(hi)) > 1e307 else 1.0  # the extent has to be finite as well
        out.append(F.coalesce(_finite(name), odd) * scale)
    return out


def _cells(rows: DataFrame, dims: int) -> dict[int, dict]:
    """Weight, rows and extent of each cell: a few numbers for each."""
    ends = [f(f"c{d}").alias(f"{n}{d}") for d in range(dims) for f, n in ((F.min, "lo"), (F.max, "hi"))]
    found = rows.groupBy("cell").agg(F.sum("w").alias("w"), F.count("*").alias("n"), *ends).collect()
    return {r["cell"]: r.asDict() for r in found}


def _table(spark, cells: list[tuple], schema: str) -> DataFrame:
    # one row for each open cell: bounded by the number of leaves asked for
    return F.broadcast(spark.createDataFrame(cells, schema))


def _cuts(rows: DataFrame, dims: int, goals: dict[int, dict]) -> dict[int, tuple[int, float, float]]:
    """(dimension, value, tie) of each cell's split: what is at most (value, tie) goes left.

    The range that holds the wanted weight is narrowed by histograms, BINS bins a pass,
    first along the dimension and then, where one value holds too much, along the tie.
    """
    cuts, spark = {}, rows.sparkSession
    open_ = {c: {"dim": g["dim"], "at": g["dim"], "lo": g["lo"], "hi": g["hi"], "value": 0.0, "goal": g["goal"], "cell": g["w"]} for c, g in goals.items()}
    while open_:
        plan = _table(
            spark, [(c, s["dim"], s["at"], s["lo"], s["hi"], s["value"]) for c, s in open_.items()],
            "cell long, dim int, at int, lo double, hi double, value double",
        )
        x = F.element_at(F.array(*[f"c{d}" for d in range(dims)], "tie"), F.col("at") + 1)
        own = F.element_at(F.array(*[f"c{d}" for d in range(dims)]), F.col("dim") + 1)
        near = rows.join(plan, "cell").withColumn("x", x).where("x between lo and hi")
        near = near.where((F.col("at") == F.col("dim")) | (own == F.col("value")))
        width = F.col("hi") - F.col("lo")
        bin_ = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("lo")) / width * BINS), F.lit(BINS - 1))).otherwise(0)
        found = near.groupBy("cell", bin_.alias("bin")).agg(F.sum("w").alias("w"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        bins: dict[int, list] = {}
        for r in found.collect():  # BINS numbers a cell
            bins.setdefault(r["cell"], []).append((r["bin"], r["w"], r["lo"], r["hi"]))
        for c, s in list(open_.items()):
            before, last = 0, None
            for _, w, lo, hi in sorted(bins[c]):
                if before + w >= s["goal"]:
                    break
                before, last = before + w, hi
            tied = s["at"] != s["dim"]
            if w > TOLERANCE * s["cell"] and lo < hi:
                s.update(lo=lo, hi=hi, goal=s["goal"] - before)
                if last is not None:
                    s["last"] = last
                continue
            if w > TOLERANCE * s["cell"] and not tied:
                s.update(at=dims, value=lo, lo=0.0, hi=1.0, goal=s["goal"] - before)
                s.pop("last", None)
                continue
            # the bin goes to the side that leaves the split nearer its goal
            left = before + w - s["goal"] <= s["goal"] - before
            edge = hi if left else (last if last is not None else s.get("last", -math.inf))
            cuts[c] = (s["dim"], s["value"], edge) if tied else (s["dim"], edge, 2.0)
            del open_[c]
    return cuts


def kd_shards(df: DataFrame, dims: dict[str, str], weight: str, target: int | None, tie: list[str], leaves: int | None = None) -> DataFrame:
    """`df` with `shard` (int) and `slot` (long, from 0 without gaps): leaves of a k-d tree.

    `dims` names the metadata columns and their kinds ("number" or "string"); `weight` is a
    column of whole numbers above 0 and `target` the weight a leaf should reach.  The tree
    has ceil(total / target) leaves, or `leaves` if that is given: a cell that stands for k of them is split where
    floor(k / 2) of k of its weight lies (a side with fewer rows than leaves leaves the rest to the other), along the dimension whose extent is the widest
    share of the whole table's.  Values that many rows share are split by a hash of the
    `tie` columns, so a hot value never makes a heavy leaf; only a row heavier than a leaf
    does.  Null and NaN coordinates come first, infinite ones at the ends.  Rows that are equal
    in a dimension, whole texts included, are dealt like any others.  Fully equal rows hash alike: they are told apart
    by their place in the stored table.  An empty table gives no rows; shards that no row
    reaches stay empty.  The columns of `df` stay as they are; `shard` and `slot` must be free.
    """
    marked = stored(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    total, count = marked.agg(F.sum(weight), F.count("*")).first()
    leaves = leaves or max(1, math.ceil((total or 0) / max(1, target)))
    # equal rows differ in the last bits of the tie only
    spread = F.pmod(F.xxhash64(*tie), F.lit(2**40)) * F.lit(2.0**-40) + F.pmod(F.xxhash64("_row"), F.lit(2**12)) * F.lit(2.0**-52)
    coords = [c.alias(f"c{d}") for d, c in enumerate(_coordinates(marked, dims))]
    rows = marked.select("_row", F.col(weight).alias("w"), spread.alias("tie"), *coords, F.lit(0).cast("long").alias("cell"))
    rows = stored(rows, "cells")
    cells = _cells(rows, len(dims))
    root = cells.get(0)
    stands = {0: (0, leaves)}  # cell -> first leaf, leaves
    number, done = 1, {}
    while root and stands:
        goals = {}
        for c, (first, k) in list(stands.items()):
            cell = cells.get(c)
            if k == 1 or cell is None or cell["n"] < 2:
                done[c] = first
                del stands[c]
                continue
            share = [(cell[f"hi{d}"] - cell[f"lo{d}"]) / ((root[f"hi{d}"] - root[f"lo{d}"]) or 1.0) for d in range(len(dims))]
            dim = max(range(len(dims)), key=lambda d: (share[d], -d))
            goals[c] = {"dim": dim, "lo": cell[f"lo{dim}"], "hi": cell[f"hi{dim}"], "w": cell["w"], "goal": cell["w"] * (k // 2) / k}
        if not goals:
            break
        cuts = _cuts(rows, len(dims), goals)
        plan, sides = [], []
        for c, (dim, value, tied) in cuts.items():
            sides.append((number, *stands[c]))
            plan.append((c, dim, value, tied, number))
            number += 2
        table = _table(rows.sparkSession, plan, "cell long, dim int, value double, edge double, to long")
        x = F.element_at(F.array(*[f"c{d}" for d in range(len(dims))]), F.col("dim") + 1)
        left = (x < F.col("value")) | ((x == F.col("value")) & (F.col("tie") <= F.col("edge")))
        cell = F.when(F.col("dim").isNull(), F.col("cell")).when(left, F.col("to")).otherwise(F.col("to") + 1)
        old = rows
        rows = stored(rows.join(table, "cell", "left").withColumn("cell", cell).drop("dim", "value", "edge", "to"), "cells")
        drop_stored(old)
        cells, stands = _cells(rows, len(dims)), {}
        for c, first, k in sides:
            here, there = (cells[side]["n"] if side in cells else 0 for side in (c, c + 1))
            left = k // 2
            if here and there and here + there >= k:  # a few heavy rows can't fill the leaves their weight asks for
                left = max(min(left, here), k - there)
            stands[c], stands[c + 1] = (first, left), (first + left, k - left)
    leaf = _table(rows.sparkSession, [(c, first) for c, first in done.items()] or [(0, 0)], "cell long, shard int")
    placed = rows.join(leaf, "cell").select("_row", "shard")
    placed = numbered(placed, "shard", ["_row"], count).drop("before")
    return marked.join(placed, "_row").drop("_row")
