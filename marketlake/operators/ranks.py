"""Global ranks of any key: sampled range partitions and their offsets, no global sort."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import work_folder
from marketlake.sinks.tables import write_parquet

#: Rows that a range should hold, and ranges at most: their offsets are broadcast.
RANGE_ROWS, MOST_RANGES = 200_000, 65_536


def ranked(
    df: DataFrame, columns: Sequence[str], name: str = "rank", n_ranges: int | None = None
) -> DataFrame:
    """``df`` with the 0-based rank of each row by ``columns`` ascending, NULLs first.

    The columns may be of any type that sorts: 64-bit numbers, texts, several of them.  Rows
    of equal values get consecutive ranks in no defined order.

    Spark samples the values, cuts them into ranges and sends each range to one task; the
    numbered ranges are stored, since counting and ranking have to see the same ones.  A
    range's offset is the count of the ranges before it, a table of ``n_ranges`` rows at
    most, and the rank inside a range is a window over that range alone.  A hash breaks ties,
    so a value that holds a third of all rows is cut into ranges like any other.
    """
    spark, columns = df.sparkSession, list(columns)
    if n_ranges is None:
        n_ranges = min(MOST_RANGES, max(1, -(-df.count() // RANGE_ROWS)))
    folder = f"{work_folder(spark, spark.conf.get('spark.sql.warehouse.dir'))}/marketlake/ranks-{uuid.uuid4().hex}"
    tied = df.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    order = [*columns, "_tie"]
    rows = write_parquet(tied.repartitionByRange(n_ranges, *order).withColumn("_range", F.spark_partition_id()), folder)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    placed = rows.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_offset") + inside)
    return placed.select(*df.columns, name)


def key_batches(
    df: DataFrame, column: str, size: int, n_ranges: int | None = None
) -> DataFrame:
    """(batch_no, keys): distinct keys of any type in ascending order, ``size`` per batch; NULL is none."""
    keys = df.select(column).filter(F.col(column).isNotNull()).distinct()
    placed = ranked(keys, [column], "_rank", n_ranges)
    return placed.groupBy(F.expr(f"_rank DIV {size}").alias("batch_no")).agg(
        F.array_sort(F.collect_list(column)).alias("keys")
    )
