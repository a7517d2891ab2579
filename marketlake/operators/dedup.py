"""Keep-last deduplication and links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The row with the greatest ``order`` per key; NULL keys form one group.

    ``row_number() = 1`` is planned as a group limit on both sides of the shuffle, so
    a key that holds most of the rows sends at most one row per map task.
    """
    latest = Window.partitionBy(*keys).orderBy(*[_col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(latest)).filter("_rn = 1").drop("_rn")


def link(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key pair, carrying the slugs of the latest copy."""
    narrow = df.select(*columns, *[c for c in order if c not in columns])
    return keep_last(narrow, keys, order).select(*columns)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
