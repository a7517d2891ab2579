"""Ranks of any key against a sorted list."""

import random

import pytest

from marketlake.operators.ranks import key_batches, ranked


@pytest.mark.parametrize("n_ranges", [1, 7])
def test_ranks_of_64_bit_numbers_and_nulls(spark, n_ranges):
    rng = random.Random(1)
    values = [rng.randrange(-(2**63), 2**63) for _ in range(500)] + [2**63 - 1, -(2**63), None]
    got = ranked(spark.createDataFrame([(v, "x") for v in values], "id bigint, note string"), ["id"], n_ranges=n_ranges)
    wanted = sorted(values, key=lambda v: (v is not None, v or 0))
    assert [r["id"] for r in sorted(got.collect(), key=lambda r: r["rank"])] == wanted
    assert got.columns == ["id", "note", "rank"]


def test_ranks_of_texts_and_several_columns(spark):
    rows = [(random.Random(i).choice("abé🙂Z"), i % 13) for i in range(300)]
    got = ranked(spark.createDataFrame(rows, "a string, b int"), ["a", "b"], n_ranges=5).collect()
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["rank"])] == sorted(rows, key=lambda r: (r[0].encode(), r[1]))


def test_a_hot_value_is_cut_into_ranges(spark):
    """A third of all rows share a value; no range gets more than three times its share."""
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) AS key")
    got = ranked(df, ["key"], n_ranges=10)
    assert got.selectExpr("min(rank)", "max(rank)", "count(distinct rank)").first() == (0, 29_999, 30_000)
    stored = spark.read.parquet(*got.inputFiles())
    assert stored.groupBy("_range").count().selectExpr("max(count)").first()[0] <= 9_000


def test_batches_of_texts(spark):
    keys = [f"k{i}" for i in range(137)]
    df = spark.createDataFrame([(k,) for k in keys * 3] + [(None,)], "key string")
    got = sorted(key_batches(df, "key", 20, n_ranges=4).collect())
    assert [r["keys"] for r in got] == [sorted(keys)[i : i + 20] for i in range(0, 137, 20)]
    assert key_batches(df.limit(0), "key", 20).isEmpty()
