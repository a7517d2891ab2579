import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators import outcomes, shape
from marketlake.operators.dedup import keep_last, link
from marketlake.contracts import TAGS


def test_keep_last_takes_the_greatest_order_and_groups_nulls(spark, rows):
    df = spark.createDataFrame(
        [("a", 0, 0, "old"), ("a", 1, 0, "new"), ("a", 0, 9, "mid"), (None, 0, 1, "n1"), (None, 0, 2, "n2")],
        "k string, source int, pos int, v string",
    )
    once = keep_last(df, ["k"], ["source", "pos"])
    assert rows(once, "k", "v") == [("a", "new"), (None, "n2")]
    assert rows(keep_last(once, ["k"], ["source", "pos"])) == rows(once)


def test_keep_last_does_not_depend_on_input_order(spark, rows):
    data = [(i % 7, i, f"v{i}") for i in range(200)]
    schema = "k int, o int, v string"
    a = spark.createDataFrame(data, schema).repartition(5)
    b = spark.createDataFrame(data[::-1], schema).repartition(3, "o")
    assert rows(keep_last(a, ["k"], ["o"])) == rows(keep_last(b, ["k"], ["o"]))


def test_link_keeps_one_row_per_pair_with_latest_slugs(spark, rows):
    df = spark.createDataFrame(
        [("e", "t", "old", 1), ("e", "t", "new", 2), ("e", "u", "x", 1)],
        "event_id string, tag_id string, tag_slug string, o int",
    )
    got = link(df, ["event_id", "tag_id", "tag_slug"], ["event_id", "tag_id"], ["o"])
    assert rows(got) == [("e", "t", "new"), ("e", "u", "x")]


def _nested(spark):
    return spark.createDataFrame(
        [("e1", [("m1", 1), ("m2", 2)]), ("e2", []), ("e3", None), ("e4", [None])],
        "id string, markets array<struct<mid:string, n:int>>",
    )


def test_explode_drops_or_keeps_empty_arrays(spark, rows):
    inner = shape.explode_structs(_nested(spark), "markets", ["id"])
    assert rows(inner, "id", "mid", shape.ARRAY_POS) == [
        ("e1", "m1", 0),
        ("e1", "m2", 1),
        ("e4", None, 0),
    ]
    outer = shape.explode_structs(_nested(spark), "markets", ["id"], outer=True)
    assert rows(outer, "id", "mid")[2:] == [("e2", None), ("e3", None), ("e4", None)]


def test_explode_rejects_duplicate_names(spark):
    with pytest.raises(ValueError, match="duplicate"):
        shape.explode_structs(_nested(spark), "markets", [F.col("id").alias("mid")])


def test_rename_exact_needs_every_column(spark):
    df = spark.createDataFrame([(1, 2)], "id int, slug int")
    assert shape.rename_exact(df, {"id": "x"}).columns == ["x", "slug"]
    with pytest.raises(ValueError, match="missing"):
        shape.rename_exact(df, {"new": "is_new"})


def test_rename_snake_rejects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "volume24hr int, volume24Hr int")
    with pytest.raises(ValueError, match="duplicate"):
        shape.rename_snake(df)


def test_conform_reports_drops_adds_and_missing(spark):
    df = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in TAGS.names]))
    out = shape.conform(df.withColumn("extra", F.lit(1)).drop("label"), TAGS, optional=["label"])
    assert (out.dropped, out.added, out.df.columns) == (["extra"], ["label"], TAGS.names)
    with pytest.raises(ValueError, match="missing columns \\['label'\\]"):
        shape.conform(df.drop("label"), TAGS)


@pytest.mark.parametrize(
    "names, start, keep",
    [
        ('["a","b"]', "2020-01-01", True),
        ('["a"]', "2024-01-01", True),
        ('["a"]', "2023-12-31", False),
        ('["a","b","c"]', "2020-05-01", False),
        ('["a","b","c"]', "2024-05-01", True),
        (None, "2024-01-01", True),
        (None, "2020-01-01", False),
        ('["a"]', None, False),
        ('["a","b"]', None, True),
        ('["a"]', "n/a", False),
        (None, None, False),
        ("not json", "2020-01-01", True),
    ],
)
def test_binary_or_recent(spark, names, start, keep):
    df = spark.createDataFrame([(names, start)], "outcomes string, start_date string")
    assert df.filter(outcomes.binary_or_recent()).count() == int(keep)


def test_condition_filter(spark):
    df = spark.createDataFrame([("",), (None,), ("0x1",)], "condition_id string")
    assert [r[0] for r in outcomes.with_condition(df).collect()] == ["0x1"]


def _markets(spark, *lists):
    return spark.createDataFrame(
        [(f"m{i}", f"s{i}", "q?", *three) for i, three in enumerate(lists)],
        "market_id string, market_slug string, question string, "
        "outcomes string, outcome_prices string, clob_token_ids string",
    )


def test_outcomes_of_zips_by_position(spark, rows):
    df = _markets(
        spark,
        ('["Yes","No"]', '["0.4","0.6"]', '["t1","t2"]'),
        ('["A","B","C"]', "[0.1,0.2,0.3]", '["t3","t4"]'),
        ('["A","A"]', None, '["t5","t6"]'),
        (None, "[]", '["t7","t8"]'),
        ('["A","B"]', None, None),
        ('["A","B"]', None, '["t9"]'),
        ('["A","B"]', None, '["a","b","c"]'),
        ('["","???"]', None, '["u1","u2"]'),
    )
    got = rows(
        outcomes.outcomes_of(df), "outcome_id", "outcome_slug", "outcome_index", "outcome_price", "clob_token_id"
    )
    assert got == [
        ("m0-0", "s0@yes", 0, 0.4, "t1"),
        ("m0-1", "s0@no", 1, 0.6, "t2"),
        ("m1-0", "s1@a", 0, 0.1, "t3"),
        ("m1-1", "s1@b", 1, 0.2, "t4"),
        ("m2-0", "s2@a", 0, None, "t5"),
        ("m2-1", "s2@a", 1, None, "t6"),
        ("m3-0", None, 0, None, "t7"),
        ("m3-1", None, 1, None, "t8"),
        ("m7-0", "s7@", 0, None, "u1"),
        ("m7-1", "s7@", 1, None, "u2"),
    ]


def test_unusable_prices_are_marked(spark):
    df = _markets(
        spark,
        ('["A","B"]', '["0.4"]', '["t1","t2"]'),
        ('["A","B"]', "broken", '["t3","t4"]'),
        ('["A","B"]', '["x","0.5"]', '["t5","t6"]'),
        ('["A","B"]', "[null, 0.5]", '["t7","t8"]'),
    )
    marked = outcomes.outcomes_of(df).filter(F.col("_cast_failed").isNotNull())
    assert sorted(r["outcome_id"] for r in marked.collect()) == ["m0-1", "m1-0", "m1-1", "m2-0"]


def test_long_list_report(spark):
    df = _markets(
        spark,
        ('["A","B"]', "[1,2]", '["a","b"]'),
        ('["A","B","C"]', None, None),
        (None, "[1,2,3]", '["a","b"]'),
        (None, None, '["a","b","c"]'),
        (None, None, None),
    )
    assert outcomes.long_list_report(df).first()["n_long"] == 3
