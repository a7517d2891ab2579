import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.contracts import CONTRACTS, FOREIGN_KEYS
from marketlake.functions import casts, lists
from marketlake.functions.naming import kebab, snake


@pytest.mark.parametrize(
    "name, expected",
    [
        ("volume24hr", "volume_24_hr"),
        ("volume1wkAmm", "volume_1_wk_amm"),
        ("conditionId", "condition_id"),
        ("showGMPSeries", "show_gmp_series"),
        ("new", "new"),
        ("negRiskMarketID", "neg_risk_market_id"),
    ],
)
def test_snake(name, expected):
    assert snake(name) == expected


def test_every_contract_column_survives_camel_and_snake():
    from marketlake.queries.feed import camel

    for contract in CONTRACTS.values():
        for name in contract.names:
            assert snake(camel(name)) == name


def test_contract_sizes_and_keys():
    sizes = {n: len(c.columns) for n, c in CONTRACTS.items()}
    assert sizes == {
        "bronze_gamma_markets": 110,
        "bronze_gamma_events": 67,
        "bronze_gamma_series": 29,
        "bronze_gamma_tags": 12,
        "bronze_gamma_event_series_link": 4,
        "bronze_gamma_event_tag_link": 4,
        "silver_market_outcomes": 9,
        "entry_outcome_dependencies": 5,
    }
    assert len(FOREIGN_KEYS) == 8
    for c in CONTRACTS.values():
        assert len(set(c.names)) == len(c.names)
        assert set(c.primary_key) <= set(c.names)
        assert [f.name for f in c.struct_type() if not f.nullable] == [
            x.name for x in c.columns if not x.nullable
        ]
    assert CONTRACTS["bronze_gamma_markets"].column("condition_id").min_length == 66
    assert CONTRACTS["bronze_gamma_series"].column("comment_count").kind == "int"
    assert CONTRACTS["bronze_gamma_markets"].column("volume").kind == "string"
    assert CONTRACTS["bronze_gamma_events"].column("volume").kind == "double"


def test_kebab(spark):
    cases = {
        "Over 2.5 Goals": "over-2-5-goals",
        "YES": "yes",
        "": "",
        "???": "",
        "Élan vital": "élan-vital",
        "ABCTeam won": "abc-team-won",
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: r["k"] for r in df.select("s", kebab(F.col("s")).alias("k")).collect()}
    assert got == cases


def test_text_to_integer_truncates_and_keeps_digits(spark):
    cases = {
        "1.9": 1,
        "-0.9": 0,
        "-0.05": 0,
        "1e3": 1000,
        "9007199254740993": 9007199254740993,
        "abc": None,
        "1e30": None,
        "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    cast = casts.to_type("s", T.StringType(), T.LongType())
    assert {r["s"]: r["n"] for r in df.select("s", cast.alias("n")).collect()} == cases


def test_text_to_boolean_is_strict(spark):
    df = spark.createDataFrame([("true",), ("false",), ("1",), ("yes",), (None,)], "s string")
    cast = casts.to_type("s", T.StringType(), T.BooleanType())
    assert [r[0] for r in df.select(cast).collect()] == [True, False, None, None, None]


def test_uint32_range(spark):
    df = spark.createDataFrame([("007",), ("4294967295",), ("4294967296",), ("-1",), ("x",)], "s string")
    got = [r[0] for r in df.select(casts.uint32(F.col("s"))).collect()]
    assert got == [7, 4294967295, None, None, None]


def test_year(spark):
    df = spark.createDataFrame([("2023-12-31",), ("n/a",), (None,), ("20251",)], "s string")
    assert [r[0] for r in df.select(casts.year(F.col("s"))).collect()] == [2023, None, None, 2025]


def test_over_long_counts_bytes(spark):
    df = spark.createDataFrame([("x" * 500,), ("x" * 501,), ("é" * 400,), (None,)], "s string")
    got = [r[0] for r in df.select(casts.over_long_to_null(F.col("s"), 500)).collect()]
    assert got == ["x" * 500, None, None, None]


def test_json_lists(spark):
    cases = ['["0.4","0.6"]', "[0.4,0.6]", None, "bad", "[]", '["x", null]', '{"a": 1}']
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = df.select(
        lists.double_list(F.col("s")).alias("d"),
        lists.json_length(F.col("s")).alias("n"),
    ).collect()
    assert [r["d"] for r in got][:5] == [[0.4, 0.6], [0.4, 0.6], None, None, []]
    assert got[5]["d"] == [None, None]
    assert [r["n"] for r in got] == [2, 2, None, None, 0, 2, None]


def test_library_has_no_python_udf():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "marketlake"
    for f in root.rglob("*.py"):
        text = f.read_text()
        assert not re.search(r"\budf\b|mapInPandas|applyInPandas|\.rdd\b|localCheckpoint", text), f
