from datetime import datetime

import pytest

from marketlake.contracts import TAGS, Col, Contract
from marketlake.sinks import tables
from marketlake.sources.snapshot import read_table_if_exists


def test_csv_and_parquet_keep_every_value(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [(1, None, True), (2, "", None), (3, ' a "quoted", text\nwith lines ', False), (4, "back\\slash", True)],
        "id int, s string, b boolean",
    )
    stored = tables.publish(df, "t", str(tmp_path))
    assert rows(stored) == rows(df)
    assert rows(tables.read_csv(spark, str(tmp_path / "t.csv"), df.schema)) == rows(df)
    lines = [p.read_text() for p in (tmp_path / "t.csv").glob("*.csv")]
    assert any("1,,true" in t for t in lines) and any('2,"",' in t for t in lines)
    assert all(t.startswith("id,s,b") for t in lines if t)


def test_json_is_scoped_to_the_run(spark, tmp_path):
    a = tables.write_json(spark.range(5).selectExpr("cast(id as string) id"), str(tmp_path), "a")
    b = tables.write_json(spark.range(2).selectExpr("cast(id as string) id"), str(tmp_path), "b")
    assert spark.read.json(a).count() == 5 and spark.read.json(b).count() == 2


def test_create_table_has_contract_and_audit_columns(spark, tmp_path):
    df = tables.create_table(spark, TAGS, str(tmp_path / "t"))
    assert df.columns == [*TAGS.names, *tables.AUDIT_COLUMNS] and df.count() == 0


def test_missing_table_is_none(spark, tmp_path):
    assert read_table_if_exists(spark, str(tmp_path / "nope")) is None
    assert read_table_if_exists(spark, None) is None


def test_upsert_audit(spark):
    first, second, third = (datetime(2025, m, 1) for m in (1, 2, 3))
    old = spark.createDataFrame(
        [("k", "keep", first, first), ("s", "same", first, second), ("c", "before", first, first), ("n", None, first, first)],
        "id string, v string, db_created_at timestamp, db_updated_at timestamp",
    )
    new = spark.createDataFrame([("s", "same"), ("c", "after"), ("i", "new"), ("n", None)], "id string, v string")
    got = {r["id"]: tuple(r)[1:] for r in tables.upsert(old, new, ["id"], third).collect()}
    assert got == {
        "k": ("keep", first, first),
        "s": ("same", first, second),
        "c": ("after", first, third),
        "i": ("new", third, third),
        "n": (None, first, first),
    }


def test_upsert_with_two_keys(spark):
    at = datetime(2025, 1, 1)
    old = spark.createDataFrame([("a", "b", 1, at, at)], "x string, y string, v int, db_created_at timestamp, db_updated_at timestamp")
    new = spark.createDataFrame([("a", "c", 2), ("a", "b", 3)], "x string, y string, v int")
    got = sorted(tuple(r)[:3] for r in tables.upsert(old, new, ["x", "y"], at).collect())
    assert got == [("a", "b", 3), ("a", "c", 2)]


def test_upsert_follows_the_contract(spark, rows):
    """The stored table is older than its contract: a column is new, another one left."""
    contract = Contract("t", (Col("id", "string"), Col("v", "string"), Col("fresh", "bigint")), ("id",))
    at, later = datetime(2025, 1, 1), datetime(2025, 2, 1)
    old = spark.createDataFrame(
        [("a", "x", "gone", at, at), ("b", "y", "gone", at, at)],
        "id string, v string, left_out string, db_created_at timestamp, db_updated_at timestamp",
    )
    new = spark.createDataFrame([("a", "x", 7), ("c", "z", None)], "id string, v string, fresh bigint")
    got = tables.upsert(old, new, ["id"], later, contract)
    assert got.columns == ["id", "v", "fresh", *tables.AUDIT_COLUMNS]
    assert rows(got) == [("a", "x", 7, at, later), ("b", "y", None, at, at), ("c", "z", None, later, later)]
    with pytest.raises(ValueError, match="fresh"):
        tables.upsert(old, new, ["id"], later)
