"""Events stored whole as VARIANT."""

import json

import pytest
from pyspark.sql import types as T

from marketlake.sources.raw import backfill, fields_of, raw_events, unknown_fields

PLACE = "_source_rank int, _feed_rank int, _page_no int, value string"


@pytest.fixture
def raw(spark, tmp_path):
    pages = [
        (0, 1, 0, json.dumps([{"id": "1", "slug": "a", "new field": 3, "it's": [1, {"x": None}]}, {"id": "2", "slug": "b"}])),
        (0, 1, 1, json.dumps([{"id": "1", "slug": "a2", "new field": 4.25}, "no object", {"id": None, "new field": "text"}])),
        (0, 1, 2, "[]"), (0, 1, 3, '{"id": "9"}'), (0, 1, 4, "not json"), (0, 1, 5, None),
    ]
    raw_events(spark.createDataFrame(pages, PLACE)).write.parquet(str(tmp_path / "raw"))
    return spark.read.parquet(str(tmp_path / "raw"))


def test_events_and_broken_pages_keep_their_places(raw, rows):
    assert rows(raw.selectExpr("_page_no", "_pos", "event IS NULL")) == [
        (0, 0, False), (0, 1, False), (1, 0, False), (1, 1, False), (1, 2, False), (3, None, True), (4, None, True), (5, None, True),
    ]


def test_fields_are_read_by_type(raw, rows):
    got = fields_of(raw, T.StructType.fromDDL("id string, `new field` double, `it's` array<variant>"))
    assert rows(got.selectExpr("_page_no", "_pos", "id", "`new field`", "size(`it's`)")) == [
        (0, 0, "1", 3.0, 2), (0, 1, "2", None, None), (1, 0, "1", 4.25, None), (1, 1, None, None, None), (1, 2, None, None, None),
    ]


def test_unknown_fields_are_reported(raw, rows):
    assert rows(unknown_fields(raw, ["id", "slug"]).select("field", "n_events")) == [("it's", 1), ("new field", 3)]
    assert unknown_fields(raw, ["id", "slug", "it's", "new field"]).isEmpty()


def test_a_field_added_later_is_filled_from_the_last_copy(spark, raw, rows):
    table = spark.createDataFrame([("1", "a2"), ("2", "b"), ("7", "gone"), (None, "x")], "event_id string, slug string")
    got = backfill(table, raw, "event_id", "id", {"added": ("new field", "double")})
    assert rows(got) == sorted([("1", "a2", 4.25), ("2", "b", None), ("7", "gone", None), (None, "x", None)], key=repr)
    with pytest.raises(ValueError, match="slug"):
        backfill(table, raw, "event_id", "id", {"slug": ("slug", "string")})
