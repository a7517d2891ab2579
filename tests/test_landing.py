import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

import pages
from marketlake.sources import landing


def _write(folder, docs_by_name):
    for name, docs in docs_by_name.items():
        pages.write(str(folder), name, docs)
    return str(folder)


def _events(*ids):
    return [{"id": str(i), "title": f"t{i}"} for i in ids]


SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType())])


def test_feed_dimension_order(spark):
    full = [tuple(r) for r in landing.feed_dimension(spark).orderBy("feed_rank").collect()]
    assert full == [(True, True, 0), (True, False, 1), (False, True, 2), (False, False, 3)]
    only = [tuple(r) for r in landing.feed_dimension(spark, "active_only").collect()]
    assert only == [(True, False, 0)]


def test_list_pages_carry_their_place(spark, tmp_path, rows):
    path = _write(
        tmp_path / "list",
        {
            "events_active_open_page_0.json": _events(1, 2),
            "events_active_open_page_10.json": _events(3),
            "events_inactive_closed_page_0.json": _events(1),
            "other.json": _events(99),
        },
    )
    files = landing.page_files(spark, path)
    got = landing.event_rows(landing.page_rows(landing.list_pages(files), SCHEMA))
    assert rows(got, *landing.ORDINAL, "id") == [
        (0, 1, 0, 0, "1"),
        (0, 1, 0, 1, "2"),
        (0, 1, 10, 0, "3"),
        (0, 2, 0, 0, "1"),
    ]
    one_feed = landing.page_rows(landing.list_pages(files, "active_only"), SCHEMA)
    assert rows(one_feed, "id") == [("1",), ("2",), ("3",)]


def test_by_id_pages_are_ordered_by_smallest_id(spark, tmp_path, rows):
    path = _write(
        tmp_path / "by_id",
        {"events_30,7,21.json": _events(7, 30), "events_5.json": [], "events_active_open_page_1.json": _events(1)},
    )
    files = landing.page_files(spark, path)
    got = landing.page_rows(landing.by_id_pages(files), SCHEMA)
    assert rows(got, "_source_rank", "_page_no", "_pos", "id") == [
        (1, 5, None, None),
        (1, 7, 0, "7"),
        (1, 7, 1, "30"),
    ]
    assert rows(landing.requested_in_pages(files)) == [(5, 5), (7, 21), (7, 30), (7, 7)]


def test_malformed_pages_are_marked(spark, rows):
    texts = ['[{"id": "1"}]', "[]", "not json", '[{"id": "2"}']
    pages_df = spark.createDataFrame(
        [(t, 0, 0, i) for i, t in enumerate(texts)], "value string, _source_rank int, _feed_rank int, _page_no int"
    )
    got = landing.page_rows(pages_df, SCHEMA)
    assert rows(got, "_page_no", "_malformed", "id")[:2] == [(0, False, "1"), (1, False, None)]
    counts = {r["_page_no"]: (r["n_rows"], r["malformed"]) for r in landing.page_counts(got).collect()}
    assert counts[0] == (1, False) and counts[1] == (0, False) and counts[2] == (0, True)
    assert counts[3][1] or counts[3][0] == 0


def test_audit(spark):
    def feed(rank, sizes):
        return [(0, rank, n, size, False) for n, size in enumerate(sizes) if size is not None]

    data = feed(0, [100, 100, 37]) + feed(1, [100, 100]) + feed(2, [100, None, 40, 100, 0]) + feed(3, [0])
    counts = spark.createDataFrame(
        data, "_source_rank int, _feed_rank int, _page_no bigint, n_rows bigint, malformed boolean"
    )
    got = {
        r["feed_rank"]: (r["rows"], r["missing_pages"], r["short_inner_pages"], r["at_row_cap"], r["status"])
        for r in landing.audit_feeds(counts, max_rows=200).collect()
    }
    assert got == {
        0: (237, 0, 0, True, "complete"),
        1: (200, 0, 0, True, "truncated"),
        2: (240, 1, 1, True, "gaps"),
        3: (0, 0, 0, False, "complete"),
    }
    holes = landing.missing_pages(counts).collect()
    assert [tuple(r) for r in holes] == [(2, 1)]


def test_missing_first_pages_are_named(spark, rows):
    counts = spark.createDataFrame([(0, 0, 3, 1, False), (0, 0, 7, 1, False)], "_source_rank int, _feed_rank int, _page_no bigint, n_rows bigint, malformed boolean")
    assert rows(landing.missing_pages(counts), "page_no") == [(0,), (1,), (2,), (4,), (5,), (6,)]


def test_nested_values_of_the_wrong_shape_are_marked(spark, rows):
    schema = T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("markets", T.ArrayType(T.StructType([T.StructField("id", T.StringType())]))),
        T.StructField("tags", T.ArrayType(T.StructType([T.StructField("id", T.StringType())]))),
    ])
    events = [
        {"id": "1", "markets": [{"id": "11"}], "tags": []}, {"id": "2", "markets": {"id": "21"}, "tags": "x"},
        {"id": "3", "markets": None}, {"id": "4", "markets": "text", "tags": [{"id": "41"}]},
    ]
    texts = [json.dumps(events), json.dumps(events[:1]), json.dumps(events[0]), "  " + json.dumps(events[:1])]
    df = spark.createDataFrame([(t, 0, 0, i) for i, t in enumerate(texts)], "value string, _source_rank int, _feed_rank int, _page_no int")
    got = landing.page_rows(df, schema)
    assert rows(landing.misshapen(got), "_page_no", "id", "wrong_shape") == [(0, "2", ["markets", "tags"]), (0, "4", ["markets"])]
    # a bare object is no page
    assert rows(got.filter("_malformed"), "_page_no") == [(2,)]
    assert landing.event_rows(got).count() == 6


def test_unmatched_files(spark, rows):
    names = ["events_active_open_page_0.json", "events_active_open_page_x.json", "notes.json", "events_1,2.json"]
    files = spark.createDataFrame([(n, "[]") for n in names], "file_name string, value string")
    assert rows(landing.unmatched_files(files, landing.LIST_PAGE)) == [("events_1,2.json",), ("events_active_open_page_x.json",), ("notes.json",)]
    assert rows(landing.page_names(files)) == [("events_1,2.json",)]


def test_fingerprint_follows_the_files(spark, tmp_path):
    path = _write(tmp_path / "f", {"a.json": _events(1), "b.json": _events(2)})
    before = landing.fingerprint(spark, path)
    assert before == landing.fingerprint(spark, path)
    _write(tmp_path / "f", {"c.json": _events(3)})
    assert before != landing.fingerprint(spark, path)


def test_inference_keeps_text_and_pins_the_second_source(spark, tmp_path, rows):
    first = _write(tmp_path / "a", {"m.json": [{"id": "1", "n": 9007199254740993, "x": 1.5}, {"id": "2", "x": "s"}]})
    second = _write(tmp_path / "b", {"m.json": [{"id": "3", "extra": 1}]})
    schema = landing.infer_schema(spark, first)
    assert {f.name: f.dataType for f in schema} == {c: T.StringType() for c in ("id", "n", "x")}
    merged = landing.concat_feeds(landing.read_merged(spark, first), landing.read_merged(spark, second, schema))
    assert rows(merged, "id", "n", "x") == [
        ("1", "9007199254740993", "1.5"),
        ("2", None, "s"),
        ("3", None, None),
    ]
    assert rows(landing.read_merged(spark, first, "id string")) == [("1",), ("2",)]


def test_packed_pages_read_like_files(spark, tmp_path, rows):
    path = _write(tmp_path / "l", {f"events_active_open_page_{i}.json": _events(i) for i in range(5)})
    files = landing.page_files(spark, path)
    landing.pack_pages(files, str(tmp_path / "packed"))
    packed = landing.packed_pages(spark, str(tmp_path / "packed"))
    read = [rows(landing.page_rows(landing.list_pages(p), SCHEMA)) for p in (files, packed)]
    assert read[0] == read[1] and len(read[0]) == 5
    assert landing.infer_packed_schema(packed) == landing.infer_schema(spark, path)


def test_packed_schema_is_the_inferred_one(spark, tmp_path):
    docs = [{"id": 1, "x": 1.5, "markets": [{"id": "a", "n": 2}], "e": None}, {"id": "2", "markets": [], "tags": [{"id": 1}], "ok": True}]
    path = _write(tmp_path / "l", {"events_active_open_page_0.json": docs, "events_active_open_page_1.json": []})
    assert landing.infer_packed_schema(landing.page_files(spark, path)) == landing.infer_schema(spark, path)


def test_feed_predicate(spark):
    data = [(True, False, "2025-01-01"), (True, False, "2024-12-31T23:59:59Z"), (True, True, "2025-06-01"), (True, False, None)]
    df = spark.createDataFrame(data, "active boolean, closed boolean, startDate string")
    assert df.filter(landing.feed_predicate(True, False)).count() == 1
    assert df.filter(landing.feed_predicate(True, False, None)).count() == 3


def test_text_is_exact(spark):
    doc = json.dumps([{"id": "1", "title": 'quote " and 東京\n'}], ensure_ascii=False)
    df = spark.createDataFrame([(doc, 0, 0, 0)], "value string, _source_rank int, _feed_rank int, _page_no int")
    assert landing.page_rows(df, SCHEMA).first()["title"] == 'quote " and 東京\n'
    assert df.select(F.json_array_length("value")).first()[0] == 1
