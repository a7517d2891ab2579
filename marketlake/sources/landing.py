"""Landed JSON pages: reading, ordering, schema and audit.

A page is one file holding a JSON array of events.  List pages are named
``events_{active|inactive}_{closed|open}_page_{n}.json`` and by-id pages
``events_{id},{id},….json``.  Every event row carries its place in the landing
(``ORDINAL``), which defines which copy of an entity is the last one.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Page size, row cap per feed, and the feeds in the order they are landed.
PAGE_SIZE = 100
MAX_ROWS_PER_FEED = 50_000
START_DATE_MIN = "2025-01-01"
FEEDS = {
    "full": [(True, True), (True, False), (False, True), (False, False)],
    "active_only": [(True, False)],
}
LIST_PAGE = r"events_(active|inactive)_(closed|open)_page_(\d+)\.json$"
BY_ID_PAGE = r"events_(\d+(?:,\d+)*)\.json$"

LIST_SOURCE, BY_ID_SOURCE = 0, 1
PAGE = ["_source_rank", "_feed_rank", "_page_no"]
ORDINAL = [*PAGE, "_pos"]


def feed_dimension(spark: SparkSession, mode: str = "full") -> DataFrame:
    """The feeds of a run mode with their landing order: at most four rows."""
    rows = ", ".join(
        f"({active}, {closed}, {rank})" for rank, (active, closed) in enumerate(FEEDS[mode])
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS feeds(feed_active, feed_closed, feed_rank)")


def feed_predicate(
    active: bool, closed: bool, start_date_min: str | None = START_DATE_MIN
) -> Column:
    """What a list feed selects; dates are ISO text, compared from their first character."""
    keep = (F.col("active") == active) & (F.col("closed") == closed)
    return keep if start_date_min is None else keep & (F.col("startDate") >= start_date_min)


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, value): whole files as rows; a page has at most 100 events."""
    return spark.read.text(path, wholetext=True, pathGlobFilter="*.json").select(
        F.col("_metadata.file_name").alias("file_name"), "value"
    )


def packed_pages(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, value): pages packed into Parquet by :func:`pack_pages`."""
    return spark.read.parquet(path).select("file_name", "value")


def pack_pages(pages: DataFrame, path: str) -> None:
    """Keep pages as a few large Parquet files.

    Millions of page files cost more to list and open than to parse; a landing that
    large should be packed once and read packed from then on.
    """
    pages.select("file_name", "value").write.mode("overwrite").parquet(path)


def unmatched_files(pages: DataFrame, pattern: str) -> DataFrame:
    """(file_name): files in a page folder that are no pages by their name."""
    return pages.filter(~F.col("file_name").rlike(pattern)).select("file_name")


def page_names(pages: DataFrame, pattern: str = BY_ID_PAGE) -> DataFrame:
    """(page_name): names of the landed pages, without their folder."""
    names = pages.select(F.regexp_extract("file_name", f"({pattern})", 1).alias("page_name"))
    return names.filter("page_name <> ''").distinct()


def fingerprint(spark: SparkSession, path: str) -> str:
    """Number, names, sizes and times of the files below ``path``, as one text.

    Only the listing is read; the sum does not depend on the order of the files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    n, total = files.agg(F.count(F.lit(1)), F.sum(mark)).first()
    return f"{n} files {total}"


def list_pages(pages: DataFrame, mode: str = "full") -> DataFrame:
    """One row per list page of the mode's feeds, with its order; other files are left out."""
    name = F.col("file_name")
    named = pages.select(
        "value",
        (F.regexp_extract(name, LIST_PAGE, 1) == "active").alias("feed_active"),
        (F.regexp_extract(name, LIST_PAGE, 2) == "closed").alias("feed_closed"),
        F.regexp_extract(name, LIST_PAGE, 3).try_cast("bigint").alias("_page_no"),
    ).filter(F.col("_page_no").isNotNull())
    feeds = F.broadcast(feed_dimension(pages.sparkSession, mode))
    return named.join(feeds, ["feed_active", "feed_closed"]).select(
        "value",
        F.lit(LIST_SOURCE).alias("_source_rank"),
        F.col("feed_rank").alias("_feed_rank"),
        "_page_no",
    )


def by_id_pages(pages: DataFrame) -> DataFrame:
    """One row per by-id page; the smallest id orders the pages among each other."""
    return pages.select("value", _page_ids().alias("_ids")).filter(
        F.element_at("_ids", 1).isNotNull()
    ).select(
        "value",
        F.lit(BY_ID_SOURCE).alias("_source_rank"),
        F.lit(0).alias("_feed_rank"),
        F.array_min("_ids").alias("_page_no"),
    )


def requested_in_pages(pages: DataFrame) -> DataFrame:
    """(batch, event_id) from the names of by-id pages."""
    named = pages.select(_page_ids().alias("_ids")).filter(F.element_at("_ids", 1).isNotNull())
    return named.select(F.array_min("_ids").alias("batch"), F.explode("_ids").alias("event_id"))


def _page_ids() -> Column:
    """Ids in a by-id file name; the array holds one NULL for any other name."""
    texts = F.split(F.regexp_extract("file_name", BY_ID_PAGE, 1), ",")
    return F.transform(texts, lambda x: x.try_cast("bigint"))


def page_rows(pages: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse pages against ``schema``: one row per event, with its ordinal.

    Fields outside the schema are left out and absent ones are NULL.  A page without
    events gives one row whose ``_pos`` is NULL, with ``_malformed`` set when its text is
    no array of objects (a bare object is none): one pass over the text then serves the
    tables and the audit.

    A nested value of the wrong shape parses to NULL like an absent one.  ``_wrong_shape``
    holds the names of such fields, NULL on sound events.  Only pages with an event that
    lacks a nested value are looked at again, for the raw text of those fields.
    """
    nested = [f.name for f in schema if isinstance(f.dataType, T.ArrayType | T.StructType)]
    array = F.col("value").startswith("[") | F.ltrim("value").startswith("[")
    parsed = pages.withColumn("_events", F.when(array, F.from_json("value", T.ArrayType(schema))))
    each = F.lit(None).cast("array<array<string>>")
    if nested:
        raw = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in nested]))
        doubtful = F.exists("_events", lambda e: reduce(or_, [e[n].isNull() for n in nested]))
        parsed = parsed.withColumn("_raw", F.when(doubtful, F.from_json("value", raw)))

        def wrong(e: Column, r: Column) -> Column:
            names = [F.when(e[n].isNull() & (r[n] != "null"), F.lit(n)) for n in nested]
            return F.when(reduce(or_, [n.isNotNull() for n in names]), F.array_compact(F.array(*names)))

        each = F.zip_with("_events", "_raw", wrong)  # NULL without raw text
    # The names stay apart from the events, which would be built anew with them.
    parsed = parsed.select(*PAGE, "_events", F.col("_events").isNull().alias("_malformed"), each.alias("_wrong"))
    rows = parsed.select(*PAGE, "_malformed", "_wrong", F.posexplode_outer("_events").alias("_pos", "_event"))
    return rows.select(*ORDINAL, "_malformed", F.get("_wrong", F.col("_pos")).alias("_wrong_shape"), "_event.*")


def misshapen(rows: DataFrame) -> DataFrame:
    """(ordinal, id, wrong_shape): events with a nested value that is no array or struct."""
    wrong = rows.filter(F.col("_wrong_shape").isNotNull())
    return wrong.select(*ORDINAL, "id", F.col("_wrong_shape").alias("wrong_shape"))


def event_rows(rows: DataFrame) -> DataFrame:
    """Only the events of :func:`page_rows`, without page placeholders."""
    return rows.filter(F.col("_pos").isNotNull()).drop("_malformed", "_wrong_shape")


def without_fields(schema: T.StructType, names: Collection[str]) -> T.StructType:
    """The schema without the named fields, also inside nested arrays of structs."""

    def prune(t: T.DataType) -> T.DataType:
        if isinstance(t, T.ArrayType):
            return T.ArrayType(prune(t.elementType), t.containsNull)
        if isinstance(t, T.StructType):
            return without_fields(t, names)
        return t

    return T.StructType(
        [T.StructField(f.name, prune(f.dataType), f.nullable) for f in schema if f.name not in names]
    )


def infer_packed_schema(pages: DataFrame) -> T.StructType:
    """The same as :func:`infer_schema` for pages that are rows, in one aggregation over them."""
    text = pages.agg(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]
    found = T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))
    if not isinstance(found, T.ArrayType) or not isinstance(found.elementType, T.StructType):
        raise ValueError(f"packed pages are no arrays of objects: {text[:200]}")

    def as_text(t: T.DataType) -> T.DataType:
        if isinstance(t, T.ArrayType):
            return T.ArrayType(as_text(t.elementType))
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in t])
        return T.StringType()

    return as_text(found.elementType)


def infer_schema(
    spark: SparkSession, path: str, sampling_ratio: float = 1.0, multi_line: bool = True
) -> T.StructType:
    """Field names and nesting from all pages; every scalar stays text.

    Text keeps big integers and mixed types as landed; contracts do the casting.
    ``multi_line`` reads one JSON array per file, otherwise one event per line.
    """
    reader = spark.read.option("multiLine", multi_line).option("primitivesAsString", True)
    reader = reader.option("samplingRatio", sampling_ratio)
    return reader.json(path, pathGlobFilter="*.json").schema


def read_merged(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Events of merged files, inferred from all rows or against a pinned schema.

    A file with one JSON array cannot be split; landings larger than a few GB per file
    should hold one event per line (``multi_line=False``).
    """
    if schema is None:
        schema = infer_schema(spark, path, multi_line=multi_line)
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def concat_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows, aligned by name; a column missing from one feed is NULL there."""
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out


def page_counts(rows: DataFrame) -> DataFrame:
    """Events per page, empty and malformed pages included."""
    return rows.groupBy(*PAGE).agg(
        F.count("_pos").alias("n_rows"), F.bool_or("_malformed").alias("malformed")
    )


def audit_feeds(
    counts: DataFrame, page_size: int = PAGE_SIZE, max_rows: int = MAX_ROWS_PER_FEED
) -> DataFrame:
    """One row per feed: pages, rows, and how the feed ended.

    A feed is ``truncated`` when its last page is full (it stopped at the row cap, or
    before its end), has ``gaps`` when page numbers are missing or a page before the last
    one is short, and is ``complete`` otherwise.
    """
    page = F.struct("_page_no", "n_rows")
    per_feed = counts.groupBy("_feed_rank").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("n_rows").cast("bigint").alias("rows"),
        F.max("_page_no").alias("last_page"),
        F.max(page)["n_rows"].alias("last_page_rows"),
        F.count_if(F.col("n_rows") < page_size).alias("_short"),
        F.count_if("malformed").alias("malformed_pages"),
    )
    last_full = F.col("last_page_rows") >= page_size
    missing = F.col("last_page") + 1 - F.col("pages")
    short_inner = F.col("_short") - F.when(last_full, 0).otherwise(1)
    gaps = (missing > 0) | (short_inner > 0)
    return per_feed.select(
        F.col("_feed_rank").alias("feed_rank"),
        "pages",
        "rows",
        "last_page",
        "last_page_rows",
        missing.alias("missing_pages"),
        short_inner.alias("short_inner_pages"),
        "malformed_pages",
        (F.col("rows") >= max_rows).alias("at_row_cap"),
        F.when(gaps, "gaps").when(last_full, "truncated").otherwise("complete").alias("status"),
    )


def missing_pages(counts: DataFrame) -> DataFrame:
    """(feed_rank, page_no) of every page number that a feed skips before its last page.

    Each landed page gives the run of numbers between it and the page before it.  The
    window holds the pages of one feed that were landed, at most the row cap over the
    page size.
    """
    before = F.lag("_page_no", 1, -1).over(Window.partitionBy("_feed_rank").orderBy("_page_no"))
    holes = counts.select("_feed_rank", "_page_no", before.alias("_before"))
    holes = holes.filter(F.col("_page_no") > F.col("_before") + 1)
    numbers = F.explode(F.sequence(F.col("_before") + 1, F.col("_page_no") - 1))
    return holes.select(F.col("_feed_rank").alias("feed_rank"), numbers.alias("page_no"))
