"""Registered queries: the engine's operators over the star-schema tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.contracts import (
    CONTRACTS,
    DEPENDENCIES,
    EVENT_SERIES_LINK,
    EVENT_TAG_LINK,
    EVENTS,
    MARKETS,
    OUTCOMES,
    RELATION_TYPES,
    SERIES,
    TAGS,
    Col,
    Contract,
    ForeignKey,
)
from marketlake.functions.casts import to_type, uint32, year
from marketlake.functions.lists import double_list, json_length, string_list
from marketlake.functions.naming import kebab
from marketlake.operators import bloom, dependencies, quality, reconcile
from marketlake.operators.dedup import keep_last
from marketlake.operators.outcomes import (
    binary_or_recent,
    dropped_outcomes as dropped_outcome_report,
    long_list_report,
    outcomes_of,
    with_condition,
)
from marketlake.operators.ranks import key_batches
from marketlake.operators.shape import (
    ARRAY_POS,
    conform,
    drop_listed,
    explode_structs,
    column_differences,
    nullify_long,
    over_long,
    rename_exact,
    rename_snake,
)
from marketlake.plans.bronze import build_events, build_markets, build_series, build_tags
from marketlake.plans.pipeline import Landing, plan_run, run_pipeline
from marketlake.queries.feed import (
    EVENT_KEYS,
    LAST_YEAR,
    ORDER,
    array_of,
    documents,
    event_pages,
    events,
    field,
    landed_fields,
    order_pages,
    table,
)
from marketlake.session import work_folder
from marketlake.sinks import tables as sinks
from marketlake.sinks.versions import Warehouse
from marketlake.sources import landing, raw
from marketlake.streaming import landing as stream

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def scratch(spark: SparkSession, name: str) -> str:
    """The folder of a table that a query stores and reads back, one per session and query.

    It lies below the checkpoint folder, or else in the warehouse: both are shared by
    driver and executors.  Another call of the query writes it anew, and the end of the
    session deletes it.
    """
    base = work_folder(spark, spark.conf.get("spark.sql.warehouse.dir"))
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/marketlake-{spark.sparkContext.applicationId}")
    root.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(root)
    return f"{root.toString()}/{name}"


# -- landed events to markets -------------------------------------------------

_MARKET_FIELDS = array_of(
    [
        field(n)
        for n in (
            "id",
            "slug",
            "question",
            "conditionId",
            "startDate",
            "outcomes",
            "outcomePrices",
            "clobTokenIds",
        )
    ]
)


def _market_events(spark: SparkSession, sf_dir: str, empty: bool) -> DataFrame:
    return events(spark, sf_dir, [*EVENT_KEYS, T.StructField("markets", _MARKET_FIELDS)], empty)


def _market_rows(spark: SparkSession, sf_dir: str, outer: bool = False) -> DataFrame:
    carry = [F.col("id").alias("event_id"), F.col("slug").alias("event_slug"), *ORDER]
    rows = explode_structs(_market_events(spark, sf_dir, outer), "markets", carry, outer)
    rows = rename_snake(rows, keep=ORDER)
    return rename_exact(rows, {"id": "market_id", "slug": "market_slug"})


def _last_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_last(_market_rows(spark, sf_dir), ["market_id"], [*ORDER, ARRAY_POS])


def _kept_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    markets = with_condition(_last_markets(spark, sf_dir))
    return markets.filter(binary_or_recent(LAST_YEAR))


@_query
def outcomes_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON to market outcomes: explode, keep-last, both filters, parse, zip."""
    return outcomes_of(_kept_markets(spark, sf_dir)).select(*OUTCOMES.names)


@_query
def explode_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _market_rows(spark, sf_dir)
    return rows.select("event_id", "event_slug", "market_id", "question", "condition_id")


@_query
def explode_markets_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _market_rows(spark, sf_dir, outer=True)
    return rows.select("event_id", "event_slug", "market_id", "question")


@_query
def markets_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _last_markets(spark, sf_dir)
    return rows.select("event_id", "market_id", "market_slug", "question", "condition_id")


@_query
def filter_nonempty_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_condition(_market_rows(spark, sf_dir))
    return rows.select("market_id", "question", "condition_id")


@_query
def filter_binary_or_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three-valued filter, with NULL outcomes and dates that start with no year."""
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_suppkey",
            F.when(
                F.col("l_returnflag") != "A",
                F.when(F.col("l_suppkey") % 7 == 0, F.lit('["a","b","c"]')).otherwise('["a","b"]'),
            ).alias("outcomes"),
            F.when(F.col("l_linenumber") == 1, "n/a")
            .when(F.col("l_linenumber") > 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .alias("start_date"),
        )
    )
    return rows.filter(binary_or_recent(LAST_YEAR))


@_query
def json_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text to lists: lengths, elements by position, quoted numbers as doubles."""
    rows = _last_markets(spark, sf_dir).select(
        "market_id",
        "outcomes",
        string_list(F.col("outcomes")).alias("names"),
        double_list(F.col("outcome_prices")).alias("prices"),
        string_list(F.col("clob_token_ids")).alias("tokens"),
    )
    return rows.select(
        "market_id",
        json_length(F.col("outcomes")).cast("bigint").alias("n_outcomes"),
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.get("names", F.lit(1)).alias("second_name"),
        F.get("prices", F.lit(0)).alias("first_price"),
        F.get("prices", F.lit(1)).alias("second_price"),
        F.get("prices", F.lit(2)).alias("third_price"),
        F.get("tokens", F.lit(0)).alias("first_token"),
    )


@_query
def dropped_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markets that give no outcome, or not all of their values, with the reason."""
    return dropped_outcome_report(_kept_markets(spark, sf_dir))


@_query
def long_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_list_report(_last_markets(spark, sf_dir))


# -- bronze and silver tables -------------------------------------------------


def _staged(df: DataFrame, contract: Contract, name: str) -> DataFrame:
    """Cast, check and store candidate rows, as a run does before it splits them.

    Storing also cuts the plan: the rules of a wide table on top of its casts would be
    one expression that the optimizer cannot handle in reasonable time.
    """
    if quality.CAST_FAILED not in df.columns:
        df = quality.coerce(df, contract)
    return sinks.write_parquet(quality.check_rows(df, contract), scratch(df.sparkSession, name))


def _split(
    df: DataFrame, contract: Contract, name: str, proven: Collection[Sequence[str]] = ()
) -> tuple[DataFrame, DataFrame]:
    """Stage and split candidate rows.

    The duplicated keys are stored before they are joined, as a run does: Spark then knows
    their size, and a few keys don't send every wide row through a shuffle and a sort.
    """
    staged = _staged(df, contract, name)
    duplicates = {
        rule: sinks.write_parquet(keys, scratch(df.sparkSession, f"{name}_duplicates/{rule}"))
        for rule, keys in quality.group_duplicates(staged, contract, proven).items()
    }
    return quality.split(staged, contract, duplicates=duplicates)


def _bronze_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = landed_fields(MARKETS, ("event_id", "event_slug"))
    parsed = events(spark, sf_dir, [*EVENT_KEYS, T.StructField("markets", array_of(fields))])
    return build_markets(parsed, ORDER, LAST_YEAR)


@_query
def bronze_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 110 columns of the markets that satisfy the contract."""
    return _split(_bronze_markets(spark, sf_dir), MARKETS, "bronze_markets", [MARKETS.primary_key])[0]


@_query
def bronze_markets_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "bronze_markets_quarantine"
    bad = _split(_bronze_markets(spark, sf_dir), MARKETS, name, [MARKETS.primary_key])[1]
    return bad.select("market_id", F.array_join(quality.FAILED_RULES, ",").alias("rules"))


@_query
def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [f for f in landed_fields(EVENTS) if f.name != "liquidityAmm"]
    nested = [T.StructField(n, T.StringType()) for n in ("eventMetadata", "eventCreators")]
    candidate = build_events(events(spark, sf_dir, [*fields, *nested], empty=True), ORDER)
    return _split(candidate, EVENTS, "bronze_events", [EVENTS.primary_key])[0]


def _series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    fields = [f for f in landed_fields(SERIES) if f.name != "description"]
    fields = [*EVENT_KEYS, T.StructField("series", array_of(fields))]
    return build_series(events(spark, sf_dir, fields, empty=True), ORDER)


@_query
def bronze_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(_series(spark, sf_dir)[0], SERIES, "bronze_series")
    return quality.split(staged, SERIES, [SERIES.primary_key])[0]


@_query
def event_series_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(_series(spark, sf_dir)[1], EVENT_SERIES_LINK, "event_series_link")
    return quality.split(staged, EVENT_SERIES_LINK, [EVENT_SERIES_LINK.primary_key])[0]


def _tags(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    fields = array_of(landed_fields(TAGS))
    return build_tags(events(spark, sf_dir, [*EVENT_KEYS, T.StructField("tags", fields)]), ORDER)


@_query
def bronze_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(_tags(spark, sf_dir)[0], TAGS, "bronze_tags")
    return quality.split(staged, TAGS, [TAGS.primary_key])[0]


@_query
def event_tag_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(_tags(spark, sf_dir)[1], EVENT_TAG_LINK, "event_tag_link")
    return quality.split(staged, EVENT_TAG_LINK, [EVENT_TAG_LINK.primary_key])[0]


@_query
def silver_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes that satisfy the contract: every row of a shared token is rejected."""
    return _split(outcomes_of(_kept_markets(spark, sf_dir)), OUTCOMES, "silver_outcomes")[0]


@_query
def silver_outcomes_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = _split(outcomes_of(_kept_markets(spark, sf_dir)), OUTCOMES, "silver_outcomes_violations")[1]
    return quality.rule_counts(bad)


# -- feeds, pages and scans ---------------------------------------------------

_ORDER_EVENT = T.StructType([field(n) for n in ("id", "slug", "active", "closed", "startDate")])


@_query
def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of JSON arrays to events with their place in the landing."""
    rows = landing.event_rows(landing.page_rows(order_pages(spark, sf_dir), _ORDER_EVENT))
    return rows.select(
        F.col("_feed_rank").alias("feed_rank"),
        F.col("_page_no").alias("page_no"),
        F.col("_pos").alias("pos"),
        "id",
        "slug",
    )


@_query
def feed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the feed of active open events since a date selects."""
    pages = landing.page_rows(order_pages(spark, sf_dir), _ORDER_EVENT)
    typed = landing.event_rows(pages).withColumns(
        {c: to_type(c, T.StringType(), T.BooleanType()) for c in ("active", "closed")}
    )
    wanted = landing.feed_predicate(active=True, closed=False, start_date_min="1998-01-01")
    return typed.filter(wanted).select("id", "startDate")


@_query
def feed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every feed ended, joined to the feed dimension."""
    rows = landing.page_rows(order_pages(spark, sf_dir), T.StructType([field("id")]))
    audit = landing.audit_feeds(landing.page_counts(rows), page_size=65, max_rows=5_000)
    return audit.join(F.broadcast(landing.feed_dimension(spark)), "feed_rank")


@_query
def feed_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page numbers that a feed skips: here, every third page of one feed did not land."""
    rows = landing.page_rows(order_pages(spark, sf_dir), T.StructType([field("id")]))
    counts = landing.page_counts(rows).filter("NOT (_feed_rank = 1 AND _page_no % 3 = 0)")
    return landing.missing_pages(counts)


@_query
def projected_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the ids of landed events, as numbers."""
    ids = events(spark, sf_dir, [field("id")], empty=True)
    return ids.select(uint32(F.col("id")).alias("event_id"))


@_query
def two_feed_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List feed plus by-id feed: a re-queried event replaces every list copy."""
    listed = events(spark, sf_dir, [field("id"), field("title")], empty=True)
    listed = listed.withColumn("source_rank", F.lit(landing.LIST_SOURCE))
    open_orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    by_id = open_orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("Refreshed order "), F.col("o_orderkey")).alias("title"),
        F.lit(landing.BY_ID_SOURCE).alias("source_rank"),
    )
    rows = landing.concat_feeds(listed, by_id)
    return keep_last(rows, ["id"], ["source_rank", *ORDER]).select("id", "title")


@_query
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events written under a run folder, read back with an inferred text schema."""
    docs = documents(spark, sf_dir, ["tags"], empty=True).select(
        F.from_json("value", _RAW_EVENT).alias("e")
    ).select("e.*")
    path = sinks.write_json(docs, scratch(spark, "raw"), "q")
    back = landing.read_merged(spark, path, multi_line=False)
    return back.select("id", "title", "openInterest", F.size("tags").cast("bigint").alias("n_tags"))


_RAW_EVENT = (
    "id string, title string, openInterest double, "
    "tags array<struct<id:string,slug:string,requiresTranslation:boolean>>"
)


@_query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published CSV read back: quotes, line breaks, spaces, NULL and empty text survive."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        F.when(F.col("lang") != "de", F.col("lang")).alias("lang"),
        F.when(F.col("n_chars") > 400, F.concat(F.lit('  "'), F.col("source"), F.lit(' '))).otherwise(
            ""
        ).alias("note"),
    )
    root = scratch(spark, "csv")
    sinks.publish(docs, "documents", root)
    return sinks.read_csv(spark, f"{root}/documents.csv", docs.schema)


# -- projections --------------------------------------------------------------


@_query
def snake_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """camelCase with digits to snake_case, then the explicit renames."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("id"),
        F.col("l_extendedprice").alias("volume24hr"),
        F.col("l_quantity").alias("volume1wkAmm"),
        F.col("l_discount").alias("umaResolutionStatus"),
        F.col("l_tax").alias("showGMPSeries"),
        (F.col("l_linenumber") == 1).alias("new"),
    )
    return rename_exact(rename_snake(rows), {"id": "market_id", "new": "is_new"})


@_query
def kebab_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    slug = F.concat(F.lit("order-"), F.col("o_orderkey"), F.lit("@"), kebab(F.col("o_orderpriority")))
    return rows.select(
        "o_orderkey", slug.alias("slug"), kebab(F.col("c_name")).alias("customer_slug")
    )


@_query
def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that is NULL when any part is."""
    part = F.when(F.col("l_returnflag") != "N", F.col("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat("l_orderkey", F.lit("-"), part).alias("outcome_id"),
    )


@_query
def nullify_long_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("image"))
    return nullify_long(docs, ["image"])


@_query
def over_long_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What nullify_long_url sets to NULL: the keys, columns and sizes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("image"), "source")
    return over_long(docs, "doc_id", ["image", "source"])


@_query
def column_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by which a table misses its contract, with the values that extra ones hold."""
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "tag_id")
    extra, missing = column_differences(customer.columns, TAGS)
    profile = quality.null_profile(customer.select(*extra)).select(
        F.lit("extra").alias("kind"), "column_name", F.col("non_null").alias("n_values")
    )
    absent = F.explode(F.array(*[F.lit(c) for c in missing])).alias("column_name")
    return profile.union(spark.range(1).select(F.lit("missing"), absent, F.lit(0).cast("bigint")))


@_query
def drop_add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named and extra columns dropped, an optional one added, contract order."""
    rows = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(
        rows, F.col("c_nationkey") == F.col("n_nationkey")
    )
    tags = customers.select(
        F.col("c_custkey").cast("string").alias("tag_id"),
        F.lower("c_name").alias("tag_slug"),
        F.col("r_name").alias("label"),
        F.col("c_acctbal").alias("unknown_field"),
        F.col("n_name").alias("clobRewards"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in TAGS.names
            if c not in ("tag_id", "tag_slug", "label", "is_carousel", "requires_translation")
        ],
        F.lit("false").alias("requires_translation"),
    )
    named = drop_listed(tags, ["clobRewards"])
    candidate = conform(named, TAGS, optional=["is_carousel"]).df
    return quality.coerce(candidate, TAGS).drop(quality.CAST_FAILED)


@_query
def cast_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed text to contract types: truncation, strict booleans, ids and years."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("id"),
        (F.col("l_extendedprice") * F.when(F.col("l_tax") > 0.04, -1).otherwise(1))
        .cast("string")
        .alias("amount"),
        F.when(F.col("l_returnflag") == "A", "true")
        .when(F.col("l_returnflag") == "N", "false")
        .otherwise("yes")
        .alias("flag"),
        F.when(F.col("l_linenumber") == 7, "x").otherwise(F.col("l_partkey").cast("string")).alias(
            "part"
        ),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        (F.col("l_tax") * -10).alias("tax"),
    )
    text = T.StringType()
    return rows.select(
        "id",
        to_type("amount", text, T.LongType()).alias("whole_amount"),
        to_type("tax", T.DoubleType(), T.LongType()).alias("whole_tax"),
        to_type("flag", text, T.BooleanType()).alias("flag"),
        to_type("part", text, T.DoubleType()).alias("part_number"),
        uint32(F.col("part")).alias("part_id"),
        year(F.col("shipped")).alias("ship_year"),
    )


# -- contract rules -----------------------------------------------------------


def _dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as dependency edges, with every kind of violation among them."""
    number = F.col("l_linenumber")
    kinds = F.array(*[F.lit(k) for k in RELATION_TYPES])
    return table(spark, sf_dir, "lineitem").select(
        F.concat("l_orderkey", F.lit("-"), number).alias("dependency_uuid"),
        F.col("l_partkey").cast("string").alias("outcome_id_a"),
        F.col("l_suppkey").cast("string").alias("outcome_id_b"),
        F.when(number == 7, "other").otherwise(F.get(kinds, number)).alias("relationship_type"),
        F.when(
            F.col("l_returnflag") != "N", F.repeat(F.lit("c"), F.col("l_quantity").cast("int") * 11)
        ).alias("comments"),
    )


def _checked_dependencies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return quality.split(_dependencies(spark, sf_dir), DEPENDENCIES)


@_query
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_counts(_checked_dependencies(spark, sf_dir)[1])


@_query
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = _checked_dependencies(spark, sf_dir)[1]
    return bad.select(
        *DEPENDENCIES.names, F.array_join(quality.FAILED_RULES, ",").alias("failed_rules")
    )


@_query
def good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_dependencies(spark, sf_dir)[0]


_LINES = Contract(
    name="lines",
    primary_key=("line_id",),
    columns=(
        Col("line_id", "string", nullable=False),
        Col("part", "bigint", nullable=False),
        Col("flag", "boolean"),
        Col("note", "string", min_length=1, max_length=9),
        Col("price", "double"),
    ),
)


def _dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as text with NULLs in required columns, empty text and values that don't cast."""
    number, key = F.col("l_linenumber"), F.concat("l_orderkey", F.lit("-"), F.col("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select(
        F.when(number != 6, key).alias("line_id"),
        F.when(number == 5, "x").when(number != 4, F.col("l_partkey").cast("string")).alias("part"),
        F.when(F.col("l_returnflag") == "A", "yes").otherwise("true").alias("flag"),
        F.when(number == 3, "").otherwise(F.repeat(F.lit("n"), number * 2)).alias("note"),
        F.when(number == 2, "1,5").otherwise(F.col("l_extendedprice").cast("string")).alias("price"),
    )


def _checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_rows(quality.coerce(_dirty_lines(spark, sf_dir), _LINES), _LINES)


@_query
def dirty_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per broken rule: required, castable, least and largest length, key."""
    return quality.rule_counts(quality.split(_checked_lines(spark, sf_dir), _LINES)[1])


@_query
def enforced_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the error of a failed run says: the broken rules with their rows."""
    bad = quality.split(_checked_lines(spark, sf_dir), _LINES)[1]
    try:
        quality.enforce(bad, _LINES)
    except quality.ContractViolation as e:
        return spark.createDataFrame(list(e.counts.items()), "rule string, n_rows bigint")
    return spark.createDataFrame([], "rule string, n_rows bigint")


@_query
def duplicate_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.duplicate_rows(docs, ["text"]).select("doc_id")


@_query
def marked_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with its duplicate flag; NULL keys form one group."""
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user"),
        F.when(F.col("event_type") != "error", F.date_trunc("hour", "ts")).alias("hour"),
    )
    return quality.mark_duplicates(rows, ["user", "hour"], "duplicate").select(
        "event_id", "duplicate"
    )


@_query
def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").drop("text")
    rows = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.null_profile(rows.withColumn("liquidity_amm", F.lit(None).cast("bigint")))


_TABLE_KEYS = (
    ForeignKey("labels", "doc_id", "documents", "doc_id"),
    ForeignKey("documents", "doc_id", "labels", "doc_id"),
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ForeignKey("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
    ForeignKey("customer", "c_custkey", "orders", "o_custkey"),
    ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
    ForeignKey("part", "p_partkey", "supplier", "s_suppkey"),
)


@_query
def fk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {n for fk in _TABLE_KEYS for n in (fk.child, fk.parent)}
    return quality.foreign_key_report({n: table(spark, sf_dir, n) for n in names}, _TABLE_KEYS)


# -- reconciliation -----------------------------------------------------------


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the earlier events table, flags as an export gives them (0/1)."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("event_id"),
        (status == "O").cast("int").alias("active"),
        (status == "F").cast("int").alias("closed"),
        (status == "P").cast("int").alias("archived"),
    )


def _landed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of orders landed with a returned line; an order may be landed often."""
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    return lines.select(F.col("l_orderkey").cast("string").alias("id"))


def _requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.plan_requery(_snapshot(spark, sf_dir), _landed_ids(spark, sf_dir))


def _returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter("o_totalprice > 100000")
    return orders.select(F.col("o_orderkey").alias("event_id"))


@_query
def open_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.open_rows(_snapshot(spark, sf_dir))


@_query
def requery_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requested(spark, sf_dir)


@_query
def requery_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id to re-query, and whether a run that asks for 500 takes it or defers it."""
    return reconcile.deferral(_requested(spark, sf_dir), 500)


@_query
def requery_without_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without landed pages every open row is asked for."""
    return reconcile.plan_requery(_snapshot(spark, sf_dir), None)


@_query
def unusable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open rows whose id is no unsigned 32-bit number."""
    wrong = F.when(F.col("event_id") % 5 == 0, F.lit("id-")).when(F.col("event_id") % 7 == 0, F.lit("99999"))
    snapshot = _snapshot(spark, sf_dir)
    return reconcile.unusable_ids(
        snapshot.withColumn("event_id", F.concat(F.coalesce(wrong, F.lit("")), "event_id"))
    )


@_query
def unanswered_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches whose page did not land: here, those with an even number did."""
    batches = reconcile.batches(_requested(spark, sf_dir)).select("batch_no", "page_name")
    return reconcile.unanswered(batches, batches.filter("batch_no % 2 = 0"))


@_query
def requery_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.batches(_requested(spark, sf_dir)).drop("event_ids")


@_query
def disappeared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.disappeared(_requested(spark, sf_dir), _returned(spark, sf_dir))


@_query
def archive_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot with the disappeared events archived; ids match by number."""
    gone = reconcile.disappeared(_requested(spark, sf_dir), _returned(spark, sf_dir))
    snapshot = _snapshot(spark, sf_dir).withColumn("archived", F.col("archived").cast("boolean"))
    return reconcile.apply_patch(snapshot, reconcile.archive_patch(gone))


@_query
def archive_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = reconcile.disappeared(_requested(spark, sf_dir), _returned(spark, sf_dir))
    return reconcile.archive_statements(gone)


@_query
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested against returned, with unexpected and repeated ids among the returned."""
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity > 40")
    returned = lines.select(F.col("l_orderkey").alias("event_id"))
    return reconcile.reconcile_counts(_requested(spark, sf_dir), returned)


@_query
def reconcile_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts per re-query batch (here: per customer of the order)."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("batch"), F.col("o_orderkey").alias("event_id"), "o_totalprice"
    )
    asked = orders.join(_requested(spark, sf_dir), "event_id", "left_semi")
    returned = orders.filter("o_totalprice > 100000")
    keys = ["batch", "event_id"]
    return reconcile.reconcile_counts(asked.select(*keys), returned.select(*keys), ["batch"])


# -- upsert -------------------------------------------------------------------


@_query
def upsert_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept, unchanged, changed and new rows, with their audit columns."""
    customer = table(spark, sf_dir, "customer")

    def stamp(text: str):
        return F.to_timestamp_ntz(F.lit(text))

    old = customer.filter("c_acctbal > 0").withColumns(
        {
            "db_created_at": stamp("2025-01-01 00:00:00"),
            "db_updated_at": stamp("2025-02-01 00:00:00"),
        }
    )
    changed = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("CONSTRUCTION"))
    new = customer.filter("c_acctbal < 5000").withColumn(
        "c_mktsegment", F.coalesce(changed, "c_mktsegment")
    )
    return sinks.upsert(old, new, ["c_custkey"], stamp("2025-03-01 00:00:00"))


@_query
def typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new table with the contract's types, filled by its first upsert."""
    first = sinks.create_table(spark, TAGS, scratch(spark, "typed_table"))
    new = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("tag_id"), F.lower("c_name").alias("tag_slug"), F.col("c_name").alias("label")
    )
    stamp = F.to_timestamp(F.lit("2025-03-01 00:00:00"))
    return sinks.upsert(first, new, ["tag_id"], stamp, TAGS).select(
        *TAGS.names, *[F.col(c).cast("timestamp_ntz").alias(c) for c in sinks.AUDIT_COLUMNS]
    )


def _versions(spark: SparkSession, name: str) -> Warehouse:
    """A new versioned warehouse of one call."""
    return Warehouse(spark, f"{scratch(spark, name)}/{uuid.uuid4().hex}")


@_query
def versioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``upsert_audit`` through a warehouse that rewrites changed buckets only."""
    customer = table(spark, sf_dir, "customer")
    warehouse = _versions(spark, "versioned_upsert")
    change = warehouse.begin()
    change.upsert("customer", customer.filter("c_acctbal > 0"), ["c_custkey"], F.to_timestamp_ntz(F.lit("2025-01-01 00:00:00")), n_buckets=32)
    change.commit()
    changed = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("CONSTRUCTION"))
    new = customer.filter("c_acctbal < 5000").withColumn("c_mktsegment", F.coalesce(changed, "c_mktsegment"))
    change = warehouse.begin()
    change.upsert("customer", new, ["c_custkey"], F.to_timestamp_ntz(F.lit("2025-03-01 00:00:00")))
    change.commit()
    return warehouse.read("customer")


@_query
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserted, updated and deleted orders between two snapshots, from the buckets that differ."""
    orders = table(spark, sf_dir, "orders")
    warehouse = _versions(spark, "change_feed")
    later = orders.withColumn("o_orderstatus", F.when((F.col("o_orderstatus") == "O") & (F.col("o_custkey") % 5 == 0), "F").otherwise(F.col("o_orderstatus")))
    for snapshot in (orders.filter("o_orderkey % 11 <> 0"), later.filter("o_orderkey % 7 <> 0")):
        change = warehouse.begin()
        change.replace("orders", snapshot, ["o_orderkey"], n_buckets=32)
        change.commit()
    fed, _ = warehouse.changes("orders", warehouse.version(1), warehouse.version(2))
    return fed.withColumnRenamed("_change", "change")


def _stored_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sinks.write_parquet(raw.raw_events(order_pages(spark, sf_dir)), f"{scratch(spark, name)}/raw")


@_query
def raw_field_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that a table's contract did not have, filled from the events stored whole."""
    stored = _stored_raw(spark, sf_dir, "raw_field_backfill")
    old = raw.fields_of(stored, T.StructType.fromDDL("id string, slug string"))
    table_before = keep_last(old, ["id"], landing.ORDINAL).select("id", "slug")
    return raw.backfill(table_before, stored, "id", "id", {"start_date": ("startDate", "date"), "closed": ("closed", "boolean")})


@_query
def raw_unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the stored events that a contract does not name, with the events that have them."""
    return raw.unknown_fields(_stored_raw(spark, sf_dir, "raw_unknown_fields"), ["id", "slug"])


@_query
def bloom_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of customers' orders that are not large, by an anti join behind a Bloom filter."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 200000").select("o_orderkey")
    return bloom.member_join(lines, large, ("l_orderkey", "o_orderkey"), "left_anti")


@_query
def bloom_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of orders that are large, by a semi join behind a Bloom filter."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 200000").select("o_orderkey")
    return bloom.member_join(lines, large, ("l_orderkey", "o_orderkey"), "left_semi")


@_query
def streamed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last copies of the series after pages landed in three lots, taken as a stream."""
    root = f"{scratch(spark, 'streamed_series')}/{uuid.uuid4().hex}"
    warehouse, wanted = Warehouse(spark, f"{root}/warehouse"), SERIES.name
    fields = [f for f in landed_fields(SERIES) if f.name != "description"]
    schema = T.StructType([*EVENT_KEYS, T.StructField("series", array_of(fields))])
    states = [s for s in stream.STATES if s.name == wanted]
    placed = sinks.write_parquet(event_pages(spark, sf_dir, ["series"]), f"{root}/pages")
    page = F.regexp_extract("file_name", r"_(\d+)\.json$", 1).cast("int")
    for lot in (1, 0, 2):  # the last copies come first, in the middle or at the end
        placed.filter(page % 3 == lot).write.mode("append").parquet(f"{root}/landing")
        landed = stream.page_stream(spark, f"{root}/landing", packed=True)
        stream.ingest(landed, warehouse, f"{root}/checkpoint", schema, states=states, n_buckets=4)
    return stream.tables(warehouse, states)[wanted].select("series_id", "title", F.col("comment_count").cast("bigint").alias("comment_count"))


# -- the whole run --------------------------------------------------------------


def _landed_schema() -> T.StructType:
    nested = {"markets": MARKETS, "series": SERIES, "tags": TAGS}
    carried = {"markets": ("event_id", "event_slug")}
    fields = [f for f in landed_fields(EVENTS) if f.name not in nested]
    arrays = [T.StructField(n, array_of(landed_fields(c, carried.get(n, ())))) for n, c in nested.items()]
    return T.StructType([*fields, *arrays])


@_query
def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published and rejected rows of every table after a whole run over all documents."""
    root = scratch(spark, "run_counts")
    landing.pack_pages(event_pages(spark, sf_dir), f"{root}/landing/list")
    pinned = Landing(f"{root}/landing", packed=True, schema=_landed_schema())
    result = run_pipeline(spark, pinned, f"{root}/out", "run", on_failure="quarantine", csv=False)
    counts = [
        (name, result.tables[name].n_rows, spark.read.parquet(f"{root}/out/quarantine/{name}").count())
        for name in CONTRACTS if name in result.tables
    ]
    return spark.createDataFrame(counts, "table_name string, n_published bigint, n_rejected bigint")


@_query
def second_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a run on top of an earlier one inserts and updates in every table.

    The warehouse holds two thirds of the orders as events; pages of every other range of
    order keys land.  Open events that did not land are asked for in batches: most answers
    say that they are closed, and one in five has disappeared and gets archived.
    """
    root = f"{scratch(spark, 'second_run_counts')}/{uuid.uuid4().hex}"
    warehouse = Warehouse(spark, f"{root}/warehouse")
    known = table(spark, sf_dir, "orders").filter("o_orderkey % 3 <> 0").selectExpr(
        "cast(o_orderkey AS string) AS event_id", "'order-' || o_orderkey AS event_slug", "o_orderstatus = 'O' AS active",
        "o_orderstatus = 'F' AS closed", "o_orderstatus = 'P' AS archived",
    )
    change = warehouse.begin()
    change.upsert(EVENTS.name, known, EVENTS.primary_key, F.to_timestamp(F.lit("2025-01-01 00:00:00")), EVENTS, n_buckets=8)
    change.commit()
    pages = event_pages(spark, sf_dir)
    every_other = F.regexp_extract("file_name", r"_(\d+)\.json$", 1).cast("int") % 2 == 0
    landing.pack_pages(pages.filter(every_other), f"{root}/landing/list")
    pinned = Landing(f"{root}/landing", packed=True, schema=_landed_schema())
    run = dict(warehouse=warehouse.root, on_failure="quarantine")
    batches = plan_run(spark, pinned, f"{root}/out", "second", **run)
    answer = """'[' || array_join(transform(filter(event_ids, i -> i % 5 <> 0),
      i -> to_json(named_struct('id', cast(i AS string), 'slug', 'order-' || i, 'ticker', 'ORDER' || i, 'title',
        'Refreshed order ' || i, 'active', false, 'closed', true, 'archived', false))), ',') || ']' AS value"""
    landing.pack_pages(batches.selectExpr("page_name AS file_name", answer), f"{root}/landing/by_id")
    result = run_pipeline(spark, pinned, f"{root}/out", "second", csv=False, **run)
    counts = [(name, w.inserted, w.updated) for name, w in result.written.items() if name in result.tables]
    return spark.createDataFrame(counts, "table_name string, n_inserted bigint, n_updated bigint")


# -- ranks and dependencies -------------------------------------------------------


@_query
def text_key_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 20 ascending text keys; every key occurs once for each of its lines."""
    lines = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_returnflag", "l_orderkey").alias("key"))
    found = key_batches(lines, "key", 20, n_ranges=16)
    return found.select("batch_no", F.size("keys").cast("bigint").alias("n_keys"), F.col("keys")[0].alias("first_key"), F.array_max("keys").alias("last_key"))


_LINKED_PARTS = [("place < 7", "implies"), ("place = 7", "mutex"), ("place = 9", "complement"), ("place = 11", "equivalent"), ("place = 12", "implies"), ("place = 14", "implies")]


def _part_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part and the next one, related by its place in a group of sixteen."""
    kind = "CASE " + " ".join(f"WHEN {place} THEN '{kind}'" for place, kind in _LINKED_PARTS) + " END"
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS a", "p_partkey + 1 AS b", "p_partkey % 16 AS place")
    steps = parts.selectExpr("a", "b", f"{kind} AS relationship_type").filter("relationship_type IS NOT NULL")
    back = parts.filter("place = 13").selectExpr("a", "a - 2", "'implies'")  # closes a cycle
    against = parts.filter("place = 14").selectExpr("a", "b", "'mutex'")  # a part that can't be true
    pairs = steps.union(back).union(against)
    return pairs.selectExpr("cast(a AS string) AS outcome_id_a", "cast(b AS string) AS outcome_id_b", "relationship_type")


@_query
def dependency_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every relation that the dependencies of the parts imply."""
    reach = dependencies.closure(dependencies.implications(_part_dependencies(spark, sf_dir)))
    return dependencies.derived_relations(reach)


@_query
def dependency_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes that can't be true or false, and the cycles of equivalent ones."""
    reach = dependencies.closure(dependencies.implications(_part_dependencies(spark, sf_dir)))
    cycles = dependencies.equivalence_cycles(reach).selectExpr("outcome_id", "'cycle of ' || cycle AS conflict")
    return dependencies.contradictions(reach).unionByName(cycles)
