"""What the physical plans must look like at scale."""

import re

import pytest
from pyspark.sql import types as T

import pages
from marketlake.contracts import MARKETS
from marketlake.operators.quality import check_rows, coerce
from marketlake.plans.bronze import NEVER_READ, build_markets, build_tags
from marketlake.queries.registry import registered
from marketlake.session import engine_settings
from marketlake.sources import landing


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def parsed(spark, tmp_path_factory):
    """Parsed landing, stored as a run does."""
    root = tmp_path_factory.mktemp("plans")
    pages.list_page(
        str(root), True, False, 0, [pages.event(1, [pages.market(1)], [pages.series(1)], [pages.tag(1)])]
    )
    schema = landing.infer_schema(spark, f"{root}/list")
    rows = landing.page_rows(landing.list_pages(landing.page_files(spark, f"{root}/list")), schema)
    rows.write.parquet(f"{root}/parsed")
    return landing.event_rows(spark.read.parquet(f"{root}/parsed"))


LAZY = [
    "outcomes_flagship",
    "explode_markets",
    "json_lists",
    "two_feed_keep_last",
    "kebab_slug",
    "rule_violations",
    "marked_duplicates",
    "fk_report",
    "requery_batches",
    "reconcile_counts",
    "upsert_audit",
    "landed_pages",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(registered()[name](spark, sf_dir))
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoop|Arrow", plan)


def test_keep_last_limits_groups_before_the_shuffle(spark, sf_dir):
    plan = plan_of(registered()["markets_keep_last"](spark, sf_dir))
    assert re.search(r"WindowGroupLimit.*Final(.|\n)*Exchange(.|\n)*WindowGroupLimit.*Partial", plan)


def test_landed_json_is_parsed_once(spark, sf_dir):
    plan = plan_of(registered()["explode_markets"](spark, sf_dir))
    assert len(re.findall(r"from_json", plan)) == 1
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1
    plan = plan_of(registered()["explode_markets_outer"](spark, sf_dir))
    assert len(re.findall(r"from_json", plan)) == 1
    plan = plan_of(registered()["outcomes_flagship"](spark, sf_dir))
    assert len(re.findall(r"from_json\(ArrayType", plan)) == 3


def test_builders_read_only_their_nested_columns(parsed):
    markets = _read_schema(build_markets(parsed))
    assert "conditionId" in markets
    links = _read_schema(build_tags(parsed)[1])
    assert '"name":"tags"' in links
    for name in ("forceShow", "eventCreators", "seriesType"):
        assert name not in markets and name not in links
    assert "conditionId" not in links and "label" not in links


def test_fields_nobody_reads_are_not_parsed(parsed):
    schema = landing.without_fields(parsed.schema, NEVER_READ)
    assert "clobRewards" in parsed.schema.json() and "eventMetadata" in parsed.schema.json()
    assert not any(n in schema.json() for n in NEVER_READ)
    assert schema["markets"].dataType.elementType["conditionId"].dataType == T.StringType()


def _read_schema(df):
    """Full read schema of the scan (plan texts shorten it)."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    return leaves.apply(0).requiredSchema().json()


def test_wide_markets_keep_codegen_and_batched_scans(spark, tmp_path):
    empty = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in MARKETS.names]))
    empty.write.parquet(str(tmp_path / "t"))
    with engine_settings(spark):
        wide = spark.read.parquet(str(tmp_path / "t")).filter("active = 'true'")
        assert "ColumnarToRow" in plan_of(wide)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        checked = check_rows(coerce(spark.read.parquet(str(tmp_path / "t")), MARKETS), MARKETS)
        checked.createOrReplaceTempView("checked_markets")
        text = spark.sql("EXPLAIN CODEGEN SELECT * FROM checked_markets").first()[0]
        size = int(re.search(r"maxMethodCodeSize:(\d+)", text).group(1))
    # Methods above 8000 bytes are not compiled by the JVM.
    assert 0 < size < 8000
    assert checked.columns[-1] == "_row_failed"


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(registered()["two_feed_keep_last"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)]" in plan
    plan = plan_of(registered()["pk_violations"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_duplicate_texts_move_hashes_first(spark, sf_dir):
    """Texts are grouped only where one hash stands for several: below a join on the hash."""
    plan = plan_of(registered()["duplicate_text_rows"](spark, sf_dir))
    by_text = [m.start() for m in re.finditer(r"Exchange hashpartitioning\(text", plan)]
    by_hash = [m.start() for m in re.finditer(r"Exchange hashpartitioning\(_hash", plan)]
    assert by_hash and all(any(h > t for h in by_hash) for t in by_text)


def test_nothing_is_broadcast_by_hint(spark, sf_dir):
    df = registered()["drop_add_columns"](spark, sf_dir)
    assert "strategy=broadcast" not in df._jdf.queryExecution().logical().toString()
