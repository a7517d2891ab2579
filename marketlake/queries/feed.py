"""Event documents derived from the star-schema tables.

Every order line gives one landed copy of its order's event: JSON text with the line as
a market, the customer's segment as a series, and the part's type and brand as tags.  An
event is thus landed several times, and markets repeat, as in real feeds.  Nothing is
grouped, so an order with very many lines is no hot spot.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.contracts import Contract

# Years in the tables end in 2001, so this takes the part of the real cut-off year.
LAST_YEAR = 1999
ORDER = ["ord"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def camel(name: str) -> str:
    """Landed spelling of a contract column: ``volume_24_hr`` -> ``volume24Hr``."""
    head, *rest = name.split("_")
    return head + "".join(w.capitalize() for w in rest)


def landed_fields(contract: Contract, carried: tuple[str, ...] = ()) -> list[T.StructField]:
    """The contract's columns as landed: own spelling, all text."""
    own_id, own_slug = contract.primary_key[0], contract.primary_key[0].replace("_id", "_slug")
    special = {own_id: "id", own_slug: "slug", "is_new": "new"}
    names = [special.get(c, camel(c)) for c in contract.names if c not in carried]
    return [T.StructField(n, T.StringType()) for n in names]


def array_of(fields: list[T.StructField]) -> T.ArrayType:
    return T.ArrayType(T.StructType(fields))


def lines(spark: SparkSession, sf_dir: str, empty: bool = False) -> DataFrame:
    """Order lines with their order, customer and part; with ``empty`` also orders without lines.

    Lines and orders are joined with an inner merge join, where a hot order is split on
    the line side (an outer join from the orders could not split it).  Orders without
    lines are found among the distinct order keys, at the price of a second scan.
    """
    items = table(spark, sf_dir, "lineitem")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    orders = table(spark, sf_dir, "orders")
    same, of_part = F.col("o_orderkey") == F.col("l_orderkey"), F.col("l_partkey") == F.col("p_partkey")
    of_customer = F.col("o_custkey") == F.col("c_custkey")
    if empty:  # above a union, the JSON text would be planned once for each side
        matched = items.hint("merge").join(orders, same)
        bare = orders.join(items.select("l_orderkey").distinct(), same, "left_anti")
        matched = matched.unionByName(bare, allowMissingColumns=True)
        return matched.join(customer, of_customer, "left").join(part, of_part, "left")
    # Customers meet the orders and parts the bare lines: whole lines move once.
    return items.join(part, of_part, "left").hint("merge").join(orders.join(customer, of_customer, "left"), same)


# The documents are SQL text: as Column calls they would take seconds to put together.

_STATUS = """
  'active', o_orderstatus = 'O', 'closed', o_orderstatus = 'F', 'archived', o_orderstatus = 'P'"""

# Values that both copies of a market share, computed once per line.  Lines of a large
# quantity share the tokens of their part.
_LINE_VALUES = {
    "_key": "concat(l_orderkey, '-', l_linenumber)",
    "_start": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "_names": """concat('["', concat_ws('","', l_returnflag, l_linestatus,
        CASE WHEN l_suppkey % 7 = 0 THEN 'X' END), '"]')""",
    "_prices": """concat('["', l_discount, '","', l_tax, '"]')""",
    "_stem": """CASE WHEN l_quantity > 40 THEN CAST(l_partkey AS STRING)
        ELSE concat(l_orderkey, '-', l_linenumber) END""",
    "_image": f"""CASE WHEN l_quantity >= 45 THEN '{"é" * 251}'
        ELSE 'https://img.example.com/x.png' END""",
}


def _market(question: str, condition: str) -> str:
    return f"""named_struct(
  'id', _key,
  'slug', concat('order-', l_orderkey, '-line-', l_linenumber),
  'new', l_linenumber = 1,
  'question', {question},
  'conditionId', {condition},
  'startDate', _start,
  'outcomes', _names,
  'outcomePrices', _prices,
  'clobTokenIds', CASE WHEN l_suppkey % 11 = 0 THEN '[]'
    ELSE concat('["', _stem, 'a","', _stem, 'b"]') END,
  {_STATUS},
  'image', _image,
  'icon', 'https://img.example.com/i.png',
  'volume24Hr', l_extendedprice,
  'spread', l_discount,
  'oneDayPriceChange', -l_tax,
  'orderMinSize', l_quantity,
  'clobRewards', array(named_struct('id', l_suppkey)),
  'unknownField', 'x')"""


def _tag(column: str) -> str:
    return f"""named_struct('id', {column}, 'slug', lower({column}),
  'label', concat({column}, ' of order ', o_orderkey), 'requiresTranslation', false)"""


_CURRENT = _market(
    "concat('Shipped on ', date_format(l_shipdate, 'yyyy-MM-dd'), '?')",
    "CASE WHEN l_quantity <= 2 THEN '' ELSE concat('0x', lpad(l_partkey, 64, '0')) END",
)
_STALE = _market("'stale'", "''")

_ARRAYS = {
    # A returned line lands an older copy of its market in front of the current one.
    "markets": f"""CASE WHEN l_orderkey IS NOT NULL THEN
  CASE WHEN l_returnflag = 'R' THEN array({_STALE}, {_CURRENT}) ELSE array({_CURRENT}) END END""",
    "series": """array(named_struct('id', c_mktsegment, 'slug', lower(c_mktsegment),
  'ticker', c_mktsegment, 'title', concat('Segment of order ', o_orderkey), 'active', true,
  'closed', false, 'archived', false, 'volume24Hr', o_totalprice, 'commentCount', o_orderkey,
  'requiresTranslation', false))""",
    "tags": f"""CASE WHEN l_orderkey IS NOT NULL THEN
  CASE WHEN l_suppkey % 13 = 0 THEN slice(array({_tag("p_type")}), 1, 0)
  ELSE array({_tag("p_type")}, {_tag("p_brand")}) END END""",
}

_PLACE = """struct(o_orderkey, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, l_linenumber) AS ord"""


def documents(
    spark: SparkSession,
    sf_dir: str,
    arrays: Collection[str] = ("markets", "series", "tags"),
    empty: bool = False,
) -> DataFrame:
    """(value, ord): one JSON text per order line and its place in the landing.

    ``arrays`` names the nested arrays to land; ``empty`` adds the orders without lines.
    """
    return _as_documents(lines(spark, sf_dir, empty), arrays)


def _as_documents(rows: DataFrame, arrays: Collection[str], *carry: str) -> DataFrame:
    nested = "".join(f"'{a}', {_ARRAYS[a]}, " for a in arrays)
    event = f"""to_json(named_struct(
  'id', CAST(o_orderkey AS STRING),
  'slug', concat('order-', o_orderkey),
  'ticker', concat('ORDER', o_orderkey),
  'title', concat('Order of customer ', o_custkey),
  'startDate', _start,
  {_STATUS},
  'liquidity', o_totalprice,
  'openInterest', o_totalprice,
  'commentCount', o_custkey,
  'image', 'https://img.example.com/e.png',
  {nested}
  'eventMetadata', named_struct('note', 'dropped'))) AS value"""
    values = [f"{text} AS {name}" for name, text in _LINE_VALUES.items()]
    return rows.selectExpr("*", *values).selectExpr(event, _PLACE, *carry)


def events(
    spark: SparkSession, sf_dir: str, fields: list[T.StructField], empty: bool = False
) -> DataFrame:
    """The documents parsed against ``fields``, each once, with their place ``ord``."""
    names = [f.name for f in fields]
    docs = documents(spark, sf_dir, [a for a in ("markets", "series", "tags") if a in names], empty)
    # With two references to the text its projection stays its own; inside from_json it would be interpreted.
    event = F.when(F.col("value").isNotNull(), F.from_json("value", T.StructType(fields)))
    parsed = docs.select("ord", event.alias("_event"))
    return parsed.select("ord", "_event.*")


def field(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


EVENT_KEYS = [field("id"), field("slug")]


def event_pages(
    spark: SparkSession, sf_dir: str, arrays: Collection[str] = ("markets", "series", "tags")
) -> DataFrame:
    """(file_name, value): all documents as list pages, by ranges of 20 order keys.

    A page is a group of the lines of at most 20 orders.  The lines meet in their page before
    their JSON text, many times as long, is made.
    """
    feed = """CASE o_orderstatus WHEN 'O' THEN 'active' ELSE 'inactive' END || '_' ||
      CASE o_orderstatus WHEN 'F' THEN 'closed' ELSE 'open' END"""
    rows = lines(spark, sf_dir, empty=True).selectExpr("*", f"{feed} AS feed", "o_orderkey DIV 20 AS page")
    # A fixed number of partitions: run-time coalescing would go by the size of the short rows.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = _as_documents(rows.repartition(parts, "feed", "page"), arrays, "feed", "page")
    # sort_array, because array_sort makes its comparator anew for every two documents it compares
    grouped = placed.groupBy("feed", "page").agg(F.sort_array(F.collect_list(F.struct("ord", "value"))).alias("docs"))
    return grouped.selectExpr(
        "concat('events_', feed, '_page_', page, '.json') AS file_name",
        "concat('[', array_join(docs.value, ','), ']') AS value",
    )


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages of orders: one feed per status, pages by ranges of 200 order keys.

    Order keys are unique, so a page is a group of at most 200 rows.
    """
    orders = table(spark, sf_dir, "orders")
    placed = orders.selectExpr(
        "0 AS _source_rank",
        "CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS _feed_rank",
        "o_orderkey DIV 200 AS _page_no",
        """named_struct('id', o_orderkey, 'slug', concat('order-', o_orderkey),
          'active', o_orderstatus = 'O', 'closed', o_orderstatus = 'F',
          'startDate', date_format(o_orderdate, 'yyyy-MM-dd')) AS event""",
    )
    return placed.groupBy("_source_rank", "_feed_rank", "_page_no").agg(
        F.to_json(F.sort_array(F.collect_list("event"))).alias("value")
    )
