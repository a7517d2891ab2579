"""The same results in SQL over the flat tables.

The registered queries work on nested JSON; these statements never build it, so the two
sides share no logic.
"""

from __future__ import annotations

from marketlake.contracts import EVENTS, MARKETS, RELATION_TYPES, SERIES, TAGS, Contract

# Order lines as landed, and the last copy of each (order, line number).
_LINES = """
lines as (
  select *, l_orderkey || '-' || l_linenumber as mid,
    row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc,
      l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc,
      l_tax desc, l_returnflag desc, l_linestatus desc) as rn
  from lineitem join orders on o_orderkey = l_orderkey),
last as (select * from lines where rn = 1)"""

_CONDITION = "case when l_quantity <= 2 then '' else '0x' || lpad(l_partkey::varchar, 64, '0') end"
_QUESTION = "'Shipped on ' || strftime(l_shipdate, '%Y-%m-%d') || '?'"
_STEM = "case when l_quantity > 40 then l_partkey::varchar else mid end"
_RECENT_OR_BINARY = "(l_suppkey % 7 <> 0 or year(o_orderdate) > 1999)"

# All landed copies: a returned line lands a stale copy in front of the current one.
_COPIES = f"""
copies as (
  select l_orderkey, l_linenumber, mid, {_QUESTION} as question, {_CONDITION} as condition_id
  from lines
  union all
  select l_orderkey, l_linenumber, mid, 'stale', '' from lines where l_returnflag = 'R')"""

_OUTCOMES = f"""
kept as (select * from last where l_quantity > 2 and {_RECENT_OR_BINARY} and l_suppkey % 11 <> 0),
outcomes as (
  select mid || '-' || i as outcome_id,
    'order-' || l_orderkey || '-line-' || l_linenumber || '@'
      || lower(case i when 0 then l_returnflag else l_linestatus end) as outcome_slug,
    i::smallint as outcome_index, mid as market_id,
    'order-' || l_orderkey || '-line-' || l_linenumber as market_slug,
    {_QUESTION} as question,
    case i when 0 then l_returnflag else l_linestatus end as outcome_name,
    case i when 0 then l_discount else l_tax end as outcome_price,
    {_STEM} || case i when 0 then 'a' else 'b' end as clob_token_id
  from kept cross join (values (0), (1)) v(i))"""

_SQL_TYPES = {
    "string": "varchar",
    "boolean": "boolean",
    "double": "double",
    "bigint": "bigint",
    "int": "integer",
    "smallint": "smallint",
}


def _all_columns(contract: Contract, filled: dict[str, str]) -> str:
    """Every column of a contract: the given expression, or a typed NULL."""
    return ", ".join(
        f"({filled.get(c.name, 'null')})::{_SQL_TYPES[c.kind]} as {c.name}"
        for c in contract.columns
    )


_STATUS = {
    "active": "o_orderstatus = 'O'",
    "closed": "o_orderstatus = 'F'",
    "archived": "o_orderstatus = 'P'",
}

_JSON_NAMES = """'["' || l_returnflag || '","' || l_linestatus || '"'
  || case when l_suppkey % 7 = 0 then ',"X"' else '' end || ']'"""

_MARKET_COLUMNS = {
    "market_id": "mid",
    "market_slug": "'order-' || l_orderkey || '-line-' || l_linenumber",
    "event_id": "l_orderkey",
    "event_slug": "'order-' || l_orderkey",
    "question": _QUESTION,
    "condition_id": _CONDITION,
    "start_date": "strftime(o_orderdate, '%Y-%m-%d')",
    "image": "case when l_quantity < 45 then 'https://img.example.com/x.png' end",
    "icon": "'https://img.example.com/i.png'",
    "outcomes": _JSON_NAMES,
    "outcome_prices": """'["' || l_discount::varchar || '","' || l_tax::varchar || '"]'""",
    "clob_token_ids": f"""'["' || {_STEM} || 'a","' || {_STEM} || 'b"]'""",
    "is_new": "l_linenumber = 1",
    "order_min_size": "trunc(l_quantity)",
    "spread": "l_discount",
    "volume_24_hr": "trunc(l_extendedprice)",
    "one_day_price_change": "trunc(-l_tax)",
    **_STATUS,
}

_EVENT_COLUMNS = {
    "event_id": "o_orderkey",
    "event_slug": "'order-' || o_orderkey",
    "ticker": "'ORDER' || o_orderkey",
    "title": "'Order of customer ' || o_custkey",
    "start_date": "strftime(o_orderdate, '%Y-%m-%d')",
    "image": "'https://img.example.com/e.png'",
    "liquidity": "o_totalprice",
    "open_interest": "trunc(o_totalprice)",
    "comment_count": "o_custkey",
    **_STATUS,
}

_SERIES_COLUMNS = {
    "series_id": "c_mktsegment",
    "series_slug": "lower(c_mktsegment)",
    "ticker": "c_mktsegment",
    "title": "'Segment of order ' || o_orderkey",
    "active": "true",
    "closed": "false",
    "archived": "false",
    "volume_24_hr": "trunc(o_totalprice)",
    "comment_count": "o_orderkey",
    "requires_translation": "false",
}

_TAG_ROWS = """
tags as (
  select l_orderkey, t.tag from lineitem join orders on o_orderkey = l_orderkey
  join part on p_partkey = l_partkey, unnest([p_type, p_brand]) as t(tag)
  where l_suppkey % 13 <> 0)"""

_DEPENDENCIES = f"""
deps as (
  select l_orderkey || '-' || l_linenumber as dependency_uuid, l_partkey::varchar as outcome_id_a,
    l_suppkey::varchar as outcome_id_b,
    case when l_linenumber = 7 then 'other'
      else {list(RELATION_TYPES)}[l_linenumber + 1] end as relationship_type,
    case when l_returnflag <> 'N' then repeat('c', (l_quantity * 11)::int) end as comments
  from lineitem),
flagged as (
  select *, relationship_type = 'other' as bad_kind, coalesce(length(comments) > 500, false) as bad_comment,
    outcome_id_a = outcome_id_b as bad_pair,
    count(*) over (partition by dependency_uuid) > 1 as bad_key,
    count(*) over (partition by outcome_id_a, outcome_id_b) > 1 as bad_group
  from deps)"""

_REQUESTED = """
requested as (
  select o_orderkey as event_id from orders where o_orderstatus = 'O'
  and not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')),
returned as (select o_orderkey as event_id from orders where o_totalprice > 100000),
gone as (select event_id from requested except select event_id from returned)"""

_PAGES = """
placed as (
  select *, (case o_orderstatus when 'O' then 1 when 'F' then 2 else 3 end)::integer as feed_rank,
    o_orderkey // 200 as page_no,
    row_number() over (partition by o_orderstatus, o_orderkey // 200 order by o_orderkey) - 1 as pos
  from orders)"""


_DIRTY_LINES = """
with rows as (
  select l_linenumber as n, l_returnflag as f, l_orderkey,
    case when l_linenumber <> 6 then l_orderkey || '-' || l_linenumber end as line_id from lineitem),
keyed as (select *, count(*) over (partition by line_id) > 1 as twice from rows),
counts as (
  select 'line_id|nullability' as rule, count(*) filter (n = 6) as n_rows from keyed union all
  select 'part|castable', count(*) filter (n = 5) from keyed union all
  select 'part|nullability', count(*) filter (n in (4, 5)) from keyed union all
  select 'flag|castable', count(*) filter (f = 'A') from keyed union all
  select 'note|min_length', count(*) filter (n = 3) from keyed union all
  select 'note|max_length', count(*) filter (n >= 5) from keyed union all
  select 'price|castable', count(*) filter (n = 2) from keyed union all
  select 'primary_key', count(*) filter (twice) from keyed)
select * from counts where n_rows > 0"""


def _fk(child: str, column: str, parent: str, parent_column: str) -> str:
    name = f"{child}.{column}->{parent}.{parent_column}"
    return f"""select '{name}' as foreign_key, {column}::varchar as missing_key, count(*) as n_rows
  from {child} c where {column} is not null
  and not exists (select 1 from {parent} p where p.{parent_column} = c.{column}) group by 2"""


def _profile(column: str, expression: str) -> str:
    return f"""select '{column}' as column_name, count({expression}) as non_null, count(*) as n_rows,
  count({expression}) = 0 as all_null from labelled"""


_IMPLIED = """recursive numbered as (
  select p_partkey as a, p_partkey + 1 as b, p_partkey % 16 as place from part),
related as (
  select a, b, case when place < 7 or place in (12, 14) then 'implies' when place = 7 then 'mutex'
    when place = 9 then 'complement' when place = 11 then 'equivalent' end as kind from numbered
  union all select a, a - 2, 'implies' from numbered where place = 13
  union all select a, b, 'mutex' from numbered where place = 14),
steps as (
  select a as x, true as xt, b as y, true as yt from related where kind in ('implies', 'equivalent')
  union select b, false, a, false from related where kind in ('implies', 'equivalent')
  union select b, true, a, true from related where kind = 'equivalent'
  union select a, false, b, false from related where kind = 'equivalent'
  union select a, true, b, false from related where kind in ('mutex', 'complement')
  union select b, true, a, false from related where kind in ('mutex', 'complement')
  union select a, false, b, true from related where kind = 'complement'
  union select b, false, a, true from related where kind = 'complement'),
reach as (
  select * from steps union select r.x, r.xt, s.y, s.yt from reach r join steps s on r.y = s.x and r.yt = s.xt)"""

ORACLES: dict[str, str] = {
    "outcomes_flagship": f"with {_LINES}, {_OUTCOMES} select * from outcomes",
    "explode_markets": f"""with {_LINES}, {_COPIES}
select l_orderkey::varchar as event_id, 'order-' || l_orderkey as event_slug, mid as market_id,
  question, condition_id from copies""",
    "explode_markets_outer": f"""with {_LINES}, {_COPIES}
select o_orderkey::varchar as event_id, 'order-' || o_orderkey as event_slug, mid as market_id,
  question from orders left join copies on o_orderkey = l_orderkey""",
    "markets_keep_last": f"""with {_LINES}
select l_orderkey::varchar as event_id, mid as market_id,
  'order-' || l_orderkey || '-line-' || l_linenumber as market_slug, {_QUESTION} as question,
  {_CONDITION} as condition_id from last""",
    "filter_nonempty_condition": f"""with {_LINES}
select mid as market_id, {_QUESTION} as question, {_CONDITION} as condition_id
from lines where l_quantity > 2""",
    "filter_binary_or_recent": """
with base as (
  select l_orderkey, l_linenumber, l_suppkey,
    case when l_returnflag <> 'A' then
      case when l_suppkey % 7 = 0 then '["a","b","c"]' else '["a","b"]' end end as outcomes,
    case when l_linenumber = 1 then 'n/a'
      when l_linenumber > 2 then strftime(o_orderdate, '%Y-%m-%d') end as start_date,
    case when l_returnflag <> 'A' then l_suppkey % 7 <> 0 end as two,
    case when l_linenumber > 2 then year(o_orderdate) > 1999 end as recent
  from lineitem join orders on o_orderkey = l_orderkey)
select l_orderkey, l_linenumber, l_suppkey, outcomes, start_date from base where two or recent""",
    "json_lists": f"""with {_LINES}
select mid as market_id, case when l_suppkey % 7 = 0 then 3 else 2 end::bigint as n_outcomes,
  case when l_suppkey % 11 = 0 then 0 else 2 end::bigint as n_tokens,
  l_linestatus as second_name, l_discount as first_price, l_tax as second_price,
  null::double as third_price,
  case when l_suppkey % 11 <> 0 then {_STEM} || 'a' end as first_token from last""",
    "long_lists": f"""with {_LINES}
select count(*) filter (l_suppkey % 7 = 0) as n_long from last""",
    "bronze_markets": f"""with {_LINES}
select {_all_columns(MARKETS, _MARKET_COLUMNS)} from last
where l_quantity > 2 and {_RECENT_OR_BINARY} and l_suppkey % 11 <> 0""",
    "bronze_markets_quarantine": f"""with {_LINES}
select mid as market_id, 'clob_token_ids_format' as rules from last
where l_quantity > 2 and {_RECENT_OR_BINARY} and l_suppkey % 11 = 0""",
    "bronze_events": f"select {_all_columns(EVENTS, _EVENT_COLUMNS)} from orders",
    "bronze_series": f"""
select {_all_columns(SERIES, _SERIES_COLUMNS)}
from orders join customer on c_custkey = o_custkey
qualify row_number() over (partition by c_mktsegment order by o_orderkey desc) = 1""",
    "event_series_link": """
select c_mktsegment as series_id, o_orderkey::varchar as event_id,
  lower(c_mktsegment) as series_slug, 'order-' || o_orderkey as event_slug
from orders join customer on c_custkey = o_custkey""",
    "bronze_tags": f"""with {_TAG_ROWS}, latest as (
  select tag, max(l_orderkey) as l_orderkey from tags group by tag)
select {_all_columns(TAGS, {
    "tag_id": "tag",
    "tag_slug": "lower(tag)",
    "label": "tag || ' of order ' || l_orderkey",
    "requires_translation": "false",
})} from latest""",
    "event_tag_link": f"""with {_TAG_ROWS}
select distinct tag as tag_id, l_orderkey::varchar as event_id, lower(tag) as tag_slug,
  'order-' || l_orderkey as event_slug from tags""",
    "silver_outcomes": f"""with {_LINES}, {_OUTCOMES}
select * from outcomes qualify count(*) over (partition by clob_token_id) = 1""",
    "silver_outcomes_violations": f"""with {_LINES}, {_OUTCOMES}, shared as (
  select * from outcomes qualify count(*) over (partition by clob_token_id) > 1)
select 'unique_clob_token_id' as rule, count(*) as n_rows from shared having count(*) > 0""",
    "landed_pages": f"""with {_PAGES}
select feed_rank, page_no, pos::integer as pos, o_orderkey::varchar as id, 'order-' || o_orderkey as slug
from placed""",
    "feed_filter": f"""with {_PAGES}
select o_orderkey::varchar as id, strftime(o_orderdate, '%Y-%m-%d') as startDate from placed
where o_orderstatus = 'O' and o_orderdate >= date '1998-01-01'""",
    "feed_audit": f"""with {_PAGES}, counted as (
  select feed_rank, page_no, count(*) as n from placed group by all),
feeds as (
  select feed_rank, count(*) as pages, sum(n)::bigint as rows, max(page_no) as last_page,
    arg_max(n, page_no) as last_page_rows, count(*) filter (n < 65) as short
  from counted group by feed_rank)
select feed_rank, pages, rows, last_page, last_page_rows, last_page + 1 - pages as missing_pages,
  short - case when last_page_rows >= 65 then 0 else 1 end as short_inner_pages,
  0::bigint as malformed_pages, rows >= 5000 as at_row_cap,
  case when last_page + 1 - pages > 0 or short - case when last_page_rows >= 65 then 0 else 1 end > 0
    then 'gaps' when last_page_rows >= 65 then 'truncated' else 'complete' end as status,
  feed_rank = 1 as feed_active, feed_rank = 2 as feed_closed
from feeds""",
    "projected_ids": """
select o_orderkey as event_id from orders left join lineitem on o_orderkey = l_orderkey""",
    "two_feed_keep_last": """
select o_orderkey::varchar as id, case when o_orderstatus = 'O'
  then 'Refreshed order ' || o_orderkey else 'Order of customer ' || o_custkey end as title
from orders""",
    "raw_field_backfill": """
select o_orderkey::varchar as id, 'order-' || o_orderkey as slug, o_orderdate::date as start_date,
  o_orderstatus = 'F' as closed from orders""",
    "raw_unknown_fields": """
select field, count(*) as n_events, case field when 'startDate' then 'STRING' else 'BOOLEAN' end as shape
from orders, (values ('active'), ('closed'), ('startDate')) as f(field) group by field""",
    "bloom_anti_join": """
select l_orderkey, l_linenumber, l_quantity from lineitem
where not exists (select 1 from orders where o_orderkey = l_orderkey and o_totalprice > 200000)""",
    "bloom_semi_join": """
select l_orderkey, l_linenumber, l_quantity from lineitem
where exists (select 1 from orders where o_orderkey = l_orderkey and o_totalprice > 200000)""",
    "json_roundtrip": """
select o_orderkey::varchar as id, 'Order of customer ' || o_custkey as title,
  o_totalprice::varchar as "openInterest",
  case when l_orderkey is null then null when l_suppkey % 13 = 0 then 0 else 2 end::bigint as n_tags
from orders left join lineitem on o_orderkey = l_orderkey""",
    "csv_roundtrip": """
select doc_id, text, case when lang <> 'de' then lang end as lang,
  case when n_chars > 400 then '  "' || source || ' ' else '' end as note from documents""",
    "snake_rename": """
select l_orderkey || '-' || l_linenumber as market_id, l_extendedprice as volume_24_hr,
  l_quantity as volume_1_wk_amm, l_discount as uma_resolution_status, l_tax as show_gmp_series,
  l_linenumber = 1 as is_new from lineitem""",
    "kebab_slug": """
select o_orderkey, 'order-' || o_orderkey || '@' || array_to_string(list_transform(
    regexp_extract_all(o_orderpriority, '[A-Z]?[a-z]+|[A-Z]+|[0-9]+'), lambda x: lower(x)), '-') as slug,
  array_to_string(list_transform(
    regexp_extract_all(c_name, '[A-Z]?[a-z]+|[A-Z]+|[0-9]+'), lambda x: lower(x)), '-') as customer_slug
from orders join customer on c_custkey = o_custkey""",
    "composite_key": """
select l_orderkey, l_linenumber,
  l_orderkey || '-' || case when l_returnflag <> 'N' then l_linenumber end as outcome_id
from lineitem""",
    "nullify_long_url": """
select doc_id, case when strlen(text) <= 500 then text end as image from documents""",
    "drop_add_columns": f"""
select {_all_columns(TAGS, {
    "tag_id": "c_custkey",
    "tag_slug": "lower(c_name)",
    "label": "r_name",
    "requires_translation": "false",
})} from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "cast_report": """
select l_orderkey || '-' || l_linenumber as id,
  trunc(l_extendedprice * case when l_tax > 0.04 then -1 else 1 end)::bigint as whole_amount,
  trunc(l_tax * -10)::bigint as whole_tax,
  case l_returnflag when 'A' then true when 'N' then false end as flag,
  case when l_linenumber <> 7 then l_partkey end::double as part_number,
  case when l_linenumber <> 7 then l_partkey end as part_id,
  year(l_shipdate)::integer as ship_year from lineitem""",
    "rule_violations": f"""with {_DEPENDENCIES}, counts as (
  select 'relationship_type|is_in' as rule, count(*) filter (bad_kind) as n_rows from flagged union all
  select 'comments|max_length', count(*) filter (bad_comment) from flagged union all
  select 'outcome_a_and_b_are_distinct', count(*) filter (bad_pair) from flagged union all
  select 'primary_key', count(*) filter (bad_key) from flagged union all
  select 'unique_outcome_pair', count(*) filter (bad_group) from flagged)
select * from counts where n_rows > 0""",
    "quarantine_rows": f"""with {_DEPENDENCIES}
select dependency_uuid, outcome_id_a, outcome_id_b, relationship_type, comments,
  concat_ws(',', case when bad_kind then 'relationship_type|is_in' end,
    case when bad_comment then 'comments|max_length' end,
    case when bad_pair then 'outcome_a_and_b_are_distinct' end,
    case when bad_key then 'primary_key' end,
    case when bad_group then 'unique_outcome_pair' end) as failed_rules
from flagged where bad_kind or bad_comment or bad_pair or bad_key or bad_group""",
    "good_rows": f"""with {_DEPENDENCIES}
select dependency_uuid, outcome_id_a, outcome_id_b, relationship_type, comments
from flagged where not (bad_kind or bad_comment or bad_pair or bad_key or bad_group)""",
    "duplicate_text_rows": """
select doc_id from documents qualify count(*) over (partition by text) > 1""",
    "marked_duplicates": """
with rows as (select event_id,
  case when event_type <> 'error' then user_id end as u,
  case when event_type <> 'error' then date_trunc('hour', ts) end as h from events)
select event_id, count(*) over (partition by u, h) > 1 as duplicate from rows""",
    "pk_violations": """
select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
group by all having count(*) > 1""",
    "null_profile": "with labelled as (select * from documents left join labels using (doc_id)) "
    + " union all ".join(
        _profile(*c)
        for c in [
            *[(n, n) for n in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")],
            ("liquidity_amm", "null::bigint"),
        ]
    ),
    "fk_report": " union all ".join(
        _fk(*key)
        for key in [
            ("labels", "doc_id", "documents", "doc_id"),
            ("documents", "doc_id", "labels", "doc_id"),
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("orders", "o_orderkey", "lineitem", "l_orderkey"),
            ("orders", "o_custkey", "customer", "c_custkey"),
            ("customer", "c_custkey", "orders", "o_custkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"),
            ("part", "p_partkey", "supplier", "s_suppkey"),
        ]
    ),
    "open_rows": "select o_orderkey as event_id from orders where o_orderstatus = 'O'",
    "requery_anti": f"with {_REQUESTED} select event_id from requested",
    "requery_cap": f"""with {_REQUESTED}
select event_id, row_number() over (order by md5('0:' || event_id), event_id) <= 500 as taken
from requested""",
    "requery_without_landing": "select o_orderkey as event_id from orders where o_orderstatus = 'O'",
    "unusable_ids": """
select case when o_orderkey % 5 = 0 then 'id-' else '99999' end || lpad(o_orderkey::varchar, 10, '0') as event_id,
  count(*) as n_rows
from orders where o_orderstatus = 'O' and (o_orderkey % 5 = 0 or o_orderkey % 7 = 0) group by 1""",
    "unanswered_batches": f"""with {_REQUESTED}, ranked as (
  select event_id, (row_number() over (order by event_id) - 1) // 20 as batch_no from requested)
select batch_no, 'events_' || string_agg(event_id::varchar, ',' order by event_id) || '.json' as page_name
from ranked where batch_no % 2 = 1 group by batch_no""",
    "feed_gaps": f"""with {_PAGES}, kept as (
  select distinct feed_rank, page_no from placed where not (feed_rank = 1 and page_no % 3 = 0)),
ends as (select feed_rank, max(page_no) as last_page from kept group by feed_rank),
numbers as (select feed_rank, unnest(range(0, last_page)) as page_no from ends)
select feed_rank, page_no from numbers except select feed_rank, page_no from kept""",
    "over_long_texts": """
select doc_id::varchar as key, 'image' as column_name, strlen(text)::bigint as n_bytes
from documents where strlen(text) > 500""",
    "column_mismatch": " union all ".join(
        f"select 'extra' as kind, '{c}' as column_name, count({c}) as n_values from customer"
        for c in ("c_acctbal", "c_mktsegment", "c_name", "c_nationkey")
    )
    + """ union all select 'missing', unnest(['tag_slug', 'label', 'force_show', 'force_hide', 'is_carousel',
  'requires_translation', 'created_by', 'updated_by', 'created_at', 'updated_at', 'published_at']), 0::bigint""",
    "run_counts": f"""with {_LINES}, {_TAG_ROWS}, binary_markets as (
  select *, {_STEM} as stem from last where l_quantity > 2 and l_suppkey % 7 <> 0),
sold as (select *, count(*) over (partition by stem) > 1 as shared from binary_markets where l_suppkey % 11 <> 0)
select 'bronze_gamma_markets' as table_name, count(*) filter (l_suppkey % 11 <> 0) as n_published,
  count(*) filter (l_suppkey % 11 = 0) as n_rejected from binary_markets
union all select 'bronze_gamma_events', count(*), 0 from orders
union all select 'bronze_gamma_series', count(distinct c_mktsegment), 0 from orders join customer on c_custkey = o_custkey
union all select 'bronze_gamma_event_series_link', count(*), 0 from orders join customer on c_custkey = o_custkey
union all select 'bronze_gamma_tags', count(distinct tag), 0 from tags
union all select 'bronze_gamma_event_tag_link', count(distinct (tag, l_orderkey)), 0 from tags
union all select 'silver_market_outcomes', 2 * count(*) filter (not shared), 2 * count(*) filter (shared) from sold""",
    "dirty_line_rules": _DIRTY_LINES,
    "enforced_counts": _DIRTY_LINES,
    "dropped_outcomes": f"""with {_LINES}, sized as (
  select mid as market_id, case when l_suppkey % 7 = 0 then 3 else 2 end::bigint as n_outcomes,
    2::bigint as n_outcome_prices, case when l_suppkey % 11 = 0 then 0 else 2 end::bigint as n_clob_token_ids
  from last where l_quantity > 2 and {_RECENT_OR_BINARY})
select *, case when n_clob_token_ids <> 2 then 'no two tokens'
  else 'values beyond the second outcome' end as reason
from sized where n_clob_token_ids <> 2 or n_outcomes > 2""",
    "typed_table": f"""
select {_all_columns(TAGS, {"tag_id": "c_custkey", "tag_slug": "lower(c_name)", "label": "c_name"})},
  timestamp '2025-03-01' as db_created_at, timestamp '2025-03-01' as db_updated_at from customer""",
    "requery_batches": f"""with {_REQUESTED}, ranked as (
  select event_id, (row_number() over (order by event_id) - 1) // 20 as batch_no from requested)
select batch_no, string_agg('id=' || event_id, '&' order by event_id) as query,
  'events_' || string_agg(event_id::varchar, ',' order by event_id) || '.json' as page_name
from ranked group by batch_no""",
    "disappeared": f"with {_REQUESTED} select event_id from gone",
    "archive_patch": f"""with {_REQUESTED}
select lpad(o_orderkey::varchar, 10, '0') as event_id, (o_orderstatus = 'O')::int as active,
  (o_orderstatus = 'F')::int as closed,
  case when o_orderkey in (select event_id from gone) then true else o_orderstatus = 'P' end as archived
from orders""",
    "archive_statements": f"""with {_REQUESTED}
select 'UPDATE bronze_gamma_events SET archived=1 WHERE event_id = ' || event_id || ';' as value
from gone""",
    "reconcile_counts": f"""with {_REQUESTED}, back as (
  select l_orderkey as event_id, count(*) as n from lineitem where l_quantity > 40 group by 1)
select (select count(*) from requested) as requested,
  (select sum(n) from back)::bigint as returned,
  (select count(*) from requested where event_id not in (select event_id from back)) as disappeared,
  (select count(*) from back where event_id not in (select event_id from requested)) as unexpected,
  (select count(*) from back where n > 1) as repeated,
  (select count(*) from requested where event_id not in (select event_id from back))
    = (select count(*) from requested) - (select sum(n) from back) as balanced""",
    "reconcile_batches": f"""with {_REQUESTED}, sides as (
  select o_custkey as batch, o_orderkey in (select event_id from requested) as req,
    o_totalprice > 100000 as ret from orders),
counts as (
  select batch, count(*) filter (req) as requested, count(*) filter (ret) as returned,
    count(*) filter (req and not ret) as disappeared, count(*) filter (ret and not req) as unexpected
  from sides where req or ret group by batch)
select *, 0::bigint as repeated, disappeared = requested - returned as balanced from counts""",
    "upsert_audit": """
select c_custkey, c_name, c_nationkey, c_acctbal,
  case when c_acctbal < 5000 and c_mktsegment = 'BUILDING' then 'CONSTRUCTION'
    else c_mktsegment end as c_mktsegment,
  case when c_acctbal > 0 then timestamp '2025-01-01' else timestamp '2025-03-01' end as db_created_at,
  case when c_acctbal > 0 and not (c_acctbal < 5000 and c_mktsegment = 'BUILDING')
    then timestamp '2025-02-01' else timestamp '2025-03-01' end as db_updated_at
from customer""",
    "versioned_upsert": """
select c_custkey, c_name, c_nationkey, c_acctbal,
  case when c_acctbal < 5000 and c_mktsegment = 'BUILDING' then 'CONSTRUCTION'
    else c_mktsegment end as c_mktsegment,
  case when c_acctbal > 0 then timestamp '2025-01-01' else timestamp '2025-03-01' end as db_created_at,
  case when c_acctbal > 0 and not (c_acctbal < 5000 and c_mktsegment = 'BUILDING')
    then timestamp '2025-01-01' else timestamp '2025-03-01' end as db_updated_at
from customer""",
    "change_feed": """
with later as (
  select * replace (case when o_orderstatus = 'O' and o_custkey % 5 = 0 then 'F' else o_orderstatus end as o_orderstatus)
  from orders),
a as (select * from orders where o_orderkey % 11 <> 0),
b as (select * from later where o_orderkey % 7 <> 0)
select 'insert' as change, b.* from b anti join a using (o_orderkey)
union all select 'delete', a.* from a anti join b using (o_orderkey)
union all select 'update', b.* from b join a using (o_orderkey) where a.o_orderstatus <> b.o_orderstatus""",
    "streamed_series": """
with ranked as (
  select c_mktsegment, o_orderkey, row_number() over (partition by c_mktsegment order by
    case o_orderstatus when 'O' then 1 when 'F' then 2 else 3 end desc, o_orderkey desc) as rn
  from orders join customer on c_custkey = o_custkey)
select c_mktsegment as series_id, 'Segment of order ' || o_orderkey as title, o_orderkey::bigint as comment_count
from ranked where rn = 1""",
    "second_run_counts": f"""with orders as (select * from main.orders where o_orderkey // 20 % 2 = 0),
{_LINES}, {_TAG_ROWS}, binary_markets as (
  select *, {_STEM} as stem from last where l_quantity > 2 and l_suppkey % 7 <> 0),
sold as (select *, count(*) over (partition by stem) > 1 as shared from binary_markets where l_suppkey % 11 <> 0),
asked as (
  select o_orderkey from main.orders where o_orderkey // 20 % 2 = 1 and o_orderkey % 3 <> 0 and o_orderstatus = 'O')
select 'bronze_gamma_markets' as table_name, count(*) filter (l_suppkey % 11 <> 0) as n_inserted, 0 as n_updated
  from binary_markets
union all select 'bronze_gamma_events', count(*) filter (o_orderkey % 3 = 0),
  count(*) filter (o_orderkey % 3 <> 0) + (select count(*) from asked) from orders
union all select 'bronze_gamma_series', count(distinct c_mktsegment), 0 from orders join customer on c_custkey = o_custkey
union all select 'bronze_gamma_event_series_link', count(*), 0 from orders join customer on c_custkey = o_custkey
union all select 'bronze_gamma_tags', count(distinct tag), 0 from tags
union all select 'bronze_gamma_event_tag_link', count(distinct (tag, l_orderkey)), 0 from tags
union all select 'silver_market_outcomes', 2 * count(*) filter (not shared), 0 from sold""",
    "text_key_batches": """
with keys as (select distinct l_returnflag || '-' || l_orderkey as key from lineitem),
ranked as (select key, (row_number() over (order by key) - 1) // 20 as batch_no from keys)
select batch_no, count(*) as n_keys, min(key) as first_key, max(key) as last_key from ranked group by batch_no""",
    "dependency_closure": f"""with {_IMPLIED}
select x::varchar as outcome_id_a, y::varchar as outcome_id_b,
  case when xt and yt then 'implies' when xt then 'mutex' else 'covers' end as relation
from reach where x <> y and (xt or yt)""",
    "dependency_conflicts": f"""with {_IMPLIED}
select x::varchar as outcome_id, case when count(*) = 2 then 'contradiction'
  when bool_and(xt) then 'never true' else 'never false' end as conflict
from reach where x = y and xt <> yt group by x
union all
select x::varchar, 'cycle of ' || least(min(x::varchar), min(y::varchar)) from reach r
where xt and yt and exists (select 1 from reach b where b.x = r.y and b.y = r.x and b.xt and b.yt) group by x""",
}
