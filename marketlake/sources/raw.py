"""Landed events kept whole as VARIANT, so that a field nobody asked for yet isn't lost."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.dedup import keep_last
from marketlake.sources.landing import ORDINAL, PAGE


def raw_events(pages: DataFrame) -> DataFrame:
    """Pages (place, value) to one row per element, with its ordinal and itself as VARIANT.

    A page is parsed once, whatever contracts ask for later.  A page that is no array of
    JSON values gives one row with NULL ``_pos`` and NULL ``event``; an empty array gives none.
    VARIANT keeps every field and its nesting; numbers are kept by value (``1.50`` is 1.5).
    """
    parsed = pages.select(*PAGE, F.expr("try_variant_get(try_parse_json(value), '$', 'array<variant>')").alias("_events"))
    broken = F.array(F.lit(None).cast(T.VariantType()))
    found = parsed.select(*PAGE, F.col("_events").isNull().alias("_broken"), F.posexplode(F.coalesce("_events", broken)).alias("_pos", "event"))
    return found.select(*PAGE, F.when(~F.col("_broken"), F.col("_pos")).alias("_pos"), "event")


def value_of(name: str, kind: str, event: str = "event") -> Column:
    """A field of the stored event by name; NULL where it is absent or has no such type."""
    quote = "'" if "'" not in name else '"'
    if quote in name:
        raise ValueError(f"no path names a field with both kinds of quotes: {name}")
    return F.try_variant_get(F.col(event), f"$[{quote}{name}{quote}]", kind)


def fields_of(raw: DataFrame, fields: T.StructType) -> DataFrame:
    """The ordinal and the named fields of every stored event; broken pages give no row."""
    events = raw.filter(F.col("_pos").isNotNull())
    return events.select(*ORDINAL, *[value_of(f.name, f.dataType.simpleString()).alias(f.name) for f in fields])


def unknown_fields(raw: DataFrame, known: Collection[str]) -> DataFrame:
    """(field, n_events, shape): top-level fields outside ``known``, with the type that holds all their values."""
    objects = raw.filter(F.schema_of_variant("event").startswith("OBJECT"))
    objects.createOrReplaceTempView(view := f"raw_{id(objects)}")
    spark = raw.sparkSession
    each = spark.sql(f"SELECT f.key AS field, f.value AS value FROM {view}, LATERAL variant_explode(event) AS f")
    each = each.filter(~F.col("field").isin(*known)) if known else each
    out = each.groupBy("field").agg(F.count(F.lit(1)).alias("n_events"), F.schema_of_variant_agg("value").alias("shape"))
    spark.catalog.dropTempView(view)
    return out


def backfill(table: DataFrame, raw: DataFrame, key: str, raw_key: str, added: dict[str, tuple[str, str]]) -> DataFrame:
    """``table`` with new columns from the stored events: column -> (field, type).

    Each row takes the values of the last stored copy (greatest ordinal) of its key; a key
    without one gets NULLs, a NULL key too.  Only key, ordinal and the new fields leave the
    scan, and copies are reduced before the join.
    """
    if clash := set(added) & set(table.columns):
        raise ValueError(f"columns already there: {sorted(clash)}")
    kind = table.schema[key].dataType.simpleString()
    columns: Sequence[Column] = [value_of(f, t).alias(c) for c, (f, t) in added.items()]
    values = raw.select(value_of(raw_key, kind).alias("_key"), *ORDINAL, *columns).filter("_key IS NOT NULL")
    last = keep_last(values, ["_key"], ORDINAL).select("_key", *added)
    return table.join(last, F.col(key) == F.col("_key"), "left").drop("_key")
