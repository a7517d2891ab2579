"""Lenient casts from landed text (or from already typed columns) to contract types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def cast_text(name: str, source: T.DataType, target: T.DataType) -> str:
    """SQL text that casts column ``name``; NULL when the value does not cast.

    Integers truncate toward zero.  Landed text goes through a wide decimal, because
    ``try_cast('1.9' AS BIGINT)`` is NULL and a double would lose digits above 2**53.
    Only ``true`` and ``false`` are boolean texts; Spark alone would take '1' and 'yes'.

    The cast is text because a wide table has hundreds of them, and every call on a
    Column is a round trip to the JVM.
    """
    column, text = f"`{name}`", isinstance(source, T.StringType)
    if source == target:
        return column
    if isinstance(target, T.BooleanType):
        if text:
            return f"CASE {column} WHEN 'true' THEN true WHEN 'false' THEN false END"
        return f"CAST({column} AS BOOLEAN)"
    if isinstance(target, _INTEGRAL) and text:
        column = f"try_cast({column} AS DECIMAL(38,10))"
    return f"try_cast({column} AS {target.simpleString()})"


def to_type(name: str, source: T.DataType, target: T.DataType) -> Column:
    return F.expr(cast_text(name, source, target))


def uint32(c: Column) -> Column:
    """Numeric value of an event id as BIGINT; NULL outside 0 .. 2**32-1."""
    n = c.try_cast("bigint")
    return F.when(n.between(0, 2**32 - 1), n)


def flag(c: Column, source: T.DataType) -> Column:
    """Boolean-like snapshot columns: booleans, 0/1 numbers, or their text."""
    return c.try_cast("boolean") if isinstance(source, T.StringType) else c.cast("boolean")


def year(c: Column) -> Column:
    """Leading four digits of a date text as INT; NULL when it does not start with them."""
    return F.regexp_extract(c, r"^(\d{4})", 1).try_cast("int")


def over_long_to_null(c: Column, max_bytes: int) -> Column:
    return F.when(F.octet_length(c) > max_bytes, F.lit(None)).otherwise(c)
