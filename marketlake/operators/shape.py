"""Explode, unnest, rename and conform columns to a contract."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.contracts import Contract
from marketlake.functions.casts import over_long_to_null
from marketlake.functions.naming import snake

log = logging.getLogger(__name__)

ARRAY_POS, ELEMENT = "_array_pos", "_element"


def explode_structs(
    df: DataFrame,
    array: str,
    carry: Sequence[str | Column],
    outer: bool = False,
    only: Sequence[str] = (),
) -> DataFrame:
    """One row per struct of ``array``: the carried columns, then the struct's fields.

    ``outer`` keeps rows with an empty or NULL array as one all-NULL row.  The outer
    generator is used in both cases: for the inner one Catalyst adds a
    ``size(array) > 0`` filter below the explode, which would parse a JSON array twice.
    ``only`` names the fields wanted: a scan prunes nested columns that are picked before
    the explode, but not several ones picked after it.
    ``_array_pos`` holds the element's position.
    """
    return unnest(explode_elements(df, array, carry, outer, only))


def explode_elements(
    df: DataFrame,
    array: str,
    carry: Sequence[str | Column],
    outer: bool = False,
    only: Sequence[str] = (),
) -> DataFrame:
    """:func:`explode_structs` before its last step: the struct is still one column, ``_element``.

    A wide struct is copied as a whole; taken apart, each of its fields is a few lines in one
    generated method, which above a size is never compiled.
    """
    fields = list(only) or df.schema[array].dataType.elementType.names
    carried = df.select(*carry).columns
    _require_distinct([*carried, *fields])
    elements = F.col(array)
    if only:
        elements = F.arrays_zip(*[F.col(f"{array}.{f}").alias(f) for f in only])
    rows = df.select(*carry, F.posexplode_outer(elements).alias(ARRAY_POS, ELEMENT))
    return rows if outer else rows.filter(F.col(ARRAY_POS).isNotNull())


def unnest(rows: DataFrame) -> DataFrame:
    """The fields of ``_element`` in the place of it, behind the other columns."""
    return rows.select(*[f"`{c}`" for c in rows.columns if c != ELEMENT], f"{ELEMENT}.*")


def rename_snake(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rename every column to snake_case, except engine columns (leading ``_``) and ``keep``."""
    names = [c if c.startswith("_") or c in keep else snake(c) for c in df.columns]
    _require_distinct(names)
    return df.toDF(*names)


def rename_exact(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; unlike ``withColumnsRenamed`` a missing source column is an error."""
    missing = sorted(set(mapping) - set(df.columns))
    if missing:
        raise ValueError(f"columns to rename are missing: {missing}")
    _require_distinct([mapping.get(c, c) for c in df.columns])
    return df.withColumnsRenamed(dict(mapping))


def drop_listed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def nullify_long(df: DataFrame, names: Sequence[str], max_bytes: int = 500) -> DataFrame:
    """NULL out values longer than ``max_bytes`` bytes (not characters)."""
    return df.withColumns({n: over_long_to_null(F.col(n), max_bytes) for n in names})


def over_long(df: DataFrame, key: str, names: Sequence[str], max_bytes: int = 500) -> DataFrame:
    """(key, column_name, n_bytes) of every value that :func:`nullify_long` sets to NULL."""
    sizes = F.array(
        *[F.struct(F.lit(n).alias("column_name"), F.octet_length(n).cast("bigint").alias("n_bytes")) for n in names]
    )
    rows = df.select(F.col(key).cast("string").alias("key"), F.explode(sizes).alias("_size"))
    return rows.select("key", "_size.*").filter(F.col("n_bytes") > max_bytes)


@dataclass(frozen=True)
class Conformed:
    df: DataFrame
    dropped: list[str]
    added: list[str]


def conform(df: DataFrame, contract: Contract, optional: Sequence[str] | None = None) -> Conformed:
    """Exactly the contract's columns, in its order; engine columns (``_``) pass through.

    Extra columns are dropped and reported, optional ones missing from the whole source
    are added as NULL, and any other missing column aborts before a job is started.
    """
    optional = contract.optional if optional is None else optional
    own = [c for c in df.columns if not c.startswith("_")]
    engine = [c for c in df.columns if c.startswith("_")]
    dropped = sorted(set(own) - set(contract.names))
    added = [c for c in contract.names if c in optional and c not in own]
    require_columns([c for c in own if c not in dropped] + added, contract)
    if dropped:
        log.warning("%s: dropping %d extra columns: %s", contract.name, len(dropped), dropped)
    for name in added:
        log.info("%s: column %s is not in the source, added as NULL", contract.name, name)
    nulls = {c: F.lit(None).cast(contract.column(c).data_type) for c in added}
    if nulls:
        df = df.withColumns(nulls)
    names = [f"`{c}`" for c in contract.names]
    return Conformed(df.selectExpr(*names, *engine), dropped, added)


def column_differences(names: Sequence[str], contract: Contract) -> tuple[list[str], list[str]]:
    """(extra, missing) columns against the contract."""
    return sorted(set(names) - set(contract.names)), sorted(set(contract.names) - set(names))


def require_columns(names: Sequence[str], contract: Contract) -> None:
    extra, missing = column_differences(names, contract)
    if extra or missing:
        raise ValueError(f"{contract.name}: extra columns {extra}, missing columns {missing}")


def _require_distinct(names: Sequence[str]) -> None:
    repeated = sorted(n for n, count in Counter(names).items() if count > 1)
    if repeated:
        raise ValueError(f"duplicate column names: {repeated}")
