"""Contract engine: coercion, row rules, group rules, split and reports."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.contracts import Contract, ForeignKey
from marketlake.functions.casts import cast_text

CAST_FAILED = "_cast_failed"
ROW_FAILED = "_row_failed"
NO_NAMES = "CAST(array() AS ARRAY<STRING>)"
FAILED_RULES = "failed_rules"


class ContractViolation(Exception):
    """Rows broke a contract; ``counts`` maps each broken rule to its number of rows."""

    def __init__(self, table: str, counts: Mapping[str, int]):
        self.table = table
        self.counts = dict(counts)
        super().__init__(f"{table}: rows fail the contract: {self.counts}")


# -- coercion ---------------------------------------------------------------


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast every column to its contract type.

    ``_cast_failed`` lists the columns whose value was present but did not cast; it is
    NULL on clean rows, so it costs almost nothing to store.
    """
    schema = df.schema
    typed, failures = [], {}
    for c in contract.columns:
        source = schema[c.name].dataType
        cast = cast_text(c.name, source, c.data_type)
        typed.append(f"{cast} AS `{c.name}`")
        if source != c.data_type:
            failures[c.name] = f"`{c.name}` IS NOT NULL AND {cast} IS NULL"
    engine = [c for c in schema.names if c.startswith("_")]
    return df.selectExpr(*typed, f"{_names_where(failures)} AS {CAST_FAILED}", *engine)


# -- row rules --------------------------------------------------------------


def row_rules(contract: Contract) -> dict[str, str]:
    """Rule name to SQL predicate, for all rules that need one row only."""
    rules: dict[str, str] = {}
    for c in contract.columns:
        if not c.nullable:
            rules[f"{c.name}|nullability"] = f"`{c.name}` IS NOT NULL"
        if c.min_length:
            rules[f"{c.name}|min_length"] = f"octet_length(`{c.name}`) >= {c.min_length}"
        if c.max_length is not None:
            rules[f"{c.name}|max_length"] = f"octet_length(`{c.name}`) <= {c.max_length}"
        if c.values:
            values = ", ".join(repr(v) for v in c.values)
            rules[f"{c.name}|is_in"] = f"`{c.name}` IN ({values})"
    for rule in contract.row_rules:
        rules[rule.name] = rule.predicate
    return rules


def _names_where(conditions: Mapping[str, str], earlier: str | None = None) -> str:
    """SQL for the array of names whose condition holds, or NULL when none does.

    ``earlier`` is a column with names to put in front.  The array is only built on rows
    where there is something to name.
    """
    some = [f"({c})" for c in conditions.values()]
    found = ", ".join(f"CASE WHEN {c} THEN '{name}' END" for name, c in conditions.items())
    names = f"array_compact(array({found}))" if conditions else NO_NAMES
    if earlier is not None:
        if conditions:  # the same names; array_compact is interpreted, with all rules below it
            found = ", ".join(f"CASE WHEN {c} THEN '{name}' ELSE '' END" for name, c in conditions.items())
            names = f"array_remove(array({found}), '')"
        some.append(f"{earlier} IS NOT NULL")
        names = f"concat(coalesce(transform({earlier}, c -> concat(c, '|castable')), {NO_NAMES}), {names})"
    return f"CASE WHEN {' OR '.join(some) or 'false'} THEN {names} END"


# -- group rules ------------------------------------------------------------


def group_rules(
    contract: Contract, proven: Collection[Sequence[str]] = ()
) -> dict[str, tuple[str, ...]]:
    """Unique keys to check, the primary key included, each distinct key set once.

    ``proven`` names key sets that the plan above already made unique (keep-last on the
    same key), which need no second grouping.
    """
    done = {frozenset(keys) for keys in proven}
    rules: dict[str, tuple[str, ...]] = {}
    for name, keys in [("primary_key", contract.primary_key), *contract.unique.items()]:
        if frozenset(keys) not in done:
            done.add(frozenset(keys))
            rules[name] = tuple(keys)
    return rules


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur on more than one row, with their count; NULLs are equal.

    The count is combined on the map side, so a hot key moves one row per task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def mark_duplicates(
    df: DataFrame, keys: Sequence[str], flag: str, dups: DataFrame | None = None
) -> DataFrame:
    """Add ``flag``: true on every row of a duplicated group.

    The duplicated keys are joined back instead of counted over a window, which would
    put a hot group into one task.  Spark picks the join from the measured size of the
    keys, and a hot key on the row side is split by the skew join.
    """
    dups = duplicated_keys(df, keys) if dups is None else dups
    found = _renamed(dups, keys).withColumn(flag, F.lit(True))
    joined = df.join(found, _same(keys), "left").drop(*[f"_dup_{k}" for k in keys])
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of all duplicated groups.

    Keys may be whole texts, so they are grouped by a hash first and only the hash moves.
    Rows whose hash repeats are then compared by value: a hash whose least and largest
    key agree holds one group, and only the others are grouped by the keys themselves.
    """
    value = F.struct(*keys)
    marked = df.withColumn("_hash", F.xxhash64(*keys))
    repeated = duplicated_keys(marked.select("_hash"), ["_hash"]).select("_hash")
    rows = marked.join(repeated, "_hash", "left_semi")
    ends = rows.groupBy("_hash").agg(F.min(value).alias("_least"), F.max(value).alias("_most"))
    one_group = F.col("_least").eqNullSafe(F.col("_most"))
    whole = rows.join(ends.filter(one_group).select("_hash"), "_hash", "left_semi").drop("_hash")
    mixed = rows.join(ends.filter(~one_group).select("_hash"), "_hash", "left_semi").drop("_hash")
    found = mixed.join(_renamed(duplicated_keys(mixed, keys), keys), _same(keys), "left_semi")
    return whole.unionByName(found)


def _renamed(dups: DataFrame, keys: Sequence[str]) -> DataFrame:
    return dups.select(*[F.col(k).alias(f"_dup_{k}") for k in keys])


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_dup_{k}")) for k in keys])


def group_duplicates(
    df: DataFrame, contract: Contract, proven: Collection[Sequence[str]] = ()
) -> dict[str, DataFrame]:
    """Rule name to the keys that break it, for every group rule still to be checked."""
    return {
        name: duplicated_keys(df, keys).select(*keys)
        for name, keys in group_rules(contract, proven).items()
    }


# -- split ------------------------------------------------------------------


def check_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Add ``_row_failed``: the failed casts and row rules, or NULL on a clean row.

    A rule that evaluates to NULL passes.  The column is stored with the staged table, so
    a later check of clean rows reads it and the key columns instead of every column.
    """
    columns = df.columns
    broken = {name: f"NOT coalesce({p}, true)" for name, p in row_rules(contract).items()}
    failed = _names_where(broken, CAST_FAILED if CAST_FAILED in columns else None)
    names = [f"`{c}`" for c in contract.names]
    engine = [c for c in columns if c.startswith("_") and c != CAST_FAILED]
    return df.selectExpr(*names, f"{failed} AS {ROW_FAILED}", *engine)


def split(
    df: DataFrame,
    contract: Contract,
    proven: Collection[Sequence[str]] = (),
    duplicates: Mapping[str, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the contract, and the others with their ``failed_rules``.

    The two sides are disjoint and together hold every input row.  Group rules look at
    all input rows, also at those that break another rule.  ``duplicates`` passes
    stored results of :func:`group_duplicates`, whose size Spark then knows.
    """
    rows = df if ROW_FAILED in df.columns else check_rows(df, contract)
    if duplicates is None:
        duplicates = group_duplicates(rows, contract, proven)
    flags = {}
    for i, (name, dups) in enumerate(duplicates.items()):
        flags[name] = f"_group_{i}"
        rows = mark_duplicates(rows, dups.columns, flags[name], dups)
    row_failed = F.col(ROW_FAILED)
    broken = reduce(lambda a, b: a | b, [F.col(f) for f in flags.values()], row_failed.isNotNull())
    group_failed = F.array_compact(
        F.array(*[F.when(F.col(f), F.lit(name)) for name, f in flags.items()])
    )
    failed = F.coalesce(row_failed, F.expr(NO_NAMES))
    if flags:
        failed = F.concat(failed, group_failed)
    names = [f"`{c}`" for c in contract.names]
    good = rows.filter(~broken).selectExpr(*names)
    bad = rows.filter(broken).withColumn(FAILED_RULES, failed).selectExpr(*names, FAILED_RULES)
    return good, bad


def quarantine_schema(contract: Contract) -> T.StructType:
    fields = [T.StructField(c.name, c.data_type) for c in contract.columns]
    return T.StructType([*fields, T.StructField(FAILED_RULES, T.ArrayType(T.StringType()))])


def rule_counts(bad: DataFrame) -> DataFrame:
    """Failing rows per rule."""
    return (
        bad.select(F.explode(FAILED_RULES).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def enforce(bad: DataFrame, contract: Contract) -> None:
    """Raise if any row failed; only the per-rule counts reach the driver."""
    counts = {r["rule"]: r["n_rows"] for r in rule_counts(bad).collect()}
    if counts:
        raise ContractViolation(contract.name, counts)


# -- reports ----------------------------------------------------------------


def non_null_counts(columns: Sequence[str]) -> list[Column]:
    """Aggregates behind the null profile, also usable as observed metrics of a write."""
    return [F.count(f"`{c}`").alias(c) for c in columns]


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, non_null, n_rows, all_null) from one pass; an empty table reports all."""
    columns = df.columns
    total = df.agg(F.count(F.lit(1)).alias("_rows"), *non_null_counts(columns))
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("non_null"))
            for c in columns
        ]
    )
    return total.select("_rows", F.inline(entries)).select(
        "column_name",
        "non_null",
        F.col("_rows").alias("n_rows"),
        (F.col("non_null") == 0).alias("all_null"),
    )


def foreign_key_violations(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Child key values without a parent row, with the number of child rows.

    Child keys are counted before the join, so a hot key is one row there.
    """
    keys = (
        child.filter(F.col(fk.column).isNotNull())
        .groupBy(F.col(fk.column).alias("_key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = parent.select(F.col(fk.parent_column).alias("_key")).distinct()
    return keys.join(parents, "_key", "left_anti").select(
        F.lit(fk.name).alias("foreign_key"),
        F.col("_key").cast(T.StringType()).alias("missing_key"),
        "n_rows",
    )


def foreign_key_report(
    tables: Mapping[str, DataFrame], foreign_keys: Sequence[ForeignKey]
) -> DataFrame:
    """Violations of all foreign keys whose two tables are present."""
    parts = [
        foreign_key_violations(tables[fk.child], tables[fk.parent], fk)
        for fk in foreign_keys
        if fk.child in tables and fk.parent in tables
    ]
    return reduce(DataFrame.unionAll, parts)
