"""Writing tables: Parquet, CSV, JSON pages, quarantine, and the audited upsert."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.contracts import Contract

AUDIT_COLUMNS = ("db_created_at", "db_updated_at")


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Store ``df`` and return the stored table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """With a header; NULL is empty and the empty string is ``""``.  Spaces are kept."""
    df.write.mode("overwrite").csv(
        path,
        header=True,
        escape='"',
        nullValue="",
        emptyValue='""',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what :func:`write_csv` wrote, line breaks inside values included.

    The null marker is one no value can have, so a quoted empty text stays a text.
    """
    return spark.read.csv(
        path,
        schema=schema,
        header=True,
        escape='"',
        multiLine=True,
        nullValue="\x00",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def publish(
    df: DataFrame, name: str, root: str, observe: Sequence = (), csv: bool = True
) -> DataFrame:
    """Parquet and, unless told otherwise, CSV of one table under ``root``.

    The CSV is made from the stored Parquet.  ``observe`` holds an observation and its
    aggregates, measured during the Parquet write.
    """
    measured = df.observe(*observe) if observe else df
    stored = write_parquet(measured, f"{root}/{name}.parquet")
    if csv:
        write_csv(stored, f"{root}/{name}.csv")
    return stored


def write_json(df: DataFrame, root: str, run_id: str) -> str:
    """Raw events as JSON lines in a folder of this run, so that no earlier file mixes in."""
    path = f"{root}/run_id={run_id}"
    df.write.mode("overwrite").json(path)
    return path


def create_table(spark: SparkSession, contract: Contract, path: str) -> DataFrame:
    """An empty stored table with the contract's columns and the audit columns."""
    schema = contract.struct_type()
    for name in AUDIT_COLUMNS:
        schema = schema.add(name, T.TimestampType(), False)
    return write_parquet(spark.createDataFrame([], schema), path)


def align(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns, then the audit columns there are.

    A stored table may be older than its contract: a column it lacks becomes a typed NULL,
    and a column that left the contract is dropped.
    """
    columns = [
        F.col(f"`{c.name}`") if c.name in df.columns else F.lit(None).cast(c.data_type).alias(c.name)
        for c in contract.columns
    ]
    return df.select(*columns, *[c for c in AUDIT_COLUMNS if c in df.columns])


def upsert(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    now: datetime | Column,
    contract: Contract | None = None,
) -> DataFrame:
    """``old`` with ``new`` merged in by key, audit columns maintained.

    Rows only in ``old`` stay as they are.  ``db_created_at`` is kept from the first
    insert, and ``db_updated_at`` moves only when some other column differs.  Keys are
    unique on both sides, so the join has no hot key.  With a ``contract`` both sides are
    aligned to it first; without one they must have the same columns.
    """
    if contract is not None:
        old, new = align(old, contract), align(new, contract)
    own = [c for c in old.columns if c not in AUDIT_COLUMNS]
    if set(own) != set(new.columns) - set(AUDIT_COLUMNS):
        raise ValueError(f"columns differ: {sorted(set(own) ^ (set(new.columns) - set(AUDIT_COLUMNS)))}")
    stamp = now if isinstance(now, Column) else F.lit(now)
    if old.isEmpty():  # every row is inserted: no wide row needs to move
        stamped = [stamp.cast(old.schema[c].dataType).alias(c) for c in AUDIT_COLUMNS]
        return new.select(*[F.col(f"`{c}`") for c in own], *stamped)
    row = ", ".join(f"`{c}`" for c in own)
    key_names = [f"_k{i}" for i in range(len(keys))]
    key_texts = [f"`{k}` AS {name}" for k, name in zip(keys, key_names)]
    before = old.selectExpr(f"struct({row}) AS _old", *AUDIT_COLUMNS, *key_texts)
    after = new.selectExpr(f"struct({row}) AS _new", *key_texts)
    joined = before.join(after, key_names, "full_outer")
    inserted = F.col("_old").isNull()
    changed = F.col("_new").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))
    return joined.select(
        F.coalesce("_new", "_old").alias("_row"),
        F.when(inserted, stamp).otherwise(F.col("db_created_at")).alias("db_created_at"),
        F.when(changed, stamp).otherwise(F.col("db_updated_at")).alias("db_updated_at"),
    ).select("_row.*", *AUDIT_COLUMNS)
