"""Session settings the engine relies on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The markets table has more columns than the default codegen limit of 100; above it
# Spark drops whole-stage codegen and batched Parquet scans.  JSON keys are
# case-sensitive, so `Id` and `id` are two fields.  Skewed joins are split at run time
# even when that costs one more shuffle.
ENGINE_SETTINGS = {
    "spark.sql.codegen.maxFields": "600",
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


@contextmanager
def engine_settings(spark: SparkSession) -> Iterator[None]:
    """Apply the settings for the duration of a run and put the caller's back afterwards."""
    before = {k: spark.conf.get(k, None) for k in ENGINE_SETTINGS}
    try:
        for key, value in ENGINE_SETTINGS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def work_folder(spark: SparkSession, default: str) -> str:
    """Shared folder for intermediate tables: the session's checkpoint folder if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None) or default
