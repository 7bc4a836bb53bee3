"""Table health (H1) and layer invariants (H2)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEALTH_SCHEMA = ("tier string, table_name string, row_count bigint, latest_date date, "
                 "duplicate_keys bigint, null_keys bigint, error string")


def _one(df: DataFrame, keys: list[str], date_col: str | None) -> DataFrame:
    """One row of counts, all from one pass grouped by key."""
    latest = F.max(date_col).cast("date") if date_col else F.lit(None).cast("date")
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"), latest.alias("_d"))
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per_key.agg(total(F.col("_c")).alias("row_count"), F.max("_d").alias("latest_date"),
                       total(F.col("_c") - 1).alias("duplicate_keys"),
                       total(F.when(no_key, F.col("_c")).otherwise(0)).alias("null_keys"))


def table_health(spark: SparkSession, tables: dict[str, dict[str, tuple]]) -> DataFrame:
    """H1: per table row count, latest date, duplicate-key and NULL-key counts.

    ``tables`` maps tier -> name -> (builder, key columns, date column[, counts]).  ``counts()`` gives what was
    counted while the table was written, or None; only without it is the table read and counted, a job of its own
    with one row as its result.  So a table that fails, while planning or while running, is reported with its
    error and the others keep their counts.
    """
    rows = []
    for tier, named in tables.items():
        for name, (build, keys, date_col, *counts) in named.items():
            try:
                known = counts[0]() if counts else None
                found = [known[c] for c in ("row_count", "latest_date", "duplicate_keys", "null_keys")] if known else _one(build(), keys, date_col).first()
                rows.append((tier, name, *found, None))
            except Exception as e:  # noqa: BLE001  (report, do not fail)
                rows.append((tier, name, None, None, None, None, str(e)))
    return spark.createDataFrame(rows, HEALTH_SCHEMA)


def layer_rowcounts_from_metrics(spark: SparkSession, counts: dict | None) -> DataFrame | None:
    """H2 from the counts by symbol that were gathered while silver was written; None where they are not complete or do not
    match (a mismatch is reported only after a recount)."""
    source, rows = (counts or {}).get("source_by"), (counts or {}).get("rows_by")
    if source is None or rows is None:
        return None
    source, rows = ({x["item"]: x["n"] for x in side} for side in (source, rows))
    if source != rows or None in source:
        return None
    return spark.createDataFrame([(s, n, rows[s], True) for s, n in source.items()], "symbol string, bronze_rows long, silver_rows long, rows_match boolean")


def layer_rowcount_check(bronze_in_window: DataFrame, silver: DataFrame) -> DataFrame:
    """H2: silver rows equal bronze rows in the feature window, per symbol and in total."""
    b = bronze_in_window.groupBy("symbol").agg(F.count(F.lit(1)).alias("bronze_rows"))
    s = silver.groupBy("symbol").agg(F.count(F.lit(1)).alias("silver_rows"))
    j = b.join(s, "symbol", "full")
    return j.select("symbol", F.coalesce("bronze_rows", F.lit(0)).alias("bronze_rows"),
                    F.coalesce("silver_rows", F.lit(0)).alias("silver_rows"),
                    (F.coalesce("bronze_rows", F.lit(0)) == F.coalesce("silver_rows", F.lit(0))).alias("rows_match"))
