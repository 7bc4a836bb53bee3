"""Query registry: name -> (Spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from barforge.functions.core import r

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


# Means of cent prices over <= 60 rows have no exact decimal ties at 8
# digits but can tie at 6 (partial frames of 32 rows), so they keep 8.
PRICE_MEAN_COLS = {"sma_5", "sma_20", "sma_60", "macd_line", "macd_signal", "macd_histogram", "atr_14"}


def digits_for(name: str, k: int) -> int:
    return 8 if name in PRICE_MEAN_COLS else k


def finalize(df: DataFrame, k: int = 6) -> DataFrame:
    """Round every DOUBLE output column with the portable r(x, k)."""
    return df.select(*[r(F.col(f.name), digits_for(f.name, k)).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def register(name: str, sql: str | None = None, k: int = 6, raw: bool = False):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return df if raw else finalize(df, k)
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
