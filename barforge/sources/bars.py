"""Daily bars derived from the driver's TPC-H-like tables.

The given tables hold no prices, so bars are derived with an integer recipe
that any SQL engine reproduces bit for bit:

    symbol = nation name of the line item's supplier, date = ship date
    per (symbol, date): sd = sum(round(discount*100)), mt = max(round(tax*100)),
                        n = count, volume = sum(quantity)
    r = 0.4 * (sd / (100 n) - 0.05)
    close_cents = floor(100000 * exp(running sum of ln(1 + r)) + 0.5)
    open_cents = previous close_cents (own close on the first bar)
    high_cents = max(open, close) * (400 + mt) div 400
    low_cents  = min(open, close) * (400 - mt) div 400

Scale: the only large input is ``lineitem``.  It is read with five columns,
joined to a supplier->symbol dimension (broadcast only when a bounded count
proves it small, else a shuffle join that AQE splits for hot suppliers),
and partially aggregated per (symbol, date) before the shuffle, so the
exchange carries at most one row per (task, symbol, date).  The running
price path is a window over the small bar table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.functions.core import running
from barforge.plans.sizing import bounded_broadcast

BAR_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "volume"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supplier_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, symbol): supplier -> nation name."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("symbol"))
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return supplier.join(bounded_broadcast(nation, 100_000), supplier.s_nationkey == nation.n_nationkey) \
        .select("s_suppkey", "symbol")


def daily_ticks_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, date, sd, mt, n, volume) from lineitem; one shuffle of partial aggregates."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_discount", "l_tax", "l_quantity")
    dim = bounded_broadcast(supplier_symbols(spark, sf_dir))
    j = li.join(dim, li.l_suppkey == dim.s_suppkey)
    return j.groupBy("symbol", F.to_date("l_shipdate").alias("date")).agg(
        F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("sd"),
        F.max(F.round(F.col("l_tax") * 100).cast("long")).alias("mt"),
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").cast("long").alias("volume"),
    )


def price_path(daily: DataFrame, base_cents: int = 100000) -> DataFrame:
    """Compound per-symbol returns into integer-cent OHLC bars."""
    w = Window.partitionBy("symbol").orderBy("date")
    ret = F.lit(0.4) * (F.col("sd").cast("double") / (F.lit(100.0) * F.col("n").cast("double")) - F.lit(0.05))
    growth = F.exp(F.sum(F.log(F.lit(1.0) + ret)).over(running()))
    closes = daily.withColumn(
        "close_cents", F.floor(F.lit(float(base_cents)) * growth + F.lit(0.5)).cast("long"))
    cents = closes.withColumn(
        "open_cents", F.coalesce(F.lag("close_cents").over(w), F.col("close_cents")))
    return cents.select(
        "symbol", "date",
        (F.col("open_cents") / F.lit(100.0)).alias("open"),
        (F.expr("(greatest(open_cents, close_cents) * (400 + mt)) div 400") / F.lit(100.0)).alias("high"),
        (F.expr("(least(open_cents, close_cents) * (400 - mt)) div 400") / F.lit(100.0)).alias("low"),
        (F.col("close_cents") / F.lit(100.0)).alias("close"),
        "volume",
    )


def bars_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bars(symbol, date, open, high, low, close, volume) over the whole history."""
    return price_path(daily_ticks_agg(spark, sf_dir))
