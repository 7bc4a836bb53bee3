"""Bronze and silver layers as materialised tables.

``bronze_bars`` derives bars from the given tables and writes them once per
session; ``silver_features`` runs F0 over them and writes the feature table
partitioned by year-month (the reference partitions by date and clusters by
symbol; monthly folders avoid ~1,800 tiny daily folders per five years).
Gold operators read the silver table, as the reference's gold SQL does.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.operators.features import LOOKBACK_YEARS, as_date, feat_lookback_filter, features_daily
from barforge.plans.metrics import LayerWatch, stored_metrics
from barforge.plans.storage import _key_path, layer_path, materialize, session_key
from barforge.sources.bars import bars_from_tables
from barforge.sources.files import write_clustered

_AS_OF: dict[tuple, object] = {}
_SILVER: dict[tuple, DataFrame] = {}


def bronze_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(spark, "bronze_bars", (sf_dir,), lambda: bars_from_tables(spark, sf_dir), watch=LayerWatch(["symbol", "date"], "date", "symbol"))


def default_as_of(spark: SparkSession, sf_dir: str):
    """max(date) of the bars: one scalar, read from the materialised table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _AS_OF:
        _AS_OF[key] = bronze_bars(spark, sf_dir).agg(F.max("date")).first()[0]
    return _AS_OF[key]


def silver_features(spark: SparkSession, sf_dir: str, as_of=None, years: int = LOOKBACK_YEARS) -> DataFrame:
    as_of = as_date(as_of or default_as_of(spark, sf_dir))

    watch = LayerWatch(["date", "symbol"], "date", "symbol")

    def build():
        bars = watch.source(feat_lookback_filter(bronze_bars(spark, sf_dir), as_of, years))
        return features_daily(bars, as_of, years)

    def arrange(feat):
        # Cluster rows by symbol inside each month folder (the reference's
        # CLUSTER BY symbol) so Parquet min/max stats prune symbol filters.
        return (feat.withColumn("year_month", F.date_format("date", "yyyy-MM"))
                .repartition("year_month").sortWithinPartitions("symbol", "date"))

    return _silver_table(spark, sf_dir, as_of, years, build, watch, arrange).drop("year_month")


def _silver_table(spark, sf_dir, as_of, years, build=None, watch=None, arrange=None):
    key = session_key(spark) + (sf_dir, str(as_of), years)
    if key not in _SILVER:
        _SILVER[key] = materialize(spark, "silver_features", (sf_dir, str(as_of), years), build,
                                   partition_by=["year_month"], watch=watch, arrange=arrange)
    return _SILVER[key]


def bronze_metrics(spark: SparkSession, sf_dir: str) -> dict | None:
    """The counts gathered while bronze was written, if they can be believed."""
    return stored_metrics(spark, layer_path(spark, "bronze_bars", (sf_dir,)), bronze_bars(spark, sf_dir))


def silver_metrics(spark: SparkSession, sf_dir: str, as_of=None, years: int = LOOKBACK_YEARS) -> dict | None:
    """The counts gathered while silver was written, if they can be believed."""
    as_of = as_date(as_of or default_as_of(spark, sf_dir))
    layer = silver_features(spark, sf_dir, as_of, years)
    return stored_metrics(spark, layer_path(spark, "silver_features", (sf_dir, str(as_of), years)), layer)


def silver_since(spark: SparkSession, sf_dir: str, days: int, as_of=None, years: int = LOOKBACK_YEARS) -> DataFrame:
    """Silver rows of the last ``days`` before ``as_of``, with a partition filter.

    The ``year_month`` predicate prunes whole month folders at the scan
    (PartitionFilters); the ``date`` predicate keeps the exact window.
    Only for row-wise use or windows confined to the same span.
    """
    as_of = as_of or default_as_of(spark, sf_dir)
    silver_features(spark, sf_dir, as_of, years)          # make sure it exists
    start = as_date(as_of) - _dt.timedelta(days=days)
    t = _silver_table(spark, sf_dir, as_date(as_of), years)
    return t.filter((F.col("year_month") >= start.strftime("%Y-%m")) & (F.col("date") >= F.lit(start))).drop("year_month")


def silver_clustered(spark: SparkSession, sf_dir: str, as_of=None) -> DataFrame:
    """The silver table once more, bucketed by symbol and sorted by (symbol, date): windows and joins on symbol read it without
    an exchange.  One bucket per partition of the session's shuffles."""
    as_of = as_date(as_of or default_as_of(spark, sf_dir))
    key = session_key(spark) + ("clustered", sf_dir, str(as_of))
    if key not in _SILVER:
        path = _key_path(spark, "silver_clustered", key)
        name = "silver_" + path.rsplit("-", 1)[1]
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        _SILVER[key] = write_clustered(silver_features(spark, sf_dir, as_of), name, path, "symbol", ["symbol", "date"], buckets)
    return _SILVER[key]
