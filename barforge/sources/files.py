"""File sources and sinks (S1-S3, S11, S13) with explicit schemas.

Schemas are always declared (never inferred): inference scans the data
twice and drifts between files.  Spark already skips files whose names
start with ``_`` or ``.``, which is exactly the reference's rule of ignoring
the combined ``_combined.csv`` next to per-symbol files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, LongType, StringType, StructField, StructType,
                               TimestampType)

BAR_CSV_SCHEMA = StructType([
    StructField("date", DateType()), StructField("symbol", StringType()),
    StructField("open", DoubleType()), StructField("high", DoubleType()), StructField("low", DoubleType()),
    StructField("close", DoubleType()), StructField("volume", LongType()),
])

QUOTE_SCHEMA = StructType([
    StructField("symbol", StringType()), StructField("open", DoubleType()), StructField("high", DoubleType()),
    StructField("low", DoubleType()), StructField("close", DoubleType()), StructField("volume", LongType()),
    StructField("timestamp", TimestampType()), StructField("_raw_json", StringType()),
])
CORRUPT = "_corrupt_record"

PAYLOAD_SCHEMA = "provider string, fetched_at string"


def write_bars_csv(bars: DataFrame, path: str) -> None:
    """One CSV part per symbol group with header ``date,symbol,open,high,low,close,volume``."""
    (bars.select("date", "symbol", "open", "high", "low", "close", "volume")
     .repartition("symbol").sortWithinPartitions("symbol", "date")
     .write.mode("overwrite").option("header", True).csv(path))


def read_bars_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with a declared schema; ``_``-prefixed files are skipped by Spark."""
    return (spark.read.schema(BAR_CSV_SCHEMA).option("header", True).option("mode", "FAILFAST")
            .option("dateFormat", "yyyy-MM-dd").csv(path))


def read_quotes_json(spark: SparkSession, path: str, keep_bad: bool = False) -> DataFrame:
    """Quote records; malformed lines are dropped (or kept with ``keep_bad``),
    fields not in the schema are ignored, the raw payload string is kept."""
    schema = StructType(QUOTE_SCHEMA.fields + [StructField(CORRUPT, StringType())])
    df = (spark.read.schema(schema).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return df if keep_bad else df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


WIDE_FIELDS = ("open", "high", "low", "close", "volume")


def bars_to_wide(bars: DataFrame, symbols: list[str] | None = None, fields=WIDE_FIELDS) -> DataFrame:
    """The download layout: one row per date, one column ``<Field>|<ticker>`` per field and ticker (``symbols``: all of them)."""
    p = bars.groupBy("date").pivot("symbol", symbols).agg(*[F.first(f).alias(f) for f in fields])
    # pivot names columns '<symbol>_<field>'
    cut = [(c, *c.rsplit("_", 1)) for c in p.columns if c != "date"]
    return p.toDF("date", *[f"{f.capitalize()}|{s}" for _, s, f in cut])


def wide_to_long(wide: DataFrame, tickers: list[str] | None = None) -> DataFrame:
    """S3: wide (field x ticker) frame to long bars; lower-case fields, tickers without data dropped.

    The tickers are those of the column names (``tickers`` narrows them; names
    without columns are left out).  One array per field and one explode over
    them side by side: the plan has one expression per column and no shuffle.
    """
    split = [c.split("|", 1) for c in wide.columns if "|" in c]
    have = {(f, t) for f, t in split}
    fields = [f for f in (x.capitalize() for x in WIDE_FIELDS) if any(f == g for g, _ in split)]
    wanted = None if tickers is None else set(tickers)
    named = [t for t in dict.fromkeys(t for _, t in split) if (wanted is None or t in wanted) and all((f, t) in have for f in fields)]
    if not named or not fields:
        types = {c: wide.schema[c].dataType.simpleString() for c in wide.columns}
        return wide.limit(0).selectExpr("date", "CAST(NULL AS string) AS symbol", *[
            f"CAST(NULL AS {next(v for c, v in types.items() if c.startswith(f + '|'))}) AS {f.lower()}" for f in fields])
    quoted = {f: ", ".join(f"`{f}|{t}`" for t in named) for f in fields}
    arrays = wide.selectExpr("date", *[f"array({quoted[f]}) AS {f.lower()}" for f in fields])
    zipped = F.arrays_zip(F.lit(named).alias("symbol"), *[F.col(f.lower()) for f in fields])
    long = arrays.select("date", F.inline(zipped))
    return long.where(F.coalesce(*[F.col(f.lower()).cast("double") for f in fields]).isNotNull()).select("date", "symbol", *[f.lower() for f in fields])


def with_payload(df: DataFrame, provider: str = "lineitem-bars") -> DataFrame:
    """Serialise (provider, fetched_at) to a JSON payload column."""
    return df.withColumn("_raw_json", F.to_json(F.struct(F.lit(provider).alias("provider"),
                                                         F.col("date").cast("string").alias("fetched_at"))))


def parse_payload(df: DataFrame) -> DataFrame:
    return df.withColumn("_payload", F.from_json("_raw_json", PAYLOAD_SCHEMA)).select(
        "*", F.col("_payload.provider").alias("provider"), F.col("_payload.fetched_at").alias("fetched_at")).drop("_payload")


def write_gold(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Rebuild a table (overwrite); dynamic partition overwrite when partitioned."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def write_clustered(df: DataFrame, table: str, path: str, by: str, sort: list[str], buckets: int) -> DataFrame:
    """S13, clustered: rows of one ``by`` value in one file, sorted; readers that group or window by it need no exchange.

    The bucket layout lives in the session's catalog under ``table``, the files at ``path``.
    """
    (df.repartition(buckets, by).sortWithinPartitions(*sort).write.mode("overwrite").bucketBy(buckets, by).sortBy(*sort)
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)
