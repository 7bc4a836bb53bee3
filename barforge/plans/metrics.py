"""Counts gathered while a layer is written (``DataFrame.observe``), stored next to it, read back by the health report.

A task that is run again after an executor was lost may count its rows twice, so a stored count is believed only
if it agrees with what the files say for free (the Parquet footers' row count); otherwise the caller counts again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

SUFFIX = "_metrics"
#: values of the ``by`` column that are counted apart; a layer with more of them has no stored counts by value
TRACKED = 10_000
SCHEMA = ("row_count long, latest_date date, duplicate_keys long, null_keys long, rows_by array<struct<item:string,n:long>>, "
          "source_by array<struct<item:string,n:long>>")


def _by(column: str):
    return F.expr(f"approx_top_k(CAST(`{column}` AS STRING), {TRACKED}, {TRACKED})").alias("by")


class LayerWatch:
    """Watches one write: ``source`` wraps what is read, ``output`` what is written, ``store`` keeps the counts."""

    def __init__(self, keys: list[str], date_col: str, by: str) -> None:
        self.keys, self.date_col, self.by = keys, date_col, by
        self._source: Observation | None = None
        self._output = Observation()

    def source(self, df: DataFrame) -> DataFrame:
        self._source = Observation()
        return df.observe(self._source, F.count(F.lit(1)).alias("n"), _by(self.by))

    def output(self, df: DataFrame) -> DataFrame:
        """Rows after the first of a key count as duplicates; a layer made by windows over ``keys`` or less needs no exchange for it."""
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        again = (F.row_number().over(Window.partitionBy(*self.keys).orderBy(self.keys[0])) > 1).cast("long")
        return df.withColumn("_again", again).observe(
            self._output, F.count(F.lit(1)).alias("row_count"), F.max(F.col(self.date_col).cast("date")).alias("latest_date"),
            F.coalesce(F.sum("_again"), F.lit(0)).alias("duplicate_keys"), F.coalesce(F.sum(no_key.cast("long")), F.lit(0)).alias("null_keys"),
            _by(self.by)).drop("_again")

    def store(self, spark: SparkSession, path: str) -> None:
        out = self._output.get
        source = self._source.get if self._source else {}

        def pairs(found: dict, total: int | None) -> list | None:
            by = [(r["item"], r["count"]) for r in found.get("by") or []]
            return by if total is not None and sum(n for _, n in by) == total and len(by) < TRACKED else None

        row = (out["row_count"], out["latest_date"], out["duplicate_keys"], out["null_keys"], pairs(out, out["row_count"]), pairs(source, source.get("n")))
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").parquet(path + SUFFIX)


def stored_metrics(spark: SparkSession, path: str, layer: DataFrame) -> dict | None:
    """The counts stored with the layer at ``path``, if there are any and the files' own row count agrees."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}{SUFFIX}/_SUCCESS")
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    row = spark.read.schema(SCHEMA).parquet(path + SUFFIX).first()
    return row.asDict(recursive=True) if row and row["row_count"] == layer.count() else None
