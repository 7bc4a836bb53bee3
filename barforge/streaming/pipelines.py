"""Structured Streaming pipelines.

All four read a file source (Parquet or JSON lines) and run with
``trigger(availableNow=True)``: every file present is processed in
micro-batches, state is checkpointed in the shared checkpoint folder, and
the query stops (``files_per_trigger`` sizes the micro-batches; tests use 1
so that state is carried across several batches).

Sinks are written under the batch's id, so a batch that is replayed after an
executor or driver loss writes the same files again.  Tables whose rows may
be corrected later (T1's bars, T3's features) keep every version under its
batch id; ``newest`` reads each key's last one.  What a batch writes follows
the batch, not the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from barforge.sources.bronze import KEY, append_new, one_per_key
from barforge.sources.files import CORRUPT, QUOTE_SCHEMA


def _ticks(stream: DataFrame) -> DataFrame:
    # withWatermark rejects TIMESTAMP_NTZ: event time becomes TIMESTAMP (UTC session)
    return stream.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"),
                         F.col("value").alias("price"), F.lit(1).cast("long").alias("size"),
                         F.col("event_id").alias("tick_id"))


def _run(writer):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def newest(table: DataFrame, keys: list[str]) -> DataFrame:
    """Each key's row of the last batch that wrote it (``batch_id`` dropped); a partially aggregated maximum."""
    others = [c for c in table.columns if c not in (*keys, "batch_id")]
    last = table.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_r"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in table.columns if c != "batch_id"])


def upsert_bars(bars: DataFrame, batch_id: int, out_dir: str) -> None:
    """Changed bars of one batch into their date partitions, under the batch's id: a replay overwrites what it wrote."""
    (bars.withColumn("bar_date", F.to_date("bar_start")).withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bar_date", "batch_id").parquet(out_dir))


def read_bars(spark: SparkSession, out_dir: str) -> DataFrame:
    """The bars as they stand: the newest version of every (symbol, bar_start)."""
    return newest(spark.read.parquet(out_dir).drop("bar_date"), ["symbol", "bar_start"])


def stream_ticks_to_bars(spark: SparkSession, source_dir: str, schema: StructType, out_dir: str, checkpoint: str,
                         interval: str = "1 hour", watermark: str = "1 day", mode: str = "update",
                         files_per_trigger: int = 1) -> DataFrame:
    """Tick files -> tumbling OHLCV bars per symbol.

    ``update`` writes the windows that a batch changed, a late tick (within
    the watermark) corrects its bar; ``append`` emits a window once the
    watermark has passed its end.
    """
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    t = _ticks(s).withWatermark("ts", watermark)
    order = F.struct("ts", "tick_id")
    bars = t.groupBy("symbol", F.window("ts", interval).alias("w")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", order).alias("close"), F.sum("size").alias("volume"))
    out = bars.select("symbol", F.col("w.start").cast("timestamp_ntz").alias("bar_start"),
                      "open", "high", "low", "close", "volume")
    if mode == "update":
        w = out.writeStream.outputMode("update").foreachBatch(lambda df, batch_id: upsert_bars(df, batch_id, out_dir))
    else:
        w = out.writeStream.outputMode("append").format("parquet").option("path", out_dir)
    _run(w.option("checkpointLocation", checkpoint))
    return read_bars(spark, out_dir) if mode == "update" else spark.read.parquet(out_dir)


def stream_dedupe(spark: SparkSession, source_dir: str, schema: StructType, out_dir: str, checkpoint: str,
                  keys=("symbol", "ts", "tick_id"), watermark: str = "1 day", files_per_trigger: int = 1) -> DataFrame:
    """Drop re-delivered ticks (same symbol, event time and id) within the watermark."""
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    t = _ticks(s).withWatermark("ts", watermark).dropDuplicatesWithinWatermark(list(keys))
    out = t.select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), "price", "tick_id")
    _run(out.writeStream.outputMode("append").format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint))
    return spark.read.parquet(out_dir)


#: bars per symbol that the features of a new bar look back on: 60 rows, and one for the differences
TAIL = 61


def _last_version(spark: SparkSession, path: str, before: int) -> int | None:
    """Largest n < ``before`` whose folder ``version=n`` was written completely."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    found = [f.getPath() for f in fs.listStatus(folder)]
    numbers = [int(p.getName().split("=")[1]) for p in found
               if p.getName().startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max((n for n in numbers if n < before), default=None)


def carry_streak(feats: DataFrame, tails: DataFrame) -> DataFrame:
    """Correct the volume streak of features that were computed from a tail: a streak that is as old as the tail goes on from
    the streak stored with the tail's first bar."""
    first = tails.where("volume_incr_streak IS NOT NULL").groupBy("symbol").agg(F.min_by("volume_incr_streak", "date").alias("_before"))
    rows = feats.join(first, "symbol", "left").withColumn("_n", F.row_number().over(Window.partitionBy("symbol").orderBy("date")) - 1)
    whole = F.col("volume_incr_streak") == F.col("_n")
    return rows.withColumn("volume_incr_streak", F.when(whole, F.col("volume_incr_streak") + F.coalesce("_before", F.lit(0)))
                           .otherwise(F.col("volume_incr_streak")).cast("long")).select(*feats.columns)


def stream_bronze_to_silver(spark: SparkSession, source_dir: str, schema: StructType, bronze_dir: str, silver_dir: str, checkpoint: str,
                            build_features: Callable[[DataFrame], DataFrame], files_per_trigger: int = 1, tail: int = TAIL) -> DataFrame:
    """Bars arrive in micro-batches; bronze gets the new (symbol, date) keys, silver their features.

    Carried state: the last ``tail`` bars of every symbol with their volume streak, one version of the table per batch, made from
    the version before, so that a replayed batch finds what its first run found.  A symbol whose bars are all
    newer than its state costs its tail and its new bars: the features of the new rows, and the last old row's again, whose
    next-day return is known only now.  Only a symbol with a bar at or before its last date (a gap filled late, or
    a re-delivery) is computed again from its whole bronze history.
    """
    tails_dir = f"{silver_dir}_tails"
    columns = [f.name for f in schema.fields]
    stored = StructType([*schema.fields, StructField("batch_id", LongType())])

    def upsert(batch: DataFrame, n: int) -> None:
        held = batch.select(*columns).persist()
        at = _last_version(spark, tails_dir, n)
        empty = spark.createDataFrame([], schema).withColumn("volume_incr_streak", F.lit(None).cast("long"))
        tails = empty if at is None else spark.read.schema(empty.schema).parquet(f"{tails_dir}/version={at}")
        last = tails.groupBy("symbol").agg(F.max("date").alias("_last"))
        rows = one_per_key(held).join(last, "symbol", "left").withColumn("_late", F.coalesce(F.col("date") <= F.col("_last"), F.lit(False))).persist()
        try:
            touched = rows.groupBy("symbol").agg(F.max("_late").alias("_late"), F.max("_last").alias("_last"))
            late = touched.where("_late").select("symbol")
            ahead = touched.where("NOT _late").select("symbol", "_last")
            new = rows.join(ahead.select("symbol"), "symbol", "left_semi").select(*columns)
            input_rows = tails.select(*columns).join(ahead.select("symbol"), "symbol", "left_semi").unionByName(new)
            # a batch and its tails: small, used by the silver rows and by the next state
            feats = carry_streak(build_features(input_rows), tails).join(ahead, "symbol", "left").persist()
            out = feats.where("_last IS NULL OR date >= _last").drop("_last")
            state = input_rows.join(feats.select("symbol", "date", "volume_incr_streak"), KEY, "left")
            if not late.isEmpty():
                # earlier batches only: what this batch itself wrote in an earlier try is not history
                history = (spark.read.schema(stored).parquet(bronze_dir)
                           .where(F.col("batch_id") < n).select(*columns).join(late, "symbol", "left_semi"))
                more = append_new(history, rows.join(late, "symbol", "left_semi").select(*columns)).select(*columns)
                whole = history.unionByName(more)
                again = build_features(whole)
                new, out = new.unionByName(more), out.unionByName(again)
                state = state.unionByName(whole.join(again.select("symbol", "date", "volume_incr_streak"), KEY, "left"))
            new.write.mode("overwrite").parquet(f"{bronze_dir}/batch_id={n}")
            out.write.mode("overwrite").parquet(f"{silver_dir}/batch_id={n}")
            place = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("date")))
            state = state.withColumn("_p", place).where(F.col("_p") <= tail).drop("_p")
            kept = tails.join(touched.select("symbol"), "symbol", "left_anti")
            state.unionByName(kept).write.mode("overwrite").parquet(f"{tails_dir}/version={n}")
            feats.unpersist()
        finally:
            rows.unpersist()
            held.unpersist()

    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    _run(s.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint))
    return newest(spark.read.parquet(silver_dir), KEY)


def stream_bad_rows(spark: SparkSession, source_dir: str, good_dir: str, quarantine_dir: str,
                    checkpoint: str, files_per_trigger: int = 1) -> tuple[DataFrame, DataFrame]:
    """T4: JSON quote lines; parsable rows go to bronze, malformed lines to a quarantine table."""
    schema = StructType(QUOTE_SCHEMA.fields + [StructField(CORRUPT, StringType())])

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            # one folder per batch id, overwritten: a replayed batch cannot duplicate rows
            batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT).write.mode("overwrite").parquet(
                f"{good_dir}/batch_id={batch_id}")
            (batch.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw_line"))
             .write.mode("overwrite").parquet(f"{quarantine_dir}/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    s = (spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
         .option("maxFilesPerTrigger", files_per_trigger).json(source_dir))
    _run(s.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint))
    return spark.read.parquet(good_dir), spark.read.parquet(quarantine_dir)
