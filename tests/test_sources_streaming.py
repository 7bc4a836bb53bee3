"""Source, sink and streaming behaviour beyond row equality."""
import os

from pyspark.sql import functions as F

from barforge.plans import catalog as C
from barforge.plans.silver import bronze_bars
from barforge.sources import bronze as SB
from barforge.sources import files as SF
from barforge.streaming import pipelines as T


def test_csv_skips_underscore_files(spark, sf):
    path = C._fresh(spark, "csvtest")
    b = bronze_bars(spark, sf)
    SF.write_bars_csv(b, path)
    SF.write_bars_csv(b, os.path.join(path, "_combined"))
    assert SF.read_bars_csv(spark, path).count() == b.count()


def test_dedupe_keeps_newest(spark, sf):
    b = bronze_bars(spark, sf).limit(50)
    old = b.select("*", F.lit(1).alias("_load"), F.lit("2001-01-01 00:00:00").cast("timestamp").alias("_inserted_at"))
    new = b.select("*", F.lit(2).alias("_load"), F.lit("2001-06-01 00:00:00").cast("timestamp").alias("_inserted_at"))
    d = SB.dedupe_bars(old.unionByName(new).unionByName(old))
    assert d.count() == 50 and d.filter(F.col("_load") != 2).count() == 0


def test_append_is_idempotent(spark, sf):
    b = bronze_bars(spark, sf)
    path = C._fresh(spark, "appendtest")
    b.limit(100).write.mode("overwrite").parquet(path)
    SB.append_to_table(path, b, spark)
    SB.append_to_table(path, b, spark)          # a replayed batch adds nothing
    assert spark.read.parquet(path).count() == b.count()


def test_bad_rows_quarantined(spark, sf):
    b = SF.with_payload(bronze_bars(spark, sf))
    src = C._fresh(spark, "badsrc")
    js = F.to_json(F.struct("symbol", "open", "high", "low", "close", "volume",
                            F.col("date").cast("timestamp").alias("timestamp"), "_raw_json"))
    line = F.when(F.dayofmonth("date") == 31, F.expr("substring(_js, 1, length(_js) - 7)")).otherwise(F.col("_js"))
    b.select("date", js.alias("_js")).select(line.alias("value")).write.mode("overwrite").text(src)
    good, bad = T.stream_bad_rows(spark, src, C._fresh(spark, "g"), C._fresh(spark, "q"), C._fresh(spark, "c"))
    n31 = b.filter(F.dayofmonth("date") == 31).count()
    assert bad.count() == n31 > 0
    assert good.count() == b.count() - n31


def test_stream_equals_batch_resample(spark, sf):
    s = C.q_stream_ticks_to_bars(spark, sf)
    bt = C.q_bars_resample_ticks_1h(spark, sf)
    cols = ["symbol", "bar_start", "open", "high", "low", "close", "volume"]
    assert sorted(map(tuple, s.select(*cols).collect())) == sorted(map(tuple, bt.select(*cols).collect()))


def test_persona_default_for_unknown(spark, sf):
    lb = spark.createDataFrame([("99_unknown", 1), ("1_momentum", 2)], "entrant_name string, week_rank int")
    out = {r["entrant_name"]: r for r in SB.persona_join(lb, SB.persona_dim(spark)).collect()}
    assert out["99_unknown"]["persona_emoji"] == SB.DEFAULT_PERSONA["emoji"]
    assert out["1_momentum"]["persona_name"] == "Momentum"
