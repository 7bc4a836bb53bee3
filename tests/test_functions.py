"""Expression semantics the reference relies on (null-propagating clamp, safe division, Sunday weeks)."""
import datetime as dt

from pyspark.sql import functions as F

from barforge.functions.core import clamp, greatest_strict, r, safe_div, sunday_week, u01


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_clamp_propagates_null(spark):
    assert one(spark, clamp(F.lit(None).cast("double"), -1, 1)) is None
    assert one(spark, clamp(F.lit(3.0), -1, 1)) == 1.0
    assert one(spark, clamp(F.lit(-3.0), -1, 1)) == -1.0
    # Spark's own least/greatest would turn NULL into -1 (a full short)
    assert one(spark, F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.lit(None).cast("double")))) == -1.0


def test_greatest_strict(spark):
    assert one(spark, greatest_strict(F.lit(1.0), F.lit(None).cast("double"))) is None
    assert one(spark, greatest_strict(F.lit(1.0), F.lit(2.0))) == 2.0


def test_safe_div(spark):
    assert one(spark, safe_div(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, safe_div(F.lit(1), F.lit(4))) == 0.25


def test_sunday_week(spark):
    sat, sun = dt.date(2024, 3, 2), dt.date(2024, 3, 3)
    assert one(spark, sunday_week(F.lit(sat))) == dt.date(2024, 2, 25)
    assert one(spark, sunday_week(F.lit(sun))) == sun


def test_portable_round(spark):
    assert one(spark, r(F.lit(1.23456789), 4)) == 1.2346
    assert one(spark, r(F.lit(-0.00000001), 6)) == 0.0


def test_u01_range_and_determinism(spark):
    df = spark.range(1000).select(u01(7, F.col("id"), "w").alias("u"))
    lo, hi = df.agg(F.min("u"), F.max("u")).first()
    assert 0.0 <= lo < 0.01 and 0.99 < hi < 1.0
    assert df.collect() == spark.range(1000).repartition(5).orderBy("id").select(u01(7, F.col("id"), "w").alias("u")).collect()
