"""Numbering rows in order without gathering them in one task.

Rows are range-partitioned and sorted; a row's place in its partition is written with it (the write cuts the lineage, so
the sampled range bounds can't move between the passes); the counts per partition, one row each, give the
offsets that are added back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.plans.storage import scratch_path

_PLACE_BITS = 33  # monotonically_increasing_id: partition above, place below


def number_rows(df: DataFrame, order: list, name: str = "row_number") -> DataFrame:
    """``df`` with ``name``: 1, 2, ... in the order of the columns ``order`` (which should be a total order)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"numbered-{uuid.uuid4().hex[:12]}")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    ranged.write.parquet(path)
    placed = spark.read.schema(ranged.schema).parquet(path)
    part = F.shiftright("_place", _PLACE_BITS)
    counts = sorted(map(tuple, placed.groupBy(part.alias("part")).count().collect()))  # one row per partition
    offset, offsets = 0, {}
    for p, n in counts:
        offsets[p] = offset
        offset += n
    if not offsets:
        return placed.drop("_place").withColumn(name, F.lit(None).cast("long"))
    start = F.lit([offsets.get(p, 0) for p in range(max(offsets) + 1)]).cast("array<long>")
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.withColumn(name, F.element_at(start, (part + 1).cast("int")) + place + 1).drop("_place")
