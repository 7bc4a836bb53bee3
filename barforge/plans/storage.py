"""Materialisation in the shared checkpoint folder.

Layers (bronze bars, silver features) are written as Parquet tables under
``spark.checkpoint.dir``: the write cuts lineage, survives executor loss and
lets every gold query start from a table, as the medallion design intends.
The folder is read from the session; only when it is unset (tests, a laptop)
do we choose one ourselves.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_MEMO: dict[tuple, str] = {}
_FRAMES: dict[tuple, DataFrame] = {}


def session_key(spark: SparkSession) -> tuple:
    """(application, JVM session) identity: cached DataFrames belong to one session."""
    return (spark.sparkContext.applicationId, spark._jsparkSession.hashCode())


def checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        # Only where the cluster named no shared folder, and only where one machine is the cluster (tests, a laptop).
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="barforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def _key_path(spark: SparkSession, layer: str, key: tuple) -> str:
    digest = hashlib.sha1(repr((spark.sparkContext.applicationId,) + key).encode()).hexdigest()[:16]
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{layer}-{digest}")


def materialize(spark: SparkSession, layer: str, key: tuple, build, partition_by=None, watch=None, arrange=None) -> DataFrame:
    """Write ``build()`` once per (session, layer, key) and read it back.

    ``watch`` (a ``LayerWatch``) counts what is written, ``arrange`` orders the rows for the files after that.
    """
    memo_key = (spark.sparkContext.applicationId, layer, key)
    frame_key = session_key(spark) + (layer, key)
    if frame_key in _FRAMES:
        # same DataFrame object: no repeated file listing / partition discovery
        return _FRAMES[frame_key]
    path = _MEMO.get(memo_key)
    if path is None:
        path = _key_path(spark, layer, key)
        df = build()
        df = watch.output(df) if watch else df
        w = (arrange(df) if arrange else df).write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        if watch:
            watch.store(spark, path)
        _MEMO[memo_key] = path
    df = spark.read.parquet(path)
    _FRAMES[frame_key] = df
    return df


def layer_path(spark: SparkSession, layer: str, key: tuple) -> str:
    """Where ``materialize`` keeps a layer."""
    return _key_path(spark, layer, key)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint dir for file-format round trips."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{spark.sparkContext.applicationId}")
