"""Trained models kept in the shared checkpoint folder: a model that is there already is read, not trained again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from barforge.operators.boosting import Boosted
from barforge.plans.storage import _key_path


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored_models(spark: SparkSession, kind: str, key: tuple, jobs: dict, train: Callable[[dict], dict[str, Boosted]]) -> dict[str, Boosted]:
    """The models named by ``jobs``; ``train`` gets the jobs of those that are not stored yet."""
    paths = {name: _key_path(spark, f"{kind}-{name}", key) for name in jobs}
    missing = {name: job for name, job in jobs.items() if not exists(spark, paths[name])}
    for name, model in (train(missing) if missing else {}).items():
        model.save(spark, paths[name])
    return {name: Boosted.load(spark, path) for name, path in paths.items()}
