"""Stages whose results are kept, so that a run that broke off goes on where it was."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import exists


def kept(spark: SparkSession, path: str, build: Callable[[], DataFrame], again: bool = False) -> DataFrame:
    """The table at ``path`` if it was written whole, else ``build()``'s result, written there and reread.

    A table counts as whole by the marker that Spark writes last; what a broken
    run left is overwritten.
    """
    if again or not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
