"""Parquet tables of one dataset folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan ``<folder>/<name>.parquet`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
