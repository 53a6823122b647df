"""Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` under ``folder``; a single file or a folder of parts."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
