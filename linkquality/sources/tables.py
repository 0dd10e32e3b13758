"""Readers for warehouse tables and the driver's test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a test-data folder (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """Full read of a silver / gold table (S4).  Column subsets are plain
    ``.select`` calls on the result; Catalyst prunes them into the scan (S5)."""
    return spark.read.format(fmt).options(**(options or {})).load(path)
