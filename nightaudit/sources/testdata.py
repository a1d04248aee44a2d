"""Readers for the driver's TPC-H-like parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Plain parquet scan; projections and filters written downstream are
    pushed into this scan by Catalyst (ReadSchema / PushedFilters)."""
    return spark.read.parquet(table_path(sf_dir, name))
