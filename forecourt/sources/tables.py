"""Driver-table access with explicit projection, so every scan prunes columns
and Catalyst can push filters into the Parquet reader."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# The six-column line key: (l_orderkey, l_linenumber) repeats in the driver
# data, these six columns are unique at every scale and serve as row key and
# as the final tie-breaker of every ordered window.
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice"]


def path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(path(sf_dir, name))
    return df.select(*cols) if cols else df
