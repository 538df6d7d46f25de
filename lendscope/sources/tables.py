"""Readers for the driver's Parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; Parquet gives column pruning and filter pushdown for free."""
    return spark.read.parquet(table_path(sf_dir, name))


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a table is a folder of part files rather than one file, by Spark's own file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory()
