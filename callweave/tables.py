"""Loading of the parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callweave.session import ship


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder ``sf_dir``. The first call of an application also sends the package to the executors."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
