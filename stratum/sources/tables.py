"""Batch table reads (A3) over a folder of parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A3: one table of a folder; a catalog name when ``sf_dir`` is None."""
    if sf_dir is None:
        return spark.read.table(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``t = Tables(spark, d); t.lineitem`` -> DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)

    def register_views(self) -> None:
        """A10: expose every table as a temporary view for SQL users."""
        for n in TABLES:
            getattr(self, n).createOrReplaceTempView(n)
