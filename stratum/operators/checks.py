"""Gates and checks over tables and file sets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_gate(tables: Mapping[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """(table, rows, ok) for every table; ok = rows >= min_rows.

    One count job per table, returned as a small DataFrame (one row per
    table) rather than driver-side counters."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("ok", F.col("rows") >= min_rows)


def manifest_check(files: DataFrame, expected: DataFrame, name_col: str = "name",
                   suffix: str | None = None) -> DataFrame:
    """Files present (by suffix) with total size, and expected names not
    present -> (name, state, size). ``files`` needs ``name`` and ``length``."""
    f = files if suffix is None else files.filter(F.col(name_col).endswith(suffix))
    present = f.select(F.col(name_col).alias("name"), F.col("length").alias("size"),
                       F.lit("present").alias("state"))
    missing = expected.select(F.col(name_col).alias("name")).join(present.select("name"), "name", "left_anti") \
        .select("name", F.lit(None).cast("bigint").alias("size"), F.lit("missing").alias("state"))
    return present.unionByName(missing)
