"""Joins, lateral explode and set operations.

No join here carries a broadcast hint unless its side has a proven size bound
(one-row aggregates, constant tables). Everything else is left to the
optimizer: AQE converts a sort-merge join to a broadcast join at runtime only
when the materialised side is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
which is the size check, with the shuffle join as the fallback beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_registry(df: DataFrame, reg: DataFrame, left_key: str | Column, right_key: str = "ticker") -> DataFrame:
    """Left equi join on an extracted key; unmatched rows keep NULLs."""
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    return df.join(reg, lk == reg[right_key], "left")


def score_inputs(left: DataFrame, right: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """C4: inner equi join, then an optional filter on the joined rows."""
    j = left.join(right, key, "inner")
    return j.filter(where) if where is not None else j


def cross_one(a: DataFrame, b: DataFrame, of_a: Sequence[Column], of_b: Sequence[Column]) -> DataFrame:
    """Aggregates ``of_a`` over ``a`` beside aggregates ``of_b`` over ``b``
    (e.g. a company row x peer means). Both sides are aggregated here, so
    either has one row and so has the product."""
    return a.agg(*of_a).crossJoin(F.broadcast(b.agg(*of_b)))


def missing_from(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Set difference both ways -> (side, *keys): 'missing' = in a, not b;
    'unexpected' = in b, not a."""
    ka, kb = a.select(*keys).distinct(), b.select(*keys).distinct()
    return (ka.join(kb, list(keys), "left_anti").withColumn("side", F.lit("missing"))
            .unionByName(kb.join(ka, list(keys), "left_anti").withColumn("side", F.lit("unexpected"))))


def explode_items(df: DataFrame, col: str | Column, alias: str = "item") -> DataFrame:
    """Lateral (inner) explode: rows with a NULL or empty array vanish."""
    c = F.col(col) if isinstance(col, str) else col
    return df.select("*", F.explode(c).alias(alias))


def tagged_union(parts: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """G1: UNION ALL by column name of differently sourced frames, each
    tagged with its name; missing columns become NULL."""
    frames = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def unique_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key. Without ``order`` the whole row is de-duplicated
    (DISTINCT); with it the first row under ``order`` is kept (deterministic,
    unlike dropDuplicates' arbitrary pick)."""
    if not order:
        return df.select(*keys).distinct() if list(keys) != df.columns else df.distinct()
    w = Window.partitionBy(*keys).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def enrich_lookup(left: DataFrame, lookup: DataFrame, key: str, order: str | Column,
                  fill: Mapping[str, str]) -> DataFrame:
    """Left ⟕ lookup by ``key`` where the lookup keeps its *last* entry per
    key under ``order``; each ``left_col: lookup_col`` in ``fill`` is only filled
    when the left value is NULL or blank. Lookup rows without a partner vanish."""
    o = F.col(order) if isinstance(order, str) else order
    last = lookup.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(o.desc()))) \
        .filter("_rn = 1").drop("_rn")
    ren = last.select(F.col(key).alias("_lk"), *[F.col(v).alias(f"_l_{v}") for v in fill.values()])
    j = left.join(ren, F.col(key) == F.col("_lk"), "left")
    for lc, vc in fill.items():
        cur = F.col(lc) if lc in left.columns else F.lit(None).cast("string")
        j = j.withColumn(lc, F.coalesce(F.nullif(F.trim(cur), F.lit("")), F.col(f"_l_{vc}")))
    return j.drop("_lk", *[f"_l_{v}" for v in fill.values()])


def with_details(items: DataFrame, details: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """List ⟕ detail. Matched rows take the detail fields with status
    'success'; unmatched rows keep id and name with status 'error', an error
    code and message. Items without an id are dropped."""
    d = details.select(F.col(key).alias("_dk"), *[F.col(f).alias(f"_d_{f}") for f in fields])
    j = items.filter(F.col(key).isNotNull()).join(d, F.col(key) == F.col("_dk"), "left")
    ok = F.col("_dk").isNotNull()
    out = j.withColumn("status", F.when(ok, "success").otherwise("error")) \
        .withColumn("error_code", F.when(ok, F.lit(None)).otherwise(F.lit("NOT_FOUND"))) \
        .withColumn("error_message", F.when(ok, F.lit(None)).otherwise(
            F.concat(F.lit("no detail for "), F.col(key).cast("string"))))
    for f in fields:
        out = out.withColumn(f, F.col(f"_d_{f}"))
    return out.drop("_dk", *[f"_d_{f}" for f in fields])
