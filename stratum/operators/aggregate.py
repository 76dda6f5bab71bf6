"""Aggregations.

Every grouped aggregate here is algebraic (count / sum / min / max / avg /
count_if) or an exact percentile, so Spark runs a partial aggregate before
the shuffle: a key holding a third of the rows still ships one partial row
per map task. Totals needed next to per-group rows come from a one-row
aggregate joined back (a proven size bound), not from ``over ()`` windows,
which would pull every row into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.timeseries import exact_quantiles, exact_quantiles_by


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def price_profile(df: DataFrame, key: str, value: str, scale: int = 2) -> DataFrame:
    """Rows, min, max and rounded average per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("min_value"),
                               F.max(value).alias("max_value"),
                               F.round(F.avg(value), scale).alias("avg_value"))


def count_distinct(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """COUNT(DISTINCT col) (NULL not counted)."""
    return df.agg(F.count_distinct(col).alias(out))


def with_total(df: DataFrame, total: DataFrame) -> DataFrame:
    """Attach a one-row aggregate to every row (broadcast: one row)."""
    return df.crossJoin(F.broadcast(total))


def share_of_total(df: DataFrame, col: str, scale: int = 2) -> DataFrame:
    """Value, count and % of all rows (scalar-subquery total)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return (with_total(counts, total)
            .withColumn("pct", F.round(F.col("count") * 100.0 / F.col("_total"), scale)).drop("_total"))


def value_counts(df: DataFrame, col: str, scale: int = 2) -> DataFrame:
    """Value counts with their share in % (same plan as D7)."""
    return share_of_total(df, col, scale)


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column profile (count, mean, stddev, min, max) in one pass, one
    row per column (``describe`` without its string formatting)."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__stddev"), F.min(c).cast("double").alias(f"{c}__min"),
                 F.max(c).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"), F.col(f"{c}__mean").alias("mean"),
        F.col(f"{c}__stddev").alias("stddev"), F.col(f"{c}__min").alias("min"),
        F.col(f"{c}__max").alias("max")) for c in cols]))
    return wide.select(rows.alias("r")).select("r.*")


def error_metrics(df: DataFrame, actual: str, pred: str, by: Sequence[str | Column] = (),
                  scale: int | None = 2) -> DataFrame:
    """MAE, RMSE, R^2, min/max prediction, mean signed and % error.

    R^2 = 1 - SSE/SST with SST = sum(y^2) - n*mean(y)^2, all from one pass of
    algebraic sums, so it partially aggregates per group.
    """
    a, p = F.col(actual), F.col(pred)
    e = p - a
    rnd = (lambda c: F.round(c, scale)) if scale is not None else (lambda c: c)
    g = df.groupBy(*by) if by else df.groupBy()
    n = F.count(F.lit(1))
    sst = F.sum(a * a) - F.sum(a) * F.sum(a) / n
    return g.agg(
        n.alias("total_trips"),
        rnd(F.avg(F.abs(e))).alias("mean_absolute_error"),
        rnd(F.sqrt(F.avg(F.pow(e, 2)))).alias("root_mean_squared_error"),
        rnd(1 - F.sum(F.pow(e, 2)) / F.nullif(sst, F.lit(0.0))).alias("r2"),
        rnd(F.min(p)).alias("min_predicted"), rnd(F.max(p)).alias("max_predicted"),
        rnd(F.avg(e)).alias("mean_error"),
        rnd(F.avg(F.abs(e) / F.nullif(a, F.lit(0.0)) * 100)).alias("mean_pct_error"))


def agg_named(df: DataFrame, by: Sequence[str], spec: Mapping[str, str],
              names: Mapping[str, str] | None = None) -> DataFrame:
    """Dict-style aggregation ``{col: fn}`` then rename ``fn(col)`` -> name."""
    out = df.groupBy(*by).agg(dict(spec))
    for (c, fn) in spec.items():
        src = f"{fn}({c})"
        if names and c in names:
            out = out.withColumnRenamed(src, names[c])
    return out


def peer_average(df: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Per key, the mean of each metric over the rows of all *other*
    keys: (total sum - own sum) / (total count - own count), NULLs ignored.

    Per-key sums are a grouped aggregate; the totals a one-row aggregate."""
    own = df.groupBy(key).agg(*[x for m in metrics for x in (
        F.sum(m).alias(f"_own_sum_{m}"), F.count(m).alias(f"_own_cnt_{m}"))])
    tot = df.agg(*[x for m in metrics for x in (F.sum(m).alias(f"_tot_sum_{m}"), F.count(m).alias(f"_tot_cnt_{m}"))])
    j = with_total(own, tot)
    return j.select(key, *[
        ((F.col(f"_tot_sum_{m}") - F.coalesce(F.col(f"_own_sum_{m}"), F.lit(0)))
         / F.nullif(F.col(f"_tot_cnt_{m}") - F.col(f"_own_cnt_{m}"), F.lit(0))).alias(f"peer_avg_{m}") for m in metrics])


def frequency(df: DataFrame, field: str, top: int | None = None, out: str = "value") -> DataFrame:
    """Count per value, blank / NULL as 'unknown', by count desc then value."""
    v = F.coalesce(F.nullif(F.trim(F.col(field).cast("string")), F.lit("")), F.lit("unknown"))
    res = df.groupBy(v.alias(out)).agg(F.count(F.lit(1)).alias("count"))
    res = res.orderBy(F.col("count").desc(), F.col(out))
    return res.limit(top) if top else res


def class_counts(df: DataFrame, classes: Mapping[str, Column]) -> DataFrame:
    """One row of conditional counts ``{name: predicate}``."""
    return df.agg(*[F.count_if(pred).alias(name) for name, pred in classes.items()])


def quantiles(df: DataFrame, col: str, qs: Sequence[float] = (0.25, 0.5, 0.75),
              by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles (linear interpolation) and the median.

    By distributed counting, over all rows (:func:`exact_quantiles`) or per
    group (:func:`exact_quantiles_by`): no task holds a group's values."""
    names = [f"q{int(round(q * 100)):02d}" for q in qs]
    if by:
        rows = exact_quantiles_by(df, by, col, [0.5, *qs])
        return rows.select(*by, F.col("q0").alias("median"), *[F.col(f"q{i + 1}").alias(n) for i, n in enumerate(names)])
    row = exact_quantiles(df, col, [0.5, *qs])
    return row.select(F.col("q0").alias("median"), *[F.col(f"q{i + 1}").alias(n) for i, n in enumerate(names)])


def run_summary(results: DataFrame, passed: str = "passed", validated: str = "validated",
                seconds: str = "duration_s") -> DataFrame:
    """Total / passed / failed / validated / total seconds (one row); a
    result without a verdict has failed."""
    return results.agg(F.count(F.lit(1)).alias("total"),
                       F.count_if(F.col(passed)).alias("passed"),
                       (F.count(F.lit(1)) - F.count_if(F.col(passed))).alias("failed"),
                       F.count_if(F.col(validated)).alias("validated"),
                       F.round(F.sum(seconds), 3).alias("total_seconds"))


def index_status(files: DataFrame, status: str = "status") -> DataFrame:
    """Total / success / skipped / failed files (one row)."""
    s = F.col(status)
    return files.agg(F.count(F.lit(1)).alias("total_files"),
                     F.count_if(s == "success").alias("success"),
                     F.count_if(s == "skipped").alias("skipped"),
                     F.count_if(s == "failed").alias("failed"))
