"""Window operators over keyed, ordered rows (E1-E11) and incremental loads (I4).

All windows are partitioned by a key. Where a window is followed by
``row_number() <= n``, Spark (3.5+) plans a partial ``WindowGroupLimit`` before
the shuffle, so a hot key sends at most ``n`` rows per map task across the
network; group forms (``min_by`` / ``max_by`` / ``min`` / ``max``) are used
where one row per key is enough, as they combine map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.session import written

Cols = Sequence[str | Column]


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _desc(cols: Cols) -> list[Column]:
    return [_c(x).desc() if isinstance(x, str) else x for x in cols]


def keep_latest(df: DataFrame, keys: Cols, order: Cols, rank_col: str = "_rn") -> DataFrame:
    """Keep the row with the greatest ``order`` per ``keys``.

    ``order`` columns are sorted descending (strings) or as given (Columns);
    give a total order for a deterministic pick.
    """
    w = Window.partitionBy(*[_c(k) for k in keys]).orderBy(*_desc(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def lag_return(df: DataFrame, key: Cols, order: Cols, price: str,
               out: str = "daily_return_pct", scale: int = 4) -> DataFrame:
    """``round((x - lag(x)) / nullif(lag(x), 0) * 100, scale)``; first row NULL."""
    w = Window.partitionBy(*[_c(k) for k in key]).orderBy(*[_c(o) for o in order])
    prev = F.lag(price).over(w)
    return df.withColumn(out, F.round((F.col(price) - prev) / F.nullif(prev, F.lit(0)) * 100, scale))


def moving_average(df: DataFrame, key: Cols, order: Cols, col: str, n: int | Sequence[int],
                   out: str | None = None, scale: int = 2,
                   exact_scale: int | None = None) -> DataFrame:
    """Average over ROWS n-1 PRECEDING .. CURRENT ROW, rounded to ``scale``.

    Partial frames at the start are averaged over what exists. With
    ``exact_scale`` the input is read as DECIMAL(18, exact_scale) so the mean
    and its rounding are exact (money columns), instead of binary floating
    point, whose ties round differently from engine to engine. Several ``n`` give
    a column ``sma_n`` each; exact ones share one running sum.
    """
    w = Window.partitionBy(*[_c(k) for k in key]).orderBy(*[_c(o) for o in order])
    names = {n: out or f"sma_{n}"} if isinstance(n, int) else {x: f"sma_{x}" for x in n}
    if exact_scale is None:
        for x, name in names.items():
            mean = F.avg(F.col(col)).over(w.rowsBetween(-(x - 1), Window.currentRow))
            df = df.withColumn(name, F.round(mean, scale).cast("double"))
        return df
    # exact sums allow one running sum and a difference instead of n additions a row
    v = F.col(col).cast(f"decimal(18,{exact_scale})")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns({"_sum": F.sum(v).over(running), "_cnt": F.count(v).over(running)})
    before = {f"_{c}_{x}": F.coalesce(F.lag(f"_{c}", x).over(w), F.lit(0)) for x in names for c in ("sum", "cnt")}
    df = df.withColumns(before)

    def mean(x: int) -> Column:
        total, rows = F.col("_sum") - F.col(f"_sum_{x}"), F.col("_cnt") - F.col(f"_cnt_{x}")
        return total.cast(f"decimal(28,{exact_scale})") / F.nullif(rows, F.lit(0)).cast("decimal(9,0)")
    return df.withColumns({name: F.round(mean(x), scale).cast("double") for x, name in names.items()}).drop("_sum", "_cnt", *before)


def rolling_stddev(df: DataFrame, key: Cols, order: Cols, col: str, n: int,
                   out: str | None = None, scale: int = 4) -> DataFrame:
    """Sample standard deviation over the last ``n`` rows; one value -> NULL."""
    w = (Window.partitionBy(*[_c(k) for k in key]).orderBy(*[_c(o) for o in order])
         .rowsBetween(-(n - 1), Window.currentRow))
    return df.withColumn(out or f"stddev_{n}", F.round(F.stddev_samp(col).over(w), scale))


def latest_per_key(df: DataFrame, key: Cols, order: Cols) -> DataFrame:
    """E5: latest row per key (row_number over ``order`` descending = 1)."""
    return keep_latest(df, key, order)


def year_range(df: DataFrame, key: str, date: str, value: str, as_of, days: int = 365,
               low: str = "fifty_two_week_low", high: str = "fifty_two_week_high") -> DataFrame:
    """MIN / MAX of ``value`` per key over ``date >= as_of - days``.

    The reference computes whole-partition window MIN/MAX and keeps one row;
    a grouped aggregate gives the same with partial (map-side) aggregation.
    """
    return (df.filter(F.col(date) >= F.date_sub(F.lit(as_of).cast("date"), days))
            .groupBy(key).agg(F.min(value).alias(low), F.max(value).alias(high)))


def period_prices(df: DataFrame, key: str, date: str, value: str, as_of, days: int = 365,
                  strict: bool = False) -> DataFrame:
    """Period-start and year-ago prices per key.

    ``strict=True`` reproduces the reference: year_start_price is the first
    price of the trailing ``days`` slice and one_year_ago_price the *latest*
    price (FIRST_VALUE over a descending order). The default is the corrected
    reading: year_start_price is the first price of ``as_of``'s calendar year
    and one_year_ago_price the first price of the trailing slice.
    """
    as_of_d = F.lit(as_of).cast("date")
    since = F.date_sub(as_of_d, days)
    sliced = df.filter(F.col(date) >= since)
    if strict:
        return sliced.groupBy(key).agg(
            F.min_by(value, date).alias("year_start_price"),
            F.max_by(value, date).alias("one_year_ago_price"))
    in_year = F.col(date) >= F.trunc(as_of_d, "year")
    return sliced.groupBy(key).agg(
        F.min_by(F.when(in_year, F.col(value)), F.when(in_year, F.col(date))).alias("year_start_price"),
        F.min_by(value, date).alias("one_year_ago_price"))


def top_n_per_key(df: DataFrame, key: Cols, order: Cols, n: int, rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per key under ``order`` (descending for names)."""
    name = rank_col or "_rn"
    w = Window.partitionBy(*[_c(k) for k in key]).orderBy(*_desc(order))
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def rank_peers(df: DataFrame, orderings: dict[str, Column]) -> DataFrame:
    """RANK over all rows for several orderings (e.g. growth NULLS LAST).

    ``orderings``: rank name -> (column, sort expression over that column). Per
    ordering the rows are counted by value, so that a value of very many rows is
    one; the rank is one more than the number of rows with values before it, a
    running sum over range-partitioned values and over their partitions.
    """
    for name, (value, order) in orderings.items():
        counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
        placed = written(counts.repartitionByRange(order).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id()), "ranks")
        parts = placed.groupBy("_p").agg(F.sum("_n").alias("_t"))  # one row a partition
        offsets = parts.withColumn("_off", F.coalesce(F.sum("_t").over(
            Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_off")
        inside = Window.partitionBy("_p").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        before = F.col("_off") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
        ranks = placed.join(F.broadcast(offsets), "_p").select(F.col(value).alias("_value"), (before + 1).cast("int").alias(name))
        df = df.join(ranks, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")
    return df


def rank_in_key(df: DataFrame, keys: Cols, order: Cols, out: str = "rank") -> DataFrame:
    """ROW_NUMBER inside a key; pass a tie-break column for determinism."""
    w = Window.partitionBy(*[_c(k) for k in keys]).orderBy(*[_c(o) for o in order])
    return df.withColumn(out, F.row_number().over(w))


def with_row_id(df: DataFrame, order: Cols, out: str = "row_id") -> DataFrame:
    """Dense surrogate id 1..N along a global order, without a single-task sort.

    Rows are range-partitioned and sorted by ``order`` once and written, with
    their partition and position as plain columns, to the shared folder. The
    id is the count of the partitions before plus the position; both come from
    that one table, so no second shuffle can deal the rows differently.
    """
    cols = [_c(o) for o in order]
    placed = (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
              .withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    placed = written(placed, "row-id")
    counts = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_i0"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    # One row per partition: bounded by the partition count, safe to broadcast.
    return (placed.join(F.broadcast(offsets.select("_p", "_off", "_i0")), "_p")
            .withColumn(out, (F.col("_off") + F.col("_i") - F.col("_i0") + 1).cast("bigint"))
            .drop("_p", "_i", "_off", "_i0"))


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float]) -> DataFrame:
    """One row (q0, q1, ...) of exact quantiles with linear interpolation; NULLs are left out.

    Equal values are counted first, then the distinct values are range
    partitioned and their counts cumulated per partition and over the
    partitions; the two neighbours of each quantile come from a filter on the
    cumulative count. No task holds all values.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    placed = written(counts.repartitionByRange("v").sortWithinPartitions("v").withColumn("_p", F.spark_partition_id()),
                     "quantiles")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_p").agg(F.sum("n").alias("_n"))  # one row per partition
    parts = parts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_p", "_off")
    inside = Window.partitionBy("_p").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = placed.join(F.broadcast(parts), "_p").select("v", "n", (F.col("_off") + F.sum("n").over(inside)).alias("upto"))
    total = placed.agg(F.sum("n").alias("total"))
    at = cum.crossJoin(F.broadcast(total))  # one row
    exprs = []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("total") - 1)
        for name, k in ((f"lo{i}", F.floor(pos)), (f"hi{i}", F.ceil(pos))):
            exprs.append(F.max(F.when((F.col("upto") - F.col("n") <= k) & (k < F.col("upto")), F.col("v"))).alias(name))
        exprs.append(F.max(pos - F.floor(pos)).alias(f"f{i}"))
    row = at.agg(*exprs)
    return row.select(*[(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"f{i}")).alias(f"q{i}")
                        for i in range(len(qs))])


def exact_quantiles_by(df: DataFrame, by: Sequence[str], col: str, qs: Sequence[float]) -> DataFrame:
    """(by, q0, q1, ...): exact quantiles of every group with linear interpolation; NULLs are left out, a group of
    NULLs alone gives NULLs.

    Equal values of a group are counted first; the distinct (group, value) pairs are range partitioned together, so
    that a group that holds nearly all rows is many partitions, and cumulated within them and over them. The values
    at the quantiles' places come from a filter on the cumulative counts; no task holds all values of a group.
    """
    v = F.col(col).cast("double")
    groups = [f"_g{i}" for i in range(len(by))]
    counts = df.groupBy(*[F.col(b).alias(g) for b, g in zip(by, groups)], v.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    placed = counts.where(F.col("v").isNotNull()).repartitionByRange(*groups, "v").sortWithinPartitions(*groups, "v")
    placed = written(placed.withColumn("_p", F.spark_partition_id()), "quantiles")
    parts = placed.groupBy(*groups, "_p").agg(F.sum("n").alias("_n"))  # one row for each partition a group is in
    before = Window.partitionBy(*groups).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn(
        "total", F.sum("_n").over(Window.partitionBy(*groups)))
    inside = Window.partitionBy("_p", *groups).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups]
    upto = placed.withColumn("_in", F.sum("n").over(inside)).alias("a").join(
        parts.alias("b"), [F.col("a._p") == F.col("b._p"), *same]).select(*[F.col(f"a.{g}").alias(g) for g in groups], "v", "n",
                                                                       (F.col("_off") + F.col("_in")).alias("upto"), "total")
    exprs = []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("total") - 1)
        for name, k in ((f"lo{i}", F.floor(pos)), (f"hi{i}", F.ceil(pos))):
            exprs.append(F.max(F.when((F.col("upto") - F.col("n") <= k) & (k < F.col("upto")), F.col("v"))).alias(name))
        exprs.append(F.max(pos - F.floor(pos)).alias(f"f{i}"))

    def between(i: int) -> Column:
        lo, hi, f = F.col(f"lo{i}"), F.col(f"hi{i}"), F.col(f"f{i}")
        infinite = F.greatest(F.abs(lo), F.abs(hi)) == float("inf")
        return F.when((lo == hi) | (f == 0), lo).when(infinite, lo * (1 - f) + hi * f).otherwise(lo + (hi - lo) * f)
    found = upto.groupBy(*groups).agg(*exprs).select(*groups, *[between(i).alias(f"q{i}") for i in range(len(qs))])
    every = counts.select(*[F.col(g).alias(f"{g}_") for g in groups]).distinct()
    out = every.join(found, [F.col(f"{g}_").eqNullSafe(F.col(g)) for g in groups], "left")
    return out.select(*[F.col(f"{g}_").alias(b) for b, g in zip(by, groups)], *[f"q{i}" for i in range(len(qs))])


def high_water(df: DataFrame, key: str, date: str, out: str = "latest_date") -> DataFrame:
    """max(date) per key, kept as a DataFrame to join (never collected)."""
    return df.groupBy(key).agg(F.max(date).alias(out))


def incremental(source: DataFrame, target: DataFrame, key: str, date: str, as_of,
                new_key_days: int = 30, only_key: str | None = None, dry_run: bool = False) -> DataFrame:
    """I4: rows of ``source`` that a refresh appends to ``target``.

    Per key, rows later than the key's high-water mark in ``target``; keys
    new to ``target`` bring their last ``new_key_days`` days (date after
    as_of - new_key_days - 1); up-to-date keys bring nothing. ``only_key``
    restricts the refresh to one key. ``dry_run`` reports, per key, how many
    rows would be appended and their first and last date.
    """
    hw = high_water(target, key, date, "_hw")
    if only_key is not None:
        source = source.filter(F.col(key) == only_key)
    floor = F.date_sub(F.lit(as_of).cast("date"), new_key_days + 1)
    new = (source.join(hw, key, "left")
           .filter(F.col(date) > F.coalesce(F.col("_hw"), floor))
           .filter(F.col(date) <= F.lit(as_of).cast("date"))
           .drop("_hw"))
    return new.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.min(date).alias("first_date"),
                                F.max(date).alias("last_date")) if dry_run else new
