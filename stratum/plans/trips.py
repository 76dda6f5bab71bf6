"""Trip scoring reports (the SQL report catalogue over the model functions).

Model outputs are computed once in an inner projection (``with_predictions``)
and reused by name, instead of repeating the function call per column.
Averages of money / distance columns are taken over DECIMAL(18,4) so the
rounded result is exact and does not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions import scalars as S
from stratum.operators import aggregate as A
from stratum.operators import models as Mo


def mean(col, scale: int = 2) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.avg(c.cast("decimal(18,4)")), scale).cast("double")


def scored(trips: DataFrame) -> DataFrame:
    """Both models' outputs (fits the tip thresholds)."""
    return Mo.with_predictions(trips)


def fared(trips: DataFrame) -> DataFrame:
    """The fare model's output alone."""
    return Mo.with_fares(trips)


def trip_totals(trips: DataFrame) -> DataFrame:
    """D3: one-row global aggregate."""
    return trips.agg(F.count(F.lit(1)).alias("total_trips"), mean("trip_distance").alias("avg_distance"),
                     mean("actual_fare").alias("avg_fare"))


def fares_for_all(trips: DataFrame) -> DataFrame:
    """Every trip with period, day name, prediction and error."""
    s = fared(trips)
    return s.select("trip_id", "trip_distance", "passenger_count",
                    S.time_period("hour_of_day").alias("time_period"), S.day_name("day_of_week").alias("day_name"),
                    "actual_fare", F.round("predicted_fare", 2).alias("predicted_fare"),
                    F.round(F.col("actual_fare") - F.col("predicted_fare"), 2).alias("prediction_error")
                    ).orderBy("trip_id")


def tip_class_for_all(trips: DataFrame) -> DataFrame:
    """Every trip with rush / day labels and predicted tip class."""
    s = scored(trips)
    return s.select("trip_id", "actual_fare", "trip_distance", "passenger_count",
                    S.flag_label("is_rush_hour", "Rush Hour", "Non-Rush").alias("rush_status"),
                    S.flag_label("is_weekend", "Weekend", "Weekday").alias("day_type"),
                    "predicted_tip_category").orderBy(F.col("actual_fare").desc(), "trip_id")


def fares_by_period(trips: DataFrame) -> DataFrame:
    """Group by the long time-period label, ordered by predicted fare."""
    s = fared(trips)
    return (s.groupBy(S.time_period("hour_of_day", long=True).alias("time_period"))
            .agg(F.count(F.lit(1)).alias("trip_count"), mean("trip_distance").alias("avg_distance_miles"),
                 mean("actual_fare").alias("avg_actual_fare"), mean("predicted_fare").alias("avg_predicted_fare"))
            .orderBy(F.col("avg_predicted_fare").desc()))


def tips_by_day_type(trips: DataFrame) -> DataFrame:
    """Day type x predicted tip class."""
    s = scored(trips)
    return (s.groupBy(S.flag_label("is_weekend", "Weekend", "Weekday").alias("day_type"),
                      F.col("predicted_tip_category").alias("tip_category"))
            .agg(F.count(F.lit(1)).alias("trip_count"), mean("actual_fare").alias("avg_fare"))
            .orderBy("day_type", "tip_category"))


def rush_hour_impact(trips: DataFrame) -> DataFrame:
    """Per rush status, averages and mean signed error."""
    s = fared(trips)
    return (s.groupBy(S.flag_label("is_rush_hour", "Rush Hour", "Non-Rush Hour").alias("rush_status"))
            .agg(F.count(F.lit(1)).alias("trip_count"), mean("trip_distance").alias("avg_distance"),
                 mean("actual_fare").alias("avg_actual_fare"), mean("predicted_fare").alias("avg_predicted_fare"),
                 mean(F.col("predicted_fare") - F.col("actual_fare")).alias("avg_prediction_error"))
            .orderBy("rush_status"))


def accuracy_metrics(trips: DataFrame) -> DataFrame:
    """MAE, RMSE, min / max prediction over all trips."""
    s = fared(trips)
    e = F.col("actual_fare") - F.col("predicted_fare")
    return s.agg(F.count(F.lit(1)).alias("total_trips"), mean(F.abs(e)).alias("mean_absolute_error"),
                 F.round(F.sqrt(F.avg(F.pow(e.cast("decimal(18,4)"), 2))), 2).alias("root_mean_squared_error"),
                 F.round(F.min("predicted_fare"), 2).alias("min_predicted_fare"),
                 F.round(F.max("predicted_fare"), 2).alias("max_predicted_fare"))


def largest_errors(trips: DataFrame, k: int = 5) -> DataFrame:
    """Top-k trips by absolute error (ties by trip id)."""
    s = fared(trips)
    out = s.select("trip_id", "trip_distance", "passenger_count", "actual_fare",
                   F.round("predicted_fare", 2).alias("predicted_fare"),
                   S.abs_error("actual_fare", "predicted_fare").alias("absolute_error"),
                   F.round((F.col("actual_fare") - F.col("predicted_fare")) / F.nullif(F.col("actual_fare"), F.lit(0.0))
                           * 100, 2).alias("error_percentage"))
    return out.orderBy(F.col("absolute_error").desc(), "trip_id").limit(k)


def per_mile_by_passengers(trips: DataFrame) -> DataFrame:
    """Ratio of averages (fare per mile) per passenger count."""
    s = fared(trips)
    d = F.avg(F.col("trip_distance").cast("decimal(18,4)"))
    return (s.groupBy("passenger_count")
            .agg(F.count(F.lit(1)).alias("trip_count"), mean("trip_distance").alias("avg_distance"),
                 mean("actual_fare").alias("avg_actual_fare"), mean("predicted_fare").alias("avg_predicted_fare"),
                 F.round(F.avg(F.col("actual_fare").cast("decimal(18,4)")) / F.nullif(d, F.lit(0)), 2)
                 .cast("double").alias("actual_fare_per_mile"),
                 F.round(F.avg(F.col("predicted_fare").cast("decimal(18,4)")) / F.nullif(d, F.lit(0)), 2)
                 .cast("double").alias("predicted_fare_per_mile"))
            .orderBy("passenger_count"))


def daily_summary(trips: DataFrame) -> DataFrame:
    """Per weekday."""
    s = fared(trips)
    return (s.groupBy("day_of_week")
            .agg(F.count(F.lit(1)).alias("trips"), mean("trip_distance", 1).alias("avg_miles"),
                 mean("actual_fare").alias("avg_actual"), mean("predicted_fare").alias("avg_predicted"))
            .withColumn("day_name", S.day_name("day_of_week")).orderBy("day_of_week"))


def tip_distribution(trips: DataFrame) -> DataFrame:
    """Predicted tip class counts and share of all trips (1 decimal)."""
    s = scored(trips).withColumnRenamed("predicted_tip_category", "tip_category")
    return (A.share_of_total(s, "tip_category", 1)
            .withColumnRenamed("count", "trip_count").withColumnRenamed("pct", "percentage")
            .orderBy(F.col("trip_count").desc(), "tip_category"))


def hourly_trend(trips: DataFrame) -> DataFrame:
    """Per hour with rush period label."""
    s = fared(trips)
    h = F.col("hour_of_day")
    period = F.when(h.between(7, 9), "Morning Rush").when(h.between(17, 19), "Evening Rush").otherwise("Normal")
    return (s.groupBy("hour_of_day").agg(F.count(F.lit(1)).alias("trips"),
                                         mean("predicted_fare").alias("avg_predicted_fare"))
            .withColumn("period_type", period).orderBy("hour_of_day"))


def real_trips_scored(trips: DataFrame) -> DataFrame:
    """Features derived from the pickup timestamp, invalid
    trips filtered first, then both models."""
    t = trips.filter((F.col("trip_distance") > 0) & (F.col("fare_amount") > 0) & F.col("pickup_ts").isNotNull())
    hour = S.hour_of("pickup_ts")
    feats = t.select("trip_id", "pickup_ts", "trip_distance", F.coalesce("passenger_count", F.lit(1)).alias("passenger_count"),
                     F.col("fare_amount").alias("actual_fare"), "tip_amount",
                     hour.alias("hour_of_day"), S.weekday_of("pickup_ts").alias("day_of_week"),
                     S.is_rush_hour(hour).alias("is_rush_hour"),
                     S.is_weekend(S.weekday_of("pickup_ts")).alias("is_weekend"))
    th = Mo.tip_thresholds(trips)
    s = Mo.with_predictions(feats, th)
    return s.select("trip_id", "pickup_ts", "trip_distance", "passenger_count", "actual_fare",
                    F.round("predicted_fare", 2).alias("predicted_fare"), "predicted_tip_category")


def filter_then_score(trips: DataFrame) -> DataFrame:
    """Filter on stored columns first, then score the survivors."""
    t = S.valid_trips(trips).filter((F.col("trip_distance") > 5.0) & (F.col("is_rush_hour") == 1))
    return t.select("trip_id", "trip_distance", Mo.fare_rule("trip_distance", rush="is_rush_hour").alias("predicted_fare"))


def error_by_rush(trips: DataFrame) -> DataFrame:
    """Two-step CTE shape: errors per trip, then per period."""
    s = fared(trips)
    e = s.select("is_rush_hour", S.abs_error("actual_fare", "predicted_fare", None).alias("absolute_error"),
                 ((F.col("actual_fare") - F.col("predicted_fare")) / F.nullif(F.col("actual_fare"), F.lit(0.0)) * 100)
                 .alias("error_percentage"))
    return (e.groupBy(S.flag_label("is_rush_hour", "Rush Hour", "Normal").alias("period"))
            .agg(F.count(F.lit(1)).alias("trips"), mean("absolute_error").alias("avg_error"),
                 mean("error_percentage").alias("avg_error_pct")).orderBy("period"))


def tip_distribution_averages(trips: DataFrame) -> DataFrame:
    """Per predicted class, counts and average fare / distance / tip."""
    s = scored(trips)
    return (s.groupBy(F.col("predicted_tip_category").alias("tip_category"))
            .agg(F.count(F.lit(1)).alias("trip_count"), mean("actual_fare").alias("avg_fare"),
                 mean("trip_distance").alias("avg_distance"), mean("tip_amount").alias("avg_tip"))
            .orderBy("tip_category"))


def typical_class(trips: DataFrame) -> DataFrame:
    """Day type x rush status, then the model applied to the group's
    typical (average) trip."""
    th = Mo.tip_thresholds(trips)
    g = (trips.groupBy(S.flag_label("is_weekend", "Weekend", "Weekday").alias("day_type"),
                       S.flag_label("is_rush_hour", "Rush Hour", "Normal").alias("rush_status"))
         .agg(F.count(F.lit(1)).alias("trips"), mean("actual_fare").alias("avg_fare"),
              mean("trip_distance").alias("avg_distance")))
    g = g.crossJoin(F.broadcast(th))  # one row
    return g.select("day_type", "rush_status", "trips", "avg_fare", "avg_distance",
                    Mo.tip_rule("avg_fare", F.col("q33"), F.col("q67")).alias("typical_tip_category")) \
        .orderBy("day_type", "rush_status")


def high_predicted_fares(trips: DataFrame, threshold: float = 30.0) -> DataFrame:
    """Filter on a model output column."""
    s = fared(trips)
    return s.filter(F.col("predicted_fare") > threshold).select(
        "trip_id", "trip_distance", "actual_fare", F.round("predicted_fare", 2).alias("predicted_fare"))


def tip_analysis(trips: DataFrame) -> DataFrame:
    """Dict-style aggregation over the predicted class, renamed."""
    s = scored(trips)
    return A.agg_named(s, ["predicted_tip_category"], {"trip_id": "count", "actual_fare": "max"},
                       {"trip_id": "trip_count", "actual_fare": "max_fare"})


def top_trips_by_fare(trips: DataFrame, k: int = 10) -> DataFrame:
    """the k highest fares (ties by trip id)."""
    return trips.select("trip_id", "trip_distance", "fare_amount").orderBy(
        F.col("fare_amount").desc(), "trip_id").limit(k)
