"""Model surface (H1-H5, H11-H15): exact rule models as JVM expressions, forest
models with Spark ML (compiled to expressions in ``forests.py``), pandas
functions where a Python model must run.

The rule models are the trips' generating formulas, so they have SQL twins;
forests are trained and applied with ``pyspark.ml`` (distributed training,
``model.transform`` for scoring) and checked on rows and metric bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratum.operators.timeseries import exact_quantiles
from stratum.session import written

FEATURES = ["trip_distance", "passenger_count", "hour_of_day", "day_of_week", "is_rush_hour", "is_weekend"]
# Defaults for missing model inputs (passengers, hour, day, rush, weekend).
FARE_DEFAULTS = {"passenger_count": 1, "hour_of_day": 12, "day_of_week": 3, "is_rush_hour": 0, "is_weekend": 0}
# Tip class labels in class-id order.
TIP_LABELS = ["Low Tip", "Medium Tip", "High Tip"]
MODEL_VERSION = "1.0.0"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fare_rule(distance, passengers=None, hour=None, dow=None, rush=None, weekend=None) -> Column:
    """H1 (rule model): 2.5 + 3.5 * distance + 2 * rush, floored at 0.
    NULL inputs take the defaults (rush 0)."""
    r = F.coalesce(_c(rush), F.lit(0)) if rush is not None else F.lit(0)
    return F.greatest(F.lit(0.0), 2.5 + 3.5 * _c(distance) + 2 * r)


def tip_thresholds(trips: DataFrame, tip: str = "tip_amount") -> DataFrame:
    """B15 fit: one row (q33, q67) of exact tip quantiles; when they nearly
    coincide (< 0.01 apart) the fixed cut points 5 / 15 are used instead."""
    q = exact_quantiles(trips, tip, [0.33, 0.67]).select(F.col("q0").alias("q33"), F.col("q1").alias("q67"))
    close = F.abs(F.col("q67") - F.col("q33")) < 0.01
    return q.select(F.when(close, F.lit(5.0)).otherwise(F.col("q33")).alias("q33"),
                    F.when(close, F.lit(15.0)).otherwise(F.col("q67")).alias("q67"))


def tip_category(trips: DataFrame, tip: str = "tip_amount", out: str = "tip_category",
                 thresholds: DataFrame | None = None) -> DataFrame:
    """Right-closed bins (-inf,q33] -> 0, (q33,q67] -> 1, above -> 2; NULL -> 0."""
    th = tip_thresholds(trips, tip) if thresholds is None else thresholds
    t = F.col(tip)
    return (trips.crossJoin(F.broadcast(th))  # one row
            .withColumn(out, F.when(t.isNull() | (t <= F.col("q33")), 0)
                        .when(t <= F.col("q67"), 1).otherwise(2))
            .drop("q33", "q67"))


TIP_RATE = 0.15


def tip_rule(fare, q33: Column, q67: Column) -> Column:
    """H2 (rule model): expected tip = 15 % of fare, binned with the fitted
    thresholds -> 'Low Tip' / 'Medium Tip' / 'High Tip'."""
    exp_tip = _c(fare) * TIP_RATE
    return (F.when(exp_tip <= q33, TIP_LABELS[0]).when(exp_tip <= q67, TIP_LABELS[1])
            .otherwise(TIP_LABELS[2]))


def with_fares(trips: DataFrame) -> DataFrame:
    """The fare model's output as a column; needs no thresholds."""
    return trips.withColumn("predicted_fare", fare_rule("trip_distance", rush="is_rush_hour"))


def with_predictions(trips: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """Both models' outputs as columns, usable by later filters and groups."""
    th = thresholds if thresholds is not None else tip_thresholds(trips)
    out = with_fares(trips).crossJoin(F.broadcast(th))  # one row
    return out.withColumn("predicted_tip_category", tip_rule("actual_fare", F.col("q33"), F.col("q67"))).drop("q33", "q67")


def prediction_json(df: DataFrame) -> Column:
    """H4: fare, class, model version and the input echo as one JSON text."""
    return F.to_json(F.struct(
        F.round("predicted_fare", 2).alias("predicted_fare"),
        F.col("predicted_tip_category").alias("predicted_tip_category"),
        F.lit(MODEL_VERSION).alias("model_version"),
        F.struct(*[F.col(c) for c in ["actual_fare", *FEATURES]]).alias("input")))


def fare_batch(dists, paxs, hours) -> Column:
    """H5: array form; position i uses dists[i], paxs[i] (default 1) and
    hours[i] (default 12); weekday fixed 3, weekend 0, rush from the hour;
    results rounded to 2. NULL or empty distances -> []."""
    def one(d, i):
        h = F.coalesce(F.get(_c(hours), i), F.lit(12))
        rush = (h.between(7, 9) | h.between(17, 19)).cast("int")
        return F.round(fare_rule(d, rush=rush), 2)
    return F.coalesce(F.transform(_c(dists), one), F.array().cast("array<double>"))


# --- Spark ML forests (H3, H13-H15) ------------------------------------------------------------

def _assembler(features=FEATURES):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


SPREAD_ROWS = 50_000
# How forests are grown, not which: the node that a row has reached in each tree is kept, so a level costs the row a step in each tree
# and not a walk from the root. Ten levels need no checkpoint.
KEEP_NODES = {"cacheNodeIds": True, "checkpointInterval": -1}


def spread(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """``df`` in as many partitions as the cores take, of ``rows`` rows at least: a table of few row groups is read by few
    tasks, and training and scoring cost far more a row than a shuffle does. Smaller tables stay as they are."""
    most, have = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if have >= most:
        return df
    want = min(most, df.count() // rows)
    return df.repartition(want) if want > have else df


def train_fare(trips: DataFrame, num_trees: int = 100, max_depth: int = 10, seed: int = 42):
    """80/20 split (seed 42), forest regressor, metrics on the hold-out,
    feature importance ranking. Returns (model, metrics_df, importance_df)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import RandomForestRegressor
    train, test = spread(trips).randomSplit([0.8, 0.2], seed=seed)
    train = train.persist(StorageLevel.DISK_ONLY)  # the fit reads it several times
    rf = RandomForestRegressor(featuresCol="features", labelCol="fare_amount", numTrees=num_trees,
                               maxDepth=max_depth, minInstancesPerNode=5, seed=seed, **KEEP_NODES)
    model = Pipeline(stages=[_assembler(), rf]).fit(train)
    train.unpersist()
    pred = written(model.transform(test).select("fare_amount", "prediction"), "fare-predictions")  # scored once for all metrics
    ev = RegressionEvaluator(labelCol="fare_amount", predictionCol="prediction")
    spark = trips.sparkSession
    metrics = spark.createDataFrame(
        [(ev.setMetricName(m).evaluate(pred), m) for m in ("mae", "rmse", "r2")],
        "value double, metric string")
    imp = model.stages[-1].featureImportances.toArray().tolist()
    importance = spark.createDataFrame(list(zip(FEATURES, imp)), "feature string, importance double") \
        .orderBy(F.col("importance").desc())
    return model, metrics, importance


def class_weights(df: DataFrame, label: str = "tip_category") -> DataFrame:
    """Balanced weights n / (k * n_class) per row (k = classes seen)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = counts.crossJoin(F.broadcast(tot)).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias("weight"))
    return df.join(w, label)


def stratified_split(df: DataFrame, label: str, key: str = "trip_id", frac: float = 0.8,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Stratified split: within each class the rows with the lowest hashes
    of ``key``, ``frac`` of the class, are for training. The hash bound of a
    class is its exact quantile of 1024 hash steps, so a class of any size is
    split alike and no row is in both parts or in neither."""
    step = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1024))
    rows = df.withColumn("_step", step)
    steps = rows.groupBy(label, "_step").agg(F.count(F.lit(1)).alias("_n"))  # at most 1024 rows a class
    upto = Window.partitionBy(label).orderBy("_step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(label)
    steps = steps.withColumn("_train", F.sum("_n").over(upto) <= F.ceil(F.lit(frac) * F.sum("_n").over(whole)))
    rows = rows.join(steps.select(label, "_step", "_train"), [label, "_step"]).drop("_step")
    return rows.filter("_train").drop("_train"), rows.filter("NOT _train").drop("_train")


def train_tip(trips: DataFrame, num_trees: int = 100, max_depth: int = 10, seed: int = 42):
    """Tip-class forest with balanced weights on a stratified split.
    Returns (model, test predictions with probabilities, metrics on them, feature importance)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    names = ["fare_amount", *FEATURES]
    labelled = class_weights(tip_category(spread(trips)))
    train, test = stratified_split(labelled, "tip_category", seed=seed)
    rf = RandomForestClassifier(featuresCol="features", labelCol="tip_category", weightCol="weight",
                                numTrees=num_trees, maxDepth=max_depth, seed=seed, **KEEP_NODES)
    model = Pipeline(stages=[_assembler(names), rf]).fit(train)
    pred = model.transform(test)
    ev = MulticlassClassificationEvaluator(labelCol="tip_category", predictionCol="prediction")
    known = written(pred.select("tip_category", "prediction"), "tip-predictions")
    metrics = trips.sparkSession.createDataFrame(
        [(ev.setMetricName(m).evaluate(known), m) for m in ("accuracy", "f1", "weightedPrecision", "weightedRecall")],
        "value double, metric string")
    importance = trips.sparkSession.createDataFrame(
        list(zip(names, model.stages[-1].featureImportances.toArray().tolist())), "feature string, importance double"
    ).orderBy(F.col("importance").desc())
    return model, pred, metrics, importance


def with_class_probs(pred: DataFrame) -> DataFrame:
    """H3: class id, class name and probabilities array from a classifier output."""
    from pyspark.ml.functions import vector_to_array
    labels = F.array(*[F.lit(x) for x in TIP_LABELS])
    return pred.withColumn("class_id", F.col("prediction").cast("int")) \
        .withColumn("class_name", F.element_at(labels, F.col("class_id") + 1)) \
        .withColumn("probabilities", vector_to_array("probability"))


def save_model(model, meta: dict, path: str) -> None:
    """Model artefact + one-row metadata table next to it."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([{k: str(v) for k, v in meta.items()}]).write.mode("overwrite").json(f"{path}/meta")


def load_model(path: str):
    """Load an artefact saved by :func:`save_model` -> (model, meta row)."""
    from pyspark.ml import PipelineModel
    spark = SparkSession.getActiveSession()
    return PipelineModel.load(f"{path}/model"), spark.read.json(f"{path}/meta").first()


# --- Python-only models: Arrow batches, never per row (H11) ------------------------------------

def map_batches(df: DataFrame, fn, schema: T.StructType | str) -> DataFrame:
    """Iterator-of-frames transform over partitions (``mapInPandas``)."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def confusion(df: DataFrame, label: str, pred: str, classes=(0, 1, 2)) -> DataFrame:
    """Confusion matrix label x predicted (pivot on the known classes)."""
    return df.groupBy(label).pivot(pred, list(classes)).count().fillna(0)


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class seen in the data: precision, recall, F1, support
    (zero division -> 0), plus the overall accuracy on every row. One pass over
    the rows counts (label, predicted) pairs; the rest reads those few."""
    pairs = df.groupBy(F.col(label).alias("l"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(F.explode(F.array(F.struct(F.col("l").alias("cls"), F.lit(True).alias("is_label"), "p", "l", "n"),
                                           F.struct(F.col("p").alias("cls"), F.lit(False).alias("is_label"), "p", "l", "n"))).alias("x")).select("x.*")
    j = sides.groupBy("cls").agg(
        F.coalesce(F.sum(F.when(F.col("is_label") & (F.col("l") == F.col("p")), F.col("n"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(F.col("is_label"), F.col("n"))), F.lit(0)).alias("support"),
        F.coalesce(F.sum(F.when(~F.col("is_label"), F.col("n"))), F.lit(0)).alias("predicted"))
    acc = j.agg((F.sum("tp") / F.sum("support")).alias("accuracy"))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    out = j.select("cls", F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"),
                   F.round(f1, 6).alias("f1"), "support")
    return out.crossJoin(F.broadcast(acc)).withColumn("accuracy", F.round("accuracy", 6))  # one row
