"""Fitted tree ensembles as native expressions.

A fitted Spark ML forest is compiled into flat arrays over all nodes of all
trees: feature, threshold, left, right, value, and the place of every root. A leaf
points to itself, so a walk is a fold of fixed length over
``node -> features[feature[node]] <= threshold[node] ? left[node] : right[node]``,
and scoring a row is a transform over the roots. The arrays enter the plan as
folded literals: no join, no Python worker. The SQL functions take a forest's
different tests once for a row and then only look up and add. The arrays' size is
bounded by the model's parameters (trees x 2^(depth + 1)), not by any table.

Sums run over the trees in order and divisions are those of Spark ML, so scores
equal ``model.transform`` to the last bit.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.operators.models import FARE_DEFAULTS, FEATURES, TIP_LABELS
from stratum.session import shared_dir

# One value a node: the prediction, or the share of each class.
LAYOUT = ("feature array<int>, threshold array<double>, `left` array<int>, `right` array<int>, value array<array<double>>, "
          "roots array<int>, depth int, classes int")


def node_table(spark: SparkSession, model) -> DataFrame:
    """The nodes of a fitted forest (the last stage of a pipeline, or the model itself) from its saved form:
    (tree, id, feature, threshold, left, right, value); feature is NULL in a leaf, value has one entry or one a class."""
    forest = model.stages[-1] if hasattr(model, "stages") else model
    path = shared_dir(spark, "forest")
    forest.write().save(path)
    n, split = F.col("nodeData"), F.col("nodeData.split")
    total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    shares = F.transform(n["impurityStats"], lambda x: F.when(total == 0, 0.0).otherwise(x / total))
    inner = n["leftChild"] >= 0
    rows = spark.read.parquet(f"{path}/data")
    if not rows.where(inner & (split["numCategories"] >= 0)).isEmpty():
        raise ValueError("a forest with categorical splits cannot be compiled")
    return rows.select(F.col("treeID").alias("tree"), n["id"].alias("id"), F.when(inner, split["featureIndex"]).alias("feature"),
                       F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"), n["leftChild"].alias("left"),
                       n["rightChild"].alias("right"), (shares if hasattr(forest, "numClasses") else F.array(n["prediction"])).alias("value"))


def compile_forest(spark: SparkSession, model) -> str:
    """The forest's arrays as JSON text of LAYOUT; the text goes through the driver and is as large as the model."""
    nodes = node_table(spark, model)
    before = Window.orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)  # one row a tree
    starts = nodes.groupBy("tree").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("int"))
    placed = nodes.join(F.broadcast(starts), "tree")
    at = F.col("start") + F.col("id")
    inner = F.col("feature").isNotNull()
    node = F.struct(at.alias("at"), F.coalesce("feature", F.lit(0)).alias("feature"), F.when(inner, F.col("threshold")).otherwise(0.0).alias("threshold"),
                    F.when(inner, F.col("start") + F.col("left")).otherwise(at).alias("left"),
                    F.when(inner, F.col("start") + F.col("right")).otherwise(at).alias("right"), "value")
    flat = placed.agg(F.sort_array(F.collect_list(node)).alias("n"), F.sort_array(F.collect_set("start")).alias("roots"))
    forest = model.stages[-1] if hasattr(model, "stages") else model
    depth = max((t.depth for t in forest.trees), default=0)
    return flat.select(F.to_json(F.struct(*[F.col(f"n.{c}").alias(c) for c in ("feature", "threshold", "left", "right", "value")],
                                          "roots", F.lit(depth).alias("depth"),
                                          F.lit(int(getattr(forest, "numClasses", 1))).alias("classes")))).first()[0]


def _sums(forest: Column, x: Column) -> Column:
    """For each class (or the one value) the sum over the trees of what the row's leaf says."""
    leaves = F.transform(forest["roots"], lambda root: F.aggregate(
        F.sequence(F.lit(1), F.greatest(forest["depth"], F.lit(1))), root,
        lambda node, _: F.when(F.get(x, F.get(forest["feature"], node)) <= F.get(forest["threshold"], node), F.get(forest["left"], node))
        .otherwise(F.get(forest["right"], node))))
    zeros = F.array_repeat(F.lit(0.0), forest["classes"])
    return F.aggregate(leaves, zeros, lambda acc, leaf: F.zip_with(acc, F.get(forest["value"], leaf), lambda a, b: a + b))


def _row(columns: Sequence[Column]) -> Column:
    """Features as a double array; NULL counts as NaN, which every comparison sends to the right."""
    return F.array(*[F.coalesce(c.cast("double"), F.lit(float("nan"))) for c in columns])


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def forest_value(forest: str, columns: Sequence[Column]) -> Column:
    """A regression forest's prediction."""
    f = F.from_json(F.lit(forest), LAYOUT)
    return _once(_row(columns), lambda x: F.get(_sums(f, x), F.lit(0)) / F.size(f["roots"]))


def forest_probabilities(forest: str, columns: Sequence[Column]) -> Column:
    """A classification forest's probabilities, in class order."""
    f = F.from_json(F.lit(forest), LAYOUT)

    def share(votes: Column) -> Column:
        return _once(F.aggregate(votes, F.lit(0.0), lambda a, v: a + v), lambda total: F.transform(votes, lambda v: v / total))
    return _once(_row(columns), lambda x: _once(_sums(f, x), share))


def first_largest(values: Column) -> Column:
    """Place (from 0) of the largest entry, the first of equal ones."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def _defaults(columns: dict[str, Column]) -> list[Column]:
    return [F.coalesce(columns[c], F.lit(FARE_DEFAULTS[c])) if c in FARE_DEFAULTS else columns[c] for c in FEATURES]


def predict_fare(forest: str, columns: dict[str, Column]) -> Column:
    """H1: fare of the features in FEATURES, never below 0; missing ones take their defaults, a missing distance gives NULL."""
    fare = F.greatest(F.lit(0.0), forest_value(forest, _defaults(columns)))
    return F.when(columns["trip_distance"].isNotNull(), fare)


def predict_tip(forest: str, fare: Column, columns: dict[str, Column]) -> Column:
    """H2: tip class of a fare and the features; a missing fare or distance gives NULL."""
    best = first_largest(forest_probabilities(forest, [fare, *_defaults(columns)]))
    label = F.element_at(F.array(*[F.lit(x) for x in TIP_LABELS]), best + 1)
    return F.when(fare.isNotNull() & columns["trip_distance"].isNotNull(), label)


def with_forests(trips: DataFrame, fare_forest: str, tip_forest: str, fare: str = "fare_amount") -> DataFrame:
    """Both models' outputs as columns, usable by later filters and groups."""
    cols = {c: F.col(c) for c in FEATURES}
    return trips.withColumn("predicted_fare", predict_fare(fare_forest, cols)).withColumn(
        "predicted_tip_category", predict_tip(tip_forest, F.col(fare), cols))


# --- the same as SQL functions ---------------------------------------------------------------------

_ARGS = "trip_distance DOUBLE, passenger_count INT, hour_of_day INT, day_of_week INT, is_rush_hour INT, is_weekend INT"


def _packed(forest: str) -> dict:
    """The arrays of a forest (JSON text of LAYOUT) for walks of few steps: its different tests, as (feature, threshold), and for each
    node the place of its test and of its left child, next to which lies the right one. A leaf asks the test after the last one, which
    always goes left, and points to itself. values has one array a class."""
    f = json.loads(forest)
    tests: dict[tuple[int, float], int] = {}
    order, asks, child, roots = [], [], [], []
    for root in f["roots"]:
        roots.append(len(order))
        order.append(root)
        while len(child) < len(order):
            n = order[len(child)]
            inner = f["left"][n] != n
            asks.append(tests.setdefault((f["feature"][n], f["threshold"][n]), len(tests)) if inner else None)
            child.append(len(order) if inner else len(child))
            order += [f["left"][n], f["right"][n]] if inner else []
    return {"tests": list(tests), "asks": [len(tests) if a is None else a for a in asks], "child": child, "roots": roots,
            "values": [[f["value"][n][c] for n in order] for c in range(f["classes"])], "depth": max(1, f["depth"])}


def _sums_sql(forest: str, features: Sequence[str], use: str) -> str:
    """``use``, an expression of ``sums``: for each class (or the one value) the sum over the trees of what the row's leaf says.

    The forest's different tests are taken once for a row, as 0 or 1; a step of a walk only looks up and adds."""
    f = _packed(forest)

    def array(values: list, kind: str) -> str:
        return f"from_json('{json.dumps(values)}', 'array<{kind}>')"
    bits = ", ".join([*(f"IF({features[i]} <= CAST('{x}' AS DOUBLE), 0, 1)" for i, x in f["tests"]), "0"])
    steps = ", ".join(str(i + 1) for i in range(f["depth"]))
    walk = f"""transform({array(f["roots"], "int")}, root -> aggregate(array({steps}), root,
    (node, i) -> get({array(f["child"], "int")}, node) + get(bits, get({array(f["asks"], "int")}, node))))"""
    sums = ", ".join(f"aggregate(leaves, 0D, (acc, leaf) -> acc + get({array(v, 'double')}, leaf))" for v in f["values"])
    for name, value, body in (("sums", f"array({sums})", use), ("leaves", walk, None), ("bits", f"array({bits})", None)):
        out = f"element_at(transform(array({value}), {name} -> {body or out}), 1)"
    return out


def _features_sql() -> list[str]:
    return [f"CAST(COALESCE({c}, {FARE_DEFAULTS[c]}) AS DOUBLE)" if c in FARE_DEFAULTS else c for c in FEATURES]


def register_model_functions(spark: SparkSession, fare_model, tip_model) -> None:
    """H1, H2: the trained forests as temporary SQL functions predict_taxi_fare and predict_tip_category (SQL bodies)."""
    fare, tip = compile_forest(spark, fare_model), compile_forest(spark, tip_model)
    trees = len(json.loads(fare)["roots"])
    labels = ", ".join(f"'{x}'" for x in TIP_LABELS)
    best = f"""element_at(transform(array(aggregate(sums, 0D, (a, b) -> a + b)), total -> element_at(transform(array(transform(sums, v -> v / total)), p ->
      element_at(array({labels}), CAST(array_position(p, array_max(p)) AS INT))), 1)), 1)"""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION predict_taxi_fare({_ARGS}) RETURNS DOUBLE RETURN
      IF(trip_distance IS NULL, NULL, greatest(0D, {_sums_sql(fare, _features_sql(), f"get(sums, 0) / {trees}")}))""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION predict_tip_category(fare DOUBLE, {_ARGS}) RETURNS STRING RETURN
      IF(trip_distance IS NULL OR fare IS NULL, NULL, {_sums_sql(tip, ["fare", *_features_sql()], best)})""")
