"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a share of all words by its weight, at most ``cap`` times its
own.  A document's copies are target / source size: the whole part is certain,
the fraction is a probability to be rounded.  Two documents of a source meet:
mass, counted in words, moves from one fraction to the other until one of them
is 0 or 1; a coin weighted so that every expectation stays decides the
direction.  The other goes on to the next document.  Small groups are rounded
each on its own and hand on their one open fraction; the open fractions of the
groups are rounded likewise, level by level, until one is left in each source.
The last one of a source is rounded to the nearer side, so a source's words differ
from its target by half of one document's at most.

All of it is DataFrame code.  Defined cases: a null text has size 0 and is never
taken; a null source is a source of its own, last in order; repeated rows are
documents of their own, rounded together however many they are; columns beside
doc_id, source and text enter only the hash of the row, whatever their names; an
empty table gives no rows.  Coins and groups depend
on the rows alone, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import written
from stratum.operators.timeseries import with_row_id

WEIGHTS = (5, 2, 1)
GROUP = 128  # documents that are rounded in one group, on average
PIECE = 1024  # copies of one row that a task makes at once


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, size): shares by weight, the excess over the caps shared again.

    Sources in order of cap * size / weight reach their cap one after the other;
    the first whose share of what is left stays below its cap ends that.  The
    windows go over one row for each source.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.asc_nulls_last("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    s = s.withColumn("w", w).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    by_cap = Window.orderBy(F.col("most") / F.col("w"), F.asc_nulls_last("source"))
    whole = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, rest = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    s = s.withColumn("level", left / F.sum("w").over(rest))
    s = s.withColumn("level", F.first(F.when(F.col("level") * F.col("w") <= F.col("most"), F.col("level")), True).over(whole))
    return s.select("source", "source_size", F.least("most", F.coalesce(F.col("level") * F.col("w"), F.col("most"))).alias("target"))


def _round_group(units: Column) -> Column:
    """Fold of (size, id, f, u) structs: the open unit and the (id, took) of all closed ones."""
    unit = "struct<size: long, id: long, f: double, u: double>"
    start = F.struct(F.lit(None).cast(unit).alias("open"), F.array().cast("array<struct<id: long, took: int>>").alias("closed"))

    def close(s: Column, unit_: Column, took: int, still: Column, f: Column) -> Column:
        done = F.struct(unit_["id"].alias("id"), F.lit(took).alias("took"))
        return F.struct(still.withField("f", f).alias("open"), F.concat(s["closed"], F.array(done)).alias("closed"))

    def meet(s: Column, e: Column) -> Column:
        o = s["open"]
        per = e["size"] / o["size"]
        up, down = F.least(1 - o["f"], e["f"] * per), F.least(o["f"], (1 - e["f"]) * per)
        # evaluated once, used in every branch
        step = F.element_at(F.transform(F.array(F.struct(up.alias("up"), down.alias("down"))), lambda m: (
            F.when(e["u"] * (m["up"] + m["down"]) < m["down"],
                   F.when(m["up"] == 1 - o["f"], close(s, o, 1, e, F.greatest(F.lit(0.0), e["f"] - m["up"] / per)))
                   .otherwise(close(s, e, 0, o, F.least(F.lit(1.0), o["f"] + m["up"]))))
            .otherwise(F.when(m["down"] == o["f"], close(s, o, 0, e, F.least(F.lit(1.0), e["f"] + m["down"] / per)))
                       .otherwise(close(s, e, 1, o, F.greatest(F.lit(0.0), o["f"] - m["down"])))))), 1)
        return F.when(o.isNull(), F.struct(e.alias("open"), s["closed"].alias("closed"))).otherwise(step)

    return F.aggregate(units, start, meet)


def _uniform(*cols: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11) + 0.5) / F.lit(2.0 ** 53)


def pivotal(units: DataFrame, seed: int = 0, group: int = GROUP) -> DataFrame:
    """(id, took) with took 0 or 1 for units (source, id, h, size > 0, 0 < f < 1); h decides groups and coins."""
    most = units.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    levels = max(1, math.ceil(math.log(max(most, 2)) / math.log(group)) + 1)
    taken, level = None, units.select("source", "id", "h", "size", "f")
    for i in range(levels):
        # open fractions left after this level: one for each group, and a single group of each source at the end
        groups = 1 if i == levels - 1 else max(1, math.ceil(most / group ** (i + 1)))
        u = _uniform(F.col("h"), F.lit(seed), F.lit(i))
        units_ = level.withColumn("g", F.pmod(F.xxhash64("h", F.lit(seed), F.lit(100 + i)), F.lit(groups)))
        sets = units_.groupBy("source", "g").agg(F.collect_list(F.struct(
            (-F.col("size")).alias("o"), "h", "size", "id", "f", u.alias("u"))).alias("units"))
        large_first = F.transform(F.array_sort("units"), lambda x: F.struct(
            x["size"].alias("size"), x["id"].alias("id"), x["f"].alias("f"), x["u"].alias("u")))
        done = written(sets.select("source", "g", _round_group(large_first).alias("x")), "mixing-level")
        closed = done.select(F.explode("x.closed").alias("c")).select("c.id", "c.took")
        taken = closed if taken is None else taken.union(closed)
        level = done.select("source", F.col("x.open.id").alias("id"), F.xxhash64("source", "g", F.lit(i)).alias("h"),
                            F.col("x.open.size").alias("size"), F.col("x.open.f").alias("f"))
    last = level.select("id", F.when(F.col("f") >= 0.5, 1).otherwise(0).alias("took"))
    return taken.union(last)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = 3.0, seed: int = 0, group: int = GROUP) -> DataFrame:
    """(doc_id, h, h2, size, source_size, target, copies) for every row; h and h2 are hashes of all the row's columns.

    n equal rows are rounded as one unit: of n times their fraction the whole part is certain, the rest is open.
    The first rows of the class, in any order, get the copies.
    """
    rows = written(docs.select("doc_id", "source", *_row_hashes(seed), word_count(F.col("text")).alias("size"))
                   .withColumn("id", F.monotonically_increasing_id()), "mixing-sizes")
    plan = written(targets(rows, weights, cap), "mixing-targets")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("whole", F.floor(share + 1e-12)).withColumn("f", F.greatest(F.lit(0.0), share - F.col("whole")))
    plan = plan.withColumnRenamed("source", "_source")
    same = ["h", "h2", "size"]
    classes = rows.groupBy("source", *same).agg(F.count("*").alias("n"), F.min("id").alias("id"))
    classes = classes.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "sure", F.when(F.col("size") > 0, F.floor(F.col("n") * F.col("f") + 1e-12)).otherwise(F.lit(0)))
    classes = classes.withColumn("f", F.greatest(F.lit(0.0), F.col("n") * F.col("f") - F.col("sure")))
    classes = written(classes.withColumn("whole", F.when(F.col("size") > 0, F.col("whole")).otherwise(F.lit(0))), "mixing-classes")
    took = pivotal(classes.where("size > 0 AND f > 0"), seed, group)
    told = written(classes.join(took, "id", "left").select(
        *same, "n", "source_size", "target", "whole", (F.col("sure") + F.coalesce("took", F.lit(0))).alias("more")), "mixing-told")
    rows = rows.select("doc_id", *same, "id")
    found = rows.join(told.where("n = 1"), same).withColumn("place", F.lit(1).cast("long"))
    if not told.where("n > 1").isEmpty():  # number equal rows by one sorted table
        again = with_row_id(rows.join(told.where("n > 1"), same), [*same, "id"], "at")
        first = written(again, "mixing-equal").groupBy(*same).agg(F.min("at").alias("first"))
        again = again.join(first, same).withColumn("place", F.col("at") - F.col("first") + 1)
        found = found.union(again.select(found.columns))
    copies = F.col("whole") + F.when(F.col("place") <= F.col("more"), 1).otherwise(0)
    return found.select("doc_id", "h", "h2", "size", "source_size", "target", copies.cast("long").alias("copies"))


def _row_hashes(seed: int) -> tuple[Column, Column]:
    return F.xxhash64(F.struct("*"), F.lit(seed)).alias("h"), F.xxhash64(F.lit(~seed), F.struct("*")).alias("h2")


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = 3.0, seed: int = 0) -> DataFrame:
    """The mix itself: every document with all its columns, as often as it is taken."""
    same = ["h", "h2"]
    copies = mix(docs, weights, cap, seed).groupBy(*same).agg(F.sum("copies").alias("copies")).where("copies > 0")
    # pieces of bounded size, so that a class of very many equal rows is many rows of the join
    copies = copies.select(*same, "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / PIECE))).alias("piece"))
    copies = copies.select(*same, F.least(F.lit(PIECE), F.col("copies") - F.col("piece") * PIECE).cast("int").alias("times"))
    once = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(1)))  # rows with the same hashes are equal
    rows = docs.select(F.struct("*").alias("row"), *_row_hashes(seed)).withColumn("n", once).where("n = 1")
    out = rows.join(copies.hint("merge"), same).select("row", F.explode(F.sequence(F.lit(1), "times")))
    return out.select("row.*")
