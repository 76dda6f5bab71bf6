"""Line dedup: repeated runs of lines found by prefix doubling over line ids.

Every line gets the id of its class of equal lines.  A round doubles the
compared length: the class of the 2^k lines from a place and that of the next
2^k name the class of 2^(k+1).  A class is an interval of the suffix array whose
common prefix has that many lines; its name is its first member, so only places
that still share their prefix go into the next round.

Deleted is every line of a run, of any number of lines and ``min_chars`` characters or
more together, that also starts at an earlier place (smaller doc_id, or further up).
Short lines therefore go only as part of a longer repeated run.  The union of these
runs is that of the shortest ones of ``min_chars`` characters that start or end at
some line: a line of a longer run lies in the shortest that starts the run, or in the
shortest that ends at the line.  Such a run of w lines, 2^k <= w < 2^(k+1), has an equal one
where the classes of its first 2^k lines and of its last 2^k lines are equal.  The
rounds end with the longest of these.

All of it is DataFrame code.  Defined cases: a null text stays null; an empty text
is one empty line; null doc_ids come last; rows of one doc_id follow each other
by text hash; an empty table gives no rows; all columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import keyed, written

MIN_CHARS = 40


def _classes(rows: DataFrame, by: list[str], purpose: str) -> DataFrame:
    """(k, twin, i, n, first): rows whose class by the given columns has others, n characters, first of the class.

    The minimum comes from a partial aggregation and meets the rows again in a
    join of two tables, which splits a class that very many rows share.
    """
    classes = rows.groupBy(*by).agg(F.min(F.struct("k", "twin", "i")).alias("first"), F.count("*").alias("size"))
    classes = written(classes.where("size > 1").drop("size"), purpose)
    return written(rows.join(classes, by).select("k", "twin", "i", "n", "first"), purpose)


def _shortest_runs(rows: DataFrame, min_chars: int) -> DataFrame:
    """(k, twin, i, w): the shortest runs of repeated lines with ``min_chars`` characters from or up to every line."""
    place = F.row_number().over(Window.partitionBy("k", "twin").orderBy("i"))
    rows = rows.select("k", "twin", "i", "n", (F.col("i") - place).alias("stretch"))
    per = Window.partitionBy("k", "twin", "stretch")
    end = F.sum("n").over(per.orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("e", end).select("*", (F.col("e") - F.col("n")).alias("s"),
                                            F.max("e").over(per).alias("total"), F.min("i").over(per).alias("low"))
    below = F.count("*").over(per.orderBy("s").rangeBetween(Window.unboundedPreceding, min_chars - 1)) + F.col("low")
    rows = rows.withColumn("to", F.greatest(below, F.col("i") + 1))
    above = F.count("*").over(per.orderBy("e").rangeBetween(Window.unboundedPreceding, -min_chars)) + F.col("low")
    rows = rows.withColumn("from", F.least(above, F.col("i")))
    first = rows.where(F.col("total") - F.col("s") >= min_chars).select("k", "twin", "i", (F.col("to") - F.col("i")).alias("w"))
    last = rows.where(F.col("e") >= min_chars).select("k", "twin", F.col("from").alias("i"), (F.col("i") + 1 - F.col("from")).alias("w"))
    return first.union(last).distinct()


def repeated_runs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k, twin, a, b): lines a up to b of a document are a later copy; ``docs`` has k, twin and text."""
    lines = docs.select("k", "twin", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    rows = lines.select("k", "twin", F.col("i").cast("long").alias("i"), F.length("line").cast("long").alias("n"),
                        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line", F.lit("")).alias("h2"))
    rows = _classes(rows, ["h1", "h2"], "lines-1")
    runs = written(_shortest_runs(rows, min_chars), "lines-shortest")
    longest = runs.agg(F.max("w")).first()[0] or 0
    later = F.struct("k", "twin", "i") != F.col("first")
    width, found = 1, None
    while True:
        spans = rows.join(runs.where(F.col("w") == width), ["k", "twin", "i"]).where(later)
        spans = spans.select("k", "twin", F.col("i").alias("a"), (F.col("i") + width).alias("b"))
        found = spans if found is None else found.union(spans)
        if width > 1:
            ends = runs.where(F.col("w").between(width + 1, 2 * width - 1)).withColumn("j", F.col("i") + F.col("w") - width)
            ends = ends.join(rows.select("k", "twin", "i", F.col("first").alias("one")), ["k", "twin", "i"])
            ends = ends.join(rows.select("k", "twin", F.col("i").alias("j"), F.col("first").alias("then")), ["k", "twin", "j"])
            equal = _classes(ends.select("k", "twin", "i", F.col("w").alias("n"), "one", "then"), ["n", "one", "then"], f"lines-{width}-runs")
            found = found.union(equal.where(later).select("k", "twin", F.col("i").alias("a"), (F.col("i") + F.col("n")).alias("b")))
        if longest < 2 * width:
            return found
        follow = rows.select("k", "twin", (F.col("i") - width).alias("i"), F.col("n").alias("n2"), F.col("first").alias("then"))
        pairs = rows.join(follow, ["k", "twin", "i"]).select("k", "twin", "i", (F.col("n") + F.col("n2")).alias("n"), "first", "then")
        pairs = pairs.withColumnRenamed("first", "one")
        width *= 2
        rows = _classes(pairs, ["one", "then"], f"lines-{width}")
        if rows.isEmpty():
            return found


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """All columns of ``docs`` with later copies of line runs deleted from ``text``, and n_lines, n_removed.

    Columns of ``docs`` with those two names give way.
    """
    base, keys = keyed(docs.select(F.struct("*").alias("row"), "doc_id", "text"))
    spans = repeated_runs(base.select("k", "twin", "text"), min_chars)
    # join overlapping spans of a document
    order = Window.partitionBy(*keys).orderBy("a", "b")
    reach = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.groupBy(*keys, "a").agg(F.max("b").alias("b")).withColumn("new", (F.col("a") > F.coalesce(reach, F.lit(-1))).cast("int"))
    spans = spans.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = spans.groupBy(*keys, "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    runs = written(runs.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("runs")), "lines-runs")
    out = base.select(*keys, "row").join(runs.hint("merge"), keys, "left").select(
        "row", F.coalesce("runs", F.array().cast("array<struct<a: bigint, b: bigint>>")).alias("runs"),
        F.split("row.text", "\n").alias("lines"))
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0).cast("long")), F.transform("runs", lambda r: r["b"])).alias("x"),
                        F.concat(F.transform("runs", lambda r: r["a"]), F.array(F.size("lines").cast("long"))).alias("y"))
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(F.col("lines"), (g["x"] + 1).cast("int"), (g["y"] - g["x"]).cast("int"))))
    text = F.when(F.size("runs") == 0, F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    own = [F.col(f"row.`{c}`") if c.lower() != "text" else text.alias(c) for c in docs.columns
           if c.lower() not in ("n_lines", "n_removed")]
    return out.select(*own, F.when(F.col("row.text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
                      F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"]).alias("n_removed"))
