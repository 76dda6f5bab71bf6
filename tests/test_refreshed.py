"""Marts that are rewritten only where their inputs changed."""

import pytest
from pyspark.sql import functions as F

from stratum.plans.refreshed import RefreshedMart

DDL = "ticker string, day int, price double"


def prices(spark, rows):
    return spark.createDataFrame(rows, DDL)


def mean(raw):
    return raw.groupBy("ticker").agg(F.avg("price").alias("mean"), F.count("*").alias("n"))


def above(means, limits):
    return means.join(limits, "ticker").select("ticker", (F.col("mean") > F.col("limit")).alias("above"))


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_only_changed_buckets_are_written(spark):
    base = [(f"T{i % 40}", i, float(i % 11)) for i in range(400)] + [(None, 1, 2.0)]
    limits = spark.createDataFrame([(f"T{i}", 5.0) for i in range(40)], "ticker string, limit double")
    means, flags = RefreshedMart(spark, "means", buckets=16), RefreshedMart(spark, "flags", buckets=16)

    def both(rows):
        raw = prices(spark, rows)
        return (means.refresh({"raw": raw}, mean), flags.refresh({"means": means, "limits": limits}, above), raw)

    first, second, raw = both(base)
    assert len(first) > 8 and set(second) <= set(first) | set(range(16))
    assert content(means.table()) == content(mean(raw)) and content(flags.table()) == content(above(mean(raw), limits))
    # the same rows in another order: nothing is written
    version = means.manifest()[0], flags.manifest()[0]
    assert both(base[::-1])[:2] == ([], []) and (means.manifest()[0], flags.manifest()[0]) == version
    # one changed ticker, a new one, one that went, a repeated row
    for change in ([(t, d, p + (t == "T7")) for t, d, p in base], base + [("NEW", 1, 9.0)], [r for r in base if r[0] != "T9"], base + [base[0]]):
        held = means.manifest()[2]
        a, b, raw = both(change)
        assert 1 <= len(a) <= 2 and len(b) <= 2, "one ticker, one bucket (and the one of the change before)"
        assert all(held[x] == y for x, y in means.manifest()[2].items() if x not in a)
        assert content(means.table()) == content(mean(raw)) and content(flags.table()) == content(above(mean(raw), limits))
    # a changed side input alone
    assert means.refresh({"raw": raw}, mean) == []
    limits2 = limits.withColumn("limit", F.when(F.col("ticker") == "T3", 0.0).otherwise(F.col("limit")))
    assert len(flags.refresh({"means": means, "limits": limits2}, above)) == 1


def test_buckets_that_go_and_empty_inputs(spark):
    m = RefreshedMart(spark, "means", buckets=4)
    with pytest.raises(ValueError):
        m.table()
    assert m.refresh({"raw": prices(spark, [])}, mean) == [] and m.table().collect() == []
    rows = prices(spark, [(f"T{i}", 1, 1.0) for i in range(30)])
    assert m.refresh({"raw": rows}, mean) == [0, 1, 2, 3]
    assert sorted(m.refresh({"raw": rows.where("ticker = 'T1'")}, mean))  # the others went
    assert content(m.table()) == [("T1", 1.0, 1)]
    again = RefreshedMart(spark, "means", m.path, buckets=4)
    assert content(again.table()) == [("T1", 1.0, 1)]


def test_a_failed_refresh_leaves_the_mart(spark):
    m = RefreshedMart(spark, "means", buckets=4)
    m.refresh({"raw": prices(spark, [("A", 1, 1.0)])}, mean)
    with pytest.raises(Exception, match="boom"):
        m.refresh({"raw": prices(spark, [("A", 1, 3.0)])}, lambda raw: mean(raw).withColumn("mean", F.raise_error(F.lit("boom")).cast("double")))
    assert content(m.table()) == [("A", 1.0, 1)]
    m.refresh({"raw": prices(spark, [("A", 1, 3.0)])}, mean)
    assert content(m.table()) == [("A", 3.0, 1)]
