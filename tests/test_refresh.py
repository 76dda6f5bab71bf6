"""Refreshes whose order follows from the reads; grouped quantiles."""

import math
import threading
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stratum.operators import aggregate as A
from stratum.streaming.refresh import CycleError, refresh


def test_order_follows_from_the_reads(spark):
    """Steps of one kind and the other, in no order; a name in a comment or a common table expression is no read."""
    spark.range(5).createOrReplaceTempView("rf_b")  # from before: not read
    done = refresh(spark, {
        "rf_d": "WITH rf_x AS (SELECT id FROM rf_c) SELECT sum(id) AS s FROM rf_x -- rf_e",
        "rf_c": "SELECT a.id FROM rf_b a JOIN RF_A b ON a.id = b.id",
        "rf_b": lambda s: s.table("rf_a").where("id % 2 = 0"),
        "rf_a": lambda s: s.range(10).toDF("id"),
        "rf_e": "SELECT 1 AS one"})
    at = list(done)
    assert at.index("rf_a") < at.index("rf_b") < at.index("rf_c") < at.index("rf_d") and all(o.status == "written" for o in done.values())
    assert set(done["rf_c"].reads) <= {"rf_a", "rf_b"} and done["rf_e"].reads == []
    assert spark.read.parquet(done["rf_d"].path).first()["s"] == 20
    assert spark.table("rf_b").count() == 5


def test_failure_skips_what_reads_it(spark):
    done = refresh(spark, {"rf_bad": "SELECT nothing FROM rf_ok", "rf_after": "SELECT * FROM rf_bad", "rf_last": "SELECT * FROM rf_after",
                           "rf_ok": "SELECT 1 AS x", "rf_lost": "SELECT * FROM no_such_table_anywhere",
                           "rf_boom": lambda s: s.range(3).select(F.raise_error(F.lit("boom")).alias("x"))})
    assert {n: o.status for n, o in done.items()} == {"rf_bad": "failed", "rf_after": "skipped", "rf_last": "skipped", "rf_ok": "written",
                                                      "rf_lost": "failed", "rf_boom": "failed"}
    assert "nothing" in done["rf_bad"].error and done["rf_last"].error == "reads rf_after"


def test_cycle(spark):
    with pytest.raises(CycleError, match="rf_(m -> rf_n -> rf_m|n -> rf_m -> rf_n)"):
        refresh(spark, {"rf_m": "SELECT * FROM rf_n", "rf_n": "SELECT * FROM rf_m", "rf_free": "SELECT 1 AS x"})
    assert refresh(spark, {}) == {}


def test_independent_steps_run_together(spark):
    both = threading.Barrier(2, timeout=60)

    def step(s):
        both.wait()
        return s.range(1)
    assert all(o.status == "written" for o in refresh(spark, {"rf_one": step, "rf_two": step}).values())


def test_a_step_that_ends_during_the_analysis_of_its_reader(spark):
    """The reader misses the table, which is there by the time the miss is looked into: it is analysed again."""
    missed = threading.Event()

    def slow(s):
        missed.wait(60)
        return s.range(3).toDF("id")

    def reader(s):
        try:
            return s.table("rf_slow")
        except AnalysisException:
            missed.set()
            while not s.catalog.tableExists("rf_slow"):
                time.sleep(0.1)
            time.sleep(1)
            raise
    done = refresh(spark, {"rf_reader": reader, "rf_slow": slow})
    assert {n: o.status for n, o in done.items()} == {"rf_reader": "written", "rf_slow": "written"} and done["rf_reader"].reads == ["rf_slow"]


def test_quantiles_of_groups(spark):
    """Ties, NULLs, infinities, NULL groups, a group of NULLs, and a group with nearly all rows."""
    rows = [(None, float(i % 7)) for i in range(20)] + [("a", None), ("a", None), ("b", math.inf), ("b", 1.0), ("b", -math.inf), ("c", 4.5),
                                                       ("d", 1.0), ("d", None), ("d", 1.0), ("d", 3.0), ("e", math.inf), ("e", math.inf)]
    df = spark.createDataFrame(rows, "v string, x double").withColumn("n", F.lit(1)).union(
        spark.range(20000).select(F.lit("hot"), (F.col("id") % 1000).cast("double"), F.lit(1)))
    got = {r.v: r[1:] for r in A.quantiles(df, "x", (0.25, 0.9), by=["v"]).collect()}
    want = {r.v: r[1:] for r in df.groupBy("v").agg(F.median("x"), F.percentile("x", 0.25), F.percentile("x", 0.9)).collect()}
    assert set(got) == set(want) and got["a"] == (None, None, None)
    for v in want:
        for a, b in zip(got[v], want[v]):
            assert (a is None) == (b is None) and (a is None or a == b or abs(a - b) < 1e-9 or (math.isnan(b) and v in ("b", "e"))), (v, got[v], want[v])
