"""Edge rows: NULLs, zero divisors, ties, empty arrays, and the SQL
functions against their bulk DataFrame forms."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from stratum.functions import scalars as S
from stratum.functions import sql_functions as SF
from stratum.operators import aggregate as A
from stratum.operators import documents as D
from stratum.operators import models as Mo
from stratum.operators import relate as R
from stratum.operators import timeseries as ts
from stratum.plans import catalogue as C


def test_pct_zero_divisor_is_null(spark):
    r = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 2.0)], "a double, b double") \
        .select(S.pct("a", "b").alias("p")).collect()
    assert [x.p for x in r] == [None, 25.0, None]


def test_trend_signal_null_is_neutral(spark):
    r = spark.createDataFrame([(10.0, 5.0, 5.0), (1.0, 5.0, 5.0), (10.0, None, 5.0), (5.0, 5.0, 5.0)],
                              "c double, a double, b double") \
        .select(S.trend_signal("c", "a", "b").alias("t")).collect()
    assert [x.t for x in r] == ["Bullish", "Bearish", "Neutral", "Neutral"]


def test_clip_keeps_null(spark):
    r = spark.createDataFrame([(None,), (-1.0,), (500.0,)], "x double") \
        .select(S.clip("x", 0.0, 100.0).alias("y")).collect()
    assert [x.y for x in r] == [None, 0.0, 100.0]


def test_sanitize_and_strip_version(spark):
    r = spark.createDataFrame([("  My KA -- v2!! ",), ("***",)], "n string") \
        .select(S.sanitize("n").alias("s"), S.strip_version(F.lit("llama-3")).alias("v")).collect()
    assert r[0].s == "My_KA_v2" and r[1].s == "knowledge_assistant" and r[0].v == "llama"


def test_tags_map_drops_keyless_and_keeps_the_last(spark):
    df = spark.createDataFrame([([("a", "1"), ("", "2"), (None, "3"), ("b", "4"), ("a", "5")],), ([],), (None,)],
                               "tags array<struct<key:string,value:string>>")
    assert [r.m for r in df.select(S.tags_map("tags").alias("m")).collect()] == [{"a": "5", "b": "4"}, {}, None]


def test_keep_latest_ties_are_deterministic(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c")], "k string, ts int, v string")
    assert ts.keep_latest(df, ["k"], ["ts", "v"]).first().v == "c"


def test_stddev_single_value_is_null(spark):
    df = spark.createDataFrame([("k", 1, 5.0)], "k string, d int, x double")
    assert ts.rolling_stddev(df, ["k"], ["d"], "x", 20, "s").first().s is None


def test_missing_phrases_and_response_text(spark):
    js = '{"output":[{"type":"message","content":[{"type":"output_text","text":"Hello World"}]}]}'
    df = spark.createDataFrame([(js, ["world", "Mars"])], "j string, e array<string>")
    r = df.select(S.response_text("j").alias("t"), S.missing_phrases(S.response_text("j"), "e").alias("m")).first()
    assert r.t == "Hello World" and r.m == ["Mars"]


def test_unreadable_answers(spark):
    js = ['{"output":[{"type":"reasoning","content":[]}]}', "timeout", None,
          '{"output":[{"type":"message","content":[{"type":"output_text","text":null}]}]}']
    df = spark.createDataFrame([(j, ["World", "out"]) for j in js], "j string, e array<string>")
    t = S.response_text("j")
    got = [(r.t, r.m) for r in df.select(t.alias("t"), S.missing_phrases(t, "e").alias("m")).collect()]
    assert got == [('[{"type":"reasoning","content":[]}]', ["World", "out"]), ("timeout", ["World"]), ("", ["World", "out"]),
                   ("", ["World", "out"])]
    none = spark.createDataFrame([(None, ["a"]), ("x", None)], "t string, e array<string>")
    assert [r.m for r in none.select(S.missing_phrases("t", "e").alias("m")).collect()] == [["a"], []]


def test_run_summary_counts_a_missing_verdict_as_failed(spark):
    df = spark.createDataFrame([(True, True, 1.0), (False, None, 2.0), (None, True, 0.5)],
                               "passed boolean, validated boolean, duration_s double")
    r = A.run_summary(df).first()
    assert (r.total, r.passed, r.failed, r.validated, r.total_seconds) == (3, 1, 2, 2, 3.5)


def test_row_ids_lose_no_row_whatever_the_width(spark):
    rows = [(i, i * 7 % 100, "x" * (i % 50) * 20, float(i)) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, v int, pad string, f double")
    for n in (3, 8, 40):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = ts.with_row_id(df, [F.col("v").desc(), F.col("id")]).select("id", "row_id", "pad").collect()
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
        assert {r.id: r.row_id for r in got} == want and len(got) == 5000


def test_ranks_of_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 5), ("b", 7), ("c", 5), ("d", None), ("e", None), ("f", 1)], "k string, v int")
    got = {r.k: r.r for r in ts.rank_peers(df, {"r": ("v", F.col("v").desc_nulls_last())}).collect()}
    assert got == {"b": 1, "a": 2, "c": 2, "f": 4, "d": 5, "e": 5}


def test_exact_quantiles(spark):
    import numpy as np
    values = [None, 3.0, 3.0, 3.0, -1.5, 10.0, 0.25, 7.0] * 3 + [99.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    qs = [0.0, 0.1, 0.33, 0.5, 0.67, 1.0]
    got = ts.exact_quantiles(df, "x", qs).first()
    assert np.allclose(list(got), np.quantile([v for v in values if v is not None], qs))
    assert list(ts.exact_quantiles(df.where("x is null"), "x", [0.5]).first()) == [None]


def test_stratified_split_is_a_partition(spark):
    df = spark.createDataFrame([(i, i % 7 == 0) for i in range(3000)] + [(9999, None)], "trip_id long, c boolean") \
        .select("trip_id", F.when(F.col("c"), 2).otherwise(0).alias("tip_category"))
    a, b = Mo.stratified_split(df, "tip_category")
    ids = [r.trip_id for r in a.collect()] + [r.trip_id for r in b.collect()]
    assert sorted(ids) == sorted([*range(3000), 9999])
    share = {r.tip_category: r["count"] for r in a.groupBy("tip_category").count().collect()}
    assert abs(share[2] / 429 - 0.8) < 0.03 and abs(share[0] / 2572 - 0.8) < 0.01


def test_snapshot_keeps_types_and_empty_columns(spark, tmp_path):
    from stratum.sources import io as IO
    import datetime as dt
    df = spark.createDataFrame([("a", None, dt.date(2020, 1, 1))], "k string, n int, d date")
    IO.write_snapshot(df, str(tmp_path), "1")
    assert IO.read_latest(spark, str(tmp_path), df.schema).collect() == df.collect()


def test_fetch_keeps_failed_and_missing_keys(spark):
    from stratum.sources import io as IO
    keys = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k long")
    answers = spark.createDataFrame([(1, '{"x":"a"}'), (2, '{"x'), (9, '{"x":"z"}')], "k long, body string")
    got = {tuple(r) for r in IO.fetch_by_key(keys, "k", answers, "x string").collect()}
    assert got == {(1, "success", None, "a"), (2, "failed", '{"x', None), (3, "not_found", None, None)}


def test_graph_order_follows_reads():
    from stratum.streaming import streams as ST
    seen = []
    out = ST.run_graph({"c": (["a", "b"], lambda a, b: seen.append("c") or a + b), "b": (["a"], lambda a: seen.append("b") or a * 2),
                        "a": ([], lambda: seen.append("a") or 1)})
    assert seen == ["a", "b", "c"] and out == {"a": 1, "b": 2, "c": 3}


def test_shared_dir_needs_a_location_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from stratum.session import shared_dir
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        shared_dir(cluster, "x")


def test_peer_average_excludes_self(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("b", None), ("c", 5.0)], "t string, x double")
    got = {r.t: r.peer_avg_x for r in A.peer_average(df, "t", ["x"]).collect()}
    assert got == {"a": 4.0, "b": 3.0, "c": 2.0}


def test_missing_from_both_sides(spark):
    a = spark.createDataFrame([("x",), ("y",)], "k string")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    got = {(r.k, r.side) for r in R.missing_from(a, b, ["k"]).collect()}
    assert got == {("x", "missing"), ("z", "unexpected")}


def test_fare_batch_defaults(spark):
    df = spark.createDataFrame([([1.0, 2.0], None, [8]), (None, None, None)], "d array<double>, p array<int>, h array<int>")
    r = df.select(Mo.fare_batch("d", "p", "h").alias("f")).collect()
    assert r[0].f == [8.0, 9.5] and r[1].f == []


def test_classify_default_label(spark):
    df = spark.createDataFrame([("zzz qqq",), ("The the and",)], "t string")
    r = df.select(D.classify("t", D.DOC_TYPE_LABELS).alias("c")).collect()
    assert r[0].c == "Other_Financial_Document" and r[1].c == "SEC_10K_Annual_Report"


def test_table_functions_match_bulk_forms_for_every_ticker(spark):
    fin, stock = C._fin(spark, SF_SMALL).cache(), C._stock(spark, SF_SMALL).cache()
    SF.register_sql_functions(spark, fin, stock)
    bulk = {"valuation_score": SF.valuation_scores(fin, stock), "compare_peers": SF.compare_peers_all(fin),
            "growth_trajectory": SF.growth_trajectories(fin), "risk_summary": SF.risk_summaries(fin, stock)}
    tickers = [r.ticker for r in fin.select("ticker").distinct().collect()]
    assert tickers
    for name, df in bulk.items():
        rows = {}
        for r in df.collect():
            rows.setdefault(r.ticker, []).append(r.asDict())
        for t in tickers:
            got = [r.asDict() for r in SF.call_table_function(spark, name, t).collect()]
            want = [{c: r[c] for c in got[0]} for r in rows[t]]
            assert sorted(map(repr, got)) == sorted(map(repr, want))
    theses = {r.ticker: r.thesis for r in SF.investment_theses(fin).collect()}
    for t in tickers:
        assert spark.sql("SELECT investment_thesis(:t) AS x", args={"t": t}).first().x == theses[t]


def test_stream_equals_batch(spark):
    from stratum.streaming import streams as ST
    out = ST.stream_bronze(spark, SF_SMALL)
    streamed = spark.read.parquet(out).select("doc_id", "document_type", "industry_sector")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    batch = ST.bronze(docs).select("doc_id", "document_type", "industry_sector")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_dedup_stream_is_idempotent(spark):
    df = C.REGISTRY["dedup_stream"](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert df.count() == docs.select(F.sha2("text", 256)).distinct().count()


def test_save_model_saves_the_production_forest(spark, monkeypatch):
    from conftest import SF_SMALL
    from stratum.plans import catalogue
    made, save = [], catalogue.Mo.save_model
    monkeypatch.setattr(catalogue.Mo, "save_model", lambda model, *rest: (made.append(model), save(model, *rest))[1])
    row = catalogue.q_save_model(spark, SF_SMALL).first()
    forest = next(s for s in made[0].stages if hasattr(s, "getNumTrees")) if hasattr(made[0], "stages") else made[0]
    assert forest.getNumTrees == 100 and forest.getOrDefault("maxDepth") == 10
    assert row.trips == row.equal > 0


def test_ranks_with_ties_and_many_nulls(spark):
    df = spark.createDataFrame([(i, None if i % 3 else float(i % 12), i % 2) for i in range(300)], "k int, x double, y int")
    got = ts.rank_peers(df, {"by_x": ("x", F.col("x").desc_nulls_last()), "by_y": ("y", F.col("y").asc())})
    xs = [r.x for r in df.collect()]
    for r in got.collect():
        above = sum(v is not None and (r.x is None or v > r.x) for v in xs)
        assert r.by_x == above + 1 and r.by_y == (1 if r.y == 0 else 151)
    assert got.count() == 300 and got.columns == ["k", "x", "y", "by_x", "by_y"]


def test_release_deletes_intermediate_tables(spark, monkeypatch):
    import os

    from stratum import session
    monkeypatch.setattr(session, "_WRITTEN", [])
    session.written(spark.range(3), "to-release")
    path = session._WRITTEN[0].removeprefix("file:")
    assert os.path.isdir(path) and session.release(spark) == 1 and not os.path.exists(path) and session.release(spark) == 0


def test_several_moving_averages_share_one_running_sum(spark):
    rows = [("a", i, None if i % 5 == 3 else i / 4) for i in range(30)] + [("b", 1, None), (None, 1, 2.5), (None, 2, 0.5)]
    df = spark.createDataFrame(rows, "k string, d int, v double")
    together = ts.moving_average(df, ["k"], ["d"], "v", (2, 7), exact_scale=2)
    single = ts.moving_average(ts.moving_average(df, ["k"], ["d"], "v", 2, exact_scale=2), ["k"], ["d"], "v", 7, exact_scale=2)
    assert sorted(map(repr, together.collect())) == sorted(map(repr, single.collect()))
    assert together._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 2


def test_summary_alone_writes_no_daily_prices(spark):
    m = C.M.Marts(spark, SF_SMALL)
    lazy = sorted(map(repr, m["stock_summary"].collect()))
    assert "stock_daily_prices" not in m._made
    n = C.M.Marts(spark, SF_SMALL)
    n["stock_daily_prices"]
    assert lazy == sorted(map(repr, n["stock_summary"].collect()))
