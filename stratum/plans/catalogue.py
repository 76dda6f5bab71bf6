"""Registered queries: name -> f(spark, sf_dir) -> DataFrame.

Each entry runs one operator (or one named report) over the whole driver
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import timeseries as ts
from stratum.plans import marts as M
from stratum.sources import fixtures as fx
from stratum.sources.fixtures import ticker_of
from stratum.sources.tables import Tables
from stratum.session import shared_dir, written

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# --- prices: E1-E8, G2, D11, I4 ------------------------------------------------------------------

def _dedup(spark, d):
    return ts.keep_latest(fx.raw_prices(spark, d), ["ticker", "trade_date"], fx.INGEST_ORDER)


def _daily(spark, d):
    return M.daily_prices(fx.raw_prices(spark, d))


@query("keep_latest")
def q_keep_latest(spark, d):
    return _dedup(spark, d)


@query("lag_return")
def q_lag_return(spark, d):
    out = ts.lag_return(_dedup(spark, d), ["ticker"], ["trade_date"], "close_price")
    return out.select("ticker", "trade_date", "close_price", "daily_return_pct")


@query("moving_average")
def q_moving_average(spark, d):
    out = ts.moving_average(_dedup(spark, d), ["ticker"], ["trade_date"], "close_price", (20, 50, 200), exact_scale=2)
    return out.select("ticker", "trade_date", "sma_20", "sma_50", "sma_200")


@query("rolling_stddev")
def q_rolling_stddev(spark, d):
    return _daily(spark, d).select("ticker", "trade_date", "daily_return_pct", "volatility_20d")


@query("daily_prices")
def q_daily_prices(spark, d):
    return _daily(spark, d)


@query("latest_per_key")
def q_latest_per_key(spark, d):
    return ts.latest_per_key(_daily(spark, d), ["ticker"], ["trade_date"]).select(
        "ticker", "trade_date", "close_price", "sma_50", "sma_200")


@query("year_range")
def q_year_range(spark, d):
    return ts.year_range(_daily(spark, d), "ticker", "trade_date", "close_price", M.DEFAULT_AS_OF)


@query("period_prices")
def q_period_prices(spark, d):
    return ts.period_prices(_daily(spark, d), "ticker", "trade_date", "close_price", M.DEFAULT_AS_OF)


@query("period_prices_strict")
def q_period_prices_strict(spark, d):
    return ts.period_prices(_daily(spark, d), "ticker", "trade_date", "close_price", M.DEFAULT_AS_OF,
                            strict=True)


@query("top_n_per_key")
def q_top_n_per_key(spark, d):
    """Last 5 prices per ticker (the recent-prices check)."""
    return ts.top_n_per_key(_daily(spark, d).select("ticker", "trade_date", "close_price"),
                            ["ticker"], ["trade_date"], 5, rank_col="rn")


@query("stock_summary")
def q_stock_summary(spark, d):
    """The flagship: one pass over the prices, one over the filing totals."""
    return M.stock_summary(_daily(spark, d), _reg(spark, d), M.DEFAULT_AS_OF, market=fx.market(spark, d))


@query("refresh_marts")
def q_refresh_marts(spark, d):
    """The price mart and the summary over it, kept up to date: first from a history in which one ticker has
    other prices and another is missing, then refreshed to the present one."""
    from stratum.plans.refreshed import RefreshedMart
    raw, registry, market = fx.raw_prices(spark, d), written(_reg(spark, d), "registry"), written(fx.market(spark, d), "market")
    prices, summary = RefreshedMart(spark, "daily_prices"), RefreshedMart(spark, "stock_summary")
    old = raw.where("ticker <> 'S3'").withColumn("close_price", F.when(F.col("ticker") == "S5", F.col("close_price") * 2)
                                                 .otherwise(F.col("close_price")))
    for history in (old, raw):
        prices.refresh({"raw": history}, lambda raw: M.daily_prices(raw))
        summary.refresh({"prices": prices, "registry": registry, "market": market},
                        lambda prices, registry, market: M.stock_summary(prices, registry, M.DEFAULT_AS_OF, market=market))
    return summary.table()


# --- trips: scalars B5-B15, B24, B25, aggregates D3-D9, D14-D15, D20, F1-F3, H1-H5, H12 ----------

from stratum.functions import scalars as S  # noqa: E402
from stratum.operators import aggregate as A  # noqa: E402
from stratum.operators import forests as Fo  # noqa: E402
from stratum.operators import models as Mo  # noqa: E402
from stratum.plans import trips as TR  # noqa: E402


def _trips(spark, d):
    return fx.trips(spark, d)


for _name, _fn in {
    "trip_totals": TR.trip_totals, "fares_for_all_trips": TR.fares_for_all,
    "tip_class_for_all_trips": TR.tip_class_for_all, "fares_by_period": TR.fares_by_period,
    "tips_by_day_type": TR.tips_by_day_type, "rush_hour_impact": TR.rush_hour_impact,
    "accuracy_metrics": TR.accuracy_metrics, "largest_errors": TR.largest_errors,
    "per_mile_by_passengers": TR.per_mile_by_passengers, "daily_summary": TR.daily_summary,
    "tip_distribution": TR.tip_distribution, "hourly_trend": TR.hourly_trend,
    "real_trips_scored": TR.real_trips_scored, "filter_then_score": TR.filter_then_score,
    "error_by_rush": TR.error_by_rush, "tip_distribution_averages": TR.tip_distribution_averages,
    "typical_class": TR.typical_class, "high_predicted_fares": TR.high_predicted_fares,
    "tip_analysis": TR.tip_analysis, "top_trips_by_fare": TR.top_trips_by_fare,
}.items():
    REGISTRY[_name] = (lambda f: lambda spark, d: f(_trips(spark, d)))(_fn)


@query("time_period")
def q_time_period(spark, d):
    t = _trips(spark, d)
    return t.select("trip_id", "hour_of_day", S.time_period("hour_of_day").alias("time_period"),
                    S.time_period("hour_of_day", long=True).alias("time_period_long"))


@query("day_name")
def q_day_name(spark, d):
    t = _trips(spark, d)
    return t.select("trip_id", "day_of_week", S.day_name("day_of_week").alias("day_name"),
                    S.flag_label("is_weekend", "Weekend", "Weekday").alias("day_type"))


@query("is_rush_hour")
def q_is_rush_hour(spark, d):
    t = _trips(spark, d)
    return t.select("trip_id", S.is_rush_hour("hour_of_day").alias("is_rush_hour"),
                    S.is_weekend("day_of_week").alias("is_weekend"))


@query("valid_trips")
def q_valid_trips(spark, d):
    return S.valid_trips(_trips(spark, d)).select("trip_id", "trip_distance", "fare_amount", "passenger_count")


@query("resolve_columns")
def q_resolve_columns(spark, d):
    """Raw events with drifting names -> canonical trip columns."""
    ev = Tables(spark, d).events
    out = S.resolve_columns(ev, {"trip_id": ["event_id", "id"], "trip_distance": ["value", "distance"],
                                 "pickup_ts": ["ts", "tpep_pickup_datetime"], "vendor": ["vendor_id"]},
                            {"vendor": "unknown"})
    return out.select("trip_id", "trip_distance", "pickup_ts", "vendor")


@query("fill_defaults")
def q_fill_defaults(spark, d):
    """Numeric coercion of the props text (bad -> NULL), NULLs -> median; a
    missing column is added with its constant default."""
    ev = Tables(spark, d).events.select(
        "event_id", F.get_json_object("props", "$.k").alias("k_text"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("value"))
    out = S.fill_defaults(ev.withColumnRenamed("k_text", "k"), {"value": "median", "rating": 3.0}, numeric=["k"])
    return out.select("event_id", "k", "value", "rating")


@query("clip")
def q_clip(spark, d):
    t = _trips(spark, d)
    return t.select("trip_id", S.clip("trip_distance", 0.5, 100.0).alias("distance_clipped"),
                    S.clip("tip_amount", lo=0.0).alias("tip_floor"))


@query("tip_category")
def q_tip_category(spark, d):
    return Mo.tip_category(_trips(spark, d)).select("trip_id", "tip_amount", "tip_category")


@query("date_parts")
def q_date_parts(spark, d):
    t = Tables(spark, d).events
    return t.select("event_id", S.hour_of("ts").alias("hour"), S.weekday_of("ts").alias("dow"),
                    F.to_date("ts").alias("day"),
                    F.date_sub(F.to_date("ts"), 365).alias("year_before"),
                    F.date_add(F.to_date("ts"), 1).alias("next_day"),
                    S.ms_to_timestamp(F.col("event_id") * 1000 + 1704067200000).cast("timestamp_ntz")
                    .alias("from_ms"))


@query("abs_error")
def q_abs_error(spark, d):
    s = TR.fared(_trips(spark, d))
    return s.select("trip_id", S.abs_error("actual_fare", "predicted_fare").alias("absolute_error"),
                    S.pct_error("actual_fare", "predicted_fare").alias("error_pct"),
                    F.round(F.sqrt(F.pow(F.col("actual_fare") - F.col("predicted_fare"), 2)), 2).alias("rms_part"))


@query("predict_taxi_fare")
def q_predict_taxi_fare(spark, d):
    t = _trips(spark, d)
    return t.select("trip_id", F.round(Mo.fare_rule("trip_distance", rush="is_rush_hour"), 2).alias("predicted_fare"))


@query("predict_tip_category")
def q_predict_tip_category(spark, d):
    return TR.scored(_trips(spark, d)).select("trip_id", "predicted_tip_category")


@query("predict_taxi_json")
def q_predict_taxi_json(spark, d):
    s = TR.scored(_trips(spark, d))
    return s.select("trip_id", Mo.prediction_json(s).alias("prediction_json"))


@query("predict_fare_batch")
def q_predict_fare_batch(spark, d):
    """One array call per batch of 100 consecutive trip ids (bounded arrays)."""
    t = _trips(spark, d)
    g = t.groupBy("passenger_count", F.floor(F.col("trip_id") / 100).alias("batch")).agg(
        F.sort_array(F.collect_list(F.struct("trip_id", "trip_distance", "hour_of_day"))).alias("xs"))
    return g.select("passenger_count", "batch", Mo.fare_batch(
        F.transform("xs", lambda x: x["trip_distance"]), F.array(),
        F.transform("xs", lambda x: x["hour_of_day"])).alias("fares"))


@query("as_json")
def q_as_json(spark, d):
    t = _trips(spark, d)
    return t.select("trip_id", S.as_json("trip_distance", "passenger_count",
                                         F.struct("hour_of_day", "day_of_week").alias("when")).alias("js"))


@query("with_row_id")
def q_with_row_id(spark, d):
    """All columns of the trips along the fare."""
    return ts.with_row_id(_trips(spark, d), [F.col("fare_amount").desc(), F.col("trip_id")])


@query("quantiles")
def q_quantiles(spark, d):
    return A.quantiles(_trips(spark, d), "fare_amount", (0.25, 0.33, 0.67, 0.75))


@query("quantiles_by")
def q_quantiles_by(spark, d):
    """D14 by group: fares by hour and passengers."""
    return A.quantiles(_trips(spark, d), "fare_amount", (0.25, 0.9), by=["hour_of_day", "passenger_count"])


@query("value_counts")
def q_value_counts(spark, d):
    return A.value_counts(_trips(spark, d), "passenger_count")


@query("profile")
def q_profile(spark, d):
    return A.profile(_trips(spark, d), ["trip_distance", "passenger_count"]).select(
        "column", "count", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"), "min", "max")


@query("error_metrics")
def q_error_metrics(spark, d):
    s = TR.fared(_trips(spark, d))
    return A.error_metrics(s, "actual_fare", "predicted_fare", by=["is_rush_hour"], scale=4)


# --- filings and marts: A11, A12, A14, B1-B4, B23, B35, C1-C5, C8, C9, D10, E9, E10, G1-G3, H6-H10, J4

from stratum.functions import sql_functions as SF  # noqa: E402
from stratum.operators import checks as CK  # noqa: E402
from stratum.operators import relate as R  # noqa: E402


def _silver(spark, d):
    return fx.silver_filings(spark, d)


def _reg(spark, d):
    return M.company_registry(fx.silver_filings(spark, d, breakdowns=False))


def _fin(spark, d):
    s = fx.silver_filings(spark, d, breakdowns=False)
    return M.company_financials(s, M.company_registry(s))


def _stock(spark, d):
    return M.stock_summary(_daily(spark, d), _reg(spark, d), M.DEFAULT_AS_OF, market=fx.market(spark, d))


@query("company_registry")
def q_company_registry(spark, d):
    return _reg(spark, d)


@query("company_financials")
def q_company_financials(spark, d):
    return _fin(spark, d)


@query("revenue_by_segment")
def q_revenue_by_segment(spark, d):
    return M.Marts(spark, d)["revenue_by_segment"]


@query("revenue_by_geography")
def q_revenue_by_geography(spark, d):
    return M.Marts(spark, d)["revenue_by_geography"]


@query("company_overview")
def q_company_overview(spark, d):
    return M.Marts(spark, d)["company_overview"]


@query("peer_comparison")
def q_peer_comparison(spark, d):
    return M.Marts(spark, d)["peer_comparison"]


@query("stock_performance")
def q_stock_performance(spark, d):
    return M.Marts(spark, d)["stock_performance"]


@query("revenue_breakdown")
def q_revenue_breakdown(spark, d):
    return M.Marts(spark, d)["revenue_breakdown"]


@query("valuation_score")
def q_valuation_score(spark, d):
    m = M.Marts(spark, d)
    return SF.valuation_scores(m["company_financials"], m["stock_summary"])


@query("compare_peers")
def q_compare_peers(spark, d):
    m = M.Marts(spark, d)
    return SF.compare_peers_all(m["company_financials"])


@query("investment_thesis")
def q_investment_thesis(spark, d):
    return SF.investment_theses(_fin(spark, d))


@query("growth_trajectory")
def q_growth_trajectory(spark, d):
    return SF.growth_trajectories(_fin(spark, d))


@query("risk_summary")
def q_risk_summary(spark, d):
    m = M.Marts(spark, d)
    return SF.risk_summaries(m["company_financials"], m["stock_summary"])


@query("first_known")
def q_first_known(spark, d):
    """Identity chain: extracted name, registry name, file stem."""
    s = _silver(spark, d)
    r = M.company_registry(s).select(F.col("ticker").alias("r_ticker"), F.col("company_name").alias("r_name"))
    x = s.withColumn("x_ticker", S.vpath("extracted_metrics", "response.ticker_symbol"))
    j = R.with_registry(x, r, "x_ticker", "r_ticker")
    return j.select("file_name", S.first_known(S.vpath("extracted_metrics", "response.company_name"), "r_name",
                                               "company_key").alias("company"),
                    S.first_known("x_ticker", "r_ticker", "company_key").alias("ticker"))


@query("vpath")
def q_vpath(spark, d):
    s = _silver(spark, d)
    v = "extracted_metrics"
    return s.select("file_name", S.vpath(v, "response.fiscal_year", "int").alias("fiscal_year"),
                    S.vpath(v, "response.total_revenue_billions", "double").alias("revenue"),
                    S.vpath(v, "response.no_such_field").alias("missing"),
                    S.vpath(v, "response.company_name", "int").alias("bad_cast"),
                    S.json_path(F.col("file_name").alias("x"), "a").alias("not_json"))


@query("pct")
def q_pct(spark, d):
    f = _fin(spark, d)
    return f.select("ticker", "fiscal_year", "gross_margin_pct", "operating_margin_pct", "net_margin_pct",
                    S.pct(F.col("total_revenue_billions") - F.col("total_revenue_billions"),
                          F.col("total_revenue_billions") - F.col("total_revenue_billions")).alias("zero_div"))


@query("null_as")
def q_null_as(spark, d):
    """Registry rows with the typed placeholders of the valuation columns."""
    return _reg(spark, d).select("ticker", *[S.null_as("double").alias(c) for c in M.VALUATION_COLS])


@query("above")
def q_above(spark, d):
    return _daily(spark, d).select("ticker", "trade_date", S.above("close_price", "sma_50").alias("above_sma_50"),
                                   S.above("close_price", "sma_200").alias("above_sma_200"))


@query("trend_signal")
def q_trend_signal(spark, d):
    return _daily(spark, d).select("ticker", "trade_date",
                                   S.trend_signal("close_price", "sma_50", "sma_200").alias("trend_signal"))


@query("present")
def q_present(spark, d):
    s = _silver(spark, d)
    return s.select("file_name", S.vpath("extracted_metrics", "response.ticker_symbol").alias("t")) \
        .filter(S.present("t"))


@query("sentence")
def q_sentence(spark, d):
    """One line per daily price; the first price of a ticker has no return, so no line."""
    return _daily(spark, d).select("ticker", "trade_date", S.sentence(
        F.col("ticker"), F.lit(" closed at "), S.num_text("close_price", 2), F.lit(" ("),
        S.num_text("daily_return_pct", 2), F.lit("%)")).alias("line"))


@query("parse_array")
def q_parse_array(spark, d):
    s = _silver(spark, d)
    arr = S.parse_array(F.to_json(F.try_variant_get("extracted_metrics", "$.response.business_segments", "variant")),
                        "array<struct<segment_name:string,segment_revenue_billions:double>>")
    return s.select("file_name", F.size(arr).alias("n_segments"),
                    F.get(arr, 0)["segment_name"].alias("first_segment"))


@query("with_registry")
def q_with_registry(spark, d):
    daily = _daily(spark, d).select("ticker", "trade_date", "close_price")
    reg = _reg(spark, d).select(F.col("ticker").alias("r_ticker"), "company_name", "industry_sector")
    return R.with_registry(daily, reg, "ticker", "r_ticker").drop("r_ticker")


@query("score_inputs")
def q_score_inputs(spark, d):
    f = _fin(spark, d).select("ticker", "fiscal_year", "gross_margin_pct")
    s = _stock(spark, d).select("ticker", "current_price", "trend_signal")
    return R.score_inputs(f, s, "ticker", F.col("gross_margin_pct") > 20)


@query("cross_one")
def q_cross_one(spark, d):
    m = M.Marts(spark, d)
    return R.cross_one(m["company_financials"], m["stock_summary"],
                       [F.round(F.avg("gross_margin_pct"), 4).alias("avg_margin"), F.count(F.lit(1)).alias("filings")],
                       [F.count(F.lit(1)).alias("tickers"), F.max("current_price").alias("max_price")])


@query("explode_items")
def q_explode_items(spark, d):
    s = _silver(spark, d)
    arr = S.parse_array(F.to_json(F.try_variant_get("extracted_metrics", "$.response.geographic_revenue", "variant")),
                        "array<struct<region:string,region_revenue_billions:double>>")
    return R.explode_items(s.select("file_name", arr.alias("regions")), "regions", "r").select(
        "file_name", F.col("r.region").alias("region"), F.col("r.region_revenue_billions").alias("revenue"))


@query("missing_from")
def q_missing_from(spark, d):
    """Customers and order keys: customers without an order, and the reverse."""
    t = Tables(spark, d)
    return R.missing_from(t.customer.select(F.col("c_custkey").alias("custkey")),
                          t.orders.select(F.col("o_custkey").alias("custkey")), ["custkey"])


@query("missing_from_years")
def q_missing_from_years(spark, d):
    """Customers who ordered in 1995 and not in 1996, and the reverse."""
    o = Tables(spark, d).orders.select(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("y"))
    return R.missing_from(o.where("y = 1995").select("custkey"), o.where("y = 1996").select("custkey"), ["custkey"])


@query("peer_average")
def q_peer_average(spark, d):
    return A.peer_average(_fin(spark, d), "ticker", ["revenue_growth_yoy_pct", "gross_margin_pct", "net_margin_pct"])


@query("rank_peers")
def q_rank_peers(spark, d):
    """Orders ranked by price and by date over the whole table."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("o_day"))
    return ts.rank_peers(o, {"price_rank": ("o_totalprice", F.col("o_totalprice").desc_nulls_last()),
                             "day_rank": ("o_day", F.col("o_day").asc_nulls_last())})


@query("rank_in_key")
def q_rank_in_key(spark, d):
    m = M.Marts(spark, d)
    return M.revenue_by_segment(m["silver_filings"], m["company_registry"], by_year=True).select(
        "ticker", "fiscal_year", "segment_name", "segment_rank")


@query("tagged_union")
def q_tagged_union(spark, d):
    f = _fin(spark, d).select("ticker", F.col("total_revenue_billions").alias("value"))
    s = _stock(spark, d).select("ticker", F.col("current_price").alias("value"), "trend_signal")
    return R.tagged_union({"financials": f, "stock": s}, "source")


@query("merge_history")
def q_merge_history(spark, d):
    """History (ship year < 2000) and a refresh (from mid-1999, overlapping)
    unioned and de-duplicated: equals the silver table of all rows."""
    raw = fx.raw_prices(spark, d)
    hist = raw.filter(F.year("trade_date") < 2000)
    refresh = raw.filter(F.col("trade_date") >= F.lit("1999-07-01").cast("date"))
    return M.daily_prices(hist, refresh).select("ticker", "trade_date", "close_price", "sma_20")


@query("unique_by")
def q_unique_by(spark, d):
    return R.unique_by(fx.raw_prices(spark, d).select("ticker", "trade_date", "close_price", "ingestion_timestamp"),
                       ["ticker"], [F.col("trade_date").desc(), F.col("ingestion_timestamp").desc(),
                                    F.col("close_price").desc()])


@query("build_marts")
def q_build_marts(spark, d):
    """A12 + A14: every mart built and written, then the row-count gate over them."""
    return CK.row_gate(M.Marts(spark, d).build_marts())


@query("build_views")
def q_build_views(spark, d):
    """A11 + A14: the four views over the written marts, queried by name through SQL."""
    M.Marts(spark, d).build_views()
    return CK.row_gate({v: spark.sql(f"SELECT * FROM {v}") for v in M.Marts.VIEWS})


# --- inventory and traces: B17-B22, B26-B33, C6, C7, D12, D13, D17-D19, F4, K1-K12 ---------------

from stratum.operators import inventory as K  # noqa: E402


def _flat(spark, d):
    return K.flatten_endpoints(fx.endpoints(spark, d))


FLAT_COLS = ["name", "id", "endpoint_type", "task", "creator", "created_at", "updated_at", "state_ready",
             "config_update", "entity_type", "entity_name", "entity_version", "model_name", "registered_model_name",
             "model_provider",
             "scale_to_zero", "workload_size", "tag_count", "tile_id", "problem_type", "endpoint_category",
             "model_type"]


@query("flatten_endpoints")
def q_flatten_endpoints(spark, d):
    f = _flat(spark, d)
    return f.select(*FLAT_COLS, F.col("tags")["segment"].alias("segment_tag"),
                    F.col("gateway.usage_tracking_enabled").alias("usage_tracking_enabled"),
                    F.col("gateway.inference_table_catalog").alias("inference_table_catalog"),
                    F.col("gateway.rate_limits_count").alias("rate_limits_count"),
                    F.col("gateway.guardrails_enabled").alias("guardrails_enabled"))


@query("model_type")
def q_model_type(spark, d):
    return _flat(spark, d).select("name", "model_type")


@query("model_type_fast")
def q_model_type_fast(spark, d):
    return K.flatten_endpoints(fx.endpoints(spark, d), fast=True).select("name", "model_type")


@query("endpoint_category")
def q_endpoint_category(spark, d):
    return _flat(spark, d).select("name", "entity_type", "endpoint_category")


@query("gateway_settings")
def q_gateway_settings(spark, d):
    return _flat(spark, d).select("name", "gateway.*").withColumn("rate_limits", F.to_json("rate_limits"))


@query("inventory_summary")
def q_inventory_summary(spark, d):
    return K.summary(_flat(spark, d))


@query("family_slice")
def q_family_slice(spark, d):
    return K.family_slice(_flat(spark, d))


@query("health")
def q_health(spark, d):
    return K.health(_flat(spark, d))


@query("providers")
def q_providers(spark, d):
    return K.providers(_flat(spark, d)).withColumn("scope", F.lit("all")).unionByName(
        K.providers(_flat(spark, d), external_only=True).withColumn("scope", F.lit("external")))


@query("format_assistants")
def q_format_assistants(spark, d):
    return K.format_assistants(fx.assistants(spark, d)).drop("raw")


@query("class_listing")
def q_class_listing(spark, d):
    return K.class_listing(_flat(spark, d))


@query("frequency")
def q_frequency(spark, d):
    """Top-20 model names (blank -> 'unknown')."""
    return A.frequency(_flat(spark, d), "model_name", top=20, out="model_name")


@query("class_counts")
def q_class_counts(spark, d):
    f = _flat(spark, d)
    return A.class_counts(f, {"foundation": F.col("endpoint_category") == "foundation_model",
                              "external": F.col("endpoint_category") == "external_model",
                              "agent": F.col("endpoint_category") == "agent",
                              "ready": F.col("state_ready") == "READY",
                              "tracking_enabled": F.col("gateway.usage_tracking_enabled"),
                              "guardrails": F.col("gateway.guardrails_enabled")})


@query("enrich_tiles")
def q_enrich_tiles(spark, d):
    f = _flat(spark, d).select("name", "tile_id", "model_type")
    t = fx.tiles(spark, d).withColumnRenamed("name", "title").withColumnRenamed("serving_endpoint_name", "name")
    return R.enrich_lookup(f, t, "name", "fetch_order", {"tile_id": "tile_id", "tile_name": "title"})


@query("with_details")
def q_with_details(spark, d):
    a = fx.assistants(spark, d)
    items = a.select("id", "name")
    details = a.filter(F.col("id").substr(4, 10).cast("int") % 3 != 0).select("id", "description", "endpoint_name")
    return R.with_details(items, details, "id", ["description", "endpoint_name"])


@query("has_prefix")
def q_has_prefix(spark, d):
    f = _flat(spark, d)
    return f.select("name", S.has_prefix("name", "databricks-").alias("pay_per_token"),
                    S.mentions("task", "AGENT").alias("mentions_agent"))


@query("ellipsis")
def q_ellipsis(spark, d):
    a = fx.assistants(spark, d)
    return a.select("id", S.ellipsis("instructions", 50).alias("i50"), S.ellipsis("instructions", 80).alias("i80"))


@query("strip_version")
def q_strip_version(spark, d):
    return _flat(spark, d).select("name", S.strip_version("name").alias("family"))


@query("sanitize")
def q_sanitize(spark, d):
    a = fx.assistants(spark, d)
    return a.select("id", S.sanitize(F.concat(F.lit("  "), F.coalesce("display_name", F.lit("")),
                                              F.lit(" -- KA #"))).alias("safe_name"))


@query("source_name")
def q_source_name(spark, d):
    p = Tables(spark, d).pages
    return p.select("page_id", S.source_name(F.regexp_extract("url", r"^https?://[^/]+(/[^?#]*)", 1),
                                             F.col("page_id")).alias("source_name"))


@query("categorize")
def q_categorize(spark, d):
    s = fx.spans(spark, d)
    return s.select("span_id", "name", S.categorize("name", K.TOOL_PATTERNS).alias("category"))


@query("tags_map")
def q_tags_map(spark, d):
    e = fx.endpoints(spark, d)
    m = S.tags_map("tags")
    return e.select("name", S.list_size("tags").alias("n_tags"), F.size(m).alias("n_keyed"),
                    m["segment"].alias("segment"))


@query("first_of")
def q_first_of(spark, d):
    e = fx.endpoints(spark, d)
    return e.select("name", S.first_of("config.served_entities", "type", "none").alias("first_type"),
                    S.first_of("config.served_entities", "workload_size", "").alias("first_size"))


@query("nest")
def q_nest(spark, d):
    n = K.nest(_flat(spark, d))
    return n.select("name", "state.ready", "entity.entity_type", "model.model_type", "derived.is_ready",
                    "derived.model_family")


@query("filter_by")
def q_filter_by(spark, d):
    f = _flat(spark, d)
    return S.filter_by(f, state_ready="READY", endpoint_category=["agent", "external_model"]).select(
        "name", "endpoint_category")


@query("tool_calls")
def q_tool_calls(spark, d):
    return K.tool_calls(fx.spans(spark, d))


@query("trace_totals")
def q_trace_totals(spark, d):
    return K.trace_totals(fx.spans(spark, d))


@query("tools_vs_expected")
def q_tools_vs_expected(spark, d):
    return K.tools_vs_expected(fx.spans(spark, d), fx.expected_tools(spark, d))


@query("validate_traces")
def q_validate_traces(spark, d):
    v = K.tools_vs_expected(fx.spans(spark, d), fx.expected_tools(spark, d))
    return v.select("trace_id", "success", F.size("missing_tools").alias("n_missing"),
                    F.size("unexpected_tools").alias("n_unexpected"), "llm_calls")


@query("latest_trace")
def q_latest_trace(spark, d):
    """Newest trace per day within the 5 minutes before 12:00 of that day."""
    return K.latest_trace_per_day(fx.spans(spark, d), hour=12, minutes=5)


@query("response_text")
def q_response_text(spark, d):
    r = fx.responses(spark, d)
    return r.select("conv_id", "turn", S.response_text("response_json").alias("text"),
                    S.response_text("response_json", first_only=True).alias("first_text"))


@query("missing_phrases")
def q_missing_phrases(spark, d):
    r = fx.responses(spark, d)
    miss = S.missing_phrases(S.response_text("response_json"), "expected_phrases")
    return r.select("conv_id", "turn", F.array_sort(miss).alias("missing"), (F.size(miss) == 0).alias("ok"))


@query("score_responses")
def q_score_responses(spark, d):
    r = fx.responses(spark, d).select("conv_id", S.response_text("response_json").alias("t"))
    scored = r.select("conv_id", F.length("t").alias("length"), S.error_free("t").alias("no_error"))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("length"), 4).alias("mean_length"),
                      F.round(F.avg("no_error"), 4).alias("mean_no_error"))


@query("recommend")
def q_recommend(spark, d):
    m = M.Marts(spark, d)
    v = SF.valuation_scores(m["company_financials"], m["stock_summary"])
    peer = A.peer_average(v, "ticker", ["valuation_score"])
    return v.join(peer, "ticker").select(
        "ticker", "fiscal_year", "valuation_score", S.recommend("valuation_score").alias("recommendation"),
        S.versus_peer("valuation_score", "peer_avg_valuation_score").alias("versus_peer"),
        F.round(F.abs(F.col("valuation_score") - F.col("peer_avg_valuation_score")), 2).alias("peer_diff"))


@query("run_summary")
def q_run_summary(spark, d):
    r = fx.responses(spark, d)
    t = S.response_text("response_json")
    res = r.select(((S.error_free(t) == 1) & (F.size(S.missing_phrases(t, "expected_phrases")) == 0)).alias("passed"),
                   (F.size("expected_phrases") > 0).alias("validated"), (F.length(t) / 1000.0).alias("duration_s"))
    return A.run_summary(res)


# --- documents, pages, conversations: B16, D21, J1-J3, J5-J7, I1, I2, I5, A1, A2, A15 ------------

from stratum.operators import bayes as By  # noqa: E402
from stratum.operators import documents as D  # noqa: E402
from stratum.operators import elements as El  # noqa: E402
from stratum.operators import index as Ix  # noqa: E402
from stratum.streaming import streams as ST  # noqa: E402


@query("parse_docs")
def q_parse_docs(spark, d):
    p = D.parse_docs(Tables(spark, d).pages)
    return p.select("page_id", "title", "parsed_content", "n_chars", F.size("elements").alias("n_elements"))


@query("element_tree")
def q_element_tree(spark, d):
    """The elements of every page that have text of their own, in document order."""
    e = El.parse_elements(Tables(spark, d).pages).select("page_id", F.posexplode(F.filter("elements", lambda e: e["text"] != "")))
    return e.select("page_id", (F.col("pos") + 1).cast("bigint").alias("n"), F.col("col.type").alias("type"), F.col("col.text").alias("text"))


@query("extract_schema")
def q_extract_schema(spark, d):
    """Filing texts, parsed and extracted by schema: 16 scalars and the sums over two arrays of objects."""
    texts = written(fx.filing_texts(fx.silver_filings(spark, d)), "filing-texts")
    m = written(El.silver_from_texts(texts), "silver-from-texts")
    kinds = {"string": "string", "integer": "int", "number": "double"}
    props = El.FILING_SCHEMA["properties"]
    scalars = [F.variant_get("extracted_metrics", f"$.response.{n}", kinds[s["type"]]).alias(n) for n, s in props.items() if s["type"] != "array"]

    def rows(name: str, first: str, second: str):
        return F.variant_get("extracted_metrics", f"$.response.{name}", f"array<struct<{first}: string, {second}: double>>").alias(name)

    def sums(name: str, first: str, second: str):
        total = F.aggregate(name, F.lit(0).cast("bigint"), lambda a, r: a + F.round(r[second] * 1e8).cast("bigint"))
        return F.size(name).cast("bigint").alias(f"n_{name}"), total.alias(f"cents_{name}"), F.array_join(
            F.array_sort(F.transform(name, lambda r: r[first])), "|").alias(f"names_{name}")
    arrays = [("business_segments", "segment_name", "segment_revenue_billions"), ("geographic_revenue", "region", "region_revenue_billions")]
    read = m.select("file_name", *scalars, *[rows(*a) for a in arrays])
    return read.select("file_name", *[F.col(n) for n, s in props.items() if s["type"] != "array"], *[c for a in arrays for c in sums(*a)])


@query("financials_from_texts")
def q_financials_from_texts(spark, d):
    """The financial mart over silver extracted from filing texts."""
    texts = written(fx.filing_texts(fx.silver_filings(spark, d)), "filing-texts")
    silver = written(El.silver_from_texts(texts), "silver-from-texts")
    return M.company_financials(silver, M.company_registry(silver))


@query("classify")
def q_classify(spark, d):
    docs = D.with_tokens(Tables(spark, d).documents.select("doc_id", "text"), "text")
    return docs.select("doc_id", D.classify("_tokens", D.DOC_TYPE_LABELS, tokenized=True).alias("document_type"),
                       D.classify("_tokens", D.SECTOR_LABELS, tokenized=True).alias("industry_sector"))


QUALITY_LABELS = ("junk", "toxic", "good")


@query("classify_quality")
def q_classify_quality(spark, d):
    """A classifier fitted on the labels of even ids, applied to every document; "good" is the default."""
    t = Tables(spark, d)
    judged = t.labels.where("doc_id % 2 = 0").select("doc_id", F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic")
                                                     .otherwise("good").alias("label"))
    docs = t.documents.select("doc_id", "text")
    model = By.fit_naive_bayes(docs.join(judged, "doc_id"), QUALITY_LABELS)
    return By.classify_texts(docs, model, out="quality_class")


@query("classify_language")
def q_classify_language(spark, d):
    """Languages learned from the documents of even ids, told for every document."""
    docs = Tables(spark, d).documents.select("doc_id", "text", F.col("lang").alias("label"))
    model = By.fit_naive_bayes(docs.where("doc_id % 2 = 0"), ("de", "es", "fr", "en"))
    return By.classify_texts(docs.drop("label"), model, out="language")


@query("extract")
def q_extract(spark, d):
    docs = Tables(spark, d).documents
    v = D.extract("text")
    return docs.select("doc_id", v.alias("m")).select(
        "doc_id", F.variant_get("m", "$.response.title", "string").alias("title"),
        F.variant_get("m", "$.response.n_words", "int").alias("n_words"),
        F.variant_get("m", "$.response.emails", "array<string>").alias("emails"),
        F.variant_get("m", "$.response.license_line", "string").alias("license_line"),
        F.variant_get("m", "$.response.n_years", "int").alias("n_years"),
        F.variant_get("m", "$.response.has_license", "boolean").alias("has_license"))


@query("file_stem")
def q_file_stem(spark, d):
    docs = Tables(spark, d).documents
    name = F.concat(F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return docs.select("doc_id", name.alias("file_name"), S.file_stem(name).alias("company_key"))


def _doc_files(spark, d):
    docs = Tables(spark, d).documents
    return docs.select(F.concat(F.lit("/docs/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
                       .alias("path"), "doc_id", "n_chars",
                       # what an index run reports: by language, so that every status occurs
                       F.when(F.col("lang") == "de", "skipped").when(F.coalesce("n_chars", F.lit(0)) == 0, "failed")
                       .otherwise("success").alias("status"))


@query("sync_source")
def q_sync_source(spark, d):
    files = _doc_files(spark, d)
    manifest = files.filter(F.col("doc_id") % 3 == 0)
    new, _ = D.sync_source(files, manifest)
    return new.select("path", "status")


@query("index_status")
def q_index_status(spark, d):
    files = _doc_files(spark, d)
    _, totals = D.sync_source(files, files.filter(F.col("doc_id") % 3 == 0))
    return totals


@query("manifest_check")
def q_manifest_check(spark, d):
    files = _doc_files(spark, d).select(F.col("path").alias("name"), F.col("n_chars").alias("length"))
    expected = Tables(spark, d).labels.select(
        F.concat(F.lit("/docs/src"), (F.col("doc_id") % 20).cast("string"), F.lit("/"), F.col("doc_id").cast("string"),
                 F.lit(".txt")).alias("name"))
    return CK.manifest_check(files, expected, suffix=".txt")


@query("retrieve")
def q_retrieve(spark, d):
    t = Tables(spark, d)
    return D.retrieve(t.benchmark, t.documents, k=3)


def _index_of_syncs(spark, d):
    """An index after two syncs: first other texts for some documents, some missing and some that go later; then all documents."""
    docs = Tables(spark, d).documents.select("doc_id", "text")
    before = docs.where("doc_id % 3 <> 0").withColumn("text", F.when(F.col("doc_id") % 7 == 1, F.concat(
        F.coalesce("text", F.lit("")), F.lit(" x"))).otherwise(F.col("text")))
    gone = docs.where("doc_id % 5 = 0").withColumn("doc_id", -1 - F.col("doc_id"))
    index = Ix.TextIndex(spark)
    index.sync(before.union(gone))
    return index, index.sync(docs)


@query("sync_index")
def q_sync_index(spark, d):
    """What a sync of the text index did, after one with other texts."""
    return _index_of_syncs(spark, d)[1]


@query("retrieve_indexed")
def q_retrieve_indexed(spark, d):
    """J6 over an index that syncs have built: segments, tombstones, blocks skipped by their maxima."""
    return _index_of_syncs(spark, d)[0].retrieve(Tables(spark, d).benchmark, k=3)


@query("with_history")
def q_with_history(spark, d):
    h = D.with_history(Tables(spark, d).conversations, block=2)
    return h.select("conv_id", "block", "earlier", F.transform("messages", lambda m: m["role"]).alias("roles"),
                    F.transform("messages", lambda m: m["content"]).alias("texts"))


@query("stream_bronze")
def q_stream_bronze(spark, d):
    """I1 run as a triggered stream; the result is read back from its sink."""
    out = ST.stream_bronze(spark, d)
    return spark.read.parquet(out).select("doc_id", "document_type", "industry_sector")


@query("stream_silver")
def q_stream_silver(spark, d):
    """I1 then I2 as triggered streams (stage -> stage)."""
    out = ST.stream_silver(spark, ST.stream_bronze(spark, d))
    return spark.read.parquet(out).select(
        "doc_id", F.variant_get("extracted_metrics", "$.response.n_words", "int").alias("n_words"))


@query("dedup_stream")
def q_dedup_stream(spark, d):
    """Exact-copy documents dropped on the text hash by a stream that runs
    twice over the same input with fresh checkpoints (the second run adds nothing)."""
    root = shared_dir(spark, "dedup")
    for run in (1, 2):
        keyed = ST.stream_documents(spark, d).select(F.sha2("text", 256).alias("text_hash"), "doc_id")
        ST.dedup_stream(keyed, ["text_hash"], f"{root}/data", f"{root}/_checkpoint{run}", run)
    return spark.read.parquet(f"{root}/data").select("text_hash")


# --- sources / sinks, price checks, incremental load, models: A3-A10, A13, D1, D2, D11, D16, H3, H13-H15, I4

from stratum.sources import io as IO  # noqa: E402


@query("read_table")
def q_read_table(spark, d):
    """A3 + A10: tables registered as temporary views, queried by SQL."""
    Tables(spark, d).register_views()
    return spark.sql("SELECT n_name, COUNT(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey "
                     "GROUP BY n_name")


@query("fetch_by_key")
def q_fetch_by_key(spark, d):
    """A4: a registry answer per distinct supplier key of the line items; the
    suppliers' answers are derived as JSON, some cut off, some missing."""
    t = Tables(spark, d)
    k = F.col("s_suppkey")
    body = F.to_json(F.struct(ticker_of(k).alias("ticker"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")))
    answers = t.supplier.where(k % 13 != 0).select(k.alias("suppkey"), F.when(k % 17 == 0, F.substring(body, 1, 9)).otherwise(body).alias("body"))
    return IO.fetch_by_key(t.lineitem.select(F.col("l_suppkey").alias("suppkey")), "suppkey", answers,
                           "ticker string, name string, nation long")


@query("price_profile")
def q_price_profile(spark, d):
    return A.price_profile(_daily(spark, d), "ticker", "close_price")


@query("count_distinct")
def q_count_distinct(spark, d):
    return A.count_distinct(fx.raw_prices(spark, d), "ticker", "tickers")


@query("high_water")
def q_high_water(spark, d):
    return ts.high_water(_dedup(spark, d), "ticker", "trade_date")


@query("incremental")
def q_incremental(spark, d):
    """I4: the target holds the history before 2000 without every 9th ticker;
    the refresh, as of the last day in the source, brings the later rows of
    known tickers and the last 30 days of new ones."""
    raw = _dedup(spark, d)
    target = raw.filter((F.year("trade_date") < 2000) & (F.substring("ticker", 2, 10).cast("int") % 9 != 0))
    as_of = raw.agg(F.max("trade_date")).first()[0]
    return ts.incremental(raw, target, "ticker", "trade_date", as_of).select("ticker", "trade_date", "close_price")


@query("incremental_dry_run")
def q_incremental_dry_run(spark, d):
    """I4 dry run: what the refresh would append, per ticker."""
    raw = _dedup(spark, d)
    target = raw.filter((F.year("trade_date") < 2000) & (F.substring("ticker", 2, 10).cast("int") % 9 != 0))
    as_of = raw.agg(F.max("trade_date")).first()[0]
    return ts.incremental(raw, target, "ticker", "trade_date", as_of, dry_run=True)


def _classed(spark, d):
    """Trips with the true and the predicted tip class; the thresholds are fitted once."""
    t = _trips(spark, d)
    th = written(Mo.tip_thresholds(t), "tip-thresholds")
    return Mo.with_predictions(Mo.tip_category(t, thresholds=th), th)


@query("confusion")
def q_confusion(spark, d):
    s = _classed(spark, d)
    p = s.withColumn("pred", F.when(F.col("predicted_tip_category") == Mo.TIP_LABELS[0], 0)
                     .when(F.col("predicted_tip_category") == Mo.TIP_LABELS[1], 1).otherwise(2))
    return Mo.confusion(p, "tip_category", "pred").select(
        "tip_category", F.col("0").alias("pred_0"), F.col("1").alias("pred_1"), F.col("2").alias("pred_2"))


@query("class_report")
def q_class_report(spark, d):
    s = _classed(spark, d)
    p = s.withColumn("pred", F.when(F.col("predicted_tip_category") == Mo.TIP_LABELS[0], 0)
                     .when(F.col("predicted_tip_category") == Mo.TIP_LABELS[1], 1).otherwise(2))
    return Mo.class_report(p, "tip_category", "pred")


@query("train_fare")
def q_train_fare(spark, d):
    """Forest regressor (100 trees, depth 10, leaf >= 5, seed 42): hold-out
    metrics (MAE, RMSE, R^2) and feature importances."""
    _, metrics, importance = Mo.train_fare(_trips(spark, d))
    return metrics.select(F.lit("metric").alias("kind"), F.col("metric").alias("name"), "value").unionByName(
        importance.select(F.lit("importance").alias("kind"), F.col("feature").alias("name"), F.col("importance").alias("value")))


@query("train_tip")
def q_train_tip(spark, d):
    """H14 + H3: classifier on a stratified split, class names and probabilities."""
    pred = Mo.train_tip(_trips(spark, d))[1]
    return Mo.with_class_probs(pred).select("trip_id", "tip_category", "class_id", "class_name", "probabilities")


@query("train_tip_report")
def q_train_tip_report(spark, d):
    """The classifier's hold-out metrics and feature importances."""
    _, _, metrics, importance = Mo.train_tip(_trips(spark, d))
    return metrics.select(F.lit("metric").alias("kind"), F.col("metric").alias("name"), "value").unionByName(
        importance.select(F.lit("importance").alias("kind"), F.col("feature").alias("name"), F.col("importance").alias("value")))


@query("model_functions")
def q_model_functions(spark, d):
    """The trained forests as SQL functions over all trips; each trip's
    result must be that of the models themselves, to the last bit."""
    t = Mo.spread(written(_trips(spark, d), "trips"))
    fare, tip = Mo.train_fare(t)[0], Mo.train_tip(t)[0]
    Fo.register_model_functions(spark, fare, tip)
    args = ", ".join(Mo.FEATURES)
    scored = fare.transform(t).withColumn("fare_model", F.greatest(F.lit(0.0), "prediction")).drop("features", "prediction")
    scored = Mo.with_class_probs(tip.transform(scored))
    return scored.select("trip_id", (F.expr(f"predict_taxi_fare({args})") == F.col("fare_model")).alias("same_fare"),
                         (F.expr(f"predict_tip_category(fare_amount, {args})") == F.col("class_name")).alias("same_tip_category"))


@query("cache_predictions")
def q_cache_predictions(spark, d):
    """Scored trips written once to shared storage and read back."""
    return IO.cache_predictions(TR.scored(_trips(spark, d)).select("trip_id", "predicted_fare", "predicted_tip_category"),
                                shared_dir(spark, "predictions"))


@query("first_n")
def q_first_n(spark, d):
    """the first 100 trips by id."""
    return _trips(spark, d).select("trip_id", "pickup_ts", "fare_amount").orderBy("trip_id").limit(100)


@query("map_batches")
def q_map_batches(spark, d):
    """A model that only exists in Python, over Arrow batches of a partition."""
    t = _trips(spark, d).select("trip_id", "trip_distance", "is_rush_hour")

    def score(pdf):
        fare = (2.5 + 3.5 * pdf["trip_distance"] + 2 * pdf["is_rush_hour"].fillna(0)).clip(lower=0.0)
        return pdf[["trip_id"]].assign(predicted_fare=fare)
    return Mo.map_batches(t, score, "trip_id long, predicted_fare double")


@query("save_model")
def q_save_model(spark, d):
    """A trained forest saved, loaded again and applied: the loaded model
    must score every trip as the trained one does."""
    t = Mo.spread(_trips(spark, d))
    model, _, _ = Mo.train_fare(t)
    path = shared_dir(spark, "model")
    Mo.save_model(model, {"version": Mo.MODEL_VERSION, "features": ",".join(Mo.FEATURES)}, path)
    loaded, meta = Mo.load_model(path)
    a = model.transform(t).select("trip_id", F.col("prediction").alias("trained"))
    b = loaded.transform(t).select("trip_id", F.col("prediction").alias("loaded"))
    return a.join(b, "trip_id").groupBy(F.lit(meta["version"]).alias("version")).agg(
        F.count(F.lit(1)).alias("trips"), F.count_if(F.col("trained") == F.col("loaded")).alias("equal"))


# sinks: written, read back, compared by content

@query("write_full")
def q_write_full(spark, d):
    """A second full refresh replaces the first, data and schema."""
    path = shared_dir(spark, "full")
    IO.write_full(Tables(spark, d).supplier.select("s_suppkey"), path)
    IO.write_full(_reg(spark, d), path)
    return spark.read.parquet(path)


@query("append_evolving")
def q_append_evolving(spark, d):
    """History without a volume column, then a refresh that brings one."""
    path = shared_dir(spark, "evolving")
    raw = _dedup(spark, d).select("ticker", "trade_date", "close_price", "volume")
    IO.append_evolving(raw.filter(F.year("trade_date") < 2000).drop("volume"), path)
    IO.append_evolving(raw.filter(F.year("trade_date") >= 2000), path)
    return IO.read_evolving(spark, path).select("ticker", "trade_date", "close_price", "volume")


@query("export_by")
def q_export_by(spark, d):
    """Endpoints exported per model type and those not ready, read back."""
    path = shared_dir(spark, "export")
    f = _flat(spark, d).select("name", "model_type", "state_ready")
    IO.export_by(f, "model_type", f"{path}/by", F.coalesce("state_ready", F.lit("")) != "READY", f"{path}/not_ready")
    schema = "name string, model_type string, state_ready string"
    by = spark.read.schema(schema + ", category string").json(f"{path}/by").select(F.col("category").alias("part"), "name", "state_ready")
    return by.unionByName(spark.read.schema(schema).json(f"{path}/not_ready").select(F.lit("not ready").alias("part"), "name", "state_ready"))


@query("write_snapshot")
def q_write_snapshot(spark, d):
    """Two snapshots; the latest one is read back with its own schema."""
    path = shared_dir(spark, "snapshot")
    rows = _reg(spark, d).select("ticker", "company_name", F.lit(None).cast("string").alias("note"),
                                 F.to_date(F.lit("2001-12-31")).alias("as_of"))
    IO.write_snapshot(rows.where("false"), path, "20011230T000000")
    IO.write_snapshot(rows, path, "20011231T000000")
    return IO.read_latest(spark, path, rows.schema)


@query("read_inventory")
def q_read_inventory(spark, d):
    """A5: endpoint records as list files and legacy wrapper files of at most 1000 records."""
    path, schema = _land_inventory(spark, d)
    return K.flatten_endpoints(IO.read_inventory(spark, path, schema)).select("name", "id", "model_type", "model_name")


@query("read_inventory_split")
def q_read_inventory_split(spark, d):
    """A5: the same files, each read in parts."""
    path, schema = _land_inventory(spark, d)
    return K.flatten_endpoints(IO.read_inventory_split(spark, path, schema)).select("name", "id", "model_type", "model_name")


def _land_inventory(spark, d):
    """Endpoint records in files, every other one a legacy wrapper; the number of files follows the number of records."""
    path = shared_dir(spark, "inventory")
    e = fx.endpoints(spark, d)
    rows = ts.with_row_id(e.select("id", F.to_json(F.struct(*e.columns)).alias("record")), ["id", "record"], "n")
    files = rows.groupBy(F.floor((F.col("n") - 1) / 1000).alias("part")).agg(
        F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("record")), ","), F.lit("]")).alias("body"))  # at most 1000
    files = files.select("part", F.when(F.col("part") % 2 == 0, F.col("body"))
                         .otherwise(F.concat(F.lit('{"endpoints":'), "body", F.lit("}"))).alias("value"))
    files.write.partitionBy("part").text(path)
    return path, e.schema


@query("stream_binary")
def q_stream_binary(spark, d):
    """A1 + I1: documents landed as files, streamed as binary files into bronze."""
    path = shared_dir(spark, "landing")
    ST.land_files(Tables(spark, d).documents, path)
    return spark.read.parquet(ST.stream_binary_bronze(spark, path)).select("doc_id", "source", "document_type", "industry_sector")


@query("run_graph")
def q_run_graph(spark, d):
    """The order of the steps follows from what they read."""
    done = ST.run_graph({"silver": (["bronze"], lambda b: ST.stream_silver(spark, b)),
                         "bronze": ([], lambda: ST.stream_bronze(spark, d))})
    return spark.read.parquet(done["silver"]).select("doc_id", "document_type")


@query("refresh")
def q_refresh(spark, d):
    """A pipeline of SQL and functions, given in no order and without lists of what they read."""
    from stratum.streaming.refresh import refresh
    t = Tables(spark, d)
    done = refresh(spark, {
        "refresh_report": "SELECT document_type, count(*) AS n, sum(chars) AS chars FROM refresh_silver JOIN refresh_sizes USING (doc_id) GROUP BY 1",
        "refresh_silver": "SELECT doc_id, document_type FROM refresh_bronze WHERE document_type <> 'Annual_Report'",
        "refresh_sizes": lambda s: s.table("refresh_bronze").select("doc_id", F.length("parsed_content").alias("chars")),
        "refresh_bronze": lambda s: ST.bronze(t.documents)})
    if done["refresh_report"].status != "written":
        raise RuntimeError(done["refresh_report"].error)
    return spark.read.parquet(done["refresh_report"].path)
