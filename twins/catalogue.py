"""Twin SQL per registered query name."""

from __future__ import annotations

from twins import (AS_OF, DAILY, DEDUP, FINANCIALS, PRICES, RAW_PRICES, RETURNS, STOCK, W)

TWINS: dict[str, str] = {}


def twin(name: str, sql: str) -> None:
    TWINS[name] = sql


# --- prices --------------------------------------------------------------------------------------
twin("keep_latest", W(RAW_PRICES, DEDUP, body="SELECT * FROM dedup"))
twin("lag_return", W(RAW_PRICES, DEDUP, RETURNS,
                     body="SELECT ticker, trade_date, close_price, daily_return_pct FROM rets"))
twin("moving_average", W(*PRICES, body="SELECT ticker, trade_date, sma_20, sma_50, sma_200 FROM daily"))
twin("rolling_stddev", W(*PRICES, body="SELECT ticker, trade_date, daily_return_pct, volatility_20d FROM daily"))
twin("daily_prices", W(*PRICES, body="SELECT * FROM daily"))
twin("latest_per_key", W(*PRICES, body="""
SELECT ticker, trade_date, close_price, sma_50, sma_200 FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn FROM daily) WHERE rn = 1"""))
twin("year_range", W(*PRICES, body=f"""
SELECT ticker, MIN(close_price) AS fifty_two_week_low, MAX(close_price) AS fifty_two_week_high
FROM daily WHERE trade_date >= {AS_OF} - 365 GROUP BY ticker"""))
twin("period_prices", W(*PRICES, body=f"""
SELECT ticker,
       arg_min(close_price, trade_date) FILTER (WHERE trade_date >= date_trunc('year', {AS_OF})) AS year_start_price,
       arg_min(close_price, trade_date) AS one_year_ago_price
FROM daily WHERE trade_date >= {AS_OF} - 365 GROUP BY ticker"""))
twin("period_prices_strict", W(*PRICES, body=f"""
SELECT ticker, arg_min(close_price, trade_date) AS year_start_price,
       arg_max(close_price, trade_date) AS one_year_ago_price
FROM daily WHERE trade_date >= {AS_OF} - 365 GROUP BY ticker"""))
twin("top_n_per_key", W(*PRICES, body="""
SELECT * FROM (SELECT ticker, trade_date, close_price,
                      ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn FROM daily)
WHERE rn <= 5"""))
twin("stock_summary", W(*PRICES, *FINANCIALS, STOCK, body="SELECT * FROM stock"))


def build() -> dict[str, str]:
    from twins import decimal_round
    return {k: decimal_round(v) for k, v in TWINS.items()}


# --- trips ----------------------------------------------------------------------------------------
from twins import TRIP_CTES, day_name, decimal_round, mean  # noqa: E402

T = TRIP_CTES


def tw(name, body):
    twin(name, W(*T, body=body))


tw("trip_totals", f"SELECT COUNT(*) AS total_trips, {mean('trip_distance')} AS avg_distance, "
                  f"{mean('actual_fare')} AS avg_fare FROM trips2")
tw("fares_for_all_trips", f"""
SELECT trip_id, trip_distance, passenger_count,
  CASE WHEN hour_of_day < 6 THEN 'Night' WHEN hour_of_day < 12 THEN 'Morning'
       WHEN hour_of_day < 18 THEN 'Afternoon' ELSE 'Evening' END AS time_period,
  {day_name('day_of_week')} AS day_name, actual_fare, ROUND(predicted_fare, 2) AS predicted_fare,
  ROUND(actual_fare - predicted_fare, 2) AS prediction_error
FROM scored""")
tw("tip_class_for_all_trips", """
SELECT trip_id, actual_fare, trip_distance, passenger_count,
  CASE is_rush_hour WHEN 1 THEN 'Rush Hour' ELSE 'Non-Rush' END AS rush_status,
  CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type, predicted_tip_category
FROM scored""")
tw("fares_by_period", f"""
SELECT CASE WHEN hour_of_day < 6 THEN 'Night (12AM-6AM)' WHEN hour_of_day < 12 THEN 'Morning (6AM-12PM)'
            WHEN hour_of_day < 18 THEN 'Afternoon (12PM-6PM)' ELSE 'Evening (6PM-12AM)' END AS time_period,
  COUNT(*) AS trip_count, {mean('trip_distance')} AS avg_distance_miles, {mean('actual_fare')} AS avg_actual_fare,
  {mean('predicted_fare')} AS avg_predicted_fare
FROM scored GROUP BY 1""")
tw("tips_by_day_type", f"""
SELECT CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       predicted_tip_category AS tip_category, COUNT(*) AS trip_count, {mean('actual_fare')} AS avg_fare
FROM scored GROUP BY 1, 2""")
tw("rush_hour_impact", f"""
SELECT CASE is_rush_hour WHEN 1 THEN 'Rush Hour' ELSE 'Non-Rush Hour' END AS rush_status, COUNT(*) AS trip_count,
  {mean('trip_distance')} AS avg_distance, {mean('actual_fare')} AS avg_actual_fare,
  {mean('predicted_fare')} AS avg_predicted_fare, {mean('predicted_fare - actual_fare')} AS avg_prediction_error
FROM scored GROUP BY 1""")
tw("accuracy_metrics", f"""
SELECT COUNT(*) AS total_trips, {mean('abs(actual_fare - predicted_fare)')} AS mean_absolute_error,
  ROUND(SQRT(AVG(POW(CAST(actual_fare - predicted_fare AS DECIMAL(18,4)), 2))), 2) AS root_mean_squared_error,
  ROUND(MIN(predicted_fare), 2) AS min_predicted_fare, ROUND(MAX(predicted_fare), 2) AS max_predicted_fare
FROM scored""")
tw("largest_errors", """
SELECT trip_id, trip_distance, passenger_count, actual_fare, ROUND(predicted_fare, 2) AS predicted_fare,
  ROUND(abs(actual_fare - predicted_fare), 2) AS absolute_error,
  ROUND((actual_fare - predicted_fare) / NULLIF(actual_fare, 0) * 100, 2) AS error_percentage
FROM scored ORDER BY absolute_error DESC, trip_id LIMIT 5""")
tw("per_mile_by_passengers", f"""
SELECT passenger_count, COUNT(*) AS trip_count, {mean('trip_distance')} AS avg_distance,
  {mean('actual_fare')} AS avg_actual_fare, {mean('predicted_fare')} AS avg_predicted_fare,
  CAST(ROUND(SUM(CAST(actual_fare AS DECIMAL(18,4))) / NULLIF(SUM(CAST(trip_distance AS DECIMAL(18,4))), 0), 2) AS DOUBLE)
    AS actual_fare_per_mile,
  CAST(ROUND(SUM(CAST(predicted_fare AS DECIMAL(18,4))) / NULLIF(SUM(CAST(trip_distance AS DECIMAL(18,4))), 0), 2) AS DOUBLE)
    AS predicted_fare_per_mile
FROM scored GROUP BY passenger_count""")
tw("daily_summary", f"""
SELECT day_of_week, COUNT(*) AS trips, {mean('trip_distance', 1)} AS avg_miles, {mean('actual_fare')} AS avg_actual,
  {mean('predicted_fare')} AS avg_predicted, {day_name('day_of_week')} AS day_name
FROM scored GROUP BY day_of_week""")
tw("tip_distribution", """
SELECT predicted_tip_category AS tip_category, COUNT(*) AS trip_count,
  ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM scored), 1) AS percentage
FROM scored GROUP BY 1""")
tw("hourly_trend", f"""
SELECT hour_of_day, COUNT(*) AS trips, {mean('predicted_fare')} AS avg_predicted_fare,
  CASE WHEN hour_of_day BETWEEN 7 AND 9 THEN 'Morning Rush' WHEN hour_of_day BETWEEN 17 AND 19 THEN 'Evening Rush'
       ELSE 'Normal' END AS period_type
FROM scored GROUP BY hour_of_day""")
tw("real_trips_scored", """
SELECT trip_id, pickup_ts, trip_distance, COALESCE(passenger_count, 1) AS passenger_count, fare_amount AS actual_fare,
  ROUND(greatest(CAST(0.0 AS DOUBLE), CAST(2.5 AS DOUBLE) + CAST(3.5 AS DOUBLE) * trip_distance
        + CAST(2 * is_rush_hour AS DOUBLE)), 2) AS predicted_fare,
  CASE WHEN fare_amount * 0.15 <= th.q33 THEN 'Low Tip' WHEN fare_amount * 0.15 <= th.q67 THEN 'Medium Tip'
       ELSE 'High Tip' END AS predicted_tip_category
FROM trips2 CROSS JOIN th WHERE trip_distance > 0 AND fare_amount > 0 AND pickup_ts IS NOT NULL""")
tw("filter_then_score", """
SELECT trip_id, trip_distance, greatest(CAST(0.0 AS DOUBLE), CAST(2.5 AS DOUBLE) + CAST(3.5 AS DOUBLE) * trip_distance
        + CAST(2 * is_rush_hour AS DOUBLE)) AS predicted_fare
FROM trips2 WHERE trip_distance > 0 AND trip_distance < 100 AND fare_amount > 0 AND fare_amount < 500
  AND passenger_count > 0 AND passenger_count <= 6 AND trip_distance > 5.0 AND is_rush_hour = 1""")
tw("error_by_rush", f"""
SELECT CASE is_rush_hour WHEN 1 THEN 'Rush Hour' ELSE 'Normal' END AS period, COUNT(*) AS trips,
  {mean('abs(actual_fare - predicted_fare)')} AS avg_error,
  {mean('(actual_fare - predicted_fare) / NULLIF(actual_fare, 0) * 100')} AS avg_error_pct
FROM scored GROUP BY 1""")
tw("tip_distribution_averages", f"""
SELECT predicted_tip_category AS tip_category, COUNT(*) AS trip_count, {mean('actual_fare')} AS avg_fare,
  {mean('trip_distance')} AS avg_distance, {mean('tip_amount')} AS avg_tip
FROM scored GROUP BY 1""")
tw("typical_class", f"""
SELECT day_type, rush_status, trips, avg_fare, avg_distance,
  CASE WHEN avg_fare * 0.15 <= th.q33 THEN 'Low Tip' WHEN avg_fare * 0.15 <= th.q67 THEN 'Medium Tip'
       ELSE 'High Tip' END AS typical_tip_category
FROM (SELECT CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
             CASE is_rush_hour WHEN 1 THEN 'Rush Hour' ELSE 'Normal' END AS rush_status,
             COUNT(*) AS trips, {mean('actual_fare')} AS avg_fare, {mean('trip_distance')} AS avg_distance
      FROM trips2 GROUP BY 1, 2) g CROSS JOIN th""")
tw("high_predicted_fares", """
SELECT trip_id, trip_distance, actual_fare, ROUND(predicted_fare, 2) AS predicted_fare
FROM scored WHERE predicted_fare > 30.0""")
tw("tip_analysis", """
SELECT predicted_tip_category, COUNT(trip_id) AS trip_count, MAX(actual_fare) AS max_fare
FROM scored GROUP BY 1""")
tw("top_trips_by_fare", "SELECT trip_id, trip_distance, fare_amount FROM trips2 ORDER BY fare_amount DESC, trip_id LIMIT 10")
tw("time_period", """
SELECT trip_id, hour_of_day,
  CASE WHEN hour_of_day < 6 THEN 'Night' WHEN hour_of_day < 12 THEN 'Morning'
       WHEN hour_of_day < 18 THEN 'Afternoon' ELSE 'Evening' END AS time_period,
  CASE WHEN hour_of_day < 6 THEN 'Night (12AM-6AM)' WHEN hour_of_day < 12 THEN 'Morning (6AM-12PM)'
       WHEN hour_of_day < 18 THEN 'Afternoon (12PM-6PM)' ELSE 'Evening (6PM-12AM)' END AS time_period_long
FROM trips2""")
tw("day_name", f"""
SELECT trip_id, day_of_week, {day_name('day_of_week')} AS day_name,
  CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type FROM trips2""")
tw("is_rush_hour", """
SELECT trip_id, CASE WHEN hour_of_day BETWEEN 7 AND 9 OR hour_of_day BETWEEN 17 AND 19 THEN 1 ELSE 0 END AS is_rush_hour,
  CASE WHEN day_of_week IN (5, 6) THEN 1 ELSE 0 END AS is_weekend FROM trips2""")
tw("valid_trips", """
SELECT trip_id, trip_distance, fare_amount, passenger_count FROM trips2
WHERE trip_distance > 0 AND trip_distance < 100 AND fare_amount > 0 AND fare_amount < 500
  AND passenger_count > 0 AND passenger_count <= 6""")
twin("resolve_columns", "SELECT event_id AS trip_id, value AS trip_distance, ts AS pickup_ts, 'unknown' AS vendor FROM events")
twin("fill_defaults", """
WITH e AS (SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
                  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events)
SELECT event_id, k, COALESCE(value, (SELECT median(value) FROM e)) AS value, CAST(3.0 AS DOUBLE) AS rating FROM e""")
tw("clip", """
SELECT trip_id, CASE WHEN trip_distance IS NULL THEN NULL ELSE greatest(least(trip_distance, 100.0), 0.5) END
  AS distance_clipped, CASE WHEN tip_amount IS NULL THEN NULL ELSE greatest(tip_amount, 0.0) END AS tip_floor
FROM trips2""")
tw("tip_category", """
SELECT trip_id, tip_amount, CASE WHEN tip_amount IS NULL OR tip_amount <= th.q33 THEN 0
  WHEN tip_amount <= th.q67 THEN 1 ELSE 2 END AS tip_category FROM trips2 CROSS JOIN th""")
twin("date_parts", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS dow, CAST(ts AS DATE) AS day,
  CAST(CAST(ts AS DATE) - 365 AS DATE) AS year_before, CAST(CAST(ts AS DATE) + 1 AS DATE) AS next_day,
  make_timestamp((event_id * 1000 + 1704067200000) * 1000) AS from_ms
FROM events""")
tw("abs_error", """
SELECT trip_id, ROUND(abs(actual_fare - predicted_fare), 2) AS absolute_error,
  ROUND(abs(actual_fare - predicted_fare) / NULLIF(actual_fare, 0) * 100, 2) AS error_pct,
  ROUND(sqrt(pow(actual_fare - predicted_fare, 2)), 2) AS rms_part
FROM scored""")
tw("predict_taxi_fare", """
SELECT trip_id, ROUND(greatest(CAST(0.0 AS DOUBLE), CAST(2.5 AS DOUBLE) + CAST(3.5 AS DOUBLE) * trip_distance
  + CAST(2 * COALESCE(is_rush_hour, 0) AS DOUBLE)), 2) AS predicted_fare FROM trips2""")
tw("predict_tip_category", "SELECT trip_id, predicted_tip_category FROM scored")
tw("model_functions", "SELECT trip_id, true AS same_fare, true AS same_tip_category FROM trips2")
tw("predict_taxi_json", """
SELECT trip_id, to_json({'predicted_fare': ROUND(predicted_fare, 2), 'predicted_tip_category': predicted_tip_category,
  'model_version': '1.0.0', 'input': {'actual_fare': actual_fare, 'trip_distance': trip_distance,
  'passenger_count': passenger_count, 'hour_of_day': hour_of_day, 'day_of_week': day_of_week,
  'is_rush_hour': is_rush_hour, 'is_weekend': is_weekend}})::VARCHAR AS prediction_json FROM scored""")
tw("predict_fare_batch", """
SELECT passenger_count, CAST(floor(trip_id / 100) AS BIGINT) AS batch,
  list(ROUND(greatest(CAST(0.0 AS DOUBLE), CAST(2.5 AS DOUBLE) + CAST(3.5 AS DOUBLE) * trip_distance
    + CAST(2 * (CASE WHEN hour_of_day BETWEEN 7 AND 9 OR hour_of_day BETWEEN 17 AND 19 THEN 1 ELSE 0 END) AS DOUBLE)), 2)
    ORDER BY trip_id) AS fares
FROM trips2 GROUP BY 1, 2""")
tw("as_json", """
SELECT trip_id, to_json({'trip_distance': trip_distance, 'passenger_count': passenger_count,
  'when': {'hour_of_day': hour_of_day, 'day_of_week': day_of_week}})::VARCHAR AS js FROM trips2""")
tw("with_row_id", "SELECT *, ROW_NUMBER() OVER (ORDER BY fare_amount DESC, trip_id) AS row_id FROM trips2")
tw("quantiles", """
SELECT median(fare_amount) AS median, quantile_cont(fare_amount, 0.25) AS q25, quantile_cont(fare_amount, 0.33) AS q33,
  quantile_cont(fare_amount, 0.67) AS q67, quantile_cont(fare_amount, 0.75) AS q75 FROM trips2""")
tw("quantiles_by", """
SELECT hour_of_day, passenger_count, median(fare_amount) AS median, quantile_cont(fare_amount, 0.25) AS q25,
  quantile_cont(fare_amount, 0.9) AS q90 FROM trips2 GROUP BY ALL""")
tw("value_counts", """
SELECT passenger_count, COUNT(*) AS count, ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM trips2), 2) AS pct
FROM trips2 GROUP BY 1""")
tw("profile", """
SELECT 'trip_distance' AS column, COUNT(trip_distance) AS count, ROUND(AVG(trip_distance), 6) AS mean,
  ROUND(STDDEV_SAMP(trip_distance), 6) AS stddev, MIN(trip_distance) AS min, MAX(trip_distance) AS max FROM trips2
UNION ALL
SELECT 'passenger_count', COUNT(passenger_count), ROUND(AVG(passenger_count), 6), ROUND(STDDEV_SAMP(passenger_count), 6),
  CAST(MIN(passenger_count) AS DOUBLE), CAST(MAX(passenger_count) AS DOUBLE) FROM trips2""")
tw("error_metrics", """
SELECT is_rush_hour, COUNT(*) AS total_trips,
  ROUND(AVG(abs(predicted_fare - actual_fare)), 4) AS mean_absolute_error,
  ROUND(SQRT(AVG(POW(predicted_fare - actual_fare, 2))), 4) AS root_mean_squared_error,
  ROUND(1 - SUM(POW(predicted_fare - actual_fare, 2))
        / NULLIF(SUM(actual_fare * actual_fare) - SUM(actual_fare) * SUM(actual_fare) / COUNT(*), 0), 4) AS r2,
  ROUND(MIN(predicted_fare), 4) AS min_predicted, ROUND(MAX(predicted_fare), 4) AS max_predicted,
  ROUND(AVG(predicted_fare - actual_fare), 4) AS mean_error,
  ROUND(AVG(abs(predicted_fare - actual_fare) / NULLIF(actual_fare, 0) * 100), 4) AS mean_pct_error
FROM scored GROUP BY is_rush_hour""")


# --- filings and marts --------------------------------------------------------------------------
from twins import GEO_MART, GEOS, SEG_MART, SEGMENTS  # noqa: E402

FINS = FINANCIALS
VALS = ("market_cap_billions", "pe_ratio", "forward_pe", "peg_ratio", "price_to_sales", "price_to_book",
        "enterprise_value_billions", "ev_to_revenue", "ev_to_ebitda", "dividend_yield_pct", "beta")


def fw(name, body, *extra):
    twin(name, W(*FINS, *extra, body=body))


def sw(name, body, *extra):
    b = body.lstrip()
    if b.startswith("WITH "):
        twin(name, W(*PRICES, *FINS, STOCK, *extra, b[5:].split("\nSELECT v.ticker", 1)[0],
                     body="SELECT v.ticker" + b.split("\nSELECT v.ticker", 1)[1]))
    else:
        twin(name, W(*PRICES, *FINS, STOCK, *extra, body=body))


fw("company_registry", "SELECT * FROM registry")
fw("company_financials", "SELECT * FROM fin")
fw("revenue_by_segment", "SELECT * FROM seg_mart", SEGMENTS, SEG_MART)
fw("revenue_by_geography", "SELECT * FROM geo_mart", GEOS, GEO_MART)
OVERVIEW = f"""overview AS (
  SELECT f.company, f.ticker, f.fiscal_year, f.fiscal_year_end_date, f.total_revenue_billions,
    f.revenue_growth_yoy_pct, f.cost_of_revenue_billions, f.gross_profit_billions, f.gross_margin_pct,
    f.operating_income_billions, f.operating_margin_pct, f.net_income_billions, f.net_margin_pct,
    f.eps_diluted AS earnings_per_share, f.total_assets_billions, f.total_liabilities_billions,
    f.total_equity_billions AS stockholders_equity_billions, f.cash_and_equivalents_billions,
    s.current_price, s.price_date, {', '.join('s.' + v for v in VALS)},
    s.fifty_two_week_high, s.fifty_two_week_low, s.ytd_return_pct, s.one_year_return_pct, s.trend_signal,
    ROUND(s.market_cap_billions / NULLIF(f.net_income_billions, 0), 2) AS price_to_earnings,
    ROUND(s.market_cap_billions / NULLIF(f.total_revenue_billions, 0), 2) AS market_cap_to_revenue
  FROM fin f LEFT JOIN stock s ON f.ticker = s.ticker)"""
sw("company_overview", "SELECT * FROM overview", OVERVIEW)
PEERS = """peers AS (
  SELECT company, ticker, fiscal_year, total_revenue_billions, market_cap_billions, revenue_growth_yoy_pct,
    ytd_return_pct, gross_margin_pct, operating_margin_pct, net_margin_pct, pe_ratio, price_to_sales, ev_to_revenue,
    RANK() OVER (ORDER BY total_revenue_billions DESC NULLS LAST) AS revenue_rank,
    RANK() OVER (ORDER BY net_margin_pct DESC NULLS LAST) AS margin_rank,
    RANK() OVER (ORDER BY revenue_growth_yoy_pct DESC NULLS LAST) AS growth_rank,
    RANK() OVER (ORDER BY pe_ratio ASC NULLS LAST) AS pe_rank
  FROM overview)"""
sw("peer_comparison", "SELECT * FROM peers", OVERVIEW, PEERS)
twin("rank_peers", """
SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_day,
  RANK() OVER (ORDER BY o_totalprice DESC NULLS LAST) AS price_rank,
  RANK() OVER (ORDER BY CAST(o_orderdate AS DATE) ASC NULLS LAST) AS day_rank FROM orders""")
twin("stock_performance", W(*PRICES, *FINS, body="""
SELECT d.ticker, c.company, d.trade_date, d.close_price, d.volume, d.daily_return_pct, d.sma_20, d.sma_50, d.sma_200,
  d.volatility_20d,
  CASE WHEN d.close_price > d.sma_50 AND d.close_price > d.sma_200 THEN 'Bullish'
       WHEN d.close_price < d.sma_50 AND d.close_price < d.sma_200 THEN 'Bearish' ELSE 'Neutral' END AS trend_signal,
  ROUND((d.close_price - d.sma_50) / NULLIF(d.sma_50, 0) * 100, 2) AS pct_above_sma_50,
  ROUND((d.close_price - d.sma_200) / NULLIF(d.sma_200, 0) * 100, 2) AS pct_above_sma_200
FROM daily d LEFT JOIN (SELECT ticker, company FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker
  ORDER BY fiscal_year DESC) AS rn FROM fin) WHERE rn = 1) c ON d.ticker = c.ticker"""))
fw("revenue_breakdown", """
SELECT 'segment' AS breakdown_type, company, ticker, fiscal_year, segment_name AS category,
  segment_revenue_billions AS revenue_billions, segment_pct_of_total AS pct_of_total, segment_rank AS category_rank
FROM seg_mart
UNION ALL
SELECT 'geography', company, ticker, fiscal_year, region, region_revenue_billions, region_pct_of_total,
  ROW_NUMBER() OVER (PARTITION BY company ORDER BY region_revenue_billions DESC, fiscal_year DESC, region)
FROM geo_mart""", SEGMENTS, SEG_MART, GEOS, GEO_MART)


def _case(x, hi, mid, a, b, c, op=">"):
    return f"CASE WHEN {x} {op} {hi} THEN {a} WHEN {x} {op} {mid} THEN {b} ELSE {c} END"


PE = "CASE WHEN s.pe_ratio < 25 THEN 30 WHEN s.pe_ratio < 50 THEN 20 ELSE 10 END"
GR = _case("f.revenue_growth_yoy_pct", 50, 10, 40, 25, 10)
MG = _case("f.gross_margin_pct", 60, 40, 30, 20, 10)
sw("valuation_score", f"""
SELECT f.ticker, f.company, f.fiscal_year, CAST({PE} + {GR} + {MG} AS INTEGER) AS valuation_score,
  CAST({PE} AS INTEGER) AS pe_component, CAST({GR} AS INTEGER) AS growth_component,
  CAST({MG} AS INTEGER) AS margin_component
FROM fin f JOIN stock s ON f.ticker = s.ticker""")
PEER_AVG = """pavg AS (
  SELECT o.ticker,
    (t.sg - COALESCE(o.sg, 0)) / NULLIF(t.ng - o.ng, 0) AS peer_avg_revenue_growth_yoy_pct,
    (t.sm - COALESCE(o.sm, 0)) / NULLIF(t.nm - o.nm, 0) AS peer_avg_gross_margin_pct,
    (t.sn - COALESCE(o.sn, 0)) / NULLIF(t.nn - o.nn, 0) AS peer_avg_net_margin_pct
  FROM (SELECT ticker, SUM(revenue_growth_yoy_pct) sg, COUNT(revenue_growth_yoy_pct) ng, SUM(gross_margin_pct) sm,
               COUNT(gross_margin_pct) nm, SUM(net_margin_pct) sn, COUNT(net_margin_pct) nn FROM fin GROUP BY ticker) o
  CROSS JOIN (SELECT SUM(revenue_growth_yoy_pct) sg, COUNT(revenue_growth_yoy_pct) ng, SUM(gross_margin_pct) sm,
               COUNT(gross_margin_pct) nm, SUM(net_margin_pct) sn, COUNT(net_margin_pct) nn FROM fin) t)"""
fw("peer_average", "SELECT * FROM pavg", PEER_AVG)
fw("compare_peers", """
SELECT f.ticker, f.fiscal_year, m.metric, m.company_value, m.peer_avg FROM fin f JOIN pavg p ON f.ticker = p.ticker,
LATERAL (VALUES ('Revenue Growth %', f.revenue_growth_yoy_pct, ROUND(p.peer_avg_revenue_growth_yoy_pct, 1)),
                ('Gross Margin %', f.gross_margin_pct, ROUND(p.peer_avg_gross_margin_pct, 1)),
                ('Net Margin %', f.net_margin_pct, ROUND(p.peer_avg_net_margin_pct, 1))) m(metric, company_value, peer_avg)
""", PEER_AVG)


def num1(x):
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,17)), 1) AS DECIMAL(38,1))::VARCHAR"


THESIS = f"""
SELECT ticker, company || ' (' || ticker || ') Summary: ' || 'Revenue $' || {num1('total_revenue_billions')} || 'B, '
  || 'Growth ' || {num1('revenue_growth_yoy_pct')} || '%, ' || 'Margin ' || {num1('gross_margin_pct')} || '%' AS thesis
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) AS rn FROM fin) WHERE rn = 1"""
fw("investment_thesis", THESIS)
twin("sentence", W(*PRICES, body="""
SELECT ticker, trade_date, ticker || ' closed at '
  || CAST(ROUND(CAST(CAST(close_price AS VARCHAR) AS DECIMAL(38,17)), 2) AS DECIMAL(38,2))::VARCHAR || ' ('
  || CAST(ROUND(CAST(CAST(daily_return_pct AS VARCHAR) AS DECIMAL(38,17)), 2) AS DECIMAL(38,2))::VARCHAR || '%)' AS line FROM daily"""))
fw("growth_trajectory", """
SELECT f.ticker, f.fiscal_year, s.year_offset, ROUND(f.total_revenue_billions * s.m, 1) AS projected_revenue,
  s.growth_rate
FROM fin f CROSS JOIN (VALUES (1, CAST(1.15 AS DOUBLE), CAST(15.0 AS DOUBLE)), (2, 1.25, 10.0), (3, 1.33, 8.0))
  s(year_offset, m, growth_rate)""")
sw("risk_summary", f"""
SELECT ticker, CAST(NULL AS INTEGER) AS fiscal_year, 'Valuation' AS risk_type,
  CASE WHEN pe_ratio > 50 THEN 'HIGH' WHEN pe_ratio > 30 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
  'P/E ratio is ' || {num1('pe_ratio')} AS description FROM stock
UNION ALL
SELECT ticker, fiscal_year, 'Growth Sustainability',
  CASE WHEN revenue_growth_yoy_pct > 80 THEN 'HIGH' WHEN revenue_growth_yoy_pct > 30 THEN 'MEDIUM' ELSE 'LOW' END,
  'Growth rate of ' || {num1('revenue_growth_yoy_pct')} || '% may not sustain' FROM fin
UNION ALL
SELECT ticker, fiscal_year, 'Debt',
  CASE WHEN total_liabilities_billions > cash_and_equivalents_billions THEN 'MEDIUM' ELSE 'LOW' END,
  'Liabilities: $' || {num1('total_liabilities_billions')} || 'B vs Cash: $' || {num1('cash_and_equivalents_billions')}
  || 'B' FROM fin""")
fw("first_known", "SELECT file_name, company, ticker FROM filings")
fw("vpath", """
SELECT file_name, fiscal_year, total_revenue_billions AS revenue, CAST(NULL AS VARCHAR) AS missing,
  CAST(NULL AS INTEGER) AS bad_cast, CAST(NULL AS VARCHAR) AS not_json FROM filings""")
fw("pct", """
SELECT ticker, fiscal_year, gross_margin_pct, operating_margin_pct, net_margin_pct, CAST(NULL AS DOUBLE) AS zero_div
FROM fin""")
fw("null_as", f"SELECT ticker, {', '.join('CAST(NULL AS DOUBLE) AS ' + v for v in VALS)} FROM registry")
twin("above", W(*PRICES, body="""
SELECT ticker, trade_date, close_price > sma_50 AS above_sma_50, close_price > sma_200 AS above_sma_200 FROM daily"""))
twin("trend_signal", W(*PRICES, body="""
SELECT ticker, trade_date, CASE WHEN close_price > sma_50 AND close_price > sma_200 THEN 'Bullish'
  WHEN close_price < sma_50 AND close_price < sma_200 THEN 'Bearish' ELSE 'Neutral' END AS trend_signal FROM daily"""))
fw("present", "SELECT file_name, ticker AS t FROM filings")
fw("parse_array", """
SELECT f.file_name, CAST(COALESCE(n, 0) AS INTEGER) AS n_segments, first_segment FROM filings f
LEFT JOIN (SELECT l_suppkey, fiscal_year, COUNT(*) AS n, MIN(segment_name) AS first_segment FROM segs GROUP BY ALL) g
  ON f.l_suppkey = g.l_suppkey AND f.fiscal_year = g.fiscal_year""", SEGMENTS)
twin("with_registry", W(*PRICES, *FINS, body="""
SELECT d.ticker, d.trade_date, d.close_price, r.company_name, r.industry_sector
FROM daily d LEFT JOIN registry r ON d.ticker = r.ticker"""))
sw("score_inputs", """
SELECT f.ticker, f.fiscal_year, f.gross_margin_pct, s.current_price, s.trend_signal
FROM fin f JOIN stock s ON f.ticker = s.ticker WHERE f.gross_margin_pct > 20""")
sw("cross_one", """
SELECT * FROM (SELECT ROUND(AVG(gross_margin_pct), 4) AS avg_margin, COUNT(*) AS filings FROM fin)
CROSS JOIN (SELECT COUNT(*) AS tickers, MAX(current_price) AS max_price FROM stock)""")
fw("explode_items", """
SELECT f.file_name, g.region, g.region_revenue_billions AS revenue
FROM filings f JOIN geos g ON f.l_suppkey = g.l_suppkey AND f.fiscal_year = g.fiscal_year""", GEOS)
twin("missing_from", """
SELECT custkey, 'missing' AS side FROM (SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL
SELECT custkey, 'unexpected' FROM (SELECT o_custkey AS custkey FROM orders EXCEPT SELECT c_custkey FROM customer)""")
twin("missing_from_years", """
WITH o AS (SELECT o_custkey AS custkey, year(o_orderdate) AS y FROM orders)
SELECT custkey, 'missing' AS side FROM (SELECT custkey FROM o WHERE y = 1995 EXCEPT SELECT custkey FROM o WHERE y = 1996)
UNION ALL
SELECT custkey, 'unexpected' FROM (SELECT custkey FROM o WHERE y = 1996 EXCEPT SELECT custkey FROM o WHERE y = 1995)""")
fw("rank_in_key", """
SELECT f.ticker, f.fiscal_year, g.segment_name,
  ROW_NUMBER() OVER (PARTITION BY f.ticker, f.fiscal_year ORDER BY g.segment_revenue_billions DESC, g.segment_name)
    AS segment_rank
FROM filings f JOIN segs g ON f.l_suppkey = g.l_suppkey AND f.fiscal_year = g.fiscal_year""", SEGMENTS)
sw("tagged_union", """
SELECT ticker, total_revenue_billions AS value, CAST(NULL AS VARCHAR) AS trend_signal, 'financials' AS source FROM fin
UNION ALL SELECT ticker, current_price, trend_signal, 'stock' FROM stock""")
twin("merge_history", W(*PRICES, body="SELECT ticker, trade_date, close_price, sma_20 FROM daily"))
twin("unique_by", W(RAW_PRICES, body="""
SELECT ticker, trade_date, close_price, ingestion_timestamp FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY trade_date DESC, ingestion_timestamp DESC,
                               close_price DESC) AS rn FROM raw_prices) WHERE rn = 1"""))
MART_COUNTS = """
SELECT 'silver_filings' AS "table", (SELECT COUNT(*) FROM filings) AS rows
UNION ALL SELECT 'company_registry', (SELECT COUNT(*) FROM registry)
UNION ALL SELECT 'stock_daily_prices', (SELECT COUNT(*) FROM daily)
UNION ALL SELECT 'company_financials', (SELECT COUNT(*) FROM fin)
UNION ALL SELECT 'stock_summary', (SELECT COUNT(*) FROM stock)
UNION ALL SELECT 'revenue_by_segment', (SELECT COUNT(*) FROM seg_mart)
UNION ALL SELECT 'revenue_by_geography', (SELECT COUNT(*) FROM geo_mart)"""
sw("build_marts", f"SELECT *, rows >= 1 AS ok FROM ({MART_COUNTS})", SEGMENTS, SEG_MART, GEOS, GEO_MART)
sw("build_views", """
SELECT *, rows >= 1 AS ok FROM (
  SELECT 'company_overview' AS "table", (SELECT COUNT(*) FROM overview) AS rows
  UNION ALL SELECT 'peer_comparison', (SELECT COUNT(*) FROM overview)
  UNION ALL SELECT 'stock_performance', (SELECT COUNT(*) FROM daily)
  UNION ALL SELECT 'revenue_breakdown', (SELECT COUNT(*) FROM seg_mart) + (SELECT COUNT(*) FROM geo_mart))""",
   OVERVIEW, SEGMENTS, SEG_MART, GEOS, GEO_MART)


# --- inventory ------------------------------------------------------------------------------------
from twins import EP, FAMILY  # noqa: E402


def iw(name, body):
    b = body.lstrip()
    twin(name, "WITH " + EP + ",\n" + b[5:] if b.startswith("WITH ") else W(EP, body=body))


FLATC = ("name, id, endpoint_type, task, creator, created_at, updated_at, state_ready, config_update, entity_type, "
         "entity_name, entity_version, model_name, registered_model_name, model_provider, scale_to_zero, workload_size, tag_count, tile_id, "
         "problem_type, endpoint_category, model_type")
iw("flatten_endpoints", f"SELECT {FLATC}, segment_tag, usage_tracking_enabled, inference_table_catalog, "
                        "rate_limits_count, guardrails_enabled FROM flat")
iw("model_type", "SELECT name, model_type FROM flat")
iw("model_type_fast", "SELECT name, model_type FROM flat WHERE model_type <> 'UNCLASSIFIED'")
iw("endpoint_category", "SELECT name, entity_type, endpoint_category FROM flat")
iw("gateway_settings", "SELECT name, usage_tracking_enabled, inference_table_catalog, inference_table_schema, "
                       "rate_limits_count, rate_limits, guardrails_enabled FROM flat")
iw("inventory_summary", """
WITH f AS (SELECT *, CASE WHEN length(model_name) > 2 THEN regexp_replace(NULLIF(model_name, ''), '-[0-9]$', '')
                          ELSE NULLIF(model_name, '') END AS model_family FROM flat),
l AS (SELECT 'model_type' AS field, model_type AS value FROM f UNION ALL SELECT 'endpoint_category', endpoint_category FROM f
  UNION ALL SELECT 'endpoint_type', endpoint_type FROM f
  UNION ALL SELECT 'entity_type', entity_type FROM f UNION ALL SELECT 'state_ready', state_ready FROM f
  UNION ALL SELECT 'task', task FROM f UNION ALL SELECT 'model_provider', model_provider FROM f
  UNION ALL SELECT 'model_family', model_family FROM f WHERE NULLIF(trim(model_family), '') IS NOT NULL
  UNION ALL SELECT 'total_count', 'all' FROM f
  UNION ALL SELECT 'usage_tracking_enabled', 'all' FROM f WHERE usage_tracking_enabled
  UNION ALL SELECT 'scale_to_zero_enabled', 'all' FROM f WHERE scale_to_zero)
SELECT field, COALESCE(NULLIF(trim(value), ''), 'unknown') AS value, COUNT(*) AS count FROM l GROUP BY 1, 2""")
iw("family_slice", f"""
WITH f AS (SELECT *, {FAMILY} AS family FROM flat)
SELECT family, model_type, COUNT(*) AS count, COUNT(*) FILTER (WHERE state_ready = 'READY') AS ready,
  list_sort((list(name ORDER BY name))[1:3]) AS sample_names
FROM f GROUP BY 1, 2""")
iw("health", """
WITH nr AS (SELECT * FROM flat WHERE COALESCE(state_ready, '') <> 'READY')
SELECT COALESCE(NULLIF(trim(entity_type), ''), 'unknown') AS entity_type, COUNT(*) AS count FROM nr GROUP BY 1
UNION ALL SELECT 'ALL', COUNT(*) FROM nr""")
iw("providers", """
SELECT model_provider, COUNT(*) AS count, 'all' AS scope FROM flat WHERE model_provider IS NOT NULL AND model_provider <> ''
GROUP BY 1
UNION ALL
SELECT model_provider, COUNT(*), 'external' FROM flat
WHERE model_provider IS NOT NULL AND model_provider <> '' AND model_provider <> 'databricks' GROUP BY 1""")
iw("class_listing", "SELECT model_type, name, state_ready FROM flat")
iw("frequency", """
SELECT COALESCE(NULLIF(trim(model_name), ''), 'unknown') AS model_name, COUNT(*) AS count FROM flat
GROUP BY 1 ORDER BY count DESC, model_name LIMIT 20""")
iw("class_counts", """
SELECT COUNT(*) FILTER (WHERE endpoint_category = 'foundation_model') AS foundation,
  COUNT(*) FILTER (WHERE endpoint_category = 'external_model') AS external,
  COUNT(*) FILTER (WHERE endpoint_category = 'agent') AS agent, COUNT(*) FILTER (WHERE state_ready = 'READY') AS ready,
  COUNT(*) FILTER (WHERE usage_tracking_enabled) AS tracking_enabled, COUNT(*) FILTER (WHERE guardrails_enabled) AS guardrails
FROM flat""")
iw("has_prefix", """
SELECT name, starts_with(name, 'databricks-') AS pay_per_token, contains(lower(task), 'agent') AS mentions_agent FROM flat""")
iw("strip_version", """
SELECT name, CASE WHEN length(name) > 2 THEN regexp_replace(name, '-[0-9]$', '') ELSE name END AS family FROM flat""")
iw("nest", """
SELECT name, state_ready AS ready, entity_type, model_type, state_ready = 'READY' AS is_ready,
  CASE WHEN length(model_name) > 2 THEN regexp_replace(model_name, '-[0-9]$', '') ELSE model_name END AS model_family
FROM flat""")
iw("filter_by", """
SELECT name, endpoint_category FROM flat WHERE state_ready = 'READY' AND endpoint_category IN ('agent', 'external_model')""")
iw("tags_map", """
SELECT name, CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 3 END AS n_tags,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS n_keyed,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'again' ELSE c_mktsegment END AS segment FROM ep""")
iw("first_of", """
SELECT name, CASE WHEN noconf OR legacy THEN 'none' ELSE entity_type END AS first_type,
  CASE WHEN noconf OR legacy THEN '' ELSE CASE c_custkey % 3 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' ELSE 'Large' END END
    AS first_size FROM ep""")
iw("enrich_tiles", """
SELECT f.name, COALESCE(tile_id, CASE WHEN k = 7 THEN 't' || CAST(c_custkey AS VARCHAR) END) AS tile_id, model_type,
  CASE WHEN k = 7 THEN 'tile ' || seg || ' ' || CAST(c_custkey AS VARCHAR) END AS tile_name
FROM flat f JOIN ep e ON f.id = 'id-' || CAST(e.c_custkey AS VARCHAR)""")


# --- documents -------------------------------------------------------------------------------------
TOK = "list_filter(string_split_regex(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def toks(x):
    return TOK.format(x=x)


def classify_sql(x, labels):
    names = list(labels)
    scores = [f"len(list_filter({toks(x)}, lambda t: list_contains({list(kws)!r}, t)))" if kws else "0"
              for kws in labels.values()]
    best = f"greatest({', '.join(scores)})"
    return (f"CASE WHEN {best} = 0 THEN '{names[-1]}' "
            + " ".join(f"WHEN {s} = {best} THEN '{n}'" for n, s in zip(names, scores)) + " END")


def _labels():
    from stratum.operators.documents import DOC_TYPE_LABELS, SECTOR_LABELS
    return DOC_TYPE_LABELS, SECTOR_LABELS


_DT, _SEC = _labels()
twin("classify", f"""
SELECT doc_id, {classify_sql('text', _DT)} AS document_type, {classify_sql('text', _SEC)} AS industry_sector
FROM documents""")
twin("file_stem", """
SELECT doc_id, source || '_' || CAST(doc_id AS VARCHAR) || '.txt' AS file_name,
  regexp_extract(source || '_' || CAST(doc_id AS VARCHAR) || '.txt', '^([^_\\.]+)', 1) AS company_key FROM documents""")
FILES = """files AS (SELECT '/docs/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, doc_id, n_chars,
  CASE WHEN lang = 'de' THEN 'skipped' WHEN COALESCE(n_chars, 0) = 0 THEN 'failed' ELSE 'success' END AS status
  FROM documents), new AS (SELECT * FROM files WHERE doc_id % 3 <> 0)"""
twin("sync_source", W(FILES, body="SELECT path, status FROM new"))
twin("index_status", W(FILES, body="""
SELECT COUNT(*) AS total_files, COUNT(*) FILTER (WHERE status = 'success') AS success,
  COUNT(*) FILTER (WHERE status = 'skipped') AS skipped, COUNT(*) FILTER (WHERE status = 'failed') AS failed FROM new"""))
twin("manifest_check", W(FILES, body="""
SELECT path AS name, n_chars AS size, 'present' AS state FROM files WHERE path LIKE '%.txt'
UNION ALL
SELECT e.name, CAST(NULL AS BIGINT), 'missing' FROM (SELECT '/docs/src' || CAST(doc_id % 20 AS VARCHAR) || '/'
  || CAST(doc_id AS VARCHAR) || '.txt' AS name FROM labels) e WHERE e.name NOT IN (SELECT path FROM files)"""))
twin("with_history", """
SELECT conv_id, n // 2 AS block, MIN(n) AS earlier, list(role ORDER BY turn) AS roles, list(text ORDER BY turn) AS texts
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n FROM conversations) GROUP BY 1, 2""")
twin("retrieve", f"""
WITH ch AS (
  SELECT doc_id, unnest(range(len(parts))) AS chunk_id, unnest(parts) AS chunk
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
ch2 AS (SELECT * FROM ch WHERE trim(chunk) <> ''),
ct AS (SELECT doc_id, chunk_id, term, COUNT(*) AS tf FROM (SELECT doc_id, chunk_id, unnest({toks('chunk')}) AS term FROM ch2)
  GROUP BY ALL),
idf AS (SELECT term, ln((SELECT COUNT(*) FROM ch2) / COUNT(*)) AS idf FROM ct GROUP BY term),
qt AS (SELECT item_id, term, COUNT(*) AS qtf FROM (SELECT item_id, unnest({toks('text')}) AS term FROM benchmark) GROUP BY ALL),
sc AS (SELECT item_id, doc_id, chunk_id, ROUND(SUM(tf * qtf * idf * idf), 9) AS score
  FROM qt JOIN idf USING (term) JOIN ct USING (term) WHERE idf > 0 GROUP BY ALL)
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, chunk_id) AS rank FROM sc)
WHERE rank <= 3""")
twin("retrieve_indexed", TWINS["retrieve"])
twin("sync_index", """
SELECT status, CAST(n AS BIGINT) AS n FROM (
  SELECT 'added' AS status, count(*) AS n FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT 'changed', count(*) FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 7 = 1
  UNION ALL SELECT 'kept', count(*) FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 7 <> 1
  UNION ALL SELECT 'removed', count(*) FROM documents WHERE doc_id % 5 = 0) WHERE n > 0""")
twin("extract", f"""
SELECT doc_id, NULLIF(trim(split_part(text, chr(10), 1)), '') AS title, CAST(len({toks('text')}) AS INTEGER) AS n_words,
  regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}') AS emails,
  NULLIF(regexp_extract(text, '(?i)(?:licen[cs]e[^\\n]*)'), '') AS license_line,
  CAST(len(regexp_extract_all(text, '\\b(?:19|20)[0-9]{{2}}\\b')) AS INTEGER) AS n_years,
  regexp_matches(text, '(?i)(?:licen[cs]e[^\\n]*)') AS has_license
FROM documents""")


# --- sources, checks, incremental, confusion --------------------------------------------------------
twin("read_table", "SELECT n_name, COUNT(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
twin("fetch_by_key", """
SELECT k AS suppkey, CASE WHEN k % 13 = 0 OR s_suppkey IS NULL THEN 'not_found' WHEN k % 17 = 0 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN k % 13 <> 0 AND k % 17 = 0 THEN '{"ticker"' END AS error,
  CASE WHEN k % 13 <> 0 AND k % 17 <> 0 THEN 'S' || CAST(s_suppkey AS VARCHAR) END AS ticker,
  CASE WHEN k % 13 <> 0 AND k % 17 <> 0 THEN s_name END AS name,
  CASE WHEN k % 13 <> 0 AND k % 17 <> 0 THEN CAST(s_nationkey AS BIGINT) END AS nation
FROM (SELECT DISTINCT l_suppkey AS k FROM lineitem) LEFT JOIN supplier ON k = s_suppkey""")
twin("price_profile", W(*PRICES, body="""
SELECT ticker, COUNT(*) AS rows, MIN(close_price) AS min_value, MAX(close_price) AS max_value,
  ROUND(AVG(close_price), 2) AS avg_value FROM daily GROUP BY ticker"""))
twin("count_distinct", W(RAW_PRICES, body="SELECT COUNT(DISTINCT ticker) AS tickers FROM raw_prices"))
twin("high_water", W(RAW_PRICES, DEDUP, body="SELECT ticker, MAX(trade_date) AS latest_date FROM dedup GROUP BY ticker"))
NEW_ROWS = """h AS (SELECT ticker, MAX(trade_date) AS hw FROM dedup
  WHERE year(trade_date) < 2000 AND CAST(substr(ticker, 2, 10) AS INTEGER) % 9 <> 0 GROUP BY ticker),
new AS (SELECT s.ticker, s.trade_date, s.close_price FROM dedup s LEFT JOIN h ON s.ticker = h.ticker
  WHERE s.trade_date > COALESCE(h.hw, (SELECT MAX(trade_date) FROM dedup) - 31))"""
twin("incremental", W(RAW_PRICES, DEDUP, NEW_ROWS, body="SELECT * FROM new"))
twin("incremental_dry_run", W(RAW_PRICES, DEDUP, NEW_ROWS, body="""
SELECT ticker, COUNT(*) AS rows, MIN(trade_date) AS first_date, MAX(trade_date) AS last_date FROM new GROUP BY ticker"""))
CONF = """p AS (SELECT s.*, CASE WHEN tip_amount IS NULL OR tip_amount <= th.q33 THEN 0 WHEN tip_amount <= th.q67 THEN 1
  ELSE 2 END AS tip_category, CASE predicted_tip_category WHEN 'Low Tip' THEN 0 WHEN 'Medium Tip' THEN 1 ELSE 2 END
  AS pred FROM scored s CROSS JOIN th)"""
twin("confusion", W(*T, CONF, body="""
SELECT tip_category, COUNT(*) FILTER (WHERE pred = 0) AS pred_0, COUNT(*) FILTER (WHERE pred = 1) AS pred_1,
  COUNT(*) FILTER (WHERE pred = 2) AS pred_2 FROM p GROUP BY tip_category"""))
twin("class_report", W(*T, CONF, body="""
SELECT c.cls, ROUND(CASE WHEN COALESCE(pp.n, 0) > 0 THEN COALESCE(tp.tp, 0) / pp.n ELSE 0.0 END, 6) AS precision,
  ROUND(CASE WHEN COALESCE(tp.support, 0) > 0 THEN tp.tp / tp.support ELSE 0.0 END, 6) AS recall,
  ROUND(CASE WHEN (CASE WHEN COALESCE(pp.n, 0) > 0 THEN COALESCE(tp.tp, 0) / pp.n ELSE 0.0 END)
                + (CASE WHEN COALESCE(tp.support, 0) > 0 THEN tp.tp / tp.support ELSE 0.0 END) > 0
    THEN 2 * (CASE WHEN COALESCE(pp.n, 0) > 0 THEN COALESCE(tp.tp, 0) / pp.n ELSE 0.0 END)
           * (CASE WHEN COALESCE(tp.support, 0) > 0 THEN tp.tp / tp.support ELSE 0.0 END)
         / ((CASE WHEN COALESCE(pp.n, 0) > 0 THEN COALESCE(tp.tp, 0) / pp.n ELSE 0.0 END)
           + (CASE WHEN COALESCE(tp.support, 0) > 0 THEN tp.tp / tp.support ELSE 0.0 END)) ELSE 0.0 END, 6) AS f1,
  COALESCE(tp.support, 0) AS support,
  ROUND((SELECT COUNT(*) FILTER (WHERE tip_category = pred) / COUNT(*) FROM p), 6) AS accuracy
FROM (SELECT tip_category AS cls FROM p UNION SELECT pred FROM p) c
LEFT JOIN (SELECT tip_category AS cls, COUNT(*) FILTER (WHERE tip_category = pred) AS tp, COUNT(*) AS support
           FROM p GROUP BY 1) tp ON c.cls = tp.cls
LEFT JOIN (SELECT pred AS cls, COUNT(*) AS n FROM p GROUP BY 1) pp ON c.cls = pp.cls"""))


# --- traces and responses ---------------------------------------------------------------------------
SPANS = """spans AS (
  SELECT user_id AS trace_id, event_id AS span_id,
    CASE WHEN event_type IN ('click', 'purchase') THEN
           ['get_valuation_score', 'compare_peers_tool', 'get_growth_trajectory', 'get_risk_summary',
            'query_knowledge_assistant', 'execute_genie_space'][event_id % 6 + 1]
         WHEN event_type = 'error' THEN ['mcp_genie_call', 'supervisor', 'planner', 'tool_router'][event_id % 4 + 1]
         ELSE 'chat_completion' END AS name,
    CASE WHEN event_type = 'view' THEN 'LLM' WHEN event_type IN ('click', 'purchase') THEN 'TOOL'
         WHEN event_type = 'error' THEN 'AGENT' ELSE 'CHAT_MODEL' END AS span_type,
    props AS inputs, props || repeat('.', CAST(event_id % 700 AS INTEGER)) AS outputs,
    CAST(ROUND(value * 1e6) AS BIGINT) AS dur_ns,
    CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'OK' END AS status, ts
  FROM events),
calls AS (
  SELECT trace_id, name, span_type, COALESCE(inputs, '') AS inputs, COALESCE(outputs, '') AS outputs,
    COALESCE(dur_ns / 1e6, 0.0) AS duration_ms,
    COALESCE(status, 'UNKNOWN') AS status
  FROM spans WHERE span_type = 'TOOL'
    OR (span_type = 'AGENT' AND regexp_matches(lower(name), 'genie|query_|get_|compare_|mcp|tool')))"""
CAT = """CASE WHEN regexp_matches(lower(name), 'genie|mcp.*genie|execute_genie|query_space_|poll_response_') THEN 'genie'
  WHEN regexp_matches(lower(name), 'query_knowledge_assistant|ka|knowledge') THEN 'knowledge_assistant'
  WHEN regexp_matches(lower(name), 'get_valuation_score|valuation') THEN 'valuation_score'
  WHEN regexp_matches(lower(name), 'compare_peers|peer') THEN 'compare_peers'
  WHEN regexp_matches(lower(name), 'get_growth_trajectory|growth') THEN 'growth_trajectory'
  WHEN regexp_matches(lower(name), 'get_risk_summary|risk') THEN 'risk_summary' ELSE name END"""
TOTALS = """tot AS (
  SELECT l.trace_id, l.llm_calls, COALESCE(c.total_duration_ms, 0.0) AS total_duration_ms
  FROM (SELECT trace_id, COUNT(*) FILTER (WHERE span_type IN ('LLM', 'CHAT_MODEL')) AS llm_calls FROM spans GROUP BY 1) l
  LEFT JOIN (SELECT trace_id, SUM(duration_ms) AS total_duration_ms FROM calls GROUP BY 1) c ON l.trace_id = c.trace_id)"""
EXPECTED = """expected AS (
  SELECT DISTINCT user_id AS trace_id, [['genie'], ['valuation_score', 'compare_peers'],
    ['knowledge_assistant', 'risk_summary']][user_id % 3 + 1] AS expected_tools FROM events
  UNION ALL SELECT DISTINCT user_id + 100000, ['genie'] FROM events WHERE user_id % 10 = 0),
found AS (SELECT trace_id, list_sort(list(DISTINCT cat)) AS tools_found
  FROM (SELECT trace_id, """ + CAT + """ AS cat FROM calls) GROUP BY 1),
val AS (
  SELECT e.trace_id, COALESCE(f.tools_found, []) AS tools_found, list_sort(list_distinct(e.expected_tools)) AS expected_tools,
    list_sort(list_filter(list_distinct(e.expected_tools), lambda x: NOT list_contains(COALESCE(f.tools_found, []), x)))
      AS missing_tools,
    list_sort(list_filter(COALESCE(f.tools_found, []), lambda x: NOT list_contains(e.expected_tools, x))) AS unexpected_tools,
    COALESCE(t.total_duration_ms, 0.0) AS total_duration_ms, CAST(COALESCE(t.llm_calls, 0) AS BIGINT) AS llm_calls
  FROM expected e LEFT JOIN found f ON e.trace_id = f.trace_id LEFT JOIN tot t ON e.trace_id = t.trace_id)"""
twin("tool_calls", W(SPANS, body="SELECT * FROM calls"))
twin("categorize", W(SPANS, body=f"SELECT span_id, name, {CAT} AS category FROM spans"))
twin("trace_totals", W(SPANS, TOTALS, body="SELECT * FROM tot"))
twin("tools_vs_expected", W(SPANS, TOTALS, EXPECTED, body="""
SELECT trace_id, tools_found, expected_tools, missing_tools, unexpected_tools, len(missing_tools) = 0 AS success,
  total_duration_ms, llm_calls FROM val"""))
twin("validate_traces", W(SPANS, TOTALS, EXPECTED, body="""
SELECT trace_id, len(missing_tools) = 0 AS success, CAST(len(missing_tools) AS INTEGER) AS n_missing,
  CAST(len(unexpected_tools) AS INTEGER) AS n_unexpected, llm_calls FROM val"""))
twin("latest_trace", W(SPANS, body="""
SELECT CAST(ts AS DATE) AS day, arg_max(trace_id, (ts, trace_id)) AS trace_id, MAX(ts) AS ts FROM spans
WHERE ts <= CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR
  AND ts >= CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 11 HOUR + INTERVAL 55 MINUTE
GROUP BY 1"""))
RESP = """words AS (
  SELECT *, list_filter(string_split_regex(regexp_replace(COALESCE(prev_user, ''), '[^\\p{L}\\s]', '', 'g'), '\\s+'), lambda x: x <> '') AS w
  FROM (SELECT *, LAG(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_user FROM conversations)
  WHERE role = 'assistant'),
resp AS (
  SELECT conv_id, turn, CASE WHEN conv_id % 23 = 5 THEN '' WHEN conv_id % 29 = 5 THEN 'no json: timeout'
    WHEN conv_id % 7 = 3 THEN 'Error: ' || text ELSE text END AS t,
    list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS expected_phrases
  FROM words)"""
twin("response_text", W(RESP, body="SELECT conv_id, turn, t AS text, t AS first_text FROM resp"))
twin("missing_phrases", W(RESP, body="""
SELECT conv_id, turn, list_sort(list_filter(expected_phrases, lambda e: NOT contains(lower(t), lower(e)))) AS missing,
  len(list_filter(expected_phrases, lambda e: NOT contains(lower(t), lower(e)))) = 0 AS ok FROM resp"""))
twin("score_responses", W(RESP, body="""
SELECT COUNT(*) AS n, ROUND(AVG(length(t)), 4) AS mean_length,
  ROUND(AVG(CASE WHEN starts_with(t, 'Error:') THEN 0 ELSE 1 END), 4) AS mean_no_error FROM resp"""))
twin("run_summary", W(RESP, body="""
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE ok) AS passed, COUNT(*) FILTER (WHERE NOT ok) AS failed,
  COUNT(*) FILTER (WHERE len(expected_phrases) > 0) AS validated, ROUND(SUM(length(t) / 1000.0), 3) AS total_seconds
FROM (SELECT *, NOT starts_with(t, 'Error:')
  AND len(list_filter(expected_phrases, lambda e: NOT contains(lower(t), lower(e)))) = 0 AS ok FROM resp)"""))
twin("ellipsis", """
SELECT 'ka-' || CAST(s_suppkey AS VARCHAR) AS id,
  CASE WHEN length(i) > 50 THEN substr(i, 1, 50) || '...' ELSE i END AS i50,
  CASE WHEN length(i) > 80 THEN substr(i, 1, 80) || '...' ELSE i END AS i80
FROM (SELECT s_suppkey, 'Use the filings of ' || s_name || ' to answer. ' || repeat('Cite sources. ', CAST(s_suppkey % 12 AS INTEGER))
  AS i FROM supplier)""")
twin("with_details", """
SELECT 'ka-' || CAST(s_suppkey AS VARCHAR) AS id, 'assistant_' || CAST(s_suppkey AS VARCHAR) AS name,
  CASE WHEN s_suppkey % 3 <> 0 THEN 'success' ELSE 'error' END AS status,
  CASE WHEN s_suppkey % 3 <> 0 THEN NULL ELSE 'NOT_FOUND' END AS error_code,
  CASE WHEN s_suppkey % 3 <> 0 THEN NULL ELSE 'no detail for ka-' || CAST(s_suppkey AS VARCHAR) END AS error_message,
  CASE WHEN s_suppkey % 3 <> 0 AND s_suppkey % 4 <> 0 THEN 'Answers questions for ' || s_name END AS description,
  CASE WHEN s_suppkey % 3 <> 0 THEN 'ka-ep-' || CAST(s_suppkey AS VARCHAR) END AS endpoint_name
FROM supplier""")


# --- remaining string / assistant / recommendation twins --------------------------------------------
twin("sanitize", """
WITH a AS (SELECT 'ka-' || CAST(s_suppkey AS VARCHAR) AS id,
  '  ' || COALESCE(CASE WHEN s_suppkey % 5 <> 0 THEN s_name END, '') || ' -- KA #' AS n FROM supplier),
b AS (SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(n, ' ', '_', 'g'),
  '[^a-zA-Z0-9_-]', '_', 'g'), '[_-]{2,}', '_', 'g'), '^[_-]+|[_-]+$', '', 'g') AS s FROM a)
SELECT id, COALESCE(NULLIF(s, ''), 'knowledge_assistant') AS safe_name FROM b""")
twin("source_name", """
SELECT page_id, translate(string_split(regexp_replace(regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1), '/+$', ''),
  '/')[-1], ' .', '__') AS source_name FROM pages""")
twin("format_assistants", """
SELECT 'ka-' || CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 5 <> 0 THEN s_name ELSE '' END AS name,
  'assistant_' || CAST(s_suppkey AS VARCHAR) AS resource_name,
  CASE WHEN s_suppkey % 4 <> 0 THEN 'Answers questions for ' || s_name ELSE '' END AS description,
  'Use the filings of ' || s_name || ' to answer. ' || repeat('Cite sources. ', CAST(s_suppkey % 12 AS INTEGER)) AS instructions,
  'ka-ep-' || CAST(s_suppkey AS VARCHAR) AS endpoint_name, 'user' || CAST(s_nationkey AS VARCHAR) || '@example.com' AS creator,
  '2024-01-' || lpad(CAST(s_suppkey % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS create_time,
  CASE WHEN s_suppkey % 6 <> 0 THEN 'exp-' || CAST(s_suppkey AS VARCHAR) ELSE '' END AS experiment_id,
  CAST(s_suppkey % 3 AS INTEGER) AS knowledge_base_count
FROM supplier""")
sw("recommend", f"""
WITH v AS (SELECT f.ticker, f.fiscal_year, CAST({PE} + {GR} + {MG} AS INTEGER) AS valuation_score
           FROM fin f JOIN stock s ON f.ticker = s.ticker),
o AS (SELECT ticker, SUM(valuation_score) AS s, COUNT(valuation_score) AS n FROM v GROUP BY ticker),
t AS (SELECT SUM(valuation_score) AS s, COUNT(valuation_score) AS n FROM v),
p AS (SELECT o.ticker, (t.s - COALESCE(o.s, 0)) / NULLIF(t.n - o.n, 0) AS pa FROM o CROSS JOIN t)
SELECT v.ticker, v.fiscal_year, v.valuation_score,
  CASE WHEN v.valuation_score >= 70 THEN 'BUY' WHEN v.valuation_score >= 40 THEN 'HOLD' ELSE 'SELL' END AS recommendation,
  CASE WHEN v.valuation_score > p.pa THEN 'ABOVE' ELSE 'BELOW' END AS versus_peer,
  ROUND(abs(v.valuation_score - p.pa), 2) AS peer_diff
FROM v JOIN p ON v.ticker = p.ticker""")


# --- sinks, streams, models -------------------------------------------------------------------------
fw("write_full", "SELECT * FROM registry")
twin("append_evolving", W(RAW_PRICES, DEDUP, body="""
SELECT ticker, trade_date, close_price, CASE WHEN year(trade_date) >= 2000 THEN volume END AS volume FROM dedup"""))
iw("export_by", """
SELECT lower(model_type) AS part, name, state_ready FROM flat
UNION ALL SELECT 'not ready', name, state_ready FROM flat WHERE COALESCE(state_ready, '') <> 'READY'""")
fw("write_snapshot", """
SELECT ticker, company_name, CAST(NULL AS VARCHAR) AS note, DATE '2001-12-31' AS as_of FROM registry""")
iw("read_inventory", "SELECT name, id, model_type, model_name FROM flat")
tw("first_n", "SELECT trip_id, pickup_ts, fare_amount FROM trips2 ORDER BY trip_id LIMIT 100")
tw("map_batches", "SELECT trip_id, predicted_fare FROM scored")
tw("save_model", "SELECT '1.0.0' AS version, COUNT(*) AS trips, COUNT(*) AS equal FROM trips2")
tw("cache_predictions", "SELECT trip_id, predicted_fare, predicted_tip_category FROM scored")


def html_text(x):
    for pat in ("(?s)<script\\b.*?</script>", "(?s)<style\\b.*?</style>", "(?s)<!--.*?-->", "<[^>]*>"):
        x = f"regexp_replace({x}, '{pat}', ' ', 'g')"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{ent}', '{ch}')"
    return f"trim(regexp_replace({x}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))"


_TAGS = " + ".join(f"len(regexp_extract_all(html, '(?s)<{t}\\b[^>]*>.*?</{t}>'))" for t in ("h1", "h2", "h3", "h4", "h5", "h6", "p", "li"))
twin("parse_docs", f"""
SELECT page_id, trim(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)) AS title, {html_text('html')} AS parsed_content,
  CAST(length({html_text('html')}) AS INTEGER) AS n_chars, CAST({_TAGS} AS INTEGER) AS n_elements FROM pages""")
def _bayes(labels: tuple[str, ...], judged: str, out: str) -> str:
    """Naive Bayes over the 65,536 commonest terms of the texts in ``judged`` (doc_id, label)."""
    order = ", ".join(f"({i}, '{x}')" for i, x in enumerate(labels))
    return f"""
WITH names(i, label) AS (VALUES {order}), judged AS ({judged}),
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}\\s]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY ALL),
c AS (SELECT term, i, sum(n) AS n FROM tf JOIN judged USING (doc_id) JOIN names USING (label) GROUP BY ALL),
top AS (SELECT term FROM c GROUP BY term ORDER BY sum(n) DESC, term LIMIT 65536),
total AS (SELECT i, sum(n) AS t FROM c JOIN top USING (term) GROUP BY i),
prior AS (SELECT i, ln(count(*) / sum(count(*)) OVER ()) AS p FROM judged JOIN names USING (label) JOIN documents USING (doc_id) GROUP BY i),
logs AS (SELECT term, i, ln((coalesce(c.n, 0) + 1.0) / (t + (SELECT count(*) FROM top))) AS w
         FROM top CROSS JOIN total LEFT JOIN c USING (term, i)),
s AS (SELECT doc_id, i, p + sum(n * w) AS score FROM tf JOIN logs USING (term) JOIN prior USING (i) GROUP BY doc_id, i, p),
b AS (SELECT doc_id, label FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS r FROM s) JOIN names USING (i) WHERE r = 1),
k AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n FROM tf JOIN top USING (term) GROUP BY doc_id)
SELECT doc_id, coalesce(label, '{labels[-1]}') AS {out}, coalesce(k.n, 0) AS n_known
FROM documents LEFT JOIN b USING (doc_id) LEFT JOIN k USING (doc_id)"""


twin("classify_quality", _bayes(("junk", "toxic", "good"), """SELECT doc_id, CASE WHEN quality = 0 THEN 'junk' WHEN toxic = 1 THEN 'toxic'
  ELSE 'good' END AS label FROM labels WHERE doc_id % 2 = 0""", "quality_class"))
twin("classify_language", _bayes(("de", "es", "fr", "en"), "SELECT doc_id, lang AS label FROM documents WHERE doc_id % 2 = 0", "language"))

# The text between a block's opening tag and the next block tag, through inline tags.
twin("element_tree", r"""
WITH bare AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                       '(?s)<(?:script|style)\b.*?</(?:script|style)\s*>', '', 'g') AS h FROM pages),
runs AS (SELECT page_id, unnest(regexp_extract_all(h, r, 1)) AS tag, unnest(regexp_extract_all(h, r, 2)) AS run,
                unnest(range(0, len(regexp_extract_all(h, r, 1)))) AS i
         FROM bare, (SELECT '<(p|li|h[1-6]|footer|div|title)\b[^>]*>((?:[^<]|</?(?:a|b|br)\b[^>]*>)*)' AS r)),
texts AS (SELECT page_id, i, tag, trim(regexp_replace(replace(replace(replace(replace(
            regexp_replace(replace(run, '<br>', ' '), '<[^>]*>', '', 'g'),
            '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM runs)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) AS n,
  CASE WHEN tag = 'p' THEN 'paragraph' WHEN tag = 'li' THEN 'list_item' WHEN tag[1] = 'h' THEN 'heading'
       WHEN tag = 'title' THEN 'title' ELSE 'section' END AS type, text FROM texts WHERE text <> ''""")
def _sums(name: str, of: str, amount: str, table: str) -> str:
    return f"""{name} AS (SELECT l_suppkey, fiscal_year, count(*) AS n, CAST(sum(CAST(round({amount} * 1e8) AS BIGINT)) AS BIGINT) AS cents,
  string_agg({of}, '|' ORDER BY {of}) AS names FROM {table} GROUP BY ALL)"""


fw("extract_schema", """
SELECT file_name, company AS company_name, ticker AS ticker_symbol, exchange, f.fiscal_year, fiscal_year_end_date, total_revenue_billions,
  cost_of_revenue_billions, gross_profit_billions, operating_income_billions, net_income_billions, total_assets_billions,
  total_liabilities_billions, total_equity_billions, cash_and_equivalents_billions, eps_diluted, revenue_growth_yoy_pct,
  seg.n AS n_business_segments, seg.cents AS cents_business_segments, seg.names AS names_business_segments,
  geo.n AS n_geographic_revenue, geo.cents AS cents_geographic_revenue, geo.names AS names_geographic_revenue
FROM filings f LEFT JOIN seg ON seg.l_suppkey = f.l_suppkey AND seg.fiscal_year = f.fiscal_year
LEFT JOIN geo ON geo.l_suppkey = f.l_suppkey AND geo.fiscal_year = f.fiscal_year""", SEGMENTS, GEOS,
   _sums("seg", "segment_name", "segment_revenue_billions", "segs"), _sums("geo", "region", "region_revenue_billions", "geos"))
fw("financials_from_texts", "SELECT * FROM fin")
BRONZE = f"""bronze AS (
  SELECT doc_id, source, text, {classify_sql('text', _DT)} AS document_type, {classify_sql('text', _SEC)} AS industry_sector
  FROM (SELECT doc_id, source, {html_text('text')} AS text FROM documents))"""
twin("stream_bronze", W(BRONZE, body="SELECT doc_id, document_type, industry_sector FROM bronze"))
twin("stream_binary", W(BRONZE, body="SELECT doc_id, source, document_type, industry_sector FROM bronze"))
twin("run_graph", W(BRONZE, body="SELECT doc_id, document_type FROM bronze"))
twin("stream_silver", W(BRONZE, body=f"SELECT doc_id, CAST(len({toks('text')}) AS INTEGER) AS n_words FROM bronze"))
twin("dedup_stream", "SELECT DISTINCT sha256(text) AS text_hash FROM documents")
twin("refresh", W(BRONZE, body="""
SELECT document_type, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM bronze WHERE document_type <> 'Annual_Report' GROUP BY 1"""))
twin("read_inventory_split", TWINS["read_inventory"])
twin("refresh_marts", TWINS["stock_summary"])
