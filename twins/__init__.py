"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each twin is written independently from the Spark code, over the same
pre-registered views. Building blocks are CTEs composed with ``W``.
"""

from __future__ import annotations

AS_OF = "DATE '2001-12-31'"


def W(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- prices ---------------------------------------------------------------------------------

RAW_PRICES = """raw_prices AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS ticker,
         CAST(l_shipdate AS DATE) AS trade_date,
         l_extendedprice * (1 - l_discount) AS open_price,
         l_extendedprice * (1 + l_tax) AS high_price,
         l_extendedprice * (1 - l_discount) * (1 - l_tax) AS low_price,
         l_extendedprice AS close_price,
         CAST(floor(l_quantity) AS BIGINT) AS volume,
         CAST(0 AS DOUBLE) AS dividends, CAST(0 AS DOUBLE) AS stock_splits,
         CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + to_seconds(l_orderkey) AS ingestion_timestamp,
         l_linenumber AS src_linenumber, l_partkey AS src_partkey
  FROM lineitem)"""

DEDUP = """dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker, trade_date
      ORDER BY ingestion_timestamp DESC, src_linenumber DESC, close_price DESC, src_partkey DESC,
               volume DESC, open_price DESC, high_price DESC) AS rn
    FROM raw_prices) WHERE rn = 1)"""

RETURNS = """rets AS (
  SELECT *, ROUND((close_price - LAG(close_price) OVER w) / NULLIF(LAG(close_price) OVER w, 0) * 100, 4)
            AS daily_return_pct
  FROM dedup WINDOW w AS (PARTITION BY ticker ORDER BY trade_date))"""


def _sma(n: int) -> str:
    # exact half-up rounding of the mean in cents (prices have two decimals)
    w = f"(PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    cents = "CAST(ROUND(close_price * 100) AS BIGINT)"
    return (f"CAST((2 * SUM({cents}) OVER {w} + COUNT(*) OVER {w}) // (2 * COUNT(*) OVER {w}) AS DOUBLE) / 100"
            f" AS sma_{n}")


DAILY = f"""daily AS (
  SELECT ticker, trade_date, open_price, high_price, low_price, close_price, close_price AS adj_close_price,
         volume, dividends, stock_splits, ingestion_timestamp, daily_return_pct,
         {_sma(20)}, {_sma(50)}, {_sma(200)},
         ROUND(STDDEV_SAMP(daily_return_pct) OVER (PARTITION BY ticker ORDER BY trade_date
               ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 4) AS volatility_20d
  FROM rets)"""

PRICES = (RAW_PRICES, DEDUP, RETURNS, DAILY)

# --- filings, registry, marts -----------------------------------------------------------------

FACTS = """facts AS (
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS fiscal_year,
         SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS rev,
         SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(l_discount AS DECIMAL(4,2)) * 5 + CAST(0.5 AS DECIMAL(2,1)))) AS cost,
         SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))) AS opex
  FROM lineitem GROUP BY ALL)"""

FILINGS = """filings AS (
  SELECT 'S' || CAST(f.l_suppkey AS VARCHAR) AS ticker, f.fiscal_year, s.s_name AS company,
         CASE WHEN s.s_acctbal >= 0 THEN 'NYSE' ELSE 'NASDAQ' END AS exchange,
         CAST(f.fiscal_year AS VARCHAR) || '-12-31' AS fiscal_year_end_date,
         CAST(rev AS DOUBLE) / 1e6 AS total_revenue_billions,
         CAST(cost AS DOUBLE) / 1e6 AS cost_of_revenue_billions,
         CAST(rev - cost AS DOUBLE) / 1e6 AS gross_profit_billions,
         CAST(rev - cost - opex AS DOUBLE) / 1e6 AS operating_income_billions,
         CAST((rev - cost - opex) * CAST(0.79 AS DECIMAL(3,2)) AS DOUBLE) / 1e6 AS net_income_billions,
         CAST(rev * CAST(1.5 AS DECIMAL(2,1)) AS DOUBLE) / 1e6 AS total_assets_billions,
         CAST(rev * CAST(0.6 AS DECIMAL(2,1)) AS DOUBLE) / 1e6 AS total_liabilities_billions,
         CAST(rev * CAST(0.9 AS DECIMAL(2,1)) AS DOUBLE) / 1e6 AS total_equity_billions,
         CAST(abs(CAST(s.s_acctbal AS DECIMAL(12,2))) / 1000 AS DOUBLE) AS cash_and_equivalents_billions,
         CAST((rev - cost - opex) * CAST(0.79 AS DECIMAL(3,2)) AS DOUBLE) / 1e6 * 1000 / 250 AS eps_diluted,
         ROUND((CAST(rev AS DOUBLE) - LAG(CAST(rev AS DOUBLE)) OVER w)
               / NULLIF(LAG(CAST(rev AS DOUBLE)) OVER w, 0) * 100, 2) AS revenue_growth_yoy_pct,
         '10-K Annual Report' AS document_type, n.n_name AS industry_sector,
         'S' || CAST(f.l_suppkey AS VARCHAR) || '_' || CAST(f.fiscal_year AS VARCHAR) || '_10k.pdf' AS file_name,
         f.l_suppkey
  FROM facts f JOIN supplier s ON f.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
  WINDOW w AS (PARTITION BY f.l_suppkey ORDER BY f.fiscal_year))"""

REGISTRY = """registry AS (
  SELECT company AS company_name, ticker, exchange, file_name AS source_file, document_type, industry_sector
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY file_name DESC) AS rn FROM filings)
  WHERE rn = 1)"""

FIN = """fin AS (
  SELECT company, ticker, fiscal_year, fiscal_year_end_date, total_revenue_billions, cost_of_revenue_billions,
         gross_profit_billions, operating_income_billions, net_income_billions, total_assets_billions,
         total_liabilities_billions, total_equity_billions, cash_and_equivalents_billions, eps_diluted,
         ROUND(gross_profit_billions / NULLIF(total_revenue_billions, 0) * 100, 2) AS gross_margin_pct,
         ROUND(operating_income_billions / NULLIF(total_revenue_billions, 0) * 100, 2) AS operating_margin_pct,
         ROUND(net_income_billions / NULLIF(total_revenue_billions, 0) * 100, 2) AS net_margin_pct,
         revenue_growth_yoy_pct, document_type, industry_sector
  FROM filings)"""

FINANCIALS = (FACTS, FILINGS, REGISTRY, FIN)

SEGMENTS = """segs AS (
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS fiscal_year, p_type AS segment_name,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / 1e6 AS segment_revenue_billions
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""

GEOS = """geos AS (
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS fiscal_year, r_name AS region,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / 1e6 AS region_revenue_billions
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL)"""

SEG_MART = """seg_mart AS (
  SELECT f.company, f.ticker, f.fiscal_year, g.segment_name, g.segment_revenue_billions,
         ROUND(g.segment_revenue_billions / NULLIF(f.total_revenue_billions, 0) * 100, 2) AS segment_pct_of_total,
         ROW_NUMBER() OVER (PARTITION BY f.ticker ORDER BY g.segment_revenue_billions DESC, g.segment_name)
           AS segment_rank,
         CAST(NULL AS DOUBLE) AS segment_growth_yoy_pct
  FROM filings f JOIN segs g ON f.l_suppkey = g.l_suppkey AND f.fiscal_year = g.fiscal_year)"""

GEO_MART = """geo_mart AS (
  SELECT f.company, f.ticker, f.fiscal_year, g.region, g.region_revenue_billions,
         ROUND(g.region_revenue_billions / NULLIF(f.total_revenue_billions, 0) * 100, 2) AS region_pct_of_total,
         CAST(NULL AS DOUBLE) AS region_growth_yoy_pct
  FROM filings f JOIN geos g ON f.l_suppkey = g.l_suppkey AND f.fiscal_year = g.fiscal_year)"""

STOCK = f"""latest AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn
                              FROM daily) WHERE rn = 1),
rng AS (
  SELECT ticker, MIN(close_price) AS fifty_two_week_low, MAX(close_price) AS fifty_two_week_high
  FROM daily WHERE trade_date >= {AS_OF} - 365 GROUP BY ticker),
per AS (
  SELECT ticker,
         arg_min(close_price, trade_date) FILTER (WHERE trade_date >= date_trunc('year', {AS_OF})) AS year_start_price,
         arg_min(close_price, trade_date) AS one_year_ago_price
  FROM daily WHERE trade_date >= {AS_OF} - 365 GROUP BY ticker),
vol AS (
  SELECT ticker, ROUND(AVG(volume), 0) AS avg_volume_10d FROM (
    SELECT ticker, volume, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn FROM daily)
  WHERE rn <= 10 GROUP BY ticker),
market AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker,
         CASE WHEN s_suppkey % 11 <> 0 THEN CAST(5 + (s_suppkey * 7) % 70 AS DOUBLE) END AS pe_ratio,
         CAST(abs(CAST(s_acctbal AS DECIMAL(12,2))) / 100 AS DOUBLE) AS market_cap_billions,
         CAST(s_suppkey % 20 AS DOUBLE) / 4 AS price_to_sales, CAST(s_suppkey % 30 AS DOUBLE) / 8 AS ev_to_revenue
  FROM supplier),
stock AS (
  SELECT l.ticker, COALESCE(r.company_name, l.ticker) AS company, l.close_price AS current_price,
         l.trade_date AS price_date,
         m.market_cap_billions, m.pe_ratio,
         CAST(NULL AS DOUBLE) AS forward_pe, CAST(NULL AS DOUBLE) AS peg_ratio,
         m.price_to_sales, CAST(NULL AS DOUBLE) AS price_to_book,
         CAST(NULL AS DOUBLE) AS enterprise_value_billions, m.ev_to_revenue,
         CAST(NULL AS DOUBLE) AS ev_to_ebitda, CAST(NULL AS DOUBLE) AS dividend_yield_pct,
         CAST(NULL AS DOUBLE) AS beta,
         g.fifty_two_week_high, g.fifty_two_week_low,
         ROUND((l.close_price - p.year_start_price) / NULLIF(p.year_start_price, 0) * 100, 2) AS ytd_return_pct,
         ROUND((l.close_price - p.one_year_ago_price) / NULLIF(p.one_year_ago_price, 0) * 100, 2)
           AS one_year_return_pct,
         v.avg_volume_10d,
         l.close_price > l.sma_50 AS above_sma_50, l.close_price > l.sma_200 AS above_sma_200,
         CASE WHEN l.close_price > l.sma_50 AND l.close_price > l.sma_200 THEN 'Bullish'
              WHEN l.close_price < l.sma_50 AND l.close_price < l.sma_200 THEN 'Bearish'
              ELSE 'Neutral' END AS trend_signal
  FROM latest l LEFT JOIN rng g ON l.ticker = g.ticker LEFT JOIN per p ON l.ticker = p.ticker
       LEFT JOIN vol v ON l.ticker = v.ticker LEFT JOIN registry r ON l.ticker = r.ticker
       LEFT JOIN market m ON l.ticker = m.ticker)"""


def sql() -> dict[str, str]:
    """All twins by query name."""
    from twins import catalogue
    return catalogue.build()

# --- trips ------------------------------------------------------------------------------------

TRIPS = """trips AS (
  SELECT event_id AS trip_id, ts AS pickup_ts, value AS trip_distance,
         CAST(1 + user_id % 6 AS INTEGER) AS passenger_count,
         CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
         CASE WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 THEN 1 ELSE 0 END AS is_rush_hour,
         CASE WHEN isodow(ts) - 1 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
         greatest(CAST(2.5 AS DOUBLE), least(CAST(200.0 AS DOUBLE),
           CAST(2.5 AS DOUBLE) + CAST(3.5 AS DOUBLE) * value
           + CAST(2 * (CASE WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 THEN 1 ELSE 0 END) AS DOUBLE)
           + CAST(((event_id * 7) % 11 - 5) AS DOUBLE) * CAST(0.25 AS DOUBLE))) AS fare_amount,
         event_id
  FROM events),
trips2 AS (
  SELECT * EXCLUDE (event_id), fare_amount AS actual_fare,
         fare_amount * CAST(event_id % 30 AS DOUBLE) / 100 AS tip_amount
  FROM trips)"""

TIP_TH = """th AS (
  SELECT CASE WHEN abs(q67 - q33) < 0.01 THEN 5.0 ELSE q33 END AS q33,
         CASE WHEN abs(q67 - q33) < 0.01 THEN 15.0 ELSE q67 END AS q67
  FROM (SELECT quantile_cont(tip_amount, 0.33) AS q33, quantile_cont(tip_amount, 0.67) AS q67 FROM trips2))"""

SCORED = """scored AS (
  SELECT t.*, greatest(CAST(0.0 AS DOUBLE), CAST(2.5 AS DOUBLE) + CAST(3.5 AS DOUBLE) * trip_distance
                        + CAST(2 * COALESCE(is_rush_hour, 0) AS DOUBLE)) AS predicted_fare,
         CASE WHEN actual_fare * 0.15 <= th.q33 THEN 'Low Tip'
              WHEN actual_fare * 0.15 <= th.q67 THEN 'Medium Tip' ELSE 'High Tip' END AS predicted_tip_category
  FROM trips2 t CROSS JOIN th)"""

TRIP_CTES = (TRIPS, TIP_TH, SCORED)


def mean(x: str, scale: int = 2) -> str:
    return f"CAST(ROUND(AVG(CAST({x} AS DECIMAL(18,4))), {scale}) AS DOUBLE)"


def day_name(x: str) -> str:
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    return "CASE " + " ".join(f"WHEN {x} = {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


def decimal_round(sql: str) -> str:
    """Rewrite every ``ROUND(x, n)`` as a half-up rounding of x's shortest
    decimal form (Spark's rule for doubles): ``ROUND(CAST(x AS DECIMAL(38,9)), n)``."""
    out, i = [], 0
    while True:
        j = sql.find("ROUND(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        inner = decimal_round(sql[j + 6:comma]) if comma else decimal_round(sql[j + 6:k])
        scale = sql[comma + 1:k].strip() if comma else "0"
        out.append(sql[i:j])
        out.append(f"CAST(ROUND(CAST(CAST({inner} AS VARCHAR) AS DECIMAL(38,17)), {scale}) AS DOUBLE)")
        i = k + 1

# --- inventory ---------------------------------------------------------------------------------

_ET = ("CASE k WHEN 0 THEN 'FOUNDATION_MODEL' WHEN 1 THEN 'PT_FOUNDATION_MODEL' WHEN 5 THEN 'EXTERNAL_MODEL' "
       "WHEN 6 THEN 'FEATURE_SPEC' ELSE 'UC_MODEL' END")
_PROV = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'openai' WHEN 'BUILDING' THEN 'anthropic' "
         "WHEN 'FURNITURE' THEN 'custom' WHEN 'HOUSEHOLD' THEN 'google' WHEN 'MACHINERY' THEN 'cohere' END")
_PT = ("CASE c_nationkey % 4 WHEN 0 THEN 'KNOWLEDGE_ASSISTANT' WHEN 1 THEN 'MULTI_AGENT_SUPERVISOR' "
       "WHEN 2 THEN 'INFORMATION_EXTRACTION' ELSE 'MODEL_SPECIALIZATION' END")

EP = f"""ep0 AS (
  SELECT *, c_custkey % 8 AS k, lower(c_mktsegment) AS seg, c_custkey % 16 = 9 AS legacy,
         c_custkey % 25 = 0 AS noconf FROM customer),
ep AS (
  SELECT *,
    CASE WHEN k = 0 THEN 'databricks-' || seg || '-' || CAST(c_custkey % 3 + 1 AS VARCHAR)
         ELSE 'ep-' || seg || '-' || CAST(c_custkey AS VARCHAR) END AS name,
    CASE WHEN k IN (4, 7) THEN 'agent/v1/responses' WHEN k = 2 THEN 'llm/v1/chat' END AS task,
    CASE WHEN noconf THEN 'unknown' WHEN legacy THEN 'SERVED_MODEL' ELSE {_ET} END AS entity_type,
    NOT noconf AND NOT legacy AND k = 3 AND c_custkey % 3 = 0 AS sysfm,
    CASE WHEN noconf OR legacy THEN NULL WHEN k = 5 THEN {_PROV}
         WHEN k IN (0, 1) OR (k = 3 AND c_custkey % 3 = 0) THEN 'databricks' END AS model_provider,
    CASE WHEN k = 7 THEN {_PT} END AS problem_type
  FROM ep0),
flat AS (
  SELECT name, 'id-' || CAST(c_custkey AS VARCHAR) AS id,
    CASE WHEN k = 0 THEN 'FOUNDATION_MODEL_API' END AS endpoint_type, task,
    'user' || CAST(c_nationkey AS VARCHAR) || '@example.com' AS creator,
    make_timestamp((1704067200000 + c_custkey * 60000) * 1000) AS created_at,
    make_timestamp((1704067200000 + c_custkey * 120000) * 1000) AS updated_at,
    CASE WHEN c_acctbal >= 0 THEN 'READY' ELSE 'NOT_READY' END AS state_ready, 'NOT_UPDATING' AS config_update,
    entity_type,
    CASE WHEN noconf THEN NULL WHEN legacy THEN 'legacy-' || seg WHEN k = 2 THEN 'system.ai.' || seg
         WHEN k IN (3, 4, 7) THEN 'main.models.' || seg END AS entity_name,
    CASE WHEN noconf THEN NULL WHEN legacy THEN '2' WHEN k IN (2, 3, 4, 7) THEN CAST(c_custkey % 5 + 1 AS VARCHAR) END
      AS entity_version,
    CASE WHEN noconf THEN '' WHEN legacy THEN 'served-' || seg
         WHEN k = 5 THEN 'ext-' || seg || '-' || CAST(c_custkey % 4 AS VARCHAR)
         WHEN k IN (0, 1) THEN 'fm-' || seg WHEN k = 6 THEN 'served-' || seg WHEN sysfm THEN 'system.ai.' || seg
         ELSE '' END AS model_name,
    CASE WHEN noconf THEN '' WHEN legacy THEN 'legacy-' || seg WHEN k = 2 THEN 'system.ai.' || seg
         WHEN k IN (3, 4, 7) AND NOT sysfm THEN 'main.models.' || seg ELSE '' END AS registered_model_name,
    model_provider,
    CASE WHEN noconf THEN NULL WHEN legacy THEN true ELSE c_custkey % 2 = 0 END AS scale_to_zero,
    CASE WHEN noconf THEN NULL WHEN legacy THEN 'Small'
         ELSE CASE c_custkey % 3 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' ELSE 'Large' END END AS workload_size,
    CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 3 END AS tag_count,
    CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'again' ELSE c_mktsegment END AS segment_tag,
    CASE WHEN k = 7 THEN 'tile-' || CAST(c_custkey AS VARCHAR) END AS tile_id, problem_type,
    CASE WHEN task LIKE '%agent%' THEN 'agent'
         WHEN noconf THEN CASE WHEN k = 0 THEN 'foundation_model' ELSE 'unknown' END
         WHEN legacy THEN 'custom_model'
         WHEN k = 5 THEN 'external_model' WHEN k IN (0, 1) OR sysfm THEN 'foundation_model' WHEN k = 6 THEN 'feature_serving'
         WHEN k IN (2, 3, 4, 7) THEN 'custom_model' ELSE 'unknown' END AS endpoint_category,
    CASE WHEN problem_type = 'KNOWLEDGE_ASSISTANT' THEN 'AGENT_BRICKS_KA'
         WHEN problem_type = 'MULTI_AGENT_SUPERVISOR' THEN 'AGENT_BRICKS_MAS'
         WHEN problem_type = 'INFORMATION_EXTRACTION' THEN 'AGENT_BRICKS_KIE'
         WHEN problem_type = 'MODEL_SPECIALIZATION' THEN 'AGENT_BRICKS_MS'
         WHEN entity_type = 'FOUNDATION_MODEL' AND starts_with(name, 'databricks-') THEN 'DATABRICKS_FM_PPT'
         WHEN entity_type = 'PT_FOUNDATION_MODEL' THEN 'DATABRICKS_FM_PT'
         WHEN entity_type = 'UC_MODEL' AND (k = 2 OR sysfm) THEN 'DATABRICKS_FM_UC_SYSTEM_AI'
         WHEN entity_type = 'UC_MODEL' AND COALESCE(task, '') = '' THEN 'DATABRICKS_CLASSIC_ML'
         WHEN entity_type = 'UC_MODEL' THEN 'DATABRICKS_FM_UC_AGENTS'
         WHEN entity_type = 'EXTERNAL_MODEL' AND model_provider = 'custom' THEN 'FM_EXTERNAL_MODEL_CUSTOM'
         WHEN entity_type = 'EXTERNAL_MODEL' THEN 'FM_EXTERNAL_MODEL'
         WHEN entity_type = 'FEATURE_SPEC' THEN 'FEATURE_SPEC' ELSE 'UNCLASSIFIED' END AS model_type,
    CASE WHEN noconf OR c_custkey % 3 = 1 THEN false ELSE c_custkey % 3 = 0 END AS usage_tracking_enabled,
    CASE WHEN noconf OR c_custkey % 3 = 1 THEN NULL ELSE 'main' END AS inference_table_catalog,
    CASE WHEN noconf OR c_custkey % 3 = 1 THEN NULL ELSE seg END AS inference_table_schema,
    CASE WHEN noconf THEN 0 ELSE CAST(c_custkey % 3 AS INTEGER) END AS rate_limits_count,
    '[' || CASE WHEN noconf THEN '' ELSE rtrim(repeat('{{"calls":100,"renewal_period":"minute"}},', CAST(c_custkey % 3 AS INTEGER)), ',') END
      || ']' AS rate_limits,
    CASE WHEN noconf THEN false ELSE c_custkey % 4 = 0 END AS guardrails_enabled
  FROM ep)"""

FAMILY = """CASE WHEN model_type IN ('DATABRICKS_FM_PPT', 'DATABRICKS_FM_PT', 'DATABRICKS_FM_UC_SYSTEM_AI') THEN 'foundation'
  WHEN model_type IN ('FM_EXTERNAL_MODEL', 'FM_EXTERNAL_MODEL_CUSTOM') THEN 'external'
  WHEN model_type IN ('AGENT_BRICKS_KA', 'AGENT_BRICKS_MAS', 'AGENT_BRICKS_KIE', 'AGENT_BRICKS_MS',
                      'DATABRICKS_FM_UC_AGENTS') THEN 'agent'
  WHEN model_type = 'DATABRICKS_CLASSIC_ML' THEN 'classic' WHEN model_type = 'FEATURE_SPEC' THEN 'feature'
  ELSE 'unclassified' END"""
