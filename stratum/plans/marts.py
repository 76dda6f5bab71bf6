"""Gold marts and analytic views of the filing and price pipeline.

Each mart is a function of its inputs returning a lazy DataFrame; :class:`Marts`
builds and writes them in dependency order. ``as_of`` replaces the reference's current date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.functions import scalars as S
from stratum.operators import timeseries as ts
from stratum.session import written
from stratum.sources import fixtures as fx

DEFAULT_AS_OF = "2001-12-31"
VALUATION_COLS = ["market_cap_billions", "pe_ratio", "forward_pe", "peg_ratio", "price_to_sales",
                  "price_to_book", "enterprise_value_billions", "ev_to_revenue", "ev_to_ebitda",
                  "dividend_yield_pct", "beta"]
RESP = "extracted_metrics"


def merge_history(history: DataFrame, refresh: DataFrame | None = None) -> DataFrame:
    """History UNION ALL refresh (by name); the de-duplication follows."""
    return history if refresh is None else history.unionByName(refresh, allowMissingColumns=True)


def daily_prices(raw: DataFrame, refresh: DataFrame | None = None,
                 order=tuple(fx.INGEST_ORDER)) -> DataFrame:
    """Silver daily prices: latest ingestion per (ticker, date), lagged return,
    20/50/200-row moving averages (exact on cents) and 20-row volatility."""
    dedup = ts.keep_latest(merge_history(raw, refresh), ["ticker", "trade_date"], list(order))
    key, order_by = ["ticker"], ["trade_date"]
    out = ts.lag_return(dedup, key, order_by, "close_price", "daily_return_pct", 4)
    out = ts.moving_average(out, key, order_by, "close_price", (20, 50, 200), scale=2, exact_scale=2)
    out = ts.rolling_stddev(out, key, order_by, "daily_return_pct", 20, "volatility_20d", 4)
    return out.select("ticker", "trade_date", "open_price", "high_price", "low_price", "close_price",
                      F.col("close_price").alias("adj_close_price"), "volume", "dividends",
                      "stock_splits", "ingestion_timestamp", "daily_return_pct",
                      "sma_20", "sma_50", "sma_200", "volatility_20d")


def company_registry(silver: DataFrame) -> DataFrame:
    """One row per ticker from extracted fields (B1 + B2 + B10 + G3).

    Where a ticker has several filings, the latest source file wins (a total
    order instead of an arbitrary drop-duplicates pick).
    """
    reg = silver.select(
        S.first_known(S.vpath(RESP, "response.company_name"), "company_key").alias("company_name"),
        S.vpath(RESP, "response.ticker_symbol").alias("ticker"),
        S.vpath(RESP, "response.exchange").alias("exchange"),
        F.col("file_name").alias("source_file"), "document_type", "industry_sector",
    ).filter(S.present("ticker"))
    return ts.keep_latest(reg, ["ticker"], ["source_file"])


def _identity(silver: DataFrame, registry: DataFrame) -> DataFrame:
    """Silver ⟕ registry on the extracted ticker (C1) + identity columns (B1)."""
    s = silver.withColumn("_x_ticker", S.vpath(RESP, "response.ticker_symbol"))
    r = registry.select(F.col("ticker").alias("_r_ticker"), F.col("company_name").alias("_r_company"))
    j = s.join(r, F.col("_x_ticker") == F.col("_r_ticker"), "left")
    return (j.withColumn("company", S.first_known(S.vpath(RESP, "response.company_name"), "_r_company", "company_key"))
             .withColumn("ticker", S.first_known("_x_ticker", "_r_ticker", "company_key"))
             .withColumn("fiscal_year", F.coalesce(S.vpath(RESP, "response.fiscal_year", "int"), F.lit(2024))))


FIN_FIELDS = ["total_revenue_billions", "cost_of_revenue_billions", "gross_profit_billions",
              "operating_income_billions", "net_income_billions", "total_assets_billions",
              "total_liabilities_billions", "total_equity_billions", "cash_and_equivalents_billions",
              "eps_diluted"]


def company_financials(silver: DataFrame, registry: DataFrame) -> DataFrame:
    """Gold company financials: identity chain, typed fields, margins."""
    j = _identity(silver, registry)
    num = {f: S.vpath(RESP, f"response.{f}", "double") for f in FIN_FIELDS}
    rev = num["total_revenue_billions"]
    return j.select(
        "company", "ticker", "fiscal_year",
        S.vpath(RESP, "response.fiscal_year_end_date").alias("fiscal_year_end_date"),
        *[c.alias(f) for f, c in num.items()],
        S.pct(num["gross_profit_billions"], rev).alias("gross_margin_pct"),
        S.pct(num["operating_income_billions"], rev).alias("operating_margin_pct"),
        S.pct(num["net_income_billions"], rev).alias("net_margin_pct"),
        S.vpath(RESP, "response.revenue_growth_yoy_pct", "double").alias("revenue_growth_yoy_pct"),
        "document_type", "industry_sector")


def _breakdown(silver: DataFrame, registry: DataFrame, field: str, ddl: str, name: str,
               value: str, pct_name: str, rank_name: str | None, by_year: bool) -> DataFrame:
    j = _identity(silver, registry)
    items = S.parse_array(F.to_json(F.try_variant_get(F.col(RESP), f"$.response.{field}", "variant")), ddl)
    # Inner explode - filings without the list vanish; B10: unnamed items dropped.
    ex = (j.filter(F.try_variant_get(F.col(RESP), f"$.response.{field}", "variant").isNotNull())
          .select("company", "ticker", "fiscal_year", "company_key",
                  S.vpath(RESP, "response.total_revenue_billions", "double").alias("_rev"),
                  F.explode(items).alias("it"))
          .filter(F.col("it")[name].isNotNull()))
    out = ex.select("company", "ticker", "fiscal_year", "_rev", "company_key",
                    F.col("it")[name].alias(name), F.col("it")[value].alias(value))
    out = out.withColumn(pct_name, S.pct(value, "_rev"))
    if rank_name:
        part = [F.coalesce("ticker", "company_key")] + (["fiscal_year"] if by_year else [])
        out = ts.rank_in_key(out, part, [F.col(value).desc(), F.col(name)], rank_name)
    return out.drop("_rev", "company_key")


def revenue_by_segment(silver: DataFrame, registry: DataFrame, by_year: bool = False) -> DataFrame:
    """Gold segments: explode, share of revenue, rank in ticker.

    ``by_year=True`` ranks within (ticker, fiscal year); the reference ranks
    across all of a ticker's filings."""
    out = _breakdown(silver, registry, "business_segments",
                     "array<struct<segment_name:string,segment_revenue_billions:double>>",
                     "segment_name", "segment_revenue_billions", "segment_pct_of_total",
                     "segment_rank", by_year)
    return out.withColumn("segment_growth_yoy_pct", S.null_as("double"))


def revenue_by_geography(silver: DataFrame, registry: DataFrame) -> DataFrame:
    """Gold regions: explode and share of revenue."""
    out = _breakdown(silver, registry, "geographic_revenue",
                     "array<struct<region:string,region_revenue_billions:double>>",
                     "region", "region_revenue_billions", "region_pct_of_total", None, False)
    return out.withColumn("region_growth_yoy_pct", S.null_as("double"))


def stock_summary(daily: DataFrame, registry: DataFrame, as_of: str = DEFAULT_AS_OF,
                  strict: bool = False, market: DataFrame | None = None) -> DataFrame:
    """Gold stock summary: latest row, 52-week range, period returns, 10-day
    volume, trend (E5 E6 E7 E8 C2 B8). ``market`` optionally supplies the
    valuation columns (ticker + any of VALUATION_COLS); otherwise NULL."""
    since = F.date_sub(F.lit(as_of).cast("date"), 365)
    recent, in_year = F.col("trade_date") >= since, F.col("trade_date") >= F.trunc(F.lit(as_of).cast("date"), "year")
    ten = Window.partitionBy("ticker").orderBy("trade_date").rowsBetween(-9, Window.currentRow)  # in the order ``daily`` has
    when = lambda cond, c: F.when(cond, F.col(c))
    # the windows of ``daily`` already lie by ticker: one aggregate, no further shuffle
    last = F.max_by(F.struct("close_price", "trade_date", "sma_50", "sma_200", "_volume"), "trade_date")
    first = F.min_by(when(recent & in_year, "close_price"), when(recent & in_year, "trade_date"))
    year_ago = (F.max_by if strict else F.min_by)(when(recent, "close_price"), when(recent, "trade_date"))
    g = daily.withColumn("_volume", F.avg("volume").over(ten)).groupBy("ticker").agg(
        last.alias("_last"), F.min(when(recent, "close_price")).alias("fifty_two_week_low"),
        F.max(when(recent, "close_price")).alias("fifty_two_week_high"),
        (F.min_by(when(recent, "close_price"), when(recent, "trade_date")) if strict else first).alias("year_start_price"),
        year_ago.alias("one_year_ago_price"))
    g = g.select("*", "_last.*", F.round("_last._volume", 0).alias("avg_volume_10d")).drop("_last", "_volume")
    j = g.join(registry.select("ticker", F.col("company_name").alias("_company")), "ticker", "left")
    if market is not None:
        j = j.join(market, "ticker", "left")
    vals = [F.col(c).cast("double").alias(c) if market is not None and c in market.columns
            else S.null_as("double").alias(c) for c in VALUATION_COLS]
    c = F.col("close_price")
    return j.select(
        "ticker", F.coalesce("_company", "ticker").alias("company"),
        c.alias("current_price"), F.col("trade_date").alias("price_date"), *vals,
        "fifty_two_week_high", "fifty_two_week_low",
        F.round((c - F.col("year_start_price")) / F.nullif(F.col("year_start_price"), F.lit(0)) * 100, 2)
        .alias("ytd_return_pct"),
        F.round((c - F.col("one_year_ago_price")) / F.nullif(F.col("one_year_ago_price"), F.lit(0)) * 100, 2)
        .alias("one_year_return_pct"),
        "avg_volume_10d",
        S.above(c, "sma_50").alias("above_sma_50"), S.above(c, "sma_200").alias("above_sma_200"),
        S.trend_signal(c, "sma_50", "sma_200").alias("trend_signal"))


# --- views (A11) ---------------------------------------------------------------------------

def company_overview(fin: DataFrame, stock: DataFrame, latest_only: bool = False) -> DataFrame:
    """Financials ⟕ stock summary. One row per filing (the reference fans
    out per filing); ``latest_only`` keeps each ticker's latest fiscal year."""
    if latest_only:
        fin = ts.keep_latest(fin, ["ticker"], ["fiscal_year"])
    s = stock.drop("company")
    j = fin.join(s, "ticker", "left")
    return j.select(
        "company", "ticker", "fiscal_year", "fiscal_year_end_date", "total_revenue_billions",
        "revenue_growth_yoy_pct", "cost_of_revenue_billions", "gross_profit_billions", "gross_margin_pct",
        "operating_income_billions", "operating_margin_pct", "net_income_billions", "net_margin_pct",
        F.col("eps_diluted").alias("earnings_per_share"), "total_assets_billions",
        "total_liabilities_billions", F.col("total_equity_billions").alias("stockholders_equity_billions"),
        "cash_and_equivalents_billions", "current_price", "price_date", *VALUATION_COLS,
        "fifty_two_week_high", "fifty_two_week_low", "ytd_return_pct", "one_year_return_pct",
        "trend_signal",
        F.round(F.col("market_cap_billions") / F.nullif(F.col("net_income_billions"), F.lit(0)), 2)
        .alias("price_to_earnings"),
        F.round(F.col("market_cap_billions") / F.nullif(F.col("total_revenue_billions"), F.lit(0)), 2)
        .alias("market_cap_to_revenue"))


def peer_comparison(overview: DataFrame) -> DataFrame:
    """Four global RANKs over the overview (one row per company filing)."""
    base = overview.select("company", "ticker", "fiscal_year", "total_revenue_billions",
                           "market_cap_billions", "revenue_growth_yoy_pct", "ytd_return_pct",
                           "gross_margin_pct", "operating_margin_pct", "net_margin_pct", "pe_ratio",
                           "price_to_sales", "ev_to_revenue")
    return ts.rank_peers(base, {
        "revenue_rank": ("total_revenue_billions", F.col("total_revenue_billions").desc_nulls_last()),
        "margin_rank": ("net_margin_pct", F.col("net_margin_pct").desc_nulls_last()),
        "growth_rank": ("revenue_growth_yoy_pct", F.col("revenue_growth_yoy_pct").desc_nulls_last()),
        "pe_rank": ("pe_ratio", F.col("pe_ratio").asc_nulls_last()),
    })


def stock_performance(daily: DataFrame, fin: DataFrame, latest_only: bool = True) -> DataFrame:
    """Daily prices ⟕ company name, trend and % above averages.

    The reference joins every filing of a ticker (one price row per filing);
    ``latest_only`` (default) joins the company of the latest filing only."""
    comp = fin.select("ticker", "fiscal_year", "company")
    if latest_only:
        comp = ts.keep_latest(comp, ["ticker"], ["fiscal_year"])
    j = daily.join(comp.drop("fiscal_year"), "ticker", "left")
    c = F.col("close_price")
    return j.select("ticker", "company", "trade_date", "close_price", "volume", "daily_return_pct",
                    "sma_20", "sma_50", "sma_200", "volatility_20d",
                    S.trend_signal(c, "sma_50", "sma_200").alias("trend_signal"),
                    S.pct(c - F.col("sma_50"), "sma_50").alias("pct_above_sma_50"),
                    S.pct(c - F.col("sma_200"), "sma_200").alias("pct_above_sma_200"))


def revenue_breakdown(segments: DataFrame, geography: DataFrame) -> DataFrame:
    """G1 + E10: segment and geography rows under one tagged shape."""
    seg = segments.select(F.lit("segment").alias("breakdown_type"), "company", "ticker", "fiscal_year",
                          F.col("segment_name").alias("category"),
                          F.col("segment_revenue_billions").alias("revenue_billions"),
                          F.col("segment_pct_of_total").alias("pct_of_total"),
                          F.col("segment_rank").alias("category_rank"))
    geo = ts.rank_in_key(geography, ["company"], [F.col("region_revenue_billions").desc(),
                                                   F.col("fiscal_year").desc(), F.col("region")],
                         "category_rank")
    geo = geo.select(F.lit("geography").alias("breakdown_type"), "company", "ticker", "fiscal_year",
                     F.col("region").alias("category"), F.col("region_revenue_billions").alias("revenue_billions"),
                     F.col("region_pct_of_total").alias("pct_of_total"), "category_rank")
    return seg.unionByName(geo)


class Marts:
    """The pipeline's tables, each built from the ones before it and
    written to the shared folder the first time it is asked for."""

    TABLES = ["silver_filings", "company_registry", "stock_daily_prices", "company_financials", "stock_summary",
              "revenue_by_segment", "revenue_by_geography"]
    VIEWS = ["company_overview", "peer_comparison", "stock_performance", "revenue_breakdown"]

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = getattr(self, f"_{name}")() if name in self.VIEWS else \
                written(getattr(self, f"_{name}")(), f"mart-{name}")
        return self._made[name]

    def _silver(self) -> DataFrame:
        """The filings for marts without breakdowns: the full table if it is there, else identity and totals alone."""
        return self["silver_filings"] if "silver_filings" in self._made else self["silver_basic"]

    def _silver_filings(self):
        return fx.silver_filings(self.spark, self.sf_dir)

    def _silver_basic(self):
        return fx.silver_filings(self.spark, self.sf_dir, breakdowns=False)

    def _company_registry(self):
        return company_registry(self._silver())

    def _stock_daily_prices(self):
        return daily_prices(fx.raw_prices(self.spark, self.sf_dir))

    def _company_financials(self):
        return company_financials(self._silver(), self["company_registry"])

    def _daily(self) -> DataFrame:
        """The prices for the summary: the written table if it is there, else their plan, whose windows already lie
        by ticker, so the summary adds no shuffle."""
        return self["stock_daily_prices"] if "stock_daily_prices" in self._made else self._stock_daily_prices()

    def _stock_summary(self):
        return stock_summary(self._daily(), self["company_registry"], self.as_of,
                             market=fx.market(self.spark, self.sf_dir))

    def _revenue_by_segment(self):
        return revenue_by_segment(self["silver_filings"], self["company_registry"])

    def _revenue_by_geography(self):
        return revenue_by_geography(self["silver_filings"], self["company_registry"])

    def _company_overview(self):
        return company_overview(self["company_financials"], self["stock_summary"])

    def _peer_comparison(self):
        return peer_comparison(self["company_overview"])

    def _stock_performance(self):
        return stock_performance(self["stock_daily_prices"], self["company_financials"])

    def _revenue_breakdown(self):
        return revenue_breakdown(self["revenue_by_segment"], self["revenue_by_geography"])

    def build_marts(self) -> dict[str, DataFrame]:
        """Every mart, written, in dependency order."""
        return {name: self[name] for name in self.TABLES}

    def build_views(self) -> dict[str, DataFrame]:
        """The four views over the written marts, registered for SQL users."""
        self.build_marts()
        views = {name: self[name] for name in self.VIEWS}
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return views
