"""Parameterised SQL functions of the serving layer.

Two forms per function:

* SQL: ``register_sql_functions(spark, fin, stock)`` creates temporary SQL
  scalar / table functions that filter views of the bulk forms, for users who call ``SELECT * FROM valuation_score('S1')``. Arguments are bound
  with ``spark.sql(query, args=...)``, never interpolated.
* Bulk: a DataFrame function computing the answer for every ticker at once
  (one scan, one join), which is what a batch report or a table should use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import scalars as S
from stratum.operators import aggregate as A
from stratum.operators import timeseries as ts


def _pe_part(pe):
    return F.when(pe < 25, 30).when(pe < 50, 20).otherwise(10)


def _growth_part(g):
    return F.when(g > 50, 40).when(g > 10, 25).otherwise(10)


def _margin_part(m):
    return F.when(m > 60, 30).when(m > 40, 20).otherwise(10)


def valuation_scores(fin: DataFrame, stock: DataFrame) -> DataFrame:
    """H7 bulk: valuation score per filing of every ticker (inner join, C4).

    NULL P/E, growth or margin fall through to the ELSE branch (10 points)."""
    j = fin.select("ticker", "company", "revenue_growth_yoy_pct", "gross_margin_pct", "fiscal_year") \
        .join(stock.select("ticker", "pe_ratio"), "ticker")
    pe, gr, mg = _pe_part(F.col("pe_ratio")), _growth_part(F.col("revenue_growth_yoy_pct")), \
        _margin_part(F.col("gross_margin_pct"))
    return j.select("ticker", "company", "fiscal_year",
                    (pe + gr + mg).cast("int").alias("valuation_score"),
                    pe.cast("int").alias("pe_component"), gr.cast("int").alias("growth_component"),
                    mg.cast("int").alias("margin_component"))


PEER_METRICS = {"Revenue Growth %": "revenue_growth_yoy_pct", "Gross Margin %": "gross_margin_pct",
                "Net Margin %": "net_margin_pct"}


def compare_peers_all(fin: DataFrame, metrics: dict[str, str] = PEER_METRICS) -> DataFrame:
    """H8 bulk: per filing and metric, the company's value and the mean of the
    metric over all other tickers' filings, rounded to 1 (D10 + unpivot)."""
    peer = A.peer_average(fin, "ticker", list(metrics.values()))
    j = fin.select("ticker", "fiscal_year", *metrics.values()).join(peer, "ticker")
    stacked = F.explode(F.array(*[
        F.struct(F.lit(label).alias("metric"), F.col(c).cast("double").alias("company_value"),
                 F.round(F.col(f"peer_avg_{c}"), 1).alias("peer_avg"))
        for label, c in metrics.items()]))
    return j.select("ticker", "fiscal_year", stacked.alias("m")).select("ticker", "fiscal_year", "m.*")


def investment_theses(fin: DataFrame) -> DataFrame:
    """H6 bulk: one summary sentence per ticker from its latest filing; any
    NULL part makes the sentence NULL (B23)."""
    latest = ts.keep_latest(fin, ["ticker"], ["fiscal_year"])
    return latest.select("ticker", S.sentence(
        F.col("company"), F.lit(" ("), F.col("ticker"), F.lit(") Summary: "),
        F.lit("Revenue $"), S.num_text("total_revenue_billions", 1), F.lit("B, "),
        F.lit("Growth "), S.num_text("revenue_growth_yoy_pct", 1), F.lit("%, "),
        F.lit("Margin "), S.num_text("gross_margin_pct", 1), F.lit("%")).alias("thesis"))


# Growth trajectory offsets, revenue multipliers and rates.
GROWTH_STEPS = [(1, 1.15, 15.0), (2, 1.25, 10.0), (3, 1.33, 8.0)]


def growth_trajectories(fin: DataFrame) -> DataFrame:
    """H9 bulk: three projected years per filing (join with a 3-row table)."""
    steps = F.explode(F.array(*[F.struct(F.lit(o).alias("year_offset"), F.lit(m).alias("_m"),
                                         F.lit(r).alias("growth_rate")) for o, m, r in GROWTH_STEPS]))
    s = fin.select("ticker", "fiscal_year", "total_revenue_billions", steps.alias("s"))
    return s.select("ticker", "fiscal_year", F.col("s.year_offset").alias("year_offset"),
                    F.round(F.col("total_revenue_billions") * F.col("s._m"), 1).alias("projected_revenue"),
                    F.col("s.growth_rate").alias("growth_rate"))


def risk_summaries(fin: DataFrame, stock: DataFrame) -> DataFrame:
    """H10 bulk: valuation, growth and debt risk rows per ticker (G1)."""
    pe = F.col("pe_ratio")
    val = stock.select("ticker", F.lit(None).cast("int").alias("fiscal_year"),
                       F.lit("Valuation").alias("risk_type"),
                       F.when(pe > 50, "HIGH").when(pe > 30, "MEDIUM").otherwise("LOW").alias("severity"),
                       S.sentence(F.lit("P/E ratio is "), S.num_text(pe, 1)).alias("description"))
    g = F.col("revenue_growth_yoy_pct")
    gro = fin.select("ticker", "fiscal_year", F.lit("Growth Sustainability").alias("risk_type"),
                     F.when(g > 80, "HIGH").when(g > 30, "MEDIUM").otherwise("LOW").alias("severity"),
                     S.sentence(F.lit("Growth rate of "), S.num_text(g, 1), F.lit("% may not sustain"))
                     .alias("description"))
    liab, cash = F.col("total_liabilities_billions"), F.col("cash_and_equivalents_billions")
    debt = fin.select("ticker", "fiscal_year", F.lit("Debt").alias("risk_type"),
                      F.when(liab > cash, "MEDIUM").otherwise("LOW").alias("severity"),
                      S.sentence(F.lit("Liabilities: $"), S.num_text(liab, 1), F.lit("B vs Cash: $"),
                                 S.num_text(cash, 1), F.lit("B")).alias("description"))
    return val.unionByName(gro).unionByName(debt)


# --- SQL forms ---------------------------------------------------------------------------------

# name -> (bulk form, view it is registered as, result columns of the SQL function)
_TABLE_FUNCTIONS = {
    "valuation_score": (valuation_scores, "valuation_scores",
                        "ticker STRING, company STRING, valuation_score INT, pe_component INT, growth_component INT, "
                        "margin_component INT"),
    "compare_peers": (lambda fin, stock: compare_peers_all(fin), "peer_comparisons",
                      "metric STRING, company_value DOUBLE, peer_avg DOUBLE"),
    "growth_trajectory": (lambda fin, stock: growth_trajectories(fin), "growth_trajectories",
                          "year_offset INT, projected_revenue DOUBLE, growth_rate DOUBLE"),
    "risk_summary": (risk_summaries, "risk_summaries", "risk_type STRING, severity STRING, description STRING"),
}


def register_sql_functions(spark: SparkSession, fin: DataFrame, stock: DataFrame) -> list[str]:
    """Create the five SQL functions as filters over views of the bulk forms,
    so every rule is stated once; Catalyst pushes the ticker into the view."""
    fin.createOrReplaceTempView("company_financials")
    stock.createOrReplaceTempView("stock_summary")
    for name, (bulk, view, columns) in _TABLE_FUNCTIONS.items():
        bulk(fin, stock).createOrReplaceTempView(view)
        picked = ", ".join(c.split()[0] for c in columns.split(", "))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(ticker_param STRING) RETURNS TABLE ({columns}) "
                  f"RETURN SELECT {picked} FROM {view} v WHERE v.ticker = ticker_param")
    investment_theses(fin).createOrReplaceTempView("investment_theses")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION investment_thesis(ticker_param STRING) RETURNS STRING "
              "RETURN (SELECT FIRST(thesis) FROM investment_theses v WHERE v.ticker = ticker_param)")
    return [*_TABLE_FUNCTIONS, "investment_thesis"]


def call_table_function(spark: SparkSession, name: str, ticker: str) -> DataFrame:
    """Invoke a registered table function with a bound parameter."""
    if name not in _TABLE_FUNCTIONS:
        raise KeyError(name)
    return spark.sql(f"SELECT * FROM {name}(:ticker)", args={"ticker": ticker})
