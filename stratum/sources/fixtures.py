"""Shapes of the reference's inputs, derived by Spark from the driver tables.

Every derivation is a lazy DataFrame over the parquet tables, so its work grows
with the data. Money is summed as DECIMAL (exact, engine independent) and only
converted to DOUBLE at the edge, as the reference's schemas declare DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratum.sources.tables import Tables

PRICE_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("trade_date", T.DateType()),
    T.StructField("open_price", T.DoubleType()),
    T.StructField("high_price", T.DoubleType()),
    T.StructField("low_price", T.DoubleType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("dividends", T.DoubleType()),
    T.StructField("stock_splits", T.DoubleType()),
    T.StructField("ingestion_timestamp", T.TimestampNTZType()),
])

# Columns that, after ingestion_timestamp, give raw price rows a total order.
INGEST_ORDER = ["ingestion_timestamp", "src_linenumber", "close_price", "src_partkey",
                "volume", "open_price", "high_price"]


def ticker_of(suppkey: Column) -> Column:
    return F.concat(F.lit("S"), suppkey.cast("string"))


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices with duplicates (bronze): one row per lineitem.

    ticker = 'S' || supplier key, trade_date = ship date, close = extended
    price, volume = quantity. ingestion_timestamp = ship date + order key
    seconds, so later orders of the same day are the later ingestions.
    """
    li = Tables(spark, sf_dir).lineitem
    price = F.col("l_extendedprice")
    return li.select(
        ticker_of(F.col("l_suppkey")).alias("ticker"),
        F.to_date("l_shipdate").alias("trade_date"),
        (price * (1 - F.col("l_discount"))).alias("open_price"),
        (price * (1 + F.col("l_tax"))).alias("high_price"),
        (price * (1 - F.col("l_discount")) * (1 - F.col("l_tax"))).alias("low_price"),
        price.alias("close_price"),
        F.floor("l_quantity").cast("bigint").alias("volume"),
        F.lit(0.0).alias("dividends"),
        F.lit(0.0).alias("stock_splits"),
        (F.to_date("l_shipdate").cast("timestamp_ntz")
         + F.make_dt_interval(secs=F.col("l_orderkey").cast("decimal(18,6)"))).alias("ingestion_timestamp"),
        F.col("l_linenumber").alias("src_linenumber"),
        F.col("l_partkey").alias("src_partkey"),
    )


def _hundredths(c: str, p: int) -> Column:
    """A DOUBLE as DECIMAL(p, 2) in whole hundredths; only what is not exactly that many needs the decimal."""
    x, n = F.col(c), F.rint(F.col(c) * 100)
    exact = (F.abs(x) < float(10 ** (p - 2))) & (n / 100 == x)
    return F.when(exact, n.cast("bigint")).otherwise((x.cast(T.DecimalType(p, 2)) * 100).cast("bigint"))


def _total(units: Column, s: int) -> Column:
    """Sum of whole units as DECIMAL with ``s`` places. Both halves of the bits are summed apart: no sum leaves a BIGINT."""
    high, low = F.sum(F.shiftright(units, 32)), F.sum(units.bitwiseAND(F.lit(0xFFFFFFFF)))
    whole = high.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    return (whole.cast(T.DecimalType(32, 0)) * F.lit(10 ** -s).cast(T.DecimalType(s, s))).cast(T.DecimalType(28 + s, s))


def filing_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact per (supplier, fiscal year) sums the filings are written from."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select(
        "l_suppkey", F.year("l_shipdate").alias("fiscal_year"),
        _hundredths("l_extendedprice", 12).alias("p"),
        _hundredths("l_discount", 4).alias("d"), _hundredths("l_tax", 4).alias("x"))
    return (li.groupBy("l_suppkey", "fiscal_year").agg(
        _total(F.col("p"), 2).cast("decimal(22,2)").alias("rev"),
        _total(F.col("p") * (F.col("d") * 5 + 50), 4).cast("decimal(30,4)").alias("cost"),
        _total(F.col("p") * F.col("x"), 4).cast("decimal(27,4)").alias("opex")))


def _bn(c: Column) -> Column:
    """DECIMAL amount -> DOUBLE billions (1e6 units in the fixture)."""
    return c.cast("double") / 1e6


def silver_filings(spark: SparkSession, sf_dir: str, breakdowns: bool = True) -> DataFrame:
    """Silver extracted metrics: one filing per (supplier, fiscal year).

    Shape of the reference's silver table: file_name, company_key,
    document_type, industry_sector, extracted_metrics VARIANT ``{response:{..}}``.
    """
    t = Tables(spark, sf_dir)
    facts = filing_facts(spark, sf_dir)
    sup = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    w = Window.partitionBy("l_suppkey").orderBy("fiscal_year")
    prev = F.lag(F.col("rev").cast("double")).over(w)
    rev = F.col("rev").cast("double")
    base = facts.join(sup, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "l_suppkey", "fiscal_year", "s_name", "s_acctbal", "n_name",
        _bn(F.col("rev")).alias("total_revenue_billions"),
        _bn(F.col("cost")).alias("cost_of_revenue_billions"),
        _bn(F.col("rev") - F.col("cost")).alias("gross_profit_billions"),
        _bn(F.col("rev") - F.col("cost") - F.col("opex")).alias("operating_income_billions"),
        _bn((F.col("rev") - F.col("cost") - F.col("opex")) * F.lit(0.79).cast("decimal(3,2)"))
        .alias("net_income_billions"),
        _bn(F.col("rev") * F.lit(1.5).cast("decimal(2,1)")).alias("total_assets_billions"),
        _bn(F.col("rev") * F.lit(0.6).cast("decimal(2,1)")).alias("total_liabilities_billions"),
        _bn(F.col("rev") * F.lit(0.9).cast("decimal(2,1)")).alias("total_equity_billions"),
        (F.abs(F.col("s_acctbal").cast("decimal(12,2)")) / 1000).cast("double")
        .alias("cash_and_equivalents_billions"),
        F.round((rev - prev) / F.nullif(prev, F.lit(0.0)) * 100, 2).alias("revenue_growth_yoy_pct"),
    )
    if breakdowns:
        filings = (base.join(_segments(t), ["l_suppkey", "fiscal_year"], "left")
                   .join(_geography(t), ["l_suppkey", "fiscal_year"], "left"))
    else:  # identity and totals only: no segment / region joins
        filings = base.withColumn("business_segments", F.lit(None)).withColumn("geographic_revenue", F.lit(None))
    key = ticker_of(F.col("l_suppkey"))
    response = F.struct(
        F.col("s_name").alias("company_name"),
        key.alias("ticker_symbol"),
        F.when(F.col("s_acctbal") >= 0, "NYSE").otherwise("NASDAQ").alias("exchange"),
        F.col("fiscal_year").cast("int").alias("fiscal_year"),
        F.concat(F.col("fiscal_year").cast("string"), F.lit("-12-31")).alias("fiscal_year_end_date"),
        "total_revenue_billions", "cost_of_revenue_billions", "gross_profit_billions",
        "operating_income_billions", "net_income_billions", "total_assets_billions",
        "total_liabilities_billions", "total_equity_billions",
        "cash_and_equivalents_billions",
        (F.col("net_income_billions") * 1000 / 250).alias("eps_diluted"),
        "revenue_growth_yoy_pct", "business_segments", "geographic_revenue")
    file_name = F.concat(key, F.lit("_"), F.col("fiscal_year").cast("string"), F.lit("_10k.pdf"))
    return filings.select(
        file_name.alias("file_name"),
        F.regexp_extract(file_name, r"^([^_\.]+)", 1).alias("company_key"),
        F.lit("10-K Annual Report").alias("document_type"),
        F.col("n_name").alias("industry_sector"),
        F.parse_json(F.to_json(F.struct(response.alias("response")))).alias("extracted_metrics"),
    )


def filing_texts(silver: DataFrame) -> DataFrame:
    """Filings as markup: the scalars as list items "label: value", each breakdown as a table. What is NULL is not written."""
    def value(name: str, kind: str) -> Column:
        v = F.variant_get("extracted_metrics", f"$.response.{name}", kind).cast("string")
        return F.replace(F.replace(v, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    def item(name: str, kind: str, label: str | None = None) -> Column:
        label = label or name.replace("_", " ").capitalize()
        return F.coalesce(F.concat(F.lit(f"<li><b>{label}</b>: "), value(name, kind), F.lit("</li>\n")), F.lit(""))

    def table(name: str, first: str, second: str) -> Column:
        rows = F.variant_get("extracted_metrics", f"$.response.{name}", f"array<struct<{first}: string, {second}: double>>")
        lines = F.transform(rows, lambda r: F.concat(F.lit("<tr><td>"), r[first], F.lit("<td>"), r[second].cast("string"), F.lit("</td></tr>")))
        head = f"<table><tr><th>{first.replace('_', ' ').capitalize()}</th><th>{second.replace('_', ' ').capitalize()}</th></tr>"
        return F.coalesce(F.concat(F.lit(head), F.array_join(lines, "\n"), F.lit("</table>")), F.lit(""))

    amounts = ["total_revenue", "cost_of_revenue", "gross_profit", "operating_income", "net_income", "total_assets",
               "total_liabilities", "total_equity", "cash_and_equivalents"]
    markup = F.concat(
        F.lit("<html><head><title>"), F.col("file_name"), F.lit("</title><style>p: 1</style></head><body><h1>"), F.col("document_type"),
        F.lit("</h1><!-- Exchange: none --><section><p>Filed under the rules of the exchange.<ul>\n"),
        *[item(n, "string") for n in ("company_name", "ticker_symbol", "exchange")], item("fiscal_year", "int"),
        item("fiscal_year_end_date", "string"), *[item(f"{n}_billions", "double") for n in amounts], item("eps_diluted", "double"),
        item("revenue_growth_yoy_pct", "double", "Revenue growth YoY (pct)"), F.lit("</ul></section><div><p>Revenue by segment</p>"),
        table("business_segments", "segment_name", "segment_revenue_billions"), F.lit("</div><div><p>Revenue by region</p>"),
        table("geographic_revenue", "region", "region_revenue_billions"), F.lit("</div></body></html>"))
    return silver.select("file_name", "company_key", "document_type", "industry_sector", markup.alias("html"))


def _segments(t: Tables) -> DataFrame:
    """Business segments per filing: revenue by part type (bounded: #types)."""
    li = t.lineitem.select("l_suppkey", "l_partkey", F.year("l_shipdate").alias("fiscal_year"),
                           _hundredths("l_extendedprice", 12).alias("p"))
    by_type = (li.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
               .groupBy("l_suppkey", "fiscal_year", "p_type").agg(_total(F.col("p"), 2).alias("r")))
    return by_type.groupBy("l_suppkey", "fiscal_year").agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("p_type").alias("segment_name"),
            _bn(F.col("r")).alias("segment_revenue_billions")))).alias("business_segments"))


def _geography(t: Tables) -> DataFrame:
    """Geographic revenue per filing: revenue by the buying customer's region."""
    li = t.lineitem.select("l_suppkey", "l_orderkey", F.year("l_shipdate").alias("fiscal_year"),
                           _hundredths("l_extendedprice", 12).alias("p"))
    cust_region = (t.customer.select("c_custkey", "c_nationkey")
                   .join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
                   .join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
                   .select("c_custkey", "r_name"))
    by_region = (li.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
                 .join(cust_region, F.col("o_custkey") == F.col("c_custkey"))
                 .groupBy("l_suppkey", "fiscal_year", "r_name").agg(_total(F.col("p"), 2).alias("r")))
    return by_region.groupBy("l_suppkey", "fiscal_year").agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("r_name").alias("region"),
            _bn(F.col("r")).alias("region_revenue_billions")))).alias("geographic_revenue"))


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market data per ticker, one row per supplier: P/E from 5 up, by supplier
    key (every 11th has none), capitalisation from the account balance."""
    s = Tables(spark, sf_dir).supplier
    k = F.col("s_suppkey")
    return s.select(ticker_of(k).alias("ticker"),
                    F.when(k % 11 != 0, (5 + (k * 7) % 70).cast("double")).alias("pe_ratio"),
                    (F.abs(F.col("s_acctbal").cast("decimal(12,2)")) / 100).cast("double").alias("market_cap_billions"),
                    ((k % 20).cast("double") / 4).alias("price_to_sales"),
                    ((k % 30).cast("double") / 8).alias("ev_to_revenue"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxi trips from events (one trip per event).

    distance = value, passengers = 1 + user_id % 6, hour / weekday (0 =
    Monday) of ts; fare = 2.5 + 3.5 * distance + 2 * rush + noise, clipped to
    [2.5, 200], where noise = ((event_id * 7) % 11 - 5) * 0.25; tip =
    fare * (event_id % 30) / 100.
    """
    ev = Tables(spark, sf_dir).events
    hour = F.hour("ts")
    rush = (hour.between(7, 9) | hour.between(17, 19)).cast("int")
    noise = ((F.col("event_id") * 7) % 11 - 5) * 0.25
    fare = F.greatest(F.lit(2.5), F.least(F.lit(200.0), 2.5 + 3.5 * F.col("value") + 2 * rush + noise))
    return ev.select(
        F.col("event_id").alias("trip_id"), F.col("ts").alias("pickup_ts"),
        F.col("value").alias("trip_distance"),
        (1 + F.col("user_id") % 6).cast("int").alias("passenger_count"),
        hour.alias("hour_of_day"), F.weekday("ts").alias("day_of_week"),
        rush.alias("is_rush_hour"), F.weekday("ts").isin(5, 6).cast("int").alias("is_weekend"),
        fare.alias("fare_amount"), fare.alias("actual_fare"),
        (fare * (F.col("event_id") % 30) / 100).alias("tip_amount"))


# --- endpoints, tiles, assistants (inventory) -----------------------------------------------------

# Fixed values for the derived inventory: entity types by custkey % 8.
ENTITY_TYPES = ["FOUNDATION_MODEL", "PT_FOUNDATION_MODEL", "UC_MODEL", "UC_MODEL", "UC_MODEL",
                "EXTERNAL_MODEL", "FEATURE_SPEC", "UC_MODEL"]
PROVIDERS = {"AUTOMOBILE": "openai", "BUILDING": "anthropic", "FURNITURE": "custom",
             "HOUSEHOLD": "google", "MACHINERY": "cohere"}
PROBLEM_TYPES = ["KNOWLEDGE_ASSISTANT", "MULTI_AGENT_SUPERVISOR", "INFORMATION_EXTRACTION", "MODEL_SPECIALIZATION"]


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested endpoint records, one per customer (shape of the serving list API)."""
    c = Tables(spark, sf_dir).customer
    k = F.col("c_custkey") % 8
    seg = F.lower("c_mktsegment")
    et = _pick(ENTITY_TYPES, k)
    name = (F.when(k == 0, F.concat(F.lit("databricks-"), seg, F.lit("-"), (F.col("c_custkey") % 3 + 1).cast("string")))
            .otherwise(F.concat(F.lit("ep-"), seg, F.lit("-"), F.col("c_custkey").cast("string"))))
    provider = F.coalesce(*[F.when(F.col("c_mktsegment") == s, F.lit(p)) for s, p in PROVIDERS.items()])
    system_fm = (k == 3) & (F.col("c_custkey") % 3 == 0)  # a UC model that wraps a system foundation model
    entity = F.struct(
        et.alias("type"), F.concat(F.lit("served-"), seg).alias("name"),
        F.when(k == 2, F.concat(F.lit("system.ai."), seg)).when(k.isin(3, 4, 7), F.concat(F.lit("main.models."), seg))
        .alias("entity_name"),
        F.when(k.isin(2, 3, 4, 7), (F.col("c_custkey") % 5 + 1).cast("string")).alias("entity_version"),
        (F.col("c_custkey") % 2 == 0).alias("scale_to_zero_enabled"),
        _pick(["Small", "Medium", "Large"], F.col("c_custkey") % 3).alias("workload_size"),
        F.when(k.isin(0, 1), F.struct(F.concat(F.lit("fm-"), seg).alias("name"), F.lit("1").alias("version")))
        .when(system_fm, F.struct(F.concat(F.lit("system.ai."), seg).alias("name"), F.lit("1").alias("version")))
        .alias("foundation_model"),
        F.when(k == 5, F.struct(F.concat(F.lit("ext-"), seg, F.lit("-"), (F.col("c_custkey") % 4).cast("string")).alias("name"),
                                provider.alias("provider"))).alias("external_model"))
    legacy = F.struct(F.concat(F.lit("served-"), seg).alias("name"), F.concat(F.lit("legacy-"), seg).alias("model_name"), F.lit("2").alias("model_version"),
                      F.lit(True).alias("scale_to_zero_enabled"), F.lit("Small").alias("workload_size"))
    use_legacy = F.col("c_custkey") % 16 == 9
    no_config = F.col("c_custkey") % 25 == 0
    gw = F.struct(
        F.when(F.col("c_custkey") % 3 != 1, F.struct((F.col("c_custkey") % 3 == 0).alias("enabled"),
                                                     F.lit("main").alias("catalog_name"),
                                                     seg.alias("schema_name"))).alias("inference_table_config"),
        F.array_repeat(F.struct(F.lit(100).alias("calls"), F.lit("minute").alias("renewal_period")),
                       (F.col("c_custkey") % 3).cast("int")).alias("rate_limits"),
        F.when(F.col("c_custkey") % 4 == 0, F.struct(F.lit(True).alias("pii")))
        .when(F.col("c_custkey") % 4 == 2, F.struct(F.lit(None).cast("boolean").alias("pii"))).alias("guardrails"))
    config = F.when(~no_config, F.struct(
        F.when(~use_legacy, F.array(entity)).alias("served_entities"),
        F.when(use_legacy, F.array(legacy)).alias("served_models"),
        gw.alias("ai_gateway")))
    tags = F.array(F.struct(F.lit("segment").alias("key"), F.col("c_mktsegment").alias("value")),
                   F.struct(F.when(F.col("c_custkey") % 2 == 0, F.lit("")).otherwise(F.lit("nation")).alias("key"),
                            F.col("c_nationkey").cast("string").alias("value")),
                   F.struct(F.when(F.col("c_custkey") % 7 == 0, F.lit("segment")).alias("key"),
                            F.lit("again").alias("value")))
    return c.select(
        name.alias("name"), F.concat(F.lit("id-"), F.col("c_custkey").cast("string")).alias("id"),
        F.when(k == 0, F.lit("FOUNDATION_MODEL_API")).alias("endpoint_type"),
        F.when(k.isin(4, 7), F.lit("agent/v1/responses")).when(k == 2, F.lit("llm/v1/chat")).alias("task"),
        F.concat(F.lit("user"), F.col("c_nationkey").cast("string"), F.lit("@example.com")).alias("creator"),
        (F.lit(1704067200000) + F.col("c_custkey") * 60000).alias("creation_timestamp"),
        (F.lit(1704067200000) + F.col("c_custkey") * 120000).alias("last_updated_timestamp"),
        F.struct(F.when(F.col("c_acctbal") >= 0, "READY").otherwise("NOT_READY").alias("ready"),
                 F.lit("NOT_UPDATING").alias("config_update")).alias("state"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(tags).alias("tags"),
        F.when(k == 7, F.struct(F.concat(F.lit("tile-"), F.col("c_custkey").cast("string")).alias("tile_id"),
                                F.concat(F.lit("tile model "), seg).alias("tile_model_name"),
                                _pick(PROBLEM_TYPES, F.col("c_nationkey") % 4).alias("problem_type")))
        .alias("tile_endpoint_metadata"),
        config.alias("config"))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile records: two versions per tile endpoint (the later fetch wins),
    plus tiles whose endpoint does not exist."""
    c = Tables(spark, sf_dir).customer.filter(F.col("c_custkey") % 8 == 7)
    seg = F.lower("c_mktsegment")
    ep = F.concat(F.lit("ep-"), seg, F.lit("-"), F.col("c_custkey").cast("string"))
    base = [F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("tile_id"),
            _pick(["KA", "MAS", "KIE", "MS"], F.col("c_nationkey") % 4).alias("tile_type")]
    v1 = c.select(*base, F.concat(F.lit("old "), seg).alias("name"), ep.alias("serving_endpoint_name"),
                  F.lit(1).alias("fetch_order"))
    v2 = c.select(*base, F.concat(F.lit("tile "), seg, F.lit(" "), F.col("c_custkey").cast("string")).alias("name"),
                  ep.alias("serving_endpoint_name"), F.lit(2).alias("fetch_order"))
    orphan = c.select(*base, F.lit("orphan").alias("name"),
                      F.concat(F.lit("gone-"), F.col("c_custkey").cast("string")).alias("serving_endpoint_name"),
                      F.lit(3).alias("fetch_order"))
    return v1.unionByName(v2).unionByName(orphan)


def assistants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant records, one per supplier (list-API shape)."""
    s = Tables(spark, sf_dir).supplier
    kb = F.array_repeat(F.struct(F.lit("volume").alias("type"), F.col("s_name").alias("source")),
                        (F.col("s_suppkey") % 3).cast("int"))
    return s.select(
        F.concat(F.lit("ka-"), F.col("s_suppkey").cast("string")).alias("id"),
        F.when(F.col("s_suppkey") % 5 != 0, F.col("s_name")).alias("display_name"),
        F.concat(F.lit("assistant_"), F.col("s_suppkey").cast("string")).alias("name"),
        F.when(F.col("s_suppkey") % 4 != 0, F.concat(F.lit("Answers questions for "), F.col("s_name")))
        .alias("description"),
        F.concat(F.lit("Use the filings of "), F.col("s_name"), F.lit(" to answer. "),
                 F.repeat(F.lit("Cite sources. "), (F.col("s_suppkey") % 12).cast("int"))).alias("instructions"),
        F.concat(F.lit("ka-ep-"), F.col("s_suppkey").cast("string")).alias("endpoint_name"),
        F.concat(F.lit("user"), F.col("s_nationkey").cast("string"), F.lit("@example.com")).alias("creator"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("s_suppkey") % 28 + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z")).alias("create_time"),
        F.when(F.col("s_suppkey") % 6 != 0, F.concat(F.lit("exp-"), F.col("s_suppkey").cast("string"))).alias("experiment_id"),
        kb.alias("knowledge_bases"))


# --- spans, expected tools, responses (traces and tests) ----------------------------------------

# Fixed values for the derived spans: tool and agent span names.
TOOL_NAMES = ["get_valuation_score", "compare_peers_tool", "get_growth_trajectory", "get_risk_summary",
              "query_knowledge_assistant", "execute_genie_space"]
AGENT_NAMES = ["mcp_genie_call", "supervisor", "planner", "tool_router"]


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace spans from events: trace = user, type and name by event type."""
    e = Tables(spark, sf_dir).events
    t = F.col("event_type")
    span_type = (F.when(t == "view", "LLM").when(t.isin("click", "purchase"), "TOOL").when(t == "error", "AGENT")
                 .otherwise("CHAT_MODEL"))
    name = (F.when(t.isin("click", "purchase"), _pick(TOOL_NAMES, F.col("event_id") % 6))
            .when(t == "error", _pick(AGENT_NAMES, F.col("event_id") % 4))
            .otherwise(F.lit("chat_completion")))
    start = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return e.select(
        F.col("user_id").alias("trace_id"), F.col("event_id").alias("span_id"), name.alias("name"),
        span_type.alias("span_type"), F.col("props").alias("inputs"),
        F.concat(F.col("props"), F.repeat(F.lit("."), (F.col("event_id") % 700).cast("int"))).alias("outputs"),
        start.alias("start_time_ns"), (start + F.round(F.col("value") * 1e6).cast("bigint")).alias("end_time_ns"),
        F.when(t == "error", "ERROR").otherwise("OK").alias("status"), F.col("ts"))


# Expected tool sets of the agent test cases.
EXPECTED_SETS = [["genie"], ["valuation_score", "compare_peers"], ["knowledge_assistant", "risk_summary"]]


def expected_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One test case per trace (+ one unknown trace per ten users)."""
    u = Tables(spark, sf_dir).events.select("user_id").distinct()
    sets = F.array(*[F.array(*[F.lit(x) for x in s]) for s in EXPECTED_SETS])
    known = u.select(F.col("user_id").alias("trace_id"), F.element_at(sets, (F.col("user_id") % 3 + 1).cast("int"))
                     .alias("expected_tools"))
    unknown = u.filter(F.col("user_id") % 10 == 0).select((F.col("user_id") + 100000).alias("trace_id"),
                                                         F.array(F.lit("genie")).alias("expected_tools"))
    return known.unionByName(unknown)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent responses (JSON) for assistant turns, each paired with the phrases
    its case expects: every two neighbouring words of the previous user turn.
    Some answers are no JSON, some are missing."""
    c = Tables(spark, sf_dir).conversations
    w = Window.partitionBy("conv_id").orderBy("turn")
    prev_user = F.lag("text").over(w)
    txt = F.when(F.col("conv_id") % 7 == 3, F.concat(F.lit("Error: "), F.col("text"))).otherwise(F.col("text"))
    msg = F.struct(F.lit("message").alias("type"),
                   F.array(F.struct(F.lit("output_text").alias("type"), txt.alias("text")),
                           F.struct(F.lit("refusal").alias("type"), F.lit("n/a").alias("text"))).alias("content"))
    extra = F.struct(F.lit("reasoning").alias("type"),
                     F.array(F.struct(F.lit("output_text").alias("type"), F.lit("hidden").alias("text"))).alias("content"))
    out = c.withColumn("prev_user", prev_user).filter(F.col("role") == "assistant")
    words = F.split(F.regexp_replace(F.coalesce("prev_user", F.lit("")), r"[^\p{L}\s]", ""), r"\s+")
    js = F.to_json(F.struct(F.array(extra, msg).alias("output")))
    kept = F.filter(words, lambda x: x != "")
    pairs = F.transform(F.slice(kept, 2, F.greatest(F.size(kept), F.lit(1))), lambda w, i: F.concat(F.get(kept, i), F.lit(" "), w))
    return out.select("conv_id", "turn",
                      F.when(F.col("conv_id") % 23 == 5, F.lit(None)).when(F.col("conv_id") % 29 == 5, F.lit("no json: timeout"))
                      .otherwise(js).alias("response_json"),
                      F.array_distinct(pairs).alias("expected_phrases"))
