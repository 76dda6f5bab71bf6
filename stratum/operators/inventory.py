"""Service inventory and trace analytics.

Inventory records arrive as nested rows (one per endpoint, optional keys as
NULL); every step is a projection or grouped aggregate over them, so the work
is spread over partitions however many records there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions import scalars as S
from stratum.operators import aggregate as A
from stratum.operators import timeseries as ts

# Tile problem types and the model_type each maps to.
TILE_MODEL_TYPES = {
    "KNOWLEDGE_ASSISTANT": "AGENT_BRICKS_KA",
    "MULTI_AGENT_SUPERVISOR": "AGENT_BRICKS_MAS",
    "INFORMATION_EXTRACTION": "AGENT_BRICKS_KIE",
    "MODEL_SPECIALIZATION": "AGENT_BRICKS_MS",
}
# model_type labels of the entity-type ladder.
FM_PPT, FM_PT = "DATABRICKS_FM_PPT", "DATABRICKS_FM_PT"
UC_SYSTEM_AI, CLASSIC_ML, UC_AGENTS = "DATABRICKS_FM_UC_SYSTEM_AI", "DATABRICKS_CLASSIC_ML", "DATABRICKS_FM_UC_AGENTS"
EXT_CUSTOM, EXT = "FM_EXTERNAL_MODEL_CUSTOM", "FM_EXTERNAL_MODEL"
FEATURE_SPEC, UNCLASSIFIED = "FEATURE_SPEC", "UNCLASSIFIED"
PAY_PER_TOKEN_PREFIX = "databricks-"
SYSTEM_AI_PREFIX = "system.ai."
# Family of each model_type for the family slices.
FAMILIES = {
    "foundation": [FM_PPT, FM_PT, UC_SYSTEM_AI], "external": [EXT, EXT_CUSTOM],
    "agent": [*TILE_MODEL_TYPES.values(), UC_AGENTS], "classic": [CLASSIC_ML],
    "feature": [FEATURE_SPEC], "unclassified": [UNCLASSIFIED],
}


def endpoint_category(entity_type: Column, ent: Column, has_legacy: Column, endpoint_type: Column,
                      task: Column) -> Column:
    """K3: category from the first served entity's type, else from the sub-objects
    present, else legacy served models, else the endpoint type; a task
    mentioning 'agent' overrides everything."""
    by_type = (F.when(entity_type == "EXTERNAL_MODEL", "external_model")
               .when(entity_type.isin("FOUNDATION_MODEL", "PT_FOUNDATION_MODEL"), "foundation_model")
               .when(entity_type == "CUSTOM_MODEL", "custom_model")
               .when(entity_type == "FEATURE_SPEC", "feature_serving")
               .when(ent["external_model"].isNotNull(), "external_model")
               .when(ent["foundation_model"].isNotNull(), "foundation_model")
               .when(S.present(ent["entity_name"]), "custom_model"))
    base = F.when(ent.isNotNull(), F.coalesce(by_type, F.lit("unknown"))) \
        .when(has_legacy, "custom_model").otherwise("unknown")
    base = F.when((endpoint_type == "FOUNDATION_MODEL_API") & (base == "unknown"), "foundation_model").otherwise(base)
    return F.when(F.lower(F.coalesce(task, F.lit(""))).contains("agent"), "agent").otherwise(base)


def model_type(problem_type: Column, entity_type: Column, name: Column, entity_name: Column,
               model_name: Column, task: Column, provider: Column) -> Column:
    """K2: the model_type ladder (tile problem type first, then entity type)."""
    out = None
    for pt, label in TILE_MODEL_TYPES.items():
        out = F.when(problem_type == pt, label) if out is None else out.when(problem_type == pt, label)
    has_task = F.coalesce(task, F.lit("")) != ""
    system_ai = S.has_prefix(F.coalesce(entity_name, F.lit("")), SYSTEM_AI_PREFIX) | \
        S.has_prefix(F.coalesce(model_name, F.lit("")), SYSTEM_AI_PREFIX)
    return (out.when((entity_type == "FOUNDATION_MODEL") & name.startswith(PAY_PER_TOKEN_PREFIX), FM_PPT)
            .when(entity_type == "PT_FOUNDATION_MODEL", FM_PT)
            .when((entity_type == "UC_MODEL") & system_ai, UC_SYSTEM_AI)
            .when((entity_type == "UC_MODEL") & ~has_task, CLASSIC_ML)
            .when(entity_type == "UC_MODEL", UC_AGENTS)
            .when((entity_type == "EXTERNAL_MODEL") & (F.coalesce(provider, F.lit("")) == "custom"), EXT_CUSTOM)
            .when(entity_type == "EXTERNAL_MODEL", EXT)
            .when(entity_type == "FEATURE_SPEC", FEATURE_SPEC)
            .otherwise(UNCLASSIFIED))


def gateway_settings(gw: Column) -> Column:
    """K4: tracking flag, inference table catalog / schema, rate limits and
    their count, guardrails flag, from the gateway sub-object (absent ->
    defaults; guardrails without any setting are off)."""
    return F.struct(
        F.coalesce(gw["inference_table_config"]["enabled"], F.lit(False)).alias("usage_tracking_enabled"),
        gw["inference_table_config"]["catalog_name"].alias("inference_table_catalog"),
        gw["inference_table_config"]["schema_name"].alias("inference_table_schema"),
        S.list_size(gw["rate_limits"]).alias("rate_limits_count"),
        F.coalesce(gw["rate_limits"], F.array()).alias("rate_limits"),
        (F.coalesce(F.to_json(gw["guardrails"]), F.lit("{}")) != "{}").alias("guardrails_enabled"))


def flatten_endpoints(raw: DataFrame, fast: bool = False) -> DataFrame:
    """K1: one flat row per endpoint.

    ``fast=True`` mirrors the list-only extractor: no model_type for
    endpoints the ladder cannot place, and those rows are dropped."""
    ent = S.first_of("config.served_entities")
    legacy = S.first_of("config.served_models")
    et = F.when(ent.isNotNull(), F.coalesce(ent["type"], F.lit(""))) \
        .when(legacy.isNotNull(), F.lit("SERVED_MODEL")).otherwise(F.lit("unknown"))
    provider = F.when(ent["external_model"].isNotNull(), ent["external_model"]["provider"]) \
        .when(ent["foundation_model"].isNotNull() | (et == "PT_FOUNDATION_MODEL"), F.lit("databricks"))
    # a type that names its kind of model decides where the name stands; other types are told by what is there
    named = (F.when(et == "EXTERNAL_MODEL", ent["external_model"]["name"])
             .when(et.isin("FOUNDATION_MODEL", "PT_FOUNDATION_MODEL"), ent["foundation_model"]["name"])
             .when(et.isin("CUSTOM_MODEL", "FEATURE_SPEC"), ent["name"])
             .when(ent["external_model"].isNotNull(), ent["external_model"]["name"])
             .when(ent["foundation_model"].isNotNull(), ent["foundation_model"]["name"])
             .when(legacy.isNotNull(), legacy["name"]))
    model_name = F.coalesce(named, F.lit(""))
    has_own = et.isin("CUSTOM_MODEL", "FEATURE_SPEC") | (~et.isin("EXTERNAL_MODEL", "FOUNDATION_MODEL", "PT_FOUNDATION_MODEL")
                                                         & ent["external_model"].isNull() & ent["foundation_model"].isNull())
    registered = F.when(ent.isNotNull() & has_own, ent["entity_name"]).when(ent.isNull(), legacy["model_name"])
    gw = gateway_settings(F.col("config.ai_gateway"))
    flat = raw.select(
        "name", "id", "endpoint_type", "task", "creator",
        S.ms_to_timestamp("creation_timestamp").cast("timestamp_ntz").alias("created_at"),
        S.ms_to_timestamp("last_updated_timestamp").cast("timestamp_ntz").alias("updated_at"),
        F.col("state.ready").alias("state_ready"), F.col("state.config_update").alias("config_update"),
        et.alias("entity_type"), F.coalesce(ent["entity_name"], legacy["model_name"]).alias("entity_name"),
        F.coalesce(ent["entity_version"], legacy["model_version"]).alias("entity_version"),
        model_name.alias("model_name"), F.coalesce(registered, F.lit("")).alias("registered_model_name"),
        provider.alias("model_provider"),
        F.coalesce(ent["scale_to_zero_enabled"], legacy["scale_to_zero_enabled"]).alias("scale_to_zero"),
        F.coalesce(ent["workload_size"], legacy["workload_size"]).alias("workload_size"),
        S.tags_map("tags").alias("tags"), S.list_size("tags").alias("tag_count"),
        F.col("tile_endpoint_metadata.tile_id").alias("tile_id"),
        F.col("tile_endpoint_metadata.problem_type").alias("problem_type"),
        endpoint_category(et, ent, legacy.isNotNull(), F.col("endpoint_type"), F.col("task")).alias("endpoint_category"),
        model_type(F.col("tile_endpoint_metadata.problem_type"), et, F.col("name"),
                   ent["entity_name"], model_name, F.col("task"), provider).alias("model_type"),
        gw.alias("gateway"))
    if fast:
        flat = flat.withColumn("model_type", F.when(F.col("model_type") != UNCLASSIFIED, F.col("model_type"))) \
            .filter(F.col("model_type").isNotNull())
    return flat


def nest(flat: DataFrame) -> DataFrame:
    """The nested output record (state, entity, model, tile, times, derived)."""
    return flat.select(
        "name", "id",
        F.struct(F.col("state_ready").alias("ready"), F.col("config_update")).alias("state"),
        F.struct("entity_type", "entity_name", "entity_version", "scale_to_zero", "workload_size").alias("entity"),
        F.struct("model_name", "model_provider", "model_type").alias("model"),
        F.struct("tile_id", "problem_type").alias("tile"),
        F.struct("created_at", "updated_at").alias("timestamps"),
        F.struct("endpoint_category", (F.col("state_ready") == "READY").alias("is_ready"),
                 S.strip_version("model_name").alias("model_family")).alias("derived"))


SUMMARY_FIELDS = ["model_type", "endpoint_category", "endpoint_type", "entity_type", "state_ready", "task", "model_provider",
                  "model_family"]


def summary(flat: DataFrame, fields: Sequence[str] = SUMMARY_FIELDS) -> DataFrame:
    """K5: (field, value, count) for every summary field in one pass: the
    fields are unpivoted, then grouped once (D12 per field). Empty values count
    as 'unknown', but model_family (the version-normalised model name, B19)
    leaves out endpoints without a name. total_count, usage_tracking_enabled and
    scale_to_zero_enabled are rows with the value 'all'."""
    f = flat.withColumn("model_family", S.strip_version(F.nullif(F.col("model_name"), F.lit(""))))
    rows = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in fields]
    flags = {"total_count": F.lit(True), "usage_tracking_enabled": F.col("gateway.usage_tracking_enabled"),
             "scale_to_zero_enabled": F.col("scale_to_zero")}
    rows += [F.struct(F.when(cond, F.lit(name)).alias("field"), F.lit("all").alias("value")) for name, cond in flags.items()]
    long = f.select(F.explode(F.array(*rows)).alias("kv")).select("kv.*")
    v = F.nullif(F.trim("value"), F.lit(""))
    long = long.where(F.col("field").isNotNull() & ((F.col("field") != "model_family") | v.isNotNull()))
    return long.groupBy("field", F.coalesce(v, F.lit("unknown")).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def family_of(mt: Column) -> Column:
    out = None
    for fam, types in FAMILIES.items():
        out = F.when(mt.isin(*types), fam) if out is None else out.when(mt.isin(*types), fam)
    return out.otherwise("unclassified")


def family_slice(flat: DataFrame, samples: int = 3) -> DataFrame:
    """K6: per family and model_type: count, ready count and up to ``samples``
    endpoint names (first by name; E8 top-n, map-side limited)."""
    f = flat.withColumn("family", family_of(F.col("model_type")))
    counts = f.groupBy("family", "model_type").agg(F.count(F.lit(1)).alias("count"),
                                                    F.count_if(F.col("state_ready") == "READY").alias("ready"))
    top = ts.top_n_per_key(f.select("family", "model_type", "name"), ["family", "model_type"],
                           [F.col("name").asc()], samples)
    names = top.groupBy("family", "model_type").agg(F.array_sort(F.collect_list("name")).alias("sample_names"))
    return counts.join(names, ["family", "model_type"], "left")


def health(flat: DataFrame) -> DataFrame:
    """K7: endpoints not READY, in total and by entity type."""
    nr = flat.filter(F.coalesce(F.col("state_ready"), F.lit("")) != "READY")
    by = A.frequency(nr, "entity_type", out="entity_type")
    total = nr.agg(F.count(F.lit(1)).alias("count")).select(F.lit("ALL").alias("entity_type"), "count")
    return by.unionByName(total)


def providers(flat: DataFrame, external_only: bool = False) -> DataFrame:
    """K8: endpoints per model provider; ``external_only`` drops the
    platform's own ('databricks')."""
    f = flat.filter(S.present("model_provider"))
    if external_only:
        f = f.filter(F.col("model_provider") != "databricks")
    return A.frequency(f, "model_provider", out="model_provider")


def class_listing(flat: DataFrame) -> DataFrame:
    """all endpoints sorted by class then name (one sort for all classes)."""
    return flat.select("model_type", "name", "state_ready").orderBy("model_type", "name")


def format_assistants(raw: DataFrame) -> DataFrame:
    """K9: list-only assistant rows, empty text for what is missing, whole
    instructions, the number of knowledge bases and the raw record."""
    fields = {"id": "id", "name": "display_name", "resource_name": "name", "description": "description",
              "instructions": "instructions", "endpoint_name": "endpoint_name", "creator": "creator",
              "create_time": "create_time", "experiment_id": "experiment_id"}
    return raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for n, c in fields.items()],
                      S.list_size("knowledge_bases").alias("knowledge_base_count"),
                      F.to_json(F.struct(*[F.col(c) for c in raw.columns])).alias("raw"))


# --- traces ------------------------------------------------------------------------------------

# Keywords that make an AGENT span a tool call.
TOOL_KEYWORDS = ["genie", "query_", "get_", "compare_", "mcp", "tool"]
# Tool categories and their name patterns, in match order.
TOOL_PATTERNS = {
    "genie": [r"genie", r"mcp.*genie", r"execute_genie", r"query_space_", r"poll_response_"],
    "knowledge_assistant": [r"query_knowledge_assistant", r"ka", r"knowledge"],
    "valuation_score": [r"get_valuation_score", r"valuation"],
    "compare_peers": [r"compare_peers", r"peer"],
    "growth_trajectory": [r"get_growth_trajectory", r"growth"],
    "risk_summary": [r"get_risk_summary", r"risk"],
}


def is_tool_call() -> Column:
    """TOOL spans, and AGENT spans whose name has a tool keyword."""
    return (F.col("span_type") == "TOOL") | ((F.col("span_type") == "AGENT") & F.lower("name").rlike("|".join(TOOL_KEYWORDS)))


def duration_ms() -> Column:
    """Span duration; 0 while a span has no start or end."""
    return F.coalesce((F.col("end_time_ns") - F.col("start_time_ns")) / 1e6, F.lit(0.0))


def tool_calls(spans: DataFrame) -> DataFrame:
    """Tool calls with whole inputs and outputs, duration in ms, status."""
    return spans.filter(is_tool_call()).select(
        "trace_id", "name", "span_type", F.coalesce("inputs", F.lit("")).alias("inputs"),
        F.coalesce("outputs", F.lit("")).alias("outputs"), duration_ms().alias("duration_ms"),
        F.coalesce("status", F.lit("UNKNOWN")).alias("status"))


def _totals() -> list[Column]:
    return [F.count_if(F.col("span_type").isin("LLM", "CHAT_MODEL")).alias("llm_calls"),
            F.coalesce(F.sum(F.when(is_tool_call(), duration_ms())), F.lit(0.0)).alias("total_duration_ms")]


def trace_totals(spans: DataFrame) -> DataFrame:
    """Per trace, model-call count and total tool duration (ms), in one aggregate."""
    return spans.groupBy("trace_id").agg(*_totals())


def tools_vs_expected(spans: DataFrame, expected: DataFrame) -> DataFrame:
    """D19 + K11: per expected trace, categories found vs expected -> missing,
    unexpected, success; a trace without spans fails with all missing. The
    spans are read once; a trace's list holds each category or unmatched name
    once.

    ``expected``: (trace_id, expected_tools array<string>)."""
    category = F.when(is_tool_call(), S.categorize("name", TOOL_PATTERNS))
    found = spans.groupBy("trace_id").agg(F.array_sort(F.collect_set(category)).alias("tools_found"), *_totals())
    j = expected.join(found, "trace_id", "left")
    tf = F.coalesce(F.col("tools_found"), F.array().cast("array<string>"))
    exp = F.array_sort(F.array_distinct("expected_tools"))
    return j.select(
        "trace_id", tf.alias("tools_found"), exp.alias("expected_tools"),
        F.array_sort(F.array_except(exp, tf)).alias("missing_tools"),
        F.array_sort(F.array_except(tf, exp)).alias("unexpected_tools"),
        (F.size(F.array_except(exp, tf)) == 0).alias("success"),
        F.coalesce("total_duration_ms", F.lit(0.0)).alias("total_duration_ms"),
        F.coalesce("llm_calls", F.lit(0)).cast("bigint").alias("llm_calls"))


def latest_trace(traces: DataFrame, as_of, minutes: int = 5, ts_col: str = "ts") -> DataFrame:
    """The newest trace started within ``minutes`` before ``as_of``."""
    end = F.lit(as_of).cast("timestamp_ntz")
    since = end - F.make_dt_interval(mins=F.lit(minutes))
    w = traces.filter((F.col(ts_col) >= since) & (F.col(ts_col) <= end))
    return w.agg(F.max_by("trace_id", F.struct(ts_col, "trace_id")).alias("trace_id"), F.max(ts_col).alias(ts_col))


def latest_trace_per_day(traces: DataFrame, hour: int = 12, minutes: int = 5, ts_col: str = "ts") -> DataFrame:
    """K12 for every day at once: the newest trace within ``minutes`` before
    ``hour`` o'clock. A filter on the time of day and one partial aggregate."""
    day = F.to_date(ts_col)
    end = day.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hour))
    w = traces.filter((F.col(ts_col) <= end) & (F.col(ts_col) >= end - F.make_dt_interval(mins=F.lit(minutes))))
    return w.groupBy(day.alias("day")).agg(F.max_by("trace_id", F.struct(ts_col, "trace_id")).alias("trace_id"),
                                           F.max(ts_col).alias(ts_col))
