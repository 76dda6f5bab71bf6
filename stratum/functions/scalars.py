"""Column functions (B1-B35): each returns a JVM-side Column expression.

None of these leave the JVM: they compose built-in functions, so they stay
inside whole-stage codegen and can be pushed through by Catalyst.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- identity, semi-structured paths, ratios -------------------------------------------

def first_known(*cols) -> Column:
    """B1: first non-NULL of a fallback chain (extracted, registry, file stem)."""
    return F.coalesce(*[_c(c) for c in cols])


def vpath(v, path: str, type_: str = "string", strict: bool = False) -> Column:
    """B2: typed read of a path in a VARIANT (``$.response.x``); missing -> NULL.

    ``strict=False`` uses ``try_variant_get`` so a value of the wrong type
    is NULL too, like a failed cast in a lenient reader.
    """
    fn = F.variant_get if strict else F.try_variant_get
    return fn(_c(v), path if path.startswith("$") else "$." + path, type_)


def json_path(s, path: str) -> Column:
    """B2 for string JSON: ``get_json_object``; missing -> NULL."""
    return F.get_json_object(_c(s), path if path.startswith("$") else "$." + path)


def pct(a, b, scale: int = 2) -> Column:
    """``round(a / nullif(b, 0) * 100, scale)`` - zero divisor gives NULL."""
    return F.round(_c(a) / F.nullif(_c(b), F.lit(0)) * 100, scale)


def null_as(type_: str = "double") -> Column:
    """Typed NULL placeholder."""
    return F.lit(None).cast(type_)


# --- CASE buckets and flags --------------------------------------------------------------

def time_period(hour, long: bool = False) -> Column:
    """Night (<6), Morning (<12), Afternoon (<18), else Evening."""
    h = _c(hour)
    if long:
        return (F.when(h < 6, "Night (12AM-6AM)").when(h < 12, "Morning (6AM-12PM)")
                .when(h < 18, "Afternoon (12PM-6PM)").otherwise("Evening (6PM-12AM)"))
    return F.when(h < 6, "Night").when(h < 12, "Morning").when(h < 18, "Afternoon").otherwise("Evening")


# Day names for day-of-week 0 = Monday .. 6 = Sunday.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def day_name(dow) -> Column:
    """Day-of-week number (0 = Monday) -> name; other values -> NULL."""
    d = _c(dow)
    return reduce(lambda acc, kv: acc.when(d == kv[0], kv[1]),
                  list(enumerate(DAY_NAMES))[1:], F.when(d == 0, DAY_NAMES[0]))


def flag_label(flag, yes: str, no: str) -> Column:
    """B6 variant: 0/1 flag -> label."""
    return F.when(_c(flag) == 1, yes).otherwise(no)


def above(a, b) -> Column:
    """``a > b``; NULL when either side is NULL."""
    return _c(a) > _c(b)


def trend_signal(close, s50, s200) -> Column:
    """Bullish above both averages, Bearish below both, else Neutral (NULL too)."""
    c, a, b = _c(close), _c(s50), _c(s200)
    return (F.when((c > a) & (c > b), "Bullish").when((c < a) & (c < b), "Bearish")
            .otherwise("Neutral"))


def is_rush_hour(hour) -> Column:
    """1 when hour is in 7-9 or 17-19, else 0."""
    h = _c(hour)
    return (h.between(7, 9) | h.between(17, 19)).cast("int")


def is_weekend(dow, weekend_days: Sequence[int] = (5, 6)) -> Column:
    """1 when the day (0 = Monday) is a weekend day, else 0."""
    return _c(dow).isin(*weekend_days).cast("int")


def present(col) -> Column:
    """Not NULL and not the empty string."""
    c = _c(col)
    return c.isNotNull() & (c.cast("string") != "")


def positive(col) -> Column:
    """Strictly positive (NULL -> NULL, filtered out by ``filter``)."""
    return _c(col) > 0


def valid_trips(df: DataFrame, distance: str = "trip_distance", fare: str = "fare_amount",
                passengers: str = "passenger_count") -> DataFrame:
    """Distance in (0,100), fare in (0,500), passengers in (0,6]."""
    return df.filter((F.col(distance) > 0) & (F.col(distance) < 100)
                     & (F.col(fare) > 0) & (F.col(fare) < 500)
                     & (F.col(passengers) > 0) & (F.col(passengers) <= 6))


# --- schema drift, defaults, clipping ----------------------------------------------------

def resolve_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]],
                    defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Rename the first present alias to the canonical name.

    A canonical column with no present alias takes its default; without a
    default it is required and a ``ValueError`` is raised (schema only, no data).
    """
    defaults = defaults or {}
    present_cols = {c.lower(): c for c in df.columns}
    out = []
    for canon, names in aliases.items():
        hit = next((present_cols[n.lower()] for n in [canon, *names] if n.lower() in present_cols), None)
        if hit is not None:
            out.append(F.col(hit).alias(canon))
        elif canon in defaults:
            out.append(F.lit(defaults[canon]).alias(canon))
        else:
            raise ValueError(f"required column {canon!r} missing; looked for {[canon, *names]}")
    used = {c.lower() for names in aliases.values() for c in names} | {c.lower() for c in aliases}
    rest = [F.col(c) for c in df.columns if c.lower() not in used]
    return df.select(*out, *rest)


def fill_defaults(df: DataFrame, spec: Mapping[str, object], numeric: Sequence[str] = ()) -> DataFrame:
    """Add missing columns, coerce ``numeric`` columns (bad text -> NULL)
    and fill NULLs with a constant or, for the value ``"median"``, the
    column's exact median (one aggregate row, cross-joined back)."""
    for c, v in spec.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None if v == "median" else v))
    for c in numeric:
        df = df.withColumn(c, F.col(c).try_cast("double"))
    med_cols = [c for c, v in spec.items() if v == "median"]
    if med_cols:
        from stratum.operators.timeseries import exact_quantiles
        for c in med_cols:
            med = exact_quantiles(df, c, [0.5]).withColumnRenamed("q0", "_med")
            df = df.crossJoin(F.broadcast(med))  # one row: bounded
            df = df.withColumn(c, F.coalesce(F.col(c), F.col("_med"))).drop("_med")
    consts = {c: v for c, v in spec.items() if v != "median"}
    for c, v in consts.items():
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return df


def clip(col, lo=None, hi=None) -> Column:
    """Clip to [lo, hi] (either bound optional); NULL stays NULL."""
    c = _c(col)
    out = c
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


# --- strings --------------------------------------------------------------------------------

def file_stem(name) -> Column:
    """Leading run of characters up to the first '_' or '.'."""
    return F.regexp_extract(_c(name), r"^([^_\.]+)", 1)


def has_prefix(col, prefix: str) -> Column:
    """Prefix predicate."""
    return _c(col).startswith(prefix)


def mentions(col, word: str) -> Column:
    """Case-folded substring predicate."""
    return F.lower(_c(col)).contains(word.lower())


def ellipsis(col, n: int) -> Column:
    """First n characters + '...' when longer than n."""
    c = _c(col)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def strip_version(col) -> Column:
    """Drop a trailing '-<digit>' when the name is longer than 2 characters."""
    c = _c(col)
    return F.when(F.length(c) > 2, F.regexp_replace(c, r"-[0-9]$", "")).otherwise(c)


def sanitize(col, default: str = "knowledge_assistant") -> Column:
    """Blanks and illegal characters -> '_', runs of '_'/'-' -> '_',
    strip leading/trailing '_' and '-', empty -> default."""
    s = F.regexp_replace(_c(col), " ", "_")
    s = F.regexp_replace(s, r"[^a-zA-Z0-9_-]", "_")
    s = F.regexp_replace(s, r"[_-]{2,}", "_")
    s = F.regexp_replace(s, r"^[_-]+|[_-]+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default))


def source_name(path, idx) -> Column:
    """Last path segment (trailing '/' ignored), blanks and dots -> '_';
    ``source_{idx+1}`` when the path has no segment."""
    trimmed = F.regexp_replace(_c(path), "/+$", "")
    last = F.element_at(F.split(trimmed, "/"), -1)
    name = F.when(_c(path).isNull(), F.concat(F.lit("source_"), (_c(idx) + 1).cast("string"))) \
        .otherwise(last)
    return F.translate(name, " .", "__")


def categorize(col, patterns: Mapping[str, Sequence[str]]) -> Column:
    """First category (in dict order) with a pattern found in the
    lower-cased name; unmatched names are kept as they are."""
    n = F.lower(_c(col))
    out = None
    for cat, pats in patterns.items():
        cond = n.rlike("|".join(f"(?:{p})" for p in pats))
        out = F.when(cond, F.lit(cat)) if out is None else out.when(cond, F.lit(cat))
    return out.otherwise(_c(col)) if out is not None else _c(col)


def sentence(*parts) -> Column:
    """Concat of text and numbers; any NULL part -> NULL."""
    return F.concat(*[_c(p) if not isinstance(p, (int, float)) else F.lit(str(p)) for p in parts])


def num_text(col, scale: int = 1) -> Column:
    """B23 helper: a number rounded to ``scale`` digits as text, via DECIMAL so
    the digits do not depend on binary float formatting."""
    return F.round(_c(col).cast(f"decimal(38,{scale + 6})"), scale).cast(f"decimal(38,{scale})").cast("string")


# --- dates, math ----------------------------------------------------------------------------

def hour_of(ts) -> Column:
    """Hour of a timestamp."""
    return F.hour(_c(ts))


def weekday_of(ts) -> Column:
    """Day of week with 0 = Monday .. 6 = Sunday."""
    return F.weekday(_c(ts))


def ms_to_timestamp(ms) -> Column:
    """Epoch milliseconds -> timestamp."""
    return F.timestamp_millis(_c(ms))


def abs_error(actual, pred, scale: int | None = 2) -> Column:
    """|actual - predicted| (rounded when ``scale`` is given)."""
    e = F.abs(_c(actual) - _c(pred))
    return F.round(e, scale) if scale is not None else e


def pct_error(actual, pred, scale: int | None = 2) -> Column:
    """|actual - predicted| / actual * 100; zero actual -> NULL."""
    e = F.abs(_c(actual) - _c(pred)) / F.nullif(_c(actual), F.lit(0)) * 100
    return F.round(e, scale) if scale is not None else e


# --- arrays, maps, structs, JSON ------------------------------------------------------------

def tags_map(tags) -> Column:
    """List of {key, value} -> map; entries without a key are dropped
    (a repeated key keeps its last value)."""
    kept = F.filter(_c(tags), lambda t: t["key"].isNotNull() & (t["key"] != ""))
    keys = F.transform(kept, lambda t: t["key"])
    last = F.filter(kept, lambda t, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), t["key"]))
    return F.map_from_entries(F.transform(last, lambda t: F.struct(t["key"].alias("key"),
                                                                      t["value"].alias("value"))))


def list_size(col) -> Column:
    """Number of elements; NULL list -> 0."""
    return F.when(_c(col).isNull(), 0).otherwise(F.size(_c(col)))


def first_of(col, field: str | None = None, default=None) -> Column:
    """First element (or a field of it) of a nested list, default when absent."""
    e = F.get(_c(col), 0)
    if field:
        e = e[field]
    return F.coalesce(e, F.lit(default)) if default is not None else e


def filter_by(df: DataFrame, **conds) -> DataFrame:
    """Equality (scalar) or membership (list) filter on several fields."""
    preds = [F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else (F.col(k) == v)
             for k, v in conds.items()]
    return df.filter(reduce(lambda a, b: a & b, preds)) if preds else df


RESPONSE_DDL = ("struct<output:array<struct<type:string,"
                "content:array<struct<type:string,text:string>>>>>")


def response_text(js, first_only: bool = False) -> Column:
    """Texts of ``output_text`` parts of ``message`` items of a response
    JSON, joined with a newline (``first_only``: the first such text). Without
    any such text the raw output, or the whole answer if it has none."""
    parsed = F.from_json(_c(js), RESPONSE_DDL)
    msgs = F.filter(parsed["output"], lambda o: o["type"] == "message")
    texts = F.flatten(F.transform(msgs, lambda m: F.transform(
        F.filter(m["content"], lambda c: c["type"] == "output_text"), lambda c: F.coalesce(c["text"], F.lit("")))))
    found = F.get(texts, 0) if first_only else F.array_join(texts, "\n")
    raw = F.coalesce(F.get_json_object(_c(js), "$.output"), _c(js), F.lit(""))
    return F.when(F.size(texts) > 0, found).otherwise(raw)


def missing_phrases(text, expected) -> Column:
    """Expected phrases not contained in text (case-insensitive); a NULL text contains none."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    return F.filter(F.coalesce(_c(expected), F.array().cast("array<string>")), lambda e: ~F.contains(t, F.lower(e)))


def error_free(text) -> Column:
    """0 when the response starts with 'Error:', else 1."""
    return (~_c(text).startswith("Error:")).cast("int")


def recommend(score) -> Column:
    """BUY at 70+, HOLD at 40+, else SELL."""
    s = _c(score)
    return F.when(s >= 70, "BUY").when(s >= 40, "HOLD").otherwise("SELL")


def versus_peer(x, avg) -> Column:
    """ABOVE / BELOW the peer mean."""
    return F.when(_c(x) > _c(avg), "ABOVE").otherwise("BELOW")


def as_json(*cols) -> Column:
    """JSON text of a struct of columns (nested structs kept)."""
    return F.to_json(F.struct(*[_c(c) for c in cols]))


def parse_array(js, ddl: str) -> Column:
    """Typed JSON array parse, e.g. ``array<struct<name:string,v:double>>``."""
    return F.from_json(_c(js), ddl)
