"""Sources and sinks.

Sinks write with DataFrame writers (parallel, one file set per partition);
paths come from the caller, normally under the cluster's shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratum.session import written


def fetch_by_key(keys: DataFrame, key: str, responses: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """A4: the answer of a source for every distinct key -> (key, status, error, the fields of ``schema``).

    ``responses`` (key, body) holds the raw answers as they came in; the keys
    meet them in a join, so a source of any size is read in parallel. A key
    without an answer has status 'not_found', an answer that does not parse
    'failed' with the text as its error; both keep their row, so nothing is
    lost silently."""
    asked = keys.select(key).distinct()
    got = asked.join(responses.select(key, F.col(body).alias("_body")), key, "left")
    parsed = got.withColumn("_r", F.from_json("_body", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("_r").isNull() | F.col("_r._corrupt").isNotNull()
    fields = [c.strip().split()[0] for c in schema.split(",")]
    status = F.when(F.col("_body").isNull(), "not_found").when(bad, "failed").otherwise("success")
    return parsed.select(key, status.alias("status"), F.when(status == "failed", F.col("_body")).alias("error"),
                         *[F.when(status == "success", F.col(f"_r.{f}")).alias(f) for f in fields])


def read_inventory(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A5: JSON inventory - files with a top-level list of records, or the legacy
    object ``{"endpoints": [...]}``; both give one row per record. A file is
    parsed whole by one task; an inventory of many files is read in parallel."""
    wrapped = T.StructType([T.StructField("endpoints", T.ArrayType(schema))])
    raw = spark.read.schema(T.StructType(schema.fields + wrapped.fields)).option("multiLine", True).json(path)
    legacy = raw.filter(F.col("endpoints").isNotNull()).select(F.explode("endpoints").alias("e")).select("e.*")
    plain = raw.filter(F.col("endpoints").isNull()).select(*schema.fieldNames())
    return plain.unionByName(legacy)


def _running(rows: DataFrame, value: F.Column, out: str, inclusive: bool = True) -> DataFrame:
    """``rows`` (file, block, id, ...) with the running sum of ``value`` over each file in ``out``: summed within the
    blocks, each a part of a file that one task reads, and over the few blocks before."""
    inside = Window.partitionBy("file", "block").orderBy("id")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    rows = rows.withColumn("_v", value.cast("bigint"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("file", "block").agg(F.sum("_v").alias("_t")).withColumn("_b", F.coalesce(F.sum("_t").over(before), F.lit(0)))
    rows = rows.withColumn(out, F.coalesce(F.sum("_v").over(upto), F.lit(0))).join(blocks.drop("_t"), ["file", "block"])
    return rows.withColumn(out, F.col(out) + F.col("_b")).drop("_v", "_b")


def read_inventory_split(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A5 for files of any size: the same rows as :func:`read_inventory`, every file read in parts by many tasks.

    Spark splits the files at closing braces. Whether a brace is inside a string follows from the number of
    quotes before it, and the depth from the braces outside strings; both are running sums over the parts, so the ends
    of the records are known without reading a file from its start. The pieces of a record then meet and are parsed.
    Escaped characters, braces and quotes in strings, nested objects and empty lists are handled; a record that does
    not fit the schema gives NULLs; the legacy wrapper has no key but "endpoints"."""
    raw = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"))
    raw = written(raw, "inventory-pieces")
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    rows = _running(raw.withColumn("q", quotes), F.col("q"), "quotes", inclusive=False)
    inside = F.col("quotes") % 2 == 1
    # the text outside strings: an open one at either end, then the whole ones
    text = F.when(inside & (F.col("q") == 0), "").when(inside, F.regexp_replace(bare, r'(?s)^[^"]*"', "")).otherwise(bare)
    text = F.regexp_replace(F.regexp_replace(text, r'"[^"]*"', ""), r'(?s)"[^"]*$', "")
    opens = F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))
    closes = F.when((F.col("quotes") + F.col("q")) % 2 == 0, 1).otherwise(0)
    rows = written(_running(rows, opens - closes, "depth").withColumn("closes", closes).drop("q", "quotes"), "inventory-depths")
    first = rows.groupBy("file").agg(F.min_by("value", F.struct("block", "id")).alias("head"))
    rows = rows.join(first.select("file", F.col("head").rlike(r'^\s*\{\s*"endpoints"\s*:').alias("wrapped")), "file")
    ends = (F.col("closes") == 1) & (F.col("depth") == F.when(F.col("wrapped"), 1).otherwise(0))
    rows = _running(rows.withColumn("ends", ends), ends.cast("int"), "record", inclusive=False)
    records = rows.groupBy("file", "record", "wrapped").agg(
        F.max("ends").alias("whole"), F.sort_array(F.collect_list(F.struct("block", "id", "value"))).alias("pieces")).where("whole")
    body = F.concat(F.array_join("pieces.value", "}"), F.lit("}"))
    body = F.when(F.col("wrapped") & (F.col("record") == 0), F.regexp_replace(body, r'^\s*\{\s*"endpoints"\s*:', "")).otherwise(body)
    parsed = records.select(F.from_json(F.regexp_replace(body, r"^[\s,\[]*", ""), schema).alias("r"))
    return parsed.select("r.*")


def write_full(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Full refresh - overwrite data and schema."""
    df.write.mode("overwrite").format(fmt).save(path)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append; new columns are kept in the new files and merged on read."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """A7 read side: union of all file schemas (missing columns -> NULL)."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def export_by(df: DataFrame, col: str, path: str, not_ready: F.Column | None = None,
              not_ready_path: str | None = None) -> None:
    """One JSON file set per lower-cased category value (categories with
    no rows produce nothing), plus the not-ready subset in a folder of its own."""
    df.withColumn("category", F.lower(F.col(col))).write.mode("overwrite").partitionBy("category").json(path)
    if not_ready is not None:
        df.filter(not_ready).write.mode("overwrite").json(not_ready_path or f"{path.rstrip('/')}-not-ready")


def write_snapshot(df: DataFrame, path: str, run_ts: str) -> str:
    """The rows as JSON under a folder of their own, and the name of that
    folder as the latest one. The pointer is a one-row table that is written
    after the data, so a reader sees the old snapshot or the whole new one."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/ts={run_ts}")
    (df.sparkSession.range(1).select(F.lit(run_ts).alias("run_ts"), F.current_timestamp().alias("at"))
     .write.mode("append").parquet(f"{path}/latest"))
    return f"{path}/ts={run_ts}"


def read_latest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A9 read side: the newest snapshot with the schema it was written with."""
    run_ts = spark.read.parquet(f"{path}/latest").agg(F.max_by("run_ts", "at")).first()[0]
    return spark.read.schema(schema).json(f"{path}/ts={run_ts}")


def cache_predictions(df: DataFrame, path: str) -> DataFrame:
    """Materialise scored rows once (a written table, not a cache that a
    lost executor takes with it) and read them back for reuse."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
