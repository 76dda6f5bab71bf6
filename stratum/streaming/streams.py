"""Streaming stages (I1, I2, I3, I5, A1, A2) as triggered Structured Streaming.

Each stage reads new input only (file-source bookkeeping in its checkpoint),
applies the same column functions as the batch twin and appends to a parquet
sink with ``trigger(availableNow=True)``: a triggered refresh that processes
everything available, then stops. Checkpoints and outputs live under the
cluster's shared checkpoint location (``spark.checkpoint.dir``), so a
restarted driver or lost executor resumes from the last committed batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import documents as D
from stratum.session import shared_dir
from stratum.streaming.ledger import KeyLedger


def stream_binary(spark: SparkSession, src: str, glob: str = "*") -> DataFrame:
    """A1: new files of a folder and those below it as (path, content, file_name, file_size)."""
    return (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
            .option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(src)
            .select("path", "content", F.col("_metadata.file_name").alias("file_name"),
                    F.col("_metadata.file_size").alias("file_size")))


def stream_table(spark: SparkSession, src: str, schema, glob: str = "*.parquet") -> DataFrame:
    """A2: append-only stream over the parquet files of an upstream table."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(src)


def stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as a stream, be it one file or a folder of them."""
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parquet*")


def run_available(df: DataFrame, out: str, ckpt: str) -> None:
    """Append everything available now to ``out`` and wait for it."""
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def bronze(docs: DataFrame) -> DataFrame:
    """I1 body (batch and stream): parse once, then two classifications that
    reuse the parsed column."""
    parsed = D.with_tokens(docs.select("doc_id", "source", "lang", D.html_text("text").alias("parsed_content")),
                           "parsed_content")
    return parsed.select("doc_id", "source", "lang", "parsed_content",
                         D.classify("_tokens", D.DOC_TYPE_LABELS, tokenized=True).alias("document_type"),
                         D.classify("_tokens", D.SECTOR_LABELS, tokenized=True).alias("industry_sector"),
                         F.current_timestamp().alias("_ingested_at"))


def silver(bronze_df: DataFrame) -> DataFrame:
    """I2 body: extraction per row, rows without a result dropped, stamped."""
    out = bronze_df.select("doc_id", "document_type", D.extract("parsed_content").alias("extracted_metrics"))
    return out.filter(F.col("extracted_metrics").isNotNull()).withColumn("_silver_at", F.current_timestamp())


def stream_bronze(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Documents table as a file stream -> bronze parquet. Returns the output path."""
    root = root or shared_dir(spark, "bronze")
    run_available(bronze(stream_documents(spark, sf_dir)), f"{root}/data", f"{root}/_checkpoint")
    return f"{root}/data"


def stream_silver(spark: SparkSession, bronze_path: str, root: str | None = None) -> str:
    """Bronze output as a stream -> silver parquet (stateless)."""
    root = root or shared_dir(spark, "silver")
    schema = spark.read.parquet(bronze_path).schema
    run_available(silver(stream_table(spark, bronze_path, schema)), f"{root}/data", f"{root}/_checkpoint")
    return f"{root}/data"


def land_files(docs: DataFrame, path: str, per_file: int = 1000) -> None:
    """Documents as text files of one JSON record a line, by source: the files
    a crawl would leave. ``per_file`` bounds a file, which a reader holds whole."""
    (docs.select("source", F.to_json(F.struct("doc_id", "lang", "text")).alias("value"))
     .write.option("maxRecordsPerFile", per_file).partitionBy("source").text(path))


def binary_documents(files: DataFrame) -> DataFrame:
    """Rows (doc_id, source, lang, text, file_name) of streamed binary files."""
    line = F.explode(F.split(F.col("content").cast("string"), "\n"))
    rec = F.from_json("line", "doc_id long, lang string, text string")
    return (files.select("file_name", F.regexp_extract("path", "source=([^/]*)/", 1).alias("source"), line.alias("line"))
            .where("line <> ''").select("file_name", "source", rec.alias("r"))
            .select("r.doc_id", "source", "r.lang", "r.text", "file_name"))


def stream_binary_bronze(spark: SparkSession, src: str, root: str | None = None) -> str:
    """A1 + I1: bronze from binary files of a folder. Returns the output path."""
    root = root or shared_dir(spark, "bronze-binary")
    run_available(bronze(binary_documents(stream_binary(spark, src, "*.txt"))), f"{root}/data", f"{root}/_checkpoint")
    return f"{root}/data"


def dedup_stream(df: DataFrame, keys: Sequence[str], out: str, ckpt: str, run: int = 1) -> None:
    """Idempotent re-runs: a key written by an earlier batch or run is dropped.

    Each micro-batch is reduced to one row per key and anti-joined with the keys
    already written. Those are kept beside the sink in a :class:`KeyLedger`, whose
    filters tell which few files can hold a key of the batch, so a batch does
    not read the history. A batch owns a folder and a part of the ledger and
    overwrites both, so a retried batch leaves no second copy. ``run`` numbers
    the runs that share the sink."""
    schema = df.schema
    ledger_path = f"{out.rstrip('/')}-keys"
    df.sparkSession.createDataFrame([], schema).write.mode("overwrite").parquet(f"{out}/run={run}/batch=-1")
    KeyLedger(df.sparkSession, ledger_path, schema, keys).create()

    def merge(batch: DataFrame, batch_id: int) -> None:
        ledger, name = KeyLedger(batch.sparkSession, ledger_path, schema, keys), f"{run}-{batch_id}"
        if name not in [n for n, _ in ledger.parts()[1]]:  # not in a retry, whose part must stay apart
            ledger.merge()
        path = f"{out}/run={run}/batch={batch_id}"
        ledger.unseen(batch, name).write.mode("overwrite").parquet(path)
        ledger.add(name, batch.sparkSession.read.schema(schema).parquet(path))

    q = df.writeStream.foreachBatch(merge).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()


Step = tuple[Sequence[str], Callable[..., object]]


def run_graph(steps: Mapping[str, Step]) -> dict[str, object]:
    """Triggered refresh of a pipeline. ``steps``: name -> (names it reads,
    function of their results); the order follows from the reads."""
    done: dict[str, object] = {}
    for name in TopologicalSorter({n: reads for n, (reads, _) in steps.items()}).static_order():
        reads, fn = steps[name]
        done[name] = fn(*[done[r] for r in reads])
    return done
