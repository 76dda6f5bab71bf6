"""Helpers that several operators share: written tables, flat text buffers,
local forests and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.timeseries import with_row_id
from stratum.session import written

# The white space that separates words, as bytes.
LAST_ID = (1 << 63) - 1  # stands for a null doc_id in keys
WORD_BREAKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once a session; on a cluster they don't have it.

    Also bounds the batches that go to Python: a task holds one on its way there
    and one on its way back, outside the heap.
    """
    sc = spark.sparkContext
    for name, most in BATCH.items():
        spark.conf.set(name, most)
    if getattr(sc, "_stratum_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="stratum-code-"), "stratum_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "stratum")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    sc.addPyFile(path)
    sc._stratum_shipped = True


def keyed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns k and twin that tell its rows apart and order them by doc_id.

    k is the doc_id, or the largest long for a null one.  twin is 0 where no
    doc_id repeats or is null, else the row's number among those of its doc_id,
    by text hash; the returned key columns then include it.
    """
    ids = docs.select("doc_id")
    k = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("k")
    if ids.where("doc_id IS NULL").isEmpty() and ids.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.select("*", k, F.lit(0).cast("long").alias("twin")), ["k"]
    # a doc_id may be that of a third of all rows: they are numbered by one range-partitioned sort
    rows = docs.select(F.struct("*").alias("row"), k, F.xxhash64("text").alias("h"), F.md5("text").alias("m"),
                       F.monotonically_increasing_id().alias("id"))
    rows = with_row_id(rows, ["k", "h", "m", "id"], "at")
    first = written(rows.groupBy("k").agg(F.min("at").alias("first")), "keyed-first")
    rows = rows.join(first, "k").withColumn("twin", (F.col("at") - F.col("first") + 1).cast("long"))
    return rows.select("row.*", "k", "twin"), ["k", "twin"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in runs of about ``limit`` bytes of text, with their UTF-8 bytes laid end to end.

    Yields (rows, bytes, offsets); a null text has no bytes.  A text longer
    than ``limit`` comes alone and whole. ``column`` may be a field of a struct.
    """
    outer, _, inner = column.partition(".")
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(outer))
        if inner:
            col = pc.struct_field(col, inner)
        col = pc.fill_null(col.cast(pa.large_string()), "")
        offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        raw = col.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        i = 0
        while i < len(col):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
            j = min(j, len(col))
            yield batch.slice(i, j - i), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document index of every word (a run of bytes other than WORD_BREAKS) of each text."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    breaks = np.zeros(256, bool)
    breaks[list(WORD_BREAKS)] = True
    gap = breaks[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.ones(n, bool)
    before[1:] = gap[:-1]
    starts = np.flatnonzero(~gap & (before | edge[:n]))
    after = np.ones(n, bool)
    after[:-1] = gap[1:]
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def lower_ascii() -> np.ndarray:
    """Table that lower-cases A-Z in UTF-8 bytes."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64; the worker keeps the longest run it has needed."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][:n]


HASH_BASE = 0x9E3779B97F4A7C15
HASH_INVERSE = pow(HASH_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hash of each slice of ``data``; equal slices hash alike wherever they lie."""
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(HASH_BASE, n), dtype=np.uint64, out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * powers(HASH_INVERSE, n + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star for each component of the links (u, v): (node, smallest node) for all other nodes."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[:len(u)], flat[len(u):]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        live = ra != rb
        if not live.any():
            break
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root = root[root]
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) for every node of the links (u, v) of longs; component is its smallest node.

    Alternates the two star contractions until the links no longer change.
    Each round is written to the shared folder.  A node with very many links is
    an even join: its minimum comes from a partial aggregation, and the join
    that hands it on reads two plain tables, so a skewed partition is split.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), purpose)
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), purpose)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), purpose)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), purpose)
        small = large.join(least, "u")
        small = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        edges = written(small.distinct(), purpose)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
