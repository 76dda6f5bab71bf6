"""Quality by importance resampling over hashed n-grams.

Two bag models over hashed words and word pairs: the target from documents that
are labelled good and not toxic, the raw model from all documents.  Each different
text counts once, however many rows hold it, and all its copies are taken or none:
else a large group of copies would sink its own weight and fill the rejections.  A document's
log importance weight is the mean log ratio of the two over its n-grams, times
``sharpness`` (a mean, or long documents would all sink or swim by length).
Gumbel noise on the log weights and the k largest sums draw k documents without
replacement, each in proportion to its weight; k is the share of good ones among
the different labelled texts, times the number of different texts.

The target is fitted on at most ``sample`` labelled documents, the lowest hashes
of doc_id.  Raw counts, weights and the choice of the k-th largest cover all
documents.  Noise comes from a hash of the text, so reruns and copies agree.

Defined cases: a text that is null or has no words has no weight and is not
taken; without good labels every weight is 1; without labels every document with
words is taken; ties at the k-th place are all taken; an empty table gives no
rows; a null label, or one of a doc_id that ``docs`` lacks, is no label; a text is good
if one of its copies is labelled so; the columns of ``docs`` are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import lower_ascii, mix, span_hashes, text_slices, word_bounds, written

BUCKETS = 1 << 18
SAMPLE = 100_000
SHARPNESS = 100.0
_STEPS = 2.0 ** 30  # keys are whole multiples of its inverse


def ngram_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of every word and pair of neighbouring words of the texts."""
    data = lower_ascii()[data]
    starts, ends, doc = word_bounds(data, offsets)
    h = span_hashes(data, starts, ends)
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    both = mix(h[pair] * np.uint64(0xA0761D6478BD642F) + h[pair + 1])
    return (np.concatenate([h, both]) % np.uint64(buckets)).astype(np.int64), np.concatenate([doc, doc[pair]])


def fit(docs: DataFrame, good: DataFrame, buckets: int = BUCKETS, smoothing: float = 0.5) -> np.ndarray:
    """Log ratio of the target to the raw model for every bucket; ``good`` (doc_id) is of bounded size."""
    flagged = docs.select("doc_id", "text").join(F.broadcast(good.select("doc_id", F.lit(True).alias("good"))), "doc_id", "left") \
        .groupBy("text").agg(F.max(F.col("good").isNotNull()).alias("good"))  # combined before the shuffle

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int64)
        for rows, data, offsets in text_slices(batches):
            b, doc = ngram_buckets(data, offsets, buckets)
            total[0] += np.bincount(b, minlength=buckets)
            flag = rows.column(1).to_numpy(zero_copy_only=False)[doc]
            total[1] += np.bincount(b[flag], minlength=buckets)
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])],
                                         names=["bucket", "raw", "target"])

    counts = flagged.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for b, r, t in counts.collect():  # at most ``buckets`` rows
        raw[b], target[b] = r, t
    if not target.any():
        return np.zeros(buckets)
    part = lambda x: np.log((x + smoothing) / (x.sum() + smoothing * buckets))
    return part(target) - part(raw)


def with_key(docs: DataFrame, ratio: np.ndarray, sharpness: float = SHARPNESS, seed: int = 0) -> DataFrame:
    """(row, log_weight, key): each row of ``docs`` whole, its mean log ratio and sampling key (null without words)."""
    buckets = len(ratio)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    names = ["row", "u", "log_weight"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for rows, data, offsets in text_slices(batches, "row.text"):
            b, doc = ngram_buckets(data, offsets, buckets)
            n = np.bincount(doc, minlength=rows.num_rows)
            total = np.bincount(doc, weights=table[b], minlength=rows.num_rows)
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([*rows.columns, mean], names=names)

    u = (F.shiftrightunsigned(F.xxhash64(F.xxhash64("text"), F.lit(seed)), 11) + 0.5) / F.lit(2.0 ** 53)
    rows = docs.select(F.struct("*").alias("row"), u.alias("u"))
    scored = rows.mapInArrow(score, rows.select("*", F.lit(None).cast("double").alias("log_weight")).schema)
    key = F.col("log_weight") * F.lit(sharpness) - F.log(-F.log("u"))
    return scored.select("row", "log_weight", (F.round(key * F.lit(_STEPS)) / F.lit(_STEPS)).alias("key"))


def kth_largest(keys: DataFrame, k: int) -> float | None:
    """The k-th largest of column key, or None if there are fewer: four counts by 16 bits of the key's order."""
    order = (F.col("key") * F.lit(_STEPS)).cast("long").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    whole = keys.where("key IS NOT NULL").select(order.alias("o"))
    prefix, left = 0, k
    for shift in (48, 32, 16, 0):
        rows = whole if shift == 48 else whole.where(F.shiftrightunsigned("o", shift + 16) == prefix)
        part = F.shiftrightunsigned("o", shift).bitwiseAND(F.lit(0xFFFF).cast("long"))
        counts = rows.groupBy(part.alias("p")).count().collect()  # at most 65,536 rows
        for p, n in sorted((tuple(r) for r in counts), reverse=True):
            if left <= n:
                break
            left -= n
        else:
            return None
        prefix = prefix << 16 | p
    return (prefix - (1 << 63)) / _STEPS


def digest(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text, F.lit("")).alias("h2")]


def good_share(docs: DataFrame, labels: DataFrame) -> float:
    """Share of good ones among the different labelled texts."""
    known = labels.where("quality IS NOT NULL").select("doc_id", (F.col("quality") == 1).alias("good"))
    texts = docs.select("doc_id", *digest("text")).join(known, "doc_id").groupBy("h1", "h2").agg(F.max("good").alias("good"))
    r = texts.agg(F.avg(F.col("good").cast("double"))).first()[0]
    return 1.0 if r is None else r


def good_sample(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def resample(docs: DataFrame, labels: DataFrame, sharpness: float = SHARPNESS, sample: int = SAMPLE,
             seed: int = 0) -> tuple[DataFrame, Column]:
    """(row, log_weight, key) of every document, and the condition under which it is taken."""
    scored = with_key(docs, fit(docs, good_sample(labels, sample)), sharpness, seed)
    keys = written(scored.groupBy(*digest("row.text")).agg(F.max("key").alias("key")).select("key"), "quality-keys")
    k = round(good_share(docs, labels) * keys.count())
    last = kth_largest(keys, k) if k else float("inf")
    return scored, F.col("key").isNotNull() if last is None else F.coalesce(F.col("key") >= F.lit(last), F.lit(False))


def taken(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the resampling takes, with their own columns."""
    scored, keep = resample(docs, labels, **options)
    return scored.where(keep).select("row.*")
