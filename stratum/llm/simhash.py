"""SimHash near-dedup by a generalised pigeonhole.

Fingerprints are cut into parts of bits that go together; each part gets its
own threshold, all thresholds together ``distance - parts + 1``, so two
fingerprints within the distance agree on some part to within its threshold.
A dynamic program over estimated candidate and probe counts chooses them.
Candidates come from equal part signatures and are verified on all bits.

Defined cases: a null or wordless text has fingerprint zero, which links like
any other; equal texts share a class; a null doc_id gets the class's smallest
doc_id, or null where the class has none; repeated rows each get a row; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import components, forest, lower_ascii, text_slices, word_bounds, written

SAMPLE = 2000      # fingerprints behind the choice of parts; affects cost only
BUCKET = 2048      # a signature with more fingerprints is compared in blocks of this size
PROBE_COST = 20.0  # a row that is shuffled, in verified pairs


def _simhash(data: np.ndarray, offsets: np.ndarray, shingle: int, seed: int) -> np.ndarray:
    """Fingerprint of each text as unsigned 64 bits."""
    import xxhash
    n_docs = len(offsets) - 1
    out = np.zeros(n_docs, np.uint64)
    lower = lower_ascii()
    lower[9:14] = 32
    data = lower[data]
    starts, ends, doc = word_bounds(data, offsets)
    if not len(starts):
        return out
    # one space after each word, other white space dropped: a shingle is then one slice
    keep = data != 32
    gap = ends[ends < len(data)]
    keep[gap] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    flat = data[keep].tobytes()
    words = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(words)[:-1]])
    count = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
    at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    last = np.minimum(at + shingle, np.repeat(first + words, count)) - 1
    begin, end = place[starts[at]].tolist(), (place[ends[last] - 1] + 1).tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(flat[a:b], seed) for a, b in zip(begin, end)), np.uint64, len(begin))
    some = np.flatnonzero(count)
    lo = np.concatenate([[0], np.cumsum(count)])
    for k in range(0, len(some), 64):  # a few texts at a time bound the bit matrix
        docs = some[k:k + 64]
        a, b = lo[docs[0]], lo[docs[-1] + 1]
        sums = np.zeros((len(docs), 64), np.int64)
        for c in range(a, b, 1 << 17):
            d = min(b, c + (1 << 17))
            bits = np.unpackbits(hashes[c:d].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            cut = np.clip(lo[docs], c, d) - c
            has = (np.clip(lo[docs + 1], c, d) - c) > cut
            sums[has] += np.add.reduceat(bits, cut[has], axis=0, dtype=np.int32)
        on = (2 * sums > count[docs][:, None]).astype(np.uint8)
        out[docs] = np.packbits(on, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def with_fingerprint(docs: DataFrame, shingle: int = 3, seed: int = 42, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the fingerprint of ``text`` (a column or a field of a struct) as a signed long
    ``fp``, which must not be there yet."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, text):
            fp = pa.array(_simhash(data, offsets, shingle, seed).view(np.int64))
            yield pa.RecordBatch.from_arrays([*rows.columns, fp], names=[*names, "fp"])

    return docs.mapInArrow(run, docs.select("*", F.lit(0).cast("long").alias("fp")).schema)


def choose_parts(sample: np.ndarray, n: float, distance: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] whose estimated cost over ``n`` fingerprints is least; thresholds below 0 are left out."""
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    dev = bits.std(0)
    corr = np.abs(np.nan_to_num(np.cov(bits.T) / np.maximum(np.outer(dev, dev), 1e-12))) if len(sample) > 2 else np.eye(64)
    pairs = sample[:, None] ^ sample[None, :]
    pairs = pairs[np.triu_indices(len(sample), 1)]
    best: tuple[float, list] = (math.inf, [])
    for m in range(1, distance + 2):
        free, parts = set(range(64)), []
        for i in range(m):
            size = len(free) // (m - i)
            seed = max(free, key=lambda b: (dev[b], -b))
            group = sorted(free, key=lambda b: (b != seed, -corr[seed, b], b))[:size]
            parts.append(sorted(group))
            free -= set(group)
        cost = []
        for part in parts:
            mask = np.uint64(sum(1 << b for b in part))
            d = np.bitwise_count(pairs & mask)
            w, row = len(part), {-1: 0.0}
            for t in range(distance + 1):
                ball = sum(math.comb(w, k) for k in range(t + 1))
                p = max(float((d <= t).mean()) if len(d) else 0.0, ball / 2.0 ** w)
                row[t] = n * n / 2 * p + PROBE_COST * n * ball
            cost.append(row)
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for row in cost:
            step: dict[int, tuple[float, list[int]]] = {}
            for used, (c, ts) in table.items():
                for t, x in row.items():
                    if used + t not in step or c + x < step[used + t][0]:
                        step[used + t] = (c + x, [*ts, t])
            table = step
        total, ts = table[distance - m + 1]
        if total < best[0]:
            best = (total, [(p, t) for p, t in zip(parts, ts) if t >= 0])
    return best[1]


def _signatures(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(part, sig, probe, fp): the signature of each part, and those within its threshold as probes."""
    masks, spread = [], []
    for i, (bits, t) in enumerate(parts):
        for k in range(t + 1):
            for flip in combinations(bits, k):
                masks.append((i, sum(1 << b for b in bits), sum(1 << b for b in flip), k > 0))
    signed = [(i, a - (1 << 64) if a >> 63 else a, f - (1 << 64) if f >> 63 else f, p) for i, a, f, p in masks]
    for lo in range(0, len(signed), 500):
        spread.append(F.array(*[F.struct(F.lit(i).alias("part"), F.lit(a).cast("long").alias("mask"),
                                         F.lit(f).cast("long").alias("flip"), F.lit(p).alias("probe"))
                                for i, a, f, p in signed[lo:lo + 500]]))
    x = fps.select("fp", F.explode(F.concat(*spread) if len(spread) > 1 else spread[0]).alias("x"))
    return x.select("x.part", F.col("fp").bitwiseAND(F.col("x.mask")).bitwiseXOR(F.col("x.flip")).alias("sig"),
                    "x.probe", "fp")


def _verify(distance: int):
    """Sorted rows of one partition -> a spanning forest of the verified links of each run of whole groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def work(table: np.ndarray) -> pa.RecordBatch | None:
            fp = table[:, -1].view(np.uint64)
            probe, side = table[:, -3], table[:, -2]
            new = np.ones(len(table), bool)
            new[1:] = (table[1:, :-3] != table[:-1, :-3]).any(1)
            cut = np.flatnonzero(np.append(new, True))
            end = np.repeat(cut[1:], np.diff(cut))
            two = np.repeat(np.maximum.reduceat(side, cut[:-1]) != np.minimum.reduceat(side, cut[:-1]), np.diff(cut))
            us, vs, k, size = [], [], 0, 0
            idx = np.arange(len(table))
            while len(idx):
                k += 1
                idx = idx[end[idx] > idx + k]
                j = idx + k
                near = np.bitwise_count(fp[idx] ^ fp[j]) <= distance
                near &= (probe[idx] + probe[j] < 2) & (~two[idx] | (side[idx] != side[j])) & (fp[idx] != fp[j])
                if near.any():
                    us.append(fp[idx[near]].view(np.int64))
                    vs.append(fp[j[near]].view(np.int64))
                    size += len(us[-1])
                    if size > 1 << 20:
                        u, v = forest(np.concatenate(us), np.concatenate(vs))
                        us, vs, size = [u], [v], 0
            if not us:
                return None
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([c.cast(pa.int64()).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1))
            rows += batch.num_rows
            if rows >= 1 << 16:
                table = np.concatenate(held)
                new = np.flatnonzero((table[1:, :-3] != table[:-1, :-3]).any(1))
                if len(new):  # the last group may go on in the next batch
                    out = work(table[:new[-1] + 1])
                    held, rows = [table[new[-1] + 1:]], len(table) - new[-1] - 1
                    if out is not None:
                        yield out
                else:
                    held = [table]
        if held and rows:
            out = work(np.concatenate(held))
            if out is not None:
                yield out
    return run


def near_links(fps: DataFrame, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) that span the components of distinct fingerprints ``fp`` at most ``distance`` bits apart."""
    sample = [r[0] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    n = fps.count()
    if n < 2:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).where("false")
    parts = choose_parts(np.array(sample, np.int64).view(np.uint64), n, distance)
    sigs = _signatures(fps, parts)
    # a signature that very many share is compared block by block
    large = written(sigs.groupBy("part", "sig").count().where(F.col("count") > bucket)
                    .select("part", "sig", F.ceil(F.col("count") / bucket).cast("long").alias("blocks")), "simhash-large")
    rows = sigs.join(large, ["part", "sig"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    rows = rows.withColumn("own", F.coalesce(own, F.lit(0).cast("long")))
    rows = rows.withColumn("other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long")))
                                              .otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    keys = ["part", "sig", "lo", "hi"]
    rows = rows.select(F.col("part").cast("long").alias("part"), "sig", F.least("own", "other").alias("lo"),
                       F.greatest("own", "other").alias("hi"), F.col("probe").cast("long").alias("probe"),
                       F.col("own").alias("side"), "fp")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_verify(distance), "u long, v long")


def _labelled(docs: DataFrame, shingle: int, distance: int, bucket: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` with fp in place of text and, for every distinct fp, its component's label."""
    rows = written(with_fingerprint(docs, shingle).drop("text"), "simhash-fp")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    linked = components(near_links(classes.select("fp"), distance, bucket), "simhash-components")
    label = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("label"))
    return rows, written(label, "simhash-labels")


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) for every row: fingerprint and smallest doc_id reachable by links."""
    rows, label = _labelled(docs.select("doc_id", "text"), shingle, distance, bucket)
    least = label.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = written(label.join(least, "label").select("fp", "component_id"), "simhash-classes")
    return rows.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One document of each component: that with the smallest doc_id, with all its columns.

    A component without any doc_id keeps the row with the smallest fingerprint;
    of repeated rows the one whose text hashes lowest stays.
    """
    hashed = F.xxhash64("text").alias("th")
    rows, label = _labelled(docs.select("doc_id", "text", hashed), shingle, distance, BUCKET)
    none, number = F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id")
    keep = label.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull().alias("none"),
                                                     F.coalesce("rep", F.lit(0)).alias("id"), "fp")).alias("x")).select("x.*")
    # the kept row of each component, by what the table itself tells: no fingerprint is computed twice
    keep = rows.select(none, number, "fp", "th").join(keep, ["none", "id", "fp"]).groupBy("none", "id", "fp").agg(F.min("th").alias("th"))
    names = ["none", "id", "th"]
    keep = written(keep.select(*names), "simhash-kept")
    texts = docs.select(F.struct("*").alias("row"), none, number, hashed)
    first = F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(1)))
    return texts.join(keep, names, "left_semi").withColumn("n", first).where("n = 1").select("row.*")
