"""Exact removal of repeated byte strings by column-wise collection transforms.

Every byte covered by a string of ``length`` bytes that also starts earlier
(smaller doc_id, or further left in the same document) is removed.

1. Anchors.  Each window of ``length`` bytes owns the smallest-hashed k-mer in
   it, leftmost first, so equal windows own equal anchors at the same place.
   Neighbouring windows with one anchor form a segment.  Only segments whose
   anchor occurs again can repeat; of equal segments the first is kept and the
   windows of the others are marked at once (per slice of a task, then per key).
2. Columns.  The different segments of an anchor are a collection of documents
   aligned at it.  From the right, each round inserts one symbol of every
   document: a stable sort by symbol takes the transform's order of one column
   to the next, and the common prefix of neighbours grows by one or falls to
   zero.  Windows whose neighbours share ``length`` bytes or more form an
   interval of equal strings; all but its first are marked.  Collections come
   in order of their anchor from sequential shuffle files and are worked off in
   runs of bounded size, so slices of the transform never meet in memory.
3. An anchor that more than HOT different segments share is taken apart:
   its windows are grouped by digest, with a partial aggregation.

Defined cases: a null or empty text has no bytes; null doc_ids come after all
others; rows of one doc_id follow each other by text hash; of identical rows one
is the first and the others repeat it; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import HASH_BASE, LAST_ID, keyed, mix, span_hashes, text_slices, written

KMER = 32
HOT = 4096
SLICE = 4 << 20       # bytes of text whose equal segments are combined before the shuffle
RUN = 1 << 15         # segments whose columns are built together, unless one anchor has more
_STEP = 1 << 19
def segments(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (document, first window, last window, anchor, anchor hash, segment hash).

    Positions count from the start of ``data``.  Memory is bounded by steps of
    the windows; a run cut by a step is two segments.
    """
    width = length - KMER + 1
    found: list[tuple[np.ndarray, ...]] = []
    for lo in range(0, max(0, len(data) - length + 1), _STEP):
        part = data[lo:lo + _STEP + length - 1]
        if len(part) < length:
            break
        h, w, b = part.astype(np.uint64) + np.uint64(1), 1, HASH_BASE
        while w < KMER:
            h = h[:-w] * np.uint64(b) + h[w:]
            w, b = 2 * w, b * b % (1 << 64)
        h = mix(h)
        tag = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        w = 1
        while 2 * w <= width:
            tag = np.minimum(tag[:-w], tag[w:])
            w *= 2
        if w < width:
            tag = np.minimum(tag[:w - width], tag[width - w:])
        at = (tag & np.uint64((1 << 20) - 1)).astype(np.int64)
        start = np.arange(len(at))
        doc = np.searchsorted(offsets, start + lo, "right") - 1
        fine = start + lo + length <= offsets[doc + 1]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new & fine)
        stop = np.flatnonzero(fine & np.append((new | ~fine)[1:], True))
        seg = span_hashes(part, first, stop + length)
        found.append((doc[first], first + lo, stop + lo, at[first] + lo, h[at[first]], seg))
    if not found:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


_MARKS = "k long, twin long, a long, b long"
ROWS = "hash long, seg long, k long, twin long, pos long, last int, lead int"


def combine(h: np.ndarray, seg: np.ndarray, k: np.ndarray, twin: np.ndarray, pos: np.ndarray, size: np.ndarray,
            lead: np.ndarray, length: int) -> pa.RecordBatch:
    """Rows as in ROWS: the first of each equal (h, seg) of a slice, and the joined spans of its later copies (last -1, seg the end)."""
    order = np.lexsort((pos, twin, k, seg, h))
    h, seg, k, twin, pos, size, lead = (x[order] for x in (h, seg, k, twin, pos, size, lead))
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (seg[1:] != seg[:-1])
    later = ~new
    a, b, dk, dt = joined(k[later], twin[later], pos[later], (pos + size)[later] + length)
    none = np.full(len(a), -1, np.int64)
    cols = [np.concatenate([h[new].view(np.int64), mix((a * 31 + dk).view(np.uint64)).view(np.int64)]),
            np.concatenate([seg[new].view(np.int64), b]), np.concatenate([k[new], dk]), np.concatenate([twin[new], dt]),
            np.concatenate([pos[new], a]), np.concatenate([size[new], none]), np.concatenate([lead[new], 0 * none])]
    kinds = [np.int64] * 5 + [np.int32] * 2
    return pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(cols, kinds)],
                                      names=["hash", "seg", "k", "twin", "pos", "last", "lead"])


def _scan(length: int):
    """Segments of each slice, equal ones combined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, limit=SLICE):
            doc, first, stop, at, h, seg = segments(data, offsets, length)
            if len(doc):
                k, twin = (rows.column(i).to_numpy()[doc] for i in (0, 1))
                yield combine(h, seg, k, twin, first - offsets[doc], stop - first, at - first, length)
    return run


def joined(k: np.ndarray, twin: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping or touching spans of each document as one: (from, to, k, twin)."""
    if not len(a):
        return a, b, k, twin
    order = np.lexsort((a, twin, k))
    k, twin, a, b = k[order], twin[order], a[order], b[order]
    other = np.ones(len(a), bool)
    other[1:] = (k[1:] != k[:-1]) | (twin[1:] != twin[:-1])
    group = np.cumsum(other)
    shift = group * (int(b.max()) + 1)
    reach = np.maximum.accumulate(b + shift) - shift
    new = other.copy()
    new[1:] |= a[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return a[first], reach[np.append(first[1:], len(a)) - 1], k[first], twin[first]


def sift(length: int):
    """Rows sorted by (hash, seg, k, twin, pos): spans of later copies, and the first of each segment whose anchor has others.

    Output rows have kind 0 (a span: pos, last as its end) or 1 (a segment).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None   # the first row of the current segment, which may still turn out alone
        alone = True
        for batch in batches:
            if not batch.num_rows:
                continue
            t = np.stack([c.cast(pa.int64()).to_numpy() for c in batch.columns], axis=1)
            span = t[:, 5] < 0
            spans = t[span]
            t = t[~span]
            out = [np.column_stack([np.zeros(len(spans), np.int64), spans[:, [0, 2, 3, 4, 1, 6]]])]
            if len(t):
                if held is not None:
                    t = np.concatenate([held[None, :], t])
                new = np.ones(len(t), bool)
                new[1:] = (t[1:, 0] != t[:-1, 0]) | (t[1:, 1] != t[:-1, 1])
                head = np.flatnonzero(new)[np.cumsum(new) - 1]
                copy = ~new & (t[:, 2:5] != t[head][:, 2:5]).any(1)
                c = t[copy]
                out.append(np.column_stack([np.zeros(len(c), np.int64), c[:, [0, 2, 3, 4]], c[:, 4] + c[:, 5] + length, c[:, 6]]))
                f = t[new]
                prev = np.zeros(len(f), bool)
                prev[1:] = f[1:, 0] == f[:-1, 0]
                prev[0] = held is not None and not alone
                some = prev.copy()
                some[:-1] |= prev[1:]
                s = f[:-1][some[:-1]]
                out.append(np.column_stack([np.ones(len(s), np.int64), s[:, [0, 2, 3, 4, 5, 6]]]))
                held, alone = f[-1], not some[-1]
            yield _sifted(np.concatenate(out))
        if held is not None and not alone:
            yield _sifted(np.array([[1, *held[[0, 2, 3, 4, 5, 6]]]]))
    return run


def _sifted(t: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(t[:, i])) for i in range(7)],
                                      names=["kind", "hash", "k", "twin", "pos", "last", "lead"])


def repeated_windows(group: np.ndarray, text: np.ndarray, begin: np.ndarray, end: np.ndarray, rank: np.ndarray,
                     length: int) -> np.ndarray:
    """Columns at which a document's window also starts in a document of its group with a smaller rank.

    ``text`` has a row for each document and a column for each place relative to
    the anchor; a document fills columns ``begin`` up to ``end``.  Returns a
    matrix of booleans, one column for each place up to the last first column.
    """
    n, width = text.shape
    marked = np.zeros((n, int(begin.max()) + width - length + 1 if n else 0), bool)
    order = np.zeros(0, np.int64)
    lcp = np.zeros(0, np.int64)
    ends = np.argsort(end, kind="stable")
    upto = np.searchsorted(end[ends], np.arange(width + 2))
    for c in range(width - 1, -1, -1):
        fresh = ends[upto[c + 1]:upto[c + 2]]        # documents whose last symbol is here: so far the empty suffix
        order = np.concatenate([fresh, order])
        lcp = np.concatenate([np.zeros(len(fresh), np.int64), lcp])
        if not len(order):
            continue
        live = begin[order] <= c
        key = np.where(live, group[order] * 256 + text[order, c], np.iinfo(np.int64).max)
        perm = np.argsort(key, kind="stable")[:int(live.sum())]
        key = key[perm]
        grown = np.zeros(len(perm), np.int64)
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        i, j = perm[same - 1], perm[same]
        grown[same] = lcp[j] + 1
        far = j > i + 1
        if far.any():
            cuts = np.column_stack([i[far] + 1, j[far] + 1]).ravel()
            grown[same[far]] = np.minimum.reduceat(np.append(lcp, 0), cuts)[::2] + 1
        order, lcp = order[perm], grown
        if c < marked.shape[1] and len(order):
            new = lcp < length
            first = np.flatnonzero(new)
            least = np.minimum.reduceat(rank[order], first)[np.cumsum(new) - 1]
            later = rank[order] != least
            marked[order[later], c] = True
    return marked


def _columns(length: int):
    """Rows (hash, k, twin, pos, lead, bytes) sorted by hash -> marked spans (k, twin, a, b)."""
    reach = length - KMER

    def work(rows: pa.Table) -> pa.RecordBatch:
        h, k, twin, pos, lead = (rows.column(i).combine_chunks().to_numpy().astype(np.int64) for i in range(5))
        blob = rows.column(5).combine_chunks().cast(pa.large_binary())
        edge = np.frombuffer(blob.buffers()[1], np.int64)[blob.offset:blob.offset + len(blob) + 1]
        raw = np.frombuffer(blob.buffers()[2], np.uint8)
        size = np.diff(edge)
        group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
        begin = reach - lead
        text = np.zeros((len(h), reach + length), np.int64 if len(h) < 64 else np.uint8)
        row = np.repeat(np.arange(len(h)), size)
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        text[row, begin[row] + inner] = raw[edge[0]:edge[-1]]
        rank = np.empty(len(h), np.int64)
        rank[np.lexsort((pos + lead, twin, k))] = np.arange(len(h))
        marked = repeated_windows(group, text, begin, begin + size, rank, length)
        edge2 = np.zeros((len(h), marked.shape[1] + 2), np.int8)
        edge2[:, 1:-1] = marked
        turn = np.diff(edge2, axis=1)
        i, a = np.nonzero(turn == 1)
        _, b = np.nonzero(turn == -1)
        at = pos[i] + lead[i] - reach
        return pa.RecordBatch.from_arrays([pa.array(k[i]), pa.array(twin[i]), pa.array(at + a), pa.array(at + b - 1 + length)],
                                          names=["k", "twin", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= RUN:
                table = pa.Table.from_batches(held)
                h = table.column(0).to_numpy()
                new = np.flatnonzero(h[1:] != h[:-1])
                if len(new):
                    cut = int(new[-1]) + 1
                    yield work(table.slice(0, cut))
                    held, size = table.slice(cut).to_batches(), size - cut
        if size:
            yield work(pa.Table.from_batches(held))
    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for k, raw, spans in zip(*(c.to_pylist() for c in batch.columns)):
            merged: list[list[int]] = []
            for s in sorted((s["a"], s["b"]) for s in spans or []):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            digest, at = hashlib.sha256(), 0
            for a, b in merged:
                digest.update(raw[at:a])
                at = b
            digest.update(raw[at:])
            out.append((k, len(raw), sum(b - a for a, b in merged), merged, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
             pa.array([x[2] for x in out], pa.int64()),
             pa.array([[{"a": a, "b": b} for a, b in x[3]] for x in out], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
             pa.array([x[4] for x in out], pa.string())], names=["k", "n_bytes", "n_removed", "spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, length: int = 100, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256) for every row of (doc_id, text).

    ``spans`` are the removed runs as (a, b), byte positions from a up to b;
    ``length`` must be over 32.
    """
    base, keys = keyed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    base = base.select("k", "twin", "text")
    rows = base.mapInArrow(_scan(length), ROWS)
    rows = rows.repartition("hash").sortWithinPartitions("hash", "seg", "k", "twin", "pos")
    sifted = written(rows.mapInArrow(sift(length), "kind long, hash long, k long, twin long, pos long, last long, lead long"),
                     "repeats-anchors")
    spans = sifted.where("kind = 0").select("k", "twin", F.col("pos").alias("a"), F.col("last").alias("b"))
    need = sifted.where("kind = 1")
    many = written(need.groupBy("hash").count().where(F.col("count") > hot).select("hash", F.lit(True).alias("hot")), "repeats-hot")
    need = need.join(many, "hash", "left")
    wanted = need.groupBy(*keys).agg(F.collect_list(F.struct("hash", "pos", "last", "lead", "hot")).alias("want"))
    texts = base.select(*keys, F.col("text").cast("binary").alias("raw"))
    cut = texts.join(wanted, keys).select(*keys, F.explode(F.transform("want", lambda x: F.struct(
        x["hash"].alias("hash"), x["pos"].alias("pos"), x["lead"].cast("long").alias("lead"), x["hot"].alias("hot"),
        F.substring(F.col("raw"), (x["pos"] + 1).cast("int"), (x["last"] + length).cast("int")).alias("bytes")))).alias("x"))
    cut = written(cut.select("k", F.col("twin") if "twin" in keys else F.lit(0).cast("long").alias("twin"), "x.*"), "repeats-segments")
    plain = cut.where("hot IS NULL").select("hash", "k", "twin", "pos", "lead", "bytes")
    marks = plain.repartition("hash").sortWithinPartitions("hash").mapInArrow(_columns(length), _MARKS)
    # windows of anchors with very many segments
    windows = cut.where("hot").select("k", "twin", F.explode(F.transform(
        F.sequence(F.lit(0), F.length("bytes") - length), lambda i: F.struct(
            (F.col("pos") + i).alias("a"), F.unhex(F.md5(F.substring(F.col("bytes"), i + 1, F.lit(length)))).alias("digest")))).alias("x")) \
        .select("k", "twin", "x.*")
    first = written(windows.groupBy("digest").agg(F.min(F.struct("k", "twin", "a")).alias("first"), F.count("*").alias("n"))
                    .where("n > 1").select("digest", "first"), "repeats-windows")
    later = windows.join(first, "digest").where(F.struct("k", "twin", "a") != F.col("first")) \
        .select("k", "twin", "a", (F.col("a") + length).alias("b"))
    marks = written(spans.union(marks).union(later), "repeats-marks")
    per = marks.groupBy(*keys).agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    rows = texts.join(per, keys, "left").select("k", "raw", "spans")
    kind = "k long, n_bytes long, n_removed long, spans array<struct<a: long, b: long>>, kept_sha256 string"
    return rows.mapInArrow(_finish, kind).select(F.when(F.col("k") != LAST_ID, F.col("k")).alias("doc_id"),
                                                 "n_bytes", "n_removed", "spans", "kept_sha256")
