"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes: each step shifts it left by one and adds the
byte's table value, so in 16 bits it depends on the last 16 bytes only.  A chunk
ends where a character does and the hash is the least of all places up to ``least``
bytes before and after; places after white space go before all others, so those
decide only in text that has no white space for that long (Chinese, base64).  An end
depends on the bytes around it alone, not on the ends before it, so chunks after
an insertion, or of a passage in other surroundings, are in step at once.  Where no
such place comes within ``most`` bytes (one character repeated) the chunk ends
there, between characters.  Of chunks with one digest the first
(smallest doc_id, furthest left) stays.  Runs of later copies are removed if
they have ``run`` bytes or more, or make up the whole document.

Defined cases: a null or empty text has no chunks; null doc_ids come last; rows
of one doc_id follow each other by text hash, identical rows are copies of the
first; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import LAST_ID, WORD_BREAKS, keyed, text_slices, written
from stratum.llm.substrings import ROWS, SLICE, combine, sift

LEAST, MOST, RUN = 16, 512, 100
_NEVER = 0xFFFFFFFF


def gear_table(seed: int = 0) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 16, 256, dtype=np.uint16)


def _least_of(v: np.ndarray, width: int) -> np.ndarray:
    """The least of v[i] ... v[i + width - 1] for every i; places beyond the end count as _NEVER."""
    v = np.concatenate([v, np.full(width, _NEVER, v.dtype)])
    size = 1
    while 2 * size <= width:
        v = np.minimum(v, np.concatenate([v[size:], np.full(size, _NEVER, v.dtype)]))
        size *= 2
    n = len(v) - width
    return np.minimum(v[:n], v[width - size:width - size + n])


def cut(data: np.ndarray, offsets: np.ndarray, least: int = LEAST, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every chunk of the texts, in order."""
    n = len(data)
    h = gear_table()[data]
    for w in (1, 2, 4, 8):
        grown = h.copy()
        grown[w:] += h[:-w] << np.uint16(w)
        h = grown
    space = np.zeros(256, bool)
    space[list(WORD_BREAKS)] = True
    rank = np.full(n + 1, _NEVER, np.uint32)  # of an end before each byte
    if n:
        rank[1:n] = h[:-1].astype(np.uint32) + np.where(space[data[:-1]], 0, 1 << 16).astype(np.uint32)
        rank[:n][data & 0xC0 == 0x80] = _NEVER
    # near its start a text has no ends: their hashes and neighbours would lie in the text before
    reach = max(least, 16)
    near = np.zeros(n + 2, np.int64)
    np.add.at(near, offsets[:-1], 1)
    np.add.at(near, np.minimum(offsets[:-1] + reach, n + 1), -1)
    rank[np.cumsum(near)[:n + 1] > 0] = _NEVER
    ahead = _least_of(rank, least)
    before = np.full(n + 1, _NEVER, np.uint32)
    before[least:] = ahead[:max(0, n + 1 - least)]
    after = np.full(n + 1, _NEVER, np.uint32)
    after[:-1] = ahead[1:]
    places = np.flatnonzero((rank != _NEVER) & (rank < before) & (rank <= after))
    bounds = np.unique(np.concatenate([places, offsets]))
    far = np.flatnonzero(np.diff(bounds) > most)
    extra = []
    for lo, hi in zip(bounds[far].tolist(), bounds[far + 1].tolist()):
        while hi - lo > most:
            lo += most
            while data[lo] & 0xC0 == 0x80:
                lo -= 1
            extra.append(lo)
    bounds = np.unique(np.concatenate([bounds, np.array(extra, np.int64)]))
    return bounds[:-1], bounds[1:]


def _scan(least: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, limit=SLICE):
            start, end = cut(data, offsets, least, most)
            if not len(start):
                continue
            raw, digest = data.tobytes(), hashlib.blake2b
            d = np.frombuffer(b"".join([digest(raw[a:b], digest_size=16).digest()
                                        for a, b in zip(start.tolist(), end.tolist())]), np.uint64).reshape(-1, 2)
            doc = np.searchsorted(offsets, start, "right") - 1
            k, twin = (rows.column(i).to_numpy()[doc] for i in (0, 1))
            yield combine(d[:, 0], d[:, 1], k, twin, start - offsets[doc], end - start, np.zeros(len(start), np.int64), 0)
    return run


def _finish(run_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, raw, spans in zip(*(c.to_pylist() for c in batch.columns)):
                merged: list[list[int]] = []
                for s in sorted((s["a"], s["b"]) for s in spans or []):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                merged = [s for s in merged if s[1] - s[0] >= min(run_bytes, len(raw))]
                kept, at = [], 0
                for a, b in merged:
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                out.append((k, len(raw), sum(b - a for a, b in merged), len(merged), b"".join(kept).decode()))
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)],
                                             names=["k", "n_bytes", "n_removed", "n_spans", "text"])
    return run


def dedup_chunks(docs: DataFrame, least: int = LEAST, most: int = MOST, run: int = RUN) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, text) for every row of (doc_id, text); text is what is left.

    Equal chunks of a slice are combined before the one shuffle by digest, so a
    chunk that every document holds reaches its task once a slice.
    """
    base, keys = keyed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    base = base.select("k", "twin", "text")
    rows = base.mapInArrow(_scan(least, most), ROWS)
    rows = rows.repartition("hash").sortWithinPartitions("hash", "seg", "k", "twin", "pos")
    later = rows.mapInArrow(sift(0), "kind long, hash long, k long, twin long, pos long, last long, lead long")
    later = written(later.where("kind = 0").select("k", "twin", F.col("pos").alias("a"), F.col("last").alias("b")), "chunk-copies")
    per = later.groupBy(*keys).agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    texts = base.select(*keys, F.col("text").cast("binary").alias("raw")).join(per.hint("merge"), keys, "left").select("k", "raw", "spans")
    out = texts.mapInArrow(_finish(run), "k long, n_bytes long, n_removed long, n_spans long, text string")
    return out.select(F.when(F.col("k") != LAST_ID, F.col("k")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "text")
