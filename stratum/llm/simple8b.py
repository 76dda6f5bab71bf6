"""Token files: Simple-8b words with escapes and block offsets.

A word of 64 bits holds a selector in its top 4 bits and 60 bits of payload:
as many values of one width as fit.  A file is a Parquet table, so any store
that Spark writes will do; its rows are segments of whole documents in order:

    header    4 bytes "S8B1", then unsigned 32-bit: ids, ids a block, words,
              escapes, ranks
    ranks     unsigned 32-bit: the segment's distinct ids, most frequent first
    offsets   unsigned 32-bit: first word and first escape of each block
    words     unsigned 64-bit, little-endian
    escapes   unsigned 32-bit

Words hold ranks, not ids, so that frequent ids are narrow.  A value of all ones
is an escape: the rank is the block's next entry in the list of escapes.  Ranks
above a limit, chosen for each segment by the estimated size, are escaped.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import text_slices, written
from stratum.llm.tokens import encoder

# Bits of a value and values of a word, by selector.
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
COUNTS = 60 // WIDTHS
BLOCK = 256
SEGMENT = 1 << 20  # ids after which a segment ends, with its last document
SLICE = 2 << 20    # bytes of text that are encoded together
_MAGIC = b"S8B1"


def _ranks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, most frequent first; how often each occurs; the rank of every id."""
    if len(ids) and int(ids.max()) < 1 << 22:
        times = np.bincount(ids)
        distinct = np.flatnonzero(times)
        times, place = times[distinct], ids
        rank_of = np.zeros(int(ids.max()) + 1, np.uint32)
    else:
        distinct, place, times = np.unique(ids, return_inverse=True, return_counts=True)
        rank_of = np.zeros(len(distinct), np.uint32)
    order = np.argsort(-times, kind="stable")
    known = distinct[order] if place is ids else order
    rank_of[known] = np.arange(len(order), dtype=np.uint32)
    return distinct[order], times[order], rank_of[place] if len(ids) else np.zeros(0, np.uint32)


def _classes(times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every rank, from how often it occurs: its narrowest selector (0 if it is to be escaped), and whether it is."""
    limits = (1 << WIDTHS.astype(np.uint64)) - 1  # all ones is kept for escapes
    kind = np.searchsorted(limits.astype(np.float64), np.arange(len(times)), "right").astype(np.uint8)
    share = np.cumsum(np.bincount(kind, weights=times, minlength=len(WIDTHS))) / max(1, times.sum())
    cost = 64 / COUNTS + 32 * (1 - share)
    escape = kind > int(cost.argmin())
    kind[escape] = 0
    return kind, escape


def encode(ids: np.ndarray) -> bytes:
    """The segment that holds ``ids`` (unsigned 32-bit)."""
    ids = np.asarray(ids, np.uint32)
    distinct, times, ranks = _ranks(ids)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    kind, escape = (x[ranks] for x in _classes(times))
    # widest run of values that fits a selector, for every position of every block
    grid = np.zeros(blocks * BLOCK + COUNTS[0], np.uint8)
    grid[:n] = kind
    top, wide, choice = grid.copy(), 1, np.full(len(grid), len(WIDTHS) - 1, np.uint8)
    for s in range(len(WIDTHS) - 1, -1, -1):
        while wide < COUNTS[s]:
            step = min(wide, int(COUNTS[s]) - wide)
            top[:-step] = np.maximum(top[:-step], top[step:])
            wide += step
        np.copyto(choice, np.uint8(s), where=top <= s)
    # follow the words of all blocks at once
    at = np.arange(blocks) * BLOCK
    stop = np.minimum(at + BLOCK, n)
    row, starts, rows = np.arange(blocks), [], []
    while len(row):
        starts.append(at)
        rows.append(row)
        at = at + COUNTS[choice[at]]
        live = at < stop[row]
        at, row = at[live], row[live]
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    block = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    start = start[np.argsort(start, kind="stable")]
    per = np.bincount(block, minlength=blocks)
    padded = np.zeros(len(grid), np.uint64)
    padded[:n] = ranks
    ones = np.zeros(len(grid), bool)
    ones[:n] = escape
    words = np.zeros(len(start), np.uint64)
    sel = choice[start]
    for s in range(len(WIDTHS)):
        w = np.flatnonzero(sel == s)
        if not len(w):
            continue
        width, value = np.uint64(WIDTHS[s]), np.full(len(w), s, np.uint64) << np.uint64(60)
        mask = (np.uint64(1) << width) - np.uint64(1)
        end = np.minimum((start[w] // BLOCK + 1) * BLOCK, n)
        for k in range(int(COUNTS[s])):
            p = start[w] + k
            v = np.where(ones[p], mask, padded[p])
            value |= np.where(p < end, v, np.uint64(0)) << (np.uint64(k) * width)
        words[w] = value
    escapes = ranks[escape]
    first_word = np.concatenate([[0], np.cumsum(per)[:-1]]) if blocks else np.zeros(0)
    first_escape = np.searchsorted(np.flatnonzero(escape), np.arange(blocks) * BLOCK)
    return b"".join([_MAGIC, struct.pack("<5I", n, BLOCK, len(words), len(escapes), len(distinct)),
                     distinct.astype("<u4").tobytes(), first_word.astype("<u4").tobytes(),
                     first_escape.astype("<u4").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u4").tobytes()])


def decode(blob: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the blocks ``first`` up to but without ``last`` (all, if None)."""
    if blob[:4] != _MAGIC:
        raise ValueError("not a token segment")
    n, size, n_words, n_escapes, n_ranks = struct.unpack_from("<5I", blob, 4)
    blocks, at = -(-n // size), 24
    part = []
    for count, kind in ((n_ranks, "<u4"), (blocks, "<u4"), (blocks, "<u4"), (n_words, "<u8"), (n_escapes, "<u4")):
        part.append(np.frombuffer(blob, kind, count, at))
        at += part[-1].nbytes
    table, first_word, first_escape, words, escapes = part
    last = blocks if last is None else min(last, blocks)
    if first >= last:
        return np.zeros(0, np.uint32)
    word_edge = np.append(first_word, n_words).astype(np.int64)
    escape_edge = np.append(first_escape, n_escapes).astype(np.int64)
    words = words[word_edge[first]:word_edge[last]]
    sel = (words >> np.uint64(60)).astype(np.int64)
    # where each word's values go: after those of the words before it in its block
    held = COUNTS[sel]
    ends = np.cumsum(held)
    heads = word_edge[first:last] - word_edge[first]
    before = ends - held
    begin = before - np.repeat(before[heads], np.diff(word_edge[first:last + 1])) \
        + np.repeat(np.arange(last - first) * size, np.diff(word_edge[first:last + 1]))
    total = min(n, last * size) - first * size
    out = np.zeros((last - first) * size + int(COUNTS[0]), np.uint32)
    ones = np.zeros(len(out), bool)
    stop = np.repeat(np.minimum((np.arange(last - first) + 1) * size, total), np.diff(word_edge[first:last + 1]))
    for s in np.unique(sel):
        w = np.flatnonzero(sel == s)
        width = np.uint64(WIDTHS[s])
        mask = (np.uint64(1) << width) - np.uint64(1)
        for k in range(int(COUNTS[s])):
            p = begin[w] + k
            ok = p < stop[w]
            v = (words[w] >> (np.uint64(k) * width)) & mask
            out[p[ok]] = v[ok]
            ones[p[ok]] = v[ok] == mask
    out, ones = out[:total], ones[:total]
    out[ones] = escapes[escape_edge[first]:escape_edge[last]]
    return table[out].astype(np.uint32)


def write_token_files(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0) -> None:
    """Write every document's ids and the end id, in ascending doc_id order, as segments under ``path``.

    Columns: shard and segment (their order is the order of the ids), doc_ids
    and n_tokens of the segment's documents, ids (the encoded segment).  A null
    text is empty; null doc_ids come first; rows of one doc_id follow each other
    by text; documents never cross segments, so a very long one makes a large one.
    """
    end = np.uint32(end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        parts: list[np.ndarray] = []
        size = 0

        def segment() -> pa.RecordBatch:
            blob = encode(np.concatenate(parts))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([seq], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(p) for p in parts]], pa.list_(pa.int64())), pa.array([blob], pa.binary())],
                names=["shard", "segment", "doc_ids", "n_tokens", "ids"])

        for rows, data, offsets in text_slices(batches, limit=SLICE):
            tokens, edge = enc.encode(data, offsets)
            for i, a, b in zip(rows.column(0).to_pylist(), edge[:-1].tolist(), edge[1:].tolist()):
                ids.append(i)
                parts.append(np.append(tokens[a:b], end))
                size += b - a + 1
                if size >= SEGMENT:
                    yield segment()
                    seq, ids, parts, size = seq + 1, [], [], 0
        if parts:
            yield segment()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, "shard long, segment long, doc_ids array<long>, n_tokens array<long>, ids binary") \
        .write.option("parquet.block.size", 32 << 20).parquet(path)


def read_token_files(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; ``with_ids`` adds its ids."""
    names = ["shard", "segment", "doc_id", "from", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, seg, docs, sizes, blob = (c[row].as_py() for c in batch.columns)
                raw = decode(blob).astype("<u4").tobytes()
                edge = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                cuts = [raw[4 * a:4 * b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
                cols = [pa.array([shard] * len(docs), pa.int64()), pa.array([seg] * len(docs), pa.int64()),
                        pa.array(docs, pa.int64()), pa.array(edge[:-1]), pa.array(np.diff(edge)),
                        pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
                if with_ids:
                    cols.append(pa.array(cuts, pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=names + ["ids"] * with_ids)

    schema = "shard long, segment long, doc_id long, `from` long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    docs = files.select("shard", "segment", "doc_ids", "n_tokens", "ids").mapInArrow(run, schema)
    sizes = written(files.select("shard", "segment", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda s, x: s + x).alias("n")),
                    "token-sizes")
    # a shard's segments in one window; the shards, as many as write tasks, in another
    before = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    base = sizes.select("shard", "segment", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("inside")) \
        .join(shards, "shard").select("shard", "segment", (F.col("ahead") + F.col("inside")).alias("base"))
    return docs.join(base, ["shard", "segment"]).select(
        "doc_id", (F.col("base") + F.col("from")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
