"""Cost-balanced packing of documents into fixed-length training sequences.

A piece of l tokens costs ``linear * l + quadratic * l * l`` (attention stays
within a document).  Each task packs its documents window by window: whole
sequences are cut from long documents, the remaining pieces go, longest first,
to the sequence of lowest cost that still has room for them.  A piece that fits
nowhere is cut to fill the cheapest sequence with room.  What is left over,
less than one sequence a window, fills sequences whose lengths are powers of
two, so nothing is padded.

Defined cases: a null or empty text is a document of the end id alone; repeated
rows are documents of their own; a null doc_id is passed on; a text of any
length is cut as often as needed; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from stratum.llm.common import text_slices
from stratum.llm.tokens import encoder

WINDOW = 1 << 20      # tokens that are packed together; bounds a task's memory
SLICE = 2 << 20       # bytes of text that are encoded together
SEQUENCE_BITS = 40    # sequences of one partition that an id can tell apart


def place(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> tuple[np.ndarray, int]:
    """Pieces as rows (document, start, length, sequence, offset), and the number of sequences."""
    pieces: list[tuple[int, int, int, int, int]] = []
    full = lengths // capacity
    sequence = 0
    for d in np.flatnonzero(full).tolist():
        for k in range(int(full[d])):
            pieces.append((d, k * capacity, capacity, sequence, 0))
            sequence += 1
    rest = lengths - full * capacity
    order = np.argsort(-rest, kind="stable")
    order = order[rest[order] > 0].tolist()
    bins = int(rest.sum()) // capacity
    room = np.full(bins, capacity, np.int64)
    cost = np.zeros(bins)
    spare: list[tuple[int, int, int]] = []
    for d in order:
        start, left = int(full[d]) * capacity, int(rest[d])
        while left and bins:
            fits = room >= left
            some = fits if fits.any() else room > 0
            if not some.any():
                break
            b = int(np.where(some, cost, np.inf).argmin())
            n = min(left, int(room[b]))
            pieces.append((d, start, n, sequence + b, capacity - int(room[b])))
            room[b] -= n
            cost[b] += linear * n + quadratic * n * n
            start, left = start + n, left - n
        if left:
            spare.append((d, start, left))
    sequence += bins
    left = sum(n for _, _, n in spare)
    room_left, offset = 0, 0
    for d, start, n in spare:
        while n:
            if not room_left:
                room_left, offset = 1 << (left.bit_length() - 1), 0
                left -= room_left
                sequence += 1
            m = min(n, room_left)
            pieces.append((d, start, m, sequence - 1, offset))
            start, n, room_left, offset = start + m, n - m, room_left - m, offset + m
    return np.array(pieces, np.int64).reshape(-1, 5), sequence


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, capacity: int = 4096,
                   linear: float = 1.0, quadratic: float = 1.0 / 1024, with_ids: bool = False) -> DataFrame:
    """One row per piece of the documents (doc_id, text).

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_tokens; ``with_ids`` adds the piece's ids as little-endian unsigned
    32-bit integers.  A sequence is padded to ``capacity`` unless its length is a
    power of two.  Packing needs no shuffle: every task packs what it reads.
    """
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens"]

    def emit(held: list[tuple[int | None, bytes]], base: int) -> tuple[pa.RecordBatch, int]:
        lengths = np.array([len(b) // 4 for _, b in held], np.int64)
        p, n = place(lengths, capacity, linear, quadratic)
        doc = p[:, 0].tolist()
        cuts = [held[d][1][4 * s:4 * (s + m)] for d, s, m in zip(doc, p[:, 1].tolist(), p[:, 2].tolist())]
        size = np.bincount(p[:, 3], weights=p[:, 2], minlength=n).astype(np.int64)
        cols = [pa.array([held[d][0] for d in doc], pa.int64()), pa.array(p[:, 1]), pa.array(p[:, 2]),
                pa.array([zlib.crc32(c) for c in cuts], pa.int64()), pa.array(lengths[p[:, 0]]),
                pa.array(base + p[:, 3]), pa.array(p[:, 4]), pa.array(size[p[:, 3]])]
        if with_ids:
            cols.append(pa.array(cuts, pa.binary()))
        return pa.RecordBatch.from_arrays(cols, names=names + ["ids"] * with_ids), base + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        base = TaskContext.get().partitionId() << SEQUENCE_BITS
        held: list[tuple[int | None, bytes]] = []
        tokens = 0
        for rows, data, offsets in text_slices(batches, limit=SLICE):
            ids, edge = enc.encode(data, offsets)
            raw = ids.astype("<u4").tobytes()
            for i, a, b in zip(rows.column(0).to_pylist(), edge[:-1].tolist(), edge[1:].tolist()):
                held.append((i, raw[4 * a:4 * b] + end))
                tokens += b - a + 1
                if tokens >= WINDOW:
                    out, base = emit(held, base)
                    held, tokens = [], 0
                    yield out
        if held:
            yield emit(held, base)[0]

    schema = ", ".join(f"{n} long" for n in names) + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)
