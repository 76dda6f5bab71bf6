"""Near-duplicate embeddings with randomised-rotation binary codes.

A unit vector is rotated by a random orthogonal matrix and kept as the signs of
its components (its code) with f, the inner product of the vector and its code.
<code, q> / f estimates the inner product with q without bias; the error is at
most sqrt(1 - s^2) sqrt(1 - f^2) / f where s is the true value, so a pair at or
above the threshold t is estimated at t - sqrt(1 - t^2) sqrt(1 - f^2) / f or
more.  That is the confidence bound in use (it holds always): pairs below it
are no links, all others are computed again exactly in double precision.

Equal vectors are one class first.  Classes lie in blocks of bounded size; two
blocks whose centres are too far apart for any link are never compared.  A task
that compares two blocks returns link counts and a spanning forest, not pairs.

Defined cases: vectors that are null, zero, empty or hold null or non-finite
components link with nothing, nor do vectors of different lengths; a null
vec_id takes part and gets its component's smallest vec_id (null if there is
none); repeated rows link as equal vectors; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import components, forest, written
from stratum.llm.vectors import in_blocks, unit, usable

BLOCK = 4096
SLACK = 1e-4  # single-precision rounding of the estimates


def rotation(dim: int, seed: int = 0) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(m: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Binary codes (packed) of unit vectors and f, their inner products with the vectors."""
    r = m @ rotation(m.shape[1], seed)
    return np.packbits(r > 0, axis=1), np.abs(r).sum(1) / math.sqrt(m.shape[1])


def _raw(column: pa.ChunkedArray) -> bytes:
    """Components end to end, in single precision where they came so: blocks travel to every block near them."""
    values = column.combine_chunks().flatten()
    return values.to_numpy(zero_copy_only=False).astype("<f4" if pa.types.is_float32(values.type) else "<f8").tobytes()


def _units(raw: bytes, dim: int, rows: int) -> np.ndarray:
    wide = len(raw) == 8 * dim * rows
    return unit(np.frombuffer(raw, "<f8" if wide else "<f4").reshape(-1, dim).astype(np.float64))


def _pack(rows: pa.Table) -> pa.Table:
    dim = rows.column("dim")[0].as_py()
    order = rows.column("id").combine_chunks().to_numpy().argsort()
    rows = rows.take(pa.array(order))
    m = _units(raw := _raw(rows.column("v")), dim, rows.num_rows)
    codes, f = encode(m)
    centre = unit(m.mean(0)[None, :])[0]
    far = float(np.arccos(np.clip(m @ centre, -1, 1)).max())
    blob = [raw, codes.tobytes(), f.tobytes(), rows.column("id").combine_chunks().to_numpy().astype("<i8").tobytes(),
            rows.column("members").combine_chunks().to_numpy().astype("<i8").tobytes()]
    names = ["block", "dim", "centre", "radius", "m", "codes", "f", "ids", "members"]
    cols = [pa.array([rows.column("block")[0].as_py()]), pa.array([dim], pa.int32()),
            pa.array([centre.tolist()], pa.list_(pa.float64())), pa.array([far]), *[pa.array([b], pa.binary()) for b in blob]]
    return pa.table(cols, names=names)


_BLOCK_SCHEMA = ("block long, dim int, centre array<double>, radius double, m binary, codes binary, f binary, "
                 "ids binary, members binary")


def _links(a: dict, b: dict, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of the links between two blocks, some rows of the first at a time."""
    dim = a["dim"]
    ma, mb = (_units(x["m"], dim, len(x["ids"]) // 8) for x in (a, b))
    codes = np.unpackbits(np.frombuffer(b["codes"], np.uint8).reshape(len(mb), -1), axis=1, count=dim)
    signs = ((codes.astype(np.float32) * 2 - 1) / math.sqrt(dim)).T
    f = np.frombuffer(b["f"])
    floor = (f * threshold - math.sqrt(1 - threshold * threshold) * np.sqrt(np.maximum(0, 1 - f * f)) - SLACK).astype(np.float32)
    turned = (ma @ rotation(dim)).astype(np.float32)
    for lo in range(0, len(ma), 512):
        i, j = np.nonzero(turned[lo:lo + 512] @ signs >= floor)
        if same:
            up = i + lo < j
            i, j = i[up], j[up]
        for k in range(0, len(i), 1 << 16):
            p, q = i[k:k + (1 << 16)] + lo, j[k:k + (1 << 16)]
            hit = np.einsum("ij,ij->i", ma[p], mb[q]) >= threshold
            yield p[hit], q[hit]


def _compare(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = row["a"], row["b"]
                ia, ib = (np.frombuffer(x["ids"], "<i8") for x in (a, b))
                wa, wb = (np.frombuffer(x["members"], "<i8") for x in (a, b))
                na, nb = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64)
                u = v = np.zeros(0, np.int64)
                for i, j in _links(a, b, threshold, a["block"] == b["block"]):
                    np.add.at(na, i, wb[j])
                    np.add.at(nb, j, wa[i])
                    u, v = forest(np.concatenate([u, ia[i]]), np.concatenate([v, ib[j]]))
                ids, counts = np.concatenate([ia, ib]), np.concatenate([na, nb])
                some = counts > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids[some], u])),
                     pa.array(np.concatenate([counts[some], np.zeros(len(u), np.int64)])),
                     pa.array(np.concatenate([ids[some], v]))], names=["u", "links", "v"])
    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.9, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id) for every row of (vec_id, embedding)."""
    fine = usable(vectors).where(F.exists("v", lambda x: x != 0))
    classes = written(fine.groupBy("v", "dim").agg(F.count("*").alias("members"), F.min("vec_id").alias("rep"))
                      .withColumn("id", F.monotonically_increasing_id()), "neardup-classes")
    placed, n = in_blocks(classes.select("id", "v", "dim", "members"), block, "neardup-cells")
    packed = written(placed.repartition("block").groupBy("block").applyInArrow(_pack, _BLOCK_SCHEMA), "neardup-blocks")
    head = packed.select("block", "dim", "centre", "radius")
    other = head.select(*[F.col(c).alias(f"{c}_2") for c in head.columns])
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.aggregate(
        F.zip_with("centre", "centre_2", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x))))
    pairs = (head.withColumn("block_2", F.explode(F.sequence("block", F.lit(max(n - 1, 0)).cast("long"))))
             .join(other, "block_2").where("dim = dim_2")
             .where(angle - F.col("radius") - F.col("radius_2") <= math.acos(threshold) + 1e-6)
             .select("block", "block_2"))
    one = packed.select("block", F.struct("*").alias("a"))
    two = packed.select(F.col("block").alias("block_2"), F.struct("*").alias("b"))
    spread = max(1, min(n * (n + 1) // 2, 4 * vectors.sparkSession.sparkContext.defaultParallelism))
    rows = pairs.join(one, "block").repartition(spread, "block", "block_2").join(two, "block_2").select("a", "b")
    found = written(rows.mapInArrow(_compare(threshold), "u long, links long, v long"), "neardup-links")
    linked = components(found.where("u <> v").select("u", "v"), "neardup-components")
    counts = found.groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links"))
    label = written(classes.select("id", "rep", "members")
                    .join(linked.withColumnRenamed("node", "id"), "id", "left").join(counts, "id", "left")
                    .select("id", "rep", F.coalesce("component", "id").alias("label"),
                            (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links")), "neardup-labels")
    least = label.groupBy("label").agg(F.min("rep").alias("component_id"))
    label = label.join(least, "label").select("id", "n_links", "component_id")
    key = written(classes.select("id", "v").join(label, "id").select("v", "n_links", "component_id"), "neardup-classes")
    whole = F.coalesce(F.forall("embedding", lambda x: x.isNotNull()), F.lit(False))
    return (vectors.select("vec_id", F.when(whole, F.col("embedding")).alias("v")).join(key, "v", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")))
