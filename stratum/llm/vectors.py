"""Vector tables in blocks of bounded size whose members lie near each other."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import written

PIVOTS = 256  # at most so many sampled vectors decide where a vector lives; they affect cost only


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim): rows whose vector and components are all present and finite."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(v.isNotNull() & F.coalesce(fine, F.lit(False))).select(
        "vec_id", v.alias("v"), F.size(v).alias("dim"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column of equal lengths as a double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, zero rows left as they are; large components don't overflow."""
    top = np.abs(m).max(1, initial=0.0)[:, None]
    m = m / np.where(top > 0, top, 1.0)
    norm = np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]
    return m / np.where(norm > 0, norm, 1.0)


def in_blocks(rows: DataFrame, size: int, purpose: str) -> tuple[DataFrame, int]:
    """``rows`` (id, v, dim, ...) with a dense ``block`` number, and the number of blocks.

    A vector goes to the most similar of a bounded sample of pivots of its
    length; a pivot with more than ``size`` vectors is split by a hash of the
    id, so a hot spot becomes several blocks and no block grows with the table.
    """
    n = rows.count()
    wanted = min(PIVOTS, max(1, math.ceil(n / size)))
    names = rows.columns
    sample: dict[int, list] = {}
    # ids first: a task sends the driver as many rows as are wanted in all
    turn = {r["id"]: i for i, r in enumerate(rows.select("id").orderBy(F.xxhash64("id"), "id").limit(wanted).collect())}
    for r in sorted(rows.where(F.col("id").isin([*turn])).select("id", "dim", "v").collect(), key=lambda r: turn[r["id"]]):
        sample.setdefault(r["dim"], []).append(list(r["v"]))
    pivots = {d: unit(np.array(x, np.float64).reshape(len(x), d)) for d, x in sample.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(names.index("dim")).to_numpy()
            cell = np.zeros(len(dims), np.int64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if int(d) in pivots:
                    cell[at] = (unit(matrix(b.column(names.index("v")).take(pa.array(at)), int(d)))
                                @ pivots[int(d)].T).argmax(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=[*names, "cell"])

    schema = rows.select("*", F.lit(0).cast("long").alias("cell")).schema
    placed = written(rows.mapInArrow(assign, schema), purpose)
    cells = written(placed.groupBy("dim", "cell").count().select(
        "dim", "cell", F.ceil(F.col("count") / size).cast("long").alias("parts")), purpose)
    # the cells are at most PIVOTS for each length of vector
    order = [(r["dim"], r["cell"], r["parts"]) for r in cells.orderBy("dim", "cell").collect()]
    first, total = [], 0
    for d, c, p in order:
        first.append((d, c, p, total))
        total += p
    if not first:
        return placed.withColumn("block", F.lit(0).cast("long")), 0
    start = rows.sparkSession.createDataFrame(first, "dim int, cell long, parts long, start long")
    out = placed.join(F.broadcast(start), ["dim", "cell"]).withColumn(
        "block", F.col("start") + F.pmod(F.xxhash64("id"), F.col("parts")))
    return out.select(*names, "block"), total
