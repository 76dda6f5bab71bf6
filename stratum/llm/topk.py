"""Exact inner-product search: a ball tree per shard, searched by branch and bound.

Every shard (a block of neighbouring vectors, of bounded size) is a ball tree.
A query visits nodes whose upper bound <q, centre> + |q| radius reaches its k-th
best score, within its own shard in the order of the bounds.  That score is
shared: the query's own shard is searched first, its k-th score travels with the
query to the other shards, and shards searched by one task hand it on.  There
groups of queries go down a tree together, and leaves are matrix products.

Defined cases: vectors that are null or hold null or non-finite components take
no part, vectors of different lengths are not compared, a null vec_id is no
query and ranks last among ties, repeated rows are rows of their own, scores
beyond a long stop at its ends, an empty table gives no rows.  Components so large
that ``scale`` takes them beyond a double are multiplied as whole numbers; balls
that hold one are never skipped.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import written
from stratum.llm.vectors import in_blocks, matrix, usable

SHARD = 2048
LEAF = 64
BAND = 8  # shards that one task searches in turn, at most
BAND_BYTES = 1 << 24
GROUP_BYTES = 1 << 22  # vectors of a group of queries
TOGETHER = 1024  # queries that go down a tree together
_EXACT = 2.0 ** 52
_LONG = (1 << 63) - 1
_NONE = _LONG  # stands for a null vec_id inside a shard


def whole(y: np.ndarray, x: np.ndarray | None, scale: float) -> list[int]:
    """The components y = floor(scale * x) as whole numbers, from x where the product left the doubles."""
    return [int(b) if math.isfinite(b) else math.floor(Fraction(float(x[i])) * Fraction(scale)) for i, b in enumerate(y.tolist())]


def build(m: np.ndarray) -> dict:
    """Ball tree over the rows of m: an order of the rows and nodes as (from, to, left, right) with balls.

    A ball that cannot be computed in doubles gets a NaN or infinite bound.
    """
    order = np.arange(len(m))
    nodes, centres, radii = [], [], []

    def add(lo: int, hi: int) -> int:
        at, rows = len(nodes), m[order[lo:hi]]
        centre = rows.mean(0)
        nodes.append([lo, hi, -1, -1])
        centres.append(centre)
        radii.append(float(np.sqrt(((rows - centre) ** 2).sum(1)).max()))
        if hi - lo > LEAF:
            far = rows[((rows - centre) ** 2).sum(1).argmax()]
            side = rows @ (far - rows[((rows - far) ** 2).sum(1).argmax()])
            mid = (hi - lo) // 2
            order[lo:hi] = order[lo:hi][np.argpartition(side, mid)]
            nodes[at][2:] = [add(lo, lo + mid), add(lo + mid, hi)]
        return at

    add(0, len(m))
    return {"order": order, "nodes": nodes, "centres": np.array(centres), "radii": np.array(radii)}


def search(tree: dict, q: np.ndarray, k: int, floor: float, skip: int, raw: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """The best k rows as (score, -vec_id, row id), none that scores below ``floor``; ``skip`` is the query's own row id.

    ``raw`` is the query before scaling, needed where scaling leaves the doubles.
    """
    m, ids, rids = tree["m"], tree["ids"], tree["rids"]
    with np.errstate(over="ignore", invalid="ignore"):
        length = float(np.abs(q).sum())
        slack = 1e-9 * (1 + float(np.abs(tree["centres"]).max(initial=0)) + tree["radii"].max(initial=0)) * (1 + length)
        bounds = tree["centres"] @ q + np.sqrt(q @ q) * tree["radii"] + slack
        bounds[~np.isfinite(bounds)] = math.inf
        exact = bool(length * tree["largest"] < _EXACT)
    own = None if exact else whole(q, raw, tree.get("scale", 1.0))
    best: list[tuple[int, int, int]] = []
    heap = [(-bounds[0], 0)]
    while heap:
        bound, at = heapq.heappop(heap)
        if -bound < floor:
            break
        lo, hi, left, right = tree["nodes"][at]
        if left >= 0:
            for child in (left, right):
                if bounds[child] >= floor:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        if exact:
            scores = m[lo:hi] @ q
            for i in np.flatnonzero(scores >= floor):
                if rids[lo + i] != skip:
                    best.append((int(scores[i]), -int(ids[lo + i]), int(rids[lo + i])))
        else:
            for i in range(lo, hi):
                if rids[i] != skip:
                    s = sum(x * y for x, y in zip(whole(m[i], tree["x"][i] if "x" in tree else None, tree.get("scale", 1.0)), own))
                    best.append((max(-_LONG - 1, min(_LONG, s)), -int(ids[i]), int(rids[i])))
        if len(best) >= k:
            best = heapq.nlargest(k, best)
            floor = max(floor, float(best[-1][0]) if exact else math.nextafter(float(best[-1][0]), -math.inf))
    return heapq.nlargest(k, best)


def _shard(scale: float):
    def run(rows: pa.Table) -> pa.Table:
        dim = rows.column("dim")[0].as_py()
        rows = rows.take(pa.array(rows.column("id").combine_chunks().to_numpy().argsort()))
        x = matrix(rows.column("v"), dim)
        with np.errstate(over="ignore", invalid="ignore"):
            m = np.floor(x * scale)
            tree = build(m)
        order = tree.pop("order")
        tree["m"], tree["scale"], tree["largest"] = m[order], scale, float(np.abs(m).max(initial=0))
        if not np.isfinite(m).all():
            tree["x"] = x[order]
        tree["rids"] = rows.column("id").combine_chunks().to_numpy()[order]
        tree["ids"] = rows.column("vec_id").combine_chunks().fill_null(_NONE).to_numpy()[order]
        return pa.table([pa.array([rows.column("block")[0].as_py()]), pa.array([dim], pa.int32()),
                         pa.array([pickle.dumps(tree)], pa.binary())], names=["block", "dim", "tree"])
    return run


_FOUND = "query long, query_id long, vec_id long, score long"


def _found(rows: list[tuple[int, int, list[tuple[int, int, int]]]]) -> pa.RecordBatch:
    flat = [(q, i, None if -v == _NONE else -v, s) for q, i, best in rows for s, v, _ in best]
    cols = list(zip(*flat)) if flat else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query", "query_id", "vec_id", "score"])


def _own(k: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(batch.schema.get_field_index("tree")):
                tree = pickle.loads(blob.as_py())
                ids = tree["ids"]
                yield _found([(int(tree["rids"][i]), int(ids[i]), search(tree, tree["m"][i], k, -math.inf, int(tree["rids"][i]),
                                                                     tree["x"][i] if "x" in tree else None))
                              for i in np.flatnonzero((ids % every == 0) & (ids != _NONE))])
    return run


def search_many(tree: dict, q: np.ndarray, floors: np.ndarray, skips: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows that reach the floors of many queries (rows of q), as (place of the query, place of the row, score).

    For queries whose scores are exact in doubles.  The queries go down the tree together: a leaf is multiplied
    with those whose bounds reached their floors on the way.
    """
    m, rids = tree["m"], tree["rids"]
    with np.errstate(over="ignore", invalid="ignore"):
        slack = 1e-9 * (1 + float(np.abs(tree["centres"]).max(initial=0)) + tree["radii"].max(initial=0)) * (1 + np.abs(q).sum(1))
        bounds = tree["centres"] @ q.T + np.outer(tree["radii"], np.sqrt(np.einsum("ij,ij->i", q, q))) + slack
        bounds[~np.isfinite(bounds)] = math.inf
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    todo = [(0, np.arange(len(q)))]
    while todo:
        at, live = todo.pop()
        live = live[bounds[at, live] >= floors[live]]
        if not len(live):
            continue
        lo, hi, left, right = tree["nodes"][at]
        if left >= 0:
            todo += [(left, live), (right, live)]
            continue
        scores = m[lo:hi] @ q[live].T
        row, of = np.nonzero(scores >= floors[live])
        other = rids[lo + row] != skips[live[of]]
        row, of = row[other], of[other]
        out.append((live[of], lo + row, scores[row, of].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _best(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best (query, vec_id, score) of each query, and the rank of each from 0."""
    of, ids, scores = (np.concatenate(x) for x in zip(*rows))
    order = np.lexsort((ids, ~scores, of))
    of, ids, scores = of[order], ids[order], scores[order]
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    keep = rank < k
    return of[keep], ids[keep], scores[keep], rank[keep]


def _floor(scores: np.ndarray) -> np.ndarray:
    """Whole scores as doubles that are not above them."""
    x = scores.astype(np.float64)
    return np.where(np.abs(x) < _EXACT, x, np.nextafter(x, -math.inf))


def _others(k: int, scale: float):
    def run(shards: pa.Table, asked: pa.Table) -> pa.Table:
        """The k best rows of a run of shards for each query of a group."""
        best = (np.zeros(0, np.int64),) * 3
        query, query_id, block = (asked.column(c).combine_chunks().to_numpy() for c in ("query", "query_id", "block"))
        if shards.num_rows and asked.num_rows:
            raw = matrix(asked.column("v"), asked.column("dim")[0].as_py())
            has = asked.column("floor").is_valid().to_numpy()
            floors = np.where(has, _floor(asked.column("floor").combine_chunks().fill_null(0).to_numpy()), -math.inf)
            with np.errstate(over="ignore", invalid="ignore"):
                q = np.floor(raw * scale)
                length = np.abs(q).sum(1)
            for at, blob in zip(shards.column("block").to_pylist(), shards.column("tree")):
                tree, rows = pickle.loads(blob.as_py()), [best]
                with np.errstate(over="ignore", invalid="ignore"):
                    exact = length * tree["largest"] < _EXACT
                many = np.flatnonzero(exact & (block != at))
                for i in range(0, len(many), TOGETHER):
                    some = many[i:i + TOGETHER]
                    of, row, scores = search_many(tree, q[some], floors[some], query[some])
                    rows.append((some[of], tree["ids"][row], scores))
                for i in np.flatnonzero(~exact & (block != at)):
                    found = search(tree, q[i], k, float(floors[i]), int(query[i]), raw[i])
                    rows.append((np.full(len(found), i), np.array([-v for _, v, _ in found], np.int64), np.array([s for s, _, _ in found], np.int64)))
                *best, rank = _best(rows, k)
                last = rank == k - 1
                floors[best[0][last]] = np.maximum(floors[best[0][last]], _floor(best[2][last]))
        of, ids, scores = best
        return pa.table([pa.array(query[of]), pa.array(query_id[of]), pa.array(ids, mask=ids == _NONE), pa.array(scores)],
                        names=["query", "query_id", "vec_id", "score"])
    return run


def _deal(placed: DataFrame, every: int, shard: int) -> DataFrame:
    """For each length of vector that is asked for: how many shards go to a task together (band), the first and the
    last of those bands, and into how many groups (parts) its queries are dealt, all of bounded size."""
    spark = placed.sparkSession
    spans = placed.groupBy("dim").agg(F.min("block").alias("lo"), F.max("block").alias("hi"), F.count_if(F.col("vec_id") % every == 0).alias("n"))
    rows = []
    for r in spans.where("n > 0").collect():  # one row for each length of vector, as in in_blocks
        size = 8 * max(1, r["dim"])
        band = max(1, min(BAND, BAND_BYTES // (shard * size), (r["hi"] - r["lo"] + 1) // (4 * spark.sparkContext.defaultParallelism)))
        rows.append((r["dim"], band, r["lo"] // band, r["hi"] // band, math.ceil(r["n"] * size / GROUP_BYTES)))
    return spark.createDataFrame(rows, "dim int, band long, first long, last long, parts long")


def top_k(vectors: DataFrame, k: int = 10, scale: float = 1024.0, every: int = 100, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each query, a row whose vec_id ``every`` divides.

    Components are floor(scale * x); ties go to the smaller vec_id.
    """
    rows = written(usable(vectors).withColumn("v", F.transform("v", lambda x: x.cast("double")))
                   .withColumn("id", F.monotonically_increasing_id()), "topk-rows")
    placed, _ = in_blocks(rows.select("id", "vec_id", "v", "dim"), shard, "topk-cells")
    placed = written(placed, "topk-placed")
    trees = written(placed.groupBy("block").applyInArrow(_shard(scale), "block long, dim int, tree binary"), "topk-trees")
    own = written(trees.mapInArrow(_own(k, every), _FOUND), "topk-own")
    floors = own.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("floor"))
    queries = written(placed.where(F.col("vec_id") % every == 0).join(floors, placed["id"] == floors["query"], "left").select(
        F.col("id").alias("query"), F.col("vec_id").alias("query_id"), "v", "dim", "block",
        F.when(F.col("n") >= k, F.col("floor")).alias("floor")), "topk-queries")
    # bands of shards meet groups of queries where both are shuffled to: copies of queries never pass the driver
    deal = F.broadcast(_deal(placed, every, shard))
    shards = trees.join(deal, "dim").select("dim", F.expr("block div band").alias("band"), F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"),
                                            "block", "tree")
    asked = queries.join(deal, "dim").select("dim", F.explode(F.sequence("first", "last")).alias("band"),
                                             F.pmod(F.xxhash64("query"), "parts").alias("part"), "query", "query_id", "v", "block", "floor")
    group = ["dim", "band", "part"]
    found = own.union(shards.groupBy(*group).cogroup(asked.groupBy(*group)).applyInArrow(_others(k, scale), _FOUND))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
