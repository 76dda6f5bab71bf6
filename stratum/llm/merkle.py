"""Merkle manifest of a dataset: trees of row digests, stored in van Emde Boas layout.

Every row is a leaf, the digest of its columns.  The leaves of a group, in order,
are cut into aligned blocks of 2^HEIGHT; a task builds the tree over one block and
stores it as one binary value in which every subtree lies together: the upper half
of the levels first, then each subtree below it, recursively.  The roots of a
group's blocks are the leaves of the next blocks, until one root is left for each
group; the groups' roots, in order, get blocks in the same way.  A manifest is thus
a table of blocks, a level after the other, each level 2^HEIGHT times smaller.

A proof is the list of a leaf's siblings up to the root.  Where a node lies in its
block follows from its level and number alone (``address``), so a block hands out
siblings without hashing anything; what lies above a block is the same for all its
leaves and comes down from the blocks above, one value a block.

Digests are lower-case hex SHA-256 of the inputs' hex texts, joined.  Two nodes make
one; a last node without a partner makes one alone; a single leaf is its own root.

Defined cases: nulls in any column have a form of their own ("-"), a null group comes
first, leaves of equal order keys are ordered by digest, so repeated rows are leaves
of their own that may change places; a null id is never tampered with; an empty table
gives no rows.  A group may hold nearly all rows: order and blocks don't depend on it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import written
from stratum.operators.timeseries import with_row_id

HEIGHT = 10  # levels of a block above its leaves
SIZE = 32    # bytes of a digest


def digest(*hexes: bytes) -> bytes:
    return hashlib.sha256(b"".join(hexes)).digest()


def address(levels: int, depth: int, i: np.ndarray) -> np.ndarray:
    """Places of the nodes number ``i`` at ``depth`` (0: the root) in the layout of a full tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(i)
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, i)
    below, down = levels - upper, depth - upper
    inside = address(below, down, i & ((1 << down) - 1))
    return ((1 << upper) - 1) + (i >> down) * ((1 << below) - 1) + inside


@lru_cache(maxsize=64)
def _places(height: int) -> list[np.ndarray]:
    """For each level from the leaves (0) to the root: byte offsets of its nodes."""
    return [address(height + 1, height - level, np.arange(1 << (height - level))) * SIZE for level in range(height + 1)]


def build(leaves: list[bytes], height: int) -> bytes:
    """Tree of ``height`` levels above at most 2^height leaves; places without a node hold zeros."""
    places = _places(height)
    out = bytearray(((2 << height) - 1) * SIZE)
    nodes = leaves
    for level in range(height + 1):
        for at, node in zip(places[level].tolist(), nodes):
            out[at:at + SIZE] = node
        if level < height:
            hexes = [n.hex().encode() for n in nodes]
            nodes = [digest(*hexes[j:j + 2]) for j in range(0, len(hexes), 2)]
    return bytes(out)


def siblings(tree: bytes, height: int, n: int, leaf: int) -> list[tuple[int, bytes]]:
    """(side, digest) from the leaf's level up; side 1: the sibling is on the left, 0: on the right, 2: there is none."""
    out = []
    for level, at in enumerate(_places(height)[:height]):
        i = leaf >> level
        other = i ^ 1
        if other > (n - 1) >> level:
            out.append((2, b""))
        else:
            out.append((i & 1, tree[at[other]:at[other] + SIZE]))
    return out


def fold(leaf: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that a leaf and its siblings make."""
    node = leaf.hex().encode()
    for side, other in path:
        pair = (node,) if side == 2 else (other.hex().encode(), node) if side else (node, other.hex().encode())
        node = hashlib.sha256(b"".join(pair)).hexdigest().encode()
    return bytes.fromhex(node.decode())


def _pack(path: list[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([side]) + other for side, other in path)


def _unpack(raw: bytes) -> list[tuple[int, bytes]]:
    out, at = [], 0
    while at < len(raw):
        n = 0 if raw[at] == 2 else SIZE
        out.append((raw[at], raw[at + 1:at + 1 + n]))
        at += 1 + n
    return out


_BLOCK = ("g long, block long, n int, height int, root binary, tree binary, ids array<long>, given array<binary>")
_ARROW = pa.schema([("g", pa.int64()), ("block", pa.int64()), ("n", pa.int32()), ("height", pa.int32()), ("root", pa.binary()),
                    ("tree", pa.binary()), ("ids", pa.list_(pa.int64())), ("given", pa.list_(pa.binary()))])


def _block(whole: int):
    """One group's block of leaves (g, block, place, leaf, many, id, given) as a row of the manifest."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows.column("place").to_numpy(), kind="stable")))
        leaves = rows.column("leaf").to_pylist()
        height = whole if rows.column("many")[0].as_py() else (len(leaves) - 1).bit_length()
        tree = build(leaves, height)
        return pa.table([[rows.column("g")[0].as_py()], [rows.column("block")[0].as_py()], [len(leaves)], [height], [tree[:SIZE]],
                         [tree], [rows.column("id").to_pylist()], [rows.column("given").to_pylist()]], schema=_ARROW)
    return run


def levels(leaves: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The manifest over leaves (g, place from 0 in g, leaf, id, given): tables of blocks, the last one with one block a g.

    id and given (another leaf to verify in this place, or null) are kept beside the first level's trees.
    """
    out, nodes = [], leaves
    while True:
        total = nodes.groupBy("g").agg((F.max("place") >= (1 << height)).alias("many"))
        blocks = (nodes.join(total, "g").withColumn("block", F.shiftright("place", height))
                  .groupBy("g", "block").applyInArrow(_block(height), _BLOCK))
        out.append(written(blocks, "merkle-blocks"))
        if out[-1].where("block > 0").isEmpty():
            return out
        nodes = _nodes(out[-1].select("g", F.col("block").alias("place"), F.col("root").alias("leaf")))


def _nodes(df: DataFrame) -> DataFrame:
    return df.select("g", "place", "leaf", F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("given"))


def _down(height: int):
    """Blocks with the path above them -> the path above each of their leaves: (g, block, path)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                above = b["path"] or b""
                yield pa.RecordBatch.from_arrays([
                    pa.array([b["g"]] * b["n"], pa.int64()),
                    pa.array([(b["block"] << height) + i for i in range(b["n"])], pa.int64()),
                    pa.array([_pack(siblings(b["tree"], b["height"], b["n"], i)) + above for i in range(b["n"])], pa.binary())],
                    names=["g", "block", "path"])
    return run


def with_paths(manifest: list[DataFrame], above: DataFrame | None = None, height: int = HEIGHT) -> DataFrame:
    """The first level's blocks, each with the path above its root; ``above`` (g, path) is what follows on a group's root."""
    top = manifest[-1]
    joined = top.join(above, "g", "left") if above is not None else top.withColumn("path", F.lit(None).cast("binary"))
    for level in reversed(manifest[:-1]):
        found = joined.select("g", "block", "n", "height", "tree", "path").mapInArrow(_down(height), "g long, block long, path binary")
        joined = level.join(written(found, "merkle-paths"), ["g", "block"], "left")
    return joined


def tagged(column: Column, length: Column | None = None) -> Column:
    """A value as it enters a leaf: "-" if null, else its UTF-8 byte count, a colon and itself."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, columns: list[str], changed: dict[str, Column] | None = None) -> Column:
    """SHA-256 of a row's columns, hex; ``changed`` gives other values for some of them."""
    parts = [tagged((changed or {}).get(c, F.col(f"`{c}`"))) for c in columns]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


_PROVEN = "g long, doc_id long, leaf string, proof_sha256 string, folded_root string"


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in batch.to_pylist():
            above, at = _unpack(b["path"] or b""), _places(b["height"])[0]
            out = []
            for i, (doc_id, given) in enumerate(zip(b["ids"], b["given"])):
                leaf = b["tree"][at[i]:at[i] + SIZE]
                path = siblings(b["tree"], b["height"], b["n"], i) + above
                proof = hashlib.sha256(b"".join(other.hex().encode() for _, other in path)).hexdigest()
                out.append((b["g"], doc_id, leaf.hex(), proof, fold(leaf if given is None else given, path).hex()))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 2 + [pa.string()] * 3)],
                                             names=["g", "doc_id", "leaf", "proof_sha256", "folded_root"])


def manifest(docs: DataFrame, columns: list[str], group: str, order: str, changed: dict[str, Column] | None = None,
             tampered: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``.

    ``order`` (a long) becomes doc_id.  Rows where ``tampered`` holds are verified with the leaf of their
    ``changed`` values, the others with their own, in both cases against the original siblings.
    """
    given = F.lit(None).cast("string") if changed is None else F.when(tampered, leaves(docs, columns, changed))
    rows = docs.select(F.col(f"`{group}`").cast("string").alias("grp"), F.col(f"`{order}`").cast("long").alias("id"),
                       leaves(docs, columns).alias("leaf"), given.alias("given"), F.monotonically_increasing_id().alias("row"))
    in_order = [F.asc_nulls_first("grp"), F.asc_nulls_first("id"), "leaf", "row"]
    rows = with_row_id(rows, in_order, "at")
    # groups in order of their bytes; a group's rows lie together, from its first one on
    groups = rows.groupBy("grp").agg(F.min("at").alias("first"))
    groups = written(with_row_id(groups, [F.asc_nulls_first("grp")], "g").select(
        F.col("grp").alias("_grp"), "first", F.col("g") - 1), "merkle-groups").toDF("_grp", "first", "g")
    rows = rows.join(groups, F.col("grp").eqNullSafe(F.col("_grp"))).select(
        "g", (F.col("at") - F.col("first")).alias("place"), F.unhex("leaf").alias("leaf"), "id", F.unhex("given").alias("given"))
    below = levels(written(rows, "merkle-leaves"), height)
    subroots = below[-1].select("g", F.col("root").alias("subroot"))
    above = levels(_nodes(subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("place"), F.col("subroot").alias("leaf"))),
                   height)
    tops = with_paths(above, height=height).select("g", "block", "n", "height", "tree", "path").mapInArrow(
        _down(height), "g long, block long, path binary").select(F.col("block").alias("g"), "path")
    proven = with_paths(below, written(tops, "merkle-tops"), height).mapInArrow(_prove, _PROVEN)
    root = above[-1].select(F.lower(F.hex("root")).alias("root"))  # one row
    roots = subroots.select("g", F.lower(F.hex("subroot")).alias("subroot")).crossJoin(F.broadcast(root))
    return proven.join(roots, "g").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                          (F.col("folded_root") == F.col("root")).alias("verified"))
