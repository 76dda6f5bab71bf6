"""Prefix trie of conversations, with totals of its subtrees by centroid decomposition.

A node is a distinct sequence of first turns; its members are the conversations that
start with it, its name is its smallest member and its depth.  Sequences are compared
by SHA-256: runs of RUN turns are digested on their own and the runs' digests again,
so that no conversation, however long, is digested in one piece.

Totals over subtrees (``rollup``): a component of the forest of parent edges is split
at its centroid, the deepest node below which more than half of the component lies.
What lies below the centroid is summed up, once for the component, and added to all
nodes on the path from the centroid to the component's top; then the centroid leaves,
the subtrees of its children and what is left above become components, each at most
half as heavy.  Each pair of a node and one of its ancestors is parted by exactly one
centroid, so every total is complete.  All large components are split in the same round, as joins;
the weight is the number of turns that members have in a subtree, which is known beforehand
by a plain aggregate, so that the path is just the nodes of over half the weight.
Components of a weight of LIMIT or less are decomposed inside tasks, by node counts.

Defined cases: rows without conv_id take no part, a null role or text is empty, a
null turn comes first, equal turn numbers are ordered by the turns' digests, repeated
rows are turns of their own, conversations without turns are members of the root, an
empty table gives no rows, other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import written
from stratum.operators.timeseries import with_row_id

RUN = 64           # turns digested in one piece
LIMIT = 1 << 16    # weight of the components that one task decomposes
CHUNK = 4096       # conversation ids joined to one text before they are hashed


# --- the conversations' turns ------------------------------------------------------------------

def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, x, n_bytes, at): every turn's digest and text size; at grows along each conversation, without gaps."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn",
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("x"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row"))
    return with_row_id(rows, ["conv_id", F.asc_nulls_first("turn"), "x", "row"], "at")


def shared_openings(conversations: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the opening of another: turns (conv_id, depth, x, n_bytes, n_turns) and (conv_id, n_turns).

    Conversation c gets the first h turns of conversation c - c % every, then its own after its first h;
    h is the unsigned CRC-32 of c in decimal, modulo ``most``.
    """
    turns = written(numbered(conversations), "trie-turns")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    convs = written(convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every), "trie-conversations")
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    k = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("k", k.cast("long"))
    convs = written(convs.withColumn("n_turns", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-conversations")
    placed = turns.join(convs.drop("n"), "conv_id").withColumn("place", F.col("at") - F.col("first") + 1)
    own = placed.where("place > h").select("conv_id", (F.col("k") + F.col("place") - F.col("h")).alias("depth"), "x", "n_bytes", "n_turns")
    first = placed.where((F.col("conv_id") == F.col("base")) & (F.col("place") < most)).select("base", "place", "x", "n_bytes")
    opening = first.join(convs.select("base", "conv_id", "k", "n_turns"), "base").where("place <= k")
    opening = opening.select("conv_id", F.col("place").alias("depth"), "x", "n_bytes", "n_turns")
    return written(own.union(opening), "trie-rebuilt"), convs.select("conv_id", "n_turns")


def prefixes(turns: DataFrame, run: int = RUN) -> DataFrame:
    """(conv_id, depth, p, n_bytes, n_turns) from turns with digests x: equal sequences of first turns have equal p."""
    sets = turns.groupBy("conv_id", F.floor((F.col("depth") - 1) / run).alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "x", "n_bytes", "n_turns"))).alias("t"))  # at most ``run``
    upto = F.transform(F.sequence(F.lit(1), F.size("t")), lambda i: F.sha2(F.array_join(F.slice("t.x", F.lit(1), i), "").cast("binary"), 256))
    sets = written(sets.select("conv_id", "run", "t", upto.alias("p")), "trie-runs")
    if not sets.where("run > 0").isEmpty():
        ends = sets.where(F.size("t") == run).select("conv_id", (F.col("run") + 1).alias("depth"), F.element_at("p", -1).alias("x"),
                                                    F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_turns"))
        above = prefixes(ends, run).select("conv_id", F.col("depth").alias("run"), F.col("p").alias("above"))
        sets = sets.join(above, ["conv_id", "run"], "left").withColumn("p", F.when(
            F.col("above").isNotNull(), F.transform("p", lambda p: F.sha2(F.concat("above", p).cast("binary"), 256))).otherwise(F.col("p")))
    flat = sets.select("conv_id", F.explode(F.arrays_zip("t", "p")).alias("e"))
    return flat.select("conv_id", "e.t.depth", "e.p", "e.t.n_bytes", "e.t.n_turns")


# --- totals over subtrees ----------------------------------------------------------------------

def decompose(parent: list[int], weights: list[list[int]]) -> list[list[int]]:
    """Sums of each weight over the subtree of every node; parents come before children, node 0 is the top."""
    total = [[0] * len(parent) for _ in weights]
    size = [0] * len(parent)
    label = [-1] * len(parent)
    todo = [list(range(len(parent)))]
    while todo:
        nodes = todo.pop()
        top = nodes[0]
        for i in nodes:
            size[i], label[i] = 1, -1
        for i in reversed(nodes[1:]):
            size[parent[i]] += size[i]
        centroid = top
        for i in nodes:  # nodes with more than half below them form a path; its last one
            if 2 * size[i] > len(nodes):
                centroid = i
        below: dict[int, list[int]] = {}
        rest = []
        for i in nodes:
            if i != centroid:
                if i != top and parent[i] == centroid:
                    label[i] = i
                elif i != top:
                    label[i] = label[parent[i]]
                (below.setdefault(label[i], []) if label[i] >= 0 else rest).append(i)
        for w, t in zip(weights, total):
            s = w[centroid] + sum(w[i] for x in below.values() for i in x)
            i = centroid
            while True:
                t[i] += s
                if i == top:
                    break
                i = parent[i]
        todo += below.values()
        if rest:
            todo.append(rest)
    return total


_ROLLED = "conv_id long, depth long, n_leaves long, saved long"


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole components, rows in order of component and depth."""
    names = ["top", "top_depth", "conv_id", "depth", "parent", "leaf", "saves", "n_leaves", "saved"]
    kept = [np.zeros(0, np.int64)] * len(names)

    def solve(cols: list[np.ndarray]) -> pa.RecordBatch:
        n = len(cols[0])
        new = np.flatnonzero(np.append(True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))) if n else np.zeros(0, int)
        leaves, saved = cols[7].copy(), cols[8].copy()
        ids, depths, parents = cols[2].tolist(), cols[3].tolist(), cols[4].tolist()
        for a, b in zip(new.tolist(), [*new[1:].tolist(), n]):
            at = {(ids[i], depths[i]): i - a for i in range(a, b)}
            up = [at.get((parents[i], depths[i] - 1), -1) for i in range(a, b)]
            x, y = decompose(up, [cols[5][a:b].tolist(), cols[6][a:b].tolist()])
            leaves[a:b] += np.array(x, np.int64)
            saved[a:b] += np.array(y, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (cols[2], cols[3], leaves, saved)],
                                          names=["conv_id", "depth", "n_leaves", "saved"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.concatenate([k, batch.column(batch.schema.get_field_index(n)).fill_null(-1).to_numpy(zero_copy_only=False)])
                for k, n in zip(kept, names)]
        last = int(np.flatnonzero((cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]))[0])  # may go on in the next batch
        kept = [c[last:] for c in cols]
        if last:
            yield solve([c[:last] for c in cols])
    if len(kept[0]):
        yield solve(kept)


def rollup(tree: DataFrame, ways: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(conv_id, depth, n_leaves, saved): sums of leaf and saves over the subtree of each node.

    ``tree`` has nodes (conv_id, depth, parent, mass, leaf, saves), ``ways`` the nodes (owner, parent) on the way
    of every conversation ``conv_id`` at every ``depth``.
    """
    zero = F.lit(0).cast("long")
    root = tree.where("depth = 0").select(F.col("conv_id").alias("top"))  # one row
    live = tree.crossJoin(F.broadcast(root)).withColumn("top_depth", zero).withColumn("n_leaves", zero).withColumn("saved", zero)
    live = live.select("top", "top_depth", "conv_id", "depth", "parent", "mass", "leaf", "saves", "n_leaves", "saved")
    way = ways.select(F.col("conv_id").alias("way"), F.col("depth").alias("way_depth"), F.col("owner").alias("child"),
                      F.col("parent").alias("child_of"))
    finished, small = [], []
    while True:
        weight = live.groupBy("top", "top_depth").agg(F.max("mass").alias("weight"))
        live = written(live.join(weight, ["top", "top_depth"]), "trie-live")
        small.append(live.where(F.col("weight") <= limit))
        live = live.where(F.col("weight") > limit)
        if live.isEmpty():
            break
        half = F.col("mass") * 2 > F.col("weight")
        centroid = live.where(half).groupBy("top", "top_depth").agg(F.max(F.struct("depth", "conv_id", "mass")).alias("z"))
        x = live.join(centroid, ["top", "top_depth"])
        x = x.join(way, (F.col("way") == F.col("conv_id")) & (F.col("way_depth") == F.col("z.depth") + 1)
                   & (F.col("depth") > F.col("z.depth")), "left")
        x = x.withColumn("is_z", (F.col("depth") == F.col("z.depth")) & (F.col("conv_id") == F.col("z.conv_id")))
        x = written(x.withColumn("below", F.coalesce(F.col("child_of") == F.col("z.conv_id"), F.lit(False))), "trie-split")
        sums = x.where("below OR is_z").groupBy("top", "top_depth").agg(F.sum("leaf").alias("s_leaf"), F.sum("saves").alias("s_saves"))
        x = x.join(sums, ["top", "top_depth"])
        on_path = ~F.col("below") & half
        x = x.withColumn("n_leaves", F.col("n_leaves") + F.when(on_path, F.col("s_leaf")).otherwise(0)).withColumn(
            "saved", F.col("saved") + F.when(on_path, F.col("s_saves")).otherwise(0))
        x = written(x.withColumn("mass", F.when(on_path, F.col("mass") - F.col("z.mass")).otherwise(F.col("mass"))), "trie-parted")
        finished.append(x.where("is_z").select("conv_id", "depth", "n_leaves", "saved"))
        live = x.where("NOT is_z").select(
            F.when(F.col("below"), F.col("child")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("below"), F.col("z.depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            "conv_id", "depth", "parent", "mass", "leaf", "saves", "n_leaves", "saved")
    parts = small[0]
    for s in small[1:]:
        parts = parts.union(s)
    out = (parts.drop("mass", "weight").repartition("top", "top_depth").sortWithinPartitions("top", "top_depth", "depth")
           .mapInArrow(_local, _ROLLED))
    for f in finished:
        out = out.union(f)
    return out


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a node's ids, in order -> SHA-256 of all of them joined; holds one hash state."""
    at, state = None, None

    def said(done: list) -> pa.RecordBatch:
        cols = list(zip(*done)) if done else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
                                          names=["conv_id", "depth", "ends_sha256"])

    for batch in batches:
        done = []
        for c, d, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (c, d) != at:
                if at is not None:
                    done.append((*at, state.hexdigest()))
                at, state = (c, d), hashlib.sha256()
                state.update(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield said(done)
    if at is not None:
        yield said([(*at, state.hexdigest())])


def end_hashes(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) from (owner, depth, conv_id): the ids that end at a node, ascending, comma-joined, hashed.

    A node's ids are joined in chunks of bounded size; only the chunks of one node meet in a task, as a stream.
    """
    rows = with_row_id(ends.select("owner", "depth", "conv_id"), ["owner", "depth", "conv_id"], "at")
    chunks = rows.groupBy("owner", "depth", F.floor(F.col("at") / CHUNK).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    return (chunks.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "chunk").select("owner", "depth", "ids")
            .mapInArrow(_hash_chunks, "conv_id long, depth long, ends_sha256 string"))


def prefix_trie(rebuilt: tuple[DataFrame, DataFrame], limit: int = LIMIT, run: int = RUN) -> DataFrame:
    """The trie's nodes with their totals, from turns (conv_id, depth, x, n_bytes, n_turns) and all (conv_id, n_turns)."""
    turns, convs = rebuilt
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), F.lit("").alias("p"), zero.alias("n_bytes"), "n_turns")
    members = written(prefixes(turns, run).union(roots), "trie-members")
    nodes = written(members.groupBy("depth", "p").agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("n_turns") - F.col("depth") + 1).alias("mass")), "trie-nodes")
    # a node of one member is its own; the others are looked up
    alone = members.join(nodes.where("n_convs > 1").select("depth", "p", "owner"), ["depth", "p"], "left")
    owned = written(alone.select("conv_id", "depth", F.coalesce("owner", "conv_id").alias("owner"),
                                 (F.col("n_turns") == F.col("depth")).alias("ends")), "trie-owners")
    above = owned.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    ways = written(owned.join(above, ["conv_id", "depth"], "left"), "trie-ways")
    tree = nodes.select(F.col("owner").alias("conv_id"), "depth", "n_convs", "n_bytes", "mass").join(
        ways.where("conv_id = owner").select("conv_id", "depth", "parent"), ["conv_id", "depth"])
    children = ways.where("conv_id = owner AND depth > 0").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    tree = tree.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    tree = written(tree.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn(
        "saves", (F.col("n_convs") - 1) * F.col("n_bytes")), "trie-tree")
    totals = rollup(tree.select("conv_id", "depth", "parent", "mass", "leaf", "saves"), ways, limit)
    found = tree.join(totals, ["conv_id", "depth"]).join(end_hashes(ways.where("ends")), ["conv_id", "depth"], "left")
    return found.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
