"""Ops 4 and 7 against brute force."""

import itertools
import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from llm_cases import roots, shipped  # noqa: F401
from stratum.llm import neardup, topk

NAN, INF = float("nan"), float("inf")


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, id long, block long, cell long, v string")


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    m = rng.standard_normal((260, 16))
    near = m[5] + 0.15 * rng.standard_normal((40, 16))
    chain = [np.cos(t) * m[0] / np.linalg.norm(m[0]) + np.sin(t) * m[1] / np.linalg.norm(m[1]) for t in np.arange(12) * 0.4]
    m = np.concatenate([m, near, chain, np.repeat(m[7:8] * 2, 30, 0)]).astype(np.float32)
    rows = [(i * 5, [float(x) for x in v]) for i, v in enumerate(m)]
    rows += [(9001, None), (9002, []), (9003, [0.0] * 16), (9004, [None] + [1.0] * 15), (9005, [NAN] + [1.0] * 15),
             (9006, [INF] + [1.0] * 15), (9007, [1.0, 2.0]), (9008, [2.0, 4.1]), (None, rows[5][1]), (10, rows[2][1]),
             (100, rows[60][1])]
    return [(i, v, 1, 1, 1, 1, "x") for i, v in rows]


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("block, kind", [(16, "float"), (2048, "double")])
def test_near_vectors(spark, block, kind):
    rows = vectors()
    got = Counter(tuple(r) for r in neardup.near_vectors(table(spark, rows, kind), 0.9, block).collect())
    fine = [(n, np.array(r[1], np.float32 if kind == "float" else float).astype(float)) for n, r in enumerate(rows)
            if good(r[1]) and any(r[1])]
    links = [(a, b) for x, (a, u) in enumerate(fine) for b, w in fine[:x]
             if len(u) == len(w) and u @ w / np.linalg.norm(u) / np.linalg.norm(w) >= 0.9]
    count, root = Counter([x for p in links for x in p]), roots(len(rows), links)
    least = {}
    for n, c in enumerate(root):
        if rows[n][0] is not None:
            least[c] = min(least.get(c, 1 << 62), rows[n][0])
    assert len(links) > 800
    assert got == Counter((r[0], count[n], least.get(root[n])) for n, r in enumerate(rows))


def test_near_vectors_of_nothing(spark):
    assert neardup.near_vectors(table(spark, [])).collect() == []
    assert [tuple(r) for r in neardup.near_vectors(table(spark, [(1, None, 0, 0, 0, 0, "")])).collect()] == [(1, 0, 1)]


def test_codes_bound_the_inner_product():
    rng = np.random.default_rng(0)
    m = rng.standard_normal((300, 32))
    m = np.concatenate([m, m[:100] + 0.2 * rng.standard_normal((100, 32))])
    m /= np.linalg.norm(m, axis=1)[:, None]
    codes, f = neardup.encode(m)
    signs = (np.unpackbits(codes, axis=1) * 2.0 - 1) / math.sqrt(32)
    turned = m @ neardup.rotation(32)
    estimate, true = turned @ signs.T / f, m @ m.T
    assert (np.abs(estimate - true) <= np.sqrt(np.maximum(0, 1 - true ** 2)) * np.sqrt(1 - f ** 2) / f + 1e-9).all()
    assert abs((estimate - true).mean()) < 0.005


def brute_top(rows, k, every):
    m = [(n, r[0], [math.floor(1024 * float(np.float32(x))) for x in r[1]]) for n, r in enumerate(rows) if good(r[1])]
    out = []
    for n, i, q in m:
        if i is not None and i % every == 0:
            s = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(q, v)))), j is None, j or 0)
                       for o, j, v in m if o != n and len(v) == len(q))
            out += [(i, r + 1, None if x[1] else x[2], -x[0]) for r, x in enumerate(s[:k])]
    return Counter(out)


@pytest.mark.parametrize("shard", [8, 2048])
def test_top_k(spark, shard):
    rows = vectors()
    got = Counter(tuple(r) for r in topk.top_k(table(spark, rows), 10, shard=shard).collect())
    assert got == brute_top(rows, 10, 100)


def test_top_k_with_few_rows_and_huge_components(spark):
    rows = [(0, [1e30, 1.0], 0, 0, 0, 0, ""), (100, [1e30, -3.0], 0, 0, 0, 0, ""), (3, [-2e9, 5.0], 0, 0, 0, 0, ""),
            (4, [3e12, 5e12], 0, 0, 0, 0, "")]
    got = Counter(tuple(r) for r in topk.top_k(table(spark, rows), 10).collect())
    assert got == brute_top(rows, 10, 100)
    assert topk.top_k(table(spark, [])).collect() == []


def test_top_k_with_components_beyond_scaling(spark):
    """floor(1024 * x) of finite doubles up to 1.8e308, against whole numbers."""
    rng = np.random.default_rng(3)
    big = [1.7e308, -1.7e308, 1.8e305, 3e305, 1e300, -2.5, 0.0, 1e-300, 7.25]
    rows = [(i * 25, [float(rng.choice(big)) for _ in range(3)], 0, 0, 0, 0, "") for i in range(60)]
    m = [[math.floor(Fraction(x) * 1024) for x in r[1]] for r in rows]
    want = Counter()
    for i in range(0, 60, 4):
        s = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(m[i], m[j])))), rows[j][0]) for j in range(60) if j != i)
        want.update((rows[i][0], n + 1, j, -x) for n, (x, j) in enumerate(s[:10]))
    for shard in (8, 2048):
        assert Counter(tuple(r) for r in topk.top_k(table(spark, rows, "double"), 10, shard=shard).collect()) == want


def test_tree_search_is_exact():
    rng = np.random.default_rng(5)
    m = np.floor(rng.standard_normal((700, 8)) * 50)
    tree = topk.build(m)
    order = tree.pop("order")
    tree |= {"m": m[order], "largest": float(np.abs(m).max()), "rids": order, "ids": order // 2}
    for q in range(0, 700, 50):
        want = sorted(((int(m[j] @ m[q]), -(j // 2), j) for j in range(700) if j != q), reverse=True)[:5]
        got = topk.search(tree, m[q], 5, -math.inf, q)
        assert [x[:2] for x in got] == [x[:2] for x in want]


def test_tree_search_of_many_queries_is_exact():
    rng = np.random.default_rng(6)
    m = np.floor(np.concatenate([rng.standard_normal((400, 8)) * 50, np.repeat(rng.standard_normal((1, 8)) * 50, 300, 0)]))
    tree = topk.build(m)
    order = tree.pop("order")
    tree |= {"m": m[order], "largest": float(np.abs(m).max()), "rids": order, "ids": order // 2}
    asked = np.arange(0, 700, 25)
    floors = np.array([sorted(m @ m[q])[-9] if q % 50 else -math.inf for q in asked])
    of, row, scores = topk.search_many(tree, m[asked], floors, asked)
    want = {(n, j, int(m[j] @ m[q])) for n, q in enumerate(asked) for j in range(700) if j != q and m[j] @ m[q] >= floors[n]}
    assert len(of) == len(want) and set(zip(of.tolist(), tree["rids"][row].tolist(), scores.tolist())) == want


def test_floors_are_not_above_their_scores():
    for s in (0, -5, 2 ** 52, 2 ** 53 + 1, 2 ** 60 + 200, -2 ** 60 - 1, 2 ** 63 - 1, -2 ** 63):
        assert Fraction(float(topk._floor(np.array([s]))[0])) <= s


def test_top_k_of_many_bands_and_groups(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP_BYTES", 256)
    for band in (1, 3):
        monkeypatch.setattr(topk, "BAND", band)
        rows = vectors(2)
        assert Counter(tuple(r) for r in topk.top_k(table(spark, rows), 10, shard=4).collect()) == brute_top(rows, 10, 100)


def test_copies_of_queries_do_not_pass_the_driver(spark):
    """The table of queries is small and its copies, one for each run of shards, are not: Spark must not broadcast them."""
    plan = topk.top_k(table(spark, vectors()), 10, shard=8)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in plan]
    sent = [y for i, x in enumerate(plan) if "BroadcastExchange" in x
            for y, _ in itertools.takewhile(lambda z: z[1] > depth[i], zip(plan[i + 1:], depth[i + 1:]))]
    assert any("Generate" in x for x in plan) and not any("Generate" in x for x in sent)
