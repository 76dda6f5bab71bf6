"""Ops 5 and 8: held-out accuracy, exact selection, dependent rounding."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm_cases import WORD, awkward, frame, shipped, with_clashes  # noqa: F401
from stratum.llm import classify, mixing

LABELS = "doc_id long, quality int, toxic int"


def test_classifier_on_held_out_labels(spark):
    """Fitted on the even labels, it tells the odd ones apart."""
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored, keep = classify.resample(docs, labels.where("doc_id % 2 = 0"))
    rows = scored.select("row.doc_id", "log_weight", keep.alias("kept")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    auc = np.mean([[g.log_weight > b.log_weight for b in bad] for g in good])
    assert auc > 0.97
    assert sum(r.kept for r in good) / len(good) > 0.97 and sum(r.kept for r in bad) / len(bad) < 0.2


def test_weights_match_a_plain_model(spark):
    texts = ["good words here", "bad junk junk", "good words again", None, "", "GOOD words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ratio = classify.fit(docs, spark.createDataFrame([(0,), (2,)], "doc_id long"), buckets=1 << 12)

    def grams(t):
        w = WORD.findall((t or "").lower())
        return w + list(zip(w, w[1:]))
    raw, target = Counter(g for t in texts for g in grams(t)), Counter(g for t in (texts[0], texts[2]) for g in grams(t))
    log = lambda c, g: np.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * (1 << 12)))
    got = {r.doc_id: r.log_weight for r in classify.with_key(docs, ratio).select("row.doc_id", "log_weight").collect()}
    for i, t in enumerate(texts):
        want = np.mean([log(target, g) - log(raw, g) for g in grams(t)]) if grams(t) else None
        assert got[i] is None if want is None else abs(got[i] - want) < 1e-9


@pytest.mark.parametrize("k", [1, 2, 17, 400, 401])
def test_kth_largest(spark, k):
    rng = random.Random(k)
    values = [round(rng.uniform(-90, 90) * 2 ** 30) / 2 ** 30 for _ in range(390)] + [0.0, -0.5, 1.25, 1.25, -1e6] * 2
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "key double")
    assert classify.kth_largest(df, k) == (sorted(values, reverse=True)[k - 1] if k <= 400 else None)


def test_resampling_of_awkward_tables(spark):
    docs = with_clashes(frame(spark, awkward()))
    for labels in ([], [(1, 1, 0), (2, 1, None), (3, None, 0), (None, 1, 0), (4, 0, 1), (1, 1, 0)]):
        out = classify.taken(docs, spark.createDataFrame(labels, LABELS))
        assert out.columns == docs.columns
        rows = out.collect()
        assert all(WORD.search(r.text or "") for r in rows)
        if not labels:
            assert len(rows) == docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).count()
    assert classify.taken(frame(spark, []), spark.createDataFrame([], LABELS)).collect() == []
    first = classify.taken(docs, spark.createDataFrame([(1, 1, 0), (4, 0, 1)], LABELS)).select("doc_id", "text").collect()
    again = classify.taken(docs.repartition(3), spark.createDataFrame([(1, 1, 0), (4, 0, 1)], LABELS)).select("doc_id", "text").collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))


@pytest.mark.parametrize("quality, labelled", [(1, False), (0, False), (0, True)])
def test_a_large_group_of_copies_leaves_the_rest_alone(spark, quality, labelled):
    """A third of all rows are copies of one document: they share one decision, and junk still goes."""
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    known = {r.doc_id: r for r in labels.collect()}
    one = min(i for i, r in known.items() if r.quality == quality and r.toxic == 0)
    copies = spark.range(10 ** 6, 10 ** 6 + docs.count() // 2).select(F.col("id").alias("doc_id")).crossJoin(
        docs.where(F.col("doc_id") == one).drop("doc_id"))
    rows = docs.unionByName(copies.select(docs.columns))
    marked = labels.unionByName(copies.where(F.lit(labelled) & (F.col("doc_id") % 3 == 0)).selectExpr("doc_id", f"{quality} AS quality", "0 AS toxic"))
    scored, keep = classify.resample(rows, marked.selectExpr("doc_id", "CAST(quality AS INT) quality", "CAST(toxic AS INT) toxic"))
    kept = {r.doc_id: r.kept for r in scored.select("row.doc_id", keep.alias("kept")).collect()}
    same = [k for i, k in kept.items() if i >= 10 ** 6 or i == one]
    good, bad = ([kept[i] for i, r in known.items() if r.quality == q and r.toxic == 0 and i != one] for q in (1, 0))
    print(f"copies kept {np.mean(same):.3f}, clean kept {sum(good)} of {len(good)}, junk kept {sum(bad)} of {len(bad)}")
    assert len(same) == docs.count() // 2 + 1 and len(set(same)) == 1
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2


# --- op 8 ---------------------------------------------------------------------------------------

def true_targets(size, weights=(5, 2, 1), cap=3.0):
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(size.values())
    while True:
        left = total - sum(cap * size[s] for s in full)
        rest = sum(w[s] for s in names if s not in full)
        t = {s: cap * size[s] if s in full else left * w[s] / rest for s in names}
        over = {s for s in names if s not in full and t[s] > cap * size[s] + 1e-9}
        if not over:
            return t
        full |= over


@pytest.mark.parametrize("size", [{"a": 10, "b": 500, "c": 90, None: 4}, {"a": 7}, {"b": 0, "a": 0}, {"x": 0, "y": 5, "z": 100},
                                  {f"s{i}": i * i + 1 for i in range(25)}, {"é": 3, "z": 1000, "a\U0001F600": 5, "a￿": 1}])
def test_targets(spark, size):
    df = spark.createDataFrame([(s, n) for s, n in size.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = true_targets(size)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in got)


@pytest.mark.parametrize("group", [4, 128])
def test_mix(spark, group):
    rng = random.Random(2)
    rows = awkward() + [(1000 + i, "w " * rng.randint(1, 40), "en", rng.choice("abcdefgh"), 1) for i in range(900)]
    docs = with_clashes(frame(spark, rows))
    out = mixing.mix(docs, group=group).collect()
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    want, largest, took = true_targets(size), defaultdict(int), defaultdict(int)
    told = {(round(t, 4), size[s]): s for s, t in want.items()}
    assert len(out) == len(rows)
    for r in out:
        s = told[round(r.target, 4), r.source_size]
        assert 0 <= r.copies <= 3
        assert r.size == 0 and r.copies == 0 or abs(r.copies - r.target / r.source_size) < 1
        largest[s], took[s] = max(largest[s], r.size), took[s] + r.copies * r.size
    assert all(abs(took[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in want)
    key = lambda r: repr((r.doc_id, r.size, r.copies))
    assert sorted(map(key, out)) == sorted(map(key, mixing.mix(docs.repartition(5), group=group).collect()))


def test_rounding_keeps_expectations(spark):
    """Over many seeds a document is taken as often as its fraction says."""
    units = spark.createDataFrame([("s", i, i * 77, 1 + i % 5, 0.1 + 0.8 * (i % 7) / 7) for i in range(40)],
                                  "source string, id long, h long, size long, f double")
    taken = np.zeros(40)
    for seed in range(30):
        for r in mixing.pivotal(units, seed, 8).collect():
            taken[r.id] += r.took
    f = np.array([0.1 + 0.8 * (i % 7) / 7 for i in range(40)])
    assert np.abs(taken / 30 - f).mean() < 0.12 and abs((taken / 30 - f).mean()) < 0.03


def test_take_repeats_whole_rows(spark):
    docs = with_clashes(frame(spark, awkward()))
    copies = sum(r.copies for r in mixing.mix(docs).collect())
    out = mixing.take(docs)
    assert out.columns == docs.columns and out.count() == copies
    assert mixing.take(frame(spark, [])).collect() == []


def test_many_equal_rows_are_one_unit(spark):
    """A third of all rows is one row, and another is repeated a million times: targets hold, no document beyond its share."""
    one = [(1, "three words here", "en", "a", 16)]
    rows = [(10 + i, "w " * (1 + i % 30), "en", "ab"[i % 2], 1) for i in range(400)]
    docs = frame(spark, rows).union(frame(spark, one * 200)).union(
        spark.range(1_000_000).selectExpr("2L", "'five words in this text'", "'en'", "'c'", "23L"))
    out = mixing.mix(docs)
    got = out.groupBy("target", "source_size").agg(F.sum(F.col("copies") * F.col("size")).alias("took"), F.max("copies").alias("most"),
                                                   F.min("copies").alias("least"), F.max("size").alias("size"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in got) == 1_000_600
    for r in got:
        assert abs(r.took - r.target) <= r.size / 2 + 1e-6 and r.most - r.least <= 1 and r.most <= 3
    assert out.where("doc_id = 1").count() == 200
    taken = mixing.take(docs).groupBy("doc_id").count().where("doc_id = 2").first()["count"]
    assert taken == out.where("doc_id = 2").agg(F.sum("copies")).first()[0]
