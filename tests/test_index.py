"""The text index against a full scan, over syncs that add, change, remove and merge."""

import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import documents as D
from stratum.operators import index as Ix

WORDS = ["the", "the", "of", "of", "a", "alpha", "beta", "gamma", "delta", "Omega", "zeta", "eta", "rare", "née"]


def texts(rng, ids):
    return [(i, None if i % 17 == 16 else "\n".join(" ".join(rng.choices(WORDS, k=rng.randint(0, 25))) for _ in range(rng.randint(0, 4))))
            for i in ids]


def answers(df):
    return sorted((r.item_id, r["rank"], r.doc_id, r.chunk_id, r.score) for r in df.collect())


@pytest.fixture(scope="module")
def questions(spark):
    rows = [(1, "alpha beta the"), (2, "rare née rare"), (3, "the of a"), (4, "unknown"), (5, None), (6, "omega zeta eta gamma delta the of")]
    return spark.createDataFrame(rows, "item_id int, text string")


def test_syncs_answer_like_a_full_scan(spark, questions, monkeypatch):
    monkeypatch.setattr(Ix, "BLOCK", 4)
    monkeypatch.setattr(Ix, "MERGE", 3)
    rng = random.Random(4)
    index, state = Ix.TextIndex(spark), {}
    seen = []
    for step in range(5):
        if step:
            for i in rng.sample(sorted(state), len(state) // 5):
                del state[i]
            changed = dict(texts(rng, rng.sample(sorted(state), len(state) // 4)))
        else:
            changed = {}
        added = dict(texts(rng, range(100 * step, 100 * step + 40)))
        before = dict(index.live().select("key", "fingerprint").collect())
        state |= changed | added
        docs = spark.createDataFrame(sorted(state.items()), "doc_id long, text string")
        did = {r.status: r.n for r in index.sync(docs).collect()}
        assert sum(did.values()) == len(state) + did.get("removed", 0) and did["added"] == 40
        assert did.get("removed", 0) == len(set(before) - set(state))
        assert {r.key for r in index.live().collect()} == set(state)
        seen.append(len(index.manifest()[1]))
        if step in (1, 4):
            assert answers(index.retrieve(questions)) == answers(D.retrieve(questions, docs))
    assert seen[:3] == [1, 2, 3] and seen[3] == 1, "the fourth segment is merged away"
    version = index.manifest()
    assert [r.status for r in index.sync(docs).collect()] == ["kept"] and index.manifest() == version
    again = Ix.TextIndex(spark, index.path)
    assert answers(again.retrieve(questions, k=1)) == [x for x in answers(index.retrieve(questions)) if x[1] == 1]


def test_a_failed_sync_leaves_the_version_before(spark, monkeypatch):
    index = Ix.TextIndex(spark)
    index.sync(spark.createDataFrame([(1, "one two")], "doc_id long, text string"))
    version = index.manifest()
    monkeypatch.setattr(index, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        index.sync(spark.createDataFrame([(2, "three")], "doc_id long, text string"))
    assert index.manifest() == version and [r.key for r in index.live().collect()] == [1]


def test_empty_index(spark, questions):
    index = Ix.TextIndex(spark)
    assert index.retrieve(questions).collect() == []
    assert index.sync(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_blocks_are_skipped_by_their_maxima(spark):
    """Postings of a block come in order of count; heads tell number and largest count of every block."""
    rng = random.Random(1)
    index = Ix.TextIndex(spark)
    index.sync(spark.createDataFrame([(i, " ".join(["x"] * rng.randint(1, 9))) for i in range(1000)], "doc_id long, text string"))
    blocks = index._blocks(index.manifest()[1]).where(F.col("term") == "x").collect()
    assert sum(b.n for b in blocks) == 1000 and all(len(b.postings) == b.n <= Ix.BLOCK for b in blocks)
    tops = sorted(((b.top, b.postings[-1].tf) for b in blocks), reverse=True)
    assert all(b.top == b.postings[0].tf == max(p.tf for p in b.postings) for b in blocks)
    assert all(a[1] >= b[0] for a, b in zip(tops, tops[1:])), "blocks don't overlap"


def test_postings_are_shuffled_once(spark):
    """Terms are counted where a chunk is; what a segment shuffles is lists of many postings, not one row a posting."""
    rows = [(i, " ".join(f"w{j % 5}" for j in range(i % 7))) for i in range(3000)]
    parts = D.chunks(spark.createDataFrame(rows, "key long, text string").coalesce(1), "key", "text")
    counts = Ix._term_counts(parts, "bigint")
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    found = {(r.key, t.term): t.tf for r in counts.collect() for t in r.terms}
    assert found == {(i, f"w{k}"): sum(j % 5 == k for j in range(i % 7)) for i in range(3000) for k in range(min(5, i % 7))}
    lists = counts.mapInArrow(Ix._lists(128), "term string, tf bigint, keys array<bigint>, chunk_ids array<int>").collect()
    assert len(lists) < len(found) / 20 and all(len(r.chunk_ids) == len(r["keys"]) <= 128 for r in lists)
    assert {(k, r.term): r.tf for r in lists for k in r["keys"]} == found and sum(len(r["keys"]) for r in lists) == len(found)


def test_repeated_and_missing_keys(spark):
    """The chunks of a key's texts are one by their number; a missing key is counted and not indexed."""
    docs = spark.createDataFrame([(1, "a b"), (1, "a c\nd"), (2, "--"), (3, "a"), (None, "a")], "doc_id long, text string")
    index = Ix.TextIndex(spark)
    assert [(r.status, r.n) for r in index.sync(docs).collect()] == [("added", 5)]
    segments = index.manifest()[1]
    forward = {(r.key, r.chunk_id): {t.term: t.tf for t in r.terms} for r in index._forward(segments).collect() if r.terms}
    assert forward == {(1, 0): {"a": 2, "b": 1, "c": 1}, (1, 1): {"d": 1}, (3, 0): {"a": 1}}
    assert sorted((r.key, r.n_chunks) for r in index._docs(segments).collect()) == [(1, 3), (1, 3), (2, 1), (3, 1)]
    postings = index._blocks(segments).select("term", F.explode("postings").alias("p")).select("term", "p.*").collect()
    assert sorted(map(tuple, postings)) == [("a", 1, 3, 0), ("a", 2, 1, 0), ("b", 1, 1, 0), ("c", 1, 1, 0), ("d", 1, 1, 1)]
