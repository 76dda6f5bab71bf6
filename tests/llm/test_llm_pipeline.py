"""The pipeline's stages on their own inputs, against plain versions, and the registration."""

from collections import Counter

import pytest

from conftest import SF_SMALL
from llm_cases import shipped  # noqa: F401
from test_llm_text import brute_fingerprint, brute_lines, brute_runs, ordered
from llm_cases import roots

import corpus_pipeline as P
from stratum.llm.common import written


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, stage in P.STAGES:
        made = written(stage(spark, docs, SF_SMALL), "test-stage")
        out[name], docs = (docs.collect(), made.collect()), made
    return out


def test_stages_in_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "lines", "near_duplicates", "mixing", "packing"]
    for name in list(stages)[:-1]:
        assert list(stages[name][1][0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_rejects_junk_and_keeps_clean(spark, stages):
    before, after = stages["quality"]
    kept = {r.doc_id for r in after}
    labels = [r for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()]
    clean = [r.doc_id for r in labels if r.quality == 1 and r.toxic == 0]
    junk = [r.doc_id for r in labels if r.quality == 0]
    assert set(map(tuple, after)) <= set(map(tuple, before))
    assert sum(i in kept for i in clean) >= 0.95 * len(clean) and sum(i in kept for i in junk) <= 0.4 * len(junk)


def test_lines_stage(stages):
    before, after = stages["lines"]
    want = {i: t for i, t, _, _ in brute_lines(ordered([(r.doc_id, r.text) for r in before]), 40)}
    assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after)


def test_lines_stage_with_runs_of_every_width(stages):
    before, after = stages["lines"]
    want = {i: t for i, t, _, _ in brute_runs(ordered([(r.doc_id, r.text) for r in before]), 40)}
    assert {r.doc_id: r.text for r in after} == want


def test_near_duplicates_stage(stages):
    before, after = stages["near_duplicates"]
    fps = [brute_fingerprint(r.text) for r in before]
    root = roots(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3])
    want = {min(before[i].doc_id for i in range(len(fps)) if root[i] == c) for c in set(root)}
    assert Counter(r.doc_id for r in after) == Counter(want)


def test_mixing_and_packing_stages(stages):
    before, after = stages["mixing"]
    copies = Counter(r.doc_id for r in after)
    assert set(map(tuple, after)) <= set(map(tuple, before)) and max(copies.values()) <= 3
    packed = stages["packing"][1]
    assert Counter(r.doc_id for r in packed if r.start == 0) == copies
    assert all(n == 4096 or n & (n - 1) == 0 for n in {r.sequence_id: r.sequence_tokens for r in packed}.values())


def test_every_operator_is_registered():
    import __spark_entry__ as E
    names = list(E.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)
