"""Ops 2, 6, 9 and 10 against brute force, with awkward rows and small limits."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from llm_cases import WORD, awkward, corpus, frame, roots, shipped, with_clashes  # noqa: F401
from stratum.llm import chunks, lines, simhash, substrings

LAST = (1 << 63) - 1


def ordered(rows):
    """Rows in the operators' order: by doc_id, nulls last, then as equal texts allow."""
    return sorted(rows, key=lambda r: (r[0] if r[0] is not None else LAST, r[1] or ""))


# --- op 6 ---------------------------------------------------------------------------------------

def brute_repeats(rows, length):
    seen, out = set(), []
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            w = b[a:a + length]
            if w in seen:
                gone[a:a + length] = b"\1" * length
            seen.add(w)
        runs = [x for x in bytes(gone).split(b"\0") if x]
        out.append((i, len(b), sum(gone), len(runs), hashlib.sha256(bytes(x for x, y in zip(b, gone) if not y)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [2, 4096])
def test_repeats_are_those_of_brute_force(spark, hot):
    rows = corpus()
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256)
           for r in substrings.remove_repeats(with_clashes(frame(spark, rows)), 100, hot).collect()]
    assert sorted(got) == sorted(brute_repeats(ordered(rows), 100))


def test_repeats_with_awkward_rows(spark):
    rows = [r for r in awkward() if r[0] not in (7,)] + [(7, "only one text here " * 9, "en", "s", 1)] * 3
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans)) for r in substrings.remove_repeats(frame(spark, rows), 100).collect()]
    want = [x[:4] for x in brute_repeats(ordered(rows), 100)]
    assert Counter(got) == Counter(want)
    assert substrings.remove_repeats(frame(spark, []), 100).collect() == []


def test_columns_find_windows_of_earlier_documents():
    rng = np.random.default_rng(3)
    base = rng.integers(97, 100, 40)
    n, length = 30, 12
    text = np.zeros((n, 40), np.uint8)
    begin, end = rng.integers(0, 9, n), rng.integers(31, 41, n)
    group = np.sort(rng.integers(0, 3, n))
    for i in range(n):
        t = base.copy()
        t[rng.integers(0, 40, 2)] = 122
        text[i, begin[i]:end[i]] = t[begin[i]:end[i]]
    rank = rng.permutation(n)
    got = substrings.repeated_windows(group, text, begin, end, rank, length)
    for i in range(n):
        for c in range(got.shape[1]):
            want = begin[i] <= c and c + length <= end[i] and any(
                rank[j] < rank[i] and group[j] == group[i] and begin[j] <= c and c + length <= end[j]
                and (text[j, c:c + length] == text[i, c:c + length]).all() for j in range(n))
            assert got[i, c] == want


# --- op 10 --------------------------------------------------------------------------------------

def test_chunks_cover_texts_and_survive_insertions():
    text = (" ".join(f"w{i * i % 977}" for i in range(3000))).encode()

    def parts(b):
        d = np.frombuffer(b, np.uint8)
        s, e = chunks.cut(d, np.array([0, len(d)]))
        assert s[0] == 0 and e[-1] == len(d) and (s[1:] == e[:-1]).all() and (e - s <= chunks.MOST).all()
        return [b[x:y] for x, y in zip(s, e)]
    a, b = parts(text), parts(text[:5000] + b" inserted words here " + text[5000:])
    assert len(set(a) - set(b)) <= 3


@pytest.mark.parametrize("letters", ["日本語文字列検索中国汉字", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdef0123456789+/"])
def test_chunks_without_spaces_survive_insertions(letters):
    text = "".join(np.random.default_rng(5).choice(list(letters), 20000))

    def parts(t):
        d = np.frombuffer(t.encode(), np.uint8)
        s, e = chunks.cut(d, np.array([0, len(d)]))
        assert s[0] == 0 and e[-1] == len(d) and (s[1:] == e[:-1]).all() and (e - s <= chunks.MOST).all()
        return [t.encode()[x:y].decode() for x, y in zip(s, e)]
    a, b = parts(text), parts(text[:700] + letters[0] + text[700:])
    assert len(a) > 100 and len(set(a) - set(b)) <= 3


def test_passages_of_fifty_words_are_found():
    """Planted in other surroundings, each of 300 leaves a run of copied chunks that is long enough."""
    rng = np.random.default_rng(7)

    def prose(n):
        return " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(2, 9)))) for _ in range(n))
    for _ in range(300):
        passage, seen, run, best = prose(50), set(), 0, 0
        for text in (f"{prose(40)} {passage} {prose(40)}".encode() for _ in range(2)):
            start, end = chunks.cut(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
            parts = [text[x:y] for x, y in zip(start, end)]
            if seen:
                for part in parts:
                    run = run + len(part) if part in seen else 0
                    best = max(best, run)
            seen.update(parts)
        assert best >= chunks.RUN


@pytest.mark.parametrize("rows", [corpus(), awkward()], ids=["plain", "awkward"])
def test_chunk_dedup(spark, rows):
    if rows is not None and any(r[0] is None for r in rows):
        rows = [r for r in rows if r[0] not in (7, None)] + [(None, "lost and found " * 12, "en", "s", 1)] * 2
    seen, want = set(), []
    for i, t, *_ in ordered(rows):
        b = np.frombuffer((t or "").encode(), np.uint8)
        start, end = chunks.cut(b, np.array([0, len(b)]))
        gone = np.zeros(len(b), bool)
        for x, y in zip(start, end):
            gone[x:y] = b[x:y].tobytes() in seen
            seen.add(b[x:y].tobytes())
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(int)))
        runs = 0
        for x, y in zip(edge[::2], edge[1::2]):
            gone[x:y] = y - x >= min(chunks.RUN, len(b))
            runs += bool(gone[x])
        want.append((i, len(b), int(gone.sum()), runs, b[~gone].tobytes().decode()))
    got = [tuple(r) for r in chunks.dedup_chunks(with_clashes(frame(spark, rows))).collect()]
    assert Counter(got) == Counter(want)


def test_chunk_dedup_of_nothing(spark):
    assert chunks.dedup_chunks(frame(spark, [])).collect() == []


# --- op 2 ---------------------------------------------------------------------------------------

def brute_lines(rows, min_chars):
    texts = [t.split("\n") if t is not None else [] for _, t, *_ in rows]
    gone = [[False] * len(t) for t in texts]
    width = 1
    while width <= max(map(len, texts), default=0):
        seen = set()
        for t, g in zip(texts, gone):
            for a in range(len(t) - width + 1):
                run = tuple(t[a:a + width])
                if run in seen and sum(map(len, run)) >= min_chars:
                    g[a:a + width] = [True] * width
                seen.add(run)
        width *= 2
    return [(r[0], None if r[1] is None else "\n".join(x for x, y in zip(t, g) if not y), len(t), sum(g))
            for r, t, g in zip(rows, texts, gone)]


@pytest.mark.parametrize("min_chars", [1, 40])
def test_line_dedup(spark, min_chars):
    rows = corpus()
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(with_clashes(frame(spark, rows)), min_chars).collect()]
    key = lambda r: (r[0], r[1] or "")
    assert sorted(got, key=key) == sorted(brute_lines(ordered(rows), min_chars), key=key)


def test_line_dedup_with_awkward_rows(spark):
    rows = [r for r in awkward() if r[0] != 7]
    out = lines.dedup_lines(frame(spark, rows))
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect())
    assert got == Counter(brute_lines(ordered(rows), 40))
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert lines.dedup_lines(frame(spark, [])).collect() == []


def brute_runs(rows, min_chars):
    """Like brute_lines, with runs of every number of lines."""
    texts = [t.split("\n") if t is not None else [] for _, t, *_ in rows]
    gone = [[False] * len(t) for t in texts]
    live, width = [(d, a) for d, t in enumerate(texts) for a in range(len(t))], 1
    while live:
        run = {(d, a): tuple(texts[d][a:a + width]) for d, a in live if a + width <= len(texts[d])}
        count, seen = Counter(run.values()), set()
        for (d, a), r in run.items():
            if r in seen and sum(map(len, r)) >= min_chars:
                gone[d][a:a + width] = [True] * width
            seen.add(r)
        live, width = [p for p in run if count[run[p]] > 1], width + 1
    return [(r[0], None if r[1] is None else "\n".join(x for x, y in zip(t, g) if not y), len(t), sum(g))
            for r, t, g in zip(rows, texts, gone)]


@pytest.mark.parametrize("min_chars", [0, 1, 9, 40])
def test_line_runs_of_every_width(spark, min_chars):
    """Runs of 3, 5, 6, 7 short lines, short lines at the edges of long ones, blank lines."""
    rng = np.random.default_rng(min_chars)
    parts = ["\n".join("x" * int(n) + str(i * 10 + j) for j, n in enumerate(rng.integers(0, 14, w))) for i, w in enumerate((3, 5, 6, 7, 3, 11))]
    parts += ["tail\n" + "long line " * 5 + "\nto\nbe", "\n" * 9, "a\nb\na\nb", "y" * 45]
    texts = ["\n".join(parts[int(p)] for p in rng.integers(0, len(parts), 4)) + f"\nonly {i}\n" + parts[i % len(parts)] for i in range(40)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(frame(spark, rows), min_chars).collect()]
    assert sorted(got) == sorted(brute_runs(rows, min_chars))


def test_line_runs_of_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(docs).collect()]
    assert sorted(got) == sorted(brute_runs(ordered([tuple(r) for r in docs.collect()]), 40))


# --- op 9 ---------------------------------------------------------------------------------------

def brute_fingerprint(text, shingle=3):
    import xxhash
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    count = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(parts))


@pytest.mark.parametrize("bucket", [4, 2048])
def test_simhash(spark, bucket):
    rows = awkward() + [(500 + i, "UPPER Case words HERE É", "en", "s", 1) for i in range(3)]
    got = simhash.simhash_components(with_clashes(frame(spark, rows)), 3, 3, bucket).collect()
    fps = [brute_fingerprint(r[1]) for r in rows]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3]
    root = roots(len(fps), links)
    least = {}
    for r, c in zip(rows, root):
        if r[0] is not None:
            least[c] = min(least.get(c, LAST), r[0])
    want = Counter((r[0], f, least.get(c)) for r, f, c in zip(rows, fps, root))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want
    kept = simhash.keep_one(with_clashes(frame(spark, rows))).collect()
    assert len(kept) == len(set(root)) and {r.doc_id for r in kept} == {least.get(c) for c in root}
    assert kept[0].asDict().keys() >= {"doc_id", "text", "k", "fp", "a.b"}


def test_simhash_of_nothing(spark):
    assert simhash.simhash_components(frame(spark, [])).collect() == []
    assert simhash.keep_one(frame(spark, [])).collect() == []


@pytest.mark.parametrize("n", [50, 1e6, 1e12])
def test_parts_obey_the_pigeonhole(n):
    sample = np.random.default_rng(0).integers(0, 1 << 63, 200, dtype=np.uint64)
    parts = simhash.choose_parts(sample, n, 3)
    bits = [b for p, _ in parts for b in p]
    assert len(bits) == len(set(bits)) and sum(t + 1 for _, t in parts) == 4


def test_probes_find_all_links(spark):
    """Thresholds above zero, as large tables get them, find the same links."""
    rng = np.random.default_rng(1)
    fps = list({int(x) for x in rng.integers(0, 1 << 62, 40)})
    fps += [f ^ (1 << int(a)) ^ (1 << int(b)) for f in fps[:20] for a, b in [rng.integers(0, 62, 2)]]
    df = spark.createDataFrame([(f,) for f in dict.fromkeys(fps)], "fp long")
    halves = [(list(range(32)), 1), (list(range(32, 64)), 1)]
    sigs = simhash._signatures(df, halves).selectExpr("cast(part as long) part", "sig", "0L lo", "0L hi",
                                                     "cast(probe as long) probe", "0L side", "fp")
    keys = ["part", "sig", "lo", "hi"]
    found = sigs.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(simhash._verify(3), "u long, v long").collect()
    fps = list(dict.fromkeys(fps))
    links = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3]
    at = {f: i for i, f in enumerate(fps)}
    assert roots(len(fps), links) == roots(len(fps), [(at[r.u], at[r.v]) for r in found])
