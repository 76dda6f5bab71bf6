"""Ops 11 to 13 against the libraries' own counts and plain models."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_cases import awkward, corpus, frame, shipped, with_clashes  # noqa: F401
from stratum.llm import merkle, token_counts, trie
from stratum.llm.tokens import tokenizer_path

# pieces that tempt a wrong cut: white space of all kinds, marks, composing characters, special-token strings
ALPHABET = ["a", "B", "'s", " ", "  ", "\n", "\r\n", "\t", "é", "́", " ́", "漢", "か", "゙", "。", "、", "1", "²",
            "<|endoftext|>", "<|startoftext|>", ".", ",", "-", "\x1c", " ", "　", "\x85", "Σ", "İ", "한", "ᄀ", "ᅡ",
            "🙂", "‍", "_", "’", "ß", "᠎", "̇", "word ", " the"]


def library(name):
    if name.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        return lambda t: len(sp.encode(t))
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path(name))
    return lambda t: len(tok.encode(t, add_special_tokens=False))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
@pytest.mark.parametrize("known", [800_000, 40])
def test_counts_of_pieces_are_those_of_texts(name, known, monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN", known)
    monkeypatch.setattr(token_counts, "LONGEST", 9)
    monkeypatch.setattr(token_counts, "BATCH", 200)
    rng, c, count = random.Random(known), token_counts.Counter(name), library(name)
    for _ in range(25):
        texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(60)]
        assert all("".join(token_counts.pieces(t)) == t for t in texts)
        assert c.counts(texts) == [count(t) for t in texts]


@pytest.mark.parametrize("rows", [awkward() + [(900, "漢字、" * 4000, "zh", "s", 1), (901, "<|endoftext|> and <|startoftext|>x", "en", "s", 1)],
                                  []], ids=["awkward", "empty"])
def test_token_counts(spark, rows):
    count = library("word_bpe_49k.json")
    got = Counter(tuple(r) for r in token_counts.count_tokens(with_clashes(frame(spark, rows)), limit=100).collect())
    assert got == Counter((r[0], len((r[1] or "").encode()), count(r[1] or ""), count(r[1] or "") > 100) for r in rows)


# --- trie --------------------------------------------------------------------------------------

CONVERSATIONS = "conv_id long, turn long, role string, text string, depth long, p string, parent string, owner long, at long, x int"


def conversations(seed=0):
    """Rows with shared openings, whole copies, one long conversation, gaps, nulls, repeated turns."""
    rng = random.Random(seed)
    rows = []
    for c in range(80):
        if c % 11 == 10:
            continue
        first = rng.choice(["hello", "hello", "hello", "who?", "née"])
        n = 0 if c == 33 else rng.choice([1, 2, 3, 7, 12])
        for t in range(n):
            rows.append((c, t * 2, rng.choice(["user", "user", "system"]) if t else "user", first if t == 0 else rng.choice(["yes", "no"])))
    rows += [(c, t, "user", f"copy {t}") for c in range(200, 230) for t in range(5)]
    rows += [(400, t, "user", f"long {t % 7}") for t in range(150)] + [(404, t, "user", f"long {t % 7}") for t in range(149)]
    rows += [(5, None, None, "nothing"), (5, None, None, None), (6, 1, "user", "twice"), (6, 1, "user", "twice"), (None, 1, "user", "lost")]
    rng.shuffle(rows)
    return [(*r, None, None, "x", 1, 2, 3) for r in rows]


def plain_trie(rows):
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            role, text = r[2] or "", r[3] or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[r[0]].append((r[1] is not None, r[1] or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(x)] for c, x in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = own.get(c - c % 5, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((c, len(whole)))
    out = set()
    for node, m in members.items():
        below = [k for k in members if k[:len(node)] == node]
        children = [k for k in below if len(k) == len(node) + 1]
        inner = {k[:-1] for k in below if k}
        ends = ",".join(str(c) for c, n in sorted(m) if n == len(node))
        out.add((min(m)[0], len(node), min(members[node[:-1]])[0] if node else None, len(m), len(children), sum(k not in inner for k in below),
                 sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k), hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("limit, run, chunk", [(trie.LIMIT, trie.RUN, trie.CHUNK), (40, 4, 3)], ids=["production", "small"])
def test_prefix_trie(spark, monkeypatch, limit, run, chunk):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rows = conversations()
    got = trie.prefix_trie(trie.shared_openings(spark.createDataFrame(rows, CONVERSATIONS)), limit, run).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert trie.prefix_trie(trie.shared_openings(spark.createDataFrame([], CONVERSATIONS))).collect() == []


@pytest.mark.parametrize("shape", ["path", "star", "random", "one"])
def test_centroids_sum_every_subtree(shape):
    rng = random.Random(1)
    n = 1 if shape == "one" else 300
    parent = [-1] + [{"path": i - 1, "star": 0}.get(shape, rng.randrange(i)) for i in range(1, n)]
    w = [rng.randrange(100) for _ in range(n)]
    want = list(w)
    for i in range(n - 1, 0, -1):
        want[parent[i]] += want[i]
    assert trie.decompose(parent, [w, [1] * n])[0] == want


# --- manifest ----------------------------------------------------------------------------------

def h(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def plain_manifest(rows, columns=("doc_id", "source", "lang", "n_chars", "text")):
    names = ("doc_id", "text", "lang", "source", "n_chars")

    def leaf(row, more=0):
        v = dict(zip(names, row))
        v["n_chars"] = v["n_chars"] if v["n_chars"] is None else v["n_chars"] + more
        return h(*["-" if v[c] is None else f"{len(str(v[c]).encode())}:{v[c]}" for c in columns])

    def tree(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(t, i):
        return [(x[(i >> k) ^ 1] if (i >> k) ^ 1 < len(x) else None, i >> k & 1) for k, x in enumerate(t[:-1])]

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for j, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, j)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            at = leaf(r, 1 if hit else 0)
            for other, right in steps:
                at = h(at) if other is None else h(other, at) if right else h(at, other)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], h(*[x for x, _ in steps if x]), at, at == top[-1][0]))
    return Counter(out)


def many_groups():
    rows = corpus()
    return awkward() + [(1000 + i, r[1], f"l{i % 13}", r[3], None if i % 3 else (1 << 63) - 1) for i, r in enumerate(rows)]


@pytest.mark.parametrize("rows, height", [(awkward(), merkle.HEIGHT), (many_groups(), 2), ([], 3), (awkward()[:1], 1)],
                         ids=["awkward", "groups", "empty", "one"])
def test_manifest(spark, rows, height):
    docs = with_clashes(frame(spark, rows))
    got = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
                          {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1},
                          F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, height)
    assert Counter(tuple(r) for r in got.collect()) == plain_manifest(rows)


@pytest.mark.parametrize("levels", range(1, 12))
def test_layout_keeps_subtrees_together(levels):
    import numpy as np
    at = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(at).tolist()) == list(range((1 << levels) - 1))
    upper = levels // 2
    if upper:
        for i in range(1 << upper):  # each subtree below the upper half is one run of places
            places = np.concatenate([at[d][i << (d - upper):(i + 1) << (d - upper)] for d in range(upper, levels)])
            assert places.max() - places.min() == len(places) - 1
