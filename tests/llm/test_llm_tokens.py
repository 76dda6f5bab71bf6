"""Ops 1 and 3: ids of whole texts, exact cover and round trips."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from llm_cases import awkward, corpus, frame, shipped, with_clashes  # noqa: F401
from stratum.llm import packing, simple8b, tokens

ODD = ["end.\n\nNext x.\nY 3rd, a-b; it's x!?\nZ", "\na b\n", "a b c\u0085 d", "é. ñ, x., ... a...b a.,b\nC 1.5 2,000 ×. ÷,",
       "a  b 　c  d", "", " ", "a", " a", "a ", "a  b", " \n a\n b \t c", "x ́y é", "\x1c a \x1c", "İstanbul ΣΑΣ ς",
       " <|endoftext|> b<|endoftext|>", None, "w" * 300 + " " + "q" * 70 + " x", "日本語 テスト 。", "á b́. ć, e\ńx"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(name, monkeypatch):
    texts = ODD + [r[1] for r in corpus()]
    for known in (800_000, 50):
        monkeypatch.setattr(tokens, "KNOWN", known)
        e = tokens.Encoder(name)
        for _ in range(2):  # the second time from what is known
            for t, got in zip(texts, e.encode_all(texts)):
                want = e.tok.encode(t or "", add_special_tokens=False).ids
                assert np.frombuffer(got, "<u4").tolist() == want, t


def _thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_spans_are_compared_by_their_bytes(name, monkeypatch):
    """Texts that a polynomial hash modulo 2^64 cannot tell apart, and all hashes equal."""
    word = _thue_morse(1024)
    pair = ["q" * 8 + word + "z" * 8, "q" * 8 + word.translate(str.maketrans("ab", "ba")) + "z" * 8]
    texts = [*pair, pair[0], " ".join(pair), "a bb a ccc bb", "İ. İ, a.", "x" * 32 + " " + "x" * 33 + " " + "x" * 32 + " y" * 40]
    for mix in (tokens.mix, lambda x: x * np.uint64(0)):
        monkeypatch.setattr(tokens, "mix", mix)
        e = tokens.Encoder(name)
        for _ in range(2):
            for t, got in zip(texts, e.encode_all(texts)):
                assert np.frombuffer(got, "<u4").tolist() == e.tok.encode(t, add_special_tokens=False).ids, t[:20]


def true_ids(rows, name, end):
    e = tokens.Encoder(name)
    return [e.tok.encode(r[1] or "", add_special_tokens=False).ids + [end] for r in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("rows", [corpus(), []], ids=["corpus", "empty"])
def test_packing_covers_every_id_once(spark, rows):
    out = packing.pack_documents(with_clashes(frame(spark, rows)), with_ids=True).collect()
    ids = dict(zip([r[0] for r in rows], true_ids(rows, "word_bpe_49k.json", 2)))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert len(own) == r.length > 0 and crc(own) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        assert np.frombuffer(r.ids, "<u4").tolist() == own
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts, whole in [(pieces[i], len(x)) for i, x in ids.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at <= 4096 and (at == 4096 or at & (at - 1) == 0) if whole is None else at == whole


def test_packing_of_repeated_rows(spark):
    rows = awkward()
    out = packing.pack_documents(frame(spark, rows)).collect()
    assert sum(r.length for r in out) == sum(map(len, true_ids(rows, "word_bpe_49k.json", 2)))
    assert sum(r.doc_id is None and r.start == 0 for r in out) == 3


def test_placing_balances_cost():
    lengths = np.random.default_rng(0).integers(1, 3000, 3000)
    p, n = packing.place(lengths, 4096, 1.0, 1 / 1024)
    size = np.bincount(p[:, 3], weights=p[:, 2], minlength=n)
    assert size.sum() == lengths.sum() and all(s == 4096 or int(s) & (int(s) - 1) == 0 for s in size)
    cost = np.bincount(p[:, 3], weights=p[:, 2] + p[:, 2] ** 2 / 1024, minlength=n)[size == 4096]
    whole = np.isin(np.arange(n)[size == 4096], p[p[:, 2] == 4096, 3])
    assert cost[~whole].std() / cost[~whole].mean() < 0.1
    assert len(packing.place(np.zeros(0, np.int64), 4096, 1, 1)[0]) == 0


@pytest.mark.parametrize("ids", [[], [0], [1] * 1000, list(range(700)), [2 ** 32 - 1] * 3, [5, 2 ** 22, 7] * 300,
                                 np.random.default_rng(0).zipf(1.2, 6000) % 50257], ids=range(7))
def test_words_round_trip(ids):
    ids = np.array(ids, np.uint32)
    blob = simple8b.encode(ids)
    assert simple8b.decode(blob).tolist() == ids.tolist()
    assert simple8b.decode(blob, 1, 2).tolist() == ids[256:512].tolist()
    if len(ids) > 5000:
        assert len(blob) < 3 * len(ids) and b"S8B1" == blob[:4]


@pytest.mark.parametrize("segment", [1 << 20, 700])
def test_token_files(spark, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(simple8b, "SEGMENT", segment)
    rows = corpus()
    path = str(tmp_path / "files")
    simple8b.write_token_files(with_clashes(frame(spark, rows)), path)
    got = {r.doc_id: r for r in simple8b.read_token_files(spark.read.parquet(path), with_ids=True).collect()}
    at, rows = 0, sorted(rows)
    for r, ids in zip(rows, true_ids(rows, "byte_bpe_50k.json", 0)):
        x = got[r[0]]
        assert (x.start, x.n_tokens, x.ids_crc32) == (at, len(ids), crc(ids))
        assert np.frombuffer(x.ids, "<u4").tolist() == ids
        at += len(ids)


def test_token_files_of_awkward_and_no_rows(spark, tmp_path):
    rows = awkward()
    simple8b.write_token_files(frame(spark, rows), str(tmp_path / "a"))
    got = sorted(simple8b.read_token_files(spark.read.parquet(str(tmp_path / "a"))).collect(), key=lambda r: r.start)
    assert len(got) == len(rows) and [r.doc_id for r in got] == sorted([r[0] for r in rows], key=lambda i: -1 if i is None else i)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    simple8b.write_token_files(frame(spark, []), str(tmp_path / "b"))
    assert simple8b.read_token_files(spark.read.schema(spark.read.parquet(str(tmp_path / "a")).schema)
                                     .parquet(str(tmp_path / "b"))).collect() == []
