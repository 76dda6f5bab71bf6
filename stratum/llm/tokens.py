"""Whole-text encoding with a public tokenizer, fast enough for a corpus.

The library spends its time merging the same words again and again.  Texts are
therefore cut, as bytes and many texts at once, at places where both
vocabularies start a new pre-token whatever surrounds the cut:

* before a single space, and around a single line feed, between characters that
  are no white space;
* before a full stop or comma that follows a letter.

The library encodes every different span once; a table of bounded size in each
worker keeps what it said, and the ids of the spans, laid end to end, are the ids
of the whole texts (tests compare both).
"""

from __future__ import annotations

import os

import numpy as np

from stratum.llm.common import mix

KNOWN = 800_000   # spans remembered per worker: this bounds memory, not results
LONGEST = 32      # bytes; longer spans are encoded anew for each slice of texts
_WORDS = LONGEST // 8

_SPACE = np.zeros(256, bool)   # ASCII white space and the separators 1C-1F
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_OPEN = ~_SPACE                # may follow a cut: no white space, nor the first byte of any outside ASCII
_OPEN[[0xC2, 0xE1, 0xE2, 0xE3]] = False
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; an absolute path is kept as it is."""
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def cuts(data: np.ndarray) -> np.ndarray:
    """Where the bytes of texts may be cut, besides where a text starts."""
    n = len(data)
    pad = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(1, np.uint8)])
    prev, prev2, prev3, after = pad[2:n + 2], pad[1:n + 1], pad[:n], pad[4:]
    ascii_prev = prev < 0x80
    # a last byte of white space outside ASCII: U+0085, U+00A0 (C2 ..) or three bytes from E1 to E3
    odd = ~ascii_prev & ((prev2 == 0xC2) | ((prev3 >= 0xE1) & (prev3 <= 0xE3)))
    between = ~_SPACE[prev] & ~odd & _OPEN[after]
    line = (data == 0x0A) & between
    # U+00C0 to U+024F but for two signs and the capital I with a dot, which lower-casing parts from its dot
    latin = ((~ascii_prev & (prev2 >= 0xC3) & (prev2 <= 0xC9) & ~((prev2 == 0xC3) & ((prev == 0x97) | (prev == 0xB7))))
             & ~((prev2 == 0xC4) & (prev == 0xB0)))
    mark = ((data == 0x2E) | (data == 0x2C)) & (_ASCII_LETTER[prev] | latin)
    cut = ((data == 0x20) & between) | line | mark
    cut[1:] |= line[:-1]
    return cut


def _different(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """One span of each content, which of them every span equals, and the spans' hashes and first LONGEST bytes.

    The hash only brings spans together; spans are taken as equal when all their bytes are.
    """
    pad = np.zeros(len(data) + LONGEST, np.uint8)
    pad[:len(data)] = data
    view = np.ndarray((len(data) + LONGEST - 7,), "<u8", pad.data, strides=(1,))
    left = np.uint64(64) - np.uint64(8) * np.minimum(8, size).astype(np.uint64)
    words = [view[starts] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> left)]
    h = mix((size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ words[0]) * np.uint64(0xD6E8FEB86659FD93))
    some, longer = np.arange(len(starts)), []
    for k in range(1, _WORDS):
        some = some[size[some] > 8 * k]
        left = np.uint64(64) - np.uint64(8) * np.minimum(8, size[some] - 8 * k).astype(np.uint64)
        w = view[starts[some] + 8 * k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> left)
        h[some] = mix((h[some] ^ w) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(k))
        words.append(np.zeros(len(starts), np.uint64))
        words[k][some] = w
        longer.append(some)
    uniq, first, place = np.unique(h, return_index=True, return_inverse=True)
    like = first[place]
    same = (size == size[like]) & (words[0] == words[0][like]) & (size <= LONGEST)
    for w, some in zip(words[1:], longer):  # of equal size, so both are in ``some`` or neither
        same[some] &= w[some] == w[like[some]]
    # long spans, and spans that share a hash with others, are told apart by their bytes
    extra, by_bytes, raw = [], {}, data.tobytes()
    for i in np.flatnonzero(~same).tolist():
        key = raw[starts[i]:starts[i] + size[i]]
        if key not in by_bytes:
            by_bytes[key] = len(uniq) + len(extra)
            extra.append(i)
        place[i] = by_bytes[key]
    if extra:
        first = np.concatenate([first, np.array(extra, np.int64)])
        # entries that no span equals any more go
        used, place = np.unique(place, return_inverse=True)
        first = first[used]
    return first, place, h, words


class Encoder:
    """Ids of whole texts.  Special-token strings inside a text are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(tokenizer_path(path))
        self.tok.encode_special_tokens = True
        z = np.zeros(0, np.int64)
        # of each known span, in order of its hash: hash, length, place and number of its ids, its bytes
        self.known = [z.astype(np.uint64), z, z, z, *[z.astype(np.uint64)] * _WORDS]
        self.ids = np.zeros(0, np.uint32)

    def _ask(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of spans, laid end to end, and how many each has."""
        raw = data.tobytes()
        said = self.tok.encode_batch_fast([raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())],
                                          add_special_tokens=False)
        ids = [e.ids for e in said]
        return (np.fromiter((i for x in ids for i in x), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[offsets[i]:offsets[i + 1]]``, laid end to end, and where each text's ids start."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        cut = cuts(data)
        cut[offsets[:-1][offsets[:-1] < n]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        size = ends - starts
        first, place, h, words = _different(data, starts, size)
        short = size[first] <= LONGEST
        kh, ks, kat, kn, *kw = self.known
        at = np.minimum(np.searchsorted(kh, h[first]), max(0, len(kh) - 1))
        hit = np.zeros(len(first), bool)
        if len(kh):
            hit = short & (kh[at] == h[first]) & (ks[at] == size[first])
            for k, w in zip(kw, words):
                hit &= k[at] == w[first]
        where, count = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        where[hit], count[hit] = kat[at[hit]], kn[at[hit]]
        ids = self.ids
        new = np.flatnonzero(~hit)
        if len(new):
            said, number = self._ask(data, starts[first[new]], ends[first[new]])
            where[new], count[new] = len(ids) + np.cumsum(number) - number, number
            ids = np.concatenate([ids, said])
            self._learn(new[short[new]], first, h, words, size, where, count, ids)
        number = count[place]
        edge = np.concatenate([[0], np.cumsum(number)])
        out = ids[np.repeat(where[place] - edge[:-1], number) + np.arange(edge[-1])]
        return out, edge[np.searchsorted(starts, offsets)]

    def _learn(self, new, first, h, words, size, where, count, ids) -> None:
        kh = self.known[0]
        new = new[np.unique(h[first[new]], return_index=True)[1]]  # of different spans with one hash, one is remembered
        fresh = new[kh[np.minimum(np.searchsorted(kh, h[first[new]]), len(kh) - 1)] != h[first[new]]] if len(kh) else new
        if len(kh) + len(fresh) > KNOWN:
            return
        f = first[fresh]
        added = [h[f], size[f], where[fresh], count[fresh], *[w[f] for w in words]]
        joined = [np.concatenate(x) for x in zip(self.known, added)]
        order = np.argsort(joined[0], kind="stable")
        self.known = [x[order] for x in joined]
        self.ids = ids

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; a null text has none."""
        raw = [(t or "").encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        ids, edge = self.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary, loaded once per worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
