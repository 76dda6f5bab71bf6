"""Token counts of whole texts: lengths only, no ids.

Texts go to Python as Arrow batches.  Each is split at safe boundaries: before a
single space or line feed between other characters, and before a full stop, comma
and the like after a letter, where the vocabularies start a new pre-token whatever
surrounds the boundary.  Pieces that the worker has not counted yet go to the library
in batches of about equal bytes, and only the length of each answer is kept.  A text's count is the sum over its pieces; tests hold
it against the library's count of the whole text.

A .json vocabulary is read by ``tokenizers`` (special-token strings inside a text
count as the library's default has it), a .model one by ``sentencepiece``, whose
pieces are split at single spaces between ASCII letters or digits, and only if no
entry of the vocabulary spans a word's start.

Defined cases: a null or empty text has 0 bytes and 0 tokens, a text without a safe
boundary is one piece, repeated rows are rows of their own, an empty table gives
no rows, other columns are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.tokens import tokenizer_path

BATCH = 1 << 20     # bytes of new pieces that the library gets at once
KNOWN = 800_000     # pieces a worker remembers: this bounds memory, not results
LONGEST = 64        # longer pieces are counted each time

# Letters that lower-casing and composing leave one letter (so not U+0130), and others before which marks are split.
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_EAST = "ぁ-ゖァ-ヺ一-鿿가-힣"
# A piece starts where the text does, at a single space or line feed between other characters, or at a mark after a letter;
# other white space stays inside a piece, and so does any at the ends of the text.
_PIECES = re.compile(
    rf"(?:\A\s*|[ \n]|(?<=[{_LATIN}])(?=[.,])|(?<=[{_EAST}])(?=[。、！？]))"
    rf"(?:[^\s.,。、！？]+|(?:[.,]|[。、！？])[^\s.,。、！？]*)(?:(?:(?<![{_LATIN}])[.,]|(?<![{_EAST}])[。、！？])[^\s.,。、！？]*)*"
    r"(?:(?:\s{2,}|[^\S \n])\S+)*(?:\s+\Z)?|\A\s+\Z")
_WORDS = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def pieces(text: str) -> list[str]:
    """The pieces of a text for a .json vocabulary; joined, they are the text."""
    return _PIECES.findall(text)


class Counter:
    """Token counts by one vocabulary, with the counts of the pieces met so far."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer_path(name)
        self.split, self.ask = _model(path) if path.endswith(".model") else _json(path)
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        split, known = [self.split(t) for t in texts], self.known
        fresh: dict[str, int] = {}
        batch, size = [], 0
        for p in {p for x in split for p in x if p not in known}:
            batch.append(p)
            size += len(p.encode())
            if size >= BATCH:
                fresh.update(zip(batch, self.ask(batch)))
                batch, size = [], 0
        fresh.update(zip(batch, self.ask(batch)))
        room = len(known) + len(fresh) <= KNOWN
        known.update(fresh)
        out = [sum(map(known.__getitem__, x)) for x in split]
        for p in fresh:
            if not room or len(p) > LONGEST:
                del known[p]
        return out


def _json(path: str) -> tuple[Callable, Callable]:
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return pieces, lambda batch: [len(e) for e in tok.encode_batch_fast(batch, add_special_tokens=False)]


def _model(path: str) -> tuple[Callable, Callable]:
    import sentencepiece
    tok = sentencepiece.SentencePieceProcessor(model_file=path)
    start = "▁"  # how the library writes a word's start
    names = [tok.id_to_piece(i).lstrip(start) for i in range(tok.get_piece_size())]
    whole = any(start in n for n in names) or not tok.encode("a", out_type=str)[0].startswith(start)
    return (lambda t: [t]) if whole else _WORDS.split, lambda batch: [len(x) for x in tok.encode(batch, num_threads=1)]


_COUNTERS: dict[str, Counter] = {}


def counter(name: str) -> Counter:
    """The worker's counter for a vocabulary, loaded once per worker."""
    if name not in _COUNTERS:
        _COUNTERS[name] = Counter(name)
    return _COUNTERS[name]


def _in_batches(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            size = [len(t.encode()) for t in texts]
            out, i = [], 0
            while i < len(texts):  # runs of rows of about BATCH bytes
                j, n = i, 0
                while j < len(texts) and (j == i or n + size[j] <= BATCH):
                    n += size[j]
                    j += 1
                out += counter(name).counts(texts[i:j])
                i = j
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(out, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row; no shuffle."""
    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _in_batches(tokenizer), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
