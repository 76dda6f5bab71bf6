"""Small tables with every awkward case, and plain helpers the tests share."""

import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# extra columns named like those that the operators use inside
CLASH = ("k long, twin long, fp long, h long, size long, key double, row string, id long, block long, label long, "
         "n_lines long, n_removed long, copies long, none boolean, `a.b` string")


def words(rng, n):
    return [rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else
            "".join(rng.choice(["er", "on", "th", "é", "ble", "sh"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def corpus(seed=0):
    """Rows (doc_id, text, lang, source, n_chars): copies, near copies, shared passages and lines, empties, a long text."""
    rng = random.Random(seed)
    passage, line = " ".join(words(rng, 70)), " ".join(words(rng, 12)) + "."
    texts = []
    for i in range(60):
        paragraphs = [" ".join(words(rng, rng.randint(3, 60))) for _ in range(rng.randint(1, 4))]
        if i % 4 == 0:
            paragraphs.insert(rng.randint(0, len(paragraphs)), line)
        if i % 5 == 0:
            paragraphs[0] = " ".join(words(rng, 5)) + " " + passage + " " + " ".join(words(rng, 5))
        texts.append("\n".join(paragraphs))
    base = " ".join(words(rng, 120)).split()
    for i in range(12):  # near copies
        w = list(base)
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [texts[3]] * 5 + ["", "x", "\n\n\n", "a\nb\nc\n" * 9 + "zz", "a\nb\nc\n" * 7, "be " * 400, "日本語 テスト。 é́", "q" * 350,
                               " \t two  words \x0b", " ".join(words(rng, 9000)), None]
    rows = [(i, t, "en", rng.choice(["s1", "s1", "s1", "s2", None]), len(t) if t else None) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def awkward(seed=0):
    """The corpus with null ids, repeated ids with other texts, and repeated rows."""
    rows = corpus(seed)
    again = [r for r in rows if r[0] in (1, 7, 20)]
    return rows + again + again[:1] + [(None, "lost and found " * 12, None, "s2", None), (None, None, "en", None, 3),
                                       (None, "lost and found " * 12, "de", "s2", None), (7, "another text under this id", "en", "s1", 26)]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    from stratum.llm.common import ship
    ship(spark)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F
    names = [c.rsplit(" ", 1) for c in CLASH.split(", ")]
    return df.select("*", *[F.lit(None).cast(t).alias(n.strip("`")) for n, t in names])


def roots(n, links):
    p = list(range(n))

    def find(x):
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
