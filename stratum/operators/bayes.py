"""A learned text classifier (J2): multinomial naive Bayes by distributed counts.

Fitting counts (term, label) pairs of the labelled texts, with a partial aggregate before the
shuffle, and keeps the ``max_terms`` commonest terms: that parameter bounds the model,
whatever the corpus. Scoring joins every text's terms with the model's, a side of at most
``max_terms`` rows, and sums the terms' logarithms per text; a text's terms are still
in one partition then, so one row a text is shuffled.

Defined cases: unlabelled rows and labels not asked for don't count in fitting; texts without
a known term (null, empty, foreign) get the last label, the default; equal scores go to
the earlier label; a label without a text is never chosen; with no labelled text at all every
text gets the default; repeated rows are rows of their own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.session import written

MAX_TERMS = 1 << 16
_EXACT = {"tinyint", "smallint", "int", "bigint", "boolean", "date", "timestamp", "timestamp_ntz", "string", "binary"}
TERMS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def terms_of(text: Column) -> Column:
    """Runs of letters and digits and runs of other marks, in lower case: shouting and symbols count as terms."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERMS), 0)



@dataclass(frozen=True)
class NaiveBayes:
    """labels in order, the logarithm of each label's share (None: no text), and the table (term, logs) of at most ``max_terms`` rows."""
    labels: tuple[str, ...]
    priors: tuple[float | None, ...]
    terms: DataFrame


def fit_naive_bayes(texts: DataFrame, labels: Sequence[str], label: str = "label", text: str = "text",
                    max_terms: int = MAX_TERMS, smoothing: float = 1.0) -> NaiveBayes:
    """Fitted on the rows of ``texts`` whose ``label`` is one of ``labels``."""
    known = texts.where(F.col(label).isin(*labels)).select(F.col(label).alias("label"), F.col(text).alias("text"))
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # one row a label
    pairs = known.select("label", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term", "label").agg(F.count("*").alias("n"))
    counts = pairs.groupBy("term").agg(F.sum("n").alias("all"), *[
        F.coalesce(F.sum(F.when(F.col("label") == x, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, x in enumerate(labels)])
    counts = written(counts.orderBy(F.desc("all"), "term").limit(max_terms), "bayes-counts")
    totals = counts.agg(F.count("*").alias("v"), *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"t{i}") for i in range(len(labels))]).first()
    logs = F.array(*[F.log((F.col(f"n{i}") + F.lit(float(smoothing))) / F.lit(totals[f"t{i}"] + smoothing * max(1, totals["v"])))
                     for i in range(len(labels))])
    priors = tuple(math.log(n[x] / sum(n.values())) if n.get(x) else None for x in labels)
    return NaiveBayes(tuple(labels), priors, written(counts.select("term", logs.alias("logs")), "bayes-terms"))


def best_label(model: NaiveBayes, sums: Column) -> Column:
    """The label of the largest prior + sum, the earlier of equal ones."""
    scores = F.array(*[F.get(sums, F.lit(i)) + F.lit(p) if p is not None else F.lit(float("-inf")) for i, p in enumerate(model.priors)])
    return F.element_at(F.array(*[F.lit(x) for x in model.labels]),
                        F.element_at(F.transform(F.array(scores), lambda s: F.array_position(s, F.array_max(s))), 1).cast("int"))


def classify_texts(docs: DataFrame, model: NaiveBayes, text: str = "text", out: str = "label") -> DataFrame:
    """The rows of ``docs`` without ``text``, with the label in ``out`` and the number of known tokens in ``n_known``."""
    rest = [c for c in docs.schema.fields if c.name != text]
    rows = docs.select(*[F.col(f"`{c.name}`").alias(f"_r{i}") for i, c in enumerate(rest)], F.col(f"`{text}`").alias("text"),
                       F.monotonically_increasing_id().alias("at"))
    # values that are equal only if they are the same go with the key: with them in the sums, Spark would sort all tokens
    keys = [f"_r{i}" for i, c in enumerate(rest) if c.dataType.simpleString() in _EXACT]
    held = [f"_r{i}" for i in range(len(rest)) if f"_r{i}" not in keys]
    terms = rows.select("at", *keys, *held, F.explode_outer(terms_of(F.col("text"))).alias("term"))
    hits = terms.join(F.broadcast(model.terms), "term", "left")  # at most max_terms rows
    sums = [F.coalesce(F.sum(F.get("logs", F.lit(i))), F.lit(0.0)) for i in range(len(model.labels))]
    told = hits.groupBy("at", *keys).agg(*[F.first(c).alias(c) for c in held], F.count("logs").alias("n_known"), F.array(*sums).alias("sums"))
    label = F.when((F.col("n_known") > 0) & F.lit(any(p is not None for p in model.priors)), best_label(model, F.col("sums")))
    return told.select(*[F.col(f"_r{i}").alias(c.name) for i, c in enumerate(rest)], F.coalesce(label, F.lit(model.labels[-1])).alias(out), "n_known")
