"""Document functions re-aimed as Spark jobs.

The reference calls hosted models to parse, classify and extract. Here each is
a deterministic, JVM-side expression over the whole text (no prefixes, no
samples), so it runs inside whole-stage codegen on every partition:

* parse: markup -> plain text and block elements (regular expressions);
* classify: keyword counts per label over the tokenised text, arg-max in label order;
* extract: schema-driven regular-expression rules -> JSON -> VARIANT;
* retrieve: tf-idf over paragraph chunks with an inverted-index join, top-k per question.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.operators import aggregate as A
from stratum.operators import timeseries as ts
from stratum.session import written

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text) -> Column:
    """Lower-cased letter/digit runs of the whole text (empty tokens dropped)."""
    return F.array_remove(F.split(F.lower(_c(text)), TOKEN_SPLIT), "")


# --- J1 parse ------------------------------------------------------------------------------------

def html_text(html) -> Column:
    """J1 native path: drop script / style / comments, tags -> space,
    decode the five basic entities, collapse whitespace."""
    t = _c(html)
    s = F.regexp_replace(t, r"(?s)<script\b.*?</script>", " ")
    s = F.regexp_replace(s, r"(?s)<style\b.*?</style>", " ")
    s = F.regexp_replace(s, r"(?s)<!--.*?-->", " ")
    s = F.when(F.contains(t, F.lit("<")), F.regexp_replace(s, r"<[^>]*>", " ")).otherwise(t)
    plain = s
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(ent), F.lit(ch))
    s = F.when(F.contains(t, F.lit("&")), plain).otherwise(s)
    # a single space stays as it is
    return F.trim(F.regexp_replace(s, r"[\t\n\x0B\f\r]\s*| \s+", " "))


def html_title(html) -> Column:
    return F.trim(F.regexp_extract(_c(html), r"(?s)<title[^>]*>(.*?)</title>", 1))


def parse_docs(df: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """Parse once -> (key, title, parsed_content, n_chars, elements).

    ``elements`` are the heading / paragraph / list blocks in order as
    ``{id, type, text}``; the parsed text is stored so later steps reuse it."""
    blocks = F.regexp_extract_all(_c(html), F.lit(r"(?s)<(h[1-6]|p|li)\b[^>]*>.*?</\1>"), 0)
    kinds = F.regexp_extract_all(_c(html), F.lit(r"(?s)<(h[1-6]|p|li)\b[^>]*>.*?</\1>"), 1)
    elements = F.transform(F.arrays_zip(kinds.alias("k"), blocks.alias("b")), lambda e, i: F.struct(
        i.alias("id"), F.when(e["k"].startswith("h"), "heading").when(e["k"] == "li", "list_item")
        .otherwise("paragraph").alias("type"), html_text(e["b"]).alias("text")))
    text = html_text(html)
    return df.select(key, html_title(html).alias("title"), text.alias("parsed_content"),
                     F.length(text).alias("n_chars"), elements.alias("elements"))


# --- J2 classify -----------------------------------------------------------------------------------

def classify(text, labels: Mapping[str, Sequence[str]], tokenized: bool = False) -> Column:
    """Label with the most keyword hits in the tokenised text; ties go
    to the earlier label; no hit -> the last label (the catch-all).

    With ``tokenized=True`` ``text`` is an array of tokens computed once in
    an earlier projection (see :func:`with_tokens`), so several classifiers
    share one tokenisation of the whole text."""
    toks = _c(text) if tokenized else tokens(text)
    names = list(labels)
    keywords = sorted({k for kws in labels.values() for k in kws})
    if not keywords:
        return F.lit(names[-1])

    def label(hits: Column) -> Column:
        scores = [F.size(F.filter(hits, lambda t: t.isin(*kws))) if kws else F.lit(0) for kws in labels.values()]
        best = F.greatest(*scores) if len(scores) > 1 else scores[0]
        out = F.when(best == 0, F.lit(names[-1]))
        for n, s in zip(names, scores):
            out = out.when(s == best, F.lit(n))
        return out

    # one pass over all tokens; the labels' counts then read the keywords among them
    found = F.filter(F.coalesce(toks, F.array().cast("array<string>")), lambda t: t.isin(*keywords))
    return F.element_at(F.transform(F.array(found), label), 1)


def with_tokens(df: DataFrame, text: str, out: str = "_tokens") -> DataFrame:
    """Tokenise once into a column (an expensive alias used by several later
    expressions is not inlined again by the optimizer)."""
    return df.withColumn(out, tokens(text))


# Document-type and sector labels, and the keywords of our
# keyword classifier (drawn from words that occur in the corpus).
DOC_TYPE_LABELS = {
    "SEC_10K_Annual_Report": ["the", "der", "le"],
    "SEC_10Q_Quarterly_Report": ["and", "und", "et"],
    "Annual_Report": ["of", "die", "la"],
    "Earnings_Release": ["is", "in", "el"],
    "Other_Financial_Document": [],
}
SECTOR_LABELS = {
    "Semiconductor": ["er", "en"], "Consumer_Electronics": ["an", "on"], "Software": ["th", "he"],
    "Financial_Services": ["es", "de"], "Healthcare": ["ou", "eau"], "Energy": ["sch", "ch"],
    "Retail": ["que", "qui"], "Other": [],
}


# --- J3 extract ------------------------------------------------------------------------------------

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
URL = r"https?://[^\s<>\"]+"
LICENSE = r"(?i)(?:licen[cs]e[^\n]*)"
YEAR = r"\b(?:19|20)[0-9]{2}\b"
_IN_MATCHES = {EMAIL: "@", URL: "://"}  # what every match contains


def extract(text, rules: Mapping[str, tuple[str, str]] | None = None) -> Column:
    """``{response: {...}}`` as VARIANT from schema-driven rules.

    ``rules``: field -> (kind, pattern) with kind 'first' (first match or
    NULL), 'all' (array of matches), 'count' (number of matches) or 'flag'.
    The default extracts title, emails, URLs, licence line, years, counts."""
    t = _c(text)
    rules = rules or {"emails": ("all", EMAIL), "urls": ("all", URL), "license_line": ("first", LICENSE),
                      "first_year": ("first", YEAR), "n_years": ("count", YEAR), "has_license": ("flag", LICENSE)}
    fields = [F.nullif(F.trim(F.substring_index(t, "\n", 1)), F.lit("")).alias("title"),
              F.size(tokens(t)).alias("n_words")]
    patterns = [p for _, p in rules.values()]
    for name, (kind, pat) in rules.items():
        found = F.regexp_extract_all(t, F.lit(pat), 0)
        if kind != "all" and patterns.count(pat) > 1:  # one search for all rules of a pattern
            out = {"first": F.nullif(F.get(found, F.lit(0)), F.lit("")), "count": F.size(found)}.get(kind, F.size(found) > 0)
            fields.append(F.when(t.isNotNull(), out).alias(name))
        elif kind == "all":
            if pat in _IN_MATCHES:
                found = F.when(~F.contains(t, F.lit(_IN_MATCHES[pat])), F.array().cast("array<string>")).otherwise(found)
            fields.append(found.alias(name))
        elif kind == "first":
            fields.append(F.nullif(F.regexp_extract(t, pat, 0), F.lit("")).alias(name))
        elif kind == "count":
            fields.append(F.regexp_count(t, F.lit(pat)).alias(name))
        else:
            fields.append(t.rlike(pat).alias(name))
    return F.parse_json(F.to_json(F.struct(F.struct(*fields).alias("response"))))


# --- J5 sync ------------------------------------------------------------------------------------

def sync_source(files: DataFrame, manifest: DataFrame, key: str = "path",
                status: str = "status") -> tuple[DataFrame, DataFrame]:
    """Files not yet in the processed ``manifest`` (left anti join) with the
    status their index run gave them, and the D21 status totals."""
    new = files.join(manifest.select(key), key, "left_anti").withColumnRenamed(status, "status")
    return new, A.index_status(new)


# --- J6 retrieve -------------------------------------------------------------------------------------

def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Paragraph chunks (split on newlines) with their position."""
    return docs.select(key, F.posexplode(F.split(_c(text), "\n")).alias("chunk_id", "chunk")) \
        .filter(F.trim("chunk") != "")


def retrieve(questions: DataFrame, docs: DataFrame, k: int = 3, qkey: str = "item_id", qtext: str = "text",
             dkey: str = "doc_id", dtext: str = "text", probe_terms: int = 10) -> DataFrame:
    """Top-k chunks per question by tf-idf, citing document and chunk.

    score(q, c) = sum over shared terms of tf(t, c) * qtf(t, q) * idf(t)^2,
    idf = ln(N / df) over N chunks; scores rounded to 9 decimals, ties by
    (doc, chunk). Exact, but without scoring every chunk that shares a common
    term:

    1. postings of the questions' terms are counted once and written;
    2. likely chunks (best by the ``probe_terms`` rarest terms, or with the most
       of some term) are scored in full; no answer can fall below the k-th;
    3. the commonest terms get a cap each, the count that nearly all their
       postings stay within, as long as all caps together stay below that
       bound. A chunk in which no other term occurs and every capped term stays
       within its cap cannot be an answer: only chunks with a rarer term, or
       with unusually many of a common one, are candidates and scored in full.
    """
    qt = questions.select(qkey, F.explode(tokens(qtext)).alias("term")).groupBy(qkey, "term") \
        .agg(F.count(F.lit(1)).alias("qtf"))
    ch = chunks(docs, dkey, dtext)
    n = ch.agg(F.count(F.lit(1)).alias("n_chunks"))
    post = ch.select(dkey, "chunk_id", F.explode(tokens("chunk")).alias("term")) \
        .join(qt.select("term").distinct(), "term", "left_semi") \
        .groupBy(dkey, "chunk_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    post = written(post, "postings")
    idf = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.percentile_approx("tf", 0.999).alias("usual")) \
        .crossJoin(F.broadcast(n)).withColumn("idf", F.log(F.col("n_chunks") / F.col("df"))).filter(F.col("idf") > 0)
    rarest = Window.partitionBy(qkey).orderBy("df", "term")
    weights = qt.join(idf, "term").select(qkey, "term", (F.col("qtf") * F.col("idf") * F.col("idf")).alias("w"), "df", "usual")
    weights = written(weights.withColumn("place", F.row_number().over(rarest)), "question-terms")

    def full_scores(pairs: DataFrame) -> DataFrame:
        return pairs.join(post, [dkey, "chunk_id"]).join(weights.select(qkey, "term", "w"), [qkey, "term"]) \
            .groupBy(qkey, dkey, "chunk_id").agg(F.sum(F.col("tf") * F.col("w")).alias("score"))

    partial = weights.filter(F.col("place") <= probe_terms).join(post, "term") \
        .groupBy(qkey, dkey, "chunk_id").agg(F.sum(F.col("tf") * F.col("w")).alias("score"))
    likely = ts.top_n_per_key(partial, [qkey], [F.col("score").desc()], 10 * k).select(qkey, dkey, "chunk_id")
    heavy = ts.top_n_per_key(post, ["term"], [F.col("tf").desc()], 2 * k).join(weights, "term").select(qkey, dkey, "chunk_id")
    probed = full_scores(likely.union(heavy).distinct())
    bound = ts.top_n_per_key(probed, [qkey], [F.col("score").desc()], k).groupBy(qkey) \
        .agg(F.when(F.count(F.lit(1)) >= k, F.min("score") * (1 - 1e-9) - 1e-6).otherwise(F.lit(0.0)).alias("bound"))
    common = Window.partitionBy(qkey).orderBy(F.desc("df"), "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spent = F.sum(F.col("w") * F.col("usual")).over(common)
    caps = weights.withColumn("_spent", spent).join(bound, qkey) \
        .select(qkey, "term", F.when(F.col("_spent") < F.col("bound"), F.col("usual")).otherwise(0).alias("cap"))
    caps = written(caps, "term-caps")
    # postings within every question's cap drop out before the questions meet them
    over = post.join(caps.groupBy("term").agg(F.min("cap").alias("_least")), "term").filter(F.col("tf") > F.col("_least"))
    candidates = over.join(caps, "term").filter(F.col("tf") > F.col("cap")).select(qkey, dkey, "chunk_id").distinct()
    candidates = written(candidates, "candidates")
    scored = full_scores(candidates).withColumn("score", F.round("score", 9))
    return ts.top_n_per_key(scored, [qkey], [F.col("score").desc(), F.col(dkey), F.col("chunk_id")], k, "rank")


# --- J7 history ---------------------------------------------------------------------------------------

def with_history(conv: DataFrame, key: str = "conv_id", turn: str = "turn", block: int = 256) -> DataFrame:
    """One row per block of ``block`` turns of a conversation, its messages
    in order as (turn, role, content), and ``earlier``, the number of turns
    before the block. A turn's history is the blocks before its own and the
    messages before it in its block: the output grows with the turns, and a
    very long conversation is many rows. Turns are numbered in order of ``turn``."""
    placed = conv.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(turn)) - 1)
    return placed.groupBy(key, F.floor(F.col("_n") / block).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), F.col("role"), F.col("text").alias("content")))).alias("messages"),
        F.min("_n").cast("bigint").alias("earlier"))
