"""Element trees, extraction by schema, naive Bayes: nested cases, plain versions, held-out accuracy."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stratum.operators import bayes as By
from stratum.operators import documents as D
from stratum.operators import elements as El

SF = SF_SMALL.replace("sf0.001", "sf0.01")


def shape(markup):
    return [(e[1], e[3], e[5]) for e in El.walk(markup)[0]]


def test_nested_lists_and_paragraphs():
    assert shape("a<ul><li>one <b>bold</b><ul><li>in<p>par</ul>after<li>two</ul>z") == [
        (None, "document", "a z"), (0, "list", ""), (1, "list_item", "one bold after"), (2, "list", ""), (3, "list_item", "in"),
        (4, "paragraph", "par"), (1, "list_item", "two")]


def test_tables_with_open_cells_and_a_nested_table():
    elements, tables = El.walk("<table><tr><th>A<th>B &amp; C<tr><td>1<td><p>x<b>y</b><br>z<table><tr><td>in</table>w</table>t")
    assert tables == [(1, ["A", "B & C"], [["1", "xy z w"]]), (9, ["in"], [])]
    depth = {e[0]: e[2] for e in elements}
    assert all(e[1] is None or e[2] == depth[e[1]] + 1 for e in elements)
    assert elements[0][5] == "t" and [e[5] for e in elements if e[4] == "td"] == ["1", "w", "in"]


@pytest.mark.parametrize("markup, text", [("", ""), ("plain < text & more", "plain < text & more"), ("</p></table>x</li>", "x"),
                                          ("<p>a<!-- b --><script>'</p>'</script>c<style>d", "ac"), ("<P CLASS=x>Up</P  >", "Up"),
                                          ("<!DOCTYPE html><p>&lt;p&gt;", "<p>"), ("<p>unended <!-- x", "unended"), ("<td>cell<tr>", "cell")])
def test_odd_markup(markup, text):
    assert " ".join(e[5] for e in El.walk(markup)[0] if e[5]) == text


def test_every_visible_run_is_in_one_element(spark):
    """Characters of all elements together are those outside tags, comments, scripts and styles."""
    import html
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        bare = re.sub(r"(?s)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", "", r.html)
        got = "".join(e[5] for e in El.walk(r.html)[0])
        assert Counter(re.sub(r"\s", "", got)) == Counter(re.sub(r"\s", "", html.unescape(bare)))


SCHEMA = {"type": "object", "properties": {
    "name": {"type": "string"}, "head_count": {"type": "integer", "title": "Employees (total)"}, "margin": {"type": "number"},
    "loss": {"type": "number"}, "listed": {"type": "boolean"}, "absent": {"type": "string"}, "wrong": {"type": "number"},
    "parts": {"type": "array", "items": {"type": "object", "properties": {"part": {"type": "string"}, "share": {"type": "number"}}}},
    "none": {"type": "array", "items": {"type": "object", "properties": {"x": {"type": "string"}}}}}}


def test_extraction_by_schema(spark):
    page = ("<h1>Report</h1><ul><li><b>Name</b>: A: B &amp; Co<li>EMPLOYEES, total: 1,234</ul><p>Margin: 12.5 %<p>Loss: ($1,000.25)"
            "<p>Listed: Yes<p>Name: second<p>Wrong: n/a<table><tr><th>Other<tr><td>1</table>"
            "<table><tr><th>No<th>Share<th>Part</tr><tr><td>1<td>60%<td>wheels<tr><td>2<td><td>doors</table>")
    rows = spark.createDataFrame([(1, page, "x"), (2, None, "y"), (3, "", "z")], "k int, html string, elements string")
    m = El.parse_elements(rows, "html", ["k"]).select("k", El.extract_schema("elements", "tables", SCHEMA).alias("m"))
    kinds = {"name": "string", "head_count": "int", "margin": "double", "loss": "double", "listed": "boolean", "absent": "string",
             "wrong": "double", "parts": "array<struct<part: string, share: double>>", "none": "array<struct<x: string>>"}
    got = {r[0]: r[1:] for r in m.select("k", *[F.variant_get("m", f"$.response.{n}", t) for n, t in kinds.items()]).collect()}
    assert got[1] == ("A: B & Co", 1234, 12.5, -1000.25, True, None, None, [("wheels", 60.0), ("doors", None)], None)
    assert got[2] == got[3] == (None,) * 9


def test_numbers_in_table_rows(spark):
    """Each row by the header's places, whatever their order; brackets are a minus only around the whole number."""
    cells = ["(1,\t2)", " $3.5 ", "4%", "(5", "(6)x", "", "-7", "n/a", "(8\u2028)x"]
    page = "<table><tr><th>Share<th>#<th>Part" + "".join(f"<tr><td>{c}<td>{i}<td>p{i}" for i, c in enumerate(cells)) + "<tr><td>9</table>"
    rows = spark.createDataFrame([(1, page)], "k int, html string")
    m = El.parse_elements(rows, "html", ["k"]).select(El.extract_schema("elements", "tables", SCHEMA).alias("m"))
    got = m.select(F.variant_get("m", "$.response.parts", "array<struct<part: string, share: double>>")).first()[0]
    assert [r.part for r in got] == [f"p{i}" for i in range(len(cells))] + [None] and got[-1].share == 9.0
    assert [r.share for r in got[:-1]] == [-12.0, 3.5, 4.0, None, None, None, -7.0, None, None]


def test_a_label_without_letters_is_absent(spark):
    schema = {"type": "object", "properties": {"%": {"type": "string"}, "b": {"type": "string"}}}
    rows = spark.createDataFrame([(1, "<p>none<p>--: 5<p>b: 6")], "k int, html string")
    m = El.parse_elements(rows, "html", ["k"]).select(El.extract_schema("elements", "tables", schema).alias("m"))
    assert m.select(F.to_json("m")).first()[0] == '{"response":{"b":"6"}}'


def test_filings_are_parsed_in_even_parts(spark):
    """a few small files of texts are dealt to more tasks than there are cores, none with most of them."""
    texts = spark.range(2000).select(F.concat("id", F.lit(".pdf")).alias("file_name"), F.lit("S").alias("company_key"), F.lit("d").alias("document_type"),
                                     F.lit("i").alias("industry_sector"), F.concat(F.lit("<li>Company name: C"), "id").alias("html")).coalesce(1)
    silver = El.silver_from_texts(texts)
    parts = [r[1] for r in silver.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(parts) > spark.sparkContext.defaultParallelism and max(parts) < 500 and sum(parts) == 2000
    names = silver.select("file_name", F.variant_get("extracted_metrics", "$.response.company_name", "string").alias("c"))
    assert names.where("c <=> 'C' || substring_index(file_name, '.', 1)").count() == 2000


def test_schema_of_unknown_type(spark):
    with pytest.raises(ValueError):
        El.extract_schema(F.array(), F.array(), {"properties": {"a": {"type": "colour"}}})


# --- naive Bayes -------------------------------------------------------------------------------

def plain_bayes(train, texts, labels, max_terms):
    words = lambda t: re.findall(r"[^\W_]+|(?:[^\w\s]|_)+", (t or "").lower())
    n, counts = Counter(x for _, x in train), defaultdict(Counter)
    for t, x in train:
        counts[x].update(words(t))
    every = sum(counts.values(), Counter())
    terms = set(sorted(every, key=lambda w: (-every[w], w.encode()))[:max_terms])
    total = {x: sum(counts[x][w] for w in terms) for x in labels}
    out = []
    for t in texts:
        known = [w for w in words(t) if w in terms]
        score = [(math.log(n[x] / len(train)) + sum(math.log((counts[x][w] + 1) / (total[x] + len(terms))) for w in known)) if n[x] else -math.inf
                 for x in labels]
        out.append((labels[score.index(max(score))] if known else labels[-1], len(known)))
    return out


@pytest.mark.parametrize("max_terms", [By.MAX_TERMS, 7])
def test_matches_a_plain_version(spark, max_terms):
    train = [("the cat sat", "a"), ("the dog ran", "b"), ("a dog, a dog!", "b"), ("cat cat", "a"), (None, "a"), ("lone", "c"), ("skipped words", "zz")]
    texts = ["the cat", "dog", None, "", "unseen entirely", "the the the", "lone dog", "cat dog", "cat dog"]
    labels = ("b", "a", "never", "c")
    model = By.fit_naive_bayes(spark.createDataFrame(train, "text string, label string"), labels, max_terms=max_terms)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "k int, text string, term string")
    got = By.classify_texts(docs, model, out="said")
    assert got.columns == ["k", "term", "said", "n_known"]
    assert [(r.said, r.n_known) for r in sorted(got.collect())] == plain_bayes([x for x in train if x[1] != "zz"], texts, labels, max_terms)


def test_without_labelled_texts(spark):
    model = By.fit_naive_bayes(spark.createDataFrame([], "text string, label string"), ("a", "b"))
    assert [r.label for r in By.classify_texts(spark.createDataFrame([("x y",)], "text string"), model).collect()] == ["b"]


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    half = docs.select("doc_id", "text", F.col("lang").alias("label"))
    lang = By.classify_texts(half.where("doc_id % 2 = 1"), By.fit_naive_bayes(half.where("doc_id % 2 = 0"), ("de", "es", "fr", "en")), out="said")
    rows = lang.collect()
    assert sum(r.label == r.said for r in rows) / len(rows) > 0.95
    judged = docs.join(labels, "doc_id").select("doc_id", "text", F.when(F.col("quality") == 0, "junk").otherwise("good").alias("label"))
    quality = By.classify_texts(judged.where("doc_id % 2 = 1"), By.fit_naive_bayes(judged.where("doc_id % 2 = 0"), ("junk", "good")), out="said").collect()
    for label in ("junk", "good"):
        of = [r for r in quality if r.label == label]
        assert sum(r.said == label for r in of) / len(of) > 0.8


def test_tokens_are_summed_without_a_sort(spark):
    model = By.fit_naive_bayes(spark.createDataFrame([("x y", "a"), ("z", "b")], "text string, label string"), ("a", "b"))
    docs = spark.createDataFrame([(1, "x", "u", 0.0), (1, "x", "u", 0.0), (None, "z z", None, None)], "k bigint, text string, s string, d double")
    got = By.classify_texts(docs, model)
    assert sorted((r.k or 0, r.s, r.d, r.label, r.n_known) for r in got.collect())[1:] == [(1, "u", 0.0, "a", 1)] * 2
    plan = By.classify_texts(docs.select("k", "s", "text"), model)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_extraction_searches_each_pattern_once(spark):
    """Rules of one pattern share its search, and text without what every match contains is not searched."""
    rows = [(1, None), (2, ""), (3, "x@y.com http://a.b 1999 2001 19991 License: x\nLICENCE y"), (4, "@ ://"), (5, "no\n2010")]
    df = spark.createDataFrame(rows, "k int, t string")
    said = df.select(D.extract("t")).columns[0]
    for pattern in (D.LICENSE, D.YEAR):
        calls = set(re.findall(r"(\w+)\(t, " + re.escape(pattern), said))
        assert calls == {"regexp_extract_all"}
    assert all(f"contains(t, {x})" in said for x in ("@", "://"))
    got = {r.k: r.m for r in df.select("k", D.extract("t").cast("string").alias("m")).collect()}
    assert got[3] == ('{"response":{"emails":["x@y.com"],"first_year":"1999","has_license":true,"license_line":"License: x","n_words":13,"n_years":2,'
                      '"title":"x@y.com http://a.b 1999 2001 19991 License: x","urls":["http://a.b"]}}')
    assert got[4] == '{"response":{"emails":[],"has_license":false,"n_words":0,"n_years":0,"title":"@ ://","urls":[]}}'


# --- filings -----------------------------------------------------------------------------------

def test_filing_money_is_exact_without_decimal_sums(spark, tmp_path):
    """sums of whole hundredths equal sums of DECIMALs, also past a BIGINT and for doubles of more places."""
    from datetime import datetime
    from decimal import ROUND_HALF_UP, Decimal as Dec

    from stratum.sources import fixtures as fx
    prices = [0.1, 1.005, 2.675, -0.005, 123456789.125, 9999999999.99, -1.115, 33.33, None]
    rates = [0.04, 0.015, 99.99, -0.045, None]
    rows = [(s, datetime(1995, 3, 1), p, d, x) for s in (1, 2) for p in prices for d in rates for x in rates[s:]]
    rows += [(3, datetime(1996, 3, 1), 9999999999.99, 99.99, 99.99)] * 400 + [(4, None, None, 0.1, 0.1)]
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp, l_extendedprice double, l_discount double, l_tax double").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    cut = lambda v: None if v is None else Dec(repr(v)).quantize(Dec("0.01"), ROUND_HALF_UP)
    want = {}
    for s, day, *v in rows:
        p, d, x = map(cut, v)
        sums = want.setdefault((s, day and day.year), [None] * 3)
        for i, u in enumerate((p, None if None in (p, d) else p * (d * 5 + Dec("0.5")), None if None in (p, x) else p * x)):
            sums[i] = sums[i] if u is None else u + (sums[i] or 0)
    facts = fx.filing_facts(spark, str(tmp_path))
    assert {(r.l_suppkey, r.fiscal_year): [r.rev, r.cost, r.opex] for r in facts.collect()} == want
    assert [t for _, t in facts.dtypes[2:]] == ["decimal(22,2)", "decimal(30,4)", "decimal(27,4)"]
    merged = facts._jdf.queryExecution().sparkPlan().toString()
    assert "partial_sum" in merged and not re.search(r"partial_sum\((?!shiftright|\()", merged)
