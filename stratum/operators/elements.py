"""Element trees of markup (J1) and extraction by a JSON schema over them.

``parse_elements`` walks the tags of a whole document once with a stack and gives
every block element as (id, parent, depth, type, tag, text) in document order.
Inline tags do not cut a text; comments, scripts and styles have none. Each visible run
of text is in exactly one element: the innermost block that is open. Tables come also
as a header and rows of cell texts.

``extract_schema`` compiles a JSON schema into native expressions over the elements: a scalar
property is the value of the first element "label: value", an array of objects the rows of the
first table whose header has all item labels. The result is VARIANT ``{response: {...}}``; what
is absent or does not parse as its type is left out, so that a path to it gives NULL.

Defined cases: a null or empty text is one empty root; an unknown end tag is
ignored, an unclosed element ends with its parent; ``p``, ``li``, table rows and cells end
where the next one starts; an angle bracket that opens no tag is text.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-z][a-z0-9]*)\b[^>]*>|([^<]+|<)",
                    re.S | re.I)
_SPACE = re.compile(r"[ \t\n\r\f\v]+")
# Element types by tag; other tags are inline.
TYPES = {**{f"h{i}": "heading" for i in range(1, 7)}, "p": "paragraph", "li": "list_item", "ul": "list", "ol": "list",
         "table": "table", "tr": "table_row", "td": "table_cell", "th": "table_cell", "title": "title",
         **dict.fromkeys("html head body article section nav header footer main aside div blockquote pre form figure "
                         "figcaption tbody thead tfoot caption dl dt dd".split(), "section")}
# An opening tag first ends the open elements on the left, up to (and without) the nearest on the right.
_ENDS = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
         "th": ({"td", "th"}, {"tr", "table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}
_BREAKS = {"br", "hr", "img"}


def walk(markup: str) -> tuple[list[tuple], list[tuple]]:
    """Elements (id, parent, depth, type, tag, text) and tables (id, header, rows) of one document."""
    made = [(None, 0, "document", "", [])]  # parent, depth, type, tag, runs of text
    stack = [0]
    tables: dict[int, list[list[tuple[int, list[str]]]]] = {}
    cells: list[tuple[int, list[str]]] = []  # open cells: element and the texts below it

    def say(text: str) -> None:
        made[stack[-1]][4].append(text)
        if cells:
            cells[-1][1].append(text)

    def close(upto: int) -> None:
        """Ends the elements of the stack from place ``upto`` on."""
        while len(stack) > upto:
            at = stack.pop()
            if cells and cells[-1][0] == at:
                cells.pop()
        say(" ")

    for _, end, name, run in _TOKEN.findall(markup):
        if run:
            say(entities.unescape(run) if "&" in run else run)
            continue
        tag = name.lower()
        if tag in _BREAKS:
            say(" ")
        kind = TYPES.get(tag)
        if kind is None:
            continue
        if end:
            for i in range(len(stack) - 1, 0, -1):
                if made[stack[i]][3] == tag:
                    close(i)
                    break
                if made[stack[i]][3] == "table":
                    break
            continue
        if made[stack[-1]][3] == "p":
            close(len(stack) - 1)
        if tag in _ENDS:
            same, stop = _ENDS[tag]
            for i in range(len(stack) - 1, 0, -1):
                if made[stack[i]][3] in stop:
                    break
                if made[stack[i]][3] in same:
                    close(i)
                    break
        say(" ")
        at = len(made)
        made.append((stack[-1], len(stack), kind, tag, []))
        stack.append(at)
        if tag == "table":
            tables[at] = []
            cells.append((at, []))  # its texts are no part of a cell around it
        elif tables and tag in ("tr", "td", "th"):
            of = next((x for x in reversed(stack) if made[x][3] == "table"), None)
            if of is None:
                continue
            if tag == "tr":
                tables[of].append([])
                continue
            if not tables[of]:
                tables[of].append([])
            cells.append((at, []))
            tables[of][-1].append(cells[-1])

    def text(runs: list[str]) -> str:
        return b" ".join("".join(runs).encode().split()).decode()  # the white space of bytes is that of markup

    elements = [(i, parent, depth, kind, tag, text(runs)) for i, (parent, depth, kind, tag, runs) in enumerate(made)]
    # A cell without blocks has the text of its element.
    grids = [(i, [[elements[at][5] if runs == made[at][4] else text(runs) for at, runs in row] for row in rows]) for i, rows in tables.items()]
    return elements, [(i, rows[0] if rows else [], rows[1:]) for i, rows in grids]


def _lists(found: Iterable[Sequence], make: Callable[[list], pa.Array]) -> pa.ListArray:
    """One list per member, of the array that ``make`` gives for all their values in a row."""
    found = list(found)
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, found))], pa.int32()), make(list(chain.from_iterable(found))))


def _texts(lists: Iterable[Sequence[str]]) -> pa.ListArray:
    return _lists(lists, lambda values: pa.array(values, pa.string()))


def _elements(rows: list[tuple]) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ELEMENT)], fields=list(_ELEMENT))


def _tables(rows: list[tuple]) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array([t[0] for t in rows], pa.int32()), _texts(t[1] for t in rows),
                                       _lists((t[2] for t in rows), _texts)], fields=list(_TABLE))


_ELEMENT = pa.struct([("id", pa.int32()), ("parent", pa.int32()), ("depth", pa.int32()), ("type", pa.string()), ("tag", pa.string()),
                      ("text", pa.string())])
_TABLE = pa.struct([("id", pa.int32()), ("header", pa.list_(pa.string())), ("rows", pa.list_(pa.list_(pa.string())))])
_DDL = ("elements array<struct<id: int, parent: int, depth: int, type: string, tag: string, text: string>>, "
        "tables array<struct<id: int, header: array<string>, rows: array<array<string>>>>")


def parse_elements(df: DataFrame, markup: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """The ``keep`` columns with ``elements`` and ``tables`` of every whole document."""
    kept = df.select(*[F.col(f"`{c}`") for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [walk(t or "") for t in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], _lists((f[0] for f in found), _elements), _lists((f[1] for f in found), _tables)],
                    names=[*keep, "elements", "tables"])

    parsed = kept.limit(0).select("*", F.lit(None).cast("int").alias("_")).schema.fields[:-1]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in parsed] + [_DDL])
    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{markup}`").cast("string").alias("_markup")).mapInArrow(run, ddl)


# --- J3: schema -> expressions ---------------------------------------------------------------------

_PAIR = r"(?s)^([^:：]{1,80})[:：]\s*(.+)$"


def _name(text: Column) -> Column:
    """A label as a name: lower case, everything but letters and digits is one underscore."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "_"), F.lit("_"))


def _plain(label: str) -> str:
    return re.sub(r"[\W_]+", "_", label.lower()).strip("_")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _typed(value: Column, kind: str) -> Column:
    """A text as the schema's type; NULL where it is none."""
    value = _once(F.trim(value), lambda v: F.when(v != "", v))
    if kind in ("number", "integer"):
        bare = F.translate(value, "$€£%, \t\n\v\f\r", "")
        signed = _once(bare, lambda b: F.when(b.startswith("(") & b.rlike(r"^\(.*\)$"), F.concat(
            F.lit("-"), F.regexp_extract(b, r"^\((.*)\)$", 1))).otherwise(b))
        return signed.try_cast("double" if kind == "number" else "bigint")
    if kind == "boolean":
        word = F.lower(value)
        return F.when(word.isin("true", "yes"), True).when(word.isin("false", "no"), False)
    if kind != "string":
        raise ValueError(f"unknown type {kind!r}")
    return value


def extract_schema(elements: Column | str, tables: Column | str, schema: Mapping) -> Column:
    """``{response: {...}}`` as VARIANT. ``schema`` is an object schema whose properties are string, number, integer
    or boolean, or arrays of objects of such; a property's ``title`` is its label if that is not its name."""
    elements, tables = (F.col(c) if isinstance(c, str) else c for c in (elements, tables))
    if all(_plain(s.get("title", n)) for n, s in schema["properties"].items()):  # a label then has a name, and its element a colon
        elements = F.filter(elements, lambda e: e["text"].contains(":") | e["text"].contains("："))
    pairs = F.transform(elements, lambda e: F.struct(_name(F.regexp_extract(e["text"], _PAIR, 1)).alias("name"),
                                                     F.regexp_extract(e["text"], _PAIR, 2).alias("value")))
    grids = F.transform(tables, lambda t: F.struct(F.transform(t["header"], _name).alias("header"), t["rows"].alias("rows")))

    def label(name: str, spec: Mapping) -> Column:
        return F.lit(_plain(spec.get("title", name)))

    def scalar(x: Column, name: str, spec: Mapping) -> Column:
        at = F.array_position(x["names"], label(name, spec)) - 1
        return _typed(F.get(x["values"], at.cast("int")), spec["type"])

    def objects(x: Column, items: Mapping) -> Column:
        fits = F.filter(x["t"], lambda t: F.forall(F.array(*[label(n, s) for n, s in items.items()]),
                                                   lambda n: F.array_contains(t["header"], n)))

        def of(table: Column) -> Column:
            places = F.struct(*[(F.array_position(table["header"], label(n, s)) - 1).cast("int").alias(n) for n, s in items.items()])
            return _once(places, lambda at: F.transform(table["rows"], lambda row: F.struct(*[
                _typed(F.get(row, at.getField(n)), s["type"]).alias(n) for n, s in items.items()])))
        return F.get(F.transform(F.slice(fits, 1, 1), of), 0)

    def response(x: Column) -> Column:
        return F.struct(*[(objects(x, s["items"]["properties"]) if s["type"] == "array" else scalar(x, n, s)).alias(n)
                          for n, s in schema["properties"].items()])

    found = _once(_once(pairs, lambda p: F.struct(p["name"].alias("names"), p["value"].alias("values"), grids.alias("t"))), response)
    return F.parse_json(F.to_json(F.struct(found.alias("response"))))


_AMOUNTS = ("total_revenue", "cost_of_revenue", "gross_profit", "operating_income", "net_income", "total_assets",
            "total_liabilities", "total_equity", "cash_and_equivalents")
# What a filing is asked for, 16 scalars and two arrays of objects.
FILING_SCHEMA = {"type": "object", "properties": {
    **{n: {"type": "string"} for n in ("company_name", "ticker_symbol", "exchange")},
    "fiscal_year": {"type": "integer"}, "fiscal_year_end_date": {"type": "string"},
    **{f"{n}_billions": {"type": "number"} for n in _AMOUNTS}, "eps_diluted": {"type": "number"},
    "revenue_growth_yoy_pct": {"type": "number", "title": "Revenue growth YoY (pct)"},
    "business_segments": {"type": "array", "items": {"type": "object", "properties": {
        "segment_name": {"type": "string"}, "segment_revenue_billions": {"type": "number"}}}},
    "geographic_revenue": {"type": "array", "items": {"type": "object", "properties": {
        "region": {"type": "string"}, "region_revenue_billions": {"type": "number"}}}}}}


def silver_from_texts(filings: DataFrame) -> DataFrame:
    """The silver table from filing texts (file_name, company_key, document_type, industry_sector, html): J1, then J3."""
    keep = ["file_name", "company_key", "document_type", "industry_sector"]
    # Few bytes of a filing take long to parse: by their bytes they came in one task per core and a straggler.
    filings = filings.repartition(4 * filings.sparkSession.sparkContext.defaultParallelism, "file_name")
    return parse_elements(filings, "html", keep).select(*keep, extract_schema("elements", "tables", FILING_SCHEMA).alias("extracted_metrics"))
