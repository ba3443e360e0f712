"""Messy HTML and compiled JSON schemas against plain checkers, on given pages and on random input."""

import json
import random
import re
from html import unescape
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import markup, schema
from ledgerloom.operators import lineitems, pages

DATA = "/root/testdata/sf0.001"


# markup

CASES = {
    "entities": ("<table><tr><td>A &amp; B &#8364;<td>1.00</table>", [["A & B €", "1.00"]]),
    "unclosed": ("<table><tr><td>A<td>1.00<tr><td>B<td>2.00</table>", [["A", "1.00"], ["B", "2.00"]]),
    "nested": ("<table><tr><td>Outer<table><tr><td>Inner</td><td>5.00</td></tr></table></td><td>7.00</td></tr></table>", [["Outer Inner 5.00", "Inner", "5.00", "7.00"], ["Inner", "5.00"]]),
    "sections": ("<TABLE><THEAD><TR><TH>h<TBODY><tr><td>x<TFOOT><tr><td>y</TABLE>z", [[], ["x"], ["y"]]),
    "pieces": ("<table><tr><td> Blue <b>gad</b>get <br>2 </td></tr></table>", [["Blue gad get 2"]]),
    "no row": ("<table><td>a<td>b</table>", []),
    "quotes": ("<table><tr><td title='a>b' x=\"</td>\">q</td></tr></table>", [["q"]]),
    "raw": ("<script>var t='<tr><td>no</td></tr>'</script><table><tr><td>yes", [["yes"]]),
    "comment": ("<table><!-- <tr><td>no</td></tr> --><tr><td>y<!-- x -->es</td></tr></table>", [["y es"]]),
    "stray ends": ("</td></tr><table><tr></p></b><td>a</span></td></tr></table></table>", [["a"]]),
    "cut off": ("<table><tr><td>a</td><td>b</td></tr><tr><td cla", [["a", "b"], []]),
    "empty": ("", []),
}


@pytest.mark.parametrize("name", CASES)
def test_rows_of_messy_tables(name):
    html, want = CASES[name]
    assert markup.read(html).rows == want


def test_table_items_of_the_three_cases(spark):
    """Entities are decoded, open cells end by themselves, and a table inside a cell leaves the outer amount."""
    rows = [("e", CASES["entities"][0]), ("u", CASES["unclosed"][0]), ("n", CASES["nested"][0]), ("0", None)]
    got = sorted(map(tuple, lineitems.table_items(spark.createDataFrame(rows, "doc_id string, html string")).select("doc_id", "row_idx", "description", "amount").collect()))
    assert got == [("e", 0, "A & B €", 1.0), ("n", 0, "Inner", 7.0), ("n", 1, "Inner", 5.0), ("u", 0, "A", 1.0), ("u", 1, "B", 2.0)]


def test_named_references_end_with_their_semicolon(spark):
    """A title cut inside `&amp;` keeps what is left of it, as the SQL of page_blocks does."""
    html = "<html><head><title>a&amp;b &amp</title></head><body><h1>a &lt;c&gt; &amp</h1><p>&copyx; &notit; &AMP; &nosuch; &#8364; &#65 &amp;lt; &"
    assert [b.text for b in markup.read(html).blocks] == ["a&b &amp", "a <c> &amp", "&copyx; &notit; & &nosuch; € A &lt; &"]
    assert [r.text for r in pages.blocks(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("block_idx").collect()][0] == "a&b &amp"


@pytest.mark.parametrize("name", CASES)
def test_parts_that_are_read_alone(name):
    """What is not wanted is not made, and what is wanted is as in a whole reading."""
    whole = markup.read(CASES[name][0])
    for part in markup.PARTS:
        got = markup.read(CASES[name][0], frozenset((part,)))
        assert getattr(got, part) == getattr(whole, part) and not any(getattr(got, x) for x in markup.PARTS - {part})
        assert got.heads == (whole.heads if part == "rows" else [])


def test_the_longest_cell_and_the_last_amount(spark):
    rows = [(1, "<table><tr><td>ab<td>cd<td>1.00<td>2.00<tr><td>3.00<tr><td>x<td>longer<td>EUR 0.00<td>4.00<tr><td>none")]
    got = lineitems.table_items(spark.createDataFrame(rows, "doc_id long, html string")).orderBy("row_idx").collect()
    assert [tuple(r)[1:] for r in got] == [(0, "ab", None, 2.0), (1, None, None, 3.0), (2, "EUR 0.00", 0.0, 4.0)]


def test_grid_places():
    html = "<table><tr><th rowspan=2>a<td colspan=2>b<td rowspan=0>c<tr><td>d<td colspan='x'>e<tr><td rowspan=99 colspan=3>f</table>"
    got = {c.text: (c.row, c.column, c.row_span, c.column_span, c.header) for c in markup.read(html).cells}
    assert got == {"a": (0, 0, 2, 1, True), "b": (0, 1, 1, 2, False), "c": (0, 3, 3, 1, False), "d": (1, 1, 1, 1, False), "e": (1, 2, 1, 1, False), "f": (2, 0, 1, 3, False)}


def test_grids_are_filled_without_overlap(spark):
    rnd = random.Random(4)
    cell = lambda: f"<t{rnd.choice('dh')} rowspan={rnd.randint(0, 3)} colspan={rnd.randint(1, 3)}>{rnd.randint(0, 99)}"
    html = [(k, "<table>" + "".join("<tr>" + "".join(cell() for _ in range(rnd.randint(0, 4))) for _ in range(5)) + "</table>") for k in range(40)]
    grid = pages.grids(spark.createDataFrame(html, "page_id long, html string"))
    full = pages.filled(grid)
    places = [(r.page_id, r.table_idx, r.row_idx, r.column_idx) for r in full.collect()]
    want = sum(r.row_span * r.column_span for r in grid.collect())
    assert len(places) == want and full.filter("begins").count() == grid.count()
    # a span to the right may run into one from above, as in a browser; where a cell begins is free
    begun = [(r.page_id, r.row_idx, r.column_idx) for r in full.filter("begins").collect()]
    assert len(begun) == len(set(begun))


class Plain(HTMLParser):
    """Blocks by another parser: texts between tags of block elements, with the tag that was open."""

    def __init__(self):
        super().__init__()
        self.out, self.open, self.buffer, self.raw = [], [], [], False

    def flush(self):
        said = " ".join("".join(self.buffer).split())
        self.buffer = []
        if said:
            self.out.append((self.open[-1] if self.open else "", said))

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.buffer.append(" ")
        if tag in markup.BLOCK:
            self.flush()
            if "p" in self.open[-1:]:
                self.open.pop()
            self.open.append(tag)
        self.raw = tag in markup.RAW

    def handle_endtag(self, tag):
        if tag in markup.BLOCK and tag in self.open:
            self.flush()
            while self.open.pop() != tag:
                pass
        self.raw = False

    def handle_data(self, data):
        if not self.raw:
            self.buffer.append(data)


def test_blocks_of_all_pages(spark):
    table = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {}
    for r in pages.blocks(table).orderBy("page_id", "block_idx").collect():
        got.setdefault(r.page_id, []).append((r.tag, r.text))
    for r in table.collect():
        plain = Plain()
        plain.feed(r.html)
        plain.close()
        plain.flush()
        assert got[r.page_id] == plain.out, r.page_id


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th rowspan=2>", "<p>", "</p>", "<b>", "</b>", "<li>", "<ul>", "</ul>", "<br>", "a", " b ", "&lt;", "<", ">", "<!-- x -->", "<script>", "</script>", "<title>", "</title>", "<td", "'"]), max_size=40))
def test_any_markup_is_read(parts):
    """Nothing crashes, no text is lost or made twice, and every cell's place is its own."""
    html = "".join(parts)
    page = markup.read(html)
    words = lambda s: re.sub(r"\s", "", s)
    read = words("".join(what for kind, what, _ in markup.tokens(html) if kind == "text"))
    assert words("".join(b.text for b in page.blocks)) == read
    places = [(c.table, c.row, c.column) for c in page.cells]
    assert len(places) == len(set(places)) and all(c.row_span >= 1 for c in page.cells)
    assert words("".join(c.text for c in page.cells)) in read or len(page.cells) > 1


def test_pages_odd(spark):
    rows = [(1, None, "x"), (1, "<p>a", "x"), (1, "<p>a", "x"), (None, "<p>b" + "<i>" * 3000 + "c", "y")]
    df = spark.createDataFrame(rows, "page_id long, html string, tag string")
    assert sorted(map(str, pages.blocks(df).collect())) == sorted(map(str, [*pages.blocks(df.limit(0)).collect(), *pages.blocks(df).collect()]))
    assert pages.blocks(df).count() == 3 and pages.grids(df).count() == 0 and pages.table_rows(df).count() == 4
    assert unescape("&amp;") == "&" and pages.grids(df.limit(0)).collect() == []


# schemas


def plain_errors(v, s, path, root, level=0):
    """A recursive checker over Python values, keyword by keyword in the schema's order."""
    if s is True or s == {}:
        return []
    if s is False:
        return [f"{path}: false"]
    if "$ref" in s:
        found = root
        for part in filter(None, s["$ref"][1:].split("/")):
            found = found[part]
        return [f"{path}: depth"] if level >= schema.LEVELS else plain_errors(v, found, path, root, level + 1)
    number = isinstance(v, int | float) and not isinstance(v, bool)
    is_a = {
        "object": isinstance(v, dict), "array": isinstance(v, list), "string": isinstance(v, str), "boolean": isinstance(v, bool), "null": v is None,
        "number": number, "integer": number and float(v).is_integer(),
    }
    same = lambda a, b: type(a) is not bool and type(b) is not bool and isinstance(a, int | float) and isinstance(b, int | float) and a == b or type(a) is type(b) and (
        (len(a) == len(b) and all(same(x, y) for x, y in zip(a, b))) if isinstance(a, list) else (a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)) if isinstance(a, dict) else a == b
    )
    go = lambda x, t, p: plain_errors(x, t, p, root, level)
    out = []
    for k, t in s.items():
        bad = False
        if k == "type":
            bad = not any(is_a[x] for x in ([t] if isinstance(t, str) else t))
        elif k == "enum":
            bad = not any(same(v, c) for c in t)
        elif k == "const":
            bad = not same(v, t)
        elif k == "pattern":
            bad = is_a["string"] and not re.search(t, v)
        elif k in ("minLength", "maxLength"):
            bad = is_a["string"] and (len(v) < t if k == "minLength" else len(v) > t)
        elif k in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"):
            bad = number and (not (v / t).is_integer() if k == "multipleOf" else {"minimum": v < t, "maximum": v > t, "exclusiveMinimum": v <= t, "exclusiveMaximum": v >= t}[k])
        elif k == "required" and is_a["object"]:
            out += [f"{path}: required {n}" for n in t if n not in v]
        elif k in ("minProperties", "maxProperties"):
            bad = is_a["object"] and (len(v) < t if k == "minProperties" else len(v) > t)
        elif k == "properties" and is_a["object"]:
            for n, x in t.items():
                if n in v:
                    out += go(v[n], x, f"{path}.{n}")
        elif k == "patternProperties" and is_a["object"]:
            for p, x in t.items():
                for n in sorted(v):
                    if re.search(p, n):
                        out += go(v[n], x, f"{path}.{n}")
        elif k == "additionalProperties" and is_a["object"]:
            extra = [n for n in sorted(v) if n not in s.get("properties", {}) and not any(re.search(p, n) for p in s.get("patternProperties", {}))]
            if t is False:
                bad = bool(extra)
            else:
                for n in extra:
                    out += go(v[n], t, f"{path}.{n}")
        elif k == "propertyNames" and is_a["object"]:
            for n in sorted(v):
                out += go(n, t, f"{path}.{n}")
        elif k == "items" and is_a["array"]:
            for i, x in enumerate(v):
                out += go(x, t if not isinstance(t, list) else t[i] if i < len(t) else s.get("additionalItems", True), f"{path}[{i}]")
        elif k in ("minItems", "maxItems"):
            bad = is_a["array"] and (len(v) < t if k == "minItems" else len(v) > t)
        elif k == "uniqueItems":
            bad = t and is_a["array"] and any(same(a, b) for i, a in enumerate(v) for b in v[:i])
        elif k == "contains":
            bad = is_a["array"] and all(go(x, t, "") for x in v)
        elif k == "allOf":
            for x in t:
                out += go(v, x, path)
        elif k == "anyOf":
            bad = all(go(v, x, "") for x in t)
        elif k == "oneOf":
            bad = sum(not go(v, x, "") for x in t) != 1
        elif k == "not":
            bad = not go(v, t, "")
        elif k == "if":
            out += go(v, s.get("else", True) if go(v, t, "") else s.get("then", True), path)
        elif k == "dependencies" and is_a["object"]:
            for n, needs in t.items():
                if n in v:
                    out += [f"{path}: required {m}" for m in needs if m not in v] if isinstance(needs, list) else go(v, needs, path)
        if bad:
            out.append(f"{path}: {k}")
    return out


SCHEMAS = [
    {"type": "object", "required": ["a", "b"], "properties": {"a": {"type": ["integer", "null"], "minimum": 0, "exclusiveMaximum": 10, "multipleOf": 2}, "b": {"type": "string", "pattern": "^x.*y$", "minLength": 2, "maxLength": 4}, "c": {"enum": [1, "1", None, True, [1, {"k": 2}]]}}, "additionalProperties": False, "minProperties": 2, "maxProperties": 3},
    {"properties": {"a": {"items": {"$ref": "#/definitions/n"}, "minItems": 1, "maxItems": 3, "uniqueItems": True, "contains": {"type": "number"}}, "b": {"items": [{"type": "string"}, {"const": 1}], "additionalItems": {"type": "null"}}}, "additionalProperties": {"type": "boolean"}, "definitions": {"n": {"type": ["number", "string"], "maximum": 5}}},
    {"anyOf": [{"type": "string"}, {"required": ["a"]}], "allOf": [{"not": {"type": "boolean"}}, {"type": ["object", "string", "array"]}], "oneOf": [{"type": "array"}, {"required": ["b"]}, {"maxLength": 2}], "if": {"required": ["c"]}, "then": {"propertyNames": {"pattern": "^[abc]$"}}, "else": {"maxProperties": 1}, "dependencies": {"a": ["b"], "b": {"required": ["c"]}}},
    {"$ref": "#/definitions/tree", "definitions": {"tree": {"type": "object", "properties": {"a": {"$ref": "#/definitions/tree"}, "b": {"type": "number"}}}}},
    {"patternProperties": {"^[ab]": {"type": "number"}}, "properties": {"it's": {"const": {"a": 1, "b": [None]}}, "c": False}, "additionalProperties": False},
    True,
]


def random_json(rnd, depth=3):
    kind = rnd.randrange(9 if depth else 6)
    if kind < 6:
        return rnd.choice([None, True, False, 0, 1, 2, 2.0, 7.5, -3, 10, 12, "", "xy", "x1y", "xaby", "1", "long text é", 1e30, 123456789012])
    if kind < 7:
        return [random_json(rnd, depth - 1) for _ in range(rnd.randrange(4))]
    return {rnd.choice(["a", "b", "c", "it's", "abc"]): random_json(rnd, depth - 1) for _ in range(rnd.randrange(4))}


@pytest.mark.parametrize("k", range(len(SCHEMAS)))
def test_compiled_schema_is_the_recursive_checker(spark, k):
    rnd = random.Random(k)
    values = [random_json(rnd) for _ in range(250)] + [{"a": 4, "b": "xy"}, {"a": 2, "b": "xy", "c": [1, {"k": 2}]}, {"a": {"a": {"a": {"a": {"a": {"b": 1}}}}}}, {"it's": {"a": 1.0, "b": [None]}}, {"a": [1, 1.0]}, {"a": [1, "z", [2]]}]
    df = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=i % 2 == 0)) for i, v in enumerate(values)], "i int, doc string")
    got = {r.i: list(r.e) for r in df.select("i", schema.compiled(SCHEMAS[k])(F.col("doc")).alias("e")).collect()}
    for i, v in enumerate(values):
        assert got[i] == plain_errors(v, SCHEMAS[k], "$", SCHEMAS[k]), (v, got[i])


def test_schema_odd(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "{"), (4, '{"a": 1}'), (5, '{"a": 1, "a": 2}'), (6, "[1,")], "i int, doc string")
    s = {"type": "object", "required": ["a", "b", "c", "d"]}
    got = {r.i: list(r.e) for r in df.select("i", schema.first_errors(F.col("doc"), json.dumps(s)).alias("e")).collect()}
    assert got == {1: ["$: missing"], 2: ["$: json"], 3: ["$: json"], 4: ["$: required b", "$: required c", "$: required d"], 5: ["$: json"], 6: ["$: json"]}
    assert df.select(schema.valid(F.col("doc"), {"type": "object"}).alias("ok")).filter("ok").count() == 1
    with pytest.raises(ValueError, match="no such type"):
        schema.compiled({"type": "text"})(F.col("doc"))
    with pytest.raises(ValueError, match="out of the document"):
        schema.compiled({"$ref": "other.json"})(F.col("doc"))
