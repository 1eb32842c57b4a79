"""Tables, lists and references against a reader that goes through a page piece by piece."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tabkit.functions.text import decode_entities, strip_markup
from tabkit.operators import html as H

PARTS = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th a='1'>", "</th>", "<ul>", "</ul>", "<ol class=x>", "</ol>", "<li>", "</li>", "<div class='a b'>",
         "</div>", "<DIV CLASS=b>", "<p>", "</p>", "text ", "word", "<b>", "</b>", "<!-- <td> -->", "<script>x<td></script>", "<thead>", "</tbody>", "<a title='<td>'>", "x<", "\n", "<tdx>",
         "<li", '<section class="b">', "</section>"]
STRUCTURE = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(?:script|style)\b.*?(?:</(?:script|style)\s*>|\Z)|(<[^>]*(?:>|\Z))|[^<]+")


def pieces(page):
    """(element, opens, classes) of tags, (None, text) of text."""
    for m in STRUCTURE.finditer(page):
        tag = m[1]
        if tag:
            name = re.match("</?([A-Za-z][A-Za-z0-9]*)", tag)
            classes = re.search(r"""(?i)\bclass\s*=\s*["']?([^"'>]*)""", tag)
            yield (name[1].lower() if name else ""), name is not None and not tag.startswith("</"), classes[1].split() if classes else []
        elif not re.match(r"(?i)<!--|<script|<style", m[0]):
            yield None, m[0]


def clean(text):
    return re.sub(r"[ \t\r\n]+", " ", text).strip(" ")


def table_rows(page, n):
    seen, depth, done, rows, cells, text, header = 0, 0, False, [], [], None, True
    for name, *rest in [*pieces(page), ("tr", False, [])]:
        if name is None:
            text = None if text is None else text + rest[0] if depth else text
            continue
        opens = rest[0]
        entering = name == "table" and opens and not depth and not done and seen == n
        own = depth == 1
        leaving = own and name == "table" and not opens
        seen += name == "table" and opens
        if own and (leaving or name in ("td", "th", "tr", "thead", "tbody", "tfoot")):
            if text is not None:
                cells.append(clean(text))
            text = None
            if leaving or name not in ("td", "th"):
                if cells:
                    rows.append((header, cells))
                cells, header = [], True
            elif opens:
                text, header = "", header and name == "th"
        depth = 1 if entering else depth + (1 if opens else -1) if depth and name == "table" else depth
        done = done or leaving
    return rows


def list_items(page, list_no, container, n):
    seen, depth, target, done, lists, stack, items, text = 0, 0 if container else 1, None, False, 0, [], [], None
    for name, *rest in [*pieces(page), ("li", False, [])]:
        if name is None:
            text = None if text is None else text + rest[0]
            continue
        opens, was = rest[0], depth
        if container and depth and name == target:
            depth += 1 if opens else -1
        elif container and opens and container in rest[1] and not depth and not done:
            if seen == n:
                depth, target = 1, name
            seen += 1
        done = done or (was > 0 and depth == 0)
        if was and (name in ("ul", "ol", "li") or not depth):
            if text is not None and list_no in (None, stack[-1] if stack else -1):
                items.append(clean(text))
            text = "" if name == "li" and opens and depth else None
            if name in ("ul", "ol") and depth:
                if opens:
                    stack.append(lists)
                    lists += 1
                else:
                    stack = stack[:-1]
    return items


@pytest.fixture(scope="module")
def pages(spark):
    draw = random.Random(12)
    rows = [(i, "".join(draw.choice(PARTS) for _ in range(draw.randrange(0, 45))) + "</table>" * 12) for i in range(1500)]
    return rows, spark.createDataFrame(rows, "id int, html string").cache()


@pytest.mark.parametrize("n", [0, 1, 2])
def test_tables(pages, n):
    rows, df = pages
    got = {}
    for r in H.html_table_rows(df, "html", n, pad="pad").orderBy("id", "row_no").collect():
        got.setdefault(r.id, []).append((r.is_header, r.cells))
    want = {i: table_rows(page, n) for i, page in rows}
    assert got == {i: [(h, [*c, "pad"] if len(c) == 1 else c) for h, c in found] for i, found in want.items() if found}


@pytest.mark.parametrize("list_no, container, n", [(None, None, 0), (0, None, 0), (1, None, 0), (None, "b", 0), (None, "b", 1), (0, "a", 0)])
def test_lists(pages, list_no, container, n):
    rows, df = pages
    got = {}
    for r in H.html_list_items(df, "html", list_no, container, n).orderBy("id", "item_no").collect():
        got.setdefault(r.id, []).append(r.item)
    want = {i: list_items(page, list_no, container, n) for i, page in rows}
    assert got == {i: found for i, found in want.items() if found}


def test_references_are_decoded_once(spark):
    texts = ["&amp;lt;", "&#38;lt;", "&#x26;#65;", "a &lt;b&gt; &unknown; &#0; &#xD800; &#1114112; &#128578; &eacute;&Eacute; & &amp", "&nbsp;&#160;&#xA0;", "&frac12;", ""]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select(decode_entities(F.col("t")).alias("d"))
    assert [r.d for r in df.collect()] == ["&lt;", "&lt;", "&#65;", "a <b> &unknown; &#0; &#xD800; &#1114112; 🙂 é&Eacute; & &amp", "&nbsp;&nbsp;&nbsp;", "½", "", None]
    assert spark.createDataFrame([("<p>a&nbsp;b &amp;<br>  c</p>",)], "t string").select(strip_markup(F.col("t"))).first()[0] == "ab & c"
