"""Tables, lists and rates out of HTML and sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.columns import let, ref
from tabkit.functions.text import extract_age_range, extract_numbers, extract_percentage, strip_markup

# What a page is read as, piece by piece: comments, scripts and styles, tags, text.
PIECE = r"(?is)<!--.*?(?:-->|\z)|<(?:script|style)\b.*?(?:</(?:script|style)\s*>|\z)|<[^>]*(?:>|\z)|[^<]+"
# Signs that a page holds more than plain tags and text: a tag within a tag, a comment, a script or style.
UNEVEN = r"(?is)<(?:[^<>]*+<|!--|(?:script|style)\b)"  # one look at each sign, and none back
REMOVED = r"(?is)^<(?:!--|(?:script|style)\b)"
TAG = r"<[^>]*(?:>|\z)"
TABLE, ROW, CELL, PLAIN_CELL = (
    rf"(?i)<{x}(?![A-Za-z0-9])[^>]*(?:>|\z)" for x in ("/?table", "/?(?:tr|thead|tbody|tfoot)", "t[dh]", "td"))
CELL_TEXT = rf"(?s){CELL}(.*?)(?=</?t[dh](?![A-Za-z0-9])|\z)"  # from a start tag to the next start or end tag of a cell
LIST = r"(?i)</?(?:ul|ol|li)(?![A-Za-z0-9])[^>]*(?:>|\z)"
ITEM = r"(?i)^<li(?![A-Za-z0-9])"
CLASSED = r"(?i)<[a-z][^>]*\bclass\s*=[^>]*(?:>|\z)"

LONGEST = 2**30  # of slices and substrings that go to the end
MAX_AGE = 150  # fixed value: stands in for the second cell of a row with one cell


def _plain(html: Column) -> Column:
    """The page without comments, scripts and styles, and with no tag inside another, so that a tag is what looks like one.
    Most pages are so already and are not taken apart."""
    pieces = F.filter(F.regexp_extract_all(html, F.lit(PIECE), F.lit(0)), lambda p: ~p.rlike(REMOVED))
    alone = F.transform(pieces, lambda p: F.when(p.startswith("<"), F.concat(F.lit("<"), F.replace(F.substring(p, 2, LONGEST), F.lit("<"), F.lit(" ")))).otherwise(p))
    return F.when(html.rlike(UNEVEN), F.array_join(alone, "")).otherwise(html)


def _cut(html: Column, tag: str | Column) -> Column:
    """Array of (tag, opens, after): every tag that matches, and what follows it up to the next. What comes before the first is left out."""
    pattern = F.lit(tag) if isinstance(tag, str) else tag
    return F.zip_with(F.regexp_extract_all(html, pattern, F.lit(0)), F.slice(F.split(html, pattern, -1), 2, LONGEST),
                      lambda t, s: F.struct(t.alias("tag"), (~t.startswith("</")).alias("opens"), s.alias("after")))


def _deeper(depth: Column, opens: Column) -> Column:
    return depth + F.when(opens, 1).otherwise(-1)


def _nth_table(html: Column, n: int) -> Column:
    """What is between the tags of the n-th table, with the tables inside it as text. The fold is over the tags of tables only."""
    start = F.struct(F.lit(0).alias("seen"), F.lit(0).alias("depth"), F.lit(False).alias("done"), F.lit("").alias("text"))

    def step(at: Column, t: Column) -> Column:
        depth = F.when(at["depth"] > 0, _deeper(at["depth"], t["opens"])).when(t["opens"] & ~at["done"] & (at["seen"] == n), F.lit(1)).otherwise(F.lit(0))
        text = F.when(depth == 1, F.concat(at["text"], t["after"])).when(depth > 1, F.concat(at["text"], F.regexp_replace(t["after"], TAG, ""))).otherwise(at["text"])
        return F.struct((at["seen"] + t["opens"].cast("int")).alias("seen"), depth.alias("depth"), (at["done"] | (at["depth"] == 1) & ~t["opens"]).alias("done"), text.alias("text"))

    return F.aggregate(_cut(html, TABLE), start, step, lambda at: at["text"])


def html_table_rows(df: DataFrame, html: str, n: int = 1, pad: object = MAX_AGE) -> DataFrame:
    """Rows of the n-th table (from 0, by start tags) of every page: ``row_no``, ``is_header``, ``cells``. Other columns are kept.

    End tags of rows and cells may be left out. Text of a table inside a cell belongs to the cell; its rows are rows of a table
    of their own. A header row has header cells only. A row with a single cell gets the pad value as its second one.

    The page is cut at the tags of tables, the table at those of rows and a row at those of cells, so each text is looked at a few times
    whatever the number of its tags, and a page is one row until its rows are known.
    """
    inside = let(_plain(ref(html)), lambda page: _nth_table(page, n))
    rows = F.filter(F.split(inside, ROW, -1), lambda r: r.rlike(CELL))
    rows = df.select(*[ref(c) for c in df.columns if c != html], F.posexplode(rows).alias("row_no", "_row"))
    rows = rows.select("*", (~F.col("_row").rlike(PLAIN_CELL)).alias("is_header"), F.regexp_extract_all("_row", F.lit(CELL_TEXT), F.lit(1)).alias("_cells")).drop("_row")
    cells = F.transform("_cells", strip_markup)
    padded = F.when(F.size("_cells") == 1, F.concat(cells, F.array(F.lit(str(pad))))).otherwise(cells)
    return rows.withColumn("cells", padded).drop("_cells")


def _within(html: Column, container: str, n: int) -> Column:
    """What is inside the n-th element of a class, up to its own end tag or the end of the page; NULL without one."""
    def has(tag: Column) -> Column:
        return F.array_contains(F.split(F.regexp_extract(tag, r"""(?is)\bclass\s*=\s*["']?([^"'>]*)""", 1), r"\s+"), container)

    def chosen(tags: Column) -> Column:  # place of the n-th element among those with a class
        return F.get(F.filter(F.transform(tags, lambda t, i: F.when(has(t), i)), lambda i: i.isNotNull()), F.lit(n))

    def rest(tags: Column) -> Column:
        return let(chosen(tags), lambda i: F.when(i.isNotNull(), F.struct(
            F.regexp_extract(F.get(tags, i), "^<([A-Za-z][A-Za-z0-9]*)", 1).alias("name"), F.get(F.split(html, CLASSED, i + 2), i + 1).alias("after"))))

    def to_end(found: Column) -> Column:
        same = F.concat(F.lit("(?i)</?"), found["name"], F.lit(r"(?![A-Za-z0-9])[^>]*(?:>|\z)"))
        before = F.get(F.split(found["after"], same, 2), F.lit(0))
        start = F.struct(F.lit(1).alias("depth"), before.alias("text"))
        step = lambda at, t: F.when(at["depth"] == 0, at).otherwise(F.struct(
            _deeper(at["depth"], t["opens"]).alias("depth"),
            F.when(_deeper(at["depth"], t["opens"]) == 0, at["text"]).otherwise(F.concat(at["text"], t["tag"], t["after"])).alias("text")))
        return F.when(found.isNotNull(), F.aggregate(_cut(found["after"], same), start, step, lambda at: at["text"]))

    return let(let(F.regexp_extract_all(html, F.lit(CLASSED), F.lit(0)), rest), to_end)


def html_list_items(df: DataFrame, html: str, list_no: int | None = None, container: str | None = None, n: int = 0) -> DataFrame:
    """List items of every page as text: ``item_no``, ``item``. Other columns are kept.

    ``container`` takes only what is inside the n-th element (from 0) of that class; ``list_no`` only the items of that list
    (from 0, by start tags, inside the container if one is given). End tags of items may be left out. A list inside an item ends
    the item's own text.
    """
    page = _plain(ref(html))
    if container:
        page = let(page, lambda h: _within(h, container, n))
    cut = let(page, lambda h: _cut(h, LIST))
    if list_no is None:
        items = F.transform(F.filter(cut, lambda t: t["tag"].rlike(ITEM)), lambda t: t["after"])
    else:
        start = F.struct(F.lit(0).alias("lists"), F.array().cast("array<int>").alias("open"), F.array().cast("array<string>").alias("items"))

        def step(at: Column, t: Column) -> Column:
            item, is_list = t["tag"].rlike(ITEM), ~t["tag"].rlike("(?i)^</?li(?![A-Za-z0-9])")
            open_lists = F.when(is_list & t["opens"], F.concat(at["open"], F.array(at["lists"]))).when(
                is_list, F.slice(at["open"], 1, F.greatest(F.size(at["open"]) - 1, F.lit(0)))).otherwise(at["open"])
            here = F.coalesce(F.get(at["open"], F.size(at["open"]) - 1), F.lit(-1)) == list_no
            return F.struct((at["lists"] + (is_list & t["opens"]).cast("int")).alias("lists"), open_lists.alias("open"),
                            F.when(item & here, F.concat(at["items"], F.array(t["after"]))).otherwise(at["items"]).alias("items"))

        items = F.aggregate(cut, start, step, lambda at: at["items"])
    out = df.select(*[ref(c) for c in df.columns if c != html], F.posexplode(items).alias("item_no", "_item"))
    return out.withColumn("item", strip_markup(F.col("_item"))).drop("_item")


def rates_from_text(df: DataFrame, text: str) -> DataFrame:
    """Sentence to rate: ``lo``, ``hi``, ``rate``. "aged a–b" gives both ends, otherwise the first number that
    follows "aged" is an open-ended start; without either both ends are NULL."""
    both = extract_age_range(ref(text))
    start = F.try_element_at(extract_numbers(F.regexp_extract(ref(text), r"aged (\d+)", 1)), F.lit(1)).cast("int")
    return df.select("*", F.coalesce(both["lo"], start).alias("lo"), both["hi"].alias("hi"),
                     extract_percentage(ref(text)).alias("rate"))


def scale_rates(ages: DataFrame, male: float, female: float) -> DataFrame:
    """Age bands by sex: the published rate for women (0), scaled by men/women for men (1), as probabilities."""
    groups = F.explode(F.array(F.struct(F.lit(0).alias("grp"), F.lit(1.0).alias("up"), F.lit(1.0).alias("down")),
                               F.struct(F.lit(1).alias("grp"), F.lit(male).alias("up"), F.lit(female).alias("down"))))
    prob = F.col("rate") * F.col("g.up") / F.col("g.down") / 100.0
    return ages.withColumn("g", groups).select(F.col("g.grp").alias("grp"), "lo", "hi", prob.alias("prob"))
