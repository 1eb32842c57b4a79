"""HTML extraction: the main text of pages, with the help of a suffix array over the pages of each host.

A page is read into blocks, the text between block-level tags. Scripts, styles, heads and hidden parts are no blocks; menus,
headers, footers, sidebars, notices, adverts, forms and reader comments are known by their tag, role, class or id; of a class or id whole
names count, and a name does not decide on what holds most of a page's words when no article lies outside it. The blocks
of all pages of a host, as word counts and hashes, are the token streams; a suffix array over them, built by the same
distributed prefix doubling as in ``lines``, gives the runs of blocks with ``LEAST_WORDS`` words or more that repeat: that
``LEAST_PAGES`` distinct pages or more, and a share of ``LEAST_SHARE`` of the host's distinct pages, hold. Blocks covered by such runs are boilerplate, and what is left are the unique runs, joined by line ends in page order.

Where the page itself marks its article (``article``, else ``main``, or ``main`` with cards in it), the text comes from the blocks in it that are not one of the
kinds above. Of these go the runs that so many pages hold within the article, and so many outside it: menus and notices set into the article. Others stay: copies of an article, lines that
many articles quote, or a line that some advert repeats, are not boilerplate. Pages without such a mark lose all that repeats on the host's pages,
within articles or not; near copies of one article on fewer pages keep it.

Pages are read in tasks; block hashes are shuffled, html is not. The runs that decide on a page are stored and come to its text
by a join whose side Spark chooses by size: texts are shuffled only where these runs are too many to send to every task. A host
with a third of all pages is counted before the shuffle and its joins are ones that Spark splits.

Cases: a NULL html has an empty text; a NULL url is the host ''; rows that repeat a page id and html are one page and get equal
rows; pages with equal html are one page for the count of distinct pages; NULL ids are kept; unfinished tags, comments and
references at the end of a cut page end there; an empty table gives an empty result; extra input columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.lines import repeated_parts, shortest_runs
from tabkit.llm.stored import store
from tabkit.runtime import settle

LEAST_WORDS = 5
# A run repeats if so many of the host's distinct pages, and that share of them, hold it: a page, a revision and a print view do not suffice.
LEAST_PAGES = 4
LEAST_SHARE = 0.1
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
                   " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody"
                   " td tfoot th thead title tr ul").split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
NO_TEXT = frozenset("head script style noscript template iframe noembed noframes svg math canvas audio video object map select datalist".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside menu dialog button textarea".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
BOILERPLATE_NAMES = frozenset((
    "ad ads adv advert adverts advertisement advertising banner billboard sponsor sponsored sponsors promo promos promotion promoted"
    " nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar toolbar footer colophon copyright"
    " sidebar sidebars aside widget widgets rail cookie cookies consent gdpr notice notices alert popup modal overlay paywall"
    " comment comments commentlist respond replies disqus share sharing social related recommended recommendations newsletter"
    " subscribe subscription signup login search searchform pagination pager skip form").split())
# Parts that say nothing of their own in the name of a class or id: "cookie-box" is a notice, "article-header" no page header.
NEUTRAL_NAMES = frozenset((
    "area bar block bottom box btn button buttons col column container content desktop element fixed global group icon icons inner item items"
    " left link links list main mobile module outer panel primary region right row secondary section site slot sticky text title top unit wrap wrapper").split())

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s\"'>]+))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
# Which open element a start tag ends, and the elements beyond which it does not look.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}


class Block(NamedTuple):
    text: str
    place: int  # 2 in an article, 1 in the main part, 0 elsewhere
    known: bool  # known to be boilerplate by its mark-up


SURE, BY_NAME = 2, 1


def _named(token: str) -> bool:
    """Whether a class or id names boilerplate: one of its parts does, and the others say nothing."""
    parts = [x.lower() for x in _NAME.findall(token)]
    return any(x in BOILERPLATE_NAMES for x in parts) and all(x in BOILERPLATE_NAMES or x in NEUTRAL_NAMES or x.isdigit() for x in parts)


def _boilerplate(name: str, attributes: str) -> int:
    """``SURE`` by its tag, role or because it is hidden, ``BY_NAME`` if it is a form or a class or id says so, else 0.

    Attributes are read one after the other, so no value is taken for an attribute, and no attribute for another that ends alike.
    """
    if name in BOILERPLATE_TAGS:
        return SURE
    found = BY_NAME if name == "form" else 0
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" and value.lower() != "until-found" or key == "aria-hidden" and value.lower() == "true":
            return SURE
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return SURE
        if name in ("html", "body", "main"):
            continue
        if key == "role" and value.lower() in BOILERPLATE_ROLES:
            return SURE
        if key in ("class", "id") and any(map(_named, value.split())) or key == "role" and value.lower() == "form":
            found = BY_NAME
    return found


class _Read(NamedTuple):
    text: str
    place: int
    sure: bool
    named: tuple[int, ...]  # numbers of the elements around it that are boilerplate by their name


def _decided(read: list[_Read]) -> list[Block]:
    """A name decides on an element unless that holds most words of the page and no marked article lies outside: a wrapper's class tells
    of its looks, and a page may be one form."""
    words = [len(r.text.split()) for r in read]
    held: dict[int, int] = {}
    for r, n in zip(read, words):
        for element in r.named:
            held[element] = held.get(element, 0) + n
    large = {e for e, n in held.items() if 2 * n > sum(words)}
    while large:  # an element inside a large one may be large too, so the innermost that is no wrapper decides
        marked = {e for e in large if any(r.place and not r.sure and e not in r.named and not any(x not in large for x in r.named) for r in read)}
        if not marked:
            break
        large -= marked
    return [Block(r.text, r.place, r.sure or any(e not in large for e in r.named)) for r in read]


def blocks_of(page: str) -> list[Block]:
    """All blocks of a page that have text, in page order."""
    out: list[_Read] = []
    held: list[str] = []
    open_: list[tuple[str, int, bool, tuple[int, ...], bool]] = []  # name, place, sure, named, without text
    place, sure, named, mute, numbered = 0, False, (), False, 0
    at, end = 0, len(page)

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append(_Read(text, place, sure, named))

    def close(depth: int) -> None:
        nonlocal place, sure, named, mute
        _, *after = open_[depth - 1] if depth else ("", 0, False, (), False)
        if [place, sure, named, mute] != after or any(name in BLOCK for name, *_ in open_[depth:]):
            flush()
        del open_[depth:]
        place, sure, named, mute = after

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            if not mute:
                held.append(page[at:])
            break
        if lt > at and not mute:
            held.append(page[at:lt])
        tag = _TAG.match(page, lt)
        if tag is None:
            if not mute:
                held.append("<")
            at = lt + 1
            continue
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if tag[1]:
            if name in BLOCK:
                flush()
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] == name:
                    close(depth)
                    break
            continue
        if name == "br":
            held.append(" ")
            continue
        if name in BLOCK:
            flush()
            ends, beyond = _ENDS.get(name, (set(), set()))
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] in ends or open_[depth][0] == "p":
                    close(depth)
                    if open_ and not ends:
                        break
                elif open_[depth][0] in beyond or not ends and open_[depth][0] in BLOCK:
                    break
        if name in VOID or tag[3].endswith("/") and name not in BLOCK:
            continue
        boiler = _boilerplate(name, tag[3])
        if boiler or name in NO_TEXT or name in ("article", "main"):
            flush()
        place = max(place, 2 if name == "article" else 1 if name == "main" else 0)
        if boiler == BY_NAME:
            numbered += 1
            named = (*named, numbered)
        sure, mute = sure or boiler == SURE, mute or name in NO_TEXT
        open_.append((name, place, sure, named, mute))
        if name in RAW:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
            to = stop.start() if stop else end
            if not mute:
                held.append(page[at:to])
            at = to
    flush()
    return _decided(out)


def article_marks(blocks: list[Block]) -> list[bool] | None:
    """Of every block, whether it belongs to the marked article; None if the page marks none.

    Articles go before the main part, unless they hold less than half of its words: then they are cards beside the text.
    """
    words = {p: sum(len(b.text.split()) for b in blocks if not b.known and b.place == p) for p in (1, 2)}
    if not any(words.values()):
        return None
    least = 2 if words[2] and words[2] >= words[1] else 1
    return [not b.known and b.place >= least for b in blocks]


def article_of(blocks: list[Block]) -> list[str] | None:
    """The blocks of the marked article, None if the page marks none."""
    marks = article_marks(blocks)
    return None if marks is None else [b.text for b, own in zip(blocks, marks) if own]


def sides(marks: list[bool] | None, blocks: int) -> list[int]:
    """From every block on, the blocks on its side of the article's border, ``LEAST_WORDS`` at most: above 0 within the article,
    below 0 outside it, 0 on a page that marks none."""
    out = [0] * blocks
    for i in range(blocks - 1, -1, -1) if marks is not None else ():
        more = abs(out[i + 1]) if i + 1 < blocks and marks[i + 1] == marks[i] else 0
        out[i] = min(more + 1, LEAST_WORDS) * (1 if marks[i] else -1)
    return out


def _streams(pages: DataFrame) -> DataFrame:
    """id, print, pos, h1, h2, parts of every block: what ``repeated_parts`` takes, and side. The host is part of the hash and, hashed,
    the id: pages with one html on a host are one stream."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            owner, hashes, sizes, words, side = [], [], [], [], []
            for i, (host, page) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                seed, blocks = xxhash.xxh3_64_intdigest(host), blocks_of(page)
                side += sides(article_marks(blocks), len(blocks))
                for block in blocks:
                    owner.append(i)
                    hashes.append(xxhash.xxh3_64_intdigest(block.text, seed))
                    sizes.append(len(block.text))
                    words.append(block.text.count(" ") + 1)
            owner, words = np.array(owner, np.int64), np.array(words, np.int64)
            places, lengths = shortest_runs(words, owner, batch.num_rows, LEAST_WORDS)
            first = np.searchsorted(owner, owner, side="left")
            of = np.searchsorted(places, np.arange(len(owner) + 1))
            row = pa.array(owner)
            yield pa.record_batch([batch.column(0).take(row), batch.column(1).take(row), pa.array((np.arange(len(owner)) - first).astype(np.int32)),
                                   pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()),
                                   pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), pa.array(lengths.astype(np.int32))), pa.array(side, pa.int8())],
                                  ["id", "print", "pos", "h1", "h2", "parts", "side"])

    return pages.select("site", "print", "host", "html").mapInArrow(task, "id bigint, print bigint, pos int, h1 bigint, h2 int, parts array<int>, side tinyint")


def repeated_blocks(pages: DataFrame) -> DataFrame:
    """(id, print, covered): the runs (pos, l) of blocks that go, by hashed host and print. On pages without a mark they
    repeat on enough distinct pages of the host, on others they lie within the article and do so both within and outside articles."""
    streams = settle(_streams(pages), "streams")
    parts = settle(repeated_parts(streams, LEAST_WORDS, ("side",)), "parts")
    hosts = store(streams.select("id", "print").distinct().groupBy(F.col("id").alias("k_id")).agg(F.count(F.lit(1)).alias("pages")), "hosts")
    within, outside = F.col("side") >= F.col("l"), -F.col("side") >= F.col("l")
    pages_of = parts.groupBy("id", "l", "a", "b", "print").agg(F.max(within.cast("int")).alias("in"), F.max(outside.cast("int")).alias("out"))
    wide = store(pages_of.groupBy("id", "l", "a", "b").agg(F.count(F.lit(1)).alias("n"), F.sum("in").alias("n_in"), F.sum("out").alias("n_out")).where(F.col("n") >= LEAST_PAGES), "runs")
    often = lambda n: (n >= LEAST_PAGES) & (n >= LEAST_SHARE * F.col("pages"))
    wide = (wide.join(hosts, F.col("id") == F.col("k_id"))
            .where(often(F.col("n"))).select(F.col("l").alias("kl"), F.col("a").alias("ka"), F.col("b").alias("kb"), (often(F.col("n_in")) & often(F.col("n_out"))).alias("both")))
    wide = store(wide, "wide")  # the join then shuffles both sides itself, and Spark may split a run that very many pages hold
    found = (parts.where((F.col("side") == 0) | within).join(wide, (F.col("l") == F.col("kl")) & (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb")))
             .where("side = 0 OR both").groupBy("id", "print").agg(F.collect_set(F.struct("pos", "l")).alias("covered")))
    return store(found, "covered")


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: the id, the url, text and marked, whether the page marks its article."""
    page = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    pages = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.xxhash64(page).alias("print"), F.col(f"`{url_col}`").alias("url"),
                      F.lower(F.coalesce(F.regexp_extract(F.col(f"`{url_col}`").cast("string"), HOST, 1), F.lit(""))).alias("host"), page.alias("html"))
    pages = pages.withColumn("site", F.xxhash64("host"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked, rest = [], []
            for page in batch.column(4).to_pylist():
                blocks = blocks_of(page)
                marks = article_marks(blocks)
                marked.append(marks is not None)
                rest.append([{"pos": i, "text": b.text} for i, b in enumerate(blocks) if (not b.known if marks is None else marks[i])])
            yield pa.record_batch([*batch.columns[:4], pa.array(marked), pa.array(rest, pa.list_(pa.struct([("pos", pa.int32()), ("text", pa.string())])))],
                                  ["id", "site", "print", "url", "marked", "blocks"])

    kind = pages.schema["url"].dataType.simpleString()
    done = pages.select("id", "site", "print", "url", "html").mapInArrow(read, f"id bigint, site bigint, print bigint, url {kind}, marked boolean, blocks array<struct<pos:int,text:string>>")
    covered = repeated_blocks(pages).withColumnsRenamed({"id": "k_id", "print": "k_print"})
    joined = done.join(covered, (F.col("site") == F.col("k_id")) & (F.col("print") == F.col("k_print")), "left")
    gone = lambda b: F.exists("covered", lambda r: (b["pos"] >= r["pos"]) & (b["pos"] < r["pos"] + r["l"]))
    left = F.when(F.col("covered").isNull(), F.col("blocks")).otherwise(F.filter("blocks", lambda b: ~gone(b)))
    text = F.array_join(F.transform(left, lambda b: b["text"]), "\n")
    return joined.select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text"), "marked")
