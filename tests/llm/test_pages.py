"""Main text of pages: mark-up cases by hand, repeats by brute force."""

from tabkit.llm import pages

CASES = [
    ("<article><h1>T &amp; t</h1><p>a <b>b</b><br>c</p><p>d&#8211;e&nbsp;f &am", ["T & t", "a b c", "d–e f &am"]),
    ("<body><nav>menu</nav><article><p>x<aside>ad</aside>y</article><footer>f</footer>", ["x", "y"]),
    ("<article><script>if (a < b) document.write('<p>no</p>')</script><style>p{}</style><p>yes<!-- <p>no</p> --></article>", ["yes"]),
    ("<article><div class='share-buttons'>no</div><p>one<p>two<ul><li>a<li>b</ul><div id=comments><p>no</div>end</article>", ["one", "two", "a", "b", "end"]),
    ("<main><p>m</p><article><p>in</p></article></main>", ["in"]),
    ("<main><p>m</p><form><input value='x'><label>no</label></form></main><p>out</p>", ["m"]),
    ("<article><table><tr><td>1<td>2<tr><td><table><tr><td>3</table>4</table></article>", ["1", "2", "3", "4"]),
    ("<ARTICLE><P CLASS=ad>no<P>yes<p data-x='a>b'>q</ARTICLE>", ["yes", "q"]),
    ("<article><p>a &lt;tag&gt; 5 < 6 <p", ["a <tag> 5 < 6"]),
    ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p><!-- open", ["yes"]),
    ("<article><p>x</p><section class='cookie-notice'><div>no</div></section><section class=story><p>y</section></article>", ["x", "y"]),
    ("<article><p>a <b>b</b> c<i>d</i>e <a href=x>f</a>, g <span class=ad>no</span>h</article>", ["a b cde f, g", "h"]),
    ("<article><p title='a hidden gem'>a<p data-hidden='false'>b<p data-id='nav'>c<p hidden=''>no<p aria-hidden=true>no<p aria-hidden=false>d</article>", ["a", "b", "c", "d"]),
    ("<article><p title=\"class='ad'\">a<p CLASS = 'x  ad'>no<p id=ad-2>no<p class=myAdBox>b<p class='AdBox'>no</article>", ["a", "b"]),
    ("<body class='has-sidebar'><div class='content no-sidebar'><article><h1 class='article-header'>h</h1><p class='social-science'>s</article></div>", ["h", "s"]),
    ("<form id=aspnetForm><article><p>one page in a form</p><form><p>no</p></form></article></form>", ["one page in a form"]),
    ("<div class='widget'><div class='header'><article><p>the text of a page in a wrapper</article></div><p>x</div>", ["the text of a page in a wrapper"]),
    ("<article><p>the text</article><article class='comment'><p>a longer answer of some reader to it</article><article class=promo><p>no</article>", ["the text"]),
    ("<main><p>text</p></main><div id=comments><p>more words than the page itself has in all</div>", ["text"]),
    ("<article class=comment><p>the one article</article>", ["the one article"]),
    ("<main><p>the main text of this page</p><article><p>a card</article><p>goes on</main>", ["the main text of this page", "a card", "goes on"]),
    ("<main><article><p>first story of this page</article><article><p>second</article><p>x</main>", ["first story of this page", "second"]),
    ("<article></article>", None), ("plain text", None), ("", None), ("<", None),
]


def test_cases():
    for page, want in CASES:
        assert pages.article_of(pages.blocks_of(page)) == want, page


def text_rows(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, id int, print int, host int, covered int")
    return {(r.page_id, r.url): r.text for r in pages.main_text(df).collect()}


def test_repeats_on_a_host_go(spark):
    page = "<div>Our menu of many fine words</div><div>short</div><div>story number {0} has words of its own</div><div><p>a b</div><p>c d</p><p>e f</p><footer>by us</footer>"
    rows = [(i, f"https://h.example/{i}", page.format(i), "x", 1, 1, 1, 1) for i in range(6)]
    rows += [(10, "https://other.example/", page.format(10), None, None, None, None, None), (11, None, None, None, 1, 1, 1, 1), (None, "https://h.example/z", page.format(77), "", 1, 1, 1, 1)]
    rows += [(12, "https://copies.example/1", page.format(5), "", 1, 1, 1, 1), (13, "https://copies.example/2", page.format(5), "", 1, 1, 1, 1)]
    rows += [(20 + i, "https://h.example/a", f"<article><p>Our menu of many fine words<p>own {i}</article>", "", 1, 1, 1, 1) for i in range(2)]
    got = text_rows(spark, rows + rows[:1])
    for i in range(6):
        assert got[(i, f"https://h.example/{i}")] == f"story number {i} has words of its own"
    assert got[(None, "https://h.example/z")] == "story number 77 has words of its own"
    whole = "Our menu of many fine words\nshort\nstory number {0} has words of its own\na b\nc d\ne f"
    assert got[(10, "https://other.example/")] == whole.format(10)
    assert got[(11, None)] == ""
    assert got[(12, "https://copies.example/1")] == got[(13, "https://copies.example/2")] == whole.format(5)  # one page
    assert got[(20, "https://h.example/a")] == "Our menu of many fine words\nown 0"  # marked: nothing is dropped


def test_runs_decide_on_marked_pages(spark):
    notice, quote = "Please read our notice on every page", "To be or not to be, that is it"
    page = "<div class=notice>{1}</div><article><p>story {0}</p><p>" + notice + "</p><p>" + quote + "</p></article>"
    rows = [(i, f"https://m.example/{i}", page.format(i, notice), "", 1, 1, 1, 1) for i in range(6)]
    rows += [(10 + i, f"https://n.example/{i}", page.format(i, "no"), "", 1, 1, 1, 1) for i in range(6)]
    rows += [(20, "https://m.example/u", "<div>" + quote + "</div><div>a page of its own words</div>", "", 1, 1, 1, 1)]
    advert = "<div class=ad>{1}</div><article><p>story {0}</p><p>" + quote + "</p></article>"
    rows += [(30 + i, f"https://o.example/{i}", advert.format(i, quote if i < 2 else "no"), "", 1, 1, 1, 1) for i in range(6)]
    got = {k: v for (k, _), v in text_rows(spark, rows).items()}
    for i in range(6):
        assert got[i] == f"story {i}\n{quote}"  # the notice repeats within and outside articles
        assert got[10 + i] == f"story {i}\n{notice}\n{quote}"  # within articles only
        assert got[30 + i] == f"story {i}\n{quote}"  # outside articles on two pages only
    assert got[20] == "a page of its own words"  # the quote repeats in articles of other pages


def test_near_copies_of_an_unmarked_article_stay(spark):
    menu, article = "<div>Our menu of many fine words</div>", "<p>The first paragraph of one long article</p><p>and the second one, also long enough</p>"
    views = [menu + article, menu + article + "<p>revised</p>", "<body class=print>" + menu + article]
    rows = [(i, f"https://r.example/{i}", v, "", 1, 1, 1, 1) for i, v in enumerate(views)]
    rows += [(10 + i, f"https://r.example/{10 + i}", f"{menu}<p>story {i} has words of its own</p>", "", 1, 1, 1, 1) for i in range(37)]
    rows += [(100 + i, f"https://s.example/{i}", f"<p>number {i}</p>" + article, "", 1, 1, 1, 1) for i in range(2)]
    rows += [(200 + i, f"https://t.example/{i}", f"<p>story {i} has words of its own</p>" + (article if i < 4 else ""), "", 1, 1, 1, 1) for i in range(60)]
    got = {k: v for (k, _), v in text_rows(spark, rows).items()}
    text = "The first paragraph of one long article\nand the second one, also long enough"
    assert [got[0], got[1], got[2]] == [text, text + "\nrevised", text]  # three of forty pages
    assert got[10] == "story 0 has words of its own"  # the menu is on all
    assert [got[100], got[101]] == ["number 0\n" + text, "number 1\n" + text]  # all pages of the host, but two
    assert got[200] == "story 0 has words of its own\n" + text  # four pages, but less than a tenth


def test_empty_table(spark):
    assert text_rows(spark, []) == {}


def test_whole_table(spark, small):
    from tabkit.llm import queries
    rows = queries.op8_main_text(spark, small).collect()
    assert len(rows) == spark.read.parquet(f"{small}/pages.parquet").count()
    assert all(r.text and r.n_chars == len(r.text) and "track(" not in r.text and "©" not in r.text for r in rows)
