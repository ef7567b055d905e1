"""Main text of pages: what goes, what stays, and templates of a host."""

from odflux.llm import html_text as ht

SCHEMA = "page_id long, url string, html string, host string, text string"


def test_elements_that_are_no_article():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a>Menu</a></ul></nav>
    <div class="cookie-notice">We use</div><article><header><h1>Head &amp; line</h1></header><p>One <b>bold.<br><p>Two&nbsp; two
    <script>var x = "</p>";</script>end<!-- <p>no</p> --><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><form><p>f</form>
    <section id="comments"><article>reader</article></section><footer>by me</footer></article><aside>Side</aside><footer>F</footer></body></html>"""
    assert ht.main_text(page) == "Head & line\nOne bold.\nTwo two end\na\nb\nc d"


def test_without_article():
    assert ht.main_text("<body><div role=navigation>x</div><main><p>m</main><p>out") == "m"
    assert ht.main_text("<body><ul><li><a>x</a><li><a>y</a></ul><p>text &lt;b&gt; &#233;") == "text <b> é"
    assert ht.main_text("plain <1 text & more") == "plain <1 text & more"
    assert [ht.main_text(t) for t in (None, "", "<", "<p", "<script>x", "<!--", "</div></p>", "<p title='a>b")][:3] == ["", "", "<"]
    assert ht.main_text("<div>" * 30_000 + "deep") == "deep"


def test_attributes_are_read_whole():
    kept = ('a href="/hidden-gems"', 'p style="overflow:hidden"', 'div data-id="menu"', 'a href="/x?id=ad"', "p title='class=ad'", "p data-hidden",
            "a href=/x?class=ad", "p title = 'a hidden b'", "p xclass=ad", "div class=a class=ad", 'p title="a>b hidden"', "p title= 'id = menu' lang=en")
    for tag in kept:
        assert ht.main_text(f"<body><p>a</p><{tag}>words</{tag.split()[0]}></body>").split() == ["a", "words"], tag
    for tag in ("p hidden", "p HIDDEN=''", 'p title="x"hidden', "p a/hidden", "div lang=en class = 'ad'", 'div id="menu"', "p aria-hidden=true", "p x= y role=alert"):
        assert ht.main_text(f"<body><p>a</p><{tag}>words</{tag.split()[0]}></body>") == "a", tag
    assert ht.main_text('<body><div style="overflow:hidden"><p>the article</p></div></body>') == "the article"


def test_names_that_wrap_an_article():
    for name in ("content has-sidebar", "no-ads", "layout with-menu", "post comment-open", "sidebar", "overlay"):
        for page in (f'<body><div class="{name}"><article><p>words</p></article></div>', f'<body><article id="a" class="{name}"><p>words</p></article>',
                     f'<body><div class="{name}"><div><main><p>words</p></main></div></div>', f'<body><div class="{name}"><div role=main>words</div></div>'):
            assert ht.main_text(page) == "words", page
    for name in ("content has-sidebar", "no-ads", "layout with-menu"):
        assert ht.main_text(f'<body><div class="{name}"><p>words</p></div>') == "words", name
    article = '<article><div class="post-header"><h1>Title</h1></div><div class="header">by</div><p>words</p><div class="{}">no</div></article>'
    for name in ("sidebar", "x ad y", "cookie-notice", "comments", "widget-2", "Related_Share"):
        assert ht.main_text(f"<body>{article.format(name)}") == "Title\nby\nwords", name
    reader = '<div id="comments"><article class="comment">reader</article></div>'
    assert ht.main_text(f"<body><article><p>words</p></article>{reader}") == "words"
    assert ht.main_text(f"<body><main><p>words</p>{reader}</main>") == "words"
    assert ht.main_text(f"<body>{reader}") == "reader"  # the only article there is
    assert ht.main_text('<body><article class="ad">a</article><div class="promo"><article>b</article></div><article>c</article>') == "a\nb\nc"


def test_templates_are_removed(spark):
    frame = lambda i: f"<body><div>Our shop sells things</div><p>Own text {i} of page.</p><p>Imprint and terms</p></body>"
    rows = [(i, f"http://A.example/{i}", frame(i), "", "") for i in range(20)]
    rows += [(100 + i, "http://copies.example/", "<p>the same article</p>", "", "") for i in range(20)]
    rows += [(200, None, None, "", ""), (201, "no host", "", "", ""), (None, "http://a.example/x", frame("x"), "", ""), rows[0], (202, "http://b/", "<p>é " * 100_000, "", "")]
    got = {}
    for r in ht.extract_text(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.page_id, []).append((r.text, r.n_chars))
    assert got[0] == [("Own text 0 of page.", 19)] * 2 and got[None] == [("Own text x of page.", 19)]
    assert got[100] == [("the same article", 16)]  # copies are one distinct page, hence no template
    assert got[200] == got[201] == [("", 0)]
    assert got[202][0][1] == 199_999
    assert ht.extract_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_templates_of_sections(spark):
    notice = lambda i: f"<body><p>Own text {i}.</p><p>Prices of the shop</p></body>"
    rows = [(i, f"http://a.example/shop/{i}", notice(i), "", "") for i in range(8)]
    rows += [(100 + i, f"http://a.example/{'news' if i % 2 else 'blog'}/x/{i}", f"<body><p>Own text {i}.</p></body>", "", "") for i in range(40)]
    rows += [(200, "http://a.example/news/y", notice(200), "", ""), (201, "http://a.example/shop", notice(201), "", "")]
    got = {r.page_id: r.text for r in ht.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(8)] == [f"Own text {i}." for i in range(8)]
    assert all(got[100 + i] == f"Own text {i}." for i in range(40))
    assert got[200] == "Own text 200.\nPrices of the shop" and got[201] == "Own text 201.\nPrices of the shop"  # a few pages elsewhere


def test_words_cells_and_short_blocks_of_an_article_stay(spark):
    """What many pages of a host share inside sentences, tables and lists is no template; a box of it is."""
    page = lambda i, wrap: (f"<body>{wrap[0]}<p>Entry {i}: smoking is <em>not</em> allowed, value <b>0</b> there.</p><p>Yes</p><p>See the rules {i}</p><ul><li>one</li>"  # noqa: E731
                            f"<li>own {i}</li></ul><table><tr><td>same cell of all</td><td>{i}</td></tr></table><p>The same line everywhere</p>"
                            f"<div>Read more <a href=/x>of us</a></div>{wrap[1]}<section>About this shop</section></body>")
    text = "Entry {0}: smoking is not allowed, value 0 there.\nYes\nSee the rules {0}\none\nown {0}\nsame cell of all {0}"
    for wrap, more in ((("<article>", "</article>"), "\nThe same line everywhere"), (("<div>", "</div>"), "")):
        rows = [(i, f"http://a.example/{i}", page(i, wrap), "", "") for i in range(8)]
        got = {r.page_id: r.text for r in ht.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got == {i: text.format(i) + more for i in range(8)}


def brute_templates(pages):
    """Place -> template hashes, by dictionaries over all pages."""
    held = {}
    for url, page in {(u, p) for _, u, p, *_ in pages if u and p}:
        rest = url.split("://", 1)[1] if "://" in url else ""
        parts = rest.split("/")
        places = [parts[0].lower()] + ([f"{parts[0].lower()}/{parts[1]}"] if len(parts) > 2 and parts[1] else []) if rest else []
        for place in places:
            held.setdefault(place, {}).setdefault(page, set(ht.hash_subtrees(ht.parse(page))))
    out = {}
    for place, distinct in held.items():
        every = [h for own in distinct.values() for h in own]
        chosen = {h for h in set(every) if every.count(h) >= ht.TEMPLATE_PAGES and every.count(h) >= ht.TEMPLATE_SHARE * len(distinct)}
        if chosen:
            out[place] = chosen
    return out


def test_templates_and_text_against_a_plain_count(spark):
    import random
    draw = random.Random(3)
    boxes = [f"<div class=x>Box {k} of <a href=/>links</a> here</div>" for k in range(4)] + ["<p>All rights are reserved</p>", "<b>bold</b>"]
    rows = []
    for i in range(120):
        host = draw.choice(["a.example", "b.example", "c.example"])
        own = "".join(draw.choice(boxes) for _ in range(draw.randint(0, 3)))
        rows.append((i, f"http://{host}/{draw.choice(['news', 'shop'])}/{i}", f"<body>{own}<article><p>Page {draw.randint(0, 90)}.</p>{draw.choice(boxes)}</article>", "", ""))
    frame = spark.createDataFrame(rows, SCHEMA)
    truth = brute_templates(rows)
    assert {r.place: set(r.templates) for r in ht.site_templates(frame).collect()} == truth and truth
    for r in ht.extract_text(frame).collect():
        host, folder = r.url.split("/")[2:4]
        known = list(truth.get(host, set()) | truth.get(f"{host}/{folder}", set()))
        assert r.text == ht.main_text(rows[r.page_id][2], known)
