import html
import re

from starglean.llm import wrappers

PAGE = (
    "<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><div id='cookie-notice'>We use cookies</div>"
    "<nav><a href=/a>a</a></nav><main><article><header><h1>T &amp; x</h1></header><p>One <b>bo</b>ld<br>two<aside>side</aside>"
    "<p>Three&nbsp;four <span class=share>Share</span>five<script>if(a<b){'</p>'}</script><!-- <p>no</p> --><form><input>go</form>"
    "<section class='comments'><p>me too</p></section></article></main><div class='sidebar'>x</div><footer>f</footer>"
)


def test_blocks_of_one_page():
    found = wrappers.blocks_of(PAGE)
    assert [t for t in wrappers.chosen(found, "article", set())] == ["T & x", "One bold two", "Three four", "five"]
    assert wrappers.blocks_of("") == [] and wrappers.blocks_of("plain  text") == [("", "plain text")]
    assert wrappers.blocks_of("<p>a<p hidden>b<p style='display: none'>c<p>d") == [("p", "a"), ("p", "d")]
    assert [t for _, t in wrappers.blocks_of("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>")] == ["a", "b", "c", "d"]
    assert [t for _, t in wrappers.blocks_of("<div>x &lt;b&gt; &#233; &unknown; < 5</div></p></div>y<script>never closed")] == ["x <b> é &unknown; < 5", "y"]


def test_folding_and_alignment():
    part = lambda place, text: ["t", place, text]
    folded = wrappers.fold([part("h", "x"), part("p", "a"), part("p", "b"), part("p", "a"), part("f", "c")])
    assert wrappers.shape(["+", folded]) == "+(h +(p) f)" and folded[1][1][0][2] is None
    pairs = wrappers.fold([part(x, "1") for x in "dtdtdt"])
    assert wrappers.shape(pairs[0]) == "+(d t)" and len(pairs) == 1
    both = wrappers.merge(wrappers.wrapper_of([("h", "x"), ("p", "a"), ("f", "c")]), wrappers.wrapper_of([("h", "y"), ("p", "a"), ("p", "b"), ("n", "new"), ("f", "c")]))
    assert [p[0] for p in both] == ["t", "+", "?", "t"]
    assert wrappers.places(both) == {"h": None, "p": None, "n": "new", "f": "c"}
    again = wrappers.merge(both, wrappers.wrapper_of([("h", "z"), ("f", "c")]))
    assert [p[0] for p in again] == ["t", "?", "?", "t"]


def test_a_host_without_article_keeps_what_varies(spark):
    page = "<body><div class=top>Our site</div><div class=x>text number {}</div><div class=low>Call us</div></body>"
    rows = [(i, "http://h.com/a", page.format(i)) for i in range(6)] + [(9, None, None), (9, None, ""), (None, "http://h.com/b", page.format(7)), (10, "http://k.com/", PAGE), (10, "http://k.com/", PAGE)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'w' AS wrapper", "1 AS host", "2 AS text", "3 AS blocks")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in wrappers.main_text(pages).collect()), key=repr)
    main = "T & x One bold two Three four five"
    assert got == sorted([*((i, f"text number {i}", 13) for i in range(6)), (9, "", 0), (9, "", 0), (None, "text number 7", 13), (10, main, len(main)), (10, main, len(main))], key=repr)
    assert wrappers.main_text(pages.limit(0)).collect() == []


def test_pages_equal_their_articles(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    rows = wrappers.main_text(pages).collect()
    assert len(rows) == len(source)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        inner = re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", inner))
        assert r.text == " ".join(html.unescape(inner).split()) and r.n_chars == len(r.text)


def test_very_long_page():
    page = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    found = wrappers.blocks_of(page)
    assert len(found) == 20_000 and wrappers.shape(["+", wrappers.wrapper_of(found)]) == "+(+(article>p))"


def test_template_blocks_inside_an_article(spark):
    page = "<body><article><h1>Title {0}</h1><p>Text {0}</p><p>Read more in our shop</p>{1}<p>Often said</p></article></body>"
    rows = [(i, "http://h.com/a", page.format(i, "<p>Rare</p>" if i < 3 else "").replace("<p>Often said</p>", "" if i > 4 else "<p>Often said</p>")) for i in range(12)]
    rows += [(20 + i, "http://copies.com/a", page.format(1, "")) for i in range(12)] + [(40 + i, "http://few.com/a", page.format(i, "")) for i in range(3)]
    rows += [(60 + i, "http://same.com/a", f"<article><p>All the same</p></article><div>{i}</div>") for i in range(12)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[0] == "Title 0 Text 0 Rare Often said" and got[11] == "Title 11 Text 11"
    assert got[20] == "Title 1 Text 1 Read more in our shop Often said" and got[41] == "Title 1 Text 1 Read more in our shop Often said"
    assert got[60] == "All the same"


def test_long_openings_and_large_wrappers_stay_apart(spark):
    opening = "Berlin, this day, from our correspondent abroad: "
    rows = [(i, "http://h.com/a", f"<div class=top>Our site</div><div class=x>{opening}{i}</div>") for i in range(4)]
    many = "".join(f"<div class=k{{0}}v{k}>fill {k}</div><p class=p{k}>here {k} {{1}}</p>" for k in range(450))
    rows += [(10 + i, "http://l.com/a", many.format("a", i) + "<div class=top>Our site</div>") for i in range(3)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [got[i] for i in range(4)] == [f"{opening}{i}" for i in range(4)]
    assert [got[10 + i] for i in range(3)] == [" ".join(f"here {k} {i}" for k in range(450)) for i in range(3)]
    big = [wrappers.wrapper_of([(f"p.{k}", f"{k} {i}") for k in range(450)]) for i in range(2)]
    assert set(wrappers.places(wrappers.absorb(*big)).values()) == {None}
    one, two = (wrappers.wrapper_of([("p", opening + w)]) for w in ("a", "b"))
    assert wrappers.places(wrappers.merge(one, two)) == {"p": None}


def test_marks_of_enclosing_parts_drop_nothing(spark):
    bodies = ["<body class='has-sidebar'><article><p>Text</p></article></body>", "<body class=sidebar><p>Text</p></body>", "<main id='search-results'><p>Text</p></main>",
              "<main class=search><p>Text</p></main>", "<article class='post related'><p>Text</p></article>", "<div class='page-with-nav'><article><p>Text</p></article></div>",
              "<div class=nav><p>before</p><article><p>Text</p></article></div>", "<div class='main-nav'>a b</div><main><p>Text</p></main>",
              "<body class='single-post'><div class='main-nav'><header>a b</header></div><div class='post-body'><p>Text</p></div></body>",
              "<article><p>Text<div class=share>Share</div></article>"]
    rows = [(i, f"http://h{i}.com/a", b) for i, b in enumerate(bodies)] + [(90, "http://x.com/", "<article><p>Text</p><figure><img src=a><figcaption>Caption</figcaption></figure></article>")]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [got[i] for i in range(len(bodies))] == ["Text"] * len(bodies) and got[90] == "Text Caption"


def test_stray_quotes_and_ids_lose_no_text():
    page = "<article><h2 id=search>Head</h2><p class=o'brien>First.</p><section id='discussion'><p>I don't know.</p></section><div class=share>Share</div><p title=\"a > b\">Last.</p></article>"
    assert [t for _, t in wrappers.blocks_of(page)] == ["Head", "First.", "I don't know.", "Last."]
    assert [t for _, t in wrappers.blocks_of("<body><div id=sidebar>Aside</div><p>Text</p></body>")] == ["Text"]


def test_broken_pages_take_linear_time():
    import time

    for broken in ("<a ", "<!", "<? ", "<a b=\"", "<a b='x ", "<!-- "):
        start = time.perf_counter()
        wrappers.blocks_of("<p>text</p>" + broken * 200_000)
        assert time.perf_counter() - start < 5, broken


def test_wrappers_are_aligned_at_any_size():
    for n in (6, 450):
        one, two = (wrappers.wrapper_of([(f"p.{k}", f"{k} {i if k % 2 else 0}") for k in range(n)]) for i in range(2))
        two.insert(3, ["t", "div.new", "new"])
        got = wrappers.absorb(one, two)
        assert [wrappers.core(p) for p in got[:5]] == ["p.0", "p.1", "p.2", "div.new", "p.3"] and got[3] == ["?", [["t", "div.new", "new"]]]
        assert len(got) == n + 1 and got[0] == ["t", "p.0", "0 0"] and got[-1] == ["t", f"p.{n - 1}", None]
    # Two orders of the same parts: none comes twice, those out of order are optional.
    many = [["t", f"p.{k}", None] for k in range(500)]
    assert sorted(map(wrappers.core, wrappers.absorb(many, many[::-1]))) == sorted(map(wrappers.core, many))
    assert wrappers.rising([5, 1, 2, 9, 3]) == [1, 2, 4] and wrappers.rising([]) == []
