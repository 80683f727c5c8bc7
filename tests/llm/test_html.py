import html
import re
import tracemalloc

from triagelake.llm.html import Page, main_text, op5_style_tree, path_of, style_tree

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> -->
<div class="page with-sidebar"><div class="ad">Buy</div><article><h1>Head &lt;line&gt;</h1><p><b>One   two&nbsp;three<br>four<p>Fi<i>v</i>e &amp; six
<div class="share">Share me</div><aside>Side</aside><p title="a > b" data-x='"'>a < b</p><form><p>Name</p></form>
<section class="comments"><p>First!</p></section><blockquote>Last</blockquote></article>
<div id="sidebar"><p>Side</p></div></div><footer>&copy; us</footer></body></html>"""


def test_page():
    assert Page(PAGE).text() == "Head <line>\nOne two three four\nFive & six\na < b\nLast"
    for empty in (None, "", " \n", "<", "<p", "<!-- open", "<script>x", "<nav>menu</nav>", "<article></article>"):
        assert Page(empty).text() == ("<" if empty == "<" else "<p" if empty == "<p" else ""), empty
    assert Page("plain &eacute; text").text() == "plain é text"
    assert Page("<div><a>Menu</a> <a>Two</a></div><div>Body <a>link</a></div>").text() == "Body link"
    assert Page("<div class=comments><article><p>only</p></article></div>").text() == "only"
    assert Page("<article><p>own</p></article><div class=comments><article><p>reader</p></article></div>").text() == "own"
    assert Page("<article>" + "<b>" * 3000 + "deep").text() == "deep"
    assert Page("<p " + "'\"" * 20000).text().startswith("<p")
    long_text = "word " * 60_000
    assert Page(f"<main><p>{long_text}</main>").text() == long_text.strip()


def test_site_style_tree(spark):
    def page(i, extra=""):
        return (f"<body><div class='top'><p>Welcome to the site</p></div><div class='x'><p>Story {i} begins</p>"
                f"<p>Shared passage</p></div><div class='top2'>Visitors: 7 {extra}</div></body>")

    rows = [(i, "http://a.org/x", page(i), "mine") for i in range(12)]
    rows += [(100 + i, "http://copies.org/x", page(0), "mine") for i in range(12)]  # one distinct page
    rows += [(200, None, None, "mine"), (201, "http://one.net/", page(1), None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    tree = {(r.host, r.path): r.importance for r in style_tree(pages.drop("host").withColumn(
        "host", __import__("pyspark").sql.functions.regexp_extract("url", "://([^/]*)", 1))).collect()}
    assert tree["a.org", path_of("body", "div.top#")] == 0 and tree["a.org", path_of("body", "div.x#")] == 1
    assert not any(h == "copies.org" for h, _ in tree)
    got = {r.page_id: r for r in main_text(pages).collect()}
    assert got[3].text == "Story 3 begins\nShared passage" and got[3].n_chars == 29 and got[3].host == "mine"
    everything = "Welcome to the site\nStory 0 begins\nShared passage\nVisitors: 7"
    assert got[105].text == everything and got[201].text == everything.replace("0", "1")
    assert got[200].text == "" and got[200].n_chars == 0
    assert len(got) == len(rows) and main_text(pages.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = op5_style_tree(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_a_part_of_a_name_does_not_drop_the_text():
    story = "<h2>Head</h2><p>" + "Some long story. " * 9 + "</p>"
    want = "Head\n" + ("Some long story. " * 9).strip()
    for name in ("content no-sidebar", "has-comments", "form-page", "x_menu"):
        assert Page(f"<body><div class='{name}'>{story}</div></body>").text() == want, name
        inner = f"<div id='{name}'>{story}<div class='ad-slot'>Buy</div><ul class='share-list'><li>Share</ul></div>"
        assert Page(f"<body><div class='left-sidebar'>Side</div>{inner}<div class='ad'>{story * 9}</div></body>").text() == want, name
    inside = "<article><h1 class='article-header'>One</h1><p class='notice-text'>Two</p><div class='ad-box'>Buy</div><p>" + "x " * 9 + "</p></article>"
    assert Page(inside).text() == "One\nTwo\n" + ("x " * 9).strip()
    assert Page("<div class='sidebar'>Side</div><p class='notice'>no</p><p>text</p>").text() == "text"


def test_weak_names_keep_what_holds_the_text():
    story = "<p>" + "Some long story. " * 15 + "</p>"
    want = ("Some long story. " * 15).strip()
    for name in ("id='promotion'", "class='widget'", "class='box alert'"):
        assert Page(f"<body><div {name}>{story}</div><div class='widget'>Weather</div></body>").text() == want, name
        passage = f"<article><p>Start</p>{story}<div {name}><p>{'more of it ' * 12}</p></div><div class='widget'>Weather</div></article>"
        assert Page(passage).text() == f"Start\n{want}\n{('more of it ' * 12).strip()}", name
    assert Page(f"<body><p>Own text</p><div class='comments'>{story}</div></body>").text() == "Own text"


def test_the_tree_decides_on_names(spark):
    def page(i):  # page 0 has little of its own in the widget, page 1 has a promotion longer than its story
        story = "".join(f"<p>Line {i} {j} of the story goes on and on</p>" for j in range(1 if i < 2 else 20))
        deal = f"Deal {i} " * (40 if i == 1 else 1)
        return (f"<body><div class='widget'>{story}</div><div class='promo'>{deal}</div>"
                f"<div class='box'>{'The same words stand on all pages. ' * 3}</div></body>")

    rows = [(i, "http://a.org/x", page(i)) for i in range(12)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert "story" not in Page(page(0)).text() and "Deal" in Page(page(1)).text()  # without the tree
    for i in got:
        assert got[i].split("\n") == [f"Line {i} {j} of the story goes on and on" for j in range(1 if i < 2 else 20)]


def test_deep_pages_take_linear_memory():
    source = "<div class='a'>x" * 50_000
    tracemalloc.start()
    tree = Page(source, tree=True)
    text = Page(source).text()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(tree.seen) == 50_000 and text == "\n".join("x" * 50_000) and peak < 100 << 20
