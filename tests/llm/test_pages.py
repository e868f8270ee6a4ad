from pyspark.sql import functions as F

from citelake.llm.pages import blocks_of, boilerplate_paths, extract_text, host_of, main_text, path_hash
from tests.llm.tables import SF, given

PAGES = "page_id long, url string, html string"


def text(html):
    return main_text(blocks_of(html), set())


def test_markup():
    assert text(None) == text("") == text("<html><head><title>t</title></head><body></body></html>") == ""
    assert text("plain  words &amp; more\n here") == "plain words & more here"
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
      <header>Site</header><nav><ul><li><a href="x>y">Home</a><li>About</ul></nav>
      <div class="sidebar">aside</div><div id="cookie-notice">We use cookies</div>
      <article><header><h1>Head &lt;1&gt;</h1></header><p>One <b>bold</b>
        text<br>next<p>Two&nbsp;words <script>var t = "</p><p>no";</script>end
        <form><label>Mail</label><input></form><div class="ad">Buy</div>
        <section class="comments"><p>First!</p></section></article>
      <div>outside</div><footer>&copy; me</footer></body></html>"""
    assert text(page) == "Head <1>\nOne bold text next\nTwo words end"
    assert text("<div>a<!-- x -- > y --><div>b</div>c</div></p></div>d") == "a\nb\nc\nd"
    assert text("<p>a < b & c<p>d</table>e") == "a < b & c\nd\ne"
    assert text("<table><tr><td>1<td>2<tr><td>3</table>") == "1\n2\n3"
    assert text("<div role=navigation>x</div><main><p>y</main>z") == "y"
    assert text("<p title='a>b' class=\"x\">q</p><p") == "q"
    assert text("<script>never closed <p>x") == ""


def test_wrappers_and_whole_names():
    """Names match as whole words; what stands around an article does not empty it."""
    body = "<article><p>Kept text.</p></article>"
    for page in (
        f'<div class="layout has-sidebar">{body}</div>', f'<div id="search-results-page">{body}</div>',
        f'<form id="aspnetForm">{body}</form>', f"<search>{body}</search>", f'<div><form action="x"><div>{body}</div></form></div>',
        '<article class="no-comments"><p>Kept text.</p></article>', '<main class="with-menu"><p>Kept text.</p></main>',
    ):
        assert text(page) == "Kept text.", page
    assert text('<article><p class="notice-board">One.</p><p>Two.</p></article>') == "One.\nTwo."
    assert text("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</p></article>") == "Let x=2 hold."
    # Chrome proper stays chrome, whatever it holds.
    assert text(f'{body}<section class="comments"><article><p>First!</p></article></section>') == "Kept text."
    assert text(f'{body}<aside><article><p>Other.</p></article></aside><form>Mail</form>') == "Kept text."
    assert text('<article><p>Kept.</p><form><article>Reply</article></form><div class="ad slot">Buy</div></article>') == "Kept."
    assert text(f'<form class="search-form">{body}</form>') == ""


def test_pages_that_share_their_main_paragraph(spark):
    """Without an article element: the paragraph is most of each page, so it stays on both."""
    main = " ".join(f"word{i}" for i in range(60))
    frame = "<div>Welcome to the example site with all its offers</div>"
    rows = [
        (1, "http://h.org/1", f"<body>{frame}<p>{main}</p></body>"),
        (2, "http://h.org/2", f"<body>{frame}<p>{main}</p><p>And some more words that only this page has.</p></body>"),
    ]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {1: main, 2: f"{main}\nAnd some more words that only this page has."}


def test_given_table(spark):
    """The article between its tags, by plain string work."""
    import html
    import re

    got = {r.page_id: (r.url, r.text, r.n_chars) for r in extract_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    for page in given("pages"):
        inside = page["html"].split("<article>")[1].split("</article>")[0]
        lines = [re.sub("<[^>]*>", "", b) for b in re.split("</?(?:p|h1)>", inside)]
        lines = [" ".join(html.unescape(b).split()) for b in lines]
        want = "\n".join(b for b in lines if b)
        assert got[page["page_id"]] == (page["url"], want, len(want))


def hosted(n, articles=False):
    """Pages without article elements, whose frame has no telling names."""
    rows = []
    for i in range(n):
        frame = "<div class='x1'>Welcome to the example site with all its offers</div>"
        foot = "<div class='x9'>Written by the people of this site for you all</div>"
        body = f"<div class='c'><p>{' '.join(f'w{i}x{k}' for k in range(20))}</p></div>"
        rows.append((i, f"http://h{i % 2}.org/{i}", f"<body>{frame}{body}{foot}</body>"))
    return rows


def test_repeated_runs_of_a_host_go(spark):
    rows = hosted(40)
    df = spark.createDataFrame(rows, PAGES)
    got = extract_text(df).collect()
    assert all(r.text == " ".join(f"w{r.page_id}x{k}" for k in range(20)) for r in got) and len(got) == 40
    paths = {p for r in boilerplate_paths(df).collect() for p in r.paths}
    assert paths == {path_hash("body>div.x1"), path_hash("body>div.x9")}


def test_copies_are_one_page(spark):
    """Equal pages are no evidence: their text stays."""
    rows = [(i, "http://h.org/", hosted(1)[0][2]) for i in range(60)]
    got = extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert all("Welcome" in r.text and "w0x3" in r.text for r in got)


def test_odd_rows(spark):
    long = "<article>" + "<p>word</p>" * 30_000 + "</article>"
    rows = [(1, None, None), (2, "x", ""), (3, "http://a", "<nav>x</nav>"), (None, "http://a", "<p>y</p>"), (5, "://B?q", long), (5, "://B?q", long)]
    df = spark.createDataFrame(rows, PAGES).withColumn("path", F.lit(1)).withColumn("text", F.lit("t")).withColumn("host", F.lit(2))
    got = sorted((r.page_id or 0, r.text if len(r.text) < 9 else len(r.text), r.n_chars) for r in extract_text(df).collect())
    assert got == [(0, "y", 1), (1, "", 0), (2, "", 0), (3, "", 0), (5, 149_999, 149_999), (5, 149_999, 149_999)]
    assert extract_text(spark.createDataFrame([], PAGES)).collect() == []


def test_host(spark):
    urls = {None: "", "no scheme/x": "", "http://A.b/c": "a.b", "x://É.ORG#f": "É.org", "a\n://h?x": "h", "p://": "", "http://a://b/": "a:"}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url: r.h for r in df.select("url", host_of(F.col("url")).alias("h")).collect()} == urls


def shared_path(n, host, unique=3):
    """Article and notice in the same kind of element; ``unique`` paragraphs of each page are its own."""
    notice = "<div><p>All of our offers end when the week does</p></div>"
    own = [[" ".join(f"{host}w{i}x{j}x{k}" for k in range(12)) for j in range(unique)] for i in range(n)]
    return [(i, f"http://{host}.org/{i}", f"<body>{notice}{''.join(f'<div><p>{p}</p></div>' for p in own[i])}</body>") for i in range(n)], own


def test_only_covered_blocks_of_a_path_go(spark):
    """The path's share of repeated runs is below and above a half; near copies leave other pages alone."""
    few, own_few = shared_path(20, "few", 3)
    most, own_most = shared_path(20, "most", 0)
    most = [(100 + i, u, h.replace("</body>", f"<div><p>short{i} but all its own words</p></div></body>")) for i, u, h in most]
    near = [(200 + i, "http://few.org/n", f"<body><div><p>{own_few[0][0]}</p></div><div><p>seen {i} times by a reader</p></div></body>") for i in range(30)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(few + most + near, PAGES)).collect()}
    for i in range(1, 20):
        assert got[i] == "\n".join(own_few[i])
        assert got[100 + i] == f"short{i} but all its own words"
    assert got[0] == "\n".join(own_few[0][1:]) and got[205] == "seen 5 times by a reader"


def test_small_hosts_go_by_their_own_pages(spark):
    """Two pages are enough, and other hosts are no evidence."""
    two, own = shared_path(2, "two")
    lone = [(1000 + i, f"http://lone{i}.org/", f"<body><div><p>All of our offers end when the week does</p></div></body>") for i in range(50)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(two + lone, PAGES)).collect()}
    assert [got[i] for i in (0, 1)] == ["\n".join(own[i]) for i in (0, 1)]
    assert all(got[1000 + i] == "All of our offers end when the week does" for i in range(50))


def test_joined_runs_give_the_same_texts(spark):
    rows = shared_path(9, "a")[0] + hosted(12) + [(50, None, None), (51, None, "<p>x</p>")]
    df = spark.createDataFrame(rows + rows[:3], PAGES)
    want = sorted(extract_text(df).collect(), key=str)
    for most in (0, 3, 11):
        assert sorted(extract_text(df, most).collect(), key=str) == want
