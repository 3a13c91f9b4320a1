import pytest

from kinmatch.llm.htmlmain import extract_main_text, host_of, main_text, site_templates, template_hashes

PAGES = "page_id bigint, url string, html string"


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("just   text\n here", "just text here"),
    ("<p>a<p>b &amp;amp; &lt;c&gt;<br>d</p>e", "a\nb &amp; <c>\nd\ne"),
    ("<body><nav>menu</nav><article><h1>T</h1><p>x <b>y</b>z</p></article><footer>f</footer></body>", "T\nx yz"),
    ("<header>site</header><article><header><h1>T</h1></header>b<footer>f</footer></article>", "T\nb"),
    ("<article>a<script>var t='</p>';</script><style>p{}</style><!-- c --><form>f<input></form>b</article>", "a\nb"),
    ("<article><p>a</p><div class='ad'>buy</div><div id=comments><p>me too</p></div><aside>s</aside></article>", "a"),
    ("<div class='with-sidebar'><article>a</article><div class='site-notice'>n</div></div>", "a"),
    ("<article>a</article><section class=comments><article class='comment'>c</article></section>", "a"),
    ("<article><ul><li>1<li>2</ul><table><tr><td>x<td>y</table></article>", "1\n2\nx y"),
    ("<ARTICLE>A&nbsp; B</ARTICLE>", "A B"), ("<article>unclosed <i>text", "unclosed text"), ("a < b > c", "a < b > c"),
    ("<article hidden>h</article><main>m</main>", "m"), ("<p title='a>b'>x</p><p title=\"open>y", "x\ny"),
    ("<![CDATA[kept]]> &#233;&#x41;", "kept éA"), ("</div></p>x", "x"), ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
])
def test_main_text(page, text):
    assert main_text(page) == text


def test_recurring_subtrees_go_only_where_they_recur():
    block = "<div><p>Subscribe to this site.</p></div>"
    page = f"<body>{block}<p>Own text.</p></body>"
    known = set(template_hashes(f"<body>{block}<p>Other.</p></body>").view("uint64").tolist())
    assert main_text(page, known) == "Own text." and main_text(page) == "Subscribe to this site.\nOwn text."
    inside = f"<article>{block}<p>Own text.</p></article>"
    assert main_text(inside, known) == "Subscribe to this site.\nOwn text."


def test_templates_decide_on_pages_with_an_article():
    share = "<div>Tell your friends</div>"
    offer = "<section><p>Our offers</p></section>"

    def page(own):
        return f"<main>{offer}<article><h1>News</h1>{share}<p>{own}</p><ul><li><p>As ever.</p></ul></article></main>"

    known = set(template_hashes(page("a")).view("uint64").tolist()) & set(template_hashes(page("b")).view("uint64").tolist())
    assert main_text(page("a")) == "Our offers\nNews\nTell your friends\na\nAs ever."
    assert main_text(page("a"), known) == "News\na\nAs ever."


def test_hosts():
    assert [host_of(u) for u in ("https://www.A.com:80/x", "http://b.org", None, "no url", "http://[bad")] == [
        "a.com", "b.org", "", "", ""
    ]


def pages(spark):
    rows = []
    for i in range(40):
        host = "hot.com" if i < 30 else f"h{i}.com"
        page = f"<body><div>Welcome to the site</div><div><p>Story {i}</p></div><div>Read on</div></body>"
        rows.append((i, f"http://{host}/{i}", page))
    rows += [(40, None, None), (41, "http://hot.com/0", ""), (0, "http://hot.com/0", rows[0][2]), (None, "x", "<p>z")]
    return spark.createDataFrame(rows, PAGES).repartition(4)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_templates_of_a_host(spark, limit):
    df = pages(spark).selectExpr("*", "'old' AS text", "'x' AS host", "'y' AS hashes")
    out = extract_main_text(df, broadcast_limit=limit)
    assert sorted(out.columns) == sorted(df.columns)
    rows = sorted(((r["page_id"], r["text"]) for r in out.collect() if r["page_id"] is not None))
    assert len(rows) == 43 and rows[:3] == [(0, "Story 0"), (0, "Story 0"), (1, "Story 1")]
    assert rows[32] == (31, "Welcome to the site\nStory 31\nRead on") and rows[-2:] == [(40, ""), (41, "")]


def test_pages_count_once_and_host_shares_matter(spark):
    found = site_templates(pages(spark)).collect()
    assert {r["host"] for r in found} == {"hot.com"} and {r["pages"] for r in found} == {31}
    assert site_templates(pages(spark), min_share=1.01).count() == 0


def test_recurrence_is_a_number_of_distinct_pages(spark):
    # a hot host of 20 sections, each with a template on a twentieth of the pages; a small host; copies of one page
    rows = [(i, f"http://hot.com/{i}", f"<div>Section {i % 20}</div><p>Story {i}</p>") for i in range(400)]
    rows += [(1000 + i, f"http://small.com/{i}", f"<div>Small site</div><p>Tale {i}</p>") for i in range(4)]
    rows += [(2000 + i, f"http://copies.com/{i}", "<div>All of it</div><p>once more</p>") for i in range(30)]
    out = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, PAGES).repartition(4)).collect()}
    assert [out[i] for i in range(400)] == [f"Story {i}" for i in range(400)]
    assert [out[1000 + i] for i in range(4)] == [f"Tale {i}" for i in range(4)]
    assert {out[2000 + i] for i in range(30)} == {"All of it\nonce more"}


def test_no_pages(spark):
    assert extract_main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_query_against_the_articles(spark, sf):
    import html
    import re

    from kinmatch.llm.queries import QUERIES

    out = {r["page_id"]: r for r in QUERIES["op5_html"](spark, sf).collect()}
    for p in spark.read.parquet(f"{sf}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", p["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert (out[p["page_id"]]["text"], out[p["page_id"]]["n_chars"]) == (want, len(want))
