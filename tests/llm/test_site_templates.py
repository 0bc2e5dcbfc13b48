import pytest

from retentide.llm.site_templates import extract_pages, host_of, main_text, parse, template_candidates
from pyspark.sql import functions as F

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";x<y</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Title &amp; more</h1><p>First &lt;b&gt;  para<br>graph&nbsp;here<p>Second <b>bold <a href='x>y'>link</a></b> end.
<form><input value="no"><button>Send</button></form><div class="ad">Buy</div><ul><li>one<li>two</ul>
<script>document.write("<p>no</p>")</script><!-- <p>no</p> --><table><tr><td>a<td>b</table><section id="comments"><p>I disagree</p></section></article>
<aside>More</aside><footer>&copy; me</footer></body></html>"""
TEXT = "Title & more\nFirst <b> para graph here\nSecond bold link end.\none\ntwo\na\nb"


def test_main_text_of_one_page():
    assert main_text(PAGE, set()) == TEXT


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("plain text", "plain text"),
        ("a < b & c", "a < b & c"),
        ("<article><p><b>x<br><p>y</article>", "x\ny"),
        ("<main><article>a</article><article class='related'>b</article></main>", "a"),
        ("<article>a<!-- never closed", "a"),
        ("<article>a<script>b", "a"),
        ("<ARTICLE ID=x>A</ARTICLE><div>b</div>", "A"),
        ("<div role='main'>a</div><p>b</p>", "a"),
        ("<article data-id='ad'><p title='class=ad'>kept</p></article>", "kept"),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
        ("<article>it&#39;s &eacute; &unknown; &#x41;</article>", "it's é &unknown; A"),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page, set()) == text
    template_candidates(page)


def test_templates_are_counted_by_host(spark):
    boiler = "<div><span>Our great site</span></div>"
    rows = [(i, f"http://a.example/{i}", f"{boiler}<div><p>Story number {i}</p></div>") for i in range(10)]
    rows += [(100 + i, f"http://b{i}.example/", f"{boiler}<p>Other {i}</p>") for i in range(5)]
    # inside an article what comes back is kept, unless it is a list of links
    links = "<div><a href=/1>One</a> <a href=/2>Two</a></div>"
    rows += [(200 + i, "http://c.example/", f"<article><p>Same line</p>{links}<p>Own {i}</p></article>") for i in range(5)]
    got = {r["page_id"]: r["text"] for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got[3] == "Story number 3"
    assert got[101] == "Our great site\nOther 1"
    assert got[202] == "Same line\nOwn 2"


def test_edge_cases(spark):
    rows = [(1, None, PAGE), (1, None, PAGE), (None, "http://x.example", None), (2, "http://x.example", ""), (3, "bad", "<article>" + "word " * 200000 + "</article>")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, host long")
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in extract_pages(df).collect()), key=str)
    long = ("word " * 200000).strip()
    assert got == sorted([(1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (None, "", 0), (2, "", 0), (3, long, len(long))], key=str)
    assert extract_pages(df.limit(0)).collect() == []


def test_host(spark):
    urls = [("https://User@Example.COM:80/x?y", "example.com"), ("nothing", ""), (None, "")]
    assert [r[0] for r in spark.createDataFrame([(u,) for u, _ in urls], "u string").select(host_of(F.col("u"))).collect()] == [h for _, h in urls]
    assert parse("<p>").children[0].tag == "p"


def test_copies_of_a_page_have_one_vote(spark):
    boiler = "<div><span>Our great site</span></div>"
    story = f"<script>t={{}}</script>{boiler}<div><p>A story</p><p>in two paragraphs</p></div>"
    rows = [(i, f"http://a.example/{i}", story.format(i)) for i in range(6)]
    rows += [(100 + i, f"http://a.example/other{i}", f"{boiler}<div><p>Story number {i}</p></div>") for i in range(10)]
    # a host of nothing but copies has no template
    rows += [(200, "http://b.example/", story)] * 5
    got = {r["page_id"]: r["text"] for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert {got[i] for i in range(6)} == {"A story\nin two paragraphs"}
    assert got[103] == "Story number 3"
    assert got[200] == "Our great site\nA story\nin two paragraphs"


def test_counted_containers_go_inside_articles(spark):
    """What only the count can tell: unmarked notices, bylines and link lists inside articles, none of them marked by tag or class."""
    notice, byline = "<div><b>Read us</b> every week, by mail</div>", "<section>The editors of Example wrote this</section>"
    links = "<ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul>"
    story = lambda k: " ".join(f"word{k}x{j}" for j in range(60))
    rows = [(i, f"http://a.example/{i}", f"<article><h1>Title {i}</h1>{byline}<p>Same line</p><p>{story(i)}</p>{notice}{links}</article>") for i in range(12)]
    # too few pages to say so
    rows += [(100 + i, "http://b.example/", f"<article>{notice}<p>{story(i)}</p></article>") for i in range(4)]
    # near copies of one article: its body comes back, but is the article
    rows += [(200 + i, "http://c.example/", f"<article><h1>Copy {i}</h1><div><p>{story(7)}</p></div></article>") for i in range(8)]
    got = {r["page_id"]: r["text"] for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert all(got[i] == f"Title {i}\nSame line\n{story(i)}" for i in range(12))
    assert got[101] == f"Read us every week, by mail\n{story(1)}"
    assert got[203] == f"Copy 3\n{story(7)}"


def test_unmatched_end_tags_take_linear_time():
    import time

    page = "<article>" + "<div>" * 20_000 + "</b></td></span>" * 20_000 + "deep</article>"
    began = time.time()
    assert main_text(page, set()) == "deep" and time.time() - began < 5


def brute(pages):
    """Whole texts by the definition, one page and host at a time, for pages of articles only."""
    from collections import Counter

    from retentide.llm import site_templates as st

    votes, sizes = {}, {}
    for _, url, page in pages:
        content, found = template_candidates(page)
        votes.setdefault(url.split("/")[2], {})[content] = found
    out = {}
    for host, own in votes.items():
        sizes[host] = len(own)
        n = Counter(x for found in own.values() for x in found)
        out[host] = {x for x, k in n.items() if (k >= 5 and k >= 0.2 * len(own) if x & 1 else k >= 3 and k >= 0.05 * len(own))}
    return {i: st.main_text(page, out[url.split("/")[2]]) for i, url, page in pages}


def test_counts_equal_brute_force(spark):
    import random

    draw = random.Random(6)
    parts = [f"<div>{'abc'[k % 3]} block {k}</div>" for k in range(6)] + [f"<ul><li><a href=/{k}>to {k}</a></ul>" for k in range(4)] + ["<p>same</p>", "<section><p>x</p></section>"]
    rows = []
    for i in range(120):
        body = "".join(draw.choices(parts, k=draw.randrange(4))) + f"<p>{'own text ' * draw.randrange(1, 9)}{i}</p>" + "".join(draw.choices(parts, k=2))
        rows.append((i, f"http://h{draw.randrange(4)}.example/{i}", f"<article>{body}</article>" if draw.random() < 0.6 else body))
    got = {r["page_id"]: r["text"] for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    want = brute(rows)
    assert got == want and any(got[i] != main_text(page, set()) for i, _, page in rows)
