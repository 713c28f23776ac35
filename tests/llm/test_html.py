"""Main text of pages: the given table, templates, broken markup, the consensus."""

import html
import re
import time
import tracemalloc

import pytest

from tests.conftest import SF_SMALL
from vitals.llm import html_text as h

ARTICLE = "<p>A first paragraph, with words and a stop.</p><p>Second &eacute;&#8217;s paragraph, with <b>bo</b>ld words.</p>"
WANT = "A first paragraph, with words and a stop. Second é’s paragraph, with bold words."
NOISE = [
    "<nav><ul><li><a href=/>Home</a><li>Menu</ul></nav>", "<header>Site</header>", "<div class='cookie-notice'>We use cookies.</div>",
    "<div id=sidebar-2>Side, with a long text, many words, and stops. And more. And more.</div>", "<form>Name <input></form>",
    "<script>var t='<p>no</p>';</script><style>p{}</style>", "<!-- <p>no</p> -->", "<div class=ad>Buy now, cheap, very cheap. Now.</div>",
    "<section id=comments><p>Nice, a long comment, with more words than the article has. Really. Yes, really. So many.</p></section>",
    "<aside>Related</aside>", "<footer>&copy; x</footer>", "<div role=navigation>go</div>", "<div hidden>no</div>", "<div style='display: none'>no</div>",
]


def test_given_pages(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = h.op3_main_text(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search("<article>(.*)</article>", pages[r["page_id"]]["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", inner)]
        assert r["text"] == " ".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])
        assert r["url"] == pages[r["page_id"]]["url"]


@pytest.mark.parametrize("noise", NOISE)
@pytest.mark.parametrize("frame", ["<main>{}</main>", "<div class=post-body>{}</div>", "<article><div class=entry>{}</div></article>", "{}"])
def test_noise_goes_and_the_article_stays(noise, frame):
    for body in (noise + frame.format(ARTICLE), frame.format(ARTICLE) + noise, frame.format(ARTICLE + noise)):
        assert h.extract(f"<html><head><title>t</title><body>{body}</body></html>", []) == WANT


@pytest.mark.parametrize(
    "broken, want",
    [
        ("", ""), ("plain text", "plain text"), ("<p>a", "a"), ("<div", ""), ("<script>x", ""), ("<!-- x", ""), ("x &amp y &am", "x & y &am"),
        ('<p title="a>b">c</p>', "c"), ("a\n\t b<br>c", "a b c"), ("<ul><li>a<li>b</ul>", "a b"), ("<p>a<p>b</div>c", "a b c"),
        ("<b>a</b><i>b</i> c", "ab c"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<![CDATA[a<b]]>", "a<b"), ("1 < 2", "1 < 2"),
    ],
)
def test_broken_markup(broken, want):
    assert h.extract(broken, []) == want


def test_consensus_decides_for_a_page_that_errs(spark):
    page = "<body><div class='story-{i}'><p>{story}</p></div><div class=chat><p>{chat}</p></div></body>"
    rows = [(i, "http://h.example/x", page.format(i=i, story="Words, and words. " * 9, chat="hm")) for i in range(9)]
    rows.append((9, "http://h.example/y", page.format(i=9, story="Short.", chat="Long, long talk. " * 9)))
    rows.append((10, "http://other.example/y", page.format(i=9, story="Short.", chat="Long, long talk. " * 9)))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in h.main_text(pages, share=0.2).collect()}
    assert got[9] == "Short." and got[10].startswith("Long, long") and got[0].startswith("Words, and")


def test_hosts(spark):
    urls = ["http://U:p@Www.X.example:80/a?b", "https://x.example", "no url", None, "//x/y"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(h.host_of(h.F.col("u"))).collect()]
    assert got == ["www.x.example", "x.example", "", "", ""]


def test_odd_rows(spark):
    schema = "page_id bigint, url string, html string, host string, paths string, text string"
    rows = [(1, None, None, "h", "p", "t"), (None, "x", "<p>a</p>", "h", "p", "t"), (2, "http://a/", "", "h", "p", "t"), (2, "http://a/", "", "h", "p", "t")]
    rows.append((3, "http://a/", "<div>" * 500 + "<p>deep" + " word" * 50_000, "h", "p", "t"))
    got = h.main_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["page_id"] or 0, len(r["text"])) for r in got) == [(0, 1), (1, 0), (2, 0), (2, 0), (3, 250_004)]
    assert h.main_text(spark.createDataFrame([], schema)).count() == 0


STORY = "".join(f"<p>Paragraph {i} of the story, with words, and more words.</p>" for i in range(9))
TOLD = " ".join(f"Paragraph {i} of the story, with words, and more words." for i in range(9))


@pytest.mark.parametrize(
    "body",
    [
        "<div class=top>Blog</div><article class='post-7 hentry category-advertising tag-social category-search'>{}</article>",
        "<div class=top>Blog</div><div class='hentry category-advertising'>{}</div>",
        "<div class='elementor'><div class='elementor-widget elementor-widget-nav-menu'>Our menu, long, and longer.</div>"
        "<div class='elementor-widget elementor-widget-text-editor'>{}</div></div>",
        "<div class=content-sidebar><div id=sidebar>Side, with words.</div><div class=entry>{}</div></div>",
        "<div class=right-sidebar><div class='elementor-widget'>{}</div><div id=comments>I like it, I really do. Yes.</div></div>",
        "<div class=top>Shop</div><form method=post action=x.aspx id=aspnetForm><div class=cookie-bar>We use cookies.</div><div id=c>{}</div></form>",
        "<article class='post category-social'>{}<article class=user-comment>So nice, so good.</article></article>",
    ],
)
def test_names_that_sound_like_boilerplate_do_not_lose_the_article(body):
    assert h.extract(f"<html><body>{body.format(STORY)}</body></html>", []) == TOLD


def test_long_comments_and_notices_do_not_replace_a_short_article():
    for name in ("comments", "cookie-notice", "user-replies"):
        assert h.extract(f"<body><div class=post>{ARTICLE}</div><form><div id={name}>{STORY * 9}</div></form></body>", []) == WANT


def test_a_page_keeps_the_winner_it_voted_for(spark):
    plain, boxed = "<body><div>{}</div></body>", "<body><div>Some box.</div><article>{}</article></body>"
    rows = [(i, "http://h.example/x", (plain if i < 7 else boxed).format(STORY)) for i in range(10)]
    # has both winners and votes for neither: the one with more text on the page
    rows.append((10, "http://h.example/y", f"<body><div>Some box.</div><article>Short, but more, and told.</article><section>{STORY}</section></body>"))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in h.main_text(pages).collect()}
    assert got.pop(10) == "Short, but more, and told."
    assert set(got.values()) == {TOLD}


def test_pages_without_a_host_do_not_vote_together(spark):
    rows = [(i, None, f"<body><div><p>{STORY}</p></div></body>") for i in range(7)]
    rows.append((7, "/relative", f"<body><div>Some box.</div><section>{STORY}</section></body>"))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r["text"] for r in h.main_text(pages).collect()} == {TOLD}
    assert h.winning_paths(pages).count() == 0


@pytest.mark.parametrize(
    "body, want",
    [
        ("<div class=post><h1>Title</h1><p>The lead</p><div class=body>{}</div></div>", "Title The lead " + TOLD),
        ("<div class=post><header><h1>Title</h1></header><div class=lead>The lead is told in its own box.</div><div>{}</div></div>",
         "Title The lead is told in its own box. " + TOLD),
        ("<div class=post><h1>Title</h1><div class=wrap><div class=body>{}</div></div></div>", "Title " + TOLD),
        ("<div class=left><div class=in>{0}{0}</div></div><div class=right><div class=in>{0}</div></div>", " ".join([TOLD] * 3)),
        ("<div class=post><div class=a><div>{0}{0}</div></div><div class=b><div>{0}</div></div></div><div class=x>x</div>", " ".join([TOLD] * 3)),
        ("<div class=top>Blog</div><div class=post><div>{}</div></div><div class=links><a>One, two.</a> <a>Three.</a></div>", TOLD),
    ],
)
@pytest.mark.parametrize("frame", ["<html><body>{}</body></html>", "<title>t</title>{}"])
def test_titles_leads_and_columns_stay(body, want, frame):
    page = frame.format(body.format(STORY))
    assert h.extract(page, []) == want
    assert h.extract(page, [h.vote(page)]) == want


def test_a_winning_body_keeps_each_page_s_title(spark):
    page = "<body><div class=post><h1>Title {0}</h1><p>Lead {0}</p><div class=body>{1}</div></div></body>"
    pages = spark.createDataFrame([(i, "http://h.example/x", page.format(i, STORY)) for i in range(5)], "page_id bigint, url string, html string")
    assert {r["page_id"]: r["text"] for r in h.main_text(pages).collect()} == {i: f"Title {i} Lead {i} {TOLD}" for i in range(5)}


def test_nested_inline_adverts_end_with_their_own_tag():
    lead = "The council met on Monday evening and agreed to a new plan for the old harbour."
    page = f'<body><article><p>{lead} <span class="ad"><span>Buy</span> our cheap shoes now</span> It starts in May.</p><p>{lead}</p></article></body>'
    assert h.extract(page, []) == f"{lead} It starts in May. {lead}"
    unclosed = f'<body><article><p>{lead} <span class="ad">Buy shoes</p><p>{lead}</p><p>One <span class="ad"/>more.</p></article></body>'
    assert h.extract(unclosed, []) == f"{lead} {lead} One more."


def test_forms_of_one_path_are_alike():
    line = "This is paragraph number %d of the one long article that the page is about, as you see."
    forms = "".join(f"<form><p>{line % k}</p></form>" for k in range(5))
    page = f"<body><div>{forms}</div><form class='find'><label>Find</label> <b>here</b></form></body>"
    assert h.extract(page, []) == " ".join(line % k for k in range(5))


def test_deep_and_unclosed_pages_take_linear_time_and_memory():
    text = "A sentence that is long enough to count, on a page nobody closed."
    pages = ["<div>" * 100_000 + text, "<span class=ad>x" * 60_000, "<body><div>" + "<span class=ad>x</div><div>" * 40_000 + text, "</ul><li>" * 100_000 + text, "<div>" * 50_000 + "<li></p>" * 50_000 + text]
    for page in pages:
        began = time.perf_counter()
        path = h.vote(page)
        found = h.extract(page, [path] if path else [])
        assert time.perf_counter() - began < 6  # both passes
        assert text in found or text not in page
    tracemalloc.start()  # slows everything down, so not while time is measured
    h.vote("<div>" * 30_000 + text)
    assert tracemalloc.get_traced_memory()[1] < 90 << 20
    tracemalloc.stop()
