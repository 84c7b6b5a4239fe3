"""Main text: a plain reading of the table's pages, and small pages case by case."""

import html
import re

import pytest

from rillhouse.llm import html_extract, queries

ARTICLE = "<h1>Title</h1><p>First &amp; <b>bold</b>\n text<p>Second<br>line &lt;tag&gt;</p>"
WANT = "Title\n\nFirst & bold text\n\nSecond line <tag>"
LONG = "words of an article " * 20

CASES = {
    None: "",
    "": "",
    "   ": "",
    "plain   text\n only": "plain text only",
    "<p>": "",
    f"<article>{ARTICLE}</article>": WANT,
    f"<nav>menu</nav><main><article>{ARTICLE}</article></main><footer>foot</footer>": WANT,
    f"<div class='sidebar'>side</div><div class=post>{ARTICLE}</div>": WANT,
    f"<body><header>site</header><article><header><h1>Title</h1></header>{ARTICLE[14:]}"
    "<section class='comments'><p>reader says</p></section></article></body>": WANT,
    f"<article>{ARTICLE}<form><input><label>Mail</label></form><div id='cookie-notice'>ok?</div>"
    "<script>var x = '<p>no</p>';</script><style>p{}</style></article>": WANT,
    f"<!-- <p>no</p> --><article>{ARTICLE}<!-- ad": WANT,
    "<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>": "one\n\ntwo\n\na\n\nb",
    f"<div><p>{LONG}</p></div><div><a href=x>{LONG}</a></div>": LONG.strip(),
    "<article><p>&copy; &#8364; &#x41; &nbsp; x</p></article>": "© € A x",
    "<article><p title='a > b'>x</p><p a=\"<q>\">y</article>": "x\n\ny",
    "<article><p>" + "long " * 30_000 + "</article>": ("long " * 30_000).strip(),
    "<article><p>unclosed <b>bold": "unclosed bold",
    "<div hidden>no</div><p>yes</p>": "yes",
}


@pytest.mark.parametrize("page", CASES, ids=range(len(CASES)))
def test_pages(page):
    assert html_extract.extract(page, None) == CASES[page]


HEAD = "<h1>Title</h1><p>lead</p>"


@pytest.mark.parametrize("page", [
    f"<div class=post>{HEAD}<div class=post-body>{LONG}</div></div>",
    f"<body>{HEAD}<div>{LONG}</div></body>",
    f"<article>{HEAD}<div class=post-body>{LONG}</div></article>",
    f"<div class=post>{HEAD}<article>{LONG}</article></div>",
    f"<div class=post>{HEAD}<div class=post-body><div>{LONG}</div></div><p><a href=x>next</a></div>",
])
def test_nothing_around_a_nested_body_is_lost(page):
    got = html_extract.extract(page, None)
    assert got.removesuffix("\n\nnext") == f"Title\n\nlead\n\n{LONG.strip()}"


@pytest.mark.parametrize("page", [
    f"<div id=page class='content no-sidebar'><article>{HEAD}{LONG}</article></div>",
    f"<div class='with-sidebar'><div class=post>{HEAD}{LONG}</div></div>",
    f"<div class='post has-comments'>{HEAD}{LONG}</div>",
    f"<div class='entry tags-news'>{HEAD}{LONG}</div>",
    f"<div class=post><div class=post-header><h1>Title</h1></div><p>lead</p>{LONG}</div>",
    f"<div class=widget>{HEAD}{LONG}</div><p>short</p>",
    f"<div class='layout-sidebar'><div class=sidebar>side</div><article>{HEAD}{LONG}</article></div>",
    f"<article>{HEAD}{LONG}</article><div class=comments><article class=comment>{LONG * 9}</article></div>",
])
def test_names_do_not_silence_an_article(page):
    got = html_extract.extract(page, None)
    assert got.removesuffix("\n\nshort") == f"Title\n\nlead\n\n{LONG.strip()}"


def test_generalised_paths():
    nodes = html_extract.containers("<div class='post post-17 b'><p>x</p></div>")
    assert [n.path for n in nodes] == ["", ">div.b.post", ">div.b.post>p"]


def test_a_host_agrees_on_its_paths(spark):
    """A page whose own best container is another follows what its host voted for."""
    rows = [
        (k, f"http://Host.example/{k}", f"<div class=story><p>{LONG}</div><div class=box><p>s</div>")
        for k in range(5)
    ]
    rows.append((9, "http://host.example:80/9", f"<div class=story><p>short</div><div class=box>{LONG}</div>"))
    rows.append((10, "http://other.example/", f"<div class=story><p>short</div><div class=box>{LONG}</div>"))
    rows += [(11, None, None), (None, "no host", "<p>t</p>"), (None, "no host", "<p>t</p>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = html_extract.main_text(pages)
    assert got.columns == ["page_id", "url", "html", "text"]
    texts = [(r.page_id, r.text) for r in got.collect()]
    assert dict(texts)[9] == "short" and dict(texts)[10] == LONG.strip() and dict(texts)[11] == ""
    assert texts.count((None, "t")) == 2 and len(texts) == len(rows)
    assert html_extract.main_text(pages.limit(0)).count() == 0


def test_query_gives_the_articles(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op4_main_text(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", article.replace("<br>", " "))
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts]
        want = "\n\n".join(x for x in lines if x)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))
