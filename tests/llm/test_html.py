import math
import time

import pytest
from pyspark.sql import functions as F

from shelfsense.llm import html
from shelfsense.llm.queries import document_number

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    pages, docs = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("pages", "documents"))
    return html.learn(html.pairs(pages, docs, document_number(F.col("url"))))


def test_marginals_equal_enumeration(model):
    tree = html.parse("<body><nav><a href=x>Home</a></nav><div><p>Some words here.<p>More.</div><footer>End</footer>")
    n, total, content = len(tree.parent), 0.0, [0.0] * 100
    for state in range(2**n):
        y = [state >> i & 1 for i in range(n)]
        p = math.exp(y[0] * model.prior)
        for i in range(n):
            p *= math.exp(y[i] * model.potentials(tree)[i])
            if i:
                loss, gain = model.loss(tree.cues[tree.parent[i]]), math.exp(html.BELOW)
                p *= (loss, 1 - loss)[y[i]] if y[tree.parent[i]] else (1, gain)[y[i]]
        total += p
        for i in range(n):
            content[i] += p * y[i]
    assert model.marginals(tree) == pytest.approx([c / total for c in content[:n]])


def test_held_out_pages(spark, model):
    """Pages the model has not learnt from: the blocks of the article element, whatever the document says."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(800).collect()
    for page in pages:
        inside = page.html[page.html.index("<article>") : page.html.index("</article>")]
        wanted = "\n".join(t for t in html.parse(inside).text if t is not None)
        assert model.extract(page.html) == wanted, page.page_id


PAGE = """<!doctype html><html><head><title>No</title><style>p{}</style></head><body class=page>
<header><h1>Site</h1><p>The best site there is.</p></header><ul class="main-menu"><li><a href=/>Home</a><li><a href=/b>News</a></ul>
<div id="cookie-notice"><p>We use cookies, as everyone does these days.</p><button>OK</button></div>
<main><article><h1>Of  mice &amp; men</h1><p>First&nbsp;<b>para</b>graph, it has
 a few words &lt;here&gt; and <a href=x>a link</a>.<p>Second one<br>goes on.</p><div class="ad">Buy this now.</div>
<script>document.write("<p>no</p>")</script><ul><li>An item of a list.<li>One more item.</ul><table><tr><td>Cell one<td>Cell two</table>
<form><label>Mail</label><input name=q><p>Subscribe to our letter.</p></form><p>Last paragraph &copy; 2024.</p></article>
<section class="comments"><h2>Comments</h2><div><p>I liked this a lot, thank you for writing it.</p></div></section></main>
<aside><p>Another story that you may like to read as well.</p></aside><footer><p>All rights reserved.</p></footer></body></html>"""


def test_furniture(model):
    assert model.extract(PAGE).split("\n") == [
        "Of mice & men",
        "First paragraph, it has a few words <here> and a link.",
        "Second one goes on.",
        "An item of a list.",
        "One more item.",
        "Cell one",
        "Cell two",
        "Last paragraph © 2024.",
    ]


def test_odd_pages(spark, model):
    long = "<article>" + "<p>word " * 60_000 + "</article>"
    deep = "<div>" * 20_000 + "text of a deep page." + "</div>" * 20_000
    broken = "<article><p class='x>a</p><p>b &amp c &am &#65;<!-- open <p>d"
    rows = [None, "", " \n", "plain text only.", long, deep, broken, "<", "<p", "</article>", "<article><p>Just this line here.</p></article>"] * 2
    frame = spark.createDataFrame([(i, None, h, 5) for i, h in enumerate(rows)], "page_id long, url string, html string, text int")
    got = {r.page_id: r.text for r in html.extract(frame, model).collect()}
    assert len(got) == len(rows)
    assert got[0] == got[1] == got[2] == "" and got[10] == "Just this line here."
    assert len(got[4]) == 60_000 * 5 - 1
    assert html.extract(frame.limit(0), model).collect() == []
    nothing = html.learn(spark.createDataFrame([], "html string, text string"))
    assert nothing.extract("") == "" and not nothing.cues and not nothing.decisive


@pytest.mark.parametrize(
    "names",
    ["post category-legal", "article share-enabled", "entry tag-ads", "post has-sidebar", "post format-image related-posts"],
)
def test_names_of_furniture_in_an_article(model, names):
    assert model.extract(PAGE.replace("<article>", f'<article class="{names}">')) == model.extract(PAGE)


def test_training_decides(model):
    """Without training no page is cut, with it the furniture of a held-out page goes."""
    untrained = html.model_of({})
    assert untrained.extract(PAGE) != model.extract(PAGE)
    assert "All rights reserved." in untrained.extract(PAGE) or untrained.extract(PAGE) == ""
    # what a name says is learnt: pages on which class "byline" is never content
    counts = {("nodes", True): 5000, ("nodes", False): 5000, ("tag:p", True): 900, ("tag:p", False): 900}
    tree = html.parse("<div><p>Text of a page, a sentence long.</p></div><div class=byline><p>By its author.</p></div>")
    at = next(i for i, cues in enumerate(tree.cues) if "name:byline" in cues)
    without, learnt = (html.model_of(counts | more).marginals(tree)[at] for more in ({}, {("name:byline", False): 500}))
    assert learnt < 1e-6 < without


@pytest.mark.parametrize(
    "piece", ["<svg>", "<a ", "<a '", "<!-- x", '<p class="x', "</p></span></b></div>", "<div></p>", "<iframe><p>", "&amp;<"]
)
def test_broken_pages_take_time_in_proportion(piece):
    """Two megabytes of broken markup; with work growing as the square none of these would end."""
    begun = time.perf_counter()
    html.parse("<div>" * 20_000 + piece * (2_000_000 // len(piece)))
    assert time.perf_counter() - begun < 20
