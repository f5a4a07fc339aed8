import pytest
from pyspark.sql import functions as F

from gondola.llm import html

ARTICLE = "First, a long sentence; with marks and words. Another one follows here, quite long too."
NOISE = "Home News Sport Weather"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{a:b}}</style><script>var x='</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize("body, text", [
    (f"<nav><ul><li><a href='/'>{NOISE}</a></li></ul></nav><article><h1>Head</h1><p>{ARTICLE}</p><p>The.</p></article><footer>f</footer>",
     f"Head\n{ARTICLE}\nThe."),
    (f"<article><p>{ARTICLE}<p>Second <b>bold  &amp;</b>\n text&nbsp;x<br>after<ul><li>one<li>two</ul></article>",
     f"{ARTICLE}\nSecond bold & text x\nafter\none\ntwo"),
    (f"<header><p>{NOISE}</p></header><div id=content><p>{ARTICLE}</p><p>{ARTICLE}</p></div><div class='sidebar-left'><p>{ARTICLE}</p></div>",
     f"{ARTICLE}\n{ARTICLE}"),
    (f"<div><p>{ARTICLE}</p><p>{ARTICLE}</p></div><section id='comments'><p>{ARTICLE} me too!</p></section><form><p>{ARTICLE}</p></form>",
     f"{ARTICLE}\n{ARTICLE}"),
    (f"<main><article><p>{ARTICLE}</p><div class='ad'>Buy</div><aside>{NOISE}</aside><div role=alert>{NOISE}</div><p hidden>x</p>"
     f"<div style='display:none'>x</div><noscript>x</noscript></article></main>", ARTICLE),
    (f"<table><tr><td><a href=x>{NOISE}</a></td></tr></table><div><div><p>{ARTICLE}</p><p>{ARTICLE} &lt;tag&gt; &#x41;</p></div></div>",
     f"{ARTICLE}\n{ARTICLE} <tag> A"),
])
def test_pages(body, text):
    assert html.main_text(page(body)) == text


@pytest.mark.parametrize("body, text", [
    (f"<form id=aspnetForm><nav>{NOISE}</nav><article><h1>Head</h1><p>{ARTICLE}</p></article><footer>f</footer></form>", f"Head\n{ARTICLE}"),
    (f"<div class='content-sidebar-wrap'><main><p>{ARTICLE}</p><p>The.</p></main><div class=sidebar><p>{ARTICLE}</p></div></div>", f"{ARTICLE}\nThe."),
    (f"<p>Skip.</p><div class='has-sidebar'><div id='search-page'><div class=post><p>{ARTICLE}</p><p>{ARTICLE}</p></div></div></div>", f"{ARTICLE}\n{ARTICLE}"),
    (f"<form><div><p>{ARTICLE}</p><p>{ARTICLE}</p></div><div class='comments'><p>{ARTICLE}</p></div></form>", f"{ARTICLE}\n{ARTICLE}"),
    (f"<article><div class='article-header'><h1>Head</h1></div><p>{ARTICLE}</p><p class='side-note'>{ARTICLE}</p><div class=ad>{ARTICLE}</div></article>",
     f"Head\n{ARTICLE}\n{ARTICLE}"),
    (f"<div class=post><p>{ARTICLE}</p><p>{ARTICLE}</p></div><section id=comments><article class=comment><p>Me too, yes.</p></article></section>",
     f"{ARTICLE}\n{ARTICLE}"),
])
def test_marked_wrappers(body, text):
    assert html.main_text(page(body)) == text


LONG = f"<p>{ARTICLE}</p><p>{ARTICLE}</p>"


@pytest.mark.parametrize("holder", ["<div class=post>{}</div><div><a href=x>Next</a></div>", "<table><tr><td><a href=x>Top</a></td></tr></table><div>{}</div>"])
@pytest.mark.parametrize("body, text", [
    (f"{LONG}<h2>End</h2><ul><li>short</li><li>list</li></ul>", f"{ARTICLE}\n{ARTICLE}\nEnd\nshort\nlist"),
    (f"<h3>Start</h3><p>By me</p><blockquote>So.</blockquote><h4>Sub</h4>{LONG}", f"Start\nBy me\nSo.\nSub\n{ARTICLE}\n{ARTICLE}"),
    (f"<table><tr><td>a<td>1</table>{LONG}<table><tr><td>b<td>2</table>", f"a\n1\n{ARTICLE}\n{ARTICLE}\nb\n2"),
    (f"<p>{ARTICLE}</p><p><a href=x>A whole link</a></p><p>{ARTICLE}</p><ul><li><a href=x>one</a><li><a href=x>two</a></ul>",
     f"{ARTICLE}\nA whole link\n{ARTICLE}"),
])
def test_all_of_the_container(holder, body, text):
    assert html.main_text(page(holder.format(body))) == text


def test_page_as_container():
    assert html.main_text(page(f"<h1>Head</h1><p>By me</p>{LONG}<h2>End</h2><ul><li>short</ul><div>Site</div>")) == (
        f"Head\nBy me\n{ARTICLE}\n{ARTICLE}\nEnd\nshort")


@pytest.mark.parametrize("broken", ["", " ", "<", "<p", "<p>", "</p></p>", "<!--", "<script>x", "&", "<a href='x", "plain text only", "<![CDATA[x]]>"])
def test_broken_markup(broken):
    assert html.main_text(broken).strip() in ("", "x", "<", "<p", "&", "plain text only", "<a href='x")


def test_truncated_page_keeps_the_article():
    assert html.main_text(page(f"<article><p>{ARTICLE}</p><p>{ARTICLE}")[:-14]) == f"{ARTICLE}\n{ARTICLE}"


def test_deep_and_long_pages():
    assert html.main_text("<div>" * 3000 + ARTICLE) == ARTICLE
    long = "".join(f"<p>{ARTICLE} {i}</p>" for i in range(5000))
    assert html.main_text(page(f"<article>{long}</article>")).count("\n") == 4999


def test_ratios_prefer_text_paths():
    found = html.blocks(page(f"<div><p>{ARTICLE}</p><p>{ARTICLE}</p><ul><li><a>{NOISE}</a></li></ul></div>"))
    scores = html.path_scores(found)
    assert max(scores, key=scores.get)[-1] == "p" and min(scores.values()) < 0.05 * max(scores.values())


def test_table(spark):
    rows = [(1, "u", page(f"<article><p>{ARTICLE}</p></article>")), (2, None, None), (None, "u", ""), (1, "u", page(f"<article><p>{ARTICLE}</p></article>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("made", F.lit(1))
    got = sorted(map(tuple, html.report(pages).collect()), key=str)
    one = (1, "u", ARTICLE, len(ARTICLE))
    assert got == sorted([one, one, (2, None, "", 0), (None, "u", "", 0)], key=str)
    assert html.report(pages.limit(0)).count() == 0


def test_marked_links_and_spans_lose_no_sentence():
    long = "A long first paragraph, with commas, that nobody closed in time. " * 4
    got = html.main_text(f"<article><a class='skip' name=top>{long}<p>See <a href=x>this</a> end.</article>")
    assert got == f"{long.strip()}\nSee this end."
    rest = "The whole text goes on for a while, so that it is the article. " * 4
    page = "<article><p>Here <span class=notice>the <b>middle</b> matters</span> a lot. {0}</p></article>"
    assert html.main_text(page.format(rest)) == f"Here the middle matters a lot. {rest.strip()}"
    nested = f"<article><p>One <span class=share>two <span>in</span> three</span></p><p>{rest}</p></article>"
    assert html.main_text(nested) == f"One\n{rest.strip()}"
    ends = f"<article><p><a class=share href=#>Share</a> {rest}<a class=share href=#>Share</a></p><p>Kept <span style='display:none'>gone</span> here.</p></article>"
    assert html.main_text(ends) == f"{rest.strip()}\nKept here."


def test_ratios_equal_sums_by_definition():
    """Path scores against sums taken anew for every path."""
    page = "<article><h1>On ducks.</h1><p>One, two; three.</p><p>Four <a href=x>five</a></p><ul><li>six</li><li>seven!</li></ul></article><div><p>eight, <a href=y>nine</a></p></div>"
    found = html.blocks(page)
    scores = html.path_scores(found)
    paths = {b.names for b in found}
    assert scores.keys() == paths

    def ratio(path):
        own = [b for b in found if b.names == path]
        marks = sum(c in html.MARKS for b in own for c in b.text)
        return [sum(len(b.text) for b in own) / len(own), marks / len(own)]

    for path in paths:
        near = [q for q in paths if q != path and (q[:-1] == path[:-1] or q == path[:-1] or q[:-1] == path)]
        smooth = ratio(path)
        if near:
            smooth = [html.SMOOTHING * r + (1 - html.SMOOTHING) * sum(ratio(q)[i] for q in near) / len(near) for i, r in enumerate(smooth)]
        own = [b for b in found if b.names == path]
        free = 1 - sum(min(b.linked, len(b.text)) for b in own) / max(1, sum(len(b.text) for b in own))
        weight = 3.0 if any(n.endswith("+") for n in path) else 1.0
        assert abs(scores[path] - smooth[0] * (1 + smooth[1]) * free ** 2 * weight) < 1e-9
