"""Main text of pages: planted articles in several templates, and odd markup."""

import random
from html import escape

import pytest

from ledgerleaf.llm import html_extraction
from ledgerleaf.llm.html_extraction import Page, main_text

WORDS = "alpha beta gamma delta été größe niño of the and 5 < 7 & so".split()


def sentence(r, n=12):
    return " ".join(r.choice(WORDS) for _ in range(r.randrange(3, n)))


def article(r):
    return [sentence(r, 8), *[sentence(r, 30) for _ in range(r.randrange(2, 6))]]


def links(r):
    return "".join(f'<li><a href="/{k}">{escape(sentence(r, 6))}</a></li>' for k in range(5))


def tagged(r, blocks):
    head, *rest = map(escape, blocks)
    return f'<!DOCTYPE html><html><head><title>{head}</title><style>p{{}}</style><script>var t="<p>no</p>";</script></head><body class="has-sidebar"><header><p>{sentence(r)}</p></header><nav><ul>{links(r)}</ul></nav><article><h1>{head}</h1>' + "".join(f"<p><b>{x}" for x in rest) + f'</article><section class="comments"><article><p>{escape(sentence(r))}</p></article></section><footer>&copy; {escape(sentence(r))}</footer></body></html>'


def plain(r, blocks):
    """No element tells what it is: the menu is all links, the notice always the same."""
    head, *rest = map(escape, blocks)
    return f'<html><body><div class="a1"><ul>{links(r)}</ul></div><div class="b2"><p>We keep crumbs on this site.</p></div><div class="c3"><h2>{head}</h2>' + "".join(f"<div>{x}</div>" for x in rest) + '<p>Read on tomorrow.</p></div><div class="d4"><span>All rights are ours.</span></div></body></html>'


def wrapped(r, blocks):
    head, *rest = map(escape, blocks)
    return f'<html><body><div id="page" class="page-with-sidebar"><main><h1>{head}</h1><div class="post-body">' + "\n".join(f"<p>{x}\n</p>" for x in rest) + f'<aside><p>{escape(sentence(r))}</p></aside><form>Name <input name=x></form></div><div class="related-posts"><p>{escape(sentence(r))}</p></div></main><div class="sidebar"><p>{escape(sentence(r))}</p></div><div id="cookie-notice">Fine?</div></div>'


@pytest.mark.parametrize("small", [False, True])
def test_templates_of_hosts(spark, monkeypatch, small):
    if small:  # templates joined by host
        monkeypatch.setattr(html_extraction, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(html_extraction, "HOT_PAGES", 3)
    r, rows, want = random.Random(6), [], {}
    common = sentence(r, 30)
    for host, made, pages in (("a.example", tagged, 40), ("b.example", plain, 12), ("c.example", wrapped, 9), ("d.example", tagged, 2), ("e.example", wrapped, 1)):
        for k in range(pages):
            blocks = article(r)
            if k % 3 == 0:
                blocks[-1] = common  # a line that many articles share is no template
            rows.append((len(rows), f"https://{host}/{k}?x=1", made(r, blocks), "x"))
            want[len(rows) - 1] = "\n".join(blocks)
    copy = article(r)
    for k in range(10):  # a host with copies of one article
        rows.append((len(rows), f"HTTP://User@F.example:80/{k}", tagged(r, copy), "x"))
        want[len(rows) - 1] = "\n".join(copy)
    odd = [(None, "https://a.example/n", ""), ("", None, ""), ("no markup & more", None, "no markup & more"), ("<p>w</p>" * 20_000, "https://g.example/", "\n".join(["w"] * 20_000)), ("<nav><a>only a menu</a></nav>", "https://a.example/m", "")]
    for html, url, text in odd:
        rows.append((len(rows), url, html, "x"))
        want[len(rows) - 1] = text
    rows.append(rows[0])
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string, tokens string")).collect()
    assert len(got) == len(rows) and {g.page_id: g.text for g in got} == want and all(g.n_chars == len(g.text) and g.url == rows[g.page_id][1] for g in got)


def test_no_pages(spark):
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(
    "html, want",
    [
        ("<p>a<br>b&amp c &lt;p&gt; &nbsp; d", "a b& c <p> d"),
        ('<p title="a>b">x</p><!-- <p>no</p> -->y<!-- cut', "x\ny"),
        ("<p>1 < 2 and <3</p><p cut off", "1 < 2 and <3"),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", "a\nb\nc\nd"),
        ("<p>a <span class=ad>buy</span> b</p>", "a\nb"),
        ("<header>h</header><article><header><h2>t</h2></header>x<script>if(a<b){'</p>'}</script>y</article>", "t\nx y"),
        ("<div hidden>h</div><ul><li>a<li>b<ul><li>c</ul></ul><dl><dt>d<dd>e</dl>", "a\nb\nc\nd\ne"),
        ("<main><h1>t</h1><p>long text here</p></main><script>never closed <p>x", "t\nlong text here"),
        ("</p></div>x</x><h1>y<h2>z", "x\ny\nz"),
        ("<article class=comment>c</article><textarea>t</textarea><p>x", "x"),
    ],
)
def test_markup(html, want):
    assert Page(html, {}).article(None) == want
