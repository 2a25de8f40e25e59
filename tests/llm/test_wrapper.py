import os
import random
import re
from html.parser import HTMLParser

import pytest
from wayloom.llm import wrapper as w


def text(html):
    page = w.Page(html)
    article = any(page.inside[n] and not page.bad[n] for n, _ in page.pieces)
    return " ".join(t for n, t in page.pieces if not page.bad[n] and (page.inside[n] or not article))


def test_main_text_of_odd_pages():
    assert text("") == ""
    assert text("plain &amp; simple") == "plain & simple"
    assert text('<script>var t="</p>";</script><article><h1>T</h1><p><b>un</b>closed<br><p>next&nbsp; \n one<style>x</style></article><footer>no</footer>') == "T unclosed next one"
    assert text('<nav>a</nav><div class="side-bar cookieNotice">b</div><main><p>c</p><div id="comments">d</div><aside>e</aside><form>f</form></main><div class="ad">g</div>') == "c"
    assert text("<body><header>top</header><article><header><h1>Head</h1></header>body</article>") == "Head body"
    assert text("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a b c d"
    assert text('<p title="a > b">x</p>') == "x"
    assert text("<!-- <article>no</article> --><p hidden>no</p><p style='display: none'>no</p><p>yes") == "yes"
    assert text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text("</div></p>stray</article> &lt;b&gt; &#8364;&copy") == "stray <b> €©"


def test_words_of_classes_never_empty_an_article():
    assert text('<html class="nav-open"><body class="single right-sidebar"><article class="post has-comments"><p>a</p></article></body></html>') == "a"
    assert text('<body class="right-sidebar"><div class="with-sidebar"><main class="widget"><p>a</p></main></div><div class="sidebar">b</div></body>') == "a"
    assert text('<body class="social"><p>a</p><div class="share">b</div></body>') == "a"
    assert text('<article><p>a</p><section id="discussion"><p>b</p></section><nav>c</nav></article>') == "a b"


def test_skeletons_fold_repeated_children():
    a, b = (w.Page(f"<article>{'<p>x</p>' * n}</article>").skeleton() for n in (1, 9))
    assert a == b == "0 root;1 article;2 p"


def test_simple_tree_matching():
    a = w.Page("<body><nav>n</nav><div class=x><p>1</p></div><section><p>2</p></section><footer>f</footer></body>").skeleton()
    b = w.Page("<body><nav>n</nav><section><p>2</p></section><aside>s</aside><footer>f</footer></body>").skeleton()
    labels_a, labels_b = w.tree(a)[0], w.tree(b)[0]
    names = {labels_a[i]: labels_b[j] for i, j in enumerate(w.match(a, b)) if j >= 0}
    assert names["nav!"] == "nav!" and names["section"] == "section" and names["footer!"] == "footer!" and "div.x" not in names
    assert w.match(a, a) == list(range(len(labels_a)))


def page(k, note, host="h.example"):
    return f"https://{host}/{k}", f"<body><div class=m>Welcome to the site</div><div class=n>{note}</div><section><p>text {k} of its own, and of no other page</p></section><div class=z>All rights kept</div></body>"


def test_what_repeats_on_a_host_is_template(spark):
    rows = [(k, *page(k, f"line {k % 3}")) for k in range(60)] + [(100 + k, *page(5, f"line {k % 3}")) for k in range(40)] + [(200, *page(1, "alone", "other.example"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in w.extract(df).collect()}
    assert all(got[k] == f"text {k} of its own, and of no other page" for k in range(60))
    # Copies of one article don't turn it into template.
    assert all(got[100 + k] == "text 5 of its own, and of no other page" for k in range(40))
    assert got[200] == "Welcome to the site alone text 1 of its own, and of no other page All rights kept"


def test_odd_pages(spark):
    rows = [(1, None, None, "x"), (2, "http://a.example/", "", "x"), (2, "http://a.example/", "", "x"), (None, "not a url", "<p>hi</p>", "x"), (3, None, "<p>" + "long " * 60_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or 0), len(r.text)) for r in w.extract(df).collect())
    assert got == [(0, 2), (1, 0), (2, 0), (2, 0), (3, 299_999)]
    assert w.extract(df.limit(0)).count() == 0


def site(k, kind):
    """A page of a site and its main text; kinds of mark-up that look like something else."""
    r = random.Random(k)
    say = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))
    parts = [say(30), say(60), say(25)]
    body = "".join(f"<p>{x}</p>" for x in parts)
    around = lambda x: f"<html><body><header>The site</header><nav><a>one</a></nav>{x}<div class='comments'><p>{say(4)} nice</p></div><footer>Rights kept</footer></body></html>"
    if kind == "plain":
        return around(f"<article>{body}</article>"), parts
    if kind == "ad-free":
        return around(f'<article class="post ad-free">{body}</article>'), parts
    if kind == "words inside":
        own = f'<div class="social history"><p>{parts[0]}</p></div><section class="related-work">{parts[1]}</section><div id="notice-of-appeal">{parts[2]}</div>'
        return around(f"<article>{own}</article>"), parts
    if kind == "label":
        return around(f"<article><p>{parts[0]}</p><label>{parts[1]}</label><p>{parts[2]}</p></article>"), parts
    if kind == "teaser":
        return around(f"<div class=body>{body}</div><article class=card><p>{say(3)}</p></article>"), None
    if kind == "bulk":
        return around(f'<div class="social history">{body}</div><div class="share">{say(5)}</div>'), parts
    if kind == "share box":
        return around(f"<article>{body}<div class=share>Tell {k % 2}</div></article>"), parts
    return around(f'<div class="{" ".join(f"w{x}" + "abcdefghij"[x] * 9 for x in range(9))} first">{parts[0]}</div><div class="{" ".join(f"w{x}" + "abcdefghij"[x] * 9 for x in range(9))} second">{parts[1]}</div><p>{parts[2]}</p>'), parts


def test_sites_with_known_main_text(spark):
    kinds = ["plain", "ad-free", "words inside", "label", "teaser", "bulk", "share box", "long classes"]
    rows = [(100 * k + n, f"https://{kind.replace(' ', '-')}.example/{n}", *site(100 * k + n, kind)) for k, kind in enumerate(kinds) for n in range(12)]
    df = spark.createDataFrame([x[:3] for x in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in w.extract(df).collect()}
    for i, url, html, parts in rows:
        if parts is None:
            assert all(x in got[i] for x in re.findall(r"<p>(.*?)</p>", html.split("</div>")[0])), url
            assert "nice" not in got[i] and "site" not in got[i]
        else:
            assert got[i] == " ".join(parts), url


class Slow(HTMLParser):
    """Texts of the blocks inside an article, by the library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks, self.text = 0, [], ""

    def flush(self):
        own = " ".join(self.text.split())
        self.blocks += [own] if own else []
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text += " "
        elif tag not in w.INLINE:
            self.flush()
        self.depth += tag == "article"

    def handle_endtag(self, tag):
        if tag not in w.INLINE:
            self.flush()
        self.depth -= tag == "article"

    def handle_data(self, data):
        self.text += data if self.depth else ""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the supplied tables are not here")
def test_supplied_pages_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in w.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        slow = Slow()
        slow.feed(r.html or "")
        slow.close()
        slow.flush()
        assert got[r.page_id] == " ".join(slow.blocks), r.url
