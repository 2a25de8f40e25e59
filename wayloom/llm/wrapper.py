"""HTML extraction by wrapper induction over the pages of a host.

Each page is parsed into a tree of its block elements, in which like-labelled
children of a node fold into one repeated node; its shape is the page's skeleton.
The commonest skeleton of a host is its reference. Every skeleton of the host is
aligned with it by simple tree matching (the largest order-preserving matching of
children, top down), so all pages' nodes have names in common. A node whose text
repeats over pages with different main texts is template; one whose text varies is
a content slot. Copies of an article count once, so they don't make it template.

The text of a page is that of its content slots, in page order, less what elements and
roles declare to be something else: menus, headers, footers, sidebars, adverts, forms,
scripts, styles. Words in class or id are evidence of that, not proof. Outside an article
element they leave a node out unless it holds over half of the page's text (only comments
go however much they are); html, body, main, article and what holds an article or main are never left out so.
Inside an article element, and for what holds most of a page, they only lower what it takes to be template. Where
the text inside article and main elements is at least half as much as what else is left,
it alone is the page's text; else it is a teaser, and all counts.

Pages are parsed twice: once for the hashes that wrappers are induced from, which are
written down, and once for the text. Counts are taken over all pages with map-side
combining; a host, however large, never meets in one task. The nodes' names and the
per-skeleton verdicts are broadcast behind a size check.

Edge cases: null and empty pages give empty texts; text outside any element counts;
unclosed and stray tags are tolerated; nesting beyond MAX_DEPTH keeps its text in the
deepest node; pages without a host form one group; repeated rows get equal texts.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import checkpoint, small_batches

#: Element classes of HTML.
RAW = ["script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "select"]
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
INLINE = [
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
]
#: Elements, roles and words in class or id that declare something other than the article.
NOT_CONTENT = ["head", "nav", "footer", "aside", "form", "button", "menu", "dialog", "select", "object", "canvas", "audio", "video"]
NOT_CONTENT_ROLES = ["navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"]
NOT_CONTENT_WORDS = [
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "side", "footer", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "discussion", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription", "signup", "login", "popup", "modal", "overlay", "widget", "toolbar", "pagination", "pager", "skip", "masthead", "topbar",
]
COMMENT_WORDS = ["comment", "comments", "reply", "replies", "disqus"]
#: A class that begins like this tells a state of the page, not what the element is.
STATES = ["has", "with", "without", "no", "is"]
MAIN = ["article", "main"]
#: Opening one of the first ends an open one of the second, up to the third.
ENDS = {
    "li": (["li"], ["ul", "ol", "menu"]), "dt": (["dt", "dd"], ["dl"]), "dd": (["dt", "dd"], ["dl"]), "tr": (["tr", "td", "th"], ["table"]), "td": (["td", "th"], ["tr", "table"]), "th": (["td", "th"], ["tr", "table"]),
    "tbody": (["thead", "tbody", "tr", "td", "th"], ["table"]), "tfoot": (["thead", "tbody", "tr", "td", "th"], ["table"]), "option": (["option"], ["select"]), "body": (["head"], []),
}
MAX_DEPTH = 40

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(" + "|".join(RAW) + r")\b[^>]*(?<!/)>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.S | re.I,
)
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/\"']|$)", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_inline, _void, _bad_tag, _bad_role, _bad_word = (frozenset(x) for x in (INLINE, VOID, NOT_CONTENT, NOT_CONTENT_ROLES, NOT_CONTENT_WORDS))
_comment_word, _state = frozenset(COMMENT_WORDS), frozenset(STATES)
_main = frozenset(MAIN)
_never_worded = frozenset(["html", "body", *MAIN])


@lru_cache(maxsize=4096)
def _label(tag: str, attrs: str) -> tuple[str, bool, int]:
    """Label of an element (tag and words of its class), whether its mark-up declares it not to be content, and whether words do: 2 if of comments."""
    bad, worded, words = tag in _bad_tag, 0, []
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            for token in value.split():
                own = _WORD.findall(_CAMEL.sub(" ", token).lower())
                words += own if name == "class" else []
                if tag not in _never_worded and own and own[0] not in _state:
                    worded = max(worded, 0 if _bad_word.isdisjoint(own) else 1, 0 if _comment_word.isdisjoint(own) else 2)
        elif name == "role":
            bad |= value.lower() in _bad_role
        elif name == "style":
            bad |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
        elif name == "hidden" or value.lower() == "true":
            bad = True
    label = ".".join([tag, *sorted(set(words))])
    if len(label) > 80:
        label = f"{label[:60]}~{_hash(label):x}"
    return label + ("!" if bad or worded else ""), bad, worded


class Page:
    """Folded tree of a page's block elements and its text pieces, each with its node, in page order."""

    def __init__(self, source: str):
        self.labels, self.children, self.parent = ["root"], [[]], [-1]
        self.bad, self.inside = [False], [False]
        self._worded, self._article, self._holds = [0], [False], [False]
        self.pieces: list[tuple[int, str]] = []
        self._by_label: list[dict[str, int]] = [{}]
        stack: list[tuple[str, int]] = [("", 0)]
        text: list[str] = []
        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                text.append(source[at : m.start()])
            at = m.end()
            tag = m[3] or m[6]
            if not tag:
                continue  # a comment, declaration or raw element
            tag = tag.lower()
            close = m[2] if m[3] else m[5]
            attrs = (m[4] if m[3] else m[7]) or ""
            if tag in _void:
                text.append(" ")
                if tag == "hr":
                    self._flush(text, stack[-1][1])
                continue
            if close:
                k = len(stack) - 1
                while k > 0 and stack[k][0] != tag:
                    k -= 1
                if k > 0:
                    self._flush(text, stack[-1][1])
                    del stack[k:]
                elif tag not in _inline:
                    self._flush(text, stack[-1][1])
                continue
            label, bad, worded = _label(tag, attrs.rstrip("/ ") if attrs else "")
            if tag in _inline and not bad and not worded:
                continue  # part of the text around it
            self._flush(text, stack[-1][1])
            self._end_implied(tag, stack)
            if attrs.endswith("/") and tag not in ("p", "div"):
                continue
            node = stack[-1][1]
            if len(stack) <= MAX_DEPTH:
                node = self._open(node, label, bad, worded, tag)
            stack.append((tag, node))
        text.append(source[at:])
        self._flush(text, stack[-1][1])
        self._settle()

    def _settle(self) -> None:
        """Hand down what is declared, then what words say: of nodes outside articles that hold neither an article or main nor most of the page."""
        holds, bad, parent = self._holds, self.bad, self.parent
        for n in range(1, len(bad)):
            bad[n] |= bad[parent[n]]
        size = [0] * len(bad)
        for n, text in self.pieces:
            size[n] += 0 if bad[n] else len(text)
        for n in range(len(holds) - 1, 0, -1):
            holds[parent[n]] |= holds[n]
            size[parent[n]] += size[n]
        for n in range(1, len(bad)):
            bad[n] |= bad[parent[n]] or (not holds[n] and (self._worded[n] == 2 or (self._worded[n] == 1 and 2 * size[n] <= size[0])))

    def _open(self, parent: int, label: str, bad: bool, worded: int, tag: str) -> int:
        have = self._by_label[parent].get(label)
        if have is not None:
            return have
        inside = self.inside[parent] or tag in _main
        if tag == "header" and not inside:
            bad = True
        self.labels.append(label)
        self.children.append([])
        self._by_label.append({})
        self.parent.append(parent)
        self.bad.append(bad)
        article = self._article[parent] or tag == "article"
        self._worded.append(0 if article else worded)
        self._article.append(article)
        self._holds.append(tag in _main)
        self.inside.append(inside)
        node = len(self.labels) - 1
        self.children[parent].append(node)
        self._by_label[parent][label] = node
        return node

    @staticmethod
    def _end_implied(tag: str, stack: list[tuple[str, int]]) -> None:
        if stack[-1][0] == "p" and tag not in _inline:
            stack.pop()
        if tag in ENDS:
            over, stop = ENDS[tag]
            k = len(stack) - 1
            cut = 0
            while k > 0 and stack[k][0] not in stop:
                if stack[k][0] in over:
                    cut = k
                k -= 1
            if cut:
                del stack[cut:]

    def _flush(self, text: list[str], node: int) -> None:
        if not text:
            return
        got = "".join(text)
        text.clear()
        got = " ".join((entities.unescape(got) if "&" in got else got).split())
        if got:
            self.pieces.append((node, got))

    def order(self) -> list[int]:
        """Nodes in preorder: positions in the skeleton."""
        out, todo = [], [0]
        while todo:
            n = todo.pop()
            out.append(n)
            todo += reversed(self.children[n])
        return out

    def skeleton(self) -> str:
        """Preorder of depth and label; like pages have like skeletons."""
        depth = [0] * len(self.labels)
        for n in range(1, len(depth)):
            depth[n] = depth[self.parent[n]] + 1
        return ";".join(f"{depth[n]} {self.labels[n]}" for n in self.order())


def tree(skeleton: str) -> tuple[list[str], list[list[int]]]:
    """Labels and children of the nodes of a skeleton."""
    labels: list[str] = []
    children: list[list[int]] = []
    path: list[int] = []
    for n, item in enumerate(skeleton.split(";")):
        depth, _, label = item.partition(" ")
        labels.append(label)
        children.append([])
        del path[int(depth) :]
        if path:
            children[path[-1]].append(n)
        path.append(n)
    return labels, children


def match(skeleton: str, reference: str) -> list[int]:
    """Simple tree matching: the reference's node for each node of the skeleton, or -1."""
    a, ac = tree(skeleton)
    b, bc = tree(reference)
    memo: dict[tuple[int, int], tuple[float, list[tuple[int, int]]]] = {}

    def best(x: int, y: int) -> tuple[float, list[tuple[int, int]]]:
        """Weight of the best matching of two subtrees whose roots match, and the matched children."""
        if (x, y) not in memo:
            xs, ys = ac[x], bc[y]
            w = [[0.0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
            step = [[0.0] * len(ys) for _ in xs]
            for i, p in enumerate(xs):
                for j, q in enumerate(ys):
                    same = a[p].split(".")[0].rstrip("!") == b[q].split(".")[0].rstrip("!")
                    step[i][j] = best(p, q)[0] + 0.5 * (a[p] == b[q]) if same else -1.0
                    w[i + 1][j + 1] = max(w[i][j + 1], w[i + 1][j], w[i][j] + step[i][j] if same else 0.0)
            pairs, i, j = [], len(xs), len(ys)
            while i and j:
                if step[i - 1][j - 1] >= 0 and w[i][j] == w[i - 1][j - 1] + step[i - 1][j - 1]:
                    pairs.append((xs[i - 1], ys[j - 1]))
                    i, j = i - 1, j - 1
                elif w[i][j] == w[i - 1][j]:
                    i -= 1
                else:
                    j -= 1
            memo[x, y] = (1.0 + w[len(xs)][len(ys)], pairs)
        return memo[x, y]

    out = [-1] * len(a)
    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        out[x] = y
        todo += best(x, y)[1]
    return out


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _host(url: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, skeleton, nodes, texts, main): hashes of each node's text and of the page's largest text."""
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("host", "skeleton", "nodes", "texts", "main")}
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page = Page(source or "")
            place = {n: i for i, n in enumerate(page.order())}
            own: dict[int, list[str]] = {}
            for n, t in page.pieces:
                own.setdefault(n, []).append(t)
            joined = {n: " ".join(v) for n, v in own.items()}
            main = max((t for n, t in joined.items() if not page.bad[n]), key=len, default="")
            out["host"].append(host)
            out["skeleton"].append(page.skeleton())
            out["nodes"].append([place[n] for n in joined])
            out["texts"].append([_hash(t) for t in joined.values()])
            out["main"].append(_hash(main))
        kinds = [pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, skeleton, names, marked): the reference's node for each node, and whether its mark-up is evidence against it."""
    cached = lru_cache(maxsize=1 << 14)(match)
    for batch in batches:
        skeletons = batch.column(1).to_pylist()
        names = [cached(a, b) for a, b in zip(skeletons, batch.column(2).to_pylist(), strict=True)]
        marked = [[label.endswith("!") for label in tree(a)[0]] for a in skeletons]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.list_(pa.int32())), pa.array(marked, pa.list_(pa.bool_()))], names=["host", "skeleton", "names", "marked"])


def induce(pages: DataFrame, min_pages: int = 4, min_share: float = 0.5, pool_pages: int = 30, pool_repeats: float = 4.0, marked_share: float = 0.1, marked_repeats: float = 1.5, broadcast_rows: int = 200_000) -> DataFrame:
    """Verdicts: (host, skeleton, template), the skeleton's nodes that are template. pages: (host, html).

    A node is template if one text of it stands beside at least `min_share` of the
    host's different main texts, `min_pages` of them at least; or if, over `pool_pages`
    of them at least, each of its texts repeats `pool_repeats` times on average. Of a
    marked node half so many pages, `marked_share` and `marked_repeats` are enough.
    """
    seen = checkpoint(pages.mapInArrow(_observe, "host string, skeleton string, nodes array<int>, texts array<bigint>, main bigint"))
    shapes = seen.groupBy("host", "skeleton").agg(F.count(F.lit(1)).alias("n"))
    reference = shapes.groupBy("host").agg(F.max_by("skeleton", F.struct("n", "skeleton")).alias("reference"))
    names = shapes.join(reference, "host").select("host", "skeleton", "reference").mapInArrow(_align, "host string, skeleton string, names array<int>, marked array<boolean>")
    nodes = names.select("host", "skeleton", F.posexplode(F.arrays_zip("names", "marked")).alias("node", "x")).select("host", "skeleton", "node", F.col("x.names").alias("name"), "x.marked")
    nodes = checkpoint(nodes.where("name >= 0"))
    known = F.broadcast(nodes) if nodes.count() <= broadcast_rows else nodes
    facts = seen.select("host", "skeleton", F.explode(F.arrays_zip("nodes", "texts")).alias("x"), "main").select("host", "skeleton", F.col("x.nodes").alias("node"), F.col("x.texts").alias("text"), "main")
    named = facts.join(known, ["host", "skeleton", "node"]).groupBy("host", "name", "text", "main").agg(F.max("marked").alias("marked"))
    texts = named.groupBy("host", "name", "text").agg(F.count(F.lit(1)).alias("n"), F.max("marked").alias("marked"))
    slots = texts.groupBy("host", "name").agg(F.sum("n").alias("pages"), F.max("n").alias("top"), F.count(F.lit(1)).alias("texts"), F.max("marked").alias("marked"))
    weaker = lambda most, least: F.when(F.col("marked"), least).otherwise(most)
    fixed = (F.col("top") >= weaker(min_pages, min_pages / 2)) & (F.col("top") >= weaker(min_share, marked_share) * F.col("pages"))
    pool = (F.col("pages") >= weaker(pool_pages, pool_pages / 2)) & (F.col("pages") >= weaker(pool_repeats, marked_repeats) * F.col("texts"))
    template = slots.where(fixed | pool).select("host", "name")
    return nodes.join(template, ["host", "name"]).groupBy("host", "skeleton").agg(F.sort_array(F.collect_list("node")).alias("template"))


def _pieces(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            skeletons, nodes, texts, inside = [], [], [], []
            for source in batch.column(batch.schema.names.index("html")).to_pylist():
                page = Page(source or "")
                place = {n: i for i, n in enumerate(page.order())}
                kept = [(n, t) for n, t in page.pieces if not page.bad[n]]
                skeletons.append(page.skeleton())
                nodes.append([place[n] for n, _ in kept])
                texts.append([t for _, t in kept])
                inside.append([page.inside[n] for n, _ in kept])
            cols = [batch.column(batch.schema.names.index(k)) for k in keep]
            lists = [pa.array(nodes, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string())), pa.array(inside, pa.list_(pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(skeletons, pa.string()), *lists], names=[*keep, "skeleton", "nodes", "texts", "inside"])

    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_rows: int = 200_000, **rules) -> DataFrame:
    """(id, url, text) of every page."""
    small_batches(pages.sparkSession)
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), _host(url_col).alias("host"), F.col(html_col).alias("html"))
    # The verdicts are used twice (counted and joined), so they are written down, where executors share a folder.
    template = checkpoint(induce(source.select("host", "html"), broadcast_rows=broadcast_rows, **rules).coalesce(8))
    keep = ["id", "url", "host"]
    kinds = ", ".join(f"{k} {source.schema[k].dataType.simpleString()}" for k in keep)
    rows = source.mapInArrow(_pieces(keep), f"{kinds}, skeleton string, nodes array<int>, texts array<string>, inside array<boolean>")
    if template.count() <= broadcast_rows:
        template = F.broadcast(template)
    left = F.filter(F.arrays_zip("nodes", "texts", "inside"), lambda x: ~F.coalesce(F.array_contains("template", x["nodes"]), F.lit(False)))
    rows = rows.join(template, ["host", "skeleton"], "left").select("id", "url", left.alias("left"))
    size = lambda pieces: F.aggregate(pieces, F.lit(0), lambda n, x: n + F.length(x["texts"]))
    rows = rows.withColumn("own", F.filter("left", lambda x: x["inside"]))
    text = lambda pieces: F.array_join(F.transform(pieces, lambda x: x["texts"]), " ")
    main = F.when((F.size("own") > 0) & (3 * size(F.col("own")) >= size(F.col("left"))), text("own")).otherwise(text("left"))
    return rows.select(F.col("id").alias(id_col), F.col("url").alias(url_col), main.alias("text"))
