"""Main-text extraction: boosted trees over DOM nodes, decoded over the tree (operator 1).

Each page is parsed into a tree of elements. A gradient-boosted ensemble (``pyspark.ml``) gives
every node the probability of being part of the article from its tag, attribute tokens, depth,
subtree density and sibling statistics. The decoding picks the labelling of the whole tree with
the largest likelihood in which nothing below a dropped node is kept, so ancestors and
descendants never contradict each other.

The ensemble is fitted on a bounded sample: the ``sample_pages`` pages of the smallest id hash
(and one fixed seed page). Their labels come from pages that mark their article by an
``article`` or ``main`` element; each also yields variants in which the marking is replaced by
other containers and known kinds of boilerplate (side bars, notices, comments, forms, ...) are
put in, so that the trees learn features and not one template.

Text rules: character references are decoded, white space inside a block becomes one space,
blocks (text between block-level element edges) are joined by one line feed in page order.

Defined results: null or empty html gives the empty text; unclosed and stray tags are tolerated;
a "<" that opens no tag is text; a page without any markup is one block; repeated rows are
extracted alike; an empty table gives an empty result; columns named like an output are replaced.
"""

from __future__ import annotations

import html as html_lib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrisk.llm.common import map_arrow, materialize, project_columns

SAMPLE_PAGES = 200
TREES, DEPTH = 20, 4

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option "
                  "p pre section select summary table tbody td tfoot th thead title tr ul".split())
UNSEEN = frozenset("head script style noscript template title textarea select option button svg math iframe object "
                   "canvas audio video datalist".split())
RAW = re.compile(r"</(script|style|textarea|title|noscript|template|iframe)\s*>", re.I)
ENDS_PARAGRAPH = BLOCK - frozenset("option optgroup tbody td tfoot th thead tr head title body html".split())
# Elements that a start tag of the same group closes, and where the search for one stops.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Attribute tokens that speak for and against an article.
BOILER_TOKENS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments "
    "commentlist consent cookie cookies copyright dialog discussion disqus footer form gdpr header hidden legal login "
    "masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination popup privacy "
    "promo promotion recommended related replies reply respond response reviews search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe tagcloud tags toc toolbar topbar widget".split())
BODY_TOKENS = frozenset("article articlebody body content entry main post prose story text".split())
BOILER_TAGS = frozenset("aside dialog fieldset footer form header menu nav".split())
BODY_TAGS = frozenset("article main".split())
TEXT_TAGS = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())

FEATURES = ("boiler_tag", "body_tag", "text_tag", "inline", "heading", "list", "boiler_tokens", "body_tokens",
            "above_boiler_tag", "above_boiler_token", "above_body_tag", "above_body_token", "depth", "below_body",
            "chars", "link_share", "tags_per_char", "stops_per_char", "children", "siblings", "sibling_place",
            "share_of_parent", "like_siblings", "holds_body", "holds_boiler")


class Page:
    """Elements of one page in document order, as parallel lists, and its text pieces."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attrs = ["#page"], [-1], [""]
        self.pieces: list[tuple[int, str]] = []     # (element, text); element -1 is a block edge
        self._parse(source)

    def _open(self, tag: str, parent: int, attrs: str) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.attrs.append(attrs)
        return len(self.tag) - 1

    def _parse(self, source: str) -> None:
        stack, pieces, at = [0], self.pieces, 0
        edge = (-1, "")
        still_open: dict[str, int] = {}

        def pop():
            t = self.tag[stack.pop()]
            still_open[t] -= 1
            if t in BLOCK:
                pieces.append(edge)

        def close_until(names, stops):
            if not any(still_open.get(x) for x in names):
                return
            for k in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[k]]
                if t in names:
                    while len(stack) > k:
                        pop()
                    return
                if t in stops:
                    return
        position = 0
        while True:
            m = TAG.search(source, position)
            if m is None:
                break
            if m.start() > at:
                pieces.append((stack[-1], source[at:m.start()]))
            at = position = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            if m.group(1):
                if name == "p" and not still_open.get("p"):
                    pieces.append(edge)
                elif name == "br":
                    pieces.append((stack[-1], " "))
                else:
                    close_until({name}, ())
                continue
            if name in ENDS_PARAGRAPH:
                close_until({"p"}, {"table", "td", "th", "button", "body", "html"})
            if name in CLOSES:
                close_until(*CLOSES[name])
                if name == "tr":
                    close_until({"tr"}, {"table"})
            if name in BLOCK:
                pieces.append(edge)
            node = self._open(name, stack[-1], m.group(3))
            if name in VOID:
                if name == "br":
                    pieces.append((stack[-1], " "))
                continue
            if name in ("script", "style", "textarea", "title", "noscript", "template", "iframe"):
                end = next((x for x in RAW.finditer(source, at) if x.group(1).lower() == name), None)
                at = position = end.end() if end else len(source)
                if name in BLOCK:
                    pieces.append(edge)
                continue
            if not m.group(3).rstrip().endswith("/") or name not in ("path", "use", "circle", "rect", "g"):
                stack.append(node)
                still_open[name] = still_open.get(name, 0) + 1
        if at < len(source):
            pieces.append((stack[-1], source[at:]))

    def text(self, kept) -> str:
        """Blocks of the kept elements."""
        blocks, run = [], []
        for node, piece in self.pieces:
            if node < 0:
                if run:
                    blocks.append("".join(run))
                    run = []
            elif kept[node]:
                run.append(piece)
        if run:
            blocks.append("".join(run))
        blocks = (" ".join(html_lib.unescape(b).split()) for b in blocks)
        return "\n".join(b for b in blocks if b)


def _tokens(attrs: str) -> tuple[int, int]:
    """Attribute tokens against and for an article."""
    if "=" not in attrs:
        return 0, 0
    boiler = body = 0
    for _, value in ATTRIBUTE.findall(attrs):
        for t in TOKEN.findall(value):
            t = t.lower()
            boiler += t in BOILER_TOKENS
            body += t in BODY_TOKENS
    return boiler, body


def features(page: Page) -> np.ndarray:
    """One row of FEATURES per element."""
    tag, parent = page.tag, page.parent
    n = len(tag)
    chars, links, stops, inner = [0] * n, [0] * n, [0] * n, [1] * n
    for node, piece in page.pieces:
        if node >= 0:
            k = len(piece)
            chars[node] += k
            stops[node] += piece.count(".") + piece.count(",")
    children: list[list[int]] = [[] for _ in range(n)]
    in_link = [False] * n
    for i in range(1, n):
        children[parent[i]].append(i)
        in_link[i] = in_link[parent[i]] or tag[i] == "a"
        if in_link[i]:
            links[i] = chars[i]
    tokens = [_tokens(a) for a in page.attrs]
    holds_body, holds_boiler = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        stops[p] += stops[i]
        inner[p] += inner[i]
        holds_body[p] |= holds_body[i] or tag[i] in BODY_TAGS or (tokens[i][1] > 0 and not tokens[i][0])
        holds_boiler[p] |= holds_boiler[i] or tag[i] in BOILER_TAGS or tokens[i][0] > 0
    out = np.zeros((n, len(FEATURES)))
    above = [(0, 0, 0, 0, 0, -1)] * n
    place = [0] * n
    for kids in children:
        for k, i in enumerate(kids):
            place[i] = k
    for i in range(n):
        t = tag[i]
        if i:
            bt, bk, mt, mk, d, bd = above[parent[i]]
            pt, (pb, pm) = tag[parent[i]], tokens[parent[i]]
            above[i] = (bt or pt in BOILER_TAGS, bk or pb > 0, mt or pt in BODY_TAGS, mk or (pm > 0 and not pb),
                        d + 1, 0 if pt in BODY_TAGS else bd + 1 if bd >= 0 else -1)
        bt, bk, mt, mk, d, bd = above[i]
        c = max(chars[i], 1)
        family = children[parent[i]] if i else [0]
        out[i] = (t in BOILER_TAGS, t in BODY_TAGS, t in TEXT_TAGS, t not in BLOCK, t[:1] == "h" and t[1:].isdigit(),
                  t in ("ul", "ol", "dl"), tokens[i][0], tokens[i][1], bt, bk, mt, mk, min(d, 20), min(bd, 20),
                  math.log1p(chars[i]), links[i] / c, inner[i] / c, stops[i] / c, len(children[i]), len(family),
                  place[i] / len(family), chars[i] / max(chars[parent[i]], 1) if i else 1.0,
                  sum(tag[x] == t for x in family[max(0, place[i] - 8):place[i] + 9]), holds_body[i], holds_boiler[i])
    return out


def decode(page: Page, p: np.ndarray) -> list[bool]:
    """Most likely labelling in which a kept element has kept ancestors only."""
    n = len(page.tag)
    log_p, log_q = np.log(p).tolist(), np.log1p(-p).tolist()
    keep, drop, best = log_p[:], log_q[:], [0.0] * n
    for i in range(n - 1, 0, -1):
        if page.tag[i] in UNSEEN:
            keep[i] = -math.inf
        best[i] = max(keep[i], drop[i])
        keep[page.parent[i]] += best[i]
        drop[page.parent[i]] += drop[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and keep[i] >= drop[i]
    return kept


# ---- training --------------------------------------------------------------------------------

SEED_PAGE = ("<html><head><title>t</title></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article>"
             "<h1>On rivers</h1><p>Rivers carve valleys, and they do so slowly.</p><p>Some run dry, others flood.</p>"
             "<p>Short.</p></article><footer>All rights reserved.</footer></body></html>")
# Boilerplate put into training variants; {s} is a short and {l} a long text of the page.
BEFORE = ('<header class="site-header"><a href="/">{s}</a><p>{s}</p></header>', '<div id="cookie-notice">{l}</div>',
          '<div class="banner"><p>{s}</p></div>', '<div class="breadcrumbs"><a href="/a">{s}</a></div>',
          '<aside class="sidebar"><h2>{s}</h2><p>{l}</p></aside>', '<form><label>{s}</label><input></form>',
          '<div class="navbar"><ul><li><a href="/b">{s}</a></li></ul></div>', '<aside><p>{l}</p></aside>')
AFTER = ('<section class="comments"><h3>{s}</h3><div class="comment"><p>{l}</p></div><div class="comment"><p>{s}</p></div>'
         '</section>', '<div id="comments"><ol><li><p>{l}</p></li></ol></div>', '<div class="related-posts"><p>{s}</p></div>',
         '<ul class="share"><li><a href="/c">{s}</a></li></ul>', '<form class="newsletter"><p>{l}</p></form>',
         '<div class="advert"><p>{l}</p></div>', '<div class="widget">{l}</div>', '<div class="ad">{s}</div>',
         '<div class="popup-notice"><p>{s}</p></div>', '<footer><p>{l}</p></footer>')
CONTAINERS = (("<article>", "</article>"), ('<div class="post-content">', "</div>"), ("<main>", "</main>"),
              ('<div id="content"><div class="entry">', "</div></div>"), ("<div>", "</div>"),
              ("<section>", "</section>"), ("", ""))
ARTICLE = re.compile(r"<(article|main)\b[^>]*>(.*?)(?:</\1\s*>|\Z)", re.S | re.I)


MARK = re.compile(r"\bdata-y=\"([01])\"")     # label of an element and what it holds, in training pages only


def _marked(markup: str, label: int) -> str:
    return re.sub(r"^<(\w+)", rf'<\1 data-y="{label}"', markup, count=1)


def training_pages(source: str, number: int) -> list[str]:
    """The page and two variants with their articles marked; none if the page does not tell its article."""
    m = ARTICLE.search(source)
    if m is None:
        return []
    body = m.group(2)
    words = re.sub(r"<[^>]*>", " ", body).split()
    head, tail = source[:m.start()], source[m.end():]
    out = [head + _marked(m.group(0), 1) + tail]
    for v in range(2):
        k = 2 * number + v
        start, end = CONTAINERS[k % len(CONTAINERS)]
        short, long = " ".join(words[:3 + k % 9]), " ".join(words[-40:])

        def put(forms, count):
            return "".join(_marked(forms[(3 * k + j) % len(forms)].replace("{s}", short).replace("{l}", long), 0)
                           for j in range(count))
        inside = put(AFTER, 2) if k % 3 == 0 else ""
        # Without a container each element of the article is marked.
        text = body if start else re.sub(r"<(p|h[1-6]|ul|ol|table|blockquote|pre)\b", r'<\1 data-y="1"', body)
        out.append(head + put(BEFORE, 3) + _marked(start, 1) + text + inside + end + put(AFTER, 3) + tail)
    return out


def training_labels(page: Page) -> list[int]:
    """1: in the article or around it. Marked parts decide for what they hold; so do elements of the
    article whose tokens speak against it."""
    n = len(page.tag)
    label, holds = [-1] * n, [0] * n
    for i in range(1, n):
        m = MARK.search(page.attrs[i])
        label[i] = int(m.group(1)) if m else label[page.parent[i]]
        if label[i] == 1 and not m:
            boiler, body = _tokens(page.attrs[i])
            label[i] = 0 if boiler and not body else 1
    for i in range(n - 1, 0, -1):
        holds[page.parent[i]] |= holds[i] or label[i] == 1
    return [x if x >= 0 else holds[i] for i, x in enumerate(label)]


def training_rows(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """(label, features) of every element of the training pages."""
    key = F.xxhash64("page_id")
    sample = pages.filter(F.lower("html").rlike("<(article|main)\\b")).select("html", key.alias("k")).orderBy(
        "k", "html").limit(sample_pages)
    seed = pages.sparkSession.range(1).select(F.lit(SEED_PAGE).alias("html"), F.lit(0).cast("long").alias("k"))

    def run(batches):
        for b in batches:
            label, rows = [], []
            for source, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for text in training_pages(source, k % 1000):
                    page = Page(text)
                    seen = [i for i in range(1, len(page.tag)) if page.tag[i] not in UNSEEN]
                    y = training_labels(page)
                    label += [float(y[i]) for i in seen]
                    rows += features(page)[seen].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.float64()), pa.array(rows, pa.list_(pa.float64()))],
                                             names=["label", "x"])
    rows = map_arrow(sample.unionByName(seed), run, "label double, x array<double>")
    return materialize(rows, "dom-nodes").select("label", array_to_vector("x").alias("features"))


def _tree(lines: list[str], nodes: list[tuple]) -> int:
    """One printed tree, depth first: (feature, threshold, left, right, value) per node."""
    line = lines.pop(0).strip()
    at = len(nodes)
    nodes.append(None)
    if line.startswith("Predict:"):
        nodes[at] = (0, 0.0, at, at, float(line.split(":")[1]))
        return at
    m = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
    left = _tree(lines, nodes)
    lines.pop(0)                       # Else (...)
    right = _tree(lines, nodes)
    nodes[at] = (int(m.group(1)), float(m.group(2)), left, right, 0.0)
    return at


class Ensemble:
    """The fitted trees as arrays, so that tasks score nodes without a Spark session."""

    def __init__(self, model):
        self.trees = []
        for tree, weight in zip(model.trees, model.treeWeights):
            nodes: list[tuple] = []
            _tree(tree.toDebugString.splitlines()[1:], nodes)
            f, t, left, right, value = map(np.array, zip(*nodes))
            self.trees.append((f, t, left, right, value * weight))

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, t, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = np.where(x[rows, f[at]] <= t[at], left[at], right[at])
            total += value[at]
        return np.clip(1 / (1 + np.exp(-2 * total)), 1e-6, 1 - 1e-6)


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Ensemble:
    gbt = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=32)
    return Ensemble(gbt.fit(training_rows(pages, sample_pages)))


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    model = pages.sparkSession.sparkContext.broadcast(fit(pages, sample_pages))
    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]

    def make():
        ensemble = model.value

        def fn(sources):
            texts = []
            for lo in range(0, len(sources), 256):
                parsed = [Page(s or "") for s in sources[lo:lo + 256]]
                rows = [features(p) for p in parsed]
                p = ensemble.probability(np.concatenate(rows))
                at = 0
                for page, x in zip(parsed, rows):
                    texts.append(page.text(decode(page, p[at:at + len(x)])))
                    at += len(x)
            return [texts, list(map(len, texts))]
        return fn
    return project_columns(pages, ["page_id", "url"], ["html"], fields, make)
