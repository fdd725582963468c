"""Main text of web pages: boosted trees over DOM nodes with hierarchical decoding.

A page becomes a tree of elements whose text runs are leaves of their own.  Boosted trees, trained here on
generated pages of many layouts, give each node the log-odds of being main text from subtree density,
attribute tokens, depth and sibling statistics.  Decoding takes the best labelling in which a dropped node's
whole subtree is dropped with it, so no choice contradicts that of an ancestor or descendant.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import Trees, boost
from .common import table

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*+)(?:>|\Z)|[^<]++|<", re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
RAW = frozenset("script style template noscript textarea title iframe svg math object select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
RAW_END = {t: re.compile(f"</{t}", re.I | re.A) for t in RAW}
#: Where an element whose end is missing ends instead: at the next tag of a block.
RECOVER = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK))})(?=[\s/>])", re.I | re.A)
#: Elements that a start tag of the key closes, up to the boundary set.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol menu dl table tbody thead tfoot html body div section article main aside nav".split())

TAGS = ["article main", "section div", "p", "h1", "h2 h3 h4 h5 h6", "ul ol dl menu", "li dt dd", "nav", "header", "footer", "aside", "form", "table tbody thead tr td th", "blockquote pre figure figcaption", "body html", "#text"]
TAG_OF = {t: i for i, g in enumerate(TAGS) for t in g.split()}
PLAIN_TAGS = frozenset("nav header footer aside form".split())
GOOD = frozenset("article articlebody content main post entry story body text maincontent prose document".split())
BAD = frozenset(
    "nav navigation menu footer foot header head sidebar side aside ad ads adv advert advertisement sponsor sponsored promo banner cookie consent notice alert warning comment comments reply replies respond discussion disqus share social related recommended widget breadcrumb breadcrumbs pagination pager toolbar login signup subscribe newsletter form search popup modal overlay legal copyright contentinfo complementary".split()
)
#: Training pages, and the seed of their generator.
PAGES, SEED = 500, 1


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "text", "depth", "label")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children, self.text, self.label = tag, attrs, parent, [], "", 0
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.children.append(self)


def parse(source: str) -> Node:
    """The tree of block elements; inline markup melts into the text runs around it."""
    root = Node("html", "", None)
    at, run, stack = root, [], []  # stack: open inline elements

    def flush():
        if run:
            text = "".join(run)
            run.clear()
            if not text.isspace():
                Node("#text", "", at).text = text

    pos, size, endless = 0, len(source), set()
    while pos < size:
        m = TOKEN.match(source, pos)
        pos = m.end()
        tag = m[2]
        if tag is None:
            c = m[0]
            if not c.startswith("<") or len(c) == 1:
                run.append(c)
            continue
        tag, closing = tag.lower(), m[1]
        if tag in RAW and not closing:
            if not m[3].endswith("/") or tag not in ("svg", "math", "object", "iframe"):
                end = None if tag in endless else RAW_END[tag].search(source, pos)
                if end:
                    pos = source.find(">", end.start()) + 1 or size
                else:
                    endless.add(tag)
                    end = RECOVER.search(source, pos)
                    pos = end.start() if end else size
            continue
        if tag == "br" or tag in VOID:
            run.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag not in BLOCK:
            # A link or inline element matters through its share of the text only.
            run.append("\0" if tag == "a" and not closing else "\1" if tag == "a" else "")
            continue
        flush()
        if closing:
            up = at
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                at = up.parent
            continue
        if tag in ("html", "body") and at is root and tag == "html":
            continue
        if tag in CLOSES:
            up = at
            while up.parent is not None and up.tag not in HOLDS:
                if up.tag in CLOSES[tag]:
                    at = up.parent
                up = up.parent
        elif at.tag == "p":
            at = at.parent
        if tag == "p" or tag in BLOCK:
            up = at
            while up.parent is not None and up.tag not in HOLDS and up.tag not in ("li", "td", "th", "dd", "blockquote", "form", "fieldset", "header", "footer", "figure"):
                if up.tag == "p":
                    at = up.parent
                up = up.parent
        if m[3].endswith("/"):
            continue
        at = Node(tag, m[3], at)
    flush()
    return root


def tokens(attrs: str) -> list[str]:
    if not attrs:
        return []
    return [w for m in ATTRIBUTE.finditer(attrs) for w in re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower()) if w]


def clean(text: str) -> str:
    return " ".join(html.unescape(text.replace("\0", "").replace("\1", "")).split())


def describe(root: Node) -> tuple[list[Node], np.ndarray]:
    """Nodes in page order (parents first) and their features."""
    nodes, stack = [], [root]
    while stack:
        n = stack.pop()
        nodes.append(n)
        stack += n.children[::-1]
    index = {id(n): i for i, n in enumerate(nodes)}
    count = len(nodes)
    parent = [-1] * count
    size, links, marks, inner, leaves = [0] * count, [0] * count, [0] * count, [1] * count, [0] * count
    good, bad, plain = [0] * count, [0] * count, [0] * count
    for i, n in enumerate(nodes):
        p = parent[i] = index[id(n.parent)] if n.parent else -1
        if n.tag == "#text":
            t = n.text
            size[i], leaves[i] = len(t), 1
            marks[i] = t.count(",") + t.count(".")
            if "\0" in t or "\1" in t:
                links[i] = sum(len(x.partition("\1")[0]) for x in t.split("\0")[1:])
        w = tokens(n.attrs)
        good[i] = sum(x in GOOD for x in w)
        bad[i] = sum(x in BAD or x.rstrip("0123456789") in BAD for x in w)
        plain[i] = n.tag in PLAIN_TAGS
    for i in range(count - 1, 0, -1):
        p = parent[i]
        for v in (size, links, marks, inner, leaves):
            v[p] += v[i]
    total = max(1, size[0])
    x = np.zeros((count, 24 + len(TAGS)))
    tags: dict[int, Counter] = {}  # how many children of a parent have each tag
    above_good, above_bad, above_plain, above_article = [0] * count, [0] * count, [0] * count, [0] * count
    for i, n in enumerate(nodes):
        p = parent[i]
        if p >= 0:
            above_good[i], above_bad[i], above_plain[i] = above_good[p] + good[p], above_bad[p] + bad[p], above_plain[p] + plain[p]
            above_article[i] = above_article[p] + (nodes[p].tag in ("article", "main"))
        same = n.parent.children if n.parent else [n]
        k = len(same)
        if p not in tags:
            tags[p] = Counter(c.tag for c in same)
        up = size[p] if p >= 0 else size[0]
        x[i, :24] = (
            n.depth, size[i], size[i] / total, links[i] / max(1, size[i]), marks[i], 100 * marks[i] / max(1, size[i]), inner[i], size[i] / inner[i], leaves[i], size[i] / max(1, leaves[i]),
            k, tags[p][n.tag] / k, size[i] / max(1, up), good[i], bad[i], above_good[i], above_bad[i], above_plain[i], above_article[i],
            links[p] / max(1, size[p]) if p >= 0 else 0, leaves[i] / max(1, leaves[0]), good[p] if p >= 0 else 0, bad[p] if p >= 0 else 0, size[p] / total if p >= 0 else 1,
        )
        x[i, 24 + TAG_OF.get(n.tag, 1)] = 1
    return nodes, x


def decode(nodes: list[Node], logits: np.ndarray) -> list[bool]:
    """The best labelling: dropping a node drops its subtree; a kept node's children may go either way."""
    score = np.clip(logits, -6, 6).tolist()
    index = {id(n): i for i, n in enumerate(nodes)}
    keep, drop, kept = list(score), [-s for s in score], [False] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        p = index[id(nodes[i].parent)]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    kept[0] = True  # the page holds what is kept
    for i in range(1, len(nodes)):
        kept[i] = kept[index[id(nodes[i].parent)]] and keep[i] > drop[i]
    return kept


def text_of(nodes: list[Node], kept: list[bool]) -> str:
    blocks = (clean(n.text) for n, k in zip(nodes, kept, strict=True) if k and n.tag == "#text")
    return "\n\n".join(b for b in blocks if b)


def generated_page(rng: np.random.Generator) -> tuple[str, str]:
    """A page of a random layout and its main text, for training and tests."""

    def word():
        alphabet = ["etaoinshrdlu", "aeiouéèçrlnst", "aeiouñlrsdc", "äöüeinrstch"][language]
        w = "".join(rng.choice(list(alphabet), rng.integers(1, 10)))
        return w + ["", "!!", "***", "$$$", "&amp;&amp;"][junk] if junk else w

    def prose(least, most):
        w = [word() for _ in range(rng.integers(least, most + 1))]
        for i in range(0, len(w), int(rng.integers(5, 15))):
            w[i] = w[i].capitalize()
            if i:
                w[i - 1] += "."
        return " ".join(w)

    language, junk = int(rng.integers(4)), int(rng.integers(0, 5)) if rng.random() < 0.3 else 0
    named = rng.random() < 0.6  # class names or ids on containers
    semantic = rng.random() < 0.7
    name = lambda *of: f' {rng.choice(["class", "id"])}="{rng.choice(of)}{rng.choice(["", "-1", " box", " wide"])}"' if named or not semantic else ""
    wrap = lambda tag, cls, body: f"<{tag if semantic else 'div'}{name(*cls)}>{body}</{tag if semantic else 'div'}>"
    link = lambda: f'<a href="/{word()}">{prose(1, 3)}</a>'
    menu = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.integers(2, 9))) + "</ul>"
    main: list[str] = []

    def block(tag, least, most):
        t = prose(least, most)
        inner, parts = t, t.split(" ")
        if len(parts) > 6 and rng.random() < 0.4:
            inner = " ".join([*parts[:2], f'<a href="/x">{parts[2]}</a>', f"<b>{parts[3]}</b>", *parts[4:]])
        main.append(clean(inner.replace("<b>", "").replace("</b>", "").replace('<a href="/x">', "").replace("</a>", "")))
        return f"<{tag}>{inner}" + ("" if tag == "p" and rng.random() < 0.2 else f"</{tag}>")

    body = [block("h1", 1, 12)]
    for _ in range(int(rng.choice([0, 1, 2, 4, 8, 15]))):
        kind = rng.random()
        if kind < 0.75:
            body.append(block("p", 1, int(rng.choice([3, 20, 80]))))
        elif kind < 0.83:
            body.append(block(str(rng.choice(["h2", "h3"])), 1, 6))
        elif kind < 0.9:
            body.append("<ul>" + "".join(block("li", 2, 15) for _ in range(rng.integers(1, 5))) + "</ul>")
        elif kind < 0.93:
            body.append("<blockquote>" + block("p", 5, 30) + "</blockquote>")
        elif kind < 0.97:
            body.append(f"<div{name('ad', 'advert', 'promo', 'notice', 'share')}>" + prose(2, 12) + "</div>" if named or not semantic else f"<aside>{prose(2, 12)}</aside>")
        else:
            body.append("<table>" + "".join("<tr>" + block("td", 1, 5) + block("td", 1, 5) + "</tr>" for _ in range(2)) + "</table>")
    comments = f'<{"section" if semantic else "div"} class="comments">' + "".join(f'<div class="comment"><p>{prose(2, 40)}</p></div>' for _ in range(rng.integers(1, 5))) + f'</{"section" if semantic else "div"}>'
    inside = rng.random() < 0.2
    article = f"<{'article' if semantic else 'div'}{name('article', 'content', 'post', 'entry', 'story', 'main-content')}>" + "".join(body) + (comments if inside else "") + f"</{'article' if semantic else 'div'}>"
    if rng.random() < 0.4:
        article = f"<main>{article}</main>" if semantic else f'<div id="main">{article}</div>'
    before = [
        wrap("header", ("header", "top", "banner"), prose(1, 6)) if rng.random() < 0.5 else "",
        wrap("nav", ("nav", "menu", "navigation"), menu()) if rng.random() < 0.9 else "",
        f'<div class="{rng.choice(["ad", "ads", "advert", "cookie-notice", "banner", "alert"])}">{prose(2, 25)}</div>' if rng.random() < 0.7 else "",
        f"<form><label>{prose(1, 3)}</label><input><button>{prose(1, 2)}</button></form>" if rng.random() < 0.3 else "",
    ]
    after = [
        wrap("aside", ("sidebar", "related", "widget"), f"<h3>{prose(1, 4)}</h3>" + (menu() if rng.random() < 0.6 else f"<p>{prose(3, 30)}</p>")) if rng.random() < 0.5 else "",
        comments if not inside and rng.random() < 0.4 else "",
        wrap("footer", ("footer", "foot", "copyright"), "&copy; " + prose(1, 20) + (menu() if rng.random() < 0.3 else "")) if rng.random() < 0.9 else "",
    ]
    if rng.random() < 0.2:
        before, after = before + after[:1], after[1:]
    page = f"<!DOCTYPE html><html><head><title>{prose(1, 8)}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>" + "".join(before) + article + "".join(after) + "</body></html>"
    return page, "\n\n".join(x for x in main if x)


def labelled(page: str, main: str) -> tuple[list[Node], np.ndarray, np.ndarray]:
    """Nodes, features and labels: a text run is main if it is one of the main blocks, an element if most of its text is."""
    nodes, x = describe(parse(page))
    wanted = set(main.split("\n\n"))
    own, all_ = np.zeros(len(nodes)), np.zeros(len(nodes))
    index = {id(n): i for i, n in enumerate(nodes)}
    for i in range(len(nodes) - 1, -1, -1):
        n = nodes[i]
        if n.tag == "#text":
            all_[i] = len(n.text)
            own[i] = all_[i] * (clean(n.text) in wanted)
        if n.parent is not None:
            p = index[id(n.parent)]
            own[p] += own[i]
            all_[p] += all_[i]
    return nodes, x, (own > 0.5 * all_).astype(float)


@cache
def train(pages: int = PAGES, seed: int = SEED) -> Trees:
    rng = np.random.default_rng(seed)
    made = [labelled(*generated_page(rng)) for _ in range(pages)]
    return boost(np.concatenate([m[1] for m in made]), np.concatenate([m[2] for m in made]), trees=50, depth=5)


def extract(sources: list[str | None], model: Trees) -> list[str]:
    """Main texts of whole pages; null counts as empty."""
    pages = [describe(parse(s or "")) for s in sources]
    if not pages:
        return []
    logits = model.logits(np.concatenate([x for _, x in pages]))
    out, at = [], 0
    for nodes, _ in pages:
        out.append(text_of(nodes, decode(nodes, logits[at : at + len(nodes)])))
        at += len(nodes)
    return out


def main_text(pages: DataFrame) -> DataFrame:
    """pages (with a column html) plus text string and n_chars long, the text's code points.

    Null and empty pages and pages without main text give an empty text.  Input columns named text or
    n_chars are replaced, other columns stay, html goes; repeated rows give repeated rows.  Pages of any length are
    parsed whole.  An element without an end tag (a script, drawing, list of options and the like) ends at the next
    block.
    """
    model = train()
    shared = pages.sparkSession.sparkContext.broadcast((model.feature, model.threshold, model.leaf, model.base))
    keep = [c for c in pages.columns if c not in ("text", "n_chars", "html")]

    def run(batches):
        trees = Trees(*shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                text = extract(part.column(part.num_columns - 1).to_pylist(), trees)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], [*keep, "text", "n_chars"])

    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")
    return pages.select(*keep, F.col("html").cast("string").alias("__html")).mapInArrow(run, schema)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
