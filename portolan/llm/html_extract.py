"""Main text of web pages by a tree-structured graphical model.

A page is parsed into its block elements.  Every block has a hidden state,
content or not; its features give a potential of its own, and a potential ties
it to its parent.  Sum-product message passing, upward from the leaves and
downward from the root, gives the exact marginals of all blocks.  The weights
are trained by gradient ascent on the likelihood of labelled pages
(`labelled_pages`), the expectations again by message passing.

The text of the blocks whose content marginal is at least one half is the
page's main text, in page order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements (fixed values).  Raw ones hold no markup; hidden ones no page text;
#: void ones no children; the text of inline ones belongs to their block.
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
HIDDEN = frozenset((*RAW, "head", "template", "svg", "select", "option", "button", "datalist", "annotation",
                    "annotation-xml"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
                  "track", "wbr"))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
                    "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong",
                    "sub", "sup", "time", "tt", "u", "var", "ruby", "rt", "rp", "nobr",
                    # formulas, and what stands in for parts that are not shown
                    "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mstyle", "mfrac", "msqrt", "mroot",
                    "msub", "msup", "msubsup", "munder", "mover", "munderover", "mpadded", "mphantom", "menclose",
                    "noscript", "object", "canvas", "audio", "video", "picture"))
CLOSES_P = frozenset(("address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption",
                      "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu",
                      "nav", "ol", "p", "pre", "section", "table", "ul"))
#: An opening tag ends open ones of these names, up to the scope on the right.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")),
        "th": (("td", "th"), ("tr", "table")), "tbody": (("tr", "td", "th", "thead", "tbody"), ("table",)),
        "body": (("head",), ("html",))}
TAGS = ("root", "div", "p", "article", "main", "section", "nav", "header", "footer", "aside", "form", "ul", "ol",
        "li", "h1", "h2", "h3", "table", "td", "blockquote", "pre", "figure", "figcaption", "dialog", "fieldset",
        "address", "dl", "dd", "tr")
#: Parts of class, id and role names by group (fixed values).
NAMES = {
    "menu": ("nav", "navbar", "menu", "breadcrumb", "breadcrumbs", "navigation", "toc", "pagination", "pager", "tabs",
             "skip"),
    "header": ("header", "masthead", "topbar", "logo", "brand", "hdr", "top"),
    "footer": ("footer", "copyright", "colophon", "legal", "bottom", "ftr", "foot"),
    "side": ("sidebar", "aside", "widget", "related", "recommended", "trending", "popular", "rail", "side", "tags",
             "share", "social", "complementary", "more"),
    "notice": ("cookie", "cookies", "notice", "consent", "alert", "gdpr", "popup", "modal", "overlay", "toast",
               "newsletter", "subscribe", "paywall", "message", "dialog"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "adbox",
               "banner-ad", "adsense", "outbrain", "taboola"),
    "comment": ("comment", "comments", "reply", "replies", "respond", "discussion", "disqus", "feedback", "reactions"),
    "form": ("form", "search", "login", "signup", "register", "searchbox"),
    "content": ("content", "article", "post", "entry", "main", "story", "body", "text", "article-body", "post-content",
                "entry-content", "maincontent", "page-content"),
}
_GROUP = {word: group for group, words in NAMES.items() for word in words}
#: Of these, words that name a place: inside an article they say nothing of the kind.
LAYOUT = frozenset(("top", "bottom", "side", "more", "message", "foot"))
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                    r"|<[!?/a-zA-Z][^>]*>?|[^<]+|<", re.S)
_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_ENDED = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


@dataclass
class Page:
    """Block tree: parent, tag, name groups per block; text runs in page order."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    groups: list[frozenset] = field(default_factory=list)
    marks: list[str] = field(default_factory=list)   # attribute text, for training labels
    runs: list[tuple[int, list[str]]] = field(default_factory=list)
    linked: dict[int, int] = field(default_factory=dict)  # characters within links


def parse(html: str) -> Page:
    """Tolerant parse: unknown ends are ignored, missing ones implied."""
    page = Page()
    article: list[bool] = []  # per block: an article, or within one

    def block(parent: int, tag: str, attrs: str) -> int:
        names = [_NAME.findall((m[0] or m[1] or m[2]).lower()) for m in _ATTR.findall(attrs)] if attrs else []
        within = parent >= 0 and article[parent]
        groups = frozenset(_GROUP[w] for ws in names for w in ws if w in _GROUP and not (within and w in LAYOUT))
        page.parent.append(parent)
        page.tag.append(tag)
        page.groups.append(groups)
        page.marks.append(attrs)
        other = bool(groups - {"content"}) or tag in _OTHER_TAGS
        article.append(not other and (within or tag in _CONTENT_TAGS or "content" in groups))
        return len(page.tag) - 1

    root = block(-1, "root", "")
    stack: list[tuple[str, int]] = [("root", root)]  # open elements and their block
    open_count: dict[str, int] = {}
    hidden = links = 0
    fresh = True  # the next text starts a run of its own

    def close(k: int) -> None:
        nonlocal hidden, links, fresh
        for name, _ in stack[k:]:
            open_count[name] -= 1
            hidden -= name in HIDDEN
            links -= name == "a"
            fresh |= name not in INLINE
        del stack[k:]

    at = 0
    while m := _TOKEN.match(html, at):
        at = m.end()
        name = m["name"]
        if name is None:
            text = m.group()
            if text[0] != "<" or text == "<":
                if not hidden:
                    node = stack[-1][1]
                    if fresh or not page.runs or page.runs[-1][0] != node:
                        page.runs.append((node, []))
                        fresh = False
                    page.runs[-1][1].append(text)
                    if links:
                        page.linked[node] = page.linked.get(node, 0) + len(text)
            continue
        name = name.lower()
        if m["end"]:
            if open_count.get(name):
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                # an inline end does not close blocks around it
                if name not in INLINE or all(n in INLINE for n, _ in stack[k:]):
                    close(k)
            continue
        if name == "br" or name == "hr":
            if page.runs and not fresh and not hidden:
                page.runs[-1][1].append(" ")
            fresh |= name == "hr"
            continue
        if name in VOID:
            continue
        if name in CLOSES_P and open_count.get("p"):
            k = len(stack) - 1
            while stack[k][0] != "p":
                k -= 1
            if all(n in INLINE or n == "p" for n, _ in stack[k:]):
                close(k)
        if name in ENDS:
            names, scope = ENDS[name]
            if any(open_count.get(x) for x in names):
                k, found = len(stack) - 1, 0
                while k > 0 and stack[k][0] not in scope:
                    if stack[k][0] in names:
                        found = k
                    k -= 1
                if found:
                    close(found)
        if m["attrs"].endswith("/") and name in ("svg", "path", "math"):
            continue
        if name in ("html", "body"):
            open_count[name] = open_count.get(name, 0) + 1
            stack.append((name, root))
            fresh = True
            continue
        if name in RAW:
            # text without markup, up to its end tag; never page text
            end = _ENDED[name].search(html, at)
            at = end.end() if end else len(html)
            continue
        open_count[name] = open_count.get(name, 0) + 1
        hidden += name in HIDDEN
        links += name == "a"
        if name in INLINE or name in HIDDEN:
            stack.append((name, stack[-1][1]))
        else:
            stack.append((name, block(stack[-1][1], name, m["attrs"])))
            fresh = True
    return page


def run_texts(page: Page) -> list[tuple[int, str]]:
    """(block, text) of the runs that have text: references decoded, white
    space turned into one space, trimmed."""
    out = ((node, " ".join(unescape("".join(parts)).split())) for node, parts in page.runs)
    return [(node, text) for node, text in out if text]


#: Features of a block: tag, names, and its own and its subtree's text by size,
#: share of links and sentences.
COLUMNS = (["bias", *[f"tag={t}" for t in TAGS], *[f"name={g}" for g in NAMES], "plain_name"]
           + [f"own={k}" for k in range(5)] + [f"sub={k}" for k in range(6)] + ["linked", "linked_all", "ends", "late"])
_TAG_AT = {t: 1 + k for k, t in enumerate(TAGS)}
_NAME_AT = {g: 1 + len(TAGS) + k for k, g in enumerate(NAMES)}
_AT = {c: k for k, c in enumerate(COLUMNS)}
#: Kinds of ties to the parent: plain, named as content, named or tagged otherwise.
TIES = 3
_OTHER_TAGS = frozenset(("nav", "header", "footer", "aside", "form", "dialog", "fieldset", "address"))
_CONTENT_TAGS = frozenset(("article", "main"))


def block_features(page: Page, texts: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, tie kind, depth) of every block."""
    n = len(page.tag)
    own, ends = np.zeros(n), np.zeros(n)
    for node, text in texts:
        own[node] += len(text)
        ends[node] += text.count(". ") + (text[-1] in ".!?")
    linked = np.zeros(n)
    for node, size in page.linked.items():
        linked[node] = size
    sub, sub_linked, sub_ends = own.copy(), linked.copy(), ends.copy()
    depth, tie = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for k in range(1, n):
        depth[k] = depth[page.parent[k]] + 1
    for k in range(n - 1, 0, -1):
        p = page.parent[k]
        sub[p] += sub[k]
        sub_linked[p] += sub_linked[k]
        sub_ends[p] += sub_ends[k]
    x = np.zeros((n, len(COLUMNS)))
    x[:, 0] = 1
    for k in range(n):
        t, g = page.tag[k], page.groups[k]
        if t in _TAG_AT:
            x[k, _TAG_AT[t]] = 1
        for name in g:
            x[k, _NAME_AT[name]] = 1
        if (g - {"content"}) or t in _OTHER_TAGS:
            tie[k] = 2
        elif g or t in _CONTENT_TAGS:
            tie[k] = 1
        elif page.marks[k]:
            x[k, _AT["plain_name"]] = 1
    rows = np.arange(n)
    x[rows, _AT["own=0"] + np.digitize(own, (1, 25, 80, 250))] = 1
    x[rows, _AT["sub=0"] + np.digitize(sub, (1, 25, 80, 250, 1000))] = 1
    x[:, _AT["linked"]] = sub_linked / np.maximum(sub, 1) > 0.5
    x[:, _AT["linked_all"]] = np.minimum(sub_linked / np.maximum(sub, 1), 1)
    x[:, _AT["ends"]] = np.minimum(sub_ends, 5) / 5
    x[:, _AT["late"]] = rows / max(n - 1, 1)
    return x, tie, depth


class Forest:
    """The trees of several pages, for messages level by level."""

    def __init__(self, parents: list[np.ndarray], features: list[np.ndarray], ties: list[np.ndarray],
                 depths: list[np.ndarray]) -> None:
        sizes = [len(p) for p in parents]
        base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.bounds = base
        self.parent = np.concatenate([np.where(p < 0, -1, p + b) for p, b in zip(parents, base[:-1], strict=True)])
        self.x, self.tie = np.concatenate(features), np.concatenate(ties)
        depth = np.concatenate(depths)
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(1, int(depth.max()) + 2))
        self.levels = np.split(order, cuts[:-1]) if len(cuts) > 1 else [order]

    def marginals(self, weights: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(content marginal of each block, joint of each block and its parent).

        ``pair[kind, parent state, own state]`` are log potentials."""
        n = len(self.parent)
        up = np.zeros((n, 2))
        up[:, 1] = self.x @ weights
        to_parent = np.zeros((n, 2))
        for level in reversed(self.levels[1:]):
            to_parent[level] = np.logaddexp.reduce(pair[self.tie[level]] + up[level][:, None, :], axis=2)
            np.add.at(up, self.parent[level], to_parent[level])
        down = np.zeros((n, 2))
        joint = np.zeros((n, 2, 2))
        for level in self.levels[1:]:
            p = self.parent[level]
            rest = up[p] + down[p] - to_parent[level]
            down[level] = np.logaddexp.reduce(pair[self.tie[level]] + rest[:, :, None], axis=1)
            both = rest[:, :, None] + pair[self.tie[level]] + up[level][:, None, :]
            both -= np.logaddexp.reduce(both.reshape(len(level), 4), axis=1)[:, None, None]
            joint[level] = np.exp(both)
        total = up + down
        return 1.0 / (1.0 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500))), joint


@dataclass
class Model:
    weights: np.ndarray
    pair: np.ndarray


def fit(pages: list[tuple[Page, np.ndarray]], rounds: int = 300, rate: float = 0.1, ridge: float = 1e-4) -> Model:
    """Weights of highest likelihood on labelled pages (labels per block)."""
    parts = [(np.array(p.parent), *block_features(p, run_texts(p))) for p, _ in pages]
    forest = Forest([p[0] for p in parts], [p[1] for p in parts], [p[2] for p in parts], [p[3] for p in parts])
    gold = np.concatenate([y for _, y in pages]).astype(np.int64)
    inner = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((TIES, 2, 2))
    np.add.at(seen, (forest.tie[inner], gold[forest.parent[inner]], gold[inner]), 1)
    model = Model(np.zeros(forest.x.shape[1]), np.zeros((TIES, 2, 2)))
    values = [model.weights, model.pair]
    state = [np.zeros_like(v) for v in (*values, *values)]
    for step in range(1, rounds + 1):
        content, joint = forest.marginals(model.weights, model.pair)
        expected = np.zeros((TIES, 2, 2))
        np.add.at(expected, forest.tie[inner], joint[inner])
        for k, g in enumerate(((gold - content) @ forest.x, seen - expected)):
            g = g / len(gold) - ridge * values[k]
            m, v = state[k], state[k + 2]
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            values[k] += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return model


# --- the labelled pages -------------------------------------------------------

#: Blocks of generated pages: markup with {t} words, {s} sentences, {l} links,
#: {q} quoted attribute names; an ``!`` marks blocks that are main text.
MENUS = ('<nav><ul>{li}</ul></nav>', '<nav>{l}{l}{l}</nav>', '<div class="navbar"><ul>{li}</ul></div>',
         '<div id="menu">{l} | {l} | {l}</div>', '<ul class="breadcrumbs">{li}</ul>',
         '<header><div class="logo">{t}</div><nav><ul>{li}</ul></nav></header>',
         '<header><h2>{t}</h2><p>{s}</p></header>', '<div class="site-header"><p>{t}</p><p>{s}</p></div>',
         '<div id="masthead"><h1>{t}</h1>{l}</div>')
NOISE = ('<div class="ad">{s}</div>', '<div class="ad">{s}{s}</div>', '<div class="advert"><p>{s}{s}</p></div>',
         '<div class="promo-box"><h3>{t}</h3><p>{s}</p></div>', '<aside><h3>{t}</h3><p>{s}</p><ul>{li}</ul></aside>',
         '<div class="sidebar"><p>{s}{s}</p><ul>{li}</ul></div>', '<div class="widget"><h3>{t}</h3><ul>{li}</ul></div>',
         '<div class="cookie-notice"><p>{s}</p><button>ok</button></div>', '<div class="notice">{s}</div>',
         '<form action="/x"><p>{t}</p><label>{t}</label><input></form>',
         '<div class="newsletter"><form><p>{s}</p></form></div>', '<form class="search"><label>{t}</label></form>',
         '<div class="related"><h3>{t}</h3>{l}{l}</div>', '<div class="share">{l}{l}</div>',
         '<div class="sponsored"><p>{s}{s}{s}</p></div>', '<section class="popup"><p>{s}</p></section>')
BODIES = ('<p!>{s}{s}</p>', '<p!>{s}{s}{s}{s}{s}</p>', '<p!>{s}</p>', '<p!>{t}.', '<h2!>{t}</h2>', '<ul!>{lx}</ul>',
          '<blockquote!><p!>{s}{s}</p></blockquote>', '<div!>{s}{s}{s}</div>', '<pre!>{t} {t}</pre>', '<p!><b>{s}<br>',
          '<table!><tr!><td!>{t}</td><td!>{t}</td></tr></table>', '<p!>{s} {l} {s}</p>', '<h3!>{t}</h3>',
          '<section!><h2!>{t}</h2><p!>{s}{s}</p></section>', '<ol!>{lx}</ol>', '<figure!><figcaption!>{s}</figcaption></figure>')
ARTICLES = ('<article!><h1!>{t}</h1>%s</article>', '<main!><h1!>{t}</h1>%s</main>',
            '<main!><article!><h1!>{t}</h1>%s</article></main>', '<div! class="content"><h1!>{t}</h1>%s</div>',
            '<div! id="main"><div! class="post"><h2!>{t}</h2>%s</div></div>',
            '<article!><header!><h1!>{t}</h1></header>%s</article>', '<div! class="entry-content">%s</div>',
            '<div! class="x1"><h1!>{t}</h1>%s</div>', '<div! class="article-body">%s</div>',
            '<div!><h1!>{t}</h1>%s</div>', '<div!><div!>%s</div></div>', '<h1!>{t}</h1>%s', '%s', '{s}{s}{s}%s')
TAILS = ('<footer>{s}</footer>', '<footer>&copy; {t} &middot; {s}</footer>', '<div class="footer"><p>{s}</p>{l}</div>',
         '<div id="copyright">{t}. {s}</div>', '<footer><nav><ul>{li}</ul></nav><p>{s}</p></footer>')
COMMENTS = ('<section class="comments"><h2>{t}</h2><div class="comment"><p>{s}{s}</p></div><div class="comment">'
            '<p>{s}</p></div></section>', '<div id="comments"><ul><li><p>{s}{s}</p></li><li>{s}</li></ul></div>',
            '<div class="discussion"><div><p>{s}{s}</p></div><div><p>{s}</p></div></div>')
PAGE_COUNT = 1000


def labelled_pages() -> list[tuple[Page, np.ndarray]]:
    """The labelled pages: sites put together from the parts above."""
    rng = np.random.default_rng(6)

    def words(low: int, high: int) -> str:
        return " ".join("x" * int(k) for k in rng.integers(2, 9, rng.integers(low, high)))

    def sentence() -> str:
        long = rng.random() < 0.1
        return words(60, 300) + " " if long else words(5, 25).capitalize() + (". " if rng.random() < 0.6 else " ")

    def fill(part: str) -> str:
        def one(m: re.Match) -> str:
            return {"t": lambda: words(1, 7), "s": sentence,
                    "l": lambda: f'<a href="/y">{words(1, 4)}</a>',
                    "li": lambda: "".join(f'<li><a href="/y">{words(1, 4)}</a></li>' for _ in range(rng.integers(2, 8))),
                    "lx": lambda: "".join(f"<li!>{words(3, 15)}.</li>" for _ in range(rng.integers(2, 6)))}[m[1]]()
        return re.sub(r"\{(t|s|l|li|lx)\}", one, part)

    def pick(parts: tuple[str, ...], low: int, high: int) -> str:
        return "".join(parts[rng.integers(len(parts))] for _ in range(rng.integers(low, high)))

    out = []
    for _ in range(PAGE_COUNT):
        inner = "".join(BODIES[rng.integers(len(BODIES))] if rng.random() < 0.9 else NOISE[rng.integers(len(NOISE))]
                        for _ in range(rng.integers(1, 8) if rng.random() < 0.5 else rng.integers(1, 20)))
        body, bare = ARTICLES[rng.integers(len(ARTICLES))], rng.random() < 0.3
        if rng.random() < 0.4:  # most sites name the article as such
            body = ARTICLES[rng.integers(3)]
        around = ["", "", "", "", ""] if bare else [pick(MENUS, 0, 3), pick(NOISE, 0, 3), pick(COMMENTS, 0, 2),
                                                    pick(NOISE, 0, 3), pick(TAILS, 0, 2)]
        if bare and rng.random() < 0.4:
            body = inner = "{s}{s}{s}"
        html = ("<html><head><title>x</title></head><body>" + "".join(around[:2])
                + (body % inner if "%s" in body else body) + "".join(around[2:]) + "</body></html>")
        html = re.sub(r"<([a-z0-9]+)!", r"<\1 data-y", fill(html))
        page = parse(html)
        labels = np.array(["data-y" in m for m in page.marks])
        labels[0] = body[0] in "%{" or body.startswith("<h1")  # the main text lies in the root itself
        page.marks = [m.replace("data-y", "").strip() for m in page.marks]
        out.append((page, labels))
    return out


@cache
def trained() -> Model:
    return fit(labelled_pages())


#: Blocks whose messages are passed together.
TOGETHER = 20_000


def extract(pages: list[str], model: Model) -> list[str]:
    """Main text of each page."""
    out: list[str] = []
    waiting: list[tuple[Page, list[tuple[int, str]]]] = []

    def settle() -> None:
        if not waiting:
            return
        parts = [(np.array(p.parent), *block_features(p, texts)) for p, texts in waiting]
        forest = Forest([p[0] for p in parts], [p[1] for p in parts], [p[2] for p in parts], [p[3] for p in parts])
        content = forest.marginals(model.weights, model.pair)[0] >= 0.5
        for (_, texts), start in zip(waiting, forest.bounds[:-1], strict=True):
            out.append(" ".join(text for node, text in texts if content[start + node]))
        waiting.clear()

    blocks = 0
    for html in pages:
        page = parse(html)
        waiting.append((page, run_texts(page)))
        blocks += len(page.tag)
        if blocks >= TOGETHER:
            settle()
            blocks = 0
    settle()
    return out


def main_text(pages: DataFrame, id_cols: list[str], html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``id_cols`` and the main text of every page, empty where there is none.

    Null and empty pages have no text; text without any markup counts as the
    body of a page; repeated rows keep a row each; other columns are not read.
    """
    model = trained()

    def run(batches):
        for batch in batches:
            html = batch.column(batch.num_columns - 1)
            for k in range(0, batch.num_rows, 200):
                texts = extract([x.as_py() or "" for x in html.slice(k, 200)], model)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(k, 200) for c in batch.columns[:-1]] + [pa.array(texts, type=pa.string())],
                    names=[*batch.schema.names[:-1], out_col])

    base = pages.select(*[F.col(f"`{c}`") for c in id_cols], F.col(f"`{html_col}`").cast("string").alias("_html"))
    schema = base.drop("_html").withColumn(out_col, F.lit("").cast("string")).schema
    return base.mapInArrow(run, schema)
