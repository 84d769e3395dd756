"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded as a tree.

Each element with text below it gets features: its tag and those above, tokens of class, id
and role, depth, size and link density of its subtree, and how it compares with its siblings.
Boosted trees give the chance that it holds main text.  Decoding then picks the most likely
set of elements in which nothing is kept below an element that is left out.

Training needs no labelled pages.  A bounded sample (``TRAIN_PAGES``) of the given pages is
read for pages whose main element is plain to see (``article`` or ``main``).  Their
paragraphs are set into page layouts with menus, sidebars, notices, comments and so on, with
and without telling names, so that the trees learn from shape as well as from names.  Spark
MLlib fits them; the fitted trees are small arrays and go to the tasks.

Text: character references are decoded, white space in a block becomes one space, blocks are
joined by line breaks in page order.  What browsers read as raw text (scripts, styles and so
on), templates, selections and sources of formulas are no text; formulas and drawings are part
of the line they stand in.  Nothing else is dropped or cut.

A page is read in time linear in its length, however broken its markup is.

Defined results: a null or empty page has an empty text; unclosed and stray tags are taken
as browsers take them, roughly; without any page to learn from, the layouts alone are the
training data (filled with stand-in sentences); repeated pages each get their row.  Input
columns named like a result column are replaced.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import Written, bounded_batches

TRAIN_PAGES = 240
TREES, DEPTH = 40, 5

# --- fixed values: names of HTML, and common words in class, id and role ------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea select title head annotation annotation-xml".split())
GOES_ON = frozenset("select annotation annotation-xml".split())  # skipped, but without an end only the tag is
FALLBACK = frozenset("object audio video canvas".split())  # may stand in a paragraph
FOREIGN = frozenset(
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder"
    " mover munderover mmultiscripts mprescripts mtable mtr mtd semantics svg g defs path rect circle ellipse line polyline polygon"
    " text tspan textpath use symbol desc lineargradient radialgradient stop clippath mask pattern marker image foreignobject".split()
)
INLINE = FOREIGN | frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var wbr".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]), "p": frozenset(["p"]),
}
TAGS = ("nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol",
        "li", "table", "td", "blockquote", "pre", "body", "button", "dialog", "figure")
OUTSIDE = frozenset(
    "ad ads advert advertisement adverts advertising alert aside banner bar breadcrumb breadcrumbs byline categories comment comments"
    " complementary consent contentinfo cookie cookies copyright dialog discussion disqus dropdown footer form gdpr hero legal links"
    " login masthead menu meta modal nav navbar navigation newsletter notice notification pager pagination popup privacy promo"
    " promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored"
    " subscribe tags toc toolbar topbar warning widget widgets".split()
)
INSIDE = frozenset("article body content entry main post story text page prose".split())
# -------------------------------------------------------------------------------------------
_TALK = frozenset(["comment", "comments", "discussion", "disqus", "replies", "reply", "respond"])

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[>\"']")
_MARKUP = re.compile("<[!?/]")
_NAMED = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "parent", "depth", "tokens", "hidden", "children", "chars", "link_chars", "stops", "n_tags", "n_links", "n_p", "n_inputs", "order")

    def __init__(self, tag: str, parent: int, depth: int, attributes: str):
        self.tag, self.parent, self.depth = tag, parent, depth
        self.children: list[int] = []
        self.chars = self.link_chars = self.stops = self.n_tags = self.n_links = self.n_p = self.n_inputs = 0
        self.tokens, self.hidden = frozenset(), False
        if attributes.strip():
            words = set()
            for name, value in _NAMED.findall(attributes):
                name, value = name.lower(), value.strip("\"'")
                if name in ("class", "id", "role"):
                    words.update(w.lower() for w in _WORD.findall(value))
                elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                    self.hidden = True
                elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    self.hidden = True
            self.tokens = frozenset(words)


class Tokens:
    """The markup of a page, from left to right, in time linear in its length.

    ``next(at)`` gives (start, end, closing, tag, attributes) of the next piece of markup; tag is None for
    comments and the like.  A ``<`` that begins nothing is text.  Attributes end at the first
    ``>`` outside quotes.  Where a quote is never closed, quotes count no longer from there on, and a
    tag ends at the first ``>``; behind the last ``>`` no tag can end, which is known beforehand.
    Nothing is searched for twice: what is not found is not there later either.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.quotes = {q: page.rfind(q) for q in "\"'"}
        self.quoted, self.absent = True, set()

    def next(self, at: int):
        page = self.page
        while True:
            start = page.find("<", at)
            if start < 0 or start > self.last:
                rest = _MARKUP.search(page, start) if start >= 0 else None
                return (rest.start(), len(page), "", None, "") if rest else None
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), "", None, ""
            closing = "/" if page.startswith("/", start + 1) else ""
            name = _NAME.match(page, start + 1 + len(closing))
            if name:
                end = self._end(name.end())
                return start, end + 1, closing, name[0].lower(), page[name.end() : end]
            if page[start + 1] in "!?/":
                end = page.find(">", start + 2)
                return start, end + 1 if end >= 0 else len(page), "", None, ""
            at = start + 1

    def _end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag; there is one, ``at`` is not behind the last."""
        first = here = at
        while self.quoted:
            stop = _STOP.search(self.page, here)
            if stop is None:
                self.quoted = False
            elif stop[0] == ">":
                return stop.start()
            elif self.quotes[stop[0]] <= stop.start():
                break  # never closed, and known without a search
            else:
                here = self.page.find(stop[0], stop.end()) + 1
                self.quoted = here <= self.last
        return self.page.find(">", first)

    def after(self, pattern: str, at: int) -> re.Match | None:
        """The next match from ``at`` on; a pattern that is not found is not looked for again."""
        if pattern in self.absent:
            return None
        found = re.compile(pattern, re.I).search(self.page, at)
        if found is None:
            self.absent.add(pattern)
        return found


class Open:
    """The elements that are open, with the places of each name in the stack."""

    def __init__(self):
        self.nodes: list[int] = []
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}

    def push(self, node: int, name: str) -> None:
        self.places.setdefault(name, []).append(len(self.nodes))
        self.nodes.append(node)
        self.names.append(name)

    def close_from(self, place: int) -> None:
        while len(self.nodes) > place:
            self.nodes.pop()
            self.places[self.names.pop()].pop()

    def last(self, names) -> int:
        """The highest place of one of the names, 0 if none is open below the body."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)


#: Of each tag in CLOSED_BY, the elements beyond which it closes nothing.
_BARRIERS = {tag: frozenset(["ul", "ol", "table", "dl", "tr"]) - closed - {tag} for tag, closed in CLOSED_BY.items()}


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Elements that are not inline, and (element, text) of the text runs in page order.

    A text run ends where a block begins or ends; what stands in it has its references
    decoded and its white space made single.  Takes time linear in the page's length.
    """
    nodes = [Node("html", -1, 0, ""), Node("body", 0, 1, "")]
    nodes[0].children.append(1)
    opened, inline = Open(), Counter()
    opened.push(0, "html")
    opened.push(1, "body")
    runs: list[tuple[int, str]] = []
    pending: list[str] = []
    linked = [0]

    def flush() -> None:
        text = " ".join(html.unescape("".join(pending)).split()) if pending else ""
        pending.clear()
        if text:
            runs.append((opened.nodes[-1], text))
            own = nodes[opened.nodes[-1]]
            own.chars += len(text)
            own.link_chars += min(len(text), linked[0])
            own.stops += text.count(".") + text.count(",") + text.count("?") + text.count("!")
        linked[0] = 0

    tokens = Tokens(page)
    at, n = 0, len(page)
    while at < n:
        found = tokens.next(at)
        if found is None:
            pending.append(page[at:])
            break
        start, end, closing, tag, attributes = found
        piece = page[at:start]
        at = end
        if piece:
            pending.append(piece)
            if inline["a"]:
                linked[0] += len(piece)
        if tag is None:
            continue
        if closing:
            if tag in INLINE:
                if inline[tag]:
                    inline[tag] -= 1
                continue
            flush()
            inline.clear()
            place = opened.last([tag])
            if place > 1:
                opened.close_from(place)
            continue
        if tag in RAW:
            if tag != "head" and not attributes.endswith("/"):
                stop = tokens.after(rf"</{tag}\s*>", at)
                at = stop.end() if stop else at if tag in GOES_ON else n
            if tag == "head":
                stop = tokens.after(r"</head\s*>|<body\b", at)
                if stop:
                    at = stop.start() if stop[0].lower().startswith("<body") else stop.end()
            pending.append(" ")
            continue
        above = opened.nodes[-1]
        if tag in INLINE:
            if tag in FOREIGN:
                continue
            nodes[above].n_tags += 1
            if tag == "br":
                pending.append(" ")
            elif tag == "a":
                nodes[above].n_links += 1
            if tag not in VOID:
                if tag == "a" and inline["a"]:
                    inline["a"] -= 1
                inline[tag] += 1
            continue
        flush()
        if tag in VOID:
            nodes[above].n_inputs += tag == "input"
            continue
        if tag in ("html", "body"):  # both are there from the start
            continue
        inline.clear()
        if opened.names[-1] == "p" and tag not in FALLBACK:  # a block ends a paragraph
            opened.close_from(len(opened.nodes) - 1)
        if tag in CLOSED_BY:
            place = opened.last(CLOSED_BY[tag])
            if place > opened.last(_BARRIERS[tag]):
                opened.close_from(place)
        above = opened.nodes[-1]
        node = Node(tag, above, nodes[above].depth + 1, attributes)
        nodes[above].children.append(len(nodes))
        node.n_tags = 1
        node.n_p = int(tag == "p")
        node.n_inputs = int(tag == "button")
        opened.push(len(nodes), tag)
        nodes.append(node)
        if attributes.endswith("/") and tag not in TAGS:
            opened.close_from(len(opened.nodes) - 1)
    flush()
    for k in range(len(nodes) - 1, 0, -1):  # children follow their parents
        a, b = nodes[nodes[k].parent], nodes[k]
        a.chars += b.chars
        a.link_chars += b.link_chars
        a.stops += b.stops
        a.n_tags += b.n_tags
        a.n_links += b.n_links
        a.n_p += b.n_p
        a.n_inputs += b.n_inputs
    return nodes, runs


FEATURES = (
    *(f"tag_{t}" for t in TAGS), "outside", "inside", "talk", "hidden", "above_outside", "above_inside", "above_talk",
    "in_article", "in_chrome", "in_form", "depth", "log_chars", "share", "link_density", "links", "stop_density", "chars_per_tag",
    "paragraphs", "inputs", "children", "siblings", "place", "share_of_siblings", "largest_sibling", "sibling_links", "has_article",
)


def features(nodes: list[Node]) -> tuple[list[int], np.ndarray]:
    """Elements with text, and one row of features for each."""
    total = max(1, nodes[0].chars)
    own = [k for k, x in enumerate(nodes) if x.chars and k]
    article = {k for k, x in enumerate(nodes) if x.tag in ("article", "main")}
    has_article = float(bool(article))
    state: dict[int, tuple] = {0: (0, 0, 0, 0, 0, 0)}
    rows = []
    near: dict[int, tuple] = {}  # of a parent's children with text: number, chars, most chars, link chars
    place: dict[int, int] = {}
    for k, x in enumerate(nodes):
        own_children = [c for c in x.children if nodes[c].chars]
        place.update((c, i) for i, c in enumerate(own_children))
        if own_children:
            chars = [nodes[c].chars for c in own_children]
            near[k] = (len(chars), sum(chars), max(chars), sum(nodes[c].link_chars for c in own_children))
    for k in range(1, len(nodes)):
        x = nodes[k]
        up = state[x.parent]
        outside, inside, talk = len(x.tokens & OUTSIDE), len(x.tokens & INSIDE), len(x.tokens & _TALK)
        chrome = x.tag in ("nav", "footer", "aside", "dialog") or (x.tag == "header" and not up[3])
        state[k] = (
            up[0] + outside, up[1] + inside, up[2] + talk, up[3] + (x.tag in ("article", "main")), up[4] + chrome, up[5] + (x.tag == "form"),
        )
        if not x.chars:
            continue
        n, chars, most, links = near[x.parent]
        rows.append(
            [float(x.tag == t) for t in TAGS]
            + [
                outside, inside, talk, x.hidden, *up, x.depth, math.log1p(x.chars), x.chars / total, x.link_chars / x.chars,
                x.n_links, 100 * x.stops / x.chars, x.chars / max(1, x.n_tags), x.n_p, x.n_inputs, len(x.children), n,
                place[k] / max(1, n - 1), x.chars / chars, x.chars / most, links / chars, has_article,
            ]
        )
    return own, np.array(rows, np.float32).reshape(len(own), len(FEATURES))


def decode(nodes: list[Node], own: list[int], chance: np.ndarray) -> set[int]:
    """Kept elements: the most likely choice in which all elements above a kept one are kept."""
    chance = np.clip(chance, 1e-4, 1 - 1e-4)
    keep = dict(zip(own, np.log(chance).tolist()))
    drop = dict(zip(own, np.log1p(-chance).tolist()))
    best, without, choice = {}, {}, {}
    for k in range(len(nodes) - 1, -1, -1):
        children = [c for c in nodes[k].children if c in keep]
        without[k] = drop.get(k, 0.0) + sum(without[c] for c in children)
        with_it = keep.get(k, 0.0) + sum(best[c] for c in children)
        choice[k] = with_it > without[k] or k == 0
        best[k] = max(with_it, without[k])
    kept = {0}
    for k in own:
        if nodes[k].parent in kept and choice[k]:
            kept.add(k)
    return kept


class Trees:
    """Fitted trees as arrays; a leaf points to itself."""

    def __init__(self, trees: list[tuple], weights: list[float]):
        self.trees, self.weights = trees, weights

    def chance(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        for (feature, limit, low, high, value), weight in zip(self.trees, self.weights):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = np.where(x[np.arange(len(x)), feature[at]] <= limit[at], low[at], high[at])
            margin += weight * value[at]
        return 1 / (1 + np.exp(-2 * margin))


def _arrays(model) -> Trees:
    out = []
    for tree in model._java_obj.trees():
        rows: list[list] = []

        def add(node) -> int:
            k = len(rows)
            rows.append([0, 0.0, k, k, float(node.prediction())])
            if node.getClass().getSimpleName() == "InternalNode":
                split = node.split()
                rows[k][0], rows[k][1] = int(split.featureIndex()), float(split.threshold())
                rows[k][2] = add(node.leftChild())
                rows[k][3] = add(node.rightChild())
            return k

        add(tree.rootNode())
        feature, limit, low, high, value = zip(*rows)
        out.append((np.array(feature), np.array(limit), np.array(low), np.array(high), np.array(value)))
    return Trees(out, [float(w) for w in model.treeWeights])


# --- training pages --------------------------------------------------------------------------

_STAND_IN = (
    "The first train left before the rain had stopped, and nobody waved.",
    "A long report followed; it named the river, the bridge and the year.",
    "Prices rose again in spring, though fewer people noticed this time.",
    "She kept the letters in a box under the stairs, sorted by colour.",
)


def _link_list(rng: random.Random, words: list[str], n: int) -> str:
    return "<ul>" + "".join(f'<li><a href="/{k}">{" ".join(rng.sample(words, min(len(words), rng.randint(1, 4))))}</a></li>' for k in range(n)) + "</ul>"


def layout(rng: random.Random, paragraphs: list[str]) -> tuple[str, set[str]]:
    """A page around these paragraphs, and the texts of its blocks that are main text."""
    words = [w for p in paragraphs for w in re.findall(r"\w+", p)] or ["word"]
    some = lambda a, b: " ".join(rng.choice(words) for _ in range(rng.randint(a, b))) + "."
    label = lambda *names: rng.choice(["", f' class="{rng.choice(names)}"', f' id="{rng.choice(names)}"', f' class="{rng.choice(names)}"'])
    extras = {
        "notice": lambda: f'<div class="{rng.choice(["notice", "cookie-banner", "alert", "gdpr-consent", "warning"])}">{rng.choice(["", "<p>"])}{some(5, 25)}</div>',
        "ad": lambda: f'<div class="{rng.choice(["ad", "ads", "advert", "sponsored", "promo-box", "advertisement"])}">{rng.choice(["", "<p>"])}{some(3, 40)}</div>',
        "form": lambda: f'<form{label("signup", "search-form", "newsletter")}><label>{some(1, 5)}</label><input name="q"><button>{some(1, 2)}</button><p>{some(3, 20)}</p></form>',
        "share": lambda: f'<div class="{rng.choice(["share", "social-links", "tags"])}">{_link_list(rng, words, rng.randint(2, 5))}</div>',
        "related": lambda: f'<{rng.choice(["div", "section", "aside"])} class="{rng.choice(["related", "recommended", "widget"])}"><h3>{some(1, 4)}</h3>{_link_list(rng, words, rng.randint(3, 8))}</div>',
    }
    comments = lambda: (
        f'<{(t := rng.choice(["section", "div"]))} {rng.choice(["class", "id"])}="{rng.choice(["comments", "comment-list", "replies", "discussion", "reader-comments"])}"><h2>{some(1, 3)}</h2>'
        + "".join(f'<div class="{rng.choice(["comment", "reply", "item"])}"><p>{rng.choice(["", "<b>" + some(1, 2) + "</b> "])}{some(5, 60)}</p></div>' for _ in range(rng.randint(1, 8)))
        + f"</{t}>"
    )
    title = some(3, 12)
    body, main = [], {title}
    for p in paragraphs:
        if rng.random() < 0.2:  # texts have short paragraphs too
            p = " ".join(p.split()[: rng.randint(1, 5)])
        kind = rng.random()
        if kind < 0.82:
            body.append(f"<p>{html.escape(p, quote=False)}</p>" if rng.random() < 0.8 else f"<p><b>{html.escape(p, quote=False)}<br>")
        elif kind < 0.86:
            body.append(f"<h2>{html.escape(p, quote=False)}</h2>")
        elif kind < 0.91:
            body.append(f"<blockquote>{html.escape(p, quote=False)}</blockquote>")
        elif kind < 0.96:
            body.append(f"<ul><li>{html.escape(p, quote=False)}</li></ul>")
        else:
            body.append(f"<div>{html.escape(p, quote=False)}</div>")
        main.add(" ".join(p.split()))
    for make in rng.sample(list(extras.values()), rng.randint(0, 3)):
        body.insert(rng.randint(0, len(body)), make())
    if rng.random() < 0.3:
        body.append(comments())
    headline = f"<h1>{title}</h1>" if rng.random() < 0.7 else f"<header><h1>{title}</h1></header>"
    tag = rng.choice(["article", "article", "main", "div", "div", "section"])
    mark = label("content", "post", "entry-content", "story", "main-text") if tag != "div" or rng.random() < 0.3 else f' class="{rng.choice(["content", "post-body", "entry", "story", "article-text"])}"'
    article = f"<{tag}{mark}>{headline}{''.join(body)}</{tag}>"
    if rng.random() < 0.3:
        article = f'<div{label("wrapper", "container", "page", "main")}>{article}</div>'
    nav = rng.choice(
        [f"<nav{label('menu', 'navbar')}>{_link_list(rng, words, rng.randint(3, 9))}</nav>", f'<div class="{rng.choice(["menu", "navbar", "breadcrumbs"])}">{_link_list(rng, words, rng.randint(3, 9))}</div>']
    )
    header = f"<header{label('site-header', 'masthead')}><{(h := rng.choice(['h1', 'h2', 'div', 'p']))}>{some(1, 5)}</{h}>{rng.choice(['', nav])}</header>"
    side = f'<{(t := rng.choice(["aside", "div"]))}{label("sidebar", "widget") if t == "aside" else " class=sidebar"}><h3>{some(1, 3)}</h3>{rng.choice([_link_list(rng, words, 5), "<p>" + some(10, 60) + "</p>"])}</{t}>'
    footer = f"<{(t := rng.choice(['footer', 'footer', 'div']))}{label('footer') if t == 'footer' else ' class=footer'}>{rng.choice(['&copy; ', '<p>'])}{some(3, 25)}</{t}>"
    before = [x for x in (header, nav, extras["ad"](), extras["notice"](), side) if rng.random() < 0.5]
    after = [x for x in (comments(), extras["related"](), extras["form"](), side, extras["ad"]()) if rng.random() < 0.3]
    return f"<html><head><title>{title}</title></head><body>{''.join(before)}{article}{''.join(after)}{footer if rng.random() < 0.85 else ''}</body></html>", main


def _plain_paragraphs(page: str) -> list[str]:
    """Paragraphs of a page whose main element is plain to see."""
    nodes, runs = parse(page)
    inside = set()
    for k, x in enumerate(nodes):
        if x.tag in ("article", "main") or x.parent in inside:
            inside.add(k)
    return [text for k, text in runs if k in inside and nodes[k].tag == "p" and len(text) > 20]


def training_rows(paragraphs: list[str], seed: int, layouts: int = 3) -> list[tuple[list[float], float]]:
    rng, out = random.Random(seed), []
    for _ in range(layouts):
        chosen = rng.sample(paragraphs, min(len(paragraphs), rng.randint(1, 12)))
        page, main = layout(rng, chosen or list(_STAND_IN))
        nodes, runs = parse(page)
        holds = set()
        for k, text in runs:
            if text in main:
                while k > 0:
                    holds.add(k)
                    k = nodes[k].parent
        own, x = features(nodes)
        out += [(row.tolist(), float(k in holds)) for k, row in zip(own, x)]
    return out


def _training(batches):
    for batch in batches:
        rows = []
        for key, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows += training_rows(_plain_paragraphs(page or ""), key)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.list_(pa.float64())), pa.array([r[1] for r in rows], pa.float64())], ["x", "label"]
        )


def fit(pages: DataFrame, page: str = "html", train_pages: int = TRAIN_PAGES) -> Trees:
    """Trees fitted to layouts around the paragraphs of at most ``train_pages`` pages."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    key = F.xxhash64(F.col(f"`{page}`").cast("string"))
    sample = pages.select(key.alias("key"), F.col(f"`{page}`").cast("string").alias("page")).orderBy("key").limit(train_pages)
    rows = sample.unionAll(pages.sparkSession.range(20).selectExpr("id as key", "'' as page"))
    rows = rows.repartition(4, "key").sortWithinPartitions("key").mapInArrow(_training, "x array<double>, label double")
    # a few megabytes, read once per level of each tree: kept in as few files as tasks are of use
    tables = Written(pages.sparkSession, "html-text")
    rows = tables(rows.coalesce(4), "training").select(array_to_vector("x").alias("features"), "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=64, seed=1).fit(rows)
    tables.drop("training")
    return _arrays(model)


def extract_texts(pages: list[str], trees: Trees) -> list[str]:
    out = []
    for first in range(0, len(pages), 200):
        parsed = [parse(p) for p in pages[first : first + 200]]
        rows = [features(nodes) for nodes, _ in parsed]
        chance = trees.chance(np.concatenate([x for _, x in rows])) if rows else np.zeros(0)
        at = 0
        for (nodes, runs), (own, _) in zip(parsed, rows):
            kept = decode(nodes, own, chance[at : at + len(own)])
            at += len(own)
            out.append("\n".join(text for k, text in runs if k in kept and k))
    return out


def main_text(pages: DataFrame, page: str = "html", trees: Trees | None = None) -> DataFrame:
    """The pages with text and n_chars."""
    bounded_batches(pages.sparkSession)
    fitted = trees or fit(pages, page)
    held = pages.sparkSession.sparkContext.broadcast((fitted.trees, fitted.weights))  # plain arrays

    def extract(batch: pa.Array) -> pa.Array:
        return pa.array(extract_texts([p or "" for p in batch.to_pylist()], Trees(*held.value)), pa.string())

    own = {"text", "n_chars"} - {page.lower()}
    kept = [c for c in pages.columns if c.lower() not in own]
    rows = pages.select(*(F.col(f"`{c}`") for c in kept), F.arrow_udf(extract, "string")(F.col(f"`{page}`").cast("string")).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
