"""Operator 7, main text of web pages: gradient-boosted trees over DOM nodes.

A page becomes a tree of block elements whose leaves are runs of text. Every
node has features: text and link density of its subtree, its tag, tokens of its
attributes, depth, how it compares with its siblings, and what its ancestors
are. Boosted trees give each node log-odds of being article. Decoding is over
the whole tree: a leaf is kept only with all its ancestors, and the kept set is
the one of greatest total log-odds, so no kept text lies under a dropped node.

The trees are fitted here, on at most TRAIN_PAGES pages of the table (those
that hash lowest). Their own tags mark some parts as article or not;
as one site's layout teaches little, each page's sentences are also laid out
anew with other containers and other boilerplate, whose parts are known.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.common import arrow_sized, lowest, ship

TRAIN_PAGES = 200
LAYOUTS = 4                           # anew, for each of them
TREES, DEPTH, BINS, RATE = 40, 4, 32, 0.3

BLOCK = set("""address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre section select summary
table tbody td tfoot th thead tr ul caption""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIP = set("script style title textarea noscript iframe template svg head".split())       # code, forms and what has no text
GROUPS = ["nav menu", "header", "footer", "aside", "form button select option fieldset label legend dialog", "article main",
          "section", "div", "p pre blockquote", "h1 h2 h3 h4 h5 h6 hgroup", "ul ol dl li dt dd", "table thead tbody tfoot tr td th caption",
          "figure figcaption"]
OWN = 29                              # features before those of the tag's group
GROUP = {t: i for i, g in enumerate(GROUPS) for t in g.split()}
AGAINST = set("""ad ads adv advert advertisement adverts aside author banner bar bio bottom breadcrumb breadcrumbs byline comment
comments consent cookie cookies copyright disclaimer disqus dialog feedback footer form gdpr header infobar legal links login masthead
menu meta modal nav navbar navigation newsletter notice notification overlay pager pagination popup privacy promo promotion promoted
rail recommended recommendations related reply responses search share sharing sidebar signup skip social sponsor sponsored subscribe
subscription tags teaser toolbar topbar widget""".split())
FOR = set("article articlebody body content entry main post story text".split())
CLOSES = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
          "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s>/]*)[^>]*>?"""
                   r"""|<([a-zA-Z][^\s>/]*)((?:[^>"']+|"[^"]*"|'[^']*')*)>?""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
MARKS = re.compile(r"[.,;:!?]")


class Page:
    """Parent, tag and attribute words of every node (how many speak for an
    article, how many against), in page order; leaves have text. A parent stands
    before its children. Parsing takes time in proportion to the page."""

    def __init__(self, source: str, marked: bool = False):
        self.parent, self.tag, self.text, self.link = [-1], ["html"], [None], [0]
        self.good, self.bad, self.mark = [0], [0], [None]
        self.marked = marked
        self._parse(source)

    def _node(self, parent, tag, text=None, link=0, good=0, bad=0, mark=None):
        self.parent.append(parent), self.tag.append(tag), self.text.append(text), self.link.append(link)
        self.good.append(good), self.bad.append(bad), self.mark.append(mark)
        return len(self.parent) - 1

    def _parse(self, source):
        stack: list[tuple[str, int]] = [("html", 0)]        # tag, nearest block node
        places: dict[str, list[int]] = {}                   # of the open tags above it, in the stack
        run: list[str] = []
        links = [0]

        def flush():
            text = " ".join("".join(run).split())
            if text:
                self._node(stack[-1][1] if stack else 0, "#text", text, min(links[0], len(text)))
            run.clear()
            links[0] = 0

        def say(raw):
            if raw:
                t = html.unescape(raw)
                run.append(t)
                if places.get("a"):
                    links[0] += len(t.strip())

        def push(tag, node):
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, node))

        def cut(size):
            while len(stack) > size:
                tag, _ = stack.pop()
                places[tag].pop()

        at, end = 0, len(source)
        while at < end:
            m = TOKEN.search(source, at)
            if m is None:
                say(source[at:])
                break
            say(source[at:m.start()])
            at = m.end()
            closing, opening, attributes = m.groups()
            if closing:
                tag = closing.lower()
                if places.get(tag):
                    if tag in BLOCK or any(t in BLOCK and places.get(t) and places[t][-1] > places[tag][-1] for t in places):
                        flush()
                    cut(places[tag][-1])
                elif tag in BLOCK:
                    flush()
            elif opening:
                tag = opening.lower()
                if tag in SKIP:
                    if tag == "head":
                        shut = re.compile(r"</head\b[^>]*>|<body\b", re.I).search(source, at)
                        if shut:
                            at = shut.end() if shut.group().startswith("</") else shut.start()
                    elif not attributes.endswith("/"):
                        shut = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
                        at = shut.end() if shut else end
                    run.append(" ")
                    continue
                if tag in BLOCK:
                    flush()
                    cut(self._closed(places, tag, len(stack)))
                    node = self._node(stack[-1][1], tag, None, 0, *self._signs(attributes))
                    if tag not in VOID:
                        push(tag, node)
                elif tag == "br" or tag in VOID:
                    run.append(" ")
                elif not attributes.endswith("/"):
                    push(tag, stack[-1][1])
        flush()

    @staticmethod
    def _closed(places, tag, size):
        """How much of the stack stays open under a start tag that implies end tags."""
        names = {"p"} if tag not in ("button", "label", "option", "select") else set()
        until: tuple = ("button", "td", "th", "body", "html", "div", "section", "article", "li", "form", "blockquote")
        if tag in CLOSES:
            own, until_own = CLOSES[tag]
            names, until = names | set(own.split()), until_own
        last = lambda tags: max((places[t][-1] for t in tags if places.get(t)), default=0)
        found = last(names)
        return found if found and found >= last(until) else size

    def _signs(self, attributes):
        """How many words of the attributes speak for an article, how many against."""
        good = bad = 0
        mark = None
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m.group(1).lower(), next((g for g in m.groups()[1:] if g is not None), "")
            if name in ("class", "id", "role", "aria-label", "itemprop", "data-role", "data-component"):
                words = {w.lower() for w in NAME.findall(value)}
                good, bad = good + len(words & FOR), bad + len(words & AGAINST)
            elif self.marked and name == "data-part":
                mark = int(value)
        return good, bad, mark

    def features(self) -> np.ndarray:
        n = len(self.parent)
        chars, words, links, marks, blocks, prose, controls = (np.zeros(n) for _ in range(7))
        parent = self.parent
        kids: list[list[int]] = [[] for _ in range(n)]
        depth, innermost, bad, good, nearest, above_good, above_bad = ([0] * n for _ in range(7))
        group = [GROUP.get(t, -1) for t in self.tag]
        for i in range(n):
            p = parent[i]
            if p >= 0:
                kids[p].append(i)
                depth[i], innermost[i], bad[i], good[i] = depth[p] + 1, innermost[p], bad[p], good[p]
                nearest[i], above_good[i], above_bad[i] = nearest[p], above_good[p], above_bad[p]
            own = -1 if 0 <= group[i] <= 4 else 1 if group[i] == 5 else 0
            if own:
                innermost[i], bad[i], good[i] = own, bad[i] or own < 0, good[i] or own > 0
            if self.good[i] or self.bad[i]:
                nearest[i] = (self.good[i] > 0) - (self.bad[i] > 0)
                above_good[i], above_bad[i] = above_good[i] + (self.good[i] > 0), above_bad[i] + (self.bad[i] > 0)
            if self.text[i] is not None:
                t = self.text[i]
                chars[i], words[i], links[i], blocks[i] = len(t), t.count(" ") + 1, self.link[i], 1
                marks[i] = len(MARKS.findall(t))
                prose[i] = len(t) if self.tag[p] in ("p", "pre", "blockquote") else 0
            controls[i] += group[i] == 4
        before = np.concatenate([[0.0], np.cumsum(chars)])[:-1]
        for i in range(n - 1, 0, -1):
            p = parent[i]
            chars[p] += chars[i]; words[p] += words[i]; links[p] += links[i]; marks[p] += marks[i]  # noqa: E702
            blocks[p] += blocks[i]; prose[p] += prose[i]; controls[p] += controls[i]  # noqa: E702
        total = max(1.0, chars[0])
        x = np.zeros((n, OWN + len(GROUPS)))
        rank, many, same, near = (np.zeros(n) for _ in range(4))
        for k in kids:
            if k:
                tags = Counter(self.tag[i] for i in k)
                mean = float(np.mean(np.log1p(chars[k])))
                for r, i in enumerate(k):
                    rank[i], many[i], same[i], near[i] = r, len(k), tags[self.tag[i]] / len(k), mean
        up = np.array([max(p, 0) for p in parent])
        home = np.where([t is not None for t in self.text], up, np.arange(n))          # a leaf has its element's tag and words
        own_good, own_bad = np.array(self.good), np.array(self.bad)
        safe = np.maximum(chars, 1)
        for j, col in enumerate((
                [t is not None for t in self.text], np.log1p(chars), links / safe, np.log1p(words), marks / np.maximum(words, 1),
                chars / np.maximum(words, 1), chars / total, np.log1p(blocks), np.log1p(chars / np.maximum(blocks, 1)), depth, rank,
                np.log1p(many), chars / np.maximum(chars[up], 1), same, near, prose / safe, np.log1p(controls), before / total,
                own_good[home], own_bad[home], own_good[up[home]], own_bad[up[home]], nearest, above_good, above_bad,
                innermost, bad, good, links[up] / np.maximum(chars[up], 1))):
            x[:, j] = col
        own = np.array(group)[home]
        has = own >= 0
        x[np.flatnonzero(has), OWN + own[has]] = 1
        return x

    def decode(self, odds: np.ndarray) -> str:
        """Text of the leaves kept: the set of greatest total log-odds that
        holds every ancestor of what it holds. The root is free."""
        n = len(self.parent)
        best = np.array(odds, float)
        best[0] = 0
        free = [t in ("html", "body") for t in self.tag]
        for i in range(n - 1, 0, -1):
            if free[i]:
                best[i] -= odds[i]
            if best[i] > 0:
                best[self.parent[i]] += best[i]
        kept = [True] * n
        out = []
        for i in range(1, n):
            kept[i] = kept[self.parent[i]] and (best[i] > 0 or free[i])
            if kept[i] and self.text[i] is not None:
                out.append(self.text[i])
        return "\n".join(out)

    def labels(self) -> np.ndarray:
        """1 article, 0 not, -1 unknown, by the nearest mark above."""
        y = np.full(len(self.parent), -1)
        for i in range(len(self.parent)):
            y[i] = self.mark[i] if self.mark[i] is not None else y[self.parent[i]] if self.parent[i] >= 0 else -1
        for i in range(len(self.parent) - 1, 0, -1):                    # what holds the article stays, too
            if y[i] == 1 and y[self.parent[i]] < 0:
                y[self.parent[i]] = 1
        return y


class Boosted:
    """Boosted trees of equal depth for a yes-no label, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        rate = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
        self.base, self.trees = float(np.log(rate / (1 - rate))), []
        if not len(y) or y.min() == y.max():
            return
        b = self.binned(x)
        z = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            tree, leaf = self._grow(b, y - p, p * (1 - p))
            self.trees.append(tree)
            z += tree[2][leaf]

    def binned(self, x):
        return np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)], axis=1) if len(x) else np.zeros(x.shape, int)

    @staticmethod
    def _grow(b, g, h):
        """Levels of splits (feature, bin) and the leaves' values. A split takes
        the gain of both sides' fits; without gain all rows go left."""
        n, f = b.shape
        feature, cut = np.zeros((1 << DEPTH) - 1, int), np.full((1 << DEPTH) - 1, BINS)
        node = np.zeros(n, int)
        for level in range(DEPTH):
            width, first = 1 << level, (1 << level) - 1
            most = np.full(width, 1e-6)
            for j in range(f):
                key = node * BINS + np.minimum(b[:, j], BINS - 1)
                sg = np.cumsum(np.bincount(key, g, width * BINS).reshape(width, BINS), axis=1)
                sh = np.cumsum(np.bincount(key, h, width * BINS).reshape(width, BINS), axis=1)
                tg, th = sg[:, -1:], sh[:, -1:]
                gain = sg**2 / (sh + 1) + (tg - sg) ** 2 / (th - sh + 1) - tg**2 / (th + 1)
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = top > most
                most[better] = top[better]
                feature[first:first + width][better], cut[first:first + width][better] = j, at[better]
            node = node * 2 + (b[np.arange(n), feature[first + node]] > cut[first + node])
        value = RATE * np.bincount(node, g, 1 << DEPTH) / (np.bincount(node, h, 1 << DEPTH) + 1)
        return (feature, cut, value), node

    def odds(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.binned(x), np.arange(len(x))
        z = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for level in range(DEPTH):
                at = (1 << level) - 1 + node
                node = node * 2 + (b[rows, feature[at]] > cut[at])
            z += value[node]
        return z


def _modifiers(r: random.Random) -> list[str]:
    """Class names of containers of whole pages or articles that hold words against."""
    words = sorted(AGAINST)
    forms = [lambda w: f"has-{w}", lambda w: f"no-{w}", lambda w: f"with-{w}", lambda w: f"{w}-open", lambda w: f"{w}-enabled",
             lambda w: f"{w}-fixed", lambda w: f"{w}-jane", lambda w: f"tag-{w}", lambda w: f"{w}-{r.choice(words)}-on"]
    return [r.choice(forms)(r.choice(words)) for _ in range(r.randint(1, 3))]


def _laid_out(sentences: list[str], r: random.Random) -> str:
    """The sentences in a page of other make, its parts marked."""
    esc = html.escape
    pick = lambda k: [esc(r.choice(sentences)) for _ in range(k)]
    prose = lambda k: "".join(f"<p>{' '.join(pick(r.randint(1, 5)))}</p>" for _ in range(k))
    few = lambda: " ".join(r.choice(sentences).split()[:r.randint(1, 4)])
    items = lambda k: "".join(f"<li><a href='/x'>{esc(few())}</a></li>" for _ in range(k))

    def part(tag, names, inner):
        name = r.choice(names)
        extra = f" {r.choice(['class', 'id'])}='{name}'" if name else ""
        return f"<{tag}{extra} data-part=0>{inner}</{tag}>"

    extras = [
        lambda: part(r.choice(["nav", "div", "ul"]), ["menu", "navbar", "main-nav", "breadcrumbs", "nav"], items(r.randint(2, 9))),
        lambda: part("nav", ["", "x1"], "<ul>" + items(r.randint(2, 9)) + "</ul>"),
        lambda: part("header", ["", "site", "top"], f"<h1>{esc(few())}</h1>" + r.choice(["", prose(1)])),
        lambda: part("div", ["header", "masthead", "page-header"], esc(few())),
        lambda: part("aside", ["", "x2", "rail"], r.choice([prose(r.randint(1, 3)), f"<h3>{esc(few())}</h3><ul>{items(4)}</ul>"])),
        lambda: part("div", ["sidebar", "widget", "related", "recommended-posts"], r.choice([prose(2), f"<h2>{esc(few())}</h2><ul>{items(5)}</ul>"])),
        lambda: part("div", ["cookie-notice", "consent", "notice", "gdpr-banner", "popup"], prose(1) + f"<button>{esc(few())}</button>"),
        lambda: part(r.choice(["div", "section", "p", "aside"]), ["ad", "ads-top", "advert", "sponsored", "promo", "ad-slot"], r.choice(pick(1) + [prose(1)])),
        lambda: part("form", ["", "search", "newsletter"], f"<label>{esc(few())}</label><input><select><option>{esc(few())}</option></select><button>{esc(few())}</button>"),
        lambda: part(r.choice(["div", "section", "ol"]), ["comments", "comment-list", "disqus", "responses"],
                     "".join(f"<div class='comment'><b>{esc(few())}</b>{prose(r.randint(1, 2))}</div>" for _ in range(r.randint(1, 4)))),
        lambda: part("footer", ["", "x3"], "&copy; " + r.choice(pick(1) + [prose(1)])),
        lambda: part("div", ["footer", "copyright", "legal", "share", "social-links", "subscribe"], r.choice(pick(1) + [items(3)])),
    ]
    kinds = [lambda: prose(1), lambda: prose(1), lambda: prose(1), lambda: f"<h2>{esc(few())}</h2>",
             lambda: "<ul>" + "".join(f"<li>{x}</li>" for x in pick(3)) + "</ul>",
             lambda: f"<blockquote>{pick(1)[0]}</blockquote>", lambda: f"<p>{esc(few())} <a href='/y'>{esc(few())}</a></p>",
             lambda: f"<div>{pick(1)[0]}</div>", lambda: f"<p>{esc(few())}</p>",
             lambda: f"<table><tr><td>{esc(few())}</td><td>{pick(1)[0]}</td></tr></table>"]
    body = [f"<h1>{esc(few())}</h1>"] * r.randint(0, 1) + [r.choice(kinds)() for _ in range(r.randint(1, 9))]
    for _ in range(r.choice([0, 0, 1, 2])):
        body.insert(r.randint(1, len(body)), r.choice(extras[4:])())
    tag, name = r.choice([("article", ""), ("article", "x4"), ("main", ""), ("div", "content"), ("div", "post"), ("div", "entry-content"),
                          ("section", "story"), ("div", "article-body"), ("div", "x5"), ("section", ""), ("main", "main"), ("div", "")])
    if r.random() < 0.5:                                    # names that say what a page has besides
        name = " ".join([name, *_modifiers(r)]).strip()
    main = f"<{tag}" + (f" class='{name}'" if name else "") + f" data-part=1>{''.join(body)}</{tag}>"
    above, below = ([r.choice(extras)() for _ in range(r.randint(0, 3))] for _ in range(2))
    inner = "".join([*above, main, *below])
    for _ in range(r.randint(0, 2)):
        more = " ".join(["layout", *_modifiers(r)])
        inner = r.choice(["<div class='wrapper'>{}</div>", "<div id='page'>{}</div>", "<main>{}</main>", "<div>{}</div>",
                          f"<div class='{more}'>{{}}</div>"]).format(inner) if "<main" not in inner else f"<div>{inner}</div>"
    return f"<html><body>{inner}</body></html>"


def train(sources: list[str], seed: int = 11) -> Boosted:
    """Fit on pages: their own article and boilerplate tags, and new layouts."""
    r = random.Random(seed)
    xs, ys = [np.zeros((0, OWN + len(GROUPS)))], [np.zeros(0, int)]
    for source in sources:
        pages = [Page(source)]
        own = pages[0]
        y = np.full(len(own.parent), -1)
        for i in range(1, len(y)):
            g = GROUP.get(own.tag[i], -1)
            y[i] = 0 if 0 <= g <= 4 else 1 if own.tag[i] == "article" else y[own.parent[i]]      # by tags, not by words
        labels = [y]
        sentences = [s for t in own.text if t for s in re.split(r"(?<=[.!?])\s+", t) if s]
        for _ in range(LAYOUTS if sentences else 0):
            page = Page(_laid_out(sentences, r), marked=True)
            pages.append(page)
            labels.append(page.labels())
        for page, y in zip(pages, labels):
            xs.append(page.features()[y >= 0])
            ys.append(y[y >= 0])
    return Boosted(np.concatenate(xs), np.concatenate(ys))


def fit(pages: DataFrame, rows: int = TRAIN_PAGES) -> Boosted:
    """Trees from at most ``rows`` pages, those that hash lowest."""
    picked = lowest(pages.where(F.length("html") > 0).select("page_id", "html"), F.xxhash64("page_id", "html"), rows).collect()
    picked.sort(key=lambda x: x["html"])
    return train([x["html"] for x in picked])


def extract(pages: DataFrame, model: Boosted, carry: tuple[str, ...] = ()) -> DataFrame:
    """``page_id, url, carried, text``: one row per row of ``pages``.

    Null or empty html, and pages of boilerplate only, give an empty text.
    Character references are decoded, white space in a block (line breaks
    too) becomes one blank, blocks are joined in page order by a line end.
    Rows are judged alone, so null or repeated ids change nothing; columns
    named in ``carry`` come back in ``carried``, others are ignored.
    """
    ship(pages.sparkSession)
    d = arrow_sized(pages.select("page_id", "url", F.struct(*[F.col(c) for c in carry]).alias("carried") if carry
                                 else F.lit(0).alias("carried"), F.coalesce("html", F.lit("")).alias("_h")))
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        trees = sent.value
        for b in batches:
            out = []
            for i in range(0, b.num_rows, 256):
                part = [Page(x.as_py()) for x in b.column("_h").slice(i, 256)]
                x = [p.features() for p in part]
                odds = trees.odds(np.concatenate(x))
                at = np.cumsum([0, *map(len, x)])
                out += [p.decode(odds[s:e]) for p, s, e in zip(part, at, at[1:])]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), b.column("carried"), pa.array(out, pa.string())],
                                             names=["page_id", "url", "carried", "text"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema if f.name != "_h")
    return d.mapInArrow(run, f"{kinds}, text string")


def op7(spark, sf_dir):
    from kinrank.llm.common import table

    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
