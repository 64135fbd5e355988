"""Main-text extraction: gradient-boosted trees score DOM nodes, and a hierarchical decoding keeps ancestors and descendants consistent.

A page becomes a tree of block elements whose leaves are text blocks (inline elements only contribute text and link characters). Trees
score every node for holding main text. The decoding picks the set of kept nodes of the largest total score in which
a node is kept only if its parent is, so no text is kept inside a dropped element and no element is kept for nothing.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: HTML's element classes and tokens of class and id attributes that speak against or for main text
RAW = ("script", "style", "noscript", "iframe", "textarea", "title")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd maction semantics annotation".split())
PHRASING = frozenset("svg object canvas template audio video picture map slot".split())  # nodes that do not end an open paragraph, as custom elements don't
BOILER = frozenset("nav footer aside header form menu dialog button select label fieldset head legend option".split())
MAIN = frozenset("article main".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p blockquote pre figcaption".split())
LIST = frozenset("ul ol li dl dt dd".split())
TABLE = frozenset("table thead tbody tfoot tr td th caption".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
AGAINST = frozenset("ad ads advert advertisement banner sponsor sponsored promo sidebar side nav navbar navigation menu breadcrumb breadcrumbs footer header masthead topbar comment comments respond reply disqus cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login search share sharing social related recommended widget toolbar pager pagination tags meta legal copyright form".split())
FOR = frozenset("article content main body post entry story text prose page".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")(?![\w:-])[^>]*>.*?(?:</(?P=raw)(?![\w:-])[^>]*>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<[!?/][^>]*>",
    re.S | re.I,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PUNCTUATION = re.compile(r"[.,;:!?]")
WORDS = re.compile(r"[a-z]+")


class Page:
    """Nodes of a page in document order: parent, tag ('' for a text block), attribute tokens, and of text blocks text and link characters."""

    def __init__(self, source: str):
        self.parent, self.tag, self.names, self.text, self.link = [-1], ["#root"], [()], [""], [0]
        self.stack, self.parts, self.links, self.in_link = [0], [], 0, 0
        at = 0
        for m in TOKEN.finditer(source):
            if m.start() > at:
                self._say(source[at : m.start()])
            at = m.end()
            if m["tag"]:
                self._element(m["tag"].lower(), bool(m["end"]), m["attrs"])
            elif m["raw"]:
                self.parts.append(" ")
        if at < len(source):
            self._say(source[at:])
        self._flush()

    def _say(self, raw: str) -> None:
        said = html.unescape(raw) if "&" in raw else raw
        self.parts.append(said)
        if self.in_link:
            self.links += len(said)

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self._add(self.stack[-1], "", (), text, min(self.links, len(text)))
        self.parts, self.links = [], 0

    def _add(self, parent: int, tag: str, names: tuple, text: str = "", link: int = 0) -> None:
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.link.append(link)

    def _element(self, tag: str, ends: bool, attrs: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.in_link = 0 if ends else 1
            return
        if tag in VOID:
            self.parts.append(" ")
            if tag == "hr":
                self._flush()
            return
        tags = self.tag
        if not ends and attrs.endswith("/") and (tag == "svg" or any(tags[k] == "svg" for k in self.stack)):  # '/>' ends an element only there
            self.parts.append(" ")
            return
        self._flush()
        if ends:
            for k in range(len(self.stack) - 1, 0, -1):
                if tags[self.stack[k]] == tag:
                    del self.stack[k:]
                    break
            self.in_link = 0
            return
        while tag not in PHRASING and "-" not in tag and len(self.stack) > 1 and (tags[self.stack[-1]] == "p" or tags[self.stack[-1]] in CLOSES.get(tag, ())):
            self.stack.pop()
        names = tuple(WORDS.findall(" ".join(x or y or z for x, y, z in NAMES.findall(attrs)).lower())) if "=" in attrs else ()
        self._add(self.stack[-1], tag, names)
        self.stack.append(len(tags) - 1)


FEATURES = 28


def node_features(page: Page) -> np.ndarray:
    """A row of features for each node."""
    n = len(page.parent)
    parent = page.parent
    chars, links, below, prose, punct, kids = [len(t) for t in page.text], list(page.link), [0] * n, [t in PROSE for t in page.tag], [len(PUNCTUATION.findall(t)) if t else 0 for t in page.text], [0] * n
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        below[p] += below[i] + 1
        prose[p] += prose[i]
        punct[p] += punct[i]
        kids[p] += 1
    depth, rank, before, after, last = [0] * n, [0] * n, [0] * n, [0] * n, [-1] * n
    bad, good, boiler, main = [0] * n, [0] * n, [0] * n, [0] * n
    up = [(0, 0, 0, 0)] * n
    for i in range(1, n):
        p, tag, names = parent[i], page.tag[i], page.names[i]
        depth[i] = depth[p] + 1
        bad[i], good[i] = int(any(x in AGAINST for x in names)), int(any(x in FOR for x in names))
        boiler[i], main[i] = int(tag in BOILER), int(tag in MAIN)
        u = up[p]
        up[i] = (u[0] + bad[p], u[1] + good[p], u[2] + boiler[p], u[3] + main[p])
        prev = last[p]
        if prev >= 0:
            rank[i], before[i], after[prev] = rank[prev] + 1, chars[prev], chars[i]
        last[p] = i
    tag = page.tag
    c, p = np.array(chars, float), np.array([max(x, 0) for x in parent])
    b, k = np.array(below, float), np.array(kids, float)
    many = np.maximum(c, 1)
    ups = np.array(up, float)
    flags = np.array([(t == "", t in HEADING, t in PROSE, t in LIST, t in TABLE, t in ("div", "section")) for t in tag], float)
    columns = [np.array(depth, float), np.log1p(c), np.array(links) / many, c / (1 + b), np.log1p(b), np.log1p(k), np.array(rank) / np.maximum(1, k[p] - 1), np.log1p(k[p])]
    columns += [c / max(1, chars[0]), c / np.maximum(1, c[p]), np.array(punct) / many, np.array(bad, float), np.array(good, float), np.array(boiler, float), np.array(main, float)]
    columns += [np.minimum(ups[:, j], 3) for j in range(4)] + [flags[:, j] for j in range(6)] + [np.log1p(before), np.log1p(after), np.log1p(np.array(prose, float))]
    return np.stack(columns, axis=1)


def decode(parent: list[int], score: np.ndarray) -> np.ndarray:
    """Kept nodes of the largest total score such that a kept node's parent is kept; the root is kept."""
    total = score.tolist()
    for i in range(len(parent) - 1, 0, -1):
        if total[i] > 0:
            total[parent[i]] += total[i]
    keep = np.zeros(len(parent), bool)
    keep[0] = True
    for i in range(1, len(parent)):
        keep[i] = total[i] > 0 and keep[parent[i]]
    return keep


class Boosted:
    """Gradient-boosted trees of fixed depth for a logistic loss, grown on feature quantiles."""

    def __init__(self, depth: int = 4, trees: int = 60, rate: float = 0.25, bins: int = 32):
        self.depth, self.trees, self.rate, self.bins = depth, trees, rate, bins
        self.base, self.feature, self.cut, self.leaf = 0.0, [], [], []

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
        n, m = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.arange(1, self.bins) / self.bins)) for j in range(m)]
        place = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)], axis=1)
        rate = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        f = np.full(n, self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-f))
            g, h = (y - p) * weight, np.maximum(p * (1 - p), 1e-6) * weight
            node = np.zeros(n, np.int64)
            feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                first, width = 2**level - 1, 2**level
                best = np.full(width, 1e-9)
                local = node - first
                for j in range(m):
                    key = local * self.bins + place[:, j]
                    gs = np.bincount(key, weights=g, minlength=width * self.bins).reshape(width, -1).cumsum(axis=1)
                    hs = np.bincount(key, weights=h, minlength=width * self.bins).reshape(width, -1).cumsum(axis=1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                    gain[:, len(cuts[j]) :] = -1
                    at = gain.argmax(axis=1)
                    better = gain[np.arange(width), at] > best
                    best[better] = gain[np.arange(width), at][better]
                    for w in np.flatnonzero(better):
                        feature[first + w], cut[first + w] = j, cuts[j][at[w]]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
            last = node - (2**self.depth - 1)
            leaf = self.rate * np.bincount(last, weights=g, minlength=2**self.depth) / (np.bincount(last, weights=h, minlength=2**self.depth) + 1)
            f += leaf[last]
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(leaf)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        out, row = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
            out += leaf[node - (2**self.depth - 1)]
        return out


# ---------------------------------------------------------------------------------------------- training


def composed(r: np.random.Generator, words: list[str]) -> tuple[str, set[str]]:
    """A made page of random layout over the given words, and its main text blocks."""
    serial, kept = [0], set()
    many = len(words)

    def say(low: int, high: int, keep: bool = False) -> str:
        serial[0] += 1
        text = f"{' '.join([words[k] for k in r.integers(0, many, int(r.integers(low, high)))])} {serial[0]}."
        if keep:
            kept.add(text)
        return text

    def pick(*xs):
        return xs[int(r.integers(len(xs)))]

    def box(tag: str, names: tuple, inner: str) -> str:
        """As an element of its own, or as a division named for it."""
        if tag and r.random() < 0.5:
            return f"<{tag}>{inner}</{tag}>"
        return f'<{pick("div", "section", "div")} {pick("class", "id")}="{pick(*names)}">{inner}</div>'

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{say(1, 4)}</a></li>' for _ in range(n)) + "</ul>"

    def ad() -> str:
        return f'<div class="{pick("ad", "ads", "advert", "banner", "sponsored", "promo")}">{pick(say(3, 40), "<p>" + say(5, 60) + "</p>")}</div>'

    def paragraphs(n: int, keep: bool) -> str:
        return "".join(f"<p>{'<b>' * (r.random() < 0.1)}{say(1, pick(8, 40, 150), keep)}{'</p>' * (r.random() < 0.95)}" for _ in range(n))

    def comments() -> str:
        inner = "".join(f'<{pick("div", "li", "article")} class="comment">{paragraphs(int(r.integers(1, 3)), False)}</div>' for _ in range(int(r.integers(1, 5))))
        return f'<{pick("section", "div", "ol")} {pick("id", "class")}="{pick("comments", "comment-list", "respond")}"><h3>{say(1, 3)}</h3>{inner}</section></div></ol>'

    top = [box("header", ("header", "masthead", "topbar"), (f"<h1>{say(1, 4)}</h1>" if r.random() < 0.3 else say(1, 4)) + (links(4) if r.random() < 0.4 else "")), box("nav", ("nav", "menu", "navbar", "breadcrumbs"), links(int(r.integers(2, 9)))), ad(), box("", ("cookie-notice", "notice", "alert", "consent"), say(4, 40)), box("form", ("search", "signup-form"), f"<label>{say(1, 3)}</label><input><button>{say(1, 2)}</button>")]
    side = [box("aside", ("sidebar", "side", "widget"), f"<h3>{say(1, 4)}</h3>{pick(links(5), paragraphs(2, False))}"), box("", ("related", "recommended", "social", "share"), links(3)), ad(), box("form", ("newsletter", "subscribe"), f"<p>{say(4, 20)}</p><input><button>{say(1, 2)}</button>")]
    body = ""
    if r.random() < 0.8:
        title = f"<{(h := pick('h1', 'h1', 'h2'))}>{say(2, 12, True)}</{h}>"
        body += f"<header>{title}</header>" if r.random() < 0.1 else title
    for _ in range(int(r.integers(1, 7))):
        kind = r.random()
        if kind < 0.65:
            body += paragraphs(int(r.integers(1, 5)), True)
        elif kind < 0.73:
            body += "<ul>" + "".join(f"<li>{say(2, 20, True)}</li>" for _ in range(int(r.integers(2, 5)))) + "</ul>"
        elif kind < 0.8:
            body += f"<h2>{say(1, 8, True)}</h2>" + paragraphs(1, True)
        elif kind < 0.85:
            body += f"<blockquote>{say(5, 40, True)}</blockquote>"
        elif kind < 0.9:
            body += "<table>" + "".join(f"<tr><td>{say(1, 6, True)}</td><td>{say(1, 6, True)}</td></tr>" for _ in range(2)) + "</table>"
        else:
            body += pick(ad(), box("aside", ("related", "share", "promo"), pick(links(2), say(2, 20))))
    if r.random() < 0.15:
        body += comments()
    way = r.random()
    if way < 0.55:
        body = f"<article>{body}</article>"
    elif way < 0.7:
        body = f"<main>{pick(body, f'<article>{body}</article>')}</main>"
    elif way < 0.92:
        body = f'<div {pick("class", "id")}="{pick("content", "main", "post", "entry-content", "article-body", "story", "text")}">{body}</div>'
    elif way < 0.96:
        body = f"<div>{body}</div>"
    before = "".join(x for x in top if r.random() < 0.5)
    after = "".join(x for x in side if r.random() < 0.4) + (comments() if r.random() < 0.3 else "") + (box("footer", ("footer", "legal", "copyright"), pick(say(3, 30), links(3), f"<p>{say(5, 40)}</p>")) if r.random() < 0.8 else "")
    inner = before + (f'<div class="{pick("wrap", "container", "row", "page")}">{body}{after}</div>' if r.random() < 0.4 else body + after)
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{say(2, 8)}</title></head><body>{inner}{'</body></html>' * (r.random() < 0.8)}", kept


def marked(page: Page, kept: set[str]) -> np.ndarray:
    """Which nodes hold main text."""
    y = np.array([t in kept for t in page.text])
    for i in range(len(y) - 1, 0, -1):
        y[page.parent[i]] |= y[i]
    return y


def structural(page: Page) -> set[str] | None:
    """Main text of a page that marks it with its only article or main element; None for other pages."""
    inside, boiler = [0] * len(page.tag), [0] * len(page.tag)
    for i in range(1, len(page.tag)):
        p = page.parent[i]
        inside[i] = inside[p] + (page.tag[i] in MAIN)
        boiler[i] = boiler[p] or page.tag[i] in BOILER or any(x in AGAINST for x in page.names[i])
    if sum(t == "article" for t in page.tag) != 1:
        return None
    return {t for t, i, b in zip(page.text, inside, boiler, strict=True) if t and i and not b}


def train(sources: list[str], made: int = 400, seed: int = 11) -> Boosted:
    """Fit on ``made`` composed pages, and on those of ``sources`` that mark their main text by structure."""
    r = np.random.Generator(np.random.PCG64(seed))
    pages = [Page(s) for s in sources]
    words = sorted({w for p in pages for t in p.text for w in t.split()})[:5000] or ["lorem", "ipsum", "dolor", "sit,", "amet."]
    cases = [(Page(s), kept) for s, kept in (composed(r, words) for _ in range(made))]
    cases += [(p, kept) for p in pages if (kept := structural(p)) is not None]
    x, y = np.concatenate([node_features(p) for p, _ in cases]), np.concatenate([marked(p, k) for p, k in cases])
    weight = np.concatenate([np.full(len(p.tag), 1 / np.sqrt(len(p.tag))) for p, _ in cases])
    return Boosted().fit(x, y.astype(float), weight / weight.mean())


def extract(sources: list[str], model: Boosted) -> list[str]:
    """Main text of each page."""
    pages = [Page(s) for s in sources]
    score = model.score(np.concatenate([node_features(p) for p in pages])) if pages else np.zeros(0)
    out, at = [], 0
    for p in pages:
        keep = decode(p.parent, score[at : at + len(p.parent)])
        at += len(p.parent)
        out.append(" ".join(t for t, k in zip(p.text, keep, strict=True) if t and k))
    return out


def _extracted(model: Boosted):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                text = extract([h or "" for h in part.column("html").to_pylist()], model)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, sample: int = 100, sample_bytes: int = 32 << 20) -> DataFrame:
    """Main text of each row of ``pages`` (page_id, url, html, any more columns): page_id, url, text, n_chars.

    Trees are trained on composed pages and on at most ``sample`` pages of the table, those of the smallest hash of page_id of which each has its share
    of ``sample_bytes`` at most; all pages are read whole. Character references are decoded, white space in a block becomes one space, blocks are joined in
    page order by one space. Null and empty html give an empty text. Repeated rows come back each. An empty table gives no rows.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    fit = rows.where(F.octet_length("html") <= sample_bytes // sample)
    some = fit.orderBy(F.xxhash64("page_id"), "page_id", F.xxhash64("html")).limit(sample).select("html").collect()  # at most sample_bytes
    return rows.mapInArrow(_extracted(train([r[0] for r in some])), "page_id long, url string, text string, n_chars long")
