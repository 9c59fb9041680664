"""Main text of web pages by boosted trees over DOM nodes.

Pages become trees of block elements.  Each node has features of its subtree (text, links,
tags, density), of its attribute tokens, its depth and its siblings.  Boosted trees give
the odds that the node is main text; decoding takes the best consistent choice over the
tree: nothing below a dropped node is kept, and a node that is kept or only passed through
may have both kinds below it.

The trees are fitted to at most `SAMPLE` pages, chosen by a hash of page_id, with labels
from the meaning of elements, and to variants of them in which the article has no telling
element and notices, sidebars, forms and comments are put in.  The model is small and goes
to the tasks; every page is judged as a whole.

Defined results: null and empty html have empty text; text outside elements belongs to the
page's root; a tag cut off at the end of the page is dropped; `<br>` is white space; a script,
style, textarea or title without an end goes on to the end of the page; another element without
text of the page (svg, iframe, option ...) whose end is missing ends where the next block
starts or an element around it ends, at once when it is written `<svg/>`;
unfinished character references without a known name stay as they are; repeated rows give
repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

SAMPLE = 300
TREES, LEVELS, RATE, BINS = 60, 4, 0.2, 32
CHUNK = 256

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[a-zA-Z/][^<>]*(?:>|\Z)|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Elements by how a page is put together.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title".split())
HIDDEN = set("noscript template svg iframe select option".split())
ENDS = {tag: re.compile(f"</{tag}[^>]*>", re.I) for tag in RAW}
BLOCK = set(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tfoot tr td th caption "
    "blockquote pre figure figcaption header footer nav aside form fieldset address details summary center".split())
KINDS = [
    {"html", "body"}, {"article", "main"}, {"section"}, {"div", "center"}, {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"},
    {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"},
    {"blockquote", "pre", "figure", "figcaption"}, {"header"}, {"footer", "address"}, {"nav"}, {"aside"}, {"form", "fieldset"}]
GOOD = set("article content main post entry story body text page copy maintext".split())
BAD = set(
    "ad ads advert advertisement adsense banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar aside widget related share sharing social comment comments reply replies discussion respond footer header masthead "
    "cookie cookies consent notice popup modal subscribe newsletter signup login form search tags meta pagination pager copyright legal".split())
PLAIN, DROPPED = {"article", "main"}, {"nav", "footer", "aside", "form", "header", "fieldset"}


class Node:
    __slots__ = ("tag", "parent", "children", "tokens", "marks", "depth", "text", "links", "tags", "stops", "own")

    def __init__(self, tag: str, parent: Node | None, attributes: str) -> None:
        self.tag, self.parent, self.children = tag, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.text = self.links = self.tags = self.stops = self.own = 0
        self.tokens, self.marks = [], ""
        if attributes:
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name in ("class", "id", "role"):
                    self.tokens += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c).lower())
                elif name.startswith("data-"):
                    self.marks += name
        if parent:
            parent.children.append(self)


def tokens(page: str) -> tuple[list[re.Match], dict[int, int]]:
    """Tags and pieces of text without what is inside RAW elements, and of each HIDDEN element the token of its end.

    An end belongs to an element when nothing around the element has ended before.
    """
    out, ends, at = [], {}, 0
    open_: list[tuple[str, int]] = []
    count: Counter[str] = Counter()
    while m := TOKEN.match(page, at):
        at = m.end()
        out.append(m)
        if m[2] is None:
            continue
        tag, closed = m[2].lower(), m[3].endswith("/")
        if m[1]:
            if count[tag]:
                while True:
                    name, start = open_.pop()
                    count[name] -= 1
                    if name == tag:
                        break
                if tag in HIDDEN:
                    ends[start] = len(out) - 1
        elif tag in RAW:
            if not count["svg"]:
                end = ENDS[tag].search(page, at)
                at = end.end() if end else len(page)
            elif not closed:
                # inside an svg such an element may be closed in itself, and ends with the svg
                end, last = ENDS[tag].search(page, at), page.find("</svg", at)
                if end and end.start() < (last if last >= 0 else len(page)):
                    at = end.end()
        elif tag not in VOID and not (closed and tag == "svg"):
            open_.append((tag, len(out) - 1))
            count[tag] += 1
    return out, ends


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """Block elements in page order, the root first, and the blocks of text with their element."""
    root = Node("html", None, "")
    nodes, blocks, open_, inside, now, links = [root], [], ["html"], [root], [], 0
    found, ends = tokens(page)
    #: Where a HIDDEN element without an end stands among the open ones, and the token up to which all is skipped.
    mute, skip = 0, -1

    def close() -> None:
        if now:
            text = " ".join("".join(now).split())
            if text:
                blocks.append((inside[-1], text))
                inside[-1].own += len(text)
                inside[-1].stops += text.count(".") + text.count(",")
            now.clear()

    def pop() -> None:
        nonlocal links, mute
        tag = open_.pop()
        if len(open_) == mute:
            mute = 0
        if tag in BLOCK:
            close()
            inside.pop()
        elif tag == "a":
            links -= 1

    for k, m in enumerate(found):
        if k <= skip:
            continue
        tag = m[2]
        if tag is None:
            if mute:
                continue
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                piece = entities.unescape(piece) if "&" in piece else piece
                now.append(piece)
                if links:
                    inside[-1].links += len(piece.strip())
            continue
        tag = tag.lower()
        if m[1]:
            if tag in open_[1:]:
                while open_[-1] != tag:
                    pop()
                pop()
            elif tag == "p":
                close()
            continue
        if tag in RAW:
            continue
        if tag in HIDDEN:
            if k in ends:
                skip = ends[k]
            elif not mute and not m[3].endswith("/"):
                mute = len(open_)
                open_.append(tag)
            continue
        if tag in VOID:
            now.append(" ")
            continue
        if tag in ("html", "head"):
            continue
        if tag in BLOCK:
            while mute:
                pop()
            close()
            stop = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",)}.get(tag)
            same = {"td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}.get(tag, (tag,))
            if stop:
                for i in range(len(open_) - 1, 0, -1):
                    if open_[i] in same:
                        while len(open_) > i:
                            pop()
                        break
                    if open_[i] in stop:
                        break
            if "p" in open_[1:]:
                while open_[-1] != "p":
                    pop()
                pop()
            node = Node(tag, inside[-1], m[3])
            nodes.append(node)
            inside.append(node)
        elif tag == "a":
            links += 1
            inside[-1].tags += not mute
        else:
            inside[-1].tags += not mute
        if not m[3].endswith("/") or tag in BLOCK:
            open_.append(tag)
        elif tag == "a":
            links -= 1
    while len(open_) > 1:
        pop()
    close()
    return nodes, blocks


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node."""
    for n in nodes:
        n.text = n.own
    for n in reversed(nodes):
        if n.parent:
            p = n.parent
            p.text += n.text
            p.links += n.links
            p.tags += n.tags + 1
            p.stops += n.stops
    total, rows, above = max(nodes[0].text, 1), [], {}
    place, tags_of = {}, {}
    for n in nodes:
        tags_of.setdefault(id(n.parent), Counter())[n.tag] += 1
    for k, n in enumerate(nodes):
        good = sum(t in GOOD for t in n.tokens)
        bad = sum(t in BAD for t in n.tokens)
        kind = next((i for i, tags in enumerate(KINDS) if n.tag in tags), len(KINDS))
        g, b, d = above.get(id(n.parent), (0, 0, 0))
        above[id(n)] = (g + good + (n.tag in PLAIN), b + bad, d + (n.tag in DROPPED))
        peers = n.parent.children if n.parent else [n]
        i = place.get(id(n.parent), 0)
        place[id(n.parent)] = i + 1
        left = peers[i - 1].text if i else 0
        right = peers[i + 1].text if i + 1 < len(peers) else 0
        alike = tags_of[id(n.parent)][n.tag]
        rows.append((
            kind, n.depth, np.log1p(n.text), n.text / (n.tags + 1), n.links / max(n.text, 1), n.text / total, np.log1p(n.own),
            n.stops / (n.text + 1), n.tags, good, bad, g, b, n.tag in DROPPED, d, k / len(nodes), len(peers), i, alike,
            np.log1p(left), np.log1p(right), len(n.children),
            next((j for j, tags in enumerate(KINDS) if n.parent and n.parent.tag in tags), len(KINDS))))
    return np.array(rows, np.float32)


def labels(nodes: list[Node]) -> np.ndarray:
    """What elements and marks mean: below an article and below no menu, form, notice or the like."""
    main, out = {}, {}
    for n in nodes:
        up = n.parent
        out[id(n)] = bool(up and out[id(up)]) or n.tag in DROPPED or "data-dropped" in n.marks or "data-article" not in n.marks and any(t in BAD for t in n.tokens)
        main[id(n)] = bool(up and main[id(up)]) or n.tag in PLAIN or "data-article" in n.marks
    return np.array([main[id(n)] and not out[id(n)] for n in nodes], float)


def variant(page: str, rng: random.Random) -> str:
    """The page with another frame: the same text, told by less."""
    found = re.search(r"(?s)<article[^>]*>(.*?)(?:</article>|\Z)", page)
    if not found:
        return page
    spare = re.findall(r">([^<>]{15,200})<", page[: found.start()] + page[found.end() :]) or ["..."]
    text = lambda: rng.choice(spare)
    junk = [
        lambda: f'<div class="{rng.choice(["sidebar", "widget", "related"])}" data-dropped=1><h3>{text()}</h3><ul><li><a href=x>{text()}</a></li><li><a href=x>{text()}</a></li></ul><p>{text()}</p></div>',
        lambda: f'<aside><p>{text()}</p><p>{text()}</p></aside>',
        lambda: f'<div class="{rng.choice(["comments", "comment-list", "replies"])}" data-dropped=1>' + "".join(f'<div class="comment"><p>{text()}</p><p>{text()} {text()}</p></div>' for _ in range(rng.randint(1, 4))) + "</div>",
        lambda: f'<form action=x><label>{text()}</label><input name=q><p>{text()}</p></form>',
        lambda: f'<div class="{rng.choice(["cookie-notice", "banner", "popup", "ad", "promo", "newsletter"])}" data-dropped=1>{rng.choice(["<p>%s</p>", "%s"]) % text()}</div>',
        lambda: f'<section id="comments" data-dropped=1><h2>{text()}</h2><p>{text()}</p></section>',
    ]
    some = lambda k: "".join(rng.choice(junk)() for _ in range(rng.randint(0, k)))
    name = rng.choice(["article", "main", "section", "div", "div", "div"])
    attributes = rng.choice(['class="content"', 'id="main"', 'class="post-body"', 'class="story"', 'class="c12"', ""])
    inner = found[1]
    cut = inner.find("</p>", len(inner) // 2)
    if cut > 0 and rng.random() < 0.5:
        inner = inner[: cut + 4] + some(1) + inner[cut + 4 :]
    head = f'<header><a href=/>{text()}</a><p>{text()}</p></header>' if rng.random() < 0.5 else ""
    middle = f"{some(2)}<{name} {attributes} data-article=1>{inner}</{name}>{some(3)}"
    if rng.random() < 0.5:
        middle = f'<div class="{rng.choice(["wrap", "container", "page"])}">{middle}</div>'
    return page[: found.start()] + head + middle + page[found.end() :]


class Boosted:
    """Boosted trees of fixed depth for log-odds, over binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        self.start, self.trees = float(np.log((y.mean() + 1e-3) / (1.001 - y.mean()))), []
        binned, score = self._bin(x), np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self._apply(tree, binned)

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T)], 1)

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature and bin asked at each inner node, value of each leaf; nodes of a level by number."""
        inner, d = 2**LEVELS - 1, x.shape[1]
        feature, cut, at = np.zeros(inner, int), np.full(inner, BINS), np.zeros(len(g), int)
        for level in range(LEVELS):
            first, count = 2**level - 1, 2**level
            gain = np.full((count, d, BINS), -np.inf)
            for f in range(d):
                cell = (at - first) * BINS + np.minimum(x[:, f], BINS - 1)
                left_g = np.bincount(cell, g, count * BINS).reshape(count, BINS).cumsum(1)
                left_h = np.bincount(cell, h, count * BINS).reshape(count, BINS).cumsum(1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                value = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
                gain[:, f] = np.where((left_h > 0.5) & (all_h - left_h > 0.5), value, -np.inf)
            for k in range(count):
                best = int(np.argmax(gain[k]))
                if np.isfinite(gain[k].flat[best]):
                    feature[first + k], cut[first + k] = divmod(best, BINS)
            at = 2 * at + 1 + (x[np.arange(len(at)), feature[at]] > cut[at])
        leaf = at - inner
        value = RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        return feature, cut, value

    def _apply(self, tree: tuple, x: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        at, rows = np.zeros(len(x), int), np.arange(len(x))
        for _ in range(LEVELS):
            at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
        return value[at - len(feature)]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        x = self._bin(x)
        return self.start + sum(self._apply(t, x) for t in self.trees)


def fit(pages: list[str], seed: int = 5, variants: int = 2) -> Boosted:
    rng, xs, ys = random.Random(seed), [], []
    for page in pages:
        for one in [page, *(variant(page, rng) for _ in range(variants))]:
            nodes, _ = parse(one)
            xs.append(features(nodes))
            ys.append(labels(nodes))
    return Boosted(np.concatenate(xs), np.concatenate(ys))


def decode(nodes: list[Node], odds: np.ndarray) -> set[int]:
    """The kept nodes of the best consistent labelling: dropped, kept, or passed through."""
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    drop, keep, through = {}, {}, {}
    for k in range(len(nodes) - 1, -1, -1):
        below = [id(c) for c in nodes[k].children]
        me = id(nodes[k])
        drop[me] = no[k] + sum(drop[c] for c in below)
        keep[me] = yes[k] + sum(max(keep[c], drop[c]) for c in below)
        through[me] = no[k] + sum(max(through[c], keep[c], drop[c]) for c in below)
    state, kept = {}, set()
    for n in nodes:
        me, up = id(n), state.get(id(n.parent), "through") if n.parent else "through"
        choice = [("drop", drop[me])]
        if up != "drop":
            choice.append(("keep", keep[me]))
        if up == "through":
            choice.append(("through", through[me]))
        state[me] = max(choice, key=lambda c: c[1])[0]
        if state[me] == "keep":
            kept.add(me)
    return kept


def main_texts(pages: list[str], model: Boosted) -> list[str]:
    parsed = [parse(p) for p in pages]
    if not parsed:
        return []
    odds = model.log_odds(np.concatenate([features(nodes) for nodes, _ in parsed]))
    out, at = [], 0
    for nodes, blocks in parsed:
        kept = decode(nodes, odds[at : at + len(nodes)])
        at += len(nodes)
        out.append("\n".join(text for n, text in blocks if id(n) in kept))
    return out


def training_pages(pages: DataFrame, bound: int = SAMPLE) -> list[str]:
    """At most `bound` pages, by a hash of page_id."""
    ids = pages.where("html IS NOT NULL").select(F.xxhash64("page_id").alias("h")).distinct().orderBy("h").limit(bound)
    last = ids.agg(F.max("h")).first()[0]
    if last is None:
        return []
    rows = pages.where(F.xxhash64("page_id") <= last).where("html IS NOT NULL").select("page_id", "html").orderBy("page_id").limit(bound)
    return [r["html"] for r in rows.collect()]


def extract(pages: DataFrame, model: Boosted | None = None) -> DataFrame:
    """page_id, url, text, n_chars per row of `pages`."""
    sample = training_pages(pages) if model is None else []
    if model is None and sample:
        model = fit(sample)

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), CHUNK):
                part = batch.iloc[low : low + CHUNK]
                got = main_texts([p or "" for p in part["html"]], model) if model else [""] * len(part)
                yield pd.DataFrame({"page_id": part["page_id"].to_numpy(), "url": part["url"].to_numpy(), "text": got, "n_chars": [len(t) for t in got]})

    return pages.select("page_id", "url", "html").mapInPandas(texts, "page_id bigint, url string, text string, n_chars bigint")
