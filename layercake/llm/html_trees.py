"""Main-text extraction: gradient-boosted trees over DOM-node features, decoded over the hierarchy.

Pages become trees of block nodes. Every node is described by its subtree
(text, links, density), its attribute tokens, depth and siblings; boosted trees
give the log-odds that it belongs to the article. A dynamic programme over the
tree then picks the best labelling in which a node is outside the article,
inside it, or cut out of it, where what lies below a cut is cut: no ancestor and
descendant contradict each other.

There are no labels, so the trees learn from pages that mark their own parts
(``article`` against ``nav``, ``footer`` and so on), from the same pages with
those tags and attributes taken away, so that structure has to tell, and from
pages with typical foreign blocks (notices, sidebars, forms, comments) grafted in.
"""

from __future__ import annotations

import html as entities
import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import ship, slices, strings

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template svg iframe textarea select button object canvas title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br img wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ARTICLE_TAGS = frozenset(("article", "main"))
FOREIGN_TAGS = frozenset("nav footer aside form header menu dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Attribute tokens that name an article's parts, and those that name other parts (fixed values).
ARTICLE_TOKENS = frozenset("article articlebody content post entry story main body text prose blogpost maincontent".split())
FOREIGN_TOKENS = frozenset(
    "ad ads adv advert adverts advertisement advertising aside banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies"
    " copyright disclaimer discussion disqus dropdown footer form gdpr header hidden login masthead menu modal nav navbar navigation newsletter"
    " notice notification pager pagination popup promo promoted promotion recommended related reply replies respond search share sharing sidebar"
    " signup social sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets alert legal contentinfo complementary".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)(?:>|\Z|(?=<))|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: frozenset
    order: int  # among its siblings
    children: list[int] = field(default_factory=list)
    own: int = 0  # characters of its own blocks
    linked: int = 0
    links: int = 0
    marks: int = 0  # punctuation
    blocks: int = 0
    tags: int = 1
    inputs: int = 0


def attribute_tokens(raw: str) -> frozenset:
    """Lower-case tokens of class, id, role and aria-label, split at case and signs; 'hidden' for elements not shown."""
    out = set()
    for name, *values in _ATTR.findall(raw):
        value = next((v for v in values if v), "")
        name = name.lower()
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            out.update(x.lower() for x in _TOKEN.findall(value))
            out.update(x.lower() for x in value.split())
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            out.add("hidden")
    return frozenset(out)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes of a page and its text blocks ``(node, text)`` in page order.

    Takes broken pages as they are: implied ends, stray ends, text cut off
    anywhere. White space inside a block is one space; empty blocks are left out.
    """
    nodes = [Node("#page", -1, 0, frozenset(), 0)]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements with the block node they stand in
    blocks: list[tuple[int, str]] = []
    pieces: list[str] = []
    in_link = 0
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                node = nodes[stack[-1][1]]
                node.own += len(text)
                node.linked += min(linked, len(text))
                node.marks += sum(map(text.count, ".,;:!?"))
                node.blocks += 1
                blocks.append((stack[-1][1], text))
        linked = 0

    def close(depth: int) -> None:
        nonlocal in_link
        while len(stack) > depth:
            tag = stack[-1][0]
            if tag == "a":
                in_link = max(0, in_link - 1)
            elif tag not in INLINE:
                flush()
            stack.pop()

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = entities.unescape(piece) if "&" in piece else piece
            pieces.append(piece)
            if in_link:
                linked += len(piece.strip())

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # an end tag closes down to its element, if that is open
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
            continue
        here = nodes[stack[-1][1]]
        if tag in SKIPPED:
            here.inputs += tag in ("button", "select", "textarea")
            raw = m[3] if m[2] else m[6]
            if not (raw or "").rstrip().endswith("/") or tag in ("script", "style", "title"):
                stop = re.compile(rf"</{tag}\s*(?:>|\Z)|</{tag}(?=[\s/])[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else end
            if tag not in ("script", "style"):
                pieces.append(" ")
            continue
        if tag in INLINE:
            here.tags += 1
            if tag == "br":
                pieces.append(" ")
            elif tag not in VOID:
                if tag == "a":
                    in_link += 1
                    here.links += 1
                stack.append((tag, stack[-1][1]))
            continue
        if tag in VOID:
            here.inputs += tag == "input"
            if tag in ("hr", "input"):
                flush()
            continue
        if tag in CLOSES_P or tag in CLOSED_BY:
            ends = CLOSED_BY.get(tag, {"p"})
            for depth in range(len(stack) - 1, 0, -1):
                name = stack[depth][0]
                if name in ends:
                    close(depth)
                    break
                if name not in INLINE and name != "p":
                    break
        flush()
        parent = stack[-1][1]
        raw = m[3] if m[2] else m[6]
        node = Node(tag, parent, nodes[parent].depth + 1, attribute_tokens(raw) if raw else frozenset(), len(nodes[parent].children))
        nodes[parent].children.append(len(nodes))
        stack.append((tag, len(nodes)))
        nodes.append(node)
    close(1)
    flush()
    return nodes, blocks


NAMES = (
    "article_tag", "foreign_tag", "article_tokens", "foreign_tokens", "above_article", "above_foreign", "is_p", "is_heading", "is_list", "is_div",
    "is_section", "depth", "log_chars", "log_own", "link_density", "link_rate", "tag_density", "mark_density", "mean_block", "n_blocks", "inputs",
    "n_children", "siblings", "order", "sibling_same", "place", "page_share", "parent_link_density", "parent_share", "before_chars", "after_chars",
    "before_links", "after_links",
)


def node_features(nodes: list[Node]) -> np.ndarray:
    """One row of ``NAMES`` for each node."""
    n = len(nodes)
    chars, linked, links, marks, blocks, tags, inputs = (np.array([getattr(x, a) for x in nodes], float) for a in ("own", "linked", "links", "marks", "blocks", "tags", "inputs"))
    own, parent = chars.copy(), [x.parent for x in nodes]
    before = np.cumsum(own) - own  # characters of nodes that began earlier
    for sums in (chars, linked, links, marks, blocks, tags, inputs):
        for i in range(n - 1, 0, -1):  # children come after their parents
            sums[parent[i]] += sums[i]
    article = [float(x.tag in ARTICLE_TAGS) for x in nodes]
    foreign = [float(x.tag in FOREIGN_TAGS) for x in nodes]
    good = [float(len(x.tokens & ARTICLE_TOKENS)) for x in nodes]
    odd = [float(len(x.tokens & FOREIGN_TOKENS)) for x in nodes]
    above_a, above_f = [0.0] * n, [0.0] * n
    for i in range(1, n):
        p = parent[i]
        above_a[i] = above_a[p] + article[p] + min(1.0, good[p])
        above_f[i] = above_f[p] + foreign[p] + min(1.0, odd[p])
    total = max(1.0, chars[0])
    density = linked / np.maximum(chars, 1)
    rows = np.zeros((n, len(NAMES)), np.float32)
    same: dict[tuple[int, str], int] = {}
    for x in nodes:
        same[x.parent, x.tag] = same.get((x.parent, x.tag), 0) + 1
    for i, x in enumerate(nodes):
        p = max(0, x.parent)
        brothers = nodes[p].children if i else [0]
        left = brothers[x.order - 1] if i and x.order else -1
        right = brothers[x.order + 1] if i and x.order + 1 < len(brothers) else -1
        rows[i] = (
            article[i], foreign[i], good[i], odd[i], min(3.0, above_a[i]), min(3.0, above_f[i]), x.tag == "p", x.tag in HEADINGS, x.tag in ("ul", "ol", "li", "dl", "dd", "dt"),
            x.tag == "div", x.tag == "section", min(30, x.depth), math.log1p(chars[i]), math.log1p(own[i]), density[i], links[i] / max(1.0, blocks[i]),
            tags[i] / (chars[i] + 1), marks[i] / (chars[i] + 1), math.log1p(chars[i] / max(1.0, blocks[i])), math.log1p(blocks[i]), inputs[i],
            math.log1p(len(x.children)), math.log1p(len(brothers)), math.log1p(x.order), same[x.parent, x.tag] / len(brothers), before[i] / total,
            chars[i] / total, density[p], chars[p] / total, math.log1p(chars[left]) if left >= 0 else -1, math.log1p(chars[right]) if right >= 0 else -1,
            density[left] if left >= 0 else -1, density[right] if right >= 0 else -1,
        )
    return rows


# --- boosted trees ------------------------------------------------------------------------------------------------


@dataclass
class Trees:
    """Complete binary trees of one depth: feature and threshold of each inner node, value of each leaf; ``start`` is the log-odds before them."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        depth = int(math.log2(self.feature.shape[1] + 1)) if self.feature.size else 0
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - len(f)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30, depth: int = 4, rate: float = 0.25, bins: int = 32, l2: float = 2.0) -> Trees:
    """Gradient boosting of logistic loss on binned features, second-order gains, level by level."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    base = float(np.clip((y * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    start = math.log(base / (1 - base))
    score = np.full(len(y), start)
    inner = 2**depth - 1
    features, thresholds, values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (p - y), weight * p * (1 - p)
        f, t = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            place = node - first
            best_gain = np.full(wide, 1e-6)
            best_bin = np.full(wide, bins)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                cell = place * (bins + 1) + binned[:, j]
                gs = np.bincount(cell, g, wide * (bins + 1)).reshape(wide, -1).cumsum(axis=1)
                hs = np.bincount(cell, h, wide * (bins + 1)).reshape(wide, -1).cumsum(axis=1)
                gl, hl, gt, ht = gs[:, : len(c)], hs[:, : len(c)], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                k = gain.argmax(axis=1)
                better = gain[np.arange(wide), k] > best_gain
                best_gain = np.where(better, gain[np.arange(wide), k], best_gain)
                best_bin = np.where(better, k, best_bin)
                f[first : first + wide][better] = j
                t[first : first + wide][better] = c[k[better]]
            at = f[node]
            node = 2 * node + 1 + (binned[np.arange(len(y)), at] > np.where(np.isinf(t[node]), bins, best_bin[place]))
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        v = -rate * gs / (hs + l2)
        score += v[leaf]
        features.append(f)
        thresholds.append(t)
        values.append(v)
    return Trees(start, np.array(features), np.array(thresholds), np.array(values))


# --- decoding -----------------------------------------------------------------------------------------------------


def decode(nodes: list[Node], log_odds: np.ndarray, enter: float = 2.0, cut: float = 0.5) -> list[bool]:
    """For each node, whether it is inside the article, under the best consistent labelling.

    A node is outside, inside or cut; children of an outside node may enter
    (at a price), children of an inside node may be cut (at a price), and what
    lies below a cut is cut. Inside nodes earn their log-odds, more with more own text.
    """
    n = len(nodes)
    earn = np.clip(log_odds, -8, 8) * np.array([0.5 + math.log1p(x.own) for x in nodes])
    outside, inside = np.zeros(n), earn.copy()
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        outside[p] += max(outside[i], inside[i] - enter)
        inside[p] += max(inside[i], -cut)
    state = [0] * n  # 0 outside, 1 inside, 2 cut
    for i, x in enumerate(nodes):
        above = state[x.parent] if i else 0
        if above == 0:
            state[i] = int(inside[i] - enter > outside[i])
        elif above == 1:
            state[i] = 1 if inside[i] >= -cut else 2
        else:
            state[i] = 2
    return [s == 1 for s in state]


# --- training pages -----------------------------------------------------------------------------------------------


def marked(nodes: list[Node]) -> list[bool] | None:
    """Whether each node is in the page's article by its own marks; None for a page that marks none."""
    out = [False] * len(nodes)
    for i, x in enumerate(nodes):
        above = out[x.parent] if i else False
        foreign = x.tag in FOREIGN_TAGS or bool(x.tokens & FOREIGN_TOKENS)
        out[i] = (above or x.tag in ARTICLE_TAGS) and not foreign
    return out if any(out) else None


def variants(page: str, other: str, rounds: int = 3) -> list[tuple[str, str]]:
    """``(page, page that labels it)``: the page itself, and in each round a page with foreign blocks grafted in and the same without telling tags."""
    return [(page, page), *(pair for k in range(rounds) for pair in _grafted(page, other, zlib.crc32(f"{k} {page}".encode())))]


def _grafted(page: str, other: str, pick: int) -> list[tuple[str, str]]:
    """The page with foreign blocks around and in its article and an own part in it, as it is and with its structural tags made plain.

    ``other``: prose for the grafts; ``pick``: what is grafted where. The second is labelled by the first.
    """
    words = other.split() or ["text"]
    prose = lambda k, n: entities.escape(" ".join((words * (1 + (k + n) // len(words)))[k % len(words) :][:n]))
    tokens = sorted(FOREIGN_TOKENS)
    name = lambda k: tokens[(pick + 7 * k) % len(tokens)]
    links = "".join(f'<li><a href="/{i}">{prose(3 * i, 2)}</a></li>' for i in range(3 + pick % 6))
    kinds = [
        f'<aside class="{name(1)}"><h3>{prose(5, 2)}</h3><ul>{links}</ul></aside>',
        f'<div class="{name(2)}-box"><p>{prose(11, 12 + pick % 30)}</p><p>{prose(60, 18)}</p></div>',
        f'<section id="comments"><h2>{prose(2, 1)}</h2><div class="comment"><p>{prose(31, 25)}</p></div><div class="comment"><p>{prose(77, 14)}</p></div></section>',
        f'<form action="/go"><label>{prose(8, 3)}</label><input name="q"><p>{prose(19, 8)}</p></form>',
        f'<div class="{name(3)}" id="{name(4)}">{prose(41, 16)}</div>',
        f"<header><p>{prose(9, 6)}</p><ul>{links}</ul></header>",
    ]
    own = [  # parts that belong to an article but that the pages at hand may lack
        f"<ul><li>{prose(13, 9)}</li><li>{prose(29, 14)}</li><li>{prose(51, 4)}</li></ul>",
        f"<blockquote><p>{prose(17, 22)}</p></blockquote>",
        f"<h2>{prose(23, 4)}</h2><div><p>{prose(37, 28)}</p><p>{prose(3, 9)}</p></div>",
        f"<table><tr><th>{prose(1, 1)}</th><td>{prose(6, 3)}</td></tr><tr><th>{prose(4, 2)}</th><td>{prose(15, 6)}</td></tr></table>",
        f"<section><h3>{prose(47, 3)}</h3><ol><li>{prose(53, 7)}</li><li>{prose(71, 12)}</li></ol></section>",
        f"<div>{prose(43, 20)}</div>",
    ][pick % 6]
    inner, before, after = (kinds[(pick >> s) % len(kinds)] for s in (0, 4, 8))
    grafted = re.sub(r"(<article\b[^>]*>)", lambda m: before + m[1], page, count=1)
    grafted = re.sub(r"(</p>)(?=<p)", lambda m: m[1] + inner + own, grafted, count=1)
    grafted = re.sub(r"(</article>)", lambda m: (inner if "section" in inner else "") + m[1] + after, grafted, count=1)
    plain = re.sub(r"(</?)(?:article|main|nav|footer|header|aside|section)\b", r"\1div", grafted)
    return [(grafted, grafted), (plain, grafted)]


def fit(pages: DataFrame, bound: int = 400, page_id: str = "page_id", html: str = "html", page_bytes: int = 1 << 18, node_bound: int = 200_000) -> Trees:
    """Train on at most ``bound`` pages of at most ``page_bytes``, the first in hash order of their id and html, and on the first ``node_bound`` of their nodes.

    These bounds keep what one task and the driver hold small whatever the pages are. Without any page that marks an article nothing is extracted.
    """
    ship(pages.sparkSession)
    source = pages.select(F.col(page_id).cast("string").alias("page_id"), F.col(html).cast("string").alias("html")).where(F.octet_length("html").between(1, page_bytes))
    some = source.orderBy(F.xxhash64("page_id", "html")).limit(bound)

    def run(batches):
        before = "text"
        for batch in batches:
            rows, labels = [], []
            for page in strings(batch.column("html")):
                for seen, labelled in variants(page, before):
                    nodes, _ = parse(seen)
                    truth = marked(parse(labelled)[0])
                    if truth and len(truth) == len(nodes):
                        rows += node_features(nodes).tolist()
                        labels += map(int, truth)
                before = " ".join(t for _, t in parse(page)[1])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float32())), pa.array(labels, pa.int32())], ["x", "y"])

    data = some.mapInArrow(run, "x array<float>, y int").limit(node_bound).collect()
    if not data or len({r["y"] for r in data}) < 2:
        return Trees(-8.0, np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)))
    x, y = np.array([r["x"] for r in data], np.float32), np.array([r["y"] for r in data], float)
    weight = 0.3 + x[:, NAMES.index("log_own")] / 5
    return boost(x, y, weight)


def extract(pages: DataFrame, trees: Trees, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page; null or empty html, and pages without an article, give ''. Repeated rows stay."""

    def run(batches):
        for batch in slices(batches, "html", 2_000_000):
            parsed = [parse(x) for x in strings(batch.column("html"))]
            odds = trees.log_odds(np.concatenate([node_features(nodes) for nodes, _ in parsed]))
            texts, at = [], 0
            for nodes, blocks in parsed:
                inside = decode(nodes, odds[at : at + len(nodes)])
                at += len(nodes)
                texts.append("\n".join(t for i, t in blocks if inside[i]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return source.mapInArrow(run, f"page_id {source.schema[0].dataType.simpleString()}, url string, text string, n_chars bigint")
