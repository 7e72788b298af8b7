"""Main text of web pages by gradient-boosted trees over DOM nodes."""

from __future__ import annotations

import html as entities
import math
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusmill.llm.common import map_rows

TRAINING_PAGES, TRAINING_CHARS = 200, 8_000_000   # pages the trees are fitted on, and their characters in all
DRESSINGS = 3                                  # labelled templates that a sampled page's text is put in
TREES, DEPTH, RATE, BINS = 40, 4, 0.25, 32
SWITCH_COST = 1.0                              # of a node that is neither kept nor dropped as a whole
PAGES_AT_ONCE = 64

_RAW = "script|style|iframe|textarea"        # what follows is text up to their end tag, as the standard has it
_HIDDEN = frozenset("noscript template svg select button".split())
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<title\b[^>]*>(?:[^<]|<(?![a-zA-Z/!]))*(?:</title\s*>)?|<({_RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[/!?a-zA-Z][^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_TOKEN = re.compile(r"[a-z]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data dfn del em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
_CLOSES_P = frozenset("address article aside blockquote body center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                      "hr main menu nav ol p pre section table ul".split())
_SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table menu body html".split())
_TAG_GROUPS = {g: i for i, names in enumerate((
    "p", "h1 h2 h3 h4 h5 h6", "li dt dd", "div", "section", "article main", "nav menu", "header", "footer", "aside", "form fieldset input",
    "td th", "tr table tbody thead", "ul ol dl", "blockquote pre", "figure figcaption", "body html #")) for g in names.split()}
_GROUPS = 18
# Tokens of class, id, role and itemprop that speak for and against main text.
_GOOD = frozenset("article articlebody content entry main post story text body blog page prose".split())
_BAD = frozenset("nav navbar navigation menu header masthead footer foot sidebar side aside widget promo ad ads advert advertisement banner sponsor sponsored "
                 "cookie consent gdpr notice alert popup modal overlay comment comments disqus reply respond share social related recommend breadcrumb "
                 "breadcrumbs form login signup subscribe newsletter search tags meta pagination pager copyright legal complementary contentinfo".split())


@dataclass
class Page:
    """Block elements of a page in document order, and its text in segments of one block each."""
    tag: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    good: list[int] = field(default_factory=list)
    bad: list[int] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)
    inner: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    segments: list[tuple[int, list[str]]] = field(default_factory=list)


def parse(source: str, labelled: bool = True) -> Page:
    """A forgiving parser: unclosed and stray tags, missing ends and raw-text elements do not break it.

    The text of buttons, selects, icons, templates and noscript is left out up
    to their end tag or the end of the block around them; one that is closed by
    itself, or has no end tag anywhere after it, hides nothing, and a block
    that starts inside a button, select or icon ends it. ``labelled`` reads the
    mark of the training layouts; pages from outside are parsed without.
    """
    page, stack, names, link, hidden, at, seen, fresh = Page(), [], [], 0, 0, 0, 0, True
    ends: dict[str, int] = {}

    def ends_later(name: str, here: int) -> bool:
        if name not in ends:
            ends[name] = max((m.start() for m in re.finditer(f"</{name}", source, re.I)), default=-1)
        return ends[name] >= here

    def open_node(name: str, attributes: str) -> None:
        up = stack[-1] if stack else -1
        good = bad = 0
        label = page.label[up] if up >= 0 else -1
        if "=" in attributes:
            for key, *values in _ATTRIBUTE.findall(attributes):
                key = key.lower()
                if key in ("class", "id", "role", "itemprop"):
                    tokens = _TOKEN.findall("".join(values).lower())
                    good += sum(t in _GOOD for t in tokens)
                    bad += sum(t in _BAD for t in tokens)
                elif labelled and key == "data-y":
                    label = int("".join(values))
        stack.append(len(page.tag))
        names.append(name)
        page.tag.append(_TAG_GROUPS.get(name, _GROUPS - 1))
        page.parent.append(up)
        page.depth.append(len(stack))
        page.good.append(good)
        page.bad.append(bad)
        page.label.append(label)
        page.first.append(seen)
        for column in (page.chars, page.linked, page.marks, page.inner):
            column.append(0)

    def text(raw: str) -> None:
        nonlocal seen, fresh
        if hidden or not raw:
            return
        decoded = entities.unescape(raw) if "&" in raw else raw
        size = len(decoded)
        if not fresh or not decoded.isspace():
            node = stack[-1]
            if fresh:
                page.segments.append((node, []))
            page.segments[-1][1].append(decoded)
            fresh = False
            page.chars[node] += size
            page.marks[node] += decoded.count(".") + decoded.count(",")
            if link:
                page.linked[node] += size
            seen += size

    open_node("#", "")
    for m in _MARKUP.finditer(source):
        if m.start() > at:
            text(source[at:m.start()])
        at = m.end()
        name = m.group(3)
        if name is None:
            fresh = fresh if hidden or m.group().startswith("<!--") else True
            continue
        name = name.lower()
        if name == "head":
            continue
        if name in _INLINE:
            if name == "a":
                link = 0 if m.group(2) else 1
            if not hidden:
                page.inner[stack[-1]] += 1
        elif name in _VOID:
            if not hidden:
                page.inner[stack[-1]] += 1
                if name in ("br", "hr", "input"):
                    fresh = True
        elif m.group(2):
            if name in names:
                while names[-1] != name:
                    names.pop()
                    stack.pop()
                names.pop()
                stack.pop()
            link, fresh = 0, fresh if name == "svg" or hidden and len(names) >= hidden else True
        elif name in _HIDDEN and not hidden:
            fresh = fresh if name == "svg" else True
            if not m.group(4).rstrip().endswith("/") and ends_later(name, at):
                names.append(name)
                stack.append(stack[-1])
                hidden = len(names)
        else:
            if hidden and name in _CLOSES_P and names[hidden - 1] in ("button", "select", "svg"):
                del names[hidden - 1:], stack[hidden - 1:]
                hidden = 0
            if hidden:
                if not m.group(4).rstrip().endswith("/"):
                    names.append(name)
                    stack.append(stack[-1])
                continue
            fresh, link = True, 0
            if name in _CLOSES_P and "p" in names:
                while names.pop() != "p":
                    stack.pop()
                stack.pop()
            for other in _SELF_CLOSING.get(name, ()):
                back = next((i for i in range(len(names) - 1, 0, -1) if names[i] == other or names[i] in _SCOPES), 0)
                if back and names[back] == other:
                    del names[back:], stack[back:]
            open_node(name, m.group(4))
        if len(names) < hidden:
            hidden = 0
    text(source[at:])
    return page


def node_features(pages: list[Page]) -> np.ndarray:
    """Feature rows of all nodes of the pages, page after page."""
    return np.concatenate([_features(p) for p in pages])


def _features(p: Page) -> np.ndarray:
    n = len(p.tag)
    parent = np.array(p.parent)
    own = np.array([p.chars, p.linked, p.marks, p.inner, [1] * n], float)
    total = own.copy()
    up_good, up_bad = list(p.good), list(p.bad)
    columns = total.T
    for i in range(n - 1, 0, -1):
        columns[p.parent[i]] += columns[i]
    for i in range(1, n):
        up_good[i] += up_good[p.parent[i]]
        up_bad[i] += up_bad[p.parent[i]]
    parent[0] = 0
    chars, page_chars = total[0], max(1.0, total[0][0])
    siblings = np.bincount(parent[1:], minlength=n)[parent] if n > 1 else np.ones(n)
    same = np.zeros(n)
    if n > 1:
        key = parent * 64 + np.array(p.tag)
        _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
        same = counts[back]
    before, after = np.zeros(n), np.zeros(n)
    last: dict[int, int] = {}
    for i in range(1, n):
        j = last.get(p.parent[i])
        if j is not None:
            before[i], after[j] = chars[j], chars[i]
        last[p.parent[i]] = i
    tag = np.array(p.tag)
    groups = (tag[:, None] == np.arange(_GROUPS)).astype(float)
    up_groups = (tag[parent][:, None] == np.arange(_GROUPS)).astype(float)
    rest = np.stack([
        np.array(p.depth, float), np.log1p(own[0]), np.log1p(chars), own[1] / np.maximum(1, own[0]), total[1] / np.maximum(1, chars),
        total[2] / np.maximum(1, chars) * 100, own[2] / np.maximum(1, own[0]) * 100, np.log1p(chars / total[4]), (total[3] + total[4]) / np.maximum(1, chars) * 100,
        chars / page_chars, np.array(p.first) / page_chars, np.log1p(siblings), same / np.maximum(1, siblings), np.log1p(before), np.log1p(after),
        np.log1p(chars[parent]), chars / np.maximum(1, chars[parent]), np.array(p.good, float), np.array(p.bad, float),
        np.array(up_good, float), np.array(up_bad, float), np.log1p(total[4])], axis=1)
    return np.concatenate([rest, groups, up_groups], axis=1)


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth: split feature and threshold by node, value by leaf."""
    split: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for split, threshold, value in zip(self.split, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, split[node]] > threshold[node])
            out += value[node - (2 ** DEPTH - 1)]
        return out


def fit_forest(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Forest:
    """Logistic gradient boosting on binned features; each level of a tree is split by Newton gain."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
    rate = np.average(y, weights=weight).clip(1e-3, 1 - 1e-3)
    bias = math.log(rate / (1 - rate))
    margin, inside = np.full(len(y), bias), 2 ** DEPTH - 1
    splits, thresholds, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        split, threshold = np.zeros(inside, np.int64), np.full(inside, np.inf)
        for level in range(DEPTH):
            base, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-6)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                slot = (node - base) * BINS + binned[:, f]
                g = np.bincount(slot, grad, width * BINS).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(slot, hess, width * BINS).reshape(width, BINS).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g ** 2 / (all_h + 1)
                gain[:, len(e):] = 0
                at = gain.argmax(axis=1)
                for k in np.flatnonzero(gain[np.arange(width), at] > best):
                    best[k], split[base + k], threshold[base + k] = gain[k, at[k]], f, e[at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), split[node]] > threshold[node])
        leaf = node - inside
        value = -RATE * np.bincount(leaf, grad, inside + 1) / (np.bincount(leaf, hess, inside + 1) + 1)
        margin += value[leaf]
        splits.append(split)
        thresholds.append(threshold)
        values.append(value)
    return Forest(np.array(splits), np.array(thresholds), np.array(values), bias)


def decode(page: Page, margin: np.ndarray) -> list[bool]:
    """Which nodes are kept, without contradictions.

    A node is kept as a whole, dropped as a whole, or divided. Under a kept
    node all are kept, under a dropped one none; a divided node costs
    ``SWITCH_COST`` and leaves the choice to its children. The cheapest
    assignment is found from the leaves up and read from the root down.
    """
    n = len(page.tag)
    log_no = -np.logaddexp(0, margin)
    log_yes = log_no + margin
    weight = np.log1p(np.array(page.chars)) + 0.05
    keep, drop = (weight * log_yes).tolist(), (weight * log_no).tolist()
    split = [max(a, b) - SWITCH_COST for a, b in zip(keep, drop)]
    own = [a > b for a, b in zip(keep, drop)]
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        keep[up] += keep[i]
        drop[up] += drop[i]
        split[up] += max(keep[i], drop[i], split[i])
    kept, state = [False] * n, [0] * n
    for i in range(n):
        up = state[page.parent[i]] if i else 0
        state[i] = up or (1 if keep[i] >= max(drop[i], split[i]) else -1 if drop[i] >= split[i] else 0)
        kept[i] = state[i] > 0 or state[i] == 0 and own[i]
    return kept


def page_text(page: Page, kept: list[bool]) -> str:
    parts = (" ".join("".join(texts).split()) for node, texts in page.segments if kept[node])
    return " ".join(p for p in parts if p)


def _weak_labels(page: Page) -> list[int]:
    """Labels of a page that marks its article itself; -1 where it does not say."""
    article, off = _TAG_GROUPS["article"], {_TAG_GROUPS[t] for t in ("nav", "header", "footer", "aside", "form")}
    if article not in page.tag:
        return [-1] * len(page.tag)
    out = []
    for i, tag in enumerate(page.tag):
        up = out[page.parent[i]] if i else 0
        out.append(0 if tag in off or page.bad[i] and not page.good[i] else 1 if tag == article else up)
    return out


def dress(title: str, blocks: list[str], others: list[str], rng: random.Random) -> str:
    """A page with the given article in one of many layouts; data-y tells the truth about each part."""
    pick = rng.choice
    esc = entities.escape

    def words(k: int) -> str:
        return " ".join(pick(others).split()[:k]) or "more"

    def links(k: int, item: str = "li") -> str:
        return "".join(f'<{item}><a href="/{i}">{esc(words(rng.randint(1, 4)))}</a></{item}>' for i in range(k))

    def sentences(k: int) -> str:
        return "".join(f"<p>{esc(pick(others)[:rng.randint(40, 400)])}</p>" for _ in range(k))

    vague = [f'class="{c}{rng.randint(1, 99)}"' for c in "abcx"]
    off = {
        "menu": [f"<nav data-y=0><ul>{links(rng.randint(3, 9))}</ul></nav>", f'<div data-y=0 class="menu">{links(6, "span")}</div>', f'<ul data-y=0 {pick(vague)}>{links(8)}</ul>'],
        "head": [f"<header data-y=0><h2>{esc(words(3))}</h2><p>{esc(words(8))}</p></header>", f'<div data-y=0 id="header">{esc(words(6))}</div>'],
        "ad": [f'<div data-y=0 class="ad">{esc(words(10))}</div>', f'<div data-y=0 class="banner sponsored"><p>{esc(words(14))}</p></div>', f'<aside data-y=0 class="promo">{sentences(1)}</aside>'],
        "side": [f'<aside data-y=0><h3>{esc(words(2))}</h3><ul>{links(5)}</ul></aside>', f'<div data-y=0 class="sidebar widget">{sentences(1)}<ul>{links(4)}</ul></div>',
                 f'<div data-y=0 class="related"><h3>{esc(words(2))}</h3>{links(4, "p")}</div>'],
        "notice": [f'<div data-y=0 class="cookie-notice">{esc(words(18))} <a href="#">{esc(words(1))}</a></div>', f'<div data-y=0 role="alert"><p>{esc(words(15))}</p></div>'],
        "form": [f'<form data-y=0><label>{esc(words(2))}</label><input type="text"><button>{esc(words(1))}</button></form>', f'<form data-y=0 class="newsletter"><p>{esc(words(12))}</p><input name="e"></form>'],
        "comments": [f'<section data-y=0 class="comments"><h3>{esc(words(2))}</h3>' + "".join(f'<div class="comment"><b>{esc(words(1))}</b>{sentences(1)}</div>' for _ in range(rng.randint(1, 6))) + "</section>",
                     f'<ol data-y=0 id="comments">' + "".join(f"<li><p>{esc(words(1))}</p>{sentences(1)}</li>" for _ in range(rng.randint(1, 5))) + "</ol>"],
        "foot": [f"<footer data-y=0>&copy; {esc(words(6))}</footer>", f'<div data-y=0 class="footer"><p>{esc(words(10))}</p>{links(3, "span")}</div>'],
    }
    part = lambda name, chance: pick(off[name]) if rng.random() < chance else ""
    style = rng.random()
    if style < 0.6:
        end = "" if rng.random() < 0.2 else "</p>"
        body = "".join(f"<p>{esc(b)}{end}" for b in blocks)
    elif style < 0.75:
        body = "<br><br>".join(map(esc, blocks))
    elif style < 0.9:
        body = "".join(f"<div>{esc(b)}</div>" for b in blocks)
    else:
        body = f"<p>{esc(blocks[0])}</p><ul>" + "".join(f"<li>{esc(b)}</li>" for b in blocks[1:4]) + "</ul>" + "".join(f"<p>{esc(b)}</p>" for b in blocks[4:])
    inner = f"<h1>{esc(title)}</h1>{body}"
    if rng.random() < 0.3:
        inner = inner.replace("</p>", "</p>" + part("ad", 1.0), 1)
    open_tag, close_tag = pick([("<article data-y=1>", "</article>"), ("<main data-y=1>", "</main>"), ('<div data-y=1 class="post-content">', "</div>"), ('<div data-y=1 id="content">', "</div>"),
                                ('<section data-y=1 class="entry">', "</section>"), (f"<div data-y=1 {pick(vague)}>", "</div>"), (f"<div {pick(vague)}><div data-y=1 {pick(vague)}>", "</div></div>")])
    top = [part("notice", 0.3), part("head", 0.5), part("menu", 0.8), part("ad", 0.4)]
    bottom = [part("ad", 0.3), part("side", 0.5), part("comments", 0.4), part("form", 0.3), part("foot", 0.8)]
    middle = "".join(top) + (part("side", 0.3)) + open_tag + inner + close_tag + "".join(bottom)
    return f"<html><head><title>{esc(title)}</title></head><body data-y=0>{middle}</body></html>"


def fit(pages: DataFrame, most: int = TRAINING_PAGES, chars: int = TRAINING_CHARS) -> Forest:
    """Learn the trees from a bounded sample of the given pages.

    Of the ``most`` pages with the lowest hashes those reach the driver, whole,
    that together have no more than ``chars`` characters, in the order of their
    hashes; the shortest one always does. Where such a page marks its article,
    that is a label; its text is also put in ``DRESSINGS`` layouts whose parts
    are known.
    """
    known = pages.where("html IS NOT NULL AND length(html) > 0").select("html", F.xxhash64("html").alias("code"))
    lowest = known.groupBy("code").agg(F.max(F.length("html")).alias("size")).orderBy("code").limit(most).collect()
    taken, left = {r["code"] for r in sorted(lowest, key=lambda r: r["size"])[:1]}, chars
    for r in lowest:
        if r["size"] <= left:
            taken.add(r["code"])
            left -= r["size"]
    sample = known.where(F.col("code").isin(list(taken))).groupBy("code").agg(F.min("html").alias("html")).orderBy("code").collect()
    rng = random.Random(9)
    parsed = [parse(r["html"], labelled=False) for r in sample]
    texts = []
    for page in parsed:
        weak = _weak_labels(page)
        blocks = [" ".join("".join(t).split()) for node, t in page.segments if weak[node] != 0]
        texts.append([b for b in blocks if len(b) > 1] or ["Text."])
    if not texts:
        texts = [["Text."]]
    train = [(p, w) for p, w in ((p, _weak_labels(p)) for p in parsed) if -1 not in w]
    flat = [b for t in texts for b in t]
    for blocks in texts:
        for _ in range(DRESSINGS):
            p = parse(dress(blocks[0][:80], blocks, flat, rng))
            train.append((p, [max(0, v) for v in p.label]))
    x = node_features([p for p, _ in train])
    y = np.concatenate([np.array(w, float) for _, w in train])
    weight = np.concatenate([np.log1p(np.array(p.chars, float)) + 0.2 for p, _ in train])
    return fit_forest(x, y, weight / weight.mean())


def extract(sources: list[str], forest: Forest) -> list[str]:
    """Main texts of whole pages; nodes of several pages go through the trees together."""
    out = []
    for at in range(0, len(sources), PAGES_AT_ONCE):
        parsed = [parse(s, labelled=False) for s in sources[at:at + PAGES_AT_ONCE]]
        margin = forest.margin(node_features(parsed))
        start = 0
        for page in parsed:
            stop = start + len(page.tag)
            out.append(page_text(page, decode(page, margin[start:stop])))
            start = stop
    return out


def main_text(pages: DataFrame, most: int = TRAINING_PAGES, chars: int = TRAINING_CHARS) -> DataFrame:
    """(page_id, url, text, n_chars) per row: the article's blocks in page order, from the whole html.

    ``most`` and ``chars`` bound the sample of ``fit``. Null and empty pages, and pages without text, give the empty text. Extra
    columns are ignored, repeated rows stay, no rows give no rows. Pages are
    not shuffled.
    """
    forest = fit(pages, most, chars)
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def of_batch(batch: pa.RecordBatch) -> dict:
        texts = extract([h or "" for h in batch.column(2).to_pylist()], forest)
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    return map_rows(pages.select("page_id", "url", "html"), of_batch, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
