"""Main text of web pages by boosted trees over DOM nodes.

A page is read into its block elements, each with the range of text blocks
below it, so that the features of all nodes of a batch are differences of
running sums. Trees fitted on rearranged pages estimate which share of a
node's text is article. Decoding goes from the leaves up: a node is taken
whole, dropped whole, or left to its children, whatever explains its text
best, so no choice contradicts one above or below it.
"""

import html
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distaff.llm import boosted_trees
from distaff.llm.common import distinct_sample

#: Distinct pages that training rearranges, at most, chosen by a hash of the whole page,
#: and layouts made of each.
FIT_PAGES, LAYOUTS = 250, 3
#: What leaving a node to its children costs, in characters times nats.
DESCENT = 1.0
#: Attribute that marks the truth in pages made for training, unless another is drawn.
MARK = "data-truth"

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z!?][^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
TOKEN = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr input area base col embed link meta param source track picture".split()
)
VOID = frozenset("br img input area base col embed link meta param source track wbr hr".split())
RAW = frozenset("script style textarea title noframes xmp iframe".split())
NESTED = frozenset("template svg math object".split())
HIDDEN = frozenset("head template noscript svg math select button object canvas audio video datalist map".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: Start tags that may stand in a head; others end it, as text does.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
#: Start tags that end hidden elements which nothing closes.
BLOCK = CLOSES_P | frozenset("body li dd dt table".split()) - {"hr"}
#: Start tags that end open elements of these kinds, up to a container.
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
CONTAINERS = frozenset("ul ol dl menu table tbody thead tfoot tr td th div section article aside nav header footer main form body".split())
#: Words of class, id and role by what they tell; the last group speaks for an article.
GROUPS = (
    "menu nav navbar navigation breadcrumb breadcrumbs tabs toolbar skip pagination pager topbar",
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted dfp adslot adsbox outbrain taboola",
    "comment comments commentlist discussion disqus reply replies respond reader readers",
    "share sharing social follow twitter facebook like likes buttons",
    "sidebar aside related recommended recommendations popular trending widget widgets rail more teaser teasers secondary complementary",
    "header masthead footer foot copyright legal colophon site sitemap contentinfo logo brand imprint",
    "cookie cookies consent gdpr notice notices alert alerts popup modal overlay warning message privacy paywall disclaimer",
    "form login signup signin register search subscribe subscription newsletter poll vote contact",
    "article content main post entry story body text page copy prose blog news detail",
)
KINDS = ("nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "p", "ul", "li", "table", "h")
BOILERPLATE = (1 << (len(GROUPS) - 1)) - 1
ARTICLE = 1 << (len(GROUPS) - 1)
BY_TOKEN = {word: 1 << i for i, words in enumerate(GROUPS) for word in words.split()}
BY_TAG = {"nav": 1, "aside": 16, "header": 32, "footer": 32, "form": 128, "article": ARTICLE, "main": ARTICLE, "dialog": 64}
KIND = {**{k: i for i, k in enumerate(KINDS)}, "ol": 10, "menu": 10, "dl": 10, **{f"h{i}": 13 for i in range(1, 7)}}


class Page(NamedTuple):
    """Block elements in document order, and the text blocks between their tags."""

    nodes: list[tuple]  # parent, kind, own mask, inherited mask, depth, gold
    spans: list[list[int]]  # first block, last block + 1, last node + 1
    blocks: list[tuple[str, int, int]]  # text, characters in links, node


def _mask(tag: str, attributes: str, mark: str | None) -> tuple[int, int]:
    """Groups of a tag, and the truth that the attribute ``mark`` of training pages tells (-1: none)."""
    mask, gold = BY_TAG.get(tag, 0), -1
    if "=" in attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            value = "".join(values)
            if name == mark:
                gold = int(value)
            elif name.lower() in ("class", "id", "role"):
                for token in TOKEN.findall(CAMEL.sub(" ", value).lower()):
                    mask |= BY_TOKEN.get(token, 0)
    return mask, gold


def _unclosed(source: str) -> set[int]:
    """Where start tags of hidden elements end that have no end tag of their own."""
    open_tags: dict[str, list[int]] = {}
    lost, at = set(), 0
    while found := TAG.search(source, at):
        at = found.end()
        ends, tag = found.group(1, 2) if found.group(2) else found.group(4, 5)
        tag = (tag or "").lower()
        if tag in RAW and not ends:
            stop = re.compile(f"</{tag}", re.I).search(source, at)
            at = stop.start() if stop else len(source)
        elif tag in HIDDEN:
            begun = open_tags.setdefault(tag, [])
            if not ends:
                if tag not in NESTED:
                    lost.update(begun)
                    begun.clear()
                begun.append(at)
            elif begun:
                begun.pop()
    return lost.union(*open_tags.values())


def read_page(text: str | None, mark: str | None = None) -> Page:
    """Tolerant reading: implied end tags, unclosed and stray tags, comments, raw text.

    A head ends at what can't stand in it; another hidden element without an
    end tag ends at the next block. ``mark`` names the attribute that tells
    the truth in training pages; others have none, whatever their attributes
    are. Open elements are found by name, so time follows the page's length,
    also with deep nesting and many stray tags.
    """
    source = text or ""
    nodes: list[tuple] = [(-1, -1, 0, 0, 0, -1)]
    spans, blocks = [[0, 0, 0]], []
    stack: list[tuple[int, str]] = [(0, "")]
    run: list[str] = []
    linked, in_link, hidden, at = 0, False, 0, 0
    begun: list[tuple[int, int]] = []  # hidden elements that are open: place in the stack, end of the start tag
    lost: set[int] | None = None
    unended: list[int] = []  # those of ``begun`` that nothing closes, by place in the stack
    opened: dict[str, list[int]] = {}  # places in the stack of the open elements of each name

    def innermost(names) -> int:
        return max((opened[name][-1] for name in names if opened.get(name)), default=0)

    def outermost_above(names, floor: int) -> int:
        places = (opened.get(name, ()) for name in names)
        return min((x[i] for x in places if (i := bisect_right(x, floor)) < len(x)), default=len(stack))

    def flush() -> None:
        nonlocal linked
        words = " ".join("".join(run).split())
        if words:
            blocks.append((words, min(linked, len(words)), stack[-1][0]))
        run.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal hidden
        flush()
        while len(stack) > to:
            node, tag = stack.pop()
            spans[node][1:] = len(blocks), len(nodes)
            if tag:
                opened[tag].pop()
            if tag in HIDDEN:
                hidden -= 1
                begun.pop()
                if unended and unended[-1] == len(stack):
                    unended.pop()

    def end_head() -> None:
        if stack[-1][1] == stack[begun[0][0]][1] == "head":
            close(begun[0][0])

    while True:
        found = TAG.search(source, at)
        if hidden and source[at : found.start() if found else len(source)].strip():
            end_head()
        if not hidden:
            piece = html.unescape(source[at : found.start() if found else len(source)])
            if piece:
                run.append(piece)
                linked += len(piece) if in_link else 0
        if found is None:
            break
        at = found.end()
        ends, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if hidden and not ends:
            if tag in BLOCK and stack[begun[-1][0]][1] != "head":
                if lost is None:
                    lost = _unclosed(source)
                    unended = [depth for depth, place in begun if place in lost and stack[depth][1] != "head"]
                close(unended[0] if unended else len(stack))
            if hidden and tag not in IN_HEAD:
                end_head()
        if tag in RAW:
            if not ends:
                stop = re.compile(f"</{tag}", re.I).search(source, at)
                at = stop.start() if stop else len(source)
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = not ends
            elif tag == "br" and not hidden:
                run.append(" ")
            continue
        in_link = False
        if ends:
            depth = innermost((tag,))
            if depth:
                close(depth)
            else:
                flush()
            continue
        if tag in CLOSES_P:
            depth = innermost(("p",))
            if depth > innermost(CONTAINERS):
                close(depth)
        elif tag in SAME_LEVEL:
            close(outermost_above(SAME_LEVEL[tag], innermost(CONTAINERS - SAME_LEVEL[tag])))
        flush()
        if tag in VOID:
            continue
        parent = stack[-1][0]
        mask, gold = _mask(tag, attributes, mark)
        above = nodes[parent]
        nodes.append((parent, KIND.get(tag, -1), mask, above[3] | mask, above[4] + 1, gold if gold >= 0 else above[5]))
        spans.append([len(blocks), 0, 0])
        stack.append((len(nodes) - 1, tag))
        opened.setdefault(tag, []).append(len(stack) - 1)
        if tag in HIDDEN:
            hidden += 1
            begun.append((len(stack) - 1, at))
            if lost and at in lost and tag != "head":
                unended.append(len(stack) - 1)
    close(0)
    return Page(nodes, spans, blocks)


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


class Batch(NamedTuple):
    """Nodes of many pages end to end."""

    features: np.ndarray
    chars: np.ndarray
    parent: np.ndarray
    first: np.ndarray  # node of each page
    share: np.ndarray  # of the text that is marked as article, nan without text


def measure(pages: list[Page]) -> Batch:
    """Features of all nodes: subtree densities, attribute groups, depth and siblings."""
    n_nodes = np.array([len(p.nodes) for p in pages], dtype=np.int64)
    n_blocks = np.array([len(p.blocks) for p in pages], dtype=np.int64)
    node_base, block_base = _running(n_nodes)[:-1], _running(n_blocks)[:-1]
    raw = np.array([x for p in pages for x in p.nodes], dtype=np.int64).reshape(-1, 6)
    spans = np.array([x for p in pages for x in p.spans], dtype=np.int64).reshape(-1, 3)
    page = np.repeat(np.arange(len(pages)), n_nodes)
    kind, own, inherited, depth, gold = raw[:, 1:].T
    parent = raw[:, 0] + node_base[page]
    parent[raw[:, 0] < 0] = np.flatnonzero(raw[:, 0] < 0)
    lo, hi = spans[:, 0] + block_base[page], spans[:, 1] + block_base[page]
    index, end = np.arange(len(raw)), spans[:, 2] + node_base[page]
    blocks = [b for p in pages for b in p.blocks]
    owner = np.array([b[2] for b in blocks], dtype=np.int64) + np.repeat(node_base, n_blocks)
    chars = np.array([len(b[0]) for b in blocks], dtype=np.float64)
    sums = {
        "chars": chars,
        "linked": np.array([b[1] for b in blocks], dtype=np.float64),
        "marks": np.array([sum(b[0].count(m) for m in ".,;?!") for b in blocks], dtype=np.float64),
        "long": (chars > 80).astype(np.float64),
        "bad": chars * ((inherited[owner] & BOILERPLATE) > 0),
        "good": chars * ((inherited[owner] & ARTICLE) > 0),
        "gold": chars * (gold[owner] == 1),
    }
    sums = {k: (r := _running(v))[hi] - r[lo] for k, v in sums.items()}
    total = np.maximum(sums["chars"], 1.0)
    n = np.maximum(hi - lo, 1)
    before = _running(chars)
    page_chars = np.maximum(sums["chars"][node_base], 1.0)[page]

    def of_kind(k: int) -> np.ndarray:
        r = _running(kind == k)
        return r[end] - r[index]

    children = np.bincount(parent[raw[:, 0] >= 0], minlength=len(raw))
    alike = parent * 16 + kind + 1
    _, at, counts = np.unique(alike, return_inverse=True, return_counts=True)
    up = sums["chars"][parent]
    columns = [
        *[kind == k for k in range(len(KINDS))],
        *[(own >> g) & 1 for g in range(len(GROUPS))],
        *[((inherited[parent] >> g) & 1) for g in range(len(GROUPS))],
        (inherited & BOILERPLATE) > 0,
        np.log1p(sums["chars"]),
        sums["linked"] / total,
        sums["marks"] / total,
        sums["long"] / n,
        sums["bad"] / total,
        sums["good"] / total,
        np.log1p(sums["chars"] / n),
        np.log1p(sums["chars"] / np.maximum(end - index, 1)),
        np.log1p(n),
        np.log1p(of_kind(9)),
        np.log1p(of_kind(11)),
        np.log1p(of_kind(13)),
        of_kind(4) > 0,
        depth,
        children,
        children[parent],
        counts[at],
        sums["chars"] / np.maximum(up, 1.0),
        np.log1p(up / np.maximum(children[parent], 1)),
        sums["linked"][parent] / np.maximum(up, 1.0),
        (before[lo] - before[block_base[page]]) / page_chars,
        (before[hi] - before[block_base[page]]) / page_chars,
        sums["chars"] / page_chars,
    ]
    features = np.stack([np.asarray(c, dtype=np.float64) for c in columns], axis=1)
    share = np.where(sums["chars"] > 0, sums["gold"] / total, np.nan)
    return Batch(features, sums["chars"], parent, node_base, share)


def decode(page: Page, probability: np.ndarray, chars: np.ndarray) -> list[str]:
    """Blocks of the subtrees that are taken.

    Text of a node outside its child nodes follows the node. Ties go to the
    coarser choice, taking before dropping.
    """
    p = np.clip(probability, 1e-4, 1 - 1e-4)
    take, drop = (chars * np.log(p)).tolist(), (chars * np.log(1 - p)).tolist()
    n = len(page.nodes)
    below, text = [0.0] * n, [0.0] * n
    choice = [1] * n
    values = chars.tolist()
    for i in range(n - 1, -1, -1):
        own = max(0.0, values[i] - text[i])
        per = max(take[i], drop[i]) / values[i] if values[i] else 0.0
        best, choice[i] = (take[i], 1) if take[i] >= drop[i] else (drop[i], 0)
        if page.spans[i][2] > i + 1 and below[i] + own * per - DESCENT > best:
            best, choice[i] = below[i] + own * per - DESCENT, 2 + choice[i]
        parent = page.nodes[i][0]
        if parent >= 0:
            below[parent] += best
            text[parent] += values[i]
    settled: list[int] = []
    for i in range(n):
        parent = page.nodes[i][0]
        settled.append(choice[i] if parent < 0 or settled[parent] >= 2 else settled[parent])
    return [t for t, _, node in page.blocks if settled[node] in (1, 3)]


MENUS = ("<nav {}>{}</nav>", '<div class="menu" {}>{}</div>', '<div id="navigation" {}>{}</div>', '<ul class="navbar" {}>{}</ul>', '<div class="breadcrumbs" {}>{}</div>')
HEADS = ("<header {}>{}</header>", '<div class="site-header" {}>{}</div>', '<div id="masthead" {}>{}</div>', '<div class="logo" {}>{}</div>')
FEET = ("<footer {}>{}</footer>", '<div class="footer" {}>{}</div>', '<div id="copyright" {}>{}</div>', '<div class="legal" {}>{}</div>')
SIDES = ("<aside {}>{}</aside>", '<div class="sidebar" {}>{}</div>', '<div class="related" {}>{}</div>', '<section class="widget" {}>{}</section>', '<div id="popular" {}>{}</div>')
ADVERTS = ('<div class="ad" {}>{}</div>', '<div class="advert" {}>{}</div>', '<div class="banner" {}>{}</div>', '<div id="sponsored" {}>{}</div>', '<p class="promo" {}>{}</p>', '<ins class="ads" {}>{}</ins><div class="ads" {}>{}</div>')
NOTICES = ('<div class="cookie-notice" {}>{}</div>', '<div id="consent" {}>{}</div>', '<div class="alert" {}>{}</div>', '<div role="alert" {}>{}</div>', '<div class="newsletter" {}>{}</div>')
FORMS = ("<form {}>{}</form>", '<div class="search-form" {}>{}</div>', '<form class="login" {}>{}</form>')
COMMENTS = ('<section class="comments" {}>{}</section>', '<div id="comments" {}>{}</div>', '<ol class="commentlist" {}>{}</ol>', '<div class="discussion" {}>{}</div>')
ARTICLES = (
    "<article {}>{}</article>", "<main {}>{}</main>", '<div class="content" {}>{}</div>', '<div id="main" {}>{}</div>',
    '<div class="post-body" {}>{}</div>', '<section class="story" {}>{}</section>', "<div {}>{}</div>", '<div class="entry" {}>{}</div>',
)
BODY = re.compile(r"<(article|main)\b[^>]*>(.*?)(?:</\1\s*>|\Z)", re.S | re.I)
PARAGRAPH = re.compile(r"<p\b[^>]*>(.*?)(?=</p|<p\b|\Z)", re.S | re.I)
MARKUP = re.compile(r"<[^>]*>")


def article_of(page: str) -> str | None:
    """Markup of the first article element; else all paragraphs, if any."""
    found = BODY.search(page)
    if found:
        return found.group(2)
    paragraphs = PARAGRAPH.findall(page)
    return "".join(f"<p>{p}</p>" for p in paragraphs) or None


def rearranged(content: str, phrases: list[str], rng: np.random.Generator, mark: str = MARK) -> str:
    """A page around the article ``content`` with boilerplate of all kinds in random places; ``mark`` tells them apart."""

    def pick(forms: tuple[str, ...]) -> str:
        return forms[rng.integers(len(forms))]

    def words(low: int, high: int) -> str:
        phrase = phrases[rng.integers(len(phrases))].split() or ["x"]
        start = rng.integers(len(phrase))
        return " ".join(phrase[start : start + int(rng.integers(low, high))])

    def links() -> str:
        items = [f'<a href="#">{words(1, 5)}</a>' for _ in range(rng.integers(2, 9))]
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if rng.random() < 0.7 else " | ".join(items)

    def paragraphs(low: int, high: int) -> str:
        tag = "li" if rng.random() < 0.2 else "p"
        return "".join(f"<{tag}>{words(4, 60)}</{tag}>" for _ in range(rng.integers(low, high)))

    def fill(forms: tuple[str, ...], inner: str) -> str:
        form = pick(forms)
        return form.format(*[f'{mark}="0"', inner] * (form.count("{}") // 2))

    def maybe(chance: float, forms: tuple[str, ...], inner) -> str:
        return fill(forms, inner()) if rng.random() < chance else ""

    parts = re.split(r"(?=<p\b)", content)
    for _ in range(rng.integers(0, 3)):  # some of it stands inside the article
        inside = [
            lambda: fill(ADVERTS, words(3, 40)),
            lambda: fill(SIDES, links()),
            lambda: fill(NOTICES, words(4, 40)),
            lambda: fill(FORMS, f"<label>{words(1, 4)}</label><input>{words(0, 3)}"),
        ][rng.integers(4)]
        parts.insert(int(rng.integers(1, len(parts) + 1)), inside())
    if rng.random() < 0.3:
        parts.append(f"<h2>{words(2, 6)}</h2><ul>" + "".join(f"<li>{words(3, 20)}</li>" for _ in range(3)) + f"</ul><blockquote>{words(8, 40)}</blockquote>")
    comments = lambda: f"<h3>{words(1, 4)}</h3>" + paragraphs(1, 8)
    if rng.random() < 0.25:
        parts.append(fill(COMMENTS, comments()))
    form = pick(ARTICLES)
    body = form.format(f'{mark}="1"', "".join(parts))
    before = [
        maybe(0.8, MENUS, links), maybe(0.5, HEADS, lambda: words(1, 12)), maybe(0.5, ADVERTS, lambda: words(3, 50)),
        maybe(0.3, NOTICES, lambda: words(5, 50)), maybe(0.3, SIDES, links), maybe(0.2, FORMS, lambda: f"<label>{words(1, 4)}</label><input>"),
    ]
    after = [
        maybe(0.4, COMMENTS, comments), maybe(0.4, SIDES, lambda: links() if rng.random() < 0.6 else paragraphs(1, 4)), maybe(0.3, ADVERTS, lambda: words(3, 50)),
        maybe(0.3, FORMS, lambda: words(2, 20)), maybe(0.8, FEET, lambda: words(2, 30) if rng.random() < 0.6 else links()), maybe(0.2, NOTICES, lambda: words(5, 40)),
    ]
    rng.shuffle(before)
    inner = "".join(before) + body + "".join(after)
    if rng.random() < 0.4:
        inner = f'<div class="wrapper">{inner}</div>'
    return f'<html><head><title>{words(2, 8)}</title></head><body {mark}="0">{inner}</body></html>'


def fit_extractor(pages: DataFrame, fit_pages: int = FIT_PAGES, layouts: int = LAYOUTS, seed: int = 0) -> boosted_trees.Trees:
    """Trees for the share of article text below a node.

    At most ``fit_pages`` pages with an article are taken apart and put
    together in ``layouts`` new ways each, with phrases of other pages as
    menus, adverts, notices, forms, comments and the like.
    """
    sources = pages.filter("html IS NOT NULL").select(F.col("html").cast("string").alias("html"))
    texts = distinct_sample(sources, fit_pages, "html").toPandas()["html"].tolist()
    contents = [c for c in map(article_of, texts) if c]
    phrases = [MARKUP.sub(" ", p)[:2000] for c in contents for p in PARAGRAPH.findall(c)[:5]] or ["x"]
    rng = np.random.default_rng(seed)
    mark = "truth-" + re.sub("[0-9]", "", uuid.uuid4().hex)  # of this run, so that no page holds it on purpose
    made = [rearranged(c, phrases, rng, mark) for c in contents for _ in range(layouts)]
    if not made:
        made = [rearranged("<p>" + "x " * 50 + "</p>", phrases, rng, mark) for _ in range(20)]
    batch = measure([read_page(p, mark) for p in made])
    known = ~np.isnan(batch.share)
    return boosted_trees.fit(batch.features[known], batch.share[known], rounds=40, leaves=12, rate=0.25)


def extract(pages: DataFrame, trees: boosted_trees.Trees) -> DataFrame:
    """(row, text) for every row of ``pages`` (html): blocks of the article joined by empty lines.

    Null and empty pages, and those without article text, have an empty text;
    repeated rows are extracted alike. Pages of any length are read whole, in
    time that follows it; attributes may hold anything. An empty table gives
    no rows, and the extractor is then fitted on made pages alone. ``row`` is
    the whole input row, its other columns having any names.
    """
    shared = pages.sparkSession.sparkContext.broadcast(trees)
    rows = pages.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            sources = batch["row"].field("html").cast(pa.string())
            for start in range(0, len(sources), 500):
                parsed = [read_page(s) for s in sources[start : start + 500].to_pylist()]
                found = measure(parsed)
                p = shared.value.probabilities(found.features)
                for page, first in zip(parsed, found.first.tolist(), strict=True):
                    here = slice(first, first + len(page.nodes))
                    texts.append("\n\n".join(decode(page, p[here], found.chars[here])))
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(texts, pa.string())], ["row", "text"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string")
