"""Main text of web pages by a tree-structured graphical model over the elements of a page."""

import re
from collections.abc import Iterator, Sequence
from html import unescape
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Expected number of pages the model is fitted on; they are drawn by a hash of the html.
FIT_PAGES = 400
FIT_STEPS = 200
#: Characters of a page's text that a training page holds at most. Pages to extract from are read whole.
TRAINING_CHARS = 6_000

# An attribute is a name, and after = a value, in quotes if one opens it. A quote anywhere else, or one without its like, is an
# ordinary character.
def _attribute(group: str) -> str:
    return rf"{group}=?[^\s/>=]++|=)(?:\s*+=\s*+(?:\"{group}[^\"]*+)\"|'{group}[^']*+)'|{group}[^\s>]*+)))?+"


_ATTRIBUTE = re.compile(_attribute("("))
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[\s/]++|" + _attribute("(?:") + ")*+)>?",
    re.S,
)
_WORDS = re.compile(r"[a-z]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page; skipped up to their end tag.
_RAW = frozenset("script style iframe template textarea title".split())
#: Elements of other vocabularies: in them, any element may end itself.
_FOREIGN = frozenset("svg math".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
# An opening tag of the left side closes an open one of the right side, if that is the nearest such.
_CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table tbody thead tfoot div article section aside main nav header footer form body blockquote td th li".split())
_TAGS = "html body article main section div aside nav header footer form p ul ol li h1 h2 h3 blockquote pre table td a b span button figure svg math noscript object select".split()
_HOLDERS = frozenset("article aside body div footer form head header html main menu nav ol section ul".split())
#: Words of class, id and role attributes, by what they say about an element.
_HINTS = {
    "content": "content article post story entry text prose main body".split(),
    "menu": "nav menu navbar breadcrumb breadcrumbs pagination pager toc links tags categories toolbar".split(),
    "frame": "header footer masthead banner top bottom copyright legal colophon topbar".split(),
    "side": "sidebar aside side widget related recommended popular trending rail teaser promo".split(),
    "notice": "cookie cookies consent notice alert popup modal newsletter subscribe signup gdpr dialog banner paywall".split(),
    "advert": "ad ads advert advertisement sponsor sponsored adsense promo".split(),
    "form": "form search login signin register contact input".split(),
    "comment": "comment comments reply replies discussion disqus respond responses commentlist reader".split(),
    "social": "share sharing social follow like".split(),
}


class Node(NamedTuple):
    parent: int
    tag: str
    hints: tuple[str, ...]


class Page(NamedTuple):
    """Elements in page order, the first one the page itself; text runs as (element, block, text)."""

    nodes: list[Node]
    runs: list[tuple[int, int, str]]


def _hints(attributes: str) -> tuple[str, ...]:
    words = set()
    for m in _ATTRIBUTE.finditer(attributes) if "=" in attributes else ():
        if m[1].lower() in ("class", "id", "role"):
            words.update(_WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", m[2] or m[3] or m[4] or "").lower()))
    return tuple(k for k, ws in _HINTS.items() if words.intersection(ws))


class _Open:
    """The elements that are open, the page itself first. Where a name is open last is known without a search, so the
    time for a page does not grow with its depth."""

    def __init__(self):
        self.nodes, self.names = [0], [""]
        self._places: dict[str, list[int]] = {}
        # How many of the names up to each element have a scope of their own.
        self._scopes = [0]

    def push(self, node: int, name: str) -> None:
        self._places.setdefault(name, []).append(len(self.names))
        self._scopes.append(self._scopes[-1] + (name in _SCOPES))
        self.nodes.append(node)
        self.names.append(name)

    def close(self, place: int) -> None:
        """End the element at ``place`` and all in it."""
        while len(self.names) > place:
            self._places[self.names.pop()].pop()
            self._scopes.pop()
            self.nodes.pop()

    def last(self, name: str) -> int:
        """The place of the innermost open element of the name, or 0."""
        places = self._places.get(name)
        return places[-1] if places else 0

    def scoped(self, place: int) -> bool:
        """Whether an element from ``place`` on has a scope of its own."""
        return self._scopes[-1] > self._scopes[place - 1]


def parse(html: str | None) -> Page:
    """The page's element tree and text, as forgiving as readers of broken markup have to be.

    Scripts, styles, titles, templates, text areas, frames and comments hold no text. Text runs with the same block number belong to one
    block: nothing that begins or ends a block lies between them. Character references are decoded.
    """
    nodes, runs = [Node(-1, "", ())], []
    opened = _Open()
    block, at = 0, 0
    html = html or ""

    def text(piece: str) -> None:
        if piece and not piece.isspace():
            runs.append((opened.nodes[-1], block, unescape(piece)))
        elif piece:
            runs.append((opened.nodes[-1], block, " "))

    while at < len(html):
        token = _TOKEN.search(html, at)
        if not token:
            text(html[at:])
            break
        text(html[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        name = token[2].lower()
        if token[1]:
            if name in _BLOCK:
                block += 1
            if last := opened.last(name):
                # A block's end tag closes what is open in it; that of anything else no block around it.
                if name not in _BLOCK:
                    last = max(last, 1 + max(map(opened.last, _BLOCK)))
                opened.close(last)
            continue
        ends_itself = token[3].rstrip().endswith("/")
        if name in _RAW:
            if ends_itself and max(map(opened.last, _FOREIGN)) > max(map(opened.last, _BLOCK)):
                continue
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = close.end() if close else len(html)
            continue
        if name == "br":
            runs.append((opened.nodes[-1], block, " "))
        if name in _VOID:
            block += name == "hr"
            continue
        if name in _BLOCK:
            block += 1
            if last := opened.last("select"):
                # A list of options holds no blocks: one that is not ended ends here.
                opened.close(last)
            last = opened.last("p")
            if last and not opened.scoped(last):
                # A block ends a paragraph that is still open, and what is open in it.
                opened.close(last)
        if name in _CLOSES:
            last = max(map(opened.last, _CLOSES[name]))
            if last and last >= max(opened.last(scope) for scope in _SCOPES - _CLOSES[name]):
                opened.close(last)
        # A list of options is a control like those of a form, wherever it stands.
        hints = _hints(token[3])
        nodes.append(Node(opened.nodes[-1], name, hints if name != "select" or "form" in hints else (*hints, "form")))
        if not ends_itself or name in _BLOCK:
            opened.push(len(nodes) - 1, name)
    return Page(nodes, runs)


_FEATURES = ["bias", "root", "in head"] + [f"tag {t}" for t in _TAGS] + ["other tag"] + [f"hint {h}" for h in _HINTS] + ["no hint", "linked", "short", "long"]
_INDEX = {f: i for i, f in enumerate(_FEATURES)}


def _features(page: Page) -> list[list[int]]:
    """Indices of every element's features: its tag, hints, share of linked text, and length."""
    n = len(page.nodes)
    chars, linked = [0] * n, [0] * n
    in_link = [False] * n
    for i, node in enumerate(page.nodes):
        in_link[i] = node.tag == "a" or (node.parent >= 0 and in_link[node.parent])
    for i, _, t in page.runs:
        chars[i] += len(t.strip())
        linked[i] += len(t.strip()) * in_link[i]
    for i in range(n - 1, 0, -1):
        chars[page.nodes[i].parent] += chars[i]
        linked[page.nodes[i].parent] += linked[i]
    out = []
    for i, node in enumerate(page.nodes):
        own = [0]
        if node.parent < 0:
            own.append(_INDEX["root"])
        else:
            own.append(_INDEX["in head"] if node.tag == "head" else _INDEX.get(f"tag {node.tag}", _INDEX["other tag"]))
        own += [_INDEX[f"hint {h}"] for h in node.hints] or [_INDEX["no hint"]]
        if chars[i]:
            if linked[i] > 0.5 * chars[i]:
                own.append(_INDEX["linked"])
            own.append(_INDEX["long"] if chars[i] > 200 else _INDEX["short"])
        out.append(own)
    return out


class Model(NamedTuple):
    """Weights of a content element's features, and of (parent, child) labels; label 1 is content.

    Elements that hold others have label pairs of their own: a paragraph is seldom unlike what it stands in.
    """

    unary: np.ndarray
    pair: np.ndarray


class Forest(NamedTuple):
    """Elements of many pages side by side, each level of the trees together."""

    features: np.ndarray
    parent: np.ndarray
    holds: np.ndarray  # 1 for elements that are there to hold others, else 0
    levels: list[np.ndarray]


def forest(pages: Sequence[Page]) -> Forest:
    pairs, parents, holds, depths = [], [], [], []
    for page in pages:
        first, depth = len(parents), []
        for i, (node, own) in enumerate(zip(page.nodes, _features(page))):
            pairs += [(first + i, f) for f in own]
            parents.append(first + node.parent if node.parent >= 0 else -1)
            holds.append(int(node.tag in _HOLDERS))
            depth.append(depth[node.parent] + 1 if node.parent >= 0 else 0)
        depths += depth
    depths = np.array(depths, dtype=np.int64)
    order = np.argsort(depths, kind="stable")
    cuts = np.flatnonzero(np.diff(depths[order])) + 1
    return Forest(np.array(pairs, dtype=np.int64).reshape(-1, 2), np.array(parents, dtype=np.int64), np.array(holds, dtype=np.int64), np.split(order, cuts) if len(order) else [])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp.reduce(x, axis=axis)


def _messages(f: Forest, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log messages by sum-product: from every element up to its parent, and down to it; its own evidence."""
    n = len(f.parent)
    own = np.zeros((n, 2))
    np.add.at(own[:, 1], f.features[:, 0], model.unary[f.features[:, 1]])
    inside, up, down = own.copy(), np.zeros((n, 2)), np.zeros((n, 2))
    for level in f.levels[:0:-1]:
        up[level] = _log_sum(inside[level][:, None, :] + model.pair[f.holds[level]], axis=2)
        np.add.at(inside, f.parent[level], up[level])
    for level in f.levels[1:]:
        parent = f.parent[level]
        others = inside[parent] + down[parent] - up[level]
        down[level] = _log_sum(others[:, :, None] + model.pair[f.holds[level]], axis=1)
        down[level] -= _log_sum(down[level], axis=1)[:, None]
    return inside, up, down


def marginals(f: Forest, model: Model) -> np.ndarray:
    """Probability of every element to be content, given its whole page."""
    inside, _, down = _messages(f, model)
    belief = inside + down
    return np.exp(belief[:, 1] - _log_sum(belief, axis=1))


def _pair_marginals(f: Forest, model: Model) -> np.ndarray:
    """Expected number of (parent, child) labels, by whether the child holds others."""
    inside, up, down = _messages(f, model)
    child = np.flatnonzero(f.parent >= 0)
    parent = f.parent[child]
    joint = (inside[parent] + down[parent] - up[child])[:, :, None] + model.pair[f.holds[child]] + inside[child][:, None, :]
    joint -= _log_sum(joint.reshape(-1, 4), axis=1)[:, None, None]
    total = np.zeros((2, 2, 2))
    np.add.at(total, f.holds[child], np.exp(joint))
    return total


def fit_model(pages: Sequence[Page], labels: Sequence[Sequence[int]], steps: int = FIT_STEPS) -> Model:
    """Maximum likelihood with a small ridge: observed minus expected counts, the latter by message passing."""
    model = Model(np.zeros(len(_FEATURES)), np.zeros((2, 2, 2)))
    if not pages:
        return model
    f, y = forest(pages), np.concatenate([np.asarray(x, dtype=np.int64) for x in labels])
    child = np.flatnonzero(f.parent >= 0)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (f.holds[child], y[f.parent[child]], y[child]), 1)
    steepness = [np.zeros_like(w) for w in model]
    for _ in range(steps):
        p = marginals(f, model)
        unary = np.bincount(f.features[:, 1], (y - p)[f.features[:, 0]], len(_FEATURES))
        for w, h, g in zip(model, steepness, (unary, seen - _pair_marginals(f, model))):
            g = g / len(y) - 1e-4 * w
            h += g * g
            w += 0.5 * g / np.sqrt(h + 1e-12)
    return model


_OTHER = "<x-no>"


def training_page(title: str, paragraphs: Sequence[str], spare: Sequence[str], draw: np.random.Generator) -> str:
    """A page with the paragraphs as its article, in one of many layouts; data-c marks the article's element.

    ``spare`` has texts for what surrounds the article.
    """
    pick = lambda options: options[int(draw.integers(len(options)))]
    some = lambda: pick(spare)[: int(draw.integers(10, 160))] if spare else "x"
    links = lambda: "".join(f"<li><a href=/x>{some()[:20]}</a></li>" for _ in range(int(draw.integers(2, 9))))
    para = lambda: f"<p>{some()}</p>"
    other = {
        "menu": [lambda: f"<nav><ul>{links()}</ul></nav>", lambda: f"<div class={pick(['menu', 'navbar', 'breadcrumbs'])}><ul>{links()}</ul></div>", lambda: f"<ul class=nav>{links()}</ul>"],
        "header": [lambda: f"<header><p>{some()}</p></header>", lambda: f"<div id={pick(['header', 'masthead', 'top'])}><h1>{some()}</h1>{para()}</div>"],
        "ad": [lambda: f"<div class={pick(['ad', 'ads', 'sponsored', 'advert'])}>{some()}</div>", lambda: f"<section class=advertisement>{para()}</section>"],
        "notice": [lambda: f"<div class={pick(['cookie-notice', 'popup', 'newsletter', 'consent'])}>{para()}<button>{some()[:9]}</button></div>", lambda: f"<div role=dialog>{para()}</div>"],
        "form": [lambda: f"<form><p>{some()}</p><input name=a><button>{some()[:9]}</button></form>", lambda: f"<div class=search-form><span>{some()}</span></div>"],
    }
    after = {
        "side": [lambda: f"<aside>{para()}{para()}</aside>", lambda: f"<div class={pick(['sidebar', 'widget', 'related'])}><h3>{some()[:30]}</h3><ul>{links()}</ul>{para()}</div>"],
        "comments": [
            lambda: f"<section class=comments><h2>{some()[:20]}</h2>{para()}{para()}</section>",
            lambda: f"<div id=comments>{''.join(f'<div class=comment>{para()}</div>' for _ in range(3))}</div>",
            lambda: f"<ol class=commentlist>{''.join(f'<li>{para()}</li>' for _ in range(3))}</ol>",
        ],
        "share": [lambda: f"<div class=share><a href=/s>{some()[:12]}</a></div>"],
        "footer": [lambda: f"<footer>{pick(['&copy; ', ''])}{some()}</footer>", lambda: f"<div class=footer><p>{some()}</p></div>"],
    }
    body = [f"<h1>{title}</h1>"] if draw.random() < 0.9 else []
    for p in paragraphs:
        body.append(pick([f"<p>{p}</p>"] * 5 + [f"<p><b>{p}</b></p>", f"<p>{p}<br>", f"<h2>{p[:40]}</h2>", f"<ul><li>{p}</li><li>{p[:30]}</li></ul>", f"<blockquote>{p}</blockquote>", f"<div>{p}</div>", f"<p>{p} <a href=/y>{p[:15]}</a></p>", f"<table><tr><td>{p[:30]}</td><td>{p[:9]}</td></tr></table>", f"<pre>{p}</pre>"]))
    if draw.random() < 0.3:
        body.insert(int(draw.integers(len(body) + 1)), pick([*other["ad"], *after["share"], *after["side"], *other["form"]])().replace("<", f"{_OTHER}<", 1))
    opens = pick(["<article data-c>"] * 6 + ["<main data-c>", "<div class=content data-c>", "<div id=main-content data-c>", "<div class=post-body data-c>", "<section class=story data-c>", "<main data-c><article>", "<div class='entry text' data-c>", "<article class=post data-c><div>"])
    closes = "".join(f"</{t}>" for t in re.findall(r"<([a-z]+)", opens)[::-1])
    article = opens + "".join(body) + closes
    shown = lambda kinds, p: "".join(pick(v)() for v in kinds.values() if draw.random() < p)
    inner = shown(other, 0.5) + article + shown(after, 0.5)
    if draw.random() < 0.3:
        inner = f"<div class={pick(['wrapper', 'page', 'container', 'site'])}>{inner}</div>"
    if draw.random() < 0.15:
        return inner
    return f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{inner}</body></html>"


def labelled(html: str) -> tuple[Page, list[int]]:
    """The training page without its marks, and its elements' labels: 1 for the article's, but for what is marked as none."""
    page = parse(html.replace(_OTHER, "<x-no></x-no>"))
    # The element whose tag holds the mark is the last one that begins before it.
    article = len(parse(html[: html.index("data-c")].replace(_OTHER, "<x-no></x-no>") + ">").nodes) - 1
    nodes, label, moved, none_of_it = [], {}, {}, False
    for i, node in enumerate(page.nodes):
        if node.tag == "x-no":
            none_of_it = True
            continue
        label[i] = int((i == article or label.get(node.parent, 0) == 1) and not none_of_it)
        none_of_it = False
        moved[i] = len(nodes)
        nodes.append(node._replace(parent=moved.get(node.parent, -1)))
    return Page(nodes, [(moved[i], b, t) for i, b, t in page.runs if i in moved]), list(label.values())


def fit(pages: DataFrame, html: str = "html", fit_pages: int = FIT_PAGES) -> Model:
    """Fit on training pages that hold the text of about ``fit_pages`` drawn pages (all, if there are fewer).

    The article of a drawn page, as its ``article`` or ``main`` element says, is laid out anew in many ways,
    each of which says which elements are the article.
    """
    known = pages.select(F.col(html).alias("html")).filter("html is not null")
    part = int(min(1.0, fit_pages / max(1, known.count())) * (1 << 31))
    drawn = known.filter(F.pmod(F.xxhash64("html"), F.lit(1 << 31)) < part)
    start = F.regexp_extract("html", r"(?is)<(?:article|main)\b[^>]*>(.*)", 1)
    rows = drawn.select(F.substring(start, 1, TRAINING_CHARS).alias("t")).filter("t != ''").orderBy("t").limit(2 * fit_pages).collect()
    texts = []
    for row in rows:
        blocks: dict[int, str] = {}
        for _, block, t in parse(re.split(r"(?i)</(?:article|main)", row["t"])[0]).runs:
            blocks[block] = blocks.get(block, "") + t
        parts = [" ".join(t.split()).replace("&", "&amp;").replace("<", "&lt;") for t in blocks.values() if t.strip()]
        if parts:
            texts.append(parts)
    texts = texts or [["Some words in a row.", "And a few more of them, to have something."]]
    draw = np.random.default_rng(17)
    made = []
    for i in range(2 * fit_pages):
        # Articles are short and long alike.
        own, spare = texts[i % len(texts)], texts[int(draw.integers(len(texts)))]
        most = int(draw.choice([1, 2, 4, 40]))
        made.append(labelled(training_page(own[0][:80], own[1 : 1 + most] or own, spare, draw)))
    return fit_model([p for p, _ in made], [y for _, y in made])


def main_texts(htmls: Sequence[str | None], model: Model) -> list[str]:
    """The main text of each page: blocks of content elements, one to a line, white space as single spaces."""
    pages = [parse(h) for h in htmls]
    if not pages:
        return []
    content = marginals(forest(pages), model) > 0.5
    out, first = [], 0
    for page in pages:
        blocks: dict[int, list[str]] = {}
        for i, block, t in page.runs:
            if content[first + i]:
                blocks.setdefault(block, []).append(t)
        joined = (" ".join("".join(parts).split()) for parts in blocks.values())
        out.append("\n".join(t for t in joined if t))
        first += len(page.nodes)
    return out


def main_text(spark: SparkSession, model: Model, html: Column) -> Column:
    shared = spark.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Model(*shared.value)
        for htmls in batches:
            # Some hundred pages at a time bound the memory of their trees.
            rows = list(htmls)
            parts = [main_texts(rows[i : i + 200], model) for i in range(0, len(rows), 200)]
            yield pd.Series([t for p in parts for t in p], dtype=object)

    return F.pandas_udf(run, "string")(html)


def extract_main_text(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars; columns of those names are replaced.

    Whole pages are read; a null or empty one has an empty text. Character references are decoded, white space
    inside a block becomes one space, blocks are joined by line ends, empty ones left out. Repeated rows come
    out each; an empty table gives no rows. Nothing is shuffled.
    """
    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    rows = pages.withColumn("_text", main_text(pages.sparkSession, model, F.col(html)))
    return rows.select(*kept, F.col("_text").alias("text"), F.char_length("_text").cast("long").alias("n_chars"))
