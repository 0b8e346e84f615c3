"""Personal data: fixed patterns, and a skip-chain conditional random field that finds further mentions of it."""

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Expected number of documents the field is fitted on; they are drawn by a hash of the text.
FIT_ROWS = 4_000
FIT_STEPS = 200
#: Marginal probability from which a mention counts.
SURE = 0.9
#: Messages that change by less have settled. Rounds without a new least change after which steps are halved.
STILL = 1e-4
_PATIENCE = 50
#: Mentions of as many documents as are inferred together, and messages that are computed at once.
_NODES_AT_ONCE = 20_000
_MESSAGES_AT_ONCE = 1 << 16

# The patterns of the four kinds, fixed by the contract of the query.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match that does not begin at the start of a run of figures would begin there too, so no other place is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")

# What may be a mention: an address, or figures with single separators between them.
_MENTION = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|[\x20]?[\[(](?:at|AT)[\])][\x20]?)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"
    r"|[+(]?[0-9](?:[\x20().-]{0,2}[0-9])+"
)
_CUE = re.compile(r"([A-Za-z]+)[^A-Za-z0-9]{0,3}$")


class Span(NamedTuple):
    kind: int
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from their ``@``: the local part is the run before it, up to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield Span(0, start, done)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[Span]:
    """Spans of the fixed patterns by kind and start; offsets count code points."""
    if not text:
        return []
    found = list(_emails(text))
    if _DIGITS.search(text):
        found += [Span(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(Span(2, *m.span()))
        if "+" in text:
            found += [Span(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return found


class Mention(NamedTuple):
    start: int
    end: int
    key: str  # what makes mentions similar: the figures, or the address without its dressing
    kind: int  # label known from a fixed pattern: 0 none, else 1 + kind
    features: tuple[int, ...]


_FEATURES = 40


def _features(text: str, start: int, end: int) -> tuple[int, ...]:
    """Indices of the mention's features: its shape, and the word in front of it."""
    s = text[start:end]
    n = sum(c.isdigit() for c in s)
    dots, gaps = s.count("."), sum(c in " -()" for c in s)
    cue = _CUE.search(text, max(0, start - 24), start)
    word = cue[1].lower() if cue else ""
    cues = {"mail": 28, "email": 28, "e": 28, "contact": 29, "phone": 30, "tel": 30, "call": 30, "ip": 31, "host": 31, "card": 32, "visa": 32, "version": 33, "v": 33, "token": 34}
    found = [0, 1 + min(n, 20)]
    found.append(22 + min(dots, 3))
    found.append(26 if gaps else 27)
    if word in cues:
        found.append(cues[word])
    if "@" in s or "at" in s.lower():
        found.append(35)
    if s[0] == "+":
        found.append(36)
    if start and (text[start - 1].isalnum() or text[start - 1] in "\"'_"):
        found.append(37)
    if end < len(text) and (text[end].isalnum() or text[end] in "\"'_"):
        found.append(38)
    if n >= 13 and not luhn("".join(c for c in s if c.isdigit())):
        found.append(39)
    return tuple(found)


def _key(s: str) -> str:
    if "@" in s or re.search(r"[\[(]at[\])]", s, re.I):
        return re.sub(r"[\x20]?[\[(]at[\])][\x20]?", "@", s, flags=re.I).lower()
    return "".join(c for c in s if c.isdigit())


def mentions(text: str | None, base: Sequence[Span]) -> list[Mention]:
    """The nodes of a document's field: base spans, and whatever between them looks like figures or an address."""
    if not text or not (base or "@" in text or _DIGITS.search(text) or "(at)" in text.lower() or "[at]" in text.lower()):
        return []
    found = [Mention(s.start, s.end, _key(text[s.start : s.end]), 1 + s.kind, _features(text, s.start, s.end)) for s in base]
    free = 0
    for start, end in [*sorted((s.start, s.end) for s in base), (len(text), len(text))]:
        if free < start:
            for m in _MENTION.finditer(text, free, start):
                found.append(Mention(m.start(), m.end(), _key(m[0]), 0, _features(text, m.start(), m.end())))
        free = max(free, end)
    return sorted(found)


class Field(NamedTuple):
    """Weights of the field: features by label; labels next to each other; labels of similar mentions."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


LABELS = 1 + len(KINDS)


def _endings(nodes: Sequence[Mention]) -> dict[str, list[str]]:
    """For every key of seven or more figures the other ones among the keys that end it, shortest first."""
    found, ending = {}, []
    for back in sorted({m.key[::-1] for m in nodes if m.key.isdigit() and len(m.key) >= 7}):
        while ending and not back.startswith(ending[-1][::-1]):
            ending.pop()
        key = back[::-1]
        found[key] = list(ending)
        ending.append(key)
    return found


def edges(nodes: Sequence[Mention]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges between neighbours, and skip edges between mentions that are similar.

    Mentions are similar if they have the same key, or one has seven or more figures that end the other's.
    Each is linked with the one of the same key before it, and with the last one of every other similar key
    since then, whatever else has the same last figures. One that no pattern labels is also linked directly
    with a similar one of every label that a pattern gives. So the edges grow with the mentions, times the
    number of keys that end one another, however often one is repeated.
    """
    chain = [(i, i + 1) for i in range(len(nodes) - 1)]
    endings = _endings(nodes)
    skip: set[tuple[int, int]] = set()
    last: dict[str, int] = {}
    longer: dict[str, dict[str, int]] = {}  # by key, mentions of longer similar keys since its last mention
    known: dict[str, dict[int, int]] = {}  # by key and label, its first mention with that label
    known_longer: dict[str, dict[int, int]] = {}
    for i, m in enumerate(nodes):
        own = last.get(m.key, -1)
        partners = [own] if own >= 0 else []
        partners += longer.pop(m.key, {}).values()
        for key in endings.get(m.key, ()):
            if last.get(key, -1) > own:
                partners.append(last[key])
            longer.setdefault(key, {})[m.key] = i
            if m.kind:
                known_longer.setdefault(key, {}).setdefault(m.kind, i)
        skip.update((j, i) for j in partners)
        last[m.key] = i
        if m.kind:
            known.setdefault(m.key, {}).setdefault(m.kind, i)
    for i, m in enumerate(nodes):
        if not m.kind:
            labelled: dict[int, int] = {}
            for found in (known.get(m.key), *(known.get(key) for key in reversed(endings.get(m.key, ()))), known_longer.get(m.key)):
                labelled = (found or {}) | labelled
            skip.update((min(i, j), max(i, j)) for j in labelled.values())
    return chain, sorted(skip)


class Graph(NamedTuple):
    """The fields of many documents side by side; no edge leads from one to another."""

    features: np.ndarray  # (node, feature) pairs
    n: int
    known: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    document: np.ndarray


def graph(documents: Sequence[Sequence[Mention]]) -> Graph:
    features, known, chains, skips, document, n = [], [], [], [], [], 0
    for k, nodes in enumerate(documents):
        chain, skip = edges(nodes)
        chains += [(a + n, b + n) for a, b in chain]
        skips += [(a + n, b + n) for a, b in skip]
        for m in nodes:
            features += [(n, f) for f in m.features]
            known.append(m.kind)
            document.append(k)
            n += 1
    pairs = lambda x: np.array(x, dtype=np.int64).reshape(-1, 2)
    return Graph(pairs(features), n, np.array(known, dtype=np.int64), pairs(chains), pairs(skips), np.array(document, dtype=np.int64))


def _unary(g: Graph, field: Field) -> np.ndarray:
    scores = np.zeros((g.n, LABELS))
    np.add.at(scores, g.features[:, 0], field.unary[g.features[:, 1]])
    return scores


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(g: Graph, field: Field, clamp: bool = True, rounds: int | None = None) -> np.ndarray:
    """Label probabilities of every node by loopy message passing along chain and skip edges.

    Nodes that a fixed pattern labels are clamped to that label, whatever is sent to them. Messages of a round
    are all computed from those of the round before, and damped by half. A document's messages are passed until
    they stop changing, or for ``rounds`` if given; where they keep swinging, the steps become smaller until
    they do stop.
    """
    scores = _unary(g, field)
    fixed = (g.known > 0) & clamp
    scores[fixed] = -50.0
    scores[fixed, g.known[fixed]] = 50.0
    both = [np.concatenate([e, e[:, ::-1]]) for e in (g.chain, g.skip)]
    senders, receivers = (np.concatenate([e[:, i] for e in both]) for i in (0, 1))
    half = [len(g.chain), len(g.skip)]
    tables = np.stack([t for w in (field.chain, field.skip) for t in (w, w.T)])
    table = np.repeat(np.arange(4), np.repeat(half, 2))
    back = np.concatenate([np.r_[h : 2 * h, 0:h] + o for h, o in zip(half, (0, 2 * half[0]))]).astype(int)
    message = np.zeros((len(senders), LABELS))
    n = int(g.document.max(initial=-1)) + 1
    step, least, stalled = np.full(n, 0.5), np.full(n, np.inf), np.zeros(n, dtype=np.int64)
    live, done = np.flatnonzero(~fixed[receivers]), 0
    while len(live) and (rounds is None or done < rounds):
        home = g.document[receivers[live]]
        belief = scores.copy()
        np.add.at(belief, receivers[live], message[live])
        change = np.zeros(n)
        new = np.empty((len(live), LABELS))
        for start in range(0, len(live), _MESSAGES_AT_ONCE):
            part = live[start : start + _MESSAGES_AT_ONCE]
            cavity = belief[senders[part]] - message[back[part]]
            new[start : start + len(part)] = _log_sum(cavity[:, :, None] + tables[table[part]], axis=1)
        new -= _log_sum(new, axis=1)[:, None]
        new = (new - message[live]) * step[home][:, None]
        message[live] += new
        np.maximum.at(change, home, np.abs(new).max(axis=1))
        better = change < 0.9 * least
        least = np.where(better, change, least)
        stalled = np.where(better, 0, stalled + 1)
        step[stalled >= _PATIENCE] /= 2
        stalled[stalled >= _PATIENCE] = 0
        live, done = live[change[home] >= STILL], done + 1
    belief = scores.copy()
    np.add.at(belief, receivers, message)
    return np.exp(belief - _log_sum(belief, axis=1)[:, None])


def _grouped(digits: str, gap: str) -> str:
    return gap.join(x for x in (digits[:3], digits[3:6], digits[6:]) if x)


def training_texts(text: str, seed: int) -> list[tuple[str, list[Span]]]:
    """The text itself, and with planted mentions whose labels are known although no pattern fits them.

    A base span is repeated further on without the dressing that the patterns ask for, and is still personal
    data; figures of the same shape that repeat nothing are planted as well, and are not.
    """
    draw = np.random.default_rng(seed)
    base = base_spans(text)
    out = [(text, base)]
    for span in base[:4]:
        s = text[span.start : span.end]
        digits = "".join(c for c in s if c.isdigit())
        other = "".join(str(x) for x in draw.integers(0, 10, len(digits)))
        planted: list[tuple[str, int | None]] = []
        if span.kind == 0:
            planted.append((s.replace("@", " (at) "), 0))
        elif span.kind == 1:
            planted.append((s + ".7", 1))
        else:
            size = 10 if span.kind == 3 else 12
            for gap in ("", " ", "-"):
                planted += [(_grouped(digits[-size:], gap), span.kind), (_grouped(other[-size:], gap), None)]
        for extra, kind in planted:
            put = f"{text} {extra} "
            again = base_spans(put)
            start = len(text) + 1
            label = [] if kind is None or any(b.end > start for b in again) else [Span(kind, start, start + len(extra))]
            out.append((put, [*again, *label]))
    return out


def fit_field(texts: Sequence[str], steps: int = FIT_STEPS) -> Field:
    """Fit the weights by pseudo-likelihood: each label given the labels next to it and of similar mentions."""
    documents, labels = [], []
    for i, text in enumerate(texts):
        for put, spans in training_texts(text, i):
            nodes = mentions(put, base_spans(put))
            truth = {(s.start, s.end): 1 + s.kind for s in spans}
            documents.append(nodes)
            labels += [truth.get((m.start, m.end), next((k for (a, b), k in truth.items() if a < m.end and m.start < b), 0)) for m in nodes]
    g, y = graph(documents), np.array(labels, dtype=np.int64)
    field = Field(np.zeros((_FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))
    if not g.n:
        return field
    target = np.eye(LABELS)[y]
    # Nodes that patterns label are clamped later, so what decides the others weighs most.
    weight = np.where(g.known > 0, 0.05, 1.0)[:, None] / g.n
    momentum = [np.zeros_like(w) for w in field]
    for _ in range(steps):
        scores = _unary(g, field)
        for table, pairs in ((field.chain, g.chain), (field.skip, g.skip)):
            np.add.at(scores, pairs[:, 0], table[:, y[pairs[:, 1]]].T)
            np.add.at(scores, pairs[:, 1], table[y[pairs[:, 0]]])
        error = (np.exp(scores - _log_sum(scores, 1)[:, None]) - target) * weight
        gradient = [np.zeros_like(w) for w in field]
        np.add.at(gradient[0], g.features[:, 1], error[g.features[:, 0]])
        for into, pairs in ((gradient[1], g.chain), (gradient[2], g.skip)):
            np.add.at(into.T, y[pairs[:, 1]], error[pairs[:, 0]])
            np.add.at(into, y[pairs[:, 0]], error[pairs[:, 1]])
        for w, m, d in zip(field, momentum, gradient):
            m *= 0.9
            m += d + 1e-5 * w
            w -= 4.0 * m
    return field


def fit(docs: DataFrame, text: str = "text", fit_rows: int = FIT_ROWS) -> Field:
    """Fit on the documents with personal data among about ``fit_rows`` drawn ones (all, if there are fewer).

    Only passages around their base spans, some hundred characters each, reach the driver.
    """
    known = docs.select(F.col(text).alias("text")).filter("text is not null")
    part = int(min(1.0, fit_rows / max(1, known.count())) * (1 << 31))
    drawn = known.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 31)) < part)

    def passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for t in batch["text"]:
                spans = base_spans(t)
                if spans or _DIGITS.search(t):
                    at = spans[0].start if spans else _DIGITS.search(t).start()
                    found.append(t[max(0, at - 150) : at + 250])
            yield pd.DataFrame({"passage": pd.Series(found, dtype=object)})

    rows = drawn.mapInPandas(passages, "passage string").distinct().orderBy("passage").limit(fit_rows).collect()
    return fit_field([r["passage"] for r in rows])


def find_spans(texts: Sequence[str | None], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """For every text its base spans and all spans, both by kind and start."""
    base = [base_spans(t) for t in texts]
    found = [list(b) for b in base]
    held: list[tuple[int, list[Mention]]] = []

    def infer() -> None:
        sure = marginals(graph([nodes for _, nodes in held]), field)
        for (i, m), p in zip(((i, m) for i, nodes in held for m in nodes), sure):
            label = int(p.argmax())
            if m.kind == 0 and label and p[label] >= SURE:
                found[i].append(Span(label - 1, m.start, m.end))
        held.clear()

    n_held = 0
    for i, t in enumerate(texts):
        nodes = mentions(t, base[i])
        # A document whose mentions all have labels has nothing left to infer.
        if any(m.kind == 0 for m in nodes):
            held.append((i, nodes))
            n_held += len(nodes)
        if n_held >= _NODES_AT_ONCE:
            infer()
            n_held = 0
    if held:
        infer()
    return [(b, sorted(f)) for b, f in zip(base, found)]


def as_text(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def masked(text: str | None, spans: Sequence[Span]) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first, then longest."""
    if not text or not spans:
        return text
    out, done = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end, s.kind)):
        if s.end <= done:
            continue
        if s.start >= done:
            out += [text[done : s.start], f"[{KINDS[s.kind].upper()}]"]
        done = s.end
    return "".join([*out, text[done:]])


def found_spans(spark: SparkSession, field: Field, text: Column) -> Column:
    """struct(base, spans, masked): spans as array of struct(kind, start, end) in code points, end exclusive."""
    shared = spark.sparkContext.broadcast(tuple(field))
    span = "array<struct<kind:string,start:int,end:int>>"

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        field = Field(*shared.value)
        listed = lambda spans: [{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in spans]
        for texts in batches:
            found = find_spans(list(texts), field)
            yield pd.DataFrame(
                {
                    "base": [listed(b) for b, _ in found],
                    "spans": [listed(s) for _, s in found],
                    "masked": [masked(t, s) for t, (_, s) in zip(texts, found)],
                }
            )

    return F.pandas_udf(run, f"base {span}, spans {span}, masked string")(text)


def find_personal_data(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` with base_spans, spans and masked_text; columns of those names are replaced.

    Base spans are those of fixed patterns. To them come mentions that no pattern fits, where the field, with
    the patterns' labels as evidence, is at least ``SURE`` of a kind: mostly repetitions of a base span in
    another dress. Whole texts are read; null and empty ones have no spans. Repeated rows come out each; an
    empty table gives no rows. Nothing is shuffled.
    """
    added = ("base_spans", "spans", "masked_text")
    kept = [c for c in docs.columns if c not in added]
    rows = docs.withColumn("_found", found_spans(docs.sparkSession, field, F.col(text)))
    return rows.select(*kept, *(F.col(f"_found.{a}").alias(b) for a, b in zip(("base", "spans", "masked"), added)))
