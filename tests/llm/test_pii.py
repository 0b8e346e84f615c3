import hashlib
import random
import re
import time

import numpy as np
import pytest

from shelfline.llm import pii
from shelfline.llm.pii import (
    KINDS, LABELS, Field, Mention, base_spans, edges, find_personal_data, find_spans, fit, fit_field, graph, luhn, marginals, masked, mentions,
)
from shelfline.llm.queries import op6_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    def good(kind, s):
        digits = [c for c in s if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and luhn("".join(digits))
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m[0])]


def test_base_spans_against_the_patterns():
    draw = random.Random(6)
    parts = ["a.b@c.de", "x@y", "@", "+1 (017) 555-7713", "+49 1", "1.2.3.4", "256.1.1.1", "001.02.3.0004", "4111 1111 1111 1111", "4111111111111112", "é", "a.b@c.d@e.f_g@h.i", ".", "-", " ", "\n", "9", "+", "12", "u%v", "@q.r.s", "0000000000000"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(12)))
        assert [(KINDS[s.kind], s.start, s.end) for s in base_spans(text)] == plain(text), repr(text)
    assert base_spans(None) == []
    assert base_spans("a" * 500_000 + "@b.c")[0].end == 500_004


def test_message_passing_against_all_labelings():
    draw = np.random.default_rng(1)
    field = Field(draw.normal(size=(40, LABELS)), draw.normal(size=(LABELS, LABELS)), draw.normal(size=(LABELS, LABELS)))
    # A chain is a tree, on which message passing is exact; with a skip edge it is close.
    for key, close in (("x{}", 1e-3), ("x", 0.15)):
        nodes = [Mention(i * 5, i * 5 + 2, key.format(i), 0, (i, i + 7)) for i in range(3)]
        g = graph([nodes])
        weights = np.zeros((LABELS,) * 3)
        for labels in np.ndindex(weights.shape):
            s = sum(field.unary[f, labels[i]] for i, m in enumerate(nodes) for f in m.features)
            s += sum(field.chain[labels[a], labels[b]] for a, b in g.chain) + sum(0.3 * 0 + field.skip[labels[a], labels[b]] for a, b in g.skip)
            weights[labels] = np.exp(s)
        weights /= weights.sum()
        exact = [weights.sum(axis=tuple({0, 1, 2} - {i})) for i in range(3)]
        assert np.abs(marginals(g, field, rounds=60) - exact).max() < close


def test_skip_edges_grow_with_the_mentions_only():
    nodes = [Mention(i, i + 1, "5551234567", 0, (0,)) for i in range(1000)]
    chain, skip = edges(nodes)
    assert len(chain) == 999 and len(skip) == 999


@pytest.fixture(scope="module")
def field(spark):
    return fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def added(field, text):
    ((base, spans),) = find_spans([text], field)
    assert set(base) <= set(spans)
    return [(KINDS[s.kind], text[s.start : s.end]) for s in spans if s not in base]


def test_repeated_mentions_are_found_and_lone_figures_are_not(field):
    start = "Call the office at +1 (017) 555-7713 today. "
    assert added(field, start + "Erhe on the, and so 017 555-7713 again in the end.") == [("phone", "017 555-7713")]
    assert added(field, start + "Erhe on the, and so 283 555-1290 again in the end.") == []
    assert added(field, "und.34@mail7.example.com in erst, dann und.34 (at) mail7.example.com schreiben") == [("email", "und.34 (at) mail7.example.com")]
    for text in ("Licensed under CC BY-NC 4.0.", "In 1999 and 2004 it was 12,345.67 or 10 000 000", 'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" b44e15e09fd311c3cf3163b66d5a9875b883d8ce'):
        assert added(field, text) == []


def test_clean_samples_stay_clean(spark, field):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    found = find_spans([r.text for r in rows], field)
    extra = sum(len(s) - len(b) for b, s in found)
    assert extra <= 0.02 * sum(len(b) for b, _ in found) + 2


def test_query_digests(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in op6_pii(spark, "/root/testdata/sf0.001").collect():
        spans = plain(docs[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_masking():
    text = "mail a@b.c or 1.2.3.4"
    assert masked(text, base_spans(text)) == "mail [EMAIL] or [IP]"
    assert masked(None, []) is None and masked("", []) == ""
    assert masked("+1 234 567 890 1", base_spans("+1 234 567 890 1")) == "[PHONE]"


def test_columns_rows_and_empty_tables(spark):
    nothing = fit_field([])
    rows = [(1, "a@b.c", "s")] * 2 + [(None, None, None), (2, "", "x"), (3, "1 " * 200_000, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = find_personal_data(df, nothing)
    assert found.columns == ["doc_id", "text", "base_spans", "spans", "masked_text"]
    found = sorted(found.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [len(r.base_spans) for r in found] == [1, 1, 0, 0, 0]
    assert [r.masked_text for r in found[:3]] == ["[EMAIL]", "[EMAIL]", ""]
    assert find_personal_data(df.filter("false"), nothing).collect() == []
    assert fit(df.filter("false")).unary.any() == 0


def test_marginals_do_not_depend_on_what_is_inferred_together(monkeypatch):
    texts = [f"call +1 415 555 {n:04d} or 415-555-{n:04d}, mail a{n}@b.org, a{n} (at) b.org, order {n * 7919}" for n in range(40)]
    texts += [None, " ".join(texts)]
    draw = np.random.default_rng(3)
    field = Field(draw.normal(size=(40, LABELS)), draw.normal(size=(LABELS, LABELS)), draw.normal(size=(LABELS, LABELS)))
    monkeypatch.setattr(pii, "SURE", 0.3)
    together = find_spans(texts, field)
    assert any(len(found) > len(base) for base, found in together)
    monkeypatch.setattr(pii, "_NODES_AT_ONCE", 5)
    monkeypatch.setattr(pii, "_MESSAGES_AT_ONCE", 3)
    assert find_spans(texts, field) == together


def test_an_unrelated_number_with_the_same_tail_hides_no_repeat(field):
    text = "call +1 415 555 1234 or +1 212 555 1234, then 415-555-1234"
    nodes = pii.mentions(text, base_spans(text))
    assert [m.kind for m in nodes] == [4, 4, 0] and edges(nodes)[1] == [(0, 2)]
    assert added(field, text) == [("phone", "415-555-1234")]


def test_every_repeat_has_the_evidence_of_its_label_however_far_it_is(field):
    text = "Call the office at +1 (017) 555-7713 today. " + "Erhe on the, and so 017 555-7713 again in the end. " * 30
    nodes = pii.mentions(text, base_spans(text))
    assert {(0, i) for i in range(1, 31)} <= set(edges(nodes)[1])
    assert added(field, text) == [("phone", "017 555-7713")] * 30
    # Numbers that hold a repeat at their end are many, the edges still grow with the mentions.
    keys = [f"{n:05d}5557713" if i % 2 else "5557713" for i, n in enumerate(range(2000))]
    assert len(edges([Mention(i, i + 1, k, 4 * (i == 1), (0,)) for i, k in enumerate(keys)])[1]) < 3 * len(keys)
    keys = ["5557713"] + [f"{n:05d}5557713" for n in range(1000)] + ["5557713"] * 1000
    assert len(edges([Mention(i, i + 1, k, 0, (0,)) for i, k in enumerate(keys)])[1]) == 3000


def test_messages_are_passed_until_they_stop_changing():
    # Evidence at one end of a long chain of strong links reaches the other end, and links that never agree end as well.
    nodes = [Mention(i, i + 1, str(i), 4 * (i == 0), (0,)) for i in range(31)]
    field = Field(np.zeros((40, LABELS)), 6.0 * np.eye(LABELS), np.zeros((LABELS, LABELS)))
    exact = 0.2 + 0.8 * ((np.exp(6) - 1) / (np.exp(6) + 4)) ** np.arange(31)
    assert np.abs(marginals(graph([nodes]), field)[:, 4] - exact).max() < 1e-2
    draw = np.random.default_rng(5)
    swinging = Field(draw.normal(size=(40, LABELS)), -9.0 * np.eye(LABELS), -9.0 * np.eye(LABELS))
    assert np.isfinite(marginals(graph([[Mention(i, i + 1, "5551234567", 0, (i % 40,)) for i in range(60)]]), swinging)).all()


def test_runs_of_figures_against_the_patterns():
    draw = random.Random(12)
    for _ in range(3000):
        parts = ["".join(draw.choice("0123456789") for _ in range(draw.choice([1, 2, 3, 4, 9, 16]))), ".", "..", "+", " ", "-", "(", "255", "a", "@", "é"]
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(30)))
        assert [(KINDS[s.kind], s.start, s.end) for s in base_spans(text)] == plain(text), repr(text)


def test_time_grows_with_the_text_alone():
    for text in (
        "7" * 1_000_000, "1." * 500_000, "12.34.56 " * 110_000, "+1 " * 330_000, "+1" + "(" * 1_000_000, "1 " * 500_000, "a@" * 500_000, "a@" + "b" * 1_000_000,
        "4111111111111111 " * 60_000, "1-" * 500_000 + "x",
    ):
        start = time.perf_counter()
        base = base_spans(text)
        took = time.perf_counter() - start
        mentions(text, base)
        assert took < 4 and time.perf_counter() - start < 15, text[:10]
    start = time.perf_counter()
    mentions("7" * 1_000_000, base_spans("7" * 1_000_000))
    assert time.perf_counter() - start < 3


def test_mentions_between_base_spans_are_nodes():
    text = "call +1 017 555-7713 or write 017 555-7713 10.0.0.1 a@b.co 4111 1111 1111 1111, 5557713"
    nodes = [(text[m.start : m.end], m.kind) for m in mentions(text, base_spans(text))]
    assert [n for n in nodes if n[1] == 0] == [("017 555-7713", 0), ("5557713", 0)]
    for a, b in zip(mentions(text, base_spans(text)), mentions(text, base_spans(text))[1:]):
        assert a.end <= b.start or a.kind and b.kind
