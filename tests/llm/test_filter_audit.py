import random
import re
from itertools import permutations

import numpy as np
import pytest

from shelfline.llm.filter_audit import Limits, audit_filters, contracted, fail_counts

from ..conftest import plan_of, rows_of

NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def _plain(docs, labels):
    """The audit as it is defined, document by document."""
    rows = [(i, t or "", s or "") for i, t, s in docs]
    fails = []
    for i, text, part in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = set()
        failed |= {"A"} if len(words) < 200 else set()
        failed |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        failed |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        failed |= {"D"} if re.search("[#$%&*|]", text) else set()
        failed |= {"E"} if i is not None and any(j is not None and j < i and t == text for j, t, _ in rows) else set()
        good = any(j == i and q == 1 for j, q, _ in labels if i is not None)
        toxic = any(j == i and x == 1 for j, _, x in labels if i is not None)
        fails.append((part, failed, good, toxic))
    out = []
    for part in {p for p, *_ in fails}:
        mine = [f for f in fails if f[0] == part]
        found, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                here = [f for f in left if name in f[1]]
                left = [f for f in left if name not in f[1]]
                failing = sum(name in f[1] for f in mine)
                shapley[name] += len(here)
                alone = sum(f[1] == {name} for f in mine)
                found.append((part, "".join(order), step, len(left), len(here), failing - len(here), alone, sum(f[2] for f in here), sum(f[3] for f in here)))
        out += [(*row, shapley[row[1][row[2] - 1]]) for row in found]
    return sorted(out, key=repr)


def _found(spark, docs, labels):
    df = audit_filters(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert df.columns == NAMES
    return rows_of(df)


def _random_docs(draw, n):
    plain = " ".join(f"w{i}" for i in range(220))
    texts = ["", None, "a", plain, plain + " #", plain.upper(), "x " * 250, "X " * 250 + "|", plain + " é" * 3, "a\x0bb\x1cc", plain]
    return [(draw.choice([i, i, i, None]), draw.choice(texts), draw.choice(["s", "t", "", None])) for i in range(n)]


def test_against_the_definition(spark):
    draw = random.Random(2)
    docs = _random_docs(draw, 80)
    docs += docs[:5]
    labels = [(draw.randrange(90), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(60)] + [(None, 1, 1)]
    assert _found(spark, docs, labels) == _plain(docs, labels)


def test_limits_are_met_exactly(spark):
    words = [f"w{i}" for i in range(100)]
    texts = {
        "A": " ".join([f"w{i}" for i in range(199)]),
        "": " ".join([f"w{i}" for i in range(200)]),
        "B": " ".join([*words[:99], *["w0"] * 101]),
        "b": " ".join([*words, *["w0"] * 100]),
        "C": " ".join([f"w{i}" for i in range(200)]) + " " + "x" * (150 - 90) + "A" * 21,
        "D": " ".join([f"w{i}" for i in range(200)]) + "|",
    }
    docs = [(i, t, name) for i, (name, t) in enumerate(texts.items())]
    found = {(r[0], r[1][0]) for r in _found(spark, docs, []) if r[2] == 1 and r[4]}
    assert {("A", "A"), ("B", "B"), ("D", "D")} <= found and not {x for x in found if x[0] in ("", "b")}
    assert _found(spark, docs, []) == _plain(docs, [])


def test_copies_over_parts_and_repeated_ids(spark):
    docs = [(5, "same", "p"), (3, "same", "q"), (3, "same", "q"), (4, None, "p"), (2, "", "q"), (None, "same", "p"), (None, "same", "p")]
    counts = fail_counts(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS))
    copies = {(r.part, r.failed >> 4 & 1): r.documents for r in counts.collect()}
    assert copies == {("p", 1): 2, ("p", 0): 2, ("q", 0): 3}


def test_empty_tables(spark):
    assert _found(spark, [], []) == [] == _found(spark, [], [(1, 1, 1)])


def test_very_long_text(spark):
    docs = [(1, "Word é " * 400_000, "s"), (2, "Word é " * 400_000, "s")]
    assert _found(spark, docs, [(2, 1, 0)]) == _plain(docs, [(2, 1, 0)])


def test_other_limits(spark):
    docs = spark.createDataFrame([(1, "one two", "s")], DOCS)
    counts = fail_counts(docs, spark.createDataFrame([], LABELS), Limits(words=2, marks="w")).collect()
    assert [r.failed for r in counts] == [8]


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 7, "x"), (2, "a b", "s", 8, "y")], DOCS + ", failed int, part string")
    labels = spark.createDataFrame([(1, 1, 0, "z")], LABELS + ", text string")
    assert rows_of(audit_filters(docs, labels)) == _plain([(1, "a b", "s"), (2, "a b", "s")], [(1, 1, 0)])


@pytest.mark.parametrize("seed", range(3))
def test_contraction_of_counts(seed):
    counts = np.random.default_rng(seed).integers(0, 2**40, (3, 2, 2, 2, 2, 2, 2))
    sums = contracted(counts)
    for choice in np.ndindex(3, 3, 3, 3, 3):
        picked = counts[np.ix_(range(3), range(2), *[[0, 1] if c == 2 else [c] for c in choice])]
        assert (sums[:, :, *choice] == picked.sum(axis=(2, 3, 4, 5, 6))).all()


def test_joins_are_by_document(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    docs = spark.createDataFrame([(1, "a", "s"), (2, "a", "s")], DOCS)
    plan = plan_of(fail_counts(docs, spark.createDataFrame([(1, 1, 1)], LABELS)))
    assert plan.count("hashpartitioning(content") == 1 and "hashpartitioning(doc_id" in plan and "Nested" not in plan
