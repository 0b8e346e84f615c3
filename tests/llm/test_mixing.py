import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfline.llm import mixing
from shelfline.llm.mixing import mix_sources

SCHEMA = "doc_id long, text string, source string"


def shares(sizes, weights=(5, 2, 1), most=3):
    """Targets by repeated resharing: cap what is above, give the excess to the others by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        above = {s for s in names if s not in capped and target[s] >= most * sizes[s]}
        if not above:
            return target
        capped |= above


def check(rows, found):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    by_source = defaultdict(int)
    for i, _, s in rows:
        by_source[s] += size[i]
    target, taken, longest = shares(by_source), defaultdict(int), defaultdict(int)
    assert sorted(r.doc_id for r in found) == sorted(i for i, _, _ in rows)
    for r in found:
        assert r.size == size[r.doc_id] and r.source_size == by_source[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert r.taken == r.size * r.copies <= 3 * r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    biggest = max(longest.values())
    assert sum(taken.values()) <= sum(size.values()) < sum(taken.values()) + 2 * biggest
    for s in target:
        assert abs(taken[s] - target[s]) <= longest[s] + biggest
    # Fair queueing: what is taken last finishes no later than anything left would.
    return taken


@pytest.mark.parametrize("range_rows", [2_000, 7])
def test_against_resharing(spark, range_rows, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", range_rows)
    draw = random.Random(3)
    rows = []
    for i in range(600):
        source = draw.choice(["b"] * 20 + ["a", "ä", "", "c", "c", None, "Z"])
        rows.append((i, draw.choice([" ".join(["w"] * draw.randrange(60)), "", None, "one two x\n y"]), source))
    found = mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, found)
    again = mix_sources(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)).collect()
    assert sorted((r.doc_id, r.copies) for r in found) == sorted((r.doc_id, r.copies) for r in again)


def test_order_is_that_of_the_virtual_finish_time(spark, monkeypatch):
    """Brute force over the same shuffle: queue every copy by finish time and cut at the budget."""
    draw = random.Random(9)
    rows = [(i, "w " * draw.randrange(1, 30), draw.choice("aaab")) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = mix_sources(df).collect()
    marks = {r.doc_id: r.m for r in df.selectExpr("doc_id", f"xxhash64({mixing.SEED}, doc_id, text) m").collect()}
    target = {r.source: (r.target, r.source_size) for r in found}
    queue = []
    for s, (t, whole) in target.items():
        end = 0
        for r in sorted((r for r in found if r.source == s), key=lambda r: (marks[r.doc_id], r.size)):
            end += r.size
            queue += [((e * whole + end) / t, s, e, end, r.doc_id, r.size) for e in range(3)]
    left, copies = sum(r.size for r in found), defaultdict(int)
    for *_, doc, size in sorted(queue):
        left -= size
        if left < 0:
            break
        copies[doc] += 1
    assert {r.doc_id: r.copies for r in found} == {i: copies[i] for i, _, _ in rows}


def test_no_rows_no_words_and_one_source(spark):
    assert mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []
    (row,) = mix_sources(spark.createDataFrame([(1, None, None)], SCHEMA)).collect()
    assert (row.size, row.source_size, row.target, row.taken) == (0, 0, 0.0, 0)
    rows = [(i, "a b c", "s") for i in range(9)]
    assert {r.copies for r in mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()} == {1}


def test_repeated_and_null_keys_and_clashing_columns(spark):
    rows = [(1, "a b", "s", 7, "x")] * 5 + [(None, "a b c", "t", 8, "y")] * 4
    found = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string, size int, more string"))
    assert found.columns == ["doc_id", "text", "source", "more", "size", "source_size", "target", "copies", "taken"]
    rows = found.collect()
    assert len(rows) == 9 and {r["size"] for r in rows} == {2, 3}
    assert sum(r.taken for r in rows) <= 22


def test_long_text_is_counted_whole(spark):
    (row,) = mix_sources(spark.createDataFrame([(1, "word " * 300_000, "s")], SCHEMA)).collect()
    assert (row.size, row.taken) == (300_000, 300_000)


def test_rows_alike_are_queued_by_their_number(spark, monkeypatch):
    """The same mix whether rows that are alike are numbered by a window or by ranges; half of the rows are alike."""
    rows = [(None, f"t{i % 3}", "a", 5) for i in range(700)] + [(i, "x", "ab"[i % 2], 1 + i % 9) for i in range(500)] + [(7, "same", "b", 4)] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, words long").repartition(6)
    found = []
    for most in (10_000, 100, 7):
        monkeypatch.setattr(mixing, "ROWS_PER_RANGE", most)
        found.append(sorted((tuple(r) for r in mix_sources(df, size="words").collect()), key=repr))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)
    taken, target = Counter(), {}
    for r in mix_sources(df, size="words").collect():
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)


def test_many_rows_alike_fill_no_window(spark):
    df = spark.range(60_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'t' AS text", "'a' AS source", "3L AS words", "id AS more")
    wide = df.withColumns({"_sid": F.lit(1), "_mark": F.lit(5).cast("long"), "_size": F.lit(3).cast("long"), "_tie": F.xxhash64("more")})
    queued = spark.createDataFrame([(1, 5, 3, 100, 60_000)], "_sid int, _mark long, _size long, _start long, _n long")
    found = mixing._numbered(wide, queued)
    assert sorted(r._nth for r in found.select("_nth").collect()) == list(range(60_000))
    one_by_one = mixing._one_by_one(queued.withColumns({"_target": F.lit(1.0), "_source_size": F.lit(1)}))
    assert one_by_one.select("_end").distinct().count() == 60_000
    assert one_by_one.groupBy(F.spark_partition_id()).count().count() > 4
    taken = mix_sources(df, size="words").agg(F.sum("taken"), F.count("*"), F.sum("copies")).first()
    assert tuple(taken) == (180_000, 60_000, 60_000)


def test_sizes_that_are_null(spark):
    df = spark.createDataFrame([(1, "a", "s", None), (2, "b", "s", 4)], "doc_id long, text string, source string, words long")
    assert sorted((r.doc_id, r.size, r.taken) for r in mix_sources(df, size="words").collect()) == [(1, 0, 0), (2, 4, 4)]
