import math
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from shelfline.llm import topk
from shelfline.llm.ann import nearest, probes_for
from shelfline.llm.oracle import ORACLE
from shelfline.llm.topk import reached, rotation, surviving, top_k
from shelfline.llm.vectors import Block, best_of_block

SCHEMA = "vec_id long, embedding array<float>"


def make(n, d, seed, spread=True):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, d)).astype(np.float32)
    if spread:
        x *= draw.uniform(0.1, 3, size=(n, 1)).astype(np.float32)
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def ints(v):
    return [math.floor(64 * x) for x in v]


def plain(rows, asked, component, k=20):
    known = {i: component(v) for i, v in rows}
    out = {}
    for q in asked:
        scores = sorted((-sum(a * b for a, b in zip(known[q], v)), i) for i, v in known.items() if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def grouped(df):
    out = defaultdict(list)
    for r in sorted(df.collect()):
        out[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return dict(out)


@pytest.mark.parametrize("tile_rows", [512, 7])
def test_top_k_against_brute_force(spark, tile_rows):
    rows = make(700, 40, 1) + [(1000 + i, make(700, 40, 1)[3][1]) for i in range(30)] + [(2000, [0.0] * 40), (2020, [1e3] * 40)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = grouped(top_k(df, df.filter("vec_id % 20 = 0"), tile_rows=tile_rows, chunk_rows=tile_rows))
    assert found == plain(rows, [i for i, _ in rows if i % 20 == 0], ints)


def test_bounds_never_lose_a_pair_and_do_prune():
    draw = np.random.default_rng(2)
    q, t = (np.floor(draw.normal(size=(n, 64)) * np.linspace(40, 1, 64)) for n in (50, 400))
    scores = q @ t.T
    bounds = np.sort(scores, axis=1)[:, -20]
    alive = surviving(Block(np.arange(50).tobytes(), q.tobytes(), bounds.tobytes()), Block(np.arange(400).tobytes(), t.tobytes(), bounds.tobytes()), rotation(t))
    assert alive[scores >= bounds[:, None]].all()
    assert alive.mean() < 0.1


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [1.0]), (40, None), (60, [nan, 1.0]), (80, [inf]), (100, [None, 1.0]), (120, []), (3, [0.5, 0.5]), (3, [0.5, 0.5]), (None, [1.0, 1.0]), (140, [1e30, -1e30]), (141, [1e12, 1e12]), (160, [1e12, 1e12])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as rank", "'x' as v")
    found = grouped(top_k(df, df.filter("vec_id % 20 = 0")))
    assert set(found) == {0, 20, 120, 140, 160}
    assert found[0] == [(141, 64 * 64 * 3 * 10**12), (160, 64 * 64 * 3 * 10**12), (3, 64 * 32 * 3), (3, 64 * 32 * 3), (20, 64 * 64), (120, 0), (140, found[0][-1][1])]
    assert found[160][0] == (141, 2**63 - 1) and found[120][0] == (0, 0)
    assert top_k(df.filter("false"), df).collect() == [] and top_k(df, df.filter("false")).collect() == []


def dot(v):
    return [float(np.float32(x)) for x in v]


def test_ann_on_few_vectors_is_exact(spark):
    rows = make(150, 12, 3)
    rows += [(500 + i, rows[3][1]) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = grouped(nearest(df, df.filter("vec_id % 20 = 0"), recall=1.0))
    expected = plain(rows, [i for i, _ in rows if i % 20 == 0], dot)
    hits = 0
    for q, near in expected.items():
        assert len(found[q]) == 20
        assert found[q] == sorted(found[q], key=lambda x: (-x[1], x[0]))
        hits += len({i for i, _ in near} & {i for i, _ in found[q]})
    assert hits >= 0.97 * 20 * len(expected)
    few = spark.createDataFrame(rows[:9], SCHEMA)
    (near,) = grouped(nearest(few, few.filter("vec_id = 0"))).values()
    assert sorted(i for i, _ in near) == list(range(1, 9))


def test_ann_recall_on_the_samples(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    x, ids = np.array([r.embedding for r in rows], dtype=np.float64), np.array([r.vec_id for r in rows])
    found = grouped(nearest(df, df.filter("vec_id % 20 = 0")))
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(ids[np.argsort(-scores)[:20]]) & {i for i, _ in found[ids[q]]})
        assert all(abs(s - x[ids == i][0] @ x[q]) < 1e-12 for i, s in found[ids[q]])
    assert hits >= 0.93 * 20 * len(found)


def test_ann_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [1.0]), (40, None), (60, [nan, 1.0]), (80, [inf]), (100, [None, 1.0]), (120, []), (140, [0.0, 0.0]), (3, [0.5, 0.5]), (3, [0.5, 0.5]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as rank", "'x' as v")
    assert grouped(nearest(df, df.filter("vec_id % 20 = 0"))) == {0: [(3, 1.5), (3, 1.5), (20, 1.0)], 20: [(0, 1.0), (3, 0.5), (3, 0.5)]}
    assert nearest(df.filter("false"), df).collect() == [] and nearest(df, df.filter("false")).collect() == []


def test_best_of_block_breaks_ties_by_id():
    ids = np.array([9, 4, 7])
    q, v, s = best_of_block(np.array([1, 2]), ids, np.array([0, 0, 0, 1]), np.array([0, 1, 2, 0]), np.array([5.0, 5.0, 6.0, 1.0]), 2)
    assert (list(q), list(v), list(s)) == ([1, 1, 2], [7, 4, 9], [6.0, 5.0, 1.0])


def test_rows_that_repeat_a_key_all_count(spark):
    duckdb = pytest.importorskip("duckdb")
    rows = make(60, 6, 8) + [(i % 30, v) for i, v in make(90, 6, 9)] + [(7, [9.0] * 6), (7, [-9.0] * 6), (20, [9.0] * 6), (20, [-9.0] * 6)]
    rows += [(7, [9.0] * 6)] * 3 + [(40, [1.0] * 6)] * 2 + [(51, [8.0] * 6)] * 40 + [(60, [2.0, 1.0, 0.0, 0.0, 0.0, 0.5])] * 30
    df = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings(vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [list(r) for r in rows])
    assert sorted(tuple(r) for r in top_k(df, df.filter("vec_id % 20 = 0")).collect()) == sorted(con.execute(ORACLE["op8_top_k"]).fetchall())
    found = grouped(nearest(df, df.filter("vec_id % 20 = 0"), recall=1.0))
    for q, near in found.items():
        scores = [(i, float(np.dot(np.float32(a).astype(float), np.float32(b).astype(float)))) for o, a in rows if o == q for i, b in rows if i != q]
        best = sorted(scores, key=lambda x: (-x[1], x[0]))[:20]
        assert [i for i, _ in near][:5] == [i for i, _ in best][:5] and len(near) == 20


def test_chunks_go_only_to_slots_that_they_can_reach(spark):
    # Steps by descending length; the third is longer than the second, so whoever meets it meets both.
    df = spark.createDataFrame([(9.5,), (6.0,), (3.0,), (1.0,), (0.0,), (float("-inf"),)], "need double")
    found = [n for (n,) in df.select(reached(np.array([9.0, 4.0, 5.0, 2.0]), F.col("need"))).collect()]
    assert found == [0, 1, 3, 4, 4, 4]


def test_queries_meet_few_candidates_where_lengths_differ(spark):
    draw = np.random.default_rng(11)
    x = draw.normal(size=(4000, 16)) * np.exp(draw.normal(size=(4000, 1)) * 1.5)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    met = spark.sparkContext.accumulator(0)
    whole = topk._compare

    def counting(q, t, basis, k):
        met.add(len(q.ids) * len(t.ids))
        return whole(q, t, basis, k)

    topk._compare = counting
    try:
        found = grouped(top_k(df, df.filter("vec_id % 20 = 0"), tile_rows=64, chunk_rows=16))
    finally:
        topk._compare = whole
    v = np.floor(64 * x).astype(np.int64)
    for q, near in found.items():
        scores = v @ v[q]
        scores[q] = np.iinfo(np.int64).min
        assert [s for _, s in near] == sorted(scores.tolist(), reverse=True)[:20]
    assert 0 < met.value < 0.4 * len(found) * len(rows)


def test_probes_hold_the_share_of_neighbours():
    assert [probes_for(np.array([0, 0, 1, 7]), r) for r in (0.5, 0.75, 0.76, 1.0)] == [1, 2, 8, 8]
    assert probes_for(np.array([]), 0.9) == 1


@pytest.mark.parametrize("groups", [40, 0])
def test_ann_measures_how_many_lists_it_needs(spark, groups):
    draw = np.random.default_rng(12)
    x = draw.normal(size=(6000, 24))
    if groups:
        x = draw.normal(size=(groups, 24))[draw.integers(groups, size=6000)] * 3 + 0.3 * x
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = grouped(nearest(df, df.filter("vec_id % 20 = 0")))
    hits = 0
    for q, near in found.items():
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & {i for i, _ in near})
    assert len(found) == 300 and hits >= 0.9 * 20 * 300
