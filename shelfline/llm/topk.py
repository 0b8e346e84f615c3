"""Exact top-k by inner product of integer vectors: longest vectors first, bounded partial sums."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import frozen
from .vectors import CHUNK_ROWS, ROWS_PER_TASK, TILE_ROWS, Block, best, best_of_block, compared, finite_vectors, matrix, norm, packed, sided

SCALE = 64
K = 20
#: Vectors that the rotation is fitted on, and longest vectors that give the first bounds. Results don't depend on them.
FIT_ROWS = 4096
SEED_ROWS = 2048
TILES_PER_SLOT = 4
#: Steps of length by which chunks are sent to slots, at most.
STEPS = 1024
#: Dimensions of a partial sum.
STEP = 16
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def scaled(x: Column) -> Column:
    return F.floor(F.lit(float(SCALE)) * x)


def rotation(sample: np.ndarray) -> np.ndarray:
    """Right singular vectors of the sample, the strongest direction first."""
    return np.linalg.eigh(sample.T @ sample)[1][:, ::-1]


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """All inner products. Sums of whole numbers below 2**53 are exact in doubles, in any order of adding."""
    return q @ v.T


def reached(highs: np.ndarray, need: Column) -> Column:
    """How many of the steps, which lie by descending length, a chunk must meet that needs vectors of the length ``need``."""
    # A step counts as long as any behind it.
    falling = np.maximum.accumulate(highs[::-1])[::-1]
    return F.size(F.filter(F.lit([float(x) for x in falling]), lambda high: high >= need))


def _large(q: np.ndarray, v: np.ndarray) -> bool:
    return len(q) > 0 and len(v) > 0 and np.abs(q).max() * np.abs(v).max() * q.shape[1] >= _EXACT


def surviving(q: Block, t: Block, basis: np.ndarray, step: int = STEP) -> np.ndarray:
    """Which pairs may still reach the query's bound, judged by growing partial sums of rotated vectors.

    What the dimensions left out can add is at most the product of the lengths of both residuals. Bounds are
    raised by far more than doubles err, so no pair that reaches its query's bound is ever dropped.
    """
    qr, tr = q.data @ basis, t.data @ basis
    width = basis.shape[1]
    slack = 1e-9 * np.sqrt((qr**2).sum(axis=1).max() * (tr**2).sum(axis=1).max()) + 1e-6
    rest_q, rest_t = (np.sqrt(np.maximum(np.cumsum((x**2)[:, ::-1], axis=1)[:, ::-1], 0)) for x in (qr, tr))
    columns = np.flatnonzero(rest_q[:, 0].max() * rest_t[:, 0] + slack >= q.bounds.min())
    alive = np.zeros((len(qr), len(tr)), dtype=bool)
    sums, ok = np.zeros((len(qr), len(columns))), np.ones((len(qr), len(columns)), dtype=bool)
    for start in range(0, width, step):
        if not len(columns):
            return alive
        end = min(width, start + step)
        sums += qr[:, start:end] @ tr[columns, start:end].T
        rest = rest_q[:, end][:, None] * rest_t[columns, end][None, :] if end < width else 0.0
        ok &= sums + rest + slack >= q.bounds[:, None]
        used = ok.any(axis=0)
        if used.mean() < 0.7:
            columns, sums, ok = columns[used], sums[:, used], ok[:, used]
    alive[:, columns] = ok
    return alive


def _compare(q: Block, t: Block, basis: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if _large(q.data, t.data):
        # Too large for doubles: whole numbers of any size, which end at the range of a long.
        exact = np.array([[max(-_LONG - 1, min(_LONG, sum(int(a) * int(b) for a, b in zip(x, y)))) for y in t.data] for x in q.data], dtype=np.int64)
        rows, columns = np.nonzero(q.ids[:, None] != t.ids[None, :])
        scores = exact[rows, columns]
    else:
        alive = surviving(q, t, basis) & (q.ids[:, None] != t.ids[None, :])
        rows, columns = np.nonzero(alive)
        scores = _scores(q.data, t.data)[rows, columns].astype(np.int64)
    return best_of_block(q.ids, t.ids, rows, columns, scores, k)


def top_k(
    vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, tile_rows: int = TILE_ROWS, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` the ``k`` rows of ``vectors`` with other keys
    whose scaled integer vectors have the largest inner product with it; fewer, if there are fewer.

    Both tables have ``key`` and ``vector``. Vectors that are null or hold null or non-finite components take
    no part, nor do null keys. Every row counts, as in the SQL of op8: rows with the same key, copies too, share one list as
    queries, and are one candidate each. A vector shorter than others ends in zeros. Ties go to the smaller key. Scaled
    components beyond the range of a long end there, and so do scores. Empty tables give no rows.

    Candidates are sorted by range of their length, the longest first, and packed into tiles; a range is a slot. The
    k-th best score among the longest vectors is a query's first bound; by Cauchy and Schwarz the bound over the query's
    own length is the length that a candidate needs. Queries are sorted by that and packed into chunks, and a chunk is
    sent only to the slots that hold such lengths, which are the first ones. Nothing but bounded samples, and the greatest
    lengths of at most ``STEPS`` runs of slots, goes to the driver.
    """
    spark = vectors.sparkSession
    rows = frozen(finite_vectors(vectors, key, vector, k, scaled).withColumn("norm", norm(F.col("v"))))
    asked = frozen(finite_vectors(queries, key, vector, k, scaled).withColumn("norm", norm(F.col("v"))))
    count, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    n_asked, asked_width = asked.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    width = max(1, width, asked_width)

    def padded(found) -> np.ndarray:
        out = np.zeros((len(found), width))
        for i, r in enumerate(found):
            out[i, : len(r["v"])] = r["v"]
        return out

    part = int(min(1.0, FIT_ROWS / max(1, count)) * (1 << 31))
    sample = padded(rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 31)) < part).select("v").limit(2 * FIT_ROWS).collect())
    top = np.abs(sample).max(initial=1.0)
    basis = rotation(sample / max(1.0, top))
    longest = rows.orderBy(F.desc("norm"), "id").limit(SEED_ROWS).select("id", "v").collect()
    seed_ids = np.array([r["id"] for r in longest], dtype=np.int64)
    seeds = padded(longest)
    shared = spark.sparkContext.broadcast((seed_ids, seeds))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, data = shared.value
        for batch in batches:
            own, q = batch.column("id").to_numpy(), matrix(batch.column("v"), width)
            bound = np.full(len(own), -np.inf)
            if len(ids) > k and not _large(q, data):
                scores = np.where(own[:, None] == ids[None, :], -np.inf, _scores(q, data))
                bound = np.partition(scores, -k, axis=1)[:, -k]
            columns = [*(batch.column(c) for c in ("id", "v", "copy", "norm")), pa.array(bound)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "copy", "norm", "bound"])

    def dealt(df: DataFrame, ranges: int, first: Column) -> DataFrame:
        order = [first, F.col("id"), F.xxhash64("v"), F.col("copy")]
        return df.repartitionByRange(max(1, ranges), *order).sortWithinPartitions(*order)

    place = F.lit(0).cast("long").alias("place")
    tiles = packed(dealt(rows, -(-count // (TILES_PER_SLOT * tile_rows)), F.desc("norm")).select(place, "id", "v", F.lit(0.0).alias("bound")), width, tile_rows)
    tiles = sided(frozen(tiles.withColumn("slot", F.spark_partition_id())), "t")
    needed = F.when(F.col("norm") > 0, F.col("bound") / F.col("norm")).otherwise(float("-inf"))
    # Written, because a range partitioning evaluates its input twice.
    with_bounds = frozen(asked.mapInArrow(bounded, "id long, v array<double>, copy long, norm double, bound double"))
    chunks = sided(packed(dealt(with_bounds, -(-n_asked // ROWS_PER_TASK), F.desc(needed)).select(place, "id", "v", "bound"), width, chunk_rows), "q")
    slots = tiles.agg(F.coalesce(F.max("t_slot"), F.lit(-1))).first()[0] + 1
    run = max(1, -(-slots // STEPS))
    highs = np.zeros(max(1, -(-slots // run)))
    for step, high in tiles.groupBy((F.col("t_slot") / run).cast("int").alias("step")).agg(F.max("t_high")).collect():
        highs[step] = high
    first_slots = F.least(reached(highs, F.col("q_need")) * run, F.lit(slots))
    aimed = chunks.withColumn("n_slots", first_slots).filter("n_slots > 0").withColumn("q_slot", F.explode(F.sequence(F.lit(0), F.col("n_slots") - 1)))
    pairs = aimed.join(tiles, F.col("q_slot") == F.col("t_slot")).filter(F.col("t_high") >= F.col("q_need"))
    found = compared(pairs, lambda q, t: _compare(q, t, basis, k), score="long")
    return best(found, k)
