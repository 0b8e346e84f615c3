"""Approximate nearest neighbours by inner product: inverted lists, scanned by growing blocks of dimensions."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import frozen
from .vectors import CHUNK_ROWS, ROWS_PER_TASK, TILE_ROWS, Block, best, best_of_block, compared, finite_vectors, matrix, norm, packed, sided

K = 20
#: Vectors that the lists' centres are fitted on, rounds of fitting, and lists at most.
FIT_ROWS = 16_384
FIT_ROUNDS = 8
MOST_LISTS = 1024
#: Queries whose true neighbours are found by brute force, and the share of these that must lie in the lists probed.
#: How many lists are probed follows from that: few where vectors form groups, most where they have no structure.
TRIAL_QUERIES = 256
RECALL = 0.96
#: A candidate is abandoned if its distance so far is beyond what chance allows at so many deviations.
DEVIATIONS = 2.5
STEP = 16


class Index(NamedTuple):
    """Centres of the lists and the rotation, in one dimension more than the vectors; their greatest length."""

    centres: np.ndarray
    rotation: np.ndarray
    longest: float


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Candidates with one more dimension that makes them all ``longest`` long: then a larger inner product is a
    smaller distance."""
    rest = np.maximum(longest**2 - np.einsum("ij,ij->i", x, x), 0.0)
    return np.concatenate([x, np.sqrt(rest)[:, None]], axis=1)


def lifted_queries(q: np.ndarray, longest: float) -> np.ndarray:
    length = np.sqrt(np.einsum("ij,ij->i", q, q))
    return np.concatenate([q * (longest / np.where(length > 0, length, 1.0))[:, None], np.zeros((len(q), 1))], axis=1)


def nearest_centres(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of every row, nearest first, ties to the smaller number."""
    far = (centres**2).sum(axis=1)[None, :] - 2 * x @ centres.T
    return np.argsort(far, axis=1, kind="stable")[:, :n]


def fit_index(sample: np.ndarray, lists: int, longest: float, seed: int = 5) -> Index:
    """Centres by Lloyd's rounds on the sample, and a random rotation."""
    draw = np.random.default_rng(seed)
    data = lifted(sample, longest)
    centres = data[draw.permutation(len(data))[:lists]]
    for _ in range(FIT_ROUNDS):
        own = nearest_centres(data, centres, 1)[:, 0]
        sums, sizes = np.zeros_like(centres), np.bincount(own, minlength=len(centres))
        np.add.at(sums, own, data)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return Index(centres, np.linalg.qr(draw.normal(size=(data.shape[1],) * 2))[0], longest)


def scanned(q: np.ndarray, x: np.ndarray, bounds: np.ndarray, index: Index, step: int = STEP) -> np.ndarray:
    """Which pairs are left when the dimensions have been added up block by block.

    In a rotated space the first t of D dimensions hold about t / D of a squared distance. A pair is abandoned
    as soon as its part is larger than that of the query's bound by ``DEVIATIONS`` deviations.
    """
    longest, width = index.longest, index.rotation.shape[0]
    qr, xr = lifted_queries(q, longest) @ index.rotation, lifted(x, longest) @ index.rotation
    length = np.sqrt(np.einsum("ij,ij->i", q, q))
    limit = np.where(np.isfinite(bounds), 2 * longest**2 - 2 * bounds * longest / length, np.inf) + 1e-9 * longest**2
    columns, alive = np.arange(len(x)), np.zeros((len(q), len(x)), dtype=bool)
    far, ok = np.zeros(alive.shape), np.ones(alive.shape, dtype=bool)
    for start in range(0, width, step):
        end = min(width, start + step)
        a, b = qr[:, start:end], xr[columns, start:end]
        far += (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T
        allowed = limit * (end / width) * (1 + DEVIATIONS / np.sqrt(end)) ** 2 if end < width else limit
        ok &= far <= allowed[:, None]
        used = ok.any(axis=0)
        if not used.any():
            return alive
        if used.mean() < 0.7:
            columns, far, ok = columns[used], far[:, used], ok[:, used]
    alive[:, columns] = ok
    return alive


def probes_for(places: np.ndarray, recall: float) -> int:
    """The least number of nearest lists that hold the share ``recall`` of all neighbours, given for each neighbour
    the place, from 0, of its list in the order in which its query probes the lists."""
    return 1 + int(np.sort(places)[max(0, int(np.ceil(recall * len(places))) - 1)]) if len(places) else 1


def _trial(rows: DataFrame, trial_ids: np.ndarray, trial: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score, place): the ``k`` best rows of (place, id, v) for each of a bounded number of queries,
    numbered by query_id, among all rows with another id. A task hands on no more than the best of its rows."""
    shared, width = rows.sparkSession.sparkContext.broadcast((trial_ids, trial)), trial.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = shared.value
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
        for batch in batches:
            ids, places = batch.column("id").to_numpy(), batch.column("place").to_numpy()
            scores = np.where(own[:, None] == ids[None, :], -np.inf, q @ matrix(batch.column("v"), width).T)
            most = min(k, len(ids))
            columns = np.argpartition(scores, len(ids) - most, axis=1)[:, len(ids) - most :]
            numbers = np.repeat(np.arange(len(q)), most)
            found = [numbers, ids[columns].ravel(), np.take_along_axis(scores, columns, 1).ravel(), places[columns].ravel()]
            held = [np.concatenate(x) for x in zip(held, found)]
            order = np.lexsort((held[1], -held[2], held[0]))
            held = [x[order] for x in held]
            rank = np.arange(len(order)) - np.searchsorted(held[0], held[0])
            held = [x[(rank < k) & np.isfinite(held[2])] for x in held]
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["query_id", "vec_id", "score", "place"])

    return rows.select("place", "id", "v").mapInArrow(run, "query_id long, vec_id long, score double, place long")


def _compare(q: Block, t: Block, index: Index, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    alive = scanned(q.data, t.data, q.bounds, index) & (q.ids[:, None] != t.ids[None, :])
    rows, columns = np.nonzero(alive)
    scores = np.empty(len(rows))
    for start in range(0, len(rows), 8192):
        part = slice(start, start + 8192)
        # Row by row in one order, so that equal vectors have equal scores.
        scores[part] = (q.data[rows[part]] * t.data[columns[part]]).sum(axis=1)
    return best_of_block(q.ids, t.ids, rows, columns, scores, k)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    recall: float = RECALL,
    tile_rows: int = TILE_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` about the ``k`` rows of ``vectors`` with other
    keys and the largest inner product with it, found among the lists nearest to it.

    Both tables have ``key`` and ``vector``. Vectors that are null, zero, or hold null or non-finite components
    take no part, nor do null keys. Every row counts: rows with the same key, copies too, share one list as queries, and
    are one candidate each. A vector shorter than others ends in zeros. Ties go to the smaller key. A query whose lists hold fewer than ``k`` others gets what all lists
    hold. Empty tables give no rows.

    The lists' centres are fitted on a bounded sample; every row is in a list. ``TRIAL_QUERIES`` queries, drawn by hash,
    are answered by brute force over all rows first, and every query probes so many lists, nearest first, that these
    hold the share ``recall`` of the answers. A list is cut into tiles, and
    the queries that probe it into chunks, so that no task depends on the size of a list. The nearest list is
    scanned first; its k-th best score is the bound with which the others are.
    """
    spark = vectors.sparkSession
    zero = F.forall("v", lambda x: x == 0)
    rows = frozen(finite_vectors(vectors, key, vector, k).filter(~zero).withColumn("norm", norm(F.col("v"))))
    asked = frozen(finite_vectors(queries, key, vector, k).filter(~zero))
    count, width, longest = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1)), F.coalesce(F.max("norm"), F.lit(1.0))).first()
    n_asked, asked_width = asked.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    width = max(width, asked_width)
    lists = int(min(MOST_LISTS, max(1, round(count**0.5 / 4))))
    part = int(min(1.0, FIT_ROWS / max(1, count)) * (1 << 31))
    drawn = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 31)) < part).orderBy("id").limit(2 * FIT_ROWS).collect()
    sample = np.zeros((max(1, len(drawn)), width))
    for i, r in enumerate(drawn):
        sample[i, : len(r["v"])] = r["v"]
    index = fit_index(sample, lists, max(longest, 1e-300))
    lists = len(index.centres)
    shared = spark.sparkContext.broadcast(tuple(index))

    def in_lists(lift, n: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value)
            for batch in batches:
                if batch.num_rows:
                    near = nearest_centres(lift(matrix(batch.column("v"), width), index.longest), index.centres, n)
                    ends = np.arange(0, near.size + 1, near.shape[1], dtype=np.int32)
                    places = pa.ListArray.from_arrays(ends, near.ravel().astype(np.int64))
                    yield pa.RecordBatch.from_arrays([places, batch.column("id"), batch.column("v")], names=["places", "id", "v"])

        return run

    listed = "places array<long>, id long, v array<double>"
    placed = rows.select("id", "v").mapInArrow(in_lists(lifted, 1), listed).select(F.col("places")[0].alias("place"), "id", "v", F.lit(0.0).alias("bound"))
    placed = frozen(placed)

    def dealt(df: DataFrame, n: int) -> DataFrame:
        order = ["place", F.xxhash64("id"), "id", F.xxhash64("v")]
        return df.repartitionByRange(max(1, -(-n // ROWS_PER_TASK)), *order).sortWithinPartitions(*order)

    tiles = sided(frozen(packed(dealt(placed, count), width, tile_rows)), "t")
    probing = frozen(asked.select("id", "v").mapInArrow(in_lists(lifted_queries, lists), listed))
    drawn = probing.orderBy(F.xxhash64("id"), "id", F.xxhash64("v")).limit(TRIAL_QUERIES).collect()
    trial = np.zeros((len(drawn), width))
    for i, r in enumerate(drawn):
        trial[i, : len(r["v"])] = r["v"]
    answered = _trial(placed, np.array([r["id"] for r in drawn], dtype=np.int64), trial, k)
    orders = [{place: i for i, place in enumerate(r["places"])} for r in drawn]
    by_score = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # At most k rows of each of the trial queries.
    answers = answered.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select("query_id", "place").collect()
    probes = probes_for(np.array([orders[r["query_id"]][r["place"]] for r in answers]), recall)

    def scan(targets: DataFrame, n: int) -> DataFrame:
        chunks = sided(packed(dealt(targets, n), width, chunk_rows), "q")
        pairs = chunks.join(tiles, chunks["q_place"] == tiles["t_place"])
        return compared(pairs, lambda q, t: _compare(q, t, Index(*shared.value), k))

    def in_places(df: DataFrame, first: int, n: int) -> DataFrame:
        bound = F.coalesce("bound", F.lit(float("-inf"))).alias("bound")
        return df.select(F.explode(F.slice("places", first, n)).alias("place"), "id", "v", bound)

    unbounded = F.lit(None).cast("double")
    found = frozen(best(scan(in_places(probing.withColumn("bound", unbounded), 1, 1), n_asked), k))
    if probes > 1:
        bounds = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
        more = scan(in_places(probing.join(bounds, "id", "left"), 2, probes - 1), n_asked * (probes - 1))
        found = frozen(best(found.drop("rank").unionByName(more), k))
    if probes < lists:
        # Queries whose lists hold too few candidates; mostly there are none.
        full = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"))
        short = frozen(probing.join(full, "id", "left_anti").withColumn("bound", unbounded))
        n_short = short.count()
        if n_short:
            more = scan(in_places(short, probes + 1, lists - probes), n_short * (lists - probes))
            found = best(found.drop("rank").unionByName(more), k)
    return found
