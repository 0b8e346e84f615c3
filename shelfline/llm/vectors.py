"""Vectors packed into blocks, for searches that compare blocks of queries with blocks of candidates."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a block of candidates and of a block of queries.
TILE_ROWS = 512
CHUNK_ROWS = 256
#: Rows that one task packs into blocks.
ROWS_PER_TASK = 4096


def finite_vectors(df: DataFrame, key: str, vector: str, k: int, component: Callable[[Column], Column] = lambda x: x) -> DataFrame:
    """(id, v, copy) with v an array<double> of ``component`` of every component.

    Rows with a null key, a null vector, or a null or non-finite component are left out. Rows with the same key
    and other vectors all stay. Full copies are counted, and stay too, numbered from 0 by ``copy``, but no more than
    ``k`` of them: a list of ``k`` has no place for more, and further copies of a query only repeat what fills its list.
    """
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(key).cast("long").alias("id"), v.alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(good, F.lit(False)))
    counted = rows.groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).alias("copies"))
    kept = counted.select("id", F.transform("v", component).cast("array<double>").alias("v"), "copies")
    return kept.select("id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix of doubles; shorter ones end in zeros."""
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    lengths = np.diff(ends)
    if (lengths == width).all():
        return values[ends[0] : ends[-1]].reshape(-1, width)
    out = np.zeros((len(lengths), width))
    for i, n in enumerate(lengths):
        out[i, :n] = values[ends[i] : ends[i + 1]]
    return out


def packed(rows: DataFrame, width: int, block_rows: int) -> DataFrame:
    """Blocks of at most ``block_rows`` neighbouring rows of the same ``place``, in the order in which rows are.

    ``rows`` has (place long, id long, v array<double>, bound double). A block is a row of (place, ids, data,
    bounds) as packed numbers, the greatest norm ``high``, and ``need``, the least norm with which another vector can
    have an inner product of the bound or more with some row (a little less than that, by more than doubles err).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held_place, n_held = 0, 0

        def block() -> pa.RecordBatch:
            ids, data, bounds = (np.concatenate(x) for x in zip(*held))
            norms = np.sqrt(np.einsum("ij,ij->i", data, data))
            needs = np.where(norms > 0, (bounds - 1) / np.where(norms > 0, norms, 1.0), -np.inf) * (1 - 1e-9)
            columns = [[held_place], [ids.tobytes()], [data.tobytes()], [bounds.tobytes()], [float(norms.max())], [float(needs.min())]]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["place", "ids", "data", "bounds", "high", "need"])

        for batch in batches:
            if not batch.num_rows:
                continue
            places, ids, bounds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("place", "id", "bound"))
            data = matrix(batch.column("v"), width)
            cuts = [0, *(np.flatnonzero(np.diff(places)) + 1), len(places)]
            for start, end in zip(cuts, cuts[1:]):
                if held and places[start] != held_place:
                    yield block()
                    held, n_held = [], 0
                held_place = int(places[start])
                while start < end:
                    stop = min(end, start + block_rows - n_held)
                    held.append((ids[start:stop], data[start:stop], bounds[start:stop]))
                    n_held, start = n_held + stop - start, stop
                    if n_held == block_rows:
                        yield block()
                        held, n_held = [], 0
        if held:
            yield block()

    ordered = rows.select("place", "id", "v", F.col("bound").cast("double").alias("bound"))
    return ordered.mapInArrow(run, "place long, ids binary, data binary, bounds binary, high double, need double")


class Block:
    """A packed block in a task."""

    def __init__(self, ids: bytes, data: bytes, bounds: bytes):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        self.data = np.frombuffer(data).reshape(len(self.ids), -1)
        self.bounds = np.frombuffer(bounds)


def compared(
    pairs: DataFrame, compare: Callable[[Block, Block], tuple[np.ndarray, np.ndarray, np.ndarray]], score: str = "double"
) -> DataFrame:
    """(query_id, vec_id, score) from ``compare(chunk, tile)`` for every row of ``pairs``, which has the packed
    columns of a chunk of queries (q_ids, q_data, q_bounds) and of a tile of candidates (t_ids, t_data, t_bounds).

    Spark limits a batch of rows by bytes, so a task holds some pairs at a time.
    """
    names = [f"{side}_{c}" for side in "qt" for c in ("ids", "data", "bounds")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = [batch.column(name)[i].as_py() for name in names]
                columns = compare(Block(*parts[:3]), Block(*parts[3:]))
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    return pairs.select(*names).mapInArrow(run, f"query_id long, vec_id long, score {score}")


def sided(blocks: DataFrame, side: str) -> DataFrame:
    return blocks.select(*(F.col(c).alias(f"{side}_{c}") for c in blocks.columns))


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest scores of every query, ties to the smaller id, ranked from 1."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best_of_block(query_ids: np.ndarray, vec_ids: np.ndarray, rows: np.ndarray, columns: np.ndarray, scores: np.ndarray, k: int):
    """Of pairs given by (row, column, score), the ``k`` best of every row: highest score, then smallest id."""
    order = np.lexsort((vec_ids[columns], -scores, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
    keep = place < k
    return query_ids[rows[keep]], vec_ids[columns[keep]], scores[keep]
