"""What each filter of a chain removes, in every order of the chain, from counts of documents by what they fail."""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import frozen

#: The filters, in the order of the axes of the tensors.
FILTERS = "ABCDE"
#: What a document is counted as: itself, a good one, a toxic one.
_COUNTS = ("documents", "good", "toxic")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_PARTS_AT_ONCE = 256
# A filter of the chain lets pass (0) or fails (1) a document, or is not looked at.
_PASS, _FAIL, _ALL = range(3)
_CHOICES = np.array([[1, 0], [0, 1], [1, 1]], dtype=np.int64)


@dataclass(frozen=True)
class Limits:
    """A text fails A below ``words`` words, B if it has fewer than ``distinct`` % distinct ones, C above ``capitals``
    % of capitals A to Z in its code points, D if it holds any of ``marks``."""

    words: int = 200
    distinct: int = 50
    capitals: int = 2
    marks: str = "#$%&*|"


def _failed(text: bytes, limits: Limits, marks: bytes) -> int:
    """Bits of the filters A to D, from the lowest on. What bytes.split() takes for white space are the ASCII ones."""
    words = text.split()
    points = len(text) if text.isascii() else len(text.decode())
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < limits.words)
        | (100 * len(set(words)) < limits.distinct * len(words)) << 1
        | (100 * capitals > limits.capitals * points) << 2
        | (len(text.translate(None, marks)) < len(text)) << 3
    )


def judged(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", part: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, part, content, failed) of every document: the SHA-256 of its whole text, and the filters A to D that it
    fails, as bits. Nothing is shuffled."""
    marks = limits.marks.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, failed = [], []
            for value in batch.column(2):
                whole = value.as_py()
                contents.append(hashlib.sha256(whole).digest())
                failed.append(_failed(whole, limits, marks))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(contents, pa.binary()), pa.array(failed, pa.int32())], names=["doc_id", "part", "content", "failed"]
            )

    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, part string, content binary, failed int")


def fail_counts(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(part, failed, documents, good, toxic): documents by the filters that they fail, as bits.

    E fails a document whose text some smaller doc_id has, anywhere in the table. All copies of a text meet as a
    minimum, summed up before the shuffle, and what has the minimum is found by doc_id, so a text that a third of
    the documents have is no hot key. Labels are joined by doc_id as well; a document is good or toxic if any row
    of its labels says so. A null doc_id is smaller than none, larger than none, and without labels.
    """
    rows = frozen(judged(docs, limits))
    known = rows.filter("doc_id IS NOT NULL")
    first = known.groupBy("content").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "content", F.lit(True).alias("is_first"))
    marks = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(*(F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))))
    )
    joined = known.join(first, ["doc_id", "content"], "left").join(marks, "doc_id", "left")
    bit = 1 << FILTERS.index("E")
    known = joined.select("part", F.when(F.col("is_first"), F.col("failed")).otherwise(F.col("failed") + bit).alias("failed"), "good", "toxic")
    nothing = F.lit(None).cast("int")
    unknown = rows.filter("doc_id IS NULL").select("part", "failed", nothing.alias("good"), nothing.alias("toxic"))
    sums = [F.count("*").alias("documents"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic"))]
    return known.unionByName(unknown).groupBy("part", "failed").agg(*sums)


def _steps() -> list[tuple[str, int, int, tuple[int, ...], tuple[int, ...], tuple[int, ...], tuple[int, ...]]]:
    """Of every order and step: order, step, filter, and what is chosen along each axis for what is kept, removed,
    failing in all, and failing alone."""
    out = []
    for order in permutations(range(len(FILTERS))):
        for step, axis in enumerate(order):
            def choice(of_axis: int, before: int, after: int) -> tuple[int, ...]:
                return tuple(of_axis if a == axis else before if a in order[:step] else after for a in range(len(FILTERS)))

            name = "".join(FILTERS[a] for a in order)
            out.append((name, step + 1, axis, choice(_PASS, _PASS, _ALL), choice(_FAIL, _PASS, _ALL), choice(_FAIL, _ALL, _ALL), choice(_FAIL, _PASS, _PASS)))
    return out


def contracted(counts: np.ndarray) -> np.ndarray:
    """Counts by (part, kind, pass or fail of each filter) summed by pass, fail or all of each filter."""
    return np.einsum("pkabcde,va,wb,xc,yd,ze->pkvwxyz", counts, *[_CHOICES] * 5, optimize=True)


def audit(counts: DataFrame) -> DataFrame:
    """For every part, all 120 orders of the filters and each step: part, filter_order, step, kept (after this step),
    removed (here), redundant (failing its filter, removed earlier), unique_fails (failing its filter only),
    good_lost and toxic_lost (removed here), shapley (its filter's removed, summed over all orders).

    ``counts`` is what ``fail_counts`` gives. A part has at most 32 rows there, which meet in one row; tasks work on
    some parts at a time. No counts give no rows.
    """
    steps = _steps()
    n = len(steps)
    axes = np.array([s[2] for s in steps])
    kept, removed, failing, alone = (tuple(np.array([s[k] for s in steps]).T) for k in (3, 4, 5, 6))
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, places = pa.array([s[0] for s in steps]), np.array([s[1] for s in steps], dtype=np.int32)
        for batch in batches:
            for start in range(0, batch.num_rows, _PARTS_AT_ONCE):
                rows = batch.slice(start, _PARTS_AT_ONCE)
                size = rows.num_rows
                table = np.zeros((size, len(_COUNTS), 1 << len(FILTERS)), dtype=np.int64)
                for i, cells in enumerate(rows.column(1).to_pylist()):
                    for cell in cells:
                        table[i, :, cell["failed"]] = [cell[c] for c in _COUNTS]
                # The lowest bit is the last axis of a reshape, so the axes are turned round.
                sums = contracted(table.reshape(size, len(_COUNTS), *[2] * len(FILTERS)).transpose(0, 1, 6, 5, 4, 3, 2))
                documents, here = sums[:, 0], sums[:, 0][:, *removed]
                of_axis = np.stack([here[:, axes == axis].sum(axis=1) for axis in range(len(FILTERS))], axis=1)
                numbers = [
                    documents[:, *kept],
                    here,
                    documents[:, *failing] - here,
                    documents[:, *alone],
                    sums[:, 1][:, *removed],
                    sums[:, 2][:, *removed],
                    of_axis[:, axes],
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(pa.array(np.repeat(np.arange(size), n))),
                        orders.take(pa.array(np.tile(np.arange(n), size))),
                        pa.array(np.tile(places, size)),
                        *(pa.array(x.reshape(-1)) for x in numbers),
                    ],
                    names=names,
                )

    cells = counts.groupBy("part").agg(F.collect_list(F.struct("failed", *_COUNTS)).alias("cells"))
    longs = ", ".join(f"{name} long" for name in names[3:])
    return cells.mapInArrow(run, f"part string, filter_order string, step int, {longs}")


def audit_filters(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The audit of the filters A to E over whole texts, see ``audit`` and ``fail_counts``.

    Part is the source, a null one the empty string. A null text is the empty one. Repeated rows count each; copies
    with the same doc_id do not fail E by each other. An empty table gives no rows. Other columns are not looked at.
    """
    return audit(fail_counts(docs, labels, limits))
