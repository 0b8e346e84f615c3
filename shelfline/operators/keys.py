"""Dense surrogate keys 1..n in the order of a natural key, without sorting the table in one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage

# monotonically_increasing_id() holds the partition number above the position within the partition.
_POSITION_BITS = 33


def dense_key(df: DataFrame, order_by: Sequence[str], key: str) -> DataFrame:
    """``df`` with ``key`` (bigint) in front: the row number in the order of ``order_by``.

    ``row_number()`` over the whole table moves every row into one task. Here the table is range-partitioned
    and sorted in parallel, which gives each row its range and its position in it; the key is that position
    plus the number of rows in the ranges before. All other columns break ties, so that copies of one natural
    key spread over ranges too and the numbering is the same in every run.

    The placed rows are written once and read back: the bounds of a range partitioning come from a sample, so
    evaluating it twice (for the sizes and for the rows) could place a row differently each time.
    """
    order = [*order_by, *(name for name in df.columns if name not in order_by)]
    placed = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        key,
    )
    in_range = F.col("_place").bitwiseAND((1 << _POSITION_BITS) - 1)
    in_front = F.get(_rows_before(placed), F.col("_range"))
    return placed.withColumn("_range", _range().cast("int")).select(
        (in_front + in_range + 1).alias(key), *df.columns
    )


def _range() -> Column:
    return F.shiftright("_place", _POSITION_BITS)


def _rows_before(placed: DataFrame) -> Column:
    """Array of the number of rows in all ranges before each one, as a scalar subquery.

    There is one element per range, so at most spark.sql.shuffle.partitions. Joining the numbers instead would
    make Spark expect a far larger table, and shuffle sales rather than broadcast a small dimension.
    """
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sizes = placed.groupBy(_range().cast("int").alias("_range")).agg(F.count("*").alias("_size"))
    running = sizes.select("_range", F.sum("_size").over(before).alias("_before"))
    by_range = F.map_from_entries(F.collect_list(F.struct("_range", "_before")))
    # An empty range has no rows, and so no entry.
    return (
        running.agg(by_range.alias("_map"), F.max("_range").alias("_top"))
        .select(F.transform(F.sequence(F.lit(0), "_top"), lambda i: F.coalesce(F.try_element_at("_map", i), F.lit(0))))
        .scalar()
    )
