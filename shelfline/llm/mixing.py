"""Mix sources to target weights by weighted fair queueing over shuffled documents."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import frozen, small_or_shuffled

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 11
#: Rows of a source that are put in order together. The mix is the same for any number.
ROWS_PER_RANGE = 2_000


def word_count(text: Column) -> Column:
    """Number of words of the text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(_source, _sid, _source_size, _rows, _target) from rows of (_source, _size).

    The sources share a mix as large as all of them together. In the order of their code points, null last,
    they take the weights in turn. A target stops at ``max_epochs`` times its source; the excess goes to the
    others by weight until none is above, so the level is sought at which the capped shares fill the total.
    A source without words has target 0. The windows run over one row per source, however many documents.
    """
    sizes = rows.groupBy("_source").agg(F.sum("_size").alias("_source_size"), F.count("*").alias("_rows"))
    by_name = W.orderBy(F.col("_source").asc_nulls_last())
    by_level = W.orderBy("_level", "_sid").rowsBetween(W.unboundedPreceding, 0)
    all_of_them = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = (
        sizes.withColumn("_sid", F.row_number().over(by_name))
        .withColumn("_weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_sid") - 1) % len(weights) + 1))
        .withColumn("_cap", F.col("_source_size") * float(max_epochs))
        .withColumn("_level", F.col("_cap") / F.col("_weight"))
        .withColumns(
            {
                "_total": F.sum("_source_size").over(all_of_them),
                "_free": F.sum("_weight").over(all_of_them) - F.sum("_weight").over(by_level),
                "_filled": F.sum("_cap").over(by_level),
            }
        )
        # With the level at this source's cap, everything up to it is full. If that gives no more than the
        # total, the level sought is here or higher.
        .withColumn("_capped", F.col("_filled") + F.col("_level") * F.col("_free") <= F.col("_total"))
        .withColumns(
            {
                "_rest": F.col("_total") - F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_cap"))).over(all_of_them), F.lit(0.0)),
                "_share": F.sum(F.when(~F.col("_capped"), F.col("_weight"))).over(all_of_them),
            }
        )
    )
    target = F.when(F.col("_capped"), F.col("_cap")).otherwise(F.col("_rest") * F.col("_weight") / F.col("_share"))
    return levels.select("_source", "_sid", "_source_size", "_rows", target.alias("_target"))


#: What rows that may stand for each other have alike.
_ALIKE = ("_sid", "_mark", "_size")


def _placed(rows: DataFrame, targets: DataFrame) -> DataFrame:
    return rows.join(targets, rows["_source"].eqNullSafe(targets["_source"])).drop("_source")


def _slotted(counted: DataFrame, targets: DataFrame) -> DataFrame:
    """Counted rows with the columns of their source and _slot, a range of the shuffle hash."""
    slots = F.ceil(F.col("_rows") / ROWS_PER_RANGE)
    # The upper 53 bits of the hash as a fraction of 1, exact in a double.
    fraction = (F.shiftright("_mark", 11) + (1 << 52)).cast("double") / float(1 << 53)
    return _placed(counted, targets).withColumn("_slot", F.floor(fraction * slots))


def _queued(slotted: DataFrame, fronts: DataFrame) -> DataFrame:
    """Counted rows with _start, the words queued in front of the first of them."""
    in_front = W.partitionBy("_sid", "_slot").orderBy("_mark", "_size").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("_size") * F.col("_n")).over(in_front), F.lit(0))
    return slotted.join(fronts, ["_sid", "_slot"]).withColumn("_start", F.col("_front") + before)


def _one_by_one(queued: DataFrame) -> DataFrame:
    """A row with _end, the words queued up to it, for each of the counted ones; many alike are dealt to many tasks."""
    last = F.col("_n") - 1
    blocks = queued.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(ROWS_PER_RANGE).cast("long"))))
    # With a number of its own: by their size, these few rows would be brought together again.
    tasks = int(queued.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.filter(F.col("_n") > ROWS_PER_RANGE).repartition(tasks, "_mark", "_block")
    rows = blocks.filter(F.col("_n") <= ROWS_PER_RANGE).unionByName(dealt)
    of_block = F.sequence(F.col("_block"), F.least(F.col("_block") + (ROWS_PER_RANGE - 1), last))
    return rows.withColumn("_nth", F.explode(of_block)).withColumn("_end", _end())


def _end() -> Column:
    return F.col("_start") + (F.col("_nth") + 1) * F.col("_size")


def _numbered(rows: DataFrame, queued: DataFrame) -> DataFrame:
    """``rows`` with _start and _nth, their number among those alike from 0 on, in the order of _tie.

    Few that are alike are numbered by a window. Groups of more than ``ROWS_PER_RANGE`` are sorted by range over all
    tasks, and numbered by the counts of the ranges before, so none is a window's or a task's.
    """
    groups = queued.select(*_ALIKE, "_start", "_n")
    nth = (F.row_number().over(W.partitionBy(*_ALIKE).orderBy("_tie")) - 1).cast("long")
    large = groups.filter(F.col("_n") > ROWS_PER_RANGE)
    if large.isEmpty():
        return rows.join(groups, list(_ALIKE)).withColumn("_nth", nth)
    large = small_or_shuffled(large)
    small = rows.join(large.select(*_ALIKE), list(_ALIKE), "left_anti").join(groups, list(_ALIKE)).withColumn("_nth", nth)
    # The last column tells rows apart that are alike in all others.
    order = [*_ALIKE, "_tie", "_row"]
    many = rows.join(large, list(_ALIKE)).withColumn("_row", F.monotonically_increasing_id())
    many = frozen(many.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()))
    of_range = F.shiftright("_place", 33)
    ranges = many.groupBy(*_ALIKE, of_range.alias("_range")).agg(F.count("*").alias("_in_range"), F.min("_place").alias("_first"))
    in_front = W.partitionBy(*_ALIKE).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_in_range").over(in_front), F.lit(0))).drop("_in_range")
    many = many.withColumn("_range", of_range).join(small_or_shuffled(ranges), [*_ALIKE, "_range"])
    many = many.withColumn("_nth", F.col("_before") + F.col("_place") - F.col("_first"))
    return small.unionByName(many.select(*small.columns))


def _copies(max_epochs: int) -> Column:
    """The row's place in the queue of all sources, once per epoch: virtual finish time, then ties."""
    epochs = F.sequence(F.lit(0), F.lit(max_epochs - 1))
    return F.transform(
        epochs,
        lambda e: F.struct(
            ((F.col("_source_size") * e + F.col("_end")) / F.col("_target")).alias("finish"),
            F.col("_sid").alias("sid"),
            e.alias("epoch"),
            F.col("_end").alias("end"),
        ),
    )


def _last_taken(rows: DataFrame, budget: int, max_epochs: int) -> Column:
    """The place of the last copy that still fits the budget when all copies are sorted by their place.

    Copies are sorted by range over all tasks; the words of a range give the running total in front of the
    next one, so no task sees more than its range.
    """
    copies = rows.filter("_size > 0 and _target > 0").select("_size", F.explode(_copies(max_epochs)).alias("_place"))
    ranges = frozen(copies.repartitionByRange("_place").withColumn("_range", F.spark_partition_id()))
    in_front = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = ranges.groupBy("_range").agg(F.sum("_size").alias("_sum"))
    fronts = sums.select("_range", "_sum", F.coalesce(F.sum("_sum").over(in_front), F.lit(0)).alias("_before"))
    # Only the range in which the budget ends has to be sorted.
    edge = fronts.filter((F.col("_before") <= budget) & (F.col("_before") + F.col("_sum") > budget)).hint("broadcast")
    inside = ranges.join(edge, "_range").withColumn(
        "_total", F.col("_before") + F.sum("_size").over(W.partitionBy("_range").orderBy("_place").rowsBetween(W.unboundedPreceding, 0))
    )
    whole = fronts.filter(F.col("_before") + F.col("_sum") <= budget).select("_range").hint("broadcast")
    fit = inside.filter(F.col("_total") <= budget).select("_place").unionByName(ranges.join(whole, "_range").select("_place"))
    found = fit.agg(F.max("_place").alias("p")).first()["p"]
    if found is None:
        return F.lit(None)
    return F.struct(
        F.lit(found["finish"]).alias("finish"), F.lit(found["sid"]).alias("sid"), F.lit(found["epoch"]).alias("epoch"), F.lit(found["end"]).alias("end")
    )


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    size: str | None = None,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken; columns of those names are replaced.

    Each source's documents stand in a queue shuffled by a hash of key and text (``size`` names a column
    that has the words, and then replaces the text in the hash), repeated up to ``max_epochs`` times. A copy
    finishes at the words of its source up to its end, divided by the source's target; copies are taken in
    the order of that virtual time until the next one would exceed the budget, which is the words of all
    documents. ``copies`` is how often the document is taken, ``taken`` the words of that.

    Null and empty texts, and null sizes, have size 0 and are never taken. A null source is a source. Null and
    repeated keys are rows of their own; rows alike in source, key and text (or size) stand next to each other in the
    queue, in the order of a hash of all their columns but maps, so reruns agree. They are queued as one row with a
    count, and get their places from it. An empty table gives no rows. A source with most of the rows is cut into
    ranges of the shuffle hash, each queued by its own task behind the words of the ranges before.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    words = F.coalesce(F.col(size).cast("long"), F.lit(0)).cast("long") if size else word_count(F.col(text))
    mark = F.xxhash64(F.lit(seed), F.col(key), F.col(size or text))
    tie = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()))
    wide = docs.withColumns({"_size": words, "_mark": mark, "_source": F.col(source), "_tie": tie})
    counted = frozen(wide.groupBy("_source", "_mark", "_size").agg(F.count("*").alias("_n")))
    total = F.col("_size") * F.col("_n")
    targets = small_or_shuffled(source_targets(counted.select("_source", total.alias("_size")), weights, max_epochs))
    slotted = _slotted(counted, targets)
    in_front = W.partitionBy("_sid").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    slots = slotted.groupBy("_sid", "_slot").agg(F.sum(total).alias("_sum"))
    fronts = small_or_shuffled(slots.select("_sid", "_slot", F.coalesce(F.sum("_sum").over(in_front), F.lit(0)).alias("_front")))
    queued = _queued(slotted, fronts)
    budget = counted.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0]
    last = _last_taken(_one_by_one(queued), budget, max_epochs)
    taken = F.size(F.filter(_copies(max_epochs), lambda place: place <= last))
    copies = F.when((F.col("_size") > 0) & (F.col("_target") > 0), taken).otherwise(0)
    if budget == 0:
        copies = F.lit(0)
    kept = [name for name in docs.columns if name not in added]
    rows = _numbered(_placed(wide.drop(*added), targets), queued)
    out = rows.withColumn("_end", _end()).withColumn("_copies", copies)
    return out.select(
        *(F.col(f"`{name}`") for name in kept),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_copies").alias("copies"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )
