"""Raw CSV in, Parquet tables in and out.

A table is a folder of versions. A version counts from the moment its ``_SUCCESS`` file is there, which Spark writes
last, so a table is replaced as a whole or, if the job fails, not at all.
"""

import re
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.adhoc import row_count_audit
from ..operators.clean import normalize_columns
from ..operators.star import SPREAD, SPREADS
from .files import delete, exists, folders_in, names_in, touch
from .schemas import CLEAN_TYPES, COLUMN_ORDER, FOLDERS, RAW_COLUMNS, ROW_ORDER


@dataclass(frozen=True)
class Buckets:
    """A layout that joins on ``key`` without moving the table: rows lie in ``number`` files by key and spread.

    Each row has one of ``SPREADS`` numbers by a hash of its columns, so that the rows of a hot key lie in as many
    files; ``operators.star`` repeats the other side, which is far smaller, once for each. ``number`` has to be
    ``spark.sql.shuffle.partitions`` at least, or Spark moves both sides to have as many tasks as that.
    """

    key: str
    number: int


_VERSION = re.compile("[0-9]{10}-[0-9a-f]{32}")
_ROWS = "_rows-"
_BUCKETS = re.compile("_buckets-([0-9]+)-(.+)")


def read_raw(spark: SparkSession, raw_base: str, table: str, quoted_line_ends: bool = False) -> DataFrame:
    """The raw CSV of a source table: a file ``<table>.csv`` or a folder of that name, all columns as strings, names
    normalised. Lines of a wrong length come with what they have: see ``split_raw`` for those.

    Names come from the header line, so only that line is read ahead (type inference would read all the data).
    With the names fixed, every further file has to have the same header. A byte-order mark is skipped. With
    ``quoted_line_ends`` a value in quotes may hold line ends; a file is then read by one task, so it is no default.
    """
    return normalize_columns(_raw(spark, raw_base, table, quoted_line_ends))


def _raw(spark: SparkSession, raw_base: str, table: str, quoted_line_ends: bool, more: str | None = None) -> DataFrame:
    path = f"{raw_base}/{FOLDERS[table]}.csv"
    reader = spark.read.option("header", True).option("multiLine", quoted_line_ends)
    header = reader.csv(path).columns
    fields = [T.StructField(name, T.StringType()) for name in (*header, *([more] if more else []))]
    if more:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", more)
    df = reader.schema(T.StructType(fields)).option("enforceSchema", False).csv(path)
    names = normalize_columns(df).columns
    missing = [name for name in RAW_COLUMNS[FOLDERS[table]] if name not in names]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return df


@dataclass(frozen=True)
class RawTable:
    """The well-formed lines of a raw table, and the others: ``rejected`` has (file, line, reason)."""

    rows: DataFrame
    rejected: DataFrame


#: A value in quotes, in which a quote is doubled or behind a backslash.
_QUOTED = r'"(?:[^"\\]|\\.|"")*+"'


def split_raw(spark: SparkSession, raw_base: str, table: str, quoted_line_ends: bool = False) -> RawTable:
    """The raw table with its malformed lines apart, so that none vanishes or is taken for what it is not.

    A line is rejected if it has fewer or more fields than the header: ``broken`` if that is so because a quote is not
    closed, else ``short`` or ``long``. Every line is in one of the two tables,
    but for empty ones, which CSV readers skip. Each table is a scan of its own.
    """
    df = _raw(spark, raw_base, table, quoted_line_ends, _LINE)
    columns = [name for name in df.columns if name != _LINE]
    outside = F.regexp_replace(_LINE, _QUOTED, "")
    fields = F.regexp_count(outside, F.lit(",")) + 1
    reason = F.when(F.contains(outside, F.lit('"')), "broken").when(fields < len(columns), "short").when(fields > len(columns), "long")
    # Spark refuses to read malformed lines without any other column, which a count would come to; this reads them all.
    read = F.length(F.concat_ws("", *(F.col(f"`{c}`") for c in columns))) >= 0
    rejected = df.filter(F.col(_LINE).isNotNull() & read).select(
        F.col("_metadata.file_path").alias("file"), F.col(_LINE).alias("line"), F.coalesce(reason, F.lit("broken")).alias("reason")
    )
    return RawTable(normalize_columns(df.filter(F.col(_LINE).isNull() & read).drop(_LINE)), rejected)


_LINE = "_line"


def read_clean(spark: SparkSession, clean_base: str, table: str) -> DataFrame:
    """A clean table, whoever wrote it, with the columns and types of ``CLEAN_TYPES``; see ``read_parquet``."""
    df = read_table(spark, clean_base, FOLDERS[table])
    return as_declared(df, CLEAN_TYPES[table], f"{clean_base}/{FOLDERS[table]}")


def read_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The newest complete version of a table that ``write_table`` wrote, its columns in the declared order; else all
    Parquet files of the folder, see ``read_parquet``."""
    path = f"{base}/{table}"
    versions = _complete(spark, path)
    if versions:
        df = _read_version(spark, f"{path}/{versions[-1]}")
    elif _foreign(spark, path):
        df = read_parquet(spark, path)
    else:
        raise FileNotFoundError(f"{path} holds no complete table")
    return df.select(*COLUMN_ORDER[table]) if table in COLUMN_ORDER else df


def read_ordered(spark: SparkSession, base: str, table: str) -> DataFrame:
    """``read_table`` with the rows in the declared order of the table, if it has one; ties by all other columns. A
    query that does not show the order, such as a sum, does not sort."""
    df = read_table(spark, base, table)
    order = ROW_ORDER.get(table, ())
    others = [name for name in df.columns if name not in order]
    return df.orderBy(*(F.col(name).asc_nulls_last() for name in (*order, *others))) if order else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Plain Parquet: a file, a folder of files, also by partition values, or a glob like ``sales/*.parquet``.

    Files may have different columns: the table has those of all files, in the order in which they first come, and
    a file gives NULL for the ones it lacks. A column of different types in two files is refused when the table is
    read for its schema, which a job finds out from the footers of all files.
    """
    return spark.read.option("mergeSchema", True).parquet(path)


def as_declared(df: DataFrame, types: dict[str, str], where: str) -> DataFrame:
    """``df`` with the declared columns, in their order; others are left out, but for the spread of a bucketed table.

    A column of another type is taken if that is one which other writers give for the same values: whole numbers of
    any size for int (one that has no room there fails the query), real and whole numbers for double, a timestamp
    for its date, and nothing but NULL for anything. Missing columns and all other types are refused by name.
    """
    found = {name.lower(): (name, kind) for name, kind in df.dtypes}
    missing = [name for name in types if name not in found]
    if missing:
        raise ValueError(f"{where} lacks the columns {missing}")
    others = {n: found[n][1] for n, kind in types.items() if found[n][1] not in (kind, "void") and found[n][1].split("(")[0] not in _TAKEN_FOR.get(kind, ())}
    if others:
        raise ValueError(f"{where} has columns of other types than declared: {others}")
    columns = [_cast(F.col(f"`{found[n][0]}`"), found[n][1], kind).alias(n) for n, kind in types.items()]
    return df.select(*columns, *([SPREAD] if SPREAD in df.columns else []))


#: Types that other writers give to columns of a type.
_TAKEN_FOR = {
    "int": ("tinyint", "smallint", "bigint"),
    "double": ("float", "decimal", "tinyint", "smallint", "int", "bigint"),
    "date": ("timestamp", "timestamp_ntz"),
}


def _cast(col: Column, found: str, kind: str) -> Column:
    if found != "bigint" or kind != "int":
        return col if found == kind else col.cast(kind)
    small = col.try_cast("int")
    return F.when(col.isNotNull() & small.isNull(), F.raise_error(F.concat(F.lit("no room in an int for "), col.cast("string")))).otherwise(small)


def _read_version(spark: SparkSession, version: str) -> DataFrame:
    """A version that has buckets is read as a table of the session's catalog, which alone knows of buckets."""
    df = spark.read.parquet(version)
    found = next(filter(None, map(_BUCKETS.fullmatch, names_in(spark, version))), None)
    if found is None:
        return df
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    name = _catalog_name(version)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{found[2]}`, {SPREAD}) INTO {found[1]} BUCKETS LOCATION '{version}'")
    return spark.table(name)


def _catalog_name(version: str) -> str:
    return f"shelfline_{version.rsplit('-', 1)[-1]}"


def _complete(spark: SparkSession, path: str) -> list[str]:
    return [name for name in folders_in(spark, path) if _VERSION.fullmatch(name) and exists(spark, f"{path}/{name}/_SUCCESS")]


def _foreign(spark: SparkSession, path: str) -> list[str]:
    """What lies in a table's folder and is no version. Names that begin by an underscore or a dot are not looked at."""
    return [name for name in names_in(spark, path) if name[0] not in "_." and not _VERSION.fullmatch(name)]


def recorded_rows(spark: SparkSession, base: str, table: str) -> int | None:
    """The number of rows that was counted when the newest version was written; None if it was not written here.

    The count lies in the folder of the version, as the name of an empty file, so it cannot be of another version.
    """
    versions = _complete(spark, f"{base}/{table}")
    names = names_in(spark, f"{base}/{table}/{versions[-1]}") if versions else []
    return next((int(name.removeprefix(_ROWS)) for name in names if name.startswith(_ROWS)), None)


def row_counts(spark: SparkSession, base: str, tables: Sequence[str]) -> DataFrame:
    """(table_name, n) of stored tables: from the record of the write, without reading a row, where there is one, and
    counted for tables that others wrote."""
    recorded = {table: recorded_rows(spark, base, table) for table in tables}
    known = spark.createDataFrame([(t, n) for t, n in recorded.items() if n is not None], "table_name string, n long")
    others = {table: read_table(spark, base, table) for table, n in recorded.items() if n is None}
    return known.unionByName(row_count_audit(others)) if others else known


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), buckets: Buckets | None = None, sort_by: Sequence[str] = ()) -> int:
    """Replace the Parquet table at ``path`` and return the number of rows written, counted during the write.

    The table that was there stays readable until the new one is complete, and one version longer for queries that
    run at that moment; older versions and the rests of failed writes go. One write at a time may run on a table.
    With ``partition_by``, rows of a value are brought together, so that there are few files; a value that holds
    much of the table is split over several tasks by adaptive execution. A folder that holds anything but versions,
    such as Parquet files of another writer, is refused, so that these are neither mixed nor lost.

    With ``sort_by`` the rows of every file lie in that order, so that the statistics of row groups tell a filter on
    these columns which to leave out.

    With ``buckets`` the table is shuffled once, here, and later joins on the key find it in place; it has the column
    ``_spread`` then.
    """
    spark = df.sparkSession
    foreign = _foreign(spark, path)
    if foreign:
        raise ValueError(f"{path} holds what is no version of a table: {foreign[:5]}")
    before = [name for name in folders_in(spark, path) if _VERSION.fullmatch(name)]
    number = int(before[-1].split("-")[0]) + 1 if before else 1
    written = Observation()
    rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    if sort_by:
        # In front the columns by which Spark sorts rows for their folders, so that it need not do so again.
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    version = f"{path}/{number:010d}-{uuid4().hex}"
    if buckets:
        spread = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.lit(SPREADS)).cast("int")
        # Dealt as buckets are, so that a bucket is one file.
        rows = rows.withColumn(SPREAD, spread).repartition(buckets.number, buckets.key, SPREAD)
        writer = rows.write.partitionBy(*partition_by).bucketBy(buckets.number, buckets.key, SPREAD).sortBy(buckets.key)
        writer.option("path", version).format("parquet").saveAsTable(_catalog_name(version))
        touch(spark, f"{version}/_buckets-{buckets.number}-{buckets.key}")
    else:
        rows.write.partitionBy(*partition_by).parquet(version)
    touch(spark, f"{version}/{_ROWS}{written.get['rows']}")
    for name in set(before) - set(_complete(spark, path)[-2:]):
        spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(name)}")
        delete(spark, f"{path}/{name}")
    return written.get["rows"]
