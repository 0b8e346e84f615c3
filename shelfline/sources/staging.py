"""Intermediate tables, in a folder that all executors share."""

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import delete

#: Session setting that names the folder for staged tables.
STAGING_DIR = "shelfline.staging.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that STAGING_DIR names; without it the checkpoint folder, without that one in the warehouse."""
    return (
        spark.conf.get(STAGING_DIR, None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.checkpoint.dir", None)
        or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"
    )


@contextmanager
def own_staging(spark: SparkSession, base: str) -> Iterator[str]:
    """Tables staged meanwhile go to a new folder in ``base``, which is deleted at the end, also after a failure."""
    before = spark.conf.get(STAGING_DIR, None)
    folder = f"{base}/_staging-{uuid4().hex}"
    spark.conf.set(STAGING_DIR, folder)
    try:
        yield folder
    finally:
        if before is None:
            spark.conf.unset(STAGING_DIR)
        else:
            spark.conf.set(STAGING_DIR, before)
        delete(spark, folder)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table, which later plans read instead of computing it again."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_together(tables: dict[str, DataFrame], label: str) -> dict[str, DataFrame]:
    """``stage`` for several tables in one job, which shuffles only once what their plans have in common. Equally
    named columns must be of the same type."""
    named = [df.withColumn("of_table", F.lit(name)) for name, df in tables.items()]
    rows = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), named)
    path = f"{shared_folder(rows.sparkSession)}/{label}-{uuid4().hex}"
    rows.write.partitionBy("of_table").parquet(path)
    # From the folder of all of them: a table without rows has none of its own.
    written = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return {name: written.filter(F.col("of_table") == name).select(df.columns) for name, df in tables.items()}
