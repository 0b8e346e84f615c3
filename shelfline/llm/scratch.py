"""Intermediate results in the folder that the cluster shares for checkpoints."""

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, from spark.checkpoint.dir. Where that is unset, a cluster, whose executors have no folder
    of this machine, gets one in the warehouse, and a session on this machine alone a new one here."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        local = context.master.startswith("local")
        context.setCheckpointDir(named or (tempfile.mkdtemp(prefix="llm-") if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"))
    return context.getCheckpointDir()


def frozen(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder; its lineage ends there, so a lost executor costs no rerun."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small_or_shuffled(df: DataFrame, most_rows: int = 50_000) -> DataFrame:
    """``df`` written once, with a broadcast hint if it has at most ``most_rows`` rows, else without one."""
    kept = frozen(df)
    return kept.hint("broadcast") if kept.count() <= most_rows else kept
