"""From raw documents to a tokenized training mix: each stage works on all that the one before has kept."""

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import langid, pii
from shelfline.llm.bpe import encode_documents
from shelfline.llm.langid import UNKNOWN, identify_languages
from shelfline.llm.mixing import mix_sources
from shelfline.llm.pii import find_personal_data
from shelfline.llm.queries import is_held_out
from shelfline.llm.scratch import shared_folder
from shelfline.llm.simhash import drop_near_duplicates

#: A document is rejected if no language is likelier than this, or none can be told.
LEAST_SCORE = 0.5
TOKENIZER = "word_bpe_49k.json"


#: The columns that stages work on. Any others are carried along whole, so that no name can clash.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _carried(docs: DataFrame) -> DataFrame:
    others = [F.col(f"`{c}`") for c in docs.columns if c not in COLUMNS]
    return docs.select(*COLUMNS, *([F.struct(*others).alias("_others")] if others else []))


def _as_documents(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(c if c in COLUMNS else F.col("_others")[c].alias(c) for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language that the others teach; their own label is not looked at."""
    model = langid.fit(docs.filter(~is_held_out()))
    marked = identify_languages(_carried(docs), model)
    return _as_documents(marked.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near copies."""
    return _as_documents(drop_near_duplicates(_carried(docs)), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind; n_chars follows the new text."""
    found = find_personal_data(_carried(docs), pii.fit(docs))
    n_chars = F.when(F.size("spans") > 0, F.char_length("masked_text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return _as_documents(found.withColumns({"n_chars": n_chars, "text": F.col("masked_text")}), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and leave out documents so that the sources have their target weights."""
    mixed = mix_sources(_carried(docs))
    return _as_documents(mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))), docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document of the mix, as often as the mix takes it."""
    return encode_documents(_carried(docs), public_tokenizers.path(TOKENIZER), keep=["doc_id", "lang", "source"])


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix),
    ("bpe", tokenize),
]

#: Fitted models and hashes are beyond SQL; the tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; what a stage returns is written, and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
