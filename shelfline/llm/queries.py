"""The registered queries of this subpackage, each over its whole table."""

from uuid import uuid4

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, piece_bpe
from .ann import nearest
from .filter_audit import audit_filters
from .html_text import extract_main_text
from .html_text import fit as fit_pages
from .langid import fit, identify_languages
from .mixing import mix_sources, word_count
from .pii import KINDS, find_personal_data
from .pii import fit as fit_field
from .scratch import frozen, shared_folder
from .simhash import simhash_components
from .topk import top_k
from .url_filter import ALLOW, BLOCK, Rule, judge_urls, link_edges
from .warc import archived, page_of
from .whitening import fit as fit_whitening
from .whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    judged = judge_urls(pages.select("page_id", "url"), URL_RULES, link_edges(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def is_held_out() -> Column:
    """Documents that no model is fitted on: crc32 of the id as text leaves remainder 2 by 4. A null id does not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", is_held_out())
    model = fit(docs.filter("not held_out"))
    return identify_languages(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.with_digests(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archived(_table(spark, sf_dir, "pages"), f"{shared_folder(spark)}/warc-{uuid4().hex}")
    return records.select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to")).alias("refers_to")
    )


def _joined(spans: str) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _is_kind(kind: str):
    return lambda span: span["kind"] == kind


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal_data(docs, fit_field(docs))
    counts = {f"n_{kind}": F.size(F.filter("base_spans", _is_kind(kind))).cast("long") for kind in KINDS}
    return found.select(
        "doc_id", *(c.alias(name) for name, c in counts.items()), F.sha2(_joined("base_spans"), 256).alias("base_sha256"), _joined("spans").alias("spans")
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 20 = 0"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return extract_main_text(pages, fit_pages(pages)).select("page_id", "url", "text", "n_chars")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sized = frozen(docs.select("doc_id", "source", word_count(F.col("text")).alias("words")))
    return mix_sources(sized, size="words").select("doc_id", "size", "source_size", "target", "taken", "copies")


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_bpe.with_digests(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    # Beyond 64 bits the contract's column has no value; the operator has 38 digits.
    return whiten(vectors, fit_whitening(vectors)).withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_language_id": op2_language_id,
    "op3_bpe": op3_bpe,
    "op4_warc": op4_warc,
    "op5_ann": op5_ann,
    "op6_pii": op6_pii,
    "op7_simhash": op7_simhash,
    "op8_top_k": op8_top_k,
    "op9_main_text": op9_main_text,
    "op10_mix_sources": op10_mix_sources,
    "op11_piece_bpe": op11_piece_bpe,
    "op12_filter_audit": op12_filter_audit,
    "op13_whitening": op13_whitening,
}
