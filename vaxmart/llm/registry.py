"""The queries that apply the operators to their whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaxmart.llm import (
    chunk_dedup,
    ctph,
    decontaminate,
    html_extract,
    language_id,
    license_scan,
    lm_score,
    near_dup,
    sentencepiece,
    suffix_dedup,
    token_alignment,
    url_filter,
    whitening,
)
from vaxmart.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs.select("doc_id", "text"), language_id.train(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


@register
def op2_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


ORACLE["op2_decontaminate"] = decontaminate.ORACLE


@register
def op3_near_duplicates(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op3_near_duplicates"] = near_dup.ORACLE


@register
def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup_report(table(spark, sf_dir, "documents"))


@register
def op5_sentencepiece(spark, sf_dir):
    return sentencepiece.encode(table(spark, sf_dir, "documents")).drop("token_ids")


@register
def op6_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.RULES).drop("n_tried")


ORACLE["op6_url_filter"] = url_filter.ORACLE


@register
def op7_license_scan(spark, sf_dir):
    """Documents as files: the source is the top directory, the language one below."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return license_scan.scan(docs.select("doc_id", path.alias("path"), "text"))


@register
def op8_lm_score(spark, sf_dir):
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


@register
def op9_chunk_dedup(spark, sf_dir):
    return chunk_dedup.dedup_chunks(table(spark, sf_dir, "documents"))


@register
def op10_fingerprints(spark, sf_dir):
    return ctph.fingerprints(table(spark, sf_dir, "documents"))


@register
def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register
def op12_token_alignment(spark, sf_dir):
    return token_alignment.align_documents(table(spark, sf_dir, "documents"))


@register
def op13_html_extraction(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))
