"""The corpus pipeline: stages applied in order to ``documents``, each written as Parquet and read again.

Every stage keeps the columns of its input, whatever their names; stages know their rows by private names.  Null texts
count as empty; rows without ``doc_id``, and rows that share one, are documents of their own unless they repeat a row's
id and text.  An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaxmart.llm import decontaminate, language_id, near_dup, sentencepiece, suffix_dedup
from vaxmart.llm.common import cut, table, whole


def _position(docs: DataFrame, name: str) -> int | None:
    lower = [c.lower() for c in docs.columns]
    return lower.index(name) if name in lower else None


def _private(docs: DataFrame) -> DataFrame:
    """The columns as ``__c0``, ``__c1`` and so on, so that no name of theirs meets an operator's."""
    return docs.toDF(*[f"__c{i}" for i in range(len(docs.columns))])


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with a sufficient margin; a null or letterless text has none."""
    inner = _private(docs)
    text = f"__c{_position(docs, 'text')}"
    found = language_id.predict(inner.withColumnRenamed(text, "text"), language_id.train(docs))
    return found.where(F.col("accepted")).withColumnRenamed("text", text).select(*inner.columns).toDF(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Rows with the same id and text are one document, of which one row stays.  Rows without an id, and those whose id
    another text has too, are documents of their own that give way to the others of their group (unless an id is so large
    that none can follow it).  A document without words is in no group."""
    inner = _private(docs)
    doc_id, text = (F.col(f"__c{_position(docs, name)}") for name in ("doc_id", "text"))
    keyed = inner.withColumn("__id", doc_id.cast("long")).withColumn("__text", F.xxhash64(whole(text)))
    counts = keyed.where("__id IS NOT NULL").groupBy("__id").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("__id").alias("__repeated"))
    repeated = cut(counts, "repeated-ids")
    again = F.col("__id") == F.col("__repeated")
    single = keyed.where("__id IS NOT NULL").join(repeated, again, "left_anti")
    special = keyed.where("__id IS NULL").unionByName(keyed.where("__id IS NOT NULL").join(repeated, again, "left_semi"))
    special = cut(special.withColumn("__whole", whole(text)).dropDuplicates(["__id", "__text", "__whole"]).drop("__whole"), "special-ids")
    # Their ids follow the largest one, or precede the smallest where there is no room behind it.
    ends = keyed.agg(F.max("__id").alias("high"), F.min("__id").alias("low")).first()
    high, low = ends["high"] or 0, ends["low"] or 0
    number = F.monotonically_increasing_id()
    special = cut(special.withColumn("__id", F.lit(high + 1) + number if high < 1 << 62 else F.lit(low - 1) - number), "special-documents")
    every = single.unionByName(special)
    verdict = near_dup.near_duplicates(every.select(F.col("__id").alias("doc_id"), text.alias("text")))
    gone = verdict.where("NOT kept").select(F.col("doc_id").alias("__gone"))
    left = every.join(gone, F.col("__id") == F.col("__gone"), "left_anti")
    return left.select(*inner.columns).toDF(*docs.columns)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that occur elsewhere too; ``n_chars``, where there is one, follows the text."""
    done = suffix_dedup.dedup_texts(docs)
    text, size = _position(docs, "text"), _position(docs, "n_chars")
    if size is None:
        return done
    inner = _private(done)
    length = F.length(f"__c{text}").cast(docs.schema.fields[size].dataType)
    return inner.withColumn(f"__c{size}", length).toDF(*docs.columns)


def keep_clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text that is left, with the checks of the round trip."""
    return sentencepiece.encode(docs)


STAGES = [
    ("language_id", keep_known_language),
    ("near_dup", keep_one_of_each_group),
    ("suffix_dedup", cut_repeated_strings),
    ("decontaminate", keep_clean_of_benchmark),
    ("sentencepiece", encode_texts),
]
#: Compression, suffix arrays and tokenization have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
