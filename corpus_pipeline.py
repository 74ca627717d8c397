"""The corpus pipeline: quality rules, quality classifier, near duplicates, repeated passages,
packing. Each stage gets what the one before kept; all but the last return documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import classifier, near_dedup, packing, quality_rules, substring_dedup
from panelcast.llm.record_queries import WORD_TOKENIZER, tokenizer_file
from panelcast.llm.storage import small_batches, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed base rules and the limits of their language and source."""
    return quality_rules.quality_rules(docs, keep=COLUMNS).where("kept").select(*COLUMNS)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of good quality. The model is fitted on labelled ones of them. A score depends on the
    text only: digests of the texts that fall are stored, so that the texts meet Python in small batches and are not
    written once more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    with small_batches(spark):
        model = classifier.fit(docs, labels)
    digest = F.md5(F.coalesce("text", F.lit(""))).alias("_md5")
    scored = classifier.score(docs.select("text", digest), model)
    fallen = stored(scored.where("NOT predicted <=> 1").select("_md5").distinct(), "fallen")
    return docs.select(*COLUMNS, digest).join(fallen, "_md5", "left_anti").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text of the least doc_id of each component of near copies (of several such, of the least
    digest); one without doc_id only where no other has any. Texts without words repeat nothing
    and stay. Of rows equal in doc_id and text, one; different texts of one or no doc_id are
    different documents."""
    found = near_dedup.near_duplicates(docs)
    wordless = F.col("component").isNull()
    group = ["component", F.when(wordless, F.col("doc_id")).alias("a"), F.when(wordless, F.col("digest")).alias("b")]
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    first = found.groupBy(*group).agg(F.min(order).alias("m"))
    wanted = first.select(F.col("m.doc_id").alias("_id"), F.col("m.digest").alias("_digest"))
    rows = docs.select(*COLUMNS, F.md5(F.coalesce("text", F.lit(""))).alias("_md5"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_md5") == F.col("_digest"))
    return rows.join(wanted, same, "left_semi").dropDuplicates(["doc_id", "_md5"]).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that repeat an earlier document. Texts that lose none stay as
    they are; others are their kept words with single spaces."""
    cut = substring_dedup.dedup_substrings(docs.select(*COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    return packing.pack(docs, tokenizer_file(WORD_TOKENIZER))


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classify),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", pack),
]
#: The classifier, the samples and the tokenizer are beyond SQL; tests use plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
