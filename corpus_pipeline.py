"""From raw documents to packed training sequences, in five stages over whole tables.

Every stage takes the documents that the one before it kept, and all but the last return
documents with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.common import if_small, kept, read
from tableferry.llm.decontaminate import decontaminate
from tableferry.llm.ngram_join import ngram_join
from tableferry.llm.packing import pack
from tableferry.llm.pii import mask_pii
from tableferry.llm.quality_rules import quality_rules
from tableferry.llm.queries import is_contaminated, trusted_ids, vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the trusted ones are those labelled good."""
    judged = quality_rules(docs, trusted_ids(spark, sf_dir), into="__rules")
    return judged.where("__rules.kept").drop("__rules")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group that similar shingles link.

    Of rows with one id, one stays. Rows without an id are in no group and stay.
    """
    found = kept(ngram_join(docs), "groups")
    spare = found.where("doc_id <> component_id").select("doc_id").distinct()
    stay = docs.join(if_small(spare), "doc_id", "left_anti")
    again = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not again.isEmpty():
        again = if_small(again)
        stay = stay.join(again, "doc_id", "left_anti").unionByName(stay.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return stay.select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    found = decontaminate(docs, read(spark, sf_dir, "benchmark"), into="__overlap")
    return found.where(~is_contaminated("__overlap")).drop("__overlap")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; ``n_chars`` is that of the new text."""
    masked = mask_pii(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their token ids."""
    return pack(docs, *vocabulary())


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Hashed n-gram likelihoods and byte-level tokens have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; the result of each but the last is kept as Parquet."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
