"""A training corpus from ``documents``: quality rules, near-duplicate removal, secret redaction, mixing, packing.

Each stage takes all rows of the one before and returns the columns of documents (packing: pieces and bins); extra columns go, whatever their
names. Rows with null and with repeated doc_ids are documents of their own in every stage. Null and empty texts fail the base rules of quality;
a stage that gets them all the same keeps them as they are, but mixing, which has no share for cells without tokens. Rows repeated in full are
copies: near-duplicate removal leaves one. Of like texts the smallest doc_id stays, null last, then the first row. Texts are taken whole at any
length. An empty table goes through all stages and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake.llm import common, mixing, neardup, packing, quality, secrets

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the model keep."""
    return quality.kept(docs.select(*COLUMNS), quality.fit(docs, common.table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of like texts, the one with the smallest doc_id (null last); texts without words all stay."""
    return neardup.deduplicated(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    text = secrets.redacted(F.col("text"), F.col("secrets.spans"))
    return secrets.scan(docs.select(*COLUMNS)).withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn at their cells' calibrated probabilities."""
    return mixing.sample(docs.select(*COLUMNS)).where("mix.kept").select(*COLUMNS)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces and their bins."""
    return packing.pack(packing.with_clusters(docs))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("secret scans", redact_secrets), ("mixing", mix_sources), ("packing", pack_bins)]

#: The learned verdicts and the similarity classes can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; each stage is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        docs = common.staged(made, *([docs] if k else [])) if k < len(STAGES) - 1 else made
    return docs
