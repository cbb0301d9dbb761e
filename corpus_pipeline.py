"""A corpus pipeline over `documents`: toxic documents go, near-duplicates go, personal data is masked, sources are mixed, tokens made.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import mixing, pii, similar, toxicity
from trailmark.llm.queries import bpe_digests
from trailmark.llm.shared import materialise, private


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold, learned from the labels of sf_dir.

    Null and empty texts and texts without known words score as such examples do, below the threshold unless toxic labels say
    otherwise; repeated rows go or stay together; all columns stay as they are, whatever their names. Texts are scored whole, and
    an empty table gives an empty result.
    """
    score, evidence = private("score"), private("evidence")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, score_col=score, evidence_col=evidence)
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates (five-word Jaccard similarity 0.8 or more), the one with the smallest id.

    Texts without words are one class, so one of them stays; rows that repeat an id with other texts are in the classes of their
    texts; ties go to the smallest row. A null id comes last. All columns stay as they are.
    """
    return similar.deduplicated(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text, and is null for a null text.

    Null and empty texts stay, repeated rows are masked alike, very long texts take time in proportion, other columns stay.
    """
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Texts without words have size 0 and are taken as their draw says; a null source is a source, a null id draws like the text
    "null"; repeated rows draw alike. All columns stay as they are.
    """
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, a row per document and copy; null texts are empty texts."""
    return bpe_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: Classifiers, fingerprints and merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
