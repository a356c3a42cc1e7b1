"""The corpus pipeline: quality, near duplicates, personal data, source mix, tokens.

Every stage takes all that its predecessor kept; each result is written as Parquet
and read again as the next stage's ``docs``.  All stages but the last return the
columns of ``documents``.

Cases, beyond those of the operators: an empty table runs through to an empty result;
extra columns of ``documents`` stay up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import catalog, chosen_path, fm_quality, mixing, pii_bootstrap
from tidemark.llm.tables import keep, read

ACCEPT = 0.3  # least quality score of a document that stays


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts."""
    model = fm_quality.fit(docs, fm_quality.training_rows(read(spark, sf_dir, "labels")))
    return fm_quality.with_scores(docs, model, out="_score").where(F.col("_score") >= ACCEPT).drop("_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of documents linked by a Jaccard similarity of 0.8 or more."""
    return chosen_path.one_of_each(docs, keep(chosen_path.jaccard_join(docs, similarity=0.8, n=5), "classes"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind, and their new lengths."""
    return pii_bootstrap.masked(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of domains, languages and sources; a document comes once per epoch that takes it."""
    rows = keep(catalog.mix_rows(docs), "mix_rows")
    plan = mixing.plan(rows, catalog.MIX_LEVELS, catalog.MIX_SHARE, catalog.MIX_EPOCHS, catalog.MIX_SEED)
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", *catalog.tree_columns())
    return mixing.mix(whole, plan, catalog.MIX_LEVELS, catalog.MIX_SEED).select("_doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of each row."""
    return catalog.bpe_digests(docs, catalog.vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("mixing", source_mix),
    ("bpe", tokens),
]

ORACLE_SQL = None  # a trained classifier and a randomised join: tests compare with a brute-force pipeline


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
