"""The corpus pipeline: quality rules, quality classifier, SimHash near-dedup, substring dedup, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on every document that its
predecessor kept, and returns a table with the columns of ``documents``; the last
returns the packed pieces.  Null texts count as empty, extra columns don't pass the
first stage, repeated rows are one near-duplicate group, and empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.common import table, written
from parley.llm.packing import pack
from parley.llm.quality_classifier import fit_classifier, held_out, quality_scores
from parley.llm.quality_rules import fit_rules, quality_rules
from parley.llm.queries import bpe_path
from parley.llm.simhash import one_of_each
from parley.llm.substring_dedup import substring_dedup
from parley.session import ensure_checkpoint_dir, ship_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and no isolation forest finds strange."""
    forests = fit_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules(docs, forests, keep=COLUMNS).where("kept").select(*COLUMNS)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their nearest labelled neighbours call good; the neighbours are of the whole input."""
    model = fit_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return quality_scores(docs, model, keep=COLUMNS).where("predicted = 1").select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest doc_id."""
    return one_of_each(docs, shingle=3, max_bits=3).select(*COLUMNS)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words that an earlier one has; the other texts stay as they are."""
    out = substring_dedup(docs, window=13, keep=("doc_id", "lang", "source"), tidy=False)
    return out.withColumnRenamed("kept", "text").withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in sequences of at most 2048."""
    out = pack(docs, bpe_path(), window=2048)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("substring dedup", substring_dedup_stage),
    ("packing", packing_stage),
]
#: Fitted models, fingerprints and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's result is written as Parquet and read by the next."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
