"""The registered queries of the training-data operators: thin digests of what each operator returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .bpe import bpe_digests
from .clustering import cluster_report, oracle as clustering_oracle
from .common import shared_path, table
from .digest import document_fingerprints
from .embedding_dedup import ORACLE as EMBEDDING_ORACLE, near_duplicate_vectors
from .hard_negatives import ORACLE as HARD_NEGATIVES_ORACLE, hard_negatives
from .packing import pack
from .preference import ORACLE as PREFERENCE_ORACLE, preference_format, reply_pairs
from .quality_classifier import fit_classifier, held_out, quality_scores
from .quality_rules import fit_rules, quality_rules
from .sharding import oracle as shard_oracle, shard_sizes, shards
from .simhash import near_duplicates
from .substring_dedup import substring_dedup
from .warc import read_archives, write_archives


def bpe_path() -> str:
    """The vocabulary file that the registered queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    """Register ``fn(spark, sf_dir)`` under its own name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_substring_dedup(spark, sf_dir):
    """Words left of every document once passages of 13 words seen in a smaller doc_id are removed."""
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op2_simhash_near_dedup(spark, sf_dir):
    """SimHash fingerprint of every document and the smallest doc_id of its near-duplicate component."""
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_bpe(spark, sf_dir):
    """Every document encoded and decoded; digests of the ids and of the decoded text."""
    return bpe_digests(table(spark, sf_dir, "documents"), bpe_path())


@query
def op4_preference_format(spark, sf_dir):
    """Preference pairs from conversations: shared prompt, two completions and their masks."""
    out = preference_format(*reply_pairs(table(spark, sf_dir, "conversations")))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    trained = lambda c: F.aggregate(c + "_mask", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"]).alias(f"{c}_trained")
    return out.select(F.col("pair_id").alias("conv_id"), "n_prompt_turns", digest("prompt"), digest("chosen"), digest("rejected"),
                      trained("chosen"), trained("rejected"))


ORACLES["op4_preference_format"] = PREFERENCE_ORACLE


@query
def op6_quality_classifier(spark, sf_dir):
    """Quality score of every document by nearest labelled neighbours in a latent space."""
    docs = table(spark, sf_dir, "documents")
    model = fit_classifier(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    out = quality_scores(docs, model, keep=("doc_id",))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op8_sharding(spark, sf_dir):
    """The extendible-hashing shard of every document, with its shard's rows and bytes."""
    placed = shards(table(spark, sf_dir, "documents"))
    return placed.join(shard_sizes(placed), "shard").select("doc_id", "shard", "depth", "bytes", "shard_rows", "shard_bytes")


ORACLES["op8_sharding"] = shard_oracle()


@query
def op9_quality_rules(spark, sf_dir):
    """Rule statistics and the isolation forest's verdict on every document."""
    docs = table(spark, sf_dir, "documents")
    out = quality_rules(docs, fit_rules(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


@query
def op5_warc(spark, sf_dir):
    """Every page written to Zstandard WARC archives and read back from them."""
    path = shared_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_document_fingerprints(spark, sf_dir):
    """Improbable-feature digest of every document and of its edited text, with likenesses."""
    return document_fingerprints(table(spark, sf_dir, "documents"))


@query
def op10_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    out = pack(table(spark, sf_dir, "documents"), bpe_path(), window=2048)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op11_hard_negatives(spark, sf_dir):
    """Five hard negatives for each of the five positives of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(moved, F.col("vec_id") % 100 == 0, positives=5, negatives=5, low_pct=80, high_pct=100, scale=256)


ORACLES["op11_hard_negatives"] = HARD_NEGATIVES_ORACLE


@query
def op12_embedding_near_dedup(spark, sf_dir):
    """Links, component and survivor of every vector among near-duplicates of its label."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


ORACLES["op12_embedding_near_dedup"] = EMBEDDING_ORACLE


@query
def op13_centroid_clustering(spark, sf_dir):
    """Cluster, distance and inertia of every vector after three rounds of 16 centroids."""
    return cluster_report(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dim=64, scale=64, seed=1)


ORACLES["op13_centroid_clustering"] = clustering_oracle()
