"""A corpus pipeline: toxicity, near-duplicates, secrets, mixing and encoding, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stresslake.llm import mixing, near_copies, pieces, secrets, simhash, toxicity
from stresslake.llm.common import materialize, prepare, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold stay."""
    prepare(spark)
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates stays.

    Near-duplicates agree in 0.8 or more of their five-word shingles (exact Jaccard),
    not op3_simhash's three bits.
    """
    prepare(spark)
    return simhash.keep_one(docs, near_copies.with_set_hash, near_copies.jaccard_links)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; every secret span in them is masked."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, once per turn."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each whole text beside the columns of the document."""
    prepare(spark)
    return pieces.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]
# Learned scores and fingerprints have no SQL form; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
