"""A training corpus in five stages: quality, line dedup, SimHash near-dedup,
mixing, packing. Each stage takes what its predecessor kept.

``run`` writes every stage as Parquet in the shared checkpoint folder and reads it
again for the next one, so a lost executor never costs more than a stage. All
stages but the last return the columns of ``documents``; the last returns the
token pieces in their sequences. Nulls, empty texts, ties and repeated rows have
the results that the operators' docstrings state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipyard.llm.common import table, written
from shipyard.llm.line_dedup import document_key, remove_repeated_chunks
from shipyard.llm.mixing import mix
from shipyard.llm.packing import pack, token_pieces
from shipyard.llm.quality import document_statistics, fit, scored, to_fit
from shipyard.llm.queries import BYTE_BPE, MIX_DEFAULT, MIX_SEED, MIX_WEIGHTS, mix_domain
from shipyard.llm.simhash import SEGMENTS, fingerprints, with_component

#: The mix takes every document at most once, and this share of all tokens.
MIX_SHARE, MIX_EPOCHS = (9, 10), 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls good (score of at least 0.5)."""
    labels = table(spark, sf_dir, "labels")
    stats = written(document_statistics(to_fit(docs.select("doc_id", "text"), labels)), "statistics")
    model = fit(stats, labels)
    return scored(docs, model, name="quality_score").where("quality_score >= 0.5").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without multi-line chunks that an earlier place has; ``n_chars`` follows the text."""
    left = remove_repeated_chunks(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, up to 3 differing bits):
    the one with the smallest id; of rows equal in id and text, one."""
    keyed = docs.select("doc_id", "text", *document_key(F.col("doc_id"), F.col("text")))
    prints = written(fingerprints(keyed, words=3, seed=42, keep=("k1", "k2")), "fingerprints")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("least")
    stays = with_component(prints, 3, SEGMENTS, least).select("least.k1", "least.k2").distinct()
    rows = docs.select(*document_key(F.col("doc_id"), F.col("text")), F.struct(*docs.columns).alias("row"))
    return rows.join(stays, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix of domains, languages and sources."""
    return mix(docs, mix_domain(), F.col("lang"), F.col("source"), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED, MIX_DEFAULT).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, packed into sequences of 1024 tokens."""
    pieces = token_pieces(docs, public_tokenizers.path(BYTE_BPE), capacity=1024, end_id=2)
    digest = written(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    packed = pack(digest, expected_rows=digest.count(), capacity=1024)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can express neither the classifier nor the fingerprints; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
