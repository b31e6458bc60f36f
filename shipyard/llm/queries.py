"""The registered queries of the operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipyard.llm import oracles
from shipyard.llm.common import table, written
from shipyard.llm.embedding_dedup import near_duplicates as near_duplicate_vectors
from shipyard.llm.ffd_packing import pack_first_fit
from shipyard.llm.line_dedup import remove_repeated_chunks
from shipyard.llm.mixing import mix
from shipyard.llm.packing import pack, token_pieces
from shipyard.llm.prefix_trie import prefix_trie, turn_sequences
from shipyard.llm.quality import quality_scores
from shipyard.llm.resampling import resample
from shipyard.llm.secrets_scan import KINDS, scan, spans_text
from shipyard.llm.simhash import near_duplicates
from shipyard.llm.substring_dedup import remove_repeats
from shipyard.llm.token_counts import token_counts
from shipyard.llm.topk import top_k

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

#: The mix that op4 draws: whole-number weights of siblings; others weigh 10.
MIX_WEIGHTS = {
    "domain": {"d0": 40, "d1": 30, "d2": 20, "d3": 10},
    "language": {"en": 50, "de": 20, "fr": 20, "es": 10},
    "source": {"src0": 30},
}
MIX_SHARE, MIX_EPOCHS, MIX_SEED, MIX_DEFAULT = (4, 5), 2, 17, 10


def mix_domain() -> F.Column:
    """The tables have no domain: sources are dealt to four by their number."""
    number = F.regexp_extract("source", "([0-9]+)$", 1)
    return F.when(number != "", F.concat(F.lit("d"), (number.try_cast("bigint") % 4).cast("string")))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens, one row per piece."""
    docs = table(spark, sf_dir, "documents")
    pieces = token_pieces(docs, public_tokenizers.path(BYTE_BPE), capacity=1024, end_id=2)
    digest = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    digest = written(digest, "pieces")
    packed = pack(digest, expected_rows=digest.count(), capacity=1024)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.95."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), limit=0.95)


def embedding_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links among all ``embeddings`` and, of each, a copy with one component turned
    about its sign and one whose first half is scaled, so that there are links."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("own_id"), "embedding", (F.col("vec_id") % F.size("embedding")).alias("at"))
    turned = F.transform("embedding", lambda x, i: F.when(i == F.col("at"), -x).otherwise(x).cast("float"))
    scaled = F.transform("embedding", lambda x, i: F.when(i * 2 < F.size("embedding"), x * F.lit(2.0)).otherwise(x).cast("float"))
    copies = [rows.select((F.col("own_id") * 3 + k).alias("vec_id"), v.alias("embedding")) for k, v in enumerate((F.col("embedding"), turned, scaled))]
    return near_duplicate_vectors(copies[0].unionByName(copies[1]).unionByName(copies[2]), limit=0.95)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of 13 words that an earlier one has."""
    found = remove_repeats(table(spark, sf_dir, "documents"), width=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix, once for each epoch that takes them."""
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs, mix_domain(), F.col("lang"), F.col("source"), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED, MIX_DEFAULT)
    return mixed.select("doc_id", "epoch", "domain", "lang", "source", "n_tokens")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SimHash component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"), words=3, distance=3, seed=42)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without multi-line chunks that an earlier place has."""
    left = remove_repeated_chunks(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_chunks", "n_removed_chunks", F.length("text").cast("long").alias("kept_chars"), F.md5("text").alias("kept_md5"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; sources are the owners, sources by language their repositories."""
    found = scan(table(spark, sf_dir, "documents"), F.col("source"), F.concat_ws("/", "source", "lang"))
    base = F.filter("spans", lambda x: x["base"])

    def count(field: str, value: str) -> F.Column:
        return F.size(F.filter("spans", lambda x: x[field] == value)).cast("long")

    return found.select(
        "doc_id",
        *[count("kind", k.name).alias(f"n_{k.name}") for k in KINDS if k.base],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        count("verdict", "live").alias("n_live"),
        count("verdict", "example").alias("n_example"),
    )


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector over all others."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20, scale=64.0)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), limit=512)


def rebuilt_conversations(conversations: DataFrame, most: int = 5) -> DataFrame:
    """Every conversation c behind the first h turns of conversation c - c % 100, in
    place of its own first h; h is crc32(c) % (``most`` + 1)."""
    own = turn_sequences(conversations)
    base = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_first"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    given = F.coalesce("_first", F.slice("turns", 1, 0))
    keyed = own.withColumn("_base", F.col("conv_id") - F.col("conv_id") % 100).join(base, "_base", "left")
    return keyed.select("conv_id", F.concat(F.slice(given, 1, h), F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie(rebuilt_conversations(table(spark, sf_dir, "conversations")))


def op12_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens, one row per piece."""
    packed = pack_first_fit(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), capacity=2048, end_id=1)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tenth of the documents that is drawn towards the benchmark's words."""
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), share=(10, 100), buckets=10_000, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "embedding_near_copies": embedding_near_copies,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_mixing": op4_mixing,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_secret_scan": op8_secret_scan,
    "op9_exact_topk": op9_exact_topk,
    "op10_token_counts": op10_token_counts,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_first_fit_packing": op12_first_fit_packing,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLES: dict[str, str] = {
    "op2_embedding_near_dedup": oracles.embedding_dedup(),
    "embedding_near_copies": oracles.embedding_copies(),
    "op3_substring_dedup": oracles.substring_dedup(),
    "op4_mixing": oracles.mixing(MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED, MIX_DEFAULT),
    "op6_line_dedup": oracles.line_dedup(),
    "op8_secret_scan": oracles.secret_scan(),
    "op9_exact_topk": oracles.exact_topk(),
    "op11_prefix_trie": oracles.prefix_trie(),
    "op13_importance_resampling": oracles.resampling(),
}
