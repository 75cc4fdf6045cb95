"""The registered queries of this subpackage: one per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (ann, codes, crosstoken, decontaminate, innerproduct, langid, mixing, secrets, sharding, simhash, tokens,
                         toxicity, warc)
from tessera.llm.common import table

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels are learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn_lexicon(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, lexicon)


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document that holds a benchmark item within 20 % word edits, with the item and the place."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard (0 to 23, sizes near equal) and slot of every document."""
    return sharding.shard_report(table(spark, sf_dir, "documents"), shards=24)


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint (3-word shingles) and group (3 bits) of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, found once per distinct text and joined back to all documents."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


ORACLE_SQL["op5_secrets"] = secrets.ORACLE


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact tokens of every document, and what of it fits in 2048 tokens."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), "word_bpe_49k.json", limit=2048)


@query
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every 20th vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), k=20)


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn_centroids(docs))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to the archive and read back."""
    return warc.archive_report(table(spark, sf_dir, "pages"))


ORACLE_SQL["op10_warc"] = warc.ORACLE.strip()


@query
def op11_crosstoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, links and corpus-wide link counts of every document under two tokenizers."""
    return crosstoken.align_documents(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", "piece_bpe_32k.model")


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector: 16 parts, 64 entries each, two rounds."""
    return codes.code_report(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


ORACLE_SQL["op12_vector_codes"] = codes.ORACLE


@query
def op13_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest inner products of every 50th vector, exactly."""
    return innerproduct.top_products(table(spark, sf_dir, "embeddings"), k=5)


ORACLE_SQL["op13_top_products"] = innerproduct.ORACLE.strip()
