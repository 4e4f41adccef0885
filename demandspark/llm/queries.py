"""One query per corpus operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from corpus_pipeline import run
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytenet, dsir, jaccard, minhash, mixing, outliers, packing, spots, structure, substrings, toxicity, urlrules, warc
from .common import ship, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @wraps(fn)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = shipped
    return shipped


@query
def op1_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by the conditional random field; every third label (by crc32) is held out."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), bytenet.remainder(3) == 1)


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the words of 35-word windows that occur anywhere else."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select("rest.doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op3_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of each document; robust distances per language and source."""
    return outliers.quality_verdicts(table(spark, sf_dir, "documents"))


@query
def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on each page's url."""
    return urlrules.url_verdicts(table(spark, sf_dir, "pages"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op6_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies of the mixture in mixed order; sources weigh the square root of their bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "source", "mix_copies", "mix_copy", "mix_key", F.sha2("text", 256).alias("text_sha256"))


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of each document; links at a Jaccard similarity of 0.8 on five-word shingles."""
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


@query
def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike neighbours are."""
    return spots.fingerprints(table(spark, sf_dir, "documents"))


@query
def op9_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back: payload size and digest, and what revisits what."""
    return warc.archived_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op10_quality_bytenet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by the byte-level network; every fourth label (by crc32) is held out."""
    return bytenet.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), bytenet.remainder(4) == 2)


@query
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and verdict of each document; links at a Jaccard similarity of 0.85 on five-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), threshold=85)


@query
def op12_dsir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight, score and rank of each document; the quarter most like the benchmark texts is drawn."""
    return dsir.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of each damaged conversation, its cheapest repair and the repair's digest."""
    return structure.damaged_and_repaired(table(spark, sf_dir, "conversations"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over ``documents``."""
    return run(spark, sf_dir)
