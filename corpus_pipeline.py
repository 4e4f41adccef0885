"""From raw documents to packed training sequences.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again before the next stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm import bytenet, jaccard, mixing, packing, substrings
from demandspark.llm.common import table
from demandspark.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
LEAST_QUALITY = 0.5


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network scores at ``LEAST_QUALITY`` or more; it never sees the held-out labels.

    Null and empty texts are scored like texts without bytes, equal texts alike, whatever their ids; an empty table stays empty.
    """
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = bytenet.quality_model(documents, labels, bytenet.remainder(4) != 2)
    return bytenet.score(docs, model).where(F.col("score") >= LEAST_QUALITY).select("rest.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates; how nulls, ties and repeated rows are settled says
    ``jaccard.one_per_component``."""
    return jaccard.one_per_component(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages that occur elsewhere, too; ``n_chars`` follows the text. Every row stays, if need be
    with an empty text; a null text stays null."""
    left = substrings.remove_repeats(docs, keep_text=True)
    changed = {"text": F.col("kept_text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("rest.n_chars"))}
    return left.select(*[changed.get(c, F.col(f"rest.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that each source holds its share of the mixture, in mixed order. Sources without text leave; rows
    without an id draw each on their own."""
    return mixing.mix(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences, in mixed order; a null or empty text is its end id."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good), ("near duplicates", drop_near_duplicates), ("substring dedup", drop_repeats),
    ("mixing", mix_sources), ("packing", pack)]

# A trained network and its threshold cannot be written in SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
