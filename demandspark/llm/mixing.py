"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

A source's rate is the mean number of times a document of it has to be repeated so that the source holds its share of the
mixture: weight * budget / size, sizes in bytes of text. Each document draws its number of copies from a Poisson
distribution with that mean, by inversion of a uniform number hashed from the seed and its id: no state, the same draw on
every attempt. Copies are exploded and placed by a hash of seed, id and copy number, which shuffles the mixture globally:
the hash chooses the partition and orders the rows within it.

Without ``weights`` a source's weight is its size to the power ``temperature`` (1: as it is, 0: all equal). A source
that ``weights`` doesn't name has weight 0 and leaves the mixture.

Null source: a source of its own. Null text: no bytes. A source without bytes has rate 0. Rows without an id are numbered
in the order of their content and draw by their number, so each draws on its own. Repeated rows with an id: the same draw
each. An empty table gives an empty result. All columns of ``docs`` are kept under
their names; ``mix_copies``, ``mix_copy`` and ``mix_key`` are added and replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.indexing import with_row_index
from ..session import materialize


def rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, temperature: float = 0.5, budget: float | None = None) -> DataFrame:
    """One row per source: ``source``, its ``size`` in bytes, and the mean number of copies ``rate``."""
    sizes = materialize(docs.groupBy("source").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("double")).alias("size")), "source-sizes")
    if weights is None:
        weighted = sizes.withColumn("weight", F.when(F.col("size") > 0, F.pow("size", F.lit(float(temperature)))).otherwise(0.0))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "named string, weight double")
        weighted = (sizes.join(given, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
                    .withColumn("weight", F.when(F.col("size") > 0, F.coalesce("weight", F.lit(0.0))).otherwise(0.0)))
    total = weighted.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    amount = F.col("all_size") if budget is None else F.lit(float(budget))
    rate = F.when((F.col("size") > 0) & (F.col("all_weight") > 0), F.col("weight") / F.col("all_weight") * amount / F.col("size")).otherwise(0.0)
    return weighted.join(F.broadcast(total)).select("source", "size", rate.alias("rate"))  # one row of totals


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed and parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / 2.0 ** 52


def poisson(u: Column, rate: Column) -> Column:
    """The number of k with P(X <= k) <= u, X being Poisson with mean ``rate``; terms are summed from their logarithms."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")

    def add(state: Column, k: Column) -> Column:
        log_term = F.when(k == 0, -rate).otherwise(state["log_term"] + F.log(rate) - F.log(k.cast("double")))
        reached = state["reached"] + F.exp(log_term)
        return F.struct(log_term.alias("log_term"), reached.alias("reached"), (state["n"] + (reached <= u).cast("int")).alias("n"))

    start = F.struct(F.lit(0.0).alias("log_term"), F.lit(0.0).alias("reached"), F.lit(0).alias("n"))
    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(0), last), start, add, lambda s: s["n"])).otherwise(0)


def _named(rows: DataFrame) -> DataFrame:
    """(row, name): the id as text; rows without one are numbered in the order of their content, equal rows in any order."""
    own = F.col("row.doc_id").cast("string")
    nameless = rows.where(own.isNull())
    named = rows.withColumn("name", own)
    if nameless.isEmpty():
        return named
    content = nameless.select("row", F.xxhash64("row.text").alias("_text"), F.md5(F.to_json("row")).alias("_all"), F.monotonically_increasing_id().alias("_row"))
    numbered = with_row_index(content, ["_text", "_all", "_row"], "_number")
    return named.where(own.isNotNull()).union(numbered.select("row", F.concat(F.lit("~"), F.col("_number").cast("string"))))


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, temperature: float = 0.5, budget: float | None = None,
        seed: int = 17) -> DataFrame:
    """Copies of documents in mixed order: all columns, ``mix_copies``, ``mix_copy`` (from 1) and ``mix_key``."""
    own = [c for c in docs.columns if c not in ("mix_copies", "mix_copy", "mix_key")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    by_source = materialize(rates(docs, weights, temperature, budget), "mixing-rates").select(F.col("source").alias("of"), "rate")
    drawn = (_named(rows).join(by_source, F.col("row.source").eqNullSafe(F.col("of")))
             .select("row", "name", poisson(uniform(seed, F.col("name")), F.col("rate")).alias("mix_copies")))
    copies = drawn.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), "mix_copies")))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), F.col("name"), F.col("mix_copy").cast("string")))
    placed = copies.withColumn("mix_key", key).repartition("mix_key").sortWithinPartitions("mix_key")
    return placed.select("row.*", "mix_copies", "mix_copy", "mix_key")
