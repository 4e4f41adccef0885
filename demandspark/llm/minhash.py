"""Near duplicates by MinHash: many universal hash minima, banding, verification, connected components.

1. *Signatures.* The distinct n-grams of lower-cased words are hashed by ``BANDS * ROWS`` strongly universal
   functions; the minima are a text's signature. Equal texts are one node, named by 128 bits of their SHA-256.
2. *Bands.* Texts whose minima agree in a whole band are candidates. With 32 bands of 6, a pair at a similarity
   of 0.85 shares no band with a probability of 3 in 10 million, a more similar pair is missed far more rarely.
3. *Stars.* In each band bucket every text is compared with one text, the hub: that with most company in all its buckets,
   which is the least edited one of a group of copies. A group so costs as many pairs as it has texts. A pair goes on if the signatures' estimate is not hopeless (``SLACK`` standard
   deviations below the threshold) and links if the full sets reach the threshold.
4. *Components* of these links by alternating large-star and small-star.
5. *The rest.* Texts that share a bucket but are still in different components meet directly, in classes of
   set size, unless their sizes exclude a link, or the numbers of their n-grams that occur in any other such text do
   (a heavily edited copy has too few of these to link with anything). Then the components are taken again.

Sets are compared by 64-bit hashes of their n-grams. Null text, empty text and text without words: an empty set,
linked with nothing, ``component_id`` is the row's own id. Repeated rows and equal texts share a component.
A null id takes part like any other and gets the smallest id of its component (null if there is none; it is
kept then). An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import blocks, components, hash_windows, hash_words, release, split_words

BANDS, ROWS = 32, 6
SLACK = 6               # standard deviations of the estimate that a verified pair may lie below the threshold
SEED = 11
_SLICE = 1 << 16        # n-grams hashed at a time, so that they stay in a core's cache


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct ``size``-word shingles; a shorter text is one shingle."""
    words = split_words(text.lower()) if text else []
    return np.unique(hash_windows(hash_words(words), min(size, len(words)))) if words else np.empty(0, np.uint64)


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiplier and summand of each function x -> (a x + b) >> 32 over 32-bit x and 64-bit a, b."""
    draw = np.random.default_rng(SEED)
    a, b = draw.integers(0, 1 << 64, (2, count), np.uint64)
    return a | np.uint64(1), b


def minima(sets: list[np.ndarray], count: int) -> np.ndarray:
    """[set, function]: least hash of each set (none is empty) under ``count`` functions."""
    a, b = _functions(count)
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    flat = np.concatenate([np.empty(0, np.uint64), *sets])
    flat = (flat ^ (flat >> np.uint64(32))) & np.uint64(0xFFFFFFFF)
    least = np.full((count, len(sets)), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(flat), _SLICE):
        piece = flat[start:start + _SLICE]
        first, last = np.searchsorted(ends, [start, start + len(piece) - 1], "right")
        at = np.maximum(ends[first:last + 1] - sizes[first:last + 1] - start, 0)
        hashed = np.empty_like(piece)
        for k in range(count):
            np.multiply(piece, a[k], out=hashed)
            hashed += b[k]
            held = least[k, first:last + 1]
            np.minimum(held, np.minimum.reduceat(hashed, at), out=held)
    return (least.T >> np.uint64(32)).astype(np.uint32)


def _sign(batches: Iterator[pa.RecordBatch], size: int, count: int) -> Iterator[pa.RecordBatch]:
    """Per row: id, text class, set size; with the first row of a class in its block the signature."""
    for batch in blocks(batches):
        names, texts = batch["node"].to_pylist(), batch["text"]
        first = {}
        for row, name in enumerate(names):
            first.setdefault(name, row)
        sets = {name: shingles(texts[row].as_py(), size) for name, row in first.items()}
        full = [name for name, s in sets.items() if len(s)]
        signed = dict(zip(full, (s.tobytes() for s in minima([sets[name] for name in full], count)), strict=True))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["node"], pa.array([len(sets[name]) for name in names], pa.int64()),
             pa.array([signed.get(name) if first[name] == row else None for row, name in enumerate(names)], pa.binary())],
            ["doc_id", "class", "n", "signature"])
        del sets, signed
    release()


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The sets of texts; a text that comes to a task again is left out."""
    seen: set[int] = set()
    for batch in blocks(batches):
        rows = {}
        for row, node in enumerate(batch["node"].to_pylist()):
            if node not in seen:
                rows[node] = row
        seen.update(rows)
        sets = [shingles(batch["text"][row].as_py(), size).view(np.int64) for row in rows.values()]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        grams = pa.LargeListArray.from_arrays(offsets, np.concatenate([np.empty(0, np.int64), *sets])).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), grams], ["node", "grams"])
    release()


def _promising(batches: Iterator[pa.RecordBatch], count: int, least: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in at least the share ``least`` of their minima."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint32).reshape(-1, count) for c in ("signature_a", "signature_b"))
        near = pa.array((a == b).sum(axis=1) >= least * count)
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(near)


class _Corpus:
    """Stored tables of one run: rows, distinct texts, members of shared buckets and their sets."""

    def __init__(self, docs: DataFrame, size: int, threshold: int, bands: int, rows: int):
        self.size, self.threshold, self.bands, self.rows = size, threshold, bands, rows
        count = bands * rows
        signed = docs.select("doc_id", F.col("text").cast("binary").alias("text"), "node").mapInArrow(
            partial(_sign, size=size, count=count), "doc_id long, class binary, n long, signature binary")
        self.signed = materialize(signed, "minhash-rows")
        texts = (self.signed.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("first_id"), F.max("n").alias("n"), F.max("signature").alias("signature"))
                 .withColumn("node", F.monotonically_increasing_id()))
        self.texts = materialize(texts, "minhash-texts")
        postings = self.texts.select("node", "n", F.explode(self._all_bands()).alias("band"))
        # Each aggregate is stored before it is joined, so that hot buckets can be split in the join.
        buckets = materialize(postings.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "minhash-buckets")
        shared = materialize(postings.join(buckets, "band"), "minhash-shared")
        company = materialize(shared.groupBy("node").agg(F.sum("size").alias("company")), "minhash-company")
        best = F.max(F.struct("company", "node")).getField("node")
        hubs = materialize(shared.join(company, "node").groupBy("band").agg(best.alias("hub")), "minhash-hubs")
        self.members = materialize(shared.join(hubs, "band").select("band", "node", "n", "hub"), "minhash-members")
        near = self.texts.join(self.members.select("node").distinct(), "node", "left_semi").select("node", "class", "first_id")
        found = docs.join(near, (docs["node"] == near["class"]) & docs["doc_id"].eqNullSafe(near["first_id"]))
        self.sets = materialize(found.select(near["node"], F.col("text").cast("binary").alias("text"))
                                .mapInArrow(partial(_sets, size=size), "node long, grams array<long>"), "minhash-sets")

    def _band(self, k: int) -> Column:
        width = 4 * self.rows
        return F.xxhash64(F.lit(k), F.substring("signature", k * width + 1, width))

    def _all_bands(self) -> Column:
        return F.array(*[self._band(k) for k in range(self.bands)])

    def sizes_allow(self, a: str, b: str) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.threshold

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The ``pairs`` (a, b) whose full sets reach the threshold; each set moves once, hot hubs are split by AQE."""
        share, count = self.threshold / 100, self.bands * self.rows
        least = max(0.0, share - SLACK * (share * (1 - share) / count) ** 0.5)
        side = lambda x: self.texts.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("signature").alias(f"signature_{x}"))
        near = (pairs.join(side("b"), "b").join(side("a"), "a").where(self.sizes_allow("n_a", "n_b"))
                .select("a", "b", "signature_a", "signature_b").mapInArrow(partial(_promising, count=count, least=least), "a long, b long"))
        near = materialize(near, "minhash-promising")
        grams = lambda x: self.sets.select(F.col("node").alias(x), F.col("grams").alias(f"grams_{x}"))
        both = near.join(grams("b"), "b").join(grams("a"), "a")
        both = both.select("a", "b", F.size("grams_a").alias("n_a"), F.size("grams_b").alias("n_b"),
                           F.size(F.array_intersect("grams_a", "grams_b")).alias("common"))
        return both.where(F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * self.threshold).select("a", "b").distinct()

    def _common(self, nodes: DataFrame) -> DataFrame:
        """(node, n, s) of the ``nodes`` that may still link: ``s`` of their n-grams occur in another of them, enough for the threshold."""
        grams = self.sets.join(nodes, "node", "left_semi").select("node", F.size("grams").cast("long").alias("n"), F.explode("grams").alias("gram"))
        several = materialize(grams.groupBy("gram").agg(F.count("*").alias("texts")).where("texts > 1").select("gram"), "minhash-grams")
        counted = grams.join(several, "gram").groupBy("node").agg(F.first("n").alias("n"), F.count("*").alias("s"))
        return materialize(counted.where(F.col("s") * 100 >= F.col("n") * self.threshold), "minhash-common")

    def rest(self, labels: DataFrame) -> DataFrame:
        """Pairs that share a bucket, are in different components and may link by their sizes and numbers of common n-grams."""
        placed = self.members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))

        def still_open(rows: DataFrame) -> DataFrame:
            bands = rows.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("band")
            return materialize(rows.join(materialize(bands, "minhash-bands"), "band", "left_semi"), "minhash-open")
        placed = still_open(placed)
        common = self._common(placed.select("node").distinct())
        common = self._common(common.select("node"))  # once more without the texts that left
        placed = still_open(placed.drop("n").join(common, "node").join(self.texts.select("node", self._all_bands().alias("bands")), "node"))
        width = 1.0001 * float(np.log(100 / min(self.threshold, 99)))  # a hair more than the largest ratio of linked sizes
        placed = placed.withColumn("kind", F.floor(F.ln("n") / width).cast("int"))
        other = placed.withColumn("kind", F.explode(F.array(F.col("kind") - 1, F.col("kind"), F.col("kind") + 1)))
        need = F.ceil((F.col("p.n") + F.col("q.n")) * self.threshold / (100.0 + self.threshold) - 1e-9)
        met = (placed.alias("p").join(other.alias("q"), (F.col("p.band") == F.col("q.band")) & (F.col("p.kind") == F.col("q.kind"))
                                      & (F.col("p.node") < F.col("q.node")) & (F.col("p.component") != F.col("q.component"))
                                      & (F.col("p.node") != F.col("p.hub")) & (F.col("q.node") != F.col("p.hub"))
                                      & (F.least("p.s", "q.s") >= need) & self.sizes_allow("p.n", "q.n")
                                      & (F.get(F.array_intersect("p.bands", "q.bands"), F.lit(0)) == F.col("p.band"))))  # each pair in its first bucket
        return met.select(F.col("p.node").alias("a"), F.col("q.node").alias("b"))

    def labels(self) -> DataFrame:
        """(node, component) of the texts that link with another one."""
        stars = self.members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
        links = materialize(self.linked(stars), "minhash-links")
        found = materialize(components(links), "minhash-labels")
        more = materialize(self.linked(self.rest(found)), "minhash-more")
        return found if more.isEmpty() else materialize(components(links.union(more)), "minhash-labels")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: int = 80, bands: int = BANDS, rows: int = ROWS,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles`` (set size), ``component_id`` (smallest id reachable over links) and ``kept``."""
    text = F.col(text_column)
    name = F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))
    corpus = _Corpus(docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), name.alias("node")), size, threshold, bands, rows)
    named = corpus.texts.select("class", "first_id", "node").join(corpus.labels(), "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = materialize(named.select("class", "first_id", "component"), "minhash-named")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_class = named.join(least, "component").select("class", "component_id")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (corpus.signed.select("doc_id", "class", "n").join(by_class, "class", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept")))
