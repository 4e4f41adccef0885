"""SpotSigs fingerprints: chains of content words behind common words.

Common words (``ANCHORS``) mark spots. Each spot's signature hashes the anchor with the next ``CHAIN`` content words; so does
the start of the text, and in stretches of more than ``GAP`` content words without an anchor every further word, so tables
and lists have spots, too. A fingerprint is the set of a text's signatures; two are as alike as their Jaccard similarity.

For neighbours in the order of ids, documents are dealt into ranges of ids of about ``RANGE_BYTES`` of text each. The first
document of a range also goes to the range before it (that of the first range to the last one), so each range can be
worked through on its own, one document at a time.

Near duplicates are found among distinct fingerprints: the Jaccard similarity is only computed for pairs that share one of
their rarest signatures (the stars and residual comparisons of the n-gram join), and not for sets more than the threshold
apart in length. Nothing is partitioned by set length.

Null text counts as empty; a text without words has an empty fingerprint, equal to other empty ones (likeness 1) and
unlike all others (0). Rows with one id are ordered by a hash of their text; rows without an id come last. A single row is
followed by itself. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import blocks
from .jaccard import _find_links, _shared_only

# Common words of English, German, French and Spanish.
ANCHORS = frozenset(w.encode() for w in (
    "the of and to in a is that for it with as was on are be at by this from or an have not "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    "le la les de des du et en un une que qui dans pour par sur au avec ne pas il est "
    "el los las de del y en un una que se por con para su al lo como más no").split())
CHAIN, GAP = 2, 8
RANGE_BYTES = 32 << 20
_MARKS = b".,;:!?\"'()[]|%&$#*"
_LAST = np.iinfo(np.int64).max


class _Words(dict):
    """Hashes of words without marks around them; the lowest bit is set for anchors."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        bare = word.strip(_MARKS) or word
        value = self[word] = xxhash.xxh3_64_intdigest(bare) & ~1 | (bare in ANCHORS)
        return value


_WORDS = _Words()


def signatures(text: str) -> np.ndarray:
    """Sorted distinct 32-bit signatures."""
    words = text.lower().encode().split()
    if not words:
        return np.empty(0, np.uint32)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    anchor = (hashes & np.uint64(1)).astype(bool)
    content = hashes[~anchor]
    if len(content) < CHAIN:
        return np.array([xxhash.xxh32_intdigest(hashes.tobytes())], np.uint32)
    place = np.arange(len(hashes))
    since = place - np.maximum.accumulate(np.where(anchor, place, -1))
    spot = anchor | (since > GAP)
    follows = np.cumsum(~anchor) - ~anchor  # content words before each word
    at = np.concatenate([[0], follows[spot]])
    mark = np.concatenate([[np.uint64(0)], np.where(anchor, hashes, np.uint64(2))[spot]])
    whole = at + CHAIN <= len(content)
    at, mixed = at[whole], mark[whole].copy()
    for step in range(CHAIN):
        mixed = (mixed ^ content[at + step]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.astype(np.uint32))


def as_string(found: np.ndarray) -> str:
    return f"{len(found)}:" + found.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity; lengths that exclude any overlap are not compared."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    count = len(text) // 4
    return text[:len(text) - count] + following[:count]


def _deal(batches: Iterator[pa.RecordBatch], bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their range; first rows of a range once more, as ``guest`` of the range before."""
    for batch in batches:
        key = batch["key"].to_numpy(zero_copy_only=False)
        part = np.searchsorted(bounds, key, side="right") - 1
        guests = np.flatnonzero(bounds[part] == key)
        rows = np.concatenate([np.arange(len(key)), guests])
        home = np.concatenate([part, (part[guests] - 1) % len(bounds)]).astype(np.int32)
        guest = np.arange(len(rows)) >= len(key)
        taken = batch.take(pa.array(rows))
        yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(guest), *taken.columns], ["range", "guest", *batch.schema.names])


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _RESULT.split(", ")]
    held, over, kinds = None, False, [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    for batch in blocks(batches, limit=4 << 20):
        out = []
        for guest, doc, data in zip(batch["guest"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if over:
                break
            over = guest  # the first guest follows the last row of the range
            text = data.decode() if data else ""
            own = signatures(text)
            if held:
                before, was, theirs = held
                changed = edited(was, text)
                new = signatures(changed)
                out.append((before, len(was), hashlib.sha256(changed.encode()).hexdigest(), as_string(theirs), as_string(new), likeness(theirs, new), likeness(theirs, own)))
            held = (doc, text, own)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: fingerprints of its text and of its edited text, and how alike they and the next document's are."""
    rows = docs.select(F.coalesce("doc_id", F.lit(_LAST)).cast("long").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-total // RANGE_BYTES))
    placed = rows.select("key").repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("first"))
    bounds = np.unique(np.array([r["first"] for r in placed.collect()], np.int64))  # a number for each range
    if not len(bounds):
        return docs.sparkSession.createDataFrame([], _RESULT)
    dealt = rows.mapInArrow(partial(_deal, bounds=bounds), "range int, guest boolean, key long, doc_id long, text binary")
    ordered = dealt.repartitionById(len(bounds), F.col("range")).sortWithinPartitions("guest", "key", F.xxhash64("text"))
    return ordered.mapInArrow(_compare, _RESULT)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        found = [signatures(t.decode() if t else "") for t in batch["text"].to_pylist()]
        node = [xxhash.xxh3_64_intdigest(f.tobytes()) - (1 << 63) for f in found]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(node, pa.int64()), pa.array([f.astype(np.int64) for f in found], pa.list_(pa.int64()))],
                                         ["doc_id", "node", "grams"])


def near_duplicates(docs: DataFrame, threshold: int = 80) -> DataFrame:
    """doc_id and ``component_id``: the smallest id reachable over fingerprints at least ``threshold`` percent alike."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    sets = materialize(rows.mapInArrow(_sets, "doc_id long, node long, grams array<long>"), "spot-sets")
    distinct = sets.where(F.size("grams") > 0).select("node", F.size("grams").cast("long").alias("n"), "grams").dropDuplicates(["node"])
    flat = distinct.select("node", "n", F.explode("grams").alias("gram"))
    labels = _find_links(_shared_only(flat, threshold), threshold)
    named = sets.select("doc_id", "node", F.size("grams").alias("n")).join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (named.join(least, "component", "left")
            .select("doc_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
