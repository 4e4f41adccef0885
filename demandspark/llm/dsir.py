"""Importance resampling of documents towards the distribution of a target corpus.

1. *Counts.* Hashed n-gram features (runs of one and two words) are counted over all documents and all target
   texts: a task adds up its own array of buckets, Spark sums the arrays.
2. *Weights.* The gains of the buckets (a table of fixed size) go to the tasks as one array; a document's weight
   is the floored mean of the gains of its features. A Gumbel number from a hash of the id is added.
3. *Threshold.* Drawing k of N without replacement means taking the k highest scores. The cutoff is found by
   bisection: exact count jobs over the stored scores narrow the range of values until one is left, then
   the same among the ids of that score (and among rows equal in both).
4. *Ranks.* Only drawn rows are range-partitioned by score; each partition is sorted on its own.

Null and empty text, and text without words: no features, weight 0, never drawn. A null id is hashed as an
empty one and comes after all other ids in ties; of rows equal in score and id those stored first are
taken. Repeated rows are rows of their own. An empty table gives an empty result; with an empty target every
bucket has only its smoothing. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.indexing import with_row_index
from ..session import materialize
from .common import blocks, release

BUCKETS = 10_000
PIECE = 1 << 20         # bytes of one text that are split into words at a time
CUTS = 16               # parts a range of values is cut into by one count job
_LONGEST = 63           # longer words are hashed on their own
_NO_ID = (1 << 63) - 1

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _crc_tables() -> np.ndarray:
    """[n, k, b]: what byte b at place k of a CRC-32 becomes when n more bytes are hashed; the CRC is linear."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> 1) ^ np.where(step & 1, np.uint32(0xEDB88320), np.uint32(0))
    tables = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
    for _ in range(_LONGEST):
        tables.append((tables[-1] >> np.uint32(8)) ^ step[tables[-1] & 255])
    return np.stack(tables)


_TABLES = _crc_tables()
_SPACE = np.uint32(zlib.crc32(b" "))


def _moved(crc: np.ndarray, by: np.ndarray | int) -> np.ndarray:
    """CRC-32 values moved on by as many bytes each."""
    out = _TABLES[by, 0, crc & 255]
    for k in (1, 2, 3):
        out ^= _TABLES[by, k, (crc >> np.uint32(8 * k)) & 255]
    return out


class _Words(dict):
    """CRC-32 of a word below, its length above; starts anew when it is full."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = zlib.crc32(word) | min(len(word), _LONGEST + 1) << 32
        if len(word) <= _LONGEST:
            self[word] = value
        return value


_WORDS = _Words()


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded number at a time."""
    folded, start = text.translate(_FOLD), 0
    while len(folded) - start > PIECE:
        end = folded.rfind(b" ", start, start + PIECE)
        if end <= start:
            end = folded.find(b" ", start + PIECE)
        if end < 0:
            break
        yield folded[start:end].split()
        start = end
    yield folded[start:].split()


def _hashed(words: list[bytes], owner: np.ndarray, fresh: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and bucket of each word that is ``fresh`` and of each run of two words of one owner."""
    packed = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    crc, length = packed.astype(np.uint32), (packed >> np.uint64(32)).astype(np.intp)
    at = np.flatnonzero(owner[1:] == owner[:-1])
    before = _moved(crc[at], 1) ^ _SPACE
    size = length[at + 1]
    pair = _moved(before, np.minimum(size, _LONGEST)) ^ crc[at + 1]
    for k in np.flatnonzero(size > _LONGEST).tolist():
        pair[k] = zlib.crc32(words[at[k] + 1], int(before[k]))
    return np.concatenate([owner[fresh], owner[at]]), np.concatenate([crc[fresh], pair]) % np.uint32(buckets)


def features(texts: list[bytes | None], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, bucket) of each feature and the texts of the words, for a bounded number of words at a time."""
    words, sizes, fresh = [], [], []

    def flush() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner = np.repeat(np.array([s[0] for s in sizes], np.int64), [s[1] for s in sizes])
        new = np.ones(len(words), bool)
        new[fresh] = False
        found = (*_hashed(words, owner, new, buckets), owner[new])
        words.clear(), sizes.clear(), fresh.clear()
        return found
    for row, text in enumerate(texts):
        last = None
        for part in _parts(text) if text else ():
            if not part:
                continue
            if last is not None and not words:  # the run over the cut; the word itself was counted before
                fresh.append(len(words))
                part.insert(0, last)
            last = part[-1]
            words += part
            sizes.append((row, len(part)))
            if len(words) * 6 > PIECE:
                yield flush()
    if words:
        yield flush()


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in blocks(batches):
        for _, bucket, _ in features(batch["text"].to_pylist(), buckets):
            total += np.bincount(bucket, minlength=buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])
    release()


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of the features of column ``text``; a task hands on one row a bucket at most."""
    rows = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(partial(_count, buckets=buckets), "bucket int, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """What a feature of each bucket is worth: 1000 times the log ratio of the smoothed shares, floored."""
    def counts(side: DataFrame) -> list[int]:
        found = dict(bucket_counts(side, buckets).collect())  # at most one row a bucket
        return [found.get(k, 0) for k in range(buckets)]
    s, t = counts(docs), counts(target)
    all_s, all_t = sum(s), sum(t)
    return np.array([math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s, t, strict=True)],
                    np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        rows = batch.num_rows
        total, count, words = (np.zeros(rows, np.int64) for _ in range(3))
        for owner, bucket, of_words in features(batch["text"].to_pylist(), len(gains)):
            total += np.bincount(owner, gains[bucket], rows).astype(np.int64)  # whole numbers far below 2^53
            count += np.bincount(owner, minlength=rows)
            words += np.bincount(of_words, minlength=rows)
        weight = np.where(count > 0, np.floor_divide(total, np.maximum(count, 1)), 0)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(words), pa.array(count), pa.array(weight)],
                                         ["doc_id", "n_words", "n_features", "weight"])


def _gumbel(seed: int) -> Column:
    """1000 times a Gumbel number from a hash of the id, floored."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.ln(-F.ln(u))).cast("long")


def largest_cut(rows: DataFrame, key: Column, wanted: int, cuts: int = CUTS) -> int:
    """The largest value that at least ``wanted`` values of the whole-number ``key`` reach; each job counts ``cuts`` values."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    while low < high:
        steps = min(cuts, high - low)
        tried = [low + (high - low) * k // steps for k in range(1, steps + 1)]
        reached = rows.agg(*[F.count_if(key >= F.lit(value)) for value in tried]).first()
        enough = [value for value, n in zip(tried, reached, strict=True) if n >= wanted]
        short = [value for value, n in zip(tried, reached, strict=True) if n < wanted]
        low, high = max([low, *enough]), min([high + 1, *short]) - 1
    return low


def highest(rows: DataFrame, keys: list[Column], wanted: int) -> Column:
    """A condition that holds for exactly the ``wanted`` rows with the highest ``keys``, the last of which has no ties."""
    chosen, tied = F.lit(False), F.lit(True)
    for key in keys:
        if wanted <= 0:
            break
        cut = largest_cut(rows.where(tied), key, wanted)
        above, equal = rows.where(tied).agg(F.count_if(key > F.lit(cut)), F.count_if(key == F.lit(cut))).first()
        chosen, tied, wanted = chosen | (tied & (key > F.lit(cut))), tied & (key == F.lit(cut)), wanted - above
        if equal == wanted:
            chosen, wanted = chosen | tied, 0
    return chosen


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS,
             id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn).

    Of the documents with ``least_words`` words or more ``percent`` in a hundred are drawn, highest scores first.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    gains = bucket_gains(docs, target.select("text"), buckets)
    weighed = docs.mapInArrow(partial(_weigh, gains=gains), "doc_id long, n_words long, n_features long, weight long")
    scores = materialize(weighed.withColumn("score", F.col("weight") + _gumbel(seed)).withColumn("place", F.monotonically_increasing_id()), "dsir-scores")
    able = scores.where(F.col("n_words") >= least_words)
    wanted = able.count() * percent // 100
    keys = [F.col("score"), F.bitwise_not(F.coalesce("doc_id", F.lit(_NO_ID))), F.bitwise_not("place")]
    drawn = (F.col("n_words") >= least_words) & highest(able, keys, wanted)
    ranked = with_row_index(scores.where(drawn), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("place")], "rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, "rank").union(scores.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))
