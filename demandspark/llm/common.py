"""What several corpus operators share: tables, words, row classes and connected components."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import suppress
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

# Fixed value: the characters that separate words (space, tab, line feed, vertical tab, form feed, return).
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of ``spark``, once a session; they then need no copy of their own."""
    context = spark.sparkContext
    if getattr(context, "_demandspark_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="demandspark-code-")) / "demandspark-code.zip"  # read by the driver's own file server only
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._demandspark_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class WordHashes(dict):
    """64-bit hashes of words. Lives as long as its Python worker and starts anew when it is full."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def split_words(text: bytes) -> list[bytes]:
    """Words of UTF-8 text; ``bytes.split`` cuts at exactly the six characters of ``WORD``."""
    return text.split()


_FACTOR, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


def hash_windows(words: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each window of ``size`` consecutive words (at least that many words)."""
    count = len(words) - size + 1
    mixed = words[:count].copy()
    for step in range(1, size):
        mixed *= _FACTOR
        mixed += words[step:step + count]
        mixed ^= mixed >> _SHIFT
    return mixed


def fragment_of(hashes: np.ndarray, fragments: int) -> np.ndarray:
    """The fragment (equal range of the order of 64-bit hashes) of each hash."""
    part = (hashes >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
    return part.astype(np.uint16 if fragments < 65536 else np.int32)


def release() -> None:
    """Give freed memory back to the system, so that a worker that waits for its next task holds little."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)


BLOCK_BYTES = 4 << 20


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` (binary) holds about ``limit`` bytes in each; a row is never cut."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
        del batch
        release()


def text_class(text: str = "text"):
    """The class of equal texts a row belongs to (64 bits); null for a null text."""
    return F.when(F.col(text).isNotNull(), F.xxhash64(text))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, component), the smallest node naming it.

    Alternates the large-star and the small-star step until the edges no longer change. Each step
    is an aggregate and a join, so a node with very many neighbours is combined before the shuffle;
    each round is written to the shared folder. Nodes without an edge to another node are not listed.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "edges")
    before = _fingerprint(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = materialize(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                            .distinct(), "edges")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()
