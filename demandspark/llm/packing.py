"""Packing token streams into sequences by dynamic programming over cut points.

Documents are taken in the order in which they arrive and keep it; their ids form one stream per task. The stream is
cut into windows of at most ``size`` tokens. Cut points are document ends (free), sentence ends (``sentence_penalty``)
and, where neither occurs for ``stride`` tokens, places within a sentence (``inner_penalty``). A window costs its padding:
``size`` minus its length, or nothing if the length is a power of two. The cheapest chain of cuts satisfies

    best(j) = penalty(j) + min( min over i in reach of best(i) + at(i), plus size - at(j);  best(i) where at(j) - at(i) is a power of two )

The inner minimum slides with j, so a monotone queue gives it in constant time. The stream is handled in blocks: the
windows of a block up to its cheapest open end are final, the rest goes on to the next block, so memory stays bounded.

Null and empty text: the document is its end id alone. Repeated rows are packed once each. A null doc_id is kept.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import blocks

END = 1              # id behind each document
BLOCK_BYTES = 4 << 20


# Fixed value: how byte-level vocabularies cut text before merging.
_CUTS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_UNUSUAL = re.compile("[^\\t\\n\\r\\x20-\\x7e\u00c0-\u024f]")  # other characters may be classed differently by another library
_LONG_RUN = re.compile(r"\S{4096}|\s{4096}")
_LONG = 1 << 16
# Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
_BYTES = {chr(b): b for b in _SHOWN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def _plain_merges(stated: dict) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Ids by token, and by special token, of a byte-level vocabulary whose ids ascend in the order of its merges; else None."""
    model, cut, special = stated["model"], stated["pre_tokenizer"] or {}, {t["content"]: t["id"] for t in stated["added_tokens"]}
    plain = (model.get("type") == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
             and not stated["normalizer"] and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
             and not any(t[k] for t in stated["added_tokens"] for k in ("single_word", "lstrip", "rstrip")))
    if not plain:
        return None
    vocabulary = {t: k for t, k in model["vocab"].items() if t not in special}
    made = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    if made != sorted(set(made)) or len(made) + 256 != len(vocabulary) or any(c not in _BYTES for t in vocabulary for c in t):
        return None
    return {bytes(_BYTES[c] for c in t): k for t, k in vocabulary.items()}, special


class Encoder:
    """Ids of a text by the vocabulary file. Texts of usual characters take a quicker library where the vocabulary allows it; ids are the same."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        merges = _plain_merges(json.loads(self.tokenizer.to_str()))
        self.quick = merges and tiktoken.Encoding("byte-level", pat_str=_CUTS, mergeable_ranks=merges[0], special_tokens=merges[1])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith((".", "!", "?", "Ċ"))

    def ids(self, text: str) -> np.ndarray:
        if not self.quick or _UNUSUAL.search(text) or len(text) > _LONG and _LONG_RUN.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self.quick.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4", copy=False)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def best_cuts(at: np.ndarray, penalty: list[int], size: int, last: bool) -> list[int]:
    """Positions at which windows end. ``at`` ascends from 0 in steps of at most ``size``; with ``last`` the end is one of them."""
    number = np.full(int(at[-1]) + 1, -1)
    number[at] = np.arange(len(at))
    exact = np.stack([np.where(at >= 1 << k, number[np.maximum(at - (1 << k), 0)], -1) for k in range(size.bit_length()) if 1 << k <= size], axis=1)
    rows, columns = np.nonzero(exact >= 0)  # cut points a power of two before each cut point
    partners, first = exact[rows, columns].tolist(), np.searchsorted(rows, np.arange(len(at) + 1)).tolist()
    at = at.tolist()
    best, back = [0] * len(at), [0] * len(at)
    queue: deque[tuple[int, int]] = deque([(at[0], 0)])  # (best + at, index), ascending in both
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0][1]] < here - size:
            queue.popleft()
        value, i = queue[0]
        cost = value + size - here
        for k in partners[first[j]:first[j + 1]]:
            if best[k] < cost:
                cost, i = best[k], k
        best[j], back[j] = cost + penalty[j], i
        key = best[j] + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    j = len(at) - 1
    if not last:  # the cheapest end from which the rest still fits into a window
        j = min((k for k in range(len(at) - 1, -1, -1) if at[k] >= at[-1] - size), key=lambda k: (best[k], -at[k]))
    cuts = []
    while j:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


def cut_points(ids: np.ndarray, document_ends: np.ndarray, sentence_end: np.ndarray, size: int, stride: int,
               sentence_penalty: int, inner_penalty: int) -> tuple[np.ndarray, list[int]]:
    """Ascending cut points of a stream, 0 first, and what it costs to end a window there."""
    sentences = np.flatnonzero(sentence_end[np.minimum(ids, len(sentence_end) - 1)]) + 1
    at = np.union1d(np.concatenate([[0], sentences]), document_ends)
    gaps = np.diff(at)
    wide = np.flatnonzero(gaps > stride)
    if len(wide):
        inner = [np.arange(at[k] + stride, at[k + 1], stride) for k in wide]
        at = np.union1d(at, np.concatenate(inner))
    cost = np.full(len(at), inner_penalty)
    cost[np.searchsorted(at, sentences)] = sentence_penalty
    cost[np.searchsorted(at, document_ends)] = 0
    return at, cost.tolist()


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [part.split()[0] for part in _PIECES.split(", ")]


def _pack(batches: Iterator[pa.RecordBatch], path: str | None, name: str, size: int, stride: int, sentence_penalty: int, inner_penalty: int):
    coder = encoder(path or public_tokenizers.path(name))
    sequence = TaskContext.get().partitionId() << 33
    held: list[tuple] = []  # (doc_id, ids of the document before these, all ids of the document, ids)

    def windows(chunks: list[tuple], last: bool) -> Iterator[pa.RecordBatch]:
        """The pieces of the final windows of ``chunks``, if any; what is left goes to ``held``."""
        nonlocal sequence, held
        stream = np.concatenate([c[3] for c in chunks])
        ends = np.cumsum([len(c[3]) for c in chunks])
        at, penalty = cut_points(stream, ends, coder.ends, size, stride, sentence_penalty, inner_penalty)
        cuts = np.array([0, *best_cuts(at, penalty, size, last)])
        if len(cuts) == 1:  # all of it fits into a window that is still open
            held = chunks
            return
        starts = np.concatenate([[0], ends[:-1]])
        edges = np.union1d(cuts, starts)
        edges = edges[edges < cuts[-1]]
        of, window = np.searchsorted(ends, edges, side="right"), np.searchsorted(cuts, edges, side="right") - 1
        stops = np.append(edges[1:], cuts[-1])
        bytes_ = stream.astype("<u4").tobytes()
        crc = [zlib.crc32(bytes_[4 * a:4 * b]) for a, b in zip(edges.tolist(), stops.tolist(), strict=True)]
        before = np.array([c[1] for c in chunks])
        columns = [pa.array([chunks[k][0] for k in of.tolist()], pa.int64()), pa.array(before[of] + edges - starts[of]),
                   pa.array(stops - edges), pa.array(crc, pa.int64()), pa.array(np.array([c[2] for c in chunks])[of]),
                   pa.array(sequence + window), pa.array(edges - cuts[window])]
        sequence += len(cuts) - 1
        rest = int(np.searchsorted(ends, cuts[-1], side="right"))
        held = [(d, n + max(0, int(cuts[-1] - starts[rest + k])), total, ids[max(0, int(cuts[-1] - starts[rest + k])):])
                for k, (d, n, total, ids) in enumerate(chunks[rest:])]
        yield pa.RecordBatch.from_arrays([c.cast(pa.int64()) for c in columns], _NAMES)

    for batch in blocks(batches, limit=BLOCK_BYTES):
        chunks = list(held)
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            ids = np.append(coder.ids(text.decode()) if text else np.empty(0, "<u4"), np.uint32(END))
            chunks.append((doc, 0, len(ids), ids))
        yield from windows(chunks, False)
    if held:
        yield from windows(held, True)


def pack(docs: DataFrame, size: int = 2048, tokenizer: str = "byte_bpe_50k.json", tokenizer_path: str | None = None, stride: int = 128,
         sentence_penalty: int = 2, inner_penalty: int = 8) -> DataFrame:
    """Pieces of documents in sequences. ``tokenizer`` names a public vocabulary file; ``tokenizer_path`` is a file of one's own."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(partial(_pack, path=tokenizer_path, name=tokenizer, size=size, stride=stride, sentence_penalty=sentence_penalty,
                                   inner_penalty=inner_penalty), _PIECES)
