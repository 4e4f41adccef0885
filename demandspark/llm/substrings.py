"""Repeated passages by relative Lempel-Ziv parsing against an index of the whole corpus.

A window is ``window`` consecutive words of one document; it repeats when its word sequence also starts
at another place, in any document or the same one. Every word covered by a repeating window goes.

The reference is the corpus itself, cut into blocks by hash of the place at which a window is looked up:

1. *Anchors.* Within each window the smallest hash of ``gram`` consecutive words is its anchor. Equal windows
   have equal anchors, and neighbouring windows mostly share one, so the index holds about a fourteenth of all
   places. Anchors that occur at one place only rule out every window that holds them.
2. *Reference.* The windows around the other anchors are looked up: each repeating one refers to its first
   occurrence (a text and a word number).
3. *Parse.* A document is factored greedily from left to right: a factor grows while the next window is in the
   reference right behind the previous one, and ends where it isn't. Since windows, not whole factors, are
   looked up, those that straddle a factor boundary are checked as well; nothing between two factors is missed.

All rows with one text form a class: they get the same answer, so their anchors and windows are indexed once.
Anchors and windows are compared by 64-bit hashes of their words.

Null text and text of fewer words than ``window``: nothing is removed. Repeated rows and equal texts of at least
``window`` words repeat each other and lose all words. An empty table gives an empty result. All other columns,
whatever their names, travel unread in a struct.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, staged
from .common import WORD, blocks, fragment_of, hash_windows, hash_words, split_words, text_class

_LOOKED = "node long, n_words long, n_removed long, kept_sha256 string, kept_text binary, windows array<long>, starts array<int>"
_PARSED = (
    "n_words long, n_removed long, kept_sha256 string, kept_text binary, factors array<struct<start:int,words:int,ref_text:bigint,ref_start:int>>")
_WORDS = re.compile(WORD.encode())
_TOP = np.uint64(2**64 - 1)
FRAGMENT_WINDOWS = 1 << 20  # windows looked up in one task
BLOCK_BYTES = 4 << 20       # text worked on at once in a task


def _packed(text: bytes) -> bytes:
    """Text as it travels between tasks: its length in 8 bytes, then zstd."""
    return len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, limit=BLOCK_BYTES):
        texts = [None if t is None else _packed(t) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["rest"], pa.array(texts, pa.binary()), batch["node"]], ["rest", "text", "node"])


def _sliding(best, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (minimum or maximum) of each ``width`` consecutive values, by doubling."""
    size, count = 1, len(values) - width + 1
    while size * 2 <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    return best(values[:count], values[width - size:width - size + count])


def _anchors(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(anchor, node, at): hash, class and first word number of each anchor."""
    width = window - gram + 1
    for batch in blocks(batches, limit=BLOCK_BYTES):
        nodes, first = np.unique(batch["node"].to_numpy(zero_copy_only=False), return_index=True)
        words = [hash_words(split_words(batch["text"][int(i)].as_py())) for i in first]
        long = [i for i, w in enumerate(words) if len(w) >= window]
        if not long:
            continue
        lengths = np.array([len(words[i]) for i in long])
        flat, ends = np.concatenate([words[i] for i in long]), np.cumsum(lengths)
        grams = np.full(len(flat), _TOP)
        grams[:len(flat) - gram + 1] = hash_windows(flat, gram)
        for back in range(1, gram):
            grams[ends - back] = _TOP  # these would reach into the next document
        least = _sliding(np.minimum, grams, width)
        around = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero((_sliding(np.maximum, np.concatenate([around, least, around]), width) == grams) & (grams != _TOP))
        of = np.searchsorted(ends, chosen, side="right")
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams[chosen].view(np.int64)), pa.array(nodes[np.array(long)[of]]), pa.array((chosen - (ends - lengths)[of]).astype(np.int32))],
            ["anchor", "node", "at"])


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _look_up(batches: Iterator[pa.RecordBatch], window: int, gram: int, keep_text: bool) -> Iterator[pa.RecordBatch]:
    """The windows around shared anchors, and the result of rows for which nothing remains to be looked up."""
    for batch in blocks(batches, limit=BLOCK_BYTES):
        out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept_text", "windows", "starts")}
        columns = (batch[c].to_pylist() for c in ("text", "places", "copies", "speaks"))
        for packed, places, copies, speaks in zip(*columns, strict=True):
            text = None if packed is None else _unpacked(packed)
            words = split_words(text) if text else []
            n, repeated, hashes, starts = len(words), (copies or 0) > 1, None, None
            if n >= window and places and (speaks or not repeated):
                turn = np.zeros(n + 2, np.int32)
                at = np.array(places)
                np.add.at(turn, np.maximum(at + gram - window, 0), 1)
                np.add.at(turn, np.minimum(at, n - window) + 1, -1)
                starts = np.flatnonzero(np.cumsum(turn)[:n - window + 1] > 0)
                hashes = hash_windows(hash_words(words), window)[starts].view(np.int64)
            open_ = hashes is not None and not repeated
            gone = n if repeated and n >= window else 0
            out["n_words"].append(n)
            out["n_removed"].append(None if open_ else gone)
            out["kept_sha256"].append(None if open_ else _sha([] if gone else words))
            out["kept_text"].append(packed if open_ or keep_text and not gone else None if text is None or not keep_text else _packed(b""))
            out["windows"].append(hashes)
            out["starts"].append(None if starts is None else starts.astype(np.int32))
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept_text": pa.binary(),
                 "windows": pa.list_(pa.int64()), "starts": pa.list_(pa.int32())}
        yield pa.RecordBatch.from_arrays([batch["rest"], batch["node"], *(pa.array(out[k], t) for k, t in kinds.items())], ["rest", "node", *kinds])


def factors(start: np.ndarray, text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Greedy parse of windows (start, reference text and reference start, by start) into maximal runs.

    Columns of the result: start, number of windows, reference text, reference start.
    """
    if not len(start):
        return np.empty((0, 4), np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(start) != 1) | (np.diff(text) != 0) | (np.diff(place) != 1)]))
    return np.stack([start[new], np.diff(new, append=len(start)), text[new], place[new]], axis=1).astype(np.int64)


_ASKED = "fragment int, asked binary, told binary, runs binary"


def _ask(batches: Iterator[pa.RecordBatch], fragments: int) -> Iterator[pa.RecordBatch]:
    """Per block of texts and fragment of the hash order.

    ``asked``: windows that occur once in the block (hash, node, start), ``told``: one place of each that occurs
    several times there. Those are resolved at once: their factors (``runs``) go to the fragment of their text.
    """
    for batch in batches:
        windows = batch["windows"].flatten().to_numpy(zero_copy_only=False)
        start = batch["starts"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = np.array([len(w) for w in batch["windows"].to_numpy(zero_copy_only=False)])
        nodes = batch["node"].to_numpy(zero_copy_only=False)
        node, open_ = np.repeat(nodes, lengths), np.repeat(batch["open"].to_numpy(zero_copy_only=False), lengths)
        order = np.argsort(windows, kind="stable")
        ranked = windows[order]
        first = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.empty(0, bool)
        group = np.cumsum(first) - 1
        heads = np.flatnonzero(first)
        several = (np.diff(heads, append=len(ranked)) > 1)[group] if len(ranked) else np.empty(0, bool)
        # The reference of a repeated window is its first place in the block; that of the first place is the second.
        ref = order[np.where(first, np.minimum(np.arange(len(ranked)) + 1, len(ranked) - 1), heads[group])] if len(ranked) else order
        local = np.flatnonzero(several & open_[order])
        sequence = local[np.lexsort((start[order[local]], node[order[local]]))]
        here, there = order[sequence], ref[sequence]
        cut = np.flatnonzero(np.concatenate([[True], np.diff(node[here]) != 0])) if len(here) else np.empty(0, np.int64)
        runs = [np.column_stack([np.full(len(f), node[here[a]]), f]) for a, b in zip(cut, np.append(cut[1:], len(here))[:len(cut)], strict=True)
                for f in [factors(start[here[a:b]], node[there[a:b]], start[there[a:b]])]]
        runs = np.concatenate([np.empty((0, 5), np.int64), *runs])
        single, heads = order[~several], order[first & several]
        asked = np.stack([windows[single], node[single], start[single], open_[single].astype(np.int64)], axis=1)
        told = np.stack([windows[heads], node[heads], start[heads]], axis=1)
        parts = [_by_fragment(x, fragments) for x in (asked, told, runs)]
        at = sorted(set().union(*parts))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array([p.get(f, b"") for f in at], pa.binary()) for p in parts)],
                                         ["fragment", "asked", "told", "runs"])


def _by_fragment(rows: np.ndarray, fragments: int) -> dict[int, bytes]:
    """Rows of numbers as bytes, column by column, by the fragment of their first number."""
    part = fragment_of(rows[:, 0].copy().view(np.uint64), fragments)
    order = np.argsort(part, kind="stable")
    found, at = np.unique(part[order], return_index=True)
    return {int(f): np.ascontiguousarray(x.T).tobytes() for f, x in zip(found, np.split(rows[order], at[1:]), strict=bool(len(found)))}


def _columns(blobs: list[bytes], count: int) -> np.ndarray:
    return np.concatenate([np.empty((count, 0), np.int64), *(np.frombuffer(b, np.int64).reshape(count, -1) for b in blobs if b)], axis=1)


def _answer(batches: Iterator[pa.RecordBatch], fragments: int) -> Iterator[pa.RecordBatch]:
    """One fragment: the places of asked windows that occur elsewhere, each with a reference, by the fragment of their text."""
    asked, told, runs = [], [], []
    for batch in batches:
        for held, column in ((asked, "asked"), (told, "told"), (runs, "runs")):
            held += batch[column].to_pylist()
    asked, told, runs = _columns(asked, 4), _columns(told, 3), _columns(runs, 5)
    window, node, start = np.concatenate([told, asked[:3]], axis=1)  # told places come first in a group
    wants = np.concatenate([np.zeros(told.shape[1], bool), asked[3] > 0])
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    if len(ranked):
        first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        heads = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        several = (np.diff(heads, append=len(ranked)) > 1)[group]
        ref = order[np.where(first, np.minimum(np.arange(len(ranked)) + 1, len(ranked) - 1), heads[group])]
        hit = np.flatnonzero(several & wants[order])
        here, there = order[hit], ref[hit]
        runs = np.concatenate([runs, np.stack([node[here], start[here], np.ones(len(here), np.int64), node[there], start[there]])], axis=1)
    parts = _by_fragment(np.ascontiguousarray(runs.T), fragments)
    yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array(list(parts.values()), pa.binary())], ["home", "runs"])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One home fragment: a row per text with its factors (start, windows, reference text, reference start)."""
    runs = _columns([b for batch in batches for b in batch["runs"].to_pylist()], 5)
    order = np.lexsort((runs[1], runs[0]))
    nodes, at = np.unique(runs[0][order], return_index=True)
    found = [np.ascontiguousarray(x).tobytes() for x in np.split(runs[1:, order].T, at[1:])] if len(nodes) else []
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], ["node", "found"])


def without_spans(text: bytes, covered: np.ndarray) -> bytes:
    """The text without its covered words; each goes together with the white space behind it."""
    bounds = np.array([m.start() for m in _WORDS.finditer(text)] + [len(text)])
    keep = np.flatnonzero(~covered)
    return text[:bounds[0]] + b"".join(text[bounds[i]:bounds[i + 1]] for i in keep)


def _parse(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("ref_text", pa.int64()), ("ref_start", pa.int32())]))
    for batch in blocks(batches, "kept_text", BLOCK_BYTES):
        removed, shas, texts, parsed = [], [], [], []
        for packed, found in zip(batch["kept_text"].to_pylist(), batch["found"].to_pylist(), strict=True):
            text = _unpacked(packed)
            words = split_words(text)
            pieces = np.frombuffer(found or b"", np.int64).reshape(-1, 4)
            spread = np.repeat(np.arange(len(pieces)), pieces[:, 1])  # windows again, so that factors from several tasks join
            step = np.arange(len(spread)) - np.repeat(np.cumsum(pieces[:, 1]) - pieces[:, 1], pieces[:, 1])
            runs = factors(pieces[spread, 0] + step, pieces[spread, 2], pieces[spread, 3] + step)
            covered = np.zeros(len(words), bool)
            for start, length, _, _ in runs.tolist():
                covered[start:start + length + window - 1] = True
            removed.append(int(covered.sum()))
            shas.append(_sha([w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]))
            texts.append(without_spans(text, covered) if covered.any() else text)
            parsed.append([{"start": a, "words": n + window - 1, "ref_text": t, "ref_start": r} for a, n, t, r in runs.tolist()])
        yield pa.RecordBatch.from_arrays(
            [batch["rest"], batch["n_words"], pa.array(removed, pa.int64()), pa.array(shas), pa.array(texts, pa.binary()), pa.array(parsed, kind)],
            ["rest", "n_words", "n_removed", "kept_sha256", "kept_text", "factors"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [None if t is None else _unpacked(t) for t in batch["kept_text"].to_pylist()]
        yield batch.set_column(batch.schema.get_field_index("kept_text"), "kept_text", pa.array(texts, pa.binary()))


def remove_repeats(docs: DataFrame, window: int = 35, gram: int = 8, text_column: str = "text", keep_text: bool = False,
                   fragment_windows: int = FRAGMENT_WINDOWS) -> DataFrame:
    """Per row: ``rest`` (the other columns), n_words, n_removed, kept_sha256, factors, and with ``keep_text`` kept_text.

    ``factors`` are the parsed repeats (start, words, ref_text, ref_start) of rows whose text occurs in one row; where
    equal texts repeat each other it is null.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_column]
    rows = docs.select(F.struct(*(others or [F.lit(1).alias("row")])).alias("rest"), F.col(text_column).cast("binary").alias("text"), text_class(text_column).alias("node"))
    rest = rows.schema["rest"].dataType
    looked = T.StructType([T.StructField("rest", rest), *T.StructType.fromDDL(_LOOKED)])
    # One row of each class speaks for it: the one with the smallest hash of its other columns.
    key = F.xxhash64("rest")
    classes = rows.where("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min(key).alias("speaker"))
    indexed = rows.where("node is not null").select("node", "text").mapInArrow(partial(_anchors, window=window, gram=gram), "anchor long, node long, at int")
    with staged(indexed, "anchors") as anchors:
        shared = anchors.groupBy("anchor").agg(F.count("*").alias("seen")).where("seen > 1").select("anchor")
        places = anchors.join(shared, "anchor").groupBy("node").agg(F.collect_set("at").alias("places"))
        # Only classes with something to look up, or with several rows, need joining.
        known = classes.join(places, "node", "left").where("copies > 1 or places is not null")
        packed = rows.mapInArrow(_pack_texts, rows.schema)
        joined = (packed.join(known, "node", "left")
                  .select("rest", "node", "text", "places", "copies", F.coalesce(key == F.col("speaker"), F.lit(True)).alias("speaks")))
        stored = materialize(joined.mapInArrow(partial(_look_up, window=window, gram=gram, keep_text=keep_text), looked), "windows")

    posted = stored.where("windows is not null").select("node", F.col("n_removed").isNull().alias("open"), "windows", "starts")
    count = posted.agg(F.sum(F.size("windows"))).first()[0] or 0
    fragments = max(1, -(-count // fragment_windows))
    answers = (posted.mapInArrow(partial(_ask, fragments=fragments), _ASKED).repartitionById(fragments, F.col("fragment"))
               .mapInArrow(partial(_answer, fragments=fragments), "home int, runs binary"))
    found = answers.repartitionById(fragments, F.col("home")).mapInArrow(_gather, "node long, found binary")
    parsed = T.StructType([T.StructField("rest", rest), *T.StructType.fromDDL(_PARSED)])
    open_rows = stored.where("n_removed is null").select("rest", "node", "n_words", "kept_text")
    late = open_rows.join(found, "node", "left").select("rest", "n_words", "kept_text", "found").mapInArrow(partial(_parse, window=window), parsed)
    done = stored.where("n_removed is not null").select("rest", "n_words", "n_removed", "kept_sha256", "kept_text",
                                                        F.lit(None).cast(parsed["factors"].dataType).alias("factors"))
    if not keep_text:
        return done.unionByName(late).drop("kept_text")
    return done.mapInArrow(_unpack, done.schema).unionByName(late).withColumn("kept_text", F.col("kept_text").cast("string"))
