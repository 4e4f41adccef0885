"""Text quality by a byte-level convolutional network in numpy.

Every byte of a text has a small vector. Learned filters slide over the whole document in steps of ``STEP`` bytes, each
seeing ``2 * STEP`` bytes; within overlapping chunks the strongest response of each filter is kept (max-pooling). The
chunk vectors of a document are combined by their mean and their maximum into one probability.

The network is fitted by gradient descent on a sample of labelled rows, bounded by ``sample`` rows of each label and
``max_train_bytes`` of text per row (longer texts are left out of the sample, never cut). Scores cover whole texts.

Null and empty text: scored as a text without bytes (one chunk of zeros). Equal texts get equal scores. Null ids are
scored and count as not held out. Labels that are null, or a table with one label only, are left out of the fit; with
no usable label at all every score is 0.5. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks

STEP, WIDTH, FILTERS = 4, 8, 32          # bytes per step, numbers per byte, filters
HALF = 32                                # steps per half chunk: chunks of 256 bytes overlap by half
SLICE_BYTES = 1 << 19


def byte_vectors() -> np.ndarray:
    """Fixed vectors: five kinds of character and three pseudo-random coordinates."""
    codes = np.arange(256)
    text = [chr(c) for c in codes]
    kinds = [[c.islower() for c in text], [c.isupper() for c in text], codes >= 128, codes == 32, [(33 <= k < 127) and not chr(k).isalnum() for k in codes]]
    return np.concatenate([np.array(kinds, np.float32).T, np.random.default_rng(5).normal(size=(256, WIDTH - 5)).astype(np.float32)], axis=1)


_VECTORS = byte_vectors()


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte vectors by step (rows of STEP * WIDTH numbers), and the number of half chunks of each text, at least one."""
    halves = np.array([max(1, -(-len(t) // (STEP * HALF))) for t in texts])
    flat = np.frombuffer(b"".join(t.ljust(int(h) * STEP * HALF, b"\0") for t, h in zip(texts, halves, strict=True)), np.uint8)
    return _VECTORS[flat].reshape(-1, STEP * WIDTH), halves


def respond(steps: np.ndarray, halves: np.ndarray, model: dict) -> np.ndarray:
    """Filter responses before bias at each step; the last step of a text sees zero bytes behind it."""
    both = steps @ model["filters"]
    out, behind = both[:, :FILTERS], both[:, FILTERS:]
    out[:-1] += behind[1:]
    last = np.cumsum(halves) * HALF - 1
    zero = np.tile(_VECTORS[0], STEP) @ model["filters"][:, FILTERS:]
    out[last[:-1]] += zero - behind[last[:-1] + 1]
    out[last[-1]] += zero
    return out


def pool(half: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunk vectors (maximum of two neighbouring halves of one text), their starts by text and number by text."""
    starts = np.concatenate([[0], np.cumsum(halves)[:-1]])
    chunk = half.copy()
    inside = np.ones(len(half), bool)
    inside[starts + halves - 1] = False
    first = np.flatnonzero(inside)
    chunk[first] = np.maximum(half[first], half[first + 1])
    keep = inside.copy()
    keep[starts[halves == 1]] = True
    counts = np.maximum(halves - 1, 1)
    return chunk[keep], np.concatenate([[0], np.cumsum(counts)[:-1]]), counts


def strongest(texts: list[bytes], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Strongest response of each filter by half chunk, and the number of half chunks of each text."""
    steps, halves = lay_out(texts)
    return respond(steps, halves, model).reshape(-1, HALF, FILTERS).max(axis=1), halves


def strongest_in_slices(text: bytes, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """The same for one long text, a slice at a time; a slice also sees the half chunk behind it."""
    size, at_once = STEP * HALF, SLICE_BYTES // (STEP * HALF)
    count = -(-len(text) // size)
    half = np.empty((count, FILTERS), np.float32)
    for start in range(0, count, at_once):
        stop = min(count, start + at_once)
        half[start:stop] = strongest([text[start * size:(stop + 1) * size]], model)[0][:stop - start]
    return half, np.array([count])


def document_vectors(texts: list[bytes], model: dict) -> np.ndarray:
    long = len(texts) == 1 and len(texts[0]) > SLICE_BYTES  # blocks hold a longer text alone
    half, halves = strongest_in_slices(texts[0], model) if long else strongest(texts, model)
    chunk, starts, counts = pool(np.maximum(half + model["bias"], 0), halves)
    return np.concatenate([np.add.reduceat(chunk, starts) / counts[:, None], np.maximum.reduceat(chunk, starts)], axis=1)


def probability(texts: list[bytes], model: dict) -> np.ndarray:
    return 1 / (1 + np.exp(-(document_vectors(texts, model).astype(np.float64) @ model["weights"] + model["offset"])))


def _gradients(texts: list[bytes], labels: np.ndarray, model: dict) -> dict:
    steps, halves = lay_out(texts)
    responses = respond(steps, halves, model).reshape(-1, HALF, FILTERS)
    at = responses.argmax(axis=1)
    half = np.maximum(np.take_along_axis(responses, at[:, None], 1)[:, 0] + model["bias"], 0)
    chunk, starts, counts = pool(half, halves)
    means, tops = np.add.reduceat(chunk, starts) / counts[:, None], np.maximum.reduceat(chunk, starts)
    vectors = np.concatenate([means, tops], axis=1)
    error = (1 / (1 + np.exp(-(vectors @ model["weights"] + model["offset"]))) - labels) / len(labels)
    back = error[:, None] * model["weights"][None]
    of = np.repeat(np.arange(len(texts)), counts)
    to_chunk = back[of, :FILTERS] / counts[of, None]
    is_top = chunk == tops[of]
    to_chunk += back[of, FILTERS:] * is_top / np.maximum(np.add.reduceat(is_top, starts, dtype=np.int64)[of], 1)
    # A chunk hands its gradient to the half that holds its maximum.
    text_start = np.concatenate([[0], np.cumsum(halves)[:-1]])
    left = np.arange(len(chunk)) - starts[of] + text_start[of]
    right = np.where(counts[of] == halves[of], left, left + 1)
    to_half = np.zeros_like(half)
    wins = half[left] >= half[right]
    np.add.at(to_half, left, to_chunk * wins)
    np.add.at(to_half, right, to_chunk * ~wins)
    to_half *= half > 0
    place = at + np.arange(len(half))[:, None] * HALF
    filters = np.empty_like(model["filters"])
    for k in range(FILTERS):
        spots, weight = place[:, k], to_half[:, k]
        used = weight != 0
        spots, weight = spots[used], weight[used]
        inner = (spots + 1) % HALF != 0
        filters[:, k] = weight @ steps[spots]
        filters[:, FILTERS + k] = weight[inner] @ steps[spots[inner] + 1]
    return {"filters": filters, "bias": to_half.sum(axis=0), "weights": error @ vectors, "offset": error.sum()}


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = 12, batch: int = 32, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> dict:
    """A network fitted by Adam."""
    draw = np.random.default_rng(seed)
    model = {"filters": draw.normal(0, 0.2, (STEP * WIDTH, 2 * FILTERS)).astype(np.float32), "bias": np.zeros(FILTERS, np.float32),
             "weights": draw.normal(0, 0.1, 2 * FILTERS), "offset": 0.0}
    if len(set(labels.tolist())) < 2:
        return model | {"weights": np.zeros(2 * FILTERS)}
    first, second, count = {k: 0.0 for k in model}, {k: 0.0 for k in model}, 0
    total = epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = draw.permutation(len(texts))
        for start in range(0, len(texts), batch):
            chosen = order[start:start + batch]
            found = _gradients([texts[i] for i in chosen], labels[chosen], model)
            count += 1
            pace = rate * min(1.0, 2 * (1 - count / (total + 1)))
            for k, gradient in found.items():
                gradient = gradient + decay * model[k] * (k in ("filters", "weights"))
                first[k] = 0.9 * first[k] + 0.1 * gradient
                second[k] = 0.999 * second[k] + 0.001 * gradient ** 2
                move = pace * (first[k] / (1 - 0.9 ** count)) / (np.sqrt(second[k] / (1 - 0.999 ** count)) + 1e-8)
                model[k] = (model[k] - move).astype(np.float32) if k in ("filters", "bias") else model[k] - move
    return model


def remainder(parts: int, id_column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, sample: int, max_train_bytes: int) -> tuple[list[bytes], np.ndarray]:
    """At most ``sample`` rows of each label (those with the smallest hashes of their ids) that ``train`` admits, with texts."""
    usable = (labels.where(train & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("label"))
              .withColumn("order", F.xxhash64("doc_id")))
    chosen = [usable.where(F.col("label") == value).orderBy("order").limit(sample) for value in (0, 1)]
    chosen = chosen[0].union(chosen[1])
    texts = docs.where(F.octet_length("text") <= max_train_bytes).select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").orderBy("order", "text").select("text", "label").limit(2 * sample).toArrow()
    return [bytes(t) for t in rows["text"].to_pylist()], np.array(rows["label"].to_pylist(), float)


def _score(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch["rest"].field("text").cast(pa.binary())  # a view; the text is not sent twice
        for part in blocks([pa.RecordBatch.from_arrays([batch["rest"], text], ["rest", "text"])], limit=SLICE_BYTES):
            scores = probability([t or b"" for t in part["text"].to_pylist()], model)
            yield pa.RecordBatch.from_arrays([part["rest"], pa.array(scores)], ["rest", "score"])


def score(docs: DataFrame, model: dict) -> DataFrame:
    """All columns of ``docs`` in the struct ``rest``, and ``score``."""
    rows = docs.select(F.struct("*").alias("rest"))
    kind = rows.select("rest", F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(partial(_score, model=model), kind)


def quality_model(docs: DataFrame, labels: DataFrame, train: Column, sample: int = 1200, max_train_bytes: int = 32 << 10) -> dict:
    """The network fitted to ``labels.quality`` where ``train`` holds."""
    return fit(*labelled_sample(docs, labels, "quality", train, sample, max_train_bytes))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted (score >= threshold); learned from rows not held out only."""
    model = quality_model(docs, labels, ~held_out)
    scored = score(docs.select("doc_id", "text"), model).select("rest.doc_id", "score")
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
