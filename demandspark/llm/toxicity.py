"""Toxic spans by a linear-chain conditional random field; marginals give document scores.

Each word is in state 0 (clean) or 1 (toxic). The score of a labelling is the sum of state scores, linear in the word,
its beginnings and its end and in the same features of both neighbours, and of transition scores. Forward-backward
passes give the marginal probability that a word is toxic; a document's score is a logistic function of the largest
marginal, the expected number of toxic words and their share.

*Labelled words.* Labels exist per document. A feature marks toxic words when it occurs in at least three plus ``share`` of the toxic
sample documents and ``ratio`` times as often among them as among the clean ones. In a toxic document the
words with such a feature are labelled toxic, all others clean; the field then learns context and transitions as well.

The sample for the fit is bounded by ``sample`` rows of each label and ``max_train_bytes`` of text per row (longer texts
are left out of the sample, never cut). Scores cover whole texts.

Null, empty and blank text: no words, hence no spans and the score of a document without toxic words. Equal texts get
equal scores. Null ids are scored and count as not held out. Without labels of both kinds nothing is toxic. An empty
table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytenet import labelled_sample
from .common import blocks

_WORD = re.compile(r"\S+")
_EDGES = ".,;:!?\"'()[]{}*%&$#|<>-_"
MARGINAL = 0.5   # a word at or above it belongs to a toxic span


def word_features(word: str) -> list[str]:
    """The word (lower case, without marks around it), its beginnings and its end."""
    bare = word.strip(_EDGES)
    return ["=" + bare, *("^" + bare[:k] for k in (3, 4, 5) if len(bare) >= k), *(["$" + bare[-4:]] if len(bare) >= 4 else [])]


class WordScores(dict):
    """State scores of words seen by a worker: the word's own share, and what it adds to its next and previous word."""

    LIMIT = 400_000

    def __init__(self, weights: dict[str, tuple[float, float, float]]):
        self.weights, self.parts = weights, []

    def __missing__(self, word: str) -> int:
        own = after = before = 0.0
        for feature in word_features(word):
            if found := self.weights.get(feature):
                own, after, before = own + found[0], after + found[1], before + found[2]
        self.parts.append((own, after, before))
        value = self[word] = len(self.parts) - 1
        return value


def chain_odds(state: np.ndarray, starts: np.ndarray, lengths: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds (state 1 to state 0) of all words; texts run side by side, longest first."""
    odds = np.exp(np.clip(state, -30, 30))
    t00, t01, t10, t11 = np.exp(model["transition"]).ravel()
    forward, backward = np.empty_like(odds), np.ones_like(odds)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # texts longer than t
    for t in range(longest):
        at = starts[:active[t]] + t
        if t:
            before = before[:active[t]]
            before = odds[at] * (t01 + before * t11) / (t00 + before * t10)
        else:
            before = odds[at] * np.exp(model["start"])
        forward[at] = before
    for t in range(longest - 2, -1, -1):
        at = starts[:active[t + 1]] + t
        ahead = odds[at + 1] * backward[at + 1]
        backward[at] = (t10 + ahead * t11) / (t00 + ahead * t01)
    return forward, backward


def _lay_out(counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array(counts, np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    total = int(ends[-1]) if len(ends) else 0
    begins, closes = np.zeros(total, bool), np.zeros(total, bool)
    full = lengths > 0
    begins[starts[full]] = True
    closes[ends[full] - 1] = True
    return lengths, starts, begins, closes


def _state(parts: np.ndarray, words: np.ndarray, begins: np.ndarray, closes: np.ndarray, bias: float) -> np.ndarray:
    """State scores of words in sequence: own part, the previous word's ``after`` and the next word's ``before``."""
    state = parts[words, 0] + bias
    if len(words) > 1:
        state[1:] += np.where(begins[1:], 0, parts[words[:-1], 1])
        state[:-1] += np.where(closes[:-1], 0, parts[words[1:], 2])
    return state


def document_statistics(marginals: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Largest marginal, log of one plus the expected number of toxic words, and the root of their share; one row a text."""
    out = np.zeros((len(lengths), 3))
    full = np.flatnonzero(lengths > 0)
    if len(full):
        out[full, 0] = np.maximum.reduceat(marginals, starts[full])
        expected = np.add.reduceat(np.where(marginals < 0.05, 0, marginals), starts[full])
        out[full, 1] = np.log1p(expected)
        out[full, 2] = np.sqrt(expected / lengths[full])
    return out


def _marginals(state, starts, lengths, model):
    forward, backward = chain_odds(state, starts, lengths, model)
    odds = forward * backward
    return odds / (1 + odds), forward, backward


def marking_features(bad: Counter, good: Counter, toxic: np.ndarray, share: float, ratio: float) -> set[str]:
    n_bad, n_good = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    return {f for f, k in bad.items() if k >= 3 + share * n_bad and k / n_bad >= ratio * (good[f] + 0.5) / n_good}


def fit(texts: list[bytes], toxic: np.ndarray, share: float = 0.02, ratio: float = 20.0, epochs: int = 10, steps: int = 20,
        rate: float = 0.2, decay: float = 1e-5, seed: int = 11) -> dict:
    """The field and the document model."""
    model = {"weights": {}, "bias": -4.0, "start": 0.0, "transition": np.zeros((2, 2)), "document": np.array([-3.0, 6.0, 0.0, 0.0])}
    if len(set(toxic.tolist())) < 2:
        return model
    unique = dict(zip(texts, toxic.tolist(), strict=True))  # copies of one text count once
    texts, toxic = list(unique), np.array(list(unique.values()))
    docs = [t.decode().lower().split() for t in texts]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for d in docs for w in d))}
    of_word = [word_features(w) for w in vocabulary]
    words_of = [np.array([vocabulary[w] for w in d], np.int64) for d in docs]
    bad, good = Counter(), Counter()  # toxic and clean texts by feature
    for words, label in zip(words_of, toxic.tolist(), strict=True):
        (bad if label else good).update({f for w in np.unique(words).tolist() for f in of_word[w]})
    marks = marking_features(bad, good, toxic, share, ratio)
    marked = np.array([any(f in marks for f in fs) for fs in of_word], bool)
    names = {f: i for i, f in enumerate(f for f, k in (bad + good).items() if k >= 3)}
    rows, columns = np.array([(w, names[f]) for w, fs in enumerate(of_word) for f in fs if f in names]).T
    weights, bias, start, transition = np.zeros((len(names), 3)), -4.0, 0.0, np.zeros((2, 2))
    use = [i for i in range(len(docs)) if len(docs[i]) and (not toxic[i] or marked[words_of[i]].any())]
    seen, draw = np.full(weights.shape, 1e-8), np.random.default_rng(seed)
    seen_rest = np.full(6, 1e-8)
    for _ in range(epochs):
        for chosen in np.array_split(draw.permutation(use), max(1, min(steps, len(use)))):
            lengths, starts, begins, closes = _lay_out([len(docs[i]) for i in chosen])
            words = np.concatenate([words_of[i] for i in chosen])
            truth = marked[words] & np.repeat(toxic[chosen] == 1, lengths)
            parts = np.zeros((len(vocabulary), 3))
            for k in range(3):
                parts[:, k] = np.bincount(rows, weights[columns, k], len(vocabulary))
            now = {"transition": transition, "start": start}
            p, forward, backward = _marginals(_state(parts, words, begins, closes, bias), starts, lengths, now)
            slip = (p - truth) / len(chosen)
            by_word = np.zeros((len(vocabulary), 3))
            by_word[:, 0] = np.bincount(words, slip, len(vocabulary))
            inner = ~begins[1:]
            by_word[:, 1] = np.bincount(words[:-1][inner], slip[1:][inner], len(vocabulary))
            by_word[:, 2] = np.bincount(words[1:][inner], slip[:-1][inner], len(vocabulary))
            gradient = np.stack([np.bincount(columns, by_word[rows, k], len(names)) for k in range(3)], axis=1) + decay * weights
            seen += gradient ** 2
            weights -= rate * gradient / np.sqrt(seen)
            # Expected minus observed transitions, from the pair marginals of neighbouring words.
            pair = np.exp(transition)[None] * np.stack([np.ones(inner.sum()), forward[:-1][inner]], 1)[:, :, None]
            ahead = np.exp(np.clip(_state(parts, words, begins, closes, bias), -30, 30))[1:][inner] * backward[1:][inner]
            pair = pair * np.stack([np.ones(len(ahead)), ahead], 1)[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            was, follows = truth[:-1][inner].astype(int), truth[1:][inner].astype(int)
            observed = np.bincount(was * 2 + follows, minlength=4).reshape(2, 2)
            rest = np.concatenate([((pair.sum(axis=0) - observed) / len(chosen)).ravel(), [slip.sum(), slip[begins].sum()]])
            seen_rest += rest ** 2
            step = 0.1 * rest / np.sqrt(seen_rest)
            transition, bias, start = transition - step[:4].reshape(2, 2), bias - step[4], start - step[5]
    strong = np.abs(weights).max(axis=1) > 1e-2
    model |= {"weights": {f: tuple(weights[i].round(5).tolist()) for f, i in names.items() if strong[i]}, "bias": bias, "start": start,
              "transition": transition}
    lengths, starts, _, _ = _lay_out([len(d) for d in docs])
    p, _, _ = tag(docs, WordScores(model["weights"]), model)
    model["document"] = _logistic(document_statistics(p, starts, lengths), toxic)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Coefficients (constant first) by Newton steps, both labels weighing the same."""
    x = np.column_stack([np.ones(len(x)), x])
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    b = np.zeros(x.shape[1])
    keep = np.diag([1e-3, ridge, ridge, ridge])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b += np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + keep, x.T @ (share * (y - p)) - keep @ b)
    return b


def tag(docs: list[list[str]], scores: WordScores, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of all words in sequence, with starts and lengths of the texts."""
    lengths, starts, begins, closes = _lay_out([len(d) for d in docs])
    words = np.fromiter((scores[w] for d in docs for w in d), np.int64, int(lengths.sum()))
    state = _state(np.array(scores.parts or [(0.0, 0.0, 0.0)]), words, begins, closes, model["bias"])
    return _marginals(state, starts, lengths, model)[0], starts, lengths


_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))


def _score(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    scores = WordScores(model["weights"])
    for batch in blocks(batches):
        texts = [t.decode() if t else "" for t in batch["text"].to_pylist()]
        if len(scores) >= scores.LIMIT:
            scores = WordScores(model["weights"])
        p, starts, lengths = tag([t.lower().split() for t in texts], scores, model)
        x = document_statistics(p, starts, lengths)
        value = 1 / (1 + np.exp(-np.clip(model["document"][0] + x @ model["document"][1:], -30, 30)))
        spans: list[list[dict]] = [[] for _ in texts]
        for k in np.flatnonzero(x[:, 0] >= MARGINAL).tolist():
            mine = p[starts[k]:starts[k] + lengths[k]]
            places = [m.span() for m in _WORD.finditer(texts[k])] if len(mine) else []
            spans[k] = [{"start": places[i][0], "end": places[i][1], "probability": float(mine[i])} for i in np.flatnonzero(mine >= MARGINAL).tolist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(value), pa.array(spans, _SPAN)], ["doc_id", "score", "spans"])


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7, sample: int = 1500,
             max_train_bytes: int = 32 << 10) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (score >= threshold) and the toxic words' character offsets with marginals."""
    model = fit(*labelled_sample(docs, labels, "toxic", ~held_out, sample, max_train_bytes))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    scored = rows.mapInArrow(partial(_score, model=model), "doc_id long, score double, spans array<struct<start:int,end:int,probability:double>>")
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
