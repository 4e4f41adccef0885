"""Operators that treat each document by itself or beside its neighbour."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandspark.llm import bytenet, mixing, outliers, packing, spots, toxicity

from .conftest import odd_rows, prose


def check_pieces(rows, pieces, size):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for i, text in rows:
        ids = np.array(coder.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        expected[i, len(ids), ids.tobytes()] += 1
    total = sum(n * k for (_, n, _), k in expected.items())
    assert sum(p.length for p in pieces) == total
    for (i, n, ids), _ in expected.items():
        for p in (p for p in pieces if p.doc_id == i and p.doc_tokens == n):
            if zlib.crc32(ids[4 * p.start:4 * (p.start + p.length)]) == p.ids_crc32:
                break
        else:
            raise AssertionError(i)
    filled = Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled[p.sequence_id] and p.length > 0
        filled[p.sequence_id] += p.length
    assert max(filled.values()) <= size


def test_packing_round_trip(docs):
    rows = odd_rows() + [(20 + k, prose(60 + k, 30 * k)) for k in range(12)] + [(50, "a  b <|endoftext|> ' l'll\r\n\r\n x .\u3000。  "), (51, "Straße été. ñandú! 12,5 %%% ok")]
    check_pieces(rows, packing.pack(docs(*rows)).collect(), 2048)
    assert packing.pack(docs(*rows).limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_packing_of_short_partitions(docs, parts):
    """Partitions below one window, a short last block, null and empty texts, and a count that is a power of two."""
    short = [(1, "a few words"), (2, None), (3, ""), (4, "x <|endoftext|> y"), (5, "tab\there \u2028 \x85 \x1c end"), (None, "no id")]
    for rows in (short[:1], short, short + [(k, prose(k, 700)) for k in range(10, 22)] + [(30, "tail")]):
        check_pieces(rows, packing.pack(docs(*rows).repartition(parts)).collect(), 2048)


def test_packing_with_a_short_last_block(docs, monkeypatch):
    from demandspark.llm import common
    coder = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    batches = [(k, prose(k, n)) for k, n in enumerate((3000, 3, 2, 1, 2500, 1))]
    data = pa.RecordBatch.from_arrays([pa.array([k for k, _ in batches]), pa.array([t.encode() for _, t in batches], pa.binary())], ["doc_id", "text"])
    monkeypatch.setattr(packing, "BLOCK_BYTES", 100)
    monkeypatch.setattr(packing.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 0})()))
    found = list(packing._pack(iter([data]), None, "byte_bpe_50k.json", 2048, 128, 2, 8))
    assert sum(sum(b["length"].to_pylist()) for b in found) == sum(len(coder.ids(t)) + 1 for _, t in batches)
    assert common.BLOCK_BYTES


def test_encoder_equals_the_vocabulary_library(spark):
    coder = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    odd = ["a <|endoftext|> b", "<|endoftext|>", " \r\n\t x", "it's we'll I'M", "ÀÿŒ ×÷ ɏ", "日本 ٣٤ ½ \x0b\x0c\x1f", "a" * 70_000, " " * 70_000 + "b", "12,5 %%%"]
    assert coder.quick
    for text in [t for t in texts if t] + odd:
        assert coder.ids(text).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_dynamic_program_is_optimal():
    draw = np.random.default_rng(4)
    for _ in range(30):
        at = np.unique(np.concatenate([[0], np.cumsum(draw.integers(1, 16, 25))]))
        penalty = draw.integers(0, 6, len(at)).tolist()
        pad = lambda n: 0 if n & (n - 1) == 0 else 16 - n
        best = [0] + [None] * (len(at) - 1)
        for j in range(1, len(at)):
            best[j] = min(best[i] + pad(int(at[j] - at[i])) for i in range(j) if at[j] - at[i] <= 16) + penalty[j]
        cuts = packing.best_cuts(at, penalty, 16, True)
        edges = [0, *cuts]
        cost = sum(pad(int(b - a)) for a, b in zip(edges, edges[1:], strict=False)) + sum(penalty[int(np.searchsorted(at, c))] for c in cuts)
        assert cuts[-1] == at[-1] and cost == best[-1]


def test_mixing_rates_and_draws(docs, spark):
    rows = [(k, prose(k, 20)) for k in range(3000)]
    frame = docs(*rows)
    mixed = mixing.mix(frame, weights={"s0": 3.0, "s1": 1.0})
    size = dict(frame.groupBy("source").agg(F.sum(F.octet_length("text"))).collect())
    got = dict(mixed.groupBy("source").agg(F.sum(F.octet_length("text"))).collect())
    assert set(frame.columns) < set(mixed.columns)
    assert abs(got["s0"] / sum(size.values()) - 0.75) < 0.03 and abs(got["s1"] / sum(size.values()) - 0.25) < 0.03
    counts = mixed.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("mix_copy").alias("last"), F.first("mix_copies").alias("k")).collect()
    assert all(r.n == r.last == r.k for r in counts)
    again = mixing.mix(frame.repartition(7), weights={"s0": 3.0, "s1": 1.0})
    assert sorted(r.mix_key for r in again.select("mix_key").collect()) == sorted(r.mix_key for r in mixed.select("mix_key").collect())


def test_poisson_inversion(spark):
    us = [0.0, 0.1, 0.5, 0.9, 0.999999]
    got = spark.createDataFrame([(u, r) for u in us for r in (0.0, 0.3, 2.0, 900.0)], "u double, r double").select(
        "u", "r", mixing.poisson(F.col("u"), F.col("r")).alias("n")).collect()
    for row in got:
        n, term, total = 0, np.exp(-row.r) if row.r < 700 else None, 0.0
        if row.r == 900:
            assert row.u == 0 or abs(row.n - 900) < 170  # below u = 1e-300 the first terms are too small for a double
            continue
        while row.r and (total := total + term) <= row.u:
            n, term = n + 1, term * row.r / (n + 1)
        assert row.n == n


def test_mixing_of_rows_without_ids(docs):
    """A source without ids keeps its weight, also if a third of its rows are equal, and is spread over the partitions."""
    rows = [(None if k % 2 else k, "the same words again" if k % 6 == 1 else prose(k, 4)) for k in range(12_000)]
    frame = docs(*rows)
    mixed = mixing.mix(frame, weights={"s0": 1.0, "s1": 2.0}, budget=60_000.0).cache()
    got = dict(mixed.groupBy("source").agg(F.sum(F.octet_length("text"))).collect())
    assert abs(got["s1"] / sum(got.values()) - 2 / 3) < 0.03
    nameless = mixed.where("doc_id is null")
    spread = [r[1] for r in nameless.groupBy(F.spark_partition_id()).count().collect()]
    assert max(spread) < 0.5 * sum(spread)
    again = mixing.mix(frame.repartition(5), weights={"s0": 1.0, "s1": 2.0}, budget=60_000.0)
    assert sorted(r.mix_key for r in again.select("mix_key").collect()) == sorted(r.mix_key for r in mixed.select("mix_key").collect())


def test_mixing_of_odd_rows(docs):
    odd = mixing.mix(docs(*odd_rows()), budget=10.0 ** 6)
    assert odd.where("text is not null").groupBy("doc_id").count().where("doc_id is null").count() == 1
    assert mixing.mix(docs((1, None), (2, "")), temperature=1.0).count() == 0
    assert mixing.mix(docs((1, "a")).limit(0)).count() == 0


def brute_probability(text, model):
    """A plain convolution and pooling, one step after the other."""
    size, steps = bytenet.STEP, bytenet.HALF
    padded = text.ljust(max(1, -(-len(text) // (size * steps))) * size * steps, b"\0")
    filters = model["filters"].astype(float)
    vectors = [np.concatenate([bytenet._VECTORS[b] for b in padded[k:k + size]]) for k in range(0, len(padded), size)] + [np.tile(bytenet._VECTORS[0], size)]
    responses = [vectors[k] @ filters[:, :bytenet.FILTERS] + vectors[k + 1] @ filters[:, bytenet.FILTERS:] for k in range(len(vectors) - 1)]
    halves = [np.max(responses[k:k + steps], axis=0) for k in range(0, len(responses), steps)]
    chunks = [np.maximum(np.maximum(a, b) + model["bias"], 0) for a, b in zip(halves, halves[1:], strict=False)] or [np.maximum(halves[0] + model["bias"], 0)]
    both = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)])
    return 1 / (1 + np.exp(-(both @ model["weights"] + model["offset"])))


def some_network():
    draw = np.random.default_rng(2)
    return {"filters": draw.normal(0, 0.2, (32, 64)).astype(np.float32), "bias": draw.normal(0, 0.1, 32).astype(np.float32),
            "weights": draw.normal(0, 0.3, 64), "offset": 0.1}


def test_network_equals_a_plain_convolution(docs, monkeypatch):
    model = some_network()
    rows = odd_rows()[:-4] + [(k, prose(k, n)) for k, n in enumerate((1, 20, 26, 60, 200), 40)]
    expected = {k: brute_probability((t or "").encode(), model) for k, (_, t) in enumerate(rows) if not t or len(t) < 5000}
    for slice_bytes in (bytenet.SLICE_BYTES, 256):
        monkeypatch.setattr(bytenet, "SLICE_BYTES", slice_bytes)
        for k, value in expected.items():
            assert abs(bytenet.probability([(rows[k][1] or "").encode()], model)[0] - value) < 1e-5
    assert bytenet.score(docs(*rows), model).count() == len(rows)


def test_network_on_a_very_long_text():
    import subprocess
    import sys
    code = ("import resource, numpy as np; from demandspark.llm import bytenet; from tests.llm.test_documents import some_network;"
            "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss;"
            "bytenet.probability([b'some words of a text. ' * 2_300_000], some_network());"
            "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)")
    grown = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()[-1])
    assert grown < 500


def brute_statistics(text):
    text = text or ""
    w = text.encode().split()
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = Counter(grams)
    cover = {j for k, g in enumerate(grams) if seen[g] > 1 for j in range(k, k + 5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))


def test_outlier_statistics(docs):
    rows = odd_rows() + [(30, "a b c d e a b c d e\n# x |\n# x |\n\n\n"), (31, "a " * 9), (32, "q w e r t y q w e r t q w e r t")]
    got = outliers.statistics(docs(*rows)).collect()
    expected = sorted(((i, *brute_statistics(t)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=str) == expected


def test_outliers_go_and_clean_rows_stay(docs):
    clean = [(k, prose(k, 60 + k % 90) + "\n" + prose(5000 + k, 30)) for k in range(400)]
    odd = [(1000 + k, " ".join(w + "%%%" for w in prose(9000 + k, 80).split())) for k in range(40)]
    frame = docs(*clean, *odd).withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string"))
    kept = {r.doc_id: r.kept for r in outliers.quality_verdicts(frame).collect()}
    assert not any(kept[1000 + k] for k in range(40)) and sum(kept[k] for k in range(400)) >= 392


def brute_determinant(points, core):
    """Exact concentration steps on whole points, from the operator's starts and from many random ones: the smallest determinant."""
    floors, h = np.array(outliers.FLOORS), int(np.ceil(core * len(points)))

    def held(cov):
        lower = np.zeros_like(cov)
        for i in range(5):
            for j in range(i + 1):
                value = cov[i, j] - lower[i, :j] @ lower[j, :j]
                lower[i, j] = np.sqrt(max(value, floors[i] ** 2)) if i == j else value / lower[j, j]
        return lower
    p25, p50, p75 = np.percentile(points, [25, 50, 75], axis=0)
    spread = (p75 - p25) / 1.349
    starts = [(p50, np.diag(spread ** 2)), (points.mean(0), np.cov(points.T, bias=True)), (p25, np.diag(spread ** 2 / 4))]
    draw = np.random.default_rng(1)
    starts += [(s.mean(0), np.cov(s.T, bias=True)) for s in (points[draw.choice(len(points), 12, replace=False)] for _ in range(40))]
    found = []
    for mean, cov in starts:
        for _ in range(30):
            d = (np.linalg.solve(held(cov), (points - mean).T) ** 2).sum(0)
            near = points[np.argsort(d, kind="stable")[:h]]
            mean, cov = near.mean(0), outliers.CORE_FACTOR * np.cov(near.T, bias=True)
        found.append((2 * np.log(np.diag(held(cov))).sum(), mean, held(cov)))
    return min(found, key=lambda f: f[0])


def test_outliers_equal_a_plain_determinant_search(docs):
    """The operator's determinant comes close to the best of a search over all rows, and its verdicts equal that search's."""
    draw = np.random.default_rng(8)
    clean = [(k, prose(k, int(draw.integers(40, 300))) + "\n# " * int(draw.integers(0, 3))) for k in range(500)]
    masked = [(1000 + k, "\n".join(["same line | %"] * 9 + [prose(7000 + k, 60)])) for k in range(90)]  # a second cloud that masks itself
    frame = docs(*clean, *masked).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    stats = outliers.vectors(outliers.statistics(frame)).collect()
    usable = [r for r in stats if r.n_words >= 10 and 100 * r.n_repeat_words <= 20 * r.n_words]
    points = np.array([[r[x] for x in outliers.VECTOR] for r in usable])
    log_det, mean, lower = brute_determinant(points, 0.75)
    for _ in range(1):  # once more from all rows that fit
        near = points[(np.linalg.solve(lower, (points - mean).T) ** 2).sum(0) <= outliers.FITS]
        mean, cov = near.mean(0), np.cov(near.T, bias=True)
    lower = np.zeros((5, 5))
    for i in range(5):
        for j in range(i + 1):
            value = cov[i, j] - lower[i, :j] @ lower[j, :j]
            lower[i, j] = np.sqrt(max(value, outliers.FLOORS[i] ** 2)) if i == j else value / lower[j, j]
    distance = {r.doc_id: d for r, d in zip(usable, (np.linalg.solve(lower, (points - mean).T) ** 2).sum(0), strict=True)}
    rows = outliers._grouped(outliers.vectors(outliers.statistics(frame)).withColumn("base_failed", F.lit(False)), 60)
    usable_ids = rows.where(F.col("doc_id").isin([r.doc_id for r in usable])).select("pool", *outliers.VECTOR)
    best = outliers.smallest_determinants(usable_ids, 0.75, 12).first()
    assert best.log_det <= log_det + 0.1
    got = {r.doc_id: r for r in outliers.quality_verdicts(frame).collect()}
    sure = {i: d for i, d in distance.items() if abs(d / outliers.CUTOFF - 1) > 0.1}  # classes of distance are a sixteenth wide
    assert len(sure) > 0.95 * len(distance) and all(got[i].kept == (d <= outliers.CUTOFF) for i, d in sure.items())
    assert not any(got[1000 + k].kept for k in range(90))


def test_small_groups_count_usable_rows_only(docs):
    rows = [(k, prose(k, 60 + k % 90)) for k in range(40)] + [(100 + k, "few words") for k in range(40)]
    frame = docs(*rows).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    got = outliers.quality_verdicts(frame).collect()  # 80 rows, but 40 to estimate from
    assert all(r.distance is None and r.kept == (r.doc_id < 100) for r in got)
    assert all(r.distance is not None for r in outliers.quality_verdicts(frame, least_rows=40).collect())


def test_outliers_of_odd_rows(docs):
    got = outliers.quality_verdicts(docs(*odd_rows())).collect()
    assert len(got) == len(odd_rows()) and all(r.base_failed != r.kept for r in got)  # too few rows: nothing is estimated
    assert outliers.quality_verdicts(docs((1, "a")).limit(0)).count() == 0


@pytest.fixture
def labelled(docs, spark):
    clean = [(k, prose(k, 80)) for k in range(300)]
    toxic = [(k, " ".join(w if j % 9 else ("slurword", "vileish", "vileous")[j % 3] for j, w in enumerate(prose(k, 80).split(), 1))) for k in range(300, 400)]
    junk = [(k, " ".join(w.upper() + "!!" for w in prose(k, 80).split())) for k in range(400, 520)]
    labels = spark.createDataFrame([(k, int(k < 400), int(300 <= k < 400)) for k in range(520)] + [(9999, None, None)], "doc_id long, quality int, toxic int")
    return docs(*clean, *toxic, *junk, *odd_rows()), labels


def test_toxicity_finds_words(labelled):
    frame, labels = labelled
    got = toxicity.toxicity(frame, labels, bytenet.remainder(3) == 1).collect()
    assert len(got) == frame.count()
    known = [r for r in got if r.doc_id is not None and 20 <= r.doc_id < 520]
    assert all(r.predicted == int(300 <= r.doc_id < 400) for r in known)
    texts = {r.doc_id: r.text for r in frame.collect()}
    for r in known:
        words = {texts[r.doc_id][s.start:s.end] for s in r.spans}
        assert words <= {"slurword", "vileish", "vileous"} and bool(words) == (300 <= r.doc_id < 400)
    assert all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(frame, labels.limit(0), bytenet.remainder(3) == 1).where("predicted = 1").count() == 0
    assert toxicity.toxicity(frame.limit(0), labels, bytenet.remainder(3) == 1).count() == 0


def test_chain_odds_equal_enumeration():
    draw = np.random.default_rng(2)
    model = {"transition": draw.normal(size=(2, 2)), "start": 0.3}
    lengths = np.array([3, 0, 5, 1])
    starts = np.cumsum(lengths) - lengths
    state = draw.normal(size=9)
    forward, backward = toxicity.chain_odds(state, starts, lengths, model)
    got = forward * backward / (1 + forward * backward)
    for a, n in zip(starts, lengths, strict=True):
        mass, on = 0.0, np.zeros(n)
        for code in range(2 ** n if n else 0):
            y = [code >> k & 1 for k in range(n)]
            s = sum(state[a + k] * y[k] for k in range(n)) + model["start"] * y[0] + sum(model["transition"][y[k - 1], y[k]] for k in range(1, n))
            mass, on = mass + np.exp(s), on + np.exp(s) * np.array(y)
        if n:
            assert np.allclose(got[a:a + n], on / mass)


def test_quality_network(labelled):
    frame, labels = labelled
    got = bytenet.quality_scores(frame, labels, bytenet.remainder(4) == 2).collect()
    known = [r for r in got if r.doc_id is not None and 20 <= r.doc_id < 520]
    assert len(got) == frame.count() and all(0 <= r.score <= 1 for r in got)
    held = [r for r in known if r.held_out]
    assert held and np.mean([r.predicted == int(r.doc_id < 400) for r in held]) > 0.95
    assert {r.score for r in bytenet.quality_scores(frame, labels.limit(0), bytenet.remainder(4) == 2).collect()} == {0.5}
    assert bytenet.quality_scores(frame.limit(0), labels, bytenet.remainder(4) == 2).count() == 0


def test_network_gradient():
    draw = np.random.default_rng(0)
    model = {"filters": draw.normal(0, 0.2, (32, 64)), "bias": draw.normal(0, 0.1, 32), "weights": draw.normal(0, 0.5, 64), "offset": 0.1}
    texts, labels = [prose(1, 90).encode(), b"", prose(2, 20).encode(), prose(3, 300).encode()], np.array([1.0, 0.0, 0.0, 1.0])

    def loss(m):
        p = bytenet.probability(texts, m)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))
    found = bytenet._gradients(texts, labels, model)
    for key, spot in (("filters", (3, 5)), ("filters", (7, 40)), ("bias", 4), ("weights", 11), ("weights", 50)):
        up, down = ({**model, key: model[key].copy()} for _ in range(2))
        up[key][spot] += 1e-4
        down[key][spot] -= 1e-4
        assert abs((loss(up) - loss(down)) / 2e-4 - found[key][spot]) < 2e-3


def brute_signatures(text):
    """One spot after the other, from the description: anchors, the start, and words far from any anchor; two content words behind each."""
    words = [w.strip(b".,;:!?\"'()[]|%&$#*") or w for w in text.lower().encode().split()]
    if not words:
        return set()
    hashes = [xxhash.xxh3_64_intdigest(w) & ~1 | (w in spots.ANCHORS) for w in words]
    content = [h for h, w in zip(hashes, words, strict=True) if w not in spots.ANCHORS]
    if len(content) < 2:
        return {xxhash.xxh32_intdigest(b"".join(h.to_bytes(8, "little") for h in hashes))}
    found, met, since = {(0, 0)}, 0, 0
    for h, w in zip(hashes, words, strict=True):
        since += 1
        if w in spots.ANCHORS:
            found.add((h, met))
            since = 0
        else:
            if since > 8:
                found.add((2, met))
            met += 1
    out = set()
    for mark, at in found:
        if at + 2 <= len(content):
            for h in content[at:at + 2]:
                mark = (mark ^ h) * 0x9E3779B97F4A7C15 % 2 ** 64
                mark ^= mark >> 32
            out.add(mark % 2 ** 32)
    return out


def test_signatures_equal_a_plain_walk():
    for text in [t or "" for _, t in odd_rows()] + ["the", "the cat", "a b c the der d e f g h i j k l m n", "der " + prose(3, 300).replace(" a", " the a")]:
        assert set(spots.signatures(text).tolist()) == brute_signatures(text), text[:40]


def test_spot_fingerprints(docs):
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 6] + [(40 + k, "the " + prose(k, 40)) for k in range(10)]
    got = {r.doc_id: r for r in spots.fingerprints(docs(*rows)).collect()}
    ordered = sorted(rows)
    for k, (i, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        changed = text[:len(text) - n] + following[:n]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        a, b = set(spots.signatures(text).tolist()), set(spots.signatures(changed).tolist())
        assert r.near_edited == (len(a & b) / len(a | b) if a | b else 1.0)
        c = brute_signatures(following)
        assert r.near_next == (len(a & c) / len(a | c) if a | c else 1.0)
    assert spots.fingerprints(docs(*odd_rows())).count() == len(odd_rows())
    assert spots.fingerprints(docs((1, "alone here"))).first().near_next == 1.0
    assert spots.fingerprints(docs((1, "a")).limit(0)).count() == 0
