"""Importance resampling, MinHash near duplicates and conversation repair against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from demandspark.llm import dsir, minhash, structure

from .conftest import odd_rows, prose
from .test_pairs import brute_components, near_copies

SMALL = "/root/testdata/sf0.001"


def brute_features(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute_resample(rows, target, percent=25, least=20):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(brute_features(text)[1])
    for text in target:
        t.update(brute_features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    out, able = [], []
    for i, text in rows:
        n, buckets = brute_features(text)
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        able += [(-score, i is None, i, len(out))] if n >= least else []
        out.append([i, len(buckets), weight, score, None])
    for rank, (*_, k) in enumerate(sorted(able, key=lambda a: (a[0], a[1], a[2] or 0, a[3]))[:percent * len(able) // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=str)


def test_resample_equals_brute_force(spark, docs):
    rows = [(k, prose(k % 30, 5 + k % 40)) for k in range(300)] + odd_rows()[:-2] + [(400, "w" * 200 + " Ab" + " zz" * 30), (401, "é É-x 9" * 9)]
    target = [prose(k, 30) for k in range(5)] + [None, ""]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string")
    got = sorted(map(tuple, dsir.resample(docs(*rows), bench).collect()), key=str)
    assert got == brute_resample(rows, target)


def test_resample_of_given_tables(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = sorted(map(tuple, dsir.resample(documents, bench).collect()), key=str)
    assert got == brute_resample(rows, [r.text for r in bench.collect()])


def test_resample_ties_and_empty_tables(spark, docs):
    same = prose(3, 40)
    rows = [(None, same)] * 30 + [(5, same)] * 30
    got = dsir.resample(docs(*rows), spark.createDataFrame([(same,)], "text string")).collect()
    drawn = sorted(r["rank"] for r in got if r["rank"])
    assert len(got) == 60 and drawn == list(range(1, 16)) and len({r.doc_id for r in got if r["rank"]}) == 1
    empty = docs(*rows).limit(0)
    assert dsir.resample(empty, spark.createDataFrame([], "text string")).count() == 0


def test_features_in_pieces(monkeypatch):
    text = "one Two-three " + "x" * 90 + " four " * 50 + "y" * 70
    whole = [(o.tolist(), b.tolist()) for o, b, _ in dsir.features([None, text.encode(), b"", b"a b"], 10_000)]
    monkeypatch.setattr(dsir, "PIECE", 40)
    pieces = list(dsir.features([None, text.encode(), b"", b"a b"], 10_000))
    assert Counter(zip(*whole[0])) == Counter((int(a), int(b)) for o, bs, _ in pieces for a, b in zip(o, bs))
    assert len(pieces) > 3 and sum(len(w) for *_, w in pieces) == brute_features(text)[0] + 2


@pytest.mark.parametrize("wanted", [0, 1, 7, 40, 100])
def test_highest_is_exact(spark, wanted):
    rows = spark.range(100).select((F.col("id") % 7 * 1000 - 3000).alias("a"), (F.col("id") % 5).alias("b"), "id")
    keys = [F.col("a"), F.bitwise_not("b"), F.bitwise_not("id")]
    got = {r.id for r in rows.where(dsir.highest(rows, keys, wanted)).collect()}
    assert got == set(sorted(range(100), key=lambda k: (-(k % 7), k % 5, k))[:wanted])


def test_minhash_equals_brute_force(docs):
    for rows in (near_copies(), odd_rows()):
        expected = [(*r, r[0] == r[2]) for r in brute_components(rows, threshold=85)]
        got = sorted(map(tuple, minhash.near_duplicates(docs(*rows), threshold=85).collect()), key=str)
        assert got == expected
    assert minhash.near_duplicates(docs(*rows).limit(0)).count() == 0


def test_minhash_chains_and_passages(docs):
    """Chains whose ends do not link, and a long passage that many texts of all sizes share."""
    words = prose(8, 400).split()
    chain = [" ".join(words[k * 10:k * 10 + 200]) for k in range(20)]
    passage = prose(9, 120)
    rows = [(k, t) for k, t in enumerate(chain)] + [(100 + k, passage + " " + prose(300 + k, 3 + k)) for k in range(60)]
    random.Random(1).shuffle(rows)
    got = sorted(map(tuple, minhash.near_duplicates(docs(*rows), threshold=85).collect()), key=str)
    assert got == [(*r, r[0] == r[2]) for r in brute_components(rows, threshold=85)]


def test_signatures_are_minima_of_whole_sets():
    sets = [minhash.shingles(prose(k, n).encode(), 5) for k, n in enumerate((1, 5, 40, 3000, 9))]
    a, b = minhash._functions(12)
    for got, s in zip(minhash.minima(sets, 12).tolist(), sets):
        folded = [(int(x) ^ int(x) >> 32) & 0xFFFFFFFF for x in s]
        assert got == [min((int(p) * x + int(q)) % 2 ** 64 >> 32 for x in folded) for p, q in zip(a, b)]


def test_one_shared_band_is_enough_for_a_bucket(docs):
    got = minhash.near_duplicates(docs((3, "A b  c d e f"), (2, "a B c d\te f"), (9, "a b c"), (None, "A b c")), threshold=85).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(3, 2, 2, False), (2, 2, 2, True), (9, 1, 9, True), (None, 1, 9, False)}


NEXT = {"0": "u", "s": "u", "u": "a", "a": "u"}


def brute_repair(rows):
    """Cheapest edits with the least string, by trying all of them with a memory; rows are (role, text, must go, open end)."""
    memory = {}

    def best(k, state, inserts):
        if (k, state, inserts) in memory:
            return memory[k, state, inserts]
        found = []
        if k == len(rows) and state in "0a":
            found.append((0, "", ()))
        if inserts < 3:
            c, e, t = best(k, NEXT[state], inserts + 1)
            found.append((c + 2, "I" + e, (("user" if NEXT[state] == "u" else "assistant", ""), *t)))
        if k < len(rows):
            role, text, gone, open_end = rows[k]
            c, e, t = best(k + 1, state, 0)
            found.append((c + 3, "D" + e, t))
            if not gone:
                if role[:1] == NEXT[state] or (state == "0" and role[:1] == "s"):
                    c, e, t = best(k + 1, role[:1], 0)
                    found.append((c + open_end, "K" + e, ((role, text), *t)))
                c, e, t = best(k + 1, NEXT[state], 0)
                found.append((c + 2 + open_end, "R" + e, (("user" if NEXT[state] == "u" else "assistant", text), *t)))
        memory[k, state, inserts] = min(found, default=(10 ** 9, "", ()))
        return memory[k, state, inserts]
    return best(0, "0", 0)


def brute_report(conversations):
    out = []
    for conv in dict.fromkeys(r[0] for r in conversations):
        rows = []
        for _, turn, role, text in [r for r in conversations if r[0] == conv]:
            role, text = " " if role is None else role, " " if text is None else text
            fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            rows += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        turns = {r[0] for r in rows if r[0] is not None}
        counts, seen, marked = Counter(), set(), []
        for _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = brute_repair(marked)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()))
    return sorted(out, key=str)


CONVERSATION = "conv_id long, turn long, role string, text string, g int, key string, audit string"


def made_conversations(seed, count, longest):
    draw, rows = random.Random(seed), []
    for conv in [*range(count), None]:
        for turn in range(draw.randint(0, longest)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ustad"])
            text = draw.choice(["Yes.", "No!", "cut off", "", " \t", None, "Why? ", "a.b", prose(turn, 4) + "."])
            rows.append((conv, draw.choice([turn, turn + 2, turn, turn, None]), role, text))
    return rows


@pytest.mark.parametrize("segment", [structure.SEGMENT, 5, 1])
def test_repair_equals_brute_force(spark, segment):
    rows = made_conversations(segment, 60, 14)
    table = spark.createDataFrame([(*r, 1, "k", "a") for r in rows], CONVERSATION).repartition(5)
    got = sorted(map(tuple, structure.damaged_and_repaired(table, segment).collect()), key=str)
    assert got == brute_report(rows)


def test_repair_of_given_tables(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, structure.damaged_and_repaired(table, 64).collect()), key=str)
    assert got == brute_report(rows)


def test_repair_of_one_long_conversation(spark):
    rows = [(1, k, ("user", "assistant", "system")[k * k % 3], f"{k % 50}.") for k in range(200)]
    table = spark.createDataFrame([(*r, 1, "k", "a") for r in rows], CONVERSATION).repartition(4)
    got = sorted(map(tuple, structure.damaged_and_repaired(table, 20).collect()), key=str)
    assert got == brute_report(rows)
    assert structure.damaged_and_repaired(table.limit(0)).count() == 0


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Still there?"), (2, 0, "assistant", "Well.")]
    placed = structure.placed_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    audits = structure.edits(structure.faults(placed))
    got = structure.repaired(placed, audits).orderBy("key", "g", "nth").collect()
    assert {(r.key, r.audit, r.cost) for r in audits.collect()} == {("=1", "KR", 2), ("=2", "IK", 2)}
    assert [(r.key, r.edit, r.role, r.text) for r in got] == [
        ("=1", "Keep", "user", "Hi."), ("=1", "Rerole", "assistant", "Still there?"),
        ("=2", "Insert", "user", ""), ("=2", "Keep", "assistant", "Well.")]
    assert [k for k, _ in groupby(r.key for r in got)] == ["=1", "=2"]
