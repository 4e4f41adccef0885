"""N-gram join and substring dedup against brute force."""

import hashlib
import itertools
import random
from collections import Counter

from demandspark.llm import common, jaccard, spots, substrings

from .conftest import odd_rows, prose


def brute_components(rows, size=5, threshold=80):
    def grams(text):
        w = text.encode().lower().split() if text else []
        return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    sets = [grams(t) for _, t in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[k] and rows[j][0] is not None]
        out.append((i, len(sets[k]), (min(ids) if ids else None) if sets[k] else i))
    return sorted(out, key=str)


def near_copies():
    draw, rows = random.Random(3), []
    for family in range(4):
        base = prose(100 + family, 120).split()
        for _ in range(30):
            copy = list(base)
            for _ in range(draw.randint(0, 8)):
                copy[draw.randrange(len(copy))] = "edit%d" % draw.randrange(10**6)
            rows.append((1000 - len(rows), " ".join(copy)))
    return rows + [(2000 + k, prose(500 + k, 40)) for k in range(20)] + [(3000, rows[0][1].upper()), (3001, rows[5][1])]


def test_components_equal_brute_force(docs):
    rows = near_copies()
    got = sorted(map(tuple, jaccard.similar_components(docs(*rows)).collect()), key=str)
    assert got == brute_components(rows)


def test_many_fragments(docs):
    rows = near_copies() + odd_rows()
    got = sorted(map(tuple, jaccard.similar_components(docs(*rows), fragment_bytes=3000).collect()), key=str)
    assert got == brute_components(rows)
    rows = shared_passages() + odd_rows()
    got = substrings.remove_repeats(docs(*rows), fragment_windows=500).select("rest.doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute_repeats(rows, 35)


def test_components_of_odd_rows(docs, spark):
    rows = odd_rows()
    got = sorted(map(tuple, jaccard.similar_components(docs(*rows)).collect()), key=str)
    assert got == brute_components(rows)
    assert jaccard.similar_components(docs(*rows).limit(0)).count() == 0


def test_one_per_component(docs):
    rows = [(1, prose(1, 50)), (2, prose(1, 50)), (2, prose(1, 50)), (3, prose(2, 50)), (3, prose(2, 50)), (None, prose(4, 9)), (None, None)]
    kept = jaccard.one_per_component(docs(*rows))
    assert kept.columns == docs(*rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, None, None]


def check_one_per_component(docs, rows):
    """Against brute force: one row of each group of linked rows, with its smallest id; wordless rows stay."""
    texts = sorted({t for _, t in rows if t and t.split()})
    group = {t: c for t, (_, _, c) in zip(texts, sorted(brute_components(list(enumerate(texts)))), strict=True)}
    members, expected = {}, Counter()
    for i, t in rows:
        if t in group:
            members.setdefault(group[t], []).append((i, t))
        else:
            expected[i, t] = 1 if i is not None else expected[i, t] + 1
    kept = Counter((r.doc_id, r.text) for r in jaccard.one_per_component(docs(*rows)).collect())
    for rows_of_one in members.values():
        ids = [i for i, _ in rows_of_one if i is not None]
        stay = [(i, t) for i, t in kept.elements() if (i, t) in rows_of_one and t in group]
        assert len(stay) == 1 and stay[0][0] == (min(ids) if ids else None)
        expected[stay[0]] += 1
    assert kept == expected


def test_one_per_component_with_null_and_repeated_ids(docs):
    a, near = prose(1, 50), prose(1, 50) + " end"
    check_one_per_component(docs, [(None, prose(4, 50)), (1, a), (None, near), (None, a)])       # a null id linked with an id goes
    check_one_per_component(docs, [(None, a), (None, near), (None, near), (None, prose(3, 50))])  # near copies without ids
    check_one_per_component(docs, [(5, prose(6, 50)), (5, prose(7, 50)), (8, prose(6, 50))])      # unrelated texts under one id
    check_one_per_component(docs, [(5, a), (5, prose(7, 50)), (2, near), (5, near)])              # one of them linked with a smaller id
    draw = random.Random(7)
    check_one_per_component(docs, [(draw.choice([None, None, i, i % 40]), t) for i, t in near_copies()] + odd_rows() + [(2, ""), (2, " "), (None, None), (None, "")])


def test_star_and_chain_components(spark):
    edges = [(0, k) for k in range(1, 200)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    found = dict(common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {found[k] for k in range(200)} == {0} and {found[k] for k in range(1000, 1061)} == {1000}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = {j for k in range(len(w) - window + 1) if seen[tuple(w[k:k + window])] > 1 for j in range(k, k + window)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def shared_passages():
    draw, rows = random.Random(9), []
    passages = [prose(40 + k, 34 + k) for k in range(8)]
    for k in range(60):
        parts = [prose(1000 + k, draw.randint(1, 60)), draw.choice(passages), prose(2000 + k, draw.randint(0, 40)), draw.choice(passages), draw.choice(passages)]
        rows.append((k, "\n".join(draw.sample(parts, draw.randint(1, 5)))))
    return rows + [(100, "x " * 90), (101, "x " * 40 + "y " * 40), (102, prose(77, 35)), (103, "tail " + prose(77, 35))]


def test_repeats_equal_brute_force(docs):
    for rows in (shared_passages(), odd_rows()):
        got = substrings.remove_repeats(docs(*rows)).select("rest.doc_id", "n_words", "n_removed", "kept_sha256")
        assert sorted(map(tuple, got.collect()), key=str) == brute_repeats(rows, 35)
    assert substrings.remove_repeats(docs((1, "a")).limit(0)).count() == 0


def test_kept_text_and_factors(docs):
    passage = prose(5, 40)
    rows = [(1, "first  words\n" + passage + "\nlast"), (2, passage + " other"), (3, "nothing\there ")]
    got = {r.rest.doc_id: r for r in substrings.remove_repeats(docs(*rows), keep_text=True).collect()}
    assert got[1].kept_text == "first  words\nlast" and got[3].kept_text == "nothing\there "
    assert [(f.start, f.words, f.ref_start) for f in got[1].factors] == [(2, 40, 0)] and got[2].n_removed == 40


def test_spot_near_duplicates(docs):
    base = ("the " + prose(8, 3) + " of ") * 30 + prose(9, 200)
    rows = [(3, base), (2, base + " end"), (1, prose(10, 200)), (4, base), (None, None), (5, "")]
    got = {r.doc_id: r.component_id for r in spots.near_duplicates(docs(*rows)).collect()}
    assert got == {3: 2, 2: 2, 4: 2, 1: 1, None: None, 5: 5}
