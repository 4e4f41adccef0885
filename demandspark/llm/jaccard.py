"""N-gram Jaccard join by vertical partitioning of the n-gram order.

The set of a document holds its distinct n-grams of lower-cased words. Two documents link when their
Jaccard similarity reaches the threshold; linked documents form components. Steps:

1. *Shared n-grams.* The n-gram hashes are cut into fragments (equal ranges of the hash order). Each task
   asks every fragment which of its n-grams also occur in another text; n-grams that a block of texts
   holds twice are known there and are told once for the block, so a very common n-gram never gathers
   in a fragment. A text whose shared n-grams are too few for the threshold cannot link: it leaves.
2. *Prefixes.* The rest is ordered rarest first. Linked texts share an n-gram within their prefixes.
3. *Stars.* Per prefix n-gram, each text is compared with the one text that has most shared n-grams, not
   with all others: linear in the size of a group of copies.
4. *The rest, exactly.* Texts that share a prefix n-gram and lie in different components are compared,
   unless their sizes or the place of that n-gram already exclude a link.

Overlaps are counted per fragment of the global (frequency, hash) order and summed per pair.
Equal texts are one node throughout and are never expanded into pairs.

Null text, empty text and text without words: an empty set, linked with nothing. Repeated rows and
equal texts share a component. A null id takes part like any other and gets the smallest id of its
component (null if there is none). An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD, blocks, components, fragment_of, hash_windows, hash_words, release, split_words, text_class

FRAGMENT_BYTES = 16 << 20   # text per fragment of step 1; a fragment's n-grams fit in one task
OVERLAP_FRAGMENTS = 8       # fragments of the frequency order for the overlap counts
SALTS = 32                  # tasks that the rows of one id and text are dealt to
_NO_ID = np.iinfo(np.int64).max


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct ``size``-word shingles; a shorter text is one shingle."""
    words = split_words(text.lower()) if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = hash_words(words)
    return np.unique(hash_windows(hashes, min(size, len(words))))


_ASKED = "fragment int, nodes binary, counts binary, asked binary, known binary, own binary"


def _ask(batches: Iterator[pa.RecordBatch], fragments: int, size: int) -> Iterator[pa.RecordBatch]:
    """Per block of rows and fragment: n-grams found once in the block (with their texts), and those found in several."""
    for batch in blocks(batches):
        ids = batch["doc_id"].fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        nodes, first, which = np.unique(batch["node"].to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
        least = np.full(len(nodes), _NO_ID)
        np.minimum.at(least, which, ids)
        column = batch["text"]
        sets = [shingle_set(column[int(i)].as_py(), size) for i in first]
        lengths = np.fromiter(map(len, sets), np.int64, len(sets))
        hashes = np.concatenate([np.empty(0, np.uint64), *sets])
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), lengths)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        same = ranked[1:] == ranked[:-1]
        several = np.zeros(len(ranked), bool)
        several[1:] |= same
        several[:-1] |= same
        known = np.unique(ranked[several])
        mark = np.empty(len(ranked), bool)
        mark[order] = several
        n_known = np.bincount(owner[mark], minlength=len(sets))
        hashes, owner = hashes[~mark], owner[~mark]
        part = fragment_of(hashes, fragments)
        order = np.argsort(part, kind="stable")  # by fragment, then by text
        hashes, owner, part = hashes[order], owner[order], part[order]
        known_part = fragment_of(known, fragments)
        own_part = fragment_of(nodes.view(np.uint64), fragments)
        own_order = np.argsort(own_part, kind="stable")
        mine = own_part[own_order]
        present = np.unique(np.concatenate([part, known_part, mine]))
        asked_at, known_at, own_at = ([np.searchsorted(x, present, side).tolist() for side in ("left", "right")] for x in (part, known_part, mine))
        rows = []
        for k, f in enumerate(present.tolist()):
            a, b = asked_at[0][k], asked_at[1][k]
            o = own_order[own_at[0][k]:own_at[1][k]]
            cut = np.flatnonzero(np.diff(owner[a:b], prepend=-1))
            rows.append((f, nodes[owner[a:b][cut]].tobytes(), np.diff(cut, append=b - a).astype(np.int32).tobytes(),
                         hashes[a:b].tobytes(), known[known_at[0][k]:known_at[1][k]].tobytes(),
                         np.stack([nodes[o], least[o], lengths[o], n_known[o]]).astype(np.int64).tobytes()))
        names, kinds = ["fragment", "nodes", "counts", "asked", "known", "own"], [pa.int32()] + [pa.binary()] * 5
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


def _decide(batches: Iterator[pa.RecordBatch], fragments: int) -> Iterator[pa.RecordBatch]:
    """One fragment: how many of the asked n-grams of each text occur in another text, gathered by the texts' home fragments."""
    release()
    asked, nodes, known, own = [], [], [], []
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("nodes", "counts", "asked", "known", "own")), strict=True):
            nodes.append(np.repeat(np.frombuffer(row[0], np.int64), np.frombuffer(row[1], np.int32)))
            asked.append(np.frombuffer(row[2], np.uint64))
            known.append(np.frombuffer(row[3], np.uint64))
            own.append(np.frombuffer(row[4], np.int64).reshape(4, -1))
    if not own:
        return
    node, hashes, told = np.concatenate(nodes), np.concatenate(asked), np.unique(np.concatenate(known))
    del nodes, asked, known, batch, row
    order = np.argsort(hashes)
    ranked = hashes[order]
    del hashes
    owner = node[order]
    del node, order
    shared = np.zeros(len(ranked), bool)
    if len(ranked):
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        differ = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
        if len(told):
            at = np.minimum(np.searchsorted(told, ranked[starts]), len(told) - 1)
            differ |= told[at] == ranked[starts]
        shared = np.repeat(differ, np.diff(starts, append=len(ranked)))
    found, counts = np.unique(owner[shared], return_counts=True)
    mine = np.concatenate(own, axis=1)
    rows = np.concatenate([mine, np.stack([found, np.full(len(found), _NO_ID), np.zeros(len(found), np.int64), counts])], axis=1)
    home = fragment_of(rows[0].copy().view(np.uint64), fragments)
    order = np.argsort(home, kind="stable")
    rows, home = rows[:, order], home[order]
    homes, at = np.unique(home, return_index=True)
    parts = [p.tobytes() for p in np.split(rows, at[1:], axis=1)] if len(homes) else []
    del ranked, owner, shared
    yield pa.RecordBatch.from_arrays([pa.array(homes.astype(np.int32)), pa.array(parts, pa.binary())], ["home", "texts"])
    release()


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One home: a row per text with its smallest id, its number of n-grams and how many of them are shared."""
    parts = [np.frombuffer(p, np.int64).reshape(4, -1) for batch in batches for p in batch["texts"].to_pylist()]
    if not parts:
        return
    node, ids, n, shared = np.concatenate(parts, axis=1)
    nodes, which = np.unique(node, return_inverse=True)
    least, size = np.full(len(nodes), _NO_ID), np.zeros(len(nodes), np.int64)
    np.minimum.at(least, which, ids)
    np.maximum.at(size, which, n)
    total = np.bincount(which, shared, len(nodes)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least, mask=least == _NO_ID), pa.array(size), pa.array(total)],
                                     ["node", "doc_id", "n", "shared"])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        sets = [shingle_set(text, size).view(np.int64) for text in batch["text"].to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        grams = pa.LargeListArray.from_arrays(offsets, np.concatenate([np.empty(0, np.int64), *sets])).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch["node"], grams], ["node", "grams"])


def _least_overlap(n: Column, threshold: int) -> Column:
    """The fewest n-grams a text of ``n`` must share with one linked to it."""
    return F.ceil(n * threshold / 100.0 - 1e-9)


def _shared_only(postings: DataFrame, threshold: int) -> DataFrame:
    """(node, n, s, grams): n-grams of at least two texts, rarest first; texts with too few of them leave."""
    df = postings.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    grouped = (postings.join(df, "gram").groupBy("node").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("grams")))
    return (grouped.withColumn("s", F.size("grams").cast("long"))
            .where(F.col("s") >= _least_overlap(F.col("n"), threshold)))


def _possible(a: str, b: str, threshold: int) -> Column:
    """Whether sizes and numbers of shared n-grams allow a link."""
    n_a, n_b, s_a, s_b = (F.col(f"{x}.{c}") for c in "ns" for x in (a, b))
    need = F.ceil((n_a + n_b) * threshold / (100.0 + threshold) - 1e-9)
    return (F.least("%s.s" % a, "%s.s" % b) >= need) & (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * threshold)


def _linked(pairs: DataFrame, segments: DataFrame, sizes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that link: overlaps counted fragment by fragment, then summed."""
    left = segments.select(F.col("node").alias("a"), "part", F.col("grams").alias("grams_a"))
    right = segments.select(F.col("node").alias("b"), "part", F.col("grams").alias("grams_b"))
    part = (pairs.join(left, "a").join(right, ["b", "part"])
            .select("a", "b", F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap")))
    total = part.groupBy("a", "b").agg(F.sum("overlap").alias("overlap"))
    n_a = sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a"))
    n_b = sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b"))
    return (total.join(n_a, "a").join(n_b, "b")
            .where(F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * threshold)
            .select("a", "b"))


def _segments(sets: DataFrame) -> DataFrame:
    """The n-grams of each text by fragment of the global (frequency, hash) order."""
    rank = lambda g: g["df"].cast("double") * 2.0 ** 32 + F.shiftrightunsigned(g["gram"], 32).cast("double")
    cuts = [k / OVERLAP_FRAGMENTS for k in range(1, OVERLAP_FRAGMENTS)]
    found = sets.select(F.explode("grams").alias("g")).agg(F.percentile_approx(rank(F.col("g")), cuts, 10_000)).first()[0] or []
    part = lambda g: sum((F.when(rank(g) >= F.lit(cut), 1).otherwise(0) for cut in found), F.lit(0))
    split = sets.select("node", F.transform("grams", lambda g: F.struct(part(g).alias("part"), g["gram"].alias("gram"))).alias("grams"))
    return (split.select("node", F.explode(F.sequence(F.lit(0), F.lit(len(found)))).alias("part"), "grams")
            .select("node", "part", F.transform(F.filter("grams", lambda g: g["part"] == F.col("part")), lambda g: g["gram"]).alias("grams"))
            .where(F.size("grams") > 0))


def _find_links(sets: DataFrame, threshold: int) -> DataFrame:
    """(node, component) of all texts that link with another one."""
    sets = materialize(sets, "ngram-sets")
    sizes = sets.select("node", "n", "s")
    segments = materialize(_segments(sets), "ngram-segments")
    prefix = (F.col("s") - _least_overlap(F.col("n"), threshold) + 1).cast("int")
    postings = materialize(sets.select("node", "n", "s", F.posexplode(F.slice("grams", F.lit(1), prefix)).alias("at", "g"))
                           .select("node", "n", "s", "at", F.col("g.gram").alias("gram")), "ngram-prefixes")
    hubs = (postings.groupBy("gram").agg(F.min(F.struct((F.col("n") - F.col("s")).alias("rare"), "node", "n", "s")).alias("hub"))
            .select("gram", "hub.node", "hub.n", "hub.s"))
    stars = (postings.alias("p").join(hubs.alias("h"), "gram")
             .where((F.col("p.node") != F.col("h.node")) & _possible("p", "h", threshold))
             .select(F.least("p.node", "h.node").alias("a"), F.greatest("p.node", "h.node").alias("b")).distinct())
    links = materialize(_linked(stars, segments, sizes, threshold), "ngram-stars")
    labels = materialize(components(links), "ngram-labels")

    placed = (postings.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")))
    open_grams = (placed.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("gram"))
    placed = materialize(placed.join(open_grams, "gram"), "ngram-open")
    ahead = F.least(F.col("p.s") - F.col("p.at"), F.col("q.s") - F.col("q.at"))  # overlap if this is the first n-gram in common
    need = F.ceil((F.col("p.n") + F.col("q.n")) * threshold / (100.0 + threshold) - 1e-9)
    rest = (placed.alias("p").join(placed.alias("q"), (F.col("p.gram") == F.col("q.gram")) & (F.col("p.node") < F.col("q.node"))
                                   & (F.col("p.component") != F.col("q.component")) & _possible("p", "q", threshold) & (ahead >= need))
            .select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct())
    more = materialize(_linked(rest, segments, sizes, threshold), "ngram-rest")
    if more.isEmpty():
        return labels
    return components(links.union(more))


def _named_texts(docs: DataFrame, size: int, threshold: int, fragment_bytes: int) -> DataFrame:
    """(node, n, first_id, component) per distinct text of ``docs`` (doc_id, text, node): its smallest id, and the node that names its component."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = max(1, -(-total // fragment_bytes))
    rows = docs.select("doc_id", "node", F.col("text").cast("binary").alias("text"))
    asked = rows.where("node is not null").mapInArrow(partial(_ask, fragments=fragments, size=size), _ASKED)
    answers = asked.repartitionById(fragments, F.col("fragment")).mapInArrow(partial(_decide, fragments=fragments), "home int, texts binary")
    counted = answers.repartitionById(fragments, F.col("home")).mapInArrow(_total, "node long, doc_id long, n long, shared long")
    texts = materialize(counted.withColumnRenamed("doc_id", "first_id"), "ngram-texts")

    near = texts.where((F.col("n") > 0) & (F.col("shared") >= _least_overlap(F.col("n"), threshold))).select("node", "n", "first_id")
    kept = (rows.join(near.select("node", "first_id"), (rows.node == near.node) & rows.doc_id.eqNullSafe(near.first_id), "left_semi"))
    grams = kept.mapInArrow(partial(_sets, size=size), "node long, grams array<long>").dropDuplicates(["node"])
    grams = materialize(grams, "ngram-near")
    flat = grams.select("node", F.size("grams").cast("long").alias("n"), F.explode("grams").alias("gram"))
    sets = _shared_only(flat, threshold)
    sets = _shared_only(materialize(sets, "ngram-shared").select("node", "n", F.explode("grams").alias("g")).select("node", "n", "g.gram"), threshold)
    labels = _find_links(sets, threshold)

    named = texts.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return materialize(named.select("node", "n", "first_id", "component"), "ngram-named")


def similar_components(docs: DataFrame, size: int = 5, threshold: int = 80, id_column: str = "doc_id",
                       text_column: str = "text", fragment_bytes: int = FRAGMENT_BYTES) -> DataFrame:
    """Per row: id, ``n_shingles`` and ``component_id``, the smallest id reachable over links (``threshold`` percent).

    A task of step 1 holds the n-grams of ``fragment_bytes`` of text; with large executors larger fragments mean fewer partitions.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), text_class(text_column).alias("node"))
    named = _named_texts(docs, size, threshold, fragment_bytes)
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_text = named.join(least, "component").select("node", "n", "component_id")
    return (docs.select("doc_id", "node").join(by_text, "node", "left")
            .select("doc_id", F.coalesce("n", F.lit(0)).alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def one_per_component(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """One row of each component, with all its columns: that with the smallest id; one without an id only if none has one.

    Components are told apart by their texts, so unrelated texts under one id all stay, and of linked ones under one id one
    stays. Rows without words link with nothing: they stay, repeated rows (equal id and text) once if they have an id.
    Of rows equal in id and text the one whose other columns come first stays.
    """
    words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    single = F.col("doc_id").isNotNull() | words  # the others stay as they are
    pair = [F.col("doc_id").cast("long").alias("_id"), text_class().alias("_node")]
    named = _named_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_class().alias("node")), size, threshold, FRAGMENT_BYTES)
    first = (named.where("n > 0").groupBy("component").agg(F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "node")).alias("c"))
             .select(F.col("c.first_id").alias("_id"), F.col("c.node").alias("_node")))
    pairs = docs.where(single).select(*pair, words.alias("_words")).groupBy("_id", "_node", "_words").agg(F.count("*").alias("_rows"))
    chosen = pairs.where("_words").join(first, pairs["_id"].eqNullSafe(first["_id"]) & (pairs["_node"] == first["_node"]), "left_semi")
    chosen = materialize(chosen.union(pairs.where("not _words")).select("_id", "_node", "_rows"), "ngram-chosen")
    rows = docs.where(single).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *pair,
                                     F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt"))

    def same(other: DataFrame) -> Column:
        return rows["_id"].eqNullSafe(other["_id"]) & rows["_node"].eqNullSafe(other["_node"])
    once, again = chosen.where("_rows = 1"), chosen.where("_rows > 1")
    kept = rows.join(once, same(once), "left_semi").select("row.*").union(docs.where(~single))
    if again.isEmpty():
        return kept
    again = again.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))  # a pair may have very many rows
    others = F.to_json(F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != "text"]))
    repeated = rows.join(again, same(again) & (rows["_salt"] == again["_salt"]), "left_semi")
    return kept.union(repeated.groupBy("_id", "_node").agg(F.min_by("row", others).alias("row")).select("row.*"))
