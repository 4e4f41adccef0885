"""Structure repair of conversations: cheapest edits by a cost table, the least edit string by prefix doubling.

The rows of a conversation, in the order of their turns, become a sequence ``(s?(ua)+)?`` of roles by edits: Keep (0),
Rerole to user or assistant (2), Delete (3; required for blank and repeated rows) and Insert of an empty user or
assistant row (2); an undeleted truncated row costs 1 more. Of the cheapest edits those with the ASCII-least string
of initials (the audit) are taken.

1. *Order.* Rows get a position in (conversation, turn, role, text) by range partitions, and are cut into segments of
   ``SEGMENT`` positions; a conversation of any length is spread over as many tasks as it has segments.
2. *Costs.* A segment is a 4 x 4 table: the cheapest way from each state (nothing yet, after s, after u, after a) to
   each. The tables of a conversation, one per segment, are combined from its end; each segment then knows what
   remains to be paid behind it, and its own costs to the end follow row by row.
3. *Audit.* Nodes are (row, state); only arcs on a cheapest path stay, and each letter leaves a node by one arc at most.
   Nodes are ranked by their least audit of 1, 2, 4, ... letters: the rank of twice the length is the pair of
   the node's rank and the rank of the node its pointer leads to; pointers double alike. Ranks choose the arc,
   and the doubled pointers give all nodes of the least path at once.

Null conversations form one conversation, null turns come first, other nulls are one space. Rows of one turn come in
the order of role and hash of the text. Repeated rows are rows (duplicates of each other). Empty and very long texts
need nothing special. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.indexing import with_row_index
from ..session import materialize
from .common import WORD, blocks, release

SEGMENT = 4096          # rows of a segment
BLOCK_ROWS = 1 << 17    # rows whose nodes a task holds at a time
_SPACES = " \t\n\x0b\x0c\r"
_DELETE, _INSERT, _KEEP, _REROLE = range(4)
_LETTERS = np.frombuffer(b"DIKR", np.uint8)
_NEVER = np.int64(1) << 40
# The state after the role of a state's only continuation; states are start, after s, after u, after a.
_NEXT = np.array([2, 2, 3, 2])
_STEP = {0: {0: 1, 1: 2}, 1: {1: 2}, 2: {2: 3}, 3: {1: 2}}  # state -> class of the row's role (s, u, a) -> state
_KEPT = np.array([[_STEP[s].get(c, -1) for c in range(4)] for s in range(4)])
_MUST_GO, _OPEN_END = 4, 8  # flags of a row's code beside its class


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with faults planted by a hash of conversation and turn; columns conv_id, turn, role, text, copy.

    Of twenty hash values 0 drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    spoken = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(spoken("conv_id"), F.lit(":"), spoken("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", spoken("role").alias("role"), spoken("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(copies).alias("copy"))


def _key(conv: str = "conv_id") -> Column:
    """A conversation's name that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))


def placed_rows(rows: DataFrame) -> DataFrame:
    """(key, g, turn, role, text): rows with their position in (conversation, turn, role, text); hot ties are split."""
    told = (F.md5(F.col("text").cast("binary")), F.monotonically_increasing_id())
    rows = rows.select(_key().alias("key"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumn("_text", told[0]).withColumn("_row", told[1])
    return with_row_index(rows, ["key", "turn", "role", "_text", "_row"], "g").drop("_text", "_row")


def faults(rows: DataFrame) -> DataFrame:
    """(key, g, turn, initial, fault): the first fault of each row of ``placed_rows``, null if it has none."""
    same = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    ended = F.substring(F.rtrim("text", F.lit(_SPACES)), -1, 1).isin(".", "!", "?")
    slim = rows.select("key", "g", "turn", F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(WORD)).alias("blank"),
                       (~ended).alias("open_end"), same.alias("said"))
    slim = materialize(slim, "structure-marks")
    firsts = (slim.where("not blank").groupBy("key", "said").agg(F.min("g").alias("first"), F.count("*").alias("times")).where("times > 1")
              .select("key", "said", "first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("g") > F.col("first"), "duplicate").when(F.col("open_end"), "truncated")
    return slim.join(firsts, ["key", "said"], "left").select("key", "g", "turn", "initial", fault.alias("fault"))


def segments(marks: DataFrame, segment: int) -> DataFrame:
    """(key, seg, codes, first, last): one byte per row of a segment, in order, and whether the conversation starts and ends in it."""
    code = (F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
            + F.when(F.col("fault").isin("blank", "duplicate"), _MUST_GO).when(F.col("fault") == "truncated", _OPEN_END).otherwise(0))
    seg = F.expr(f"(g - 1) div {segment}")
    coded = marks.select("key", "g", seg.alias("seg"), F.lpad(F.hex(code), 2, "0").alias("code"))
    cut = coded.groupBy("key", "seg").agg(F.array_sort(F.collect_list(F.struct("g", "code"))).alias("rows"))
    cut = cut.select("key", "seg", F.unhex(F.concat_ws("", F.transform("rows", lambda r: r["code"]))).alias("codes"))
    ends = coded.groupBy("key").agg(F.min("seg").alias("lowest"), F.max("seg").alias("highest"))
    return materialize(cut.join(ends, "key").select("key", "seg", "codes", (F.col("seg") == F.col("lowest")).alias("first"),
                                                    (F.col("seg") == F.col("highest")).alias("last")), "structure-segments")


class _Table:
    """Costs to the end of every (row, state) of a block of segments; rows of all segments are worked through together."""

    def __init__(self, codes: list[bytes], after: np.ndarray, last: np.ndarray):
        self.sizes = np.array([len(c) for c in codes], np.int64)
        self.starts = np.cumsum(self.sizes + 1) - (self.sizes + 1)  # a segment of n rows has n + 1 places
        flat = np.zeros(int((self.sizes + 1).sum()), np.uint8)
        self.is_row = np.ones(len(flat), bool)
        self.is_row[self.starts + self.sizes] = False
        flat[self.is_row] = np.frombuffer(b"".join(codes), np.uint8)
        self.kind, self.must_go, self.extra = flat & 3, (flat & _MUST_GO) > 0, np.where(flat & _OPEN_END, 1, 0)
        self.last = last
        self.cost = np.full((len(flat), 4), _NEVER, np.int64)
        ends = self.starts + self.sizes
        self.cost[ends] = after
        self.cost[ends[last]] = self._with_inserts(after[last])
        order = np.argsort(-self.sizes, kind="stable")
        longest = -self.sizes[order]
        for back in range(1, int(self.sizes.max(initial=0)) + 1):
            active = order[:np.searchsorted(longest, -back, "right")]
            at = ends[active] - back
            self.cost[at] = self._with_inserts(np.minimum.reduce(self._row_arcs(at)[0]))

    @staticmethod
    def _with_inserts(cost: np.ndarray) -> np.ndarray:
        for _ in range(3):  # two inserts in a row are the most that can help
            cost = np.minimum(cost, cost[:, _NEXT] + 2)
        return cost

    def _row_arcs(self, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Costs over Delete, Keep and Rerole from the places ``at``, and the state behind Keep (-1: not possible)."""
        behind, fixed = self.cost[at + 1], (self.extra[at] + np.where(self.must_go[at], _NEVER, 0))[:, None]
        kept = _KEPT.T[self.kind[at]]
        keep = np.where(kept >= 0, np.take_along_axis(behind, np.maximum(kept, 0), 1), _NEVER) + fixed
        return [behind + 3, keep, behind[:, _NEXT] + 2 + fixed], kept

    def tables(self) -> np.ndarray:
        """[segment, state]: cost at the start of each segment."""
        return self.cost[self.starts]

    def paths(self) -> tuple[list[list[str]], np.ndarray]:
        """Least audit and last state of each segment for each state it may be entered in."""
        places = len(self.cost)
        rows = np.flatnonzero(self.is_row)
        nodes = places * 4
        arcs = np.full((4, places, 4), -1, np.int64)  # letter, place, state -> node
        (drop, keep, change), kept = self._row_arcs(rows)
        now = self.cost[rows]
        behind, states = (rows[:, None] + 1) * 4, np.arange(4)
        arcs[_DELETE, rows] = np.where(drop == now, behind + states, -1)
        arcs[_KEEP, rows] = np.where((keep == now) & (kept >= 0), behind + kept, -1)
        arcs[_REROLE, rows] = np.where(change == now, behind + _NEXT, -1)
        may = self.is_row.copy()
        may[(self.starts + self.sizes)[self.last]] = True
        inserted = np.where(may[:, None] & (self.cost[:, _NEXT] + 2 == self.cost), np.arange(places)[:, None] * 4 + _NEXT, -1)
        arcs[_INSERT] = inserted
        arcs[:, self.cost >= _NEVER] = -1
        arcs = arcs.reshape(4, nodes)

        # Length 1: the least letter; 0 is the end of the string. Each letter has one target, so a least prefix has one end.
        leaves = arcs >= 0
        rank = np.where(leaves.any(axis=0), leaves.argmax(axis=0) + 1, 0)
        own = np.arange(nodes)
        pointers = [np.where(rank > 0, arcs[np.maximum(rank - 1, 0), own], own)]
        while True:
            rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + rank[pointers[-1]], return_inverse=True)[1]
            further = pointers[-1][pointers[-1]]
            if np.array_equal(further, pointers[-1]):
                break
            pointers.append(further)
        # The letter that starts a node's least audit: least (letter, rank of the target) over its arcs.
        offer = np.where(leaves, np.arange(4)[:, None] * nodes + rank[np.maximum(arcs, 0)], np.iinfo(np.int64).max)
        letters = np.where(leaves.any(axis=0), offer.argmin(axis=0) + 1, 0)

        entries = (self.starts[:, None] * 4 + states).ravel()
        ends = pointers[-1][entries]
        # Steps to the end: the largest number of pointers, from the longest down, that still leave the last node ahead.
        steps, node = np.zeros(len(entries), np.int64), entries.copy()
        for k in range(len(pointers) - 1, -1, -1):
            ahead = letters[pointers[k][node]] > 0
            steps += np.where(ahead, 1 << k, 0)
            node = np.where(ahead, pointers[k][node], node)
        steps += letters[entries] > 0
        offsets = np.cumsum(steps) - steps
        far = np.arange(int(steps.sum())) - np.repeat(offsets, steps)
        node = np.repeat(entries, steps)
        for k, pointer in enumerate(pointers):
            node = np.where(far >> k & 1, pointer[node], node)
        text = _LETTERS[letters[node] - 1].tobytes().decode("ascii")
        audits = [text[o:o + n] for o, n in zip(offsets.tolist(), steps.tolist(), strict=True)]
        return [audits[k:k + 4] for k in range(0, len(audits), 4)], (ends & 3).reshape(-1, 4)


_DONE = np.array([0, _NEVER, _NEVER, 0])  # what remains to be paid behind the last row of a conversation


def _cost_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment the flattened 4 x 4 table; behind a last segment only the accepting states remain."""
    for batch in blocks(batches, "codes", BLOCK_ROWS):
        codes, last = batch["codes"].to_pylist(), batch["last"].to_numpy(zero_copy_only=False)
        out = []
        for state in range(4):
            after = np.full((len(codes), 4), _NEVER)
            after[:, state] = np.where(last, _DONE[state], 0)
            out.append(np.minimum(_Table(codes, after, last).tables(), _NEVER))
        table = np.stack(out, axis=2).reshape(len(codes), 16)
        yield pa.RecordBatch.from_arrays([batch["key"], batch["seg"], pa.array(table.tolist(), pa.list_(pa.int64()))], ["key", "seg", "costs"])
    release()


def _remaining(pieces: pd.DataFrame) -> pd.DataFrame:
    """One conversation of several segments, one row each: what remains to be paid behind each, from the last back."""
    pieces = pieces.sort_values("seg")
    tables = np.array(pieces["costs"].to_list()).reshape(-1, 4, 4)
    after, found = np.zeros(4, np.int64), []
    for k, table in enumerate(tables[::-1]):
        found.append(after if k else _DONE)
        after = np.minimum((table + after[None, :]).min(axis=1), _NEVER)
    return pd.DataFrame({"key": pieces["key"], "seg": pieces["seg"], "after": [f.tolist() for f in found[::-1]]})


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment and state it may be entered in: cost to the end of the conversation, least audit, state behind it; role changes inside."""
    for batch in blocks(batches, "codes", BLOCK_ROWS):
        codes, last = batch["codes"].to_pylist(), batch["last"].to_numpy(zero_copy_only=False)
        after = np.array([a if a is not None else _DONE for a in batch["after"].to_pylist()], np.int64).reshape(-1, 4)
        table = _Table(codes, after, last)
        audits, ends = table.paths()
        illegal = []
        for code in codes:
            kinds = np.frombuffer(code, np.uint8) & 3
            illegal.append(int((~_legal(kinds[:-1], kinds[1:])).sum()))
        rows = [batch["key"], batch["seg"], batch["first"], pa.array(table.tables().tolist(), pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string())),
                pa.array(ends.tolist(), pa.list_(pa.int32())), pa.array(illegal, pa.int64()),
                pa.array([c[0] & 3 for c in codes], pa.int32()), pa.array([c[-1] & 3 for c in codes], pa.int32())]
        yield pa.RecordBatch.from_arrays(rows, ["key", "seg", "first", "costs", "audits", "ends", "illegal", "head", "tail"])
    release()


def _legal(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    """Whether two rows' roles may follow each other: system-user, user-assistant, assistant-user."""
    return ((before == 0) & (now == 1)) | ((before == 1) & (now == 2)) | ((before == 2) & (now == 1))


def _entered(pieces: pd.DataFrame) -> pd.DataFrame:
    """One conversation of several segments: the state each is entered in, and illegal changes of role between them."""
    pieces = pieces.sort_values("seg")
    state, entry = 0, []
    for ends in pieces["ends"]:
        entry.append(state)
        state = int(ends[state])
    between = ~_legal(pieces["tail"].to_numpy()[:-1], pieces["head"].to_numpy()[1:])
    return pd.DataFrame({"key": pieces["key"], "seg": pieces["seg"], "entry": entry, "between": [0, *between.astype(int).tolist()]})


def edits(marks: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(key, seg, entry, audit, cost, illegal) per segment: its part of the least cheapest edits; ``cost`` with the first segment only."""
    cut = segments(marks, segment)
    several = cut.where("not (first and last)")
    tables = several.select("key", "seg", "codes", "last").mapInArrow(_cost_tables, "key string, seg long, costs array<long>")
    after = tables.groupBy("key").applyInPandas(_remaining, "key string, seg long, after array<long>")
    known = cut.join(after, ["key", "seg"], "left").select("key", "seg", "codes", "first", "last", "after")
    found = known.mapInArrow(_audits, "key string, seg long, first boolean, costs array<long>, audits array<string>, ends array<int>, illegal long, head int, tail int")
    found = materialize(found.join(cut.select("key", "seg", "last"), ["key", "seg"]), "structure-audits")
    entry = (found.where("not (first and last)").select("key", "seg", "ends", "head", "tail").groupBy("key")
             .applyInPandas(_entered, "key string, seg long, entry int, between long"))
    state = F.coalesce("entry", F.lit(0))
    return materialize(found.join(entry, ["key", "seg"], "left").select(
        "key", "seg", state.alias("entry"), F.element_at("audits", state + 1).alias("audit"),
        F.when(F.col("first"), F.col("costs")[0]).otherwise(0).alias("cost"), (F.col("illegal") + F.coalesce("between", F.lit(0))).alias("illegal")),
        "structure-edits")


_ROLES = {2: "user", 3: "assistant"}


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments one after the other, each its audit first, then its rows: the repaired rows. Holds one audit."""
    names = ["key", "g", "nth", "edit", "role", "text"]
    audit, at, state, here = "", 0, 0, (None, -1)
    out: list[tuple] = []

    def insert() -> None:
        nonlocal at, state
        nth = 0
        while at < len(audit) and audit[at] == "I":
            state, nth = int(_NEXT[state]), nth + 1
            out.append((here[0], here[1], nth, "Insert", _ROLES[state], ""))
            at += 1
    for batch in batches:
        for row in batch.to_pylist():
            if row["audit"] is not None:
                audit, at, state, here = row["audit"], 0, row["entry"], (row["key"], row["g"])
                insert()
                continue
            letter, role, here = audit[at], row["role"], (row["key"], row["g"])
            at += 1
            if letter == "K":
                state = int(_KEPT[state]["sua".find(role[:1])])
                out.append((*here, 0, "Keep", role, row["text"]))
            elif letter == "R":
                state = int(_NEXT[state])
                out.append((*here, 0, "Rerole", _ROLES[state], row["text"]))
            insert()
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
            (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()))], names)
        out.clear()


def repaired(rows: DataFrame, audits: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(key, g, nth, edit, role, text): the rows of the repaired conversations in the order of (g, nth), without deleted ones."""
    seg = F.expr(f"(g - 1) div {segment}")
    none = F.lit(None).cast("string")
    told = audits.select("key", "seg", (F.col("seg") * segment).alias("g"), "entry", "audit", none.alias("role"), none.alias("text"))
    said = rows.select("key", seg.alias("seg"), "g", F.lit(None).cast("int").alias("entry"), none.alias("audit"), "role", "text")
    both = told.union(said).repartition("key", "seg").sortWithinPartitions("key", "seg", F.desc_nulls_last("audit"), "g")
    return both.mapInArrow(_apply, "key string, g long, nth int, edit string, role string, text string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which come one after the other; holds one batch."""
    key, digest = None, None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if digest is None or row["key"] != key:
                if digest is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = row["key"], hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{row['role']}:{row['text']}".encode())
        yield _digests(done)
    yield _digests([] if digest is None else [(key, digest.hexdigest())])


def _digests(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], ["key", "repaired_sha256"])


def repair_report(rows: DataFrame, wanted: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Per conversation of ``wanted`` (conv_id): gaps, faults, illegal changes of role, cost, audit and digest of the repair of ``rows``.

    The digest runs through a conversation's lines in order, so it is the one step that a conversation takes in a single task, as a stream.
    """
    rows = placed_rows(rows)
    marks = materialize(faults(rows), "structure-faults")
    audits = edits(marks, segment)
    lines = repaired(rows, audits, segment).repartition("key").sortWithinPartitions("key", "g", "nth")
    digests = lines.select("key", "role", "text").mapInArrow(_digest, "key string, repaired_sha256 string")
    turns = marks.groupBy("key", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counts = turns.groupBy("key").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    whole = audits.groupBy("key").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
                                      F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda a: a["audit"]), "").alias("audit"))
    named = wanted.select("conv_id").distinct().withColumn("key", _key())
    joined = named.join(counts, "key", "left").join(whole, "key", "left").join(digests, "key", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def damaged_and_repaired(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``repair_report`` of the damaged rows, for every conversation of ``conversations``."""
    conversations = conversations.select("conv_id", "turn", "role", "text")
    return repair_report(damage(conversations), conversations, segment)
