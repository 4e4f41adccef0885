"""Web archives (WARC): written as text files by Spark, read back in splits with boundary-chain verification.

*Writing.* One record per page. Of equal payloads of at least ``least`` bytes the smallest page id is the response, the
others are revisits that refer to it and hold no payload. The archives are plain text files that end each record with
two line ends, so Spark's own writer puts them into any file system.

*Reading.* Spark splits the files at the record magic, wherever a split begins. Each piece between two magics is a
candidate record: its header tells where its successor starts. A task knows positions only within its split, and follows
each candidate's chain to the first successor outside it. The start of a split follows from the sizes of the splits
before it. Pointer jumping from the start of each file, whose steps double in each round, then finds the candidate at
which the true chain enters each split; the candidates on the chain from there are the records. A magic inside a payload
starts a candidate that no record leads to, so it is rejected and its text stays part of the payload.

Null html: an empty payload. Null url: no target line. Null page_id: written without a number; it can revisit, but
nothing refers to it. Repeated rows with one page_id: those that hold the smallest id of their payload are all responses.
An empty table writes and yields nothing. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

MAGIC = b"WARC/1.0\r\n"
_END = "\r\n\r\n"   # behind each record; also ends a header
_LENGTH = re.compile(rb"^content-length:[ \t]*(\d+)[ \t]*\r?$", re.I | re.M)
_TYPE = re.compile(rb"^warc-type:[ \t]*(\S+)", re.I | re.M)
_ID = re.compile(rb"^warc-record-id:[ \t]*<urn:x-page:(-?\d*)>", re.I | re.M)
_REFERS = re.compile(rb"^warc-refers-to:[ \t]*<urn:x-page:(-?\d+)>", re.I | re.M)
_DIGEST = re.compile(rb"^warc-payload-digest:[ \t]*sha256:(\S+)", re.I | re.M)


def record_types(pages: DataFrame, least: int = 100) -> DataFrame:
    """page_id, url, payload, digest, and for revisits ``refers_to``."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    long = rows.where(F.octet_length("payload") >= least)
    firsts = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    firsts = materialize(firsts.select(F.col("digest").alias("of"), "first"), "payload-firsts")
    same = (F.col("digest") == F.col("of")) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, same, "left").select("page_id", "url", "payload", "digest", F.col("first").alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least: int = 100, date: str = "2024-01-01T00:00:00Z") -> None:
    """A folder of archives with one record per row."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    urn = lambda column: F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))
    again = F.col("refers_to").isNotNull()
    body = F.when(again, F.lit("")).otherwise(F.col("payload"))
    target = F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20]", "%20")), F.lit(""))
    revisit = F.when(again, F.concat(line("WARC-Refers-To", urn("refers_to")), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")))).otherwise("")
    record = F.concat(F.lit(MAGIC.decode()), line("WARC-Type", F.when(again, "revisit").otherwise("response")), line("WARC-Record-ID", urn("page_id")),
                      line("WARC-Date", F.lit(date)), target, line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")), revisit,
                      line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"), body)
    record_types(pages, least).select(record.alias("value")).write.option("lineSep", _END).text(path)


_CANDIDATE = ("file long, block long, at long, next long, leaves long, size long, page_id long, record_type string, refers_to long, "
              "payload_bytes long, payload_digest string, open boolean")
_NAMES = [part.split()[0] for part in _CANDIDATE.split(", ")]


class _Split:
    """The candidates of one split, in positions counted from its first magic or, in a file's first split, from the file's start."""

    def __init__(self, file: int, block: int):
        self.file, self.block, self.size, self.rows, self.open = file, block, 0, [], []

    def add(self, piece: bytes) -> None:
        start = self.size - len(MAGIC)  # of the magic before this piece
        self.size += len(piece) + len(MAGIC)
        for row, missing, digest in self.open:  # payloads that go on behind the magic before this piece
            part = (MAGIC + piece)[:missing]
            digest.update(part)
            row[1] = missing - len(part)
        self.open = [[row, left, digest] for (row, _, digest), left in ((o, o[0][1]) for o in self.open) if left or self._close(row, digest)]
        if start < 0 and not self.block:
            return  # what stands before the first magic of a file
        header, found, body = piece.partition(_END.encode())
        length = _LENGTH.search(header) if found else None
        if not length:
            return
        n, kind, page, refers, told = int(length[1]), _TYPE.search(header), _ID.search(header), _REFERS.search(header), _DIGEST.search(header)
        end = start + len(MAGIC) + len(header) + len(_END) + n
        row = [start, 0, end + len(_END), int(page[1]) if page and page[1] else None, kind[1].decode() if kind else None,
               int(refers[1]) if refers else None, n, None, True]
        digest = hashlib.sha256(body[:n])
        self.rows.append(row)
        if row[4] == "revisit":
            row[7], row[8] = told[1].decode() if told else None, False
        elif len(body) >= n:
            self._close(row, digest)
        else:
            row[1] = n - len(body)
            self.open.append([row, row[1], digest])

    def _close(self, row: list, digest) -> bool:
        row[7], row[8] = digest.hexdigest(), False
        return False

    def batch(self) -> pa.RecordBatch:
        following = {row[0]: row[2] for row in self.rows}
        leaves: dict[int, int] = {}
        for start in sorted(following, reverse=True):
            leaves[start] = leaves.get(following[start], following[start])
        out = [(self.file, self.block, None, None, None, self.size) + (None,) * 6]
        out += [(self.file, self.block, r[0], r[2], leaves[r[0]], None, r[3], r[4], r[5], r[6], r[7], r[8]) for r in self.rows]
        kinds = [pa.int64()] * 7 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], _NAMES)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split: _Split | None = None
    for batch in batches:
        for file, block, piece in zip(batch["file"].to_pylist(), batch["block"].to_pylist(), batch["piece"].to_pylist(), strict=True):
            if split is None or (split.file, split.block) != (file, block):
                if split:
                    yield split.batch()
                split = _Split(file, block)
            split.add(piece)
    if split:
        yield split.batch()


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between magics: file, block (where its split starts in the file), piece."""
    text = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece"))


def chain_entries(found: DataFrame) -> DataFrame:
    """Pointer jumping: (file, block, entry) with the candidate at which the chain from the file's start enters each split."""
    starts = found.where("at >= 0 or block > 0")
    targets = (found.select("file", F.col("leaves").alias("at")).union(found.select("file", F.lit(0).cast("long").alias("at"))).distinct())
    nodes = materialize(starts.join(targets, ["file", "at"]).select("file", "block", "at", "leaves"), "chain-nodes")
    reached = nodes.where("at = 0").select("file", "at")
    jump = nodes.select("file", "at", F.col("leaves").alias("to")).join(nodes.select("file", F.col("at").alias("to")), ["file", "to"], "left_semi")
    jump = materialize(jump.select("file", "at", "to"), "chain-jumps")
    while not jump.isEmpty():
        ahead = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = materialize(reached.union(ahead).distinct(), "chain-reached")
        second = jump.select("file", F.col("at").alias("to"), F.col("to").alias("beyond"))
        jump = materialize(jump.join(second, ["file", "to"]).select("file", "at", F.col("beyond").alias("to")), "chain-jumps")
    return nodes.join(reached, ["file", "at"]).select("file", "block", F.col("at").alias("entry"))


def _walk(table: pa.Table) -> pa.Table:
    """The candidates of one split that lie on the chain from its entry."""
    at, following = table["at"].to_pylist(), table["next"].to_pylist()
    row = {a: k for k, a in enumerate(at)}
    here, kept = table["entry"][0].as_py(), []
    while here in row:
        kept.append(row[here])
        here = following[row[here]]
    return table.take(pa.array(kept, pa.int64())).drop_columns(["entry"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per verified record: page_id, record_type, refers_to, payload_bytes and payload_digest of its own payload."""
    split = materialize(pieces(spark, path).mapInArrow(_candidates, _CANDIDATE), "archive-candidates")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split of a file
    bases = split.where("at is null").select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    bases = materialize(bases, "archive-splits")
    found = split.where("at is not null").drop("size").join(bases, ["file", "block"])
    found = found.withColumns({c: F.col(c) + F.col("base") for c in ("at", "next", "leaves")}).drop("base")
    entries = materialize(chain_entries(found), "chain-entries")
    entered = found.join(entries, ["file", "block"])
    records = entered.groupBy("file", "block").applyInArrow(_walk, entered.drop("entry").schema)
    records = materialize(records, "archive-records")
    whole = records.where("not open").select("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest")
    cut = records.where("open").select("file", "at", "next", "page_id", "record_type", "refers_to", "payload_bytes")
    if cut.isEmpty():
        return whole
    return whole.union(_across_splits(spark, path, bases, cut))


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, size = None, 0
    for batch in batches:
        places = []
        for file, block, piece in zip(batch["file"].to_pylist(), batch["block"].to_pylist(), batch["piece"].to_pylist(), strict=True):
            if (file, block) != key:
                key, size = (file, block), 0
            places.append(size)
            size += len(piece) + len(MAGIC)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "place"])


def _across_splits(spark: SparkSession, path: str, bases: DataFrame, cut: DataFrame) -> DataFrame:
    """Records whose payload holds a magic behind the end of their split: their pieces are brought together by record."""
    placed = pieces(spark, path).mapInArrow(_place, "file long, block long, piece binary, place long").join(bases, ["file", "block"])
    placed = placed.select("file", (F.col("place") + F.col("base") - len(MAGIC)).alias("start"), "piece")
    mine = placed.join(cut, "file").where("start >= at and start < next")
    text = F.aggregate(F.array_sort(F.collect_list(F.struct("start", "piece"))), F.lit(b""), lambda a, p: F.concat(a, F.lit(MAGIC), p["piece"]))
    joined = mine.groupBy("file", "at", "page_id", "record_type", "refers_to", "payload_bytes", "next").agg(text.alias("bytes"))
    body_start = (F.col("next") - F.col("at") - len(_END) - F.col("payload_bytes") + 1).cast("int")
    payload = F.substring("bytes", body_start, F.col("payload_bytes").cast("int"))
    return joined.select("page_id", "record_type", "refers_to", "payload_bytes", F.sha2(payload, 256).alias("payload_digest"))


def archived_pages(pages: DataFrame, path: str | None = None, least: int = 100) -> DataFrame:
    """Write, read back, and give each record the size and digest of its full payload."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archives")
    write_archives(pages, path, least)
    records = materialize(read_archives(spark, path), "archived")
    first = records.where("record_type = 'response' and page_id is not null").groupBy(F.col("page_id").alias("first")).agg(F.max("payload_bytes").alias("full_bytes"))
    revisits = records.where("record_type = 'revisit'").join(first, F.col("refers_to") == F.col("first"), "left")
    revisits = revisits.select("page_id", F.col("full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return records.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").union(revisits)
