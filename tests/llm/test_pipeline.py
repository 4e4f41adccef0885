"""The pipeline end to end, its registration, and the SQL counterparts."""

import hashlib
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from demandspark.llm import bytenet, mixing
from demandspark.llm.common import table
from demandspark.llm.oracle import ORACLE_SQL
from demandspark.llm.queries import QUERIES
from demandspark.session import materialize

from .conftest import odd_rows, prose
from .test_documents import check_pieces
from .test_pairs import brute_repeats, check_one_per_component, shared_passages

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts, columns = [docs.count()], docs.columns
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = materialize(stage(spark, docs, SMALL), "test-stage")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] == counts[3]
    packed = corpus_pipeline.pack(spark, docs, SMALL)
    assert packed.where("length <= 0 or length > 2048").count() == 0
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").distinct().collect()}


def plain(frame):
    return sorted(map(str, frame.collect()))


def test_the_quality_stage_keeps_what_the_network_accepts(spark, docs):
    """All rows of whole documents at the threshold or above, unchanged; ties, repeats and odd texts are rows like others."""
    frame = docs(*odd_rows(), *[(100 + k, prose(k, 50)) for k in range(20)], *[(200 + k, "%%% " * 40) for k in range(5)])
    documents, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    model = bytenet.quality_model(documents, labels, bytenet.remainder(4) != 2)
    scores = {t: bytenet.probability([(t or "").encode()], model)[0] for t in {r.text for r in frame.collect()}}
    expected = sorted(str(r) for r in frame.collect() if scores[r.text] >= corpus_pipeline.LEAST_QUALITY)
    got = corpus_pipeline.keep_good(spark, frame, SMALL)
    assert got.columns == frame.columns and plain(got) == expected
    assert corpus_pipeline.keep_good(spark, frame.limit(0), SMALL).count() == 0


def test_the_near_duplicate_stage_keeps_one_of_each_group(spark, docs):
    check_one_per_component(docs, odd_rows() + [(k, prose(1, 50)) for k in range(40, 44)])
    empty = docs((1, "a")).limit(0)
    assert corpus_pipeline.drop_near_duplicates(spark, empty, SMALL).columns == empty.columns


def test_the_repeats_stage_removes_covered_words(spark, docs):
    for rows in (shared_passages(), odd_rows()):
        frame = docs(*rows)
        got = corpus_pipeline.drop_repeats(spark, frame, SMALL)
        assert got.schema == frame.schema
        kept = sorted(((r.doc_id, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in got.collect()), key=str)
        assert kept == sorted(((i, digest) for i, _, _, digest in brute_repeats(rows, 35)), key=str)
        assert all(r.n_chars == len(r.text) for r in got.collect() if r.text is not None and r.n_chars is not None)
    assert corpus_pipeline.drop_repeats(spark, docs((1, "a")).limit(0), SMALL).count() == 0


def test_the_mixing_stage_repeats_rows_by_their_draw(spark, docs):
    frame = docs(*odd_rows(), *[(100 + k, prose(k, 30)) for k in range(60)])
    drawn = mixing.mix(frame).select("doc_id", "text", "mix_copies").distinct()
    got = corpus_pipeline.mix_sources(spark, frame, SMALL)
    assert got.columns == frame.columns
    counts = Counter((r.doc_id, r.text) for r in got.collect())
    rows = Counter((r.doc_id, r.text) for r in frame.collect())
    for r in drawn.where("doc_id >= 100").collect():
        assert counts[r.doc_id, r.text] == rows[r.doc_id, r.text] * r.mix_copies
    assert set(counts) <= set(rows)


def test_the_packing_stage_packs_every_token(spark, docs):
    rows = odd_rows() + [(100 + k, prose(k, 30)) for k in range(9)]
    check_pieces(rows, corpus_pipeline.pack(spark, docs(*rows), SMALL).collect(), 2048)


def test_run_equals_its_stages(spark):
    docs = table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SMALL), "test-stage")
    both = [Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in f.collect()) for f in (docs, corpus_pipeline.run(spark, SMALL))]
    tokens = [sum(k[2] * n for k, n in c.items()) for c in both]
    assert tokens[0] == tokens[1]


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))
    assert set(ORACLE_SQL) <= set(names) and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "labels", "benchmark", "conversations"):
        assert os.path.exists(f"{SMALL}/{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    frame = QUERIES[name](spark, SMALL)
    expected = connection.execute(f"SELECT {', '.join(frame.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, frame.collect()), key=str) == sorted(expected, key=str)
