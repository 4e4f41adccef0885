"""Url rules and web archives."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from demandspark.llm import urlrules, warc
from demandspark.session import scratch_path

URLS = ["https://a.example.org/es/1", "http://example.org/en/12?x#y", "https://EXAMPLE.ORG", "https://org/", "http://x.com/fr/", "http://x.com/de/?page=2&ref=x",
        "http://y.net/?page=2&ref=x", "http://y.net/tag/1", "http://ads.y.net/", "http://badads.net/", "http://z.net/login?next=1", "http://z.net/loginpage",
        "no scheme /tag/", "", None, "://", "http://blog.y.net/en/?page=1&ref=2", "http://notexample.org/en/1", "HTTP://Q.COM/DE/", "http://x.com/de", "a://b://c/d"]


def test_index_fetches_every_fitting_rule(spark):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)] + [(None, URLS[0])], "page_id long, url string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlrules.url_verdicts(pages).collect()}
    expected = set()
    for k, url in [*enumerate(URLS), (None, URLS[0])]:
        host, path = urlrules.host_and_path(url)
        fits = [(len(h + p), h + p, v) for v, h, p in urlrules.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        hits = {v for v, p in urlrules.PATTERN_RULES if re.search(urlrules.pattern_regex(p), url or "")}
        best = max(fits, default=None)
        expected.add((k, host, path, best[1] if best else None, best[2] if best else "block" if hits == {"block"} else "allow"))
    assert got == expected
    assert urlrules.url_verdicts(pages.limit(0)).count() == 0


def test_columns_with_clashing_names(spark):
    rows = [(1, "http://x.com/de/", "<p>" + "a" * 100), (2, None, None), (3, "http://example.org/es/1", "<p>" + "a" * 100)]
    plain = spark.createDataFrame(rows, "page_id long, url string, html string")
    names = ("host", "path", "rule", "verdict", "token", "tokens", "pattern", "payload", "payload_digest", "record_type", "file", "offset", "start", "size", "refers_to", "node", "rest")
    full = plain.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(urlrules.url_verdicts(full), urlrules.url_verdicts(plain))
    assert same(warc.archived_pages(full), warc.archived_pages(plain))


def test_rules_are_filed_under_their_rarest_token():
    rules = urlrules.compile_rules([("block", "example.org", "/en/1")], [("block", "/tag/"), ("block", "*abc*")])
    assert [r["tokens"] for r in rules] == [["example", "org", "en"], ["tag"], []]
    assert urlrules.build_index(rules, {"example": 9, "org": 9, "en": 4, "tag": 1}) == {"en": [0], "tag": [1], None: [2]}
    with pytest.raises(ValueError):
        urlrules.compile_rules([("block", "a", "/")] * (urlrules.MAX_RULES + 1), [])


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def forged(k):
    """A payload that holds whole records of its own."""
    inner = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{90_000 + k}>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    return "start " + inner * (k % 4 + 1) + "WARC/1.0\r\n" * 3 + "x" * (400 * (k % 7)) + inner


def check_archive(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(map(tuple, warc.archived_pages(pages.repartition(2)).collect()), key=str)
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    expected = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = first.get(h) if len(data) >= 100 and sum(x[2] == h for x in rows) > 1 and first.get(h) != i else None
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if to is not None else "response", to))
    assert got == sorted(expected, key=str)


def test_archives_round_trip(spark, small_splits):
    rows = [(k, f"http://h/{k}\r\nX: y", forged(k)) for k in range(40)] + [(100, None, None), (101, "", ""), (102, "u", "é" * 99), (103, "u", "é" * 99), (104, "u", "é" * 40),
            (105, "u", "é" * 40), (None, "u", "é" * 99), (50, "u", forged(3)), (106, "u", "y" * 9000), (107, "u", "\r\n\r\n" * 60)]
    check_archive(spark, rows)


def test_archives_without_splits(spark):
    check_archive(spark, [(k, "u", forged(k)) for k in range(10)])
    assert warc.archived_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_chain_entries_cross_many_splits(spark, small_splits):
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("p"), F.repeat(F.col("id").cast("string"), 90)).alias("html"))
    path = scratch_path(spark, "archive")
    warc.write_archives(pages.coalesce(1), path)
    assert sorted(r.page_id for r in warc.read_archives(spark, path).collect()) == list(range(300))
