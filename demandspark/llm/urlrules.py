"""URL verdicts from pattern rules that are found by their rarest literal token.

A rule is a verdict and a pattern. From the pattern's text come the tokens (runs of letters and digits) that every URL it
matches must hold as whole tokens. The rule is filed under the one of them that the fewest URLs hold, counted over all
URLs. A URL fetches the rules filed under its own tokens, and only those run their regular expression; patterns without
such a token are tried on every URL. Host rules (a host, its subdomains and the beginning of a path) are patterns, too,
and are filed the same way.

The longest host rule that fits decides. Otherwise the pattern rules do: a fitting ``allow`` overrides any ``block``, and
a URL that nothing blocks is allowed.

Pattern syntax: ``*`` is any text, ``^`` a separator (anything but a letter, a digit or ``_-.%``) or the end, ``|`` at
either end the URL's bound, ``||`` at the start the bound of a host or of one of its labels. Case is ignored.

Null url, and url without ``://``: host and path are empty; patterns still see the url (null: the empty text). Repeated
rows get the same answer each. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RULES = 200_000   # rules travel with the tasks; a longer list is refused
_TOKEN = re.compile(r"[a-z0-9]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|$)"

# (verdict, host, beginning of the path)
HOST_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
PATTERN_RULES = [
    ("block", "?page=*&ref="), ("block", "?sessionid="), ("block", "&sessionid="), ("block", "/tag/"), ("block", "/login^"), ("block", "/cart^"),
    ("block", "/wp-admin/"), ("block", "/print/"), ("block", "/calendar/*/day/"), ("block", "||ads."), ("block", "||tracker."), ("block", "?utm_source=feed|"),
    ("block", "?replytocom="), ("block", ".zip|"), ("block", ".exe|"), ("allow", "||blog.*/en/"), ("allow", "||docs."), ("allow", "/sitemap.xml|")]


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_UPPER), slash + path


def pattern_regex(pattern: str) -> str:
    start = r"^[^:/?#]*://(?:[^/?#]*\.)?" if pattern.startswith("||") else "^" if pattern.startswith("|") else ""
    body = pattern.lstrip("|") if start else pattern
    end = "$" if body.endswith("|") else ""
    body = body.removesuffix("|")
    return "(?is)" + start + "".join(".*" if c == "*" else _SEPARATOR if c == "^" else re.escape(c) for c in body) + end


def host_regex(host: str, path: str) -> str:
    return r"(?s)^(?:[^/]*\.)?" + re.escape(host) + re.escape(path)


def whole_tokens(literal: str, open_start: bool, open_end: bool) -> list[str]:
    """Tokens of a pattern that occur as whole tokens in whatever it matches."""
    found = []
    for m in _TOKEN.finditer(literal.translate(_UPPER)):
        before = m.start() and literal[m.start() - 1] != "*" or not m.start() and not open_start
        after = m.end() < len(literal) and literal[m.end()] != "*" or m.end() == len(literal) and not open_end
        if before and after:
            found.append(m.group())
    return found


def compile_rules(host_rules: Sequence[tuple[str, str, str]], patterns: Sequence[tuple[str, str]]) -> list[dict]:
    if len(host_rules) + len(patterns) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    hosts = [{"verdict": v, "name": h + p, "regex": host_regex(h, p), "tokens": whole_tokens(h + p, False, True)} for v, h, p in host_rules]
    others = [{"verdict": v, "name": None, "regex": pattern_regex(p), "tokens": whole_tokens(p.strip("|"), not p.startswith("|"), not p.endswith("|"))}
              for v, p in patterns]
    return hosts + others


def token_counts(pages: DataFrame, tokens: set[str]) -> dict[str, int]:
    """How many URLs hold each of the rules' tokens; as many numbers as there are such tokens."""
    if not tokens:
        return {}
    wanted = pages.sparkSession.createDataFrame([(t,) for t in sorted(tokens)], "token string")
    held = pages.select(F.explode(F.array_distinct(F.split(F.translate("url", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[^a-z0-9]+"))).alias("token"))
    return {r["token"]: r["n"] for r in held.join(F.broadcast(wanted), "token").groupBy("token").agg(F.count("*").alias("n")).collect()}


def build_index(rules: list[dict], counts: dict[str, int]) -> dict[str | None, list[int]]:
    """Rule numbers by rarest token; those without a token under None."""
    index: dict[str | None, list[int]] = {}
    for k, rule in enumerate(rules):
        rarest = min(rule["tokens"], key=lambda t: (counts.get(t, 0), t), default=None)
        index.setdefault(rarest, []).append(k)
    return index


class Matcher:
    def __init__(self, rules: list[dict], index: dict[str | None, list[int]]):
        self.rules, self.index, self.compiled = rules, index, {}

    def fits(self, number: int, text: str) -> bool:
        if number not in self.compiled:
            self.compiled[number] = re.compile(self.rules[number]["regex"])
        return self.compiled[number].search(text) is not None

    def judge(self, url: str | None) -> tuple[str, str, str | None, str]:
        host, path = host_and_path(url)
        url = url or ""
        candidates = list(self.index.get(None, ()))
        for token in set(_TOKEN.findall(url.translate(_UPPER))):
            candidates += self.index.get(token, ())
        best, verdicts = None, set()
        for number in candidates:
            rule = self.rules[number]
            if rule["name"] is None:
                if self.fits(number, url):
                    verdicts.add(rule["verdict"])
            elif self.fits(number, host + path) and (best is None or len(rule["name"]) > len(best["name"])):
                best = rule
        if best:
            return host, path, best["name"], best["verdict"]
        return host, path, None, "block" if verdicts == {"block"} else "allow"


def _judge(batches: Iterator[pa.RecordBatch], rules: list[dict], index: dict) -> Iterator[pa.RecordBatch]:
    matcher = Matcher(rules, index)
    for batch in batches:
        found = [matcher.judge(url) for url in batch["url"].to_pylist()]
        columns = [pa.array([f[k] for f in found], pa.string()) for k in range(4)]
        yield pa.RecordBatch.from_arrays([batch["page_id"], *columns], ["page_id", "host", "path", "rule", "verdict"])


def url_verdicts(pages: DataFrame, host_rules: Sequence[tuple[str, str, str]] = tuple(HOST_RULES),
                 patterns: Sequence[tuple[str, str]] = tuple(PATTERN_RULES)) -> DataFrame:
    """Per row: page_id, host, path, rule (the deciding host rule or null) and verdict."""
    pages = pages.select("page_id", "url")
    rules = compile_rules(host_rules, patterns)
    index = build_index(rules, token_counts(pages, {t for r in rules for t in r["tokens"]}))
    return pages.mapInArrow(partial(_judge, rules=rules, index=index), "page_id long, host string, path string, rule string, verdict string")
