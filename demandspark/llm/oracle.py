"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from .urlrules import HOST_RULES, PATTERN_RULES, pattern_regex


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _url_rules() -> str:
    """Every rule against every url, without an index."""
    fits = [(len(h + p), h + p, v, f"(host = {_text(h)} OR ends_with(host, {_text('.' + h)})) AND starts_with(path, {_text(p)})") for v, h, p in HOST_RULES]
    fits.sort(key=lambda f: -f[0])
    rule = "CASE " + " ".join(f"WHEN {c} THEN {_text(name)}" for _, name, _, c in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN {_text(v)}" for _, _, v, c in fits)
    hit = {v: " OR ".join(f"regexp_matches(coalesce(url, ''), {_text(pattern_regex(p))})" for w, p in PATTERN_RULES if w == v) for v in ("block", "allow")}
    verdict += f" WHEN ({hit['block']}) AND NOT ({hit['allow']}) THEN 'block' ELSE 'allow' END"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
        WITH rests AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parts AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
                         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests)
        SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict FROM parts"""


_MIXING = """
    WITH sizes AS (SELECT source, sum(coalesce(strlen(text), 0))::DOUBLE AS size FROM documents GROUP BY source),
    weighted AS (SELECT source, size, CASE WHEN size > 0 THEN pow(size, 0.5) ELSE 0 END AS weight FROM sizes),
    rates AS (SELECT source, weight / sum(weight) OVER () * sum(size) OVER () / size AS rate FROM weighted WHERE size > 0),
    terms AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1.0))) OVER (PARTITION BY source ORDER BY k) AS reached
              FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 20)::BIGINT + 1)) AS k FROM rates)),
    drawn AS (SELECT doc_id, source, text, ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / pow(2, 52) AS u FROM documents),
    counted AS (SELECT d.doc_id, d.source, d.text, (SELECT count(*) FROM terms t WHERE t.source IS NOT DISTINCT FROM d.source AND t.reached <= d.u) AS n FROM drawn d)
    SELECT doc_id, source, n::INTEGER AS mix_copies, c::INTEGER AS mix_copy, md5('17-order:' || coalesce(doc_id::VARCHAR, '') || ':' || c) AS mix_key,
           sha256(text) AS text_sha256
    FROM (SELECT *, unnest(range(1, n + 1)) AS c FROM counted WHERE n > 0)"""

_WARC = """
    WITH rows AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    firsts AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM rows)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to FROM firsts"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"


def _components(threshold: int, more: str = "") -> str:
    """Every pair of texts that share a shingle compared, links followed from text to text; equal texts are one."""
    return f"""
    WITH RECURSIVE words AS (SELECT min(doc_id) AS node, text, any_value(regexp_extract_all({_LOWER}, {_WORDS})) AS w FROM documents WHERE text IS NOT NULL GROUP BY text),
    shingles AS (SELECT DISTINCT node, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS gram FROM words WHERE len(w) > 0),
    sizes AS (SELECT node, count(*) AS n FROM shingles GROUP BY node),
    common AS (SELECT x.node AS a, y.node AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.gram = y.gram AND x.node < y.node GROUP BY 1, 2),
    links AS (SELECT a, b FROM common JOIN sizes p ON p.node = a JOIN sizes q ON q.node = b WHERE 100 * c >= {threshold} * (p.n + q.n - c)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (SELECT node, node AS other FROM sizes UNION SELECT r.node, l.b FROM reached r JOIN edges l ON l.a = r.other),
    named AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node),
    rows AS (SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
             FROM documents d LEFT JOIN words t ON t.text = d.text LEFT JOIN sizes s ON s.node = t.node LEFT JOIN named c ON c.node = t.node)
    SELECT doc_id, n_shingles, component_id{more} FROM rows"""


_REPEATS = f"""
    WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
    windows AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, unnest(list_transform(range(1, len(w) - 33), lambda i: md5(array_to_string(w[i:i + 34], ' ')))) AS h
                FROM words WHERE len(w) >= 35),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
    placed AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
    FROM words LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id) LEFT JOIN kept k USING (doc_id)"""

# CRC-32, a byte at a time: eight steps of the polynomial make the table of 256 entries.
_CRC = """
    steps AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x::BIGINT, list_transform(range(8), lambda k: k::BIGINT)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    hashed AS (SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(feature)),
                lambda i: ('0x' || substr(hex(encode(feature)), 2 * i + 1, 2))::BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
               FROM (SELECT DISTINCT feature FROM features), steps)"""

_RESAMPLE = rf"""
    WITH texts AS (SELECT 's' AS side, doc_id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
    words AS (SELECT side, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts WHERE text IS NOT NULL),
    features AS (SELECT side, doc_id, unnest(w) AS feature FROM words
                 UNION ALL SELECT side, doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
    {_CRC},
    found AS (SELECT side, doc_id, bucket FROM features JOIN hashed USING (feature)),
    totals AS (SELECT count(*) FILTER (side = 's') AS all_s, count(*) FILTER (side = 't') AS all_t FROM found),
    gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
              FROM (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM found GROUP BY bucket), totals),
    weights AS (SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM found JOIN gains USING (bucket) WHERE side = 's' GROUP BY doc_id),
    scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(len(w), 0) >= 20 AS able,
                 coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score
               FROM documents d LEFT JOIN weights USING (doc_id) LEFT JOIN (SELECT doc_id, w FROM words WHERE side = 's') USING (doc_id)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) FILTER (able) OVER () AS n_able FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * n_able // 100 THEN place END AS rank FROM ranked"""

ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": _REPEATS, "op4_url_rules": _url_rules(), "op6_poisson_mixing": _MIXING, "op7_ngram_jaccard": _components(80), "op9_warc_chain": _WARC,
    "op11_minhash": _components(85, ", doc_id = component_id AS kept"), "op12_dsir": _RESAMPLE}
