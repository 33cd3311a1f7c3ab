"""DuckDB SQL of the operators that SQL can express, each by brute force over the whole tables."""

from __future__ import annotations

from spindle.llm.hosts import SUFFIXES

# words as in ``shingles``: runs of ASCII letters, digits and non-ASCII characters, lower case
_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z0-9\x{80}-\x{10FFFF}]+'), lambda w: w <> '')"
_SHINGLES = "list_transform(range(0, greatest(len(w) - k + 1, 0)), lambda i: array_to_string(w[i + 1:i + k], ' '))"

_PROBE = "'</s>[INST] ok [/INST]'"
_CONTROLS = r"len(regexp_extract_all({0}, '</?s>|\[/?INST\]'))"

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
_TERMS = rf"regexp_extract_all(translate(text, {_UPPER}, {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


def _suffix(host: str, digits: str, long: str, short: str) -> str:
    two = f"list_aggregate(list_slice(string_split({host}, '.'), -2, -1), 'string_agg', '.')"
    names = ", ".join(f"'{s}'" for s in SUFFIXES)
    return f"CASE WHEN regexp_full_match({host}, '[0-9.]*') THEN {digits} WHEN {two} IN ({names}) THEN {long} ELSE {short} END"


def _last(host: str, n: int) -> str:
    return f"list_aggregate(list_slice(string_split({host}, '.'), -{n}, -1), 'string_agg', '.')"


def _strength(name: str, groups: str) -> str:
    """Strength of rows (n, k, parent_n, parent_k) by moments, as in ``hosts``."""
    return f"""{name} AS (
  SELECT 1 / least(greatest(CASE WHEN at_most - by_chance > 0 THEN (seen - by_chance) / (at_most - by_chance) ELSE 0.001::DOUBLE END,
                            0.001::DOUBLE), 0.95::DOUBLE) - 1 AS s
  FROM (SELECT CAST(sum(CAST(floor(1e6 * (n * (k / n - mean) * (k / n - mean))) AS BIGINT)) AS DOUBLE) AS seen,
               CAST(sum(CAST(floor(1e6 * (mean * (1 - mean) * (1 - n / parent_n))) AS BIGINT)) AS DOUBLE) AS by_chance,
               CAST(sum(CAST(floor(1e6 * (mean * (1 - mean) * n * (1 - n / parent_n))) AS BIGINT)) AS DOUBLE) AS at_most
        FROM (SELECT *, parent_k / parent_n AS mean FROM ({groups}) WHERE n > 0)))"""


_PARENT = "n AS parent_n, k AS parent_k"
_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
          ("com", "/de/", "block")]
_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in _RULES)

_REPUTATION = rf"""
WITH u AS (SELECT row_number() OVER () AS r, CAST(page_id AS BIGINT) AS page_id, coalesce(url, '') AS url FROM pages),
     p AS (SELECT r, page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {_UPPER}, {_LOWER}) AS host,
                  regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM u),
     rules(rh, rp, v) AS (VALUES {_RULE_ROWS}),
     fit AS (SELECT r, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS ruled
             FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY r),
     j AS (SELECT p.*, rule, ruled FROM p LEFT JOIN fit USING (r)),
     h AS (SELECT host, {_suffix('host', "''", _last('host', 2), _last('host', 1))} AS suffix,
                  {_suffix('host', 'host', _last('host', 3), _last('host', 2))} AS domain,
                  count(ruled) AS n, count(*) FILTER (WHERE ruled = 'block') AS k FROM j GROUP BY host),
     d AS (SELECT suffix, domain, CAST(sum(n) AS BIGINT) AS n, CAST(sum(k) AS BIGINT) AS k FROM h GROUP BY suffix, domain),
     e AS (SELECT suffix, CAST(sum(n) AS BIGINT) AS n, CAST(sum(k) AS BIGINT) AS k FROM d GROUP BY suffix),
     t AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(k) AS BIGINT) AS k FROM e),
     {_strength('s1', f'SELECT e.n, e.k, t.n AS parent_n, t.k AS parent_k FROM e, t')},
     {_strength('s2', f'SELECT d.n, d.k, parent_n, parent_k FROM d JOIN (SELECT suffix, {_PARENT} FROM e) USING (suffix)')},
     {_strength('s3', f'SELECT h.n, h.k, parent_n, parent_k FROM h JOIN (SELECT suffix, domain, {_PARENT} FROM d) USING (suffix, domain)')},
     pe AS (SELECT suffix, (e.k + s1.s * (t.k / t.n)) / (e.n + s1.s) AS above FROM e, t, s1),
     pd AS (SELECT suffix, domain, (d.k + s2.s * above) / (d.n + s2.s) AS prior FROM s2, d JOIN pe USING (suffix)),
     ab AS (SELECT host, n, k, k + s3.s * prior AS a, (n - k) + s3.s * (1 - prior) AS b FROM s3, h JOIN pd USING (suffix, domain)),
     q AS (SELECT host, n, k, a / (a + b) - 1.645::DOUBLE * sqrt(a / (a + b) * (b / (a + b)) / (a + b + 1)) AS bound FROM ab)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN bound >= 0.5::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
       n AS labelled, k AS blocked, bound
FROM j JOIN q USING (host)"""


def _clustering(k: int = 8, rounds: int = 10) -> str:
    """Lloyd's rounds in integers, one set of tables per round."""
    kept = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64"
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
       list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS p FROM embeddings WHERE {kept})""",
             "e AS MATERIALIZED (SELECT r, unnest(range(1, 65)) AS j, unnest(p) AS x FROM v)",
             f"""c0 AS MATERIALIZED (SELECT c, unnest(range(1, 65)) AS j, unnest(p) AS y FROM (
       SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), p) - 1 AS c, p FROM v) WHERE c < {k})"""]
    near = """a{0} AS MATERIALIZED (SELECT r, CAST(arg_min(c, (d, c)) AS INTEGER) AS c, min(d) AS d FROM (
       SELECT r, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d FROM e JOIN c{0} USING (j) GROUP BY r, c) GROUP BY r)"""
    for i in range(rounds):
        parts += [near.format(i), f"""c{i + 1} AS MATERIALIZED (
       SELECT c, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS y
       FROM (SELECT c, j, sum(x) AS s, count(*) AS n FROM a{i} JOIN e USING (r) GROUP BY c, j)
       UNION ALL SELECT c, j, y FROM c{i} WHERE c NOT IN (SELECT c FROM a{i}))"""]
    return "WITH " + ",\n     ".join([*parts, near.format(rounds)]) + f""",
     g AS (SELECT c, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY c),
     s AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, c AS cluster, d AS distance, cluster_inertia, CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia,
       centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN g USING (c) JOIN s USING (c)"""


ORACLE_SQL = {
    # template: <s>[INST] role [/INST] text </s>, 20 characters; control strings are escaped where the turn
    # holds any, backslashes where it holds any
    "op1_chat_format": rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', {_PROBE}), (-1, 1, 'assistant', {_PROBE})),
     c AS (SELECT *, {_CONTROLS.format('role')} + {_CONTROLS.format('text')} AS controls,
                  length(role || text) - length(replace(role || text, '\', '')) AS slashes FROM t)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(20 + length(role) + length(text) + controls + slashes) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
    # every window of an item's length that shares a shingle with it
    "op6_decontamination": f"""
WITH i AS (SELECT item_id, w, len(w) AS length, least(len(w), 5) AS k
           FROM (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
     ix AS (SELECT item_id, length, k, unnest({_SHINGLES}) AS s FROM i),
     ic AS (SELECT item_id, length, k, s, count(*) AS n FROM ix GROUP BY ALL),
     sizes AS (SELECT DISTINCT k FROM i),
     d AS (SELECT row_number() OVER () AS r, doc_id, w FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
     ds AS (SELECT r, k, len(w) AS words, {_SHINGLES} AS all_s FROM d, sizes WHERE len(w) >= k),
     dx AS (SELECT r, k, words, unnest(all_s) AS s, unnest(range(0, len(all_s))) AS p FROM ds),
     hits AS (SELECT DISTINCT r, item_id, length, dx.k, words, p FROM dx JOIN ic ON dx.s = ic.s AND dx.k = ic.k),
     starts AS (SELECT DISTINCT r, item_id, length, k,
                       unnest(range(greatest(0, least(p - (length - k), words - length)),
                                    greatest(0, least(p, words - length)) + 1)) AS start
                FROM hits),
     wx AS (SELECT b.r, item_id, start, dx.s, count(*) AS n, any_value(least(b.length, dx.words) - b.k + 1) AS total
            FROM starts b JOIN dx ON b.r = dx.r AND b.k = dx.k AND dx.p BETWEEN start AND start + b.length - b.k
            GROUP BY b.r, item_id, start, dx.s),
     js AS (SELECT wx.r, wx.item_id, wx.start, sum(least(wx.n, ic.n)) AS shared, any_value(wx.total) AS have,
                   any_value(ic.length - ic.k + 1) AS want
            FROM wx JOIN ic ON wx.item_id IS NOT DISTINCT FROM ic.item_id AND wx.s = ic.s GROUP BY 1, 2, 3),
     found AS (SELECT r, item_id, start, shared / (have + want - shared) AS similarity FROM js
               WHERE shared >= 0.8 * (have + want - shared) - 1e-9)
SELECT doc_id, item_id, CAST(arg_min(start, (-similarity, start)) AS INTEGER) AS start, max(similarity) AS similarity
FROM found JOIN d USING (r) GROUP BY r, doc_id, item_id""",
    # every 400-byte string of every text, as hex
    "op8_suffix_array_dedup": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
     s AS (SELECT r, unnest(range(0, length(h) // 2 - 399)) AS p, h FROM d WHERE length(h) >= 800),
     m AS (SELECT r, p, md5(substr(h, 2 * p + 1, 800)) AS m FROM s),
     often AS (SELECT m FROM m GROUP BY m HAVING count(*) > 1),
     hit AS (SELECT r, p, p - lag(p) OVER (PARTITION BY r ORDER BY p) AS step FROM m SEMI JOIN often USING (m)),
     runs AS (SELECT r, p, sum(CASE WHEN step <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS run FROM hit),
     spans AS (SELECT r, run, min(p) AS low, max(p) + 400 AS high FROM runs GROUP BY r, run),
     cuts AS (SELECT r, run, low, high, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low), 0) AS since FROM spans),
     kept AS (SELECT c.r, count(*) AS n_spans, sum(high - low) AS n_removed,
                     string_agg(substr(h, 2 * since + 1, 2 * (low - since)), '' ORDER BY low)
                       || substr(any_value(h), 2 * max(high) + 1) AS rest
              FROM cuts c JOIN d USING (r) GROUP BY c.r)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)""",
    # all pairs of different multisets that share a shingle, and components of those at 0.8 or more
    "op10_bag_minhash": f"""
WITH RECURSIVE
     d AS (SELECT row_number() OVER () AS r, doc_id, w, least(len(w), 5) AS k FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
     b AS (SELECT r, doc_id, list_sort({_SHINGLES}) AS bag FROM d WHERE len(w) > 0),
     c AS (SELECT bag, min(doc_id) AS copies_id, row_number() OVER () AS c FROM b GROUP BY bag),
     x AS (SELECT c, s, count(*) AS n FROM (SELECT c, unnest(bag) AS s FROM c) GROUP BY c, s),
     size AS (SELECT c, len(bag) AS size FROM c),
     shared AS (SELECT p.c AS a, q.c AS b, sum(least(p.n, q.n)) AS n FROM x p JOIN x q ON p.s = q.s AND p.c <> q.c GROUP BY p.c, q.c),
     links AS (SELECT a, b FROM shared JOIN size sa ON a = sa.c JOIN size sb ON b = sb.c WHERE n >= 0.8 * (sa.size + sb.size - n) - 1e-9),
     reach(c, t) AS (SELECT c, c FROM c UNION SELECT reach.c, links.b FROM reach JOIN links ON reach.t = links.a),
     least_id AS (SELECT reach.c, min(c.copies_id) AS class_id FROM reach JOIN c ON reach.t = c.c GROUP BY reach.c)
SELECT d.doc_id, CASE WHEN c.c IS NULL THEN d.doc_id ELSE class_id END AS class_id,
       CASE WHEN c.c IS NULL THEN d.doc_id ELSE copies_id END AS copies_id
FROM d LEFT JOIN b USING (r) LEFT JOIN c USING (bag) LEFT JOIN least_id USING (c)""",
    # every term of every document
    "op11_lexical_search": f"""
WITH t AS (SELECT r, doc_id, unnest({_TERMS}) AS term FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
     size AS (SELECT r, doc_id, count(*) AS n FROM t GROUP BY r, doc_id),
     total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
     item AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
     post AS (SELECT r, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM item) GROUP BY r, term),
     weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
                FROM post, total GROUP BY term, docs),
     m AS (SELECT r, doc_id, 50 + (50 * n * docs) // terms AS m FROM size, total),
     scored AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
                FROM item JOIN weight USING (term) JOIN post USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id)
SELECT CAST(item_id AS BIGINT) AS item_id, CAST(rank AS INTEGER) AS rank, CAST(doc_id AS BIGINT) AS doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50""",
    "op12_url_filter": _REPUTATION,
    "op13_centroid_clustering": _clustering(),
}
