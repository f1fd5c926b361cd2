"""DuckDB SQL of the queries that SQL can express over whole tables.

The others (trained or weighted models, eigenvectors) are held against
brute-force versions in the tests.
"""

from __future__ import annotations

SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MIXING = f"""WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{SPACED}')) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST(([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, 3.0 * source_size AS stop, 3.0 * source_size / weight AS ratio FROM s),
l AS (
  SELECT *, row_number() OVER o AS place,
    ((SELECT sum(source_size) FROM s) - coalesce(sum(stop) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r WINDOW o AS (ORDER BY ratio, source NULLS LAST)),
t AS (
  SELECT *, least(stop, weight * (SELECT level FROM l WHERE level <= ratio ORDER BY place LIMIT 1)) AS target FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, CAST(t.target AS DOUBLE) AS target,
    CASE WHEN t.source_size > 0 THEN CAST(floor(floor(t.target) / t.source_size) AS BIGINT) ELSE 0 END AS whole,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(whole * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - whole * source_size - begin)) AS BIGINT) AS taken
FROM p"""

JACCARD = f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '{SPACED}') AS ws FROM documents),
sh AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) >= 5
    THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON least_of.a = w.doc_id"""

RECOMPRESSION = f"""WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS ws FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM w WHERE len(ws) >= 13),
f AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(ws[i:i + 12], ' ')) AS first FROM g),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM f WHERE first < doc_id),
word AS (
  SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""

TOPK = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.w, v.w) AS BIGINT) AS score
  FROM v q, v WHERE q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""

DECONTAMINATION = f"""WITH it AS (
  SELECT item_id, regexp_extract_all({LOWERED}, '{ALNUM}') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS k, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM it WHERE len(ws) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '{ALNUM}') AS ws FROM documents),
sizes AS (SELECT DISTINCT k FROM win),
dw AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, sizes WHERE len(ws) >= k)),
hit AS (
  SELECT doc_id, i, k, item_id FROM dw JOIN win USING (k, g)),
words AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS t
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.t, '')) AS items_sha256, coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((n >> {s}) & 31), 1)"
WARC = f"""WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, min(page_id) OVER (PARTITION BY html) AS first,
    array_to_string(list_transform(list_transform(range(0, 8), lambda g: CAST('0x' || substr(h, g * 5 + 1, 5) AS BIGINT)),
      lambda n: {' || '.join(_DIGIT.format(s=s) for s in (15, 10, 5, 0))}), '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d"""

SUFFIXES = """WITH b AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
g AS (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM b WHERE n >= 100)),
f AS (SELECT doc_id, p FROM g QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
e AS (SELECT doc_id, p, p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100, -1) AS fresh FROM f),
i AS (SELECT doc_id, p, count(*) FILTER (WHERE fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM e),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS z FROM i GROUP BY doc_id, run),
cut AS (
  SELECT doc_id, h, a, z, n, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs JOIN b USING (doc_id)),
kept AS (
  SELECT doc_id, sum(z - a) AS lost, count(*) AS spans,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(z) + 1) AS h
  FROM cut GROUP BY doc_id)
SELECT b.doc_id, b.n AS n_bytes, CAST(coalesce(lost, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept.h, b.h))) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id)"""

# Patterns of the secret scan, by kind; letters of the first one in either case.
_KEYWORD = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                    for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = "(" + _KEYWORD + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_PATTERNS = [("assign", _ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 2))", 12, 6, "weak_assign"),
             ("access", "AKIA[A-Z0-9]+", "length(m)", 18, 12, "weak_access"),
             ("hex", "[0-9a-f]{12,}", "length(m)", 16, 0, "weak_hex"),
             ("endpoint", r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/-]*)?", "1", 0, 0, "")]
_ROLES = {"assign": "secret", "hex": "secret", "weak_assign": "secret", "weak_hex": "secret", "access": "identifier",
          "weak_access": "identifier", "endpoint": "endpoint"}
_ORDER = ["assign", "access", "hex", "weak_assign", "weak_access", "weak_hex", "endpoint"]


def _found(strong: str, pattern: str, length: str, least: int, weak: int, weak_name: str) -> str:
    kind = f"CASE WHEN {length} >= {least} THEN '{strong}' WHEN {length} >= {weak} THEN nullif('{weak_name}', '') END"
    return f"""SELECT doc_id, s, e, kind FROM (
  SELECT doc_id, z - length(m) AS s, z AS e, {kind} AS kind FROM (
    SELECT doc_id, m, sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS z FROM (
      SELECT doc_id, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, unnest(range(1, len(ms) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM t)
      WHERE len(ms) > 0))) WHERE kind IS NOT NULL"""


SECRETS = f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS (
  SELECT kind, o, role FROM (VALUES {", ".join(f"('{k}', {o}, '{_ROLES[k]}')" for o, k in enumerate(_ORDER))}) AS v(kind, o, role)),
f AS (SELECT * FROM ({" UNION ALL ".join(_found(*p) for p in _PATTERNS)}) JOIN k USING (kind)),
near AS (
  SELECT DISTINCT w.doc_id, w.s, w.e, w.kind, w.o FROM f w JOIN f p ON w.doc_id = p.doc_id AND w.o > 2
    AND ((w.role = 'secret' AND p.role IN ('identifier', 'endpoint')) OR (w.role <> 'secret' AND p.role = 'secret'))
    AND p.s - w.e <= 120 AND w.s - p.e <= 120 AND (p.s >= w.e OR w.s >= p.e)),
every AS (SELECT doc_id, s, e, kind, o FROM f WHERE o <= 2 UNION ALL SELECT * FROM near),
r AS (
  SELECT doc_id, count(*) FILTER (WHERE o = 0) AS n_assign, count(*) FILTER (WHERE o = 1) AS n_access,
    count(*) FILTER (WHERE o = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (WHERE o <= 2) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans
  FROM every GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN r USING (doc_id)"""

MINHASH = f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '{SPACED}') AS ws FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) >= 2
    THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END)) AS s FROM w),
nodes AS (SELECT min(doc_id) AS node, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
sh AS (SELECT node, n, unnest(s) AS g FROM nodes),
df AS (SELECT g, count(*) AS c FROM sh GROUP BY g),
placed AS (SELECT node, n, g, row_number() OVER (PARTITION BY node ORDER BY c, g) AS place FROM sh JOIN df USING (g)),
pre AS (SELECT * FROM placed WHERE place <= n - ceil(0.8 * n) + 1),
pair AS (
  SELECT DISTINCT a.node AS a, b.node AS b FROM pre a JOIN pre b ON a.g = b.g AND a.node < b.node
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
link AS (
  SELECT a, b FROM (
    SELECT a, b, x.n AS p, y.n AS q, len(list_intersect(x.s, y.s)) AS c
    FROM pair JOIN nodes x ON x.node = a JOIN nodes y ON y.node = b) WHERE 100 * c >= 80 * (p + q - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, l.b FROM reach JOIN both_ways l ON reach.b = l.a),
least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(least(node, m), node, doc_id) AS component_id,
  doc_id = coalesce(least(node, m), node, doc_id) AS kept
FROM sets LEFT JOIN nodes USING (s) LEFT JOIN least_of ON a = node"""

_CLUSTER_ROUND = """a{n} AS MATERIALIZED (
  SELECT i, min_by(k, (d, k)) AS k, min(d) AS d FROM (
    SELECT e.i, c.k, sum((e.x - c.x) * (e.x - c.x)) AS d FROM e JOIN c{n} c USING (j) GROUP BY ALL) GROUP BY i)"""
_CLUSTER_MOVE = """c{m} AS MATERIALIZED (
  SELECT c.k, c.j, coalesce(s.x, c.x) AS x FROM c{n} c LEFT JOIN (
    SELECT k, j, (t - ((t % n) + n) % n) // n AS x FROM (
      SELECT a.k, e.j, sum(e.x) AS t, count(*) AS n FROM a{n} a JOIN e USING (i) GROUP BY ALL)) s USING (k, j))"""
CLUSTERING = """WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS MATERIALIZED (SELECT i, unnest(range(64)) AS j, unnest(w) AS x FROM v),
c0 AS MATERIALIZED (
  SELECT k, j, x FROM e JOIN (
    SELECT i, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM v QUALIFY k < 8) USING (i)),
""" + ",\n".join(_CLUSTER_ROUND.format(n=n) + ",\n" + _CLUSTER_MOVE.format(n=n, m=n + 1) for n in range(10)) + """,
""" + _CLUSTER_ROUND.format(n=10) + """,
h AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c10 GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a10 JOIN h USING (k) JOIN v USING (i)"""

ORACLES: dict[str, str] = {
    "op3_mixing": MIXING,
    "op4_suffixes": SUFFIXES,
    "op5_jaccard": JACCARD,
    "op6_secrets": SECRETS,
    "op7_recompression": RECOMPRESSION,
    "op8_topk": TOPK,
    "op9_decontamination": DECONTAMINATION,
    "op10_warc": WARC,
    "op12_minhash": MINHASH,
    "op13_clustering": CLUSTERING,
}
