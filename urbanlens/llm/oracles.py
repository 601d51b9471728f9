"""DuckDB SQL for the operators' queries that SQL can express. The others depend on a
tokenizer, a trained model, a hash function or corpus weights, and are tested against
brute force, exact round trips and held-out accuracy instead."""

from __future__ import annotations

# --- 7: the rules once more, as plain text ------------------------------------------------
_RULES = (  # kind, pattern, measured group, least length
    ("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
               r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("url_login", r"[a-z]{2,10}://[A-Za-z0-9._%+-]{1,64}:[A-Za-z0-9._%+-]{3,64}@", 0, 0),
)
_MATCHES = " UNION ALL ".join(f"""
  SELECT rid, {n} AS ord, '{kind}' AS kind, {least} AS least, unnest(range(1, len(ms) + 1)) AS i, ms, gs, caught
  FROM (SELECT rid, regexp_extract_all(t, '{pattern}', 0) AS ms, string_split_regex(t, '{pattern}') AS gs,
               regexp_extract_all(t, '{pattern}', {group}) AS caught FROM d)""" for n, (kind, pattern, group, least) in enumerate(_RULES))

SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_MATCHES}),
lens AS (SELECT rid, ord, kind, i, ms[i] AS text_, gs[i] AS gap, length(caught[i]) >= least AS kept FROM m),
placed AS (SELECT rid, ord, kind, kept, length(text_) AS n,
                  sum(length(gap) + length(text_)) OVER (PARTITION BY rid, ord ORDER BY i) - length(text_) AS start FROM lens),
spans AS (SELECT rid, ord, kind, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + n AS BIGINT) AS s FROM placed WHERE kept),
found AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                 count(*) FILTER (kind = 'hex') AS n_hex,
                 coalesce(string_agg(s, ',' ORDER BY start, ord) FILTER (ord < 3), '') AS base,
                 string_agg(s, ',' ORDER BY start, ord) AS spans FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (rid)"""

# --- 9: shingles, links and components ------------------------------------------------------
NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, shingle FROM (
        SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[]
                                   WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                                   ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS node, a AS other FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, w.doc_id) AS component_id,
       coalesce(c.component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node AS doc_id, min(other) AS component FROM reach GROUP BY node) c USING (doc_id)"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# --- 12: integer scores of all documents, the ten best of each item -------------------------
_TERMS = rf"unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
SEARCH = f"""
WITH dt AS (SELECT rid, doc_id, t, count(*) AS tf
            FROM (SELECT rid, doc_id, {_TERMS} AS t FROM (SELECT row_number() OVER () AS rid, * FROM documents)) GROUP BY ALL),
size AS (SELECT rid, CAST(sum(tf) AS BIGINT) AS n FROM dt GROUP BY rid),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM size),
weight AS (SELECT t, CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
           FROM (SELECT t, count(*) AS df FROM dt GROUP BY t), total),
asked AS (SELECT iid, item_id, t, count(*) AS times
          FROM (SELECT iid, item_id, {_TERMS} AS t FROM (SELECT row_number() OVER () AS iid, * FROM benchmark)) GROUP BY ALL),
part AS (SELECT rid, doc_id, t, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)) AS part
         FROM dt JOIN size USING (rid), total),
score AS (SELECT iid, item_id, rid, doc_id, CAST(sum(times * w * part) AS BIGINT) AS score
          FROM asked JOIN weight USING (t) JOIN part USING (t) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0) WHERE rank <= 10"""

# --- 13: counts of all phrases, their lowest cut, the first ones of each language ------------
COLLOCATIONS = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
occ AS (SELECT lang, ws[i] AS phrase, 1 AS k FROM places
        UNION ALL SELECT lang, ws[i] || ' ' || ws[i + 1], 2 FROM places WHERE i < len(ws)
        UNION ALL SELECT lang, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2], 3 FROM places WHERE i + 1 < len(ws)),
total AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
f AS (SELECT lang, phrase, k AS words, count(*) AS f FROM occ GROUP BY ALL),
c AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS s FROM f WHERE words > 1 AND f >= 10),
longer AS (SELECT lang, phrase, max(a) AS longest FROM (
             SELECT lang, a, s[1] || ' ' || s[2] AS phrase FROM c WHERE words = 3
             UNION ALL SELECT lang, a, s[2] || ' ' || s[3] FROM c WHERE words = 3) GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < 50 * a),
cuts AS (SELECT lang, phrase, a, 1 AS k, s[1] AS head, array_to_string(s[2:], ' ') AS rest FROM kept
         UNION ALL SELECT lang, phrase, a, 2, s[1] || ' ' || s[2], s[3] FROM kept WHERE words = 3),
scored AS (SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r,
                  CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
           FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = rest),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM scored) WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best) JOIN total USING (lang)
WHERE rank <= 2000"""

ORACLES: dict[str, str] = {"op7_secret_scan": SECRETS, "op9_minmax_neardup": NEAR, "op12_lexical_search": SEARCH,
                           "op13_collocations": COLLOCATIONS}
