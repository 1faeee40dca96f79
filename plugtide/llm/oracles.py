"""Reference SQL (DuckDB) for the text operators that SQL can express.

It goes its own ways: rows of spans instead of arrays, all pairs that share a shingle instead of
signatures, a recursive walk instead of stars, windows instead of grouped texts, every window of every
text instead of anchors, single documents and terms instead of classes and cells.
"""

from __future__ import annotations

_SECRET_WORDS = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"


def _matches(kind: int, pattern: str, group: int) -> str:
    """Rows (rid, kind, s, e, token, counted) of all matches of one pattern."""
    quoted = pattern.replace("'", "''")
    return f"""
          SELECT rid, {kind} AS kind, x.s AS s, x.s + length(x.token) AS e, x.token AS token, length(x.counted) AS counted
          FROM (
            SELECT rid, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
              's': list_sum(list_transform(gaps[1:i], lambda y: length(y)))
                   + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0),
              'token': m[i], 'counted': g[i]}})) AS x
            FROM (SELECT rid, regexp_extract_all(t, '{quoted}') AS m, regexp_extract_all(t, '{quoted}', {group}) AS g,
                         string_split_regex(t, '{quoted}') AS gaps FROM texts))"""


_ASSIGN = r"""(?:%s)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""" % _SECRET_WORDS
_BELOW = "(1 / (1 + exp(-(0.07056 * ({0}) * ({0}) * ({0}) + 1.5976 * ({0})))))"
_BEYOND = "(2 * " + _BELOW.format("-abs({0})") + ")"

SECRETS = f"""
        WITH texts AS MATERIALIZED (
          SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
        base AS MATERIALIZED (
          SELECT rid, kind, s, e FROM ({_matches(0, _ASSIGN, 1)}) WHERE counted >= 12
          UNION ALL SELECT rid, kind, s, e FROM ({_matches(1, "AKIA[A-Z0-9]+", 0)}) WHERE counted >= 18
          UNION ALL SELECT rid, kind, s, e FROM ({_matches(2, "[0-9a-f]+", 0)}) WHERE counted >= 16),
        tokens AS (
          SELECT rid, s, e, translate(token, '-_', '+/') AS p, CAST(length(token) AS DOUBLE) AS n
          FROM ({_matches(3, "[A-Za-z0-9+/_-]{16,}", 0)}) x
          WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = x.rid AND b.s < x.e AND x.s < b.e)),
        alphabets(o, pattern, alphabet, two, three) AS (VALUES
          (1, '^[0-9]+$', '0123456789', 0.16::DOUBLE, 0.034::DOUBLE),
          (2, '^[0-9a-f]+$', '0123456789abcdef', 0.12::DOUBLE, 0.019::DOUBLE),
          (3, '^[0-9A-F]+$', '0123456789ABCDEF', 0.12::DOUBLE, 0.019::DOUBLE),
          (4, '^[A-Z2-7]+$', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 0.068::DOUBLE, 0.0058::DOUBLE),
          (5, '', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/', 0.068::DOUBLE, 0.0058::DOUBLE)),
        inferred AS (
          SELECT *, CAST(length(alphabet) AS DOUBLE) AS size, string_split(p, '') AS c FROM tokens
          JOIN alphabets ON regexp_matches(p, pattern) QUALIFY row_number() OVER (PARTITION BY rid, s ORDER BY o) = 1),
        valued AS (
          SELECT *, list_transform(c, lambda y: instr(alphabet, y) - 1 - (size - 1) / 2) AS v,
                 list_sum(list_transform(list_distinct(c), lambda y: pow(len(list_filter(c, lambda z: z = y)), 2))) AS squares
          FROM inferred),
        measured AS (
          SELECT *, size / n * squares - n AS chi, len(list_filter(v, lambda y: y > 0)) AS above,
                 1 + len(list_filter(range(1, len(v)), lambda i: (v[i] > 0) <> (v[i + 1] > 0))) AS runs,
                 list_sum(list_transform(range(1, len(v)), lambda i: v[i] * v[i + 1])) AS products FROM valued),
        normal AS (
          SELECT *, size * (1 + (n - 1) * two) - n AS expected,
                 2 * size / n * sqrt(n * (n - 1) / 2 * two * (1 - two) + n * (n - 1) * (n - 2) * (three - two * two)) AS spread,
                 1 + 2 * above * (n - above) / n AS mean_runs, products / ((size * size - 1) / 12) / sqrt(n - 1) AS serial
          FROM measured),
        chances AS (
          SELECT *, {_BELOW.format("(chi - expected) / spread")} AS p_text, {_BEYOND.format("serial")} AS p_serial,
                 CASE WHEN (mean_runs - 1) * (mean_runs - 2) > 0 THEN
                   {_BEYOND.format("(runs - mean_runs) / sqrt((mean_runs - 1) * (mean_runs - 2) / (n - 1))")} ELSE 0 END AS p_runs
          FROM normal),
        stepped AS MATERIALIZED (
          SELECT rid, s, e, CASE WHEN n >= 128 THEN 128 WHEN n >= 64 THEN 64 WHEN n >= 40 THEN 40 WHEN n >= 28 THEN 28 WHEN n >= 20 THEN 20 ELSE 16 END AS band,
                 least(floor(-10 * log10(CASE WHEN p_runs < 0.001 OR p_serial < 0.001 THEN 1 ELSE greatest(p_text, 1e-30) END)), 300) AS step
          FROM chances),
        levels AS (
          SELECT band, min(step) AS level FROM (
            SELECT DISTINCT band, step, count(*) OVER (PARTITION BY band) AS total,
                   count(*) OVER (PARTITION BY band ORDER BY step DESC) AS found FROM stepped)
          WHERE total * pow(10, -step / 10) <= 0.05 * found GROUP BY band),
        added AS MATERIALIZED (
          SELECT rid, 3 AS kind, s, e FROM stepped JOIN levels l USING (band) WHERE step >= level),
        named AS (
          SELECT *, (['assign', 'access', 'hex', 'random'])[kind + 1] || ':' || s || ':' || e AS shown
          FROM (SELECT * FROM base UNION ALL SELECT * FROM added))
        SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
               count(*) FILTER (WHERE kind = 2) AS n_hex,
               sha256(coalesce(string_agg(shown, ',' ORDER BY s, kind, e) FILTER (WHERE kind < 3), '')) AS base_sha256,
               coalesce(string_agg(shown, ',' ORDER BY s, kind, e), '') AS spans,
               count(*) FILTER (WHERE kind = 3) AS n_random
        FROM texts LEFT JOIN named USING (rid) GROUP BY rid, doc_id
"""

NEAR = r"""
        WITH RECURSIVE texts AS (
          SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS MATERIALIZED (
          SELECT DISTINCT doc_id, unnest(list_transform(
            range(1, greatest(len(w) - 2, least(len(w), 1)) + 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' '))) AS s
          FROM texts),
        sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS MATERIALIZED (
          SELECT a, b FROM (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
          JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b
          WHERE 100 * c >= 85 * (m.n + n.n - c)),
        reached(a, b) AS (
          SELECT doc_id, doc_id FROM documents
          UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id,
               min(r.b) = d.doc_id AS kept
        FROM (SELECT DISTINCT doc_id FROM documents) d
        JOIN reached r ON r.a = d.doc_id LEFT JOIN sizes n ON n.doc_id = d.doc_id GROUP BY d.doc_id
    """

EXACT = r"""
        WITH d AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d
    """

PASSAGES = r"""
        WITH texts AS MATERIALIZED (
          SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
          FROM documents),
        windows AS MATERIALIZED (
          SELECT rid, doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS s
          FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM texts)),
        gone AS (
          SELECT DISTINCT rid, unnest(range(i, i + 50)) AS i
          FROM windows JOIN (SELECT s, min(doc_id) AS least FROM windows GROUP BY s) USING (s) WHERE least < doc_id),
        words AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts),
        kept AS (
          SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
          FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (rid)
    """

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SEARCH = rf"""
        WITH texts AS MATERIALIZED (
          SELECT row_number() OVER () AS rid, doc_id,
                 regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
          FROM documents),
        sizes AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, sum(len(w))::BIGINT AS terms FROM texts),
        wanted AS MATERIALIZED (
          SELECT item, item_id, term, count(*) AS times FROM (
            SELECT row_number() OVER () AS item, item_id,
                   unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
        held AS MATERIALIZED (
          SELECT rid, doc_id, n, term, count(*) AS tf
          FROM (SELECT rid, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM texts)
          WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
        weights AS (
          SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
          FROM held, sizes GROUP BY term),
        scored AS (
          SELECT item, item_id, rid, doc_id,
                 sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
          FROM held JOIN weights USING (term) JOIN wanted USING (term), sizes GROUP BY ALL)
        SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 20
    """

DIVERGENCE = rf"""
        WITH texts AS MATERIALIZED (
          SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                 regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        held AS MATERIALIZED (
          SELECT lang, source, term, sum(n)::BIGINT AS n, count(*) AS texts
          FROM (SELECT rid, lang, source, term, count(*) AS n FROM (SELECT *, unnest(w) AS term FROM texts) GROUP BY ALL)
          GROUP BY ALL),
        kept AS MATERIALIZED (
          SELECT lang, term, sum(n)::BIGINT AS n FROM held GROUP BY lang, term HAVING sum(texts) >= 10),
        langs AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
        present AS MATERIALIZED (SELECT DISTINCT lang, source FROM texts),
        totals AS (
          SELECT p.lang, p.source, coalesce(sum(h.n) FILTER (WHERE k.term IS NOT NULL), 0)::HUGEINT AS total
          FROM present p LEFT JOIN held h ON h.lang = p.lang AND h.source = p.source
          LEFT JOIN kept k ON k.lang = h.lang AND k.term = h.term GROUP BY ALL),
        shares AS MATERIALIZED (
          SELECT t.lang, t.source, k.term, coalesce(h.n, 0) AS n,
                 (1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 2)) // (t.total + 2 * l.v))::BIGINT AS p,
                 (1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v))::BIGINT AS q
          FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang)
          LEFT JOIN held h ON h.lang = t.lang AND h.source = t.source AND h.term = k.term),
        pairs AS (
          SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
          FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        ranked AS (
          SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value,
                 row_number() OVER (PARTITION BY lang, source ORDER BY coalesce(value, 0) DESC, item)::INTEGER AS rank
          FROM (SELECT a.lang, a.source, b.source AS item FROM present a JOIN present b ON a.lang = b.lang AND a.source <> b.source)
          LEFT JOIN pairs USING (lang, source, item)
          UNION ALL SELECT * FROM (
            SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) AS value,
                   row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // (p + q) DESC, term)::INTEGER AS rank
            FROM shares WHERE n > 0 AND p > q) WHERE rank <= 10)
        SELECT * FROM ranked
    """

ORACLE_SQL: dict[str, str] = {
    "op3_secret_scan": SECRETS,
    "op4_near_dedup": NEAR,
    "op7_exact_dedup": EXACT,
    "op11_substring_dedup": PASSAGES,
    "op12_ranked_search": SEARCH,
    "op13_divergence_audit": DIVERGENCE,
}
