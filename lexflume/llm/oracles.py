"""SQL of the longer results that SQL can state."""

from __future__ import annotations

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

COLLOCATIONS = rf"""
    WITH d AS (
        SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {_LETTERS}) AS t FROM documents
    ), pieces AS (
        SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
    ), ws AS (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
    ), places AS (
        SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM ws, range(1, 6) s(m) WHERE len(w) >= m
    ), f AS (
        SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL
    ), totals AS (
        SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang
    ), c AS (
        SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 100
    ), cuts AS (
        SELECT c.lang, c.m, c.phrase, c.a, t.n, k, x.f AS l, y.f AS r,
               CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(x.f AS HUGEINT) * y.f) AS score
        FROM c JOIN totals t USING (lang), range(1, 5) s(k), f x, f y
        WHERE k < c.m AND x.lang = c.lang AND y.lang = c.lang
          AND x.phrase = array_to_string(c.w[1:k], ' ') AND y.phrase = array_to_string(c.w[k + 1:], ' ')
    ), lowest AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), inner_phrases AS (
        SELECT lang, a, b - s + 1 AS size, array_to_string(w[s:b], ' ') AS phrase
        FROM c, range(1, 6) x(s), range(2, 6) y(b) WHERE s < b AND b <= m AND b - s + 1 < m
    ), covered AS (
        SELECT lang, phrase, max(a) AS around FROM inner_phrases GROUP BY ALL
    ), alone AS (
        SELECT lowest.* FROM lowest LEFT JOIN covered USING (lang, phrase) WHERE around IS NULL OR 100 * around < 100 * a
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, CAST(score AS BIGINT) AS score
    FROM alone QUALIFY rank <= 2000
"""

_PATTERNS = r"""
    (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', '\2', 12),
    (1, 'access', 'AKIA[A-Z0-9]+', '\0', 18),
    (2, 'hex', '[0-9a-f]+', '\0', 16),
    (3, 'issued', 'gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}', '\0', 16),
    (4, 'mixed', '[A-Za-z0-9+/_-]+', '\0', 24)
"""

# chr(1) stands before a match, chr(2) after it and after its value; texts that hold them get chr(3) instead.
CREDENTIALS = rf"""
    WITH kinds(k, name, pattern, value, least) AS (VALUES {_PATTERNS}),
    d AS (
        SELECT row_number() OVER () AS id, doc_id, source,
               translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS t
        FROM documents
    ), marked AS (
        SELECT id, doc_id, source, k, name, least,
               string_split(CASE k
                   {"".join(f"WHEN {k} THEN regexp_replace(t, (SELECT pattern FROM kinds WHERE k = {k}), chr(1) || (SELECT chr(92) || '0' || chr(2) || value FROM kinds WHERE k = {k}) || chr(2), 'g') " for k in range(5))}
               END, chr(1)) AS parts
        FROM d, kinds
    ), numbered AS (
        SELECT id, doc_id, source, k, name, least, unnest(parts) AS p, unnest(range(1, len(parts) + 1)) AS i FROM marked
    ), cut AS (
        SELECT id, doc_id, source, k, name, least, i, string_split(p, chr(2)) AS x FROM numbered
    ), placed AS (
        SELECT *, CASE WHEN i > 1 THEN x[2] END AS v,
               sum(length(x[-1]) + CASE WHEN i > 1 THEN length(x[1]) ELSE 0 END) OVER (PARTITION BY id, k ORDER BY i) - length(x[-1]) AS e
        FROM cut
    ), found AS (
        SELECT id, doc_id, source, k, name, CAST(e - length(x[1]) AS BIGINT) AS s, CAST(e AS BIGINT) AS e, v,
               len(list_distinct(string_split(v, ''))) >= 8 AS looks
        FROM placed
        WHERE i > 1 AND length(v) >= least
          AND (k <> 4 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')))
    ), owners AS (
        SELECT v, count(DISTINCT coalesce('s' || split_part(source, '/', 1), '')) AS owners FROM found GROUP BY v
    ), judged AS (
        SELECT found.*, owners >= 3 AS example, owners < 3 AND looks AS live FROM found JOIN owners USING (v)
    ), listed AS (
        SELECT id, k, s, name || ':' || s || ':' || e AS span, example, live FROM judged
    ), by_doc AS (
        SELECT id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
               string_agg(span, ',' ORDER BY s, k) FILTER (k < 3) AS base,
               string_agg(span, ',' ORDER BY s, k) FILTER (k < 3 OR live) AS spans,
               count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_example,
               string_agg(span, ',' ORDER BY s, k) FILTER (live) AS live_spans
        FROM listed GROUP BY id
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
           coalesce(n_example, 0) AS n_example, coalesce(live_spans, '') AS live_spans
    FROM d LEFT JOIN by_doc USING (id)
"""

# Every \\, < and [ of a role or text is written as two characters; a turn's marks have 19.
_SPECIAL = "len(regexp_extract_all({0}, '[\\\\<\\[]'))"
CHAT = f"""
    WITH c AS (
        SELECT conv_id, turn, role, text FROM conversations UNION ALL
        SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), t AS (
        SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, coalesce(role = 'assistant', false) AS loss,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
        FROM c
    )
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY place)) AS turns_sha256,
           CAST(coalesce(sum(length(x)) FILTER (loss), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(x, '' ORDER BY place) FILTER (loss), '')) AS loss_sha256,
           CAST(sum(19 + length(r) + length(x) + {_SPECIAL.format('r')} + {_SPECIAL.format('x')}) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id
"""
