"""The same results as DuckDB SQL, for the queries that SQL can express."""

from __future__ import annotations

# Phrases by their words: all n-grams are counted, cut and ranked as defined.
COLLOCATIONS = r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]'), lambda x: x <> '') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM i, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS f FROM g GROUP BY lang, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
part AS (SELECT lang, a AS longer, array_to_string(w[s.s:s.s + m.m - 1], ' ') AS phrase FROM c, (SELECT unnest([1, 2, 3, 4]) AS s) s, (SELECT unnest([2, 3, 4]) AS m) m
  WHERE m.m < c.k AND s.s + m.m - 1 <= c.k),
inside AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN part USING (lang, phrase) WHERE 100 * part.longer >= 100 * c.a),
kept AS (SELECT c.* FROM c ANTI JOIN inside USING (lang, phrase)),
cut AS (SELECT kept.lang, kept.phrase, a, j.j AS j, array_to_string(w[1:j.j], ' ') AS l, array_to_string(w[j.j + 1:], ' ') AS r
  FROM kept, (SELECT unnest([1, 2, 3, 4]) AS j) j WHERE j.j < kept.k),
s AS (SELECT cut.lang, cut.phrase, a, j, fl.f AS l, fr.f AS r, n.n, (1000::HUGEINT * a * n.n // (fl.f::HUGEINT * fr.f))::BIGINT AS score
  FROM cut JOIN f fl ON fl.lang = cut.lang AND fl.phrase = cut.l JOIN f fr ON fr.lang = cut.lang AND fr.phrase = cut.r JOIN n ON n.lang = cut.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM s),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""

# CRC-32 bit by bit; then the cheapest edits row by row, one (cost, audit) for each state of the pattern.
CONVERSATIONS = r"""WITH RECURSIVE base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS b FROM conversations),
hashed AS (SELECT *, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
  lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 20 AS m FROM base),
damaged AS (SELECT conv_id, turn, CASE m WHEN 4 THEN 'user' ELSE role END AS role,
  CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE m WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE m <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS spoken FROM damaged),
coded AS (SELECT conv_id, turn, role, text, i, CASE left(role, 1) WHEN 'u' THEN 0 WHEN 'a' THEN 1 WHEN 's' THEN 2 ELSE 3 END AS w,
  CASE WHEN spoken = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
    WHEN right(spoken, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS f FROM placed),
steps AS (SELECT *, lag(w) OVER (PARTITION BY conv_id ORDER BY i) AS before, count(*) OVER (PARTITION BY conv_id) AS n,
  f IN (0, 3) AS stays, CASE f WHEN 3 THEN 5 ELSE 0 END AS x FROM coded),
r(conv_id, i, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), {'c': 0, 'a': ''}, {'c': 1000000000, 'a': ''}, {'c': 1000000000, 'a': ''}, {'c': 1000000000, 'a': ''} FROM steps
  UNION ALL
  SELECT conv_id, i,
    {'c': t0.c + 2, 'a': t0.a || 'D'},
    list_min([{'c': t1.c + 2, 'a': t1.a || 'D'}, {'c': CASE WHEN stays AND w = 2 THEN t0.c + x ELSE 1000000000 END, 'a': t0.a || 'K'}]),
    list_min(list_concat([{'c': t2.c + 2, 'a': t2.a || 'D'}], list_transform([t0, t1, t3], lambda t: {'c': CASE WHEN stays AND w = 0 THEN t.c + x ELSE 1000000000 END, 'a': t.a || 'K'}),
      list_transform([t0, t1, t3], lambda t: {'c': CASE WHEN stays THEN t.c + x + 1 ELSE 1000000000 END, 'a': t.a || 'R'}))),
    list_min([{'c': t3.c + 2, 'a': t3.a || 'D'}, {'c': CASE WHEN stays AND w = 1 THEN t2.c + x ELSE 1000000000 END, 'a': t2.a || 'K'},
      {'c': CASE WHEN stays THEN t2.c + x + 1 ELSE 1000000000 END, 'a': t2.a || 'R'}])
  FROM (SELECT r.conv_id, steps.i, w, x, stays, s0 AS t0, s1 AS t1,
      list_min([s2, {'c': s0.c + 5, 'a': s0.a || 'I'}, {'c': s1.c + 5, 'a': s1.a || 'I'}, {'c': s3.c + 5, 'a': s3.a || 'I'}]) AS t2,
      list_min([s3, {'c': s2.c + 5, 'a': s2.a || 'I'}, {'c': s0.c + 10, 'a': s0.a || 'II'}, {'c': s1.c + 10, 'a': s1.a || 'II'}]) AS t3
    FROM r JOIN steps ON steps.conv_id IS NOT DISTINCT FROM r.conv_id AND steps.i = r.i + 1)),
done AS (SELECT r.conv_id, list_min([s0, s3, {'c': s2.c + 5, 'a': s2.a || 'I'}, {'c': s1.c + 10, 'a': s1.a || 'II'}]) AS s
  FROM r JOIN (SELECT conv_id, max(i) AS n FROM steps GROUP BY 1) z ON z.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = z.n),
edits AS (SELECT conv_id, unnest(string_split(s.a, '')) AS e, generate_subscripts(string_split(s.a, ''), 1) AS j FROM done WHERE s.a <> ''),
numbered AS (SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS k FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
said AS (SELECT numbered.conv_id, e, j, k, role, CASE WHEN e = 'I' THEN '' ELSE text END AS text, coalesce(e = 'K' AND k = 1 AND w = 2, false) AS system
  FROM numbered LEFT JOIN coded ON coded.conv_id IS NOT DISTINCT FROM numbered.conv_id AND coded.i = numbered.i AND e <> 'I' WHERE e <> 'D'),
lines AS (SELECT *, max(CAST(system AS INTEGER)) OVER (PARTITION BY conv_id) AS shift FROM said),
texts AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (k - 1 - shift) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS t FROM lines GROUP BY 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 1) AS blank, count(*) FILTER (f = 2) AS duplicate,
  count(*) FILTER (f = 3) AS truncated, count(*) FILTER (before IS NOT NULL AND NOT (before = 2 AND w = 0 OR before = 0 AND w = 1 OR before = 1 AND w = 0)) AS illegal FROM steps GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(done.s.c, 0) AS BIGINT) AS cost, coalesce(done.s.a, '') AS audit, sha256(coalesce(texts.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM c.conv_id"""
