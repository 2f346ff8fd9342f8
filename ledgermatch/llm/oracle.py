"""DuckDB SQL for the queries that SQL can express, from the contract's words; op4's method adds its two parameters (fence, least spreads)."""

from __future__ import annotations

from ledgermatch.llm.quality_rules import FENCE, LEAST_SPREAD, MAX_REPEATED_PERCENT, MIN_WORDS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
near AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
link AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT DISTINCT a AS x, a AS y FROM link UNION SELECT reach.x, link.b FROM reach JOIN link ON reach.y = link.a),
component AS (SELECT x, min(y) AS m FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.m, d.doc_id) AS component_id, d.doc_id = coalesce(c.m, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN component c ON c.x = d.doc_id"""


def _share(pattern: str) -> str:
    return f"length(regexp_replace(t, '{pattern}', '', 'g'))"


def _quality_rules(min_group: int = 50) -> str:
    def quartile(m: str, p: float, only: str = "") -> str:
        return f"list_sort(list({m}){only})[greatest(1, ceil({p} * count(*){only}))::BIGINT]"

    def limits(m: str) -> str:
        # Symbols and repeated lines are absent from most texts: the quartiles of those that have some, and 0 if none has.
        only = f" FILTER ({m} > 0)" if m in ("symbol_share", "dup_line_share") else ""
        q1, q2, q3 = (quartile(m, p, only) for p in (0.25, 0.5, 0.75))
        start = f"coalesce({q2}, 0)" if only else q3
        return f"{start} + {FENCE} * greatest(coalesce({q3} - {q1}, 0), {LEAST_SPREAD[m]}) AS {m}"

    levels = ", ".join(limits(m) for m in LEAST_SPREAD)
    fits = " AND ".join(f"m.{m} <= CASE WHEN l0.n >= {min_group} THEN l0.{m} WHEN l1.n >= {min_group} THEN l1.{m} ELSE l2.{m} END" for m in LEAST_SPREAD)
    return rf"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM w WHERE len(w) >= 5),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM twice) GROUP BY 1),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
c AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, {_share(r'[\x20\x09-\x0D]+')}::BIGINT AS word_chars,
         {_share('[^#*$%&|<>]+')}::BIGINT AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         coalesce(l.n, 0) AS n_lines, {_share(r'[\p{L}\p{M}\p{N}\x20\x09-\x0D]+')} AS marks, {_share(r'[^\p{Lu}]+')} AS capitals
  FROM w LEFT JOIN repeated r USING (doc_id) LEFT JOIN lines l USING (doc_id)),
m AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
         n_symbols / greatest(word_chars, 1) AS symbol_share, marks / greatest(word_chars, 1) AS mark_share,
         capitals / greatest(word_chars, 1) AS capital_share, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
         word_chars / greatest(n_words, 1) AS word_length FROM c),
passed AS (SELECT * FROM m WHERE NOT base_failed),
l0 AS (SELECT lang, source, count(*) AS n, {levels} FROM passed GROUP BY lang, source),
l1 AS (SELECT lang, count(*) AS n, {levels} FROM passed GROUP BY lang),
l2 AS (SELECT {levels} FROM passed)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {fits} AS kept,
       {', '.join('m.' + m for m in LEAST_SPREAD)}
FROM m LEFT JOIN l0 ON m.lang = l0.lang AND m.source = l0.source LEFT JOIN l1 ON m.lang = l1.lang, l2"""


DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
         unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS g
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM d, sizes WHERE len(w) >= n),
found AS (SELECT doc_id, i, n, item_id FROM runs JOIN windows USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

SHARDING = """
WITH steps AS (
  SELECT list(list_reduce([n] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)),
d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size,
         xor(4294967295, list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32 FROM documents, steps),
p AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS start, sum(size) OVER () AS total,
         row_number() OVER (ORDER BY doc_id, text_crc32, size) AS i FROM d),
s AS (SELECT *, least(23, (2 * start + size) * 24 // (2 * total))::INTEGER AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY i) - 1 AS slot,
       NULL::INTEGER AS grown_shard FROM s"""


def url_filter(rules) -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return rf"""
WITH u AS (
  SELECT row_number() OVER () AS i, page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
r(h, p, v) AS (VALUES {values}),
best AS (
  SELECT i, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY i)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (i)"""


VECTOR_SEARCH = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, min(v) AS v FROM whole GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS score
  FROM e q JOIN e c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score::BIGINT AS score FROM r WHERE rank <= 20"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM pieces, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size),
f AS (SELECT lang, phrase, size, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY 1),
candidate AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 10),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:size], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate)),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, x.a AS l, y.a AS r, (1000000::HUGEINT * cut.a * cut.a // (x.a::HUGEINT * y.a))::BIGINT AS score, k
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = first JOIN f y ON y.lang = cut.lang AND y.phrase = rest),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
cover AS (
  SELECT lang, part, max(a) AS a FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM candidate WHERE size = 3)
  GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN cover c ON c.lang = s.lang AND c.part = s.phrase WHERE c.a IS NULL OR 100 * c.a < 50 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

SPELLING_VARIANTS = rf"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce([n] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295] || list_transform(
           regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM runs, steps),
slipped AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT DISTINCT a, b FROM (
    SELECT x.word AS a, y.word AS b FROM cuts x JOIN cuts y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
    UNION ALL SELECT x.word, w.word FROM cuts x JOIN words w ON w.word = x.rest
    UNION ALL SELECT w.word, x.word FROM cuts x JOIN words w ON w.word = x.rest)),
near AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, (-w.n, b)) AS best, max(w.n) AS best_n FROM pairs JOIN words w ON w.word = b GROUP BY a),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)),
chain AS (
  SELECT word, word AS reached FROM formed UNION ALL SELECT chain.word, f.form FROM chain JOIN formed f ON f.word = chain.reached WHERE f.form IS NOT NULL),
ends AS (SELECT chain.word, reached AS root FROM chain JOIN formed f ON f.word = chain.reached WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""


QUALITY_RULES = _quality_rules()
