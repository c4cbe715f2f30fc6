"""SQL texts (DuckDB) that say the same as a registered query."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


#: Words by runs and checksums (the checksum's table is built bit by bit), near words by the
#: texts that are left when one letter is taken out.
SPELLING = f"""
WITH RECURSIVE crc_bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_bits WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
         unnest(regexp_extract_all({_lowered("text")}, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run
  FROM documents
),
doc_runs AS (SELECT doc, run, count(*) AS c FROM runs GROUP BY ALL),
coded AS (
  SELECT run, c, flatten(list_transform(string_split(doc || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
                   ELSE [CAST(192 | (unicode(x) >> 6) AS BIGINT), CAST(128 | (unicode(x) & 63) AS BIGINT)] END)) AS bytes
  FROM doc_runs
),
summed AS (
  SELECT run, c, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
    lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS h
  FROM coded, crc_table
),
cut AS (
  SELECT c, CASE WHEN h % 97 = 0
                 THEN substring(run, 1, CAST(h % length(run) AS INTEGER)) || substring(run, CAST(h % length(run) AS INTEGER) + 2)
                 ELSE run END AS word
  FROM summed
),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
),
dels AS (
  SELECT word, i, substring(word, 1, CAST(i AS INTEGER) - 1) || substring(word, CAST(i AS INTEGER) + 1) AS d
  FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)
),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM dels a JOIN dels b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION
  SELECT d.word, w.word FROM dels d JOIN words w ON w.word = d.d
  UNION
  SELECT w.word, d.word FROM dels d JOIN words w ON w.word = d.d
),
best AS (
  SELECT a AS word, b AS near, wb.n AS near_n, count(*) OVER (PARTITION BY a) AS n_near,
         row_number() OVER (PARTITION BY a ORDER BY wb.n DESC, b) AS place
  FROM pairs JOIN words wb ON wb.word = b
),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word AND place = 1
),
walk(word, here) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT walk.word, form FROM walk JOIN forms ON forms.word = walk.here WHERE form IS NOT NULL
),
ends AS (SELECT walk.word, walk.here AS root FROM walk JOIN forms ON forms.word = walk.here WHERE form IS NULL)
SELECT forms.word, n, n_near, form, form_n, root FROM forms JOIN ends USING (word)
"""

#: Counts of all phrases of 1 to 5 words, without a graph.
PHRASES = f"""
WITH RECURSIVE pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array({_lowered("text")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM listed GROUP BY lang),
grams AS (
  SELECT lang, k AS size, array_to_string(words[i : i + k - 1], ' ') AS phrase
  FROM listed, range(1, 6) s(k), LATERAL (SELECT unnest(range(1, len(words) - k + 2)) AS i)
),
counts AS (SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
split AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
inner_ones AS (
  SELECT a.lang, a.phrase FROM split a
  JOIN (SELECT lang, f, unnest([array_to_string(w[: size - 1], ' '), array_to_string(w[2 :], ' ')]) AS part FROM split WHERE size > 2) b
    ON a.lang = b.lang AND a.phrase = b.part AND b.f >= a.f
),
cuts AS (
  SELECT lang, phrase, size, f AS a, k, array_to_string(w[: k], ' ') AS p, array_to_string(w[k + 1 :], ' ') AS q
  FROM split, LATERAL (SELECT unnest(range(1, size)) AS k)
  WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM inner_ones)
),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.size, a, l.f AS l, r.f AS r, n, k,
         (CAST(1000 AS HUGEINT) * a * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM cuts
  JOIN counts l ON l.lang = cuts.lang AND l.phrase = p
  JOIN counts r ON r.lang = cuts.lang AND r.phrase = q
  JOIN totals ON totals.lang = cuts.lang
),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1
),
edges AS (
  SELECT lang, phrase AS gram, array_to_string(w[: 4], ' ') AS src, array_to_string(w[2 :], ' ') AS dst, w[5] AS last
  FROM split WHERE size = 5
),
unary AS (
  SELECT i.lang, i.before, o.gram
  FROM (SELECT lang, dst AS node, min(gram) AS before FROM edges GROUP BY ALL HAVING count(*) = 1) i
  JOIN (SELECT lang, src AS node, min(gram) AS gram FROM edges GROUP BY ALL HAVING count(*) = 1) o
    ON i.lang = o.lang AND i.node = o.node
  WHERE before <> gram
),
steps(lang, head, gram, place, path) AS (
  SELECT lang, gram, gram, 0, gram FROM edges WHERE (lang, gram) NOT IN (SELECT (lang, gram) FROM unary)
  UNION ALL
  SELECT s.lang, s.head, u.gram, s.place + 1, s.path || ' ' || e.last
  FROM steps s JOIN unary u ON u.lang = s.lang AND u.before = s.gram JOIN edges e ON e.lang = u.lang AND e.gram = u.gram
),
whole AS (
  SELECT s.lang, s.gram, m.path FROM steps s
  JOIN (SELECT lang, head, arg_max(path, place) AS path FROM steps GROUP BY ALL) m ON m.lang = s.lang AND m.head = s.head
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, CAST(r.score AS BIGINT) AS score,
       CASE WHEN r.size = 5 THEN coalesce(whole.path, r.phrase) END AS path
FROM ranked r LEFT JOIN whole ON whole.lang = r.lang AND whole.gram = r.phrase
WHERE r.rank <= 2000
"""

_SPACED, _ALNUM = "'[^\\x20\\x09-\\x0D]+'", "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
#: Documents with a number per row, so that rows with one id or none are told apart.
_NUMBERED = "docs AS (SELECT *, row_number() OVER () AS row FROM documents)"

#: All pairs of different sets that share a word, without prefixes; a set is its sorted words.
LINES = f"""
WITH {_NUMBERED},
split AS (
  SELECT row, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no
  FROM docs WHERE text IS NOT NULL
),
lines AS (
  SELECT row, doc_id, no, list_sort(list_distinct(regexp_extract_all(lower(line), {_SPACED}))) AS words
  FROM split WHERE regexp_matches(line, {_SPACED})
),
sets AS (SELECT words, min((coalesce(doc_id, -9223372036854775808), row, no)) AS spot FROM lines GROUP BY words),
listed AS (SELECT row_number() OVER (ORDER BY spot) AS id, spot, words, len(words) AS size FROM sets),
tokens AS (SELECT id, size, unnest(words) AS token FROM listed),
pairs AS (
  SELECT a.id AS a, b.id AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.id < b.id
   AND 100 * least(a.size, b.size) >= 80 * greatest(a.size, b.size)
  GROUP BY a.id, b.id, a.size, b.size HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))
),
counted AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM pairs UNION ALL SELECT b FROM pairs) GROUP BY id),
per AS (
  SELECT spot[2] AS row, sum(coalesce(n, 0)) AS n_links, list(spot[3] ORDER BY spot[3]) FILTER (id NOT IN (SELECT b FROM pairs)) AS kept
  FROM listed LEFT JOIN counted USING (id) GROUP BY ALL
),
sizes AS (SELECT row, count(*) AS n FROM lines GROUP BY row)
SELECT doc_id, coalesce(n, 0) AS n_lines, coalesce(n, 0) - coalesce(len(kept), 0) AS n_removed,
       CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(array_to_string(kept, ','), '') AS kept_lines
FROM docs LEFT JOIN sizes USING (row) LEFT JOIN per USING (row)
"""

#: Sizes of all intersections of different sets, then the documents that links reach.
NEAR = f"""
WITH RECURSIVE listed AS (SELECT doc_id, coalesce(regexp_extract_all({_lowered("text")}, {_SPACED}), []) AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
           range(1, greatest(len(words) - 1, 2)), lambda i: array_to_string(words[i : i + 2], ' ')))) END AS shingles
  FROM listed
),
classes AS (SELECT shingles, min(doc_id) AS rep, len(shingles) AS size FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
items AS (SELECT rep, size, unnest(shingles) AS shingle FROM classes),
edges AS (
  SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.shingle = b.shingle AND a.rep <> b.rep
   AND 100 * least(a.size, b.size) >= 85 * greatest(a.size, b.size)
  GROUP BY a.rep, b.rep, a.size, b.size HAVING 100 * count(*) >= 85 * (a.size + b.size - count(*))
),
walk(node, here) AS (SELECT rep, rep FROM classes UNION SELECT node, b FROM walk JOIN edges ON here = a),
lowest AS (SELECT node, min(here) AS component FROM walk GROUP BY node)
SELECT doc_id, len(s.shingles) AS n_shingles, coalesce(rep, doc_id) AS class_id, coalesce(component, doc_id) AS component_id,
       doc_id = coalesce(component, doc_id) AS kept
FROM sets s LEFT JOIN classes c ON c.shingles = s.shingles LEFT JOIN lowest ON node = rep
"""

#: Counts within a document, and lines by the different contents of their host that hold them.
RULES = f"""
WITH {_NUMBERED},
listed AS (
  SELECT row, doc_id, coalesce(source, '') AS host, source IS NULL AS no_host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_SPACED}) AS words
  FROM docs
),
windows AS (
  SELECT row, i, array_to_string(words[i : i + 2], ' ') AS w FROM listed, LATERAL (SELECT unnest(range(1, len(words) - 1)) AS i)
),
twice AS (SELECT row, unnest([i, i + 1, i + 2]) AS i FROM (SELECT *, count(*) OVER (PARTITION BY row, w) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT row, count(DISTINCT i) AS n_repeat_words FROM twice GROUP BY row),
lines AS (
  SELECT row, host, no_host, line, regexp_extract_all({_lowered("line")}, {_SPACED}) AS w
  FROM (SELECT row, host, no_host, unnest(string_split(text, chr(10))) AS line FROM listed)
  WHERE regexp_matches(line, {_SPACED})
),
dups AS (SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY row),
normed AS (SELECT row, host, no_host, array_to_string(w, ' ') AS line, sum(len(w)) AS n FROM lines GROUP BY ALL),
contents AS (SELECT row, md5(string_agg(line, chr(10) ORDER BY line)) AS content FROM normed GROUP BY row),
hosts AS (
  SELECT host, no_host, count(DISTINCT coalesce(content, '')) AS host_docs FROM listed LEFT JOIN contents USING (row) GROUP BY ALL
),
common AS (
  SELECT host, no_host, line FROM normed JOIN contents USING (row) JOIN hosts USING (host, no_host)
  GROUP BY host, no_host, line, host_docs
  HAVING count(DISTINCT content) > 10
      OR (count(DISTINCT content) >= 5 AND count(DISTINCT content) > CAST(0.1 AS DOUBLE) * host_docs)
),
removed AS (SELECT row, sum(n) AS n, count(*) AS n_lines FROM normed JOIN common USING (host, no_host, line) GROUP BY row),
counted AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(removed.n_lines, 0) AS n_common_lines, CAST(len(words) - coalesce(removed.n, 0) AS BIGINT) AS words_left
  FROM listed LEFT JOIN repeats USING (row) LEFT JOIN dups USING (row) LEFT JOIN removed USING (row)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND words_left >= CAST(0.3 AS DOUBLE) * n_words AND words_left >= 50 AS kept
FROM counted
"""

#: Every window of a document against every window of an item, on the words.
CONTAMINATION = f"""
WITH {_NUMBERED},
items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_lowered("text")}, {_ALNUM}) AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS width, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS win
  FROM items, LATERAL (SELECT unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i) WHERE len(words) > 0
),
listed AS (SELECT row, doc_id, coalesce(regexp_extract_all({_lowered("text")}, {_ALNUM}), []) AS words FROM docs),
places AS (
  SELECT row, width, i, array_to_string(words[i : i + width - 1], ' ') AS win
  FROM listed, (SELECT DISTINCT width FROM windows), LATERAL (SELECT unnest(range(1, len(words) - width + 2)) AS i)
),
found AS (SELECT row, i, width, item FROM places JOIN windows USING (width, win)),
hit AS (SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(i, i + width)) AS place FROM found) GROUP BY row),
named AS (SELECT row, list_sort(list(DISTINCT item)) AS ids FROM found GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, n IS NOT NULL AS contaminated
FROM listed LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""

#: Every string of 50 bytes, as hexadecimal digits, with the smallest document that it starts in.
REPEATS = f"""
WITH {_NUMBERED},
bytes AS (SELECT row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM docs),
blocks AS (  -- with the 49 bytes after them
  SELECT row, doc_id, o, substring(h, 2 * o + 1, 2 * 561) AS h
  FROM bytes, LATERAL (SELECT unnest(range(0, CAST(length(h) // 2 AS BIGINT), 512)) AS o)
),
starts AS (
  SELECT row, doc_id, o + i AS p, substring(h, 2 * i + 1, 100) AS s
  FROM blocks, LATERAL (SELECT unnest(range(0, CAST(length(h) // 2 - 49 AS BIGINT))) AS i)
),
low AS (SELECT s, min(doc_id) AS low FROM starts GROUP BY s HAVING count(*) > 1),
gone AS (SELECT row, p FROM starts JOIN low USING (s) WHERE low < doc_id OR (doc_id IS NULL AND low IS NOT NULL)),
marked AS (SELECT row, p, coalesce(p - lag(p) OVER (PARTITION BY row ORDER BY p) > 50, true) AS fresh FROM gone),
runs AS (
  SELECT row, run, min(p) AS a, max(p) + 50 AS b
  FROM (SELECT row, p, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY row ORDER BY p) AS run FROM marked) GROUP BY row, run
),
gaps AS (
  SELECT row, run, a, b, substring(h, 2 * coalesce(lag(b) OVER w, 0) + 1, 2 * (a - coalesce(lag(b) OVER w, 0))) AS piece,
         CASE WHEN lead(a) OVER w IS NULL THEN substring(h, 2 * b + 1) ELSE '' END AS tail
  FROM runs JOIN bytes USING (row) WINDOW w AS (PARTITION BY row ORDER BY run)
),
left_over AS (
  SELECT row, string_agg(piece || tail, '' ORDER BY run) AS h, CAST(sum(b - a) AS BIGINT) AS removed, count(*) AS n FROM gaps GROUP BY row
)
SELECT doc_id, length(bytes.h) // 2 AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(coalesce(l.h, bytes.h))) AS kept_sha256
FROM bytes LEFT JOIN left_over l USING (row)
"""

ORACLES = {
    "op1_line_dedup": LINES, "op2_near_dedup": NEAR, "op3_quality_rules": RULES, "op7_decontamination": CONTAMINATION,
    "op8_suffix_dedup": REPEATS, "op11_spelling_variants": SPELLING, "op13_phrases": PHRASES,
}
