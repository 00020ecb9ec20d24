"""The same questions in plain SQL, where SQL can express them on whole tables."""

from __future__ import annotations

from usagemart.llm import collocations, mixing
from usagemart.llm.quality_rules import KEPT_SHARE, LINE_DOCUMENTS

_ITEM_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_ITEM_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, w[i:i + least(len(w), 13) - 1] AS win
  FROM b, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS t(i) WHERE len(w) > 0),
placed AS (
  SELECT r, i, n, w[i:i + n - 1] AS win
  FROM d, (SELECT DISTINCT n FROM windows) s, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT r, i, n, item FROM placed JOIN windows USING (n, win)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT r, i, n FROM hits) h, unnest(range(i, i + n)) AS t(p) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""

_SPACE = r"[\x20\x09-\x0D]"

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host
  FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
runs AS (SELECT r, i, w[i:i + 4] AS run FROM w, unnest(range(1, len(w) - 3)) AS t(i)),
twice AS (SELECT r, run FROM runs GROUP BY r, run HAVING count(*) > 1),
repeated AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, i FROM runs JOIN twice USING (r, run)) x, unnest(range(i, i + 5)) AS t(p) GROUP BY r),
lines AS (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
letters AS (
  SELECT r, host, text, line, trim(regexp_replace(lower(line), '[^\p{{L}}]+', ' ', 'g')) AS letters FROM lines),
normal AS (
  SELECT r, host, text, line, CASE WHEN letters <> '' THEN letters
           ELSE regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g') END AS same FROM letters),
above AS (
  SELECT host, same FROM normal WHERE same <> '' GROUP BY host, same
  HAVING count(DISTINCT text) > {LINE_DOCUMENTS}),
taken AS (
  SELECT r, sum(length(regexp_replace(line, '{_SPACE}', '', 'g')))::BIGINT AS n
  FROM normal JOIN above USING (host, same) GROUP BY r),
dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
c AS (
  SELECT doc_id, len(w.w) AS n_words, length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
         coalesce(taken.n, 0) AS n_taken_chars
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN repeated USING (r) LEFT JOIN taken USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND NOT word_chars - n_taken_chars < {KEPT_SHARE} * word_chars AS kept
FROM c"""

MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS draw
  FROM documents),
s AS (
  SELECT source, sum(size)::HUGEINT AS source_size, {mixing.MAX_EPOCHS} * sum(size)::HUGEINT AS cap,
         ({list(mixing.WEIGHTS)})[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}]::HUGEINT AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER fill AS place, sum(source_size) OVER () - coalesce(sum(cap) OVER (fill ROWS BETWEEN
           UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (fill ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM s WINDOW fill AS (ORDER BY cap / w::DOUBLE, source NULLS LAST)),
level AS (SELECT place, rest, open_weight FROM o WHERE cap * open_weight >= rest * w ORDER BY place LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN o.place < l.place THEN cap::DOUBLE ELSE l.rest::DOUBLE * w::DOUBLE / l.open_weight::DOUBLE END AS target,
         CASE WHEN o.place < l.place THEN cap ELSE (l.rest * w) // l.open_weight END AS goal
  FROM o, level l)
SELECT d.doc_id, d.size::BIGINT AS size, t.source_size::BIGINT AS source_size, t.target,
       CASE WHEN t.source_size = 0 THEN 0 ELSE d.size * (goal // t.source_size) + greatest(0, least(d.size,
         goal % t.source_size - coalesce(sum(d.size) OVER (PARTITION BY t.source ORDER BY d.draw, d.size
                                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) END::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source"""

# A byte at a time: eight shifts, each with the polynomial if the bit that leaves is set.
_CRC = """xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT for i in range(8)],
                                  lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

# Before each row at most one message is inserted (two never lead to a cheaper repair), and up to two at the end.
CONVERSATIONS = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
picked AS (SELECT *, {_CRC.format(text="key")} % 20 AS p FROM keyed),
copied AS (SELECT *, unnest(CASE WHEN p = 3 THEN [1, 2] ELSE [1] END) AS copy FROM picked WHERE p <> 0),
d AS (
  SELECT conv_id, turn, CASE WHEN p = 4 THEN 'user' ELSE role END AS role,
         CASE p WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM copied),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         right(regexp_replace(text, '{_SPACE}+$', ''), 1) AS last FROM d),
m AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen, left(role, 1) AS initial,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM n),
r AS (
  SELECT *, last = '' AS blank, last <> '' AND seen AS duplicate,
         last <> '' AND NOT seen AND last NOT IN ('.', '!', '?') AS truncated FROM m),
inserts(start, ready, inserted) AS (
  VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
edits(ready, done, letter, initial) AS (
  VALUES (0, 0, 'D', NULL), (1, 1, 'D', NULL), (2, 2, 'D', NULL), (3, 3, 'D', NULL),
         (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (2, 3, 'K', 'a'), (3, 2, 'K', 'u'),
         (0, 2, 'R', 'user'), (1, 2, 'R', 'user'), (2, 3, 'R', 'assistant'), (3, 2, 'R', 'user')),
moves AS (
  SELECT r.conv_id, r.i, start, done,
         (CASE WHEN inserted <> '' THEN 3 ELSE 0 END + CASE letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
          + CASE WHEN letter <> 'D' AND truncated THEN 3 ELSE 0 END)::BIGINT AS cost,
         CASE WHEN inserted <> '' THEN 'I' ELSE '' END || letter AS audit,
         CASE WHEN inserted <> '' THEN chr(10) || inserted || ':' ELSE '' END
         || CASE letter WHEN 'K' THEN chr(10) || role || ':' || text WHEN 'R' THEN chr(10) || e.initial || ':' || text
            ELSE '' END AS message
  FROM r, inserts JOIN edits e USING (ready)
  WHERE letter = 'D' OR NOT blank AND NOT duplicate AND (letter = 'R' OR e.initial = r.initial)),
steps(conv_id, i, done, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'message': ''}} FROM r
  UNION ALL
  SELECT s.conv_id, s.i + 1, v.done, min({{'cost': s.best.cost + v.cost, 'audit': s.best.audit || v.audit,
                                         'message': s.best.message || v.message}})
  FROM steps s JOIN moves v ON v.conv_id IS NOT DISTINCT FROM s.conv_id AND v.i = s.i + 1 AND v.start = s.done
  GROUP BY s.conv_id, s.i, v.done),
closings(done, cost, audit, message) AS (
  VALUES (0, 0, '', ''), (1, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 3, 'I', chr(10) || 'assistant:'),
         (3, 0, '', '')),
figures AS (
  SELECT conv_id, max(i) AS i, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id),
ends AS (
  SELECT f.conv_id, min({{'cost': s.best.cost + c.cost, 'audit': s.best.audit || c.audit,
                        'message': s.best.message || c.message}}) AS best
  FROM figures f JOIN steps s ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.i = f.i JOIN closings c USING (done)
  GROUP BY f.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(substr(coalesce(best.message, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN figures f ON o.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN ends e ON o.conv_id IS NOT DISTINCT FROM e.conv_id"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS p, piece
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f AS (
  SELECT lang, k, w[i:i + k - 1] AS words, count(*) AS f
  FROM w, unnest(range(1, 6)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= {collocations.SUPPORT}),
cuts AS (
  SELECT c.lang, c.words, c.f AS a, cut, l.f AS l, r.f AS r, n,
         (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
  FROM c JOIN n USING (lang), unnest(range(1, c.k)) AS s(cut)
  JOIN f l ON l.lang = c.lang AND l.words = c.words[1:cut] JOIN f r ON r.lang = c.lang AND r.words = c.words[cut + 1:]),
least AS (SELECT *, row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) AS place FROM cuts),
within AS (
  SELECT lang, c.words[i:i + k - 1] AS words, max(f) AS f
  FROM (SELECT lang, words, f, len(words) AS size FROM c) c, unnest(range(2, size)) AS s(k),
       unnest(range(1, size - k + 2)) AS t(i) GROUP BY ALL),
kept AS (
  SELECT l.*, array_to_string(l.words, ' ') AS phrase FROM least l LEFT JOIN within x ON x.lang = l.lang AND x.words = l.words
  WHERE place = 1 AND NOT coalesce(100 * x.f >= 100 * a, false)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= {collocations.TOP}"""

SQL: dict[str, str] = {"op2_quality_rules": QUALITY, "op10_decontaminate": DECONTAMINATE,
                       "op11_mixing": MIXING, "op12_conversations": CONVERSATIONS,
                       "op13_collocations": COLLOCATIONS}
