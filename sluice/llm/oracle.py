"""DuckDB SQL that states the expected rows of the corpus queries independently."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

REPETITION = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
grams AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, range(5, 11) r(n))),
seen AS (SELECT doc_id, n, p, count(*) OVER (PARTITION BY doc_id, n, g) AS c,
                row_number() OVER (PARTITION BY doc_id, n, g ORDER BY p) AS r FROM grams),
later AS (SELECT DISTINCT doc_id, n, unnest(range(p, p + n)) AS p FROM seen WHERE r > 1),
again AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS p FROM seen WHERE c > 1 AND n = 5),
covered AS (SELECT doc_id, n, sum(length(word)) AS chars FROM later JOIN words USING (doc_id, p) GROUP BY ALL),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
                 generate_subscripts(string_split(t, chr(10)), 1) AS p FROM d),
dups AS (SELECT doc_id, count(*) AS n_dup, sum(chars) AS chars FROM (
           SELECT doc_id, list_sum([length(x) FOR x IN regexp_extract_all(line, '[^\x20\x09-\x0D]+')]) AS chars,
                  row_number() OVER (PARTITION BY doc_id, line ORDER BY p) AS r FROM lines)
         WHERE r > 1 AND chars > 0 GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
             coalesce((SELECT count(*) FROM again a WHERE a.doc_id = d.doc_id), 0) AS n_repeat_words,
             coalesce(dups.chars, 0) AS dup_line_chars,
             {", ".join(f"coalesce((SELECT chars FROM covered c WHERE c.doc_id = d.doc_id AND c.n = {n}), 0) AS dup_chars_{n}" for n in range(5, 11))}
      FROM d LEFT JOIN dups USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       dup_line_chars::BIGINT AS dup_line_chars,
       {", ".join(f"dup_chars_{n}::BIGINT AS dup_chars_{n}" for n in range(5, 11))},
       base_failed,
       NOT base_failed AND 100 * dup_line_chars <= 20 * word_chars
         {" ".join(f"AND 100 * dup_chars_{n} <= {20 - n} * word_chars" for n in range(5, 11))} AS kept
FROM b
"""

MIXING = rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
r AS (SELECT *, 2 * source_size AS stop, 2 * source_size / weight AS ratio,
             coalesce(sum(2 * source_size) OVER w, 0) AS stopped, coalesce(sum(weight) OVER w, 0) AS weight_below,
             sum(weight) OVER () AS weights, sum(source_size) OVER () AS words
      FROM s WINDOW w AS (ORDER BY 2 * source_size / weight, source IS NOT NULL, source
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, (1.5::DOUBLE * words - stopped) / (weights - weight_below) AS level FROM r),
t AS (SELECT source, source_size,
             least(stop::DOUBLE, coalesce((SELECT arg_min(level, ratio) FROM v x WHERE x.level <= x.ratio), 0) * weight) AS target
      FROM v),
k AS (SELECT *, coalesce('s' || source, '') AS skey, floor(target)::BIGINT AS words, ceil(source_size / 64.0::DOUBLE)::BIGINT AS blocks FROM t),
e AS (SELECT *, (floor(words / greatest(source_size, 1)) * blocks
                 + ceil((words - floor(words / greatest(source_size, 1)) * source_size) / 64))::BIGINT AS need FROM k),
c AS (SELECT *, coalesce(sum(need) OVER (ORDER BY skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below,
             (sum(need) OVER ())::BIGINT AS wanted, count(*) OVER () AS sources FROM e WHERE need > 0),
i AS (SELECT skey, below, need, floor(below * (2147483648::DOUBLE / wanted))::BIGINT AS low,
             floor((below + need) * (2147483648::DOUBLE / wanted))::BIGINT AS high, wanted + wanted // 50 + 64 * sources AS points FROM c),
g AS (SELECT id, id % 2147483648 * 1327217885 % 2147483648 AS point FROM (SELECT unnest(range((SELECT max(points) FROM i))) AS id)),
q AS (SELECT skey, row_number() OVER (PARTITION BY skey ORDER BY id) - 1 AS rank, id AS slot
      FROM g JOIN i ON point >= low AND point < high),
lack AS (SELECT skey, below, points, unnest(range((SELECT count(*) FROM q WHERE q.skey = i.skey), need)) AS rank FROM i),
slots AS (SELECT skey, rank, slot FROM q UNION ALL SELECT skey, rank, points + below + rank FROM lack),
p AS (SELECT row_number() OVER () AS r, d.*, skey, source_size, target, words, blocks,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
copies AS (SELECT *, least(a + size, words - copy * source_size) AS z FROM p, (SELECT unnest([0, 1]) AS copy)),
ends AS (SELECT r, skey, copy * blocks + unnest([a // 64, (z - 1) // 64]) AS rank FROM copies WHERE z > a),
f AS (SELECT r, min(slot) AS first_slot, max(slot) AS last_slot FROM ends JOIN slots USING (skey, rank) GROUP BY r)
SELECT doc_id, size, source_size, target, first_slot::BIGINT AS first_slot, last_slot::BIGINT AS last_slot,
       (greatest(least(a + size, words) - a, 0) + greatest(least(a + size, words - source_size) - a, 0))::BIGINT AS taken
FROM p LEFT JOIN f USING (r)
"""

_TOKENS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
i AS (SELECT item_id, {_TOKENS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
grams AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM windows))),
m AS (SELECT doc_id, n, p, item_id FROM grams JOIN windows USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_LETTERS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+')")

DIVERGENCE = rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LETTERS} AS w, row_number() OVER () AS r FROM documents),
x AS (SELECT lang, source, r, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM x GROUP BY ALL HAVING count(DISTINCT r) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM x SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * v.v))::BIGINT AS p,
             (1 + (1000000000::HUGEINT * (k.total + 5)) // (v.n + 5 * v.v))::BIGINT AS q
      FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
ranked AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM ranked)
WHERE part = 'pair' OR rank <= 50
"""

INFILL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
r AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS c1, ('0x' || h[9:16])::BIGINT % (n + 1) AS c2,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                       OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                  WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
s AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) - least(c1, c2) AS m,
             substring(t, 1, least(c1, c2)) AS pre, substring(t, least(c1, c2) + 1, greatest(c1, c2) - least(c1, c2)) AS mid,
             substring(t, greatest(c1, c2) + 1) AS suf FROM r)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN m END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""
