"""SQL for DuckDB that states the results of the operators it can express, written apart from them.

The others rest on trained models, tokenizers, iterative fits or crc32, which DuckDB lacks: they are tested against
brute force, round trips and held-out rows.
"""

from __future__ import annotations

_QUALITY = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t,
        list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(regexp_split_to_array(t, '\n'), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM d),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS k FROM places),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
        length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals
      FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
f AS (SELECT *, n_words < 10 AS r0, 100 * n_repeat_words > 20 * n_words AS r1, 10 * n_symbols > 3 * n_words AS r2,
        2 * n_dup_lines > n_lines AS r3, word_chars < 2 * n_words AS r4, word_chars > 15 * n_words AS r5,
        2 * n_capitals > word_chars AS r6 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r0 OR r1 AS base_failed,
  NOT (r0 OR r1 OR r2 OR r3 OR r4 OR r5 OR r6) AS kept, n_lines, n_capitals,
  (r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT + 32 * r5::INT + 64 * r6::INT)::BIGINT AS failures,
  'clean-2' AS policy
FROM f
"""

_NEAR = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
      FROM documents),
s AS (SELECT DISTINCT doc_id, k FROM (
        SELECT doc_id, unnest(CASE WHEN len(ws) > 1 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])
                                   ELSE ws END) AS k FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a AS doc_id, a AS r FROM both_ways UNION SELECT reach.doc_id, g.b FROM reach JOIN both_ways g ON g.a = reach.r),
root AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(root.r, d.doc_id) AS component_id,
  d.doc_id = coalesce(root.r, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN root ON root.doc_id = d.doc_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_PHRASES = rf"""
WITH pieces AS (
  SELECT lang, doc_id, i, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece, generate_subscripts(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]'), 1) AS j
  FROM (SELECT coalesce(lang, 'und') AS lang, doc_id, row_number() OVER () AS i, {_LOWER} AS t FROM documents)),
words AS (SELECT lang, i, j, unnest(ws) AS w, generate_subscripts(ws, 1) AS k
  FROM (SELECT *, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces)),
runs AS (SELECT lang, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY i, j ORDER BY k)),
f AS (
  SELECT lang, w AS phrase, 1 AS size, count(*) AS f FROM runs GROUP BY ALL
  UNION ALL SELECT lang, w || ' ' || w2, 2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, w || ' ' || w2 || ' ' || w3, 3, count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL),
c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND f >= 10),
cuts AS (SELECT *, array_to_string(ws[:k], ' ') AS first, array_to_string(ws[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
lefts AS MATERIALIZED (SELECT x.*, f.f AS l FROM cuts x JOIN f ON f.lang = x.lang AND f.phrase = x.first),
sides AS MATERIALIZED (SELECT x.*, f.f AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * f.f) AS score FROM lefts x JOIN f ON f.lang = x.lang AND f.phrase = x.rest),
scored AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (SELECT lang, phrase, max(a) AS longer FROM (
  SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM c WHERE size = 3) GROUP BY ALL),
kept AS (SELECT s.* FROM scored s LEFT JOIN held h ON h.lang = s.lang AND h.phrase = s.phrase WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept),
n AS (SELECT lang, count(*) AS n FROM words GROUP BY lang)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

_RESAMPLING = rf"""
WITH crc AS (  -- remainders of all bytes for the polynomial 0xEDB88320
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainders),
texts AS (
  SELECT 's' AS side, doc_id, row_number() OVER () AS i, text FROM documents UNION ALL SELECT 't', NULL, row_number() OVER (), text FROM benchmark),
words AS (
  SELECT side, doc_id, i, list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM texts),
runs AS (SELECT side, i, unnest(ws) AS w FROM words),
buckets AS (
  SELECT w, xor(list_reduce(list_concat([4294967295], list_transform(range(strlen(w)), lambda k: ('0x' || substr(hex(w), 2 * k + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM runs), crc),
placed AS (SELECT side, i, bucket FROM runs JOIN buckets USING (w)),
counts AS (SELECT bucket, count_if(side = 's') AS s, count_if(side = 't') AS t FROM placed GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS sum_s, sum(t)::DOUBLE AS sum_t FROM counts),
gains AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum_s + 10000)) / ((s + 1)::DOUBLE * (sum_t + 10000))))::BIGINT AS gain FROM counts, totals),
weights AS (SELECT i, floor(sum(gain) / count(*))::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE side = 's' GROUP BY i),
drawn AS (SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM words LEFT JOIN weights USING (i) WHERE side = 's'),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM drawn),
able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored s LEFT JOIN able a ON a.doc_id = s.doc_id
"""

_OVERLAP = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, k FROM (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))
                             WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS k FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a AS doc_id, b AS r FROM ways UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.r),
root AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN root ON root.doc_id = d.doc_id
"""

ORACLES: dict[str, str] = {
    "op2_quality_rules": _QUALITY,
    "op8_minhash_dedup": _NEAR,
    "op11_phrase_mining": _PHRASES,
    "op12_importance_resampling": _RESAMPLING,
    "op13_jaccard_join": _OVERLAP,
}
