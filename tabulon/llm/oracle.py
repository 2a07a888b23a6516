"""DuckDB statements of the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
NORMAL = f"lower(trim(regexp_replace(line, '{SPACE}', ' ', 'g')))"
LINES = (f"SELECT doc_id, source, text, pos, line, regexp_matches(line, '{WORD}') AS word, {NORMAL} AS norm FROM "
         "(SELECT doc_id, source, text, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM "
         "(SELECT doc_id, source, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) a) b")

LINE_DEDUP = f"""
WITH l AS ({LINES}),
one AS (SELECT coalesce(text, '') AS text, MIN(source) AS site FROM documents GROUP BY 1),
spread AS (SELECT norm FROM l JOIN one ON l.text = one.text WHERE word GROUP BY norm HAVING COUNT(DISTINCT one.site) >= 10),
m AS (SELECT l.*, word AND l.norm IN (SELECT norm FROM spread) AS gone FROM l),
d AS (SELECT doc_id, COUNT(*) FILTER (WHERE word) AS n_lines, COUNT(*) FILTER (WHERE gone) AS n_gone,
      coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS t FROM m GROUP BY doc_id)
SELECT doc_id, n_lines, n_gone AS n_removed, CAST(length(t) AS BIGINT) AS n_chars_left, sha256(t) AS text_sha256 FROM d
"""

QUALITY = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
l AS (SELECT *, len(regexp_extract_all(line, '{WORD}')) AS n FROM ({LINES}) x WHERE word),
dup AS (SELECT doc_id, COUNT(*) - COUNT(DISTINCT line) AS n FROM l GROUP BY doc_id),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8) x),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, k) AS c FROM g) x WHERE c > 1),
rep AS (SELECT doc_id, SUM(n) AS n FROM (SELECT doc_id, LEAST(8, i - coalesce(LAG(i) OVER (PARTITION BY doc_id ORDER BY i), i - 8)) AS n
        FROM twice) x GROUP BY doc_id),
seen AS (SELECT source, norm, COUNT(DISTINCT text) AS n FROM l GROUP BY source, norm),
lim AS (SELECT source, norm FROM seen WHERE n > 20),
gone AS (SELECT doc_id, SUM(n) AS n FROM l JOIN lim ON l.source = lim.source AND l.norm = lim.norm GROUP BY doc_id),
b AS (SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '{SPACE}', '', 'g')) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
      coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_removed
      FROM d LEFT JOIN dup ON d.doc_id = dup.doc_id LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN gone ON d.doc_id = gone.doc_id),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
      n_removed > 0 AND (n_words - n_removed < 20 OR n_words - n_removed < 0.3 * n_words) AS depleted FROM b)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT depleted AS kept, CAST(n_removed AS BIGINT) AS n_removed FROM f
"""

_BENCH_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

WINNOW = f"""
WITH d AS (SELECT doc_id, {_BENCH_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_BENCH_WORDS} AS w FROM benchmark),
win AS (SELECT item_id, 10 AS n, array_to_string(w[i:i + 9], ' ') AS k FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS i FROM b WHERE len(w) >= 10) x
        UNION SELECT item_id, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND 9),
g AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM
      (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) z WHERE len(w) >= n) x),
hit AS (SELECT g.doc_id, g.i, g.n, win.item_id FROM g JOIN win ON g.k = win.k AND g.n = win.n),
cov AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) x GROUP BY doc_id),
its AS (SELECT doc_id, COUNT(*) AS n, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(cov.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(its.s, '')) AS items_sha256, coalesce(cov.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""

HARD_NEGATIVES = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT * FROM (SELECT anchor_id, id, score, ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS n FROM p WHERE same) x
        WHERE n <= 5),
neg AS (SELECT pos.anchor_id, pos.id AS positive_id, p.id AS negative_id, pos.score AS positive_score, p.score AS negative_score,
        CAST(ROW_NUMBER() OVER (PARTITION BY pos.anchor_id, pos.id ORDER BY p.score DESC, p.id) AS INTEGER) AS rank
        FROM pos JOIN p ON p.anchor_id = pos.anchor_id AND NOT p.same
        WHERE 80 * pos.score <= 100 * p.score AND 100 * p.score <= 100 * pos.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5
"""
