"""DuckDB SQL for the operators that SQL can express, over the same tables."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

DECONTAMINATION = rf"""
WITH lowered AS (
  SELECT 0 AS side, cast(doc_id AS varchar) AS id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
  UNION ALL
  SELECT 1, cast(item_id AS varchar), translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') FROM benchmark
), worded AS (
  SELECT side, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered
), item_starts AS (
  SELECT id, w, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i
  FROM worded WHERE side = 1 AND len(w) > 0
), items AS (
  SELECT DISTINCT id AS item_id, n, array_to_string(w[i : i + n - 1], ' ') AS win FROM item_starts
), doc_starts AS (
  SELECT id, w, s.n, unnest(range(1, len(w) - s.n + 2)) AS i
  FROM worded, (SELECT DISTINCT n FROM items) AS s WHERE side = 0 AND len(w) >= s.n
), hits AS (
  SELECT d.id, d.i, d.n, m.item_id
  FROM (SELECT id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win FROM doc_starts) AS d
  JOIN items AS m ON d.win = m.win AND d.n = m.n
), found AS (
  SELECT id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS names
  FROM hits GROUP BY id
), covered AS (
  SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY id
)
SELECT cast(worded.id AS bigint) AS doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(n_hit, 0) AS bigint) AS n_hit,
       cast(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM worded LEFT JOIN found USING (id) LEFT JOIN covered USING (id) WHERE side = 0
"""

LINE_DEDUP = rf"""
WITH lined AS (
  SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL
), hashed AS (
  SELECT doc_id, l, list_transform(l, lambda x: md5(x)) AS h FROM lined
), cut AS (
  SELECT doc_id, l, list_filter(range(1, len(l) + 1), lambda i: i = len(l)
    OR cast('0x' || left(md5(coalesce(CASE WHEN i > 1 THEN h[i - 1] END, '') || h[i]), 4) AS int) % 4 = 0) AS ends FROM hashed
), spans AS (
  SELECT doc_id, l, ends, unnest(range(1, len(ends) + 1)) AS k FROM cut
), chunks AS (
  SELECT doc_id, k, l[CASE WHEN k > 1 THEN ends[k - 1] + 1 ELSE 1 END : ends[k]] AS part FROM spans
), texts AS (
  SELECT doc_id, k, array_to_string(part, chr(10)) AS chunk, len(part) AS n,
         len(list_filter(part, lambda x: regexp_matches(x, '{_WORD}'))) AS worded FROM chunks
), judged AS (
  SELECT *, worded >= 2 AND (doc_id, k) <> (first_value((doc_id, k)) OVER (PARTITION BY chunk ORDER BY doc_id, k)) AS gone
  FROM texts
)
SELECT d.doc_id, cast(coalesce(sum(n), 0) AS bigint) AS n_lines, cast(count(k) AS bigint) AS n_chunks,
       cast(coalesce(sum(cast(gone AS int)), 0) AS bigint) AS n_removed_chunks,
       cast(coalesce(sum(CASE WHEN gone THEN n END), 0) AS bigint) AS n_removed_lines,
       sha256(coalesce(string_agg(chunk, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM documents AS d LEFT JOIN judged USING (doc_id) GROUP BY d.doc_id
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM worded WHERE len(w) > 0
), shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + 2], ' ')) AS s FROM starts
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes AS x ON x.doc_id = a.doc_id JOIN sizes AS y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reached AS (
  SELECT doc_id AS id, doc_id AS r FROM documents
  UNION
  SELECT reached.id, links.b FROM reached JOIN links ON links.a = reached.r
), low AS (
  SELECT id, min(r) AS component_id FROM reached GROUP BY id
)
SELECT d.doc_id, cast(coalesce(n, 0) AS bigint) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents AS d JOIN low ON low.id = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""

QUALITY_RULES = rf"""
WITH worded AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i : i + 2] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded)
), again AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1
), inside AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM again) GROUP BY doc_id
), measured AS (
  SELECT d.doc_id, stratum, cast(len(w) AS bigint) AS n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS bigint) AS word_chars,
         cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS bigint) AS n_symbols, len(l) AS n_lines,
         cast(len(l) - len(list_distinct(l)) AS bigint) AS n_dup_lines, cast(coalesce(n, 0) AS bigint) AS n_repeat_words
  FROM worded AS d LEFT JOIN inside USING (doc_id)
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), binned AS (
  SELECT doc_id, stratum, base_failed, unnest([
    {{'rule': 'symbols', 'bin': least(200, floor(coalesce(n_symbols / nullif(cast(n_words AS double), 0), 0) * 50))}},
    {{'rule': 'dup_lines', 'bin': least(100, floor(coalesce(n_dup_lines / nullif(cast(n_lines AS double), 0), 0) * 100))}},
    {{'rule': 'repeats', 'bin': least(100, floor(coalesce(n_repeat_words / nullif(cast(n_words AS double), 0), 0) * 100))}},
    {{'rule': 'word_length', 'bin': least(250, floor(coalesce(word_chars / nullif(cast(n_words AS double), 0), 0) * 5))}}],
    recursive := true) FROM failed
), counts AS (
  SELECT stratum, rule, bin, sum(cast(good = 1 AS int)) AS good, sum(cast(good = 0 AS int)) AS bad
  FROM binned JOIN (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) USING (doc_id)
  WHERE NOT base_failed GROUP BY ALL
), tails AS (
  SELECT stratum, rule, bin, cast(sum(good) OVER (PARTITION BY stratum, rule) AS bigint) AS n,
         cast(sum(good) OVER down AS bigint) AS k, sum(bad) OVER down AS hit,
         (SELECT count(DISTINCT stratum) FROM counts) AS strata
  FROM counts WINDOW down AS (PARTITION BY stratum, rule ORDER BY bin DESC)
), tested AS (
  SELECT *, CASE WHEN k >= n * 0.0025 THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda j:
    exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.0025) + (n - j) * ln(0.9975)))) END AS p FROM tails
), certified AS (
  SELECT *, bool_and(p <= 0.05 / (strata * 4)) OVER (PARTITION BY stratum, rule ORDER BY bin DESC) AS ok FROM tested
), cutoffs AS (
  SELECT stratum, rule, arg_max(bin, (hit - k, bin)) AS cutoff FROM certified
  WHERE ok AND hit > k AND bin > 0 GROUP BY stratum, rule
), rejected AS (
  SELECT DISTINCT doc_id FROM binned JOIN cutoffs USING (stratum, rule) WHERE bin >= cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM failed
"""

FILTER_INTERACTION = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), marked AS (
  SELECT doc_id, part, min(doc_id) OVER (PARTITION BY t) AS low,
         len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d FROM worded
), known AS (
  SELECT doc_id, max(cast(quality = 1 AS int)) AS good, max(cast(toxic = 1 AS int)) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
         || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN coalesce(low < marked.doc_id, false) THEN 'E' ELSE '' END AS fails
  FROM marked LEFT JOIN known ON known.doc_id = marked.doc_id
), grouped AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails
), orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE NOT contains(o, f)
), steps AS (
  SELECT o AS filter_order, cast(k AS int) AS step, left(o, k - 1) AS before, substr(o, k, 1) AS f
  FROM orders, (SELECT unnest(range(1, 6)) AS k) WHERE length(o) = 5
), applied AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS hit, fails = f AS alone,
         regexp_matches(fails, '[' || before || '-]') AS gone
  FROM grouped, steps
), counted AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM applied GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, cast(kept AS bigint) AS kept, cast(removed AS bigint) AS removed,
       cast(redundant AS bigint) AS redundant, cast(unique_fails AS bigint) AS unique_fails, cast(good_lost AS bigint) AS good_lost,
       cast(toxic_lost AS bigint) AS toxic_lost, cast(sum(removed) OVER (PARTITION BY part, f) AS bigint) AS shapley
FROM counted
"""


def _framed(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    whole = ["cast(doc_id AS varchar)", "source", "lang", "cast(n_chars AS varchar)", text]
    return f"sha256({' || '.join(_framed(v) for v in whole)})"


#: CRC-32 of the decimal id, bit by bit: each byte is added before the first of its eight shifts
_CRC = """xor(4294967295, list_reduce(list_prepend(cast(4294967295 AS bigint), list_transform(range(0, 8 * length(id)), lambda i:
  CASE WHEN i % 8 = 0 THEN cast(ascii(substr(id, cast(i // 8 + 1 AS bigint), 1)) AS bigint) ELSE 0 END)),
  lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))))"""

MERKLE_MANIFEST = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS seen
  FROM (SELECT *, cast(doc_id AS varchar) AS id FROM documents)
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n FROM hashed
), low AS (
  SELECT tree, 0 AS lvl, pos, n, leaf AS node FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM low WHERE n > 1
  GROUP BY tree, lvl, pos // 3, n
), subroots AS (
  SELECT tree, node, lvl FROM low WHERE n = 1
), high AS (
  SELECT 100 AS lvl, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, node FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM high WHERE n > 1
  GROUP BY lvl, pos // 3, n
), places AS (
  SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS place FROM subroots
), steps AS (
  SELECT a.tree, a.lvl, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM low AS a JOIN low AS b ON a.tree = b.tree AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1
  GROUP BY a.tree, a.lvl, a.pos
  UNION ALL
  SELECT '', a.lvl, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), ''),
         coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '')
  FROM high AS a JOIN high AS b ON a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1
  GROUP BY a.lvl, a.pos
), folded AS (
  SELECT doc_id, tree, leaf, 0 AS lvl, pos, tree AS at_tree, seen AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT f.doc_id, f.tree, f.leaf, CASE WHEN s.lvl IS NULL THEN 100 ELSE f.lvl + 1 END,
         CASE WHEN s.lvl IS NULL THEN p.place ELSE f.pos // 3 END, CASE WHEN s.lvl IS NULL THEN '' ELSE at_tree END,
         CASE WHEN s.lvl IS NULL THEN h ELSE sha256(s.l || h || s.r) END, CASE WHEN s.lvl IS NULL THEN proof ELSE proof || s.l || s.r END
  FROM folded AS f JOIN places AS p ON p.tree = f.tree
  LEFT JOIN steps AS s ON s.tree = at_tree AND s.lvl = f.lvl AND s.pos = f.pos
  WHERE s.lvl IS NOT NULL OR at_tree <> ''
), ends AS (
  SELECT doc_id, tree, leaf, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM folded GROUP BY doc_id, tree, leaf
)
SELECT doc_id, leaf, subroots.node AS subroot, root.node AS root, sha256(proof) AS proof_sha256, h AS folded_root,
       h = root.node AS verified
FROM ends JOIN subroots USING (tree), (SELECT node FROM high WHERE n = 1) AS root
"""
