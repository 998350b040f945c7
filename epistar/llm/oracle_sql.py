"""DuckDB SQL for the operators whose results SQL can express.

The sketch, CRF, forest, parser and trained models have none; they are tested
against brute force, planted cases and held-out labels. Neither has the BM25
search: SQL engines score and verify text runs too differently to compare bits.
"""

from __future__ import annotations

from epistar.llm import merkle, mixing, ns_bounds, quality_rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, y FROM reach JOIN edges ON b = x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""

SUBSTRINGS = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
again AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM again),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM d),
kept AS (
  SELECT word.doc_id, string_agg(x, ' ' ORDER BY k) AS t, count(*) AS n
  FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.k = gone.k GROUP BY ALL)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

MIXING = rf"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS k, sum(n) OVER () AS total FROM s),
w AS (SELECT *, CASE (k - 1) % 3 WHEN 0 THEN {mixing.WEIGHTS[0]:.1f}::DOUBLE WHEN 1 THEN {mixing.WEIGHTS[1]:.1f}::DOUBLE ELSE {mixing.WEIGHTS[2]:.1f}::DOUBLE END AS w FROM r),
o AS (
  SELECT *, coalesce(sum(2 * n) OVER f, 0)::DOUBLE AS cap_before, sum(w) OVER () - coalesce(sum(w) OVER f, 0) AS w_left
  FROM w WINDOW f AS (ORDER BY 2 * n / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (1.5::DOUBLE * total - cap_before) * w / w_left >= 2 * n AS full_ FROM o),
left_ AS (SELECT 1.5::DOUBLE * min(total) - coalesce(sum(2 * n) FILTER (WHERE full_), 0)::DOUBLE AS budget, sum(w) FILTER (WHERE NOT full_) AS w FROM c),
t AS (SELECT c.source, c.n, CASE WHEN full_ THEN (2 * c.n)::DOUBLE ELSE left_.budget * c.w / left_.w END AS target FROM c, left_),
e AS (
  SELECT d.doc_id, d.size, t.n AS source_size, t.target, CASE WHEN t.n > 0 THEN floor(t.target / t.n)::BIGINT ELSE 0 END AS whole,
    coalesce(sum(d.size) OVER (
      PARTITION BY d.source ORDER BY md5('{mixing.SEED}:' || d.doc_id || ':' || d.size), d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (whole * size + greatest(0, least(size, floor(target)::BIGINT - whole * source_size - start)))::BIGINT AS taken
FROM e
"""

_Q = quality_rules
_LETTERS = {
    "upper": r"\P{Lu}+", "plain": r"[^\p{Ll}0-9]+", "blank": r"[^\x20\x09-\x0D]+", "mark": r"""[^.,;:!?''"()\-]+""", "symbol": "[^#*$%&|<>]+",
}
_COUNTS = ", ".join(f"length(regexp_replace(t, '{keep}', '', 'g')) AS c_{name}" for name, keep in _LETTERS.items())
_OTHER = " - ".join(["length(t)", *[f"c_{name}" for name in _LETTERS]])


def _js(p: str, q: str) -> str:
    return f"(CASE WHEN {p} > 0 THEN 0.5 * {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + CASE WHEN {q} > 0 THEN 0.5 * {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)"


QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, lang, {WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS k FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT d.doc_id, lang, t, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    regexp_extract_all(lower(regexp_replace(t, '[.,;:!?''"()\-]', '', 'g')), '[^\x20\x09-\x0D]+') AS pw, {_COUNTS}
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)),
f AS (SELECT *, {_OTHER} AS c_other, length(t) AS chars FROM base),
prose AS (SELECT * FROM f WHERE 100 * c_symbol <= {_Q.MAX_REFERENCE_SYMBOL_PCT} * chars),
classes AS (
  SELECT lang, sum(len(pw)) AS n, {", ".join(f"sum(c_{c}) AS c_{c}" for c in _Q.CLASSES)} FROM prose GROUP BY lang),
refs AS (SELECT *, {" + ".join(f"c_{c}" for c in _Q.CLASSES)} AS chars FROM classes WHERE lang IS NOT NULL AND n >= {_Q.MIN_REFERENCE_WORDS}),
short AS (
  SELECT lang, x, count(*) AS k FROM (SELECT lang, unnest(pw) AS x FROM prose) WHERE length(x) <= {_Q.SHORT} AND regexp_matches(x, '\p{{L}}') GROUP BY ALL),
top AS (
  SELECT lang, x, k FROM short WHERE lang IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lang ORDER BY k DESC, x) <= {_Q.COMMON_WORDS}),
q AS (SELECT top.lang, x, k / refs.n AS q FROM top JOIN refs ON refs.lang = top.lang),
keyed AS (SELECT f.*, f.lang AS key FROM f WHERE lang IN (SELECT lang FROM refs)),
hist AS (
  SELECT doc_id, key, x, count(*) AS c FROM (SELECT doc_id, key, unnest(pw) AS x FROM keyed) GROUP BY ALL),
bins AS (
  SELECT k.doc_id, q.q, coalesce(h.c, 0) / len(k.pw) AS p FROM keyed k JOIN q ON q.lang = k.key LEFT JOIN hist h ON h.doc_id = k.doc_id AND h.x = q.x
  WHERE len(k.pw) > 0),
sums AS (SELECT doc_id, sum({_js("p", "q")}) AS js, greatest(0, 1 - sum(p)) AS rest_p, greatest(0, 1 - sum(q)) AS rest_q FROM bins GROUP BY doc_id),
words AS (SELECT doc_id, js + {_js("rest_p", "rest_q")} AS js_words FROM sums),
cls AS (
  SELECT k.doc_id, {" + ".join(_js(f"(k.c_{c} / k.chars)", f"(r.c_{c} / r.chars)") for c in _Q.CLASSES)} AS js_classes
  FROM keyed k JOIN refs r ON r.lang = k.key WHERE k.chars > 0),
v AS (
  SELECT *, n_words < {_Q.MIN_WORDS} OR 100 * n_repeat_words > {_Q.MAX_REPEAT_PCT} * n_words AS base_failed,
    n_words >= {_Q.MIN_DIVERGENCE_WORDS} AND (
      coalesce(js_classes > {_Q.MAX_CLASS_DIVERGENCE[0]} + {_Q.MAX_CLASS_DIVERGENCE[1]} / n_words, false)
      OR coalesce(js_words > {_Q.MAX_WORD_DIVERGENCE[0]} + {_Q.MAX_WORD_DIVERGENCE[1]} / n_words, false)) AS diverges
  FROM f LEFT JOIN cls USING (doc_id) LEFT JOIN words USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT diverges AS kept FROM v
"""


def _field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({name}::VARCHAR) || ':' || {name}::VARCHAR END"


_LEAF = " || ".join(_field(name) for name in merkle.FIELDS[:-1])
_RUN = merkle.FANOUT
# CRC-32 of a number's digits: the table of its 256 entries follows from the polynomial
MERKLE = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) r(b)),
d AS (
  SELECT doc_id, lang, sha256({_LEAF} || {_field("text")}) AS leaf,
    sha256({_LEAF} || {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS small,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS crc
  FROM documents, crc_table),
l AS (
  SELECT doc_id, leaf, CASE WHEN crc % 3 = 0 THEN small ELSE leaf END AS shown, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf, crc) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
low AS (
  SELECT tree, 0 AS level, pos, n, leaf AS h FROM l
  UNION ALL
  SELECT tree, level + 1, pos // {_RUN}, (n + {_RUN - 1}) // {_RUN}, sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, level, pos // {_RUN}, n),
sub AS (SELECT tree, h FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, tree AS pos, (SELECT count(*) FROM sub) AS n, h FROM sub
  UNION ALL
  SELECT level + 1, pos // {_RUN}, (n + {_RUN - 1}) // {_RUN}, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY level, pos // {_RUN}, n),
runs AS (
  SELECT tree, level, pos // {_RUN} AS run, list(h ORDER BY pos) AS kids FROM low WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, level, pos // {_RUN}, list(h ORDER BY pos) FROM high WHERE n > 1 GROUP BY ALL),
depth AS (SELECT tree, max(level) AS deep FROM low GROUP BY tree),
climb AS (
  SELECT l.tree AS own, pos AS leaf_pos, l.tree AS tree, 0 AS level, pos, 0 AS step, shown AS folded, '' AS proof FROM l
  UNION ALL
  SELECT own, leaf_pos, runs.tree, c.level + 1, c.pos // {_RUN}, step + 1,
    sha256(array_to_string(kids[:c.pos % {_RUN}], '') || folded || array_to_string(kids[c.pos % {_RUN} + 2:], '')),
    proof || array_to_string(kids[:c.pos % {_RUN}], '') || array_to_string(kids[c.pos % {_RUN} + 2:], '')
  FROM (
    SELECT own, leaf_pos, step, folded, proof, CASE WHEN c.tree >= 0 AND level = deep THEN -1 ELSE c.tree END AS tree,
      CASE WHEN c.tree >= 0 AND level = deep THEN 0 ELSE level END AS level, CASE WHEN c.tree >= 0 AND level = deep THEN c.tree ELSE pos END AS pos
    FROM climb c LEFT JOIN depth ON depth.tree = c.tree) c
  JOIN runs ON runs.tree = c.tree AND runs.level = c.level AND runs.run = c.pos // {_RUN}),
done AS (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY own, leaf_pos ORDER BY step DESC) = 1),
root AS (SELECT h AS root FROM high WHERE n = 1)
SELECT l.doc_id, l.leaf, sub.h AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM l JOIN done ON done.own = l.tree AND done.leaf_pos = l.pos JOIN sub ON sub.tree = l.tree, root
"""


_N = ns_bounds


def _assigned(k: int) -> str:
    """CTEs of round k: every vector's nearest of the centroids c{k}."""
    return f"""e{k} AS MATERIALIZED (
  SELECT n, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT x.n, x.v, c{k}.c, list_sum(list_transform(list_zip(x.v, c{k}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM x, c{k})
  GROUP BY n, v)"""


def _moved(k: int) -> str:
    """CTEs of round k: the centroids after it; floor of the exact mean, as division of a multiple."""
    return f"""s{k} AS (
  SELECT c, p, (s - ((s % n) + n) % n) // n AS m FROM (
    SELECT c, p, sum(a)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(v) AS a, generate_subscripts(v, 1) AS p FROM e{k}) GROUP BY c, p)),
c{k + 1} AS MATERIALIZED (
  SELECT c{k}.c, coalesce(g.v, c{k}.v) AS v FROM c{k} LEFT JOIN (SELECT c, list(m ORDER BY p) AS v FROM s{k} GROUP BY c) g ON g.c = c{k}.c)"""


CENTROIDS = f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda e: floor({_N.SCALE} * e::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {_N.DIMS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {_N.DIMS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
    SELECT sha256('{_N.SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM x ORDER BY h, v LIMIT {_N.CLUSTERS})),
{", ".join(f"{_assigned(k)}, {_moved(k)}" for k in range(_N.ROUNDS))},
{_assigned(_N.ROUNDS)}
SELECT x.vec_id, e.c::INTEGER AS cluster, e.d AS distance, sum(e.d) OVER (PARTITION BY e.c)::BIGINT AS cluster_inertia, sum(e.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(z.v, ',')) AS centroid_sha256
FROM e{_N.ROUNDS} e JOIN x USING (n) JOIN c{_N.ROUNDS} z ON z.c = e.c
"""

ORACLE_SQL = {
    "op1_ngram_jaccard_join": JACCARD,
    "op4_substring_dedup": SUBSTRINGS,
    "op8_mix_to_weights": MIXING,
    "op10_quality_rules": QUALITY,
    "op11_merkle_manifest": MERKLE,
    "op13_centroid_clustering": CENTROIDS,
}
