"""DuckDB SQL with the same results as the operators that SQL can express."""

from __future__ import annotations

from .licences import TEMPLATES, template_bigrams
from .rules import RULES, RuleSpec, bucket, bucket_low


def rules_sql(spec: RuleSpec = RuleSpec()) -> str:
    duck = lambda text: text.replace(" div ", " // ")
    values = " UNION ALL ".join(
        f"SELECT lang, source, '{r.name}' AS rule, {duck(r.expr)} AS v FROM counts WHERE NOT base_failed"
        for r in RULES
    )
    wide = f"{spec.spread} * (q3 - q1)"
    limits = ", ".join(
        f"max(CASE WHEN rule = '{r.name}' THEN q3 + {wide} + {r.slack} END) AS {r.name}_high"
        + (f", max(CASE WHEN rule = '{r.name}' THEN q1 - {wide} - {r.slack} END) AS {r.name}_low" if r.both else "")
        for r in RULES
    )
    inside = " AND ".join(
        f"{duck(r.expr)} <= f.{r.name}_high" + (f" AND {duck(r.expr)} >= f.{r.name}_low" if r.both else "")
        for r in RULES
    )
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), starts AS (
  SELECT k, len(w) AS n, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8
), grams AS (
  SELECT k, i, array_to_string(w[i:i + 7], ' ') AS g FROM starts
), twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM grams) WHERE c > 1
), steps AS (
  SELECT k, least(8, coalesce(lead(i) OVER (PARTITION BY k ORDER BY i) - i, 8)) AS s FROM twice
), covered AS (
  SELECT k, sum(s) AS c FROM steps GROUP BY k
), raw AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(c, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g'))::BIGINT AS n_upper,
    len(l)::BIGINT AS n_lines
  FROM w LEFT JOIN covered USING (k)
), counts AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM raw
), vals AS ({values}
), buckets AS (
  SELECT lang, source, rule, {bucket('v')} AS bucket, count(*) AS n FROM vals GROUP BY ALL
), levels AS (
  SELECT level, lang, source, rule, bucket, sum(n)::BIGINT AS n FROM (
    SELECT 2 AS level, * FROM buckets
    UNION ALL SELECT 1, lang, NULL, rule, bucket, n FROM buckets
    UNION ALL SELECT 0, NULL, NULL, rule, bucket, n FROM buckets
  ) GROUP BY ALL
), ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rule ORDER BY bucket) AS cum,
    sum(n) OVER (PARTITION BY level, lang, source, rule) AS total
  FROM levels
), quartiles AS (
  SELECT level, lang, source, rule, max(total) AS total,
    min(CASE WHEN cum * 4 >= total THEN {bucket_low('bucket')} END) AS q1,
    min(CASE WHEN cum * 4 >= total * 3 THEN {bucket_low('bucket')} END) AS q3
  FROM ranked GROUP BY ALL
), by_level AS (
  SELECT level, lang, source, max(total) AS total, {limits} FROM quartiles GROUP BY ALL
), chosen AS (
  SELECT a.lang AS fence_lang, a.source AS fence_source,
    CASE WHEN a.total >= {spec.least_group} THEN 2 WHEN b.total >= {spec.least_group} THEN 1 ELSE 0 END AS level
  FROM by_level a JOIN by_level b ON a.level = 2 AND b.level = 1 AND a.lang IS NOT DISTINCT FROM b.lang
)
SELECT c.doc_id, c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, c.base_failed,
  NOT c.base_failed AND coalesce({inside}, false) AS kept
FROM counts c
LEFT JOIN chosen h ON c.lang IS NOT DISTINCT FROM h.fence_lang AND c.source IS NOT DISTINCT FROM h.fence_source
LEFT JOIN by_level f ON f.level = h.level
  AND (h.level = 0 OR f.lang IS NOT DISTINCT FROM c.lang)
  AND (h.level < 2 OR f.source IS NOT DISTINCT FROM c.source)
"""


def licences_sql(templates: dict[str, str] = TEMPLATES, least: float = 0.8) -> str:
    rows = ", ".join(
        "('{}', [{}])".format(name, ", ".join(f"'{b}'" for b in template_bigrams(text)))
        for name, text in templates.items()
    )
    return rf"""
WITH t(license_id, g) AS (VALUES {rows}
), d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l, coalesce(text, '') AS x FROM documents
), s AS (
  SELECT row_number() OVER () AS k, doc_id, segment FROM (
    SELECT doc_id, unnest(CASE WHEN len(l) > 1 THEN list_append(l, x) ELSE l END) AS segment FROM d)
), w AS (
  SELECT k, doc_id, string_split(trim(regexp_replace(lower(segment), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM s
), b AS (
  SELECT k, doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b
  FROM w WHERE len(w) > 1
), m AS (
  SELECT k, doc_id, license_id, 2 * len(list_intersect(b, g)) / (len(b) + len(g)) AS dice FROM b JOIN t
    ON len(b) <= len(g) * {(2 - least) / least} AND len(g) <= len(b) * {(2 - least) / least}
)
SELECT doc_id, license_id, count(*) AS n_segments, max(dice) AS best_dice
FROM (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY k ORDER BY dice DESC, license_id) = 1)
WHERE dice >= {least} GROUP BY ALL
"""


def merkle_sql() -> str:
    """Trees of leaves by language and the tree of their tops, level by level."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0} END"
    fields = ", ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    shift = "lambda v, z: xor(v >> 1, 3988292384::UBIGINT * (v & 1))"
    step = f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), {shift})"
    digits = "list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ord((doc_id::VARCHAR)[i])::UBIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {digits}), {step}), 4294967295::UBIGINT)"
    parent = "SELECT {tree} lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 7) // 8"
    climb = """SELECT w.k, {tree} w.lvl + 1, w.idx // 8, w.leaf,
    sha256(string_agg(CASE WHEN s.idx = w.idx THEN w.folded ELSE s.h END, '' ORDER BY s.idx)),
    w.proof || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (WHERE s.idx <> w.idx), '') {top}"""
    return rf"""
WITH RECURSIVE raw AS (
  SELECT row_number() OVER () AS k, lang, doc_id, sha256(concat({fields}, {field.format('text')})) AS leaf,
    CASE WHEN {crc} % 3 = 0 THEN sha256(concat({fields}, {field.format(lower)})) END AS altered
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n FROM raw
), nodes AS (
  SELECT lang, 0 AS lvl, idx, leaf AS h, n FROM leaves
  UNION ALL
  {parent.format(tree='lang,')} FROM nodes WHERE n > 1 GROUP BY lang, lvl, idx // 8
), subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), upper_nodes AS (
  SELECT 0 AS lvl, idx, h, n FROM subroots
  UNION ALL
  {parent.format(tree='')} FROM upper_nodes WHERE n > 1 GROUP BY lvl, idx // 8
), walk AS (
  SELECT k, lang, 0 AS lvl, idx, leaf, coalesce(altered, leaf) AS folded, '' AS proof, n = 1 AS done FROM leaves
  UNION ALL
  {climb.format(tree='w.lang,', top=', any_value(s.n) <= 8')} FROM walk w
  JOIN nodes s ON s.lang IS NOT DISTINCT FROM w.lang AND s.lvl = w.lvl AND s.idx // 8 = w.idx // 8
  WHERE NOT w.done GROUP BY w.k, w.lang, w.lvl, w.idx, w.leaf, w.folded, w.proof
), upper_walk AS (
  SELECT w.k, 0 AS lvl, s.idx, w.leaf, w.folded, w.proof, s.n = 1 AS done
  FROM walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.done
  UNION ALL
  {climb.format(tree='', top=', any_value(s.n) <= 8')} FROM upper_walk w
  JOIN upper_nodes s ON s.lvl = w.lvl AND s.idx // 8 = w.idx // 8
  WHERE NOT w.done GROUP BY w.k, w.lvl, w.idx, w.leaf, w.folded, w.proof
)
SELECT l.doc_id, w.leaf, s.h AS subroot, r.h AS root, sha256(w.proof) AS proof_sha256,
  w.folded AS folded_root, w.folded = r.h AS verified
FROM upper_walk w JOIN leaves l USING (k)
JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
CROSS JOIN (SELECT h FROM upper_nodes WHERE n = 1) r
WHERE w.done
"""
