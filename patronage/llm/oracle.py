"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from patronage.llm.url_filter import EXTRA_BLOCK


def _regex(glob: str) -> str:
    """The glob as a regular expression over '.' + host + newline + path."""
    special = ".+()[]{}?\\$"
    return "".join({"^": r"[^\x0A]*", "*": r".*", "|": r"\x0A"}.get(c, "\\" + c if c in special else c) for c in glob)


#: Distinct five-word shingles of each text; fewer words are one shingle.
_SHINGLES = r"""
{name}_words AS (
  SELECT {key} AS id, list_filter(string_split_regex(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM {table}
), {name} AS (
  SELECT DISTINCT id, array_to_string(w[k : k + 4], ' ') AS s FROM {name}_words, unnest(range(1, greatest(len(w) - 3, 2))) AS r(k) WHERE len(w) > 0
), {name}_sizes AS (SELECT id, count(*) AS n FROM {name} GROUP BY id)
"""
_DOC_SHINGLES = _SHINGLES.format(name="docs", key="doc_id", text="text", table="documents")
_ITEM_SHINGLES = _SHINGLES.format(name="items", key="item_id", text="text", table="benchmark")

ORACLE = {
    "op4_ngram_jaccard": rf"""
WITH RECURSIVE {_DOC_SHINGLES}, pairs AS (
  SELECT a.id AS a, b.id AS b, count(*) AS common FROM docs a JOIN docs b ON a.s = b.s AND a.id < b.id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN docs_sizes x ON x.id = a JOIN docs_sizes y ON y.id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links), reached(id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reached.id, both_ways.b FROM reached JOIN both_ways ON both_ways.a = reached.other
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN docs_sizes ON docs_sizes.id = d.doc_id
JOIN (SELECT id, min(other) AS component_id FROM reached GROUP BY id) r ON r.id = d.doc_id
""",
    "op9_decontamination": rf"""
WITH {_DOC_SHINGLES}, {_ITEM_SHINGLES}, shared AS (
  SELECT docs.id AS doc_id, items.id AS item_id, count(*) AS n_shared FROM docs JOIN items ON docs.s = items.s GROUP BY ALL
)
SELECT doc_id, item_id, n AS n_shingles, n_shared, n_shared / n AS containment
FROM shared JOIN items_sizes ON items_sizes.id = item_id WHERE 100 * n_shared >= 80 * n
""",
    "op8_url_filter": rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, rest, regexp_extract(rest, '(?s)^([^/?#]*)', 1) AS raw_host FROM cut
), named AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '(?s)^([^?#]*)', 1) AS path FROM split
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM named
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_full_match('.' || host || chr(10) || path, '(?s)({"|".join(_regex(g) for g in EXTRA_BLOCK)})') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
""",
    "op10_suffix_dedup": """
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS (
  SELECT doc_id, k AS s, array_slice(b, k + 1, k + 50) AS x FROM d, unnest(range(0, n - 49)) AS r(k) WHERE n >= 50
), first_held AS (SELECT x, min(doc_id) AS holder FROM windows GROUP BY x), gone AS (
  SELECT doc_id, s FROM windows JOIN first_held USING (x) WHERE doc_id > holder
), marked AS (
  SELECT doc_id, s, coalesce(s > max(s + 50) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS fresh FROM gone
), numbered AS (SELECT doc_id, s, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM marked), spans AS (
  SELECT doc_id, min(s) AS a, max(s) + 50 AS z FROM numbered GROUP BY doc_id, g
), between AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p, a AS q FROM spans
  UNION ALL SELECT doc_id, max(z), NULL FROM spans GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(CASE WHEN p < coalesce(q, n) THEN hex(array_slice(b, p + 1, coalesce(q, n))) ELSE '' END, '' ORDER BY p) AS h
  FROM between JOIN d USING (doc_id) GROUP BY doc_id
), sums AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(CASE WHEN h IS NULL THEN b ELSE unhex(h) END) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
""",
    "op6_lattice_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reached(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reached.id, links.b FROM reached JOIN links ON links.a = reached.other
), named AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id), degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM embeddings JOIN named ON id = vec_id LEFT JOIN degrees ON a = vec_id
""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, list_filter(regexp_split_to_array(line, '[ \t]+'), lambda w: w <> '') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS line FROM documents)
), places AS (
  SELECT piece, lang, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM pieces
), f1 AS (SELECT lang, w AS x, count(*) AS f FROM places GROUP BY ALL), ahead AS (
  SELECT lang, w AS a, lead(w) OVER o AS b, lead(w, 2) OVER o AS c FROM places WINDOW o AS (PARTITION BY piece ORDER BY pos)
), f2 AS (SELECT lang, a || ' ' || b AS x, a, b, count(*) AS f FROM ahead WHERE b IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, a || ' ' || b || ' ' || c AS x, a, b, c, count(*) AS f FROM ahead WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
inner_pairs AS (
  SELECT lang, x, max(f) AS m FROM (SELECT lang, a || ' ' || b AS x, f FROM f3 UNION ALL SELECT lang, b || ' ' || c, f FROM f3) GROUP BY lang, x
), cuts AS (
  SELECT f2.lang, f2.x, f2.f AS a, 1 AS k, p.f AS l, q.f AS r FROM f2 JOIN f1 p ON p.lang = f2.lang AND p.x = f2.a JOIN f1 q ON q.lang = f2.lang AND q.x = f2.b
  LEFT JOIN inner_pairs i ON i.lang = f2.lang AND i.x = f2.x WHERE f2.f >= 10 AND (i.m IS NULL OR 100 * i.m < 50 * f2.f)
  UNION ALL SELECT f3.lang, f3.x, f3.f, 1, p.f, q.f FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.x = f3.a JOIN f2 q ON q.lang = f3.lang AND q.x = f3.b || ' ' || f3.c
  UNION ALL SELECT f3.lang, f3.x, f3.f, 2, p.f, q.f FROM f3 JOIN f2 p ON p.lang = f3.lang AND p.x = f3.a || ' ' || f3.b JOIN f1 q ON q.lang = f3.lang AND q.x = f3.c
), scored AS (
  SELECT lang, x AS phrase, a, l, r, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score, k FROM cuts
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000
""",
}
