"""DuckDB SQL for those training-data queries that SQL can express on whole tables in reasonable time."""

from .secret_scan import BASE, RULES as SECRETS

_WORDS = r"list_filter(string_split_regex(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [len(w) || ' ' || array_to_string(w, ' ')] ELSE [] END) AS h FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
g AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, g.b FROM r JOIN g ON r.seen = g.a),
m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d JOIN m ON node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

NEAREST = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.e, x.e) / (sqrt(list_inner_product(q.e, q.e)) * sqrt(list_inner_product(x.e, x.e))) AS score FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM p WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""

RULES = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format('text')} AS w FROM documents),
g AS (SELECT doc_id, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
d AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM d, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
b AS (SELECT w.doc_id, text, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
  OR (n_dup_lines >= 2 AND 10 * n_dup_lines > 3 * len(string_split(text, chr(10)))) OR length(text) - length(replace(text, '!!', '!')) > 0.3 * n_words
  OR 10 * length(regexp_replace(text, '[^\p{{L}}\p{{M}}]+', '', 'g')) < 5 * word_chars OR 2 * length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) > word_chars) AS kept FROM f
"""

WINDOWS = f"""
WITH w AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
p AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 48), lambda i: array_to_string(w[i:i + 49], ' '))) AS s, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50),
g AS (SELECT doc_id, i FROM p QUALIFY min(doc_id) OVER (PARTITION BY s) < doc_id),
r AS (SELECT doc_id, list(DISTINCT i + k) AS r FROM g, (SELECT unnest(range(0, 50)) AS k) GROUP BY doc_id)
SELECT w.doc_id, len(w) AS n_words, coalesce(len(r), 0) AS n_removed, sha256(coalesce(array_to_string(CASE WHEN r IS NULL THEN w ELSE list_filter(w, lambda x, j: NOT list_contains(r, j)) END, ' '), '')) AS kept_sha256 FROM w LEFT JOIN r USING (doc_id)
"""

PHRASES = rf"""
WITH p AS (SELECT row_number() OVER () AS id, lang, s FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(coalesce({_LOWER}, ''), '[.,;:!?\x0A-\x0D]')) AS s FROM documents)),
w AS (SELECT lang, list_filter(string_split_regex(s, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (SELECT lang, p, count(*) AS a FROM (SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS p FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k) GROUP BY lang, p HAVING count(*) >= 100),
c AS (SELECT * FROM f WHERE len(p) > 1),
x AS (SELECT c.lang, c.p, c.a, unnest(range(1, len(c.p))) AS k FROM c),
s AS (SELECT x.lang, x.p, x.a, k, l.a AS l, r.a AS r, n, CAST(CAST(1000 AS HUGEINT) * x.a * n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score FROM x JOIN f l ON l.lang = x.lang AND l.p = x.p[:k] JOIN f r ON r.lang = x.lang AND r.p = x.p[k + 1:] JOIN n ON n.lang = x.lang QUALIFY row_number() OVER (PARTITION BY x.lang, x.p ORDER BY score, k) = 1),
i AS (SELECT DISTINCT c.lang, c.p FROM c JOIN c AS b ON b.lang = c.lang AND len(b.p) > len(c.p) AND 100 * b.a >= 100 * c.a AND contains(' ' || array_to_string(b.p, ' ') || ' ', ' ' || array_to_string(c.p, ' ') || ' ')),
k AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM s ANTI JOIN i ON i.lang = s.lang AND i.p = s.p)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score FROM k WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= 2000
"""


def _secrets() -> str:
    """A row for each match of each rule: what lies between matches, and they themselves, add up to their places."""
    each = []
    for i, r in enumerate(SECRETS):
        p = r.pattern.replace("'", "''")
        whole, part = f"regexp_extract_all(text, '{p}')", f"regexp_extract_all(text, '{p}', {r.part})"
        each.append(f"SELECT rid, '{r.kind}' AS kind, {i} AS o, {whole} AS m, {part} AS g, string_split_regex(text, '{p}') AS b, {r.least} AS least FROM d")
    counts = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in SECRETS[:BASE])
    sums = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in SECRETS[:BASE])
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents), a AS ({' UNION ALL '.join(each)}),
e AS (SELECT rid, kind, o, unnest(list_transform(range(1, len(m) + 1), lambda i: struct_pack(start := list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), size := length(m[i]), part := length(g[i]))), recursive := true), least FROM a WHERE len(m) > 0 AND list_max(list_transform(g, lambda x: length(x))) >= least),
s AS (SELECT rid, kind, o, CAST(start AS BIGINT) AS start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT) AS span FROM e WHERE part >= least),
t AS (SELECT rid, {sums}, string_agg(span, ',' ORDER BY start, o) FILTER (o < {BASE}) AS base, string_agg(span, ',' ORDER BY start, o) AS spans FROM s GROUP BY rid)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN t USING (rid)
"""


ORACLE_SQL = {
    "op4_minhash_neardup": NEAR, "op6_nearest_neighbours": NEAREST, "op8_quality_rules": RULES, "op9_substring_dedup": WINDOWS, "op12_collocations": PHRASES, "op13_secret_scan": _secrets(),
}
