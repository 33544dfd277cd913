"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .licences import TEMPLATES, bigrams_of

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


def _licences(threshold: float = 0.8) -> str:
    rows = ", ".join("('{}', [{}])".format(name, ", ".join(f"'{b}'" for b in bigrams_of(t))) for name, t in sorted(TEMPLATES.items()))
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    return f"""WITH t(template, b) AS (VALUES {rows}), u AS (SELECT doc_id, text AS x, -1 AS unit FROM documents UNION ALL SELECT doc_id, unnest(string_split(text, chr(10))), unnest(range(len(string_split(text, chr(10))))) FROM documents WHERE contains(text, chr(10))),
w AS (SELECT doc_id, unit, string_split(trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM u WHERE x IS NOT NULL),
g AS (SELECT doc_id, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS p FROM w WHERE len(w) >= 3),
m AS (SELECT doc_id, unit, template, 2 * len(list_intersect(p, b)) / CAST(len(p) + len(b) AS DOUBLE) AS dice FROM g JOIN t ON len(p) BETWEEN {low} * len(b) AND {high} * len(b)),
f AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT template, ',' ORDER BY template) AS found, max(dice) AS best FROM m WHERE dice >= {threshold} GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(found, '') AS found, round(best, 6) AS best_dice FROM documents LEFT JOIN f USING (doc_id)"""


SQL: dict[str, str] = {
    "op2_topk": """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op3_minhash": f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 OR w IS NULL THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON r.doc_id = e.a), m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, doc_id = c AS kept FROM m LEFT JOIN n USING (doc_id)""",
    "op5_lines": """WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents), w AS (SELECT doc_id, unnest(range(1, len(l) - 1)) AS i, l FROM l WHERE len(l) >= 3), k AS (SELECT doc_id, i, l[i:i + 2] AS k FROM w WHERE trim(l[i], ' ') <> '' OR trim(l[i + 1], ' ') <> '' OR trim(l[i + 2], ' ') <> ''),
f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM k), c AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 3)))) AS gone FROM f WHERE r > 1 GROUP BY doc_id)
SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(gone, i)), lambda i: l[i]), chr(10)) END AS text, coalesce(len(l), 0) AS n_lines, coalesce(len(gone), 0) AS n_removed FROM l LEFT JOIN c USING (doc_id)""",
    "op7_mixing": f"""WITH d AS (SELECT doc_id, source, coalesce(len({WORDS}), 0) AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
z AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM d GROUP BY source),
y AS (SELECT *, (place % 3 + 1)::DOUBLE AS weight, (source_size * 3)::DOUBLE AS lim FROM z),
x AS (SELECT *, coalesce(sum(lim) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, sum(source_size::DOUBLE) OVER () AS total FROM y),
v AS (SELECT *, (total - before) / rest AS level, lim / weight > (total - before) / rest AS open FROM x),
t AS (SELECT source, source_size, place, CASE WHEN open THEN (SELECT level FROM v WHERE open ORDER BY lim / weight, place LIMIT 1) * weight ELSE lim END AS target FROM v),
b AS (SELECT doc_id, size, source_size, place, target, round(target)::BIGINT AS goal, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, greatest(0, least(size, goal - before)) AS p0, greatest(0, least(size, goal - source_size - before)) AS p1, greatest(0, least(size, goal - source_size * 2 - before)) AS p2 FROM b),
u AS (SELECT *, (before + p0 / 2.0::DOUBLE) / target AS u FROM p)
SELECT doc_id, size, source_size, target, (p0 + p1 + p2)::BIGINT AS taken, round(CASE WHEN p0 = 0 THEN NULL WHEN place % 3 = 0 THEN (sqrt(greatest(2.25 + 2 * (-1.0) * (u * 1.0), 0)) - 1.5) / (-1.0) WHEN place % 3 = 1 THEN u WHEN u <= 0.3125 THEN (sqrt(greatest(0.25 + 2 * 0.5 * u, 0)) - 0.5) / 0.5 ELSE 0.5 + (sqrt(greatest(0.5625 + 2 * 2.5 * (u - 0.3125), 0)) - 0.75) / 2.5 END, 9) AS position FROM u""",
    "op8_licences": _licences(),
    "op10_cells": """WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.9), n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a),
r AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON r.vec_id = l.a), m AS (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept FROM m LEFT JOIN n USING (vec_id)""",
}
