"""DuckDB SQL of the catalogue's queries, written apart from their DataFrame code."""

from __future__ import annotations

ACC = "ÉÈÊËàâäáéèêëîïíôöóûüúùçÀÂÄÁÎÏÍÔÖÓÛÜÚÙÇ"
FOLD = "EEEEaaaaeeeeiiiooouuuucAAAAIIIOOOUUUUC"
LEGAL = "'SAS','SASU','SARL','EURL','SCI','SCIC','SCOP','SA','SNC','SELARL','SELAS','SELASU'"
STREET = "'RUE','AV','AVE','AVENUE','BD','BOULEVARD','CHE','CHEMIN','IMP','IMPASSE','ALL','ALLEE','PL','PLACE','SQ','SQUARE','ROUTE','RTE','QUAI','SENTIER','ZA','ZI','ZAC'"
STOP = "'LES','DU','DE','LA','LE','DES','D','L','AUX','AU'"


def norm(x: str) -> str:
    t = f"trim(regexp_replace(translate(replace(upper(replace({x}, 'ß', 'SS')), '-', ' '), '{ACC}', '{FOLD}'), '\\s+', ' ', 'g'))"
    return f"(CASE WHEN {x} IS NULL OR trim({x}) IN ('[ND]','[nd]','ND','nan','NaN','None') THEN '' ELSE {t} END)"


def toks(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def legal(x: str) -> str:
    n = norm(x)
    bare = f"array_to_string(list_filter({toks(n)}, lambda w: w NOT IN ({LEGAL})), ' ')"
    return f"(CASE WHEN {bare} = '' THEN {n} ELSE {bare} END)"


def lev(a: str, b: str) -> str:
    return f"(CASE WHEN {a} = '' AND {b} = '' THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE 1 - levenshtein({a}, {b}) / CAST(greatest(length({a}), length({b})) AS DOUBLE) END)"


def name_tokens(x: str) -> str:
    return f"list_distinct(list_filter({toks(x)}, lambda w: w NOT IN ({STOP}) AND length(w) >= 2))"


def numbers(x: str) -> str:
    return f"list_distinct(regexp_extract_all({x}, '\\b(\\d{{1,6}})\\b', 1))"


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '([\\p{{L}}\\p{{N}}_]+)', 1)"


CRM = f"crm AS (SELECT c_custkey AS query_id, c_nationkey AS q_insee, c_custkey % 7 AS q_cp, {legal('c_name')} AS q_name FROM customer), stock AS (SELECT s_suppkey AS cand_id, s_nationkey AS insee, s_suppkey % 7 AS cp, {legal('s_name')} AS name FROM supplier)"
PAIRS = f"{CRM}, pairs AS (SELECT query_id, cand_id, q_name, name, jaro_winkler_similarity(q_name, name) AS jw, {lev('q_name', 'name')} AS lev FROM crm JOIN stock ON q_insee = insee), scored AS (SELECT *, round(0.6 * jw + 0.4 * lev, 6) AS score FROM pairs), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, cand_id) AS rank FROM scored)"
TWO = "two AS (SELECT query_id, max(score) FILTER (rank = 1) AS s1, coalesce(max(score) FILTER (rank = 2), 0.0) AS s2, avg(score) FILTER (rank <= 3) AS s3, max(cand_id) FILTER (rank = 1) AS chosen FROM ranked GROUP BY query_id)"
CALIB = "c AS (SELECT doc_id, (doc_id * 37 % 101) / 100.0::DOUBLE AS score, quality AS label FROM labels)"
BIN = "CAST(least(greatest(ceil(score * 10) - 1, 0), 9) AS INTEGER)"


def tfidf(q: str, docs: str, by: str, qid: str, did: str, terms: str, k: int, norm_: bool = False, min_df: int = 1, max_df: float = 1.0, out: str = "top") -> str:
    b = f"{by}, " if by else ""
    using = f"({b}term)"
    n = f"(SELECT {b}count(*) AS nd FROM {docs} GROUP BY {by})" if by else f"(SELECT count(*) AS nd FROM {docs})"
    join_n = f"JOIN {n} USING ({by})" if by else f"CROSS JOIN {n}"
    p = out
    length = lambda post, key: f"SELECT {b}{key}, sqrt(sum(w * w)) AS len FROM {post} GROUP BY {b}{key}"
    w = lambda post, key: f"(SELECT {b}{key}, term, w / len AS w FROM {post} JOIN ({length(post, key)}) USING ({b}{key}))" if norm_ else post
    return f"""{p}_pd AS (SELECT {b}{did}, term, count(*) AS tf FROM (SELECT {b}{did}, unnest({terms}) AS term FROM {docs}) GROUP BY ALL),
{p}_pq AS (SELECT {b}{qid}, term, count(*) AS tf FROM (SELECT {b}{qid}, unnest({terms}) AS term FROM {q}) GROUP BY ALL),
{p}_idf AS (SELECT {b}term, ln((1 + nd) / CAST(1 + df AS DOUBLE)) + 1 AS idf FROM (SELECT {b}term, count(*) AS df FROM {p}_pd GROUP BY ALL) {join_n} WHERE df >= {min_df} AND df <= {max_df} * nd),
{p}_wd AS (SELECT {b}{did}, term, tf * idf AS w FROM {p}_pd JOIN {p}_idf USING {using}), {p}_wq AS (SELECT {b}{qid}, term, tf * idf AS w FROM {p}_pq JOIN {p}_idf USING {using}),
{p}_s AS (SELECT {b}{qid}, {did}, round(sum(x.w * y.w), 6) AS score FROM {w(p + '_wq', qid)} x JOIN {w(p + '_wd', did)} y USING {using} GROUP BY ALL),
{p} AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {b}{qid} ORDER BY score DESC, {did}) AS INTEGER) AS rank FROM {p}_s) WHERE rank <= {k})"""


def grams(x: str, least: int, most: int) -> str:
    parts = []
    for n in range(least, most + 1):
        short = f"length(w) = {n}" + (f" OR {n} = {least}" if n == least else "")
        parts.append(f"(CASE WHEN length(w) > {n} THEN list_transform(range(1, length(w) - {n} + 2), lambda i: w[i:i + {n - 1}]) WHEN {short} THEN [w] ELSE CAST([] AS VARCHAR[]) END)")
    return f"flatten(list_transform(list_transform({toks(x)}, lambda v: ' ' || v || ' '), lambda w: list_concat({', '.join(parts)})))"


def word_grams(x: str) -> str:
    w = words(x)
    return f"list_concat({w}, list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"


PARTS = f"p AS (SELECT p_partkey, p_size, {norm("p_name || ' ' || p_type")} AS t FROM part), q AS (SELECT p_partkey AS q, p_size, t FROM p)"
CATEGORY_5 = "'5410','5415','5499','5505','5510','5560','5599','5710','5720','5770','5785','5202','5485','5699','5660'"


def dense(k: int) -> str:
    dot = "list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: x[1]::DOUBLE * x[2]::DOUBLE))"
    return f"s AS (SELECT a.label, a.vec_id AS q, b.vec_id, round({dot}, 5) AS score FROM embeddings a JOIN embeddings b USING (label) WHERE a.vec_id <> b.vec_id), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s), top AS (SELECT * FROM r WHERE rank <= {k})"


def routing(src: str, group: str = "") -> str:
    return f"""m AS (SELECT {group}count(*) AS total, count(*) FILTER (status = 'AUTO') AS auto, count(*) FILTER (status = 'AUTO' AND strict) AS auto_right, count(*) FILTER (status = 'AUTO' AND same) AS auto_same, count(*) FILTER (status <> 'AUTO' AND strict) AS review_right, count(*) FILTER (strict) AS "right" FROM {src}"""


SQL: dict[str, str] = {
    "text_normalize": f"SELECT doc_id, md5({norm('text')}) AS norm_md5, length({norm('text')}) AS norm_length FROM documents",
    "name_normalize_legal": f"""WITH r AS (SELECT c_custkey AS id, 'SARL ' || c_name || ' SAS' AS raw FROM customer UNION ALL SELECT -s_suppkey, s_name || '-École  S.A.' FROM supplier), x AS (SELECT *, raw || ' ' || raw AS two FROM r)
SELECT id, {legal('raw')} AS name, CASE WHEN length(two) <= 20 THEN two WHEN contains(two[1:21], ' ') THEN regexp_replace(two[1:21], ' [^ ]*$', '') ELSE two[1:21] END AS short_name FROM x""",
    "tfidf_text_normalize": f"""WITH r AS (SELECT p_partkey AS id, p_name || ' j.n.c. travaux' || p_type AS raw FROM part UNION ALL SELECT -item_id - 1, text FROM benchmark),
b AS (SELECT id, trim(regexp_replace(regexp_replace({norm('raw')}, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS b FROM r),
w AS (SELECT id, unnest({toks('b')}) AS w, generate_subscripts({toks('b')}, 1) AS i FROM b),
g AS (SELECT *, i - row_number() OVER (PARTITION BY id, (length(w) = 1 AND regexp_matches(w, '^\\p{{L}}$')) ORDER BY i) AS island, (length(w) = 1 AND regexp_matches(w, '^\\p{{L}}$')) AS one FROM w),
a AS (SELECT id, 1000000 + min(i) AS i, string_agg(w, '' ORDER BY i) AS w FROM g WHERE one GROUP BY id, island HAVING count(*) >= 2),
al AS (SELECT id, w, i FROM w UNION ALL SELECT id, w, i FROM a),
e AS (SELECT id, i * 2 AS o, w FROM al UNION ALL SELECT id, i * 2 + 1, CASE WHEN w LIKE '%AUX' AND length(w) >= 6 THEN w[:-4] || 'AL' WHEN w LIKE '%S' AND w NOT LIKE '%SS' THEN w[:-2] WHEN w LIKE '%X' THEN w[:-2] END FROM al WHERE length(w) >= 5 AND regexp_matches(w, '^\\p{{L}}+$')),
u AS (SELECT id, w, min(o) AS o FROM e WHERE w IS NOT NULL GROUP BY id, w)
SELECT r.id, coalesce(t.terms, '') AS terms FROM r LEFT JOIN (SELECT id, string_agg(w, ' ' ORDER BY o) AS terms FROM u GROUP BY id) t USING (id)""",
    "code_normalize": "WITH x AS (SELECT c_custkey, c_nationkey, CASE WHEN length((c_custkey * 61)::VARCHAR) >= 5 THEN (c_custkey * 61)::VARCHAR ELSE lpad((c_custkey * 61)::VARCHAR, 5, '0') END AS code FROM customer) SELECT c_custkey, code, CASE WHEN code[1:2] IN ('97', '98') THEN code[1:3] ELSE code[1:2] END AS department, code[1:2] AS postcode_department, c_nationkey::VARCHAR AS legal_code FROM x",
    "identifier_clean": """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey::VARCHAR WHEN o_orderkey % 3 = 1 THEN o_orderkey::VARCHAR || '12345678900011' ELSE o_custkey::VARCHAR || '7' END AS n FROM orders)
SELECT o_orderkey, CASE WHEN length(n) <= 14 THEN lpad(n, 14, '0') END AS siret, CASE WHEN length(n) >= 9 THEN n ELSE lpad(n, 9, '0') END AS siren, CASE WHEN length(n) <= 14 THEN lpad(n, 14, '0')[1:9] END AS siren_of_siret FROM x""",
    "numeric_tokens": f"SELECT doc_id, len({numbers('text')}) AS n_numbers, array_to_string(list_sort({numbers('text')}), ',') AS numbers FROM documents",
    "url_parse": "SELECT page_id, regexp_extract(url, '^(\\w+)://', 1) AS scheme, regexp_extract(url, '^\\w+://([^/:?#]+)', 1) AS host, regexp_extract(url, '^\\w+://[^/?#]*([^?#]*)', 1) AS path FROM pages",
    "json_props": "SELECT event_id, array_to_string(list_sort(json_keys(props)), ',') AS fields FROM events",
    "legal_category_map": f"""WITH x AS (SELECT p_partkey, p_size, '5' || lpad((p_partkey * 7 % 900)::VARCHAR, 3, '0') AS code, p_size * 2 AS division FROM part)
SELECT p_partkey, CASE WHEN code IN ('5532','5542','5552','5558') THEN 'PUBLIC' WHEN code IN ({CATEGORY_5}) THEN 'PRIVE' ELSE 'INCONNU' END AS category,
CASE WHEN division > 99 THEN (CASE WHEN division = 100 THEN 'C' END) WHEN division BETWEEN 1 AND 3 THEN 'A' WHEN division BETWEEN 5 AND 9 THEN 'B' WHEN division BETWEEN 10 AND 33 THEN 'C' WHEN division = 35 THEN 'D' WHEN division BETWEEN 36 AND 39 THEN 'E' WHEN division BETWEEN 41 AND 43 THEN 'F' WHEN division BETWEEN 45 AND 47 THEN 'G' WHEN division BETWEEN 49 AND 53 THEN 'H' WHEN division BETWEEN 55 AND 56 THEN 'I' WHEN division BETWEEN 58 AND 63 THEN 'J' WHEN division BETWEEN 64 AND 66 THEN 'K' WHEN division = 68 THEN 'L' WHEN division BETWEEN 69 AND 75 THEN 'M' WHEN division BETWEEN 77 AND 82 THEN 'N' WHEN division = 84 THEN 'O' WHEN division = 85 THEN 'P' WHEN division BETWEEN 86 AND 88 THEN 'Q' WHEN division BETWEEN 90 AND 93 THEN 'R' WHEN division BETWEEN 94 AND 96 THEN 'S' WHEN division BETWEEN 97 AND 98 THEN 'T' WHEN division = 99 THEN 'U' END AS section,
CASE WHEN p_size = 1 THEN 9 ELSE 1 END::BIGINT AS n_arrondissements FROM x""",
    "left_join_enrich": "SELECT c_nationkey, c_custkey, c_name, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
    "semi_join_scope": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_mktsegment IS NOT NULL)",
    "anti_join_missing": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000)",
    "blocking_join": f"WITH {CRM} SELECT query_id, count(*) AS pool_size, min(cand_id) AS first_candidate FROM crm JOIN stock ON q_insee = insee GROUP BY query_id",
    "blocking_fallback": f"WITH {CRM}, a AS (SELECT query_id, cand_id FROM crm JOIN stock ON q_insee + 5 = insee), b AS (SELECT query_id, cand_id FROM crm JOIN stock ON q_cp = cp WHERE query_id NOT IN (SELECT query_id FROM a)) SELECT query_id, max(via) AS via, count(*) AS pool_size, sum(cand_id)::BIGINT AS id_sum FROM (SELECT *, 'first' AS via FROM a UNION ALL SELECT *, 'second' FROM b) GROUP BY query_id",
    "location_or_union": f"WITH {CRM} SELECT query_id, count(*) AS pool_size, sum(cand_id)::BIGINT AS id_sum FROM crm JOIN stock ON q_insee = insee OR q_cp = cp GROUP BY query_id",
    "mega_policy": "WITH n AS (SELECT l_suppkey % 25 AS block, l_partkey % 5 AS narrow, count(*) AS n FROM lineitem GROUP BY ALL), b AS (SELECT block, sum(n) AS c FROM n GROUP BY block), g AS (SELECT block FROM b WHERE c >= (SELECT avg(c) FROM b)) SELECT s_suppkey, sum(n)::BIGINT AS pool_size FROM supplier JOIN n ON s_suppkey % 25 = block WHERE block NOT IN (SELECT block FROM g) OR s_suppkey % 5 = narrow GROUP BY s_suppkey",
    "numeric_rescue_join": f"WITH b AS (SELECT item_id, unnest({numbers("(text || ' ' || item_id)")}) AS t FROM benchmark), d AS (SELECT doc_id, unnest({numbers('text')}) AS t FROM documents) SELECT item_id, doc_id, count(*) AS shared FROM b JOIN d USING (t) GROUP BY ALL",
    "sibling_bag": f"WITH x AS (SELECT *, {norm('p_name')} AS n FROM part) SELECT p_partkey, md5(names) AS names_md5 FROM x JOIN (SELECT p_brand, p_size, string_agg(DISTINCT n, ' ' ORDER BY n) AS names FROM x GROUP BY ALL) USING (p_brand, p_size)",
    "address_density": f"WITH x AS (SELECT *, CASE WHEN p_size > 40 THEN '' ELSE {norm('p_name')} END AS a FROM part) SELECT p_partkey, CASE WHEN a = '' THEN 1 ELSE count(*) OVER (PARTITION BY p_brand, a) END AS density FROM x",
    "category_filter_fallback": "WITH x AS (SELECT *, ('57' || lpad((p_partkey % 90)::VARCHAR, 2, '0')) IN ('5710','5720','5770','5785') AS m FROM part), y AS (SELECT *, bool_or(m) OVER (PARTITION BY p_brand) AS any_ FROM x), z AS (SELECT p_brand, p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS place FROM y WHERE m OR NOT any_) SELECT * FROM z WHERE place <= 20",
    "siren_expansion": """WITH o AS (SELECT o_custkey AS siren, o_orderkey AS siret, o_orderkey % 9 AS insee, o_orderkey % 4 AS cp, (o_orderstatus = 'F')::INTEGER AS closed, o_totalprice FROM orders), f AS (SELECT siren AS query_id, min(siret) AS s0 FROM o GROUP BY siren),
x AS (SELECT query_id, o.siret, CASE WHEN insee = s0 % 9 THEN 0 WHEN cp = s0 % 4 THEN 1 ELSE 2 END AS bucket, closed, o_totalprice FROM f JOIN o ON siren = query_id WHERE siret <> s0),
y AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY bucket, closed, o_totalprice DESC, siret) AS rank FROM x) SELECT query_id, siret, bucket::INTEGER AS bucket, rank::INTEGER AS rank FROM y WHERE rank <= 10""",
    "pairwise_jw": f"WITH {PAIRS} SELECT query_id, cand_id, round(jw, 6) AS jw FROM pairs",
    "pairwise_levenshtein": f"WITH {PAIRS} SELECT query_id, cand_id, round(lev, 6) AS lev FROM pairs",
    "pairwise_jaccard": f"""WITH p AS (SELECT p_partkey, p_brand, {norm("p_name || ' ' || p_type")} AS n FROM part), x AS (SELECT *, {name_tokens('n')} AS t, {numbers('n')} AS u, {toks('n')}[1] AS f FROM p)
SELECT a.p_partkey AS q, b.p_partkey, round(CASE WHEN len(a.t) = 0 AND len(b.t) = 0 THEN 1.0 WHEN len(a.t) = 0 OR len(b.t) = 0 THEN 0.0 ELSE len(list_intersect(a.t, b.t)) / CAST(len(list_distinct(list_concat(a.t, b.t))) AS DOUBLE) END, 6) AS jaccard, round(CASE WHEN len(a.u) = 0 OR len(b.u) = 0 THEN 0.0 ELSE len(list_intersect(a.u, b.u)) / CAST(greatest(len(a.u), len(b.u)) AS DOUBLE) END, 6) AS numeric, (a.f = b.f)::INTEGER AS first_word FROM x a JOIN x b USING (p_brand) WHERE a.p_partkey < b.p_partkey""",
    "idf_overlap": f"""WITH p AS (SELECT p_partkey, p_brand, {norm("p_name || ' ' || p_type")} AS n FROM part), t AS (SELECT p_brand, p_partkey, unnest({name_tokens('n')}) AS term FROM p), i AS (SELECT p_brand, term, ln((1 + nd) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM t JOIN (SELECT p_brand, count(*) AS nd FROM p GROUP BY p_brand) USING (p_brand) GROUP BY p_brand, term, nd), f AS (SELECT p_brand, min(p_partkey) AS k FROM p GROUP BY p_brand), ft AS (SELECT p_brand, term FROM t JOIN f USING (p_brand) WHERE p_partkey = k),
g AS (SELECT p_partkey, avg(idf) AS m FROM t JOIN ft USING (p_brand, term) JOIN i USING (p_brand, term) GROUP BY p_partkey) SELECT p_partkey, round(coalesce(m, 0.0), 6) AS idf_overlap FROM p LEFT JOIN g USING (p_partkey)""",
    "word_tfidf_topk": f"WITH b AS (SELECT item_id, {norm('text')} AS t FROM benchmark), d AS (SELECT doc_id, {norm('text')} AS t FROM documents), {tfidf('b', 'd', '', 'item_id', 'doc_id', words('t'), 10)} SELECT item_id, doc_id, round(score, 3) AS score, rank FROM top",
    "char_tfidf_topk": f"WITH {PARTS}, {tfidf('q', 'p', 'p_size', 'q', 'p_partkey', grams('t', 3, 5), 3, True)} SELECT q, p_partkey, score, rank FROM top",
    "address_tfidf_topk": f"WITH {PARTS}, {tfidf('q', 'p', 'p_size', 'q', 'p_partkey', word_grams('t'), 3, False, 1, 0.95)} SELECT q, p_partkey, score, rank FROM top",
    "global_cosine_topk": f"WITH {PARTS}, {tfidf('q', 'p', 'p_size', 'q', 'p_partkey', words('t'), 10, True, 2, 0.95, 'w')}, {tfidf('q', 'p', 'p_size', 'q', 'p_partkey', grams('t', 3, 3), 10, True, 2, 0.95, 'c')}, m AS (SELECT q, p_partkey, round(coalesce(w.score, 0.8 * c.score), 6) AS score FROM w FULL JOIN c USING (q, p_partkey)), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, p_partkey) AS INTEGER) AS rank FROM m) SELECT * FROM r WHERE rank <= 5",
    "hybrid_union_rescue": f"WITH {PARTS}, {tfidf('q', 'p', 'p_size', 'q', 'p_partkey', words('t'), 5, False, 1, 1.0, 'w')}, {tfidf('q', 'p', 'p_size', 'q', 'p_partkey', word_grams('t'), 5, False, 1, 0.5, 'a')}, u AS (SELECT q, p_partkey, 0 AS c, rank FROM w UNION ALL SELECT q, p_partkey, 1, rank FROM a), f AS (SELECT q, p_partkey, min(c) AS c, arg_min(rank, c) AS r FROM u GROUP BY ALL), z AS (SELECT q, p_partkey, CASE WHEN c = 0 THEN 'name' ELSE 'address' END AS channel, CAST(row_number() OVER (PARTITION BY q ORDER BY c, r, p_partkey) AS INTEGER) AS place FROM f) SELECT * FROM z WHERE place <= 8",
    "dense_topk": f"WITH {dense(5)} SELECT q, vec_id, score, rank FROM top",
    "semantic_top2_gap": f"WITH {dense(2)}, g AS (SELECT q, max(score) FILTER (rank = 1) AS best, coalesce(max(score) FILTER (rank = 2), 0.0) AS second FROM top GROUP BY q) SELECT *, round(best - second, 6) AS gap FROM g",
    "dedupe_last_wins": "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1",
    "stage1_topn": f"WITH {PAIRS} SELECT query_id, count(*) AS kept, sum(cand_id)::BIGINT AS id_sum FROM ranked WHERE rank <= 2 GROUP BY query_id",
    "topk_gap_ratio": f"WITH {PAIRS}, {TWO} SELECT query_id, round(s1, 6) AS score_top1, round(s2, 6) AS score_top2, round(s3, 6) AS score_top3_avg, round(s1 - s2, 6) AS score_gap, round(s1 / CASE WHEN s2 > 1e-6 THEN s2 ELSE 0.001 END, 6) AS score_ratio FROM two",
    "open_over_closed": """WITH o AS (SELECT o_custkey AS q, (o_custkey % 2)::VARCHAR || right(o_orderkey::VARCHAR, 1) AS siren, o_orderkey, o_orderstatus = 'F' AS closed, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders), t AS (SELECT * FROM o WHERE rank <= 10), m AS (SELECT *, min(rank) FILTER (closed) OVER (PARTITION BY q, siren) AS c, min(rank) FILTER (NOT closed) OVER (PARTITION BY q, siren) AS p FROM t)
SELECT q, o_orderkey, CAST(CASE WHEN c < p AND rank = c THEN p WHEN c < p AND rank = p THEN c ELSE rank END AS INTEGER) AS rank FROM m""",
    "risk_features": f"WITH {PAIRS}, r AS (SELECT query_id, coalesce(max(score) FILTER (rank = 1), 0.0) AS s1, coalesce(max(score) FILTER (rank = 2), 0.0) AS s2, coalesce(max(jw) FILTER (rank = 1), 0.0) AS j1, coalesce(max(jw) FILTER (rank = 2), 0.0) AS j2, coalesce(max(lev) FILTER (rank = 1), 0.0) AS l1, coalesce(max(lev) FILTER (rank = 2), 0.0) AS l2 FROM ranked GROUP BY query_id) SELECT query_id, round(s1, 6) AS score_top1, round(s2, 6) AS score_top2, round(s1 - s2, 6) AS score_gap, round(s1 / CASE WHEN s2 > 1e-6 THEN s2 ELSE 0.001 END, 6) AS score_ratio, round(j1, 6) AS top1_name_jaro_max, round(j2, 6) AS top2_name_jaro_max, round(j1 - j2, 6) AS delta_name_jaro_max, round(l1, 6) AS top1_addr_jaro, round(l1 - l2, 6) AS delta_addr_jaro, 0.0::DOUBLE AS delta_city_match FROM r",
    "route_auto_review": f"WITH {PAIRS}, {TWO} SELECT query_id, chosen, round(s1, 6) AS score, round(s1 - s2, 6) AS gap, CASE WHEN s1 >= 0.85 AND s1 - s2 >= 0.01 THEN 'AUTO' ELSE 'REVIEW' END AS status, CASE WHEN s1 >= 0.85 THEN 'MATCH' WHEN s1 >= 0.6 THEN 'REVIEW' ELSE 'NO_MATCH' END AS confidence FROM two",
    "places_fallback": f"WITH {PAIRS}, t AS (SELECT query_id, score FROM ranked WHERE rank = 1), x AS (SELECT query_id, CASE WHEN s_suppkey IS NULL THEN 'NO_PLACE' WHEN query_id % 11 <> s_suppkey % 11 THEN 'DEPARTMENT_MISMATCH' WHEN score < 0.75 THEN 'LOW_SCORE' ELSE 'OK' END AS reason FROM t LEFT JOIN supplier ON s_suppkey * 3 = query_id WHERE score < 0.9) SELECT query_id, reason, CASE WHEN reason = 'OK' THEN 'MATCH_PLACES' ELSE 'NO_MATCH' END AS final_status FROM x",
    "loss_reasons": "SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'FOUND' WHEN o_orderkey % 5 = 0 THEN 'NOT_IN_PARTITION' WHEN o_orderstatus = 'F' THEN 'FILTERED_CLOSED' WHEN o_orderkey % 11 = 0 THEN 'FILTERED_UNNAMED' WHEN o_orderkey % 13 = 0 THEN 'PRUNED_BY_PREFILTER' WHEN o_orderkey % 3 = 0 THEN 'PRUNED_BY_TFIDF' ELSE 'FILTERED_OTHER' END AS reason, count(*) AS n FROM orders GROUP BY ALL",
    "group_sources": "WITH f AS (SELECT conv_id AS key, role, min(turn) AS o, count(*) AS n FROM conversations WHERE conv_id IS NOT NULL GROUP BY ALL) SELECT key, string_agg(role, '|' ORDER BY o, role) AS sources, min(o) AS first_seen, sum(n)::BIGINT AS n_rows FROM f GROUP BY key",
    "commune_mode": "WITH g AS (SELECT c_nationkey, o_orderpriority, o_orderstatus, count(*) AS n, min(o_orderkey) AS f FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) SELECT c_nationkey, o_orderpriority, o_orderstatus, n FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, f) AS r FROM g) WHERE r = 1",
    "string_agg_distinct": "WITH g AS (SELECT p_brand, string_agg(DISTINCT coalesce(p_name, ''), ' ' ORDER BY coalesce(p_name, '')) || ' ' || string_agg(DISTINCT coalesce(p_type, ''), ' ' ORDER BY coalesce(p_type, '')) AS n FROM part GROUP BY p_brand) SELECT p_brand, md5(trim(regexp_replace(regexp_replace(upper(n), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))) AS names_md5 FROM g",
    "geo_count_index": "SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS site_count FROM lineitem GROUP BY ALL",
    "geo_locations_in_order": "WITH g AS (SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL), w AS (SELECT *, row_number() OVER k AS place, coalesce(sum(n) OVER (PARTITION BY l_suppkey ORDER BY l_returnflag <> 'R', l_linestatus <> 'F', n DESC, l_returnflag, l_linestatus ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g WINDOW k AS (PARTITION BY l_suppkey ORDER BY l_returnflag <> 'R', l_linestatus <> 'F', n DESC, l_returnflag, l_linestatus)) SELECT l_suppkey, l_returnflag, l_linestatus, place::INTEGER AS place, before::BIGINT AS before FROM w WHERE before < 400",
    "source_cap": "SELECT event_id, place::INTEGER AS place FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS place FROM events) WHERE place <= 3",
    "closed_filter": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IS NULL OR o_orderstatus <> 'F' OR o_orderdate >= TIMESTAMP '1997-01-01'",
    "partition_validator": "WITH g AS (SELECT l_returnflag || l_linestatus AS code, l_orderkey AS k, count(*) AS n, count(*) FILTER (l_linestatus <> 'F') AS m FROM lineitem GROUP BY ALL) SELECT code, sum(n)::BIGINT AS n_rows, coalesce(sum(n) FILTER (k IS NULL), 0)::BIGINT AS null_keys, sum(CASE WHEN k IS NULL THEN 0 ELSE n - 1 END)::BIGINT AS duplicates, sum(m)::BIGINT AS mixed FROM g GROUP BY code",
    "audit_location": "WITH o AS (SELECT o_custkey, min(o_orderstatus) AS st FROM orders GROUP BY o_custkey) SELECT CASE WHEN o_custkey IS NULL THEN 'missing' WHEN st = 'F' THEN 'ok' ELSE 'bad' END AS status, count(*) AS n FROM customer LEFT JOIN o ON c_custkey = o_custkey GROUP BY ALL",
    "upsert_keep_last": "WITH n AS (SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL), f AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL) SELECT * FROM n UNION ALL SELECT * FROM f WHERE o_custkey NOT IN (SELECT o_custkey FROM n)",
    "hit_at_k": f"WITH {PAIRS}, f AS (SELECT query_id, min(rank) FILTER (cand_id % 4 = query_id % 4) AS f FROM ranked WHERE rank <= 2 GROUP BY query_id) SELECT count(*) AS queries, round(avg((coalesce(f, 99) <= 1)::INTEGER), 6) AS hit_1, round(avg((coalesce(f, 99) <= 2)::INTEGER), 6) AS hit_2, round(avg(coalesce(1 / f::DOUBLE, 0)), 6) AS mrr FROM f",
    "routing_evaluation": f"WITH {PAIRS}, t AS (SELECT CASE WHEN score >= 0.85 THEN 'AUTO' ELSE 'REVIEW' END AS status, cand_id % 4 = query_id % 4 AS strict, cand_id % 2 = query_id % 2 AS same FROM ranked WHERE rank = 1), {routing('t')}) SELECT *, round(auto / total::DOUBLE, 6) AS auto_rate, round(coalesce(auto_right / nullif(auto, 0)::DOUBLE, 0), 6) AS precision, round(coalesce(auto_same / nullif(auto, 0)::DOUBLE, 0), 6) AS precision_same, round(CASE WHEN auto > 0 THEN 1 - auto_right / auto::DOUBLE ELSE 0.0 END, 6) AS fp_rate, round(coalesce(review_right / nullif(\"right\", 0)::DOUBLE, 0), 6) AS fn_rate FROM m",
    "segment_breakdown": f"WITH t AS (SELECT lang, CASE WHEN toxic = 0 THEN 'AUTO' ELSE 'REVIEW' END AS status, quality = 1 AS strict, quality = 1 AS same FROM labels JOIN documents USING (doc_id)), {routing('t', 'lang, ')} GROUP BY GROUPING SETS ((lang), ())) SELECT coalesce(lang, 'ALL') AS segment, total, auto, auto_right, round(auto / total::DOUBLE, 6) AS auto_rate, round(coalesce(auto_right / nullif(auto, 0)::DOUBLE, 0), 6) AS precision, round(CASE WHEN auto > 0 THEN 1 - auto_right / auto::DOUBLE ELSE 0.0 END, 6) AS fp_rate, round(coalesce(review_right / nullif(\"right\", 0)::DOUBLE, 0), 6) AS fn_rate FROM m",
    "calibration_ece": f"WITH {CALIB}, x AS (SELECT *, least(greatest(score, 1e-15), 1 - 1e-15) AS p, {BIN} AS b FROM c), g AS (SELECT b, count(*) AS n, sum(score) AS s, sum(label) AS y, sum((score - label) ** 2) AS q, sum(-(label * ln(p) + (1 - label) * ln(1 - p))) AS l FROM x GROUP BY b) SELECT round(sum(q) / sum(n), 6) AS brier, round(sum(l) / sum(n), 6) AS log_loss, round(sum(abs(s - y)) / sum(n), 6) AS ece FROM g",
    "calibration_table": f"WITH {CALIB}, g AS (SELECT {BIN} AS bin, count(*) AS n, avg(score) AS m, avg(label) AS r FROM c GROUP BY 1) SELECT i::INTEGER AS bin, coalesce(n, 0) AS n, round(coalesce(m, 0.0), 6) AS mean_score, round(coalesce(r, 0.0), 6) AS rate FROM range(10) t(i) LEFT JOIN g ON i = bin",
    "auc": f"WITH {CALIB}, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS k FROM c) SELECT round((sum(k) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0::DOUBLE) / (count(*) FILTER (label = 1) * count(*) FILTER (label <> 1))::DOUBLE, 6) AS auc FROM r",
    "threshold_sweep": f"WITH {CALIB}, t AS (SELECT round(0.5 + 0.005 * i, 3)::DOUBLE AS threshold FROM range(100) r(i)), g AS (SELECT threshold, count(*) AS total, count(*) FILTER (score >= threshold) AS accepted, count(*) FILTER (score >= threshold AND label <> 1) AS wrong FROM c CROSS JOIN t GROUP BY threshold), h AS (SELECT *, round(accepted / total::DOUBLE, 6) AS auto_rate, round(coalesce(wrong / nullif(accepted, 0)::DOUBLE, 0.0), 6) AS fp_rate FROM g) SELECT *, row_number() OVER (ORDER BY fp_rate > 0.15, CASE WHEN fp_rate > 0.15 THEN fp_rate ELSE 0 END, auto_rate DESC, threshold) = 1 AS best FROM h",
    "cost_grid": f"WITH {CALIB}, x AS (SELECT score, doc_id % 10 / 20.0::DOUBLE AS g FROM c), t AS (SELECT unnest([0.75, 0.8, 0.85, 0.9])::DOUBLE AS threshold), u AS (SELECT unnest([0.0, 0.05, 0.1, 0.15, 0.2, 0.25])::DOUBLE AS gap_min), a AS (SELECT threshold, gap_min, count(*) AS total, count(*) FILTER (score >= threshold AND g >= gap_min) AS auto_count FROM x CROSS JOIN t CROSS JOIN u GROUP BY ALL), b AS (SELECT *, total - auto_count AS review_count, CAST(floor((total - auto_count) * 5000 * 30 / total::DOUBLE) AS BIGINT) AS monthly_calls FROM a) SELECT *, round(auto_count / total::DOUBLE, 6) AS auto_rate, round(greatest(monthly_calls - 2500, 0) * 0.001::DOUBLE, 6) AS monthly_cost, round(monthly_calls * 0.017::DOUBLE, 6) AS monthly_cost_other FROM b",
    "pipeline_stats": "SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS matched, count(*) FILTER (o_orderstatus = 'P') AS review, round(count(*) FILTER (o_orderstatus = 'F') / count(*)::DOUBLE, 4) AS match_rate, round(avg(o_totalprice) FILTER (o_orderstatus = 'F'), 4) AS mean_match, round(min(o_totalprice) FILTER (o_orderstatus = 'F'), 4) AS min_match, round(max(o_totalprice) FILTER (o_orderstatus = 'F'), 4) AS max_match FROM orders",
    "timer_percentiles": "SELECT event_type, count(value) AS n, round(sum(value), 4) AS total, round(sum(value) / count(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type",
    "hard_negatives": f"""WITH {PAIRS}, n AS (SELECT * FROM scored WHERE cand_id % 4 <> query_id % 4), a AS (SELECT query_id, cand_id, 0 AS k, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, cand_id) AS r FROM n WHERE score >= 0.7 UNION ALL SELECT query_id, cand_id, 1, row_number() OVER (PARTITION BY query_id ORDER BY lev DESC, cand_id) FROM n WHERE lev >= 0.5 UNION ALL SELECT query_id, cand_id, 2, row_number() OVER (PARTITION BY query_id ORDER BY md5(query_id || '|' || cand_id), cand_id) FROM n), b AS (SELECT * FROM a WHERE r <= 5), c AS (SELECT *, row_number() OVER (PARTITION BY query_id, cand_id ORDER BY k) AS f FROM b), e AS (SELECT query_id, cand_id, CASE k WHEN 0 THEN 'hard' WHEN 1 THEN 'same_addr' ELSE 'random' END AS kind, CAST(row_number() OVER (PARTITION BY query_id ORDER BY k, r, cand_id) AS INTEGER) AS place FROM c WHERE f = 1) SELECT * FROM e WHERE place <= 8""",
    "group_split": "WITH x AS (SELECT o_orderkey, o_custkey, ('0x' || md5(o_custkey::VARCHAR)[1:8])::BIGINT % 100 AS b FROM orders) SELECT o_orderkey, o_custkey, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'dev' ELSE 'test' END AS split FROM x",
    "silver_labels": "SELECT event_id, event_type FROM events WHERE coalesce(CASE WHEN event_id % 5 <> 0 THEN value END >= 20, true) AND coalesce(CASE WHEN event_id % 3 = 0 THEN value / 100 END >= 0.5, true)",
    "stream_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "embedding_text_normalize": f"""WITH r AS (SELECT p_partkey AS id, replace(array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' '), ' ', '') || p_brand || 'SNCFGare15Pro' AS raw FROM part),
n AS (SELECT id, trim(regexp_replace(translate(replace(raw, '-', ' '), '{ACC}', '{FOLD}'), '\\s+', ' ', 'g')) AS n FROM r)
SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(n, '([a-z])([A-Z])', '\\1 \\2', 'g'), '([A-Z]+)([A-Z][a-z])', '\\1 \\2', 'g'), '(\\d+)', ' \\1 ', 'g'), '\\s+', ' ', 'g')) AS embedding_text FROM n""",
    "address_parse": f"""WITH r AS (SELECT p_partkey, p_size::VARCHAR AS num, p_type, p_name, lpad((p_partkey % 10000)::VARCHAR, 4, '0') AS tail FROM part)
SELECT p_partkey, num AS number, 'Rue ' || p_type || ', 6' || tail || ' ' || p_name AS street, '6' || tail AS postcode, p_name AS city, num || '|' || array_to_string(list_filter({toks(norm('p_type'))}, lambda w: w NOT IN ({STREET})), ' ') AS address_hash, num || ' bis' AS number_with_suffix FROM r""",
    "hash_rescue_join": f"""WITH h AS (SELECT p_partkey, p_size::VARCHAR || '|' || array_to_string(list_filter({toks(norm('p_name'))}, lambda w: w NOT IN ({STREET})), ' ') AS h FROM part) SELECT a.p_partkey AS q, count(*) AS n, min(a.h) AS address_hash FROM h a JOIN h b USING (h) WHERE a.p_partkey < b.p_partkey GROUP BY a.p_partkey""",
    "person_name_flag": f"""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Jean-' ELSE 'Acme ' END || translate(c_mktsegment, '0123456789', '') || CASE WHEN c_custkey % 5 = 0 THEN ' SARL' ELSE '' END AS n FROM customer), t AS (SELECT c_custkey, n, {toks(norm('n'))} AS t FROM r)
SELECT c_custkey, len(t) BETWEEN 2 AND 3 AND NOT regexp_matches(n, '\\d') AND NOT list_has_any(t, [{LEGAL}]) AND list_has_any(t, ['JEAN']) AS is_person FROM t""",
    "acronym_match": f"""WITH p AS (SELECT p_partkey, {norm('p_name')} AS n FROM part), a AS (SELECT *, CASE WHEN len({toks('n')}) <= 1 THEN '' ELSE array_to_string(list_transform(list_filter({toks('n')}, lambda w: w NOT IN ({STOP}, 'ET', 'LYON', 'CORBAS', 'DECINES', 'MEYZIEU', 'VILLEURBANNE')), lambda w: w[1:1]), '') END AS acronym FROM p),
x AS (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN n[1:2] ELSE acronym END AS a FROM a), y AS (SELECT *, regexp_matches(replace(a, ' ', ''), '^[A-Z]{{2,6}}$') AS ia, regexp_matches(replace(n, ' ', ''), '^[A-Z]{{2,6}}$') AS ib FROM x)
SELECT p_partkey, acronym, CASE WHEN ia AND NOT ib THEN starts_with(acronym, replace(a, ' ', ''))::INTEGER WHEN ib AND NOT ia THEN (len({toks('a')}) > 1 AND starts_with(array_to_string(list_transform({toks('a')}, lambda w: w[1:1]), ''), replace(n, ' ', '')))::INTEGER ELSE 0 END AS matches FROM y""",
    "bag_of_names": f"""WITH j AS (SELECT p_partkey, p_size, unnest([p_name, p_type, s_name, 'Jean ' || p_brand, p_brand[1:2]]) AS v, unnest([1, 3, 7, 8, 5]) AS o, unnest([1, 2, 3, 4, 5]) AS i FROM part LEFT JOIN supplier ON p_partkey % 100 + 1 = s_suppkey),
n AS (SELECT *, {legal('v')} AS t FROM j), k AS (SELECT * FROM n WHERE length(t) > 2 AND NOT regexp_matches(t, '^[\\d ]+$') AND (o <> 8 OR p_size % 2 = 0)), u AS (SELECT p_partkey, t, min(i) AS i FROM k GROUP BY ALL)
SELECT p_partkey, coalesce(n_names, 0) AS n_names, coalesce(primary_name, '') AS primary_name, coalesce(bag_text, '') AS bag_text FROM part LEFT JOIN (SELECT p_partkey, count(*) AS n_names, arg_min(t, o) AS primary_name FROM k GROUP BY p_partkey) USING (p_partkey) LEFT JOIN (SELECT p_partkey, string_agg(t, ' ' ORDER BY i) AS bag_text FROM u GROUP BY p_partkey) USING (p_partkey)""",
    "prefilter_sample": f"""WITH {PAIRS}, x AS (SELECT query_id, cand_id, (cand_id = query_id % 100)::INTEGER AS label, rank AS o FROM ranked), y AS (SELECT *, row_number() OVER (PARTITION BY query_id, o > 2 ORDER BY md5(query_id || '|' || cand_id), cand_id) AS h FROM x WHERE query_id IN (SELECT query_id FROM x WHERE label = 1)) SELECT query_id, cand_id, label FROM y WHERE label = 1 OR o <= 2 OR h <= 2""",
    "pad_candidates": f"""WITH {PAIRS}, x AS (SELECT query_id, cand_id, rank, row_number() OVER (PARTITION BY query_id, rank = 1 ORDER BY md5('pad|' || query_id || '|' || cand_id), cand_id) AS r FROM ranked) SELECT query_id, cand_id FROM x WHERE rank = 1 OR r <= 2""",
    "feature_vector": f"""WITH {CRM}, b AS (SELECT s_suppkey AS cand_id, s_nationkey AS insee, unnest([s_name, 'Customer ' || s_suppkey]) AS v, unnest([0, 1]) AS pos FROM supplier), n AS (SELECT cand_id, insee, pos, {legal('v')} AS t FROM b), k AS (SELECT * FROM n WHERE length(t) > 2),
x AS (SELECT query_id, cand_id, pos, jaro_winkler_similarity(q_name, t) AS jw, {lev('q_name', 't')} AS lev FROM crm JOIN k ON q_insee = insee), r AS (SELECT *, row_number() OVER (PARTITION BY query_id, cand_id ORDER BY jw DESC, pos) AS p FROM x),
f AS (SELECT query_id, cand_id, count(*) AS name_count, max(jw) FILTER (p = 1) AS j1, coalesce(max(jw) FILTER (p = 2), 0.0) AS j2, max(lev) FILTER (p = 1) AS l FROM r GROUP BY ALL),
a AS (SELECT *, (query_id % 50) || ' RUE ' || (query_id % 9) AS a1, (cand_id % 50) || ' RUE ' || (cand_id % 9) AS a2, 'RUE ' || (query_id % 9) AS s1, 'RUE ' || (cand_id % 9) AS s2 FROM f),
g AS (SELECT *, jaro_winkler_similarity(a1, a2) AS aj, {lev('a1', 'a2')} AS al, jaro_winkler_similarity(s1, s2) AS sj FROM a)
SELECT query_id, cand_id, name_count, round(j1, 6) AS name_jaro_max, round(j2, 6) AS name_jaro_second, round(l, 6) AS name_levenshtein_max, round(aj, 6) AS addr_jaro, round(al, 6) AS addr_levenshtein, abs(query_id % 50 - cand_id % 50)::DOUBLE AS street_number_diff, round(sj, 6) AS street_name_jaro, round(j1 * aj, 6) AS name_addr_consistency, round(0.5 * sj + 0.3 * (query_id % 50 = cand_id % 50)::INTEGER + 0.2, 6) AS full_addr_match_score FROM g""",
}
