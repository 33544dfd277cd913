"""More of the catalogue: records, lookups, predicates, the pool and inference, and saved indexes. Each query stands
beside the DuckDB SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import fields as R
from ..functions import similarity as S
from ..functions import text as T
from ..operators import blocking as B
from ..operators import curation as K
from ..operators import evaluation as E
from ..operators import features as V
from ..operators import lookup as L
from ..operators import retrieval as X
from ..operators import sampling as M
from ..operators import scoring as P
from ..sources import sinks, tables
from ..staging import cut, new_path
from .catalogue import _best, _calibration, _crm, _scored, _stock, _top, _truth, r6, table
from .oracle import CALIB, PAIRS, legal, norm, toks
from .oracle import name_tokens as sql_name_tokens

QUERIES: dict = {}
SQL: dict[str, str] = {}
col, lit = F.col, F.lit


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Text and records

BLANKS = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


@query(f"""WITH r AS (SELECT n_nationkey, ' Saint-Étienne ' || n_name || '  lès-Ñu' AS raw FROM nation)
SELECT n_nationkey, {BLANKS.format("replace(upper(strip_accents(trim(raw))), '-', ' ')")} AS city, regexp_replace(strip_accents(raw || '€'), '[^\\x00-\\x7F]', '', 'g') AS plain FROM r""")
def city_normalize(spark, d):
    r = table(spark, d, "nation").select("n_nationkey", F.concat(lit(" Saint-Étienne "), "n_name", lit("  lès-Ñu")).alias("raw"))
    return r.select("n_nationkey", R.city_key(col("raw")).alias("city"), R.transliterated(F.concat("raw", lit("€"))).alias("plain"))


def _crm_raw(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    school = F.when(col("c_custkey") % 2 == 0, "École ").otherwise("Groupe ")
    return j.select("c_custkey", F.concat(school, "c_mktsegment", lit(" "), "n_name", lit(" SARL ("), F.lower("c_mktsegment"), lit(") (SIEGE)")).alias("name"), F.concat((col("c_custkey") % 90).cast("string"), lit(" bis rue "), "n_name").alias("address"), col("n_name").alias("city"), F.lpad((col("c_custkey") % 99000).cast("string"), 5, "0").alias("postcode"), F.lpad(col("c_nationkey").cast("string"), 5, "0").alias("insee"))


CRM_RAW = "raw AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'École ' ELSE 'Groupe ' END || c_mktsegment || ' ' || n_name || ' SARL (' || lower(c_mktsegment) || ') (SIEGE)' AS name, (c_custkey % 90) || ' bis rue ' || n_name AS address, n_name AS city, c_mktsegment AS seg FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@query(f"""WITH {CRM_RAW}, x AS (SELECT *, array_to_string(list_filter({toks(legal('name'))}, lambda w: w <> city), ' ') AS n, {BLANKS.format("translate(replace(name, '-', ' '), 'É', 'E')")} AS kept FROM raw)
SELECT c_custkey, n AS crm_name, array_to_string(list_filter({toks("kept")}, lambda w: upper(w) <> city AND w <> 'SARL'), ' ') AS crm_name_semantic, {norm('address')} AS crm_addr, regexp_extract(address, '^\\d+') AS crm_street_num, 'rue ' || city AS crm_street_name, seg AS aliases,
array_to_string(list_sort(list_distinct(list_filter({toks('n')}, lambda w: length(w) >= 3 AND w NOT IN ('LES','DES','AUX','GROUPE','SOCIETE','HOLDING')))), ' ') AS crm_tokens, (c_custkey % 2 = 0)::INTEGER AS is_crm_school FROM x""")
def crm_fields(spark, d):
    f = R.crm_row(col("name"), col("address"), col("city"), col("postcode"), col("insee"))
    r = _crm_raw(spark, d).select("c_custkey", *[v.alias(k) for k, v in f.items()])
    return r.select("c_custkey", "crm_name", "crm_name_semantic", "crm_addr", "crm_street_num", "crm_street_name", F.array_join("aliases", "|").alias("aliases"), F.array_join(F.array_sort("crm_tokens"), " ").alias("crm_tokens"), "is_crm_school")


ADDRESS_PARTS = "x AS (SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN p_size::VARCHAR END AS n, CASE WHEN p_partkey % 3 = 0 THEN 'bis' END AS r, CASE WHEN p_partkey % 7 <> 0 THEN 'Rue' ELSE '' END AS k, CASE WHEN p_partkey % 11 <> 0 THEN p_name END AS s, p_type AS o, p_brand FROM part)"


def _composed(*parts: str) -> str:
    return "nullif(concat_ws(' ', " + ", ".join(f"nullif(trim({p}), '')" for p in parts) + "), '')"


@query(f"""WITH {ADDRESS_PARTS}, y AS (SELECT *, {_composed('n', 'r')} AS number, concat_ws(' ', nullif(n, ''), nullif(k, ''), nullif(s, '')) AS main FROM x)
SELECT p_partkey, number, {_composed("''", 'number', 'k', 's')} AS address, {norm("coalesce(nullif(main, ''), o)")} AS built, coalesce(nullif(s, ''), nullif(k, ''), p_brand || ' ' || o) AS denomination, {_composed('o', 'number', 's', "'69001'", "'Lyon'")} AS places_query,
n IS NOT NULL AND (s IS NOT NULL OR len(regexp_extract_all(upper(main), '[A-Z0-9]+')) >= 2) AS complete, array_to_string(list_filter({toks(norm('main'))}, lambda w: w <> 'RUE'), ' ') AS street FROM y""")
def address_compose(spark, d):
    p = table(spark, d, "part")
    k = col("p_partkey")
    x = p.select("p_partkey", "p_brand", F.when(k % 5 != 0, col("p_size").cast("string")).alias("n"), F.when(k % 3 == 0, "bis").alias("r"), F.when(k % 7 != 0, "Rue").otherwise("").alias("k"), F.when(k % 11 != 0, col("p_name")).alias("s"), col("p_type").alias("o"))
    x = x.withColumn("number", R.compose(col("n"), col("r"))).withColumn("main", F.concat_ws(" ", "n", F.nullif("k", lit("")), "s"))
    return x.select("p_partkey", "number", R.compose(lit(""), col("number"), col("k"), col("s")).alias("address"), T.build_address(col("n"), col("k"), col("s"), col("o")).alias("built"), R.denomination(col("s"), [col("k")], col("p_brand"), col("o")).alias("denomination"), R.compose(col("o"), col("number"), col("s"), lit("69001"), lit("Lyon")).alias("places_query"), R.complete_address(col("n"), col("s"), col("main")).alias("complete"), T.normalize_street(col("main")).alias("street"))


@query(f"""WITH x AS (SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'SARL ' || c_mktsegment || ' AGENCE ' || n_name WHEN 1 THEN 'Sarl ' || c_mktsegment WHEN 2 THEN 'SAS AGENCE LYON' ELSE 'ÉTABLISSEMENT ' || c_mktsegment || ' LYON' END AS name,
CASE c_custkey % 4 WHEN 0 THEN '12 BIS RUE DE LYON 69001' WHEN 1 THEN '12 rue 69001' WHEN 2 THEN 'RUE_DE LYON' ELSE 'RUE DE LYON 69001' END AS address, CASE c_custkey % 3 WHEN 0 THEN ' prive ' WHEN 1 THEN 'PUBLIC' ELSE 'AUTRE' END AS category FROM customer JOIN nation ON c_nationkey = n_nationkey),
y AS (SELECT *, array_to_string(list_filter(string_split(strip_accents(name), ' '), lambda w: w NOT IN ('SARL', 'SAS', 'AGENCE', 'LYON')), ' ') AS v FROM x)
SELECT id, CASE WHEN id % 4 = 3 THEN v END AS name, CASE id % 4 WHEN 0 THEN 'CHARACTERS' WHEN 1 THEN 'NOT_UPPERCASE' WHEN 2 THEN 'EMPTY' END AS name_error, CASE id % 4 WHEN 0 THEN address END AS address, CASE id % 4 WHEN 1 THEN 'NOT_UPPERCASE' WHEN 2 THEN 'CHARACTERS' WHEN 3 THEN 'LAYOUT' END AS address_error,
CASE id % 3 WHEN 0 THEN 'PRIVE' WHEN 1 THEN 'PUBLIC' END AS category, CASE WHEN id % 3 = 2 THEN 'CATEGORY' END AS category_error FROM y""")
def prepared_fields(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    k = col("c_custkey")
    pick = lambda *v: F.when(k % 4 == 0, v[0]).when(k % 4 == 1, v[1]).when(k % 4 == 2, v[2]).otherwise(v[3])
    x = c.join(n, c.c_nationkey == n.n_nationkey).select(k.alias("id"), pick(F.concat(lit("SARL "), "c_mktsegment", lit(" AGENCE "), "n_name"), F.concat(lit("Sarl "), "c_mktsegment"), lit("SAS AGENCE LYON"), F.concat(lit("ÉTABLISSEMENT "), "c_mktsegment", lit(" LYON"))).alias("name"), pick(lit("12 BIS RUE DE LYON 69001"), lit("12 rue 69001"), lit("RUE_DE LYON"), lit("RUE DE LYON 69001")).alias("address"), F.when(k % 3 == 0, " prive ").when(k % 3 == 1, "PUBLIC").otherwise("AUTRE").alias("category"))
    checked = {"name": R.prepared_name(col("name"), lit("Lyon")), "address": R.prepared_address(col("address")), "category": R.prepared_category(col("category"))}
    return x.select("id", *[v["value"].alias(c) for c, v in checked.items()], *[v["error"].alias(f"{c}_error") for c, v in checked.items()])


@query("""WITH x AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN ' ' || lpad(o_orderkey::VARCHAR, 14, '0') WHEN 1 THEN o_orderkey::VARCHAR || 'x' END AS raw FROM orders), y AS (SELECT *, regexp_replace(raw, '\\D', '', 'g') AS d FROM x)
SELECT o_orderkey, CASE WHEN length(d) = 14 THEN d END AS value, CASE WHEN length(d) <> 14 THEN 'expected 14 digits, got ' || length(d) END AS error FROM y""")
def strict_identifiers(spark, d):
    k = col("o_orderkey")
    raw = F.when(k % 3 == 0, F.concat(lit(" "), F.lpad(k.cast("string"), 14, "0"))).when(k % 3 == 1, F.concat(k.cast("string"), lit("x")))
    return table(spark, d, "orders").select("o_orderkey", R.exact_identifier(raw, 14).alias("x")).select("o_orderkey", "x.value", "x.error")


@query("SELECT c_custkey, sha1(c_name) AS query_hash, ('0x' || right(md5(c_name), 8))::BIGINT & 2147483647 AS seed, sha256('{\"q\":\"' || c_name || '\"}') AS signature FROM customer")
def hash_keys(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.sha1("c_name").alias("query_hash"), R.stable_seed(col("c_name")).alias("seed"), F.sha2(F.to_json(F.struct(col("c_name").alias("q"))), 256).alias("signature"))


@query("""WITH x AS (SELECT event_id, event_type, CASE event_id % 5 WHEN 0 THEN 'nan' WHEN 1 THEN '' WHEN 2 THEN ' x ' WHEN 3 THEN event_id::VARCHAR END AS raw FROM events)
SELECT event_id, CASE WHEN event_id % 5 = 3 THEN event_id::DOUBLE ELSE -1.0 END AS number, CASE event_id % 5 WHEN 2 THEN 'x' WHEN 3 THEN raw ELSE '-' END AS text, CASE event_id % 5 WHEN 2 THEN 'x' WHEN 3 THEN raw ELSE event_type END AS first FROM x""")
def safe_values(spark, d):
    k = col("event_id")
    raw = F.when(k % 5 == 0, "nan").when(k % 5 == 1, "").when(k % 5 == 2, " x ").when(k % 5 == 3, k.cast("string"))
    return table(spark, d, "events").select("event_id", R.number_or(raw, -1.0).alias("number"), R.text_or(raw, "-").alias("text"), R.first_text(raw, col("event_type")).alias("first"))


@query(f"""SELECT doc_id, md5(nullif({BLANKS.format('text')}, '')) AS clean_md5, md5({BLANKS.format("regexp_replace(upper(replace(coalesce(text, ''), 'ß', 'SS')), '[^\\p{L}\\p{N}_\\s]', ' ', 'g')")}) AS index_md5, (upper(coalesce(source, '')) IN ('TRUE', 'OUI')) AS truthy, 'D:' || coalesce(lang, 'x') || '|CP:' || (doc_id % 9) AS scope, (doc_id % 9)::VARCHAR AS scope_cp FROM documents""")
def text_tidy(spark, d):
    x = table(spark, d, "documents").withColumn("scope", C.scope_key({"D": F.coalesce("lang", lit("x")), "EA": lit(None).cast("string"), "CP": (col("doc_id") % 9).cast("string")}))
    return x.select("doc_id", F.md5(T.clean_text(col("text")).cast("binary")).alias("clean_md5"), F.md5(T.index_name(col("text")).cast("binary")).alias("index_md5"), C.is_true(col("source")).alias("truthy"), "scope", C.scope_map(col("scope"))["CP"].alias("scope_cp"))


@query("SELECT event_id, (props::JSON->>'k')::BIGINT AS k, CASE WHEN event_id % 2 = 0 THEN '[\"' || event_type || '\"]' ELSE '[\"' || event_type || '\",\"x\"]' END AS listed FROM events")
def json_extract(spark, d):
    k = col("event_id")
    said = F.when(k % 3 == 0, col("props")).otherwise(F.concat(lit("The answer: "), "props", lit(" (end)")))
    return table(spark, d, "events").select("event_id", R.json_object(said, "k bigint")["k"].alias("k"), R.json_list(F.array("event_type", lit(""), F.when(k % 2 == 1, "x"))).alias("listed"))


@query("""WITH x AS (SELECT s_suppkey, s_name, unnest(range(0, s_suppkey % 3 + 1)) AS i FROM supplier) SELECT s_suppkey, (i + 1)::INTEGER AS rank, lpad(s_suppkey::VARCHAR, 9, '0') AS siren, lpad(s_suppkey::VARCHAR, 9, '0') || lpad(i::VARCHAR, 5, '0') AS siret, s_name AS label FROM x""")
def nested_candidates(spark, d):
    s = table(spark, d, "supplier")
    siren = F.lpad(col("s_suppkey").cast("string"), 9, "0")
    unit = lambda i: F.struct(F.concat(siren, F.lpad(i.cast("string"), 5, "0")).alias("siret"))
    others = F.when(col("s_suppkey") % 3 > 0, F.transform(F.sequence(lit(1), (col("s_suppkey") % 3).cast("int")), unit))
    person = F.struct(siren.alias("siren"), lit("").alias("denomination"), col("s_name").alias("nom"), unit(lit(0)).alias("etablissementSiege"), others.alias("autresEtablissements"))
    record = F.to_json(F.struct(F.struct(F.struct(person.alias("personneMorale")).alias("content")).alias("formality")))
    return s.select("s_suppkey", F.inline(R.nested_candidates(record)))


# Predicates


@query("""SELECT l_orderkey, l_linenumber, NOT (l_returnflag <> l_linestatus) AS geo_ok, NOT (l_discount * 10 < 0.5 AND l_tax * 10 < 0.2) AS semantic_ok, (l_discount * 10 >= 0.9 AND l_tax * 10 >= 0.5 AND (l_quantity <= 2 OR l_quantity = 9999)) AS strict_address,
(l_discount * 10 >= 0.6 OR l_tax * 10 >= 0.3) AS name_evidence, CASE WHEN l_discount * 10 >= 0.835 THEN 'AUTO' ELSE 'REVIEW' END AS routed, (l_returnflag = l_linestatus)::INTEGER AS equal_present FROM lineitem""")
def pair_predicates(spark, d):
    li = table(spark, d, "lineitem")
    a, b, none = col("l_discount") * 10, col("l_tax") * 10, lit(0.0)
    return li.select("l_orderkey", "l_linenumber", R.agrees(col("l_returnflag"), col("l_linestatus")).alias("geo_ok"), V.semantic_gate(a, b).alias("semantic_ok"), P.strict_address(a, b, col("l_quantity")).alias("strict_address"), P.name_evidence(a, b, none, none, none).alias("name_evidence"), P.route(a).alias("routed"), R.equal_present(col("l_returnflag"), col("l_linestatus")).alias("equal_present"))


@query("""WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END AS a, CASE WHEN p_partkey % 3 = 0 THEN p_brand[1:2] END AS b FROM part)
SELECT p_partkey, (a <> '' OR coalesce(b, '') <> '') AS raw_named, a <> '' AS bag_named, (p_partkey % 5 = 0) AS open FROM x""")
def unnamed_filters(spark, d):
    k = col("p_partkey")
    p = table(spark, d, "part").select("p_partkey", F.when(k % 4 == 0, "").otherwise(col("p_name")).alias("a"), F.when(k % 3 == 0, F.substring("p_brand", 1, 2)).alias("b"), F.when(k % 5 == 0, "O").otherwise("N").alias("diffusion"))
    bag = K.bag_of_names([(col("a"), "ETAB_ENSEIGNE"), (col("b"), "UL_SIGLE")], lit(False))
    return p.select("p_partkey", K.raw_named(["a", "b"]).alias("raw_named"), (F.size(bag) > 0).alias("bag_named"), K.diffusible("diffusion").alias("open"))


@query("""SELECT o_custkey, count(*) AS n FROM orders WHERE length(lpad(o_orderkey::VARCHAR, CASE WHEN o_orderkey % 2 = 0 THEN 14 ELSE 9 END, '0')) = 14 AND o_orderpriority <> '5-LOW' GROUP BY o_custkey""")
def valid_keys(spark, d):
    o = table(spark, d, "orders").withColumn("siret", F.when(col("o_orderkey") % 2 == 0, F.lpad(col("o_orderkey").cast("string"), 14, "0")).otherwise(F.lpad(col("o_orderkey").cast("string"), 9, "0"))).withColumn("code", F.when(col("o_orderpriority") != "5-LOW", col("o_orderpriority")).otherwise(" "))
    return K.valid_keys(o, "siret", "code").groupBy("o_custkey").agg(F.count("*").alias("n"))


SCOPES = "scopes AS (SELECT 'D:' || (o_custkey % 90) || '|EA:' || o_orderstatus || CASE WHEN o_custkey % 4 = 0 THEN '|NAF:62' ELSE '' END AS scope_key, count(*) * 1000 AS total_results, min(o_custkey % 2) AS pages_fetched FROM orders GROUP BY 1)"


@query(f"WITH {SCOPES} SELECT scope_key, total_results FROM scopes WHERE total_results >= 10000 AND pages_fetched = 0 AND scope_key NOT LIKE '%NAF:%'")
def dense_scopes(spark, d):
    key = F.concat(lit("D:"), (col("o_custkey") % 90).cast("string"), lit("|EA:"), "o_orderstatus", F.when(col("o_custkey") % 4 == 0, "|NAF:62").otherwise(""))
    s = table(spark, d, "orders").groupBy(key.alias("scope_key")).agg((F.count("*") * 1000).alias("total_results"), F.min(col("o_custkey") % 2).alias("pages_fetched"))
    return L.dense_scopes(s).select("scope_key", "total_results")


# Truth, joins, lookups


@query("""SELECT 'labelled' AS layout, doc_id::VARCHAR AS crm_id, lpad(doc_id::VARCHAR, 14, '0') AS siret_gt FROM labels WHERE quality = 1 UNION ALL SELECT 'plain', c_custkey::VARCHAR, c_name FROM customer UNION ALL SELECT 'query', s_suppkey::VARCHAR, s_name FROM supplier UNION ALL SELECT 'long', s_suppkey::VARCHAR, s_name FROM supplier""")
def truth_layouts(spark, d):
    s = table(spark, d, "supplier")
    forms = {
        "labelled": table(spark, d, "labels").select(col("doc_id").alias("query_id"), col("quality").alias("label"), F.lpad(col("doc_id").cast("string"), 14, "0").alias("siret")),
        "plain": table(spark, d, "customer").select(col("c_custkey").alias("crm_id"), col("c_name").alias("siret")),
        "query": s.select(col("s_suppkey").alias("query_id"), col("s_name").alias("gt_siret")),
        "long": s.select(col("s_suppkey").alias("crm_id"), col("s_name").alias("ground_truth_siret")),
    }
    parts = [L.truth(f).select(lit(k).alias("layout"), "crm_id", "siret_gt") for k, f in forms.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("""WITH t AS (SELECT l_orderkey, lpad(l_partkey::VARCHAR, 14, '0') AS s FROM lineitem), g AS (SELECT l_orderkey AS o_orderkey, list_sort(list_distinct(list(s))) AS a, list_distinct(list(s[1:9])) AS b FROM t GROUP BY 1),
r AS (SELECT o_orderkey, lpad((o_orderkey * 7 % 200)::VARCHAR, 14, '0') AS c FROM orders) SELECT o_orderkey, c AS chosen, coalesce(list_contains(a, c), false) AS strict, coalesce(list_contains(b, c[1:9]), false) AS same, a IS NOT NULL AS has_truth, coalesce(len(a), 0) AS n_valid FROM r LEFT JOIN g USING (o_orderkey)""")
def truth_judged(spark, d):
    t = table(spark, d, "lineitem").select(col("l_orderkey").alias("o_orderkey"), F.lpad(col("l_partkey").cast("string"), 14, "0").alias("siret"))
    sets = L.truth_sets(t, "o_orderkey", "siret")
    r = table(spark, d, "orders").select("o_orderkey", F.lpad((col("o_orderkey") * 7 % 200).cast("string"), 14, "0").alias("chosen"))
    n = sets.select("o_orderkey", F.size("valid_sirets").cast("long").alias("n_valid"))
    return L.judged(r, sets, "o_orderkey", "chosen").join(n, "o_orderkey", "left").fillna(0, ["n_valid"])


@query("SELECT c_custkey, c_name, c_mktsegment, n AS n_orders, c_name_xgb FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n, min(o_orderpriority) AS c_name_xgb FROM orders GROUP BY 1) USING (c_custkey)")
def crm_routed_join(spark, d):
    routed = table(spark, d, "orders").groupBy(col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.min("o_orderpriority").alias("c_name"))
    return L.with_suffix(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), routed, "c_custkey", "_xgb")


@query("""WITH s AS (SELECT o_orderkey, o_custkey, ('0x' || md5(o_custkey::VARCHAR)[1:8])::BIGINT % 100 AS b FROM orders) SELECT o_orderkey, CASE WHEN b < 85 THEN 'train' ELSE 'dev' END AS split, c_mktsegment FROM s LEFT JOIN customer ON o_custkey = c_custkey""")
def split_metadata_join(spark, d):
    split = M.group_split(table(spark, d, "orders").select("o_orderkey", col("o_custkey").alias("c_custkey")), "c_custkey", train=85, dev=15)
    return K.enrich(split, table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey").select("o_orderkey", "split", "c_mktsegment")


def _sites(spark, d):
    p = table(spark, d, "part")
    return p.select(col("p_partkey").cast("string").alias("siret"), col("p_brand").alias("siren"), col("p_name").alias("name"), F.when(col("p_size") % 3 == 0, "A").otherwise("F").alias("state"))


def _raw_groups(spark, d):
    c, k = table(spark, d, "customer"), col("c_custkey")
    return c.select(F.when(k % 2 == 0, "siret").otherwise("siren").alias("key_type"), F.when(k % 2 == 0, (k * 3).cast("string")).otherwise(F.concat(lit("Brand#"), (k % 40).cast("string"))).alias("value"), F.when(k % 4 == 0, col("c_name")).alias("label"), lit("WEB").alias("sources")).distinct()


@query("""WITH sites AS (SELECT p_partkey::VARCHAR AS siret, p_brand AS siren, p_name AS name, CASE WHEN p_size % 3 = 0 THEN 'A' ELSE 'F' END AS state FROM part), g AS (SELECT DISTINCT CASE WHEN c_custkey % 2 = 0 THEN 'siret' ELSE 'siren' END AS key_type, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey * 3)::VARCHAR ELSE 'Brand#' || (c_custkey % 40) END AS value, CASE WHEN c_custkey % 4 = 0 THEN c_name END AS label FROM customer),
a AS (SELECT value, value AS siret, coalesce(siren, 'INCONNU') AS siren, CASE WHEN state IS NULL THEN coalesce(label, 'NOM_INCONNU') ELSE name END AS name, CASE WHEN state IS NULL THEN 'fallback' ELSE 'exact' END AS found FROM g LEFT JOIN sites ON siret = value WHERE key_type = 'siret'),
o AS (SELECT value, siret, siren, name, state, row_number() OVER (PARTITION BY value ORDER BY state <> 'A', siret) AS r, bool_or(state = 'A') OVER (PARTITION BY value) AS any_open FROM g JOIN sites ON siren = value WHERE key_type = 'siren')
SELECT * FROM a UNION ALL SELECT value, siret, siren, name, CASE WHEN state = 'A' THEN 'open' ELSE 'closed' END FROM o WHERE r <= 20 AND (state = 'A' OR NOT any_open)""")
def exact_lookup(spark, d):
    return L.enriched(_raw_groups(spark, d), _sites(spark, d)).select("value", "siret", "siren", "name", "found")


@query("""WITH o AS (SELECT 'Brand#' || (s_suppkey % 25 + 1) AS p_brand, array_to_string(list_sort(list_distinct(list(s_name))), '|') AS pm FROM supplier WHERE s_suppkey % 2 = 0 GROUP BY 1) SELECT p_partkey, pm AS pm_dirigeant_names FROM part LEFT JOIN o USING (p_brand)""")
def officer_lookup(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    s = table(spark, d, "supplier").select(F.concat(lit("Brand#"), (col("s_suppkey") % 25 + 1).cast("string")).alias("p_brand"), F.when(col("s_suppkey") % 2 == 0, "Personne Morale").otherwise("personne physique").alias("type_dirigeant"), col("s_name").alias("denomination"))
    return K.enrich(p, p.select("p_brand").distinct(), "p_brand", officers=s).select("p_partkey", "pm_dirigeant_names")


@query("""WITH p AS (SELECT p_brand, p_partkey, p_size FROM part), q AS (SELECT s_suppkey AS query_id, s_nationkey % 50 + 1 AS insee, s_suppkey % 7 AS postcode FROM supplier), t AS (SELECT query_id, 'Brand#' || (query_id % 25 + 1) AS siren, 1 AS entity_rank FROM q UNION ALL SELECT query_id, 'Brand#' || ((query_id + 9) % 25 + 1), 2 FROM q),
j AS (SELECT query_id, siren, p_partkey AS siret, entity_rank, CASE WHEN p_size = insee THEN 0 WHEN p_partkey % 7 = postcode THEN 1 ELSE 2 END AS near FROM q JOIN t USING (query_id) JOIN part ON p_brand = siren WHERE p_partkey % 9 <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, siren ORDER BY near, siret)::INTEGER AS place FROM j) SELECT * FROM r WHERE place <= 5""")
def entity_first_retrieval(spark, d):
    from ..operators.pool import entity_first

    s = table(spark, d, "supplier")
    q = s.select(col("s_suppkey").alias("query_id"), (col("s_nationkey") % 50 + 1).alias("insee"), (col("s_suppkey") % 7).alias("postcode"))
    brand = lambda k: F.concat(lit("Brand#"), (k % 25 + 1).cast("string"))
    top = q.select("query_id", brand(col("query_id")).alias("siren"), lit(1).alias("rank")).unionByName(q.select("query_id", brand(col("query_id") + 9).alias("siren"), lit(2).alias("rank")))
    return entity_first(q, top, _pool_sites(spark, d), per_entity=5)


# Groups


@query("""WITH x AS (SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN o_orderpriority END AS insee, CASE WHEN o_custkey % 3 <= 1 THEN 'P' || (o_custkey % 50) END AS postcode, 'VILLE ' || (o_custkey % 20) AS city FROM orders),
m AS (SELECT insee, postcode, city, count(*) AS n, min(o_orderkey) AS f FROM x WHERE insee IS NOT NULL GROUP BY ALL), rep AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY insee ORDER BY n DESC, f) AS r FROM m) WHERE r = 1),
k AS (SELECT CASE WHEN insee IS NOT NULL THEN 'insee' WHEN postcode IS NOT NULL THEN 'postcode' ELSE 'city' END AS kind, coalesce(insee, postcode, city) AS code, min(o_orderkey) AS first_seen FROM x GROUP BY ALL)
SELECT first_seen, kind, CASE WHEN kind = 'insee' THEN code END AS insee, CASE WHEN kind = 'postcode' THEN code WHEN kind = 'insee' THEN rep.postcode END AS postcode, CASE WHEN kind = 'city' THEN code WHEN kind = 'insee' THEN rep.city END AS city FROM k LEFT JOIN rep ON kind = 'insee' AND code = rep.insee""")
def distinct_communes(spark, d):
    k = col("o_custkey")
    o = table(spark, d, "orders").select("o_orderkey", F.when(k % 3 == 0, col("o_orderpriority")).alias("insee"), F.when(k % 3 <= 1, F.concat(lit("P"), (k % 50).cast("string"))).alias("postcode"), R.city_key(F.concat(lit("Ville-"), (k % 20).cast("string"))).alias("city"))
    reps = K.most_frequent(o.where("insee is not null"), ["insee"], ["postcode", "city"], "o_orderkey")
    return L.communes(o, reps, insee="insee", postcode="postcode", city=col("city"), ordinal="o_orderkey")


@query("""WITH x AS (SELECT user_id, 'WEB_' || upper(event_type) AS s, event_id % 10 AS r FROM events WHERE event_id % 4 <> 0), m AS (SELECT user_id, s, min(r) AS r FROM x GROUP BY ALL)
SELECT user_id, string_agg(s || ':' || r, '|' ORDER BY s) AS ranks, string_agg(s, '|' ORDER BY s) AS sources FROM m GROUP BY user_id""")
def web_ranks(spark, d):
    e = table(spark, d, "events").select("user_id", F.concat(F.when(col("event_id") % 4 != 0, "WEB_").otherwise("RNE_"), F.upper("event_type")).alias("source"), (col("event_id") % 10).alias("rank"))
    best = L.best_web_rank(e, ["user_id"], "source", "rank")
    text = F.array_join(F.transform(F.array_sort(F.map_entries("web_ranks")), lambda x: F.concat(x["key"], lit(":"), x["value"].cast("string"))), "|")
    return best.select("user_id", text.alias("ranks")).join(L.entity_sources(e, "user_id", "source").select("user_id", F.array_join("entity_sources", "|").alias("sources")), "user_id")


@query("""WITH x AS (SELECT DISTINCT lpad((p_size * 2)::VARCHAR, 2, '0') || '.22Z' AS code FROM part), y AS (SELECT code, code[1:2]::INTEGER AS d FROM x)
SELECT CASE WHEN d BETWEEN 1 AND 3 THEN 'A' WHEN d BETWEEN 5 AND 9 THEN 'B' WHEN d BETWEEN 10 AND 33 THEN 'C' WHEN d = 35 THEN 'D' WHEN d BETWEEN 36 AND 39 THEN 'E' WHEN d BETWEEN 41 AND 43 THEN 'F' WHEN d BETWEEN 45 AND 47 THEN 'G' WHEN d BETWEEN 49 AND 53 THEN 'H' WHEN d BETWEEN 55 AND 56 THEN 'I' WHEN d BETWEEN 58 AND 63 THEN 'J' WHEN d BETWEEN 64 AND 66 THEN 'K' WHEN d = 68 THEN 'L' WHEN d BETWEEN 69 AND 75 THEN 'M' WHEN d BETWEEN 77 AND 82 THEN 'N' WHEN d = 84 THEN 'O' WHEN d = 85 THEN 'P' WHEN d BETWEEN 86 AND 88 THEN 'Q' WHEN d BETWEEN 90 AND 93 THEN 'R' WHEN d BETWEEN 94 AND 96 THEN 'S' WHEN d BETWEEN 97 AND 98 THEN 'T' WHEN d = 99 THEN 'U' END AS section, count(*) AS n_codes, string_agg(code, '|' ORDER BY code) AS codes FROM y GROUP BY 1 HAVING section IS NOT NULL""")
def naf_by_section(spark, d):
    p = table(spark, d, "part").select(F.concat(lit(" "), F.lpad((col("p_size") * 2).cast("string"), 2, "0"), lit(".22Z ")).alias("naf"))
    return K.codes_by_section(K.unique_codes(p, "naf"), "naf").select("section", F.size("codes").cast("long").alias("n_codes"), F.array_join("codes", "|").alias("codes"))


@query("SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS n_{t}" for t in ("customer", "supplier", "part", "orders", "nation", "region", "pages")))
def harvest_stats(spark, d):
    return E.table_counts({t: table(spark, d, t) for t in ("customer", "supplier", "part", "orders", "nation", "region", "pages")})


@query("""WITH c AS (SELECT l_suppkey::VARCHAR AS code, count(*) AS n FROM lineitem GROUP BY 1), m AS (SELECT *, (SELECT avg(n) FROM c) AS a FROM c) SELECT code, row_number() OVER (ORDER BY n < a, n DESC, code)::INTEGER AS place FROM m WHERE n >= 10""")
def partition_order(spark, d):
    c = K.partition_codes(table(spark, d, "lineitem").withColumn("code", col("l_suppkey").cast("string")), "code")
    mean = c.agg(F.avg("row_count")).first()[0] or 0
    return L.ordered_codes(c, by_size=True, mega_first=True, mega=mean, least=10).select("code", "place")


# Ranking, sampling, evaluation


@query(f"""WITH {PAIRS}, t AS (SELECT * FROM ranked WHERE rank <= 2), w AS (SELECT query_id, max(score) FILTER (rank = 1) AS a, max(score) FILTER (rank = 2) AS b FROM t GROUP BY 1)
SELECT query_id, cand_id, (rank - 1)::INTEGER AS place, round(coalesce(a - b, 0), 6) AS score_gap, round(CASE WHEN b IS NULL THEN 1.0 WHEN b > 0 THEN a / b ELSE 100.0 END, 6) AS score_ratio, round(a / CASE WHEN b = 0 THEN 0.001 ELSE b END, 6) AS ratio_replaced FROM t JOIN w USING (query_id)""")
def top_k_from_zero(spark, d):
    top = cut(_top(spark, d, 2))  # three uses
    t = P.gap_and_ratio_of_place(top, query="query_id")
    two = P.gap_and_ratio(top, query="query_id").select("query_id", "score_top1", "score_top2")
    n = top.groupBy("query_id").agg(F.count("*").alias("n"))
    second = F.when(col("n") > 1, col("score_top2"))
    return t.join(two, "query_id").join(n, "query_id").select("query_id", "cand_id", "place", r6(col("score_gap")).alias("score_gap"), r6(col("score_ratio")).alias("score_ratio"), r6(P.ratio_replacing_zero(col("score_top1"), second)).alias("ratio_replaced"))


def _block_pairs(spark, d):
    """(query_id, cand_id) of every pair of a block. The queries are dealt out before the join multiplies them."""
    q = _crm(spark, d).select("query_id", "q_insee").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "query_id")
    return q.join(_stock(spark, d).select("cand_id", "insee"), col("q_insee") == col("insee")).select("query_id", "cand_id")


@query(f"WITH {PAIRS}, l AS (SELECT *, (cand_id % 4 = query_id % 4)::INTEGER AS label FROM ranked) SELECT query_id, cand_id, label FROM l WHERE rank <= 2 OR label = 1")
def top_and_positives(spark, d):
    label = (col("cand_id") % 4 == col("query_id") % 4).cast("int")
    positives = _block_pairs(spark, d).withColumn("label", label).where("label = 1")  # all of them, whatever their score
    p = _best(_crm(spark, d), _stock(spark, d), best=2).withColumn("label", label)
    top = M.top_and_positives(p, query="query_id", candidate="cand_id", label="label", score="score", k=2).where("label = 0").select("query_id", "cand_id", "label")
    return top.unionByName(positives)


@query(f"""WITH {PAIRS}, b AS (SELECT query_id, cand_id, round(jw, 6) AS j FROM pairs), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY j DESC, cand_id)::INTEGER AS place FROM b WHERE cand_id <> query_id % 100 AND j BETWEEN 0.5 AND 0.95) SELECT query_id, cand_id, place FROM r WHERE place <= 3""")
def band_negatives(spark, d):
    p = _scored(spark, d).withColumn("truth", col("query_id") % 100).withColumn("jw", r6(col("jw")))
    return M.band_negatives(p, query="query_id", candidate="cand_id", similarity="jw", truth="truth").select("query_id", "cand_id", "place")


@query(f"""WITH {PAIRS}, s AS (SELECT query_id, cand_id, score, cand_id % 2 = query_id % 2 AS same FROM scored), r AS (SELECT *, row_number() OVER (PARTITION BY query_id, same ORDER BY score DESC, cand_id) AS r FROM s) SELECT query_id, cand_id FROM r WHERE NOT same OR r <= 1""")
def capped_siblings(spark, d):
    same = col("cand_id") % 2 == col("query_id") % 2
    crm, stock = _crm(spark, d).withColumn("q_odd", col("query_id") % 2), _stock(spark, d).withColumn("odd", col("cand_id") % 2)
    p = _best(crm, stock, by=(("q_insee", "insee"), ("q_odd", "odd")), best=1)
    own = M.capped_siblings(p, query="query_id", candidate="cand_id", same=same, score="score", most=1).select("query_id", "cand_id")
    return own.unionByName(_block_pairs(spark, d).where(~same))  # those of other entities need no score


@query(f"""WITH {PAIRS}, s AS (SELECT query_id, name AS negative FROM ranked WHERE rank <= 2) SELECT c_custkey AS query_id, c_name AS anchor, c_mktsegment AS positive, negative FROM customer JOIN s ON c_custkey = query_id""")
def name_triplets(spark, d):
    c = table(spark, d, "customer").select(col("c_custkey").alias("query_id"), "c_name", "c_mktsegment")
    t = M.triplets(c, _top(spark, d, 2).select("query_id", "name"), query="query_id", anchor="c_name", positive="c_mktsegment", negative="name")
    return t.join(c.select("query_id", col("c_name").alias("anchor")), "anchor").select("query_id", "anchor", "positive", "negative")


@query("SELECT o_orderkey FROM orders ORDER BY md5('s' || o_orderkey), o_orderkey LIMIT 100")
def hash_sample(spark, d):
    return M.hash_sample(table(spark, d, "orders").where(~M.is_closed(lit("A "))), "o_orderkey", 100, "s").select("o_orderkey")


def _ranked_orders(spark, d):
    o = table(spark, d, "orders")
    return o.select((col("o_custkey") % 500).alias("q"), col("o_orderkey").alias("c"), F.concat((col("o_custkey") % 3).cast("string"), lit("x")).alias("siren"), (col("o_orderstatus") == "F").alias("closed"), col("o_totalprice").alias("score"), (col("o_orderkey") % 5 == 0).cast("int").alias("label"))


@query("""WITH x AS (SELECT o_custkey % 500 AS q, o_orderkey AS c, o_custkey % 3 AS siren, o_orderstatus = 'F' AS closed, (o_orderkey % 5 = 0)::INTEGER AS label, row_number() OVER (PARTITION BY o_custkey % 500 ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders),
p AS (SELECT *, min(rank) FILTER (closed) OVER w AS cp, min(rank) FILTER (NOT closed) OVER w AS op FROM x WINDOW w AS (PARTITION BY q, siren)), r AS (SELECT *, CASE WHEN cp < op AND rank = cp THEN op WHEN cp < op AND rank = op THEN cp ELSE rank END AS place FROM p),
f AS (SELECT q, min(place) FILTER (label = 1) AS f FROM r GROUP BY q) SELECT count(*) AS queries, round(avg((coalesce(f, 1000000) <= 1)::DOUBLE), 6) AS hit_1, round(avg((coalesce(f, 1000000) <= 5)::DOUBLE), 6) AS hit_5, round(avg(coalesce(1.0 / f, 0)), 6) AS mrr FROM f""")
def promoted_hits(spark, d):
    return E.promoted_hit_at_k(_ranked_orders(spark, d), query="q", candidate="c", entity="siren", closed=col("closed"), label="label", ks=[1, 5])


@query(f"""WITH {CALIB}, s AS (SELECT score, sum((label = 1)::INTEGER) AS p, sum((label <> 1)::INTEGER) AS n FROM c GROUP BY score), t AS (SELECT *, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp FROM s) SELECT round(sum(p * tp / CAST(tp + fp AS DOUBLE)) / sum(p), 6) AS average_precision FROM t""")
def average_precision(spark, d):
    return E.average_precision(_calibration(spark, d), score="score", label="label", cells=16)


@query(f"""WITH {CALIB}, b AS (SELECT CASE WHEN score > 0 AND score <= 0.5 THEN 0 WHEN score > 0.5 AND score <= 0.7 THEN 1 WHEN score > 0.7 AND score <= 0.8 THEN 2 WHEN score > 0.8 AND score <= 0.9 THEN 3 WHEN score > 0.9 AND score <= 0.95 THEN 4 WHEN score > 0.95 AND score <= 0.98 THEN 5 WHEN score > 0.98 AND score <= 0.99 THEN 6 WHEN score > 0.99 AND score <= 0.995 THEN 7 WHEN score > 0.995 AND score <= 1 THEN 8 END AS bin, score, label FROM c),
g AS (SELECT bin, count(*) AS n, avg(score) AS s, avg(label::DOUBLE) AS y FROM b GROUP BY bin) SELECT round(sum(n * abs(s - y)) FILTER (bin IS NOT NULL) / sum(n), 6) AS ece FROM g""")
def uneven_calibration(spark, d):
    return E.uneven_calibration(_calibration(spark, d), score="score", label="label", edges=[0.0, 0.5, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995, 1.0])


@query(f"""WITH {PAIRS}, h AS (SELECT q.query_id, r.rank FROM (SELECT DISTINCT query_id, (query_id * 4 + q_insee) % 100 AS own FROM crm) q LEFT JOIN (SELECT * FROM ranked WHERE rank <= 5) r ON r.query_id = q.query_id AND r.cand_id = q.own)
SELECT count(*) AS queries, round(avg((coalesce(rank, 1000000) <= 1)::DOUBLE), 6) AS recall_1, round(avg((coalesce(rank, 1000000) <= 5)::DOUBLE), 6) AS recall_5, round(avg(coalesce(1.0 / rank, 0)), 6) AS mrr FROM h""")
def paired_recall(spark, d):
    own = table(spark, d, "customer").select(col("c_custkey").alias("query_id"), ((col("c_custkey") * 4 + col("c_nationkey")) % 100).alias("own"))
    return E.paired_recall(_top(spark, d, 5), own, query="query_id", found="cand_id", own="own", ks=[1, 5])


@query("""WITH x AS (SELECT o_orderpriority AS segment, CASE WHEN o_orderkey % 3 = 0 THEN 'AUTO' ELSE 'REVIEW_LOW' END AS status, CASE WHEN o_orderkey % 5 = 0 THEN 'MATCH_PLACES' ELSE 'NO_MATCH' END AS f, CASE WHEN o_orderkey % 2 = 0 THEN 'MATCH_PLACES' ELSE 'NO_MATCH' END AS p, o_custkey % 3 = 0 AS ok FROM orders),
m AS (SELECT segment, count(*) AS total, count(*) FILTER (f = 'MATCH_PLACES') AS matched, count(*) FILTER (f = 'MATCH_PLACES' AND ok) AS matched_right, count(*) FILTER (f = 'NO_MATCH') AS no_match, count(*) FILTER (f = 'NO_MATCH' AND p = 'MATCH_PLACES') AS held, count(*) FILTER (f = 'NO_MATCH' AND p = 'MATCH_PLACES' AND NOT ok) AS held_rightly, count(*) FILTER (status LIKE 'REVIEW%') AS calls FROM x GROUP BY ROLLUP (segment))
SELECT coalesce(segment, 'ALL') AS segment, total, matched, matched_right, no_match, held, held_rightly, calls, round(matched_right / CAST(nullif(matched, 0) AS DOUBLE), 6) AS precision, round(calls * 0.001::DOUBLE, 6) AS cost FROM m""")
def places_evaluation(spark, d):
    k = col("o_orderkey")
    x = table(spark, d, "orders").select(col("o_orderpriority").alias("segment"), F.when(k % 3 == 0, "AUTO").otherwise("REVIEW_LOW").alias("status"), F.when(k % 5 == 0, "MATCH_PLACES").otherwise("NO_MATCH").alias("final_status"), F.when(k % 2 == 0, "MATCH_PLACES").otherwise("NO_MATCH").alias("places_status"), (col("o_custkey") % 3 == 0).alias("correct"))
    return E.places_measures(x, 0.001).withColumn("segment", F.coalesce("segment", lit("ALL")))


# Outside evidence


WEB = f"""w AS (SELECT c_custkey AS q, s_suppkey AS cand, c_nationkey::VARCHAR AS i1, s_nationkey::VARCHAR AS i2, (c_custkey % 3) || ' rue ' || c_mktsegment AS a1, (s_suppkey % 3) || ' rue ' || CASE WHEN s_suppkey % 2 = 0 THEN c_mktsegment ELSE s_name END AS a2, s_suppkey % 3 > 0 AS two, s_suppkey % 3 = 2 AS dir, s_suppkey % 8 AS wr FROM customer JOIN supplier ON c_nationkey = s_nationkey),
e0 AS (SELECT *, {norm('a1')} AS n1, {norm('a2')} AS n2 FROM w), e1 AS (SELECT *, jaro_winkler_similarity(regexp_replace(n1, '^\\d+ ', ''), regexp_replace(n2, '^\\d+ ', '')) AS j, len(list_intersect({toks('n1')}, {toks('n2')})) / CAST(len(list_distinct(list_concat({toks('n1')}, {toks('n2')}))) AS DOUBLE) AS o, abs(q % 3 - cand % 3)::DOUBLE AS nd FROM e0),
e AS (SELECT *, j >= 0.9 AND o >= 0.5 AND nd <= 2 AS strict, j >= 0.95 AND o >= 0.6 AND nd <= 1 AS very, round(j + o + CASE WHEN two THEN 0.5 ELSE 0 END + CASE WHEN dir THEN 0.2 ELSE 0 END - least(nd, 5) * 0.05 + greatest(0, 0.15 - wr * 0.02), 6) AS score FROM e1)"""


def _web(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    j = c.join(s, c.c_nationkey == s.s_nationkey)
    street = F.when(col("s_suppkey") % 2 == 0, col("c_mktsegment")).otherwise(col("s_name"))
    three = col("s_suppkey") % 3
    x = j.select(col("c_custkey").alias("q"), col("s_suppkey").alias("cand"), col("c_nationkey").cast("string").alias("crm_insee"), col("s_nationkey").cast("string").alias("cand_insee"), lit("").alias("crm_postcode"), lit("69001").alias("cand_postcode"), lit("Lyon").alias("crm_city"), lit("LYON").alias("cand_city"), F.concat((col("c_custkey") % 3).cast("string"), lit(" rue "), "c_mktsegment").alias("crm_address"), F.concat(three.cast("string"), lit(" rue "), street).alias("cand_address"), F.when(three == 0, F.array(lit("WEB_GOOGLE"))).when(three == 1, F.array(lit("WEB_GOOGLE"), lit("WEB_MAPS"))).otherwise(F.array(lit("WEB_GOOGLE"), lit("WEB_ANNUAIRE"))).alias("sources"), (col("s_suppkey") % 8).alias("web_rank"))
    return L.web_evidence(x).withColumn("web_score", r6(col("web_score")))


@query(f"WITH {WEB} SELECT q, cand, round(j, 6) AS street_name_jaro, round(o, 6) AS addr_overlap, nd AS num_diff, strict AS strict_addr, very AS very_strict_addr, score AS web_score FROM e")
def web_evidence(spark, d):
    return _web(spark, d).select("q", "cand", r6(col("street_name_jaro")).alias("street_name_jaro"), r6(col("addr_overlap")).alias("addr_overlap"), "num_diff", "strict_addr", "very_strict_addr", "web_score")


@query(f"""WITH {WEB}, x AS (SELECT *, count(*) OVER (PARTITION BY q) AS n, row_number() OVER (PARTITION BY q ORDER BY score DESC, cand) AS r FROM e WHERE (two AND strict) OR (dir AND very)) SELECT q, cand, CASE WHEN two AND very THEN 0.95 WHEN two THEN 0.9 ELSE 0.88 END::DOUBLE AS confidence, n AS n_eligible FROM x WHERE r = 1""")
def web_choice(spark, d):
    return L.web_choice(_web(spark, d), query="q", candidate="cand", strict=False).select("q", "cand", "confidence", "n_eligible")


@query(f"""WITH {PAIRS} SELECT DISTINCT query_id, CASE query_id % 7 WHEN 0 THEN 'NO_JSON' WHEN 1 THEN 'NO_DECISION' WHEN 2 THEN 'BAD_DECISION' WHEN 3 THEN 'BAD_CONFIDENCE' END AS error, CASE query_id % 7 WHEN 4 THEN CASE WHEN known THEN 'BEST_MATCH' ELSE 'NO_MATCH' END WHEN 5 THEN 'NO_MATCH' WHEN 6 THEN CASE WHEN known THEN 'BEST_MATCH' ELSE 'NO_MATCH' END END AS decision,
CASE WHEN query_id % 7 IN (4, 6) AND known THEN (query_id * 4 + q_insee) % 100 || '' END AS chosen_siret, CASE query_id % 7 WHEN 4 THEN CASE WHEN known THEN 1.0 ELSE 0.0 END WHEN 5 THEN 0.25 WHEN 6 THEN CASE WHEN known THEN 0.5 ELSE 0.0 END END::DOUBLE AS confidence FROM (SELECT query_id, q_insee, bool_or(cand_id = (query_id * 4 + q_insee) % 100) AS known FROM crm JOIN stock ON q_insee = insee GROUP BY ALL)""")
def match_decisions(spark, d):
    from .catalogue import _crm, _stock

    crm, stock = _crm(spark, d), _stock(spark, d)
    valid = crm.join(stock, col("q_insee") == col("insee")).select("query_id", col("cand_id").cast("string").alias("siret"))
    k, own = col("query_id"), ((col("query_id") * 4 + col("q_insee")) % 100).cast("string")
    best = lambda conf: F.concat(lit('Sure: {"decision": "BEST_MATCH", "confidence": '), lit(conf), lit(', "chosen_siret": "'), own, lit('"} ok'))
    said = F.when(k % 7 == 0, "nothing").when(k % 7 == 1, '{"confidence": 1}').when(k % 7 == 2, '{"decision": "MAYBE", "confidence": 1}').when(k % 7 == 3, '{"decision": "NO_MATCH", "confidence": "high"}').when(k % 7 == 4, best("1.7")).when(k % 7 == 5, '{"decision": "NO_MATCH", "confidence": 0.25, "chosen_siret": "3"}').otherwise(best("0.5"))
    asked = crm.join(valid.select("query_id").distinct(), "query_id", "left_semi").select("query_id", said.alias("reply"))
    return L.match_decision(asked, valid, query="query_id", reply="reply", siret="siret")


@query(f"""WITH {PAIRS}, l AS (SELECT query_id, string_agg(rank || '. ' || name || ' (' || cand_id || ')', chr(10) ORDER BY rank) AS l FROM ranked WHERE rank <= 3 GROUP BY 1) SELECT c_custkey AS query_id, md5('Row: ' || c_name || chr(10) || coalesce(l, '-')) AS prompt_md5 FROM customer LEFT JOIN l ON query_id = c_custkey""")
def match_prompts(spark, d):
    q = table(spark, d, "customer").select(col("c_custkey").alias("query_id"), "c_name")
    p = L.match_prompt(q, _top(spark, d, 3), query="query_id", title=F.concat(lit("Row: "), "c_name"), line=F.concat("name", lit(" ("), col("cand_id").cast("string"), lit(")")), order="rank", most=3)
    return p.select("query_id", F.md5(col("prompt").cast("binary")).alias("prompt_md5"))


@query("""WITH x AS (SELECT c_custkey AS k FROM customer) SELECT k, CASE k % 8 WHEN 0 THEN 'empty_query' WHEN 1 THEN 'api_error: timeout' WHEN 2 THEN 'no_places_results' WHEN 3 THEN 'missing_dept_guard' WHEN 4 THEN 'dept_mismatch: crm=69 places=01' WHEN 5 THEN 'xgb_rerun_error: x' WHEN 6 THEN 'xgb_rerun_not_auto' ELSE 'ok' END AS reason FROM x""")
def places_reasons(spark, d):
    k = col("k")
    case = lambda n, yes, no: F.when(k % 8 == n, yes).otherwise(no)
    none = lit(None).cast("string")
    reason = P.places_outcome(query=case(0, lit(""), lit("acme")), error=case(1, lit("timeout"), none), found=k % 8 != 2, crm_department=case(3, none, lit("69")), place_department=case(4, lit("01"), lit("69")), rerun_error=case(5, lit("x"), none), rerun_status=case(6, lit("REVIEW"), lit("AUTO")))
    return table(spark, d, "customer").select(col("c_custkey").alias("k")).select("k", reason.alias("reason"))


@query("""WITH a AS (SELECT o_custkey AS k, count(*) AS attempts, arg_max(CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'not_found' ELSE 'error' END, o_orderkey) AS last FROM orders GROUP BY 1), x AS (SELECT c_custkey AS k, c_custkey IN (SELECT s_suppkey * 3 FROM supplier) AS done, coalesce(attempts, 0) AS attempts, last FROM customer LEFT JOIN a ON k = c_custkey),
y AS (SELECT k, CASE WHEN done THEN 'done' WHEN last = 'not_found' THEN 'not_found' WHEN last = 'failed' THEN 'failed' ELSE 'open' END AS status, attempts FROM x) SELECT k, status, attempts, status IN ('open', 'failed') AND attempts < 12 AS retry FROM y""")
def recovery_status(spark, d):
    wanted, known = table(spark, d, "customer").select(col("c_custkey").alias("k")), table(spark, d, "supplier").select((col("s_suppkey") * 3).alias("k"))
    tried = table(spark, d, "orders").select(col("o_custkey").alias("k"), col("o_orderkey").alias("attempt"), F.when(col("o_orderstatus") == "F", "failed").when(col("o_orderstatus") == "P", "not_found").otherwise("error").alias("status"))
    return L.recovery_status(wanted, known, tried, key="k", most=12)


# Features, pool and inference


def _pool_sites(spark, d):
    p, k = table(spark, d, "part"), col("p_partkey")
    return p.select(k.alias("siret"), col("p_brand").alias("siren"), col("p_size").alias("insee"), (k % 7).alias("postcode"), T.normalize_text(F.concat_ws(" ", "p_name", "p_type", (k % 97).cast("string"))).alias("name"), T.normalize_text(F.concat(col("p_size").cast("string"), lit(" rue "), "p_type", lit(" "), "p_brand")).alias("address"), col("p_size").cast("string").alias("number"), F.concat(lit("rue "), "p_type", lit(" "), "p_brand").alias("street"), F.when(k % 9 == 0, "F").otherwise("A").alias("state"))


def _pool_queries(spark, d):
    """Customers that ask for the part of their own number: some by a commune without any site, so by postcode."""
    c, k = table(spark, d, "customer"), col("siret")
    j = _pool_sites(spark, d).join(c.select(col("c_custkey").alias("siret")), "siret")
    return j.select(k.alias("query_id"), F.when(k % 4 == 0, 9000).otherwise(col("insee")).alias("insee"), "postcode", "name", "address", "number", "street")


POOL = f"""sites AS (SELECT p_partkey AS siret, p_brand AS siren, p_size AS insee, p_partkey % 7 AS postcode, {norm("p_name || ' ' || p_type || ' ' || (p_partkey % 97)")} AS name, {norm("p_size || ' rue ' || p_type || ' ' || p_brand")} AS address, p_size || '|' || {norm("p_type || ' ' || p_brand")} AS h, CASE WHEN p_partkey % 9 = 0 THEN 'F' ELSE 'A' END AS state FROM part),
qs AS (SELECT siret AS query_id, CASE WHEN siret % 4 = 0 THEN 'p:' || postcode ELSE 'i:' || insee END AS block, name, address, h FROM sites JOIN customer ON c_custkey = siret), blocks AS (SELECT DISTINCT block FROM qs), placed AS (SELECT 'i:' || insee AS block, * FROM sites UNION ALL SELECT 'p:' || postcode, * FROM sites), every AS (SELECT placed.* FROM placed JOIN blocks USING (block)), kept AS (SELECT * FROM every WHERE state <> 'F'),
sized AS (SELECT query_id, qs.block, name, address, h, coalesce(b, 0) AS base, coalesce(f, 0) AS filtered FROM qs LEFT JOIN (SELECT block, count(*) AS b FROM every GROUP BY 1) USING (block) LEFT JOIN (SELECT block, count(*) AS f FROM kept GROUP BY 1) USING (block)), big AS (SELECT * FROM sized WHERE filtered > 30), docs AS (SELECT * FROM kept WHERE block IN (SELECT block FROM big))"""


def _pool_sql(n: str) -> str:
    from .oracle import grams, tfidf, word_grams

    return f"""{POOL}, {tfidf('big', 'docs', 'block', 'query_id', 'siret', word_grams('name'), 8, out='w')}, {tfidf('big', 'docs', 'block', 'query_id', 'siret', grams('name', 3, 3), 4, norm_=True, out='c')}, {tfidf('big', 'docs', 'block', 'query_id', 'siret', word_grams('address'), 5, max_df=0.95, out='a')},
ch AS (SELECT query_id, siret, 0 AS ch FROM w UNION ALL SELECT query_id, siret, 0 FROM c UNION ALL SELECT query_id, siret, 1 FROM a), found AS (SELECT query_id, siret, CASE min(ch) WHEN 0 THEN 'name' ELSE 'address' END AS channel FROM ch GROUP BY 1, 2),
num AS (SELECT block, query_id, unnest(list_distinct(regexp_extract_all(name, '\\b(\\d{{1,6}})\\b', 1))) AS t FROM big), dnum AS (SELECT block, siret, unnest(list_distinct(regexp_extract_all(name, '\\b(\\d{{1,6}})\\b', 1))) AS t FROM docs), res AS (SELECT DISTINCT query_id, siret FROM num JOIN dnum USING (block, t) UNION SELECT query_id, siret FROM big JOIN docs USING (block, h)),
more AS (SELECT query_id, siret, 'rescue' AS channel FROM res ANTI JOIN found USING (query_id, siret)), got AS (SELECT * FROM found UNION ALL SELECT * FROM more), cnt AS (SELECT query_id, block, coalesce(n, 0) AS n FROM big LEFT JOIN (SELECT query_id, count(*) AS n FROM got GROUP BY 1) USING (query_id)),
fill AS (SELECT query_id, siret FROM (SELECT query_id, siret, n, row_number() OVER (PARTITION BY query_id ORDER BY md5(query_id || '|' || siret), siret) AS r FROM cnt JOIN docs USING (block) ANTI JOIN got USING (query_id, siret) WHERE n < 16) WHERE r <= 16 - n),
{n} AS (SELECT query_id, siret, 'block' AS channel FROM sized JOIN kept USING (block) WHERE filtered <= 30 UNION ALL SELECT * FROM got UNION ALL SELECT query_id, siret, 'fill' FROM fill)"""


def _built(spark, d):
    from ..operators.pool import build_pool
    from .config import RetrievalConfig

    config = RetrievalConfig(name_k=8, char_k=4, address_k=5, char_ngrams=(3, 3), min_candidates=16)
    return build_pool(_pool_queries(spark, d), _pool_sites(spark, d), config, prefilter=30)


@query(f"WITH {_pool_sql('pool')} SELECT * FROM pool")
def build_pool(spark, d):
    return _built(spark, d)[0]


@query(f"WITH {_pool_sql('pool')} SELECT query_id, base, filtered, coalesce(n, 0) AS pool FROM sized LEFT JOIN (SELECT query_id, count(*) AS n FROM pool GROUP BY 1) USING (query_id)")
def pool_sizes(spark, d):
    return _built(spark, d)[1]


@query(f"""WITH {_pool_sql('pool')}, x AS (SELECT qs.query_id, e.siret IS NOT NULL AS in_base, coalesce(e.state <> 'F', false) AS in_filtered, p.siret IS NOT NULL AS in_pool FROM qs LEFT JOIN every e ON e.block = qs.block AND e.siret = qs.query_id LEFT JOIN pool p ON p.query_id = qs.query_id AND p.siret = qs.query_id)
SELECT query_id, in_base, in_filtered, in_pool, CASE WHEN in_pool THEN NULL WHEN NOT in_base THEN 'NOT_IN_PARTITION' WHEN NOT in_filtered THEN 'FILTERED_CLOSED' ELSE 'PRUNED_BY_TFIDF' END AS loss_reason FROM x""")
def truth_survival(spark, d):
    from ..operators.pool import survival

    q = _pool_queries(spark, d)
    return survival(q, _pool_sites(spark, d), q.select("query_id", col("query_id").alias("siret")), {"pool": _built(spark, d)[0]}).drop("siret")


@query(f"""WITH {_pool_sql('pool')}, x AS (SELECT 'pool' AS mode, count(*) AS total, count(*) FILTER (EXISTS (SELECT 1 FROM every e WHERE e.block = qs.block AND e.siret = query_id)) AS in_base, count(*) FILTER (EXISTS (SELECT 1 FROM pool p WHERE p.query_id = qs.query_id AND p.siret = qs.query_id)) AS in_pool FROM qs UNION ALL SELECT 'name', count(*), count(*) FILTER (EXISTS (SELECT 1 FROM every e WHERE e.block = qs.block AND e.siret = query_id)), count(*) FILTER (EXISTS (SELECT 1 FROM pool p WHERE p.channel = 'name' AND p.query_id = qs.query_id AND p.siret = qs.query_id)) FROM qs)
SELECT *, round(100 * in_base / CAST(total AS DOUBLE), 6) AS recall_base, round(100 * in_pool / CAST(total AS DOUBLE), 6) AS recall_pool, round(100 * in_pool / CAST(in_base AS DOUBLE), 6) AS recall_given_base FROM x""")
def recall_by_mode(spark, d):
    from ..operators.pool import recall_by_mode as recall
    from ..operators.pool import survival

    q, pool = _pool_queries(spark, d), _built(spark, d)[0]
    truth = q.select("query_id", col("query_id").alias("siret"))
    return recall({m: survival(q, _pool_sites(spark, d), truth, {"pool": p}) for m, p in (("pool", pool), ("name", pool.where("channel = 'name'")))}, "pool")


@query(f"""WITH {_pool_sql('pool')}, put AS (SELECT query_id, query_id AS siret FROM qs WHERE query_id IN (SELECT query_id FROM pool) AND NOT EXISTS (SELECT 1 FROM pool p WHERE p.query_id = qs.query_id AND p.siret = qs.query_id)) SELECT query_id, siret, false AS injected FROM pool UNION ALL SELECT query_id, siret, true FROM put""")
def truth_injected(spark, d):
    from ..operators.pool import with_truth

    return with_truth(_built(spark, d)[0], _pool_queries(spark, d).select("query_id", col("query_id").alias("siret")))


@query(f"""WITH {_pool_sql('pool')}, p AS (SELECT pool.query_id, pool.siret, s.siren, s.state, jaro_winkler_similarity(q.name, s.name) AS j, jaro_winkler_similarity(q.address, s.address) AS a FROM pool JOIN qs q USING (query_id) JOIN sites s ON s.siret = pool.siret), s1 AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(0.6 * j + 0.4 * a, 6) DESC, siret) AS r1 FROM p),
s2 AS (SELECT *, round(0.7 * j + 0.2 * a + 0.1 * (j * a), 6) AS score FROM s1 WHERE r1 <= 10), t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, siret) AS rank FROM s2), k AS (SELECT *, max(score) FILTER (rank = 1) OVER (PARTITION BY query_id) AS a1, max(score) FILTER (rank = 2) OVER (PARTITION BY query_id) AS a2 FROM t WHERE rank <= 3)
SELECT query_id, siret, rank::INTEGER AS rank, score, round(a1 - coalesce(a2, 0), 6) AS score_gap, CASE WHEN a1 >= 0.85 AND a1 - coalesce(a2, 0) >= 0.01 THEN 'AUTO' ELSE 'REVIEW' END AS status FROM k""")
def infer_top_k(spark, d):
    from ..operators.pool import infer_top_k as infer

    q = _pool_queries(spark, d).select("query_id", col("name").alias("q_name"), col("address").alias("q_address"))
    s = _pool_sites(spark, d).select("siret", "siren", "name", "address", "state")
    p = _built(spark, d)[0].join(q, "query_id").join(s, "siret")
    p = p.withColumns({"j": S.jaro_winkler(col("q_name"), col("name")), "a": S.jaro_winkler(col("q_address"), col("address"))})
    second = lambda df: df.withColumn("score", F.round(0.7 * col("j") + 0.2 * col("a") + 0.1 * (col("j") * col("a")), 6))
    out = infer(p, stage1=P.heuristic(col("j"), col("a")), stage2=second, top_n=10, k=3, closed=col("state") == "F")
    return out.select("query_id", "siret", "rank", "score", r6(col("score_gap")).alias("score_gap"), "status")


def _model_sides(spark, d):
    """Customers and suppliers with what the feature model asks for."""
    # A small file is one task's: rows are dealt out before their fields are worked out.
    raw = _crm_raw(spark, d).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    f = R.crm_row(col("name"), col("address"), col("city"), col("postcode"), col("insee"))
    q = raw.select(col("c_custkey").alias("query_id"), *[v.alias(k) for k, v in f.items()])
    s, n, k = table(spark, d, "supplier"), table(spark, d, "nation"), col("s_suppkey")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    sign = F.concat(F.when(k % 2 == 0, "Ecole ").otherwise("Association "), "n_name")
    unit = F.concat(lit("Holding machinery "), k.cast("string"))
    fields = [(sign, "ETAB_ENSEIGNE"), (F.when(k % 3 == 0, "Jean Martin"), "PERSON_NAME"), (F.substring("s_name", 1, 4), "UL_SIGLE"), (unit, "UL_DENOM")]
    c = j.select(k.alias("cand_id"), V.prepared(K.bag_of_names(fields, lit(True))).alias("bag"), T.normalize_text(F.concat((k % 90).cast("string"), lit(" rue "), "n_name")).alias("addr"), (k % 90).cast("string").alias("number"), F.concat(lit("rue "), "n_name").alias("street"), col("n_name").alias("city"), F.lpad(k.cast("string"), 5, "0").alias("postcode"), F.lpad(col("s_nationkey").cast("string"), 5, "0").alias("insee"), F.when(k % 2 == 0, "7210").otherwise("5710").alias("legal_code"), (k % 4 == 0).alias("is_siege"), sign.alias("main_name"), F.array(unit).alias("unit_names"), sign.alias("sign"), (k % 7).cast("long").alias("density"))
    return q, c


def _model_sql() -> str:
    lev = "(1 - levenshtein(q, t) / CAST(greatest(length(q), length(t)) AS DOUBLE))"
    jac = lambda a, b: f"(CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0 WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / CAST(len(list_distinct(list_concat({a}, {b}))) AS DOUBLE) END)"
    r = lambda x, n: f"round({x}, 6) AS {n}"
    return f"""WITH {CRM_RAW}, crm AS (SELECT c_custkey AS query_id, city, c_custkey % 2 = 0 AS school, c_custkey, seg, array_to_string(list_filter({toks(legal('name'))}, lambda w: w <> city), ' ') AS q, {norm('address')} AS a1, c_custkey % 90 AS n1, 'rue ' || city AS st1 FROM raw),
sup AS (SELECT s_suppkey AS cand_id, n_name, s_name, CASE WHEN s_suppkey % 2 = 0 THEN 'Ecole ' ELSE 'Association ' END || n_name AS sign, 'Holding machinery ' || s_suppkey AS unit, {norm("(s_suppkey % 90) || ' rue ' || n_name")} AS a2, s_suppkey % 90 AS n2 FROM supplier JOIN nation ON s_nationkey = n_nationkey),
b0 AS (SELECT cand_id, unnest([sign, CASE WHEN cand_id % 3 = 0 THEN 'Jean Martin' END, s_name[1:4], unit]) AS v, unnest([1, 8, 5, 7]) AS src, unnest([0, 1, 2, 3]) AS pos FROM sup), b1 AS (SELECT cand_id, src, pos, {legal('v')} AS t FROM b0 WHERE v IS NOT NULL), bag AS (SELECT * FROM b1 WHERE length(t) > 2 AND NOT regexp_matches(t, '^[\\d ]+$')),
m AS (SELECT query_id, cand_id, src, pos, t, q, jaro_winkler_similarity(q, t) AS jw, {lev} AS lev, {jac(sql_name_tokens('q'), sql_name_tokens('t'))} AS tok, (split_part(q, ' ', 1) = split_part(t, ' ', 1))::INTEGER AS first, contains(t, q)::INTEGER AS holds, contains(q, t)::INTEGER AS held, {jac(sql_name_tokens('t'), sql_name_tokens('n_name'))} AS near, len({toks('t')}) AS words, src = 8 OR t LIKE 'JEAN %' AS person FROM crm JOIN sup ON n_name = city JOIN bag USING (cand_id)),
k AS (SELECT *, near > 0.7 AND words <= 3 AS citylike FROM m), o AS (SELECT *, row_number() OVER (PARTITION BY query_id, cand_id ORDER BY citylike, jw DESC, pos) AS p FROM k),
g AS (SELECT query_id, cand_id, any_value(q) AS q, count(*) AS n, max(jw) FILTER (p = 1) AS j1, coalesce(max(jw) FILTER (p = 2 AND NOT citylike), 0) AS j2, max(lev) FILTER (p = 1) AS l1, max(tok) AS tok, max(first) AS first, max(holds) AS holds, max(held) AS held, max(jw) FILTER (src IN (1, 8)) AS je, coalesce(max(jw) FILTER (src IN (5, 7)), 0) AS ju, coalesce(max(jw) FILTER (src = 5), 0) AS js, max(src) FILTER (p = 1) AS src, max(t) FILTER (p = 1) AS t1, bool_or(person) AS person, coalesce(max(jw) FILTER (person), 0) AS jp, max(near) AS near, bool_or(citylike) AS citylike, arg_max(t, jw) AS t0 FROM o GROUP BY ALL),
f AS (SELECT g.*, crm.seg, crm.school, a1, a2, n1, n2, sign, unit, city, jaro_winkler_similarity(a1, a2) AS aj, jaro_winkler_similarity(st1, upper('rue ' || n_name)) AS sj, {jac(f"list_distinct({toks('a1')})", f"list_distinct({toks('a2')})")} AS ao, (1 - levenshtein(a1, a2) / CAST(greatest(length(a1), length(a2)) AS DOUBLE)) AS al, jaro_winkler_similarity(g.q, upper(sign)) AS sg, list_intersect({sql_name_tokens('g.q')}, {sql_name_tokens('t1')}) AS sh, list_distinct(list_filter({toks('g.q')}, lambda w: length(w) >= 3 AND w NOT IN ('LES','DES','AUX','GROUPE','SOCIETE','HOLDING'))) AS ct, {toks('upper(unit)')} AS ut, g.cand_id % 7 AS dens FROM g JOIN crm USING (query_id) JOIN sup ON sup.cand_id = g.cand_id)
SELECT query_id, cand_id, {r('n::DOUBLE', 'name_count')}, {r('j1', 'name_jaro_max')}, {r('j2', 'name_jaro_second')}, {r('j1 - j2', 'name_jaro_gap')}, {r('l1', 'name_levenshtein_max')}, {r('tok', 'name_token_overlap_max')}, {r("coalesce(list_sum(list_transform(sh, lambda w: CASE w WHEN 'ECOLE' THEN 2.0 WHEN 'GROUPE' THEN 1.5 ELSE 3.0 END)) / len(sh), 0)", 'idf_name')}, first::DOUBLE AS name_first_word_match_max, holds::DOUBLE AS name_contains_crm_max, held::DOUBLE AS name_crm_contains_cand_max, {r('je', 'name_sim_max_etab')}, {r('ju', 'name_sim_max_ul')}, {r('js', 'name_sim_max_sigle')}, 0.0::DOUBLE AS name_sim_max_pm_dirigeant, src::DOUBLE AS type_of_max_name, (src IN (5, 7))::INTEGER::DOUBLE AS is_ul_name_max, (src = 5)::INTEGER::DOUBLE AS is_sigle_max, length(t1)::DOUBLE AS name_length_max, person::INTEGER::DOUBLE AS has_person_name, {r('jp', 'person_name_jaro_max')}, {r('near', 'name_city_overlap_max')}, citylike::INTEGER::DOUBLE AS name_is_city_like_max,
CASE WHEN j1 < 0.5 AND tok < 0.2 THEN 0.0 ELSE 0.75 END::DOUBLE AS name_semantic_max, {r('aj', 'addr_jaro')}, {r('al', 'addr_levenshtein')}, {r('ao', 'addr_token_overlap')}, abs(n1 - n2)::DOUBLE AS street_number_diff, (n1 = n2)::INTEGER::DOUBLE AS street_number_match, {r('sj', 'street_name_jaro')}, CASE WHEN cand_id % 2 = 0 THEN 1.0 ELSE -1.0 END::DOUBLE AS legal_form_category, (cand_id % 4 = 0)::INTEGER::DOUBLE AS is_siege, (cand_id % 2 = 1)::INTEGER::DOUBLE AS is_association, school::INTEGER::DOUBLE AS is_crm_school, (jaro_winkler_similarity(upper(seg), upper(sign)) >= 0.8 OR contains(upper(sign), upper(seg)))::INTEGER::DOUBLE AS alias_match,
{r("CASE WHEN len(ct) > 0 THEN len(list_filter(ut, lambda u: list_contains(ct, u) OR (length(u) >= 4 AND len(list_filter(ct, lambda t: (length(t) >= 6 AND contains(t, u)) OR (length(t) >= 4 AND contains(u, t)))) > 0))) / CAST(len(ct) AS DOUBLE) ELSE 0 END", 'token_overlap_ul')}, CASE WHEN src IN (5, 7) THEN 1.0 ELSE 0.5 END::DOUBLE AS ul_vs_pm_indicator, (q = t0)::INTEGER::DOUBLE AS name_norm_exact, {r('aj * (1 - j1)', 'addr_unsupported_by_name')}, {r('dens / 100.0::DOUBLE * (1 - j1)', 'name_density_penalty')}, {r('aj / ln(1 + greatest(1, dens)::DOUBLE)', 'addr_jaro_per_density')}, {r('0.5 * sj + 0.3 * (n1 = n2)::INTEGER + 0.2 * (lpad(query_id::VARCHAR, 5, \'0\') = lpad(cand_id::VARCHAR, 5, \'0\'))::INTEGER', 'full_addr_match_score')}, {r('sg', 'name_jaro_vs_enseigne')}, 1.0::DOUBLE AS name_city_suffix_match, {r('j1 * aj', 'name_addr_consistency')}, 1.0::DOUBLE AS geo_exact_match, 1.0::DOUBLE AS city_match FROM f"""


MODEL_COLUMNS = """name_count name_jaro_max name_jaro_second name_jaro_gap name_levenshtein_max name_token_overlap_max idf_name name_first_word_match_max name_contains_crm_max name_crm_contains_cand_max name_sim_max_etab name_sim_max_ul name_sim_max_sigle name_sim_max_pm_dirigeant type_of_max_name is_ul_name_max is_sigle_max name_length_max has_person_name person_name_jaro_max name_city_overlap_max name_is_city_like_max name_semantic_max addr_jaro addr_levenshtein addr_token_overlap street_number_diff street_number_match street_name_jaro legal_form_category is_siege is_association is_crm_school alias_match token_overlap_ul ul_vs_pm_indicator name_norm_exact addr_unsupported_by_name name_density_penalty addr_jaro_per_density full_addr_match_score name_jaro_vs_enseigne name_city_suffix_match name_addr_consistency geo_exact_match city_match""".split()


@query(_model_sql())
def feature_model(spark, d):
    q, c = _model_sides(spark, d)
    idf = F.map_from_arrays(F.array(lit("ECOLE"), lit("GROUPE")), F.array(lit(2.0), lit(1.5)))
    shared = {"name_idf": idf, "default_idf": lit(3.0), "sem_1": lit(0.75), "sem_2": lit(0.5)}
    p = V.block_features(q, c, on=("crm_insee", "insee"), query_id="query_id", candidate_id="cand_id", constants=shared, semantic=("sem_1", "sem_2"), digits=6)
    return p.select("query_id", "cand_id", *MODEL_COLUMNS)


@query(f"""WITH b AS (SELECT s_suppkey, n_name, unnest(['Ecole ' || n_name, CASE WHEN s_suppkey % 3 = 0 THEN 'Jean Martin' END, CASE WHEN s_suppkey % 2 = 0 THEN 'Holding ' || s_suppkey END, n_name]) AS v, unnest([0, 1, 2, 3]) AS pos FROM supplier JOIN nation ON s_nationkey = n_nationkey), t AS (SELECT s_suppkey, n_name, pos, {legal('v')} AS t FROM b WHERE v IS NOT NULL),
g AS (SELECT *, t <> n_name AND t NOT LIKE 'JEAN%' AS good FROM t), w AS (SELECT *, bool_or(good) OVER (PARTITION BY s_suppkey) AS any_good FROM g) SELECT s_suppkey, string_agg(t, '|' ORDER BY pos) AS names FROM w WHERE good OR NOT any_good GROUP BY s_suppkey""")
def semantic_names(spark, d):
    s, n, k = table(spark, d, "supplier"), table(spark, d, "nation"), col("s_suppkey")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    fields = [(F.concat(lit("Ecole "), "n_name"), "ETAB_ENSEIGNE"), (F.when(k % 3 == 0, "Jean Martin"), "PERSON_NAME"), (F.when(k % 2 == 0, F.concat(lit("Holding "), k.cast("string"))), "UL_DENOM"), (col("n_name"), "ETAB_DENOM")]
    return j.select("s_suppkey", F.array_join(V.semantic_names(K.bag_of_names(fields, lit(True)), col("n_name"), lit("")), "|").alias("names"))


# Saved indexes


ALL_PAIRS = "s AS (SELECT a.vec_id AS q, b.vec_id, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)), 5) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)"


@query(f"WITH {ALL_PAIRS} SELECT q, vec_id, score, rank FROM r WHERE rank <= 3")
def dense_index(spark, d):
    e, path = table(spark, d, "embeddings"), new_path(spark, "dense")
    X.build_dense_index(e, path, doc_id="vec_id", vector="embedding")
    return X.search_dense_index(e, path, query_id="q", doc_id="vec_id", vector="embedding", k=3, round_to=5).select("q", "vec_id", "score", "rank")


@query(f"WITH {ALL_PAIRS} SELECT q, greatest(max(score), 0) AS best FROM r GROUP BY q")
def semantic_max(spark, d):
    e, path = table(spark, d, "embeddings"), new_path(spark, "dense")
    X.build_dense_index(e, path, doc_id="vec_id", vector="embedding")
    top = X.search_dense_index(e, path, query_id="q", doc_id="vec_id", vector="embedding", k=1, round_to=5)
    v = e.select("vec_id", "embedding")
    both = top.join(v.withColumnRenamed("vec_id", "q").withColumnRenamed("embedding", "mine"), "q").join(v, "vec_id")
    return both.select("q", F.round(V.semantic_max(col("mine"), F.array("embedding")), 5).alias("best"))


def _term_sql() -> str:
    from .oracle import tfidf, words

    q = f"q AS (SELECT item_id AS q, {norm('text')} AS t FROM benchmark), p AS (SELECT p_partkey, {norm("p_name || ' ' || p_type")} AS t FROM part)"
    return f"WITH {q}, {tfidf('q', 'p', '', 'q', 'p_partkey', words('t'), 3, min_df=2, max_df=0.9)} SELECT q, p_partkey, score, rank FROM top"


@query(_term_sql().replace("FROM benchmark", "FROM (SELECT s_suppkey AS item_id, 'red ring ' || s_name AS text FROM supplier)"))
def term_index(spark, d):
    p = table(spark, d, "part").select("p_partkey", T.normalize_text(F.concat_ws(" ", "p_name", "p_type")).alias("t"))
    q = table(spark, d, "supplier").select(col("s_suppkey").alias("q"), T.normalize_text(F.concat(lit("red ring "), "s_name")).alias("t"))
    path, terms = new_path(spark, "terms"), X.word_ngrams(col("t"), 1)
    X.build_term_index(p, path, by=[], doc_id="p_partkey", terms=terms, min_df=2, max_df=0.9)
    return X.search_term_index(q, path, by=[], query_id="q", doc_id="p_partkey", terms=terms, k=3).select("q", "p_partkey", "score", "rank")


@query("SELECT s_suppkey, [length(s_name)::FLOAT, (s_name LIKE '%1%')::INTEGER::FLOAT] AS vector FROM supplier")
def encoded_names(spark, d):
    model = lambda: lambda texts: [[len(t), "1" in t] for t in texts]
    return X.encoded(table(spark, d, "supplier").select("s_suppkey", "s_name"), model, text="s_name").select("s_suppkey", "vector")


# Sinks and streams


@query("""WITH o AS (SELECT o_custkey, min(o_orderkey) FILTER (o_orderstatus = 'F') AS f, max(o_orderkey) FILTER (o_orderstatus = 'O') AS n FROM orders GROUP BY 1) SELECT o_custkey, coalesce(n, f) AS o_orderkey FROM o WHERE coalesce(n, f) IS NOT NULL""")
def replaced_rows(spark, d):
    o, path = table(spark, d, "orders"), new_path(spark, "progress")
    B.keep_first(o.where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"]).write.parquet(path)
    sinks.replace_rows(o.where("o_orderstatus = 'O'").select("o_custkey", "o_orderkey", col("o_orderkey").alias("_seq")), path, ["o_custkey"])
    return spark.read.parquet(f"{path}.next")


@query("""SELECT c_custkey, n, CASE WHEN t > TIMESTAMP '1998-01-01' THEN 'hit' ELSE 'miss' END AS found FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, max(o_orderdate) AS t, count(*) AS n0 FROM orders GROUP BY 1) USING (c_custkey), LATERAL (SELECT CASE WHEN t > TIMESTAMP '1998-01-01' THEN n0 END AS n)""")
def cached_rows(spark, d):
    cache = table(spark, d, "orders").groupBy(col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("fetched_at"), F.count("*").alias("n"))
    hits, misses = tables.read_through(table(spark, d, "customer").select("c_custkey"), cache, "c_custkey", lit("1998-01-31").cast("timestamp_ntz"), 30)
    return hits.select("c_custkey", "n", lit("hit").alias("found")).unionByName(misses.select("c_custkey", lit(None).cast("long").alias("n"), lit("miss").alias("found")))


def _stream(spark, d):
    return spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")


def _written(spark, df, name: str):
    from ..streaming.windows import write

    path = new_path(spark, name)
    write(df, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/table")


@query("""WITH w AS (SELECT date_trunc('day', ts) AS s, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT strftime(s, '%Y-%m-%d') AS day, event_type, n FROM w WHERE s + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)""")
def stream_closed_windows(spark, d):
    """Append mode: only windows that the watermark has closed are written."""
    from ..streaming.windows import windowed

    w = windowed(_stream(spark, d), by=["event_type"], late="2 days")
    return _written(spark, w, "closed").select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("SELECT DISTINCT user_id FROM events")
def stream_once(spark, d):
    from ..streaming.windows import once_within

    return _written(spark, once_within(_stream(spark, d), ["user_id"], ttl="3650 days"), "once").select("user_id")


@query("""WITH x AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new FROM events), y AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM x), z AS (SELECT user_id, s, count(*) AS n, max(ts) AS last FROM y GROUP BY ALL)
SELECT user_id, n, count(*) AS sessions FROM z WHERE last + INTERVAL 12 HOUR <= (SELECT max(ts) - INTERVAL 2 DAY FROM events) GROUP BY ALL""")
def stream_sessions(spark, d):
    from ..streaming.windows import sessions

    s = _written(spark, sessions(_stream(spark, d), by="user_id", gap="12 hours"), "sessions")
    return s.groupBy("user_id", "n").agg(F.count("*").alias("sessions"))


@query("SELECT event_type, count(*) AS n, max(event_id) AS last_page FROM events GROUP BY event_type")
def stream_progress(spark, d):
    """Pages of scopes as they come, a few files a trigger; the checkpoint holds where a rerun goes on."""
    from ..streaming.windows import table_stream

    path = new_path(spark, "pages")
    table(spark, d, "events").repartition(4).write.parquet(path)
    pages = _written(spark, table_stream(spark, path, files_per_trigger=1), "progress")
    return pages.groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_page"))


@query()
def sigmoid_calibration(spark, d):
    c = _calibration(spark, d)
    return P.boosted_score(P.fit_sigmoid(c), c, "calibrated").select("doc_id", F.round("calibrated", 4).alias("calibrated"))
