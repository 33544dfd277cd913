import pytest
from pyspark.sql import functions as F

from concordat.operators import blocking as B
from concordat.operators import curation as K
from concordat.operators import evaluation as E
from concordat.operators import sampling as M
from concordat.operators import scoring as P
from concordat.plans.config import RetrievalConfig
from concordat.sources import sinks, tables


def test_gap_and_ratio(spark):
    df = spark.createDataFrame([("A", 1, 0.9), ("A", 2, 0.6), ("B", 1, 0.5), ("B", 2, 0.0), ("C", 1, 0.4)], "q string, rank int, score double")
    got = {r["q"]: (round(r["score_gap"], 6), round(r["score_ratio"], 6)) for r in P.gap_and_ratio(df, query="q").collect()}
    assert got == {"A": (0.3, 1.5), "B": (0.5, 500.0), "C": (0.4, 400.0)}


def test_risk_row(spark):
    df = spark.createDataFrame([("A", 1, 0.9, 0.8, 0.7), ("A", 2, 0.6, 0.5, 0.4)], "q string, rank int, score double, name_jaro_max double, addr_jaro double")
    r = P.risk_row(df, query="q").first()
    assert round(r["delta_name_jaro_max"], 6) == 0.3 and r["top1_city_match"] == 0.0
    assert len(r) == 1 + 64


def test_promotion(spark):
    df = spark.createDataFrame([("q", "X", "a", 1, True), ("q", "Y", "b", 2, False), ("q", "X", "c", 3, False), ("q", "", "d", 4, True), ("q", "", "e", 5, False)], "q string, siren string, s string, rank int, closed boolean")
    got = [r["s"] for r in P.promote_open(df, query="q", entity="siren", closed=F.col("closed")).orderBy("rank").collect()]
    assert got == ["c", "b", "a", "d", "e"]


def test_routing_measures(spark):
    df = spark.createDataFrame([("AUTO", True, True), ("AUTO", False, True), ("REVIEW", False, False)], "status string, strict boolean, same boolean")
    r = E.routing_measures(df).first()
    assert (r["auto"], r["auto_right"], r["precision"], r["precision_same"]) == (2, 1, 0.5, 1.0)


def test_fallback_is_per_query(spark):
    q = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "y")], "q int, i string, p string")
    c = spark.createDataFrame([(10, "a", "x"), (11, "c", "x")], "c int, insee string, cp string")
    got = sorted((r["q"], r["c"], r["via"]) for r in B.block_with_fallback(q, c, query_id="q", first=("i", "insee"), second=("p", "cp")).collect())
    assert got == [(1, 10, "first"), (2, 10, "second"), (2, 11, "second")]


def test_closed_filter_keeps_null(spark):
    df = spark.createDataFrame([("F",), ("A",), (None,)], "s string")
    assert K.open_only(df, "s").count() == 2


def test_groups_stay_whole(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("g"), "id")
    got = M.group_split(df, "g").groupBy("g").agg(F.countDistinct("split").alias("n")).agg(F.max("n")).first()[0]
    assert got == 1


def test_most_frequent_takes_first_seen(spark):
    df = spark.createDataFrame([("k", "b", 1), ("k", "a", 2), ("k", "a", 3), ("k", "b", 4)], "k string, v string, o int")
    assert K.most_frequent(df, ["k"], ["v"], "o").first()["v"] == "b"


def test_manifest_and_validator(spark):
    df = spark.createDataFrame([("01001", "a"), ("01001", "a"), ("01002", None)], "insee string, siret string")
    got = {r["insee"]: (r["n_rows"], r["null_keys"], r["duplicates"]) for r in K.partition_issues(df, code="insee", key="siret", expected=F.lit(True)).collect()}
    assert got == {"01001": (2, 0, 1), "01002": (1, 1, 0)}


def test_partitioned_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("s1", "01001"), ("s2", "2A004")], "siret string, insee string")
    sinks.partitioned(df, str(tmp_path / "c"), "insee")
    back = tables.partitioned(spark, str(tmp_path / "c"), df.where("siret = 's1'"), "insee", ["siret", "insee", "missing"])
    assert [tuple(r) for r in back.select("siret", "insee").collect()] == [("s1", "01001")]


@pytest.mark.parametrize("sep", [";", ",", "\t"])
def test_csv_aliases(spark, tmp_path, sep):
    p = tmp_path / "crm.csv"
    p.write_text(sep.join(["N° Service", "Client final", "Code Postal"]) + "\n" + sep.join(["7", "ACME", "01000"]) + "\n", "utf-8")
    r = tables.csv(spark, str(p)).first()
    assert (r["crm_id"], r["crm_name"], r["postcode"], r["insee"]) == ("7", "ACME", "01000", None)


def test_export_reports_unknown_rows(spark, tmp_path):
    crm = spark.createDataFrame([("1",)], "crm_id string")
    res = spark.createDataFrame([("1", "x"), ("2", "y")], "crm_id string, siret string")
    assert [r["crm_id"] for r in sinks.export(crm, res, str(tmp_path / "o.json")).collect()] == ["2"]


def test_settings_signature():
    a = RetrievalConfig()
    assert a.signature() == RetrievalConfig.of({"char_ngrams": [3, 5]}).signature()
    assert a.signature() != RetrievalConfig(name_k=10).signature()
    with pytest.raises(ValueError):
        a.require("other")


def test_provider(spark):
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    got = tables.provider(keys, lambda rows: [{"k": r["k"], "v": str(r["k"])} for r in rows if r["k"] > 1], "k int, v string").collect()
    assert [tuple(r) for r in got] == [(2, "2")]


def test_establishments(spark):
    rec = '{"siret":"1","siren":"2","adresse":{"numero":"3","voie":"R","codePostal":"01000","commune":"C"},"periodes":[{"dateFin":"2000-01-01","dateDebut":"1990-01-01","etat":"F","enseigne":"OLD"},{"dateDebut":"2000-01-02","etat":"A","enseigne":"NEW"}]}'
    r = tables.establishments(spark.createDataFrame([(rec,)], "record string")).first()
    assert (r["etat"], r["enseigne"], r["commune"]) == ("A", "NEW", "C")


def test_dense_index_recall(spark, tmp_path):
    """An approximate index of 12 000 vectors in lists: recall at 5 against all products."""
    import numpy as np

    from concordat.operators import retrieval as X

    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16))[rng.integers(0, 300, 12_000)] + 0.4 * rng.normal(size=(12_000, 16))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k long, v array<float>")
    X.build_dense_index(df, str(tmp_path / "i"), doc_id="k", vector="v")
    assert spark.read.parquet(str(tmp_path / "i/centres")).count() == 109
    got = X.search_dense_index(df.where("k % 100 = 0"), str(tmp_path / "i"), query_id="q", doc_id="k", vector="v", k=5).toPandas()
    s = x[::100].astype(float) @ x.astype(float).T
    s[np.arange(120), np.arange(0, 12_000, 100)] = -1
    want = {(int(i * 100), int(j)) for i, row in enumerate(np.argsort(-s, axis=1)[:, :5]) for j in row}
    assert len(want & set(zip(got.q, got.k))) >= 0.9 * len(want)


def test_sigmoid_follows_the_labels(spark):
    rows = [(i, i / 100, int(i % 100 > 60 or i % 7 == 0)) for i in range(100)]
    df = spark.createDataFrame(rows, "i int, score double, label int")
    got = [r["c"] for r in P.boosted_score(P.fit_sigmoid(df), df, "c").orderBy("i").collect()]
    assert got == sorted(got) and 0 < got[0] < 0.4 and got[-1] > 0.8


def test_profile_issues():
    from concordat.operators.features import FAST, FEATURES
    from concordat.plans.config import InferenceProfile

    assert len(FEATURES) == 54 and [f for f in FEATURES if f in FAST] == FAST and len(set(FAST)) == 35
    p = InferenceProfile(feature_order=tuple(FEATURES), retrieval_signature="x")
    assert len(p.issues()) == 3 and p.first_stage_order() == tuple(FEATURES)
    with pytest.raises(ValueError):
        p.issues(strict=True)
    ok = InferenceProfile(ranker_fast_feature_order=tuple(FAST), semantic_enabled=True, retrieval_signature=RetrievalConfig().signature())
    assert ok.issues(strict=True) == [] and ok.first_stage_order() == tuple(FAST)


def test_commands(spark, tmp_path, capsys):
    from concordat.__main__ import main

    assert main(["list"]) == 0 and "build_pool" in capsys.readouterr().out
    assert main(["run", "harvest_stats", "/root/testdata/sf0.001", "--to", str(tmp_path / "o"), "--format", "json"]) == 0
    assert spark.read.json(str(tmp_path / "o")).count() == 1


def test_sinks_and_postcodes(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "k string, n int")
    sinks.csv(df, str(tmp_path / "c"), order=["k"])
    assert [r["k"] for r in spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "c")).collect()] == ["a", "b"]
    sinks.json_lines(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_jobs_run_side_by_side():
    """The channels of a pool were prepared one behind the other."""
    import threading

    from concordat.staging import together

    met = threading.Barrier(2)
    assert together(lambda: met.wait(10) and "a" or "a", lambda: met.wait(10) and "b" or "b") == ["a", "b"]


def test_a_name_is_normalised_once(spark):
    """The text was normalised again wherever a rule named it."""
    from concordat.functions import text as T

    plan = spark.range(1).select(T.normalize_name(F.col("id").cast("string")).alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_replace(") <= 2


def test_features_of_names_are_worked_out_once_a_class(spark, sf, monkeypatch):
    """Every pair got them anew, also where many queries share name, city and aliases."""
    from concordat.operators import features as V
    from concordat.plans import registry

    sizes, old = [], V._of_names
    monkeypatch.setattr(V, "_of_names", lambda pairs, names: sizes.append(pairs.count()) or old(pairs, names))
    n = registry.QUERIES["feature_model"](spark, sf).count()
    assert 0 < sizes[0] < n


def test_trees_are_fitted_on_different_rows(spark, sf, monkeypatch):
    """The fit read every pair again and again; values that many pairs share count by their weight."""
    from concordat.plans import registry

    seen, old = [], P.fit_boosted

    def fit(rows, features, **k):
        seen.append((rows.count(), rows.agg(F.sum(k["weight"])).head()[0]))
        return old(rows, features, **k)

    monkeypatch.setattr(P, "fit_boosted", fit)
    n = registry.QUERIES["gbt_scorer"](spark, sf).count()
    assert seen[0][0] < n == seen[0][1]


def test_rescued_sites_come_once_from_their_join(spark):
    """Rescued pairs, most of a pool, were made distinct and grouped with the others, in the plan that had all channels."""
    from concordat.operators.pool import rescues
    from concordat.plans.config import RetrievalConfig

    sides = "block string, id long, name string, number string, street string"
    names = ["A 1 2", "B 2 1", "C 3", "D", "E 1", None]
    rows = [("x" if i % 3 else "y", i, names[i % 6], str(i % 4), ["rue a", "rue b", None][i % 5 % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, sides)
    q, s = df.withColumnRenamed("id", "query_id"), df.withColumnRenamed("id", "siret")
    found = spark.createDataFrame([(i, j) for i in range(0, 60, 2) for j in range(20)], "query_id long, siret long")
    have = {tuple(r) for r in found.collect()}
    out = rescues(q, s, found, RetrievalConfig())
    number = lambda r: {x for x in (r[2] or "").split() if x.isdigit()}
    like = lambda a, b: bool(number(a) & number(b)) or bool(a[4] and a[3:] == b[3:])
    want = sorted((a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and like(a, b) and (a[1], b[1]) not in have)
    assert sorted(map(tuple, out.collect())) == want and len(want) > 300
    tree = out._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0]
    assert "Aggregate" not in tree and "Repartition" not in tree
    assert rescues(q, s, found, RetrievalConfig(rescue_numeric=False, rescue_address=False)).count() == 0


def test_features_of_classes_are_rounded_once(spark, sf):
    """Every feature was rounded on every pair, also those that pairs look up."""
    from concordat.plans import registry

    tree = registry.QUERIES["feature_model"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert tree.split("Join Inner")[0].count("round(") <= 12
