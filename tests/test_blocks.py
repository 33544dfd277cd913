"""Best pairs worked out in blocks, against brute force."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from concordat.functions import similarity as S
from concordat.operators import blocks as N
from concordat.operators import retrieval as R
from concordat.operators import scoring as P
from concordat.plans import registry

NAME_QUERIES = "hit_at_k match_prompts name_triplets paired_recall places_fallback risk_features route_auto_review routing_evaluation stage1_topn top_k_from_zero topk_gap_ratio hard_negatives prefilter_sample pad_candidates".split()


def _score(name, address):
    return 0.6 * name + 0.4 * address


def _names(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choice("ABé 01") for _ in range(draw.choice([0, 1, 3, 8, 12, 30, 40, 70]))) for _ in range(n)]


@pytest.mark.parametrize("best,near,drawn,seed", [(3, 0, 0, None), (3, 2, 2, "s"), (0, 3, 0, None), (1, 0, 3, None)])
def test_best_by_names_against_every_pair(best, near, drawn, seed):
    q = pd.DataFrame({"q": range(60), "_name": _names(1, 60), "_bar": [i % 3 for i in range(60)]})
    d = pd.DataFrame({"c": range(100, 200), "_name": _names(2, 100), "_bar": [i % 3 for i in range(100, 200)]})
    got = N._best_by_names(_score, best, near, drawn, seed, "q", "c")((), q.sample(frac=1, random_state=1), d.sample(frac=1, random_state=1))
    found = {(a, b): (j, v) for a, b, j, v in zip(got["q"], got["c"], got["jw"], got["lev"])}
    for i, a, bar in q.itertuples(index=False, name=None):
        every = []
        for c, b, other in d.itertuples(index=False, name=None):
            if bar != other:
                lev = 1.0 if not (a or b) else 0.0 if not (a and b) else 1 - N._levenshtein(a, b) / max(len(a), len(b))
                jw = S.jaro_winkler_of(a, b)
                digest = hashlib.md5(((f"{seed}|" if seed else "") + f"{i}|{c}").encode()).hexdigest()
                every.append((c, jw, lev, round(_score(jw, lev), 6), digest))
        want = {x[0] for x in sorted(every, key=lambda x: (-x[3], x[0]))[:best]} | {x[0] for x in sorted(every, key=lambda x: (-x[2], x[0]))[:near]} | {x[0] for x in sorted(every, key=lambda x: x[4])[:drawn]}
        assert {c for k, c in found if k == i} == want
        for c, jw, lev, _, _ in every:
            if c in want:
                assert found[i, c][0] == pytest.approx(jw, abs=1e-12) and found[i, c][1] == lev


def test_hashes_are_md5():
    tails = [b"1", b"23456", b"9" * 19]
    for head in (b"", b"7|", b"pad|123456789|", b"x" * 40):
        assert N._Hashes(tails).first(head).tolist() == [int(hashlib.md5(head + t).hexdigest()[:8], 16) for t in tails]


@pytest.mark.parametrize("name", NAME_QUERIES)
def test_top_lists_no_pair(spark, sf, name, monkeypatch):
    """Only the best pairs of a block leave it: pairs of all customers and suppliers of a nation were listed before."""
    from concordat.plans import catalogue

    def listed(*_):
        raise AssertionError("all pairs are listed")

    monkeypatch.setattr(catalogue, "_pairs", listed)
    registry.QUERIES[name](spark, sf)


def test_terms_are_scored_once_a_class(spark):
    rows = spark.createDataFrame([(i, ["a b", "b a", "c", "a b b", ""][i % 5]) for i in range(100)], "id int, t string")
    known = {r["id"]: r["_class"] for r in R.term_classes(rows, [], "id", F.split("t", " ")).collect()}
    assert [known[i] for i in (0, 1, 2, 3, 97)] == [0, 0, 2, 3, 2]
    top = R.tfidf_top_k(rows.withColumnRenamed("id", "q"), rows, by=[], query_id="q", doc_id="id", query_terms=R.word_ngrams(F.col("t"), 1), doc_terms=R.word_ngrams(F.col("t"), 1), k=3, norm=True)
    got = {}
    for r in top.orderBy("q", "rank").collect():
        got.setdefault(r["q"], []).append(r["id"])
    assert len(got) == 80 and got[0] == got[96] == [0, 1, 5] and got[2] == [2, 7, 12] and 4 not in got


def test_blocks_are_dealt_out(spark):
    """A block of many queries and documents is cut on both sides; the best are those of the whole."""
    rng = np.random.default_rng(1)
    rows = [(i, int(t), float(rng.random())) for i in range(300) for t in rng.choice(20, 5, replace=False)]
    df = spark.createDataFrame([(i, f"t{t}", w) for i, t, w in rows], "id int, term string, w double")
    got = N.best_by_postings(df.withColumnsRenamed({"id": "q", "w": "qw"}), df, by=[], query_id="q", doc_id="id", k=4, rows=400)
    x = np.zeros((300, 20))
    for i, t, w in rows:
        x[i, t] = w
    have = {(r["q"], r["id"]): r["score"] for r in got.collect()}
    s = np.round(x @ x.T, 6)
    for i in range(300):
        for j in sorted(range(300), key=lambda j: (-s[i, j], j))[:4]:
            assert have[i, j] == pytest.approx(s[i, j], abs=1.1e-6)


def test_texts_are_tokenised_before_they_meet(spark, sf):
    """Tokens were worked out again for every pair."""
    assert "regexp_extract_all" not in registry.QUERIES["pairwise_jaccard"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_of_a_brand_whatever_the_size(spark, tmp_path):
    """Only parts of the same size met, one pair in fifty of a brand."""
    parts = [(1, "hot bolt", "A", "LARGE", 1), (2, "hot bolt", "A", "LARGE", 2), (3, "blue 7", "A", "SMALL", 3), (4, "hot bolt", "B", "LARGE", 1)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    got = registry.QUERIES["pairwise_jaccard"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == [(1, 2, 1.0, 0.0, 1), (1, 3, 0.0, 0.0, 0), (2, 3, 0.0, 0.0, 0)]


def test_pairs_of_texts_are_dealt_out(spark):
    """Texts of more rows than a piece, blocks of more than a deal, keys that repeat, blocks and keys that are null."""
    rows = [(i % 40, "ab"[i % 2], f"T{i % 3}") for i in range(90)] + [(7, None, "T0"), (None, "a", "T1")]
    df = spark.createDataFrame(rows, "k int, b string, t string")
    got = N.text_pairs(df, by="b", key="k", text="t", own={"u": F.lower}, features=lambda a, b: [F.concat(a("u"), b("t")).alias("f")], piece=4, rows_a_deal=10)
    want = sorted((x[0], y[0], x[2].lower() + y[2]) for x in rows[:90] for y in rows[:90] if x[1] == y[1] and x[0] < y[0])
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("digits", [None, 6])
def test_pair_features_against_every_pair(spark, digits):
    """Names of any length, candidates with no, one or many names, names like a city, equal and empty ones."""
    text = "name string, city1 string, addr1 string"
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("ABé 01") for _ in range(draw.choice([0, 1, 3, 8, 12, 30, 40, 70])))
    some = lambda: draw.choice([word(), "LYON", "SAINT ETIENNE", "ETIENNE SAINT", "DU LYON"])
    where = lambda: draw.choice(["", "12 RUE A", "12 BIS RUE A", "7 RUE B", "RUE B", "99999999999 RUE C", word()])
    city = lambda: draw.choice(["LYON", "SAINT ETIENNE", "", "PARIS"])
    q = spark.createDataFrame([(i, i % 2, some(), city(), where()) for i in range(60)], f"q long, k int, {text}")
    bags = [[{"text": some(), "source": "UL_SIGLE", "is_ul": True, "is_sigle": True} for _ in range(draw.choice([0, 1, 2, 2, 5]))] for _ in range(50)]
    d = spark.createDataFrame([(i, i % 3, b, city(), where()) for i, b in enumerate(bags)], "c long, on int, bag array<struct<text:string,source:string,is_ul:boolean,is_sigle:boolean>>, city2 string, addr2 string")
    got = N.pair_features(q, d, by=[("k", "on")], query_id="q", candidate_id="c", name="name", bag="bag", cities=("city1", "city2"), addresses=("addr1", "addr2"), postcode_match=0.0, digits=digits)
    pairs = q.join(d, F.col("k") == F.col("on"))
    want = P.name_features(pairs, "bag", "name", "city1", "city2", ["q", "c"]).join(P.address_features(pairs.select("q", "c", "addr1", "addr2"), "addr1", "addr2"), ["q", "c"])
    want = P.interactions(want.withColumn("address_density", F.lit(1)).withColumn("postcode_match", F.lit(0)))
    want = want.select("q", "c", "name_count", *[F.round(x, digits).alias(x) if digits else x for x in N.PAIR_FEATURES])
    have, should = ({r[:2]: r[2:] for r in df.collect()} for df in (got, want))
    assert len(have) == got.count() and set(have) == set(should) and len(have) > 500
    for key, row in should.items():
        assert have[key] == (row if digits else pytest.approx(row, abs=1e-12)), key


def test_features_multiply_no_pair(spark, sf, monkeypatch):
    """A row was made for each name of each pair, and met the pair's address in a join."""
    from concordat.plans import catalogue

    monkeypatch.delattr(catalogue.P, "name_features")
    f = registry.QUERIES["feature_vector"](spark, sf)
    tree = f._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in tree and "posexplode" not in tree


def test_like_queries_share_a_block(spark):
    """One address of more queries than a block holds: each query meets every candidate once."""
    q = spark.range(1300).select(F.col("id").alias("q"), F.lit(1).alias("k"), F.format_string("N%05d", "id").alias("name"), F.lit("LYON").alias("city"), F.lit("1 RUE A").alias("addr"))
    d = spark.range(3).select(F.col("id").alias("c"), F.lit(1).alias("on"), F.expr("array(named_struct('text', 'N00001'), named_struct('text', 'N01'))").alias("bag"), F.lit("LYON").alias("city2"), F.lit("1 RUE B").alias("addr2"))
    got = N.pair_features(q, d, by=[("k", "on")], query_id="q", candidate_id="c", name="name", bag="bag", cities=("city", "city2"), addresses=("addr", "addr2"), digits=6)
    assert got.select("q", "c").distinct().count() == got.count() == 3900 and got.where("name_jaro_max = 1").count() == 3


def test_rounding_is_sparks(spark):
    x = [0.5, 0.0000005, 0.1234565, 0.9999995, 0.0000015, 9999.0, 0.0, 1.0, 0.12345649999999999, 2.6753725] + np.random.default_rng(1).random(200).tolist()
    want = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").select(F.round("x", 6)).collect()]
    assert sorted(N.rounded(np.array(x), 6).tolist()) == sorted(want)


@pytest.mark.parametrize("longest,codes", [(40, 1 << 20), (40, 10), (70, 1 << 20)])
def test_scores_of_all_pairs(spark, longest, codes, monkeypatch):
    """Every pair once, with the similarities and the boosted score that Spark gives it."""
    monkeypatch.setattr(N, "_CODES", codes)
    names = [x for x in _names(3, 120) if len(x) <= longest]
    q = spark.createDataFrame([(i, i % 2, x) for i, x in enumerate(names[:60])], "q long, k int, q_name string")
    d = spark.createDataFrame([(i, i % 3, x) for i, x in enumerate([*names[40:], None])], "c long, on int, name string")
    sides = dict(queries=q, candidates=d, by=[("k", "on")], query_id="q", candidate_id="c", query_name="q_name", name="name")
    text = F.coalesce("name", F.lit(""))
    pairs = S.with_jaro_winkler(q.join(d, F.col("k") == F.col("on")), "q_name", "name", "jw").withColumn("lev", S.levenshtein_ratio(F.col("q_name"), text))
    kinds = N.pair_kinds(**sides)
    want = {r[:2]: r[2] for r in pairs.groupBy("jw", "lev").count().collect()}
    assert {r[:2]: r[2] for r in kinds.collect()} == want and kinds.count() == len(want)
    model = P.fit_boosted(kinds.withColumn("label", (F.col("jw") + F.col("lev") > 0.9).cast("int")), ["jw", "lev"], rounds=3, depth=3)
    got = N.pair_scores(**sides, score=P.boosted_arrays(model), digits=6)
    should = {(r["q"], r["c"]): round(r["score"], 6) for r in P.boosted_score(model, pairs).select("q", "c", "score").collect()}
    have = {(r["q"], r["c"]): r["score"] for r in got.collect()}
    assert got.count() == len(have) == len(should) and len(set(should.values())) > 3 and have == pytest.approx(should, abs=1.1e-6)


def test_boosted_scores_list_no_pair(spark, sf, monkeypatch):
    """Every pair's similarity was worked out in a row of its own, twice."""
    from concordat.plans import catalogue

    monkeypatch.delattr(catalogue, "_scored")
    assert "FlatMapCoGroupsInArrow" in registry.QUERIES["gbt_scorer"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
