"""Pair features, scores, ranking, promotion, routing."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from .blocking import ranked

# The features whose values of the two best candidates go into the risk row.
RISK_BASE = ["name_jaro_max", "name_token_overlap_max", "name_semantic_max", "name_semantic_second", "name_semantic_gap", "addr_jaro", "addr_token_overlap", "street_number_diff", "address_density", "idf_name", "name_length_max", "numeric_token_match", "name_sim_max_etab", "name_sim_max_pm_dirigeant", "name_crm_contains_cand_max", "name_contains_crm_max", "postcode_match", "city_match", "street_name_jaro", "name_addr_consistency"]


def name_features(pairs: DataFrame, names: str, crm_name: str, crm_city: str, cand_city: str, keys: list[str]) -> DataFrame:
    """Name features of a pair over the candidate's bag of names: array<struct<text,source,is_ul,is_sigle>>.

    The bag is exploded once, similarities are worked out for each distinct pair of strings, and the pair's features
    come back by one aggregation. The best name is the one of highest Jaro-Winkler that isn't like the city's name,
    if there is such a one.
    """
    one = pairs.select(*keys, crm_name, crm_city, cand_city, F.posexplode(names).alias("_pos", "_n")).select("*", F.col("_n.text").alias("_text"))
    one = S.with_jaro_winkler(one, crm_name, "_text", "jw")
    q, t = F.col(crm_name), F.col("_text")
    qt, tt = T.name_tokens(q), T.name_tokens(t)
    city = F.greatest(S.jaccard(tt, T.name_tokens(F.col(cand_city))), S.jaccard(tt, T.name_tokens(F.col(crm_city))))
    one = one.select("*", S.levenshtein_ratio(q, t).alias("lev"), S.jaccard(qt, tt).alias("tok"), S.numeric_match(T.numeric_tokens(q), T.numeric_tokens(t)).alias("num"), city.alias("city"), T.first_word_match(q, t).alias("first"), T.contains(t, q).alias("holds"), T.contains(q, t).alias("held"), T.acronym_match(q, t).alias("acro"), T.is_person_name(t).alias("person"))
    one = one.withColumn("citylike", (F.col("city") > 0.7) & (F.size(T.tokens(t)) <= 3))
    free = F.min(F.col("citylike").cast("int")).over(Window.partitionBy(*keys))
    one = one.withColumn("_free", free == 0).withColumn("_ok", ~(F.col("citylike") & F.col("_free")))
    one = ranked(one, keys, [F.desc("_ok"), F.desc("jw"), "_pos"], "_place")
    best = lambda c: F.max(F.when(F.col("_place") == 1, c))
    top = lambda c, when=None: F.coalesce(F.max(F.when(when, c) if when is not None else c), F.lit(0.0))
    second = F.coalesce(F.max(F.when((F.col("_place") == 2) & F.col("_ok"), F.col("jw"))), F.lit(0.0))
    return one.groupBy(*keys).agg(
        F.count("*").alias("name_count"), best(F.col("jw")).alias("name_jaro_max"), second.alias("name_jaro_second"), best(F.col("lev")).alias("name_levenshtein_max"), top(F.col("tok")).alias("name_token_overlap_max"),
        best(F.col("num")).alias("numeric_token_match"), top(F.col("first")).alias("name_first_word_match_max"), top(F.col("holds")).alias("name_contains_crm_max"), top(F.col("held")).alias("name_crm_contains_cand_max"), top(F.col("acro")).alias("acronym_match_max"),
        top(F.col("jw"), ~F.col("_n.is_ul")).alias("name_sim_max_etab"), top(F.col("jw"), F.col("_n.is_ul")).alias("name_sim_max_ul"), top(F.col("jw"), F.col("_n.is_sigle")).alias("name_sim_max_sigle"), top(F.col("jw"), F.col("_n.source") == "PM_DIRIGEANT").alias("name_sim_max_pm_dirigeant"),
        best(F.col("_n.source")).alias("type_of_max_name"), best(F.length("_text")).alias("name_length_max"), F.max("person").cast("int").alias("has_person_name"), top(F.col("jw"), F.col("person")).alias("person_name_jaro_max"), top(F.col("city")).alias("name_city_overlap_max"), F.max("citylike").cast("int").alias("name_is_city_like_max"),
        F.max((F.col("_text") == F.col(crm_name)) & (F.col("jw") == 1.0)).cast("int").alias("name_norm_exact"),
    ).withColumn("name_jaro_gap", F.col("name_jaro_max") - F.col("name_jaro_second"))


def address_features(pairs: DataFrame, crm_addr: str, cand_addr: str) -> DataFrame:
    """Address similarities of normalised addresses, and of their streets."""
    p = S.with_jaro_winkler(pairs, crm_addr, cand_addr, "addr_jaro")
    p = p.withColumn("_s1", T.street_of_address(F.col(crm_addr))).withColumn("_s2", T.street_of_address(F.col(cand_addr)))
    p = S.with_jaro_winkler(p, "_s1", "_s2", "street_name_jaro").drop("_s1", "_s2")
    a, b = F.col(crm_addr), F.col(cand_addr)
    n1, n2 = T.street_number(a), T.street_number(b)
    return p.withColumns({"addr_levenshtein": S.levenshtein_ratio(a, b), "addr_token_overlap": S.jaccard(T.name_tokens(a, 1, [""]), T.name_tokens(b, 1, [""])), "street_number_diff": S.number_gap(n1, n2), "street_number_match": F.coalesce((n1 == n2).cast("int"), F.lit(0))})


def interactions(p: DataFrame) -> DataFrame:
    """Products and penalties of name, address and density columns that are there already."""
    c = F.col
    return p.withColumns({
        "name_addr_consistency": c("name_jaro_max") * c("addr_jaro"),
        "addr_unsupported_by_name": c("addr_jaro") * (1 - c("name_jaro_max")),
        "name_density_penalty": F.least(c("address_density"), F.lit(100)) / 100 * (1 - c("name_jaro_max")),
        "addr_jaro_per_density": c("addr_jaro") / F.log1p(F.greatest(F.lit(1), c("address_density"))),
        "postcode_match_without_addr": c("postcode_match") * (1 - c("street_name_jaro")),
        "full_addr_match_score": 0.5 * c("street_name_jaro") + 0.3 * c("street_number_match") + 0.2 * c("postcode_match"),
    })


def heuristic(name: Column, address: Column) -> Column:
    return 0.6 * name + 0.4 * address


def top_k(scored: DataFrame, *, query: str, candidate: str, k: int, score: str = "score") -> DataFrame:
    return ranked(scored, [query], [F.desc(score), candidate]).where(F.col("rank") <= k)


def gap_and_ratio(top: DataFrame, *, query: str, floor: float = 0.001, tiny: float = 1e-6) -> DataFrame:
    """One row a query: the best two scores, gap and ratio; a second score of almost 0 divides as `floor`."""
    g = top.groupBy(query).agg(F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("score_top1"), F.coalesce(F.max(F.when(F.col("rank") == 2, F.col("score"))), F.lit(0.0)).alias("score_top2"), F.coalesce(F.avg(F.when(F.col("rank") <= 3, F.col("score"))), F.lit(0.0)).alias("score_top3_avg"))
    below = F.when(F.col("score_top2") > tiny, F.col("score_top2")).otherwise(floor)
    return g.withColumns({"score_gap": F.col("score_top1") - F.col("score_top2"), "score_ratio": F.col("score_top1") / below})


def promote_open(top: DataFrame, *, query: str, entity: str, closed: Column, place: str = "rank") -> DataFrame:
    """In each query and entity the first closed row and the first open row behind it swap places.

    Rows with an empty entity never move.
    """
    w = Window.partitionBy(query, entity)
    t = top.withColumn("_c", F.min(F.when(closed, F.col(place))).over(w)).withColumn("_o", F.min(F.when(~closed, F.col(place))).over(w))
    swap = F.coalesce((F.col("_c") < F.col("_o")) & (F.col(entity).cast("string") != ""), F.lit(False))
    new = F.when(swap & (F.col(place) == F.col("_c")), F.col("_o")).when(swap & (F.col(place) == F.col("_o")), F.col("_c")).otherwise(F.col(place))
    return t.withColumn(place, new).drop("_c", "_o")


def risk_row(top: DataFrame, *, query: str, features: list[str] = RISK_BASE) -> DataFrame:
    """One row a query: scores, and each feature of the first, of the second and their difference; missing is 0."""
    pick = lambda f, r: F.coalesce(F.max(F.when(F.col("rank") == r, F.col(f).cast("double"))), F.lit(0.0))
    have = [f for f in features if f in top.columns]
    g = top.where("rank <= 2").groupBy(query).agg(pick("score", 1).alias("score_top1"), pick("score", 2).alias("score_top2"), *[pick(f, r).alias(f"top{r}_{f}") for f in have for r in (1, 2)])
    below = F.when(F.col("score_top2") > 1e-6, F.col("score_top2")).otherwise(0.001)
    zero = {f"{p}_{f}": F.lit(0.0) for f in features if f not in have for p in ("top1", "top2", "delta")}
    return g.withColumns({"score_gap": F.col("score_top1") - F.col("score_top2"), "score_ratio": F.col("score_top1") / below} | {f"delta_{f}": F.col(f"top1_{f}") - F.col(f"top2_{f}") for f in have} | zero)


def route(risk: Column, threshold: float = 0.835) -> Column:
    return F.when(risk >= threshold, "AUTO").otherwise("REVIEW")


def confidence_status(x: Column, decision: Column | None = None) -> Column:
    status = F.when(x >= 0.85, "MATCH").when(x >= 0.60, "REVIEW").otherwise("NO_MATCH")
    return status if decision is None else F.when(decision == "BEST_MATCH", status).otherwise("NO_MATCH")


def name_evidence(jaro, token, etab, ul, semantic) -> Column:
    return (jaro >= 0.60) | (token >= 0.30) | (etab >= 0.60) | (ul >= 0.60) | (semantic >= 0.50)


def strict_address(jaro: Column, overlap: Column, number: Column, very: bool = False) -> Column:
    j, o, d = (0.95, 0.60, 1) if very else (0.90, 0.50, 2)
    return (jaro >= j) & (overlap >= o) & ((number <= d) | (number == 9999.0))


def places_fallback(review: DataFrame, places: DataFrame, *, query: str, dept_query: Column, dept_place: Column, rescored: DataFrame, threshold: float) -> DataFrame:
    """Review rows against a table of places: guarded by department, scored again, decided with a reason."""
    p = review.join(places, query, "left").join(rescored.select(query, F.col("score").alias("score_after")), query, "left")
    reason = F.when(F.col("place_id").isNull(), "NO_PLACE").when(F.coalesce(dept_query != dept_place, F.lit(False)), "DEPARTMENT_MISMATCH").when(F.col("score_after").isNull(), "NO_CANDIDATE").when(F.col("score_after") < threshold, "LOW_SCORE").otherwise("OK")
    return p.withColumn("reason", reason).withColumn("final_status", F.when(F.col("reason") == "OK", "MATCH_PLACES").otherwise("NO_MATCH"))


def fit_boosted(train: DataFrame, features: list[str], label: str = "label", weight: str | None = None, rounds: int = 20, depth: int = 4):
    """Pointwise boosted trees: the pluggable ranker and decider. Spark ML has no learning to rank."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    gbt = GBTClassifier(featuresCol="_x", labelCol=label, maxIter=rounds, maxDepth=depth, seed=7, **({"weightCol": weight} if weight else {}))
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_x"), gbt]).fit(train)


def boosted_score(model, rows: DataFrame, name: str = "score") -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    out = model.transform(rows)
    return out.withColumn(name, vector_to_array("probability")[1]).drop("_x", "rawPrediction", "probability", "prediction")


def boosted_arrays(model) -> Callable:
    """What `boosted_score` gives, of arrays of the features: the trees as plain numbers, which tasks get by value."""
    def plain(node):
        if node.numDescendants() == 0:
            return node.prediction()
        return node.split().featureIndex(), node.split().threshold(), plain(node.leftChild()), plain(node.rightChild())

    gbt = model.stages[-1]
    trees = [(w, plain(t._call_java("rootNode"))) for w, t in zip(gbt.treeWeights, gbt.trees)]

    def score(*features):
        def walk(node):
            if isinstance(node, float):
                return np.full(len(features[0]), node)
            i, threshold, left, right = node
            return np.where(features[i] <= threshold, walk(left), walk(right))

        return 1 / (1 + np.exp(-2 * sum(w * walk(t) for w, t in trees)))

    return score


def fit_isotonic(rows: DataFrame, score: str = "score", label: str = "label"):
    from pyspark.ml.regression import IsotonicRegression

    return IsotonicRegression(featuresCol=score, labelCol=label).fit(rows.select(score, F.col(label).cast("double")))


def calibrated(model, rows: DataFrame, score: str = "score", name: str = "calibrated") -> DataFrame:
    out = model.setPredictionCol("_p").transform(rows)
    return out.withColumn(name, F.least(F.greatest(F.col("_p"), F.lit(0.0)), F.lit(1.0))).drop("_p")


def fit_sigmoid(rows: DataFrame, score: str = "score", label: str = "label"):
    """Platt scaling: a logistic regression on the score alone."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    return Pipeline(stages=[VectorAssembler(inputCols=[score], outputCol="_x"), LogisticRegression(featuresCol="_x", labelCol=label, maxIter=200, tol=1e-10)]).fit(rows)


def ratio_replacing_zero(first: Column, second: Column) -> Column:
    """First over second score; a second of exactly 0 counts as 0.001, a missing one gives null."""
    return first / F.when(second == 0, 0.001).otherwise(second)


def gap_and_ratio_of_place(top: DataFrame, *, query: str) -> DataFrame:
    """Rows with `place` from 0, gap and ratio of their query: a second score of 0 or less gives the ratio 100, a single
    row the gap 0 and the ratio 1."""
    two = top.groupBy(query).agg(F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("_1"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("_2"))
    ratio = F.when(F.col("_2").isNull(), 1.0).when(F.col("_2") > 0, F.col("_1") / F.col("_2")).otherwise(100.0)
    return top.join(two, query).select("*", (F.col("rank") - 1).alias("place"), F.coalesce(F.col("_1") - F.col("_2"), F.lit(0.0)).alias("score_gap"), ratio.alias("score_ratio")).drop("_1", "_2")


def places_outcome(*, query: Column, error: Column, found: Column, crm_department: Column, place_department: Column, rerun_error: Column, rerun_status: Column) -> Column:
    """The reason of a decision by places, in the order in which they are looked at; 'ok' is a match."""
    return (
        F.when(F.coalesce(query, F.lit("")) == "", "empty_query").when(error.isNotNull(), F.concat(F.lit("api_error: "), error)).when(~found, "no_places_results")
        .when(crm_department.isNull() | place_department.isNull(), "missing_dept_guard").when(crm_department != place_department, F.concat(F.lit("dept_mismatch: crm="), crm_department, F.lit(" places="), place_department))
        .when(rerun_error.isNotNull(), F.concat(F.lit("xgb_rerun_error: "), rerun_error)).when(rerun_status != "AUTO", "xgb_rerun_not_auto").otherwise("ok")
    )
