import math

import numpy as np
import pytest

from murmurate.operators import modeling, statistics


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def test_shape_matches_corrected_formulas(spark):
    x = [1.0, 2.0, 2.0, 9.0, 30.0]
    r = statistics.shape(frame(spark, [(v,) for v in x], "x double"), ["x"]).first()
    import pandas as pd

    assert abs(r.skewness - pd.Series(x).skew()) < 1e-9 and abs(r.kurtosis - pd.Series(x).kurt()) < 1e-9


def test_ranks_and_spearman(spark):
    import pandas as pd

    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 9, 150).astype(float), rng.integers(0, 9, 150).astype(float)
    df = frame(spark, [(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    ranks = statistics.average_ranks(df.select("a"), "a").collect()
    want = dict(zip(a, pd.Series(a).rank()))
    assert all(want[r.a] == r["rank"] for r in ranks)
    rho = statistics.spearman(df, ["a", "b"]).first().rho
    assert abs(rho - pd.Series(a).rank().corr(pd.Series(b).rank())) < 1e-9


def test_mann_whitney_and_chi_square(spark):
    rows = [(float(i), i % 2 == 0) for i in range(80)] + [(float(i) + 30, True) for i in range(40)]
    r = statistics.mann_whitney(frame(spark, rows, "v double, g boolean"), "v", "g")
    t, f = [v for v, g in rows if g], [v for v, g in rows if not g]
    u = sum((x > y) + 0.5 * (x == y) for x in t for y in f)
    assert r["u"] == u and 0 < r["p_value"] < 0.5 and r["n_true"] == 80
    assert statistics.mann_whitney(frame(spark, rows[:4], "v double, g boolean"), "v", "g")["p_value"] is None
    cells = [("a", True)] * 10 + [("a", False)] * 20 + [("b", True)] * 30 + [("b", False)] * 15
    c = statistics.chi_square(frame(spark, cells, "t string, y boolean"), "t", "y")
    assert c["dof"] == 1 and abs(c["chi2"] - 6.75) < 0.4 and 0.003 < c["p_value"] < 0.02
    assert abs(statistics.gamma_tail(1.0, 2.0) - math.exp(-2)) < 1e-12 and abs(statistics.normal_tail(1.959964) - 0.05) < 1e-6


def test_holm(spark):
    df = frame(spark, [("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", 0.9)], "hypothesis string, p_value double")
    got = {r.hypothesis: round(r.p_value_holm, 6) for r in statistics.holm(df).collect()}
    assert got == {"a": 0.04, "c": 0.09, "b": 0.09, "d": 0.9}


def test_vif_and_transforms(spark):
    rows = [(float(i), float(2 * i + (i % 3))) for i in range(1, 40)]
    v = {r.feature: r.vif for r in statistics.vif(frame(spark, rows, "a double, b double"), ["a", "b"]).collect()}
    assert v["a"] > 10
    lam = statistics.yeo_johnson_lambda(frame(spark, [(math.exp(i / 5),) for i in range(40)], "x double"), "x")
    assert lam < 0.4
    assert [statistics.chosen_transform(s) for s in (None, 1, 3, 9)] == ["none", "none", "log1p", "yeo_johnson"]


def test_evaluation(spark):
    rows = [("NEGATIVE", "NEGATIVE", 0.8, 0.1, 0.1), ("neutral", "POSITIVE", 0.1, 0.3, 0.6), ("POSITIVE", "POSITIVE", 0.0, 0.0, 1.0), ("POSITIVE", None, None, None, None), (None, "POSITIVE", 0.0, 0.0, 1.0)]
    ddl = "truth string, transformer_label string, transformer_negative double, transformer_neutral double, transformer_positive double"
    r = statistics.evaluate_labels(frame(spark, rows, ddl), "truth", "transformer")
    assert abs(r["accuracy"] - 2 / 3) < 1e-12 and r["eligible_rows"] == 4 and r["scored_rows"] == 3
    p = np.array([row[2:] for row in rows[:3]], float)
    y = np.eye(3)[[0, 1, 2]]
    assert abs(r["multiclass_brier_score"] - ((p - y) ** 2).sum(1).mean()) < 1e-12
    assert r["confusion_matrix"]["NEUTRAL"]["POSITIVE"] == 1
    for bad, what in (([("WHAT", "POSITIVE", 0.0, 0.0, 1.0)], "unknown"), ([("POSITIVE", "POSITIVE", 0.4, 0.4, 0.4)], "sum to 1"), ([("POSITIVE", None, None, None, None)], "no rows")):
        with pytest.raises(ValueError, match=what):
            statistics.evaluate_labels(frame(spark, bad, ddl), "truth", "transformer")
    with pytest.raises(KeyError):
        statistics.evaluate_labels(frame(spark, rows, ddl), "nothing", "transformer")


def test_ranking_metrics(spark):
    df = frame(spark, [(0.9, 1.0), (0.8, 0.0), (0.7, 1.0), (0.1, 0.0)], "score double, label double")
    m = modeling.ranking_metrics(df)
    assert abs(m["roc_auc"] - 0.75) < 1e-12 and abs(m["average_precision"] - (0.5 + 0.5 * 2 / 3)) < 1e-12 and m["best_threshold"] == 0.7
    t = modeling.threshold_metrics(df, 0.75)
    assert (t["tp"], t["fp"], t["fn"], t["tn"]) == (1, 1, 1, 1) and t["flagged_share"] == 0.5
    assert modeling.ranking_metrics(df.where("label = 1"))["roc_auc"] is None


def test_split_is_stable(spark):
    df = spark.range(3000).selectExpr("id AS message_id", "cast(id % 3 = 0 as double) AS label")
    a = {r.message_id: r.part for r in modeling.stratified_split(df).collect()}
    b = {r.message_id: r.part for r in modeling.stratified_split(df.where("id < 1000" if "id" in df.columns else "message_id < 1000")).collect()}
    assert all(a[k] == v for k, v in b.items()) and 0.55 < sum(v == "train" for v in a.values()) / 3000 < 0.65


def test_missing_report_and_eligibility(spark):
    df = frame(spark, [(1, None, "a"), (1, None, "b")], "a int, b double, c string")
    r = {x.column: (x.missing_share, x.constant) for x in statistics.missing_report(df).collect()}
    assert r["b"] == (1.0, True) and r["a"] == (0.0, True) and r["c"] == (0.0, False)
    assert statistics.eligible_features(df, ["a", "b", "c", "d"]) == []
    assert statistics.dummies(df, "c", ["a", "b"]).columns[-1] == "c_b"


def test_model_round_trip(spark, tmp_path):
    rows = [(i, float(i % 20), ["x", "y", "z"][i % 3], None if i % 7 == 0 else float(i % 5), float(i % 20 > 9)) for i in range(240)]
    df = modeling.balanced_weights(frame(spark, rows, "message_id long, a double, c string, b double, label double"))
    ready, stages = modeling.preprocessing(df, ["a", "b"], ["c"], least=5)
    model = modeling.fit(ready(df), stages, maxIter=10)
    scored = modeling.scored(model, ready(df))
    assert modeling.ranking_metrics(scored)["roc_auc"] > 0.99
    assert modeling.importance(model, ready(df))[0][0].startswith("scaled_0")
    modeling.save(model, str(tmp_path), rows=240)
    again, meta = modeling.load(str(tmp_path))
    assert meta["rows"] == 240 and "to" in meta["excluded_columns"] and modeling.ranking_metrics(modeling.scored(again, ready(df)))["roc_auc"] > 0.99
    best, score = modeling.random_search(ready(df), stages, {"regParam": [0.0, 0.1]}, tries=1, folds=2, key="message_id")
    assert "regParam" in best and score > 0.9
    forest = modeling.fit(ready(df), stages, "forest", numTrees=3, maxDepth=3)
    assert modeling.importance(forest, ready(df))[0][1] > 0
    assert modeling.prior_scores(df, df).first().score == 0.5 and modeling.lift(0.6, 0.3) == 2.0
    with pytest.raises(ValueError):
        modeling.fit(ready(df), stages, "oracle")


def test_model_table_keeps_what_was_known_at_the_start(spark):
    rows = [(1, 1, "2020-01-01", "a", 5, True, 3), (1, 2, "2020-01-02", "b", 6, True, 3)]
    df = frame(spark, rows, "conversation_id long, message_id long, date string, `from` string, text_length int, conversation_was_answered boolean, conversation_message_count int")
    t = modeling.model_table(df)
    assert t.count() == 1 and t.first().message_id == 1 and not set(modeling.LEAKY) & set(t.columns) and t.first().label == 1.0


def test_quantiles_of_groups(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [("a" if i % 3 else None, float(v)) for i, v in enumerate(rng.integers(0, 40, 500))] + [("a", None), ("b", float("nan")), ("c", 7.0)]
    got = {r.g: (r.n, list(r.q)) for r in statistics.quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", [0.0, 0.25, 0.5, 0.99, 1.0]).collect()}
    assert set(got) == {"a", None, "c"} and got["c"] == (1, [7.0] * 5)
    for g in ("a", None):
        own = [v for k, v in rows if k == g and v is not None]
        assert got[g][0] == len(own) and np.allclose(got[g][1], np.quantile(own, [0.0, 0.25, 0.5, 0.99, 1.0]))
    assert statistics.quantile(spark.createDataFrame([], "v double"), "v", 0.5) is None
