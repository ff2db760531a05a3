"""Descriptive statistics, dependence, and tests, with the sums done in Spark."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from murmurate.operators.skew import salted_join
from murmurate.operators.sorted_runs import scan_runs
from murmurate.schema import SENTIMENT_LABELS, col, require
from murmurate.session import Scratch

PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def _stacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value`` without NULL, for one pass over several columns."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), col(c).cast("double").alias("value")) for c in columns])).alias("x")).select("x.*").where("value IS NOT NULL AND NOT isnan(value)")


def quantiles(df: DataFrame, group: Sequence[str], value: str, ps: Sequence[float], scratch: Scratch | None = None) -> DataFrame:
    """``<group>, n, q``: exact interpolated quantiles of each group, NULL and NaN left out.

    Values are counted first, and a distributed running sum over the counts gives
    every value its places; so no task holds the distinct values of a group.
    NULL is a group of its own; a group without values has no row.
    """
    scratch = scratch or Scratch(df.sparkSession, "quantiles")
    v = col(value).cast("double")
    counts = df.select(*[col(g) for g in group], v.alias("__v")).where("__v IS NOT NULL AND NOT isnan(__v)").groupBy(*[col(g) for g in group], "__v").agg(F.count("*").alias("__n"))
    placed = scan_runs(counts, group, ["__v"], scratch=scratch, value=F.col("__n"), keep=[*group, "__v"])
    totals = placed.groupBy(*[col(g).alias(f"__g{i}") for i, g in enumerate(group)]).agg(F.max("running_total").alias("n"))
    if group:
        same = F.lit(True)
        for i, g in enumerate(group):
            same = same & col(g).eqNullSafe(F.col(f"__g{i}"))
        placed = placed.join(totals, same)
    else:
        placed = placed.withColumn("n", F.lit(totals.first()[0]))
    aggs = []
    for i, p in enumerate(ps):
        at = (F.col("n") - 1) * F.lit(float(p))
        aggs += [F.min(F.when(F.col("running_total") > f(at), F.col("__v"))).alias(f"__{name}{i}") for name, f in (("lo", F.floor), ("hi", F.ceil))]
    out = placed.groupBy(*[col(g) for g in group], "n").agg(*aggs)
    parts = []
    for i, p in enumerate(ps):
        at, lo, hi = (F.col("n") - 1) * F.lit(float(p)), F.col(f"__lo{i}"), F.col(f"__hi{i}")
        parts.append(F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi))
    return out.select(*[col(g) for g in group], "n", F.array(*parts).alias("q"))


def quantile(df: DataFrame, value: str, p: float) -> float | None:
    """One exact quantile of a column, None where it has no value."""
    row = quantiles(df, [], value, [p]).first()
    return row["q"][0] if row else None


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact percentiles and maximum per feature."""
    s = _stacked(df, columns)
    out = s.groupBy("feature").agg(F.count("*").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    out = out.join(quantiles(s, ["feature"], "value", PERCENTILES).drop("n"), "feature")
    return out.select("feature", "count", "mean", "std", "min", *[F.col("q")[i].alias(f"p{round(q * 100):02d}") for i, q in enumerate(PERCENTILES)], "max")


def shape(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis per feature; NULL below 3 and 4 values."""
    out = _stacked(df, columns).groupBy("feature").agg(F.count("*").alias("n"), F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2"))
    n = F.col("n").cast("double")
    return out.select(
        "feature", "n",
        F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * F.col("g1")).alias("skewness"),
        F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)).alias("kurtosis"),
    )


def outliers(df: DataFrame, columns: Sequence[str], fence: float = 1.5, z: float = 3.0) -> DataFrame:
    """Bounds and counts of values outside the quartile fence and beyond z deviations, per feature."""
    s = _stacked(df, columns)
    q = s.groupBy("feature").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s")).join(quantiles(s, ["feature"], "value", [0.25, 0.75]), "feature")
    width = F.col("q")[1] - F.col("q")[0]
    q = q.select("feature", (F.col("q")[0] - fence * width).alias("lower"), (F.col("q")[1] + fence * width).alias("upper"), "m", "s")
    # One row per feature.
    return s.join(F.broadcast(q), "feature").groupBy("feature", "lower", "upper").agg(
        F.count("*").alias("n"), F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).alias("iqr_outliers"),
        F.count_if(F.abs(F.col("value") - F.col("m")) > z * F.col("s")).alias("z_outliers"),
    )


def yeo_johnson(x: Column, lam: float) -> Column:
    positive = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1, F.lit(lam)) - 1) / lam
    negative = -F.log1p(-x) if abs(lam - 2) < 1e-12 else -((F.pow(1 - x, F.lit(2 - lam)) - 1) / (2 - lam))
    return F.when(x >= 0, positive).otherwise(negative)


def yeo_johnson_lambda(df: DataFrame, column: str, low: float = -3.0, high: float = 3.0, rounds: int = 4, grid: int = 13) -> float:
    """Most likely lambda by a narrowing grid; each round is one aggregation over the data."""
    x = col(column).cast("double")
    best = 1.0
    for _ in range(rounds):
        lams = np.linspace(low, high, grid)
        row = df.where(x.isNotNull()).agg(
            F.count("*"), F.sum(F.signum(x) * F.log1p(F.abs(x))), *[F.var_pop(yeo_johnson(x, float(v))) for v in lams]
        ).first()
        n, jac = row[0], row[1] or 0.0
        like = [-n / 2 * math.log(v) + (lam - 1) * jac if v and v > 0 else -math.inf for lam, v in zip(lams, row[2:])]
        i = int(np.argmax(like))
        best, step = float(lams[i]), (high - low) / (grid - 1)
        low, high = best - step, best + step
    return best


def chosen_transform(skew: float | None) -> str:
    """``yeo_johnson`` above skewness 5, ``log1p`` above 2, else ``none``."""
    return "none" if skew is None or abs(skew) <= 2 else "log1p" if abs(skew) <= 5 else "yeo_johnson"


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature_a, feature_b, r, n`` of every pair, each from the rows where both are present; one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = col(a).isNotNull() & col(b).isNotNull()
        aggs += [F.corr(F.when(both, col(a).cast("double")), F.when(both, col(b).cast("double"))).alias(f"r{i}"), F.count_if(both).alias(f"n{i}")]
    row = df.agg(*aggs)
    items = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n")) for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(items).alias("x")).select("x.*")


def strong_pairs(matrix: DataFrame, least: float = 0.5) -> DataFrame:
    return matrix.where(F.abs("r") >= least)


def average_ranks(df: DataFrame, column: str, scratch: Scratch | None = None) -> DataFrame:
    """Adds ``rank``, the mean place of equal values, over rows where the column is present.

    Places come from one row per distinct value: its count, and a distributed
    running sum of the counts before it; no task sorts the whole table.
    """
    scratch = scratch or Scratch(df.sparkSession, "ranks")
    counts = df.where(col(column).isNotNull()).groupBy(col(column).alias("__value")).agg(F.count("*").alias("__n"))
    placed = scan_runs(counts, [], ["__value"], scratch=scratch, value=F.col("__n"), keep=["__value", "__n"])
    ranks = placed.select("__value", (F.col("running_total") - (F.col("__n") - 1) / 2.0).alias("rank"))
    return df.join(ranks, col(column) == F.col("__value")).drop("__value")


def spearman(df: DataFrame, columns: Sequence[str], least: int = 100) -> DataFrame:
    """``feature_a, feature_b, rho, n`` per pair over the rows where both are present; NULL below ``least``.

    Rows are counted by pair and values in one pass. Of these cells one scan
    ranks the values of both sides of all pairs, and each cell meets its two
    ranks by a salted join, as one value may fill a third of the cells.
    """
    scratch = Scratch(df.sparkSession, "spearman")
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    each = F.array(*[F.struct(F.lit(i).alias("pair"), col(a).cast("double").alias("a"), col(b).cast("double").alias("b")) for i, (a, b) in enumerate(pairs)])
    cells = df.select(F.explode(each).alias("x")).select("x.*").where("a IS NOT NULL AND b IS NOT NULL").groupBy("pair", "a", "b").agg(F.count("*").alias("n"))
    cells = scratch.write(cells, "cells")
    values = cells.select("pair", "n", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("v")) for s in "ab"])).alias("x"))
    values = values.groupBy("pair", F.col("x.side").alias("side"), F.col("x.v").alias("v")).agg(F.sum("n").alias("n"))
    placed = scan_runs(values, ["pair", "side"], ["v"], scratch=scratch, value=F.col("n"))
    rank = (F.col("running_total") - (F.col("n") - 1) / 2.0).alias("rank")
    ranked = cells
    for side, other in ("ab", "ba"):
        of = placed.where(F.col("side") == side).select("pair", F.col("v").alias(side), rank.alias(f"r{side}"))
        ranked = salted_join(ranked, of, ["pair", side], spread=[other])
    x, y, n = F.col("ra"), F.col("rb"), F.col("n").cast("double")
    total = ranked.groupBy("pair").agg(F.sum("n").alias("n"), *[F.sum(n * e).alias(k) for k, e in (("x", x), ("y", y), ("xx", x * x), ("yy", y * y), ("xy", x * y))])
    # Ranks are numbers around the middle place, so their sums are taken as they are and centred here.
    m = F.col("n").cast("double")
    cov, vx, vy = (F.col("xy") - F.col("x") * F.col("y") / m), (F.col("xx") - F.col("x") * F.col("x") / m), (F.col("yy") - F.col("y") * F.col("y") / m)
    rho = F.when(F.col("n") >= least, F.try_divide(cov, F.sqrt(vx * vy)))
    names = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    out = total.select(F.get(names, F.col("pair")).alias("p"), rho.alias("rho"), "n")
    return out.select(F.col("p.a").alias("feature_a"), F.col("p.b").alias("feature_b"), "rho", "n")


def vif(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Variance inflation of each column in an uncentred regression on the others, from one Gram matrix."""
    k = len(columns)
    full = df.dropna(subset=list(columns))
    x = [col(c).cast("double") for c in columns]
    row = full.agg(*[F.sum(x[i] * x[j]) for i in range(k) for j in range(i, k)]).first()
    g, at = np.zeros((k, k)), 0
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = row[at] or 0.0
            at += 1
    inverse = np.linalg.pinv(g)
    values = [(c, float(inverse[i, i] * g[i, i])) for i, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(values, "feature string, vif double")


def normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def mann_whitney(df: DataFrame, value: str, group: str, least: int = 30) -> dict:
    """Two-sided asymptotic test of two groups (true, false) with tie and continuity correction.

    All sums come from one row per distinct value, ranked by a distributed scan.
    """
    rows = df.select(col(value).cast("double").alias("v"), col(group).cast("boolean").alias("g")).where("v IS NOT NULL AND g IS NOT NULL")
    scratch = Scratch(df.sparkSession, "ranks")
    counts = rows.groupBy("v").agg(F.count("*").alias("t"), F.count_if("g").alias("n1"))
    placed = scan_runs(counts, [], ["v"], scratch=scratch, value=F.col("t"))
    rank, t = F.col("running_total") - (F.col("t") - 1) / 2.0, F.col("t").cast("double")
    r = placed.agg(F.coalesce(F.sum("n1"), F.lit(0)), F.coalesce(F.sum(F.col("t") - F.col("n1")), F.lit(0)), F.sum(F.col("n1") * rank), F.sum(t * t * t - t)).first()
    n1, n2, ranks, ties = r
    if min(n1, n2) < least:
        return {"n_true": n1, "n_false": n2, "u": None, "p_value": None}
    n = n1 + n2
    u = ranks - n1 * (n1 + 1) / 2
    sd = math.sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))))
    z = max(abs(u - n1 * n2 / 2) - 0.5, 0) / sd if sd else 0.0
    medians = {m["g"]: m["q"][0] for m in quantiles(rows, ["g"], "v", [0.5], scratch).collect()}
    return {
        "n_true": n1, "n_false": n2, "u": u, "p_value": normal_tail(z), "rank_biserial": 2 * u / (n1 * n2) - 1,
        "median_true": medians[True], "median_false": medians[False],
    }


def gamma_tail(a: float, x: float) -> float:
    """Upper regularized incomplete gamma function, by series or continued fraction."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        for i in range(1, 10_000):
            term *= x / (a + i)
            total += term
            if term < total * 1e-15:
                break
        return 1 - front * total
    b = x + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi_square(df: DataFrame, a: str, b: str, least_total: int = 0) -> dict:
    """Test of independence of two categories, with Yates' correction at one degree, and Cramer's V.

    Cells and their expected counts stay in Spark, whatever the number of
    categories; cells without a row add what the others' expected counts lack.
    Values of ``a`` with fewer than ``least_total`` rows are left out.
    """
    scratch = Scratch(df.sparkSession, "cells")
    cells = df.where(col(a).isNotNull() & col(b).isNotNull()).groupBy(col(a).cast("string").alias("a"), col(b).cast("string").alias("b")).agg(F.count("*").alias("n"))
    cells = scratch.write(cells, "cells")
    across = cells.groupBy("a").agg(F.sum("n").alias("ra")).where(F.col("ra") >= least_total)
    cells = scratch.write(cells.join(across, "a"), "kept")
    down = cells.groupBy("b").agg(F.sum("n").alias("rb"))
    n, xs, ys = cells.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_distinct("a"), F.count_distinct("b")).first()
    dof = max(xs - 1, 0) * max(ys - 1, 0)
    if not dof or not n:
        return {"chi2": None, "dof": dof, "p_value": None, "cramers_v": None, "n": int(n)}
    expected = F.col("ra").cast("double") * F.col("rb") / F.lit(float(n))
    gap = F.abs(F.col("n") - expected)
    if dof == 1:
        gap = gap - F.least(F.lit(0.5), gap)
    near = cells.join(down, "b")
    chi2, e = near.agg(F.sum(gap * gap / expected), F.sum(expected)).first()
    chi2 += _empty_cell(near, n) if dof == 1 else max(n - e, 0.0)
    return {"chi2": chi2, "dof": dof, "p_value": gamma_tail(dof / 2, chi2 / 2), "cramers_v": math.sqrt(chi2 / n / min(xs - 1, ys - 1)), "n": int(n)}


def _empty_cell(near: DataFrame, n: int) -> float:
    """What the empty cells of a table of two by two add, with the correction; there are at most two."""
    rows = near.select("a", "b", "ra", "rb").collect()
    across, down, full = {r["a"]: r["ra"] for r in rows}, {r["b"]: r["rb"] for r in rows}, {(r["a"], r["b"]) for r in rows}
    missing = [across[x] * down[y] / n for x in across for y in down if (x, y) not in full]
    return sum((e - min(0.5, e)) ** 2 / e for e in missing)


def holm(df: DataFrame, p: str = "p_value", name: str = "hypothesis") -> DataFrame:
    """Step-down correction over a table of tests (tens of rows): ``p_value_holm``."""
    w = Window.orderBy(col(p), col(name))
    m = df.where(col(p).isNotNull()).withColumn("__i", F.row_number().over(w) - 1).withColumn("__m", F.count("*").over(Window.partitionBy()))
    return m.withColumn("p_value_holm", F.least(F.max(col(p) * (F.col("__m") - F.col("__i"))).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(1.0))).drop("__i", "__m")


def missing_report(df: DataFrame) -> DataFrame:
    """``column, missing_share, distinct_values, constant`` of every column, in one pass."""
    names = df.columns
    row = df.agg(F.count("*").alias("n"), *[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(names)], *[F.count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(names)])
    items = F.array(
        *[F.struct(F.lit(c).alias("column"), F.coalesce(1 - F.try_divide(F.col(f"c{i}"), F.col("n")), F.lit(0.0)).alias("missing_share"), F.col(f"d{i}").alias("distinct_values"), (F.col(f"d{i}") <= 1).alias("constant")) for i, c in enumerate(names)]
    )
    return row.select(F.explode(items).alias("x")).select("x.*")


def eligible_features(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Candidates that are present, numeric, not all NULL and not constant."""
    numeric = {c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean") or t.startswith("decimal")}
    present = [c for c in candidates if c in numeric]
    if not present:
        return []
    row = df.agg(*[F.count_distinct(col(c)).alias(str(i)) for i, c in enumerate(present)]).first()
    return [c for i, c in enumerate(present) if row[i] > 1]


def dummies(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per value but the first."""
    return df.withColumns({f"{column}_{v}": F.coalesce((col(column) == v).cast("int"), F.lit(0)) for v in list(values)[1:]})


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """``actual, predicted, n`` of scored rows, labels in upper case."""
    scored = df.select(F.upper(col(truth)).alias("actual"), F.upper(col(predicted)).alias("predicted")).where("actual IS NOT NULL AND predicted IS NOT NULL")
    return scored.groupBy("actual", "predicted").agg(F.count("*").alias("n"))


def evaluate_labels(df: DataFrame, truth: str, backend: str, bins: int = 10, classes: Sequence[str] = SENTIMENT_LABELS) -> dict:
    """Accuracy, F1, balanced accuracy, Brier, log loss, calibration and coverage against gold labels.

    Two small aggregations; unknown labels, probabilities that are not finite,
    out of range or do not sum to 1, and no scored row are errors.
    """
    if backend not in ("vader", "transformer"):
        raise ValueError("backend must be vader or transformer")
    if bins < 2:
        raise ValueError("bins must be at least 2")
    pcols = [f"{backend}_{c.lower()}" for c in classes]
    require(df, [truth, f"{backend}_label", *pcols], "evaluation")
    rows = df.select(F.upper(col(truth)).alias("y"), F.upper(col(f"{backend}_label")).alias("g"), F.array(*[col(c).cast("double") for c in pcols]).alias("p"))
    known = [F.lit(c) for c in classes]
    tolerance = 0.002 if backend == "vader" else 1e-6
    scored = F.col("y").isNotNull() & F.col("g").isNotNull()
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    bad = F.exists("p", lambda x: x.isNull() | F.isnan(x) | (x < 0) | (x > 1)) | (F.abs(total - 1) > tolerance)
    at = F.array_position(F.array(*known), F.col("y")).cast("int")
    brier = F.aggregate(F.transform("p", lambda x, i: F.pow(x - F.when(i + 1 == at, 1.0).otherwise(0.0), F.lit(2))), F.lit(0.0), lambda a, x: a + x)
    loss = -F.ln(F.least(F.greatest(F.try_element_at("p", at), F.lit(1e-15)), F.lit(1.0)))
    r = rows.agg(
        F.count("y").alias("eligible"), F.count_if(scored).alias("scored"),
        F.count_if(~F.col("y").isin(*classes)).alias("bad_truth"), F.count_if(~F.col("g").isin(*classes)).alias("bad_guess"),
        F.count_if(scored & bad).alias("bad_p"), F.avg(F.when(scored & F.col("y").isin(*classes), brier)).alias("brier"), F.avg(F.when(scored & F.col("y").isin(*classes), loss)).alias("loss"),
    ).first()
    if r["bad_truth"] or r["bad_guess"]:
        raise ValueError("unknown sentiment labels")
    if not r["scored"]:
        raise ValueError("no rows have both a gold label and a prediction")
    if r["bad_p"]:
        raise ValueError("evaluation probabilities are not finite, outside 0 to 1, or do not sum to 1")
    ok = rows.where(scored)
    best = F.array_max("p")
    bin_of = F.least(F.floor(best * bins), F.lit(bins - 1)).cast("int")
    cal = ok.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"), F.avg((F.col("y") == F.col("g")).cast("int")).alias("acc"), F.avg(best).alias("conf")).orderBy("bin").collect()
    table = {(c["y"], c["g"]): c["n"] for c in ok.groupBy("y", "g").agg(F.count("*").alias("n")).collect()}
    get = lambda a, b: table.get((a, b), 0)
    per = {}
    for c in classes:
        tp, guessed, support = get(c, c), sum(get(a, c) for a in classes), sum(get(c, b) for b in classes)
        precision, recall = tp / guessed if guessed else 0.0, tp / support if support else 0.0
        per[c] = {"precision": precision, "recall": recall, "f1": 2 * precision * recall / (precision + recall) if precision + recall else 0.0, "support": support}
    n = r["scored"]
    return {
        "backend": backend, "eligible_rows": r["eligible"], "scored_rows": n, "coverage": n / r["eligible"], "accuracy": sum(get(c, c) for c in classes) / n,
        "macro_f1": sum(v["f1"] for v in per.values()) / len(classes), "balanced_accuracy": sum(v["recall"] for v in per.values()) / len(classes),
        "multiclass_brier_score": r["brier"], "log_loss": r["loss"], "expected_calibration_error": sum(c["n"] / n * abs(c["acc"] - c["conf"]) for c in cal),
        "confusion_matrix": {a: {b: get(a, b) for b in classes} for a in classes}, "per_class": per,
        "calibration_bins": [{"lower": c["bin"] / bins, "upper": (c["bin"] + 1) / bins, "count": c["n"], "accuracy": c["acc"], "mean_confidence": c["conf"]} for c in cal],
    }
