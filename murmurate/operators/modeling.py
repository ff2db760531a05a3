"""A leakage-safe model of which conversations get an answer."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from murmurate.operators.prepare import first_messages, hash_rank
from murmurate.schema import col
from murmurate.session import Scratch

# Columns that are known only once the conversation has gone on.
LEAKY = (
    "conversation_was_answered", "conversation_end", "conversation_message_count", "conversation_participant_count", "conversation_duration_mins",
    "turn_count", "is_op", "response_gap_mins", "response_gap_mins_between_speakers", "response_gap_bucket", "to",
)


def model_table(df: DataFrame, target: str = "conversation_was_answered") -> DataFrame:
    """First messages with what was known at that moment, and the target as ``label``."""
    first = first_messages(df).where(col(target).isNotNull()).withColumn("label", col(target).cast("double"))
    return first.drop(*[c for c in LEAKY if c in first.columns])


def stratified_split(df: DataFrame, key: str = "message_id", shares: Sequence[float] = (0.6, 0.2, 0.2), seed: int | str = 42) -> DataFrame:
    """Adds ``part`` (train, validation, test) by a hash of the key within each class.

    A row's part follows from its own key, so no class is sorted into one task
    and new rows move none of the old; shares hold in expectation.
    """
    u = F.conv(F.substring(hash_rank(F.concat_ws("|", col("label").cast("string"), col(key).cast("string")), seed), 1, 8), 16, 10).cast("double") / 2.0**32
    return df.withColumn("part", F.when(u < shares[0], "train").when(u < shares[0] + shares[1], "validation").otherwise("test"))


def frequent_levels(df: DataFrame, column: str, least: int = 20, most: int = 100_000) -> list[str]:
    """All values that occur at least ``least`` times; more than ``most`` are refused, as each becomes a column of the model."""
    rows = df.where(col(column).isNotNull()).groupBy(col(column).cast("string").alias("v")).count().where(F.col("count") >= least)
    levels = [r["v"] for r in rows.select("v").limit(most + 1).collect()]
    if len(levels) > most:
        raise ValueError(f"{column} has more than {most} frequent values")
    return sorted(levels)


def preprocessing(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], least: int = 20):
    """Median imputation and scaling of numbers; mode imputation and one-hot of frequent levels."""
    keep = {c: frequent_levels(train, c, least) for c in categorical}
    modes = {c: train.agg(F.mode(col(c).cast("string"), True)).first()[0] or "missing" for c in categorical}

    def ready(df: DataFrame) -> DataFrame:
        df = df.withColumns({c: col(c).cast("double") for c in numeric})
        return df.withColumns({c: F.when(F.coalesce(col(c).cast("string"), F.lit(modes[c])).isin(*keep[c]), F.coalesce(col(c).cast("string"), F.lit(modes[c]))).otherwise("other") for c in categorical})

    stages = [Imputer(strategy="median", inputCols=list(numeric), outputCols=[f"{c}__i" for c in numeric])]
    stages.append(VectorAssembler(inputCols=[f"{c}__i" for c in numeric], outputCol="numbers", handleInvalid="keep"))
    stages.append(StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True))
    parts = ["scaled"]
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=[f"{c}__x" for c in categorical], handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"{c}__x" for c in categorical], outputCols=[f"{c}__h" for c in categorical], handleInvalid="keep"))
        parts += [f"{c}__h" for c in categorical]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return ready, stages


def balanced_weights(df: DataFrame) -> DataFrame:
    """Adds ``weight``: rows / (2 * rows of the class)."""
    n = {r["label"]: r["n"] for r in df.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    out = F.lit(1.0)
    for k, v in n.items():
        out = F.when(col("label") == k, total / (len(n) * v)).otherwise(out)
    return df.withColumn("weight", out)


def fit(train: DataFrame, stages: list, kind: str = "logistic", seed: int = 42, **params) -> PipelineModel:
    """``logistic`` (balanced) or ``forest`` (100 trees, depth 18, leaves of 5, balanced)."""
    if kind == "logistic":
        model = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", **{"maxIter": 100, **params})
    elif kind == "forest":
        model = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight", seed=seed, **{"numTrees": 100, "maxDepth": 18, "minInstancesPerNode": 5, **params})
    else:
        raise ValueError(f"unknown model {kind!r}")
    return Pipeline(stages=[*stages, model]).fit(train)


def scored(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("score", vector_to_array("probability")[1])


def prior_scores(df: DataFrame, train: DataFrame) -> DataFrame:
    """The baseline: everyone gets the training share of the positive class."""
    return df.withColumn("score", F.lit(float(train.agg(F.avg("label")).first()[0] or 0.0)))


def threshold_table(df: DataFrame, score: str = "score", label: str = "label", digits: int = 6) -> DataFrame:
    """``threshold, tp, fp`` of predicting every row at or above each distinct score.

    One row per rounded score, so cumulative sums run over at most 10**digits rows.
    """
    per = df.groupBy(F.round(col(score), digits).alias("threshold")).agg(F.sum(col(label)).cast("double").alias("p"), F.sum(1 - col(label)).cast("double").alias("q"))
    w = Window.orderBy(F.desc("threshold"))
    return per.select("threshold", F.sum("p").over(w).alias("tp"), F.sum("q").over(w).alias("fp"))


def ranking_metrics(df: DataFrame, score: str = "score", label: str = "label") -> dict:
    """ROC AUC, average precision, the threshold of the best F1 and that F1, as sums over the thresholds."""
    w = Window.orderBy(F.desc("threshold"))
    tp, fp = F.col("tp"), F.col("fp")
    steps = threshold_table(df, score, label).select("*", *[(F.col(c) - F.coalesce(F.lag(c).over(w), F.lit(0.0))).alias(f"d_{c}") for c in ("tp", "fp")])
    ends = steps.agg(F.max("tp"), F.max("fp")).first()
    if not ends[0] or not ends[1]:
        return {"roc_auc": None, "average_precision": None, "best_threshold": None, "best_f1": None}
    p, q = float(ends[0]), float(ends[1])
    f1 = 2 * tp / (tp + fp + p)
    r = steps.agg(
        F.sum(F.col("d_fp") * (2 * tp - F.col("d_tp")) / 2) / (p * q), F.sum(F.col("d_tp") / p * tp / (tp + fp)), F.max(F.struct(f1, "threshold"))
    ).first()
    return {"roc_auc": r[0], "average_precision": r[1], "best_threshold": float(r[2][1]), "best_f1": float(r[2][0])}


def threshold_metrics(df: DataFrame, threshold: float = 0.5, score: str = "score", label: str = "label") -> dict:
    """Confusion counts and what follows from them, with the share of rows that are flagged."""
    hit = col(score) >= threshold
    pos = col(label) == 1
    r = df.agg(F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"), F.count_if(~hit & pos).alias("fn"), F.count_if(~hit & ~pos).alias("tn")).first()
    tp, fp, fn, tn = r
    div = lambda a, b: a / b if b else 0.0
    recall, specificity = div(tp, tp + fn), div(tn, tn + fp)
    return {
        "tp": tp, "fp": fp, "fn": fn, "tn": tn, "precision": div(tp, tp + fp), "recall": recall, "specificity": specificity, "npv": div(tn, tn + fn),
        "f1": div(2 * tp, 2 * tp + fp + fn), "balanced_accuracy": (recall + specificity) / 2, "flagged_share": div(tp + fp, tp + fp + fn + tn),
    }


def lift(average_precision: float, prevalence: float) -> float:
    return average_precision / prevalence if prevalence else 0.0


def random_search(train: DataFrame, stages: list, grid: dict[str, Sequence], *, kind: str = "logistic", tries: int = 8, folds: int = 3, seed: int = 42, key: str = "message_id") -> tuple[dict, float]:
    """Sampled settings compared by average precision over hash folds; the best setting and its mean."""
    rng = np.random.default_rng(seed)
    scratch = Scratch(train.sparkSession, "search")
    folded = scratch.write(train.withColumn("__f", F.pmod(F.xxhash64(F.lit(seed), col(key)), F.lit(folds))), "folds")
    best: tuple[dict, float] = ({}, -1.0)
    try:
        for _ in range(tries):
            setting = {k: v[int(rng.integers(len(v)))] for k, v in grid.items()}
            got = []
            for f in range(folds):
                model = fit(folded.where(F.col("__f") != f), stages, kind, seed, **setting)
                got.append(ranking_metrics(scored(model, folded.where(F.col("__f") == f)))["average_precision"] or 0.0)
            if np.mean(got) > best[1]:
                best = (setting, float(np.mean(got)))
    finally:
        scratch.close()
    return best


def importance(model: PipelineModel, df: DataFrame, top: int = 20) -> list[tuple[str, float]]:
    """Signed coefficients or importances by feature name, largest first by size."""
    attrs = model.transform(df.limit(1)).schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    last = model.stages[-1]
    values = last.coefficients.toArray() if hasattr(last, "coefficients") else last.featureImportances.toArray()
    rows = [(names.get(i, str(i)), float(v)) for i, v in enumerate(values)]
    return sorted(rows, key=lambda r: (-abs(r[1]), r[0]))[:top]


def save(model: PipelineModel, folder: str, **metadata) -> None:
    """The fitted pipeline and, beside it, what it was fitted on as one JSON row."""
    model.write().overwrite().save(f"{folder}/model")
    spark = SparkSession.active()
    row = [(json.dumps(metadata | {"excluded_columns": list(LEAKY)}, sort_keys=True, default=str),)]
    spark.createDataFrame(row, "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/metadata")


def load(folder: str) -> tuple[PipelineModel, dict]:
    spark = SparkSession.active()
    return PipelineModel.load(f"{folder}/model"), json.loads(spark.read.text(f"{folder}/metadata").first()[0])
