"""Checks that fail closed, each a single pass over its table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurate.operators.residual import tokens
from murmurate.operators.sentiment import TRANSFORMER_COLUMNS, VADER_COLUMNS
from murmurate.schema import EMOTION_LABELS, PLACEHOLDERS, SENTIMENT_LABELS, col


class ValidationError(ValueError):
    pass


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row: ``rows`` and how many rows violate each check; a check that is NULL is not violated."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])


def enforce(df: DataFrame, checks: Mapping[str, Column], context: str) -> dict:
    """The counts of one pass; any violation is an error that names it."""
    if twice := sorted({c for c in df.columns if df.columns.count(c) > 1}):
        raise ValidationError(f"{context}: columns occur twice: {twice}")
    counts = violations(df, checks).first().asDict()
    if broken := {k: v for k, v in counts.items() if k != "rows" and v}:
        raise ValidationError(f"{context} failed: {broken}")
    return counts | {"passed": True}


def _size(c: str) -> Column:
    return F.coalesce(F.size(col(c)), F.lit(0))


def core_checks(df: DataFrame, text: str = "text_cleaned") -> dict[str, Column]:
    have = set(df.columns)
    out = {"null_text": col(text).isNull()} if text in have else {}
    for stem in ("tech_lexicon", "slang", "glued"):
        m, n = f"{stem}_matches", f"{stem}_match_count"
        if {m, n} <= have:
            out[f"{stem}_count_differs"] = _size(m) != F.coalesce(col(n), F.lit(-1))
    for name, token in PLACEHOLDERS.items():
        if f"{name}_count" in have and text in have:
            out[f"{name}_count_differs"] = F.regexp_count(col(text), F.lit(rf"(?U)\b{token}\b")) != F.coalesce(col(f"{name}_count"), F.lit(-1))
    if {"residual_words", "has_residual"} <= have:
        out["residual_flag_differs"] = (_size("residual_words") > 0) != F.coalesce(col("has_residual"), F.lit(False))
    if "glued_matches" in have:
        out["placeholder_glued"] = F.exists(F.coalesce(col("glued_matches"), F.array()), lambda x: F.upper(x["run"]).isin(*PLACEHOLDERS.values()))
    return out


def validate_core(df: DataFrame, text: str = "text_cleaned", *, max_nonword: float = 0.25, least_tokens: int = 100) -> dict:
    """Text, match counts, placeholders, flags and the share of NONWORD tokens, in one aggregation."""
    checks = core_checks(df, text)
    t = tokens(col(text))
    row = df.agg(
        F.count("*").alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()],
        F.coalesce(F.sum(F.size(t)), F.lit(0)).alias("__tokens"), F.coalesce(F.sum(F.size(F.filter(t, lambda x: x == "NONWORD"))), F.lit(0)).alias("__nonwords"),
    ).first().asDict()
    n, bad = row.pop("__tokens"), row.pop("__nonwords")
    if broken := {k: v for k, v in row.items() if k != "rows" and v}:
        raise ValidationError(f"core validation failed: {broken}")
    if n >= least_tokens and bad / n > max_nonword:
        raise ValidationError(f"NONWORD token rate {bad / n:.3f} is above {max_nonword}")
    return row | {"tokens": n, "nonword_rate": bad / n if n else 0.0, "passed": True}


def distribution_checks(prefix: str, parts: list[str], labels, tolerance: float) -> dict[str, Column]:
    cols = [col(c) for c in parts]
    some = F.lit(False)
    for c in cols:
        some = some | c.isNotNull()
    total = sum(cols[1:], cols[0])
    outside = F.lit(False)
    for c in cols:
        outside = outside | (c < 0) | (c > 1) | F.isnan(c.cast("double"))
    return {
        f"{prefix}_incomplete": some & (total.isNull() | col(f"{prefix}_label").isNull()),
        f"{prefix}_out_of_range": outside, f"{prefix}_sum": F.abs(total - 1) > tolerance,
        f"{prefix}_label_unknown": ~col(f"{prefix}_label").isin(*labels),
    }


def validate_sentiment(df: DataFrame, *, least_rows: int = 100, least_unique: int = 10) -> dict:
    """Completeness, ranges, sums, labels against thresholds, and a minimum of different scores."""
    have, checks, unique = set(df.columns), {}, {}
    if set(VADER_COLUMNS) <= have:
        checks |= distribution_checks("vader", list(VADER_COLUMNS[:3]), SENTIMENT_LABELS, 0.002)
        c = col("vader_compound")
        right = F.when(c >= 0.05, "POSITIVE").when(c <= -0.05, "NEGATIVE").otherwise("NEUTRAL")
        checks |= {"vader_compound_range": F.abs(c) > 1, "vader_label_threshold": c.isNotNull() & (col("vader_label") != right)}
        unique["vader_compound"] = F.count_distinct("vader_compound")
    if set(TRANSFORMER_COLUMNS) <= have:
        checks |= distribution_checks("transformer", list(TRANSFORMER_COLUMNS[:3]), SENTIMENT_LABELS, 1e-4)
        unique["transformer_score"] = F.count_distinct("transformer_score")
    if not checks:
        raise ValidationError("no sentiment columns")
    counts = enforce(df, checks, "sentiment validation")
    row = df.agg(*[v.alias(k) for k, v in unique.items()], *[F.count(col(k)).alias(f"n_{k}") for k in unique]).first().asDict()
    for k in unique:
        if row[f"n_{k}"] >= least_rows and row[k] < least_unique:
            raise ValidationError(f"{k} has low diversity: {row[k]} different scores in {row[f'n_{k}']} rows")
    return counts


def validate_nlp(df: DataFrame, *, coverage: float = 0.99, topic_coverage: float = 0.5, frozen_rows: int = 20) -> dict:
    """Ratios, coverage, frozen features, topics and emotions."""
    have, checks = set(df.columns), {}
    for c in have:
        if c.endswith("_ratio") or c in ("nlp_lexical_diversity", "topic_score", "topic_entropy", "topic_margin", "emotion_score"):
            checks[f"{c}_range"] = (col(c) < 0) | (col(c) > 1.0000001)
        if c.startswith("nlp_") and c.endswith("_count"):
            checks[f"{c}_negative"] = col(c) < 0
    if {"nlp_token_count", "nlp_alpha_token_count"} <= have:
        checks["alpha_above_tokens"] = col("nlp_alpha_token_count") > col("nlp_token_count")
    if {"topic_id", "topic_label"} <= have:
        checks["topic_half_set"] = col("topic_id").isNull() != col("topic_label").isNull()
    if "emotion_label" in have:
        checks |= distribution_checks("emotion", [f"emotion_{x.lower()}" for x in EMOTION_LABELS], EMOTION_LABELS, 1e-4)
    counts = enforce(df, checks, "NLP validation")
    row = df.agg(
        F.count("*").alias("n"),
        *([F.count("nlp_token_count").alias("covered"), F.count_distinct("nlp_token_count").alias("kinds"), F.count_distinct("text_cleaned").alias("texts")] if {"nlp_token_count", "text_cleaned"} <= have else []),
        *([F.count("topic_id").alias("topics")] if "topic_id" in have else []),
    ).first().asDict()
    n = row["n"]
    if n and "covered" in row:
        if row["covered"] / n < coverage:
            raise ValidationError(f"linguistic coverage {row['covered'] / n:.3f} is below {coverage}")
        if n >= frozen_rows and row["texts"] > 1 and row["kinds"] <= 1:
            raise ValidationError("linguistic features are frozen: one token count for all texts")
    if n and "topics" in row and row["topics"] / n < topic_coverage:
        raise ValidationError(f"topic coverage {row['topics'] / n:.3f} is below {topic_coverage}")
    return counts


def validate_unique(df: DataFrame, keys: list[str], context: str) -> None:
    """No NULL and no repeated key; copies are counted in the map tasks first."""
    bad = df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("__n"))
    null = F.lit(False)
    for k in keys:
        null = null | col(k).isNull()
    row = bad.agg(F.count_if(null).alias("nulls"), F.count_if(F.col("__n") > 1).alias("repeated")).first()
    if row["nulls"] or row["repeated"]:
        raise ValidationError(f"{context}: {row['nulls']} NULL and {row['repeated']} repeated keys")


def validate_silver(df: DataFrame, key: str = "message_id", *, max_nonword: float = 0.25) -> dict:
    """Unique ids and all checks that the columns present allow."""
    validate_unique(df, [key], "silver")
    out = validate_core(df, max_nonword=max_nonword) if "text_cleaned" in df.columns else {}
    if {"vader_label", "transformer_label"} & set(df.columns):
        out |= validate_sentiment(df)
    if any(c.startswith(("nlp_", "topic_", "emotion_")) for c in df.columns):
        out |= validate_nlp(df)
    return out


def validate_gold(gold: DataFrame, keys: list[str], *, silver: DataFrame | None = None, conserved: DataFrame | None = None, null_keys: bool = False) -> dict:
    """Unique keys, counts, averages and shares in range, and as many messages as went in.

    ``conserved`` is the input whose rows the counts must add up to, where a
    level filters or multiplies messages; by default ``silver``.
    """
    checks: dict[str, Column] = {}
    for c in gold.columns:
        if c.endswith("message_count") or c in ("participant_count", "unique_contacts", "total_interactions"):
            checks[f"{c}_negative_or_null"] = col(c).isNull() | (col(c) < 0)
        if c.endswith("_share"):
            checks[f"{c}_range"] = (col(c) < -1e-9) | (col(c) > 1 + 1e-9)
        if "avg_vader_compound" in c or "expected_sentiment" in c:
            checks[f"{c}_range"] = F.abs(col(c)) > 1 + 1e-9
        if any(x in c for x in ("avg_vader_negative", "avg_vader_neutral", "avg_vader_positive", "confidence", "normalized_entropy")):
            checks[f"{c}_range"] = (col(c) < -1e-9) | (col(c) > 1 + 1e-9)
    out = enforce(gold, checks, "gold validation")
    if keys:
        if null_keys:
            gold = gold.withColumns({k: F.coalesce(col(k).cast("string"), F.lit("\u0000")) for k in keys})
        validate_unique(gold, keys, "gold")
    source = conserved if conserved is not None else silver
    if source is not None:
        got, want = gold.agg(F.coalesce(F.sum("message_count"), F.lit(0))).first()[0], source.count()
        if got != want:
            raise ValidationError(f"gold holds {got} messages of {want}")
    return out


def json_guard(text: Column, ddl: str) -> Column:
    """Whether a non-blank cell is no JSON of the given type."""
    cell = F.nullif(F.trim(text), F.lit(""))
    return cell.isNotNull() & F.from_json(cell, ddl).isNull()
