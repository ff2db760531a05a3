"""Bronze to silver and silver to gold, as plans and from the command line."""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurate.functions import structural
from murmurate.functions.normalize import normalized
from murmurate.operators import gold as gold_ops
from murmurate.operators import lexicons, linguistic, residual, sentiment, topics, validate
from murmurate.operators.prepare import prepare_bronze, seeded_sample, working_text
from murmurate.schema import FEATURE_SCHEMA_VERSION, PLACEHOLDERS, col
from murmurate.sources import metrics, readers, writers


#: What ``residual.reviewed_labels`` takes.
LABEL_TABLES = ("jargon", "languages", "nonwords", "english")


@dataclass(frozen=True)
class PipelineConfig:
    """Everything a run can choose. Unknown names are a TypeError."""

    anonymize: bool = True
    normalize: bool = True
    residual_policy: str = "manual_review"
    sentiment_mode: str | None = "vader"
    linguistic: bool = True
    topics: bool = False
    topic_count: int = 12
    topic_sample: int | None = None
    topic_features: int = 20_000
    topic_rounds: int = 400
    include_slang_review: bool = False
    sample_size: int | None = None
    random_state: int = 42
    max_nonword_rate: float = 0.25
    materialization: str = "auto"
    validate: bool = True

    def updated(self, **changes) -> PipelineConfig:
        if unknown := sorted(set(changes) - {f.name for f in fields(self)}):
            raise TypeError(f"unknown options: {unknown}")
        return replace(self, **changes)


def core_features(df: DataFrame, config: PipelineConfig, terms, slang=lexicons.DEFAULT_SLANG, corrections: Mapping[str, str] | None = None) -> DataFrame:
    """Cleaned text, matches, counts and flags; structural matches come from the text as it was."""
    df = working_text(df)
    text = col("text_cleaned")
    if config.normalize:
        df = df.withColumn("text_cleaned", normalized(text, corrections))
    df = df.withColumn("structural_matches", structural.structural_matches(text))
    if config.anonymize:
        df = df.withColumn("text_cleaned", structural.anonymized(text))
        df = df.withColumns(structural.placeholder_counts(text))
    else:
        df = df.withColumns(structural.raw_counts(text))
    df = df.withColumns(
        {
            "tech_lexicon_matches": lexicons.term_matches(text, terms),
            "slang_matches": lexicons.slang_matches(text, slang, config.include_slang_review),
            "glued_matches": lexicons.glued_matches(text, terms),
        }
    )
    df = df.withColumns({f"{k}_match_count": F.size(f"{k}_matches").cast("bigint") for k in ("tech_lexicon", "slang", "glued")})
    flags = ["tech_lexicon_matches", "slang_matches", "glued_matches", "structural_matches", *[f"{p}_count" for p in PLACEHOLDERS]]
    return df.withColumn("has_lexicon_match", lexicons.has_lexicon_match(flags))


def bronze_to_silver(
    bronze: DataFrame, terms, *, config: PipelineConfig | None = None, releases=(), tie_break: Sequence[str] = (), dictionary: DataFrame | None = None, label_tables: dict[str, DataFrame] | None = None,
    classifier=None, backend=None, tagger=None, prepared: bool = False, slang: Sequence[tuple[str, str, str]] = lexicons.DEFAULT_SLANG,
    corrections: Mapping[str, str] | None = None, valence: Mapping[str, float] = sentiment.VALENCE, **options,
) -> DataFrame:
    """Prepared, core and enriched silver, checked before it is handed on.

    ``slang``, ``corrections`` and ``valence`` take the place of the small tables that ship.
    With ``validate`` (the default) the finished table is written to the shared
    folder, or kept as ``materialization`` says, and every check its columns
    allow is made; what fails is a ``ValidationError`` and no table. With
    ``materialization="none"`` nothing is kept, so the plan runs once for the
    checks and again for its use. Without ``validate`` it is one lazy plan.
    """
    config = (config or PipelineConfig()).updated(**options)
    df = bronze if prepared else prepare_bronze(bronze, releases, tie_break, unique_ids=True)
    if config.sample_size:
        df = seeded_sample(df, config.sample_size, seed=config.random_state)
    df = core_features(df, config, terms, slang, corrections)
    df = residual.with_residuals(df, key="message_id", dictionary=dictionary)
    labels = residual.residual_labels(df, config.residual_policy, tables=label_tables, classifier=classifier)
    if labels is not None:
        df = residual.apply_labels(df, labels, key="message_id")
    if config.sentiment_mode:
        df = sentiment.analyze_sentiment(df, config.sentiment_mode, backend=backend, valence=valence)
    out = annotate_messages(df, config, tagger=tagger)
    if not config.validate:
        return out
    kept = writers.kept(out, config.materialization, "silver")
    validate.validate_silver(kept, max_nonword=config.max_nonword_rate)
    return kept


def annotate_messages(df: DataFrame, config: PipelineConfig, *, tagger=None, emotion=None) -> DataFrame:
    """Linguistic, topic and emotion columns; those of an earlier run go first."""
    owned = [c for c in df.columns if c.startswith(("nlp_", "topic_", "emotion_"))]
    df = df.drop(*owned)
    if config.linguistic:
        from murmurate.functions.normalize import without_labels

        df = df.withColumns(linguistic.linguistic_features(without_labels(col("text_cleaned"))))
    if tagger is not None:
        df = linguistic.tagged_features(df, tagger)
    if config.topics:
        model = topics.fit_topics_on(
            df, sample=config.topic_sample, seed=config.random_state, topics=config.topic_count, max_features=config.topic_features, rounds=config.topic_rounds
        )
        df = topics.assign_topics(df, model)
    if emotion is not None:
        df = sentiment.score_emotion(df, emotion)
    return df


GOLD_KEYS = {
    "conversation": ["conversation_id"], "user": ["user"], "date": ["date_period"], "language": ["language_label"], "residual": ["residual_word"],
    "technical": ["technical_term", "technical_category"], "topic": ["topic_id", "topic_label"], "entity": ["entity_source", "entity_label", "entity"], "sample": ["message_id"],
}


def silver_to_gold(silver: DataFrame, level: str, *, check: bool = True, **options) -> tuple[DataFrame, dict]:
    """A gold level and what was checked of it."""
    out = gold_ops.gold(silver, level, **options)
    report: dict = {"gold_level": level, "schema_version": FEATURE_SCHEMA_VERSION, "options": {k: str(v) for k, v in options.items()}}
    if check and level != "sample":
        keys = GOLD_KEYS.get(level) or [out.columns[0]]
        conserved = {"conversation": silver, "date": silver.where("date IS NOT NULL") if "date" in silver.columns else None}.get(level)
        report["validation"] = validate.validate_gold(out, keys, conserved=conserved, null_keys=True)
    elif check:
        validate.validate_unique(out, ["message_id"], "gold sample")
    return out, report


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="murmurate", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("silver", "gold"):
        s = sub.add_parser(name)
        s.add_argument("--input-table"), s.add_argument("--input-path"), s.add_argument("--input-csv")
        s.add_argument("--output-table"), s.add_argument("--output-path")
        s.add_argument("--format", default="parquet"), s.add_argument("--mode", default="errorifexists", choices=writers.MODES)
        s.add_argument("--audit-path"), s.add_argument("--metrics-path")
        s.add_argument("--sample-size", type=int), s.add_argument("--random-state", type=int, default=42)
        s.add_argument("--materialization", default="auto", choices=writers.MATERIALIZATIONS)
    silver, g = sub.choices["silver"], sub.choices["gold"]
    silver.add_argument("--lexicon", required=True), silver.add_argument("--release-dates", default="")
    silver.add_argument("--residual-policy", default="manual_review", choices=residual.POLICIES)
    silver.add_argument("--slang", help="table of token, type, meaning"), silver.add_argument("--corrections", help="table of word, correction")
    silver.add_argument("--valence", help="table of word, valence"), silver.add_argument("--dictionary", help="table of word: words that are no residuals")
    for name in LABEL_TABLES:
        silver.add_argument(f"--labels-{name}", help="table of word (and label, for languages) for the policy reviewed")
    silver.add_argument("--sentiment", default="vader", choices=("none", "vader", "transformer", "both"))
    silver.add_argument("--topics", action="store_true"), silver.add_argument("--no-anonymize", action="store_true"), silver.add_argument("--no-linguistic", action="store_true")
    silver.add_argument("--topic-count", type=int, default=12), silver.add_argument("--topic-sample", type=int, help="fit on so many messages, not on all")
    silver.add_argument("--topic-features", type=int, default=20_000), silver.add_argument("--topic-rounds", type=int, default=400)
    silver.add_argument("--max-nonword-rate", type=float, default=0.25)
    g.add_argument("--level", required=True, choices=gold_ops.LEVELS)
    g.add_argument("--granularity", default="day"), g.add_argument("--channel-column", default="channel"), g.add_argument("--release-axis", default="since")
    return p


def word_tables(spark: SparkSession, a: argparse.Namespace) -> dict:
    """The tables that the command line names, as arguments of ``bronze_to_silver``."""
    read = lambda path: readers.read_lookup(spark, path)
    out: dict = {}
    if a.slang:
        out["slang"] = lexicons.slang_rows(read(a.slang))
    if a.corrections:
        out["corrections"] = lexicons.lookup_map(read(a.corrections), "word", "correction")
    if a.valence:
        out["valence"] = lexicons.lookup_map(read(a.valence), "word", "valence", "double")
    if a.dictionary:
        out["dictionary"] = read(a.dictionary)
    labels = {name: read(path) for name in LABEL_TABLES if (path := getattr(a, f"labels_{name}"))}
    if a.residual_policy == "reviewed":
        if missing := [f"--labels-{name}" for name in LABEL_TABLES if name not in labels]:
            raise ValueError(f"the policy reviewed needs {', '.join(missing)}")
        out["label_tables"] = labels
    elif labels:
        raise ValueError("label tables go with the policy reviewed")
    return out


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"murmurate-{a.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    source = readers.read_bronze(spark, table=a.input_table, path=a.input_path, csv=a.input_csv, fmt=a.format)
    target = a.output_table or a.output_path
    context = metrics.run_context(spark, f"to_{a.command}", input_name=a.input_table or a.input_path or a.input_csv, output_name=target, materialization=a.materialization)
    with metrics.Stopwatch() as clock:
        if a.command == "silver":
            config = PipelineConfig(
                anonymize=not a.no_anonymize, linguistic=not a.no_linguistic, topics=a.topics, residual_policy=a.residual_policy, sample_size=a.sample_size,
                sentiment_mode=None if a.sentiment == "none" else a.sentiment, random_state=a.random_state, max_nonword_rate=a.max_nonword_rate,
                materialization=a.materialization, topic_count=a.topic_count, topic_sample=a.topic_sample, topic_features=a.topic_features, topic_rounds=a.topic_rounds,
            )
            terms = lexicons.lexicon_rows(readers.read_path(spark, a.lexicon))
            df = bronze_to_silver(source, terms, config=config, releases=[x for x in a.release_dates.split(",") if x], **word_tables(spark, a))
            report = validate.validate_silver(df, max_nonword=a.max_nonword_rate) if config.validate else {"passed": True}
            writers.write(df, table=a.output_table, path=a.output_path, mode=a.mode, fmt=a.format)
            columns = len(df.columns)
        else:
            options = {"date": {"granularity": a.granularity}, "channel": {"column": a.channel_column}, "release": {"axis": a.release_axis}}.get(a.level, {})
            if a.level == "sample":
                options = {"n": a.sample_size or 1000, "seed": a.random_state}
            out, report = silver_to_gold(readers.read_silver(source), a.level, **options)
            writers.write_gold(out, table=a.output_table, path=a.output_path, fmt=a.format)
            columns = len(out.columns)
    written = (spark.table(target) if a.output_table else spark.read.format(a.format).load(target)).count()
    if a.audit_path:
        writers.append_audit_table(spark, stage=a.command, target=target, rows=written, columns=columns, passed=True, details=report, path=a.audit_path)
    if a.metrics_path:
        metrics.append_metrics(spark, [metrics.stage_metric(context, a.command, clock.seconds, rows_out=written, columns_out=columns)], path=a.metrics_path)
    print(json.dumps({"target": target, "rows": written, "seconds": round(clock.seconds, 3)}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
