"""The queries of the core: each takes a session and a folder of Parquet tables and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmurate.functions import normalize, structural
from murmurate.functions.probability import class_columns, normalized_probabilities
from murmurate.functions.temporal import calendar_fields, moment
from murmurate.operators import gold, joins, lexicons, linguistic, modeling, prepare, reports, residual, sentiment, statistics, topics, validate
from murmurate.operators.sessions import user_sessions
from murmurate.plans.pipeline import bronze_to_silver, silver_to_gold
from murmurate.schema import SENTIMENT_LABELS, as_timestamps, col
from murmurate.session import Scratch
from murmurate.sources import metrics, readers, writers
from murmurate.sources.adapters import messages_from_events, once_per_message
from murmurate.streaming.windows import run_available, windowed_counts
from murmurate.streaming.windows import streamed_sessions as sessions_of_stream

Query = Callable[[SparkSession, str], DataFrame]
DIGITS, NUDGE = 6, 1e-9


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return as_timestamps(spark.read.parquet(f"{d}/{name}.parquet"))


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, as sums in another order differ in the last ones.

    The nudge moves exact halves, which would round either way, to one side.
    """
    return df.withColumns({f.name: F.round(col(f.name) + F.lit(NUDGE), DIGITS) for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def silver(spark: SparkSession, d: str) -> DataFrame:
    return once_per_message(table(spark, d, "silver"))


def dated(spark: SparkSession, d: str) -> DataFrame:
    return silver(spark, d).where("date IS NOT NULL AND `from` IS NOT NULL AND conversation_id IS NOT NULL")


def bronze(spark: SparkSession, d: str) -> DataFrame:
    return prepare.with_conversation_id(prepare.clean_bronze(table(spark, d, "dialoguetext_196")))


def texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dialoguetext_196").select("row_id", F.coalesce("text", F.lit("")).alias("text_cleaned"))


def lexicon(spark: SparkSession, d: str):
    return lexicons.lexicon_rows(table(spark, d, "tech_lexicon"))


def calendar(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "release_calendar")


# --- sessions ------------------------------------------------------------------------------------


def p1_sessions(spark: SparkSession, d: str) -> DataFrame:
    return user_sessions(table(spark, d, "silver"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_sessions(spark, d).selectExpr("user_name", "first_event_id AS first_message_id", "last_event_id AS last_message_id")


# --- gold ------------------------------------------------------------------------------------------


def _gold(level: str, **options) -> Query:
    return lambda spark, d: rounded(gold.gold(silver(spark, d), level, **options))


def nullable_counts_as_doubles(df: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    """Whole numbers that may be missing, in the one type that all readers show alike."""
    whole = [c for c, t in df.dtypes if t in ("int", "bigint") and c.startswith(prefixes) and not c.endswith("message_count")]
    return df.withColumns({c: col(c).cast("double") for c in whole})


def gold_user(spark: SparkSession, d: str) -> DataFrame:
    return rounded(nullable_counts_as_doubles(gold.gold_user(silver(spark, d)), ("sent_", "received_")))


def gold_language(spark: SparkSession, d: str) -> DataFrame:
    """Scripts are labelled first, as silver's text still holds them."""
    s = silver(spark, d)
    return rounded(gold.gold_language(s.withColumn("text_cleaned", normalize.labelled_scripts(F.coalesce("text_cleaned", F.lit(""))))))


def gold_channel_events(spark: SparkSession, d: str) -> DataFrame:
    return rounded(gold.gold_channel(messages_from_events(table(spark, d, "events"))))


def gold_sample(spark: SparkSession, d: str) -> DataFrame:
    """A sample of a thousand messages is what this operator is for."""
    return gold.gold_sample(silver(spark, d), 1000, 42).select("message_id", "conversation_id", "text_cleaned")


# --- bronze preparation ----------------------------------------------------------------------------


def dedup_messages(spark: SparkSession, d: str) -> DataFrame:
    df = prepare.clean_bronze(table(spark, d, "dialoguetext_196"))
    return prepare.deduplicate(df, ("date", "from", "text"), ("row_id",)).select("row_id", "date", "from", "text")


def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    return prepare.with_message_id(bronze(spark, d)).select("row_id", "conversation_id", "message_id")


def participant_inference(spark: SparkSession, d: str) -> DataFrame:
    return prepare.infer_participants(bronze(spark, d), ("row_id",)).select("row_id", "from", "to")


def turn_features(spark: SparkSession, d: str) -> DataFrame:
    out = prepare.turn_features(dated(spark, d), ("message_id",))
    return rounded(out.select("message_id", "turn_count", "is_op", "response_gap_mins", "response_gap_mins_between_speakers"))


def user_activity(spark: SparkSession, d: str) -> DataFrame:
    return prepare.user_features(dated(spark, d), ("message_id",)).select("message_id", "user_message_count", "user_messages_this_month", "user_tier")


def conversation_bounds(spark: SparkSession, d: str) -> DataFrame:
    names = ["start", "end", "message_count", "participant_count", "duration_mins", "was_answered"]
    return rounded(prepare.conversation_features(dated(spark, d)).select("message_id", *[f"conversation_{n}" for n in names]))


def length_buckets(spark: SparkSession, d: str) -> DataFrame:
    df = texts(spark, d)
    df = df.withColumns(prepare.text_sizes(col("text_cleaned")))
    return prepare.size_buckets(df).select("row_id", "text_length", "word_count", "text_length_bucket", "word_count_bucket")


def gap_buckets(spark: SparkSession, d: str) -> DataFrame:
    out = prepare.size_buckets(prepare.turn_features(dated(spark, d), ("message_id",)))
    return out.groupBy("response_gap_bucket").agg(F.count("*").alias("messages"))


def message_calendar(spark: SparkSession, d: str) -> DataFrame:
    s = silver(spark, d).where("date IS NOT NULL").select("message_id", "date")
    return s.withColumns(calendar_fields(col("date"))).drop("date")


def parsed_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dialoguetext_196").select("row_id", moment(col("date")).alias("moment"))


def release_distance(spark: SparkSession, d: str) -> DataFrame:
    s = silver(spark, d).where("date IS NOT NULL").select("message_id", "date")
    return nullable_counts_as_doubles(prepare.with_release_distance(s, calendar(spark, d)).drop("date"), ("days_",))


def asof_calendar(spark: SparkSession, d: str) -> DataFrame:
    s = silver(spark, d).select("message_id", "date")
    return joins.asof_join(s, calendar(spark, d), left_on="date", right_on="release_date", values=["release_name"]).select("message_id", "release_name")


def asof_next_release(spark: SparkSession, d: str) -> DataFrame:
    s = silver(spark, d).select("message_id", "date")
    return joins.asof_join(s, calendar(spark, d), left_on="date", right_on="release_date", values=["release_name"], direction="forward").select("message_id", "release_name")


def prepared_bronze(spark: SparkSession, d: str) -> DataFrame:
    return rounded(nullable_counts_as_doubles(prepare.prepare_bronze(table(spark, d, "dialoguetext_196"), calendar(spark, d), ("row_id",)), ("days_",)))


def first_message(spark: SparkSession, d: str) -> DataFrame:
    return prepare.first_messages(dated(spark, d).select("conversation_id", "message_id", "date", "from")).select("conversation_id", "message_id")


def conversation_sample(spark: SparkSession, d: str) -> DataFrame:
    """A sample of whole conversations: 200 of them with every message."""
    return prepare.whole_conversation_sample(silver(spark, d), 200).select("conversation_id", "message_id")


# --- text ------------------------------------------------------------------------------------------


def anonymize_counts(spark: SparkSession, d: str) -> DataFrame:
    t = texts(spark, d).withColumn("text_cleaned", structural.anonymized(col("text_cleaned")))
    return t.withColumns(structural.placeholder_counts(col("text_cleaned")))


def structural_matches(spark: SparkSession, d: str) -> DataFrame:
    found = texts(spark, d).select("row_id", F.explode(structural.structural_matches(col("text_cleaned"))).alias("m"))
    return found.select("row_id", "m.match", "m.category")


def structural_tallies(spark: SparkSession, d: str) -> DataFrame:
    parts = [F.struct(F.lit(k).alias("category"), F.size(structural.matches(col("text_cleaned"), k)).alias("n")) for k in structural.TRACKED]
    return texts(spark, d).select(F.explode(F.array(*parts)).alias("x")).groupBy("x.category").agg(F.sum("x.n").alias("matches"))


def normalized_text(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).select("row_id", normalize.normalized(col("text_cleaned")).alias("text_cleaned"))


def script_labels(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).withColumn("text_cleaned", normalize.labelled_scripts(col("text_cleaned")))


def character_counts(spark: SparkSession, d: str) -> DataFrame:
    return normalize.character_counts(texts(spark, d), "text_cleaned")


def character_classes(spark: SparkSession, d: str) -> DataFrame:
    c = character_counts(spark, d).withColumn("class", normalize.character_class(col("ch")))
    return c.groupBy("class").agg(F.count("*").alias("characters"), F.sum("occurrences").alias("occurrences"))


def rare_characters(spark: SparkSession, d: str) -> DataFrame:
    return normalize.rare_characters_replaced(texts(spark, d), "text_cleaned")


def lexicon_matches(spark: SparkSession, d: str) -> DataFrame:
    found = texts(spark, d).select("row_id", F.explode(lexicons.term_matches(col("text_cleaned"), lexicon(spark, d))).alias("m"))
    return found.select("row_id", "m.term", "m.category")


def single_word_terms(spark: SparkSession, d: str) -> DataFrame:
    return lexicons.single_word_terms(texts(spark, d), table(spark, d, "tech_lexicon"), key="row_id", text="text_cleaned")


def slang_matches(spark: SparkSession, d: str) -> DataFrame:
    found = texts(spark, d).select("row_id", F.explode(lexicons.slang_matches(col("text_cleaned"))).alias("m"))
    return found.select("row_id", "m.token", "m.type", "m.meaning")


def glued_matches(spark: SparkSession, d: str) -> DataFrame:
    found = texts(spark, d).select("row_id", F.explode(lexicons.glued_matches(col("text_cleaned"), lexicon(spark, d))).alias("m"))
    return found.select("row_id", "m.*")


def glued_review(spark: SparkSession, d: str) -> DataFrame:
    found = texts(spark, d).select(lexicons.glued_matches(col("text_cleaned"), lexicon(spark, d)).alias("glued_matches"))
    return lexicons.glued_review(found).withColumn("examples", F.array_join("examples", " "))


def core_silver(spark: SparkSession, d: str) -> DataFrame:
    """Bronze to silver with its default options, one row per message; lists as JSON text."""
    out = bronze_to_silver(table(spark, d, "dialoguetext_196"), lexicon(spark, d), releases=calendar(spark, d), tie_break=("row_id",))
    lists = [f.name for f in out.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return rounded(nullable_counts_as_doubles(out.withColumns({c: F.to_json(col(c)) for c in lists}), ("days_",)))


def match_tallies(spark: SparkSession, d: str) -> DataFrame:
    return lexicons.match_tallies(silver(spark, d))


def token_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return residual.vocabulary(residual.with_candidates(texts(spark, d)))


def residual_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """Words that the lexicon and a dictionary of common words leave; the dictionary is the most used English words."""
    t = texts(spark, d).withColumn("tech_lexicon_matches", lexicons.term_matches(col("text_cleaned"), lexicon(spark, d)))
    words = spark.createDataFrame([(w,) for w in linguistic.STOPWORDS], "word string")
    return residual.residual_counts(t, dictionary=words)


def applied_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of residual words of silver, written into its text."""
    s = silver(spark, d).select("message_id", "text_cleaned", "residual_words")
    words = residual.vocabulary(s).select("word", F.lit("NONWORD").alias("label"))
    return residual.apply_labels(s, words, key="message_id").select("message_id", "text_cleaned")


def nonword_rate(spark: SparkSession, d: str) -> DataFrame:
    return rounded(residual.nonword_rate(applied_labels(spark, d)))


#: A few words by language, as a reviewer would list them.
REVIEWED_LANGUAGES = (("hola", "SPANISH"), ("gracias", "SPANISH"), ("pero", "SPANISH"), ("bonjour", "FRENCH"), ("merci", "FRENCH"), ("avec", "FRENCH"), ("danke", "GERMAN"), ("nicht", "GERMAN"), ("ciao", "ITALIAN"), ("sono", "ITALIAN"), ("obrigado", "PORTUGUESE"), ("niet", "DUTCH"), ("no", "SPANISH"))


def _review_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Jargon is the lexicon, non-words are words without vowel, known English the most used words; a word may be in several."""
    words = residual.vocabulary(residual.with_candidates(texts(spark, d)))
    return {
        "jargon": table(spark, d, "tech_lexicon").select(F.col("term").alias("word")).where("word IS NOT NULL"),
        "languages": spark.createDataFrame(REVIEWED_LANGUAGES, "word string, label string"),
        "nonwords": words.where(~col("word").rlike("[aeiouy]")).select("word"),
        "english": spark.createDataFrame([(w,) for w in linguistic.STOPWORDS], "word string"),
    }


def reviewed_labels(spark: SparkSession, d: str) -> DataFrame:
    """Every word of the messages with its label by the precedence of the reviewed tables."""
    words = residual.vocabulary(residual.with_candidates(texts(spark, d)))
    return residual.reviewed_labels(words, **_review_tables(spark, d))


def residual_lists(spark: SparkSession, d: str) -> DataFrame:
    """The residual words of each message, as text."""
    t = texts(spark, d).withColumn("tech_lexicon_matches", lexicons.term_matches(col("text_cleaned"), lexicon(spark, d)))
    words = spark.createDataFrame([(w,) for w in linguistic.STOPWORDS], "word string")
    out = residual.with_residuals(Scratch(spark, "residuals").write(t, "matched"), key="row_id", dictionary=words)
    return out.select("row_id", F.array_join("residual_words", " ").alias("words"), "has_residual")


def reviewed_text(spark: SparkSession, d: str) -> DataFrame:
    """Messages with the reviewed labels written in; jargon, numbers and uncertain words stay."""
    return residual.apply_labels(texts(spark, d), reviewed_labels(spark, d), key="row_id").select("row_id", "text_cleaned")


def batch_labels(spark: SparkSession, d: str) -> DataFrame:
    tables = _review_tables(spark, d)
    words = residual.vocabulary(residual.with_candidates(texts(spark, d)))
    return residual.batch_labels(words, tables["languages"], tables["jargon"])


def review_export(spark: SparkSession, d: str) -> DataFrame:
    return residual.review_export(silver(spark, d))


def slang_review(spark: SparkSession, d: str) -> DataFrame:
    """Usual and ambiguous slang together, counted by token."""
    found = texts(spark, d).select(F.explode(lexicons.slang_matches(col("text_cleaned"), include_review=True)).alias("m"))
    return found.groupBy(F.col("m.token").alias("token"), F.col("m.type").alias("type")).agg(F.count("*").alias("occurrences"))


def raw_structure_counts(spark: SparkSession, d: str) -> DataFrame:
    """Kinds that could be anonymized, counted in the text as it came."""
    return texts(spark, d).withColumns(structural.raw_counts(col("text_cleaned"))).drop("text_cleaned")


def all_match_tallies(spark: SparkSession, d: str) -> DataFrame:
    """Technical terms, slang, glued terms, structures and placeholders over all messages."""
    t, rows = texts(spark, d), lexicon(spark, d)
    clean = structural.anonymized(col("text_cleaned"))
    t = t.withColumns(
        {
            "tech_lexicon_matches": lexicons.term_matches(col("text_cleaned"), rows), "slang_matches": lexicons.slang_matches(col("text_cleaned")),
            "glued_matches": lexicons.glued_matches(col("text_cleaned"), rows), "structural_matches": structural.structural_matches(col("text_cleaned")), "__clean": clean,
        }
    ).withColumns(structural.placeholder_counts(F.col("__clean")))
    return lexicons.match_tallies(Scratch(spark, "tallies").write(t, "matches"))


def contractions(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).withColumn("text_cleaned", normalize.repaired_contractions(F.regexp_replace("text_cleaned", "(?i)n't", "n't't")))


# --- sentiment, language, topics ---------------------------------------------------------------------


def sentiment_scores(spark: SparkSession, d: str) -> DataFrame:
    return sentiment.score_vader(texts(spark, d)).drop("text_cleaned")


def backend_agreement(spark: SparkSession, d: str) -> DataFrame:
    return rounded(sentiment.backend_agreement(silver(spark, d)))


def linguistic_features(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).withColumns(linguistic.linguistic_features(col("text_cleaned"))).drop("text_cleaned")


def probability_measures(spark: SparkSession, d: str) -> DataFrame:
    """Entropy, margin, label and expected sentiment from the class probabilities in silver, made to sum to 1."""
    parts = ["transformer_negative", "transformer_neutral", "transformer_positive"]
    s = silver(spark, d).where(" AND ".join(f"{c} IS NOT NULL" for c in parts)).select("message_id", *parts)
    p = s.withColumn("p", normalized_probabilities([col(c) for c in parts], 0.01))
    out = p.select("message_id", *[c.alias(n) for n, c in class_columns("model", SENTIMENT_LABELS, col("p")).items()])
    return rounded(out.withColumn("expected_sentiment", col("model_positive") - col("model_negative")))


def topic_assign(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("message_id"), F.coalesce("text", F.lit("")).alias("text_cleaned"))
    return topics.assign_topics(docs, topics.fit_topics_on(docs)).drop("text_cleaned")


# --- statistics and reports ---------------------------------------------------------------------------

NUMBERS = ["text_length", "word_count", "vader_compound", "transformer_score"]


def describe_numeric(spark: SparkSession, d: str) -> DataFrame:
    return rounded(statistics.describe(silver(spark, d), NUMBERS))


def shape_numeric(spark: SparkSession, d: str) -> DataFrame:
    out = statistics.shape(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.withColumns({c: F.round(c, 4) for c in ("skewness", "kurtosis")})


def outliers(spark: SparkSession, d: str) -> DataFrame:
    return rounded(statistics.outliers(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"]))


def pearson_matrix(spark: SparkSession, d: str) -> DataFrame:
    return rounded(statistics.pearson(silver(spark, d), NUMBERS))


def spearman_matrix(spark: SparkSession, d: str) -> DataFrame:
    return rounded(statistics.spearman(silver(spark, d), NUMBERS[:3]))


def inflation(spark: SparkSession, d: str) -> DataFrame:
    return rounded(statistics.vif(silver(spark, d), NUMBERS))


def answer_tests(spark: SparkSession, d: str) -> DataFrame:
    """Whether text length and topic differ between first messages with and without answer, with Holm's correction."""
    f = _with_answer(spark, d)
    u = statistics.mann_whitney(f, "text_length", "answered")
    c = statistics.chi_square(f, "topic_label", "answered", 30)
    rows = [("text_length", "mann_whitney", float(u["u"] or 0), u["p_value"]), ("topic", "chi_square", float(c["chi2"] or 0), c["p_value"])]
    return rounded(statistics.holm(spark.createDataFrame(rows, "hypothesis string, test string, statistic double, p_value double")))


def _with_answer(spark: SparkSession, d: str) -> DataFrame:
    s = dated(spark, d)
    answered = s.groupBy("conversation_id").agg((F.count_distinct("from") > 1).alias("answered"))
    first = prepare.first_messages(s.select("conversation_id", "message_id", "date", "text_length", "word_count", "vader_compound", "channel", "topic_label"))
    return first.join(answered, "conversation_id")


def confusion(spark: SparkSession, d: str) -> DataFrame:
    return statistics.confusion(silver(spark, d), "transformer_label", "vader_label")


def evaluation_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The transformer's probabilities in silver against the rule-based label as if it were gold."""
    parts = [f"transformer_{x}" for x in ("negative", "neutral", "positive")]
    s = silver(spark, d).where(" AND ".join(f"{c} IS NOT NULL" for c in ["transformer_label", *parts]))
    # The stored probabilities are rounded; they are made to sum to 1 again.
    total = sum([col(c) for c in parts[1:]], col(parts[0]))
    m = statistics.evaluate_labels(s.withColumns({c: col(c) / total for c in parts}), "vader_label", "transformer")
    names = ("coverage", "accuracy", "macro_f1", "balanced_accuracy", "multiclass_brier_score", "log_loss", "expected_calibration_error")
    return rounded(spark.createDataFrame([(n, float(m[n])) for n in names], "metric string, value double"))


def answer_model(spark: SparkSession, d: str) -> DataFrame:
    """Test metrics of a balanced logistic model and of the prior, from first messages alone."""
    f = _with_answer(spark, d).withColumns({"label": col("answered").cast("double"), "channel": F.coalesce("channel", F.lit("none"))})
    f = Scratch(spark, "model").write(modeling.balanced_weights(modeling.stratified_split(f)), "table")
    train, test = f.where("part = 'train'"), f.where("part = 'test'")
    ready, stages = modeling.preprocessing(train, ["text_length", "word_count", "vader_compound"], ["channel"])
    model = modeling.fit(ready(train), stages, maxIter=20)
    rows = []
    for name, scored in (("logistic", modeling.scored(model, ready(test))), ("prior", modeling.prior_scores(test, train))):
        m = modeling.ranking_metrics(scored)
        rows.append((name, m["roc_auc"], m["average_precision"]))
    return spark.createDataFrame(rows, "model string, roc_auc double, average_precision double")


def summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.gold_conversation(silver(spark, d))


def key_figures(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reports.key_figures(summary(spark, d)))


def topic_answer_rates(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reports.topic_answer_rates(summary(spark, d)))


def topic_priorities(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reports.topic_priorities(reports.topic_answer_rates(summary(spark, d), top=None)))


def monthly_sentiment(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reports.weighted_monthly_sentiment(summary(spark, d)))


def conversation_buckets(spark: SparkSession, d: str) -> DataFrame:
    return reports.conversation_buckets(summary(spark, d))


def user_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reports.user_profile(dated(spark, d)))


def ended_by_opener(spark: SparkSession, d: str) -> DataFrame:
    return reports.ended_by_opener(dated(spark, d))


def weekday_by_hour(spark: SparkSession, d: str) -> DataFrame:
    return reports.weekday_by_hour(silver(spark, d))


def cross_tab(spark: SparkSession, d: str) -> DataFrame:
    return reports.cross_tab(_with_answer(spark, d), "topic_label", "answered")


def release_bucket_measures(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reports.by_bucket(silver(spark, d), "days_since_release_bucket", ["text_length", "word_count"]))


def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reports.value_counts(silver(spark, d), "channel"))


def multiparty(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reports.multiparty(silver(spark, d)))


def monthly_volume(spark: SparkSession, d: str) -> DataFrame:
    return reports.monthly_volume(silver(spark, d))


def duplicate_figures(spark: SparkSession, d: str) -> DataFrame:
    return reports.duplicate_figures(prepare.clean_bronze(table(spark, d, "dialoguetext_196")), ["date", "from", "text"], "folder")


def most_common(spark: SparkSession, d: str) -> DataFrame:
    """The twenty busiest senders: a top-k report."""
    return reports.most_common(silver(spark, d), "from", 20)


def missing_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(statistics.missing_report(silver(spark, d).select("channel", "topic_id", "transformer_score", "vader_label", "date")))


def participants_melted(spark: SparkSession, d: str) -> DataFrame:
    m = silver(spark, d).select("message_id", "from", "to").unpivot("message_id", ["from", "to"], "role", "person").where("person IS NOT NULL")
    return m.groupBy("role").agg(F.count("*").alias("rows"), F.count_distinct("person").alias("people"))


def release_rollup(spark: SparkSession, d: str) -> DataFrame:
    r = silver(spark, d).rollup("days_since_release_bucket", "channel")
    return r.agg(F.count("*").alias("message_count"), F.grouping_id().cast("bigint").alias("level"))


def silver_violations(spark: SparkSession, d: str) -> DataFrame:
    s = silver(spark, d)
    checks = {
        "tech_count_differs": F.coalesce(F.size("tech_lexicon_matches"), F.lit(0)) != col("tech_lexicon_match_count"),
        "compound_range": F.abs("vader_compound") > 1,
        "probability_sum": F.abs(col("transformer_negative") + col("transformer_neutral") + col("transformer_positive") - 1) > 0.01,
        "topic_half_set": col("topic_id").isNull() != col("topic_label").isNull(),
    }
    return validate.violations(s, checks)


def transformer_checks(spark: SparkSession, d: str) -> DataFrame:
    """The library's own checks of a distribution over the labels, at a tolerance that rounded values fail."""
    parts = ["transformer_negative", "transformer_neutral", "transformer_positive"]
    return validate.violations(silver(spark, d), validate.distribution_checks("transformer", parts, SENTIMENT_LABELS, 1e-5))


def core_validation(spark: SparkSession, d: str) -> DataFrame:
    """What the validation of core silver counts; a violation would be an error."""
    out = bronze_to_silver(table(spark, d, "dialoguetext_196"), lexicon(spark, d), tie_break=("row_id",), validate=False, materialization="none")
    counts = validate.validate_silver(Scratch(spark, "core").write(out, "core"))
    rows = [(k, float(v)) for k, v in counts.items() if isinstance(v, (int, float)) and not isinstance(v, bool) and k not in ("tokens", "nonword_rate")]
    return spark.createDataFrame(rows, "what string, n double")


def gold_validation(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every gold level that passed its validation."""
    s = Scratch(spark, "gold").write(silver(spark, d), "silver")
    rows = []
    for level in ("conversation", "user", "date", "channel", "release", "residual", "technical", "topic"):
        _, report = silver_to_gold(s, level)
        rows.append((level, report["validation"]["rows"]))
    return spark.createDataFrame(rows, "level string, rows bigint")


def bad_json_cells(spark: SparkSession, d: str) -> DataFrame:
    s = silver(spark, d)
    cells = F.when(col("message_id") % 7 == 0, F.concat(F.lit("x"), col("named_entities"))).otherwise(col("named_entities"))
    return s.agg(F.count("*").alias("rows"), F.count_if(validate.json_guard(cells, "array<struct<text:string,label:string>>")).alias("malformed"))


def collection_cells(spark: SparkSession, d: str) -> DataFrame:
    """Lists written as JSON or as program literals, read back."""
    s = silver(spark, d).select("message_id", "residual_words")
    literal = F.when(col("residual_words").isNotNull(), F.concat(F.lit("['"), F.array_join("residual_words", "', '"), F.lit("']")))
    cell = F.when((col("message_id") % 2 == 0) & (F.size("residual_words") > 0), literal).otherwise(F.to_json("residual_words"))
    return s.select("message_id", F.array_join(readers.collection(cell, "array<string>", "residual_words"), " ").alias("words"))


def minute_dates(spark: SparkSession, d: str) -> DataFrame:
    return prepare.to_minutes(silver(spark, d).select("message_id", "date"))


def filtered_summary(spark: SparkSession, d: str) -> DataFrame:
    """Answered conversations of 2010 to 2012, as a dashboard would filter them."""
    return reports.filter_summary(summary(spark, d), start="2010-01-01", end="2012-12-31", answered=True).select("conversation_id", "message_count")


def longest_messages(spark: SparkSession, d: str) -> DataFrame:
    """The ten longest messages: a top-k report."""
    return reports.largest(silver(spark, d).select("message_id", "text_length"), "text_length", 10, ("message_id",))


def clipped_lengths(spark: SparkSession, d: str) -> DataFrame:
    kept = reports.clipped_at_p99(silver(spark, d).select("message_id", "text_length"), "text_length")
    return kept.agg(F.count("*").alias("rows"), F.max("text_length").alias("longest"))


def feature_transforms(spark: SparkSession, d: str) -> DataFrame:
    """Which transform each number would get by its skewness, and what the power transform makes of it."""
    s = silver(spark, d)
    means = s.agg(*[F.avg(statistics.yeo_johnson(col(c).cast("double"), 0.5)).alias(c) for c in NUMBERS]).first()
    skews = {r["feature"]: r["skewness"] for r in statistics.shape(s, NUMBERS).collect()}
    rows = [(c, statistics.chosen_transform(skews[c]), float(means[c])) for c in NUMBERS]
    return rounded(spark.createDataFrame(rows, "feature string, transform string, mean_power double"))


def topic_dummies(spark: SparkSession, d: str) -> DataFrame:
    s = silver(spark, d)
    values = ("NEGATIVE", "NEUTRAL", "POSITIVE")
    out = statistics.dummies(s, "vader_label", values)
    return out.agg(*[F.sum(f"vader_label_{v}").alias(v.lower()) for v in values[1:]])


def eligible_features(spark: SparkSession, d: str) -> DataFrame:
    s = silver(spark, d).withColumn("constant", F.lit(1))
    found = statistics.eligible_features(s, ["text_length", "word_count", "constant", "channel", "absent", "vader_compound"])
    return spark.createDataFrame([(c,) for c in found], "feature string")


def model_rows(spark: SparkSession, d: str) -> DataFrame:
    """The leakage-safe model table with its split by hash."""
    rows = modeling.model_table(prepare.conversation_features(dated(spark, d).select("conversation_id", "message_id", "date", "from", "to", "text_length")))
    return modeling.stratified_split(rows).select("message_id", "label", "part", "text_length")


def ranking_quality(spark: SparkSession, d: str) -> DataFrame:
    """How well the transformer's positive probability finds messages that the rules call positive."""
    s = silver(spark, d).where("transformer_positive IS NOT NULL AND vader_label IS NOT NULL")
    s = s.select(col("transformer_positive").alias("score"), (col("vader_label") == "POSITIVE").cast("double").alias("label"))
    m = modeling.ranking_metrics(s)
    t = modeling.threshold_metrics(s, 0.5)
    rows = [(k, float(m[k])) for k in ("roc_auc", "average_precision", "best_f1")] + [(k, float(v)) for k, v in t.items()]
    return rounded(spark.createDataFrame(rows, "metric string, value double"))


def stage_metrics(spark: SparkSession, d: str) -> DataFrame:
    """A metric row as it is appended and read again; rows in and out come from the tables."""
    n, m = table(spark, d, "dialoguetext_196").count(), table(spark, d, "silver").count()
    path = Scratch(spark, "metrics").path("metrics")
    row = metrics.stage_metric(metrics.run_context(spark, "check"), "stage", 2.5, rows_in=n, rows_out=m)
    metrics.append_metrics(spark, [row], path=path)
    return rounded(spark.read.parquet(path).select("pipeline", "stage", "status", "rows_in", "rows_out", "seconds", "rows_per_second", "ms_per_row_in", "ms_per_row_out"))


def streamed_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of the events' users as a stream closes them; those still open when the input ends are not emitted."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    scratch = Scratch(spark, "stream")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    sink = scratch.path("sessions")
    run_available(sessions_of_stream(messages_from_events(stream)), sink, scratch.path("progress"))
    return spark.read.schema("user_name string, session_start timestamp, session_end timestamp, event_count bigint").parquet(sink)


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Bronze written as CSV and read again with its schema; NULL and empty text are one in CSV."""
    df = table(spark, d, "dialoguetext_196").select(*[F.nullif(col(c).cast("string"), F.lit("")).alias(c) for c in ("row_id", "folder", "dialogue_id", "date", "from", "to", "text")])
    folder = Scratch(spark, "csv").root
    path = writers.write_csv(df, folder, "bronze")
    return readers.read_csv(spark, path, df.schema)


def stream_daily_counts(spark: SparkSession, d: str) -> DataFrame:
    """Daily counts of events by a stream that is run until its input is read, then read from its last state."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    source = Scratch(spark, "stream")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    counts = windowed_counts(messages_from_events(stream)).drop("approx_senders")
    out = source.path("counts")
    q = counts.writeStream.outputMode("complete").option("checkpointLocation", source.path("progress")).trigger(availableNow=True)
    q.foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(out)).start().awaitTermination()
    return spark.read.parquet(out)


def queries() -> dict[str, Query]:
    return {
        "p1_found": p1_found, "p1_sessions": p1_sessions,
        "gold_conversation": _gold("conversation"), "gold_user": gold_user,
        "gold_date_day": _gold("date", granularity="day"), "gold_date_week": _gold("date", granularity="week"), "gold_date_month": _gold("date", granularity="month"),
        "gold_channel": _gold("channel"), "gold_channel_events": gold_channel_events,
        "gold_release_since": _gold("release", axis="since"), "gold_release_until": _gold("release", axis="until"),
        "gold_language": gold_language, "gold_residual": _gold("residual"), "gold_technical": _gold("technical"), "gold_topic": _gold("topic"),
        "gold_entity": _gold("entity"), "gold_sample": gold_sample,
        "dedup_messages": dedup_messages, "stable_ids": stable_ids, "participant_inference": participant_inference, "turn_features": turn_features,
        "user_activity": user_activity, "conversation_bounds": conversation_bounds, "length_buckets": length_buckets, "gap_buckets": gap_buckets,
        "message_calendar": message_calendar, "parsed_dates": parsed_dates, "release_distance": release_distance, "asof_calendar": asof_calendar,
        "asof_next_release": asof_next_release, "prepared_bronze": prepared_bronze, "first_message": first_message, "conversation_sample": conversation_sample,
        "anonymize_counts": anonymize_counts, "structural_matches": structural_matches, "structural_tallies": structural_tallies,
        "normalized_text": normalized_text, "script_labels": script_labels, "character_counts": character_counts, "character_classes": character_classes,
        "rare_characters": rare_characters, "lexicon_matches": lexicon_matches, "single_word_terms": single_word_terms, "slang_matches": slang_matches,
        "glued_matches": glued_matches, "glued_review": glued_review, "core_silver": core_silver, "match_tallies": match_tallies,
        "token_vocabulary": token_vocabulary, "residual_vocabulary": residual_vocabulary, "applied_labels": applied_labels, "nonword_rate": nonword_rate,
        "sentiment_scores": sentiment_scores, "backend_agreement": backend_agreement, "linguistic_features": linguistic_features, "topic_assign": topic_assign,
        "describe_numeric": describe_numeric, "shape_numeric": shape_numeric, "outliers": outliers, "pearson_matrix": pearson_matrix,
        "spearman_matrix": spearman_matrix, "inflation": inflation, "answer_tests": answer_tests, "confusion": confusion, "evaluation_metrics": evaluation_metrics, "answer_model": answer_model,
        "key_figures": key_figures, "topic_answer_rates": topic_answer_rates, "topic_priorities": topic_priorities, "monthly_sentiment": monthly_sentiment,
        "conversation_buckets": conversation_buckets, "user_profile": user_profile, "ended_by_opener": ended_by_opener, "weekday_by_hour": weekday_by_hour,
        "cross_tab": cross_tab, "release_bucket_measures": release_bucket_measures, "value_counts": value_counts, "multiparty": multiparty,
        "monthly_volume": monthly_volume, "duplicate_figures": duplicate_figures, "most_common": most_common, "missing_report": missing_report,
        "participants_melted": participants_melted, "release_rollup": release_rollup, "silver_violations": silver_violations,
        "csv_round_trip": csv_round_trip, "stream_daily_counts": stream_daily_counts, "streamed_sessions": streamed_sessions,
        "residual_lists": residual_lists, "reviewed_labels": reviewed_labels, "reviewed_text": reviewed_text, "batch_labels": batch_labels, "review_export": review_export, "slang_review": slang_review,
        "raw_structure_counts": raw_structure_counts, "all_match_tallies": all_match_tallies, "contractions": contractions, "probability_measures": probability_measures,
        "transformer_checks": transformer_checks, "core_validation": core_validation, "gold_validation": gold_validation, "bad_json_cells": bad_json_cells,
        "collection_cells": collection_cells, "minute_dates": minute_dates, "filtered_summary": filtered_summary, "longest_messages": longest_messages, "clipped_lengths": clipped_lengths,
        "feature_transforms": feature_transforms, "topic_dummies": topic_dummies, "eligible_features": eligible_features, "model_rows": model_rows, "ranking_quality": ranking_quality, "stage_metrics": stage_metrics,
    }
