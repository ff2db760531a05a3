"""Silver messages aggregated to the eleven gold levels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmurate.functions.temporal import minutes_between, period_start
from murmurate.operators.prepare import seeded_sample
from murmurate.schema import EMOTION_LABELS, LANGUAGE_LABELS, SENTIMENT_LABELS, SENTINELS, col, require

# The columns that are averaged, summed and counted by label, with their names in gold.
AVERAGES = {
    "text_length": "avg_text_length", "word_count": "avg_word_count",
    "response_gap_mins_between_speakers": "avg_response_gap_mins_between_speakers",
    "vader_compound": "avg_vader_compound", "vader_negative": "avg_vader_negative",
    "vader_neutral": "avg_vader_neutral", "vader_positive": "avg_vader_positive",
    "transformer_expected_sentiment": "avg_transformer_expected_sentiment",
    "transformer_negative": "avg_transformer_negative", "transformer_neutral": "avg_transformer_neutral",
    "transformer_positive": "avg_transformer_positive", "transformer_score": "avg_transformer_confidence",
    "transformer_normalized_entropy": "avg_transformer_normalized_entropy",
    "emotion_score": "avg_emotion_confidence", "emotion_normalized_entropy": "avg_emotion_normalized_entropy",
    "topic_score": "avg_topic_confidence", "topic_entropy": "avg_topic_entropy",
}
SUMS = {
    "tech_lexicon_match_count": "total_tech_lexicon_matches", "slang_match_count": "total_slang_matches",
    "glued_match_count": "total_glued_matches", "named_entity_count": "total_named_entities",
}
LABELS = {"vader_label": SENTIMENT_LABELS, "transformer_label": SENTIMENT_LABELS, "emotion_label": EMOTION_LABELS}
DISTINCTS = {"conversation_id": "unique_conversations", "from": "unique_senders", "to": "unique_recipients"}

LEVELS = ("conversation", "user", "date", "channel", "release", "language", "residual", "technical", "topic", "entity", "sample")


def base_metrics(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The metrics of every gold level that the columns present allow, for one pass over the rows.

    Averages and shares leave NULL out, sums of nothing are 0, and of equally
    frequent labels the smallest is the most common.
    """
    have = set(df.columns)
    out = [F.count("*").alias("message_count")]
    out += [F.avg(col(s)).alias(t) for s, t in AVERAGES.items() if s in have]
    out += [F.coalesce(F.sum(col(s)), F.lit(0)).cast("bigint").alias(t) for s, t in SUMS.items() if s in have]
    out += [F.count_distinct(col(s)).alias(t) for s, t in DISTINCTS.items() if s in have and s not in keys]
    for label, values in LABELS.items():
        if label in have:
            out.append(F.mode(col(label), True).alias(f"most_common_{label}"))
            share = lambda v, c=col(label): F.avg(F.when(c.isNotNull(), (c == v).cast("int")))
            out += [share(v).alias(f"{label.removesuffix('_label')}_{v.lower()}_share") for v in values]
    if "topic_label" in have and "topic_label" not in keys:
        out.append(F.mode(col("topic_label"), True).alias("most_common_topic"))
    return out


def aggregate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Base metrics per key; a NULL key is a group of its own."""
    require(df, list(keys), "gold aggregation")
    return df.groupBy(*[col(k) for k in keys]).agg(*base_metrics(df, keys))


def prefixed(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) if c in keys else col(c).alias(f"{prefix}{c}") for c in df.columns])


def participants(include_sentinels: bool = False) -> Column:
    """Distinct people among senders and recipients, as an aggregate over exploded rows."""
    people = F.col("__person")
    return F.count_distinct(people if include_sentinels else F.when(~people.isin(*SENTINELS), people))


def gold_conversation(df: DataFrame, include_sentinels: bool = False) -> DataFrame:
    """One row per conversation with bounds, duration, participants and whether it was answered.

    Participants and answer come from a second, narrow aggregation, so that the
    wide rows are not multiplied by two people each.
    """
    require(df, ["conversation_id"], "conversation gold")
    extra = []
    if "date" in df.columns:
        extra = [F.min("date").alias("conversation_start"), F.max("date").alias("conversation_end")]
    out = df.groupBy("conversation_id").agg(*base_metrics(df, ["conversation_id"]), *extra)
    if extra:
        out = out.withColumn("conversation_duration_mins", minutes_between(col("conversation_end"), col("conversation_start")))
    people = [c for c in ("from", "to") if c in df.columns]
    if people:
        exploded = df.select("conversation_id", F.explode(F.array(*[col(c) for c in people])).alias("__person"))
        counted = exploded.groupBy("conversation_id").agg(participants(include_sentinels).alias("participant_count"))
        out = out.join(counted.withColumnRenamed("conversation_id", "__id"), col("conversation_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    answered = (col("unique_senders") > 1) if "from" in df.columns else F.lit(False)
    return out.withColumn("conversation_was_answered", answered)


def gold_user(df: DataFrame) -> DataFrame:
    """Sent and received metrics per user (full outer), interactions and distinct contacts."""
    require(df, ["from", "to"], "user gold")
    metrics = lambda side: prefixed(
        df.where(col(side).isNotNull()).groupBy(col(side).alias("user")).agg(*base_metrics(df, [side])),
        {"from": "sent_", "to": "received_"}[side], ["user"],
    )
    both = metrics("from").join(metrics("to"), "user", "full")
    pairs = df.select(col("from").alias("a"), col("to").alias("b")).where("a IS NOT NULL AND b IS NOT NULL").distinct()
    contacts = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy(F.col("a").alias("user"))
    both = both.join(contacts.agg(F.count_distinct("b").alias("unique_contacts")), "user", "left")
    both = both.withColumns({c: F.coalesce(col(c), F.lit(0)) for c in both.columns if c.endswith("message_count") or c == "unique_contacts"})
    return both.withColumn("total_interactions", col("sent_message_count") + col("received_message_count"))


def gold_date(df: DataFrame, granularity: str = "day") -> DataFrame:
    """Per UTC day, week (from Monday) or month; messages without date are left out."""
    require(df, ["date"], "date gold")
    return aggregate(df.where("date IS NOT NULL").withColumn("date_period", period_start(col("date"), granularity)), ["date_period"])


def gold_channel(df: DataFrame, column: str = "channel") -> DataFrame:
    require(df, [column], "channel gold")
    return aggregate(df.where(col(column).isNotNull()), [column])


def gold_release(df: DataFrame, axis: str = "since") -> DataFrame:
    if axis not in ("since", "until"):
        raise ValueError("axis must be since or until")
    return aggregate(df, [f"days_{axis}_release_bucket"])


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?U)\w+(?:['-]\w+)*"), F.lit(0))


def gold_language(df: DataFrame) -> DataFrame:
    """Per language label found in the text; a message with several counts in each, with none as UNLABELED."""
    require(df, ["text_cleaned"], "language gold")
    found = F.array_intersect(F.array(*[F.lit(x) for x in LANGUAGE_LABELS]), _tokens(F.coalesce(col("text_cleaned"), F.lit(""))))
    labels = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("UNLABELED")))
    return aggregate(df.withColumn("language_label", F.explode(labels)), ["language_label"])


def terms_of(df: DataFrame, column: str, fields: Sequence[str]) -> Column:
    """An array column as ``array<struct<fields>>``: from structs, from arrays of strings, or from strings.

    Any other type is a TypeError.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType):
        item = kind.elementType
        if isinstance(item, T.StructType):
            names = item.fieldNames()
            pick = lambda x: F.struct(*[(x[f] if f in names else F.lit(None).cast("string")).alias(f) for f in fields])
            return F.transform(col(column), pick)
        if isinstance(item, T.ArrayType):
            return F.transform(col(column), lambda x: F.struct(*[F.get(x, F.lit(i)).alias(f) for i, f in enumerate(fields)]))
        if isinstance(item, T.StringType):
            return F.transform(col(column), lambda x: F.struct(x.alias(fields[0]), *[F.lit(None).cast("string").alias(f) for f in fields[1:]]))
    raise TypeError(f"{column} has type {kind.simpleString()}, expected an array of structs, arrays or strings")


def gold_residual(df: DataFrame) -> DataFrame:
    """Per unresolved word as written; a repeated word counts each time."""
    words = F.transform(terms_of(df, "residual_words", ["word"]), lambda x: x["word"])
    return aggregate(df.withColumn("residual_word", F.explode(words)).where("residual_word IS NOT NULL"), ["residual_word"])


def _technical(df: DataFrame) -> DataFrame:
    exploded = df.withColumn("__t", F.explode(terms_of(df, "tech_lexicon_matches", ["term", "category"]))).where("__t.term IS NOT NULL")
    return exploded.withColumns({"technical_term": F.col("__t.term"), "technical_category": F.coalesce(F.col("__t.category"), F.lit("UNKNOWN"))}).drop("__t")


def gold_technical(df: DataFrame) -> DataFrame:
    """Per technical term as matched and its category, UNKNOWN if it has none."""
    return aggregate(_technical(df), ["technical_term", "technical_category"])


def gold_topic(df: DataFrame) -> DataFrame:
    require(df, ["topic_id", "topic_label"], "topic gold")
    return aggregate(df.where("topic_id IS NOT NULL AND topic_label IS NOT NULL"), ["topic_id", "topic_label"])


def parsed_entities(df: DataFrame, column: str = "named_entities") -> Column:
    """Entities as ``array<struct<text,label>>``; text that is no JSON list fails."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        return terms_of(df, column, ["text", "label"])
    text = F.nullif(F.trim(col(column)), F.lit(""))
    parsed = F.from_json(text, "array<struct<text:string,label:string>>", {"mode": "PERMISSIVE"})
    broken = text.isNotNull() & (parsed.isNull() | ~text.startswith("["))
    return F.when(broken, F.raise_error(F.concat(F.lit(f"malformed JSON in {column}: "), F.substring(text, 1, 100)))).otherwise(parsed)


def gold_entity(df: DataFrame) -> DataFrame:
    """Per entity of the technical lexicon and of named entities, with its source and label."""
    parts = []
    if "tech_lexicon_matches" in df.columns:
        parts.append(_technical(df).withColumns({"entity_source": F.lit("technical_lexicon"), "entity_label": col("technical_category"), "entity": col("technical_term")}).drop("technical_term", "technical_category"))
    if "named_entities" in df.columns:
        named = df.withColumn("__e", F.explode(parsed_entities(df))).where("__e.text IS NOT NULL")
        parts.append(named.withColumns({"entity_source": F.lit("spacy_ner"), "entity_label": F.col("__e.label"), "entity": F.col("__e.text")}).drop("__e"))
    if not parts:
        raise KeyError("entity gold needs tech_lexicon_matches or named_entities")
    stacked = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return aggregate(stacked, ["entity_source", "entity_label", "entity"])


def gold_sample(df: DataFrame, n: int = 1000, seed: int | str = 42) -> DataFrame:
    """``n`` silver rows in stable hash order."""
    return seeded_sample(df, n, "message_id", seed)


def gold(df: DataFrame, level: str, **options) -> DataFrame:
    """The gold table of a level; an unknown one is a ValueError."""
    levels: dict[str, Callable[..., DataFrame]] = {
        "conversation": gold_conversation, "user": gold_user, "date": gold_date, "channel": gold_channel, "release": gold_release,
        "language": gold_language, "residual": gold_residual, "technical": gold_technical, "topic": gold_topic, "entity": gold_entity,
        "sample": gold_sample,
    }
    if level not in levels:
        raise ValueError(f"unknown gold level {level!r}; known are {sorted(levels)}")
    return levels[level](df, **options)
