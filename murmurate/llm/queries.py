"""The queries of the problems tagged llm, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurate.llm import conversations, copies, language, mixing, packing, personal, reading, sampling, terms
from murmurate.session import Scratch

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- 2: duplicates hidden by formatting --------------------------------------------------------


def _records(spark: SparkSession, d: str) -> DataFrame:
    messages = copies.canonical_records(_table(spark, d, "dialoguetext_196"), "dialoguetext_196", "row_id")
    exports = copies.canonical_records(_table(spark, d, "raw_exports"), "raw_exports", "raw_id", payload="payload")
    return messages.unionByName(exports)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return copies.copy_pairs(_records(spark, d))


def p2_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return copies.collapsed(_records(spark, d))


# --- 3: languages --------------------------------------------------------------------------------


def _language_model(spark: SparkSession, d: str) -> language.Crf:
    texts, labels = language.training_rows(_table(spark, d, "dialoguetext_196"), _table(spark, d, "message_labels"))
    return language.fit(texts, labels, language.Lexicon(_terms(spark, d)))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return language.doubtful_labels(_table(spark, d, "dialoguetext_196"), _table(spark, d, "message_labels"), _language_model(spark, d))


def p3_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.segments(_table(spark, d, "dialoguetext_196"), _language_model(spark, d))


def p3_languages(spark: SparkSession, d: str) -> DataFrame:
    return language.message_languages(p3_segments(spark, d))


def p3_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of every message over its stretches: each word lies in exactly one."""
    return p3_segments(spark, d).groupBy("row_id").agg(F.sum("words").cast("bigint").alias("words"), F.min("start_pos").cast("bigint").alias("first_pos"), F.max("end_pos").cast("bigint").alias("end_pos"))


# --- 4: stable sample ---------------------------------------------------------------------------

#: Help channels of single languages are small and kept at a higher rate; talk off the topic at a lower.
SAMPLE_RATES = {
    "#help": 0.05, "#offtopic": 0.02,
    **{f"#help-{x}": 0.4 for x in ("es", "de", "fr", "nl", "pt", "it", "ru")},
}
SAMPLE_DEFAULT = 0.1
SAMPLE_SALT = "silver-1"


def _thresholds(earlier: DataFrame | None) -> tuple[dict[str, int], int]:
    return sampling.grown(SAMPLE_RATES, SAMPLE_DEFAULT, *(sampling.stored_thresholds(earlier) if earlier is not None else ()))


def p4_thresholds(spark: SparkSession, d: str, earlier: DataFrame | None = None) -> DataFrame:
    """What p4_sample draws with, to be stored beside it and given to the next draw as ``earlier``."""
    return sampling.thresholds_table(spark, *_thresholds(earlier))


def p4_sample(spark: SparkSession, d: str, earlier: DataFrame | None = None) -> DataFrame:
    thresholds, default = _thresholds(earlier)
    return sampling.stable_sample(
        _table(spark, d, "silver"), key="message_id", stratum="channel",
        thresholds=thresholds, default=default,
        salt=SAMPLE_SALT, version=("load_batch", "ingested_at"),
    )


def p4_kept(spark: SparkSession, d: str) -> DataFrame:
    """An earlier sample at the default rate, and the one after channels got lower and higher rates: none of its keys is lost."""
    draw = lambda thresholds, default: sampling.stable_sample(
        _table(spark, d, "silver"), key="message_id", stratum="channel", thresholds=thresholds, default=default, salt=SAMPLE_SALT, version=("load_batch", "ingested_at")
    )
    earlier, later = draw(*sampling.grown({}, SAMPLE_DEFAULT)), p4_sample(spark, d, sampling.thresholds_table(spark, *sampling.grown({}, SAMPLE_DEFAULT)))
    both = earlier.select("message_id", F.lit(1).alias("e")).join(later.select("message_id", F.lit(1).alias("l")), "message_id", "full")
    return both.agg(F.count("e").alias("earlier"), F.count("l").alias("later"), F.count_if(F.col("e").isNotNull() & F.col("l").isNull()).alias("lost"))


# --- 5: personal information ---------------------------------------------------------------------------

#: The lexicon is a fixed table that travels with the tasks; this bounds its size.
MOST_TERMS = 200_000


def _terms(spark: SparkSession, d: str) -> list[str]:
    rows = _table(spark, d, "tech_lexicon").select("term").where("term IS NOT NULL").limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"tech_lexicon has more than {MOST_TERMS} terms")
    return sorted(r[0] for r in rows)


def _personal(spark: SparkSession, d: str) -> DataFrame:
    return personal.find_personal(_table(spark, d, "dialoguetext_196"), _terms(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _personal(spark, d).select("row_id", "kind", "start_pos")


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal.redact(_table(spark, d, "dialoguetext_196"), _personal(spark, d))


def p5_plain_emails(spark: SparkSession, d: str) -> DataFrame:
    """Of the addresses found, those written with an at sign and a domain of letters: SQL can find them too."""
    found = _personal(spark, d).where("kind = 'email'")
    texts = _table(spark, d, "dialoguetext_196").select(F.col("row_id").cast("bigint").alias("row_id"), "text")
    said = found.join(texts, "row_id").withColumn("email", F.expr("substring(text, start_pos + 1, end_pos - start_pos)"))
    return said.where(F.col("email").contains("@")).select("row_id", "start_pos", "email")


# --- 6: term frequencies -------------------------------------------------------------------------

TERM_FIELDS = {"residual_words": "residual_words", "tech_lexicon_matches": "transform(tech_lexicon_matches, x -> x.term)"}


def p6_terms(spark: SparkSession, d: str) -> DataFrame:
    counts, total = terms.term_frequencies(_table(spark, d, "silver"), key="message_id", fields=TERM_FIELDS)
    return terms.mark_terms(counts, total)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_terms(spark, d).where("mark IS NOT NULL").select("field_name", "term", "mark")


# --- 7: conversations -------------------------------------------------------------------------------


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return conversations.left_out(_table(spark, d, "dialoguetext_196"))


def p7_conversations(spark: SparkSession, d: str) -> DataFrame:
    return conversations.conversations(_table(spark, d, "dialoguetext_196"))


# --- 8: filling containers ---------------------------------------------------------------------------


def _capacity(spark: SparkSession, d: str, budget: str) -> int:
    return int(_table(spark, d, "token_budgets").where(F.col("budget_name") == budget).first()["capacity_tokens"])


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(_table(spark, d, "documents"), _capacity(spark, d, "standard"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    reports = []
    for budget in ("short", "standard", "long"):
        capacity = _capacity(spark, d, budget)
        report = packing.fill_report(packing.packed(_table(spark, d, "documents"), capacity), capacity)
        reports.append(report.select(F.lit(budget).alias("budget_name"), F.lit(capacity).alias("capacity_tokens"), "*"))
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def p8_faults(spark: SparkSession, d: str) -> DataFrame:
    """What must not happen, counted over the packed documents: one row, all zeros but ``documents``."""
    capacity = _capacity(spark, d, "standard")
    placed = Scratch(spark, "faults").write(packing.packed(_table(spark, d, "documents"), capacity), "placed")
    fills = placed.where("container IS NOT NULL").groupBy("container").agg(F.sum("tokens").alias("load"))
    whole = placed.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("n"), F.count_distinct("start_token").alias("starts"))
    over = fills.agg(F.count_if(F.col("load") > capacity)).first()[0]
    return whole.agg(
        F.count("*").alias("documents"), F.count_if((F.col("n") <= capacity) & (F.col("pieces") > 1)).alias("split_needlessly"),
        F.count_if(F.col("pieces") != F.greatest(F.ceil(F.col("n") / capacity), F.lit(1))).alias("wrong_pieces"), F.count_if(F.col("starts") != F.col("pieces")).alias("repeated_pieces"),
    ).withColumn("overfull_containers", F.lit(over).cast("bigint"))


# --- 9: mixing sources ---------------------------------------------------------------------------------


def _mixture(spark: SparkSession, d: str, **options) -> tuple[DataFrame, DataFrame]:
    return mixing.mixture(_table(spark, d, "documents"), _table(spark, d, "mix_targets"), **options)


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """As large as all tokens of the sources that have a target."""
    return _mixture(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(*_mixture(spark, d))


def p9_shares_exact(spark: SparkSession, d: str) -> DataFrame:
    """Shares of the largest mixture in which no source falls short."""
    return mixing.shares(*_mixture(spark, d, total_tokens=mixing.EXACT))


def p9_totals(spark: SparkSession, d: str) -> DataFrame:
    parts = [mixing.totals(f(spark, d)).select(F.lit(name).alias("mixture"), "*") for name, f in (("all tokens", p9_shares), ("exact shares", p9_shares_exact))]
    return parts[0].unionByName(parts[1])


def p9_faults(spark: SparkSession, d: str) -> DataFrame:
    """What must not happen in the shares of a mixture by tokens: one row, all zeros but ``sources``."""
    s = p9_shares(spark, d)
    return s.agg(
        F.count("*").alias("sources"), F.count_if(F.col("used_tokens") != F.col("budget")).alias("budget_missed"), F.count_if(F.col("most_uses") > F.col("max_repeats")).alias("used_too_often"),
        F.count_if(F.col("used_tokens") > F.col("available") * F.col("max_repeats")).alias("more_than_there_is"), (F.round(F.sum("actual_share"), 6) != 1).cast("bigint").alias("shares_off"),
    )


def p9_mixture_chars(spark: SparkSession, d: str) -> DataFrame:
    """SQL cannot count tokens; measured in characters, the same mixture can be held against it."""
    return _mixture(spark, d, size=F.coalesce(F.length("text"), F.lit(0)).cast("bigint"))[0]


def p9_shares_chars(spark: SparkSession, d: str) -> DataFrame:
    out = mixing.shares(*_mixture(spark, d, size=F.coalesce(F.length("text"), F.lit(0)).cast("bigint")))
    return out.withColumns({c: F.round(c, 6) for c in ("target_share", "actual_share")})


# --- 10: reading level -----------------------------------------------------------------------------------


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    return reading.reading_levels(_table(spark, d, "documents"), _table(spark, d, "reading_labels"))


def p10_profile(spark: SparkSession, d: str) -> DataFrame:
    return reading.profile(p10_levels(spark, d))


def p10_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of every document, and whether it has a score."""
    return p10_levels(spark, d).select("doc_id", "words", F.col("score").isNotNull().alias("scored"))


def p10_sources(spark: SparkSession, d: str) -> DataFrame:
    """Documents and words per source, over all levels of the profile."""
    return p10_profile(spark, d).groupBy("source").agg(F.sum("documents").alias("documents"), F.sum("words").alias("words"))


def p10_held_out(spark: SparkSession, d: str) -> DataFrame:
    """How often levels equal the band, or are within one of it, on labels that were not used to fit."""
    measures = reading.held_out(_table(spark, d, "documents"), _table(spark, d, "reading_labels"))
    return spark.createDataFrame(sorted(measures.items()), "measure string, value double")


def queries() -> dict[str, Query]:
    return {
        "p2_found": p2_found, "p2_collapsed": p2_collapsed,
        "p3_found": p3_found, "p3_segments": p3_segments, "p3_languages": p3_languages,
        "p4_sample": p4_sample, "p4_thresholds": p4_thresholds, "p4_kept": p4_kept,
        "p5_found": p5_found, "p5_redacted": p5_redacted,
        "p6_found": p6_found, "p6_terms": p6_terms,
        "p7_found": p7_found, "p7_conversations": p7_conversations,
        "p8_packed": p8_packed, "p8_fill": p8_fill,
        "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p9_shares_exact": p9_shares_exact, "p9_totals": p9_totals,
        "p9_faults": p9_faults, "p9_mixture_chars": p9_mixture_chars, "p9_shares_chars": p9_shares_chars,
        "p10_levels": p10_levels, "p10_profile": p10_profile, "p10_held_out": p10_held_out,
        "p3_words": p3_words, "p5_plain_emails": p5_plain_emails, "p8_faults": p8_faults, "p10_words": p10_words, "p10_sources": p10_sources,
    }


def oracle_sql() -> dict[str, str]:
    from murmurate.llm import oracle

    return oracle.sql()
