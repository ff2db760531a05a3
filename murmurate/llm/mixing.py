"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurate.llm.sampling import key_hash
from murmurate.llm.tokens import RANKS, token_count
from murmurate.operators.sorted_runs import scan_runs
from murmurate.session import Scratch


#: As total: all tokens of the sources that have a target, or the most with which every source reaches its share.
ALL, EXACT = "all", "exact"


def _budgets(sized: DataFrame, targets: DataFrame, total_tokens: int | str) -> DataFrame:
    """``source, target_share, max_repeats, available, budget, full_epochs, rest`` per target."""
    available = sized.where("source IS NOT NULL").groupBy("source").agg(F.sum("tokens").alias("available"))
    wanted = targets.where("source IS NOT NULL").groupBy("source").agg(
        F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")
    )
    rows = wanted.join(available, "source", "left").select(
        "source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"),
        F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("max_repeats"), F.coalesce("available", F.lit(0)).alias("available"),
    )
    if total_tokens == EXACT:
        # A source without tokens is as scarce as can be: no exact mixture has any size then.
        total_tokens = rows.where("target_share > 0").agg(
            F.min(F.floor(F.col("available") * F.col("max_repeats") / F.col("target_share")))
        ).first()[0]
    elif total_tokens == ALL:
        total_tokens = rows.where("target_share > 0 AND max_repeats > 0").agg(F.sum("available")).first()[0]
    budget = F.least(F.floor(F.col("target_share") * F.lit(int(total_tokens or 0))), F.col("available") * F.col("max_repeats")).cast("bigint")
    return rows.withColumn("budget", budget).select(
        "*", F.when(F.col("available") > 0, F.expr("budget div available")).otherwise(0).alias("full_epochs"),
        F.when(F.col("available") > 0, F.expr("budget % available")).otherwise(0).alias("rest"),
    )


def mixture(
    documents: DataFrame, targets: DataFrame, *, total_tokens: int | str = ALL, salt: str = "mix-1", tokenizer: str = RANKS, size: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """The mixture and the budgets it was cut to.

    Mixture: ``source, doc_id, tokens, full_uses, partial_tokens, used_tokens``,
    one row per document that is used: ``full_uses`` times whole, and in the
    last epoch up to ``partial_tokens`` (the document at the cut is used in
    part, so a source meets its budget to the token). A source's budget is its
    share of ``total_tokens``, a number, ``ALL`` (the tokens of all sources that
    have a target) or ``EXACT`` (the most with which every source reaches its
    share). A source that cannot fill its budget within its repeats gives all it
    may, and the shares report the shortfall; it takes nothing from the others.
    ``size`` is another measure of a document (bigint) in place of tokens.

    Documents are keyed by a salted hash, range-sorted within their source and
    summed up along that order by a distributed scan, so a source with any
    part of all rows is spread over many tasks. The order is the same in every
    epoch. Documents without a source or with a source that has no target are
    not used; a target without documents gets nothing, which the shares
    report. A doc_id counts once (of copies, the longest text's size); empty
    tables give empty results.
    """
    scratch = Scratch(documents.sparkSession, "mixture")
    sized = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        (token_count(F.col("text"), tokenizer) if size is None else size).alias("tokens"),
    ).where("doc_id IS NOT NULL AND source IS NOT NULL")
    sized = scratch.write(sized.groupBy("doc_id").agg(F.max(F.struct("tokens", "source")).alias("d")).select("doc_id", "d.source", "d.tokens"), "sized")
    budgets = scratch.write(_budgets(sized, targets, total_tokens), "budgets")
    ordered = scan_runs(
        sized, ["source"], [key_hash(F.col("doc_id"), salt), "doc_id"], scratch=scratch, value=F.col("tokens"), head="doc_id"
    )
    # budgets has one row per target; Spark broadcasts it only if it is as small as that suggests.
    joined = ordered.join(budgets.select("source", "full_epochs", "rest"), "source")
    partial = F.greatest(F.least(F.col("rest") - (F.col("running_total") - F.col("tokens")), F.col("tokens")), F.lit(0))
    used = joined.select(
        "source", "doc_id", "tokens", F.col("full_epochs").alias("full_uses"), partial.alias("partial_tokens")
    ).withColumn("used_tokens", F.col("tokens") * F.col("full_uses") + F.col("partial_tokens"))
    return used.where("full_uses > 0 OR partial_tokens > 0"), budgets


def shares(used: DataFrame, budgets: DataFrame) -> DataFrame:
    """Target and actual share of every source, with its budget, repeats and documents."""
    got = used.groupBy("source").agg(
        F.sum("used_tokens").alias("used_tokens"), F.count("*").alias("documents"),
        F.max(F.col("full_uses") + (F.col("partial_tokens") > 0).cast("int")).alias("most_uses"),
    )
    rows = budgets.join(got, "source", "left").select(
        "source", "target_share", "max_repeats", "available", "budget",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("used_tokens", "documents", "most_uses")],
    )
    rows = Scratch(used.sparkSession, "shares").write(rows, "shares")
    total = rows.agg(F.sum("used_tokens")).first()[0] or 0
    return rows.withColumn("actual_share", F.try_divide("used_tokens", F.lit(total)))


def totals(shares: DataFrame) -> DataFrame:
    """``used_tokens, available_tokens, sources_short``: what the mixture reached of the tokens of its sources.

    A source is short if its actual share is below its target by more than a thousandth of it.
    """
    short = F.coalesce("actual_share", F.lit(0.0)) < F.col("target_share") * 0.999
    return shares.where("target_share > 0 AND max_repeats > 0").agg(
        F.coalesce(F.sum("used_tokens"), F.lit(0)).alias("used_tokens"), F.coalesce(F.sum("available"), F.lit(0)).alias("available_tokens"),
        F.count_if(short).alias("sources_short"),
    )
