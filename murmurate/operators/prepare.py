"""Bronze messages to prepared messages: cleaning, identifiers, inference, turns, activity, calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurate.functions.temporal import calendar_fields, minutes_between, moment, right_closed
from murmurate.operators.joins import asof_join
from murmurate.operators.sorted_runs import scan_runs
from murmurate.schema import SENTINELS, TO_ALL, TO_UNANSWERED, col, normalized_names, require
from murmurate.session import Scratch

RELEASE_BOUNDS = ([7, 14, 21, 28, 42, 56], ["0-1wk", "1-2wk", "2-3wk", "3-4wk", "4-6wk", "6-8wk", "8wk+"])
TEXT_BOUNDS = ([20, 50, 100, 200], ["very_short", "short", "medium", "long", "very_long"])
WORD_BOUNDS = ([5, 10, 20, 40], ["very_short", "short", "medium", "long", "very_long"])
GAP_BOUNDS = ([5, 30, 120, 1440], ["immediate", "quick", "moderate", "slow", "very_slow"])
TIER_BOUNDS = ([10, 50, 150, 500], ["occasional", "regular", "active", "frequent", "power_user"])
MESSAGE_COUNT_BOUNDS = ([2, 5, 10, 20, 50], ["1-2", "3-5", "6-10", "11-20", "21-50", "51+"])
DURATION_BOUNDS = ([1, 5, 15, 60, 240, 1440, 10080], ["0-1m", "1-5m", "5-15m", "15-60m", "1-4h", "4-24h", "1-7d", "7d+"])


def blank_to_null(c: Column) -> Column:
    """NULL for blank text; other values keep their surrounding whitespace."""
    return F.when(F.trim(c) != "", c)


def clean_bronze(df: DataFrame) -> DataFrame:
    """Normalized names, blank participants as NULL, parsed dates; rows without date or text go."""
    df = normalized_names(df)
    require(df, ["date", "from", "text"], "bronze")
    if "to" not in df.columns:
        df = df.withColumn("to", F.lit(None).cast("string"))
    changes = {"from": blank_to_null(col("from").cast("string")), "to": blank_to_null(col("to").cast("string"))}
    if dict(df.dtypes)["date"] in ("string", "void"):
        changes["date"] = moment(col("date").cast("string"))
    else:
        changes["date"] = col("date").cast("timestamp")
    if "dialogue_id" in df.columns:
        changes["dialogue_id"] = F.regexp_replace(col("dialogue_id").cast("string"), r"(?i)\.tsv$", "").try_cast("bigint")
    if "folder" in df.columns:
        changes["folder"] = col("folder").try_cast("bigint")
    return df.withColumns(changes).where("date IS NOT NULL AND text IS NOT NULL")


def deduplicate(df: DataFrame, keys: Sequence[str] = ("date", "from", "text"), tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per key; of equal keys the one that is smallest by ``tie_break``, then by all columns.

    The choice does not depend on the order or partitioning of the input.
    Copies are reduced in the map tasks before they are shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [*tie_break, *[c for c in rest if c not in tie_break]]
    if not order:
        return df.distinct()
    best = df.groupBy(*[col(k) for k in keys]).agg(F.min(F.struct(*[col(c) for c in order])).alias("__best"))
    return best.select(*[col(c) if c in keys else F.col(f"__best.`{c}`").alias(c) for c in df.columns])


def stable_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by ``::``, with ``<NULL>`` for NULL."""
    return F.sha2(F.concat_ws("::", *[F.coalesce(p.cast("string"), F.lit("<NULL>")) for p in parts]), 256)


def moment_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def with_conversation_id(df: DataFrame) -> DataFrame:
    if "conversation_id" in df.columns:
        return df
    require(df, ["folder", "dialogue_id"], "conversation_id")
    return df.withColumn("conversation_id", stable_id(col("folder"), col("dialogue_id")))


def with_message_id(df: DataFrame) -> DataFrame:
    if "message_id" in df.columns:
        return df
    return df.withColumn(
        "message_id", stable_id(col("conversation_id"), moment_text(col("date")), col("from"), col("to"), col("text"))
    )


def _joined_back(df: DataFrame, summary: DataFrame, key: str = "conversation_id") -> DataFrame:
    """A group's summary on each of its rows.

    Aggregates combine in the map tasks and the join is divided by AQE where a
    group is large, which a window over the group would not be.
    """
    return df.join(summary.withColumnRenamed(key, "__key"), col(key).eqNullSafe(F.col("__key")), "left").drop("__key")


def _tie(df: DataFrame, tie_break: Sequence[str]) -> list[str]:
    """What orders messages of one moment besides the sender: their content, never their place in the input."""
    names = list(tie_break) or (["message_id"] if "message_id" in df.columns else [c for c in ("text", "to") if c in df.columns])
    return [c for c in names if c != "from"]


def _exchanges(df: DataFrame, tie: Sequence[str]) -> DataFrame:
    """One row per conversation, sender and recipient: first message, last moment, and size."""
    return df.groupBy("conversation_id", "from", "to").agg(
        F.min(F.struct("date", *[col(c) for c in tie])).alias("__lo"), F.max("date").alias("__hi"), F.count("*").alias("__n")
    )


def _other(c: Column) -> Column:
    return F.when(c == F.col("__one"), F.col("__two")).when(c == F.col("__two"), F.col("__one"))


def _facts(exchanges: DataFrame, include_sentinels: bool = False) -> DataFrame:
    """What is known of each conversation, from its exchanges alone.

    ``__people``, ``__one``, ``__two``: how many senders are named, first and last of them;
    of the messages whose sender is named or inferred: ``__first`` (the order key of the first
    one), bounds, size, participants, and whether more than one person wrote. An inferred
    recipient is a sender of the conversation or nobody, so recipients that are named
    suffice to count participants.
    """
    people = exchanges.groupBy("conversation_id").agg(
        F.count_distinct("from").alias("__people"), F.min("from").alias("__one"), F.max("from").alias("__two")
    )
    known = _joined_back(exchanges, people)
    known = known.withColumn("__sender", F.coalesce("from", F.when(F.col("__people") == 2, _other(col("to"))))).where("__sender IS NOT NULL")
    person = lambda c, sends: F.struct(F.col(c).alias("p"), F.lit(sends).alias("s"))
    each = known.select("*", F.explode(F.array(person("__sender", True), person("to", False))).alias("x"))
    sends = F.col("x.s")
    real = F.when(F.lit(include_sentinels) | ~F.col("x.p").isin(*SENTINELS), F.col("x.p"))
    return each.groupBy("conversation_id", "__people", "__one", "__two").agg(
        F.min(F.struct("__lo", "__sender")).alias("__first"), F.min("__lo.date").alias("conversation_start"), F.max("__hi").alias("conversation_end"),
        F.sum(F.when(sends, F.col("__n"))).alias("conversation_message_count"), (F.count_distinct(F.when(sends, F.col("x.p"))) > 1).alias("conversation_was_answered"),
        F.count_distinct(real).alias("conversation_participant_count"),
    )


_FACTS = ["conversation_start", "conversation_end", "conversation_message_count", "conversation_was_answered", "conversation_participant_count"]


def _with_participants(df: DataFrame, facts: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Rows with sender, their recipient filled in, and the facts of their conversation."""
    known = _joined_back(df, facts)
    two = F.col("__people") == 2
    known = known.withColumn("from", F.coalesce(col("from"), F.when(two, _other(col("to"))))).where(col("from").isNotNull())
    order = F.struct(F.struct("date", *[col(c) for c in tie]), col("from"))
    # A named recipient is part of a default order, so a missing one is compared before it is filled in.
    recipient = (
        F.when(F.col("__people") <= 1, TO_UNANSWERED)
        .when(order == F.col("__first"), TO_ALL)
        .when(two, _other(col("from")))
        .otherwise(TO_ALL)
    )
    return known.withColumn("to", F.coalesce(col("to"), recipient))


def infer_participants(df: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Fills senders and recipients from the two people of a conversation.

    A missing sender with a recipient is the other of exactly two known
    senders; rows that stay without sender go. A missing recipient is
    ``__UNANSWERED__`` with one sender, ``__ALL__`` in the first turn, the only
    other of two senders, else ``__ALL__``. Messages of one moment are ordered
    by ``tie_break``, by default by their content.
    """
    tie = _tie(df, tie_break)
    exchanges = Scratch(df.sparkSession, "participants").write(_exchanges(df, tie), "exchanges")
    return _with_participants(df, _facts(exchanges), tie).drop("__people", "__one", "__two", "__first", *_FACTS)


def _turned(df: DataFrame, tie: Sequence[str], scratch: Scratch) -> DataFrame:
    """``turn_count`` and gaps, with ``__opener_place``: whether the row is a conversation's first."""
    placed = scan_runs(df, ["conversation_id"], ["date", *tie, "from"], scratch=scratch, lag=["date", "from"])
    gap = minutes_between(col("date"), col("prev_date"))
    return placed.withColumns(
        {
            "turn_count": F.col("run_rank") - 1,
            "response_gap_mins": gap,
            "response_gap_mins_between_speakers": F.when(col("from") != col("prev_from"), gap),
        }
    ).drop("running_total", "run_rank", "run_head", "prev_date", "prev_from")


def turn_features(df: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """``turn_count, is_op, response_gap_mins, response_gap_mins_between_speakers`` in a conversation.

    Turns come from a range-partitioned scan, so a conversation of any size is
    spread over the tasks its rows fill.
    """
    tie = _tie(df, tie_break)
    opener = df.where(col("from").isNotNull()).groupBy("conversation_id").agg(F.min_by("from", F.struct("date", *[col(c) for c in tie], "from")).alias("__opener"))
    turned = _joined_back(_turned(df, tie, Scratch(df.sparkSession, "turns")), opener)
    return turned.withColumn("is_op", col("from") == F.col("__opener")).drop("__opener")


def user_features(df: DataFrame, tie_break: Sequence[str] = (), scratch: Scratch | None = None, lag: Sequence[str] = ()) -> DataFrame:
    """``user_message_count`` (running), ``user_messages_this_month`` and ``user_tier``.

    Counts of a month are one aggregate joined back; running numbers come from a
    range-partitioned scan, so no user is one task. ``prev_<c>`` is added for
    every ``lag`` column.
    """
    placed = scan_runs(df, ["from"], ["date", *_tie(df, tie_break)], scratch=scratch or Scratch(df.sparkSession, "users"), lag=lag)
    month = F.date_trunc("month", col("date"))
    months = placed.groupBy(col("from").alias("__u"), month.alias("__m")).agg(F.count("*").alias("user_messages_this_month"))
    out = placed.join(months, col("from").eqNullSafe(F.col("__u")) & month.eqNullSafe(F.col("__m")), "left")
    out = out.withColumns({"user_message_count": F.col("run_rank"), "user_tier": right_closed(F.col("user_messages_this_month"), *TIER_BOUNDS)})
    return out.drop("__u", "__m", "running_total", "run_rank", "run_head")


def conversation_features(df: DataFrame, include_sentinels: bool = False) -> DataFrame:
    """Bounds, size, participants and answer of its conversation on each message."""
    person = F.explode(F.array_distinct(F.array("from", "to")))
    people = df.select("conversation_id", person.alias("p")).where("p IS NOT NULL")
    if not include_sentinels:
        people = people.where(~F.col("p").isin(*SENTINELS))
    people = people.groupBy("conversation_id").agg(F.count_distinct("p").alias("conversation_participant_count"))
    whole = df.groupBy("conversation_id").agg(
        F.min("date").alias("conversation_start"), F.max("date").alias("conversation_end"), F.count("*").alias("conversation_message_count"),
        (F.count_distinct("from") > 1).alias("conversation_was_answered"),
    )
    whole = _joined_back(whole, people)
    return _with_duration(_joined_back(df, whole))


def _with_duration(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "conversation_participant_count": F.coalesce("conversation_participant_count", F.lit(0)).cast("bigint"),
            "conversation_duration_mins": minutes_between(col("conversation_end"), col("conversation_start")),
        }
    )


def text_sizes(text: Column) -> dict[str, Column]:
    """Characters, and words divided by whitespace; blank text has no word."""
    words = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return {
        "text_length": F.length(text).cast("bigint"),
        "word_count": F.when(words == "", 0).otherwise(F.size(F.split(words, " "))).cast("bigint"),
    }


def calendar_features(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_fields(col("date")))


def size_buckets(df: DataFrame) -> DataFrame:
    out = {}
    for source, target, bounds in (
        ("text_length", "text_length_bucket", TEXT_BOUNDS),
        ("word_count", "word_count_bucket", WORD_BOUNDS),
        ("response_gap_mins_between_speakers", "response_gap_bucket", GAP_BOUNDS),
    ):
        if source in df.columns:
            out[target] = right_closed(col(source), *bounds)
    return df.withColumns(out) if out else df


def release_distance(date: Column, releases: Sequence[str]) -> dict[str, Column]:
    """Days since the last and until the next release, from a constant sorted array; NULL outside it.

    For calendars of up to some hundred dates; ``with_release_distance`` serves any.
    """
    days = F.array(*[F.lit(r).cast("date") for r in sorted(releases)])
    # As an element of an array the day is computed once, not once for every release.
    once = lambda f: F.get(F.transform(F.array(F.to_date(date)), f), 0)
    since = once(lambda day: F.datediff(day, F.array_max(F.filter(days, lambda r: r <= day))))
    return _distances(since, once(lambda day: F.datediff(F.array_min(F.filter(days, lambda r: r >= day)), day)))


def _distances(since: Column, until: Column) -> dict[str, Column]:
    return {
        "days_since_release": since,
        "days_until_release": until,
        "days_since_release_bucket": right_closed(since, *RELEASE_BOUNDS),
        "days_until_release_bucket": right_closed(until, *RELEASE_BOUNDS),
    }


#: Calendars up to this size are a constant of the plan; larger ones are joined.
CONSTANT_RELEASES = 500


def with_release_distance(df: DataFrame, calendar: DataFrame, release_date: str = "release_date") -> DataFrame:
    """Distances to the releases of a calendar of any size: a constant array or, beyond it, as-of joins."""
    days = calendar.select(F.to_date(col(release_date)).alias("__day")).where("__day IS NOT NULL").distinct()
    known = [r[0].isoformat() for r in days.limit(CONSTANT_RELEASES + 1).collect()]
    if len(known) <= CONSTANT_RELEASES:
        return df.withColumns(release_distance(col("date"), known))
    out = df.withColumn("__at", F.to_date("date").cast("timestamp"))
    for target, direction in (("__last", "backward"), ("__next", "forward")):
        out = asof_join(out, days.select("__day", col("__day").alias(target)), left_on="__at", right_on="__day", values=[target], direction=direction)
    since, until = F.datediff(F.to_date("date"), "__last"), F.datediff("__next", F.to_date("date"))
    return out.withColumns(_distances(since, until)).drop("__at", "__last", "__next")


def key_first(df: DataFrame, keys: Sequence[str] = ("message_id", "conversation_id", "date", "from", "to")) -> DataFrame:
    """Key columns first, the others as they were."""
    present = [c for c in keys if c in df.columns]
    return df.select(*[col(c) for c in present], *[col(c) for c in df.columns if c not in present])


def to_minutes(df: DataFrame, column: str = "date") -> DataFrame:
    """Times cut to the minute; NULL stays NULL."""
    return df.withColumn(column, F.date_trunc("minute", col(column)))


def _own_ids(df: DataFrame, turned: DataFrame) -> DataFrame:
    """Rows numbered within their sender, with ``prev_message_id``: of equal ids all but the first get one of their own.

    Parts of an id end at a colon. Where no name holds one, equal ids have the
    sender in common and are neighbours; else they are looked for among all rows
    of ``turned``.
    """
    later = col("message_id") == col("prev_message_id")
    named = [col(c).cast("string").contains(":") for c in ("conversation_id", "from", "to")]
    if not turned.where(named[0] | named[1] | named[2]).isEmpty():
        turn = F.struct("conversation_id", "turn_count")
        first = turned.groupBy("message_id").agg(F.min(turn).alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
        df, later = _joined_back(df, first, "message_id"), turn > F.col("__first")
    again = stable_id(col("message_id"), col("turn_count"))
    return df.withColumn("message_id", F.when(later, again).otherwise(col("message_id"))).drop("prev_message_id", "__first")


def prepare_bronze(df: DataFrame, releases: Sequence[str] | DataFrame = (), tie_break: Sequence[str] = (), minutes: bool = False, unique_ids: bool = False) -> DataFrame:
    """All of the above: bronze messages to prepared messages, key columns first.

    Rows are shuffled four times: to find copies, to meet the facts of their
    conversation, to be numbered within it, and within their sender. What each
    step leaves is written to the shared folder, so no plan holds another
    twice. ``releases`` are dates or a calendar table; ``minutes`` cuts times.

    A message without sender may say the same as one with the sender that is
    inferred for it, and names with colons may join to the same as others. All
    stay, and their content gives them one ``message_id``; with ``unique_ids``
    the later turns get ids of their own. Ids that the table brings are left as
    they are.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "prepare")
    cleaned = clean_bronze(df)
    cleaned = scratch.write(with_conversation_id(deduplicate(to_minutes(cleaned) if minutes else cleaned, tie_break=tie_break)), "clean")
    tie = _tie(cleaned, tie_break)
    exchanges = scratch.write(_exchanges(cleaned, tie), "exchanges")
    whole = with_message_id(_with_participants(cleaned, _facts(exchanges), tie))
    whole = _with_duration(whole).withColumn("is_op", col("from") == F.col("__first.__sender")).drop("__people", "__one", "__two", "__first")
    turned = _turned(whole, tie, scratch)
    own_ids = unique_ids and "message_id" not in cleaned.columns
    out = user_features(turned, ("message_id", "turn_count"), scratch, ["message_id"] if own_ids else []).withColumns(text_sizes(col("text")))
    if own_ids:
        out = _own_ids(out, turned)
    for done in (cleaned, exchanges):
        scratch.drop(done)
    out = calendar_features(out)
    if isinstance(releases, DataFrame):
        out = with_release_distance(out, releases)
    elif releases:
        out = out.withColumns(release_distance(col("date"), releases))
    return key_first(size_buckets(out))


def working_text(df: DataFrame) -> DataFrame:
    """``text_cleaned`` from itself or ``text``, NULL as empty."""
    if "text_cleaned" not in df.columns and "text" not in df.columns:
        raise KeyError("text or text_cleaned is needed")
    source = col("text_cleaned") if "text_cleaned" in df.columns else col("text")
    return df.withColumn("text_cleaned", F.coalesce(source.cast("string"), F.lit("")))


def nonempty(df: DataFrame) -> DataFrame:
    return df.where("word_count > 0")


def hash_rank(key: Column, seed: int | str) -> Column:
    """A stable pseudo-random order of keys that other engines can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}::"), key.cast("string")).cast("binary"))


def seeded_sample(df: DataFrame, n: int, key: str = "message_id", seed: int | str = 42) -> DataFrame:
    """The ``n`` rows whose keys come first in hash order; all if there are no more; n < 1 is an error."""
    if n < 1:
        raise ValueError("a sample needs at least one row")
    return df.withColumn("__h", hash_rank(col(key), seed)).orderBy("__h", key).limit(n).drop("__h")


def whole_conversation_sample(df: DataFrame, n: int, key: str = "conversation_id", seed: int | str = 42) -> DataFrame:
    """Every message of ``n`` sampled conversations, by a semi join."""
    chosen = seeded_sample(df.select(key).where(col(key).isNotNull()).distinct(), n, key, seed)
    return df.join(chosen, key, "left_semi")


def first_messages(df: DataFrame, tie_break: Sequence[str] = ("message_id",)) -> DataFrame:
    """The first message of each conversation."""
    first = df.groupBy("conversation_id").agg(F.min_by(F.struct(*[col(c) for c in df.columns]), F.struct("date", *[col(c) for c in tie_break])).alias("m"))
    return first.select("m.*")


def last_messages(df: DataFrame, tie_break: Sequence[str] = ("message_id",)) -> DataFrame:
    """The last message of each conversation."""
    last = df.groupBy("conversation_id").agg(F.max_by(F.struct(*[col(c) for c in df.columns]), F.struct("date", *[col(c) for c in tie_break])).alias("m"))
    return last.select("m.*")
