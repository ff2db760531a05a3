"""Rebuilding conversations from message rows with keyed streaming state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurate.functions.temporal import is_blank, micros, moment, nick
from murmurate.operators.sorted_runs import scan_runs
from murmurate.session import Scratch, rename_path

#: Event times are kept within these moments (1970-01-02 and 2200-01-01); the clock comes after them.
_EARLY_US, _LATE_US, _CLOCK_S = 86_400_000_000, 7_258_118_400_000_000, 9_000_000_000
#: Dialogues with more rows are buffered in several parts, so no state and no task holds one of any size.
PART_ROWS = 50_000
_STRETCH = (
    "folder bigint, dialogue bigint, rows bigint, senders array<string>, asked array<string>, unreadable boolean, reason string, "
    "turns array<struct<us:bigint,row_id:bigint,who:string,to_nick:string,speaker:string,role:string>>"
)


def prepared_messages(df: DataFrame, *keep: str) -> DataFrame:
    """``row_id, folder, dialogue, us, who, to_nick, has_text`` of bronze rows.

    ``dialogue`` is the number in ``dialogue_id``; rows without a folder or a
    number belong to no dialogue and are left out.
    """
    return df.select(
        F.col("row_id").cast("bigint").alias("row_id"),
        F.col("folder").cast("bigint").alias("folder"),
        F.regexp_extract(F.col("dialogue_id").cast("string"), r"(\d+)", 1).try_cast("bigint").alias("dialogue"),
        micros(moment(F.col("date").cast("string"))).alias("us"),
        nick(F.col("`from`").cast("string")).alias("who"),
        nick(F.col("`to`").cast("string")).alias("to_nick"),
        (~is_blank(F.col("text").cast("string"))).alias("has_text"), *[F.col(f"`{c}`") for c in keep],
    ).where("folder IS NOT NULL AND dialogue IS NOT NULL")


def _other(one: Column, two: Column, to_nick: Column) -> Column:
    """Who wrote a message without sender between two people: the one it does not address."""
    return F.when(to_nick == one, two).otherwise(one)


def reason_of(messages: Column, unreadable: Column, senders: Column, orphans: Column, inferable: Column) -> Column:
    """``empty``, ``broken`` or ``no_reply``, the first that holds, or NULL."""
    return (
        F.when(messages == 0, "empty")
        .when(unreadable | ((orphans > 0) & ~F.coalesce((senders == 2) & inferable, F.lit(False))), "broken")
        .when(senders < 2, "no_reply")
    )


def closing_dialogues(stream: DataFrame, delay: str, timeout: str, parts: DataFrame | None = None) -> DataFrame:
    """The streaming operator: messages in, ordered and validated dialogues out.

    The state of a key is the buffer of its messages, whatever order they come
    in. Once the watermark (``delay`` behind the latest time) is ``timeout`` past
    the last of them, the dialogue closes: its messages are ordered, missing
    senders inferred, asker and helpers told apart, and the verdict is emitted
    with them. The key is the dialogue; ``parts`` (folder, dialogue, parts) names
    dialogues that are too long for one buffer and are kept in several, by a
    hash of the row.
    """
    said = F.when(F.col("has_text"), F.struct("us", "row_id", "who", "to_nick"))
    late = stream.withWatermark("event_time", delay)
    late = late.join(parts, ["folder", "dialogue"], "left") if parts is not None else late.withColumn("parts", F.lit(1))
    part = F.pmod(F.xxhash64("row_id"), F.coalesce("parts", F.lit(1)).cast("bigint")).alias("part")
    closed = late.groupBy(F.session_window("event_time", timeout), "folder", "dialogue", part).agg(F.count("*").alias("rows"), F.array_sort(F.collect_list(said)).alias("m"))
    named = F.transform("m", lambda x: x["who"])
    orphans = F.filter("m", lambda x: x["who"].isNull())
    closed = closed.select(
        "folder", "dialogue", "rows", "m", F.array_sort(F.array_distinct(F.filter(named, lambda x: x.isNotNull()))).alias("senders"),
        F.array_distinct(F.transform(orphans, lambda x: F.coalesce(x["to_nick"], F.lit("")))).alias("asked"), F.exists("m", lambda x: x["us"].isNull()).alias("unreadable"),
    )
    one, two = F.get("senders", F.lit(0)), F.get("senders", F.lit(1))
    inferable = F.forall("asked", lambda x: (x == one) | (x == two))
    closed = closed.withColumn("reason", reason_of(F.size("m"), F.col("unreadable"), F.size("senders"), F.size("asked"), inferable))
    spoken = F.transform("m", lambda x: F.coalesce(x["who"], _other(one, two, x["to_nick"])))
    closed = closed.withColumn("spoken", spoken)
    asker = F.get("spoken", F.lit(0))
    turns = F.zip_with("m", "spoken", lambda x, s: F.struct(x["us"].alias("us"), x["row_id"].alias("row_id"), x["who"].alias("who"), x["to_nick"].alias("to_nick"), s.alias("speaker"), F.when(s == asker, "asker").otherwise("helper").alias("role")))
    return closed.select("folder", "dialogue", "rows", "senders", "asked", "unreadable", "reason", turns.alias("turns"))


def _staged(df: DataFrame, scratch: Scratch, arrival: str | None) -> tuple[DataFrame, str, list[list[str]]]:
    """Messages written by time slot; or by the arrivals that ``df`` names, in their order."""
    event = F.timestamp_micros(F.coalesce(F.least(F.greatest("us", F.lit(_EARLY_US)), F.lit(_LATE_US)), F.lit(_EARLY_US)))
    messages = prepared_messages(df, *([arrival] if arrival else [])).withColumn("event_time", event)
    path = scratch.path("staged")
    if arrival is None:
        staged = messages.withColumn("slot", F.year("event_time").cast("string"))
        staged.write.partitionBy("slot").parquet(path)
        return df.sparkSession.read.schema(staged.schema).parquet(path), path, []
    messages = scratch.write(messages, "messages")
    latest = messages.groupBy(F.col(arrival).alias("a")).agg(F.max("event_time").alias("t")).orderBy("a").collect()
    # What comes behind the watermark is buffered at the earliest time that is still admitted; its place among the messages is its own date's.
    seen, bound, out = None, F.lit(None).cast("timestamp"), []
    for r in latest:
        if seen is not None:
            bound = F.when(F.col(arrival) == r["a"], F.lit(seen)).otherwise(bound)
        seen = r["t"] if seen is None else max(seen, r["t"])
        out.append([str(r["a"])])
    staged = messages.withColumn("event_time", F.greatest("event_time", bound)).withColumn("slot", F.col(arrival).cast("string")).drop(arrival)
    staged.write.partitionBy("slot").parquet(path)
    return df.sparkSession.read.schema(staged.schema).parquet(path), path, out


def closed_stretches(df: DataFrame, *, replays: int = 3, delay: str = "1 hour", timeout: str = "7 days", arrival: str | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """What the stream emits for a table of messages: a row for each dialogue, or for each stretch or part of it.

    The table is replayed in ``replays`` arrivals in the order of its dates, rows
    without a readable date in the first; or, with ``arrival`` (a column of
    few values), as it came. A message that is later than the watermark allows
    is buffered at the watermark's edge and never dropped. A dialogue that goes
    on after it was closed opens anew, so it has several stretches, which are
    put together when read.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "dialogues")
    staged, stage, arrivals = _staged(df, scratch, arrival)
    live = scratch.path("live")
    schema = staged.drop("slot").schema
    if not arrivals:
        counts = sorted((str(r[0]), r[1]) for r in staged.groupBy("slot").count().collect())
        total, at = sum(n for _, n in counts), 0
        arrivals = [[] for _ in range(replays)]
        for slot, n in counts:
            arrivals[min(at * replays // max(total, 1), replays - 1)].append(slot)
            at += n
    long = staged.groupBy("folder", "dialogue").agg(F.ceil(F.count("*") / F.lit(part_rows)).alias("parts")).where("parts > 1")
    long = scratch.write(long, "parts")
    # The clock's own row, later than any message, lets the watermark pass every open dialogue.
    clock = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    clock = clock.withColumns({"folder": F.lit(-1).cast("bigint"), "dialogue": F.lit(-1).cast("bigint"), "has_text": F.lit(False), "event_time": F.timestamp_seconds(F.lit(_CLOCK_S))})
    clock.coalesce(1).write.parquet(f"{stage}/slot=clock")
    clock.limit(0).write.parquet(f"{live}/none")

    source = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(live)
    sink = scratch.path("closed")
    closing = closing_dialogues(source, delay, timeout, None if long.isEmpty() else long)
    stream = closing.writeStream.format("parquet").option("path", sink).outputMode("append").option("checkpointLocation", scratch.path("progress")).trigger(processingTime="0 seconds").start()
    try:
        for slots in [*arrivals, ["clock"]]:
            # Slots are moved from the oldest on, so one that is read alone is not late for the next.
            for slot in slots:
                rename_path(spark, f"{stage}/slot={slot}", f"{live}/{slot}")
            if slots:
                stream.processAllAvailable()
        # The batch that only moves the watermark on.
        stream.processAllAvailable()
    finally:
        stream.stop()
    return spark.read.schema(_STRETCH).parquet(sink).where("dialogue >= 0")


def verdicts(stretches: DataFrame) -> DataFrame:
    """``folder, dialogue, stretches, reason, one, two``: the stream's verdict, or that of all stretches together."""
    key = ["folder", "dialogue"]
    whole = stretches.groupBy(*key).agg(F.count("*").alias("stretches"), F.max("reason").alias("reason"), F.max(F.get("senders", F.lit(0))).alias("one"), F.max(F.get("senders", F.lit(1))).alias("two"))
    several = whole.where("stretches > 1").select(*key)
    apart = stretches.join(several, key, "left_semi")
    # One row per person and stretch, however many a dialogue has.
    person = lambda c, kind: F.transform(c, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("p")))
    people = apart.select(*key, F.size("turns").alias("n"), "unreadable", F.explode_outer(F.concat(person("senders", "from"), person("asked", "to"), F.array(F.struct(F.lit("stretch").alias("kind"), F.lit(None).cast("string").alias("p"))))).alias("x"))
    of = lambda kind: F.when(F.col("x.kind") == kind, F.col("x.p"))
    facts = people.groupBy(*key).agg(
        F.sum(F.when(F.col("x.kind") == "stretch", F.col("n"))).alias("messages"), F.bool_or("unreadable").alias("unreadable"), F.count_if(F.col("x.kind") == "stretch").alias("stretches"),
        F.count_distinct(of("from")).alias("senders"), F.min(of("from")).alias("one"), F.max(of("from")).alias("two"),
        F.count_distinct(of("to")).alias("asked"), F.min(of("to")).alias("asked_one"), F.max(of("to")).alias("asked_two"),
    )
    known = lambda c: F.col(c).isin(F.col("one"), F.col("two"))
    # With at most two different recipients, the first and the last by name are all of them.
    inferable = (F.col("asked") <= 2) & known("asked_one") & known("asked_two")
    facts = facts.withColumn("reason", reason_of(F.col("messages"), F.col("unreadable"), F.col("senders"), F.col("asked"), inferable))
    columns = [*key, "stretches", "reason", "one", "two"]
    return whole.where("stretches = 1").select(*columns).unionByName(facts.select(*columns))


def left_out(df: DataFrame, **options) -> DataFrame:
    """``folder, dialogue, reason`` of every dialogue that is empty, broken or without a reply."""
    return verdicts(closed_stretches(df, **options)).where("reason IS NOT NULL").select("folder", "dialogue", "reason")


def conversations(df: DataFrame, **options) -> DataFrame:
    """Messages of the valid dialogues in order, with speaker and role, as the stream emitted them.

    Result: ``row_id, folder, dialogue, turn, sent_at, speaker, role``. Rows
    with blank text are no messages. ``turn`` counts from 0 by date, then
    row_id. A missing sender is the one of two that the message does not
    address. ``role`` is ``asker`` for the speaker of turn 0, else ``helper``.
    Repeated rows stay, as only a dialogue's own rows decide. Dialogues of
    several stretches or parts are numbered by a range-partitioned scan over
    their emitted messages, so one of any length is spread out.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "conversations")
    key, columns = ["folder", "dialogue"], ["row_id", "folder", "dialogue", "turn", "sent_at", "speaker", "role"]
    stretches = closed_stretches(df, **options)
    valid = scratch.write(verdicts(stretches).where("reason IS NULL"), "verdicts")
    sent = F.timestamp_micros("x.us").alias("sent_at")
    # A dialogue of one stretch was judged in the stream, so it is read as it is.
    judged = valid.where("stretches = 1").select(*key)
    one = stretches.where("reason IS NULL").join(judged, key, "left_semi").select(*key, F.posexplode("turns").alias("turn", "x"))
    one = one.select("x.row_id", *key, F.col("turn").cast("bigint").alias("turn"), sent, "x.speaker", "x.role")
    apart = valid.where("stretches > 1").select(*key, "one", "two")
    if apart.isEmpty():
        return one.select(*columns)
    said = stretches.join(apart, key).select(*key, "one", "two", F.explode("turns").alias("x"))
    said = said.select("x.row_id", *key, "x.us", F.coalesce("x.who", _other(F.col("one"), F.col("two"), F.col("x.to_nick"))).alias("speaker"))
    turned = scan_runs(said, key, ["us", "row_id"], scratch=scratch)
    first = turned.where("run_rank = 1").select(*key, F.col("speaker").alias("asker"))
    many = turned.join(first, key).select(
        "row_id", *key, (F.col("run_rank") - 1).alias("turn"), F.timestamp_micros("us").alias("sent_at"), "speaker",
        F.when(F.col("speaker") == F.col("asker"), "asker").otherwise("helper").alias("role"),
    )
    return one.select(*columns).unionByName(many)
