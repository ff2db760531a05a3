"""Grouping activity into sessions by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurate.functions.temporal import micros, moment, nick
from murmurate.session import Scratch


def user_sessions(
    df: DataFrame,
    *,
    user: str = "from",
    date: str = "date",
    key: str = "message_id",
    gap_minutes: float = 30,
) -> DataFrame:
    """One row per stretch of a user's events without a silence above the gap.

    Result: ``user_name, session_start, session_end, duration_seconds,
    event_count, first_event_id, last_event_id``.

    Each key counts once (of copies that differ, the earliest moment, then the
    smallest nick). Rows with a NULL key, an unreadable date or a blank user
    are no events. A silence of exactly the gap does not split. Among events
    of the same moment the smallest id is first and the largest last. Other
    columns of the input are ignored whatever their names; an empty input
    gives an empty result.

    Method. Two events of a user in the same slot of one gap's width always
    belong together, and two whose slots are not neighbours never touch. So
    events are first combined, map-side too, into one node per user and slot,
    however many events a busy user has, and a node's predecessor is the node
    of the slot before, if the silence between them is within the gap. Then
    pointers are doubled: each round joins every unfinished node to the node
    it points to and takes over that node's pointer, until all point to roots.
    Unfinished pointers of a chain are all different, so no join key is hot,
    and a chain of n slots takes log2(n) rounds. Sessions are nodes grouped by
    root.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "sessions")
    gap = int(gap_minutes * 60_000_000)
    if gap <= 0:
        raise ValueError("gap_minutes must be positive")
    events = df.select(
        F.col(f"`{key}`").cast("bigint").alias("id"),
        nick(F.col(f"`{user}`").cast("string")).alias("u"),
        micros(moment(F.col(f"`{date}`").cast("string"))).alias("t"),
    ).where("id IS NOT NULL AND u IS NOT NULL AND t IS NOT NULL")
    once = events.groupBy("id").agg(F.min(F.struct("t", "u")).alias("e")).select("id", "e.u", "e.t")
    nodes = once.groupBy("u", F.expr(f"(t - pmod(t, {gap}L)) div {gap}L").alias("slot")).agg(
        F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi"), F.count("*").alias("n")
    )
    nodes = scratch.write(nodes.select("u", "slot", F.col("lo.t").alias("t0"), F.col("lo.id").alias("i0"), F.col("hi.t").alias("t1"), F.col("hi.id").alias("i1"), "n"), "nodes")

    before = nodes.select(F.col("u").alias("pu"), (F.col("slot") + 1).alias("pslot"), F.col("t1").alias("pt1"))
    linked = scratch.write(
        nodes.join(before, (F.col("u") == F.col("pu")) & (F.col("slot") == F.col("pslot")), "left").select(
            *nodes.columns, F.coalesce(F.col("t0") - F.col("pt1") <= gap, F.lit(False)).alias("linked")
        ),
        "linked",
    )
    scratch.drop(nodes)
    done = linked.where("NOT linked").select(*nodes.columns, F.col("slot").alias("root"))
    parts = [done]
    open_nodes = linked.where("linked").select(*nodes.columns, (F.col("slot") - 1).alias("root"))
    while not open_nodes.isEmpty():
        targets = open_nodes.select("u", "slot", "root", F.lit(False).alias("final"))
        for p in parts:
            targets = targets.unionByName(p.select("u", "slot", "root", F.lit(True).alias("final")))
        targets = targets.select(F.col("u").alias("tu"), F.col("slot").alias("tslot"), F.col("root").alias("troot"), "final")
        step = scratch.write(
            open_nodes.join(targets, (F.col("u") == F.col("tu")) & (F.col("root") == F.col("tslot")))
            .select(*nodes.columns, F.col("troot").alias("root"), "final"),
            "pointers",
        )
        scratch.drop(open_nodes)
        parts.append(step.where("final").drop("final"))
        open_nodes = step.where("NOT final").drop("final")
    everything = parts[0]
    for p in parts[1:]:
        everything = everything.unionByName(p)
    grouped = everything.groupBy("u", "root").agg(
        F.min(F.struct("t0", "i0")).alias("a"), F.max(F.struct("t1", "i1")).alias("b"), F.sum("n").alias("n")
    )
    return grouped.select(
        F.col("u").alias("user_name"),
        F.timestamp_micros("a.t0").alias("session_start"),
        F.timestamp_micros("b.t1").alias("session_end"),
        ((F.col("b.t1") - F.col("a.t0")) / F.lit(1_000_000.0)).alias("duration_seconds"),
        F.col("n").cast("bigint").alias("event_count"),
        F.col("a.i0").alias("first_event_id"),
        F.col("b.i1").alias("last_event_id"),
    )
