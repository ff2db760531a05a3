"""Filling fixed-capacity containers with documents."""

from __future__ import annotations

import itertools
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurate.llm.tokens import RANKS, token_count
from murmurate.session import Scratch, shuffle_partitions


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: largest first, each into the fullest bin that still holds it."""
    bins: list[list[int]] = []
    rest: list[tuple[int, int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect_left(rest, (sizes[i], -1))
        if at == len(rest):
            bins.append([i])
            insort(rest, (capacity - sizes[i], len(bins) - 1))
        else:
            left, b = rest.pop(at)
            bins[b].append(i)
            insort(rest, (left - sizes[i], b))
    return bins


def local_search(sizes: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Improves bins until no exchange raises the sum of squared fills.

    The lightest bin gives its items away: by a move, by exchanging one item
    for a smaller one of another underfull bin, or two items for one. Each
    exchange makes a heavier bin heavier, which raises the sum of squares, an
    integer with an upper bound, so the search ends. Bins that run empty are
    dropped.
    """
    load = [sum(sizes[i] for i in b) for b in bins]
    kept = [sorted(b, key=lambda i: sizes[i]) for b in bins]
    active = {b for b in range(len(bins)) if load[b] < capacity}
    stuck: set[int] = set()

    def shift(a: int, b: int, out: list[int], back: list[int]) -> None:
        for i in out:
            kept[a].remove(i)
        for i in back:
            kept[b].remove(i)
        kept[a] = sorted([*kept[a], *back], key=lambda i: sizes[i])
        kept[b] = sorted([*kept[b], *out], key=lambda i: sizes[i])
        change = sum(sizes[i] for i in out) - sum(sizes[i] for i in back)
        load[a] -= change
        load[b] += change

    def largest_pair(items: list[int], most: int) -> list[int] | None:
        """The two items of the largest sum up to ``most``, by two pointers over ascending sizes."""
        x, y, best, pair = 0, len(items) - 1, -1, None
        while x < y:
            s = sizes[items[x]] + sizes[items[y]]
            if s > most:
                y -= 1
                continue
            if s > best:
                best, pair = s, [items[x], items[y]]
                if s == most:
                    break
            x += 1
        return pair

    def improve(a: int, others: list[int]) -> int | None:
        """The bin that took part in the best exchange of bin a, if there is one."""
        best: tuple[int, int, list[int], list[int]] | None = None
        items = kept[a]
        single = [([i], sizes[i]) for i in reversed(items)]
        for b in others:
            room = capacity - load[b]
            theirs = kept[b]
            for out, s in single:
                if s <= room:
                    if best is None or load[b] + s > best[0]:
                        best = (load[b] + s, b, out, [])
                    break
            if best and best[0] == capacity:
                break
            for out, s in single:
                # The smallest of their items that still leaves them within capacity brings the most.
                at = bisect_left(theirs, s - room, key=lambda i: sizes[i])
                if at < len(theirs) and sizes[theirs[at]] < s:
                    gain = load[b] + s - sizes[theirs[at]]
                    if best is None or gain > best[0]:
                        best = (gain, b, out, [theirs[at]])
            # For each of their items, the largest pair that fits in its place; as the item grows, so does the pair.
            for back in dict.fromkeys(sizes[i] for i in theirs):
                if len(items) < 2 or best and best[0] == capacity:
                    break
                pair = largest_pair(items, room + back)
                if pair and (s := sizes[pair[0]] + sizes[pair[1]]) > back and (best is None or load[b] + s - back > best[0]):
                    best = (load[b] + s - back, b, pair, [theirs[bisect_left(theirs, back, key=lambda i: sizes[i])]])
        if best is None:
            return None
        shift(a, best[1], best[2], best[3])
        return best[1]

    def touched(a: int, b: int) -> None:
        for x in (a, b):
            stuck.discard(x)
            if load[x] in (0, capacity):
                active.discard(x)

    while len(active) > 1:
        order = sorted(active - stuck, key=lambda b: (load[b], b))
        if not order:
            break
        a = order[0]
        # Only bins at least as full can gain in squares; the fullest are tried first.
        others = sorted((b for b in active if b != a and load[b] >= load[a]), key=lambda b: (-load[b], b))
        b = improve(a, others)
        if b is None:
            stuck.add(a)
            continue
        touched(a, b)
        # A change can only help a stuck bin through the bins that changed.
        changed = {a, b}
        for x in sorted(stuck, key=lambda x: (load[x], x)):
            near = [y for y in sorted(changed) if y in active and y != x and load[y] >= load[x]]
            y = improve(x, near) if x in active and near else None
            if y is not None:
                touched(x, y)
                changed |= {x, y}
    return [b for b in kept if b]


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    return local_search(sizes, best_fit(sizes, capacity), capacity)


def packed(
    documents: DataFrame,
    capacity: int,
    *,
    shard_items: int = 3000,
    full_enough: float = 0.995,
    tokenizer: str = RANKS,
) -> DataFrame:
    """``doc_id, piece, start_token, tokens, container``: every document's place.

    A document that fits is one piece; only a longer one is cut, into pieces
    of the capacity and a rest. A text without tokens (NULL or empty) has one
    row with 0 tokens and no container. A doc_id counts once (of copies, the
    longest); a NULL doc_id is left out.

    Pieces of the capacity are containers by themselves. The others are spread
    by hash over shards of about ``shard_items`` pieces, whatever their source
    or size, and every shard is packed and improved by local search. Items of
    containers that are not ``full_enough`` are pooled and packed again in
    fewer shards, until they fit into one shard or a level no longer frees
    containers; then they stay as they are. Nothing is left unpacked. Shards
    are tasks of their own, as packing costs time and not bytes.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    scratch = Scratch(documents.sparkSession, "packing")
    sized = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), token_count(F.col("text"), tokenizer).alias("n")).where("doc_id IS NOT NULL")
    sized = scratch.write(sized.groupBy("doc_id").agg(F.max("n").alias("n")), "sized")
    pieces = sized.select("doc_id", "n", F.explode(F.sequence(F.lit(0), F.greatest(F.expr(f"(n - 1) div {capacity}"), F.lit(0)))).alias("piece"))
    pieces = pieces.select(
        "doc_id", F.col("piece").cast("bigint").alias("piece"), (F.col("piece") * F.lit(capacity)).cast("bigint").alias("start_token"),
        F.least(F.col("n") - F.col("piece") * F.lit(capacity), F.lit(capacity)).cast("bigint").alias("tokens"),
    )
    name = F.concat_ws("-", F.lit("full"), "doc_id", "piece")
    ready = [pieces.where(f"tokens = {capacity} OR tokens = 0").withColumn("container", F.when(F.col("tokens") > 0, name))]
    loose = pieces.where(f"tokens BETWEEN 1 AND {capacity - 1}")

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "piece"], kind="stable").reset_index(drop=True)
        sizes = frame.tokens.tolist()
        place, load = [0] * len(sizes), [0] * len(sizes)
        for b, items in enumerate(pack(sizes, capacity)):
            total = sum(sizes[i] for i in items)
            for i in items:
                place[i], load[i] = b, total
        return frame.assign(place=place, load=load)[["doc_id", "piece", "start_token", "tokens", "level", "shard", "place", "load"]]

    ddl = "doc_id bigint, piece bigint, start_token bigint, tokens bigint, level int, shard bigint, place bigint, load bigint"
    count, before = loose.count(), None
    tasks = 4 * shuffle_partitions(documents.sparkSession)
    # Every level leaves fewer containers than the one before or is the last.
    for level in itertools.count():
        if not count:
            break
        shards = -(-count // shard_items)
        shard = F.pmod(F.xxhash64("doc_id", "piece", F.lit(level)), F.lit(shards))
        placed = scratch.write(
            loose.withColumn("level", F.lit(level)).withColumn("shard", shard).repartition(min(shards, tasks), "shard").groupBy("shard").applyInPandas(fill, ddl), f"level{level}"
        )
        named = placed.withColumn("container", F.concat_ws("-", F.lit("c"), "level", "shard", "place"))
        columns = ["doc_id", "piece", "start_token", "tokens", "container"]
        poor = placed.where(F.col("load") < F.lit(full_enough * capacity))
        left, bins = poor.agg(F.count("*"), F.count_distinct("shard", "place")).first()
        if shards == 1 or not left or (before is not None and bins >= before):
            ready.append(named.select(columns))
            break
        ready.append(named.where(F.col("load") >= F.lit(full_enough * capacity)).select(columns))
        loose, count, before = poor.select("doc_id", "piece", "start_token", "tokens"), left, bins
    out = ready[0]
    for part in ready[1:]:
        out = out.unionByName(part)
    return out


def fill_report(placed: DataFrame, capacity: int) -> DataFrame:
    """``containers, tokens, least_containers, fill``: how much of the containers is used."""
    return placed.where("container IS NOT NULL").agg(
        F.count_distinct("container").alias("containers"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")
    ).select(
        "containers", "tokens", F.ceil(F.col("tokens") / F.lit(capacity)).alias("least_containers"),
        F.try_divide("tokens", F.col("containers") * F.lit(capacity)).alias("fill"),
    )
