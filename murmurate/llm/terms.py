"""Occurrences and records of every distinct value, counted in burst tries."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurate.session import Scratch


class BurstTrie:
    """Counters of strings: trie nodes over containers that burst when they outgrow a limit.

    A container maps the rest of a term to ``[occurrences, records]``. When it
    holds more than ``burst`` entries it is replaced by a node with one
    container per next character. ``subtrees`` walks the containers; the path
    to a container is the prefix its terms share.
    """

    __slots__ = ("burst", "root", "size")

    def __init__(self, burst: int = 2048):
        self.burst, self.root, self.size = burst, {}, 0
        self.root = {"leaf": {}}

    def add(self, term: str, occurrences: int, records: int) -> None:
        node, depth = self.root, 0
        while "leaf" not in node:
            at = term[depth : depth + 1]
            if at not in node:
                node[at] = {"leaf": {}}
            node, depth = node[at], depth + 1
        leaf, rest = node["leaf"], term[depth:]
        if rest in leaf:
            counters = leaf[rest]
            counters[0] += occurrences
            counters[1] += records
            return
        leaf[rest] = [occurrences, records]
        self.size += 1
        # A container whose only term has ended cannot be divided further.
        if len(leaf) > self.burst:
            del node["leaf"]
            for tail, counters in leaf.items():
                node.setdefault(tail[:1], {"leaf": {}})["leaf"][tail[1:]] = counters

    def subtrees(self) -> Iterator[tuple[str, dict[str, list[int]]]]:
        stack = [("", self.root)]
        while stack:
            prefix, node = stack.pop()
            if "leaf" in node:
                yield prefix, node["leaf"]
            else:
                stack += [(prefix + at, child) for at, child in node.items()]


_OUT = pa.schema([("field_name", pa.string()), ("term", pa.string()), ("occurrences", pa.int64()), ("records", pa.int64())])
_DDL = "field_name string, term string, occurrences bigint, records bigint"


def _batches(field: str, trie: BurstTrie, rows: int = 50_000):
    cols: tuple[list, list, list] = ([], [], [])
    for prefix, leaf in trie.subtrees():
        for rest, (o, r) in leaf.items():
            cols[0].append(prefix + rest)
            cols[1].append(o)
            cols[2].append(r)
    for i in range(0, len(cols[0]), rows):
        t, o, r = (c[i : i + rows] for c in cols)
        yield pa.RecordBatch.from_arrays(
            [pa.array([field] * len(t), pa.string()), pa.array(t, pa.string()), pa.array(o, pa.int64()), pa.array(r, pa.int64())], schema=_OUT
        )


def _counter(fields: list[str], burst: int, flush: int):
    """Counts one partition's lists, each batch's equal terms combined before they enter the trie."""

    def count(batches):
        tries = {f: BurstTrie(burst) for f in fields}
        for batch in batches:
            for field in fields:
                lists = batch.column(field)
                # Flattening drops NULL lists; parent indices say which record each value came from.
                parent, values = pc.list_parent_indices(lists), pc.list_flatten(lists)
                keep = pc.is_valid(values)
                parent, values = parent.filter(keep), values.filter(keep)
                if not len(values):
                    continue
                lowered = pa.array([v.lower() for v in values.to_pylist()], pa.string())
                pairs = pa.table({"t": lowered, "p": parent}).group_by(["t", "p"]).aggregate([([], "count_all")])
                by_term = pairs.group_by("t").aggregate([("count_all", "sum"), ([], "count_all")])
                for t, o, r in zip(by_term["t"].to_pylist(), by_term["count_all_sum"].to_pylist(), by_term["count_all"].to_pylist()):
                    tries[field].add(t, o, r)
                if tries[field].size > flush:
                    yield from _batches(field, tries[field])
                    tries[field] = BurstTrie(burst)
        for field in fields:
            yield from _batches(field, tries[field])

    return count


def _routes(terms: list[str], want: int) -> dict:
    """A tree of prefixes, burst where terms are many; its leaves are numbered routes."""
    trie = BurstTrie(max(1, len(terms) // want))
    for t in terms:
        trie.add(t, 1, 1)
    numbers = iter(range(1, len(terms) + 2))

    def strip(node):
        return next(numbers) if "leaf" in node else {at: strip(child) for at, child in node.items()}

    return strip(trie.root)


def _router(tree, spare: int):
    def route_of(term: str) -> int:
        node, depth = tree, 0
        while isinstance(node, dict):
            at = term[depth : depth + 1]
            if at not in node:
                # A prefix that no routing term has: terms that share it meet under a route of its own hash.
                return -1 - zlib.crc32(term[: depth + 1].encode("utf-8", "surrogatepass")) % spare
            node, depth = node[at], depth + 1
        return node

    def assign(batches):
        for batch in batches:
            routes = pa.array([route_of(t) for t in batch.column("term").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, routes], schema=_OUT.append(pa.field("route", pa.int32())))

    return assign


def _merger(burst: int, flush: int):
    """Merges the subtrees of one route after the other; the rows arrive sorted by field, route and term.

    As equal terms arrive together, a tree of more than ``flush`` terms is handed
    on between two terms, so a route with any number of terms fits into memory.
    """

    def merge(batches):
        at, last, trie = None, None, BurstTrie(burst)
        for batch in batches:
            for f, t, o, r, n in zip(*(batch.column(c).to_pylist() for c in ("field_name", "term", "occurrences", "records", "route"))):
                if (f, n) != at or trie.size > flush and t != last:
                    if at:
                        yield from _batches(at[0], trie)
                    at, trie = (f, n), BurstTrie(burst)
                trie.add(t, o, r)
                last = t
        if at:
            yield from _batches(at[0], trie)

    return merge


def term_frequencies(
    df: DataFrame,
    *,
    key: str,
    fields: dict[str, str],
    burst: int = 2048,
    flush: int = 400_000,
    routes: int = 1024,
    routing_sample: int = 20_000,
) -> tuple[DataFrame, int]:
    """Counts of every term of every field, and the number of records.

    ``fields`` maps a name to an SQL expression giving ``array<string>``.
    Result: ``field_name, term, occurrences, records``, where ``term`` is the
    value in lower case, ``occurrences`` counts repeats inside a record and
    ``records`` does not. Records are taken once by ``key`` (copies that
    differ: the smallest by all fields); a NULL key is no record. NULL lists,
    empty lists and NULL values count nothing; an empty string is a term.

    Each worker counts in burst tries, so a term's occurrences are combined
    before anything is shuffled, handing on after at most ``flush`` distinct
    terms to bound its memory. The counters are then routed by adaptive
    prefixes: a tree that is burst wherever terms are many, built from about
    ``routing_sample`` terms chosen by hash, which steer the balance of the
    routes and no count. Matching subtrees of all workers meet under their
    route and are merged there, one route at a time and in the order of terms.
    """
    scratch = Scratch(df.sparkSession, "terms")
    names = list(fields)
    if "__all" in names:
        raise ValueError("__all is a reserved field name")
    work = df.select(F.col(f"`{key}`").alias("__k"), *[F.expr(e).alias(n) for n, e in fields.items()]).where("__k IS NOT NULL")
    once = work.groupBy("__k").agg(F.min(F.struct(*[F.col(f"`{n}`") for n in names])).alias("r"))
    # The number of records comes from the same pass, as the one term of a field of its own.
    once = once.select(*[F.col(f"r.`{n}`").alias(n) for n in names], F.array(F.lit("all")).alias("__all"))
    counted = scratch.write(once.mapInArrow(_counter([*names, "__all"], burst, flush), _DDL), "counted")
    total = counted.where("field_name = '__all'").agg(F.sum("records")).first()[0] or 0
    counted = counted.where("field_name <> '__all'")
    # A share of the terms by their hash, so that tasks hand on no more than is used: there are no more terms than rows.
    share = min(1.0, routing_sample / max(counted.count(), 1))
    chosen = F.pmod(F.xxhash64("term"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    sample = sorted(r[0] for r in counted.where(chosen).select("term").distinct().collect())
    routed = counted.mapInArrow(_router(_routes(sample, routes), routes), _DDL + ", route int")
    merged = routed.repartition("field_name", "route").sortWithinPartitions("field_name", "route", "term").mapInArrow(_merger(burst, flush), _DDL)
    return scratch.write(merged, "terms"), int(total)


def mark_terms(counts: DataFrame, total: int, *, rare: int = 2, common: float = 0.02) -> DataFrame:
    """Adds ``mark``: ``rare`` up to ``rare`` records, ``common`` above that share of all records, else NULL.

    A term that is both is ``rare``.
    """
    return counts.withColumn(
        "mark", F.when(F.col("records") <= rare, "rare").when(F.col("records") > F.lit(common) * F.lit(total), "common")
    )
