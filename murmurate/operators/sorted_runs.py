"""Scanning globally sorted rows for runs, without putting a run into one task.

Rows are range-partitioned by group and order columns together and sorted
externally inside each partition, so a group of any size is spread over as many
partitions as its rows fill. Each partition is scanned once; the group that
crosses a partition border is completed from one border row per partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from murmurate.session import Scratch, shuffle_partitions

_EDGE = [
    T.StructField("__run_first_g", T.StringType()),
    T.StructField("__run_last_g", T.StringType()),
    T.StructField("__run_last_sum", T.LongType()),
    T.StructField("__run_last_n", T.LongType()),
    T.StructField("__run_last_head", T.LongType()),
    T.StructField("__run_single", T.BooleanType()),
]
#: Longer keys are named by their SHA-256 in border rows, so that those stay small.
_LONGEST_NAME = 256


def _name(key: str) -> str:
    return key if len(key) <= _LONGEST_NAME else "\u0000" + hashlib.sha256(key.encode("utf-8", "surrogatepass")).hexdigest()


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with every part optional, as rows without a predecessor have none."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    return kind


def _flat(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _scanner(kept: list[str], lag: list[str], fill: str | None, arrow_schema: pa.Schema):
    """The partition scan: adds running sum, rank, head, previous and last values, and ends with one border row."""

    def scan(batches):
        pid = TaskContext.get().partitionId()
        first_g = last_g = None
        total = count = head = 0
        in_first, seen = True, False
        before_row: dict[str, pa.Array] = {}
        filled: pa.Array | None = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g = batch.column("__run_g")
            value = np.asarray(batch.column("__run_v").to_numpy(zero_copy_only=False), dtype=np.int64)
            key = np.asarray(batch.column("__run_h").to_numpy(zero_copy_only=False), dtype=np.int64)
            new = np.ones(n, bool)
            if n > 1:
                new[1:] = pc.not_equal(g.slice(1), g.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            lead = g[0].as_py()
            if not seen:
                first_g = lead
            carried = seen and lead == last_g
            if seen and not carried:
                in_first = False
            new[0] = not carried
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            at = np.maximum(start, 0)
            before = np.concatenate(([0], np.cumsum(value)))
            running = before[1:] - before[at]
            rank = np.arange(n) - at + 1
            heads = key[at]
            old = start < 0
            if carried:
                running[old] += total
                rank[old] += count
                heads[old] = head
            opened = np.zeros(n, bool)
            if in_first:
                later = np.flatnonzero(new[1:]) + 1
                stop = later[0] if len(later) else n
                opened[:stop] = True
                in_first = not len(later)
            total, count, head = int(running[-1]), int(rank[-1]), int(heads[-1])
            last_g, seen = g[n - 1].as_py(), True
            cols = [batch.column(c) for c in kept]
            cols += [pa.array(running), pa.array(rank), pa.array(heads), pa.array(opened)]
            cols += [pa.array(np.full(n, pid, np.int32)), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())]
            cols += [pa.nulls(n, pa.int64())] * 3 + [pa.nulls(n, pa.bool_())]
            for c in lag:
                own = batch.column(f"__run_lag_{c}")
                # Place 0 holds the row before this batch; the first row of a group has none before it.
                line = pa.concat_arrays([before_row.get(c, pa.nulls(1, own.type)), own])
                cols.append(line.take(pa.array(np.arange(n), mask=new)))
                before_row[c] = own.slice(n - 1)
            if fill:
                own = batch.column(f"__run_fill_{fill}")
                valid = own.is_valid().to_numpy(zero_copy_only=False)
                near = np.maximum.accumulate(np.where(valid, np.arange(n), -1))
                none = np.where(old, (near < 0) & (filled is None), near < start)
                line = pa.concat_arrays([filled if filled is not None else pa.nulls(1, own.type), own])
                got = _flat(line.take(pa.array(near + 1, mask=none)))
                cols.append(got)
                filled = got.slice(n - 1)
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow_schema)], schema=arrow_schema)
        if seen:
            edge: dict[str, pa.Array] = {
                "__run_pid": pa.array([pid], pa.int32()), "__run_first_g": pa.array([_name(first_g)]), "__run_last_g": pa.array([_name(last_g)]), "__run_last_sum": pa.array([total]),
                "__run_last_n": pa.array([count]), "__run_last_head": pa.array([head]), "__run_single": pa.array([in_first]),
            }
            edge |= {f"prev_{c}": v for c, v in before_row.items()}
            if fill:
                edge[f"last_{fill}"] = filled
            yield pa.RecordBatch.from_arrays([edge[f.name].cast(f.type) if f.name in edge else pa.nulls(1, f.type) for f in arrow_schema], schema=arrow_schema)

    return scan


def scan_runs(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    *,
    scratch: Scratch,
    value: Column | None = None,
    head: str | None = None,
    partitions: int | None = None,
    keep: Sequence[str] | None = None,
    lag: Sequence[str] = (),
    fill: str | None = None,
    descending: bool = False,
) -> DataFrame:
    """Adds to each row its place in its group under a total order.

    ``running_total``: inclusive sum of ``value`` (integers, NULL counts as 0);
    ``run_rank``: 1-based place; ``run_head``: ``head`` (a bigint column) of the
    group's first row; ``prev_<c>`` for every ``lag`` column: its value in the
    row before, NULL in the first; ``last_<c>`` for the ``fill`` column: its last
    value that is not NULL, up to and with this row. NULL is a group of its own.
    ``descending`` turns the order round. Rows that tie in ``order`` take any
    order among themselves, so pass a unique column last. An empty input gives
    an empty result. ``keep`` names the columns of the result, by default all.
    Without a group all rows are one.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    kept = list(keep if keep is not None else df.columns)
    added = {"running_total", "run_rank", "run_head", *[f"prev_{c}" for c in lag], *([f"last_{fill}"] if fill else [])}
    if clash := added & set(kept):
        raise ValueError(f"columns already exist: {sorted(clash)}")
    # Lengths after the parts make the joined key unambiguous whatever the texts hold, and leave its beginning to the values, by which sorting is quick.
    texts = [F.col(f"`{c}`").cast("string") for c in group]
    lengths = [F.concat(F.lit("|"), F.coalesce(F.length(t).cast("string"), F.lit("-"))) for t in texts]
    order_cols = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order]
    names = [f"__run_o{i}" for i in range(len(order_cols))]
    work = df.select(
        *[F.col(f"`{c}`") for c in kept],
        F.concat(F.lit(""), *[F.coalesce(t, F.lit("")) for t in texts], *lengths).alias("__run_g"),
        F.coalesce(value if value is not None else F.lit(1), F.lit(0)).cast("bigint").alias("__run_v"),
        F.coalesce((F.col(f"`{head}`") if head else F.lit(0)).cast("bigint"), F.lit(0)).alias("__run_h"),
        *[F.col(f"`{c}`").alias(f"__run_lag_{c}") for c in lag], *([F.col(f"`{fill}`").alias(f"__run_fill_{fill}")] if fill else []),
        *[c.alias(n) for c, n in zip(order_cols, names)],
    )
    sort_by = [F.col("__run_g"), *[F.col(n).desc() if descending else F.col(n) for n in names]]
    ranged = work.repartitionByRange(partitions or shuffle_partitions(spark), *sort_by).sortWithinPartitions(*sort_by)
    kinds = {f.name: f.dataType for f in work.schema.fields}
    out = T.StructType(
        [
            *[T.StructField(c, _nullable(kinds[c]), True) for c in kept],
            T.StructField("running_total", T.LongType()),
            T.StructField("run_rank", T.LongType()),
            T.StructField("run_head", T.LongType()),
            T.StructField("__run_open", T.BooleanType()),
            T.StructField("__run_pid", T.IntegerType()),
            *_EDGE,
            *[T.StructField(f"prev_{c}", _nullable(kinds[f"__run_lag_{c}"]), True) for c in lag],
            *([T.StructField(f"last_{fill}", _nullable(kinds[f"__run_fill_{fill}"]), True)] if fill else []),
        ]
    )
    scanned = scratch.write(ranged.mapInArrow(_scanner(kept, list(lag), fill, to_arrow_schema(out)), out), "runs")
    edges = scanned.where(F.col("__run_single").isNotNull())
    carried = [f"prev_{c}" for c in lag]
    # One row per non-empty partition: the only global window, over a number of rows fixed by the plan.
    w = Window.orderBy("__run_pid")
    edges = edges.select(
        "__run_pid", "__run_last_sum", "__run_last_n", "__run_last_head", *carried, *([f"last_{fill}"] if fill else []),
        F.coalesce(F.col("__run_first_g") == F.lag("__run_last_g").over(w), F.lit(False)).alias("cont"),
        "__run_single",
    )
    edges = edges.withColumn("seg", F.sum((~(F.col("__run_single") & F.col("cont"))).cast("int")).over(w))
    s = Window.partitionBy("seg").orderBy("__run_pid")
    edges = edges.select(
        "__run_pid", "cont", *[F.col(c).alias(f"c_{c}") for c in carried],
        F.sum("__run_last_sum").over(s).alias("c_sum"),
        F.sum("__run_last_n").over(s).alias("c_n"),
        F.first("__run_last_head").over(s).alias("c_head"),
        *([F.last(f"last_{fill}", ignorenulls=True).over(s).alias("c_fill")] if fill else []),
    )
    whole = ["c_sum", "c_n", "c_head", *[f"c_{c}" for c in carried], *(["c_fill"] if fill else [])]
    carry = edges.select("__run_pid", "cont", *[F.lag(c).over(w).alias(c) for c in whole]).where("cont").select(F.col("__run_pid").alias("__run_c_pid"), *whole)
    rows = scanned.where(F.col("__run_single").isNull())
    # At most one row per partition, so the broadcast side is bounded by the plan.
    joined = rows.join(F.broadcast(carry), F.col("__run_open") & (F.col("__run_pid") == F.col("__run_c_pid")), "left")
    first = F.col("run_rank") == 1
    return joined.select(
        *[F.col(f"`{c}`") for c in kept],
        (F.col("running_total") + F.coalesce("c_sum", F.lit(0))).alias("running_total"),
        (F.col("run_rank") + F.coalesce("c_n", F.lit(0))).alias("run_rank"),
        F.coalesce("c_head", "run_head").alias("run_head"),
        *[F.when(first, F.col(f"c_{c}")).otherwise(F.col(c)).alias(c) for c in carried],
        *([F.coalesce(f"last_{fill}", "c_fill").alias(f"last_{fill}")] if fill else []),
    )
