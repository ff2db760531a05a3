"""Joins that Spark has no operator for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmurate.operators.sorted_runs import scan_runs
from murmurate.schema import col
from murmurate.session import Scratch

#: Right sides up to this size, without ``by``, are a constant of the plan.
CONSTANT_ROWS = 200


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    left_on: str,
    right_on: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    direction: str = "backward",
    constant_rows: int = CONSTANT_ROWS,
) -> DataFrame:
    """Adds to each left row the nearest right row at or before (``backward``) or after (``forward``) it.

    Left rows with a NULL time get NULL; right rows with a NULL time are
    ignored; of right rows at one time the largest ``values`` count. A right
    side of at most ``constant_rows`` rows, which is counted first, becomes a
    constant array that each left row looks through. Otherwise both sides are
    stacked, range-partitioned by ``by`` and time, and scanned with the last
    right row carried along, so neither a hot key nor a single moment with any
    number of left rows is one task.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction must be backward or forward")
    back = direction == "backward"
    found = F.struct(col(right_on).cast("timestamp").alias("__at"), F.struct(*[col(v) for v in values]).alias("__values"))
    r = right.where(col(right_on).isNotNull())
    time = col(left_on).cast("timestamp")
    if not by:
        few = r.select(F.unix_micros(col(right_on).cast("timestamp")).alias("at"), F.struct(*[col(v) for v in values]).alias("v")).limit(constant_rows + 1).collect()
        if len(few) <= constant_rows:
            kinds = dict(right.dtypes)
            row = lambda x: F.struct(
                F.timestamp_micros(F.lit(x["at"])).alias("__at"), F.struct(*[F.lit(x["v"][v]).cast(kinds[v]).alias(v) for v in values]).alias("__values")
            )
            at = F.array(*[row(x) for x in few]) if few else F.array().cast(T.ArrayType(r.select(found.alias("v")).schema["v"].dataType))

            def nearest(t):
                if back:
                    return F.array_max(F.filter(at, lambda x: x["__at"] <= t))
                later = F.filter(at, lambda x: x["__at"] >= t)
                return F.array_max(F.filter(later, lambda x: x["__at"] == F.array_min(later)["__at"]))

            # As an element of an array the time is computed once, not once for every row it is compared with.
            hit = F.get(F.transform(F.array(time), nearest), 0)
            return left.withColumn("__hit", hit).select(*[col(c) for c in left.columns], *[F.col(f"__hit.__values.`{v}`").alias(v) for v in values])
    keys = [f"__k{i}" for i in range(len(by))]
    r = r.select(
        *[col(b).alias(k) for b, k in zip(by, keys)], col(right_on).cast("timestamp").alias("__t"), found.alias("__v"), F.lit(0).alias("__side"),
        *[F.lit(None).cast(t).alias(f"__l_{c}") for c, t in left.dtypes],
    )
    # At one moment right rows come before left rows, smaller values before larger, so the largest is carried.
    l = left.select(  # noqa: E741
        *[col(b).alias(k) for b, k in zip(by, keys)], time.alias("__t"), F.lit(None).cast(r.schema["__v"].dataType).alias("__v"),
        F.lit(1).alias("__side"), *[col(c).alias(f"__l_{c}") for c in left.columns],
    )
    both = l.unionByName(r)
    step = F.unix_micros("__t") if back else -F.unix_micros("__t")
    kept = ["__t", "__side", *[f"__l_{c}" for c in left.columns]]
    scanned = scan_runs(both, keys, [step, "__side", "__v"], scratch=Scratch(left.sparkSession, "asof"), fill="__v", keep=kept)
    matched = F.col("__t").isNotNull()
    for b in by:
        matched = matched & F.col(f"`__l_{b}`").isNotNull()
    hit = F.when(matched, F.col("last___v"))
    out = scanned.where("__side = 1").withColumn("__hit", hit)
    return out.select(*[F.col(f"`__l_{c}`").alias(c) for c in left.columns], *[F.col(f"__hit.__values.`{v}`").alias(v) for v in values])
