"""Joins whose left side may hold a third of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], *, spread: Sequence[str], how: str = "inner", salts: int = 16) -> DataFrame:
    """Equi-join that divides every left key over ``salts`` tasks.

    The salt is a hash of the ``spread`` columns, so a recomputed task salts its
    rows as before. The right side, which should have few rows per key, is
    repeated ``salts`` times, and as such a side Spark measures it when it
    decides on a broadcast. NULL keys match nothing, as in any equi-join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread]), F.lit(salts)))
    # Spark takes a side for no larger after explode, but a join for the product of its sides: so many blocks, at 8 bytes each, make up for the salts.
    block, last = F.col("__block"), F.lit(salts - 1).cast("bigint")
    blocks = left.sparkSession.range(-(-salts // 8), numPartitions=1).select(F.col("id").alias("__block"))
    repeated = right.crossJoin(blocks).withColumn("__salt", F.explode(F.sequence(block * 8, F.least(block * 8 + 7, last)))).drop("__block")
    if how == "inner":  # either side could be broadcast, and the left one, often words of texts, is many times what Spark expects of it
        repeated = repeated.hint("merge")
    return salted.join(repeated, [*on, "__salt"], how).drop("__salt")
