"""A sample that is the same in every run and only grows as data grows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hash values are the first 32 bits of an MD5, so every engine can repeat them.
HASH_RANGE = 2**32


def key_hash(key: Column, salt: str) -> Column:
    """A number in [0, 2**32) that depends on the key and the salt alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{salt}|"), key.cast("string")).cast("binary")), 1, 8), 16, 10).cast("bigint")


def threshold_of(rate: float) -> int:
    if not 0 <= rate <= 1:
        raise ValueError("a rate lies between 0 and 1")
    return round(rate * HASH_RANGE)


def raise_thresholds(earlier: Mapping[str, int], rates: Mapping[str, float]) -> dict[str, int]:
    """Thresholds per stratum that are never below earlier ones, so no earlier choice is lost."""
    wanted = {k: threshold_of(r) for k, r in rates.items()}
    return {k: max(earlier.get(k, 0), wanted.get(k, 0)) for k in sorted({*earlier, *wanted})}


def grown(
    rates: Mapping[str, float], default: float, earlier: Mapping[str, int] | None = None, earlier_default: int = 0
) -> tuple[dict[str, int], int]:
    """Thresholds and default for new rates, neither below what an earlier sample was drawn with.

    A stratum without an earlier entry was drawn at the earlier default; one
    that no longer has a rate of its own has the default's.
    """
    earlier = earlier or {}
    new_default = max(earlier_default, threshold_of(default))
    before = {k: earlier.get(k, earlier_default) for k in {*earlier, *rates}}
    return raise_thresholds(before, {**dict.fromkeys(earlier, default), **rates}), new_default


def thresholds_table(spark: SparkSession, thresholds: Mapping[str, int], default: int) -> DataFrame:
    """``stratum, threshold``, to be stored with the sample; the default has stratum NULL."""
    return spark.createDataFrame([(None, default), *sorted(thresholds.items())], "stratum string, threshold bigint")


def stored_thresholds(table: DataFrame) -> tuple[dict[str, int], int]:
    """Thresholds and default from such a table; an empty one is no earlier sample."""
    rows = [(r["stratum"], r["threshold"]) for r in table.select("stratum", "threshold").collect()]
    return {k: v for k, v in rows if k is not None}, max((v for k, v in rows if k is None), default=0)


def stable_sample(
    df: DataFrame,
    *,
    key: str,
    stratum: str,
    thresholds: Mapping[str, int],
    default: int,
    salt: str = "sample-1",
    version: tuple[str, ...] = (),
) -> DataFrame:
    """``<key>, stratum, key_hash``: the keys whose salted hash lies under their stratum's threshold.

    A row is judged by its own key and stratum, never by its place or by other
    rows, so reruns, other partitionings and added rows leave every earlier
    choice as it was. A key delivered several times appears once, with the
    stratum of its first chosen copy by ``version`` columns (then the smallest
    stratum). A NULL stratum is the stratum ``''``; a NULL key is never chosen.
    Strata without a threshold use ``default``. ``thresholds`` is a small
    mapping by design (one entry per stratum that has a rate of its own).

    The filter runs before the only shuffle, which holds chosen rows alone.
    """
    s = F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit(""))
    limit = F.lit(default)
    if thresholds:
        table = F.create_map(*[x for k, v in sorted(thresholds.items()) for x in (F.lit(k), F.lit(int(v)).cast("bigint"))])
        limit = F.coalesce(F.try_element_at(table, s), F.lit(default).cast("bigint"))
    chosen = df.select(
        F.col(f"`{key}`").alias("__key"), s.alias("__s"), key_hash(F.col(f"`{key}`"), salt).alias("__h"),
        F.struct(*[F.col(f"`{v}`") for v in version], s).alias("__v"), limit.alias("__t"),
    ).where("__key IS NOT NULL AND __h < __t")
    return (
        chosen.groupBy("__key", "__h")
        .agg(F.min("__v").alias("v"))
        .select(F.col("__key").alias(key), F.col(f"v.{_last_field(len(version))}").alias("stratum"), F.col("__h").alias("key_hash"))
    )


def _last_field(n: int) -> str:
    return f"col{n + 1}"
