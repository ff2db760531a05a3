"""Distributions over classes: checks, entropy, margin, expected sentiment."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_probabilities(columns: Sequence[Column], tolerance: float = 1e-5) -> Column:
    """The probabilities as an array that sums to 1; missing, out-of-range or badly summing ones fail.

    All missing is no distribution and gives NULL.
    """
    values = F.array(*[c.cast("double") for c in columns])
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    none = F.forall(values, lambda x: x.isNull())
    bad = F.exists(values, lambda x: x.isNull() | (x < 0) | (x > 1))
    return (
        F.when(none, F.lit(None).cast("array<double>"))
        .when(F.coalesce(bad, F.lit(True)), F.raise_error(F.lit("a class probability is missing or outside 0 to 1")).cast("array<double>"))
        .when(F.abs(total - 1) > tolerance, F.raise_error(F.lit("class probabilities must sum to 1")).cast("array<double>"))
        .otherwise(F.transform(values, lambda x: x / total))
    )


def entropy(p: Column) -> Column:
    return F.aggregate(F.transform(p, lambda x: F.when(x > 0, -x * F.ln(x)).otherwise(0.0)), F.lit(0.0), lambda a, x: a + x)


def normalized_entropy(p: Column, classes: int) -> Column:
    return entropy(p) / F.lit(math.log(classes))


def margin(p: Column) -> Column:
    """The largest probability less the second largest."""
    falling = F.sort_array(p, False)
    return F.get(falling, F.lit(0)) - F.coalesce(F.get(falling, F.lit(1)), F.lit(0.0))


def top_label(p: Column, labels: Sequence[str]) -> Column:
    """The label of the largest probability; the first of equal ones."""
    place = F.array_position(p, F.array_max(p)).cast("int")
    return F.try_element_at(F.array(*[F.lit(x) for x in labels]), place)


def class_columns(prefix: str, labels: Sequence[str], p: Column) -> dict[str, Column]:
    """A distribution spread into probability, label, score, entropy and margin columns."""
    out = {f"{prefix}_{x.lower()}": F.get(p, F.lit(i)) for i, x in enumerate(labels)}
    out |= {
        f"{prefix}_label": top_label(p, labels), f"{prefix}_score": F.array_max(p), f"{prefix}_entropy": entropy(p),
        f"{prefix}_normalized_entropy": normalized_entropy(p, len(labels)), f"{prefix}_margin": margin(p),
    }
    return out
