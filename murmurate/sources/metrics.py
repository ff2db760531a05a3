"""Run metrics: what each materialized stage took."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from murmurate.schema import FEATURE_SCHEMA_VERSION

_L, _D, _S, _B = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
SCHEMA = T.StructType(
    [T.StructField("recorded_at", T.TimestampType())]
    + [T.StructField(c, _S) for c in ("run_id", "pipeline", "schema_version", "stage", "compute", "spark_version", "app_name", "policy", "sentiment_mode", "gold_level", "materialization", "input_name", "output_name", "status")]
    + [T.StructField(c, _L) for c in ("rows_in", "rows_out", "columns_out", "partitions", "workers", "sample_size", "random_state")]
    + [T.StructField(c, _D) for c in ("seconds", "rows_per_second", "ms_per_row_in", "ms_per_row_out")]
    + [T.StructField("validated", _B), T.StructField("sampled", _B)]
)


def compute_kind(spark: SparkSession) -> str:
    return "connect" if "connect" in type(spark).__module__ else "classic"


def worker_hint(spark: SparkSession) -> int | None:
    """Executors as configured, or the cores of a local master."""
    n = spark.conf.get("spark.executor.instances", None)
    if n and n.isdigit():
        return int(n)
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return None


def run_context(spark: SparkSession, pipeline: str, **fields) -> dict:
    """What all stages of a run share; only columns of the schema are kept."""
    base = {"run_id": uuid.uuid4().hex, "pipeline": pipeline, "schema_version": FEATURE_SCHEMA_VERSION, "compute": compute_kind(spark), "spark_version": spark.version, "workers": worker_hint(spark)}
    return base | {k: v for k, v in fields.items() if k in SCHEMA.names}


def stage_metric(context: dict, stage: str, seconds: float, *, rows_in: int | None = None, rows_out: int | None = None, **fields) -> dict:
    """Rows per second of the input, and milliseconds per row; NULL per row where there is no row."""
    per = lambda n: seconds * 1000 / n if n else None
    rate = (rows_in / seconds if seconds > 0 else None) if rows_in is not None else None
    row = {"recorded_at": datetime.now(timezone.utc).replace(tzinfo=None), "stage": stage, "status": "ok", "seconds": float(seconds), "rows_in": rows_in, "rows_out": rows_out, "rows_per_second": rate, "ms_per_row_in": per(rows_in), "ms_per_row_out": per(rows_out)}
    return dict.fromkeys(SCHEMA.names) | context | row | {k: v for k, v in fields.items() if k in SCHEMA.names}


def append_metrics(spark: SparkSession, rows: list[dict], *, table: str | None = None, path: str | None = None) -> None:
    """Appends with the declared schema; nothing to do for no rows."""
    if not rows:
        return
    from murmurate.sources.writers import write

    data = [tuple(r.get(c) for c in SCHEMA.names) for r in rows]
    write(spark.createDataFrame(data, SCHEMA), table=table, path=path, mode="append")


class Stopwatch:
    def __enter__(self):
        self.began = time.perf_counter()
        return self

    def __exit__(self, *_):
        self.seconds = time.perf_counter() - self.began
