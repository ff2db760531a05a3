"""Writing tables, scratch tables, audit and metric logs."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from murmurate.schema import FEATURE_SCHEMA_VERSION
from murmurate.session import Scratch
from murmurate.sources.readers import format_available

MODES = ("errorifexists", "overwrite", "append")
MATERIALIZATIONS = ("auto", "persist", "table", "none")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def write(df: DataFrame, *, table: str | None = None, path: str | None = None, mode: str = "errorifexists", fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """To a table or a path, exactly one; schemas are never merged silently."""
    if bool(table) == bool(path):
        raise ValueError("give exactly one of table and path")
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; known are {MODES}")
    if not format_available(df.sparkSession, fmt):
        raise ValueError(f"the format {fmt!r} is not on the class path")
    w = df.write.format(fmt).mode(mode).option("mergeSchema", "false").partitionBy(*partition_by)
    w.saveAsTable(table) if table else w.save(path)


def write_gold(df: DataFrame, *, table: str | None = None, path: str | None = None, fmt: str = "parquet") -> None:
    """Replaces a gold table and its schema."""
    if bool(table) == bool(path):
        raise ValueError("give exactly one of table and path")
    w = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    w.saveAsTable(table) if table else w.save(path)


def write_csv(df: DataFrame, folder: str, name: str) -> str:
    """CSV in the dialect the readers expect; arrays and structs as JSON text."""
    from pyspark.sql import functions as F

    flat = df.withColumns({f.name: F.to_json(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))})
    out = f"{folder}/{name}.csv"
    flat.write.mode("overwrite").options(header="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(out)
    return out


def describe_table(spark: SparkSession, table: str) -> dict:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect() if r["col_name"]}


def quoted(name: str) -> str:
    parts = name.split(".")
    if not 1 <= len(parts) <= 3 or not all(_IDENTIFIER.fullmatch(p) for p in parts):
        raise ValueError(f"not a table name: {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def scratch_table_name(schema: str, stage: str) -> str:
    """``[catalog.]schema._murmurate_<stage>_<hex>``."""
    quoted(schema)
    if len(schema.split(".")) > 2 or not _IDENTIFIER.fullmatch(stage):
        raise ValueError("scratch tables need [catalog.]schema and a plain stage name")
    return f"{schema}._murmurate_{stage}_{uuid.uuid4().hex}"


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def resolve_materialization(mode: str) -> str:
    """``auto`` is a written table on a remote session and persisted blocks otherwise."""
    if mode not in MATERIALIZATIONS:
        raise ValueError(f"unknown materialization {mode!r}; known are {MATERIALIZATIONS}")
    if mode != "auto":
        return mode
    from pyspark.sql.utils import is_remote

    return "table" if is_remote() else "persist"


def kept(df: DataFrame, mode: str = "auto", stage: str = "stage") -> DataFrame:
    """The frame as it is used several times from now on: a written table, persisted blocks, or the plan itself.

    A table outlives lost executors and is dropped when the driver ends or with
    ``session.release``; ``auto`` is a table.
    """
    mode = "table" if mode == "auto" else resolve_materialization(mode)
    return df.persist() if mode == "persist" else Scratch(df.sparkSession, stage).write(df, stage) if mode == "table" else df


@contextmanager
def materialized(df: DataFrame, mode: str = "auto", stage: str = "stage") -> Iterator[DataFrame]:
    """The frame kept for several uses, and released at the end whatever happens."""
    mode = resolve_materialization(mode)
    if mode == "persist":
        kept = df.persist()
        try:
            yield kept
        finally:
            kept.unpersist()
    elif mode == "table":
        scratch = Scratch(df.sparkSession, stage)
        try:
            yield scratch.write(df, stage)
        finally:
            scratch.close()
    else:
        yield df


AUDIT_FIELDS = (
    "completed_at", "schema_version", "stage", "target", "rows", "columns", "passed", "input", "policy", "sentiment", "sample_size", "random_state", "seconds", "validation", "details",
)


def append_audit(path: str, record: dict, *, output: str | None = None) -> dict:
    """Appends one JSON line; refused unless validation passed and the output is there."""
    if not record.get("validation", {}).get("passed"):
        raise ValueError("an audit record needs a passed validation")
    if output is not None and not os.path.exists(output.removeprefix("file://")):
        raise FileNotFoundError(output)
    row = dict.fromkeys(AUDIT_FIELDS) | {k: v for k, v in record.items() if k in AUDIT_FIELDS}
    row |= {"completed_at": datetime.now(timezone.utc).isoformat(), "schema_version": FEATURE_SCHEMA_VERSION, "passed": True}
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(row, sort_keys=True, default=str) + "\n")
    return row


AUDIT_SCHEMA = "completed_at timestamp, schema_version string, stage string, target string, rows bigint, columns int, passed boolean, details_json string"


def append_audit_table(spark: SparkSession, *, stage: str, target: str, rows: int, columns: int, passed: bool, details: dict, table: str | None = None, path: str | None = None) -> None:
    row = [(datetime.now(timezone.utc).replace(tzinfo=None), FEATURE_SCHEMA_VERSION, stage, target, rows, columns, passed, json.dumps(details, sort_keys=True, default=str))]
    write(spark.createDataFrame(row, AUDIT_SCHEMA), table=table, path=path, mode="append")
