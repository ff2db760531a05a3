"""The bundle of small gold tables that dashboards read: export, load, contract."""

from __future__ import annotations

import json
import os
import re
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurate.schema import FEATURE_SCHEMA_VERSION, col

# The tables of the bundle and the columns each needs.
REQUIRED = {
    "conversation_summary": ("conversation_id", "message_count", "conversation_was_answered", "conversation_start"),
    "monthly_summary": ("date_period", "message_count"), "correlation_matrix": ("feature",), "statistical_summary": ("feature", "mean"),
    "hypothesis_tests": ("hypothesis", "test", "p_value", "p_value_holm"), "model_selection": ("model", "average_precision"),
    "model_test_metrics": ("model", "roc_auc"), "model_feature_importance": ("feature", "importance"),
}
#: Columns that would expose people or their words.
FORBIDDEN = ("text", "text_cleaned", "from", "to", "message_id", "residual_words", "named_entities", "nlp_tokens")
MOST_ROWS = 1_000_000


def validate_bundle(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows per table; missing tables or columns, exposing columns, bad keys or counts are errors."""
    if missing := sorted(set(REQUIRED) - set(tables)):
        raise ValueError(f"the bundle lacks {missing}")
    rows = {}
    for name, df in tables.items():
        if not re.fullmatch(r"[a-z][a-z0-9_]*", name):
            raise ValueError(f"not a safe table name: {name!r}")
        if lacks := sorted(set(REQUIRED.get(name, ())) - set(df.columns)):
            raise ValueError(f"{name} lacks columns {lacks}")
        if exposed := sorted(set(FORBIDDEN) & set(df.columns)):
            raise ValueError(f"{name} exposes {exposed}")
        if len(set(df.columns)) != len(df.columns):
            raise ValueError(f"{name} has a column twice")
        unique = {"conversation_summary": "conversation_id", "monthly_summary": "date_period"}.get(name)
        aggs = [F.count("*").alias("n")]
        if "message_count" in df.columns:
            aggs.append(F.count_if(col("message_count").isNull() | (col("message_count") < 0)).alias("bad"))
        if unique:
            aggs += [F.count_distinct(col(unique)).alias("d")]
        r = df.agg(*aggs).first().asDict()
        if r.get("bad") or r.get("d", r["n"]) != r["n"]:
            raise ValueError(f"{name} has bad counts or repeated keys")
        rows[name] = r["n"]
    return rows


def export_bundle(tables: dict[str, DataFrame], folder: str) -> dict:
    """Each table to a temporary CSV that replaces the old one, then the manifest with relative paths.

    The tables are gold, small by their nature; one above ``MOST_ROWS`` is refused.
    """
    rows = validate_bundle(tables)
    if big := {k: v for k, v in rows.items() if v > MOST_ROWS}:
        raise ValueError(f"too large for a bundle: {big}")
    root = Path(folder)
    root.mkdir(parents=True, exist_ok=True)
    entries = {}
    for name, df in tables.items():
        target, temporary = root / f"{name}.csv", root / f".{name}.csv.tmp"
        df.toPandas().to_csv(temporary, index=False)
        os.replace(temporary, target)
        entries[name] = {"path": target.name, "rows": rows[name], "columns": df.columns}
    manifest = {"schema_version": FEATURE_SCHEMA_VERSION, "created_at": datetime.now(timezone.utc).isoformat(), "tables": entries}
    temporary = root / ".manifest.json.tmp"
    temporary.write_text(json.dumps(manifest, indent=2, sort_keys=True))
    os.replace(temporary, root / "manifest.json")
    return manifest


def load_bundle(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a bundle after checks of version, paths and contract; dates UTC, booleans tolerant."""
    root = Path(folder).resolve()
    manifest = json.loads((root / "manifest.json").read_text())
    if manifest.get("schema_version") != FEATURE_SCHEMA_VERSION:
        raise ValueError(f"bundle of schema {manifest.get('schema_version')}, expected {FEATURE_SCHEMA_VERSION}")
    out = {}
    for name, entry in manifest["tables"].items():
        path = (root / entry["path"]).resolve()
        if root not in path.parents:
            raise ValueError(f"{entry['path']} lies outside the bundle")
        if not path.exists():
            raise FileNotFoundError(path)
        df = spark.read.options(header="true", quote='"', escape='"', multiLine="true").schema(", ".join(f"`{c}` string" for c in entry["columns"])).csv(f"file://{path}")
        casts = {}
        for c in df.columns:
            if c in ("conversation_start", "conversation_end", "date_period"):
                casts[c] = col(c).try_cast("timestamp")
            elif c == "conversation_was_answered":
                casts[c] = F.lower(F.trim(col(c))).isin("true", "1", "1.0", "yes", "t")
            elif c.endswith("_count"):
                casts[c] = col(c).try_cast("double").cast("bigint")
            elif c in ("mean", "p_value", "p_value_holm", "average_precision", "roc_auc", "importance") or c.startswith("avg_"):
                casts[c] = col(c).try_cast("double")
        out[name] = df.withColumns(casts)
    validate_bundle(out)
    return out
