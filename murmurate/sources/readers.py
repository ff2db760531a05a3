"""Reading bronze messages, lexicons and collections kept in text cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmurate.schema import BRONZE, as_timestamps, col

CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "FAILFAST", "encoding": "UTF-8"}


def format_available(spark: SparkSession, name: str) -> bool:
    """Whether a data source such as delta is on the class path."""
    if name in ("parquet", "orc", "csv", "json", "text"):
        return True
    try:
        spark._jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource(name, spark._jsparkSession.sessionState().conf())
        return True
    except Exception:
        return False


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if not format_available(spark, fmt):
        raise ValueError(f"the format {fmt!r} is not on the class path")
    return as_timestamps(spark.read.format(fmt).load(path))


def read_bronze(spark: SparkSession, *, table: str | None = None, path: str | None = None, csv: str | None = None, fmt: str = "parquet", schema: T.StructType = BRONZE) -> DataFrame:
    """Bronze messages from a table, a path or CSV; exactly one of them."""
    given = [x for x in (table, path, csv) if x]
    if len(given) != 1:
        raise ValueError("give exactly one of table, path and csv")
    if table:
        return as_timestamps(spark.table(table))
    if path:
        return read_path(spark, path, fmt)
    return read_csv(spark, csv, schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """RFC 4180 CSV with a header and a declared schema; a malformed row or other header fails."""
    return spark.read.schema(schema).options(**CSV).option("enforceSchema", "false").csv(path)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A table of words: CSV with a header where the path ends in .csv, else Parquet."""
    return spark.read.options(**CSV).csv(path) if path.lower().endswith(".csv") else read_path(spark, path)


def literal_to_json(cell: Column) -> Column:
    """A list written as a program literal (single quotes, None, tuples) as JSON."""
    s = F.regexp_replace(cell, r"\bNone\b", "null")
    s = F.regexp_replace(F.regexp_replace(s, r"\bTrue\b", "true"), r"\bFalse\b", "false")
    s = F.regexp_replace(F.regexp_replace(s, r"\(", "["), r",?\s*\)", "]")
    # Quotes that open or close an item; an apostrophe between letters stays.
    return F.regexp_replace(F.regexp_replace(s, r"(?<=[\[{,:\s])'|^'", '"'), r"'(?=\s*[\]},:])", '"')


def collection(cell: Column, ddl: str, name: str, strict: bool = True) -> Column:
    """A text cell as the array type ``ddl``: NULL and blank are empty, JSON first, then a literal.

    A cell that is neither fails, or is empty when not strict.
    """
    text = F.nullif(F.trim(cell), F.lit(""))
    parsed = F.coalesce(F.from_json(text, ddl), F.from_json(literal_to_json(text), ddl))
    parsed = F.when(text.startswith("[") | text.startswith("("), parsed)
    empty = F.lit(None).cast(ddl)
    broken = F.raise_error(F.concat(F.lit(f"malformed collection in {name}: "), F.substring(text, 1, 80))).cast(ddl) if strict else empty
    out = F.when(text.isNull() | F.lower(text).isin("nan", "none"), empty).when(parsed.isNotNull(), parsed).otherwise(broken)
    return F.coalesce(out, F.from_json(F.lit("[]"), ddl))


def read_silver(df: DataFrame, strict: bool = True) -> DataFrame:
    """Silver whose collections may be text (from CSV) or arrays, as arrays of structs."""
    types = {
        "tech_lexicon_matches": "array<struct<term:string,category:string>>", "slang_matches": "array<struct<token:string,type:string,meaning:string>>",
        "glued_matches": "array<struct<term:string,category:string,glue:string,run:string>>", "residual_words": "array<string>",
    }
    for c, ddl in types.items():
        if c in df.columns and dict(df.dtypes)[c] == "string":
            df = df.withColumn(c, collection(col(c), ddl, c, strict))
    return df


def register_views(spark: SparkSession, folder: str, tables: list[str]) -> None:
    """Tables of a folder as temporary views, for SQL over silver and gold."""
    for t in tables:
        as_timestamps(spark.read.parquet(f"{folder}/{t}.parquet")).createOrReplaceTempView(t)
