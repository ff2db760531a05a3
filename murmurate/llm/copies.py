"""Duplicates hidden by formatting differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurate.functions.temporal import micros, moment, nick
from murmurate.operators.sorted_runs import scan_runs
from murmurate.session import Scratch

_JSON = {"allowUnquotedControlChars": "true", "allowBackslashEscapingAnyCharacter": "true"}
# Private-use characters standing for escaped backslash and quote while a payload is cut into fields.
_BACKSLASH, _QUOTE = "\ue000", "\ue001"


def canonical_text(text: Column) -> Column:
    """Letters and digits in their order, without case (a sharp s is its capital form SS); empty if there are none."""
    return F.regexp_replace(F.replace(F.lower(F.upper(text)), F.lit("ß"), F.lit("ss")), r"[^\p{L}\p{N}]+", "")


_PAIR = r'(?:date|from|text)\s*[:=]\s*"[^"]*+"'
_LIST = rf"(?is)^\s*{_PAIR}\s*[,;|]?\s*{_PAIR}\s*[,;|]?\s*{_PAIR}\s*$"
_EACH = r'(?is)(date|from|text)\s*[:=]\s*"([^"]*+)"\s*[,;|]?\s*'


def with_payload_fields(df: DataFrame, payload: str) -> DataFrame:
    """Adds ``__date, __from, __text`` of an exported payload, NULL unless it is whole.

    Read are JSON objects and ``key = "value"`` or ``key: "value"`` lists with
    ``,``, ``;``, ``|`` or blanks between them, keys in any case and order. A
    list is rewritten as a JSON object, so both are parsed once, in one place.
    """
    raw = F.col(f"`{payload}`").cast("string")
    masked = F.replace(F.replace(raw, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    as_object = F.concat(F.lit("{"), F.regexp_replace(F.regexp_replace(masked, _EACH, '"$1":"$2",'), r",\s*$", ""), F.lit("}"))
    back = F.replace(F.replace(as_object, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    json = F.when(raw.rlike(r"(?s)^\s*\{.*\}\s*$"), raw).when(masked.rlike(_LIST), back)
    # One step per column: an expression that is used several times would be computed as often.
    df = df.withColumn("__map", F.from_json(json, "map<string,string>", _JSON))
    entries = F.transform(F.map_entries("__map"), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    df = df.withColumn("__entries", F.array_distinct(F.filter(entries, lambda e: e["key"].isin("date", "from", "text"))))
    df = df.withColumn("__known", F.when((F.size("__entries") == 3) & (F.size(F.array_distinct(F.transform("__entries", lambda e: e["key"]))) == 3), F.map_from_entries("__entries")))
    return df.withColumns({f"__{k}": F.try_element_at("__known", F.lit(k)) for k in ("date", "from", "text")}).drop("__map", "__entries", "__known")


def canonical_records(df: DataFrame, table: str, id_col: str, *, payload: str | None = None) -> DataFrame:
    """``record_table, id, moment_us, who, canon``, the last three NULL in a record that is no case.

    No case is a record with an unreadable date, without a nick, or whose text
    has no letter or digit, and a payload that is not whole.
    """
    if payload:
        df = with_payload_fields(df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{payload}`").alias("__payload")), "__payload")
    else:
        df = df.select(F.col(f"`{id_col}`").alias("__id"), *[F.col(f"`{c}`").cast("string").alias(f"__{c}") for c in ("date", "from", "text")])
    date, who, text = F.col("__date"), F.col("__from"), F.col("__text")
    parsed = df.select(
        F.col("__id").cast("bigint").alias("id"),
        micros(moment(date)).alias("t"), nick(who).alias("u"), F.nullif(canonical_text(text), F.lit("")).alias("c"),
    )
    case = F.col("t").isNotNull() & F.col("u").isNotNull() & F.col("c").isNotNull()
    return parsed.select(
        F.lit(table).alias("record_table"), "id",
        F.when(case, F.col("t")).alias("moment_us"), F.when(case, F.col("u")).alias("who"), F.when(case, F.col("c")).alias("canon"),
    )


def mark_copies(records: DataFrame, scratch: Scratch) -> DataFrame:
    """``record_table, id, first_id``: every case with the smallest id of its set of same records.

    Canonical records are range-partitioned by table, moment, nick, whole
    canonical text and id, sorted externally, and scanned for runs of equal
    keys, compared in full. As the id is part of the range, a record with any
    number of copies is spread over many partitions.
    """
    # Written once, as finding the ranges reads all records before the shuffle reads them again.
    cases = scratch.write(records.where("canon IS NOT NULL AND id IS NOT NULL"), "canonical")
    runs = scan_runs(
        cases, ["record_table", "moment_us", "who", "canon"], ["id"], scratch=scratch, head="id", keep=["record_table", "id"]
    )
    return runs.select("record_table", "id", F.col("run_head").alias("first_id"))


def copy_pairs(records: DataFrame) -> DataFrame:
    """``record_table, first_id, copy_id``: one row for every record but the first of each set.

    A repeated id is no copy of itself. Empty input gives an empty result.
    """
    marked = mark_copies(records, Scratch(records.sparkSession, "copies"))
    return marked.where("id <> first_id").select("record_table", "first_id", F.col("id").alias("copy_id"))


def collapsed(records: DataFrame) -> DataFrame:
    """``record_table, first_id, copies``: one row per distinct record with its exact count.

    Records that are no case cannot be compared and stay single. Rows that
    repeat an id count as copies; a NULL id is left out.
    """
    marked = mark_copies(records, Scratch(records.sparkSession, "copies"))
    single = records.where("canon IS NULL AND id IS NOT NULL").select("record_table", "id", F.col("id").alias("first_id"))
    return (
        marked.unionByName(single)
        .groupBy("record_table", "first_id")
        .agg(F.count("*").alias("copies"))
        .select("record_table", "first_id", "copies")
    )
