"""Names, types and fixed vocabularies of messages on their way from bronze to gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEATURE_SCHEMA_VERSION = "2.2.0"

#: Recipients that stand for nobody in particular.
TO_ALL, TO_UNANSWERED = "__ALL__", "__UNANSWERED__"
SENTINELS = (TO_ALL, TO_UNANSWERED)

BRONZE = T.StructType([T.StructField(c, T.StringType()) for c in ("folder", "dialogueID", "date", "from", "to", "text")])

# Label and placeholder tokens that stand in cleaned text.
LATIN_LABELS = ("SPANISH", "PORTUGUESE", "FRENCH", "GERMAN", "ITALIAN", "DUTCH", "JAPANESE")
SCRIPT_LABELS = (
    "HAN_CHINESE_JAPANESE_KANJI", "JAPANESE_HIRAGANA", "JAPANESE_KATAKANA", "KOREAN_HANGUL", "CYRILLIC", "ARABIC",
    "HEBREW", "GREEK", "THAI", "DEVANAGARI", "ARMENIAN", "GEORGIAN", "ETHIOPIC", "MALAYALAM", "TAMIL", "SINHALA",
)
LANGUAGE_LABELS = LATIN_LABELS + SCRIPT_LABELS
RESIDUAL_LABELS = ("JARGON", "NONWORD", "UNCERTAIN") + LANGUAGE_LABELS
PLACEHOLDERS = {
    "domain": "WEBSITEDOMAIN", "email": "EMAILADDRESS", "phone": "PHONENUMBER", "ssn": "SSN",
    "ipv4": "IPADDRESS", "ipv6": "IPV6ADDRESS", "menu_path": "MENUPATH", "keyboard_shortcut": "KEYBOARDSHORTCUT",
}
STRIPPED_LABELS = RESIDUAL_LABELS + tuple(PLACEHOLDERS.values())
SENTIMENT_LABELS = ("NEGATIVE", "NEUTRAL", "POSITIVE")
EMOTION_LABELS = ("ANGER", "DISGUST", "FEAR", "JOY", "NEUTRAL", "SADNESS", "SURPRISE")

GLUED = T.ArrayType(
    T.StructType([T.StructField(c, T.StringType()) for c in ("term", "category", "glue", "run")])
)
TERMS = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("category", T.StringType())]))
SLANG = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("token", "type", "meaning")]))

CORE_COUNTS = tuple(f"{k}_count" for k in PLACEHOLDERS) + ("tech_lexicon_match_count", "slang_match_count", "glued_match_count")


def normalized_names(df: DataFrame) -> DataFrame:
    """Column names stripped, lower-cased, blanks to ``_``; ``dialogueid`` becomes ``dialogue_id``."""
    names = ["_".join(c.strip().lower().split()) for c in df.columns]
    names = ["dialogue_id" if n == "dialogueid" else n for n in names]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"column names are not unique once normalized: {twice}")
    return df.toDF(*names)


def require(df: DataFrame, columns: list[str], context: str) -> None:
    if missing := sorted(set(columns) - set(df.columns)):
        raise KeyError(f"{context} needs columns {missing}")


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def as_timestamps(df: DataFrame) -> DataFrame:
    """Timestamps without a zone as UTC timestamps, so that time arithmetic applies to them."""
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: col(c).cast("timestamp") for c in naive}) if naive else df
