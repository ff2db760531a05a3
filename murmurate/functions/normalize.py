"""Spelling of chat text: corrections, drawn-out fillers, labels, scripts and unusual characters."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurate.schema import STRIPPED_LABELS

#: A small correction table; pass another (word in lower case to correction) for more.
CORRECTIONS = {
    "dont": "don't", "doesnt": "doesn't", "didnt": "didn't", "cant": "can't", "wont": "won't", "isnt": "isn't", "wasnt": "wasn't",
    "youre": "you're", "thats": "that's", "whats": "what's", "ive": "I've", "im": "I'm", "doesn": "doesn't", "didn": "didn't",
    "thx": "thanks", "thnx": "thanks", "plz": "please", "pls": "please", "u": "you", "ur": "your", "teh": "the", "recieve": "receive",
    "definately": "definitely", "seperate": "separate", "dirver": "driver", "reboting": "rebooting", "gonna": "going to", "wanna": "want to",
}

# Accented spellings that are corrected, and drawn-out fillers with their plain form,
# the first that fits the whole word.
LATIN_CORRECTIONS = {
    "thankś": "thanks", "networksß": "networks", "iḿ": "I'm", "iĺl": "I'll", "itś": "it's", "helló": "hello", "vírus": "virus", "vídeos": "videos",
    "vidéo": "video", "runß": "run", "thatß": "that", "thinkç": "think", "ók": "ok", "i'äm": "I am", "fæces": "feces", "âss": "ass", "wíth": "with",
    "ｒｅｓｏｌｕｔｉｏｎ": "resolution", "installé": "install", "sörry": "sorry", "héhé": "hehe",
    "sǝdʎʇ": "types", "sʎɐʍlɐ": "always", "uʍop": "down", "ubuntuß": "ubuntu", "whatś": "what's",
    "ǝpısdn": "upside", "ǝɯɐu": "name", "ʎuɐ": "any", "ʎɯ": "my",
}
FILLERS = (
    (r"(?=.*ha)[ha]+", "haha"), (r"(?=.*heh)[he]+", "hehe"), (r"hm+", "hmm"), (r"oh+", "oh"), (r"o{2,}h*", "ooh"), (r"uh*m+", "um"),
    (r"uh+", "uh"), (r"gr+", "grr"), (r"ah+", "ah"), (r"hi+", "hi"), (r"eh+", "eh"), (r"ew+", "ew"), (r"aw+e*", "aw"), (r"wa+h+", "wah"),
    (r"hello+", "hello"), (r"argh(?:gh)*h*", "argh"), (r"a{2,}h+", "aah"), (r"to{2,}", "too"), (r"na+h+", "nah"), (r"lo+l+", "lol"),
    (r"no+", "no"), (r"erm+", "erm"),
)
DEJA_VU = r"(?iU)\bd[eé]j[aàá][\s-]*vu\b"


def filler(word: str) -> str | None:
    """The plain form of a drawn-out filler in lower case, or None."""
    for shape, plain in _compiled_fillers():
        if shape.fullmatch(word):
            return plain
    return None


@lru_cache(maxsize=1)
def _compiled_fillers():
    return [(re.compile(p), plain) for p, plain in FILLERS]


def normalize_one(text: str, corrections: Mapping[str, str]) -> str:
    """Corrects whole words that no apostrophe follows, keys with apostrophes first."""
    with_marks = sorted((k for k in corrections if not k.replace("_", "a").isalnum()), key=len, reverse=True)
    if with_marks:
        pattern = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, with_marks)) + r")(?!\w)(?!')", re.IGNORECASE)
        text = pattern.sub(lambda m: corrections[m.group().lower()], text)

    def fixed(m: re.Match) -> str:
        lower = m.group().lower()
        return corrections.get(lower) or filler(lower) or m.group()

    return re.sub(r"\b\w+\b(?!')", fixed, text)


def normalized(text: Column, corrections: Mapping[str, str] | None = None) -> Column:
    """Latin corrections, then chat corrections and fillers; NULL as empty.

    The words go through one dictionary lookup each in an Arrow UDF: a regular
    expression of all corrections in the JVM is far slower, and its literal map too.
    """
    chat = {k.lower(): v for k, v in (CORRECTIONS if corrections is None else corrections).items()}
    latin = dict(LATIN_CORRECTIONS)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        latin_words = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, latin), key=len, reverse=True)) + r")\b", re.IGNORECASE)
        out = []
        for t in texts:
            if t and not t.isascii():
                t = latin_words.sub(lambda m: latin[m.group().lower()], t)
            out.append(normalize_one(t, chat) if t else "")
        return pd.Series(out, dtype=object)

    return run(F.regexp_replace(F.coalesce(text, F.lit("")), DEJA_VU, "deja vu"))


def repaired_contractions(text: Column) -> Column:
    """``doesn't't`` to ``doesn't``."""
    return F.regexp_replace(text, r"(?iU)\b(\w+n't)(?:'t)+", "$1")


def without_labels(text: Column) -> Column:
    """Text without label and placeholder tokens."""
    tokens = "|".join(sorted(STRIPPED_LABELS, key=len, reverse=True))
    return F.regexp_replace(text, rf"(?U)\b(?:{tokens})\b", "")


def is_effectively_empty(text: Column) -> Column:
    return text.isNull() | ~text.rlike(r"\p{L}")


# Scripts whose runs are replaced, by the name Java's regular expressions know them.
SCRIPTS = {
    "HAN_CHINESE_JAPANESE_KANJI": "IsHan", "JAPANESE_HIRAGANA": "IsHiragana", "JAPANESE_KATAKANA": "IsKatakana", "KOREAN_HANGUL": "IsHangul",
    "CYRILLIC": "IsCyrillic", "ARABIC": "IsArabic", "HEBREW": "IsHebrew", "GREEK": "IsGreek", "THAI": "IsThai", "DEVANAGARI": "IsDevanagari",
    "ARMENIAN": "IsArmenian", "GEORGIAN": "IsGeorgian", "ETHIOPIC": "IsEthiopic", "MALAYALAM": "IsMalayalam", "TAMIL": "IsTamil", "SINHALA": "IsSinhala",
}


def labelled_scripts(text: Column) -> Column:
    """Runs of a foreign script as its label; a label repeated side by side stays once."""
    for label, script in SCRIPTS.items():
        text = F.regexp_replace(text, rf"\p{{{script}}}+", f" {label} ")
    for label in SCRIPTS:
        text = F.regexp_replace(text, rf"\b{label}(?:\s+{label}\b)+", label)
    return F.trim(F.regexp_replace(text, r" {2,}", " "))


def character_counts(df: DataFrame, text: str) -> DataFrame:
    """``ch, occurrences`` of every character that is neither an ASCII letter nor a blank."""
    found = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"(?s)[^A-Za-z ]"), F.lit(0))
    return df.select(F.explode(found).alias("ch")).groupBy("ch").agg(F.count("*").alias("occurrences"))


def character_class(ch: Column) -> Column:
    """A named class of a character: digits, ASCII signs, arrows, emoji, scripts, accents and the rest."""
    ranges = (
        (r"[0-9]", "ascii_digit"), (r"[\t\n\r\x0B\f]", "ascii_whitespace"), (r"[\x00-\x1F\x7F]", "ascii_control"),
        (r"[.,;:!?]", "ascii_sentence_sign"), (r"['\"`]", "ascii_quote"), (r"[()\[\]{}<>]", "ascii_bracket"),
        (r"[+*/=%^~|\\-]", "ascii_operator"), (r"[@#$&_]", "ascii_symbol"),
        (r"[\x{1F300}-\x{1FAFF}]", "emoji"), (r"[\x{2600}-\x{27BF}]", "dingbat"), (r"[\x{2190}-\x{21FF}\x{27F0}-\x{27FF}\x{2900}-\x{297F}]", "arrow"),
        (r"[\x{2500}-\x{257F}]", "box_drawing"), (r"[\x{2580}-\x{259F}]", "block_element"), (r"[\x{25A0}-\x{25FF}]", "geometric_shape"),
        (r"[\x{2200}-\x{22FF}]", "math_operator"), (r"[\x{2800}-\x{28FF}]", "braille"), (r"[\x{FF00}-\x{FFEF}]", "full_width"),
        (r"[\x{00C0}-\x{024F}&&\p{L}]", "latin_extended"), (r"[\x{0250}-\x{02AF}]", "phonetic"),
        *[(rf"\p{{{s}}}", label.lower()) for label, s in SCRIPTS.items()],
        (r"\p{M}", "combining_mark"), (r"\p{Sc}", "currency"), (r"\p{Sm}", "math_symbol"), (r"\p{Sk}", "modifier_symbol"), (r"\p{So}", "other_symbol"),
        (r"\p{Nd}", "other_digit"), (r"\p{N}", "other_number"), (r"\p{Z}", "separator"), (r"\p{Cf}", "format"), (r"\p{Co}", "private_use"),
        (r"[\p{Pi}\p{Pf}]", "typographic_quote"), (r"\p{Pd}", "dash"), (r"\p{P}", "other_sign"), (r"\p{L}", "other_letter"),
    )
    out = F.when(ch.isNull(), F.lit(None).cast("string"))
    for pattern, name in ranges:
        out = out.when(ch.rlike(f"^{pattern}$"), name)
    return out.otherwise("other:unassigned")


def rare_characters_replaced(df: DataFrame, text: str, least: int = 10, marker: str = "�") -> DataFrame:
    """Characters that occur fewer than ``least`` times in the whole column become ``marker``.

    The rare ones are few occurrences by definition, so the rows that hold one
    are found by a join on the characters and only those rows are rewritten.
    """
    rare = character_counts(df, text).where(F.col("occurrences") < least).select("ch")
    # Rows are told apart by 128 bits of hash over all columns; equal rows are rewritten alike.
    cells = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.withColumn("__row", F.struct(F.xxhash64(*cells), F.xxhash64(F.lit(1), *cells)))
    letters = F.array_distinct(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"(?s)[^A-Za-z ]"), F.lit(0)))
    hits = keyed.select("__row", F.explode(letters).alias("ch")).join(rare, "ch").groupBy("__row").agg(F.collect_set("ch").alias("__rare"))
    fixed = F.when(
        F.col("__rare").isNotNull(),
        F.array_join(F.transform(F.split(F.col(f"`{text}`"), ""), lambda c: F.when(F.array_contains("__rare", c), marker).otherwise(c)), ""),
    ).otherwise(F.col(f"`{text}`"))
    return keyed.join(hits, "__row", "left").withColumn(text, fixed).drop("__row", "__rare")


def emoticons_restored(df: DataFrame, text: str, group: str, letters: str = "Дヅ") -> DataFrame:
    """Letters of another script that are the only ones of it in a whole group become ``:)``."""
    chars = F.array_distinct(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"[\p{IsCyrillic}\p{IsKatakana}]"), F.lit(0)))
    seen = df.select(F.col(f"`{group}`").alias("__g"), F.explode(chars).alias("c")).distinct()
    only = seen.groupBy("__g").agg(F.count("*").alias("n"), F.min("c").alias("c")).where((F.col("n") == 1) & F.col("c").isin(*set(letters)))
    joined = df.join(only.select("__g", F.lit(True).alias("__only")), F.col(f"`{group}`") == F.col("__g"), "left")
    fixed = F.when(F.col("__only"), F.regexp_replace(F.col(f"`{text}`"), f"[{''.join(sorted(set(letters)))}]+", ":)")).otherwise(F.col(f"`{text}`"))
    return joined.withColumn(text, fixed).drop("__g", "__only")
