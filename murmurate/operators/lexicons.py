"""Technical terms, slang and glued terms found in text, whatever the size of the lexicon.

One automaton per lexicon finds all its entries in one pass over a text; the
matches that keep their boundaries are then taken from the left, the longest
first, without overlap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from murmurate.schema import GLUED, PLACEHOLDERS, SLANG, TERMS, col

#: Slang that ships with the library: token, type, meaning. Pass another table for more.
DEFAULT_SLANG = (
    ("lol", "Slang", "laughing out loud"), ("brb", "Slang", "be right back"), ("imo", "Slang", "in my opinion"), ("btw", "Slang", "by the way"),
    ("afaik", "Slang", "as far as I know"), ("afaict", "Slang", "as far as I can tell"), ("iirc", "Slang", "if I recall correctly"),
    ("fwiw", "Slang", "for what it is worth"), ("thx", "Textese", "thanks"), ("plz", "Textese", "please"), ("sry", "Textese", "sorry"),
    ("kthx", "Textese", "ok, thanks"), ("nvm", "Slang", "never mind"), ("noob", "Slang", "newcomer"), ("w00t", "Expression", "joy"),
    ("dunno", "Expression", "I do not know"), ("gotcha", "Expression", "understood"), ("hmm", "Expression", "thinking"),
    (":)", "Emoticon", "smile"), (":(", "Emoticon", "frown"), (";)", "Emoticon", "wink"), (":D", "Emoticon", "laugh"), (":P", "Emoticon", "tongue"),
    ("<3", "Symbol", "heart"), ("->", "Symbol", "arrow"), ("pwned", "Flagged/Ambiguous", "beaten"),
)
WORD_TYPES = frozenset({"Slang", "Expression", "Textese", "Technical/IRC"})
REVIEW_TYPES = frozenset({"Flagged/Ambiguous", "Other/Non-Slang"})
MIN_GLUED = 4
EXAMPLES = 5


def _is_word(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def _folded(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _automaton(keys: Iterable[str]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for k in keys:
        a.add_word(k, k)
    if len(a):
        a.make_automaton()
    return a


def _bounded(text: str, a: int, b: int) -> bool:
    """Neither edge of the match lies inside a run of word characters."""
    left = a == 0 or not _is_word(text[a - 1])
    right = b == len(text) or not _is_word(text[b])
    return left and right


def _hits(automaton, text: str, keep: Callable[[int, int, str], bool]) -> list[tuple[int, int, str]]:
    if not len(automaton):
        return []
    found = [(end - len(k) + 1, end + 1, k) for end, k in automaton.iter(text)]
    return sorted((h for h in found if keep(*h)), key=lambda h: (h[0], h[0] - h[1]))


def _from_left(hits: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, str]]:
    at = 0
    for a, b, k in hits:
        if a >= at:
            yield a, b, k
            at = b


class TermFinder:
    """Finds the terms of ``(term, category)`` rows; of a term listed twice the first category counts."""

    def __init__(self, terms: Iterable[tuple[str, str | None]]):
        self.category: dict[str, str | None] = {}
        for term, category in terms:
            if term:
                self.category.setdefault(term.lower(), category)
        self.automaton = _automaton(self.category)
        self.glued = _automaton(t for t in self.category if len(t) >= MIN_GLUED and all(map(_is_word, t)))

    def find(self, text: str) -> list[dict]:
        low = _folded(text)
        hits = _hits(self.automaton, low, lambda a, b, _: _bounded(text, a, b))
        return [{"term": text[a:b], "category": self.category[k]} for a, b, k in _from_left(hits)]

    def find_glued(self, text: str) -> list[dict]:
        """Terms that touch further word characters, with the side and the whole run."""
        out = []
        for a, b, k in _from_left(_hits(self.glued, _folded(text), lambda *_: True)):
            left = a == 0 or not _is_word(text[a - 1])
            right = b == len(text) or not _is_word(text[b])
            if left and right:
                continue
            x, y = a, b
            while x > 0 and _is_word(text[x - 1]):
                x -= 1
            while y < len(text) and _is_word(text[y]):
                y += 1
            if text[x:y].upper() not in PLACEHOLDERS.values():
                out.append({"term": k, "category": self.category[k], "glue": "prefix" if left else "suffix" if right else "infix", "run": text[x:y]})
        return out


class SlangFinder:
    """Finds slang: word-like entries in any case as whole words, signs literally and anywhere."""

    def __init__(self, entries: Iterable[tuple[str, str, str]], review: bool = False):
        kept = [e for e in entries if e[0] and (e[1] in REVIEW_TYPES) == review]
        self.exact = {t: (kind, meaning) for t, kind, meaning in kept}
        word_like = [e for e in kept if e[1] in WORD_TYPES and all(_is_word(c) or c in "'/-" for c in e[0])]
        self.folded = {t.lower(): (kind, meaning) for t, kind, meaning in word_like}
        words = {e[0] for e in word_like}
        self.words, self.signs = _automaton(self.folded), _automaton(t for t, _, _ in kept if t not in words)

    def find(self, text: str) -> list[dict]:
        hits = _hits(self.words, _folded(text), lambda a, b, _: _bounded(text, a, b))
        hits = sorted(hits + _hits(self.signs, text, lambda *_: True), key=lambda h: (h[0], h[0] - h[1]))
        out = []
        for a, b, _ in _from_left(hits):
            kind, meaning = self.exact.get(text[a:b]) or self.folded.get(text[a:b].lower(), (None, None))
            out.append({"token": text[a:b], "type": kind, "meaning": meaning})
        return out


def _udf(find: Callable[[], Callable[[str], list]], kind) -> Callable[[Column], Column]:
    """An Arrow UDF whose finder is built once per worker."""

    @F.pandas_udf(kind)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = find()
        for texts in parts:
            yield pd.Series([ready(t) if t else [] for t in texts], dtype=object)

    return run


def term_matches(text: Column, terms: list[tuple[str, str | None]]) -> Column:
    return _udf(lambda: TermFinder(terms).find, TERMS)(text)


def glued_matches(text: Column, terms: list[tuple[str, str | None]]) -> Column:
    return _udf(lambda: TermFinder(terms).find_glued, GLUED)(text)


def slang_matches(text: Column, entries=DEFAULT_SLANG, include_review: bool = False) -> Column:
    def build():
        first, second = SlangFinder(entries), SlangFinder(entries, review=True)
        return (lambda t: first.find(t) + second.find(t)) if include_review else first.find

    return _udf(build, SLANG)(text)


def lexicon_rows(df: DataFrame, most: int = 200_000) -> list[tuple[str, str | None]]:
    """A lexicon table for the finders; one larger than ``most`` is refused, as it travels with every task."""
    rows = df.select("term", "category").where("term IS NOT NULL").orderBy("term", "category").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the lexicon has more than {most} terms; join exploded tokens instead (single_word_terms)")
    return [(r[0], r[1]) for r in rows]


def lookup_rows(df: DataFrame, columns: tuple[str, ...], most: int = 200_000) -> list[tuple]:
    """A small table for the workers, ordered, without rows whose first column is NULL; a larger one than ``most`` is refused."""
    rows = df.select(*columns).where(col(columns[0]).isNotNull()).orderBy(*columns).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the table of {columns[0]} has more than {most} rows")
    return [tuple(r) for r in rows]


def slang_rows(df: DataFrame) -> list[tuple[str, str, str]]:
    """A table of ``token, type, meaning``."""
    return lookup_rows(df, ("token", "type", "meaning"))


def lookup_map(df: DataFrame, key: str, value: str, kind: str = "string") -> dict:
    """A table of two columns as a mapping by key in lower case; of a key listed twice the smallest value counts."""
    out: dict = {}
    for k, v in lookup_rows(df.select(F.lower(col(key)).alias(key), col(value).cast(kind).alias(value)).where(col(value).isNotNull()), (key, value)):
        out.setdefault(k, v)
    return out


def single_word_terms(df: DataFrame, lexicon: DataFrame, *, key: str, text: str) -> DataFrame:
    """``<key>, term, occurrences`` of one-word terms, by an equi-join on tokens: for lexicons of any size.

    Spark broadcasts the lexicon if its measured size allows, else shuffles both.
    """
    tokens = F.regexp_extract_all(F.lower(col(text)), F.lit(r"(?U)\w+"), F.lit(0))
    words = df.select(col(key), F.explode(tokens).alias("term")).groupBy(key, "term").agg(F.count("*").alias("occurrences"))
    return words.join(lexicon.select(F.lower("term").alias("term")).distinct(), "term", "left_semi").select(key, "term", "occurrences")


def glued_review(df: DataFrame) -> DataFrame:
    """Glued terms by side and term: count, up to five examples, and whether they are safe to split.

    Safe are prefixes whose every run is the term followed by digits. Riskier
    sides come later in ``risk``.
    """
    g = df.select(F.explode("glued_matches").alias("g")).select("g.*")
    plain = (F.col("glue") == "prefix") & (F.regexp_replace(F.lower("run"), r"\d+$", "") == F.col("term"))
    runs = g.groupBy("glue", "term", "run").agg(F.count("*").alias("n"), F.bool_and(plain).alias("plain"))
    # Only the first runs by name are kept of each task's rows, so a term with any number of runs is no large window.
    first = runs.withColumn("__i", F.row_number().over(Window.partitionBy("glue", "term").orderBy("run"))).where(F.col("__i") <= EXAMPLES)
    first = first.groupBy("glue", "term").agg(F.sort_array(F.collect_list("run")).alias("examples"))
    whole = runs.groupBy("glue", "term").agg(F.sum("n").alias("occurrences"), F.bool_and("plain").alias("safe"))
    risk = F.when(F.col("glue") == "prefix", 0).when(F.col("glue") == "suffix", 1).otherwise(2)
    return whole.join(first, ["glue", "term"]).select("glue", "term", "occurrences", "examples", "safe", risk.alias("risk"))


def has_lexicon_match(columns: Mapping[str, str] | Iterable[str]) -> Column:
    """Whether any of the match arrays or count columns holds something."""
    out = F.lit(False)
    for c in columns:
        out = out | (F.coalesce(F.size(col(c)), F.lit(0)) > 0 if c.endswith("_matches") else F.coalesce(col(c), F.lit(0)) > 0)
    return out


def match_tallies(df: DataFrame) -> DataFrame:
    """``lexicon, term, occurrences`` over the whole table, for all match columns present."""
    parts = []
    for column, lexicon, pick in (
        ("tech_lexicon_matches", "technical", lambda x: F.lower(x["term"])), ("slang_matches", "slang", lambda x: x["token"]),
        ("glued_matches", "glued", lambda x: x["term"]), ("structural_matches", "structural", lambda x: x["category"]),
    ):
        if column in df.columns:
            terms = df.select(F.lit(lexicon).alias("lexicon"), F.explode(F.transform(col(column), pick)).alias("term"))
            parts.append(terms.groupBy("lexicon", "term").agg(F.count("*").alias("occurrences")))
    for name in PLACEHOLDERS:
        if f"{name}_count" in df.columns:
            parts.append(df.select(F.lit("anonymized").alias("lexicon"), F.lit(name).alias("term"), F.coalesce(F.sum(col(f"{name}_count")), F.lit(0)).alias("occurrences")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
