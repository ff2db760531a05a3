"""The vocabulary no lexicon explains: extraction, counts, labels and their application."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterable, Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurate.operators.skew import salted_join
from murmurate.schema import PLACEHOLDERS, RESIDUAL_LABELS, col

TOKEN = r"(?U)\w+(?:['-]\w+)*"
POLICIES = ("manual_review", "reviewed", "api")
#: Labels that are known but not written into the text.
UNWRITTEN = ("JARGON", "UNCERTAIN")
VOCABULARY_CEILING = 500_000


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def _accounted(df: DataFrame) -> Column:
    """Lower-case tokens that matches of the row already explain."""
    parts = [F.array().cast("array<string>")]
    flat = lambda c, f: F.flatten(F.transform(F.coalesce(col(c), F.array()), lambda x: tokens(F.lower(x[f]))))
    for column, field in (("tech_lexicon_matches", "term"), ("slang_matches", "token"), ("structural_matches", "match")):
        if column in df.columns:
            parts.append(flat(column, field))
    if "glued_matches" in df.columns:
        glued = F.coalesce(col("glued_matches"), F.array())
        parts += [F.transform(glued, lambda x: F.lower(x["term"])), F.transform(glued, lambda x: F.lower(x["run"]))]
    return F.array_distinct(F.flatten(F.array(*parts)))


def with_candidates(df: DataFrame, text: str = "text_cleaned") -> DataFrame:
    """Adds ``residual_words``: tokens without explained ones, labels, placeholders and numbers."""
    df = df.withColumn("__accounted", _accounted(df))
    return df.withColumn("residual_words", _candidates(text)).drop("__accounted")


def _candidates(text: str) -> Column:
    reserved = sorted({t.lower() for t in (*RESIDUAL_LABELS, *PLACEHOLDERS.values())})
    plain = F.filter(tokens(col(text)), lambda t: ~F.lower(t).isin(*reserved) & ~t.rlike(r"(?U)^\d+$"))
    # The matches of a row are few; where there are none, the list is not looked through.
    return F.when(F.size("__accounted") == 0, plain).otherwise(F.filter(plain, lambda t: ~F.array_contains("__accounted", F.lower(t))))


def with_residuals(df: DataFrame, *, key: str, text: str = "text_cleaned", dictionary: DataFrame | None = None, word: str = "word") -> DataFrame:
    """Adds ``residual_words`` and ``has_residual``; words of the dictionary are no residuals.

    The dictionary is joined on distinct words, in the map tasks where Spark
    measures it small enough and by shuffle otherwise, and the known words of a
    row are then taken out of its list.
    """
    df = with_candidates(df, text)
    if dictionary is not None:
        words = df.select(col(key).alias("__k"), F.explode("residual_words").alias("__w")).select("__k", F.lower("__w").alias("__w")).distinct()
        english = dictionary.select(F.lower(col(word)).alias("__w")).distinct()
        known = salted_join(words, english, ["__w"], spread=["__k"], how="left_semi").groupBy("__k").agg(F.collect_set("__w").alias("__known"))
        df = df.join(known, col(key) == F.col("__k"), "left")
        kept = F.filter("residual_words", lambda t: ~F.array_contains(F.coalesce("__known", F.array()), F.lower(t)))
        df = df.withColumn("residual_words", kept).drop("__k", "__known")
    return df.withColumn("has_residual", F.size("residual_words") > 0)


def vocabulary(df: DataFrame) -> DataFrame:
    """``word, count`` of residual words in lower case over the whole table."""
    return df.select(F.explode("residual_words").alias("w")).groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("count"))


def residual_counts(df: DataFrame, *, text: str = "text_cleaned", dictionary: DataFrame | None = None, word: str = "word") -> DataFrame:
    """``word, count`` of the residual words of a text column, without those of the dictionary.

    The same as ``vocabulary(with_residuals(…))``, but words are counted first
    and each distinct one meets the dictionary once; no row needs its own list.
    """
    counts = vocabulary(with_candidates(df, text))
    return counts if dictionary is None else counts.join(dictionary.select(F.lower(col(word)).alias("word")).distinct(), "word", "left_anti")


def reviewed_labels(words: DataFrame, *, jargon: DataFrame, languages: DataFrame, nonwords: DataFrame, english: DataFrame) -> DataFrame:
    """``word, count, label`` by precedence: jargon, language, number, known English (none), nonword.

    ``jargon``, ``nonwords`` and ``english`` have ``word``; ``languages`` has
    ``word, label``. Words that nothing labels have label NULL.
    """
    mark = lambda d, name: d.select(F.lower("word").alias("word")).distinct().withColumn(name, F.lit(True))
    named = languages.select(F.lower("word").alias("word"), F.upper("label").alias("__language")).groupBy("word").agg(F.min("__language").alias("__language"))
    out = words.join(mark(jargon, "__jargon"), "word", "left").join(named, "word", "left")
    out = out.join(mark(nonwords, "__nonword"), "word", "left").join(mark(english, "__english"), "word", "left")
    label = (
        F.when(F.col("__jargon"), "JARGON")
        .when(F.col("__language").isNotNull(), F.col("__language"))
        .when(F.col("word").rlike(r"(?U)^\d+$"), "UNCERTAIN")
        .when(F.col("__english"), F.lit(None).cast("string"))
        .when(F.col("__nonword"), "NONWORD")
    )
    return out.select("word", "count", label.alias("label"))


def apply_labels(df: DataFrame, labels: DataFrame, *, key: str, text: str = "text_cleaned") -> DataFrame:
    """Replaces tokens by their label; numbers, JARGON, UNCERTAIN and unknown labels leave the token.

    Labels meet the rows by a join on distinct words, so their number is not
    limited by the driver's or a task's memory; each row then needs only the
    labels of its own words.
    """
    usable = labels.select(F.lower("word").alias("__w"), F.upper("label").alias("__l")).where(
        F.col("__l").isin(*RESIDUAL_LABELS) & ~F.col("__l").isin(*UNWRITTEN) & ~F.col("__w").rlike(r"(?U)^\d+$")
    )
    usable = usable.groupBy("__w").agg(F.min("__l").alias("__l"))
    words = df.select(col(key).alias("__k"), F.explode(F.array_distinct(tokens(F.lower(col(text))))).alias("__w"))
    own = salted_join(words, usable, ["__w"], spread=["__k"]).groupBy("__k").agg(F.map_from_entries(F.collect_set(F.struct("__w", "__l"))).alias("__map"))
    joined = df.join(own, col(key) == F.col("__k"), "left")
    # Tokens and the text between them alternate: what is left after taking the tokens out.
    found = tokens(col(text))
    between = F.split(F.regexp_replace(col(text), TOKEN, "\u0000"), "\u0000")
    named = F.transform(found, lambda t: F.coalesce(F.try_element_at(F.col("__map"), F.lower(t)), t))
    rebuilt = F.array_join(F.flatten(F.zip_with(between, named, lambda b, t: F.array(b, F.coalesce(t, F.lit(""))))), "")
    return joined.withColumn(text, F.when(F.col("__map").isNotNull(), rebuilt).otherwise(col(text))).drop("__k", "__map")


class ResidualClassifier(Protocol):
    """Labels words in batches; runs on the driver, where its credentials stay."""

    def classify(self, words: Sequence[str]) -> dict[str, str]: ...


class ClassifierError(RuntimeError):
    pass


class RetryingClassifier:
    """Sends batches through ``send(request) -> (status, body)`` with retries and a strict reply check.

    The reply must label every word of its batch exactly once with a known
    label; anything else fails. Statuses 408, 409, 429 and 5xx are tried again
    after 1, 2, 4 ... seconds; others fail at once. Words made of digits are
    never sent. Nothing secret enters the provenance.
    """

    def __init__(self, send: Callable[[dict], tuple[int, dict]], model: str, *, batch: int = 500, retries: int = 4, sleep: Callable[[float], None] = time.sleep):
        if not 1 <= batch <= 500:
            raise ValueError("a batch holds 1 to 500 words")
        self.send, self.model, self.batch, self.retries, self.sleep = send, model, batch, retries, sleep
        self.requests: list[str] = []

    def request(self, words: Sequence[str]) -> dict:
        item = {"type": "object", "properties": {"word": {"enum": list(words)}, "label": {"enum": list(RESIDUAL_LABELS)}}, "required": ["word", "label"], "additionalProperties": False}
        schema = {"type": "object", "properties": {"labels": {"type": "array", "items": item}}, "required": ["labels"], "additionalProperties": False}
        return {"model": self.model, "temperature": 0, "store": False, "strict": True, "schema": schema, "words": list(words)}

    def classify(self, words: Iterable[str]) -> dict[str, str]:
        todo = sorted({w.lower() for w in words if not w.isdigit()})
        out: dict[str, str] = {}
        for i in range(0, len(todo), self.batch):
            part = todo[i : i + self.batch]
            request = self.request(part)
            self.requests.append(hashlib.sha256(json.dumps(request, sort_keys=True).encode()).hexdigest())
            got = [(str(x["word"]).lower(), str(x["label"]).upper()) for x in self._ask(request).get("labels", [])]
            if sorted(w for w, _ in got) != part or any(label not in RESIDUAL_LABELS for _, label in got):
                raise ClassifierError("the reply does not label every word exactly once with a known label")
            out |= dict(got)
        return out

    def _ask(self, request: dict) -> dict:
        for attempt in range(self.retries + 1):
            status, body = self.send(request)
            if status == 200:
                return body
            if not (status in (408, 409, 429) or status >= 500) or attempt == self.retries:
                raise ClassifierError(f"the classifier answered {status}")
            self.sleep(2.0**attempt)
        raise ClassifierError("unreachable")

    def provenance(self) -> dict:
        return {"model": self.model, "batches": len(self.requests), "request_sha256": list(self.requests)}


def residual_labels(df: DataFrame, policy: str, *, tables: dict[str, DataFrame] | None = None, classifier: ResidualClassifier | None = None, ceiling: int = VOCABULARY_CEILING) -> DataFrame | None:
    """Labels by policy: none for ``manual_review``, joins for ``reviewed``, the classifier for ``api``.

    Only ``api`` brings words to the driver, so only it has a ceiling.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown residual policy {policy!r}; known are {POLICIES}")
    if policy == "manual_review":
        return None
    words = vocabulary(df)
    if policy == "reviewed":
        return reviewed_labels(words, **(tables or {}))
    if classifier is None:
        raise ValueError("policy api needs a classifier")
    rows = words.orderBy("word").limit(ceiling + 1).collect()
    if len(rows) > ceiling:
        raise MemoryError(f"the residual vocabulary has more than {ceiling} words")
    labels = classifier.classify([r["word"] for r in rows])
    return df.sparkSession.createDataFrame([(r["word"], r["count"], labels.get(r["word"])) for r in rows], "word string, count bigint, label string")


def review_export(df: DataFrame, labels: DataFrame | None = None, source: str = "manual_review") -> DataFrame:
    """``word, count, classification_label, classification_source`` for people to fill in."""
    words = vocabulary(df)
    if labels is None:
        return words.withColumns({"classification_label": F.lit(""), "classification_source": F.lit(source)})
    joined = words.join(labels.select("word", "label"), "word", "left")
    return joined.select("word", "count", F.coalesce("label", F.lit("")).alias("classification_label"), F.lit(source).alias("classification_source"))


def nonword_rate(df: DataFrame, text: str = "text_cleaned") -> DataFrame:
    """``tokens, nonwords, rate`` over the whole table."""
    t = tokens(col(text))
    return df.agg(
        F.coalesce(F.sum(F.size(t)), F.lit(0)).cast("bigint").alias("tokens"), F.coalesce(F.sum(F.size(F.filter(t, lambda x: x == "NONWORD"))), F.lit(0)).cast("bigint").alias("nonwords")
    ).withColumn("rate", F.coalesce(F.try_divide("nonwords", "tokens"), F.lit(0.0)))


def batch_labels(words: DataFrame, languages: DataFrame, jargon: DataFrame) -> DataFrame:
    """Language label, else NONWORD for what is neither jargon nor a number; one join for both tables."""
    named = languages.select(F.lower("word").alias("word"), F.upper("label").alias("language")).groupBy("word").agg(F.min("language").alias("language"))
    known = jargon.select(F.lower("word").alias("word"), F.lit(True).alias("jargon")).distinct()
    out = words.join(named, "word", "left").join(known, "word", "left")
    label = F.coalesce("language", F.when(F.col("jargon").isNull() & ~F.col("word").rlike(r"(?U)^\d+$"), "NONWORD"))
    return out.select("word", label.alias("label"))
