"""Rule-based sentiment, pluggable models, and how well they agree."""

from __future__ import annotations

import math

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurate.functions.normalize import is_effectively_empty, without_labels
from murmurate.functions.probability import class_columns, normalized_probabilities
from murmurate.operators.prepare import seeded_sample
from murmurate.schema import EMOTION_LABELS, SENTIMENT_LABELS, col
from murmurate.session import Scratch

VADER_COLUMNS = ("vader_negative", "vader_neutral", "vader_positive", "vader_compound", "vader_label")
TRANSFORMER_COLUMNS = (
    "transformer_negative", "transformer_neutral", "transformer_positive", "transformer_label", "transformer_score",
    "transformer_expected_sentiment", "transformer_entropy", "transformer_normalized_entropy", "transformer_margin",
)

#: A small valence table, -4 to 4; pass a larger one as a mapping.
VALENCE = {
    "good": 1.9, "great": 3.1, "best": 3.2, "better": 1.9, "nice": 1.8, "love": 3.2, "loves": 2.7, "like": 1.5, "thanks": 1.9, "thank": 1.5,
    "works": 0.8, "working": 0.6, "worked": 0.8, "fine": 0.8, "fix": 0.9, "fixed": 1.2, "solved": 1.8, "perfect": 2.7, "excellent": 2.7,
    "happy": 2.7, "cool": 1.3, "awesome": 3.1, "easy": 1.9, "helpful": 1.8, "help": 1.7, "welcome": 2.0, "please": 1.3, "free": 1.5, "glad": 2.0,
    "safe": 1.9, "clean": 1.7, "useful": 1.9, "yes": 1.7, "win": 2.8, "smile": 1.5, "lol": 1.8, ":)": 2.0, ":d": 2.3, ";)": 0.9,
    "bad": -2.5, "terrible": -2.1, "worst": -3.1, "worse": -2.1, "hate": -2.7, "broken": -1.6, "broke": -1.8, "fail": -2.5, "failed": -2.3,
    "failure": -2.3, "error": -1.7, "errors": -1.4, "problem": -1.7, "problems": -1.7, "stuck": -1.0, "wrong": -2.1, "sorry": -0.3, "lost": -1.3,
    "lose": -1.7, "losing": -1.6, "stop": -1.2, "stopped": -0.9, "crash": -1.7, "crashed": -1.4, "bug": -1.0, "slow": -0.8, "ugly": -2.3,
    "stupid": -2.4, "useless": -1.8, "annoying": -1.7, "sad": -2.1, "angry": -2.3, "dead": -3.3, "missing": -1.2, "warning": -1.4, "ugh": -1.8,
    "panic": -1.9, "damn": -1.7, "denied": -1.9, "no": -1.2, "confused": -1.3, "bored": -1.1, "kill": -3.7, "killed": -3.5, "ban": -2.6, ":(": -1.9,
}
# The constants and word lists of the published rules (Hutto & Gilbert, ICWSM 2014).
_BOOST, _DROP, _CAPS, _NEGATE = 0.293, -0.293, 0.733, -0.74
BOOSTERS = dict.fromkeys("absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely especially exceptionally extremely fabulously flipping frickin friggin fully greatly hella highly hugely incredible incredibly intensely majorly more most particularly purely quite really remarkably so substantially thoroughly total totally tremendously uber unbelievably unusually utterly very".split(), _BOOST)
BOOSTERS |= dict.fromkeys("almost barely hardly kinda kindof less little marginally occasionally partly scarcely slightly somewhat sorta sortof".split(), _DROP)
NEGATIONS = frozenset("aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't shouldn't wasn't weren't without wont wouldnt won't wouldn't rarely seldom despite".split())
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def vader(text: str, valence: Mapping[str, float] = VALENCE) -> tuple[float, float, float, float]:
    """Negative, neutral, positive share and compound score of one text."""
    words = []
    for w in text.split():
        bare = w.strip(_PUNCTUATION)
        words.append(bare if len(bare) > 2 else w)
    low = [w.lower() for w in words]
    shouted = [w.isupper() for w in words]
    mixed = 0 < sum(shouted) < len(words)
    scores = []
    for i, w in enumerate(low):
        v = valence.get(w)
        if v is None or w in BOOSTERS:
            scores.append(0.0)
            continue
        if w == "no" and i + 1 < len(low) and low[i + 1] in valence:
            v = 0.0  # it then negates the next word
        if mixed and shouted[i]:
            v += math.copysign(_CAPS, v)
        for back in (1, 2, 3):
            j = i - back
            if j < 0 or low[j] in valence and low[j] != "no":
                continue
            step = BOOSTERS.get(low[j], 0.0)
            if step:
                step = -step if v < 0 else step
                if mixed and shouted[j]:
                    step += math.copysign(_CAPS, step if v > 0 else -step) * (1 if v > 0 else -1)
                v += step * (1.0, 0.95, 0.9)[back - 1]
            if low[j] in NEGATIONS or "n't" in low[j] or low[j] == "no":
                so = back > 1 and low[j] == "never" and {"so", "this"} & set(low[j + 1 : i])
                v = v * (1.25 if back == 3 else 1.5) if so else v if low[j : j + 2] == ["without", "doubt"] else v * _NEGATE
        if i > 0 and low[i - 1] == "least" and not (i > 1 and low[i - 2] in ("at", "very")):
            v *= _NEGATE
        scores.append(v)
    if "but" in low:
        at = low.index("but")
        scores = [s * (0.5 if i < at else 1.5 if i > at else 1.0) for i, s in enumerate(scores)]
    if not scores:
        return 0.0, 0.0, 0.0, 0.0
    marks = min(text.count("!"), 4) * 0.292
    asks = text.count("?")
    marks += (asks * 0.18 if asks <= 3 else 0.96) if asks > 1 else 0.0
    total = sum(scores)
    total += marks if total > 0 else -marks if total < 0 else 0.0
    compound = total / math.sqrt(total * total + 15)
    positive = sum(s + 1 for s in scores if s > 0)
    negative = sum(s - 1 for s in scores if s < 0)
    neutral = sum(1 for s in scores if s == 0)
    if positive > abs(negative):
        positive += marks
    elif positive < abs(negative):
        negative -= marks
    whole = positive + abs(negative) + neutral
    return round(abs(negative / whole), 3), round(neutral / whole, 3), round(positive / whole, 3), round(max(-1.0, min(1.0, compound)), 4)


def sentiment_label(compound: Column) -> Column:
    return F.when(compound >= 0.05, "POSITIVE").when(compound <= -0.05, "NEGATIVE").when(compound.isNotNull(), "NEUTRAL")


def score_vader(df: DataFrame, text: str = "text_cleaned", valence: Mapping[str, float] = VALENCE) -> DataFrame:
    """The VADER columns from the text without labels; all NULL where no letter is left."""
    table = dict(valence)

    @F.pandas_udf("struct<vader_negative:double,vader_neutral:double,vader_positive:double,vader_compound:double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [(None,) * 4 if t is None else vader(t, table) for t in texts]
        return pd.DataFrame(rows, columns=list(VADER_COLUMNS[:4]), dtype="float64")

    df = df.drop(*VADER_COLUMNS)
    plain = without_labels(col(text))
    scored = df.withColumn("__v", run(F.when(~is_effectively_empty(plain), plain)))
    out = scored.withColumns({c: F.col(f"__v.{c}") for c in VADER_COLUMNS[:4]}).drop("__v")
    return out.withColumn("vader_label", sentiment_label(col("vader_compound")))


class BackendUnavailable(RuntimeError):
    """A model that is needed is not installed here."""


class Backend:
    """Class probabilities from a model that each worker loads once.

    ``load()`` returns ``predict(texts) -> list of {label: probability}`` and
    runs on the worker; ``labels`` maps the model's names to ours.
    """

    def __init__(self, load: Callable[[], Callable[[list[str]], list[Mapping[str, float]]]], classes: Sequence[str], labels: Mapping[str, str] | None = None, chunk: int = 4096):
        if chunk < 1:
            raise ValueError("chunk must be positive")
        self.load, self.classes, self.chunk = load, tuple(classes), chunk
        self.labels = {k.lower(): v for k, v in (labels or {}).items()} | {c.lower(): c for c in classes}

    def rows(self, predict, texts: list[str | None]) -> list[list[float] | None]:
        """Probabilities in the order of the classes; texts that are NULL are not sent; bounded chunks."""
        out: list[list[float] | None] = [None] * len(texts)
        real = [i for i, t in enumerate(texts) if t is not None]
        for at in range(0, len(real), self.chunk):
            part = real[at : at + self.chunk]
            for i, scores in zip(part, predict([texts[j] for j in part]), strict=True):
                named = {self.labels[k.lower()]: float(v) for k, v in scores.items() if k.lower() in self.labels}
                if missing := [c for c in self.classes if c not in named]:
                    raise ValueError(f"the model gave no probability for {missing}")
                out[i] = [named[c] for c in self.classes]
        return out

    def column(self, text: Column) -> Column:
        backend = self

        @F.pandas_udf("array<double>")
        def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            predict = backend.load()
            for texts in parts:
                yield pd.Series(backend.rows(predict, [t if t is not None else None for t in texts]), dtype=object)

        return run(text)


def unavailable(name: str) -> Callable[[], Callable]:
    def load():
        raise BackendUnavailable(f"the backend {name!r} needs a model that is not installed here")

    return load


def transformer_backend(load=None) -> Backend:
    names = {"label_0": "NEGATIVE", "label_1": "NEUTRAL", "label_2": "POSITIVE"}
    return Backend(load or unavailable("transformer"), SENTIMENT_LABELS, names, chunk=4096)


def emotion_backend(load=None) -> Backend:
    return Backend(load or unavailable("emotion"), EMOTION_LABELS, chunk=4096)


def _scored(df: DataFrame, prefix: str, backend: Backend, text: str) -> tuple[DataFrame, Column]:
    plain = without_labels(col(text))
    p = backend.column(F.when(~is_effectively_empty(plain), plain))
    df = df.withColumn("__raw", p)
    parts = [F.get("__raw", F.lit(i)) for i in range(len(backend.classes))]
    return df.withColumn("__p", normalized_probabilities(parts)).drop("__raw"), F.col("__p")


def score_transformer(df: DataFrame, backend: Backend, text: str = "text_cleaned") -> DataFrame:
    out, p = _scored(df.drop(*TRANSFORMER_COLUMNS), "transformer", backend, text)
    out = out.withColumns(class_columns("transformer", SENTIMENT_LABELS, p))
    return out.withColumn("transformer_expected_sentiment", col("transformer_positive") - col("transformer_negative")).drop("__p")


def score_emotion(df: DataFrame, backend: Backend, text: str = "text_cleaned") -> DataFrame:
    owned = [c for c in df.columns if c.startswith("emotion_")]
    out, p = _scored(df.drop(*owned), "emotion", backend, text)
    return out.withColumns(class_columns("emotion", EMOTION_LABELS, p)).drop("__p")


def analyze_sentiment(df: DataFrame, mode: str = "vader", *, backend: Backend | None = None, text: str = "text_cleaned", valence: Mapping[str, float] = VALENCE) -> DataFrame:
    """``vader``, ``transformer`` or ``both``; columns of the other mode from an earlier run go."""
    if mode not in ("vader", "transformer", "both"):
        raise ValueError(f"unknown sentiment mode {mode!r}")
    df = df.drop(*VADER_COLUMNS, *TRANSFORMER_COLUMNS)
    if mode in ("vader", "both"):
        df = score_vader(df, text, valence)
    if mode in ("transformer", "both"):
        df = score_transformer(df, backend or transformer_backend(), text)
    return df


def backend_agreement(df: DataFrame) -> DataFrame:
    """``rows, label_agreement, score_correlation`` of the two backends where both scored."""
    both = df.where("vader_label IS NOT NULL AND transformer_label IS NOT NULL")
    return both.agg(
        F.count("*").alias("rows"), F.avg((col("vader_label") == col("transformer_label")).cast("int")).alias("label_agreement"),
        F.corr("vader_compound", "transformer_expected_sentiment").alias("score_correlation"),
    )


def throughput_probe(df: DataFrame, score: Callable[[DataFrame], DataFrame], *, rows: int = 2000, total: int | None = None, key: str = "message_id") -> dict:
    """Times a scorer on a seeded sample and projects it to the whole table."""
    scratch = Scratch(df.sparkSession, "probe")
    sample = scratch.write(seeded_sample(df, rows, key), "sample")
    try:
        n = sample.count()
        began = time.perf_counter()
        score(sample).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - began
    finally:
        scratch.close()
    rate = n / seconds if seconds else 0.0
    return {"rows": n, "seconds": seconds, "rows_per_second": rate, "projected_minutes": (total or df.count()) / rate / 60 if rate else None}


