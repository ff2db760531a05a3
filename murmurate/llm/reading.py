"""Reading level of documents: a pairwise ranker calibrated by isotonic regression."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 5
#: Labels used for fitting at most, chosen by hash; the fitted model is applied to every document.
MAX_LABELS = 4000
#: Pairs that one step of the fit looks at together; all pairs are used.
PAIR_BLOCK = 400_000
#: Sizes of the vocabularies of the most frequent words of all documents, whose share tells plain from rare words.
BANDS = (100, 1000)

# English words that open a subordinate clause, forms of "to be" before a passive, and endings of
# abstract nouns and learned adjectives, verbs and adverbs.
_SUBORDINATORS = (
    "after although as because before if insofar lest notwithstanding once provided since than that though unless until "
    "what when whenever where whereas wherever whether which while who whoever whom whose why"
).split()
_BE = "am is are was were be been being".split()
_ABSTRACT = ("tion", "sion", "ment", "ness", "ity", "ance", "ence", "ism", "ency", "ancy")
_LEARNED = ("ous", "ive", "ical", "able", "ible", "ally", "ently", "ised", "ated", "ising", "ating", "ary")

#: Features that mean the same in any language written with letters.
NEUTRAL = ("sentence_length", "clause_length", "word_length", "syllables", "long_words", "longer_words", "longest_words", "commas", "compounds", "questions", "variety")
FEATURES = (*NEUTRAL, "subordination", "passives", "abstract_endings", "learned_endings", *[f"beyond_{n}" for n in BANDS])


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def frequent_words(documents: DataFrame, most: int = max(BANDS)) -> list[str]:
    """The ``most`` most frequent words of all documents, the most frequent first; their number is the bound of what is collected."""
    counts = documents.select(F.explode(words_of(F.col("text"))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return [r[0] for r in counts.orderBy(F.desc("n"), "w").limit(most).select("w").collect()]


_WORD, _VOWELS = re.compile(r"[^\W\d_]+"), re.compile("[aeiouyàâäáåæèéêëìíîïòóôöøùúûüаеёиоуыэюя]+")
_SENTENCE, _HYPHEN = re.compile(r"[.!?]+(?=\s|$)|\n+"), re.compile(r"[^\W\d_]-[^\W\d_]")
#: Words whose facts are remembered by a task; forgotten when they are more.
MOST_REMEMBERED = 200_000
TEXTS_AT_ONCE = 256


class FeatureReader:
    """Features of texts; what is known of a word is looked up once and summed up by arrays."""

    def __init__(self, frequent: Sequence[str]):
        self.rank = {w: i for i, w in enumerate(frequent)}
        self.subordinators, self.be = frozenset(_SUBORDINATORS), frozenset(_BE)
        self.endings = [tuple(e + s for e in es for s in ("", "s")) for es in (_ABSTRACT, _LEARNED)]
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.facts: list[list[float]] = []

    def fact(self, w: str) -> list[float]:
        """Length, syllables, length classes, subordinator, endings, rarity; then a form of "to be", and a participle's ending."""
        n, rank = len(w), self.rank.get(w, 1 << 30)
        ending = [n >= 6 and w.endswith(e) for e in self.endings]
        return [n, len(_VOWELS.findall(w)), n >= 7, n >= 10, n >= 13, w in self.subordinators, *ending, *[rank >= k for k in BANDS], w in self.be, w.endswith(("ed", "en"))]

    def read(self, texts: Sequence[str | None]) -> np.ndarray:
        """A row per text: its number of words, then FEATURES, 0 where it has no word."""
        if len(self.ids) > MOST_REMEMBERED:
            self.clear()
        texts = [t or "" for t in texts]
        words = [_WORD.findall(t.lower()) for t in texts]
        ids, facts = self.ids, self.facts
        for w in {w for ws in words for w in ws}.difference(ids):
            ids[w] = len(facts)
            facts.append(self.fact(w))
        flat = np.fromiter((ids[w] for ws in words for w in ws), np.int64)
        n = np.array([len(ws) for ws in words], np.int64)
        table = np.array(facts, float).reshape(len(facts), 8 + len(BANDS) + 2)
        start = np.concatenate(([0], np.cumsum(n)))
        # A form of "to be" right before a participle, in one text.
        passive = np.zeros(len(flat))
        if len(flat) > 1:
            passive[:-1] = table[flat[:-1], -2] * table[flat[1:], -1]
            passive[np.minimum(start[1:], len(flat)) - 1] = 0

        def summed(values: np.ndarray) -> np.ndarray:
            total = np.concatenate(([0.0], np.cumsum(values)))
            return total[start[1:]] - total[start[:-1]]

        # One fact after the other, so that memory is a few numbers per word.
        got = np.stack([*[summed(table[flat, j]) for j in range(table.shape[1] - 2)], summed(passive)], axis=1)
        sentences = np.maximum(np.array([len(_SENTENCE.findall(t)) for t in texts], float), 1)
        breaks = np.array([t.count(",") + t.count(";") + t.count(":") for t in texts], float)
        hyphens = np.array([len(_HYPHEN.findall(t)) if "-" in t else 0 for t in texts], float)
        asks = np.array([t.count("?") for t in texts], float)
        kinds = np.array([len(set(ws)) for ws in words], float)
        per = np.where(n > 0, n, 1)
        share = lambda c: np.where(n > 0, c / per, 0.0)
        column = dict(
            zip(("word_length", "syllables", "long_words", "longer_words", "longest_words", "subordination", "abstract_endings", "learned_endings", *[f"beyond_{k}" for k in BANDS], "passives"), map(share, got.T))
        ) | {
            "sentence_length": np.log1p(n / sentences), "clause_length": np.log1p(n / (sentences + breaks + got[:, 5])), "commas": share(breaks), "compounds": share(hyphens),
            "questions": asks / sentences, "variety": np.where(n > 0, kinds / np.sqrt(per), 0.0),
        }
        return np.stack([n.astype(float), *[column[c] for c in FEATURES]], axis=1)


def with_features(documents: DataFrame, frequent: Sequence[str]) -> DataFrame:
    """Adds ``__words`` (their number) and ``__<feature>`` of the whole text.

    An Arrow UDF, as one look per word and array sums took about a third of the
    time that list expressions or a pattern per feature took in the JVM.
    """
    known = list(frequent)

    @F.pandas_udf("array<double>")
    def read(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = FeatureReader(known)
        for texts in parts:
            texts = texts.tolist()
            rows = [r for i in range(0, len(texts), TEXTS_AT_ONCE) for r in reader.read(texts[i : i + TEXTS_AT_ONCE])]
            yield pd.Series(rows, dtype=object)

    df = documents.withColumn("__f", read(F.col("text")))
    names = ["words", *FEATURES]
    return df.select(*[F.col(f"`{c}`") for c in documents.columns], *[F.get("__f", F.lit(i)).alias(f"__{n}") for i, n in enumerate(names)])


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: sorted x and the non-decreasing fit of y."""
    order = np.argsort(x, kind="stable")
    xs, blocks = x[order], []
    for v in y[order]:
        blocks.append([float(v), 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, n2 = blocks.pop()
            v1, n1 = blocks.pop()
            blocks.append([(v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2])
    return xs, np.repeat([b[0] for b in blocks], [b[1] for b in blocks])


@dataclass
class Ranker:
    """score = sum of weight * (feature - mean); level = 1 + number of cuts that the score reaches."""

    mean: np.ndarray
    weight: np.ndarray
    cuts: list[float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.weight

    def levels(self, x: np.ndarray) -> np.ndarray:
        return 1 + np.searchsorted(np.array(self.cuts), self.scores(x), side="right")


def _pairs(band: np.ndarray, rater: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of all pairs that one rater put into different bands, the harder one first."""
    for r in np.unique(rater):
        own = np.flatnonzero(rater == r)
        for high in np.unique(band[own]):
            a, b = own[band[own] == high], own[band[own] < high]
            step = max(1, PAIR_BLOCK // max(len(b), 1))
            for at in range(0, len(a), step):
                part = a[at : at + step]
                if len(b):
                    yield np.repeat(part, len(b)), np.tile(b, len(part))


def fit_ranker(x: np.ndarray, band: np.ndarray, rater: np.ndarray, *, l2: float = 1.0, steps: int = 25) -> Ranker:
    """Learns from all pairs one rater put into different bands, so raters' own scales cancel out."""
    mean, spread = x.mean(0), x.std(0)
    z = (x - mean) / np.where(spread > 0, spread, 1)
    k = x.shape[1]
    w = np.zeros(k)
    for _ in range(steps):
        # Newton steps of the logistic loss; the pairs' sums are made block by block.
        gradient, hessian, seen = -l2 * w, l2 * np.eye(k), 0
        for a, b in _pairs(band, rater):
            d = z[a] - z[b]
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            gradient = gradient + d.T @ (1 - p)
            hessian = hessian + (d * (p * (1 - p))[:, None]).T @ d
            seen += len(a)
        if not seen:
            break
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    weight = w / np.where(spread > 0, spread, 1)
    xs, fit = isotonic((x - mean) @ weight, band.astype(float))
    cuts = []
    for k in range(2, LEVELS + 1):
        above = np.flatnonzero(fit >= k - 0.5)
        # Halfway between the last score below and the first above; a level nobody reached starts at infinity.
        cuts.append(float("inf") if not len(above) else float(xs[above[0]]) if above[0] == 0 else float((xs[above[0]] + xs[above[0] - 1]) / 2))
    return Ranker(mean, weight, cuts)


def labelled_features(documents: DataFrame, labels: DataFrame, frequent: Sequence[str], max_labels: int = MAX_LABELS):
    """Features, bands, raters and documents of at most ``max_labels`` labels, chosen by a hash of the label."""
    chosen = (
        labels.where(f"doc_id IS NOT NULL AND band BETWEEN 1 AND {LEVELS}")
        .select(F.col("doc_id").alias("__doc"), F.coalesce("rater", F.lit("")).alias("__rater"), F.col("band").alias("__band"))
        .orderBy(F.xxhash64("__doc", "__rater", "__band"), "__doc", "__rater", "__band")
        .limit(max_labels)
    )
    # At most max_labels rows are broadcast, so the documents are scanned without a shuffle.
    joined = documents.select(F.col("doc_id").alias("__id"), "text").where("text IS NOT NULL").join(F.broadcast(chosen), F.col("__id") == F.col("__doc"))
    names = [f"__{n}" for n in FEATURES]
    frame = with_features(joined, frequent).select("__doc", "__rater", "__band", *names).toPandas()
    frame = frame.sort_values(["__doc", "__rater", "__band", *names]).reset_index(drop=True)
    return frame[names].to_numpy(float), frame["__band"].to_numpy(int), frame["__rater"].to_numpy(str), frame["__doc"].to_numpy()


def fitted(x: np.ndarray, band: np.ndarray, rater: np.ndarray) -> dict[str, Ranker]:
    """A ranker of all features for English, and one of the neutral features for other languages."""
    def one(names: Sequence[str]) -> Ranker:
        at = [FEATURES.index(n) for n in names]
        if not len(x):
            return Ranker(np.zeros(len(at)), np.zeros(len(at)), [float("inf")] * (LEVELS - 1))
        return fit_ranker(x[:, at], band, rater)

    return {"english": one(FEATURES), "other": one(NEUTRAL)}


def reading_levels(documents: DataFrame, labels: DataFrame, *, max_labels: int = MAX_LABELS) -> DataFrame:
    """``doc_id, source, words, score, level`` for every row of documents.

    ``level`` is 1 (easiest) to 5. A text without any word (NULL, blank, only
    signs) has ``score`` NULL and level 1: there is nothing hard to read.
    Repeated rows get equal levels. The labels are of English documents; texts
    that ``lang`` (if there is such a column) says are in another language are
    judged by a ranker of the features that mean the same in any language.
    Without labels every level is 1. Documents are not shuffled; before the
    scoring pass one pass counts the words of all documents.
    """
    if "lang" not in documents.columns:
        documents = documents.withColumn("lang", F.lit(None).cast("string"))
    frequent = frequent_words(documents)
    rankers = fitted(*labelled_features(documents, labels, frequent, max_labels)[:3])
    english = F.coalesce(F.lower(F.trim(F.col("lang"))).rlike("^(?:en(?:g|glish)?(?:[-_].*)?)?$"), F.lit(True))
    base = with_features(documents.select("doc_id", "source", "text", english.alias("__english")), frequent)
    score = lambda r, names: sum([F.lit(float(w)) * (F.col(f"__{n}") - F.lit(float(m))) for n, w, m in zip(names, r.weight, r.mean)], F.lit(0.0))

    def level(r: Ranker) -> Column:
        out = F.lit(1)
        for cut in r.cuts:
            if cut != float("inf"):
                out = out + F.coalesce((F.col("score") >= F.lit(cut)).cast("int"), F.lit(0))
        return out

    scored = base.withColumn("score", F.when(F.col("__words") > 0, F.when(F.col("__english"), score(rankers["english"], FEATURES)).otherwise(score(rankers["other"], NEUTRAL))))
    return scored.select("doc_id", "source", F.col("__words").cast("bigint").alias("words"), "score", F.when(F.col("__english"), level(rankers["english"])).otherwise(level(rankers["other"])).alias("level"))


def held_out(documents: DataFrame, labels: DataFrame, *, folds: int = 5, max_labels: int = MAX_LABELS) -> dict[str, float]:
    """How levels agree with bands of documents that were not used to fit, over folds by document."""
    frequent = frequent_words(documents)
    x, band, rater, doc = labelled_features(documents, labels, frequent, max_labels)
    fold = np.array([zlib.crc32(str(d).encode()) % folds for d in doc])
    gap = {"english": [], "other": []}
    for f in range(folds):
        test = fold == f
        if test.any() and not test.all():
            for name, r in fitted(x[~test], band[~test], rater[~test]).items():
                at = [FEATURES.index(n) for n in (FEATURES if name == "english" else NEUTRAL)]
                gap[name] += list(np.abs(r.levels(x[test][:, at]) - band[test]))
    out = {"labels": float(len(band))}
    for name, g in gap.items():
        g = np.array(g)
        out |= {f"{name}_same": float((g == 0).mean()) if len(g) else 0.0, f"{name}_within_one": float((g <= 1).mean()) if len(g) else 0.0}
    return out


def profile(levels: DataFrame) -> DataFrame:
    """Documents and words per source and level."""
    return levels.groupBy("source", "level").agg(F.count("*").alias("documents"), F.sum("words").alias("words"))
