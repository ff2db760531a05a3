"""Topics: one factorization of all messages, applied to every message."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurate.functions.normalize import without_labels
from murmurate.operators.linguistic import STOPWORDS
from murmurate.operators.prepare import seeded_sample
from murmurate.schema import col
from murmurate.session import Scratch, shuffle_partitions

_TOKEN = re.compile(r"\b\w[\w'-]+\b")
_STOP = frozenset(STOPWORDS)
TOPIC_COLUMNS = ("topic_id", "topic_label", "topic_weight", "topic_score", "topic_entropy", "topic_margin", "topic_vocabulary_terms")


def _words(text: str) -> list[str]:
    return [w for w in _TOKEN.findall(text.lower()) if w not in _STOP]


@dataclass(frozen=True)
class Rows:
    """Sparse rows: row i has the ``values`` at ``terms`` from ``starts[i]`` up to ``starts[i + 1]``."""

    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.starts) - 1

    def blocks(self, size: int = 1000) -> Iterator[Rows]:
        for i in range(0, len(self), size):
            starts = self.starts[i : i + size + 1]
            a, b = starts[0], starts[-1]
            yield Rows(starts - a, self.terms[a:b], self.values[a:b], self.width)

    def times(self, m: np.ndarray) -> np.ndarray:
        """Rows x m, for m with a row per term."""
        out = np.zeros((len(self), m.shape[1]))
        filled = np.flatnonzero(np.diff(self.starts))
        if len(filled):
            out[filled] = np.add.reduceat(m[self.terms] * self.values[:, None], self.starts[filled], axis=0)
        return out

    def under(self, w: np.ndarray) -> np.ndarray:
        """Transposed w x rows, for w with a row per row."""
        row = np.repeat(np.arange(len(self)), np.diff(self.starts))
        return np.stack([np.bincount(self.terms, self.values * c[row], self.width) for c in w.T])


@dataclass(frozen=True)
class TopicModel:
    vocabulary: dict[str, int]
    idf: np.ndarray
    topics: np.ndarray
    labels: list[str]
    fit_rows: int
    seed: int
    rounds: int = 0

    def matrix(self, texts: Iterable[str | None]) -> Rows:
        """L2-normalized TF-IDF rows."""
        starts, terms, values = [0], [], []
        for t in texts:
            found = Counter(j for w in _words(t or "") if (j := self.vocabulary.get(w)) is not None)
            js = np.fromiter(sorted(found), np.int32, len(found))
            x = np.fromiter((found[j] for j in js), float, len(js)) * self.idf[js]
            terms.append(js)
            values.append(x / (np.linalg.norm(x) or 1))
            starts.append(starts[-1] + len(js))
        none = np.zeros(0)
        return Rows(np.array(starts), np.concatenate([none.astype(np.int32), *terms]), np.concatenate([none, *values]), len(self.idf))

    def weights(self, x: Rows) -> np.ndarray:
        """Non-negative weights of the topics that rebuild each row best."""
        return _rebuilt(x.times(self.topics.T), self.topics @ self.topics.T)

    def assign(self, texts: Sequence[str | None]) -> pd.DataFrame:
        x = self.matrix(texts)
        w = self.weights(x)
        total = w.sum(1)
        known = total > 1e-12
        p = np.where(known[:, None], w / np.where(known, total, 1)[:, None], np.nan)
        best = np.where(known, np.nan_to_num(p).argmax(1), 0)
        k = p.shape[1]
        falling = -np.sort(-np.nan_to_num(p), axis=1)
        h = -np.where(p > 0, p * np.log(np.where(p > 0, p, 1)), 0).sum(1) / (np.log(k) if k > 1 else 1)
        pick = lambda v: [float(a) if ok else None for a, ok in zip(v, known)]
        return pd.DataFrame(
            {
                "topic_id": pd.array([int(b) if ok else None for b, ok in zip(best, known)], dtype="Int32"),
                "topic_label": [self.labels[b] if ok else None for b, ok in zip(best, known)],
                "topic_weight": pick(w[np.arange(len(w)), best]), "topic_score": pick(falling[:, 0]), "topic_entropy": pick(h),
                "topic_margin": pick(falling[:, 0] - falling[:, 1] if k > 1 else np.ones(len(w))),
                "topic_vocabulary_terms": np.diff(x.starts).astype("int32"),
            }
        )


def _rebuilt(top: np.ndarray, gram: np.ndarray, start: np.ndarray | None = None, rounds: int = 500) -> np.ndarray:
    """Non-negative w with the least ``w gram w' - 2 w top'`` per row, by coordinate descent until nothing moves."""
    w = np.zeros(top.shape, order="F") if start is None else np.array(start, order="F")
    for _ in range(rounds):
        moved = 0.0
        for j in np.flatnonzero(np.diag(gram) > 0):
            new = np.maximum(w[:, j] + (top[:, j] - w @ gram[:, j]) / gram[j, j], 0)
            moved = max(moved, np.abs(new - w[:, j]).max(initial=0))
            w[:, j] = new
        if moved <= 1e-6 * w.max(initial=0):
            break
    return w


# What a pass over all rows sums up, per block of rows.


def _products(x: Rows, m: np.ndarray) -> np.ndarray:
    return x.under(x.times(m))


def _halves(x: Rows, m: np.ndarray) -> np.ndarray:
    """Squared lengths of the positive and the negative part of each column of rows x m."""
    u = x.times(m)
    return np.stack([(np.maximum(u, 0) ** 2).sum(0), (np.minimum(u, 0) ** 2).sum(0)], axis=1)


def _topic_sums(x: Rows, h: np.ndarray) -> np.ndarray:
    """W'X beside W'W, for the best weights W of the rows under topics h."""
    w = _rebuilt(x.times(h.T), h @ h.T)
    return np.hstack([x.under(w), w.T @ w])


Pass = Callable[[Callable[[Rows, np.ndarray], np.ndarray], np.ndarray], np.ndarray]


def _start(over: Pass, width: int, k: int, mean: float, seed: int) -> np.ndarray:
    """NNDSVDa's deterministic topics: non-negative parts of the right singular vectors, zeros filled with the mean.

    The vectors come from subspace iteration, eight passes over the rows.
    """
    z = np.random.default_rng(seed).normal(size=(width, min(k + 10, width)))
    for _ in range(8):
        q = np.linalg.qr(z)[0]
        z = over(_products, q).T
    squares, turn = np.linalg.eigh(q.T @ z)
    order = np.argsort(-squares)[:k]
    s, v = np.sqrt(np.maximum(squares[order], 0)), q @ turn[:, order]
    lengths = np.sqrt(over(_halves, v)) / np.where(s > 0, s, 1)[:, None]
    h = np.zeros((k, width))
    for j in range(k):
        sides = np.maximum(v[:, j], 0), np.maximum(-v[:, j], 0)
        sizes = [lengths[j, i] * np.linalg.norm(sides[i]) for i in (0, 1)]
        best = int(sizes[1] > sizes[0])
        h[j] = np.sqrt(s[j] * sizes[best]) * sides[best] / (np.linalg.norm(sides[best]) or 1)
    h[h < 1e-10] = mean
    return h


def _factorized(over: Pass, h: np.ndarray, rounds: int, tolerance: float) -> tuple[np.ndarray, int]:
    """Topics of a non-negative factorization of all rows, and the rounds they took.

    A round finds the best weights for the topics, in one pass that leaves W'X
    and W'W, and then the best topics for those sums. It ends when the
    projected gradient has fallen to ``tolerance`` of its first size.
    """
    k, first = len(h), None
    for n in range(1, rounds + 1):
        sums = over(_topic_sums, h)
        top, gram = sums[:, :-k], sums[:, -k:]
        slope = gram @ h - top
        size = np.abs(np.where(h > 0, slope, np.minimum(slope, 0))).sum()
        first = size if first is None else first
        if size <= tolerance * first:
            return h, n
        h = np.ascontiguousarray(_rebuilt(top.T, gram, h.T).T)
    return h, rounds


def _counted(texts: Iterable[str | None]) -> tuple[Counter, Counter]:
    """In how many texts, and how often, each word occurs."""
    df, tf = Counter(), Counter()
    for t in texts:
        words = Counter(_words(t or ""))
        df.update(words.keys())
        tf.update(words)
    return df, tf


def _bounds(n: int) -> tuple[int, float]:
    return (1, n) if n < 20 else (2, 0.95 * n)


def _check(topics: int, max_features: int, rounds: int) -> None:
    if min(topics, max_features, rounds) < 1:
        raise ValueError("topic sizes must be positive")


def _unfitted(df: dict[str, int], n: int, seed: int) -> TopicModel:
    """A model of the terms of the vocabulary by document frequency, without topics."""
    if not df:
        raise ValueError("the topic vocabulary is empty")
    terms = sorted(df)
    idf = np.array([np.log((1 + n) / (1 + df[w])) + 1 for w in terms])
    return TopicModel({w: i for i, w in enumerate(terms)}, idf, np.zeros((0, len(terms))), [], n, seed)


def _fitted(model: TopicModel, over: Pass, total: float, topics: int, seed: int, top_terms: int, rounds: int, tolerance: float) -> TopicModel:
    n, width, terms = model.fit_rows, len(model.idf), list(model.vocabulary)
    k = min(topics, n, width)
    h, used = _factorized(over, _start(over, width, k, total / (n * width), seed), rounds, tolerance)
    labels = [" | ".join(terms[i] for i in row.argsort()[-top_terms:][::-1]) for row in h]
    return TopicModel(model.vocabulary, model.idf, h, labels, n, seed, used)


def fit_topics(texts: Sequence[str | None], *, topics: int = 12, max_features: int = 20_000, seed: int = 42, top_terms: int = 8, rounds: int = 400, tolerance: float = 1e-4) -> TopicModel:
    """TF-IDF and non-negative factorization of texts that the driver holds; ``fit_topics_on`` does the same for a table."""
    _check(topics, max_features, rounds)
    kept = [t for t in texts if t and t.strip()]
    if not kept:
        raise ValueError("cannot fit topics without text")
    df, tf = _counted(kept)
    least, most = _bounds(len(kept))
    terms = sorted((w for w, c in df.items() if least <= c <= most), key=lambda w: (-tf[w], w))[:max_features]
    model = _unfitted({w: df[w] for w in terms}, len(kept), seed)
    x = model.matrix(kept)
    return _fitted(model, lambda step, m: sum(step(b, m) for b in x.blocks()), x.values.sum(), topics, seed, top_terms, rounds, tolerance)


def _pass_over(x: DataFrame, width: int) -> Pass:
    """Sums over a table of ``terms, values`` (int32 and float64 as bytes).

    Each task adds up its own rows; partial sums are put together per row of
    the result, in the order of tasks, so the same tasks give the same sums.
    """
    spark = x.sparkSession
    x = x.coalesce(max(spark.sparkContext.defaultParallelism, 1))

    def over(step, m: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(m)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                terms, values = (np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(v.as_buffer(), np.uint8) for v in batch.column(i)]]) for i in (0, 1))
                lengths = np.fromiter((v.as_buffer().size // 4 for v in batch.column(0)), np.int64, batch.num_rows)
                rows = Rows(np.concatenate([[0], np.cumsum(lengths)]), terms.view(np.int32), values.view(np.float64), width)
                for block in rows.blocks():
                    part = step(block, shared.value)
                    total = part if total is None else total + part
            if total is not None:
                n = len(total)
                yield pa.RecordBatch.from_pydict({"task": pa.array([TaskContext.get().partitionId()] * n, pa.int32()), "at": pa.array(range(n), pa.int32()), "sums": pa.array([r.tobytes() for r in total], pa.binary())})

        def added(parts: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(b) for b in parts.sort_values("task")["sums"])
            return pd.DataFrame({"at": parts["at"].iloc[:1], "sums": [total.tobytes()]})

        out = x.mapInArrow(partial, "task int, at int, sums binary").groupBy("at").applyInPandas(added, "at int, sums binary").collect()
        shared.destroy()
        return np.stack([np.frombuffer(r["sums"]) for r in sorted(out, key=lambda r: r["at"])])

    return over


def fit_topics_on(
    df: DataFrame, *, text: str = "text_cleaned", key: str = "message_id", sample: int | None = None, seed: int = 42, topics: int = 12, max_features: int = 20_000, top_terms: int = 8,
    rounds: int = 400, tolerance: float = 1e-4,
) -> TopicModel:
    """Fits once on all messages, or on the first ``sample`` in stable hash order, without label tokens.

    Words are counted, rows weighted and topics fitted by tasks over all rows.
    The driver holds the vocabulary and sums of a row per topic alone.
    """
    _check(topics, max_features, rounds)
    spark = df.sparkSession
    plain = df.select(col(key), without_labels(col(text)).alias("t")).where(F.trim("t") != "")
    if sample is not None:
        plain = seeded_sample(plain, sample, key, seed)
    scratch = Scratch(spark, "topics")
    tasks = max(shuffle_partitions(spark), spark.sparkContext.defaultParallelism)
    plain = scratch.write(plain.repartition(tasks, col(key), col("t")).sortWithinPartitions(key, "t").select("t"), "text")
    n = plain.count()
    if not n:
        raise ValueError("cannot fit topics without text")

    def counts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            d, t = _counted(part["t"])
            yield pd.DataFrame({"w": list(d), "d": list(d.values()), "t": [t[w] for w in d]})

    words = plain.mapInPandas(counts, "w string, d bigint, t bigint").groupBy("w").agg(F.sum("d").alias("d"), F.sum("t").alias("t"))
    least, most = _bounds(n)
    terms = words.where(F.col("d").between(least, most)).orderBy(F.desc("t"), "w").limit(max_features).collect()
    model = _unfitted({r["w"]: r["d"] for r in terms}, n, seed)
    shared = spark.sparkContext.broadcast(model)

    def weighted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            x = shared.value.matrix(part["t"])
            spans = [slice(a, b) for a, b in zip(x.starts[:-1], x.starts[1:]) if b > a]
            yield pd.DataFrame({"terms": [x.terms[i].tobytes() for i in spans], "values": [x.values[i].tobytes() for i in spans], "total": [float(x.values[i].sum()) for i in spans]})

    x = scratch.write(plain.mapInPandas(weighted, "terms binary, values binary, total double"), "rows")
    total = x.agg(F.sum("total")).first()[0]
    out = _fitted(model, _pass_over(x.select("terms", "values"), len(model.idf)), total, topics, seed, top_terms, rounds, tolerance)
    shared.destroy()
    scratch.close()
    return out


def assign_topics(df: DataFrame, model: TopicModel, text: str = "text_cleaned") -> DataFrame:
    """Topic columns of every message; without a word of the vocabulary they are NULL, never topic 0."""
    ddl = "struct<topic_id:int,topic_label:string,topic_weight:double,topic_score:double,topic_entropy:double,topic_margin:double,topic_vocabulary_terms:int>"
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(ddl)
    def run(texts: pd.Series) -> pd.DataFrame:
        parts = [shared.value.assign(texts.iloc[i : i + 2000].tolist()) for i in range(0, len(texts), 2000)]
        return pd.concat(parts, ignore_index=True)

    out = df.drop(*TOPIC_COLUMNS).withColumn("__t", run(without_labels(F.coalesce(col(text), F.lit("")))))
    return out.withColumns({c: F.col(f"__t.{c}") for c in TOPIC_COLUMNS}).drop("__t")
