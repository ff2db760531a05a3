"""Languages of messages and of their stretches, by a linear-chain conditional random field."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurate.functions.temporal import stripped

LANGUAGES = ("en", "es", "pt", "fr", "de", "it", "nl", "ru")
#: Labelled messages used for training at most, chosen by hash; the model is applied to all.
TRAIN_ROWS = 4000
#: Longer training texts are several sequences.
TRAIN_WORDS = 60
BUCKETS = 1 << 17
#: Words a stretch needs to count as a clause of its language.
CLAUSE_WORDS = 5

# Codes and names by which labels call the languages (ISO 639-1, 639-2/3, English and own names).
LABELS = {
    "en": "en eng english englisch anglais inglés ingles inglese inglês engels английский",
    "es": "es spa spanish español espanol castellano spanisch espagnol spaans испанский",
    "pt": "pt por portuguese português portugues portugiesisch portugais portugees португальский",
    "fr": "fr fra fre french français francais französisch frans французский",
    "de": "de deu ger german deutsch allemand alemán aleman tedesco duits немецкий",
    "it": "it ita italian italiano italienisch italien italiaans итальянский",
    "nl": "nl nld dut dutch nederlands niederländisch néerlandais нидерландский",
    "ru": "ru rus russian русский russisch russe ruso russo",
}
# Frequent function words of each language, the lexicon of the lexicon feature.
COMMON = {
    "en": "the a of to and is in it you that not i on with for my was at be this have from but what when if there does how after who",
    "es": "el la de que y a en un los se no por con una su para es las como pero más le lo mi si sin hay ya ha tienes",
    "pt": "o a de que e do da em um para é com não uma os no se na por mais as mas ao ele meu sem já você isso quando",
    "fr": "le la de et les des un une à en que qui est pas pour dans du ne ce je il sur au avec mais mon plus si on chez",
    "de": "der die das und ist nicht ich ein eine zu den mit auf für es dem sich wenn mein aber wie bei ist alles man ohne den noch am",
    "it": "il la di che e un una a in per non è sono con del i le lo mi si da ma come mio se più alla dove senza poi",
    "nl": "de het een van en is niet ik te dat op met voor je zijn er maar als mijn om hem bij aan ook wel nog zonder weer heb",
    "ru": "и в не на я что с как это а по но у к из за то же для если мой его так уже без или только при нет",
}

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
# Between two words of one clause there is none of these.
_BREAK = re.compile(r"\.(?!\w)|[;!?\n\r\"“”«»()\[\]{}|]|\s[/-]\s|->|(?<!\w)'|'(?!\w)|:\s*['\"]")


def label_language(label: Column) -> Column:
    """The language a label names, whatever code or name it uses, or NULL; regions are ignored."""
    known = F.create_map(*[F.lit(x) for k, names in LABELS.items() for n in names.split() for x in (n, k)])
    return F.try_element_at(known, F.regexp_replace(F.lower(stripped(label)), r"[-_].*$", ""))


class Lexicon:
    """Technical terms, which every language borrows: their words tell nothing about the language."""

    #: What such a word is read as; it has no feature, so the words around it decide.
    NEUTRAL = "<t>"

    def __init__(self, terms: Iterable[str] = ()):
        self.terms = frozenset(tuple(t.lower().split()) for t in terms)
        self.longest = max((len(t) for t in self.terms), default=0)

    def read(self, words: list[str]) -> list[str]:
        out, i = [], 0
        while i < len(words):
            for n in range(min(self.longest, len(words) - i), 0, -1):
                if tuple(words[i : i + n]) in self.terms:
                    out += [self.NEUTRAL] * n
                    i += n
                    break
            else:
                out.append(words[i])
                i += 1
        return out


def word_features(word: str) -> list[str]:
    """Affixes, character n-grams and lexicon entries of one word in lower case."""
    if word == Lexicon.NEUTRAL:
        return []
    marked = f"^{word}$"
    out = ["bias", f"w={word}"]
    out += [f"p{n}={word[:n]}" for n in (1, 2, 3, 4) if len(word) >= n]
    out += [f"s{n}={word[-n:]}" for n in (1, 2, 3, 4) if len(word) >= n]
    out += [f"g={marked[i : i + n]}" for n in (2, 3) for i in range(len(marked) - n + 1)]
    out += [f"lex={k}" for k, words in _COMMON_SETS.items() if word in words]
    out += [f"c={c}" for c in set(word) if c > "z"]
    out.append("script=" + ("cyrillic" if any("Ѐ" <= c <= "ӿ" for c in word) else "latin"))
    return out


_COMMON_SETS = {k: frozenset(v.split()) for k, v in COMMON.items()}


def hashed(word: str) -> np.ndarray:
    return np.unique(np.array([zlib.crc32(f.encode()) % BUCKETS for f in word_features(word)], dtype=np.int64))


def forward_backward(emit: np.ndarray, length: np.ndarray, start: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals ``(B, L, K)``, expected transitions ``(K, K)`` and log partition ``(B,)`` of a padded batch.

    Forward and backward vectors are scaled to sum to 1 at every word, so each
    step is one matrix product; the scales make up the partition.
    """
    b, steps, k = emit.shape
    top, highest = emit.max(2), trans.max()
    e, move = np.exp(emit - top[:, :, None]), np.exp(trans - highest)
    alpha, beta = np.empty_like(e), np.full_like(e, 1.0 / k)
    live = np.arange(steps)[None, :] < length[:, None]
    now = np.exp(start - start.max()) * e[:, 0]
    scale = now.sum(1, keepdims=True)
    alpha[:, 0] = now / scale
    log_z = np.log(scale[:, 0]) + top[:, 0] + start.max()
    for t in range(1, steps):
        now = (alpha[:, t - 1] @ move) * e[:, t]
        scale = now.sum(1, keepdims=True)
        alpha[:, t] = now / scale
        log_z += np.where(live[:, t], np.log(scale[:, 0]) + top[:, t] + highest, 0.0)
    moved = np.zeros((k, k))
    for t in range(steps - 2, -1, -1):
        follow = e[:, t + 1] * beta[:, t + 1]
        back = follow @ move.T
        on = live[:, t + 1]
        beta[:, t] = np.where(on[:, None], back / back.sum(1, keepdims=True), 1.0 / k)
        whole = (alpha[:, t] * back).sum(1)
        moved += move * (alpha[:, t].T @ np.where(on[:, None], follow / whole[:, None], 0.0))
    both = alpha * beta
    marginal = np.where(live[:, :, None], both / both.sum(2, keepdims=True), 0.0)
    return marginal, moved, log_z


@dataclass
class Crf:
    weight: np.ndarray
    start: np.ndarray
    trans: np.ndarray
    lexicon: Lexicon = field(default_factory=Lexicon)
    known: dict[str, np.ndarray] = field(default_factory=dict)

    def emission(self, word: str) -> np.ndarray:
        got = self.known.get(word)
        if got is None:
            got = self.weight[hashed(word)].sum(0)
            # A cache of this size, not a limit of the vocabulary.
            if len(self.known) < 200_000:
                self.known[word] = got
        return got

    def marginals(self, sentences: list[list[str]], cells: int = 60_000) -> list[np.ndarray]:
        """Per sentence the probability of every language for every word; similar lengths share a batch."""
        sentences = [self.lexicon.read(s) for s in sentences]
        out: list[np.ndarray] = [np.zeros((0, len(self.start)))] * len(sentences)
        order = sorted((i for i, s in enumerate(sentences) if s), key=lambda i: len(sentences[i]))
        at = 0
        while at < len(order):
            stop, longest = at, 0
            while stop < len(order) and max(longest, len(sentences[order[stop]])) * (stop - at + 1) <= max(cells, len(sentences[order[stop]])):
                longest = len(sentences[order[stop]])
                stop += 1
            part = order[at:stop]
            length = np.array([len(sentences[i]) for i in part])
            emit = np.zeros((len(part), length.max(), len(self.start)))
            for r, i in enumerate(part):
                emit[r, : length[r]] = [self.emission(w) for w in sentences[i]]
            marginal = forward_backward(emit, length, self.start, self.trans)[0]
            for r, (i, n) in enumerate(zip(part, length)):
                out[i] = marginal[r, :n]
            at = stop
        return out


def _train(sentences: list[list[str]], labels: list[np.ndarray], lexicon: Lexicon, *, steps: int, transitions: bool, init: Crf | None = None, l2: float = 0.02) -> Crf:
    """Full-batch gradient ascent (Adam) on the likelihood of the labels."""
    k = len(LANGUAGES)
    types = sorted({w for s in sentences for w in s})
    number = {w: i for i, w in enumerate(types)}
    feats = [hashed(w) for w in types]
    used, flat = np.unique(np.concatenate(feats), return_inverse=True)
    owner = np.repeat(np.arange(len(types)), [len(f) for f in feats])
    w = init.weight[used].copy() if init else np.zeros((len(used), k))
    start = init.start.copy() if init else np.zeros(k)
    trans = init.trans.copy() if init else np.zeros((k, k))
    ids = [np.array([number[x] for x in s]) for s in sentences]
    length = np.array([len(s) for s in ids])
    padded = np.zeros((len(ids), length.max()), dtype=np.int64)
    gold = np.zeros((len(ids), length.max()), dtype=np.int64)
    for r, (s, y) in enumerate(zip(ids, labels)):
        padded[r, : len(s)], gold[r, : len(s)] = s, y
    live = np.arange(padded.shape[1])[None, :] < length[:, None]
    seen = np.zeros((len(types), k))
    np.add.at(seen, (padded[live], gold[live]), 1)
    moves = np.zeros((k, k))
    both = live[:, 1:]
    np.add.at(moves, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    begins = np.bincount(gold[:, 0], minlength=k).astype(float)
    params = [w, start, trans]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    tokens = live.sum()

    def spread(values: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(flat, values[owner, j], minlength=len(used)) for j in range(k)], 1)

    counted = seen.sum(1)
    for step in range(1, steps + 1):
        score = np.stack([np.bincount(owner, w[flat, j], minlength=len(types)) for j in range(k)], 1)
        if transitions:
            marginal, moved, _ = forward_backward(score[padded], length, start, trans)
            expected = np.zeros((len(types), k))
            np.add.at(expected, padded[live], marginal[live])
            grads = [spread(seen - expected) / tokens, (begins - marginal[:, 0].sum(0)) / tokens, (moves - moved) / tokens]
        else:
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            grads = [spread(seen - p * counted[:, None]) / tokens, np.zeros(k), np.zeros((k, k))]
        for i, (p, g) in enumerate(zip(params, grads)):
            g = g - l2 * p / tokens
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p += 0.1 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-9)
    weight = np.zeros((BUCKETS, k), dtype=np.float32)
    weight[used] = w
    return Crf(weight, start, trans, lexicon)


def fit(texts: list[str], labels: list[str], lexicon: Lexicon | None = None) -> Crf:
    """Learns from messages with one, possibly wrong, label each.

    Words first take their message's label. A model without transitions is
    fitted to that, and decoding with transitions that favour staying in a
    language replaces labels that most other messages contradict: wrong ones,
    and those of the other language in a mixed message. Then the chain is fitted.
    """
    lexicon = lexicon or Lexicon()
    sentences = [lexicon.read([w.lower() for w in _WORD.findall(t)]) for t in texts]
    kept = [(s[i : i + TRAIN_WORDS], LANGUAGES.index(y)) for s, y in zip(sentences, labels) for i in range(0, len(s), TRAIN_WORDS)]
    if not kept:
        return Crf(np.zeros((BUCKETS, len(LANGUAGES)), np.float32), np.zeros(len(LANGUAGES)), np.zeros((len(LANGUAGES),) * 2), lexicon)
    sentences, gold = [s for s, _ in kept], [np.full(len(s), y) for s, y in kept]
    stay = np.full((len(LANGUAGES),) * 2, np.log(0.01))
    np.fill_diagonal(stay, np.log(0.93))
    for steps in (40, 60):
        model = _train(sentences, gold, lexicon, steps=steps, transitions=False)
        model.trans = stay
        gold = [p.argmax(1) for p in model.marginals(sentences)]
    # The chain starts from those transitions and learns its own.
    return _train(sentences, gold, lexicon, steps=30, transitions=True, init=Crf(model.weight.astype(float), model.start, stay, lexicon))


def training_rows(messages: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], list[str]]:
    """At most ``rows`` labelled texts, chosen by a hash of the row's id and so the same in any layout."""
    known = labels.select(F.col("row_id").alias("__r"), label_language(F.col("lang").cast("string")).alias("__y")).where("__r IS NOT NULL AND __y IS NOT NULL")
    # Twice as many labels as rows, since a text may be missing or blank; bounded, so broadcast.
    known = known.orderBy(F.xxhash64("__r"), "__r", "__y").limit(2 * rows)
    joined = messages.select("row_id", "text").join(F.broadcast(known), F.col("row_id") == F.col("__r")).where("text IS NOT NULL")
    found = joined.orderBy(F.xxhash64("__r"), "__r", "__y", "text").limit(rows).select("text", "__y").collect()
    return [r[0] for r in found], [r[1] for r in found]


def stretches(text: str, words: list[tuple[str, int, int]], marginal: np.ndarray) -> Iterator[tuple[int, int, str, int, int, float]]:
    """``start, end, language, words, most words in one clause, confidence`` of each run of one language."""
    if not words:
        return
    best = marginal.argmax(1)
    n, a = len(words), 0
    while a < n:
        # One or two words inside a clause of another language are a name or a borrowed word.
        b = a
        while b + 1 < n and best[b + 1] == best[a]:
            b += 1
        inside = 0 < a and b + 1 < n and b - a < 2 and best[a - 1] == best[b + 1]
        if inside and not any(_BREAK.search(text, words[i - 1][2], words[i][1]) for i in range(a, b + 2)):
            best[a : b + 1] = best[a - 1]
        a = b + 1
    a = 0
    while a < n:
        b = a
        while b + 1 < n and best[b + 1] == best[a]:
            b += 1
        longest = count = 1
        for i in range(a + 1, b + 1):
            count = 1 if _BREAK.search(text, words[i - 1][2], words[i][1]) else count + 1
            longest = max(longest, count)
        yield words[a][1], words[b][2], LANGUAGES[best[a]], b - a + 1, longest, float(marginal[a : b + 1, best[a]].mean())
        a = b + 1


_STRETCH = "row_id bigint, start_pos int, end_pos int, lang string, words int, clause_words int, confidence double"


def segments(messages: DataFrame, model: Crf) -> DataFrame:
    """One row per stretch of one language in every text, positions in code points.

    ``messages`` has ``row_id`` and ``text``. NULL texts and texts without a
    word give no row; repeated rows give repeated rows. The model's size is
    fixed, so it travels with the tasks; texts are read whole.
    """
    shared = messages.sparkSession.sparkContext.broadcast(model)

    def read(batches):
        crf = shared.value
        for frame in batches:
            texts = [t or "" for t in frame.text]
            words = [[(m.group().lower(), *m.span()) for m in _WORD.finditer(t)] for t in texts]
            marginals = crf.marginals([[w for w, _, _ in s] for s in words])
            rows = [(i, *s) for i, t, w, p in zip(frame.row_id, texts, words, marginals) for s in stretches(t, w, p)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _STRETCH.split(", ")]).astype(
                {"row_id": "int64", "start_pos": "int32", "end_pos": "int32", "words": "int32", "clause_words": "int32", "confidence": "float64"}
            )

    ids = messages.select(F.col("row_id").cast("bigint").alias("row_id"), F.col("text").cast("string").alias("text")).where("row_id IS NOT NULL")
    return ids.mapInPandas(read, _STRETCH)


def message_languages(found: DataFrame) -> DataFrame:
    """``row_id, lang, confidence, languages``: the language of most words, and all with a whole clause."""
    per = found.groupBy("row_id", "lang").agg(
        F.sum("words").alias("words"), F.max("clause_words").alias("clause_words"),
        (F.sum(F.col("confidence") * F.col("words")) / F.sum("words")).alias("confidence"),
    )
    return per.groupBy("row_id").agg(
        F.max(F.struct("words", "confidence", "lang")).alias("best"),
        F.array_sort(F.collect_set(F.when(F.col("clause_words") >= CLAUSE_WORDS, F.col("lang")))).alias("languages"),
    ).select("row_id", F.col("best.lang").alias("lang"), F.col("best.confidence").alias("confidence"), "languages")


def doubtful_labels(messages: DataFrame, labels: DataFrame, model: Crf) -> DataFrame:
    """``row_id, lang``: the languages of messages whose label is missing, wrong or one of several.

    A language is in a message if a stretch of it has a clause of at least
    five words. A label of no known language is missing; a label of a language
    without such a clause is wrong. A row labelled twice is judged by each label.
    """
    given = labels.where("row_id IS NOT NULL").select(F.col("row_id").cast("bigint").alias("row_id"), label_language(F.col("lang").cast("string")).alias("given"))
    labelled = messages.join(given.select("row_id").distinct(), "row_id", "left_semi")
    spoken = segments(labelled, model).where(F.col("clause_words") >= CLAUSE_WORDS).groupBy("row_id").agg(F.collect_set("lang").alias("languages"))
    cases = given.join(spoken, "row_id").where(
        F.col("given").isNull() | (F.size("languages") > 1) | ~F.array_contains("languages", F.coalesce("given", F.lit("")))
    )
    return cases.select("row_id", F.explode("languages").alias("lang")).distinct()
