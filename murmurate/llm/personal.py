"""Personal information inside free text, by bootstrapped contextual extraction."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurate.operators.skew import salted_join
from murmurate.session import Scratch

KINDS = ("email", "address", "phone", "id_number", "name")
#: Bits of the filter that lets only pairs with a possible family name through; fixed, so its size is too.
FILTER_BITS = 1 << 20
MOST_REMEMBERED = 200_000

# The shapes that identifiers are written in. A shape marked strong can hardly be
# anything else and makes its instances seeds; a weak one is decided by context.
_WORD = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_UNIT = r"(?:,? (?:apt|flat|unit|suite)\.? ?\w+)?"
_STREET = r"(?:street|st\.?|avenue|ave\.?|road|rd\.?|lane|ln\.?|drive|dr\.?|court|ct\.?|close|crescent|boulevard|blvd\.?|square|terrace|place|way)"
_LOCAL = r"(?<![\w.+@-])[\w+-]+(?:\.[\w+-]+)*"
_SHAPES: list[tuple[str, bool, re.Pattern]] = [
    ("email", True, re.compile(rf"{_LOCAL}@(?:[^\W\d_][\w-]*\.)+[^\W\d_]{{2,}}(?![\w@])")),
    ("email", True, re.compile(rf"{_LOCAL} ?[(\[{{] ?at ?[)\]}}] ?[\w-]+(?:(?: ?[(\[{{] ?dot ?[)\]}}] ?|\.)[\w-]+)+", re.I)),
    ("email", True, re.compile(rf"{_LOCAL} at [\w-]+(?: dot [\w-]+)+(?!\w)", re.I)),
    ("email", False, re.compile(rf"{_LOCAL}@[\w-]+(?:\.[\w-]+)+(?![\w@])")),
    ("address", True, re.compile(r"(?<!\w)(?:p\. ?o\. ?|po |post office )box \d+(?!\w)", re.I)),
    ("address", True, re.compile(rf"(?<![\w.])\d+[a-z]?(?: (?:bis|ter|quater))?,? (?:rue|chemin|allée|impasse|boulevard|quai|place|avenue) (?:de la |de l['’]|des |du |de |d['’])?{_WORD}", re.I)),
    ("address", True, re.compile(rf"(?<!\w)(?:calle|c/|avenida|avda\.?|plaza|paseo|camino|carrera) ?(?:{_WORD} ){{1,5}}?\d+[a-z]?(?!\w)(?:, ?\d+º ?\w)?", re.I)),
    ("address", True, re.compile(r"(?<!\w)[^\W\d_]{3,}(?:straße|strasse|str\.|gasse|platz|allee|damm|ufer|weg|straat)(?: |(?<=\.))\d+ ?[a-z]?(?!\w)", re.I)),
    ("address", True, re.compile(rf"(?<![\w.#/-])\d+[A-Za-z]? (?:[A-Z][\w'’-]+ ){{1,3}}(?=[A-Z])(?i:{_STREET})(?!\w)")),
    ("address", False, re.compile(rf"(?<![\w.#/-])\d+[a-z]? (?:{_WORD} ){{1,3}}?{_STREET}(?!\w)", re.I)),
    ("address", False, re.compile(rf"(?<!\w)(?:am|an der|auf dem|auf der|hinterm|hinter dem|im|unterm|unter den|zum|zur|beim|vor dem|via) (?:{_WORD} ){{1,2}}\d{{1,4}}[a-z]?(?![\w:]|\.\d)", re.I)),
    ("phone", True, re.compile(r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,6}(?![\w])")),
    ("phone", True, re.compile(r"(?<![\w(])\(\d{2,5}\)[ -]?\d{3,4}[ -]\d{4}(?![\w-])")),
    ("phone", True, re.compile(r"(?<![\w.+-])(?:1[-.])?\d{3}([-.])\d{3}\1\d{4}(?![\w-]|\.\d)")),
    ("phone", True, re.compile(r"(?<![\w.+-])0(?:\d{4} \d{6}|\d{2,3} \d{3,4} \d{4}|\d([ .])\d{2}(?:\1\d{2}){3})(?![\w-]|[.]\d)")),
    ("phone", False, re.compile(r"(?<![\w.+-])(?:\d{10,11}|\d{3,5} \d{3,4} \d{3,4}|\d{3} \d{7})(?![\w-]|[.]\d)")),
    ("id_number", True, re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("id_number", True, re.compile(r"(?<![\w-])[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D](?![\w-])", re.I)),
    ("id_number", True, re.compile(r"(?<![\w.+-])\d{3} \d{2} \d{4}(?![\w-]|[.]\d)")),
    ("id_number", False, re.compile(r"(?<![\w.+-])\d{9}(?![\w-]|[.]\d)")),
]
#: The one shape whose capitals are what makes it strong.
_CAPITALS = next(p for _, strong, p in _SHAPES if strong and "[A-Z][" in p.pattern and "street" in p.pattern)
_TOKEN = re.compile(r"\w+(?:['’-]\w+)*|[^\w\s]")
_TAIL = re.compile(_UNIT, re.I)
#: The share of a word's uses that lie in candidates of names, from which it counts as used for nothing else.
PURE = 0.5
#: How much each pattern says, by its name: words to the left and right, and the shape itself where it is unmistakable.
WEIGHTS = {"l1": 1.0, "l2": 3.0, "r1": 1.0, "r2": 3.0, "lr": 2.0, "sh": 8.0}

_CANDIDATE = "row_id bigint, kind string, start_pos bigint, end_pos bigint, instance string, strong boolean, given string, family string, patterns array<string>"


def _set_off(text: str, a: int, b: int) -> bool:
    """Whether a neighbouring word is in lower case: capitals amid capitals say nothing."""
    before, after = re.search(r"([^\W\d_])[\w'’-]*[\W_]*$", text[max(0, a - 60) : a]), re.match(r"[\W\d_]*([^\W\d_])", text[b : b + 60])
    return any(m and m.group(1).islower() for m in (before, after))


#: Digits that the shapes of a kind have at least.
_DIGITS = {"email": 0, "address": 1, "phone": 6, "id_number": 6}
#: What a message with a candidate has at least one of, so the others need not be looked at: in the notation of the JVM.
SIGNS = r"[\p{Nd}@\[({\p{Lu}\p{Lt}]|(?i: at )"


def _spans(text: str) -> list[tuple[str, str, bool, int, int]]:
    """Candidates with a shape of their own, none inside another: kind, shape, whether it is strong, and place.

    Strong and earlier shapes come first.
    """
    digits = sum(map(str.isdigit, text))
    spelt = "@" in text or "at" in text.lower()
    if not digits and not spelt:
        return []
    taken: list[tuple[str, str, bool, int, int]] = []
    for number, (kind, strong, shape) in enumerate(_SHAPES):
        if digits < _DIGITS[kind] or (kind == "email" and not spelt):
            continue
        for m in shape.finditer(text):
            a, b = m.span()
            if kind == "address":
                b = _TAIL.match(text, b).end()
            if all(b <= x or a >= y for *_, x, y in taken):
                sure = strong and (shape is not _CAPITALS or _set_off(text, a, b))
                taken.append((kind, f"sh {number}", sure, a, b))
    return sorted(taken, key=lambda s: s[3])


def _instance(kind: str, surface: str) -> str:
    """What makes two occurrences the same node of the graph."""
    s = surface.lower()
    if kind in ("phone", "id_number"):
        return re.sub(r"[^\w+]", "", s)
    if kind == "address":
        # A street is one instance whatever the number, the unit and the word for street.
        words = [w for w in re.findall(_WORD, re.split(r",\s*(?:apt|flat|unit|suite)", s)[0]) if not re.fullmatch(_STREET, w)]
        return " ".join(words) or s
    return s


class _Reader:
    """Tokens of a message, with terms of the lexicon and other candidates as one class each."""

    def __init__(self, terms: Iterable[str]):
        self.terms = {tuple(t.lower().split()) for t in terms}
        self.longest = max((len(t) for t in self.terms), default=0)
        self.first = {t[0] for t in self.terms if t}

    def tokens(self, text: str, spans) -> list[tuple[str, int, int]]:
        raw, out, i, s = [(m.group(), *m.span()) for m in _TOKEN.finditer(text)], [], 0, 0
        while i < len(raw):
            word, a, b = raw[i]
            while s < len(spans) and spans[s][4] <= a:
                s += 1
            if s < len(spans) and spans[s][3] < b and a < spans[s][4]:
                out.append((f"<{spans[s][0]}>", spans[s][3], spans[s][4]))
                while i < len(raw) and raw[i][1] < spans[s][4]:
                    i += 1
                continue
            for n in range(min(self.longest, len(raw) - i) if word.lower() in self.first else 0, 0, -1):
                if tuple(w.lower() for w, _, _ in raw[i : i + n]) in self.terms:
                    out.append(("<t>", a, raw[i + n - 1][2]))
                    i += n
                    break
            else:
                out.append((word, a, b))
                i += 1
        return out


def _class(token: str) -> str:
    return token if token[0] == "<" and len(token) > 1 else "<n>" if any(c.isdigit() for c in token) else token.lower()


def _patterns(tokens: list[str], first: int, last: int) -> list[str]:
    """The lexical patterns around tokens first..last; one of borders alone says nothing and is left out."""
    at = lambda i: "<s>" if i < 0 else "</s>" if i >= len(tokens) else _class(tokens[i])
    l1, l2, r1, r2 = at(first - 1), at(first - 2), at(last + 1), at(last + 2)
    out = []
    if l1 != "<s>":
        out += [f"l1 {l1}", f"l2 {l2} {l1}"]
    if r1 != "</s>":
        out += [f"r1 {r1}", f"r2 {r1} {r2}"]
    if l1 != "<s>" or r1 != "</s>":
        out.append(f"lr {l1} _ {r1}")
    return out


_is_word = re.compile(r"(?:[^\W\d_]|['’-]){2,}").fullmatch


def _names(tokens: list[tuple[str, int, int]], capital: bool = False):
    """Pairs that are written like a name: ``(first, last, given, family, has_initial)`` by token number.

    Given and family name with or without an initial between, an initial and a
    family name, or family name, comma and given name. With ``capital`` only
    those whose words both begin with a capital, or an initial.
    """
    words = [t for t, _, _ in tokens]
    n, i = len(words), 0
    joined = lambda x, y: y < n and tokens[y][1] - tokens[x][2] <= 1
    initial = lambda x: x + 1 < n and len(words[x]) == 1 and words[x].isalpha() and words[x + 1] == "." and tokens[x + 1][1] == tokens[x][2]
    while i < n:
        w = words[i]
        if initial(i) and joined(i + 1, i + 2) and _is_word(words[i + 2]):
            # Also after a word that may be a given name; the longer reading wins where it is known.
            yield i, i + 2, None, words[i + 2], True
        elif (not capital or w[0].isupper()) and _is_word(w):
            if joined(i, i + 1) and initial(i + 1) and joined(i + 2, i + 3) and _is_word(words[i + 3]):
                yield i, i + 3, w, words[i + 3], True
            elif joined(i, i + 1) and _is_word(words[i + 1]):
                yield i, i + 1, w, words[i + 1], False
            if i + 2 < n and words[i + 1] == "," and tokens[i + 1][1] == tokens[i][2] and joined(i + 1, i + 2) and _is_word(words[i + 2]):
                last = i + 2
                if joined(last, last + 1) and initial(last + 1):
                    last += 2
                yield i, last, words[i + 2], w, False
        i += 1


def _capital(w: str | None) -> bool:
    return w is None or w[:1].isupper()


def candidate_rows(row_id: int, text: str, reader: _Reader) -> Iterator[tuple]:
    """All candidates of one message with their patterns; names only where capitals set them off."""
    spans = _spans(text)
    shouting = text.upper() == text
    if not spans and (shouting or not re.search(r"[^\W\d_a-zà-ÿ]", text)):
        return
    tokens = reader.tokens(text, spans)
    words = [t for t, _, _ in tokens]
    place = {(a, b): i for i, (_, a, b) in enumerate(tokens)}
    for kind, shape, strong, a, b in spans:
        i = place[(a, b)]
        yield row_id, kind, a, b, _instance(kind, text[a:b]), strong, None, None, _patterns(words, i, i) + [shape] * strong
    if shouting:
        return
    whole: set[int] = set()
    for first, last, given, family, has_initial in _names(tokens, capital=True):
        if has_initial and given and _capital(given):
            whole.add(last)
        elif has_initial and last in whole:
            continue
        if _capital(given) and _capital(family) and family != family.lower():
            key = f"{given.lower() if given else '.'} {family.lower()}"
            yield row_id, "name", tokens[first][1], tokens[last][2], key, has_initial, given and given.lower(), family.lower(), _patterns(words, first, last) + ["sh initial"] * has_initial


def _candidates(messages: DataFrame, terms: list[str]) -> DataFrame:
    names = [c.split()[0] for c in _CANDIDATE.split(", ")]

    def find(batches):
        reader = _Reader(terms)
        for frame in batches:
            rows = [r for i, t in zip(frame.row_id, frame.text) if t for r in candidate_rows(i, t, reader)]
            yield pd.DataFrame(rows, columns=names).astype({"row_id": "int64", "start_pos": "int64", "end_pos": "int64", "strong": "bool"})

    return messages.where(F.col("text").rlike(SIGNS)).mapInPandas(find, _CANDIDATE)


def score_graph(candidates: DataFrame, scratch: Scratch, *, rounds: int = 3, accept: float = 0.5) -> DataFrame:
    """``kind, instance, in_context`` of accepted instances, by iterating over the pattern-instance graph.

    Patterns are words around an instance and, where it is unmistakable, its
    shape. Instances of such a shape are the seeds of the first round; from then
    on every instance, seeds too, is judged by its patterns: accepted if they
    are good enough on weighted average. A pattern is as good as the share of
    its other occurrences whose instance is accepted, compared with the share
    that accepted occurrences themselves see around them: what is not accepted
    is unlabelled rather than wrong, and this estimates how much of the true
    ones is accepted so far. For a pattern seen with this instance alone its
    shape stands in: 1 if it is unmistakable, else 0. ``in_context`` says whether
    the words around it alone would do.

    Edges are counted before each join, and the joins on patterns and on
    instances are salted, so neither with a third of all occurrences is a third
    of a task.
    """
    weight = F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv])
    edges = (
        candidates.select("kind", "instance", "strong", F.explode("patterns").alias("pattern"))
        .groupBy("kind", "instance", "pattern")
        .agg(F.count("*").alias("n"), F.max("strong").alias("strong"))
        .withColumn("w", F.try_element_at(weight, F.substring("pattern", 1, 2)) * F.col("n"))
    )
    edges = scratch.write(edges, "edges")
    alone = candidates.where("strong").select("kind", "instance", F.lit(False).alias("in_context")).distinct()
    accepted = scratch.write(alone, "seeds")
    shape = F.col("pattern").startswith("sh")
    for r in range(rounds):
        known = salted_join(edges, accepted.select("kind", "instance", F.lit(1).alias("ok")), ["kind", "instance"], spread=["pattern"], how="left")
        known = known.withColumn("own", F.when(F.col("ok") == 1, F.col("n")).otherwise(0))
        counted = known.groupBy("kind", "pattern").agg(F.sum("own").alias("good"), F.sum("n").alias("all"))
        counted = scratch.write(counted.withColumn("share", F.col("good") / (F.col("all") + 2)), f"patterns{r}")
        # One row per kind, of which there are five.
        usual = counted.where(~shape).groupBy("kind").agg((F.sum(F.col("good") * F.col("share")) / F.sum("good")).alias("usual"))
        patterns = counted.where("good > 0").join(F.broadcast(usual), "kind", "left").select("kind", "pattern", "good", "all", F.when(shape, 1.0).otherwise(F.col("usual")).alias("usual"))
        others = F.col("all") - F.col("n")
        p = F.least((F.col("good") - F.col("own")) / (others + 2) / F.col("usual"), F.lit(1.0))
        prior = F.col("strong").cast("double")
        judged = salted_join(known, patterns, ["kind", "pattern"], spread=["instance"], how="left").withColumn(
            "p", F.when(F.col("all").isNull(), F.when(shape, prior).otherwise(0.0)).when(others == 0, prior).when(shape, F.col("good") / F.col("all")).otherwise(F.coalesce(p, F.lit(0.0)))
        )
        words = F.when(~shape, F.col("w")).otherwise(0.0)
        scored = judged.groupBy("kind", "instance").agg(
            (F.sum(F.col("p") * F.col("w")) / F.sum("w")).alias("score"), F.coalesce(F.try_divide(F.sum(F.col("p") * words), F.sum(words)), F.lit(0.0)).alias("context")
        )
        fitting = scored.where(F.col("score") >= accept).select("kind", "instance", (F.col("context") >= accept).alias("in_context"))
        # An instance without any pattern has nothing that could be held against its shape.
        bare = candidates.where("strong AND size(patterns) = 0").select("kind", "instance", F.lit(False).alias("in_context"))
        accepted = scratch.write(fitting.unionByName(bare).groupBy("kind", "instance").agg(F.max("in_context").alias("in_context")), f"accepted{r}")
    return accepted


def _uses(messages: DataFrame, words: DataFrame) -> DataFrame:
    """``word, uses``: how often each of the words occurs in all texts, in any case and place."""
    token = F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+(?:['’-]\w+)*"), F.lit(0))
    counted = messages.select(F.explode(token).alias("word")).groupBy("word").agg(F.count("*").alias("uses"))
    return counted.join(words.distinct(), "word", "left_semi")


def _name_parts(messages: DataFrame, candidates: DataFrame, accepted: DataFrame, scratch: Scratch, rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """Family and given names seen in accepted names: what lets unseen spellings and contexts be found.

    A family name is a word whose uses in candidates are accepted often enough,
    or that was accepted with an initial and is hardly used in any other way
    (``PURE``). Given names are found by family names, and each round finds
    further family names by two given names before them.
    """
    names = candidates.where("kind = 'name'").groupBy("instance", "given", "family").agg(F.count("*").alias("n"), F.count_if(~F.col("strong")).alias("plain"))
    known = accepted.where("kind = 'name'").select("instance", F.lit(1).alias("ok"), "in_context")
    names = scratch.write(names.join(known, "instance", "left"), "names")
    words = names.select(F.explode(F.array("family", "given")).alias("word")).where("word IS NOT NULL")
    uses = scratch.write(_uses(messages, words), "uses")
    of = lambda c: uses.withColumnRenamed("word", c)
    good = F.sum(F.when(F.col("ok") == 1, F.col("n")).otherwise(0)).alias("good")
    fitting = F.count_if(F.col("in_context")).alias("fitting")
    initials = F.sum(F.when(F.col("ok") == 1, F.col("n") - F.col("plain")).otherwise(0)).alias("initials")
    families = scratch.write(names.groupBy("family").agg(good, fitting, initials, F.sum("n").alias("n")).join(of("family"), "family", "left"), "families")
    family = families.where(f"(good >= 2 AND good >= 0.4 * n) OR (fitting >= 1 AND good >= 0.6 * n) OR (initials >= 1 AND n >= {PURE} * uses)").select("family")
    family = scratch.write(family, "family0")
    pure = families.where(f"n >= {PURE} * uses").select("family")
    for r in range(rounds):
        # A given name is one seen with two known families, written out as a pair; its other uses do
        # not matter ("Will", "Mark"), nor does a word that only stands before initials ("Dear"). One
        # family is enough for a word that is hardly used otherwise.
        given = names.where("given IS NOT NULL").join(family.withColumn("known", F.lit(1)), "family", "left").groupBy("given").agg(
            good, F.sum("n").alias("n"), F.count_if((F.col("ok") == 1) & (F.col("plain") > 0) & (F.col("known") == 1)).alias("pairs"),
            F.count_if(F.col("in_context") & (F.col("known") == 1)).alias("fitting"), F.count_if(F.col("known") == 1).alias("with_known"),
        ).join(of("given"), "given", "left")
        given = given.where(f"pairs >= 2 OR (fitting >= 1 AND good >= 0.6 * n) OR (with_known >= 1 AND n >= {PURE} * uses) OR (with_known >= 2 AND n >= 0.3 * uses)")
        given = scratch.write(given.select("given"), f"given{r}")
        if r < rounds - 1:
            led = names.join(given, "given", "left_semi").groupBy("family").agg(F.count_distinct("given").alias("k")).where("k >= 2").join(pure, "family", "left_semi")
            family = scratch.write(family.unionByName(led.select("family")).distinct(), f"family{r + 1}")
    return family, given


def _named(messages: DataFrame, family: DataFrame, given: DataFrame, terms: list[str]) -> DataFrame:
    """Occurrences of known names in any case and order."""
    bits = sorted(r[0] for r in family.select((F.crc32(F.col("family").cast("binary")) % FILTER_BITS).cast("int")).distinct().collect())
    filled = bytearray(FILTER_BITS // 8)
    for b in bits:
        filled[b >> 3] |= 1 << (b & 7)
    filled = bytes(filled)
    ddl = "row_id bigint, start_pos bigint, end_pos bigint, given string, family string"

    def maybe(word: str) -> bool:
        h = zlib.crc32(word.encode()) % FILTER_BITS
        return bool(filled[h >> 3] >> (h & 7) & 1)

    def find(batches):
        reader = _Reader(())
        # Words that were looked up and are no family name; forgotten when they are many.
        other: set[str] = set()
        for frame in batches:
            rows = []
            if len(other) > MOST_REMEMBERED:
                other.clear()
            for i, t in zip(frame.row_id, frame.text):
                if not t:
                    continue
                fresh = set(_TOKEN.findall(t.lower())) - other
                hit = {w for w in fresh if maybe(w)}
                other |= fresh - hit
                if not hit:
                    continue
                seen: dict[str, bool] = {}
                tokens = reader.tokens(t, _spans(t))
                for first, last, g, f, _ in _names(tokens):
                    f = f.lower()
                    if seen.setdefault(f, maybe(f)):
                        rows.append((i, tokens[first][1], tokens[last][2], g and g.lower(), f))
            yield pd.DataFrame(rows, columns=["row_id", "start_pos", "end_pos", "given", "family"]).astype({"row_id": "int64", "start_pos": "int64", "end_pos": "int64"})

    pairs = messages.mapInPandas(find, ddl)
    known = salted_join(pairs, family, ["family"], spread=["row_id", "start_pos"], how="left_semi")
    whole = salted_join(known.where("given IS NOT NULL"), given, ["given"], spread=["row_id", "start_pos"], how="left_semi")
    columns = ["row_id", "start_pos", "end_pos"]
    return whole.select(columns).unionByName(known.where("given IS NULL").select(columns)).select("row_id", F.lit("name").alias("kind"), "start_pos", "end_pos")


def _resolve(spans: DataFrame) -> DataFrame:
    """Of overlapping occurrences in a message, the longest stays, then the kind named first."""
    ddl = "row_id bigint, kind string, start_pos bigint, end_pos bigint"

    def choose(batches):
        for frame in batches:
            rows = []
            for i, found in zip(frame.row_id, frame.found):
                kept: list = []
                for s in sorted(found, key=lambda s: (s["start_pos"] - s["end_pos"], KINDS.index(s["kind"]), s["start_pos"])):
                    if all(s["end_pos"] <= k["start_pos"] or s["start_pos"] >= k["end_pos"] for k in kept):
                        kept.append(s)
                rows += [(i, s["kind"], s["start_pos"], s["end_pos"]) for s in kept]
            yield pd.DataFrame(rows, columns=["row_id", "kind", "start_pos", "end_pos"]).astype({"row_id": "int64", "start_pos": "int64", "end_pos": "int64"})

    return spans.groupBy("row_id").agg(F.collect_set(F.struct("kind", "start_pos", "end_pos")).alias("found")).mapInPandas(choose, ddl)


def find_personal(messages: DataFrame, terms: list[str]) -> DataFrame:
    """``row_id, kind, start_pos, end_pos``: every occurrence, positions in code points.

    ``messages`` has ``row_id`` and ``text``; NULL and empty texts hold
    nothing, a NULL row_id is left out, and repeated rows are found in again.
    ``terms`` are words of the trade that contexts treat alike; they are part
    of the program's configuration and small.

    1. Candidates: everything shaped like an identifier, with the patterns of
       words around it. 2. Seeds are candidates of unmistakable shape (a phone
    number with its country code, a name with an initial). The graph of
    patterns and instances is scored in rounds, so patterns induced by seeds
    admit instances of weak shape, which strengthen further patterns; in the
    end seeds are judged by the graph like all others.
    3. Names: parts of accepted names are looked up in all messages, in any
       case, order and context. 4. Overlaps within a message are resolved.
    """
    scratch = Scratch(messages.sparkSession, "personal")
    messages = messages.select(F.col("row_id").cast("bigint").alias("row_id"), F.col("text").cast("string").alias("text")).where("row_id IS NOT NULL AND text IS NOT NULL")
    candidates = scratch.write(_candidates(messages, terms), "candidates")
    accepted = score_graph(candidates, scratch)
    family, given = _name_parts(messages, candidates, accepted, scratch)
    columns = ["row_id", "kind", "start_pos", "end_pos"]
    found = salted_join(candidates.where("kind <> 'name'"), accepted, ["kind", "instance"], spread=["row_id", "start_pos"], how="left_semi").select(columns)
    return _resolve(found.unionByName(_named(messages, family, given, terms)))


def redact(messages: DataFrame, found: DataFrame) -> DataFrame:
    """``row_id, text`` with every occurrence replaced by ``[KIND]``; the rest stays as it is."""
    spans = found.groupBy("row_id").agg(F.sort_array(F.collect_set(F.struct("start_pos", "end_pos", "kind"))).alias("spans"))
    joined = messages.select(F.col("row_id").cast("bigint").alias("row_id"), "text").join(spans, "row_id", "left")

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans):
            if text is not None and found is not None:
                for s in reversed(list(found)):
                    text = f"{text[: s['start_pos']]}[{s['kind'].upper()}]{text[s['end_pos'] :]}"
            out.append(text)
        return pd.Series(out, dtype=object)

    return joined.select("row_id", replaced("text", "spans").alias("text"))
