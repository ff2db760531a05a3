"""Linguistic features of messages: token, sentence and word-class counts, entities."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurate.functions.normalize import without_labels
from murmurate.operators.sentiment import BackendUnavailable
from murmurate.schema import col

# Negating words, and frequent English words that carry little meaning.
NEGATIONS = (
    "not no never none nobody nothing neither nowhere cannot cant can't won't wont isn't isnt wasn't wasnt aren't arent weren't werent doesn't "
    "doesnt didn't didnt don't dont hasn't hasnt haven't havent hadn't hadnt shouldn't shouldnt wouldn't wouldnt couldn't couldnt n't"
).split()
STOPWORDS = (
    "a about above after again against all also am an and any are as at be because been before being below between both but by can could did do does "
    "doing down during each few for from further had has have having he her here hers herself him himself his how i if in into is it its itself just "
    "me more most my myself no nor not now of off on once only or other our ours ourselves out over own same she should so some such than that the "
    "their theirs them themselves then there these they this those through to too under until up very was we were what when where which while who "
    "whom why will with would you your yours yourself yourselves"
).split()
# Words with inner marks, else single signs; an approximation of a full tokenizer that needs no model.
TOKEN = r"(?U)\w+(?:['’.-]\w+)*|[^\w\s]"
_POS = {"NOUN": "noun", "PROPN": "proper_noun", "VERB": "verb", "ADJ": "adjective", "ADV": "adverb"}


def linguistic_features(text: Column) -> dict[str, Column]:
    """Counts and ratios in the JVM; a text without token has counts and ratios of 0."""
    text = F.coalesce(text, F.lit(""))
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    n = F.size(tokens)
    alpha = F.filter(tokens, lambda t: t.rlike(r"^\p{L}+$"))
    sentences = F.filter(F.split(text, r"(?<=[.!?])\s+|\n+"), lambda s: F.length(F.trim(s)) > 0)
    listed = lambda words: F.size(F.filter(tokens, lambda t: F.lower(t).isin(*words)))
    distinct = F.size(F.array_distinct(F.transform(alpha, F.lower)))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return {
        "nlp_token_count": n, "nlp_alpha_token_count": F.size(alpha), "nlp_unique_alpha_token_count": distinct,
        "nlp_lexical_diversity": ratio(distinct, F.size(alpha)), "nlp_sentence_count": F.size(sentences),
        "nlp_avg_sentence_tokens": ratio(n, F.size(sentences)), "nlp_stopword_count": listed(STOPWORDS), "nlp_negation_count": listed(NEGATIONS),
        "nlp_punctuation_count": F.size(F.filter(tokens, lambda t: t.rlike(r"^\p{P}$"))),
        "nlp_exclamation_count": F.size(F.filter(tokens, lambda t: t == "!")), "nlp_question_count": F.size(F.filter(tokens, lambda t: t == "?")),
        "nlp_uppercase_token_count": F.size(F.filter(tokens, lambda t: (F.length(t) > 1) & (t == F.upper(t)) & (t != F.lower(t)))),
    }


class Tagger:
    """Word classes and entities from a model each worker loads once.

    ``load()`` returns ``tag(texts) -> list of {"tokens": [(text, pos, tag)],
    "entities": [(text, label, start, end)]}``.
    """

    def __init__(self, load: Callable[[], Callable[[list[str]], list[dict]]]):
        self.load = load

    def column(self, text: Column) -> Column:
        load = self.load

        @F.pandas_udf("struct<tokens:array<struct<token:string,pos:string,tag:string>>,entities:array<struct<text:string,label:string,start:int,end:int>>>")
        def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            tag = load()
            for texts in parts:
                rows = tag([t or "" for t in texts])
                yield pd.DataFrame(
                    {
                        "tokens": [[{"token": a, "pos": b or "UNKNOWN", "tag": c} for a, b, c in r["tokens"]] for r in rows],
                        "entities": [[{"text": a, "label": b, "start": c, "end": d} for a, b, c, d in r["entities"]] for r in rows],
                    }
                )

        return run(text)


def _equals(value: str):
    return lambda x: x == value


def no_tagger():
    raise BackendUnavailable("word classes and entities need a tagger, and none is installed here")


def tagged_features(df: DataFrame, tagger: Tagger, text: str = "text_cleaned", details: bool = False) -> DataFrame:
    """Word-class counts and ratios, entities and their counts; token details on request."""
    df = df.withColumn("__t", tagger.column(without_labels(F.coalesce(col(text), F.lit("")))))
    tokens, entities = F.col("__t.tokens"), F.col("__t.entities")
    n = F.size(tokens)
    counts = {}
    for pos, name in _POS.items():
        c = F.size(F.filter(F.transform(tokens, lambda t: t["pos"]), _equals(pos)))
        counts |= {f"{name}_count": c, f"{name}_ratio": F.coalesce(F.try_divide(c, n), F.lit(0.0))}
    kinds = lambda items, f: F.map_from_entries(
        F.transform(F.array_sort(F.array_distinct(F.transform(items, lambda x: x[f]))), lambda k: F.struct(k.alias("key"), F.size(F.filter(items, lambda x: x[f] == k)).cast("bigint").alias("value")))
    )
    labelled = lambda *labels: F.size(F.filter(entities, lambda e: e["label"].isin(*labels)))
    counts |= {
        "nlp_pos_counts": kinds(tokens, "pos"), "named_entities": entities, "named_entity_label_counts": kinds(entities, "label"),
        "named_entity_count": F.size(entities), "person_entity_count": labelled("PERSON"), "location_entity_count": labelled("GPE", "LOC", "FAC"),
        "organization_entity_count": labelled("ORG"), "product_entity_count": labelled("PRODUCT"),
    }
    if details:
        counts |= {"nlp_tokens": F.transform(tokens, lambda t: t["token"]), "nlp_pos_tags": tokens}
    return df.withColumns(counts).drop("__t")


def json_view(df: DataFrame) -> DataFrame:
    """Maps and entity arrays as compact JSON strings, as older readers expect them."""
    names = [c for c in ("nlp_pos_counts", "named_entities", "named_entity_label_counts", "nlp_tokens", "nlp_pos_tags") if c in df.columns]
    return df.withColumns({c: F.to_json(col(c)) for c in names if dict(df.dtypes)[c] != "string"})
