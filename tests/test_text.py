import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from murmurate.operators import lexicons, linguistic, residual, sentiment, topics, validate

TERMS = [("video card", "hardware"), ("card", "other"), ("apt", "packages"), (".bashrc", "files"), ("c++", "tools"), ("grep", "commands"), ("APT", "later")]


def naive(text, terms):
    """Leftmost, longest first, with edges that touch no word character."""
    alt = "|".join(rf"(?<!\w){re.escape(t)}(?!\w)" for t in sorted({t.lower() for t, _ in terms}, key=len, reverse=True))
    return [m.group() for m in re.finditer(alt, text, re.I)]


def test_terms_longest_first_with_their_first_category(spark):
    df = spark.createDataFrame([("My Video Card needs .bashrc, c++ and APT; telegraph",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(lexicons.term_matches(F.col("t"), TERMS)).collect()]
    assert [(m.term, m.category) for m in got[0]] == [("Video Card", "hardware"), (".bashrc", "files"), ("c++", "tools"), ("APT", "packages")]
    assert got[1:] == [[], []]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["video", "card", "apt", ".bashrc", "c++", "grep", " ", "x", "_", ".", "+"]), max_size=12))
def test_finder_equals_a_naive_scan(parts):
    text = "".join(parts)
    assert [m["term"] for m in lexicons.TermFinder(TERMS).find(text)] == naive(text, TERMS)


def test_glued_terms(spark):
    f = lexicons.TermFinder([("grep", "commands"), ("kernel", "os"), ("ls", "commands"), ("emailaddress", "x")])
    got = {(m["term"], m["glue"], m["run"]) for m in f.find_glued("egrep grep2 mygrepper grep kernel_x EMAILADDRESS1 EMAILADDRESS als")}
    assert got == {("grep", "suffix", "egrep"), ("grep", "prefix", "grep2"), ("grep", "infix", "mygrepper"), ("kernel", "prefix", "kernel_x"), ("emailaddress", "prefix", "EMAILADDRESS1")}
    df = spark.createDataFrame([("grep1 grep22 grepx",)], "t string").select(lexicons.glued_matches(F.col("t"), [("grep", "c")]).alias("glued_matches"))
    r = lexicons.glued_review(df).first()
    assert (r.glue, r.occurrences, r.examples, r.safe) == ("prefix", 3, ["grep1", "grep22", "grepx"], False)


def test_slang(spark):
    f = lexicons.SlangFinder(lexicons.DEFAULT_SLANG)
    assert [m["token"] for m in f.find("LOL that is thx:) lolly")] == ["LOL", "thx", ":)"]
    assert f.find("pwned") == [] and lexicons.SlangFinder(lexicons.DEFAULT_SLANG, review=True).find("pwned")[0]["token"] == "pwned"
    df = spark.createDataFrame([("pwned lol",)], "t string")
    assert [m.token for m in df.select(lexicons.slang_matches(F.col("t"), include_review=True)).first()[0]] == ["lol", "pwned"]


EMPTY = {"tech_lexicon_matches": "array<struct<term:string,category:string>>"}


def test_residual_candidates(spark):
    df = spark.createDataFrame(
        [(1, "EMAILADDRESS SPANISH NONWORD unrecognizedfixturetoken", []), (2, "video card unrecognizedfixturetoken", [("video card", "hardware")]), (3, "version 2 or 64 bit", []), (4, None, None)],
        "id int, text_cleaned string, tech_lexicon_matches array<struct<term:string,category:string>>",
    )
    got = {r.id: r.residual_words for r in residual.with_residuals(df, key="id").collect()}
    assert got == {1: ["unrecognizedfixturetoken"], 2: ["unrecognizedfixturetoken"], 3: ["version", "or", "bit"], 4: []}
    english = spark.createDataFrame([("version",), ("OR",), ("bit",)], "word string")
    out = {r.id: (r.residual_words, r.has_residual) for r in residual.with_residuals(df, key="id", dictionary=english).collect()}
    assert out[3] == ([], False) and out[1] == (["unrecognizedfixturetoken"], True)


def test_vocabulary_folds_case(spark):
    df = spark.createDataFrame([(["First", "shared"],), (["second", "SHARED", "shared"],), ([],), (None,)], "residual_words array<string>")
    assert {r.word: r["count"] for r in residual.vocabulary(df).collect()} == {"first": 1, "second": 1, "shared": 3}


def tables(spark):
    return {
        "jargon": spark.createDataFrame([("kernel",)], "word string"), "languages": spark.createDataFrame([("hola", "spanish")], "word string, label string"),
        "nonwords": spark.createDataFrame([("res",), ("maybe",)], "word string"), "english": spark.createDataFrame([("maybe",)], "word string"),
    }


def test_reviewed_labels_and_their_application(spark):
    words = spark.createDataFrame([("kernel", 1), ("hola", 1), ("12", 1), ("maybe", 1), ("res", 2), ("other", 1)], "word string, count long")
    labels = residual.reviewed_labels(words, **tables(spark))
    assert {r.word: r.label for r in labels.collect()} == {"kernel": "JARGON", "hola": "SPANISH", "12": "UNCERTAIN", "maybe": None, "res": "NONWORD", "other": None}
    df = spark.createDataFrame([(1, "Hola, res (unrecognizedfixturetoken) kernel 12!"), (2, ""), (3, None)], "id int, text_cleaned string")
    assert {r.id: r.text_cleaned for r in residual.apply_labels(df, labels, key="id").collect()} == {1: "SPANISH, NONWORD (unrecognizedfixturetoken) kernel 12!", 2: "", 3: None}
    b = residual.batch_labels(words, tables(spark)["languages"], tables(spark)["jargon"])
    assert {r.word: r.label for r in b.collect()} == {"kernel": None, "hola": "SPANISH", "12": None, "maybe": "NONWORD", "res": "NONWORD", "other": "NONWORD"}


def test_policies(spark):
    df = spark.createDataFrame([(["hola"],)], "residual_words array<string>")
    assert residual.residual_labels(df, "manual_review") is None
    with pytest.raises(ValueError):
        residual.residual_labels(df, "guess")
    with pytest.raises(ValueError):
        residual.residual_labels(df, "api")
    with pytest.raises(MemoryError):
        residual.residual_labels(spark.createDataFrame([(["a", "b"],)], "residual_words array<string>"), "api", classifier=object(), ceiling=1)
    assert residual.review_export(df).first().asDict() == {"word": "hola", "count": 1, "classification_label": "", "classification_source": "manual_review"}


def test_classifier_protocol():
    sent, naps = [], []

    def answer(replies):
        it = iter(replies)

        def send(request):
            sent.append(request)
            return next(it)

        return residual.RetryingClassifier(send, "m", sleep=naps.append)

    ok = {"labels": [{"word": "hola", "label": "SPANISH"}]}
    c = answer([(503, {}), (200, ok)])
    assert c.classify(["Hola", "123"]) == {"hola": "SPANISH"} and naps == [1.0]
    assert all("123" not in r["words"] for r in sent) and sent[0]["temperature"] == 0 and sent[0]["store"] is False
    assert len(c.provenance()["request_sha256"]) == 1
    with pytest.raises(residual.ClassifierError):
        answer([(401, {})]).classify(["a"])
    for bad in ({"labels": []}, {"labels": ok["labels"] * 2}, {"labels": [{"word": "hola", "label": "KLINGON"}]}):
        with pytest.raises(residual.ClassifierError):
            answer([(200, bad)]).classify(["hola"])


def test_vader_rules():
    v = lambda t: sentiment.vader(t)[3]
    assert v("great fix") > 0.05 and v("terrible failure") < -0.05 and v("the house") == 0
    assert v("not good") < 0 < v("good") < v("very good") < v("VERY good") and v("good!!!") > v("good")
    assert v("good but terrible") < 0 and v("") == 0
    assert v("barely good") < v("good")
    assert all(abs(sum(sentiment.vader(t)[:3]) - 1) < 0.002 for t in ("great fix", "bad bad day", "so so"))


def test_sentiment_columns(spark):
    df = spark.createDataFrame([("great fix",), ("NONWORD",), (None,), ("terrible failure",)], "text_cleaned string").withColumn("transformer_label", F.lit("old"))
    out = sentiment.analyze_sentiment(df)
    assert [r.vader_label for r in out.collect()] == ["POSITIVE", None, None, "NEGATIVE"] and "transformer_label" not in out.columns
    validate.validate_sentiment(out)
    with pytest.raises(ValueError):
        sentiment.analyze_sentiment(df, "tarot")
    with pytest.raises(Exception, match="not installed"):
        sentiment.analyze_sentiment(df, "transformer").collect()


def test_model_backend(spark):
    def load():
        return lambda texts: [{"label_0": 0.1, "LABEL_1": 0.7, "positive": 0.2} for _ in texts]

    df = spark.createDataFrame([("a",), ("SSN",)], "text_cleaned string")
    r = sentiment.score_transformer(df, sentiment.transformer_backend(load)).collect()
    assert (r[0].transformer_label, r[0].transformer_score) == ("NEUTRAL", 0.7) and abs(r[0].transformer_expected_sentiment - 0.1) < 1e-12 and r[1].transformer_label is None
    sizes = []
    b = sentiment.Backend(load, ("NEGATIVE", "NEUTRAL", "POSITIVE"), {"label_0": "NEGATIVE", "label_1": "NEUTRAL"}, chunk=3)
    b.rows(lambda t: sizes.append(len(t)) or load()(t), list("abcdefghij"))
    assert sizes == [3, 3, 3, 1]
    with pytest.raises(ValueError):
        b.rows(lambda t: [{"label_0": 1.0}] * len(t), ["x"])


def test_emotions(spark):
    p = dict(zip(["anger", "disgust", "fear", "joy", "neutral", "sadness", "surprise"], [0.05, 0.05, 0.10, 0.50, 0.10, 0.10, 0.10]))
    df = spark.createDataFrame([("a",)], "text_cleaned string")
    r = sentiment.score_emotion(df, sentiment.emotion_backend(lambda: lambda texts: [p for _ in texts])).first()
    assert r.emotion_label == "JOY" and abs(r.emotion_score - 0.5) < 1e-12 and abs(r.emotion_margin - 0.4) < 1e-12


def test_low_diversity_and_frozen_features(spark):
    one = spark.range(100).select(F.lit(0.1).alias("vader_negative"), F.lit(0.8).alias("vader_neutral"), F.lit(0.1).alias("vader_positive"), F.lit(0.0).alias("vader_compound"), F.lit("NEUTRAL").alias("vader_label"))
    with pytest.raises(validate.ValidationError, match="low diversity"):
        validate.validate_sentiment(one)
    frozen = spark.range(20).select(F.col("id").cast("string").alias("text_cleaned"), F.lit(3).alias("nlp_token_count"))
    with pytest.raises(validate.ValidationError, match="frozen"):
        validate.validate_nlp(frozen)


def test_linguistic_features(spark):
    c = linguistic.linguistic_features(F.col("t"))
    r = spark.createDataFrame([("I can't BELIEVE it! Why not?",), ("",), (None,)], "t string").select(*[v.alias(k) for k, v in c.items()]).collect()
    assert (r[0].nlp_sentence_count, r[0].nlp_negation_count, r[0].nlp_exclamation_count, r[0].nlp_question_count, r[0].nlp_uppercase_token_count) == (2, 2, 1, 1, 1)
    assert r[1].nlp_token_count == 0 and r[1].nlp_lexical_diversity == 0.0 and r[2].nlp_token_count == 0


def test_tagger(spark):
    def load():
        return lambda texts: [{"tokens": [("Ann", "PROPN", "NNP"), ("runs", "VERB", "VBZ")], "entities": [("Ann", "PERSON", 0, 3)]} for _ in texts]

    df = linguistic.tagged_features(spark.createDataFrame([("Ann runs",)], "text_cleaned string"), linguistic.Tagger(load), details=True)
    r = linguistic.json_view(df).first()
    assert (r.proper_noun_count, r.verb_ratio, r.person_entity_count, r.nlp_pos_counts) == (1, 0.5, 1, '{"PROPN":1,"VERB":1}')
    with pytest.raises(Exception, match="tagger"):
        linguistic.tagged_features(spark.createDataFrame([("x",)], "text_cleaned string"), linguistic.Tagger(linguistic.no_tagger)).collect()


def test_topics(spark):
    texts = ["wireless driver network card", "wireless network driver", "apt package update", "package update repository apt", "music player sound", "sound player music volume"]
    m = topics.fit_topics(texts, topics=3)
    assert m.labels == topics.fit_topics(texts, topics=3).labels
    df = spark.createDataFrame([(t,) for t in [*texts, "zzzxxyy", None]], "text_cleaned string")
    r = topics.assign_topics(df, m).collect()
    assert all(0 <= x.topic_score <= 1 and -1e-9 <= x.topic_entropy <= 1 + 1e-9 for x in r[:6]) and len({x.topic_id for x in r[:6]}) == 3
    assert r[0].topic_id == r[1].topic_id and r[6].topic_id is None and r[7].topic_label is None
    with pytest.raises(ValueError):
        topics.fit_topics(["", None])


def test_core_validation(spark):
    rows = [("res " * 3, 1)] * 50
    df = spark.createDataFrame([("NONWORD NONWORD", 0)] * 50, "text_cleaned string, ssn_count long")
    with pytest.raises(validate.ValidationError, match="NONWORD token rate"):
        validate.validate_core(df)
    with pytest.raises(validate.ValidationError, match="ssn_count_differs"):
        validate.validate_core(spark.createDataFrame(rows, "text_cleaned string, ssn_count long"))
    assert validate.validate_core(spark.createDataFrame([("x SSN", 1)], "text_cleaned string, ssn_count long"))["passed"]
