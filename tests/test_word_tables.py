import pytest

from murmurate.operators.validate import ValidationError
from murmurate.plans import pipeline
from murmurate.plans.pipeline import bronze_to_silver

BRONZE = "folder string, `dialogueID` string, date string, `from` string, `to` string, text string"


def bronze(spark):
    rows = [("1", "a.tsv", "2010-01-01T10:00:00Z", "ann", "bob", "zorped grawlix becuase it blorps")]
    return spark.createDataFrame(rows, BRONZE)


def test_word_tables_reach_silver(spark):
    tables = {"slang": [("zorped", "Slang", "stopped")], "corrections": {"becuase": "because"}, "valence": {"grawlix": -3.0}, "dictionary": spark.createDataFrame([("Blorps",)], "word string")}
    plain = bronze_to_silver(bronze(spark), [("apt", "TOOL")], linguistic=False).first()
    r = bronze_to_silver(bronze(spark), [("apt", "TOOL")], linguistic=False, **tables).first()
    assert not plain.slang_matches and plain.vader_compound == 0 and "blorps" in plain.residual_words
    assert [m.token for m in r.slang_matches] == ["zorped"] and "because" in r.text_cleaned
    assert r.vader_compound < -0.4 and r.vader_label == "NEGATIVE" and "blorps" not in r.residual_words


def test_word_tables_from_the_command_line(spark, tmp_path):
    contents = {"slang": "Token,Type,Meaning\nzorped,Slang,stopped\n", "corrections": "word,correction\nBecuase,because\n", "valence": "word,valence\nGrawlix,-3\n", "dictionary": "word\nit\n"}
    contents |= {"labels-jargon": "word\nx\n", "labels-languages": "word,label\ny,SPANISH\n", "labels-nonwords": "word\nblorps\n", "labels-english": "word\nz\n"}
    arguments = []
    for name, text in contents.items():
        (tmp_path / f"{name}.csv").write_text(text)
        arguments += [f"--{name}", str(tmp_path / f"{name}.csv")]
    base = ["silver", "--lexicon", "x", "--residual-policy", "reviewed"]
    out = pipeline.word_tables(spark, pipeline._parser().parse_args([*base, *arguments]))
    assert out["slang"] == [("zorped", "Slang", "stopped")] and out["corrections"] == {"becuase": "because"} and out["valence"] == {"grawlix": -3.0}
    r = bronze_to_silver(bronze(spark), [("apt", "TOOL")], linguistic=False, residual_policy="reviewed", **out).first()
    assert "NONWORD" in r.text_cleaned and r.vader_compound < -0.4
    with pytest.raises(ValueError, match="--labels-jargon"):
        pipeline.word_tables(spark, pipeline._parser().parse_args(base))


def test_silver_with_too_many_nonwords_is_refused(spark):
    rows = [("1", f"{i}.tsv", f"2010-01-01T10:{i % 60:02d}:{i // 60:02d}Z", f"u{i}", "bob", "res") for i in range(120)]
    df = spark.createDataFrame(rows, BRONZE)
    word = lambda *w: spark.createDataFrame([(x,) for x in w], "word string")
    tables = {"jargon": word("x"), "languages": spark.createDataFrame([("hola", "SPANISH")], "word string, label string"), "nonwords": word("res"), "english": word("the")}
    options = {"residual_policy": "reviewed", "label_tables": tables, "linguistic": False}
    with pytest.raises(ValidationError, match="NONWORD token rate"):
        bronze_to_silver(df, [("apt", "TOOL")], **options)
    assert bronze_to_silver(df, [("apt", "TOOL")], validate=False, **options).count() == 120
    for how in ("table", "persist", "none"):
        assert bronze_to_silver(df, [("apt", "TOOL")], max_nonword_rate=1.0, materialization=how, **options).count() == 120
