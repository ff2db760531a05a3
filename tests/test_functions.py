import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from murmurate.functions import normalize, probability, structural
from murmurate.functions.temporal import is_blank, moment, nick, period_start, right_closed


def values(spark, rows, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_moments_in_all_notations(spark):
    same = ["2005-06-15T10:50:00.000Z", "2005-06-15T12:50:00.000+02:00", " 2005-06-15t10:50:00.000z ", "2005/06/15 10:50:00", "2005-06-15 10:50", "15.6.2005 10:50:00", "1118832600", "2005-06-15T05:50:00-0500"]
    got = values(spark, [(x,) for x in same], "d string", moment(F.col("d")).cast("string"))
    assert {g[0] for g in got} == {"2005-06-15 10:50:00"}
    none = ["2011-02-30T08:15:00Z", "0000-00-00T00:00:00.000Z", "2010-06-14T27:90:00.000Z", "yesterday", "n/a", "", "   ", None, "12:30", "2011"]
    assert all(g[0] is None for g in values(spark, [(x,) for x in none], "d string", moment(F.col("d"))))


def test_moment_is_utc_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values(spark, [("2005-06-15 10:50:00",)], "d string", F.unix_micros(moment(F.col("d")))) == [(1118832600_000000,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_nicks_blanks_and_buckets(spark):
    assert values(spark, [(" Bob\t",), ("  ",), (None,)], "n string", nick(F.col("n")), is_blank(F.col("n"))) == [("bob", False), (None, True), (None, True)]
    got = values(spark, [(0.0,), (5.0,), (5.1,), (None,)], "x double", right_closed(F.col("x"), [5], ["low", "high"]))
    assert [g[0] for g in got] == ["low", "low", "high", None]
    with pytest.raises(ValueError):
        right_closed(F.col("x"), [5], ["one"])
    with pytest.raises(ValueError):
        period_start(F.col("x"), "year")


def test_urls_swallow_mail_like_paths_and_addresses_are_replaced(spark):
    rows = [("http://www.mail-archive.com/lug@linux.or.ug/msg14772.html",), ("contact person@example.com",), ("from 192.168.1.5 or fe80::1 press Ctrl+Alt+T",), (None,)]
    t = structural.anonymized(F.col("t"))
    c = structural.placeholder_counts(t)
    got = values(spark, rows, "t string", t, c["domain_count"], c["email_count"], c["ipv4_count"], c["ipv6_count"], c["keyboard_shortcut_count"])
    assert got[0][:3] == ("WEBSITEDOMAIN", 1, 0)
    assert got[1][:3] == ("contact EMAILADDRESS", 0, 1)
    assert got[2] == ("from IPADDRESS or IPV6ADDRESS press KEYBOARDSHORTCUT", 0, 0, 1, 1, 1)
    assert got[3][0] is None


PROBES = [
    "System > Preferences > Main Menu", "ctrl + shift + esc now", "/etc/apt/sources.list and /usr", "www.example.com/x", "call (415) 555-0101", "123-45-6789", "::1 up",
    "01010101 bits", "d41d8cd98f00b204", "a 64bit 3.5ghz cpu, 20mb/s", "the 2nd at 7pm in the 90's", "1920x1080 or 720p in 2014", "café2nd é720",
]


@pytest.mark.parametrize("kind", sorted(structural.PATTERNS))
def test_patterns_agree_with_another_regex_engine(spark, kind):
    p = structural.PATTERNS[kind]
    other = re.compile(p.replace("(?U)", "").replace("(?iU)", ""), re.I if p.startswith("(?iU)") else 0)
    got = values(spark, [(x,) for x in PROBES], "t string", structural.matches(F.col("t"), kind))
    assert [g[0] for g in got] == [[m.group() for m in other.finditer(x)] for x in PROBES]


def test_structures_of_a_text(spark):
    got = values(spark, [("see /etc/fstab in 2014",), ("",)], "t string", structural.all_structures(F.col("t")), structural.structural_matches(F.col("t")))
    assert got[0][0] == {"unix_absolute_path": ["/etc/fstab"], "reference_year": ["2014"]}
    assert [tuple(m) for m in got[0][1]] == [("/etc/fstab", "unix_absolute_path"), ("2014", "reference_year")]
    assert got[1] == ({}, [])


def test_normalization(spark):
    rows = [("dont panic",), (None,), ("x'dont go, dont' stay",), ("hahaha nooo hmmmm thx U",), ("déjà-vu helló",)]
    got = [g[0] for g in values(spark, rows, "t string", normalize.normalized(F.col("t")))]
    assert got == ["don't panic", "", "x'don't go, dont' stay", "haha no hmm thanks you", "deja vu hello"]


def test_labels_scripts_and_contractions(spark):
    got = values(spark, [("SPANISH EMAILADDRESS hola",), ("привет мир hello",)], "t string", normalize.without_labels(F.col("t")), normalize.labelled_scripts(F.col("t")))
    assert got[0][0].split() == ["hola"]
    assert got[1][1] == "CYRILLIC hello"
    assert values(spark, [("doesn't't",)], "t string", normalize.repaired_contractions(F.col("t"))) == [("doesn't",)]
    assert values(spark, [("!!",), ("é",), (None,)], "t string", normalize.is_effectively_empty(F.col("t"))) == [(True,), (False,), (True,)]


def test_rare_characters_and_emoticons(spark):
    df = spark.createDataFrame([("a☃b",), ("é" * 12,), ("plain",)], "t string")
    assert sorted(r.t for r in normalize.rare_characters_replaced(df, "t", 10, "?").collect()) == ["a?b", "plain", "é" * 12]
    df = spark.createDataFrame([(1, ":Д hi"), (2, "привет Д")], "g int, t string")
    assert {r.g: r.t for r in normalize.emoticons_restored(df, "t", "g").collect()} == {1: "::) hi", 2: "привет Д"}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="haeowrnlt'. _-", max_size=40))
def test_fillers_change_whole_words_only(text):
    out = normalize.normalize_one(text, {})
    assert [w for w in re.findall(r"\W+", text)] == [w for w in re.findall(r"\W+", out)]


def test_probabilities(spark):
    p = probability.normalized_probabilities([F.col("a"), F.col("b"), F.col("c")])
    cols = probability.class_columns("s", ["NEGATIVE", "NEUTRAL", "POSITIVE"], p)
    df = spark.createDataFrame([(0.1, 0.7, 0.2), (None, None, None)], "a double, b double, c double")
    got = df.select(cols["s_label"], cols["s_score"], cols["s_margin"], cols["s_entropy"]).collect()
    assert got[0][0] == "NEUTRAL" and abs(got[0][1] - 0.7) < 1e-12 and abs(got[0][2] - 0.5) < 1e-12
    assert abs(got[0][3] - 0.8018185525433373) < 1e-12 and got[1][0] is None
    for bad in [(0.4, 0.4, 0.4), (0.5, None, 0.5), (1.5, -0.5, 0.0)]:
        with pytest.raises(Exception, match="probabilit"):
            spark.createDataFrame([bad], "a double, b double, c double").select(p).collect()
