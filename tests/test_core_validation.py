import pytest

from murmurate.plans import queries

DAY = [("10:00", "ann", "bob", "hi"), ("10:02", "bob", "ann", "bye")]


def test_core_validation_counts_a_copy_without_sender(spark, tmp_path):
    rows = [(1, "10:00", "ann", "bob", "hi"), (2, "10:01", "bob", "ann", "same"), (3, "10:01", None, "ann", "same"), (4, "10:02", "ann", "bob", "bye")]
    rows = [(i, 1, "1.tsv", f"2010-01-01T{t}:00Z", s, r, x) for i, t, s, r, x in rows]
    spark.createDataFrame(rows, "row_id long, folder long, dialogue_id string, date string, `from` string, `to` string, text string").write.parquet(f"{tmp_path}/dialoguetext_196.parquet")
    spark.createDataFrame([("apt", "TOOL")], "term string, category string").write.parquet(f"{tmp_path}/tech_lexicon.parquet")
    got = {r.what: r.n for r in queries.core_validation(spark, str(tmp_path)).collect()}
    assert got.pop("rows") == 4 and set(got.values()) == {0.0}


@pytest.mark.parametrize(
    "rows",
    [
        [("10:01", "bob", "ann::x", "d"), ("10:01", "bob", "ann", "x::d"), ("10:01", None, "ann", "x::d")],
        [("10:01", "a::b", "c", "d"), ("10:01", "aa", "c", "d"), ("10:01", "a", "b::c", "d")],
        [("10:01", "a:", "b", "d"), ("10:01", "a", ":b", "d")],
    ],
)
def test_core_validation_counts_messages_whose_names_join_to_the_same(spark, tmp_path, rows):
    rows = [(i, 1, "1.tsv", f"2010-01-01T{t}:00Z", s, r, x) for i, (t, s, r, x) in enumerate(DAY + rows)]
    spark.createDataFrame(rows, "row_id long, folder long, dialogue_id string, date string, `from` string, `to` string, text string").write.parquet(f"{tmp_path}/dialoguetext_196.parquet")
    spark.createDataFrame([("apt", "TOOL")], "term string, category string").write.parquet(f"{tmp_path}/tech_lexicon.parquet")
    got = {r.what: r.n for r in queries.core_validation(spark, str(tmp_path)).collect()}
    assert got.pop("rows") == len(rows) and set(got.values()) == {0.0}
