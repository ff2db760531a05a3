from murmurate.llm import mixing


def test_a_mixture_of_all_tokens_reports_short_sources(spark):
    docs = spark.createDataFrame([(i, "big", "one two three four") for i in range(50)] + [(99, "tiny", "one two three four")], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("tiny", 0.5, 2)], "source string, target_share double, max_repeats int")
    exact = mixing.shares(*mixing.mixture(docs, targets, total_tokens=mixing.EXACT))
    whole = mixing.shares(*mixing.mixture(docs, targets))
    n = {r.source: r.available for r in whole.collect()}
    e, w = mixing.totals(exact).first(), mixing.totals(whole).first()
    assert e.used_tokens == 4 * n["tiny"] and e.available_tokens == w.available_tokens == n["big"] + n["tiny"] and e.sources_short == 0
    assert w.used_tokens == (n["big"] + n["tiny"]) // 2 + 2 * n["tiny"] and w.sources_short == 1
    assert {r.source: r.actual_share < 0.5 for r in whole.collect()} == {"big": False, "tiny": True}
