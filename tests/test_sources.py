import json

import pytest

from murmurate.operators.residual import review_export
from murmurate.plans.pipeline import PipelineConfig, bronze_to_silver
from murmurate.schema import BRONZE, FEATURE_SCHEMA_VERSION
from murmurate.sources import bundle, metrics, readers, writers
from murmurate.streaming.windows import run_available, streamed_sessions, windowed_counts


def test_exactly_one_source_and_target(spark, tmp_path):
    for kw in ({}, {"table": "a", "csv": "b"}):
        with pytest.raises(ValueError):
            readers.read_bronze(spark, **kw)
    with pytest.raises(ValueError):
        writers.write(spark.range(1), table="a", path="b")
    with pytest.raises(ValueError):
        writers.write(spark.range(1), path=str(tmp_path / "x"), mode="merge")
    with pytest.raises(ValueError, match="class path"):
        writers.write(spark.range(1), path=str(tmp_path / "x"), fmt="nosuchformat")


def test_csv_dialect(spark, tmp_path):
    p = tmp_path / "b.csv"
    p.write_text('folder,dialogueID,date,from,to,text\n1,2.tsv,2020-01-01,a,,"he said ""hi""\nand left, then"\n')
    r = readers.read_bronze(spark, csv=str(p)).first()
    assert r.text == 'he said "hi"\nand left, then' and r.to is None
    p.write_text("folder,dialogueID,date,from,text,to\n1,2,3,4,5,6\n")
    with pytest.raises(Exception):
        readers.read_bronze(spark, csv=str(p)).collect()
    df = spark.createDataFrame([("1", "  spaced  ", None)], "folder string, text string, `to` string")
    out = writers.write_csv(df, str(tmp_path), "t")
    assert readers.read_csv(spark, out, df.schema).first().text == "  spaced  "


def test_scratch_names_and_materialization(spark):
    n = writers.scratch_table_name("cat.sch", "core")
    assert n.startswith("cat.sch._murmurate_core_") and writers.quoted(n).count("`") == 6
    for bad in ("a b", "x;drop", "a.b.c.d", ""):
        with pytest.raises(ValueError):
            writers.quoted(bad)
    with pytest.raises(ValueError):
        writers.resolve_materialization("ram")
    for mode in ("persist", "table", "none", "auto"):
        with writers.materialized(spark.range(3), mode) as kept:
            assert kept.count() == 3


def test_audit(spark, tmp_path):
    log = str(tmp_path / "audit.jsonl")
    with pytest.raises(ValueError):
        writers.append_audit(log, {"stage": "silver", "validation": {"passed": False}})
    with pytest.raises(FileNotFoundError):
        writers.append_audit(log, {"validation": {"passed": True}}, output=str(tmp_path / "none"))
    for _ in range(2):
        writers.append_audit(log, {"stage": "silver", "rows": 3, "secret": "x", "validation": {"passed": True}})
    rows = [json.loads(x) for x in open(log)]
    assert len(rows) == 2 and set(rows[0]) == set(writers.AUDIT_FIELDS) and rows[0]["schema_version"] == FEATURE_SCHEMA_VERSION
    writers.append_audit_table(spark, stage="gold", target="t", rows=1, columns=2, passed=True, details={"a": 1}, path=str(tmp_path / "audit"))
    assert spark.read.parquet(str(tmp_path / "audit")).first().details_json == '{"a": 1}'


def test_metrics(spark, tmp_path):
    c = metrics.run_context(spark, "p", output_name="o", token="secret")
    assert "token" not in c
    m = metrics.stage_metric(c, "core", 2.5, rows_in=1000, rows_out=100)
    assert (m["rows_per_second"], m["ms_per_row_in"], m["ms_per_row_out"]) == (400.0, 2.5, 25.0)
    z = metrics.stage_metric(c, "core", 2.5, rows_in=0, rows_out=0)
    assert z["rows_per_second"] == 0.0 and z["ms_per_row_in"] is None and len(metrics.SCHEMA) == 28
    metrics.append_metrics(spark, [], path=str(tmp_path / "m"))
    metrics.append_metrics(spark, [m, z], path=str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2


def tables(spark):
    f = spark.createDataFrame
    return {
        "conversation_summary": f([(1, 2, True, "2020-01-05"), (2, 1, False, "2020-02-01")], "conversation_id int, message_count long, conversation_was_answered boolean, conversation_start string"),
        "monthly_summary": f([("2020-01-01", 2)], "date_period string, message_count long"), "correlation_matrix": f([("a", 1.0)], "feature string, a double"),
        "statistical_summary": f([("a", 0.5)], "feature string, mean double"), "hypothesis_tests": f([("h", "t", 0.1, 0.2)], "hypothesis string, test string, p_value double, p_value_holm double"),
        "model_selection": f([("m", 0.5)], "model string, average_precision double"), "model_test_metrics": f([("m", 0.6)], "model string, roc_auc double"),
        "model_feature_importance": f([("f", 0.1)], "feature string, importance double"),
    }


def test_bundle(spark, tmp_path):
    t = tables(spark)
    bundle.export_bundle(t, str(tmp_path))
    back = bundle.load_bundle(spark, str(tmp_path))
    assert [r.conversation_was_answered for r in back["conversation_summary"].orderBy("conversation_id").collect()] == [True, False]
    with pytest.raises(ValueError, match="exposes"):
        bundle.export_bundle(t | {"conversation_summary": t["conversation_summary"].selectExpr("*", "'x' AS text_cleaned")}, str(tmp_path))
    with pytest.raises(ValueError, match="lacks"):
        bundle.validate_bundle({k: v for k, v in t.items() if k != "monthly_summary"})
    m = json.loads((tmp_path / "manifest.json").read_text())
    m["tables"]["monthly_summary"]["path"] = "../x.csv"
    (tmp_path / "manifest.json").write_text(json.dumps(m))
    with pytest.raises(ValueError, match="outside"):
        bundle.load_bundle(spark, str(tmp_path))
    m["schema_version"] = "1"
    (tmp_path / "manifest.json").write_text(json.dumps(m))
    with pytest.raises(ValueError, match="schema"):
        bundle.load_bundle(spark, str(tmp_path))


def test_bronze_to_silver(spark):
    rows = [("1", "5.tsv", "2020-01-01T00:00:00.000Z", "ann", None, "dont email me at person@example.com"), ("1", "5.tsv", "2020-01-01T00:01:00.000Z", "bob", "", "apt-get works great on the kernel!"), ("1", "5.tsv", "bad", "bob", "ann", "x"), ("1", "5.tsv", "2020-01-01T00:02:00.000Z", None, "bob", "sudo apt fixed it :)")]
    bronze = spark.createDataFrame(rows, BRONZE)
    s = bronze_to_silver(bronze, [("apt", "packages"), ("kernel", "os")], releases=["2019-10-17"])
    got = {r.turn_count: r for r in s.collect()}
    assert len(got) == 3 and got[0].text_cleaned == "don't email me at EMAILADDRESS" and got[0].email_count == 1
    assert got[2]["from"] == "ann" and [m.term for m in got[2].tech_lexicon_matches] == ["apt"] and got[1].vader_label == "POSITIVE"
    assert got[0].days_since_release == 76 and got[0].conversation_was_answered
    with pytest.raises(TypeError):
        PipelineConfig().updated(nonsense=1)
    assert review_export(s).count() > 0


def test_views(spark, data):
    readers.register_views(spark, data, ["silver", "events"])
    assert spark.sql("SELECT count(*) FROM silver").first()[0] > 0


def test_streams(spark, tmp_path):
    rows = [("a", "2020-01-01 00:00:00"), ("a", "2020-01-01 00:10:00"), ("b", "2020-01-02 00:00:00"), ("z", "2021-01-01 00:00:00")]
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, "`from` string, d string").selectExpr("`from`", "cast(d as timestamp) AS date").coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    run_available(windowed_counts(spark.readStream.schema(schema).parquet(src)), str(tmp_path / "w"), str(tmp_path / "wc"))
    assert sorted(r.message_count for r in spark.read.parquet(str(tmp_path / "w")).collect()) == [1, 2]
    run_available(streamed_sessions(spark.readStream.schema(schema).parquet(src)), str(tmp_path / "s"), str(tmp_path / "sc"))
    assert sorted((r.user_name, r.event_count) for r in spark.read.parquet(str(tmp_path / "s")).collect()) == [("a", 2), ("b", 1)]
