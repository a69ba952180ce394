"""Plug-ins, sinks, readers, streams, timings: what has no SQL."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dictionary as D
from ledgerloom.operators import layout, report
from ledgerloom.plans import observe
from ledgerloom.sources import plugins, sinks
from ledgerloom.sources import tables as S
from ledgerloom.streaming import streams


def test_pages_and_engines(spark):
    docs = spark.createDataFrame([("a", "application/pdf", bytearray(b"p1|p2")), ("b", "image/png", bytearray(b"x")), ("c", "text/plain", bytearray(b"x")), ("d", "application/pdf", bytearray(b"")), ("e", "application/pdf", None)], "document_id string, media_type string, content binary")
    conv = {"application/pdf": lambda b: [x for x in b.split(b"|") if x]}
    got = {(r.document_id, r.page_number): r for r in plugins.pages(docs, conv, [("up", bytes.upper), ("end", lambda b: b + b"!")]).collect()}
    assert bytes(got["a", 2].image) == b"P2!" and got["a", 1].normalization_steps == ["up", "end"] and bytes(got["b", 1].image) == b"X!"
    assert "no converter" in got["c", 0].error and "no pages" in got["d", 0].error and "no content" in got["e", 0].error

    def factory():
        def engine(images):
            if any(b"P2" in i for i in images):
                raise RuntimeError("broken")
            return [json.dumps({"text": i.decode()}) for i in images]

        return engine

    pages = plugins.pages(docs, conv, [("up", bytes.upper)])
    out = {(r.document_id, r.page_number): (r.payload, r.error) for r in plugins.predicted(pages, factory, batch=1).collect()}
    assert out["a", 1] == ('{"text": "P1"}', None) and out["a", 2] == (None, "RuntimeError: broken") and len(out) == 3
    assert plugins.by_name("json:dumps") is json.dumps and plugins.by_name("os.path.join") is os.path.join
    with pytest.raises(ValueError):
        plugins.by_name("x")


def test_files(spark, tmp_path):
    good, text = tmp_path / "nota é 1.PNG", tmp_path / "x.txt"
    good.write_bytes(b"x")
    text.write_bytes(b"x")
    paths = [str(good), str(tmp_path / "gone.pdf"), str(text), str(tmp_path)]
    with pytest.raises(ValueError, match="missing"):
        S.load_files(spark, paths)
    got = S.load_files(spark, paths, missing="skip").collect()
    assert len(got) == 1 and got[0].source_uri == good.as_uri() and got[0].media_type == "image/png"
    import uuid

    assert got[0].document_id == str(uuid.uuid5(uuid.NAMESPACE_URL, good.as_uri()))
    faults = [r.error for r in S.load_files(spark, paths, missing="row").orderBy("sample_index").collect()]
    assert faults == [None, "missing", "unknown suffix", "not a file"]
    with pytest.raises(ValueError):
        S.load_files(spark, paths[1:], missing="skip")
    assert S.path_list(" a, b,,") == ["a", "b"] and S.found_files(str(tmp_path / "*.txt"), 1) == [str(text)]
    with pytest.raises(ValueError):
        S.path_list(" , ")


def test_uris(spark):
    rows = [("file:///a%20b.pdf",), ("file://host/share/a.pdf",), ("file:/a+b.pdf",), ("/plain/a b",), ("s3://x/y",)]
    got = [r[0] for r in spark.createDataFrame(rows, "u string").select(S.uri_path(F.col("u"))).collect()]
    assert got == ["/a b.pdf", "//host/share/a.pdf", "/a+b.pdf", "/plain/a b", None]


def test_payloads(spark):
    rows = [(1, '"só texto"'), (2, '["a", {"text": "b"}, 5]'), (3, '{"elements": {"items": [{"value": "c"}]}}'), (4, '{"predictions": [{"tokens": 1, "text": "d"}]}'), (5, '{"raw_text": "e"}'), (6, None)]
    items = S.payload_items(spark.createDataFrame(rows, "id int, payload string"))
    got = sorted((r.id, r.item_no, r.text) for r in S.json_elements(items, "item").collect())
    assert (1, 0, "só texto") in got and (2, 0, "a") in got and (2, 1, "b") in got and (4, 0, "d") in got and (5, 0, "e") in got and len([g for g in got if g[0] == 2]) == 2 and not [g for g in got if g[0] == 6]
    with pytest.raises(Exception, match="unknown form"):
        S.payload_items(spark.createDataFrame([(1, "5")], "id int, payload string")).collect()


def test_read_through_and_records(spark, tmp_path):
    docs, cached = spark.createDataFrame([("a",), ("b",)], "document_id string"), spark.createDataFrame([("a", 1), ("z", 9)], "document_id string, n int")
    got = S.read_through(docs, cached, lambda d: d.withColumn("n", F.lit(5))).collect()
    assert sorted(map(tuple, got)) == [("a", 1), ("b", 5)]
    (tmp_path / "r.json").write_text('[{"a": 1}, {"a": 2}]')
    assert S.read_records(spark, str(tmp_path / "r.json"), "a int").count() == 2
    (tmp_path / "bad.json").write_text('[{"a": "x"}]')
    with pytest.raises(Exception):
        S.read_records(spark, str(tmp_path / "bad.json"), "a int").collect()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("d", "e", 1)], "document_id string, engine_id string, n int")
    sinks.write_bundle({"document": df.drop("engine_id"), "candidates": df}, str(tmp_path / "b"))
    assert {r.name for r in spark.read.json(str(tmp_path / "b/manifest")).collect()} == {"document", "candidates"}
    parts = sinks.bundle(df.drop("engine_id"), df, df.unionByName(df), df, df.limit(0), df)
    sinks.write_bundle(parts, str(tmp_path / "all"))
    assert list(parts) == sinks.BUNDLE and spark.read.json(str(tmp_path / "all/manifest")).count() == 7
    r = spark.read.parquet(str(tmp_path / "all/summary")).first()
    assert (r.candidates, r.raw_elements, r.validation_issues) == (2, 1, 0)
    sinks.write_log(df, str(tmp_path / "log"), "done")
    assert spark.read.text(str(tmp_path / "log")).first()[0] == '{"document_id":"d","engine_id":"e","event":"done","n":1}'
    sinks.write_json(df, str(tmp_path / "j"), ["engine_id"])
    assert os.path.isdir(tmp_path / "j/engine_id=e")
    sheet = spark.createDataFrame([("d", True, "{}")], "document_id string, review_required boolean, corrections_template string")
    sinks.write_review(sheet, str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r/corrections")).first()[0] == "{}"
    sinks.write_experiment(str(tmp_path / "x"), df, df, df, report.manifest(spark, "run", ["b", "a"], 2, ["t"]))
    assert spark.read.json(str(tmp_path / "x/experiment_manifest")).first().engines == ["a", "b"]
    s = spark.createDataFrame([("d", "error"), ("ok", "processed")], "document_id string, document_status string")
    assert sinks.result_of(s, "d")[1] == 1 and sinks.result_of(s, "ok")[1] == 0 and sinks.result_of(s, "none")[1] == 1


def test_rows_and_tables(spark):
    rows = [(1, "Número da Nota 00032794  Emissão: 05/09/2021", (10.0, 5.0, 100.0, 20.0)), (2, "Série E", (0.0, 0.0, 1.0, 1.0)), (3, "a: b", None), (4, None, None)]
    df = spark.createDataFrame(rows, "id int, t string, bounding_box struct<x:double,y:double,w:double,h:double>")
    got = [(r.id, r.cell, r.x) for r in layout.row_elements(df, "id", "t", "bounding_box").orderBy("id", "cell_no").collect()]
    assert [g[:2] for g in got] == [(1, "Número da Nota"), (1, "00032794"), (1, "Emissão"), (1, "05/09/2021"), (2, "Série E"), (3, "a"), (3, "b")]
    assert got[0][2] == 10.0 and abs(got[1][2] - (10 + 100 * 14 / 39)) < 1e-9 and got[5][2] is None
    html = [(1, 3, "<table><tr><td>a</td><td> b </td></tr><tr></tr><tr><th>c</th></tr></table>", (0.0, 30.0, 9.0, 30.0)), (2, 4, "texto", None)]
    t = spark.createDataFrame(html, "id int, ordinal int, t string, bounding_box struct<x:double,y:double,w:double,h:double>")
    assert [(r.id, r.reading_order, r.text, r.y) for r in layout.table_elements(t, "id", "t").orderBy("id", "reading_order").collect()] == [(1, 3000, "a  b", 30.0), (1, 3002, "c", 50.0), (2, 4, "texto", None)]


def test_streams(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1, 10, 0)
    rows = [(t + datetime.timedelta(minutes=10 * i), "a", 1.0, "d", 1 + i % 2) for i in range(12)]
    df = spark.createDataFrame(rows, "ts timestamp, event_type string, value double, document_id string, page_number int")
    for i in range(2):
        df.filter(F.pmod(F.minute("ts"), F.lit(20)) == i * 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    read = lambda: streams.read_files(spark, str(tmp_path / "in"), df.schema, per_trigger=1)
    streams.run_once(streams.throughput(read(), late="1 minute", slide="30 minutes"), str(tmp_path / "out"), str(tmp_path / "s1"))
    assert spark.read.parquet(str(tmp_path / "out")).count() >= 0
    batch = streams.throughput(df, slide="30 minutes")
    assert batch.filter("start = timestamp'2024-01-01 10:30:00'").first().n == 6
    seen = []
    streams.run_batches(streams.running_counts(read()), lambda d, i: seen.extend(map(tuple, d.collect())), str(tmp_path / "s2"), "update")
    assert max(seen, key=lambda r: r[3]) == ("d", 12, 2, 2)


def test_report(spark):
    m = spark.createDataFrame([("e", "a", 1, 0, 0, 0.5, 0.0, None), ("e", "b", 0, 0, 0, 0.0, 0.0, None), ("e", "c", 0, 0, 2, 0.0, 0.0, 0.25)], "engine_id string, field_name string, n_filled int, n_conflict int, n_evaluated int, fill_rate double, conflict_rate double, correctness_rate double")
    lines_ = [r.line for r in report.report_lines(m).orderBy("line").collect()]
    assert len(lines_) == 2 and lines_[0].endswith("n/a") and lines_[1].endswith("25.0%")
    t = spark.createDataFrame([("d", "e", {"preprocessing": 1.0, "extract": 2.5})], "document_id string, engine_id string, stages map<string,double>")
    assert t.select(report.total_time(F.col("stages"))).first()[0] == 3.5
    st = observe.Stages()
    with pytest.raises(KeyError), st.measure("a"):
        raise KeyError
    assert st.times["a"] >= 0 and st.total == st.times["a"]
    env = observe.environment(spark, {"tmp": "/tmp", "none": "/no/such"})
    assert env["path_tmp"].endswith("(there)") and "missing" in observe.format_environment(env)


def test_configuration(tmp_path):
    raw = json.load(open(D.HERE))
    (tmp_path / "c.json").write_text(json.dumps(raw | {"critical": ["net_amount"]}))
    assert D.load(str(tmp_path / "c.json")).critical == ["net_amount"] and len(D.DEFAULT.fields) == 37
    (tmp_path / "bad.json").write_text(json.dumps(raw | {"no_such": 1}))
    with pytest.raises(TypeError):
        D.load(str(tmp_path / "bad.json"))
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(raw, allow_unicode=True))
    assert D.load(str(tmp_path / "c.yaml")).fields == D.DEFAULT.fields


def test_only_wanted_columns_are_read(spark, tmp_path):
    """Column pruning reaches the scan, and no text is shuffled where only a flag is wanted."""
    from ledgerloom.plans import catalog

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    plan = catalog.queries()["element_blank_filter"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema: ") :].split("\n")[0]
    assert set(schema.split("struct<")[1].rstrip(">").replace(":", " ").split(",")) <= {"artifact_id bigint", "engine_id string", "text string", "loaded_at timestamp_ntz", "loaded_at timestamp"}
    shuffled = plan[plan.index("Exchange") :] if "Exchange" in plan else ""
    assert "max_by" in plan and shuffled


def test_latest(spark):
    t = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "a", None, t), (1, "b", 5, t + datetime.timedelta(1)), (2, "c", 7, None), (2, "c", 7, None)], "k int, a string, b int, loaded_at timestamp")
    assert sorted(map(tuple, S.latest(df, "k", columns=["a"]).collect())) == [(1, "b"), (2, "c")]
    assert S.latest(df.limit(0), "k").count() == 0
