"""Small fixtures for what SQL does not cover, and for odd input."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions import values as V
from ledgerloom.operators import candidates as C
from ledgerloom.operators import integrity, layout, lines, quality, resolve
from ledgerloom.sources import sinks
from ledgerloom.sources import tables as S
from ledgerloom.streaming import streams

ELEMENT = "document_id string, engine_id string, ordinal int, text string, page_number int, bounding_box struct<x:double,y:double,w:double,h:double>, confidence double, block_num int, line_num int"


def one(spark, schema, rows, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_numbers(spark):
    got = one(spark, "v string", [("R$ 1.234,56",), ("1234,5",), ("1.234",), ("abc",), ("1_0",), (None,), ("-2,00",)], V.decimal(F.col("v")))
    assert [None if x is None else float(x) for x in got] == [1234.56, 1234.5, 1.234, None, None, None, -2.0]


def test_dates(spark):
    got = one(spark, "v string", [("5/9/2021",), ("005/09/2021",), ("2021-09-05",), ("09/2021",), ("31/02/2021",), (None,)], V.date(F.col("v")))
    day = datetime.date(2021, 9, 5)
    assert got == [day, None, day, datetime.date(2021, 9, 1), None, None]


def test_documents(spark):
    got = one(spark, "v string", [("529.982.247-25",), ("11.222.333/0001-81",), ("111.111.111-11",), ("529.982.247-26",), ("1",), (None,)], V.valid_document(F.col("v")))
    assert got == [True, True, False, False, False, False] or got[:5] == [True, True, False, False, False]


def test_uuid5(spark):
    assert one(spark, "v string", [("file:///a b.pdf",)], V.uuid5(F.col("v"))) == [str(uuid.uuid5(uuid.NAMESPACE_URL, "file:///a b.pdf"))]


def test_norm(spark):
    assert one(spark, "v string", [("Ação  Nº 1@x",), (None,), ("",)], T.norm(F.col("v"))) == ["acao no 1 @ x", "", ""]


def test_lines(spark):
    rows = [
        ("d", "e", 1, "mundo", 1, (50.0, 10.0, 5.0, 5.0), 0.9, 1, 1),
        ("d", "e", 0, "Olá", 1, (10.0, 10.0, 5.0, 5.0), 0.9, 1, 1),
        ("d", "e", 2, "  ", 1, (10.0, 30.0, 5.0, 5.0), 0.9, 1, 2),
        ("d", "e", 3, "fim", None, None, None, None, None),
    ]
    got = lines.build_lines(spark.createDataFrame(rows, ELEMENT)).orderBy("line_index").select("text", "line_index").collect()
    assert [tuple(r) for r in got] == [("fim", 0), ("Olá mundo", 1)]
    assert lines.build_lines(spark.createDataFrame([], ELEMENT)).count() == 0


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_section_fold_is_a_plain_loop(spark, block):
    texts = ["Prefeitura Municipal", "CNPJ 1", "Prestador de serviços", "CNPJ 2", "Tomador de serviços", "UF SP", "Discriminação dos serviços", "serviço x", "Valor líquido 3", "boleto vencimento", "nosso numero", "outra linha", "aliquota 2%"]
    rows = [("d", "e", i, t, 1, (0.0, 20.0 * i, 1.0, 1.0), 0.9, None, None) for i, t in enumerate(texts)]
    li = lines.build_lines(spark.createDataFrame(rows, ELEMENT))
    got = [r.section for r in lines.classify_sections(li, block).orderBy("line_index").collect()]
    feats = lines.line_features(lines.score_sections(li)).orderBy("line_index").select(*lines.FEATURES).collect()
    state, want = lines.START, []
    for f in feats:
        s = lines.step(state, *f)
        want.append(s[0])
        state = (s[0], state[1] or s[0] == "recipient", state[2] or s[0] == "service")
    assert got == want
    assert want[2] == "provider" and want[3] == "provider" and want[4] == "recipient" and want[9] == "ignored_billing"


def test_overlaps_brute_force(spark):
    import random

    rnd = random.Random(1)
    boxes = [(1, i, (rnd.uniform(0, 600), rnd.uniform(0, 600), rnd.uniform(1, 200), rnd.uniform(1, 200))) for i in range(60)] + [(2, 99, None)]
    df = spark.createDataFrame(boxes, "page int, id int, bounding_box struct<x:double,y:double,w:double,h:double>")
    got = {r.page: (r.boxes, r.overlapping) for r in layout.overlaps(df, ["page"], "id").collect()}

    def iou(a, b):
        w = max(min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]), 0)
        h = max(min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1]), 0)
        return w * h / (a[2] * a[3] + b[2] * b[3] - w * h)

    n = sum(any(iou(b[2], c[2]) > 0.1 for c in boxes[:60] if c[1] != b[1]) for b in boxes[:60])
    assert got == {1: (60, n)}


def test_json_elements(spark):
    rows = [(1, '{"value": "a", "score": 87}'), (2, '{"raw_text": "b", "page_num": 2, "label": "tab"}'), (3, "broken"), (4, None)]
    got = [tuple(r) for r in S.json_elements(spark.createDataFrame(rows, "id int, payload string")).drop("bounding_box").orderBy("id").collect()]
    assert got == [(1, "a", 0.87, None, "text"), (2, "b", None, 2, "tab"), (3, None, None, None, "text"), (4, None, None, None, "text")]


def test_files_and_sinks(spark, tmp_path):
    (tmp_path / "a.PDF").write_bytes(b"x")
    paths = [str(tmp_path / "a.PDF"), str(tmp_path / "a.PDF")]
    got = S.load_files(spark, paths).orderBy("sample_index").collect()
    assert [(r.media_type, r.file_size_bytes, r.sample_index) for r in got] == [("application/pdf", 1, 0), ("application/pdf", 1, 1)]
    df = spark.createDataFrame([("e", 1, None)], "engine_id string, b int, a string")
    sinks.write_bundle({"t": df}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/t")).count() == 1
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"a":null,"b":1,"engine_id":"e"}'


def test_email_repair(spark):
    rows = [("E-mail: contatoQtal.example",), ("E-mail: a@b.c",), ("E-mail: nfe (arroba) xyz.test",), (None,)]
    assert one(spark, "v string", rows, C.repaired_email(F.col("v"))) == ["contato@tal.example", None, "nfe@xyz.test", None]


def test_resolve_conflict(spark):
    cols = "document_id string, engine_id string, cand_id long, candidate_ordinal int, confidence double, value string, field_name string, label_text string, section_name string, context_text string, same_block_as_label boolean, block_num int, label_block_num int"
    rows = [
        ("d", "e", 1, 0, 1.0, "10/01/2024", "issue_date", "emissao", None, None, True, None, None),
        ("d", "e", 2, 1, 0.95, "11/01/2024", "issue_date", "emissao", None, None, True, None, None),
        ("x", "e", 3, 0, 1.0, "10/01/2024", "issue_date", "emissao", None, None, True, None, None),
        ("y", "e", 4, 0, None, None, "issue_date", None, None, None, None, None, None),
    ]
    out = resolve.resolved(resolve.scored(spark.createDataFrame(rows, cols))).filter("field_name = 'issue_date'")
    got = {r.document_id: (r.status, r.value) for r in out.collect()}
    assert got["d"] == ("conflict", None) and got["x"] == ("resolved", "10/01/2024") and got["y"][0] == "conflict"


def test_corrections(spark):
    f = spark.createDataFrame([("d", "a", "1", "conflict", 0.5), ("d", "b", "2", "resolved", 0.9)], "document_id string, field_name string, value string, status string, confidence double")
    c = spark.createDataFrame([("d", "a", " ", "2024-01-02"), ("d", "a", "9", "2024-01-01"), ("d", "c", "7", None), ("d", "a", "8", "03/01/2024")], "document_id string, field_name string, corrected_value string, reviewed_at string")
    got = {r.field_name: (r.value, r.status, r.confidence, r.previous_value) for r in quality.corrected(f, quality.last_corrections(c)).collect()}
    assert got == {"a": ("8", "resolved", None, "1"), "b": ("2", "resolved", 0.9, None), "c": ("7", "resolved", None, None)}


def test_integrity(spark):
    bad = integrity.problems(spark, ["a"], {"a": ["x"], "b": ["x"]}, {}, ["a"], {"w": -1.0}, {"t": 2.0})
    kinds = sorted(r.kind for r in bad.collect())
    assert kinds == ["alias_collision", "bad_threshold", "bad_weight", "unknown_alias_field"]
    with pytest.raises(ValueError):
        integrity.require_sound(bad)


def test_sessions(spark, tmp_path):
    t = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame([("d", t(0)), ("d", t(5)), ("d", t(50))], "document_id string, loaded_at timestamp")
    got = sorted(r.n for r in streams.sessions(df).collect())
    assert got == [1, 2]


def test_no_python_in_native_paths(spark):
    rows = [("d", "e", 1, "x", 1, None, None, None, None)]
    plan = lines.score_sections(lines.build_lines(spark.createDataFrame(rows, ELEMENT)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
