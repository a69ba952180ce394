"""Candidates from lines: synthetic documents, one a case. A line is its elements, set apart by bars."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import extract as X
from ledgerloom.operators import generate, lines

CASES = {
    "header": (["Número da Nota|00032794", "Data Emissão|05/09/2021|10:22", "Código de Verificação|AB12-CD34"], {"nfse_number": ("00032794", "same_line"), "issue_date": ("05/09/2021", "same_line"), "verification_code": ("AB12-CD34", "same_line")}),
    "number below": (["Número da Nota", "00032794"], {"nfse_number": ("00032794", "next_line")}),
    "number and date": (["Nota Número|31407|Série E|Emissão|28/09/2022"], {"nfse_number": ("31407", "same_line"), "issue_date": ("28/09/2022", "same_line")}),
    "date near": (["Data Emissão|Série", "Nada", "05/09/2021"], {"issue_date": ("05/09/2021", "nearby_line")}),
    "code over lines": (["Código de Verificação", "AB12-", "CD34EF"], {"verification_code": ("AB12-CD34EF", "nearby_lines")}),
    "code without digit": (["Código de Verificação", "QUARTA-FEIRA"], {}),
    "parties": (
        ["PRESTADOR DE SERVIÇOS", "Razão Social|ACME SERVICOS LTDA", "CNPJ/CPF|12.345.678/0001-90|Inscrição Municipal|12345", "Endereço|Rua A, 5", "E-mail|a@acme.com|Telefone|1133334444|UF|SP", "TOMADOR DE SERVIÇOS", "Nome/Razão Social|BETA COMERCIO SA", "CNPJ/CPF|98.765.432/0001-10"],
        {"provider_name": ("ACME SERVICOS LTDA", "same_line"), "provider_document": ("12.345.678/0001-90", "same_line"), "provider_municipal_registration": ("12345", "same_line"), "provider_address": ("Rua A, 5", "same_line"), "provider_email": ("a@acme.com", "same_line"), "provider_phone": ("1133334444", "same_line"), "provider_uf": ("SP", "same_line"), "recipient_name": ("BETA COMERCIO SA", "same_line"), "recipient_document": ("98.765.432/0001-10", "same_line")},
    ),
    "before the recipient heading": (["TOMADOR DE SERVIÇOS", "E-mail|x@p.com|TOMADOR|E-mail|y@r.com"], {"provider_email": ("x@p.com", "same_line")}),
    "misread mailbox": (["PRESTADOR DE SERVIÇOS", "E-mail|contatoQacme.com.br"], {"provider_email": ("contato@acme.com.br", "ocr_corrected_email")}),
    "merged party block": (["PRESTADOR DE SERVIÇOS", "Nome/Razão Social: ACME SERVICOS LTDA Nome Fantasia: X UF: SP"], {"provider_name": ("ACME SERVICOS LTDA", "same_line"), "provider_uf": ("SP", "same_line")}),
    "identity number by form": (["PRESTADOR DE SERVIÇOS", "Insc 52.998.224/0001-25"], {"provider_document": ("52.998.224/0001-25", "regex")}),
    "phone is no identity number": (["PRESTADOR DE SERVIÇOS", "CNPJ Telefone 11987654321"], {"provider_phone": None, "provider_document": None}),
    "billing is left out": (["Boleto|linha digitável|Nosso número|12345", "Número da Nota|777"], {"nfse_number": ("777", "same_line")}),
    "service": (["Discriminação dos Serviços", "Suporte técnico mensal de sistemas", "Manutenção corretiva da rede interna", "Código do Serviço|17.01", "Natureza da Operação|Tributação no município"], {"service_description": ("Suporte técnico mensal de sistemas Manutenção corretiva da rede interna", "following_service_lines"), "service_code": ("17.01", "same_line"), "operation_nature": ("Tributação no município", "same_line")}),
    "priced item": (["Discriminação dos Serviços", "Royalties de marca registrada Preço: 9.874,24"], {"service_description": ("Royalties de marca registrada Preço", "following_service_lines")}),
    "description within the label's element": (["DISCRIMINAÇÃO DO SERVIÇO CONSULTA"], {"service_description": ("CONSULTA", "same_line")}),
    "heading is no description": (["Discriminação dos Serviços", "Valor total 5,00"], {"service_description": None}),
    "city outside the service part": (["Prefeitura Municipal", "Local da prestação|Campinas"], {"service_city": ("Campinas", "same_line")}),
    "amounts below": (["Valor total|Valor líquido", "1.000,00 900,00"], {"gross_amount": ("1.000,00", "financial_table"), "net_amount": ("900,00", "financial_table")}),
    "amount on the line": (["Valor líquido|R$ 900,00"], {"net_amount": ("R$ 900,00", "same_line")}),
    "credit line": (["Valor total 800,00|Valor líquido|do crédito 0,00"], {"net_amount": ("800,00", "same_line")}),
    "service code in reach": (["Código do Serviço", "1401 - Instalação de equipamentos de rede"], {"service_code": ("1401", "nearby_line")}),
    "year is no code": (["Código do Serviço|2024"], {"service_code": None}),
    "empty": ([" "], {}),
}


def elements(spark, cases):
    rows = []
    for d, texts in cases.items():
        k = 0
        for i, t in enumerate(texts):
            for j, w in enumerate(t.split("|")):
                rows.append((d, "e", k, f"{d}:{k}", w, 1, i, 1, (float(j * 100), float(i * 20), 90.0, 10.0), 0.8))
                k += 1
    return spark.createDataFrame(rows, "document_id string, engine_id string, ordinal int, element_id string, text string, block_num int, line_num int, page_number int, bounding_box struct<x:double,y:double,w:double,h:double>, confidence double")


@pytest.fixture(scope="module")
def found(spark):
    df = elements(spark, {k: v[0] for k, v in CASES.items()})
    return [r.asDict() for r in generate.candidates(df).collect()]


@pytest.mark.parametrize("name", CASES)
def test_candidates(found, name):
    got = {}
    for r in found:
        if r["document_id"] == name:
            got.setdefault(r["field_name"], []).append((r["value"], r["value_source"]))
    for field, want in CASES[name][1].items():
        assert (want in got.get(field, [])) if want else not [x for x in got.get(field, []) if x], (field, got)
    if not CASES[name][1]:
        assert got == {}


def test_evidence(found):
    r = next(r for r in found if r["document_id"] == "parties" and r["field_name"] == "provider_name")
    assert r["source_element_ids"] == ["parties:2"] and abs(r["confidence"] - 0.88) < 1e-9 and r["line_text"] == "Razão Social ACME SERVICOS LTDA"
    assert r["section_name"] == "provider" and not r["section_override_applied"] and r["same_block_as_label"] and r["line_index"] == 1
    assert r["candidate_id"].startswith("parties:normalizer:provider_name:1:1:")
    t = next(r for r in found if r["document_id"] == "amounts below" and r["field_name"] == "gross_amount")
    assert abs(t["confidence"] - 0.9) < 1e-9 and t["label_text"] == "valor total"


def test_long_documents_are_cut_without_loss(spark, monkeypatch):
    texts = ["Número da Nota", "777", "Data Emissão", "x", "05/09/2021"] * 8
    df = elements(spark, {"long": texts})
    whole = {(r.line_index, r.field_name, r.value) for r in generate.candidates_from_lines(lines.classify_sections(lines.build_lines(df))).collect()}
    monkeypatch.setattr(lines, "PART", 3)
    parts = {(r.line_index, r.field_name, r.value) for r in generate.candidates_from_lines(lines.classify_sections(lines.build_lines(df), block=3)).collect()}
    assert parts == whole and len(whole) >= 16


def test_without_elements(spark):
    assert generate.candidates(elements(spark, {"a": [" "]}).filter(F.lit(False))).count() == 0


def test_fold_has_a_shuffle_of_its_own(spark):
    li = lines.classify_sections(lines.build_lines(elements(spark, {"a": ["Número da Nota|1"]})))
    plan = li._jdf.queryExecution().executedPlan().toString()
    fold = plan[plan.index("MapInArrow run") :]
    assert fold.index("Exchange hashpartitioning") < fold.index("Join"), "adaptive execution may spread the rows of a join anew"


def _plan(df) -> str:
    return df._jdf.queryExecution().analyzed().toString()


def test_values_are_worked_out_once(spark):
    """A value that a rule uses again and again stands once in the plan; next lines carry texts, not values that few labels ask for."""
    code = F.col("id").cast("string")
    assert _plan(spark.range(1).select(X.valid_code(code).alias("x"))).count("translate(") == 2  # of the code and of its parts
    assert _plan(spark.range(1).select(X.service_text("service_description", code).alias("x"))).count("translate(") == 1
    found = lines.classify_sections(lines.build_lines(elements(spark, {"d": ["Data Emissão|Série", "Nada", "05/09/2021"]})))
    ready = generate.prepared(found)
    assert set(ready.schema["next"].dataType.elementType.names) == {"line_index", "section", "normal", "text", "words", "has_columns"}


def test_label_within_an_element(spark):
    """Words of an element before a label's, and an element without words, do not move the place where the label ends."""
    found = lines.classify_sections(lines.build_lines(elements(spark, {"d": ["Nota fiscal|-|Valor|líquido da nota|R$ 900,00"]})))
    got = generate.label_hits(found).select(F.explode("labels").alias("m")).select("m.field", "m.stop").collect()
    assert ("net_amount", 3) in [tuple(r) for r in got]
