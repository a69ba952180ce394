"""Typed values: expected results of single texts, and the independent SQL in test_oracle."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import extract as X

CASES = [
    ("provider_document", "CNPJ 12,345.678/0001-90 x", "12.345.678/0001-90"),
    ("provider_document", "52998224725", "529.982.247-25"),
    ("provider_document", "123", None),
    ("provider_municipal_registration", "1.234-5 Inscricao Estadual 99", "1.234-5"),
    ("provider_municipal_registration", "isento", "ISENTO"),
    ("provider_municipal_registration", "Insc. Estadual 77", None),
    ("provider_name", "ACME SERVICOS LTDA CNPJ: 12.345.678/0001-90", "ACME SERVICOS LTDA"),
    ("provider_name", "Casa Verde Inscrição: 5", "Casa Verde"),
    ("provider_name", "Casa Verde : 1234", "Casa Verde"),
    ("provider_name", "Casa", None),
    ("recipient_email", "fale a@b.com já", "a@b.com"),
    ("provider_uf", "sp x", "SP"),
    ("provider_phone", "11987654321/01133334444", "11987654321 01133334444"),
    ("issue_date", "em 01/02/2024 às 3", "01/02/2024"),
    ("competence_date", "15/04/2026", "04/2026"),
    ("competence_date", "04/2026", "04/2026"),
    ("service_code", "17.01.02 - x", "17.01.02"),
    ("service_code", "1.05 x", "1.05"),
    ("service_code", "ano 2024", None),
    ("service_code", "Lei Complementar 116", None),
    ("service_code", "1401 Instalação", "1401"),
    ("service_code", "1234,50", None),
    ("service_city", "3550308 São Paulo - SP", "3550308 São Paulo/SP"),
    ("service_city", "35503 São Paulo ! SP", "São Paulo/SP"),
    ("service_city", "12345", None),
    ("operation_nature", "Tributação no município Código 5", "Tributação no município"),
    ("operation_nature", "de operação", None),
    ("service_description", "Discriminação dos Serviços: CONSULTA", "CONSULTA"),
    ("service_description", "DISCRIMINAÇÃO DO SERVIÇO", None),
    ("service_description", "Suporte técnico mensal Valor total 3", "Suporte técnico mensal"),
    ("iss_rate", "alíquota 2,5% x", "2,5%"),
    ("iss_rate", "5 x 3%", "3%"),
    ("gross_amount", "5,00% R$ 1.234,56", "R$ 1.234,56"),
    ("gross_amount", "10.50", "10.50"),
    ("net_amount", "nada", None),
    ("verification_code", "ABCD- 12EF", "ABCD-12EF"),
    ("verification_code", "CODIGO 12345 AB12CD", "AB12CD"),
    ("verification_code", "quarta-feira", None),
    ("verification_code", "http://x.y/AB12CD", None),
    ("nfse_number", "31407 Série E Data Emissão: 28/09/2022 Certificação: 6E93194D2", "31407"),
    ("nfse_number", "1.234 nota 77", "77"),
    ("nfse_number", "a/b 7", None),
    ("provider_address", " : Rua A, 5 - ", "Rua A, 5"),
    ("provider_address", "", None),
    ("provider_address", None, None),
]


@pytest.fixture(scope="module")
def got(spark):
    df = spark.createDataFrame([(i, f, v) for i, (f, v, _) in enumerate(CASES)], "i int, f string, v string")
    return {r[0]: r[1] for r in df.select("i", X.typed(F.col("f"), F.col("v"))).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_typed(got, i):
    assert got[i] == CASES[i][2], CASES[i]


def test_inline(spark):
    rows = [("Nome/Razão Social: NCR BRASIL LTDA Nome Fantasia: X CNPJ: 1",), ("Município: X UF: sp",), ("sem rótulo",), ("contatoQacme.com.br",), ("nfe Oacme.com",), ("aaQwww.acme.com",)]
    df = spark.createDataFrame(rows, "t string").select(X.inline_party_name(F.col("t")), X.inline_state(F.col("t")), X.repaired_email(F.col("t")))
    out = [tuple(r) for r in df.collect()]
    assert [x[0] for x in out] == ["NCR BRASIL LTDA", None, None, None, None, None]
    assert out[1][1] == "SP" and [x[2] for x in out[3:]] == ["contato@acme.com.br", "nfe@acme.com", None]
