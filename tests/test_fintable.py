"""Value tables: alignment of synthetic headers and values."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import fintable, lines

CASES = {
    "in order": (["Valor total dos serviços Base de cálculo Alíquota Valor ISS", "1.000,00 900,00 5% 45,00"], {"gross_amount": "1.000,00", "taxable_amount": "900,00", "iss_rate": "5%", "iss_amount": "45,00"}),
    "split number": (["Base de cálculo Alíquota Valor ISS", "900 ,00 2,50 % 22,50"], {"taxable_amount": "900,00", "iss_rate": "2,50%", "iss_amount": "22,50"}),
    "rate without sign": (["Deduções Base de cálculo Alíquota Valor ISS", "0,00 900,00 3,00 27,00"], {"deductions_amount": "0,00", "taxable_amount": "900,00", "iss_rate": "3,00", "iss_amount": "27,00"}),
    "nonzero deductions": (["Deduções Base de cálculo Alíquota", "10,00 900,00 3%"], {"taxable_amount": "900,00", "iss_rate": "3%"}),
    "tax after the rate": (["Base de cálculo Alíquota", "900,00 5% 45,00"], {"taxable_amount": "900,00", "iss_rate": "5%", "iss_amount": "45,00"}),
    "tax after the base": (["Base de cálculo Valor líquido", "900,00 800,00 45,00"], {"taxable_amount": "900,00", "net_amount": "800,00", "iss_amount": "45,00"}),
    "sparse": (["PIS COFINS INSS", "1,00 2,00"], {"inss_withheld_amount": "2,00"}),
    "sparse with zero": (["Deduções PIS COFINS", "0,00 2,00"], {"deductions_amount": "0,00", "cofins_withheld_amount": "2,00"}),
    "single base": (["Base de cálculo Valor ISS", "900,00"], {"taxable_amount": "900,00"}),
    "single of three": (["PIS COFINS Base de cálculo", "900,00"], {}),
    "place holder": (["Total trib federais Valor líquido da nota Desconto incondicionado", "1,00 2,00 3,00"], {"net_amount": "2,00", "unconditional_discount": "3,00"}),
    "two lines": (["PIS COFINS CSLL", "1,00 2,00", "3,00", "4,00"], {"pis_withheld_amount": "1,00", "cofins_withheld_amount": "2,00", "csll_withheld_amount": "3,00"}),
    "next header ends": (["PIS COFINS", "1,00", "INSS IRRF", "5,00 6,00"], {}),
    "informs": (["Valor aproximado PIS COFINS", "1,00 2,00"], {}),
    "one column": (["Valor total", "1,00"], {}),
    "no values": (["PIS COFINS", "nada"], {}),
}


@pytest.fixture(scope="module")
def got(spark):
    rows = [(k, "e", i, t, "values", 9) for k, (texts, _) in CASES.items() for i, t in enumerate(texts)]
    df = fintable.next_of(spark.createDataFrame(rows, "document_id string, engine_id string, line_index int, text string, section string, n_lines int"))
    out = fintable.tables(lines.with_next(df, 3, ["section", "normal", "text", "has_columns"])).filter("line_index = 0")
    return {r.document_id: {p.field: p.value for p in r.mapped} for r in out.select("document_id", "mapped").collect()}


@pytest.mark.parametrize("name", CASES)
def test_tables(got, name):
    assert got[name] == CASES[name][1]


def test_longer_labels_come_first(spark):
    text = "valor total dos servicos valor liquido da nota ir irrf base de calculo do issqn"
    out = spark.range(1).select(fintable.columns_of(F.lit(text)).alias("c")).first().c
    assert [(x.label, x.start) for x in out] == [("valor total dos servicos", 0), ("valor liquido da nota", 4), ("ir", 8), ("irrf", 9), ("base de calculo do issqn", 10)]
