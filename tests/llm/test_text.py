"""Problems 1 to 4: detection, replacement, markup, scanned pages, characters."""

import datetime
import random
import re
import unicodedata

import pyarrow as pa
import pytest

from ledgerloom.llm import markup, ocr, pii, queries, unicode_forms

KEY = b"a key of the tests"
T0, T1 = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)


def kinds(text):
    return {k for i, k in enumerate(pii.KINDS) if pii.kinds_of([text], KEY)[0] >> i & 1}


@pytest.mark.parametrize(
    "text, want",
    [
        ("E-mail: ana@xpto.test  Telefone: (11) 98888-7777", {"email", "phone"}),
        ("E-mail: nfe[at]xpto ponto net ponto example", {"email"}),
        ("Correio eletrônico nfe (arroba) xpto.test", {"email"}),
        ("E-mail: contatoQxpto.example", {"email"}),
        ("CPF/CNPJ: 12.345.678/0001-99", {"id_number"}),
        ("CNPJ/CPF - 775 864 312 - 48", {"id_number"}),
        ("Inscrição Municipal: 5.791.126-8", set()),
        ("Chave de acesso 2202 6206 9534 2171 6957 1246 8109 4288 3251 5680 8855", set()),
        ("protocolo 78890456745", set()),
        ("Motorista Ricardo Brandolu - RG nº 820403238", {"id_number", "name"}),
        ("Endereço: Rua das Flores, 120", {"address"}),
        ("Município: Flalica  UF: MS", set()),
        ("Quadra 56 Lote 2, Setor Sunovi", {"address"}),
        ("Nome: VRUCREFUVE, NATÁLIA", {"name"}),
        ("Nome S. Givoco Jotepogra", {"name"}),
        ("Nome/Razão Social: Plotagadi Construções e Reformas Ltda", set()),
        ("A empresa Instituto Gustavo Subrira permanece responsável", set()),
        ("End.: Av. Pe. Mariana Gavreso, 3005", {"address"}),
        ("Assinado digitalmente por Luciana Zu\u200blima em 01/02/2024", {"name"}),
        ("", set()),
        ("   ", set()),
    ],
)
def test_pii_kinds(text, want):
    assert kinds(text) == want


def test_redact_keeps_the_rest():
    text = "Falar com Carlos Mendoca (11 98888-7777) em 10/05/2024; protocolo 123."
    out = pii.redact(text, KEY)
    assert "Carlos" not in out and "98888" not in out
    assert out.startswith("Falar com [NAME ") and out.endswith(" em 10/05/2024; protocolo 123.")
    assert pii.redact(None, KEY) is None and pii.redact("", KEY) == "" and pii.redact("nada aqui", KEY) == "nada aqui"


def test_redact_odd_characters():
    text = "E-mail: an\u200ba@xp\u00adto.test fim\u200b"
    out = pii.redact(text, KEY)
    assert re.fullmatch(r"E-mail: \[EMAIL [a-z2-7]{26}\] fim\u200b", out)


@pytest.mark.parametrize("name", ["Maria Aparecida dos Santos de Oliveira", "MARIA APARECIDA DOS SANTOS DE OLIVEIRA", "Maria Clara Aparecida dos Santos de Oliveira e Souza", "maria aparecida dos santos de oliveira"])
def test_redact_whole_names(name):
    out = pii.redact(f"Falar com {name} em 10/05/2024; protocolo 123.", KEY)
    assert re.fullmatch(r"Falar com \[NAME [a-z2-7]{26}\] em 10/05/2024; protocolo 123\.", out)


def test_redact_words_cut_at_line_ends():
    text = "Falar com Car-\nlos Men-\ndoca em 10/05/2024, na obser-\nvação"
    out = pii.redact(text, KEY)
    assert kinds(text) == {"name"}
    assert out == "Falar com " + pii.placeholder(4, "Carlos Mendoca", KEY) + " em 10/05/2024, na obser-\nvação"
    assert pii.redact("Falar com Carlos Men-\ndoca em 10/05/2024", KEY) == "Falar com " + pii.placeholder(4, "Carlos Mendoca", KEY) + " em 10/05/2024"


def test_redacted_query_covers_all_fields(spark, tmp_path):
    mail = "E-mail: ana@xpto.test"
    spark.createDataFrame([(1, mail, T0)], "artifact_id long, text string, loaded_at timestamp").write.parquet(f"{tmp_path}/raw_artifacts.parquet")
    spark.createDataFrame([(1, mail, None, T0), (2, "nada", mail, T0)], "cand_id long, line_text string, context_text string, loaded_at timestamp").write.parquet(f"{tmp_path}/candidates.parquet")
    spark.conf.set(pii.SETTING, KEY.hex())
    got = {(r.source_table, r.row_key, r.field_name): r.redacted_text for r in queries.p1_redacted(spark, str(tmp_path)).collect()}
    red = pii.redact(mail, KEY)
    assert "ana@" not in red
    assert got == {("raw_artifacts", 1, "text"): red, ("candidates", 1, "line_text"): red, ("candidates", 1, "context_text"): None, ("candidates", 2, "line_text"): "nada", ("candidates", 2, "context_text"): red}


def test_pseudonyms_link_and_keep_format():
    a, b = pii.placeholder(2, "529.982.247-25", KEY), pii.placeholder(2, "52998224725", KEY)
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b) and re.fullmatch(r"\[ID_NUMBER \d{3}\.\d{3}\.\d{3}-\d{2}\]", a)
    digits = re.sub(r"\D", "", a)
    assert pii.check_digits(digits[:9]) == digits[9:]  # a valid number stays valid
    assert pii.placeholder(1, "+55 (11) 98888-7777", KEY)[7:] != "" and a != pii.placeholder(2, "529.982.247-25", b"other")


def test_feistel_is_a_permutation():
    for n in (2, 7, 100, 1000):
        assert sorted(pii.feistel(i, n, b"k") for i in range(n)) == list(range(n))
    d = pii.permute_date("31/12/2023", b"k")
    assert re.fullmatch(r"\d{2}/\d{2}/\d{4}", d) and pii.permute_date("31/02/2023", b"k") == "31/02/2023"


def test_long_pieces_are_found_whole():
    way = "Rua " + " ".join(["das Flores e dos Campos"] * 30) + ", 120"
    assert kinds(f"Endereço: {way}") == {"address"} and way not in pii.redact(f"Endereço: {way}", KEY)
    plain = "Rua " + " ".join(["das Flores e dos Campos"] * 9) + ", 120"
    assert re.fullmatch(r"Entregar na \[ADDRESS [a-z2-7]{26}\] hoje", pii.redact(f"Entregar na {plain} hoje", KEY))
    name = "Maria " + " ".join(["Aparecida dos Santos"] * 40)
    assert re.fullmatch(r"Falar com \[NAME [a-z2-7]{26}\]\.", pii.redact(f"Falar com {name}.", KEY))
    assert kinds("Silva Marcos " + "CPF 529.982.247-25 " * 9) == {"name", "id_number"}
    assert kinds("Fonc 11988887777") == {"phone"} and kinds("f0ne 11988887777") == {"phone"}


def test_key_is_the_callers():
    assert len({pii.link(f"Pessoa {i}", KEY, b"name") for i in range(60_000)}) == 60_000
    assert pii.redact("CPF: 529.982.247-25", KEY) != pii.redact("CPF: 529.982.247-25", b"other")
    with pytest.raises(ValueError):
        pii.redact("CPF: 529.982.247-25", b"")
    assert pii.redact("nascido em 31/12/1980", KEY) != "nascido em 31/12/1980" and kinds("nascido em 31/12/1980") == set()


def test_pii_tables(spark):
    schema = "artifact_id long, text string, loaded_at timestamp, mask int, row_key string"
    rows = [(1, "CPF: 529.982.247-25", T0, 1, "x"), (1, "nada", T1, 1, "x"), (2, "CPF: 529.982.247-25", T0, 1, "x"), (2, "CPF: 529.982.247-25", T0, 1, "x"), (3, None, None, 1, "x"), (4, "tel.: (11) 98888-7777 " * 3000, None, 1, "x")]
    df = spark.createDataFrame(rows, schema)
    got = {(r.row_key, r.pii_type) for r in pii.found(df, "artifact_id", ["text"], "raw_artifacts", KEY).collect()}
    assert got == {(2, "id_number"), (4, "phone")}
    assert pii.found(spark.createDataFrame([], schema), "artifact_id", ["text"], "raw_artifacts", KEY).count() == 0
    red = pii.redacted(df, {"text": "out"}, KEY)
    assert red.filter("artifact_id = 3 and out is null").count() == 1
    with pytest.raises(ValueError):
        pii.redacted(df, {"text": "mask"}, KEY)


@pytest.mark.parametrize(
    "text, want, plain",
    [
        ("<p>a &amp; b</p>", {"html"}, "a & b"),
        ("<UL><LI>a<LI>b</UL>", {"html"}, "- a\n- b"),
        ("<table><tr><td>a</td><td>1</td></tr></table>", {"html"}, "a | 1"),
        ("**a** b", {"markdown"}, "a b"),
        ("# a\n\n```python\nx = 1\n```", {"markdown"}, "# a\n\n    x = 1"),
        ("| a | b |\n|---|---|\n| 1 | 2 |", {"markdown"}, None),
        ("'''a''' [[b|c]]", {"wiki"}, "a c"),
        ("== a ==\nb", {"wiki"}, "# a\n\nb"),
        (r"\textbf{a} $x^2$", {"latex"}, None),
        (r"{\small a: 4\%} \\", {"latex"}, "a: 4%"),
        ("valor < R$ 5,00 e alíquota > 2%", set(), None),
        (r"Arquivo C:\notas\2024\lote_24", set(), None),
        ("* Valores em reais", set(), None),
        ("e/ou $ 1,00 = 3,00", set(), None),
        ("Campo <não informado> [5] - 1 -", set(), None),
        ("Fulano | Relatório 06/2024", set(), None),
        ("", set(), ""),
        (None, set(), None),
    ],
)
def test_markup(text, want, plain):
    bits = markup.kinds_of(text)
    assert {k for i, k in enumerate(markup.KINDS) if bits >> i & 1} == want
    if plain is not None:
        assert markup.clean_text(text) == plain
    if not want:
        assert markup.clean_text(text) == text


@pytest.mark.parametrize("n", [1, 299, 300, 301, 2_200, 10_000, 200_000])
def test_markup_of_any_length(n):
    w = "a" * n
    for text, kind in ((f"`{w}`", "markdown"), (f"[[{w}]]", "wiki"), (f"{{{{{w}}}}}", "wiki"), (f"**{w}**", "markdown"), (f"== {w} ==", "wiki"), (f"~~{w}~~", "markdown"), (f"__{w}__", "markdown"), (f"[a](http://{w})", "markdown"), (f"[{w}](#{w})", "markdown"), (f"$x^{w}$", "latex"), (f"${w}$", "latex"), (f"--- {' ' * n}---", "markdown")):
        assert markup.kinds_of(text) == 1 << markup.KINDS.index(kind), text[:20]
    for text in ("[" * n, "{{" * n, "**" + w, "`" + w, "~~" + w, "$" + w, "![" * n):
        markup.kinds_of(text)


def test_matching_of_long_trees():
    rows = "".join(f"<tr><td>{i}</td></tr>" for i in range(3_000))
    a = markup._nest(markup.flat_tree(markup.parse(f"<table>{rows}</table>")))
    b = markup._nest(markup.flat_tree(markup.parse(f"<table><tr><td>x</td><td>y</td></tr>{rows}</table><p>z</p>")))
    assert markup.simple_tree_match(a, b)[0] == a[4] == 3_000 * 3 + 2


def test_tree_matching_brute_force():
    rnd = random.Random(4)

    def tree(depth):
        return "<{0}>{1}</{0}>".format(rnd.choice(["div", "p", "b"]), "".join(tree(depth - 1) if depth and rnd.random() < 0.7 else rnd.choice("xy") for _ in range(rnd.randrange(0, 4))))

    def size(a, b):
        if a[1] != b[1]:
            return 0
        x, y = a[3], b[3]
        m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + size(x[i], y[j]))
        return m[-1][-1] + 1

    for _ in range(200):
        a, b = (markup._nest(markup.flat_tree(markup.parse(tree(3) + tree(2)))) for _ in range(2))
        n, pairs = markup.simple_tree_match(a, b)
        assert n == size(a, b) == len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs})


def test_labels():
    assert [markup.clean_label(x) for x in ("<b>para</b>", "$equ$", "PARA ", "[[sec]]", None, " ")] == ["para", "equ", "para", "sec", None, None]


def test_simple_tree_matching():
    a = markup._nest(markup.flat_tree(markup.parse("<table><tr><td>x</td><td>1</td></tr></table>")))
    b = markup._nest(markup.flat_tree(markup.parse("<table><tr><td>x</td><td>2</td></tr><tr><td>y</td></tr></table>")))
    size, pairs = markup.simple_tree_match(a, b)
    assert size == 7 and markup.simple_tree_match(b, a)[0] == size


def test_wrapper_induction(spark):
    pages = [(i, f"<table><tr><td>Total</td><td>{i}</td></tr></table>", "h") for i in range(5)] + [(9, None, "h"), (10, "no markup", None)]
    got = {r.row_key: (r.template, r.content) for r in markup.induce_wrappers(spark.createDataFrame(pages, "row_key long, text string, site string"), ["site"]).collect()}
    assert got == {i: ("Total", str(i)) for i in range(5)}


def test_markup_found(spark):
    schema = "artifact_id long, text string, raw_label string, loaded_at timestamp"
    rows = [(1, "<p>a</p>", "**b**", T0), (1, "a", "b", T1), (2, "<p>a</p>", None, None)]
    assert {tuple(r) for r in markup.found(spark.createDataFrame(rows, schema)).collect()} == {(2, "text", "html")}
    assert markup.found(spark.createDataFrame([], schema)).count() == 0


def test_unicode_against_the_standard_library():
    rnd = random.Random(3)
    pool = "abc ÁçZz09.,-\n" + "ＡＢｚ１，　" + "áç̃" + "\u200b\u00ad\ufeff" + "\u00a0\u2003" + "Δµ品ß"
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randrange(0, 30))) for _ in range(400)] + [None, "", "\u0301x", "a\u0301" * 5000]
    out, bits = unicode_forms.normalize(pa.array(texts))
    zero = set(map(chr, unicode_forms.INVISIBLE))
    spaces = set(map(chr, unicode_forms.SPACES))
    for text, got, b in zip(texts, out.to_pylist(), bits):
        if text is None:
            assert got is None and b == 0
            continue
        want = "".join(" " if c in spaces or c == "\u3000" else chr(ord(c) - 0xFEE0) if "\uff01" <= c <= "\uff5e" else c for c in text if c not in zero)
        assert got == unicodedata.normalize("NFC", want)
        assert bool(b & 1) == any("\uff01" <= c <= "\uff5e" or c == "\u3000" for c in text)
        assert bool(b & 4) == any(c in zero for c in text) and bool(b & 8) == any(c in spaces for c in text)


def test_marks_in_any_order():
    rnd = random.Random(8)
    texts = ["a\u0323\u0302", "a\u0302\u0323", "\u00e2\u0323", "\u1ea1\u0302", "A\u030a\u0323x", "\u212b", "o\u0304\u0303" * 300]
    texts += ["".join(rnd.choice("aeouAxç\u00e2\u1ead\u01d5" + "\u0300\u0301\u0302\u0303\u0304\u0307\u0308\u030a\u031b\u0323\u0327\u0328\u0331") for _ in range(rnd.randrange(1, 40))) for _ in range(600)]
    out = unicode_forms.normalize(pa.array(texts))[0].to_pylist()
    assert out[:4] == ["\u1ead"] * 4
    assert out == [unicodedata.normalize("NFC", t) for t in texts]


def test_look_alikes():
    texts = ["Pаgina", "Оплата по договору", "Δt = 5", "kΩ µm", "Νº 5", "ЅERVIÇOS", "Τιμολόγιο", "Vaca/ΕЅ", "ver СОРА e Завод"]
    out, bits = unicode_forms.normalize(pa.array(texts))
    assert [bool(b & 16) for b in bits] == [True, False, False, False, True, True, False, True, False]
    assert out.to_pylist()[0] == "Pagina" and out.to_pylist()[1] == texts[1] and out.to_pylist()[5] == "SERVIÇOS"
    again, _ = unicode_forms.normalize(out)
    assert again.to_pylist() == out.to_pylist()


def test_unicode_tables(spark):
    schema = "cand_id long, value string, loaded_at timestamp, at int"
    rows = [(1, "a\u200b", T0, 1), (1, "a", T1, 1), (2, "Ａ", None, 1), (3, None, None, 1), (4, "", None, 1)]
    df = spark.createDataFrame(rows, schema)
    assert {tuple(r) for r in unicode_forms.found(df, "cand_id", "value", "candidates").collect()} == {("candidates", 2, "value", "full_width")}
    assert [r.normalized_text for r in unicode_forms.normalized(df, "value").orderBy("cand_id", "at").collect()][2:] == ["A", None, ""]
    assert unicode_forms.found(spark.createDataFrame([], schema), "cand_id", "value", "candidates").count() == 0


def test_normalized_query_covers_both_tables(spark, tmp_path):
    spark.createDataFrame([(1, "ｎｏｔａ", T0), (2, None, T0)], "artifact_id long, text string, loaded_at timestamp").write.parquet(f"{tmp_path}/raw_artifacts.parquet")
    spark.createDataFrame([(1, "cafe\u0301", T0)], "cand_id long, value string, loaded_at timestamp").write.parquet(f"{tmp_path}/candidates.parquet")
    got = {(r.source_table, r.row_key, r.field_name, r.normalized_text) for r in queries.p4_normalized(spark, str(tmp_path)).collect()}
    assert got == {("raw_artifacts", 1, "text", "nota"), ("raw_artifacts", 2, "text", None), ("candidates", 1, "value", "café")}


ART = "artifact_id long, document_id string, engine_id string, ordinal int, element_type string, text string, page_number int, bounding_box struct<x:double,y:double,w:double,h:double>, loaded_at timestamp, row_key int, at int"
CAND = "cand_id long, document_id string, line_text string, context_text string, loaded_at timestamp, row_key int"


def pages():
    rows, i = [], 0
    for d in range(12):
        for p in (1, 2, 3):
            for y, t in ((40.0, f"Empresa Azul {d} | Relatório de faturamento"), (300.0, "O campo destinado às observações foi preenchido manualmente na sexta-feira"), (700.0, f"Valor Total do Serviço: {d}{p},00"), (1610.0, f"Página {p} de 3")):
                i += 1
                rows.append((i, f"d{d}", "e", i, "para", t, p, (10.0, y, 100.0, 20.0), T0, 0, 0))
    odd = ["O cam-\npo destinado às obser-\nvações", "na sexta-\nfeira", "O carnpo destinado", "Val0r Total", "Página 3 de 3", "12", "Código XRT0CAST3", None, "  ", "Preço 7.000,l6", "Período 2023-\n2024"]
    for t in odd:
        i += 1
        rows.append((i, "x", "e", i, "para", t, 1, (10.0, 500.0, 10.0, 10.0), T0, 0, 0))
    return rows


def test_scanned_pages(spark):
    rows = pages()
    a = spark.createDataFrame(rows, ART)
    c = spark.createDataFrame([(1, "d1", "Valor Líquido 3", "Empresa Azul 1 | Relatório de faturamento Valor Líquido 3", T0, 0), (2, "d1", None, "", None, 0), (3, "x", "Código do Serv- iço 3", None, T0, 0)], CAND)
    got = {(r.source_table, r.row_key, r.field_name, r.noise_kind) for r in ocr.found(a, c).collect()}
    art = {(k, kind) for s, k, _, kind in got if s == "raw_artifacts"}
    first = len(rows) - 11
    assert {k for k, kind in art if kind == "running_header"} == {r[0] for r in rows if r[5] and r[5].startswith("Empresa")}
    assert {k - first for k, kind in art if kind == "hyphenation"} == {1}
    assert {k - first for k, kind in art if kind == "misread"} == {3, 4, 10}
    assert {k for k, kind in art if kind == "page_number"} == {r[0] for r in rows if r[5] and r[5].startswith("Página")}
    assert {x[1:] for x in got if x[0] == "candidates"} == {(1, "context_text", "running_header"), (3, "line_text", "hyphenation")}
    assert ocr.found(spark.createDataFrame([], ART), spark.createDataFrame([], CAND)).count() == 0


def test_headers_on_few_pages_of_a_large_document(spark):
    box, body = (10.0, 40.0, 100.0, 20.0), (10.0, 300.0, 100.0, 900.0)
    fill = [f"Linha {'abcdef'[k]} do texto que a página traz por inteiro." for k in range(6)]
    rows = [(p, "big", "e", p, "para", f"Empresa Verde Serviços - Lote geral {p}", p, box, T0, 0, 0) for p in range(1, 121)]
    rows += [(1000 + p, "big", "e", 500 + p, "para", "Setor de Obras - Filial Norte", p, box, T0, 0, 0) for p in (10, 11)]
    rows += [(1100, "big", "e", 600, "para", "Setor de Compras - Filial Sul", 12, box, T0, 0, 0)]  # one page only
    rows += [(1200 + p, "big", "e", 700 + p, "para", "\n".join(["Anexo do Contrato - Filial Leste", *fill, f"R$ {p},36 já abatidos do total"]), p, body, T0, 0, 0) for p in (20, 21)]
    rows += [(1300 + p, "big", "e", 800 + p, "para", "\n".join([f"Registro de ocorrência {p}: a leitura do documento", "foi feita no balcão.", *fill]), p, body, T0, 0, 0) for p in (30, 31)]
    got = {r.row_key for r in ocr.found(spark.createDataFrame(rows, ART), spark.createDataFrame([], CAND)).filter("noise_kind = 'running_header'").collect()}
    assert got == {*range(1, 121), 1010, 1011, 1220, 1221}


def test_reflow(spark):
    rows = [r for r in pages() if r[1] != "x"]
    rows += [(900, "y", "e", 1, "para", "O campo destinado às obser-", 1, (1.0, 200.0, 1.0, 1.0), T0, 0, 0), (901, "y", "e", 2, "para", "vações foi preenchido", 1, (1.0, 230.0, 1.0, 1.0), T0, 0, 0)]
    out = ocr.reflowed(spark.createDataFrame(rows, ART), spark.createDataFrame([], CAND))
    assert [r.paragraph for r in out.filter("document_id = 'y'").collect()] == ["O campo destinado às observações foi preenchido"]
    assert out.filter("paragraph like '%Página%' or paragraph like '%Relatório%'").count() == 0


def test_reflow_keeps_the_rest_of_noisy_elements(spark):
    head = "Empresa Azul 1 | Relatório de faturamento"
    body = ["O campo destinado às observações foi preenchido", "Os valores foram conferidos pelo setor", "A entrega ocorreu conforme combinado", "O serviço foi prestado na sede"]
    texts = {
        900: "\n".join([head, *body, "Página 4 de 5"]),
        901: "\n".join([*body, "- 4 -"]),
        902: "\n".join([head, *body, "O total consta abaixo e o saldo em aberto não foi incluído", "4"]),
        903: "O anexo da Folha 12 foi conferido",
        904: "Consulta de notas - Página 4 de 5",
        905: f"**{head}** {{.topo}}\nTexto que fica",
        906: f"{head}\nPágina 4 de 5",
        907: f"<div>{head}</div>",
    }
    rows = [r for r in pages() if r[1] == "d1"]
    rows += [(k, "d1", f"e{k}", 1, "para", t, 4, (10.0, 300.0, 100.0, 600.0), T0, 0, 0) for k, t in texts.items()]
    # an earlier delivery with noise of its own
    rows += [(903, "d1", "e903", 1, "para", head, 4, (10.0, 40.0, 100.0, 20.0), None, 0, 0)]
    out = ocr.reflowed(spark.createDataFrame(rows, ART), spark.createDataFrame([], CAND))
    got = {r.engine_id: r.paragraph for r in out.filter("engine_id <> 'e'").collect()}
    whole = " ".join(body)
    assert got["e900"] == whole and got["e901"] == whole
    assert got["e902"] == whole + " O total consta abaixo e o saldo em aberto não foi incluído"
    assert got["e903"] == texts[903] and got["e904"].strip() == "Consulta de notas"
    assert got["e905"].endswith("Texto que fica") and "Relat" not in got["e905"]
    assert "e906" not in got and "e907" not in got
