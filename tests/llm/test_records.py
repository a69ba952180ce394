"""Problems 5 to 9: survivors, names, packing, leakage, splitting."""

import datetime
import itertools
import random

import pytest

from ledgerloom.llm import leakage, names, packing, splitting, survivors, tok

T0 = datetime.datetime(2024, 1, 1)


def linked(spark, values):
    df = spark.createDataFrame([(v, f"d{i}") for i, v in enumerate(values)], "value string, document_id string")
    return {tuple(r) for r in names.found(df).collect()}


def test_names(spark):
    same = [
        ["Trovupano Serviços Médicos Associados Ltda", "TROVUPANO SERV. MÉD. ASSOC. LIMITADA", "Serviços Médicos Associados Trovupano", "Trovupno Serviços Médicos Associados Ltda", "Trovupano L.T.D.A."],
        ["Cliprivrufro Comunicação Visual ME", "Cliprivrufro Comun. Visual"],
        ["Cliprivrufro Engenharia e Manutenção S.A.", "ENG. E MANUT. CLIPRIVRUFRO SOCIEDADE ANÔNIMA"],
        ["Gabriel Gito Dogoquafli", "DOGOQUAFLI, GABRIEL GITO", "Biel Dogoquafli", "G. Gito Dogoquafli", "Dr(a). Gabriel G. Dogoquafli", "Gab riel Gito Dogoquafli"],
        ["Fernanda Dogoquafli"],
    ]
    heads = ["TOMADOR DE SERVIÇOS", "CPF/CNPJ", "Razão Social", None, "", "  "]
    want = {tuple(sorted(p)) for g in same for p in itertools.combinations(g, 2)}
    assert linked(spark, [v for g in same for v in g] * 2 + heads) == want


def test_chains_are_followed_to_their_end(spark):
    n = 41
    link = spark.createDataFrame([(f"k{i:02}", f"k{max(0, i - 1):02}") for i in range(n)], "key string, parent string")
    assert {(r.key, r.parent) for r in names.roots(link).collect()} == {(f"k{i:02}", "k00") for i in range(n)}
    assert names.roots(link.limit(0)).count() == 0


def test_candidates_share_a_key_with_what_they_explain():
    rnd = random.Random(9)
    values = ["Carlos Eduardo Silva", "Maria Clara Souza Lima", "Trovupano Engenharia e Manutenção Ltda", "Ana Paula Mendoca", "Joaquim Brandolucci"]
    forms = []
    for v in values:
        for _ in range(120):
            w = list(v)
            for _ in range(rnd.randrange(0, 3)):
                i = rnd.randrange(len(w))
                w[i : i + 1] = rnd.choice([[], [w[i], rnd.choice("aeiou")], [rnd.choice("abcdeo")], [w[i], " "]])
            t = "".join(w)
            if rnd.random() < 0.3:
                t = " ".join(x[0] + "." if k and rnd.random() < 0.4 else x for k, x in enumerate(t.split()))
            got = names.read_form(t.lower().replace("ç", "c").replace("ã", "a"), t)
            if got and got[1]:
                forms.append(dict(zip(names.FIELDS, got), n=rnd.randrange(1, 9), key="|".join(got[:6])))
    keys = [names.blocks_of(f) for f in forms]
    missed = hit = 0
    for i, f in enumerate(forms):
        for j, c in enumerate(forms):
            if f["key"] != c["key"] and names.rank_of(c) > names.rank_of(f) and names.likelihood(f, c) >= names.MIN_LOG:
                hit += 1
                missed += not keys[i][0] & keys[j][1]
    assert hit > 1000 and missed <= hit * 0.01


def test_names_empty(spark):
    assert linked(spark, []) == set() and linked(spark, [None, ""]) == set()


CAND = "cand_id long, document_id string, engine_id string, field_name string, value string, confidence double, section_confidence double, loaded_at timestamp, label_text string, context_text string, line_text string, section_name string, page_number int, bounding_box struct<x:double,y:double,w:double,h:double>, value_source string, vkey int"


def cand(i, value, conf=0.5, sec=0.5, day=1, label="l", field="gross_amount", engine="a", doc="d"):
    return (i, doc, engine, field, value, conf, sec, datetime.datetime(2024, 1, day), label, "c", "t", "s", 1, None, "same_line", 0)


def test_survivors(spark):
    rows = [
        cand(1, "R$ 1.234,50", 0.9, 0.9, 3), cand(2, "1234,50", 0.8, None, 1), cand(3, "1.234,50 ", 0.7, 0.9, 3, None),  # 1 wins
        cand(4, "10,00", 0.9, 0.5, 1), cand(5, "10,00", 0.5, 0.9, 1),  # neither
        cand(6, "20,00"), cand(7, "20,00"),  # a full tie
        cand(8, "30,00"), cand(8, "30,00"),  # one record, delivered twice
        cand(9, None), cand(10, "", None), cand(11, "x"),
        cand(12, "01/02/2024", 0.9, field="issue_date"), cand(13, "1.2.2024", 0.4, field="issue_date", engine="b"), cand(14, "2024-02-01", 0.9, day=2, field="issue_date"),  # 14 wins
        cand(15, "Trovupano Engenharia e Manutenção Ltda", 0.4, field="provider_name"), cand(16, "TROVUPANO ENG. E MANUT. LTDA", 0.6, field="provider_name"), cand(17, "TOMADOR DE SERVIÇOS", 0.9, field="provider_name"),
    ]
    df = spark.createDataFrame(rows, CAND)
    assert {tuple(r) for r in survivors.found(df).collect()} == {(1, 1), (12, 14), (15, 16)}
    assert survivors.found(spark.createDataFrame([], CAND)).count() == 0
    best = {(r.field_name, r.vkey) for r in survivors.fused(df).collect()}
    assert ("issue_date", "2024-02-01") in best and sum(f == "gross_amount" for f, _ in best) == 1
    built = {r.group_id: r for r in survivors.built(df).collect()}
    assert built[1].confidence == 0.9 and built[1].label_text == "l"


def test_survivors_brute_force(spark):
    rnd = random.Random(5)
    rows = [cand(i, f"{rnd.randrange(8)},00", rnd.choice([None, 0.1, 0.5, 0.9]), rnd.choice([None, 0.3, 0.7]), rnd.randrange(1, 4), rnd.choice([None, "l"]), doc=f"d{rnd.randrange(6)}") for i in range(300)]
    want = set()
    groups = {}
    for r in rows:
        groups.setdefault((r[1], r[4]), []).append(r)
    key = lambda r: (r[5] if r[5] is not None else -1, r[6] if r[6] is not None else -1, r[7], r[8] is not None)
    for g in groups.values():
        top = [r for r in g if all(all(x >= y for x, y in zip(key(r), key(o))) for o in g)]
        if len(g) > 1 and len(top) == 1:
            want.add((min(r[0] for r in g), top[0][0]))
    assert {tuple(r) for r in survivors.found(spark.createDataFrame(rows, CAND)).collect()} == want


def test_latent_quality_prefers_the_better_source(spark):
    rnd = random.Random(2)
    rows, i = [], 0
    for d in range(300):
        for engine, right in (("a", 0.95), ("b", 0.4), ("c", 0.9)):
            i += 1
            rows.append(cand(i, "100,00" if rnd.random() < right else f"{rnd.randrange(1, 90)},11", engine=engine, doc=f"d{d}"))
    q, values = survivors.source_quality(survivors.grouped(spark.createDataFrame(rows, CAND)))
    q = q.sources
    assert q["a/line"][0] > q["b/line"][0] + 0.2 and q["c/line"][1] > q["b/line"][1]  # two sources alone could not be told apart
    assert values.filter("vkey = '100'").agg({"p_true": "avg"}).first()[0] > values.filter("vkey <> '100'").agg({"p_true": "avg"}).first()[0]


def test_rows_hang_on_the_inferred_quality(spark):
    rnd = random.Random(5)
    rows = [cand(i, f"{rnd.randrange(4)},00", rnd.choice([None, 0.1, 0.5, 0.9]), rnd.choice([None, 0.3, 0.9]), rnd.randrange(1, 4), rnd.choice([None, "l"]), doc=f"d{rnd.randrange(9)}", engine=rnd.choice("ab")) for i in range(120)]
    records = survivors.cut(survivors.grouped(spark.createDataFrame(rows, CAND)))
    quality, _ = survivors.source_quality(records)
    found = lambda q: {tuple(r) for r in survivors.survivors(records, q).filter("several and sole").select("group_id", "survivor_id").collect()}
    chosen = lambda q: {tuple(r) for r in survivors.survivors(records, q).select("group_id", "survivor_id").collect()}
    same = survivors.Quality(quality.sources, quality.respects, {k: v * 2 for k, v in quality.weights.items()}, quality.span)
    swapped = survivors.Quality(quality.sources, quality.respects, {k: -v for k, v in quality.weights.items()}, quality.span)
    other = survivors.Quality(quality.sources, quality.respects, {"sure": 0.05, "placed": 0.05, "fresh": 9.0, "full": 0.05}, quality.span)
    assert found(quality) == found(same) == found(other) and found(quality)
    assert found(swapped) != found(quality) and chosen(other) != chosen(quality)


def test_quality_of_many_sources(spark):
    rnd = random.Random(7)
    rows = [cand(i, f"{rnd.choice([5, 5, 5, 5, 6, 7, 8])},00", rnd.random(), rnd.random(), rnd.randrange(1, 4), engine=f"e{i % 13}", doc=f"d{i // 13}") for i in range(13 * 60)]
    records = survivors.cut(survivors.grouped(spark.createDataFrame(rows, CAND)))
    a, va = survivors.source_quality(records)
    b, vb = survivors.source_quality(records, held=0)  # by the workers
    assert len(a.sources) == 13 and all(abs(x - y) < 1e-9 for s in a.sources for x, y in zip(a.sources[s], b.sources[s]))
    assert all(abs(a.weights[r] - b.weights[r]) < 1e-9 for r in survivors.RESPECTS)
    p = lambda v: {(r.document_id, r.vkey): round(r.p_true, 9) for r in v.collect()}
    assert p(va) == p(vb) and len(p(va)) > 60


def plain_best_fit(sizes, cap):
    bins = []
    for s in sorted(sizes, reverse=True):
        fit = [b for b in bins if cap - b >= s]
        if fit:
            bins[bins.index(max(fit))] += s
        else:
            bins.append(s)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_is_that_of_one_by_one(seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([1, 2, 3, 7, 10, rnd.randrange(1, 50)]) for _ in range(rnd.randrange(0, 400))]
    plan, n = packing.best_fit({s: sizes.count(s) for s in set(sizes)}, 50)
    load = [0] * n
    for size, _, count, first in plan.tolist():
        for b in range(first, first + count):
            load[b] += size
    assert sorted(load) == plain_best_fit(sizes, 50)


def test_pack(spark):
    docs = [(i, n) for i, n in enumerate([5, 5, 95, 100, 230, 0, None, 60, 40, 60])] + [(0, 5)]
    got = packing.pack(spark.createDataFrame(docs, "doc_id long, tokens long"), [(1, 100), (2, 1000)]).collect()
    for limit, cap in ((1, 100), (2, 1000)):
        rows = [r for r in got if r.limit_id == limit]
        assert sum(r.tokens for r in rows) == sum(n or 0 for _, n in docs)
        load = {}
        for r in rows:
            load[r.container_id] = load.get(r.container_id, 0) + r.tokens
        assert max(load.values()) <= cap and len(load) == -(-600 // cap)
        assert {r.doc_id for r in rows if r.part_no > 0} == ({4} if cap == 100 else set())
    assert packing.pack(spark.createDataFrame([], "doc_id long, tokens long"), [(1, 100)]).count() == 0


WORDS = "alfa beta gama delta epsilon zeta eta teta iota capa lambda mi ni csi omicron pi ro sigma tau upsilon fi chi psi omega um dois tres quatro cinco seis sete oito nove dez".split()


def item(seed, n=60):
    rnd = random.Random(seed)
    return [rnd.choice(WORDS) + str(rnd.randrange(1000)) for _ in range(n)]


def test_leakage(spark):
    note = "Leia a nota fiscal abaixo e responda usando apenas os dados que aparecem nela com todo o cuidado e sem acrescentar nada que nao esteja escrito nela."
    a, b = item(1), item(2)
    bench = [(1, note + "\n" + " ".join(a)), (2, note + "\n" + " ".join(b)), (3, None), (4, "curto")]
    changed = [w if k % 9 else "outra" for k, w in enumerate(a[10:40])]
    docs = [
        (1, "texto antes " + " ".join(a) + " texto depois"),
        (2, " ".join(a[5:25]).upper().replace(" ", " \n> ")),  # twenty words, in another dress
        (3, " ".join(a[5:20])),  # fifteen
        (4, note),
        (5, " ".join(changed)),
        (6, " ".join(a[:15]) + " no meio outra coisa qualquer que nao tem nada com isso " + " ".join(a[15:30])),
        (7, " ".join(random.Random(1).sample(a, 60))),  # the words, not the order
        (8, " ".join(a + b)),
        (9, None), (10, ""), (11, "palavra " * 50_000 + " ".join(b[:22])), (12, " ".join(a)), (12, " ".join(a)),
    ]
    c = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(bench, "item_id long, text string")
    got = {tuple(r) for r in leakage.found(c, q).collect()}
    assert got == {(1, 1), (2, 1), (5, 1), (6, 1), (8, 1), (8, 2), (11, 2), (12, 1)}
    assert leakage.found(c.limit(0), q).count() == 0 and leakage.found(c, q.limit(0)).count() == 0


def test_leakage_of_equal_items_and_parts(spark):
    a, b, c = item(1), item(2), item(3)
    shared = " ".join(item(9, 25))
    bench = [(1, " ".join(a)), (2, " ".join(a).upper()), (3, " ".join(b) + " " + shared), (4, shared + " " + " ".join(c)), (4, shared + " " + " ".join(c))]
    docs = [(1, " ".join(a[:30])), (2, shared), (3, " ".join(b)), (4, " ".join(c[20:45])), (5, " ".join(c[30:45]) + " " + " ".join(c[:15]))]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    want = {(1, 1), (1, 2), (3, 3), (4, 4)}
    for most in (10_000_000, 400, 1):  # in one part, in several, one text a part
        rows = [tuple(r) for r in leakage.found(d, q, most=most).collect()]
        assert set(rows) == want and len(rows) == len(want)


def test_leakage_of_versions_of_one_text(spark):
    a, b, c, d, e, f = (item(k) for k in range(11, 17))
    note = "Este documento foi gerado para conferencia interna e nao substitui a nota original que deve ser guardada pelo prazo previsto na lei."
    form = "na conferencia da nota {} o auditor apontou {} campos vazios e o saldo de {} reais foi levado ao processo {} que a revisora guardou na pagina {} do lote {} para {} dias de consulta do setor"
    fill = lambda k: form.format(*(f"{x}{k}" for x in range(71, 78)))
    bench = [
        (1, " ".join(a)), (2, " ".join(a[:30] + ["outra"] + a[31:])),  # one word is another
        (3, " ".join(b[:30])), (4, " ".join(b[:30] + c)),  # one stands in the other
        (5, "Leia o texto e responda.\n" + " ".join(d[:40]) + "\n" + note), (6, " ".join(d[:40]) + " qual era o valor pago no mes seguinte?"),  # other questions
        (7, " ".join(e[:25] + f[:30])), (7, " ".join(e[:25] + f[30:])),  # one item, two texts
        (8, ".".join(e[30:55])), (9, " ".join(e[30:55])),  # equal tokens; one word, and twenty-five
        (10, fill(1)), (11, fill(2)), (12, note + " " + " ".join(item(17))),
        (13, "quando o rio Tejo sobe a ponte velha fecha e os barcos esperam na margem de pedra ate que a agua baixe de novo em 1987 por tres dias"),
        (14, "quando o rio Douro sobe a ponte velha fecha e os barcos esperam na margem de pedra ate que a agua baixe de novo em 2004 por tres dias"),  # too far from each other to tell them apart by
    ]
    docs = [
        (1, " ".join(a)), (2, " ".join(b[:25])), (3, " ".join(c[:25])), (4, " ".join(d[5:35])), (5, " ".join(e[:25])), (6, " ".join(e[30:55])),
        (7, fill(1)), (8, fill(3)), (9, note), (10, bench[-2][1]), (11, " ".join(f[:30] + e[:25] + f[30:])),
    ]
    x, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    want = {(1, 1), (1, 2), (2, 3), (2, 4), (3, 4), (4, 5), (4, 6), (5, 7), (6, 9), (7, 10), (10, 13), (10, 14), (11, 7)}
    for most in (10_000_000, 700):
        rows = [tuple(r) for r in leakage.found(x, q, most=most).collect()]
        assert set(rows) == want and len(rows) == len(want)


def test_chain_brute_force():
    rnd = random.Random(6)
    for _ in range(300):
        blocks = [(rnd.randrange(12), rnd.randrange(12), rnd.randrange(1, 4)) for _ in range(rnd.randrange(0, 8))]
        want = 0
        for k in range(1 << len(blocks)):
            some = sorted((x for i, x in enumerate(blocks) if k >> i & 1), key=lambda x: (x[1], x[0]))
            if all(x[0] + x[2] <= y[0] and x[1] + x[2] <= y[1] for x, y in zip(some, some[1:])):
                want = max(want, sum(x[2] for x in some))
        assert sum(n for _, n in leakage._chained(blocks)) == want


def brute_tokens(text):
    import re
    import unicodedata

    s = "".join(x for x in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(x))
    return re.findall(r"[a-z0-9]+", s)


def test_token_hashes():
    import pyarrow as pa

    texts = ["Ação 12.345,67 fim", "fim", "", "x" * 1000, "AÇÃO fim"]
    h, start = leakage.tokens(pa.array(texts, pa.large_string()))
    words = [w for t in texts for w in brute_tokens(t)]
    assert len(h) == len(words) and list(start) == list(itertools.accumulate([len(brute_tokens(t)) for t in texts], initial=0))
    assert all((h[i] == h[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(len(words)))


def test_chunks_count_exactly():
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(["palavra", " ", "\n", "12,5", ".", "é", "\t", "don't", "  "]) for _ in range(60)) for _ in range(80)]
    for t in texts:
        assert sum(tok.count(c) for c in tok.CHUNK.findall(t)) == tok.count(t)


def test_split(spark):
    para = "Esta frase tem algumas palavras comuns. Outra frase vem depois dela, com uma virgula. "
    texts = ["# Titulo\n\n" + para * 6 + "\n\n" + para * 9 + "\n" + para * 3, "semespaco" * 400, "a " * 3000, "curto", "", None, ("linha %d\n" * 200) % tuple(range(200))]
    limits = [(1, 64, 8), (2, 256, 32)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = splitting.pieces(df, limits).collect()
    for limit, most, lap in limits:
        for d, t in enumerate(texts):
            ps = sorted((r for r in rows if r.doc_id == d and r.limit_id == limit), key=lambda r: r.piece_no)
            assert bool(ps) == (bool(t) and tok.count(t) > most)
            at = 0
            for r in ps:
                assert r.piece == t[r.begin : r.end] and tok.count(r.piece) == r.tokens <= most
                assert t[at : r.new_from].strip() == "" and r.overlap_tokens <= lap
                at = r.end
            if ps:
                assert t[at:].strip() == "" and [r.piece_no for r in ps] == list(range(len(ps)))
    kinds = [r.boundary for r in rows if r.doc_id == 0 and r.limit_id == 2]
    assert set(kinds) <= {"start", "heading", "paragraph", "line", "sentence"}


def test_merge_takes_weak_boundaries_first():
    assert splitting.merge([5, 5, 5, 5], [0, 2, 4, 2], 10) == [0, 2]
    assert splitting.merge([5, 5, 5], [0, 3, 1], 10) == [0, 1]
    assert splitting.merge([50], [0], 10) == [0]
