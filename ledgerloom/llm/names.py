"""Problem 6: variant spellings of company and people's names.

A noisy channel: every distinct spelling is read into a form (kind, name, line of business, legal form,
or given, middle and family name). Spellings that are written often and in full are candidate canonical
forms; a form is attached to the candidate with the greatest posterior, log prior (how often the candidate
is written) plus log likelihood (typing errors, abbreviations, lost or reordered parts). Candidates are
found by keys of one lost letter (two for long names) together with what else must agree - a line of business,
or the initials of given and middle name - so that a common family name is no block of its own, and no pair
is formed outside a family of near-equal names. Chains of attachments are followed to their end.

Odd input: null, blank and heading values are no names and link to nothing; equal strings are one spelling
however many rows have it; ties of posterior go to the smaller key; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .pii import GIVEN, NEAR_GIVEN, TITLES_SET, close
from .unicode_forms import bare_forms, normalize

# Business words with the abbreviations people use for them.
BUSINESS = {
    "servicos": "serv servico", "medicos": "med", "associados": "assoc", "comercio": "com", "informatica": "inform", "construcoes": "constr",
    "reformas": "ref", "consultoria": "cons", "tributaria": "trib", "tecnologia": "tec", "informacao": "inf", "distribuidora": "distrib",
    "papeis": "pap", "engenharia": "eng", "manutencao": "manut", "laboratorio": "lab", "analises": "anal", "industria": "ind", "alimentos": "alim",
    "transportes": "transp transporte", "rodoviarios": "rod", "seguranca": "seg", "patrimonial": "patrim", "administracao": "adm admin", "hoteleira": "hotel",
    "comunicacao": "comun", "visual": "vis", "producoes": "prod", "graficas": "graf", "sistemas": "sist", "logistica": "logist", "compartilhados": "compart",
    "representacoes": "repr", "participacoes": "part", "limpeza": "limp", "contabilidade": "contab", "advogados": "adv", "filhos": "",
}
LEGAL = {
    "ltda": "ltda", "limitada": "ltda", "eireli": "eireli", "me": "me", "microempresa": "me", "sa": "sa", "epp": "epp", "mei": "mei",
    "cia": "sa", "companhia": "sa",
}
NICKS = {
    "biel": "gabriel", "gabi": "gabriel", "cida": "aparecida", "nanda": "fernanda", "beto": "roberto", "chico": "francisco", "ze": "jose", "tiao": "sebastiao", "bia": "beatriz",
    "duda": "eduardo", "edu": "eduardo", "dani": "daniela", "rafa": "rafael", "mari": "mariana", "manu": "manuela", "lu": "luciana", "pri": "priscila", "nati": "natalia", "nat": "natalia",
    "vini": "vinicius", "leo": "leonardo", "guga": "gustavo", "gu": "gustavo", "rick": "henrique", "ric": "ricardo", "tonho": "antonio", "toninho": "antonio", "tony": "antonio", "nina": "ines",
    "lena": "helena", "leninha": "helena", "tere": "teresa", "cris": "cristina", "isa": "isabela", "bela": "isabela", "elis": "elisangela", "quim": "joaquim", "juca": "jose", "rai": "raimundo", "mundinho": "raimundo",
    "ceica": "conceicao", "dri": "adriana", "drica": "adriana", "sil": "silvana", "debi": "debora", "deb": "debora", "paulinho": "paulo", "carlinhos": "carlos", "landinho": "orlando",
    "bene": "benedito", "dito": "benedito", "val": "valdir", "ceci": "cecilia", "cica": "cecilia", "marcinha": "marcia", "paty": "patricia", "pati": "patricia", "ti": "tiago", "caco": "carlos", "tete": "teresa", "dudu": "eduardo", "wag": "wagner", "tavinho": "otavio", "re": "renata", "soninha": "sonia", "liv": "livia",
}
HEADINGS = {
    "tomador de servicos", "prestador de servicos", "razao social", "nome razao social", "nome", "cpf cnpj", "cnpj cpf", "cnpj", "cpf", "c n p j", "endereco",
    "inscricao municipal", "municipio", "discriminacao dos servicos", "nota fiscal", "nota fiscal eletronica de servicos", "dados do prestador", "dados do tomador",
    "e mail", "telefone", "valor total", "codigo de verificacao", "numero da nota", "data de emissao", "nome empresarial", "prestador", "tomador", "descricao dos servicos", "valor liquido",
    "documento", "uf", "cep", "competencia", "natureza da operacao", "base de calculo",
}
SMALL = {"de", "da", "do", "das", "dos", "e", "em"}
ABBREV = {a: w for w, xs in BUSINESS.items() for a in [w, *xs.split()]}
HEADING_WORDS = {w for h in HEADINGS for w in h.split()}
_near_business: dict[str, list[str]] = {}
for _w in BUSINESS:
    if len(_w) >= 5:
        for _i in range(len(_w)):
            _near_business.setdefault(_w[:_i] + _w[_i + 1 :], []).append(_w)
for _a in [a for a in ABBREV if len(a) >= 5 and a not in BUSINESS]:
    for _i in range(len(_a)):
        _near_business.setdefault(_a[:_i] + _a[_i + 1 :], []).append(_a)
    _near_business.setdefault(_a, []).append(_a)
MIN_LOG = -12.0  # a form less likely than this under every candidate stays its own
FIELDS = ["kind", "name", "given", "middle", "biz", "legal", "flat"]


def deletes(w: str) -> list[str]:
    """The word and all words with one letter less."""
    return [w] if len(w) < 5 else list(dict.fromkeys([w, *(w[:i] + w[i + 1 :] for i in range(len(w)))]))


def deletes2(w: str) -> list[str]:
    """deletes, and for words of eight letters or more (where two errors are allowed) those with two letters less."""
    one = deletes(w)
    return one if len(w) < 8 else list(dict.fromkeys([*one, *(x[:i] + x[i + 1 :] for x in one[1:] for i in range(len(x)))]))


def blocks_of(f: dict) -> tuple[set[str], set[str]]:
    """(keys of a form as one to be explained, keys of it as a candidate): a candidate that explains a form shares one.

    A firm must have the form's lines of business among its own: the form asks for its first, the candidate answers for
    each. A person must have the form's given initial (or, if that was mistyped, the rest of the given name) and its
    first middle initial if it has one. Forms without a line of business also meet by all their letters in a row.
    """
    asks: set[str] = set()
    answers: set[str] = set()
    if f["kind"] == "f":
        own = f["biz"].split()
        for k in deletes2(f["name"]):
            asks.add(f"f{k}|{own[0] if own else ''}")
            answers.update(f"f{k}|{b}" for b in ("", *own))
    else:
        middle = f["middle"].split()
        first = middle[0][:1] if middle else ""
        given = f["given"]
        heads = {given[:1], "~" + given[1:], "~" + given} if len(given) > 3 else {given[:1]}
        for k in deletes2(f["name"]):
            for g in heads:
                asks.add(f"p{k}|{g}|{first}")
                answers.add(f"p{k}|{g}|")
                if first:
                    answers.add(f"p{k}|{g}|{first}")
    if not f["biz"]:
        flat = {" " + k for k in deletes(f["flat"])}
        asks |= flat
        answers |= flat
    return asks, answers


def distance(a: str, b: str, most: int = 2) -> int:
    """Letters added, lost, changed or swapped with the next (optimal string alignment); most + 1 where it is more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    prev2: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            d = min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, prev2[j - 2] + 1)
            cur.append(d)
        if min(cur) > most:
            return most + 1
        prev2, prev = prev, cur
    return prev[-1]


def business_word(t: str) -> str | None:
    """The business word that a token is, abbreviates or mistypes."""
    if t in ABBREV:
        return ABBREV[t]
    if len(t) >= 5:
        for k in deletes(t):
            for w in _near_business.get(k, ()) if k not in BUSINESS else (k,):
                if distance(t, w, 1) <= 1:
                    return ABBREV[w]
    elif len(t) >= 3:  # a mistyped abbreviation
        for a, w in ABBREV.items():
            if 3 <= len(a) <= 5 and a != w and abs(len(a) - len(t)) <= 1 and distance(a, t, 1) == 1 and len(t) >= 3:
                return "?" + w
    return None


def read_form(low: str, raw: str) -> tuple[str, ...] | None:
    """FIELDS of a name in bare lower case; None for headings and blanks."""
    s = low.replace("(a)", " ").replace("s/a", " sa ").replace("s. a.", " sa ").replace("&", " e ")
    comma = s.find(",")
    words: list[str] = []
    dotted: list[bool] = []
    cut_at = -1
    for part in s.replace(",", " , ").replace("-", " ").replace("/", " ").split():
        if part == ",":
            cut_at = len(words)
            continue
        t = part.strip(".;:'\"()[]*_")
        if t.count(".") and t.replace(".", "") in ("ltda", "sa", "me", "eireli", "epp"):
            t = t.replace(".", "")
        for x in t.split(".") if "." in t else [t]:
            x = "".join(c for c in x if c.isalnum())
            if x:
                words.append(x)
                dotted.append(part.endswith(".") or "." in t)
    if not words:
        return None
    plain = " ".join(words)
    if plain in HEADINGS or all(w in HEADING_WORDS or w in SMALL for w in words):
        return None
    if " ".join(words[-2:]) == "sociedade anonima" and len(words) > 2:
        words, dotted = [*words[:-2], "sa"], [*dotted[:-2], False]
    legal: list[str] = []
    biz: list[str] = []
    core: list[tuple[str, int, bool]] = []
    i = 0
    while i < len(words):
        w = words[i]
        if w == "sociedade" and i + 1 < len(words) and distance(words[i + 1], "anonima", 1) <= 1:
            legal.append("sa")
            i += 2
            continue
        if w in LEGAL or len(w) >= 6 and any(distance(w, x, 1) <= 1 for x in ("limitada", "eireli", "microempresa")):
            legal.append(LEGAL.get(w) or LEGAL[next(x for x in ("limitada", "eireli", "microempresa") if distance(w, x, 1) <= 1)])
        elif w in SMALL and not (w == "e" and (dotted[i] or i == 0)):
            pass
        else:
            core.append((w, i, dotted[i]))
        i += 1
    titled = False
    while core and core[0][0] in TITLES_SET and len(core) > 1 and core[0][0] not in ABBREV:
        core.pop(0)
        titled = True
    rest = []
    firm = bool(legal)
    for w, at, dot in core:
        b = business_word(w)
        if b and not b.startswith("?"):
            biz.append(b)
        elif b and (dot and not titled and len(w) > 1):
            biz.append(b[1:])
        else:
            rest.append((w, at, dot))
    if titled or cut_at > 0 and not legal or (not legal and not biz and len(rest) >= 2 and _personal(rest)):
        if cut_at > 0:
            rest = [x for x in core if x[1] >= cut_at] + [x for x in core if x[1] < cut_at]
            rest = [x for x in rest if x[0] not in TITLES_SET] or rest
        else:
            rest = core
        return _person([x[0] for x in rest], cut_at > 0)
    if not rest:
        return None
    if not firm and not biz and len(rest) >= 2:
        # neither given name nor business word: a split name or an unknown person
        return _person([x[0] for x in rest], False)
    if any(len(x[0]) > 1 for x in rest):
        rest = [x for x in rest if len(x[0]) > 1 or not biz]
    name = "".join(x[0] for x in rest)
    return ("f", name, "", "", " ".join(sorted(set(biz))), legal[0] if legal else "", name)


def _personal(rest: list) -> bool:
    known = set(GIVEN) | set(NICKS)
    ws = [x[0] for x in rest]
    return any(w in known or len(w) == 1 for w in ws) or close(ws[0], GIVEN, NEAR_GIVEN) or close(ws[-1], GIVEN, NEAR_GIVEN)


def _given(w: str) -> bool:
    return w in GIVEN or w in NICKS


def _person(ws: list[str], swapped: bool) -> tuple[str, ...] | None:
    if len(ws) < 2:
        return None if not ws else ("f", ws[0], "", "", "", "", ws[0])
    if not swapped and not _given(ws[0]) and len(ws[0]) > 1:
        if len(ws[-1]) == 1 and not close(ws[0], GIVEN, NEAR_GIVEN):
            ws = [ws[-1], *ws[:-1]]  # surname and initial
        elif _given(ws[-1]) and not close(ws[0], GIVEN, NEAR_GIVEN):
            ws = [ws[-1], *ws[:-1]] if len(ws) == 2 else [ws[-1], *ws[1:-1], ws[0]]
        elif len(ws) == 2 and close(ws[-1], GIVEN, NEAR_GIVEN) and not close(ws[0], GIVEN, NEAR_GIVEN):
            ws = [ws[-1], ws[0]]
        elif len(ws) >= 3 and not close(ws[0], GIVEN, NEAR_GIVEN) and (_given(ws[1]) or close(ws[1], GIVEN, NEAR_GIVEN)):
            ws = [*ws[1:], ws[0]]  # surname first, no comma
    given = NICKS.get(ws[0], ws[0]) if ws[0] not in GIVEN else ws[0]
    return ("p", ws[-1], given, " ".join(ws[1:-1]), "", "", "".join(ws))


def likelihood(form: dict, cand: dict) -> float:
    """log P(form is written | candidate is meant); -inf where it cannot be."""
    no = -math.inf
    if form["flat"] == cand["flat"] and not (form["biz"] or cand["biz"]) and (form["kind"] != cand["kind"] or form["kind"] == "p"):
        return -3.0  # a blank typed inside a word
    if form["kind"] == cand["kind"] == "p" and len(form["flat"]) >= 10 and form["middle"].count(" ") != cand["middle"].count(" ") or bool(form["middle"]) != bool(cand["middle"]):
        if len(form["flat"]) >= 10 and not (form["biz"] or cand["biz"]) and distance(form["flat"], cand["flat"], 1) <= 1:
            return -8.0
    if form["kind"] != cand["kind"]:
        return no
    errors, log = 0, 0.0
    d = distance(form["name"], cand["name"])
    if d > 2 or d == 2 and min(len(form["name"]), len(cand["name"])) < 8 or d == 1 and min(len(form["name"]), len(cand["name"])) < 5:
        return no
    errors += d
    log -= 4.0 * d
    if form["kind"] == "f":
        a, b = set(form["biz"].split()), set(cand["biz"].split())
        if not a <= b:
            return no
        log -= 0.0 if a == b else 1.0 if a else 2.5
        if form["legal"] != cand["legal"]:
            if form["legal"] and cand["legal"]:
                return no
            log -= 0.7
        if d and not a:
            log -= 2.0
        if d == 2 and a != b:
            return no
    else:
        g, h = form["given"], cand["given"]
        if g != h:
            if len(g) == 1:
                if g != h[:1]:
                    return no
                log -= 1.5
            elif len(h) == 1:
                return no
            else:
                e = distance(g, h)
                if e > 1 and not (e == 2 and min(len(g), len(h)) >= 7) or min(len(g), len(h)) < 4 or g in GIVEN and h in GIVEN:
                    return no
                errors += e
                log -= 4.0 * e
        x, y = form["middle"].split(), cand["middle"].split()
        if x != y:
            if not x:
                log -= 1.0
            elif len(x) > len(y):
                return no
            else:
                for p, q in zip(x, y):
                    if p == q:
                        continue
                    if len(p) == 1 and p == q[:1]:
                        log -= 0.7
                    elif len(q) > 1 and min(len(p), len(q)) >= 4 and distance(p, q, 1) == 1 and errors == 0:
                        errors += 1
                        log -= 4.0
                    else:
                        return no
                if len(x) < len(y):
                    log -= 1.0
        if errors and len(g) == 1:
            log -= 3.0
    if errors > 2:
        return no
    if errors and len(form["name"]) < 7 and form["n"] > 2 and form["n"] * 3 > cand["n"]:
        return no  # a short name, written in too many documents to be an error
    return log


def rank_of(f: dict) -> tuple:
    """Candidates come before what they can explain: fuller forms first, then more frequent ones."""
    if f["kind"] == "f":
        full = (len(f["biz"].split()), bool(f["legal"]), 0)
    else:
        full = (f["given"] in GIVEN, len(f["given"]) > 1, sum(2 if len(m) > 1 else 1 for m in f["middle"].split()))
    return (*map(int, full), f["n"], f["key"])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df by keys over three tasks for each core: the work on a spelling is large against its bytes, by which tasks would else be put together."""
    return df.repartition(3 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def spellings(df: DataFrame, value: str = "value", unit: str = "document_id") -> DataFrame:
    """(value, n, key, kind, name, given, middle, biz, legal) of every distinct spelling that is a name.

    n counts documents (column unit), not rows: one typing error is often repeated within a document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            normal = normalize(b.column("value"))[0]
            low = bare_forms(normal)[0].to_pylist()
            rows = [read_form(x, r) for x, r in zip(low, normal.to_pylist())]
            keep = [i for i, r in enumerate(rows) if r and r[1]]
            cols = [pa.array([rows[i][j] for i in keep], pa.string()) for j in range(len(FIELDS))]
            keys = pa.array(["|".join(rows[i][:6]) for i in keep], pa.string())
            at = pa.array(np.array(keep, np.int64))
            yield pa.RecordBatch.from_arrays([b.column("value").take(at), b.column("n").take(at), keys, *cols], names=["value", "n", "key", *FIELDS])

    once = df.filter(F.col(value).isNotNull()).select(F.col(value).alias("value"), F.col(unit)).distinct()
    counted = spread(once.groupBy("value").agg(F.count("*").alias("n")), "value")
    return counted.mapInArrow(run, "value string, n long, key string, " + ", ".join(f"{c} string" for c in FIELDS))


def attach(forms: DataFrame) -> DataFrame:
    """(key, parent): the best candidate of each form, itself where none explains it. forms: key, n and FIELDS."""
    cols = ["key", "n", *FIELDS]

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            idx, keys, asked = [], [], []
            for i, f in enumerate(b.select(FIELDS).to_pylist()):
                asks, answers = blocks_of(f)
                idx += [i] * (len(asks) + len(answers))
                keys += [*asks, *answers]
                asked += [True] * len(asks) + [False] * len(answers)
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(idx, pa.int64())), pa.array(keys, pa.string()), pa.array(asked, pa.bool_())], names=["id", "block", "asks"])

    # keys and forms are joined by their hashes (two keys of one hash only mean a comparison more); near-equal names share
    # most of their keys, so pairs are made once before the forms are joined to them
    known = cut(spread(forms.select(F.xxhash64("key").alias("id"), *cols), "id"))
    blocked = known.select("id", *FIELDS).mapInArrow(block, "id long, block string, asks boolean").select("id", F.xxhash64("block").alias("block"), "asks")
    blocked = cut(blocked)
    left = spread(blocked.filter("asks").drop("asks"), "block")
    right = spread(blocked.filter("not asks").select(F.col("id").alias("c_id"), "block"), "block")
    once = left.join(right, "block").filter("id <> c_id").select("id", "c_id").distinct()
    both = spread(once, "id").join(known, "id")
    pairs = spread(both, "c_id").join(known.select(F.col("id").alias("c_id"), *[F.col(c).alias("c_" + c) for c in cols]), "c_id")
    # of the spellings under one key only those that could explain the other are compared
    pairs = pairs.filter("key <> c_key and (kind = 'p' or (legal = '' or c_legal = '' or legal = c_legal))").select(*cols, *["c_" + c for c in cols])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            best: dict[str, tuple[float, str]] = {}
            for r in rows:
                form = {c: r[c] for c in cols}
                cand = {c: r["c_" + c] for c in cols}
                if rank_of(cand) <= rank_of(form):
                    continue
                log = likelihood(form, cand)
                if log < MIN_LOG:
                    continue
                post = (log + math.log(cand["n"]), cand["key"])
                old = best.get(form["key"])
                if old is None or post[0] > old[0] or post[0] == old[0] and post[1] < old[1]:
                    best[form["key"]] = post
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.string()), pa.array([-x[0] for x in best.values()], pa.float64()), pa.array([x[1] for x in best.values()], pa.string())], names=["key", "cost", "parent"]
            )

    scored = pairs.mapInArrow(score, "key string, cost double, parent string")
    best = scored.groupBy("key").agg(F.min(F.struct("cost", "parent"))["parent"].alias("parent"))
    return forms.select("key").join(best, "key", "left").select("key", F.coalesce("parent", "key").alias("parent"))


def roots(link: DataFrame) -> DataFrame:
    """(key, parent) with every chain of parents followed to its end. link: a parent outranks its child, so there is no cycle.

    Each round doubles the way and is written to the shared folder; it ends when no parent has a parent of its own.
    """
    while True:
        up = link.filter("key <> parent").select(F.col("key").alias("parent"), F.col("parent").alias("grand"))
        link = cut(link.join(up, "parent", "left").select("key", F.coalesce("grand", "parent").alias("parent"), F.col("grand").isNotNull().alias("moved")))
        if link.filter("moved").isEmpty():
            return link.drop("moved")


def entities(df: DataFrame, value: str = "value") -> DataFrame:
    """(value, entity): the canonical key of every spelling of a name."""
    words = cut(spellings(df, value))
    forms = words.groupBy("key").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in FIELDS])
    link = roots(cut(attach(forms)))
    return words.join(link, "key").select("value", F.col("parent").alias("entity"))


def found(df: DataFrame) -> DataFrame:
    """(value_1, value_2): distinct pairs of spellings of one entity. df: rows with a value column."""
    ent = cut(entities(df))
    a = ent.select("entity", F.col("value").alias("value_1"))
    b = ent.select("entity", F.col("value").alias("value_2"))
    return a.join(b, "entity").filter("value_1 < value_2").select("value_1", "value_2")


def names_of(candidates: DataFrame) -> DataFrame:
    return candidates.filter(F.col("field_name").isin("provider_name", "recipient_name")).select("value", "document_id")
