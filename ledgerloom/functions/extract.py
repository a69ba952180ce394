"""Typed values out of free text, as Catalyst expressions: one function a kind of field, and `typed` that chooses by field.

Each takes a text and gives the value or null. Word limits and case folding are those of Unicode.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dictionary import DEFAULT, Config
from .text import let, norm, tokens
from .values import document_mask, first_match

# Forms of values.
DOCUMENT = r"\b(?:\d{2}[.,]\d{3}\.\d{3}/\d{4}-\d{2}|\d{14}|\d{3}\.\d{3}\.\d{3}-\d{2}|\d{11})\b"
EMAIL = r"\b[^@\s]+@[^@\s]+\.[^@\s]+\b"
DATE = r"\b\d{2}/\d{2}/\d{4}\b"
MONTH = r"\b\d{2}/\d{4}\b"
MONEY = r"(?:R\$\s*)?\b\d{1,3}(?:\.\d{3})*,\d{2}\b|\b\d+\.\d{2}\b"
RATE = r"\b(?:\d{1,2},\d{1,4}%?|\d{1,2}%)"
CODE = r"\b(?:[A-Z0-9]{4,12}-[A-Z0-9]{2,12}(?:-[A-Z0-9]{2,12}){0,4}|[A-Z0-9]{5,12})\b"
SERVICE_CODES = (r"\b\d{2}\.\d{2}\.\d{2}\b", r"\b\d{1,2}\.\d{2}\b", r"\b\d{4}\b", r"\b\d{3}\b")
# Words that are no code, phrases that are headings, words that end or begin other things.
NO_CODE = ["ASSINATURA", "AUTENTICACAO", "AUTENTICIDADE", "CERTIFICACAO", "CODIGO", "CONTROLE", "DIGITAL", "DOCUMENTO", "ELETRONICA", "ELETRONICO", "ELETRONICANFSE", "FISCAL", "MODELO", "NFSE", "NFS", "NOTA", "PRESTADOR", "RPS", "SERVICO", "SERVICOS", "VALIDACAO", "VERIFICACAO"]
HEADINGS = ["de servicos", "dos servicos", "prestador de servicos", "tomador de servicos", "discriminacao do servico", "discriminacao dos servicos", "do servico", "do servicos"]
DESCRIPTION_STOPS = ["aliquota", "base", "codigo", "cofins", "deducoes", "desconto", "inss", "iss", "item", "local", "municipio", "natureza", "pis", "retencoes", "valor", "valores"]
CODE_CONTEXT = ["atividade", "cnae", "cod servico", "codigo atividade", "codigo do servico", "codigo servico", "item da lista", "lista de servico", "subitem", "subitens"]
PARTY_LABELS = r"(?iu)\b(?:cnpj|cpf|(?:nome|name)\s+fantasia|endere[çc]o|e\s*mail|email|fone|insc\.?|inscri[çc][aã]o|munic[íi]pio|telefone|uf)\b"
NAME_LABEL = r"(?iu)(?:nome|name)\s*/?\s*raz[aã]o\s+social\s*:?\s*|raz[aã]o\s+social\s*/?\s*(?:nome|name)?\s*:?\s*|(?:nome|name)\s*:?\s+"
TEXT_STOPS = {
    "operation_nature": r"(?iu)\b(?:c[óo]digo|data|emiss[aã]o|local\s+d[aeo]|valor|base\s+de\s+c[aá]lculo)\b",
    "service_city": r"(?iu)\b(?:data|c[óo]digo|natureza|valor|base\s+de\s+c[aá]lculo|iss)\b",
    "service_description": r"(?iu)\b(?:atividade|base\s+de\s+c[aá]lculo|c[óo]digo\s+do\s+servi[çc]o|informa[çc][õo]es\s+adicionais|local\s+d[aeo]|natureza|outras\s+informa[çc][õo]es|valor|vencimento)\b",
}
DESCRIPTION_LABEL = r"(?iu)^(?:descri[cç][aã]o|discrimina[cç][aã]o)(?:\s+d[oe]s?\s+servi[çc]os?)?\s*:?\s*"
EDGE = r"^[ :\-\t\r\n]+|[ :\-\t\r\n]+$"


def says(normal: Column, phrases: list[str]) -> Column:
    """Does a normal text have one of the phrases anywhere (also within a word)?"""
    return reduce(lambda a, b: a | b, [normal.contains(p) for p in phrases])


def cleaned(v: Column) -> Column:
    """Without blanks, colons and dashes at its ends, inner blanks single."""
    return F.regexp_replace(F.regexp_replace(v, EDGE, ""), r"(?U)\s+", " ")


def _head(v: Column, pattern: str) -> Column:
    """What stands before the first match."""
    return F.split(v, pattern, 2)[0]


def document(v: Column) -> Column:
    return document_mask(first_match(v, DOCUMENT))


def registration(v: Column) -> Column:
    """A municipal registration; what follows a label of the state's is cut off."""
    v = F.trim(_head(v, r"(?i)\b(?:insc\.?\s*estadual|inscricao\s+estadual|estadual)\b"))
    m = first_match(v, r"(?i)\b(?:isento|[A-Z0-9][A-Z0-9.\-/]{1,20})\b")
    return let(m, lambda m: F.when(F.lower(m) == "isento", F.upper(m)).otherwise(F.regexp_replace(m, r"^[ .:\-]+|[ .:\-]+$", "")))


def party_name(v: Column) -> Column:
    """A name up to the next label, without numbers that are none of it; at least two words."""
    v = F.regexp_replace(_head(v, PARTY_LABELS), DOCUMENT, "")
    v = F.regexp_replace(v, r"\b\d{11,14}\b$", "")
    v = F.regexp_replace(v, r"[\s:,\-]+\d[\d.\s]*$", "")
    v = F.regexp_replace(F.regexp_replace(v, r"(?U)\s+", " "), r"^[ :\-,\t\r\n]+|[ :\-,\t\r\n]+$", "")
    return let(v, lambda v: F.when(F.size(tokens(norm(v))) >= 2, v))


def inline_party_name(line: Column) -> Column:
    """The name after a name label within a line."""
    label = first_match(line, NAME_LABEL)
    return F.when(label.isNotNull(), party_name(F.substring_index(F.regexp_replace(line, "^(?s)(.*?)(?:" + NAME_LABEL.replace("(?iu)", "(?iu:") + "))", "\x01"), "\x01", -1)))


def state(v: Column) -> Column:
    return first_match(F.upper(v), r"\b[A-Z]{2}\b")


def inline_state(line: Column) -> Column:
    return F.upper(first_match(line, r"(?i)\bUF\s*:?\s*([A-Z]{2})\b", 1))


def phones(v: Column) -> Column:
    """All words of seven to eleven digits (and a trunk zero), one blank between."""
    return F.nullif(F.array_join(F.regexp_extract_all(F.replace(v, F.lit("/"), F.lit(" ")), F.lit(r"\b0?\d{7,11}\b"), 0), " "), F.lit(""))


def competence(v: Column) -> Column:
    return F.coalesce(first_match(v, MONTH), first_match(v, DATE))


def service_code(v: Column) -> Column:
    """The first of four forms whose first match is no part of a number, no law and no year."""

    def one(p: str) -> Column:
        def good(m: Column) -> Column:
            code, after = m["code"], m["after"]
            year = code.rlike(r"^\d+$") & code.try_cast("int").between(1900, 2099)
            return F.when((code != "") & ~after.isin(",", "/", ".") & ~((code == "116") & norm(v).contains("lei complementar")) & ~year, code)

        return let(F.struct(F.regexp_extract(v, f"({p})(.?)", 1).alias("code"), F.regexp_extract(v, f"({p})(.?)", 2).alias("after")), good)

    return F.when(v.rlike(r"\d(?:\d|\.)\d"), F.coalesce(*[one(p) for p in SERVICE_CODES]))  # each form has that


def money_values(v: Column) -> Column:
    """All amounts that no percent sign follows."""
    p = F.lit(f"({MONEY})(%?)")
    both = F.arrays_zip(F.regexp_extract_all(v, p, 1).alias("v"), F.regexp_extract_all(v, p, 2).alias("s"))
    return F.transform(F.filter(both, lambda x: x["s"] == ""), lambda x: F.trim(x["v"]))


def money(v: Column) -> Column:
    return F.get(money_values(v), F.lit(0))


def is_zero(v: Column) -> Column:
    """Has digits, and all are zero."""
    return v.rlike(r"\d") & ~v.rlike(r"[1-9]")


def valid_code(code: Column) -> Column:
    """Has a digit and five signs, is more than digits unless parted by hyphens, and no part is an ordinary word."""
    plain = lambda x: F.upper(F.replace(norm(x), F.lit(" "), F.lit("")))
    words = F.exists(F.split(code, "-"), lambda x: plain(x).isin(NO_CODE))
    good = lambda n: (F.length(n) >= 5) & n.rlike(r"\d") & ~n.rlike(r"^\d+$") & (code.contains("-") | n.rlike("[A-Z]")) & ~n.isin(NO_CODE)
    return let(plain(code), good) & ~words


def verification_code(v: Column) -> Column:
    """The first valid code; hyphens that blanks have set apart are joined. A link or a slash makes it none."""
    joined = F.regexp_replace(F.regexp_replace(F.upper(v), r"-\s+", "-"), r"\s+-", "-")
    codes = F.transform(F.regexp_extract_all(joined, F.lit(CODE), 0), lambda c: F.regexp_replace(c, "^-+|-+$", ""))
    return F.when(~F.lower(v).contains("http") & ~v.contains("/"), F.get(F.filter(codes, valid_code), F.lit(0)))


def note_number(v: Column) -> Column:
    """The last plain number before a date; numbers with points only where there is no other."""
    date = first_match(v, DATE)
    before = let(date, lambda d: F.when(d.isNotNull(), F.trim(F.substring(v, F.lit(1), F.position(d, v) - 1))).otherwise(v))

    def last(v: Column) -> Column:
        every = F.regexp_extract_all(v, F.lit(r"\b\d[\d.]{0,11}\b"), 0)
        of = lambda every: F.coalesce(F.try_element_at(F.filter(every, lambda x: x.rlike(r"^\d+$")), F.lit(-1)), F.try_element_at(every, F.lit(-1)))
        return F.when((v != "") & ~v.contains("/"), let(every, of))

    return let(before, last)


def _noise(name: str, normal: Column, value: Column, toks: Column) -> Column:
    """Is a service text, given with its words, no such text?"""
    letters = F.length(F.array_join(toks, ""))
    if name == "service_description":
        short = F.size(toks) < 3
        plain = F.forall(toks, lambda t: t.rlike("^[a-z]+$") & (F.length(t) >= 4) & ~t.isin(DESCRIPTION_STOPS))
        return short & ((F.size(toks) == 0) | ~plain) | says(normal, ["aliquota", "base de calculo", "informacoes relevantes", "servico local prestacao", "valor iss", "valor liquido", "valor total"])
    if name == "service_city":
        words = ["descricao do servico", "descricao dos servicos", "outras informacoes", "servico local prestacao", "aliquota", "situacao trib", "tributad", "local de prestacao", "prestacao do servico", "servicos prestados", "ervicos prestados"]
        return F.forall(toks, lambda t: t.rlike("^[0-9]+$")) | normal.isin("da prestacao do servico", "de prestacao", "do servico") | says(normal, words) | (letters < 3) | value.rlike(MONEY)
    return normal.isin("da operacao", "de operacao") | (letters < 3) | value.rlike(MONEY)


def service_text(name: str, v: Column) -> Column:
    """operation_nature, service_city or service_description: without its label, up to the next label; null where that is noise."""
    v = cleaned(v)
    if name == "service_description":
        v = F.regexp_replace(v, DESCRIPTION_LABEL, "")
    v = F.regexp_replace(_head(v, TEXT_STOPS[name]), EDGE, "")
    if name == "service_city":
        v = F.regexp_replace(F.regexp_replace(v, r"^\d{3,5}\s+", ""), EDGE, "")
    out = (lambda v: F.replace(F.regexp_replace(v, r"\s*!\s*", "/"), F.lit(" - "), F.lit("/"))) if name == "service_city" else (lambda v: v)
    noise = lambda n, v: let(tokens(n), lambda toks: _noise(name, n, v, toks))
    ok = lambda n, v: (n != "") & ~n.isin(HEADINGS) & ~noise(n, v)
    return let(v, lambda v: F.when(let(norm(v), lambda n: ok(n, v)), out(v)))


def repaired_email(v: Column) -> Column:
    """A mailbox whose @ was read as O, Q or 0; web addresses are none."""
    v = F.regexp_replace(F.trim(v), r"(?U)\s+", " ")
    out = []
    for p in (r"\b([A-Za-z0-9._%+-]{2,}?)\s+[OQ0]([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)\b", r"\b([A-Za-z0-9._%+-]{2,}?)[OQ0][)\]]?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)\b"):
        user, host = F.regexp_extract(v, p, 1), F.regexp_extract(v, p, 2)
        out.append(F.when((user != "") & ~F.lower(host).startswith("www."), F.lower(F.concat(user, F.lit("@"), host))))
    return F.coalesce(*out)


def typed(name: Column, value: Column, config: Config = DEFAULT) -> Column:
    """The value of a field in a text by the field's kind; the text itself for fields of free text; null where it has none."""
    ends = lambda x: name.endswith(x)
    return let(cleaned(value), lambda v: F.when(v != "", (
        F.when(ends("_document"), document(v))
        .when(ends("_municipal_registration"), registration(v))
        .when(name.isin("provider_name", "recipient_name"), party_name(v))
        .when(ends("_email"), first_match(v, EMAIL))
        .when(ends("_uf"), state(v))
        .when(ends("_phone"), phones(v))
        .when(name == "issue_date", first_match(v, DATE))
        .when(name == "competence_date", competence(v))
        .when(name == "service_code", service_code(v))
        .when(name == "operation_nature", service_text("operation_nature", v))
        .when(name == "service_city", service_text("service_city", v))
        .when(name == "service_description", service_text("service_description", v))
        .when(name == "iss_rate", first_match(v, RATE))
        .when(name.isin(config.money_fields), money(v))
        .when(name == "verification_code", verification_code(v))
        .when(name == "nfse_number", note_number(v))
        .otherwise(v)
    )))
