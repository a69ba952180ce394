"""Problem 1: personal information in free text, replaced by typed placeholders with linked pseudonyms.

`spans` finds e-mail addresses, phone numbers, identity numbers, street addresses and people's names.
`redact` writes `[TYPE pseudonym]` in their place and leaves everything else as it was. Pseudonyms are
format-preserving: digits go through a keyed Feistel permutation of their own length, so an equal number
has an equal pseudonym in every document, whatever its notation; a number with valid check digits keeps
valid ones; dates of birth are permuted among real dates. Texts (names, mailboxes, streets) are linked by
a keyed permutation of 128 bits of their normalised form, a space in which different texts do not meet.
`found` reads its rows off the placeholders that the redaction of a text has written. The key is the
caller's: there is no default, and without it nothing can be undone.

Odd input: null stays null; blank and empty texts are unchanged; long texts are read whole; repeated
rows give equal results; extra columns are kept by `redacted`, a clash with its output column is an error.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import hmac
import math
import re
import secrets
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import MEMO, explode_masks, flag_masks
from .unicode_forms import Tables, bare_forms, normalize

KINDS = ["email", "phone", "id_number", "address", "name"]

# Common Brazilian given names and short forms, without accents.
GIVEN_NAMES = """
adriana alberto alessandra alexandre alice aline amanda ana anderson andre andrea antonia antonio aparecida augusto beatriz benedito
bernardo bruna bruno caio camila carla carlos carolina cecilia celia celso claudia claudio conceicao cristiane cristina daniel daniela
danilo david debora denise diego edson eduardo elaine eliane elisangela emerson fabiana fabio fatima felipe fernanda fernando flavia
flavio francisca francisco gabriel gabriela geraldo gilberto giovana guilherme gustavo helena heloisa henrique ines isabel isabela ivan
joana joao joaquim jorge jose juliana julio karina larissa laura leandro leonardo leticia livia lucas lucia luciana luciano luis luiz
luiza manoel manuela marcelo marcia marcio marcos margarida maria mariana marina mario marta mateus maria mauricio miguel monica
natalia nelson olga orlando otavio patricia paula paulo pedro priscila rafael raimundo regina renata renato ricardo roberta roberto
rodrigo rogerio rosa sandra sebastiao sergio silvana silvia simone sonia tatiana teresa tereza thiago tiago valdir valeria vanessa
vera vicente vinicius vitor viviane wagner wellington yara zelia
"""
NICKNAMES = "biel cida nanda beto chico ze tiao bia duda dani rafa malu toninho zeca gabi lena cris leo guga tati vini rick fran manu lu pri nat beca sil quim"
TITLES = "sr sra dr dra prof profa eng adv pe cel dona dom doutor doutora padre coronel"
STREETS = "rua avenida alameda travessa praca largo rodovia estrada"
#: Words that mark an institution or company when they stand near a name.
FIRM = """
ltda limitada eireli me sa microempresa sociedade anonima servicos serv comercio com industria ind alimentos alim construcoes constr reformas
ref consultoria cons tributaria trib tecnologia tec informacao inf informatica inform distribuidora distrib papeis engenharia eng manutencao manut
laboratorio lab analises anal transportes transp rodoviarios rod seguranca seg patrimonial patrim administracao adm hoteleira hotel comunicacao
comun visual producoes prod graficas graf medicos med associados assoc sistemas logistica filhos instituto padaria fundacao colegio escola
igreja hospital clinica banco prefeitura associacao cooperativa empresa contratada fornecedor mercado posto farmacia
"""
#: Ordinary words that follow a label or a given name but belong to no name.
PLAIN = """
em pelo pela por para com no na nos nas ao aos que se sao cpf cnpj rg tel telefone fone cel email e-mail correio eletronico endereco end municipio uf
inscricao municipal cep razao social nome nota fiscal valor numero codigo data emissao prestador tomador passaporte portador
reserva setor saida conta aprovado conferido taxa parcela documento pedido horas o a os as um uma esta este cobranca cancelamento assinatura
desconto materiais equipamento foram instalacao competencia prestacao reembolso registro revisao medicao atendimento locacao havendo favor
duvidas beneficiario motorista hospede socio responsavel retirada copia enviar assinado aos contato correspondencia cada total liquido bruto
imposto aliquota base calculo natureza operacao descontos retencoes federais verificacao autenticidade discriminacao descricao
diferenca contratada empresa campo laudo prestador pagamento documentos valores chave conforme falar usuario relatorio demonstrativo pagina folha
servico services batch the license supplier rev de da do das dos e ref street suite
"""


ACCENTS = {c: unicodedata.normalize("NFD", chr(c))[0] for c in range(0xC0, 0x250) if unicodedata.decomposition(chr(c))[:1] not in ("", "<")}


def bare(s: str) -> str:
    """Lower case without accents; as long as s."""
    return s.lower() if s.isascii() else s.translate(ACCENTS).lower()


GIVEN = set(GIVEN_NAMES.split())
NICK = set(NICKNAMES.split())
FIRMS = set(FIRM.split())
PLAINS = set(PLAIN.split())
CONNECT = {"de", "da", "do", "das", "dos", "e"}
INSTITUTE = {"instituto", "padaria", "fundacao", "colegio", "escola", "hospital", "setor", "bairro", "igreja", "clinica", "sistema", "plataforma", "projeto", "equipamento"} | set(STREETS.split())
ALLSTREET = {"av", "al", "tv", "pca", "r", "rod"}


#: Words that a sentence has and an address has not.
SENTENCE = {"que", "para", "foi", "foram", "deve", "devem", "sera", "serao", "esta", "este", "pelo", "pela", "conforme", "sao", "informado", "cadastrado", "acima", "abaixo", "pagamento", "emissao", "data", "nota", "fiscal", "servico", "servicos", "valor"}


def _near(words: set[str]) -> dict[str, str]:
    out: dict[str, str] = {}
    for w in words:
        if len(w) >= 5:
            for i in range(len(w)):
                out.setdefault(w[:i] + w[i + 1 :], w)
    return out


NEAR_GIVEN, NEAR_FIRM = _near(GIVEN), _near({w for w in FIRMS if len(w) >= 6})


def close(w: str, words: set[str], near: dict[str, str]) -> bool:
    """w is one of the words, or one letter added, lost, changed or swapped away from one."""
    if w in words:
        return True
    if len(w) < 4:
        return False
    if w in near:
        return True
    for i in range(len(w)):
        d = w[:i] + w[i + 1 :]
        if d in words and len(d) >= 5:
            return True
        if d in near:
            x = near[d]
            if len(x) == len(w):
                diff = [k for k in range(len(w)) if x[k] != w[k]]
                if len(diff) == 1 or len(diff) == 2 and diff[1] == diff[0] + 1 and x[diff[0]] == w[diff[1]] and x[diff[1]] == w[diff[0]]:
                    return True
    return False


# Patterns.
#: Top domains of addresses without an @: the common generic ones, those of Portuguese-speaking and neighbouring countries, and the reserved ones.
_DOM = r"(?:com|net|org|gov|edu|info|biz|app|dev|adv|eng|ind|br|pt|ao|mz|ar|uy|py|cl|us|uk|eu|io|me|co|tv|test|example|invalid|localhost)"
#: Mailboxes of roles, which companies use whatever their name.
_ROLE = r"(?:nfe|nfse|nf|contato|contact|financeiro|fiscal|faturamento|cobranca|contabil|contabilidade|comercial|vendas|compras|atendimento|suporte|support|sac|rh|adm|administrativo|diretoria|secretaria|info|sales|billing|admin|noreply|ouvidoria)"
EMAILS = [
    re.compile(r"[\w.+%-]+ ?[@©] ?[\w-]+(?:[.,][\w-]+)+"),
    re.compile(r"[\w.+%-]+\s*[(\[{<]\s?(?:arr?oba|at|a|@)\s?[)\]}>]\s*[\w-]+(?:\.[\w-]+|\s*[(\[]?\b(?:ponto|dot)\b[)\]]?\s*[\w-]+)+", re.I),
    re.compile(r"\b[\w.+%-]+ (?:arroba|at) [\w-]+(?: ?(?:\.| ponto | dot ) ?[\w-]+)*(?:\.| ponto | dot )" + _DOM + r"\b", re.I),
    re.compile(r"(?<![\w@.])[a-z0-9._+-]{2,}[QOG0][a-z0-9-]{2,}(?:\.[a-z0-9-]+)*\." + _DOM + r"(?![\w])"),
    re.compile(r"(?i:e-?mai[l1i]|corre[il1!]o e[l1i]etr[ôo0]n[il1!]co)\W{0,6}([\w.+-]+(?:\.[\w-]+)*\." + _DOM + r")\b", re.I),
    re.compile(r"(?i:e-?mai[l1i]|corre[il1!]o e[l1i]etr[ôo0]n[il1!]co)\W{0,6}([\w.+-]+ [QOG0] [\w-]+(?:\.[\w-]+)*\." + _DOM + r")\b"),
    re.compile(r"(?<![\w@.])" + _ROLE + r"[QOG0a][a-z0-9-]{3,}(?:\.[a-z0-9-]+)*\." + _DOM + r"(?![\w])", re.I),
    re.compile(r"(?<![\w@.])(?:nfe|contato|financeiro|faturamento|cobranca|atendimento)[a-z0-9-]{3,}(?:\.[a-z0-9-]+)*\." + _DOM + r"(?![\w])", re.I),
]
PHONE = re.compile(r"(?<![\w.,/-])(?<!\d )(?:\+ ?55[ -]?)?(?:\(0?\d{2}\) ?|\(0[xX]{2}\d{2}\) ?|0[xX]{2} ?\d{2}[ -]?|0?\d{2}[ -.]|0?\d{2} - )9? ?\d{4}[ .-]?\d{4}(?![\d/])(?!-\d)(?![.,]\d)(?! \d{4}\b)")
PHONE_BARE = re.compile(r"(?<![\w.,/-])(?<!\d )(?:\+?55)?0?[1-9]\d9?\d{8}(?![\w/])(?!-\d)(?![.,]\d)")
PHONE_LOCAL = re.compile(r"(?i:tel(?:efone)?|fone|cel(?:ular)?|whatsapp|ligar para)\W{1,4}(9?\d{4}[ .-]?\d{4})(?!\d)")
CPF = re.compile(r"(?<![\w.,/-])(?<!\d )\d{3} ?[.,]? ?\d{3} ?[.,]? ?\d{3}(?: ?- ?| ?/ ?)\d{2}(?![\w/-])|(?<![\w.,/-])\d{3}[.,]\d{3}[.,]\d{3} \d{2}(?!\d)|(?<![\w.,/-])\d{3} \d{3} \d{3} ?-? ?\d{2}(?![\w/-])(?! \d)")
CNPJ = re.compile(r"(?<![\w.,/-])\d{2} ?[.,]? ?\d{3} ?[.,]? ?\d{3} ?/ ?\d{4}(?: ?- ?| )?\d{2}(?![\w/])")
BARE_ID = re.compile(r"(?<![\w.,/-])(?<!\d )(?:\d{14}|\d{11})(?![\w/-])(?![.,]\d)")
ID_LABEL = re.compile(r"(?:C ?\.? ?P ?\.? ?F|C ?\.? ?N ?\.? ?P ?\.? ?J|Usu[áa]rio|USU[ÁA]RIO)\.?(?: ?/ ?(?:C\.?N\.?P\.?J|C\.?P\.?F)\.?)?\W{0,6}(?:n[º°o.]{0,2} ?)?$", re.I)
RG = re.compile(r"\b(?:R\.?G\.?|identidade|passaporte|passport|RNE)\W{0,4}(?:n[º°o.]?[º°]? ?)?((?:[A-Z]{0,2} ?\d[\d. ]{5,12}\d(?: ?- ?[\dXx])?|[A-Z]{2} ?\d{6})(?![\d]))", re.I)
ADDRESS = re.compile(
    r"(?<![\w.])(?:(?:Rua|Avenida|Av|Alameda|Travessa|Tv|Pra[çc]a|P[çc]a|Largo|Rodovia|Estrada)\.?|Rod\.|Al\.|R\.)\s+(?:(?:d[aeo]s?|e)\s+)?(?:[^\W\d_]+\.?\s+){0,4}?[^\W\d_]{2,}\.?\s*(?:,|n[º°o]\.?|N[º°o]\.?)?\s*(?:n[º°o]\.?\s*|N[º°]\s*)?(?:\d{1,5}\b(?!/\d)|s/n|S/N)(?!\s*de\b)"
    r"|\bQuadra\s+\d+\s+Lote\s+\d+(?:,?\s*Setor\s+(?:(?:Dona|Doutora?|Padre|Coronel|Prof|Pe|Cel|Dr)\.?\s+[^\W\d_]+\s+)?[^\W\d_]+)?"
    r"|(?<![\w.,/-])\d{1,5}\s+(?:d[aeo]s?\s+)?(?:[^\W\d_]+\.?\s+){1,4}Street(?:,?\s*Suite\s+\d+)?",
    re.I,
)
# a street's name of any length, if it is written as a name
ADDRESS_LONG = re.compile(r"(?<![\w.])(?i:rua|avenida|alameda|travessa|pra[çc]a|largo|rodovia|estrada|av\.|tv\.|p[çc]a\.)\s+(?:(?:[A-ZÀ-Ú][^\W\d_]*\.?|d[aeo]s?|D[AEO]S?|e|E)\s+)*+(?<=\s)(?:[A-ZÀ-Ú][^\W\d_]*\.?)?(?:(?<=[^\W\d_])\s*,\s*|\s*)(?:[nN][º°o]\.?\s*)?\d{1,5}\b(?!/\d)")
# without a number the name must be written as a name
ADDRESS_NAME = re.compile(r"(?<![\w.])(?:(?:Rua|Avenida|Alameda|Travessa|Praça|Pça\.|Rodovia|Estrada|Av\.|Tv\.)|(?:RUA|AVENIDA|ALAMEDA|TRAVESSA|PRAÇA|PÇA\.|RODOVIA|ESTRADA|AV\.|TV\.)) (?:(?:d[aeo]s?|D[AEO]S?) )?(?!(?:de|DE) )[A-ZÀ-Ú][\w.]+")
ADDRESS_LABEL = re.compile(r"(?<!\w)(?:Endere[çc]o|End\.|ENDERE[ÇC]O|E[nm]c?[l1]?dere[çc]o|Endcre[çc]o|Enderc[çc]o|Endereç0)\s*(?::|-)?\s*((?!eletr)[^\W\d_][^:;?!|\d]+\d\w*|\d+ [^\W\d_]+ [^:;?!|\d]*)")
ADDRESS_HINT = re.compile(r"\b(?:rua|av|avenida|al|alameda|tv|travessa|pca|praca|largo|rod|rodovia|estrada|quadra|r)\b|street|end\.|e[nm].{0,3}.rec|dere[cg]")
# over the bare text
CONTEXT = re.compile(r"(?:cuidados de|falar com|aprovado por|conferido por|responsavel tecnico\W{1,4}|beneficiario\W{1,4}|socio administrador|hospede|recebido por|conversado com|encaminhadas a|digitalmente por|motorista)\s+")
LABEL = re.compile(r"(?:(?<!\w)n[o0c](?:[mn]|rn)[ec](?:\s?/\s?r?[a-z0]{2,4}o s[o0][ce][i1l!a]{1,2}[l1])?|(?<!\w)raza[o0] s[o0][ce][i1l!]a[l1])\s*[:\-–]?\s+")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?(?:\(a\))?\.?|[,&/()\d:;@-]|\S")
BLANK = re.compile(r"</?[A-Za-z!][^<>]*>|&#?\w+;|\*\*|~~|```|''+|\[\[|\]\]|\{\{|\}\}|\\[A-Za-z]+\*?|[|`{}]|\]\(#\w+\)")


def _blank(m: re.Match) -> str:
    return " " * (m.end() - m.start())


HYPHEN = re.compile(r"(?<=[^\W\d_])[-‐¬]\s*\n\s*(?=[a-zà-ú])|(?<=[A-ZÀ-Ú])[-‐¬]\s*\n\s*(?=[A-ZÀ-Ú]{2})")


def detection_text(text: str) -> str:
    """As long as text; markup signs, line breaks and other blanks become spaces."""
    if BLANK_HINT.search(text) and BLANK.search(text):
        text = BLANK.sub(_blank, text)
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ")


def _cut_firm(m: re.Match, b: str) -> bool:
    """Is the word the cut beginning of a company word?"""
    tail = m.string[m.end() : m.end() + 1]
    return tail in ("-", "‐", "¬") and any(f.startswith(b) for f in FIRMS)


NO_PERSON = re.compile(r"C ?\.? ?N ?\.? ?P ?\.? ?J\b|C ?\.? ?P ?\.? ?F\b", re.I)
LEGAL_FORM = re.compile(r"\bS ?\.A\b|\bS ?/ ?A\b|\bM\.E\b|\bE\.I\.R\.|\bL\.T\.D\.", re.I)


def _person(words: list[re.Match], i: int, loose: bool, reach: int = 6) -> tuple[int, int] | None:
    """The name that begins at word i: (first, one past last) word, or None.

    Its first `reach` words decide whether it is one; it goes on as far as its lettering does.
    """
    n = len(words)
    if i < n and NO_PERSON.match(words[i].string, words[i].start()):
        return None
    j = i
    while j < n and bare(words[j].group().rstrip(".").replace("(a)", "")) in TITLES_SET:
        j += 1
    titled = j > i
    seq: list[tuple[int, str, str]] = []
    k = j
    while k < n and len(seq) < reach:
        w = words[k].group()
        b = bare(w.rstrip("."))
        after = words[k].string[words[k].end() : words[k].end() + 1]
        if loose and after and (after.isdigit() or after == "!") and b[:1].isalpha():
            return None  # a word with a misread sign: a company's line of business, or no name
        if not b or not b[0].isalpha():
            if w == "," and seq and loose and k == j + 1 and k + 1 < n and close(bare(words[k + 1].group()), GIVEN | NICK, NEAR_GIVEN):
                seq.append((k, ",", ","))
                k += 1
                continue
            if w in "&/" and seq:
                seq.append((k, w, "&"))
            break
        if b in CONNECT and not w[0].isupper() or b in CONNECT and w.isupper():
            if not seq:
                return None
            seq.append((k, w, "+"))
            k += 1
            continue
        if b in PLAINS or (k > j and b in FIRMS and len(b) > 1):
            if b in FIRMS and b not in ("com",):
                seq.append((k, w, "F"))
            break
        seq.append((k, w, b))
        k += 1
    whole = len(seq) >= reach  # the words were cut by reach only
    if any(x[2] in ("F", "&") or len(x[2]) > 3 and close(x[2], FIRMS, NEAR_FIRM) and not close(x[2], GIVEN, NEAR_GIVEN) for x in seq):
        return None
    while seq and seq[-1][2] in ("+", ","):
        seq.pop()
    real = [x for x in seq if x[2] not in ("+", ",")]
    if len(real) < 2:
        return None
    legal = LEGAL_FORM.search(words[real[0][0]].string, words[real[0][0]].start(), words[real[-1][0]].end() + 6)
    if legal:
        return None
    if loose and any(len(x[2]) >= 3 and _cut_firm(words[x[0]], x[2]) for x in real):
        return None
    if not loose and not (real[0][1][0].isupper() or real[0][1].islower() and real[1][1].islower()):
        return None
    # a sentence may go on after the name: stop at the first lower-case word of a capitalised name
    if real[0][1][0].isupper():
        stop = next((q for q, x in enumerate(seq) if x[2] not in ("+", ",") and x[1].islower()), len(seq))
        whole = whole and stop == len(seq)
        seq = seq[:stop]
        while seq and seq[-1][2] in ("+", ","):
            seq.pop()
        real = [x for x in seq if x[2] not in ("+", ",")]
        if len(real) < 2:
            return None
    if real[1][2] in PLAINS:
        return None
    if loose and not titled and not any(close(x[2], GIVEN | NICK, NEAR_GIVEN) for x in real[:3]) and not any(len(x[2]) == 1 for x in real[:3]):
        if len(real) > 4 or any(len(x[2]) < 4 for x in real):
            return None
    if real[0][1].islower():  # nothing tells where a name without capitals ends: parts after a connective are taken for it
        return i, _name_end(words, seq[min(len(seq), 5) - 1][0] + 1, str.islower, True)
    end = seq[-1][0] + 1
    return i, _name_end(words, end, str.isupper if real[0][1].isupper() and len(real[0][1]) > 2 else lambda w: w[0].isupper(), False) if whole else end


def _name_end(words: list[re.Match], end: int, like: Callable[[str], bool], linked: bool) -> int:
    """One past the last word of a name that goes on at word end in this lettering; linked: only with words after a connective."""
    k, joined = end, end > 0 and bare(words[end - 1].group()) in CONNECT
    while k < len(words):
        w = words[k].group()
        b = bare(w.rstrip("."))
        if b in CONNECT and (not w[0].isupper() or w.isupper()):
            joined = True
        elif not b[:1].isalpha() or b in PLAINS or b in FIRMS and len(b) > 1 or not like(w) or linked and not joined:
            break
        else:
            end, joined = k + 1, False
        k += 1
    return end


TITLES_SET = set(TITLES.split())


def _names(d: str, low: str, letters: str, out: list) -> None:
    has_given = not GIVEN.isdisjoint(letters.split())
    marks = [(m.end(), True) for m in LABEL.finditer(low)] + [(m.end(), False) for m in CONTEXT.finditer(low)]
    if not has_given and not marks:
        return
    words = list(WORD.finditer(d))
    starts = {w.start(): i for i, w in enumerate(words)}
    taken: list[tuple[int, int]] = []
    for at, label in marks:
        while at < len(d) and d[at] in " :-–*>":
            at += 1
        i = starts.get(at)
        if i is None:
            continue
        got = _person(words, i, True)
        if got:
            taken.append((words[got[0]].start(), words[got[1] - 1].end()))
    if has_given:
        for i, w in enumerate(words):
            s = w.group()
            if len(s) < 4 or bare(s.rstrip(".")) not in GIVEN:
                continue
            if any(a <= w.start() < b for a, b in taken):
                continue
            # the words before
            back = [bare(x.group().rstrip(".")) for x in words[max(0, i - 3) : i]]
            prev = [b for b in back if b not in CONNECT]
            before = d[w.start() - 1] if w.start() else " "
            if before in "@._+-/\\" and before != "-" or w.end() < len(d) and d[w.end()] in "@_[":
                continue
            if any(b in INSTITUTE or b in ALLSTREET and words[max(0, i - 3) : i] for b in prev[-2:]):
                continue
            if any(bare(x.group()) == "street" for x in words[i + 1 : i + 4]):
                continue
            got = _person(words, i, False)
            if got:
                taken.append((words[got[0]].start(), words[got[1] - 1].end()))
            elif i >= 2 and words[i - 1].group() == "," and words[i - 2].group()[0].isalpha():
                # surname first
                f = bare(words[i - 2].group())
                if f not in PLAINS and f not in FIRMS and f not in GIVEN and words[i - 2].group()[0].isupper() and not re.search(r"\d", d[max(0, words[i - 2].start() - 1)]):
                    taken.append((words[i - 2].start(), w.end()))
            elif i >= 1:
                # surname and given name without a comma, alone in the field or up to the next label
                f = bare(words[i - 1].group())
                alone = i + 1 == len(words) or not words[i + 1].group()[0].islower()
                if alone and f.isalpha() and len(f) > 3 and f not in PLAINS and f not in FIRMS and f not in INSTITUTE and words[i - 1].group()[0].isupper() and (i == 1 or LABEL.match(d)):
                    taken.append((words[i - 1].start(), w.end()))
    # the stop of a sentence is no part of a name, that of an initial or a short form is
    out += [(a, b - 1 if d[b - 1] == "." and d[max(a, b - 4) : b - 1].isalpha() else b, 4) for a, b in taken]


_PHONE_BAD = re.compile(r"(?:protocolo|chave|c[óo]digo|pedido|ordem|relat[óo]rio|contrato|inscri|linha|conta|usu[áa]rio|c\.?p\.?f|c\.?n\.?p\.?j|rg|nota|n[ºo°]|refer[êe]ncia|cep)\W{0,6}(?:n[ºo°.]* ?)?$", re.I)
_PHONE_WORDS = {"telefone", "fone", "tel", "cel", "celular", "whatsapp", "para", "comercial", "contato", "ligar"}


PHONE_LABELS, ID_LABELS = ("telefone", "fone", "tel"), ("cpf", "cnpj", "cpfcnpj")
#: Glyphs that a scanner takes for each other, by their plainest form.
GLYPHS = str.maketrans("e0l1!|jfh", "coiiiiitn")


def glyphs(w: str) -> str:
    for a, b in (("rn", "m"), ("ii", "n"), ("ni", "m")):
        w = w.replace(a, b)
    return w.translate(GLYPHS)


def misread_label(w: str, labels: tuple[str, ...]) -> bool:
    """Is a word one of the labels with misread glyphs, or with one other letter in a place of it, or cut by its last letter?"""
    return any(glyphs(w) == glyphs(x) or len(w) == len(x) > 2 and sum(a != b for a, b in zip(w, x)) == 1 and w[0] == x[0] or len(x) == 3 and w == x[:2] and x != "cpf" for x in labels)


def _context_word(d: str, at: int) -> str:
    m = re.search(r"([^\W\d_](?:[^\W\d_]|[0!|](?=[^\W\d_]))*)[\W_]*$", d[max(0, at - 30) : at])
    return bare(m.group(1)) if m else ""


NEAR_PHONE = _near({"telefone", "celular"})
DIGITS = re.compile(r"\d(?:[ .,/()x+-]{0,4}\d){7}")
LONG_RUN = re.compile(r"\d{10}")
ID_WORDS = re.compile(r"\br\.?g\b|passap|identid|\brne\b")
EMAIL_HINTS = ("@", "©", "arroba", "arobа", "[at]", "(at)", " at ", "mail", "eletr", ".test", ".example", ".invalid", ".com", ".net", ".org", ".br")
BLANK_HINT = re.compile(r"[<&*~`'\[\]{}|\\]")


def _label_like(w: str) -> bool:
    """A label's word, or one glyph away from it."""
    return close(w, LABEL_WORDS, NEAR_LABEL) or w.startswith(("c.n.p", "c.p.f", "e-mail", "emai", "corre"))


LABEL_WORDS = {"telefone", "fone", "nome", "razao", "valor", "codigo", "numero", "emitida", "data", "aliquota", "municipio", "inscricao", "descricao", "discriminacao", "natureza", "autenticidade", "cnpj", "cpf", "nota", "imposto", "liquido", "bruto", "email", "correio", "chave", "folha", "pagina"}
NEAR_LABEL = _near(LABEL_WORDS)


def _after_given(d: str, at: int) -> bool:
    return _context_word(d, at) in GIVEN


def spans(text: str, low: str | None = None, letters: str | None = None) -> list[tuple[int, int, int]]:
    """(start, end, index in KINDS) of the pieces of personal information, without overlaps.

    low and letters: bare_forms of the text, where the caller has made them for a whole batch.
    """
    out: list[tuple[int, int, int]] = []
    d = detection_text(text)
    if low is None or letters is None or d != text:
        if d != text and low is not None and len(low) == len(d) and not BLANK_HINT.search(text):
            pass
        else:
            low, letters = (x[0].as_py() for x in bare_forms(pa.array([d], pa.large_string())))
    if any(h in low for h in EMAIL_HINTS):
        for p in EMAILS:
            for m in p.finditer(d):
                g = 1 if p.groups else 0
                out.append((m.start(g), m.end(g), 0))
    if ("rg" in low or "r.g" in low or "passap" in low or "identid" in low or "rne" in low) and ID_WORDS.search(low):
        out += [(m.start(1), m.end(1), 2) for m in RG.finditer(d)]
    if DIGITS.search(d):
        ids: list[tuple[int, int, int]] = list(out) if out and out[-1][2] == 2 else []
        run = LONG_RUN.search(d)
        if "/" in d:
            ids += [(m.start(), m.end(), 2) for m in CNPJ.finditer(d)]
        ids += [(m.start(), m.end(), 2) for m in CPF.finditer(d)]
        for m in BARE_ID.finditer(d) if run else ():
            if ID_LABEL.search(d, max(0, m.start() - 30), m.start()) or len(m.group()) == 14 and _id_word(_context_word(d, m.start())) or len(m.group()) == 11 and _id_word(_context_word(d, m.start())):
                ids.append((m.start(), m.end(), 2))
        for m in PHONE.finditer(d):
            if not any(a < m.end() and m.start() < b for a, b, _ in ids) and not _PHONE_BAD.search(d, max(0, m.start() - 22), m.start()):
                out.append((m.start(), m.end(), 1))
        for m in PHONE_BARE.finditer(d) if run else ():
            w = _context_word(d, m.start())
            if (w in _PHONE_WORDS or close(w, {"telefone", "celular"}, NEAR_PHONE) or misread_label(w, PHONE_LABELS)) and not any(a < m.end() and m.start() < b for a, b, _ in ids):
                out.append((m.start(), m.end(), 1))
        for m in PHONE_LOCAL.finditer(d) if "tel" in low or "fone" in low or "cel" in low or "whats" in low or "ligar" in low else ():
            out.append((m.start(1), m.end(1), 1))
        out += ids
    if ADDRESS_HINT.search(low):
        streets = [(m.start(), m.end()) for p in (ADDRESS, ADDRESS_LONG, ADDRESS_NAME) for m in p.finditer(d) if d[m.start() : m.start() + 2] not in ("R.", "r.") or not _after_given(d, m.start())]
        for m in ADDRESS_LABEL.finditer(d) if "en" in low else ():
            inner = [x.strip(".:,-()") for x in bare(m.group(1)).split()]
            if inner[0] not in PLAINS and inner[0] not in FIRMS and not any(_label_like(x) for x in inner) and not any(x in SENTENCE for x in inner):
                streets.append((m.start(1), m.end(1)))
        out += [(a, b, 3) for a, b in streets]
    _names(d, low, letters, out)
    if len(out) < 2:
        return out
    out.sort(key=lambda x: (x[0], -x[1]))
    keep: list[tuple[int, int, int]] = []
    order = {0: 0, 2: 1, 4: 2, 3: 3, 1: 4}
    for s in sorted(out, key=lambda x: (order[x[2]], x[0], -x[1])):
        if not any(s[0] < b and a < s[1] for a, b, _ in keep):
            keep.append(s)
    return sorted(keep)


def _id_word(w: str) -> bool:
    return w in ID_LABELS or w == "usuario" or misread_label(w, ID_LABELS) or w == "j"


def pieces(text: str, low: str | None = None, letters: str | None = None) -> list[tuple[int, int, int]]:
    """spans of a text in its consistent form, with those that are found only when words cut at line ends are joined."""
    plain = spans(text, low, letters)
    if "\n" not in text or not HYPHEN.search(text):
        return plain
    kept, at, places = [], 0, []
    for m in HYPHEN.finditer(text):
        kept.append(text[at : m.start()])
        places += range(at, m.start())
        at = m.end()
    kept.append(text[at:])
    places += range(at, len(text))
    out = [(places[a], places[b - 1] + 1, k) for a, b, k in spans("".join(kept)) if b > a]
    covered = {i for a, b, _ in out for i in range(a, b)}
    out += [x for x in plain if not covered.issuperset(range(x[0], x[1]))]
    merged: list[tuple[int, int, int]] = []
    for a, b, k in sorted(out, key=lambda x: (x[0], -x[1])):
        if merged and a < merged[-1][1]:  # the longer piece names the kind
            x, y, j = merged[-1]
            merged[-1] = (x, max(b, y), j if y - x >= b - a else k)
        else:
            merged.append((a, b, k))
    return merged


def kinds_of(texts: list[str | None], key: bytes) -> list[int]:
    """Bits of the kinds whose placeholders the redaction of each text writes."""
    return [bits for _, bits in redactions(texts, key)]


# ---- pseudonyms ---------------------------------------------------------------------------------


def feistel(value: int, size: int, key: bytes, tweak: bytes = b"", rounds: int = 8) -> int:
    """A keyed permutation of range(size): a balanced Feistel network over a square that holds it, walked along its cycle."""
    if size < 2:
        return value
    half = math.isqrt(size - 1) + 1
    while True:
        a, b = divmod(value, half)
        for r in range(rounds):
            f = int.from_bytes(hmac.digest(key, tweak + bytes([r]) + b.to_bytes(16, "big"), "sha256")[:8], "big")
            a, b = b, (a + f) % half
        value = a * half + b
        if value < size:
            return value


def check_digits(base: str) -> str:
    """The two check digits of a CPF (9 digits) or CNPJ (12 digits)."""
    out = base
    for _ in range(2):
        if len(base) == 9:
            total = sum(int(c) * w for c, w in zip(out, range(len(out) + 1, 1, -1)))
        else:
            weights = [(i % 8) + 2 for i in range(len(out))][::-1]
            total = sum(int(c) * w for c, w in zip(out, weights))
        rest = total % 11
        out += "0" if rest < 2 else str(11 - rest)
    return out[len(base) :]


@lru_cache(100_000)
def permute_digits(digits: str, key: bytes, tweak: bytes) -> str:
    """A number of the same length; valid check digits stay valid."""
    n = len(digits)
    if n in (11, 14) and check_digits(digits[:-2]) == digits[-2:]:
        base = digits[:-2]
        new = str(feistel(int(base), 10 ** len(base), key, tweak + b"v")).zfill(len(base))
        return new + check_digits(new)
    return str(feistel(int(digits), 10**n, key, tweak + bytes([n]))).zfill(n)


def permute_number(piece: str, key: bytes, tweak: bytes) -> str:
    """The digits of a piece permuted, its other signs kept."""
    digits = "".join(c for c in piece if c.isdigit())
    if not digits:
        return piece
    new = iter(permute_digits(digits, key, tweak))
    return "".join(next(new) if c.isdigit() else c for c in piece)


DAY0, DAYS = datetime.date(1900, 1, 1), 73_049  # 1900-2099


def permute_date(piece: str, key: bytes) -> str:
    """A date dd/mm/yyyy (or yyyy-mm-dd, or with dots) permuted among the real dates of two centuries."""
    m = re.fullmatch(r"(\d{1,2})([/.-])(\d{1,2})\2(\d{4})|(\d{4})-(\d{2})-(\d{2})", piece)
    if not m:
        return piece
    try:
        day = datetime.date(int(m[4]), int(m[3]), int(m[1])) if m[4] else datetime.date(int(m[5]), int(m[6]), int(m[7]))
    except ValueError:
        return piece
    n = (day - DAY0).days
    if not 0 <= n < DAYS:
        return piece
    new = DAY0 + datetime.timedelta(feistel(n, DAYS, key, b"date"))
    return new.strftime(f"%d{m[2]}%m{m[2]}%Y") if m[4] else new.isoformat()


@lru_cache(100_000)
def link(piece: str, key: bytes, tweak: bytes) -> str:
    """26 letters and digits (128 bits) that stand for the normalised form of a text piece."""
    form = re.sub(r"[\W_]+", " ", bare(piece)).strip()
    n = feistel(int.from_bytes(hashlib.sha256(form.encode()).digest()[:16], "big"), 2**128, key, tweak)
    return base64.b32encode(n.to_bytes(16, "big")).decode().rstrip("=").lower()


BORN = re.compile(r"(?:nascid[oa] em|nascimento\W{0,4})\s*(\d{1,2}[/.-]\d{1,2}[/.-]\d{4})", re.I)


def placeholder(kind: int, piece: str, key: bytes) -> str:
    name = KINDS[kind].upper()
    if kind in (1, 2):
        tweak = KINDS[kind].encode()
        if kind == 1:  # the country code and the trunk zero are notation
            piece = re.sub(r"^\+? ?55(?=\D|\d{10,11}$)[ -]?|^0(?:xx)?(?=\d{2})", "", piece.strip())
        return f"[{name} {permute_number(piece, key, tweak)}]"
    return f"[{name} {link(piece, key, KINDS[kind].encode())}]"


def fold_map(text: str, normal: str) -> list[int]:
    """For each character of the consistent form the place in the text where it begins; empty where a composition is unusual."""
    if len(normal) == len(text):
        return list(range(len(text) + 1))
    t = Tables.get()
    places: list[int] = []
    for i, c in enumerate(text):
        w = int(t.width[ord(c)])
        if w and unicodedata.combining(c) and places and len(unicodedata.normalize("NFC", text[places[-1]] + c)) == 1:
            continue
        places += [i] * w
    places.append(len(text))
    return places if len(places) == len(normal) + 1 else []


BORN_HINT = re.compile(r"nasc", re.I)


def _replace(text: str, normal: str, found: list[tuple[int, int, int]], key: bytes, dates: bool) -> tuple[str, int]:
    """(text with placeholders, bits of the kinds that were written)."""
    bits = 0
    if found:
        places = fold_map(text, normal)
        if not places:
            text, places = normal, list(range(len(normal) + 1))
        out, at = [], 0
        for a, b, k in found:
            x, y = places[a], places[b]
            out += [text[at:x], placeholder(k, HYPHEN.sub("", normal[a:b]), key)]
            bits |= 1 << k
            at = y
        out.append(text[at:])
        text = "".join(out)
    if dates and BORN_HINT.search(text):
        text = BORN.sub(lambda m: m.group().replace(m.group(1), permute_date(m.group(1), key)), text)
    return text, bits


def redactions(texts: list[str | None], key: bytes, dates: bool = True) -> list[tuple[str | None, int]]:
    """(text with every piece of personal information replaced by its placeholder, bits of the kinds replaced)."""
    if not key:
        raise ValueError("a key is needed")
    normal = normalize(pa.array(texts, pa.large_string()))[0]
    low, letters = bare_forms(normal)
    rows = zip(texts, normal.to_pylist(), low.to_pylist(), letters.to_pylist())
    return [_replace(t, n, pieces(n, a, b), key, dates) if t else (t, 0) for t, n, a, b in rows]


def redact(text: str | None, key: bytes, dates: bool = True) -> str | None:
    return redactions([text], key, dates)[0][0]


def redacted(df: DataFrame, columns: dict[str, str], key: bytes, dates: bool = True) -> DataFrame:
    """df with a redacted column for each text column: {text column: new column}."""
    clash = set(columns.values()) & set(df.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + "".join(f", `{o}` string" for o in columns.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for b in batches:
            new = []
            for src in columns:
                vals = b.column(src).to_pylist()
                fresh = list(set(vals) - memo.keys())
                memo.update((t, x[0]) for t, x in zip(fresh, redactions(fresh, key, dates)))
                new.append(pa.array([memo[v] for v in vals], pa.string()))
            if len(memo) > MEMO:
                memo.clear()
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *columns.values()])

    return df.mapInArrow(run, schema)


def found(df: DataFrame, row_key: str, fields: list[str], source: str, key: bytes) -> DataFrame:
    """(source_table, row_key, field_name, pii_type) of the latest delivery of every row: what its redaction replaced."""
    masks = flag_masks(df, row_key, fields, lambda: lambda texts: kinds_of(texts, key), 8)
    return explode_masks(masks, fields, KINDS, 8, "pii_type", source)


#: The session's setting that holds the key of the pseudonyms, in hexadecimal.
SETTING = "spark.ledgerloom.pseudonym.key"


def session_key(spark: SparkSession) -> bytes:
    """The session's key; where it has none, a random one, whose pseudonyms link only the rows of one run."""
    own = spark.conf.get(SETTING, None)
    return bytes.fromhex(own) if own else secrets.token_bytes(32)
