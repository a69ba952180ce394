"""Problem 3: noise of scanned pages: cut words, misread characters, running headers, page numbers.

1. Words are counted with the word before them over all texts. Words of one confusable-glyph skeleton form a group; a
   form is taken for a more frequent word of its group that it misreads (glyph by glyph) if both stand beside a common
   neighbour: the chosen word must be one that the form's context supports.
2. Lines at the top or bottom of pages are keyed by skeleton with digits masked; a key on two or more pages of
   a document of any size is a running header, if one of its boxes is in the margin or all its lines have the form of one (else if it is on PART of the pages).
3. Cut words are joined unless the compound itself is a known word; page numbers are known by form and,
   where they are bare numbers, by place and value.
4. `reflowed` takes header lines and page numbers out of the elements (the rest of an element stays), repairs
   words and joins the lines of a page into paragraphs with windows over (document, engine, page). `repaired_fields`
   does the same for one-line fields.

The frequent words (a share of all words, so at most 1 / SHARE of them) are broadcast; rare words are joined by
shuffle. Rows meet the headers of their document in sorted streams of (document, salt): a document with a third of
all rows is spread over SALT tasks, and no row carries its document's headers. Odd input: null and blank texts have no
noise; a null page counts as one more page of its engine for headers; a null box is in no margin; an exact repeat is one
record; texts and lines of any length are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MEMO, cut, explode_masks, over_texts
from .pii import bare
from .unicode_forms import normalize

KINDS = ["hyphenation", "misread", "running_header", "page_number"]
HYPHENATION, MISREAD, HEADER, PAGE, BARE = 1, 2, 4, 8, 16
BITS = 8
#: A frequent word has at least this share of all words and LEAST occurrences.
SHARE, LEAST = 2e-6, 30
RATIO_RARE, RATIO_FREQUENT = 4, 20
TOP, BOTTOM = 0.08, 0.93
#: A repeated edge line without a box in the margin and without the form of a header is one on this part of the pages.
PART = 0.05

# What a scanner reads for what is printed.
MISREAD_AS = {
    "0": "o", "c": "e", "l": "i", "!": "i", "|": "i", "f": "t", "5": "s", "1": "li", "9": "g", "6": "b", "O": "D", "F": "E", "4": "aA", "8": "B", "I": "l", "S": "5",
    "3": "E", "7": "T", "$": "s", "ii": "nu", "cl": "d", "rn": "m", "vv": "w", "II": "N",
}
#: One sign for glyphs that are taken for each other; glyphs that are taken for two are first written as two.
TO_CLASS = str.maketrans("el1!|tfj0qQ5$689 4y".replace(" ", ""), "ciiiiiiioooss" + "bbg" + "av")
TO_TWO = (("m", "rn"), ("n", "ii"), ("u", "ii"), ("w", "vv"))
ALPHA = re.compile(r"(?<![\w!|])(?<!\w-)[^\W\d_]{3,}(?:-[^\W\d_]+)*(?![\w!|])")
MIXED = re.compile(r"(?<![\w!@.])(?=\w)(?=[\w!|]*[^\W\d_])(?=[\w!|]*[\d!|])[\w!|]{3,}(?![\w@])")
HYPHEN = re.compile(r"([^\W\d_]+)[-‐¬]\s*\n\s*([^\W\d_]+)|([^\W\d_]+)[-‐¬] +([^\W\d_]+)")
HYPHEN_END = re.compile(r"(?<![\w-])([^\W\d_]{2,})[-‐¬]\s*$")
SOFT = re.compile("[^\\W\\d_]­\\s*\\n\\s*[^\\W\\d_]")
ODD_NUMBER = re.compile(
    r"(?<![\w.,/-])(?=[\d.,OolISBZ]*\d)(?=[\d.,]*[OolISBZ])[\dOolISBZ]{1,3}(?:\.[\dOolISBZ]{3})*,[\dOolISBZ]{2}(?![\w])"
    r"|(?<![\w.,/-])(?=[\dOolISBZ/]*\d)(?=[\d/]*[OolISBZ])[\dOolISBZ]{1,2}/[\dOolISBZ]{1,2}/[\dOolISBZ]{4}(?![\w/])"
)
ODD_HINT = re.compile(r"[\d.,/][OolISBZ]|[OolISBZ][\d,.]\d?")
ODD_MAIL = re.compile(r"(?<![\w@.])[A-Za-z0-9._+-]{2,} ?[QOG0©] ?[a-z0-9-]{2,}(?:\.[a-z0-9-]+)*\.(?:test|example|invalid|com|net|org|br)(?![\w])")
LABELLED_MAIL = re.compile(r"(?:e-?mail|correio eletr[ôo]nico)\W{0,6}([\w.+©-]+\.(?:test|example|invalid|com|net|org|br))\b", re.I)
MAIL_WORD = re.compile(r"[a-z0-9._+-]*[a-z][015][a-z][a-z0-9._+-]*(?:@| ?[(\[])|@[a-z0-9.-]*[a-z][0156!][a-z][a-z0-9.-]*")
PAGES = re.compile(
    r"(?<!na )(?<!da )(?<![\w-])(?:p[áaà4][gq9][il1!][nu][ao]s?|p[áa][gq9]\.?|p[áa][gq9][il1!](?:ii|rn|n)a|pa[gq9][ec]|fl[s]?\.|f[o0]l[hb]a|fo[il1!]ha)\s*(?:n[ºo°]\s*)?((?=[OolI]{0,2}\d)[\dOolI]{1,5})(?!\d)(?:\s*(?:/|de|of|dc|0f)\s*[\dOolI]{1,4})?(?![\w,/])(?!\.\d)",
    re.I,
)
DASHED = re.compile(r"(?:^|\n)[ \t]*(?:[-–—]\s?\d{1,4}\s?[-–—]|\[\s?\d{1,4}\s?\])[ \t]*(?=\n|$)")
DASHED_FIRST = re.compile(r"^(?:- \d{1,4} -|\[\d{1,4}\]) (?=\S)")
BARE_PAGE = re.compile(r"\W*(\d{1,5})(?:\s?/\s?(\d{1,4}))?\W*")
#: What may stand between a page number and the rest of its line.
SEPARATED, SEPARATES = re.compile(r"(?:^|[-–—|·•:;,(\[]|\s{2,})[\W_]*$"), re.compile(r"\W*$|\s*[-–—|·•:;,]|\s{3,}")
SPOILT = re.compile(r"</?\w+[^>]*>|<!--.*?-->|&#?\w+;|\\(?:begin|end)\{\w+\}|\\[A-Za-z]+|[*#`|<>{}$\\]|'''|''|\[\[(?:[\w ]+\||Categoria:\w+)?|\]\]|\]\(#\w+\)")


def reversals(w: str) -> Iterator[str]:
    """What a word may have been if one of its glyphs was misread."""
    for i, c in enumerate(w):
        for to in MISREAD_AS.get(c, ""):
            yield w[:i] + to + w[i + 1 :]
        pair = w[i : i + 2]
        for to in MISREAD_AS.get(pair, "") if len(pair) == 2 else "":
            yield w[:i] + to + w[i + 2 :]


def unread(w: str) -> str:
    """All digits and signs within a word read as letters."""
    up = w.isupper() or sum(c.isupper() for c in w) > 1
    to = {"0": "o", "1": "l", "!": "i", "|": "i", "5": "s", "9": "g", "6": "b", "4": "a", "8": "b", "3": "e", "7": "t", "$": "s"}
    s = "".join(to.get(c, c) for c in w)
    return s.upper() if up else s


def skeleton(w: str, d: str = "cl") -> str:
    """The confusable-glyph class of a word. d: what the letter d is taken for (capital D: o)."""
    s = bare(w).replace("d", d)
    for a, b in TO_TWO:
        s = s.replace(a, b)
    return s.translate(TO_CLASS)


def line_key(line: str) -> str:
    """The masked skeleton of a line: words by skeleton, numbers as one sign, page numbers dropped."""
    line = SPOILT.sub(" ", line)
    line = PAGES.sub(" ", line)
    out: list[str] = []
    for w in re.findall(r"[\w!|]+", bare(line)):
        n = sum(c.isdigit() for c in w)
        if n and n * 2 >= len(w):
            if not out or out[-1] != "#":
                out.append("#")
        else:
            s = skeleton(w)
            out.append(s)
    return "".join(out)


def _blank(m: re.Match) -> str:
    return " " * (m.end() - m.start())


def key_words(line: str) -> list[tuple[str, int, int]]:
    """(part of the key, start, end in the line) of the words of a line; the parts joined are its line_key."""
    line = SPOILT.sub(_blank, line)
    line = PAGES.sub(_blank, line)
    out: list[tuple[str, int, int]] = []
    for m in re.finditer(r"[\w!|]+", bare(line)):
        w = m.group()
        n = sum(c.isdigit() for c in w)
        if n and n * 2 >= len(w):
            if out and out[-1][0] == "#":
                out[-1] = ("#", out[-1][1], m.end())
            else:
                out.append(("#", m.start(), m.end()))
        else:
            out.append((skeleton(w), m.start(), m.end()))
    return out


#: Stands before the first word of a text.
BEGIN = "\x02"
WORDS = re.compile(BEGIN + "|" + ALPHA.pattern)


def neighbours(texts: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """(before, word, n): words of letters (and compounds) of all texts with the word before them.

    Counted in Python by partition, then summed. A word that ends a text is `before` of BEGIN.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            pairs = list(counts)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.string()), pa.array([y for _, y in pairs], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["before", "word", "n"])

        for b in batches:
            for col in b.columns:
                normal = normalize(col)[0]
                found = WORDS.findall(BEGIN + f"\n{BEGIN}\n".join(t for t in normal.to_pylist() if t) + "\n" + BEGIN)
                counts.update(zip(found, found[1:]))
            if len(counts) > 400_000:
                yield rows()
                counts = Counter()
        yield rows()

    parts = [df.select(*cols).mapInArrow(run, "before string, word string, n long") for df, cols in texts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("before", "word").agg(F.sum("n").alias("n"))


def word_counts(pairs: DataFrame) -> DataFrame:
    """(word, n)."""
    return pairs.filter(F.col("word") != BEGIN).groupBy("word").agg(F.sum("n").alias("n"))


def misread_forms(words: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """(word, meant, n, times): forms that misread a more frequent word of their skeleton group, in a context of that word.

    One misread glyph: the form's readings are joined with the words. Two: the most frequent word of the group is
    compared. pairs: neighbours(); without them any context will do.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = b.column(0).to_pylist()
            keys = [dict.fromkeys((skeleton(x), skeleton(x, "o"))) for x in w]
            idx = pa.array([i for i, k in enumerate(keys) for _ in k], pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(idx) for c in b.columns), pa.array([x for k in keys for x in k], pa.string())], names=["word", "n", "skeleton"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = b.column(0).to_pylist()
            as_ = [{y.lower() for y in reversals(x) if bare(y) != bare(x) and y.lower() != x.lower()} for x in w]
            idx = pa.array([i for i, k in enumerate(as_) for _ in k], pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(idx) for c in b.columns), pa.array([x for k in as_ for x in k], pa.string())], names=["word", "n", "low"])

    plain = words.filter("word not like '%-%'").select("word", "n")
    base = plain.mapInArrow(keyed, "word string, n long, skeleton string")
    # in a group only the strongest forms can be meant: the top by count for each lettering
    style = F.when(F.upper("word") == F.col("word"), "U").when(F.initcap("word") == F.col("word"), "T").otherwise("l")
    base = base.withColumn("style", F.when(F.col("word").rlike("[A-Z][A-Z]"), "U").otherwise(style))
    top = base.groupBy("skeleton", "style").agg(F.max(F.struct("n", "word")).alias("t")).select("skeleton", "style", F.col("t.word").alias("meant"), F.col("t.n").alias("times"))
    two = base.join(top, ["skeleton", "style"]).filter(f"word <> meant and times >= {RATIO_RARE} * n").select("word", "meant", "n", "times").distinct()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, m = b.column(0).to_pylist(), b.column(1).to_pylist()
            keep = [i for i, (x, y) in enumerate(zip(w, m)) if _misreads(x, y)]
            yield b.take(pa.array(keep, pa.int64()))

    known = plain.groupBy(F.lower("word").alias("low")).agg(F.max(F.struct("n", "word")).alias("t")).select("low", F.col("t.word").alias("meant"), F.col("t.n").alias("times"))
    one = plain.mapInArrow(read, "word string, n long, low string").join(known, "low").filter(f"times >= {RATIO_RARE} * n").select("word", "meant", "n", "times")
    fits = one.unionByName(two.mapInArrow(check, "word string, meant string, n long, times long")).distinct()
    if pairs is not None:
        fits = supported(cut(fits), pairs)
    return fits.groupBy("word").agg(F.max(F.struct("times", "meant", "n")).alias("m")).select("word", "m.meant", "m.n", "m.times")


def supported(fits: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of fits whose word and meant word stand after, or before, the same word somewhere in the corpus.

    Only pairs with a word of fits are looked at; they are joined by (word, neighbour), so a frequent neighbour is no key of its own.
    """
    low = pairs.select(F.lower("before").alias("before"), F.lower("word").alias("word"))
    some = fits.select(F.lower("word").alias("w")).unionByName(fits.select(F.lower("meant").alias("w"))).distinct()
    after = low.filter(F.col("word") != BEGIN).join(some, F.col("word") == F.col("w"), "left_semi").select(F.col("word").alias("w"), F.concat(F.lit("<"), "before").alias("side"))
    ahead = low.filter(F.col("before") != BEGIN).join(some, F.col("before") == F.col("w"), "left_semi").select(F.col("before").alias("w"), F.concat(F.lit(">"), "word").alias("side"))
    sides = cut(after.unionByName(ahead).distinct())
    asked = fits.select("word", "meant", F.lower("word").alias("w"), F.lower("meant").alias("m")).join(sides, "w")
    told = sides.select(F.col("w").alias("m"), "side")
    yes = asked.join(told, ["m", "side"], "left_semi").select("word", "meant").distinct()
    return fits.join(yes, ["word", "meant"], "left_semi")


def _misreads(word: str, meant: str) -> bool:
    """Is word a misreading of meant by one glyph or two?"""
    a, b = bare(word), bare(meant)
    if a == b or word.lower() == meant.lower():
        return False
    first = [x for x in reversals(word) if bare(x) != a]
    if any(x == meant or x.lower() == meant.lower() for x in first):
        return True
    return any(y == meant for x in first if len(word) > 6 for y in reversals(x))


class Lexicon:
    """Frequent words and what the detector needs of them; bounded by the share of a frequent word."""

    def __init__(self, words: list[tuple[str, int]], misread: dict[str, str]) -> None:
        plain = [w for w, _ in words if "-" not in w]
        self.words = frozenset(plain)
        self.lower = frozenset(w.lower() for w in plain if len(w) >= 3)
        self.bad = frozenset(misread)
        self.meant = misread
        compounds = {w.lower() for w, _ in words if "-" in w}
        self.compounds = frozenset(compounds)
        heads = {w.split("-")[0] for w in compounds}
        accented = {bare(h) for h in heads if bare(h) != h}
        self.heads = frozenset(heads - accented)  # "pre" is no head where "pré" is one


def detect(text: str, original: str, lex: Lexicon) -> tuple[int, list[str]]:
    """(bits, rare words to look up) of a text in its consistent form. BARE: a bare number, judged by place."""
    out = 0
    if "-" in text or "‐" in text or "¬" in text:
        for m in HYPHEN.finditer(text):
            a, b = (m.group(1), m.group(2)) if m.group(1) else (m.group(3), m.group(4))
            if len(a) + len(b) < 4 or f"{a}-{b}".lower() in lex.compounds:
                continue
            if b[0].islower() or a.isupper() and b.isupper() and len(a) > 1:
                if m.group(1) or len(a) > 1 and (b[0].islower() == a[-1].islower()):
                    if m.group(3) and b.lower() in ("de", "da", "do", "e", "a", "o") and a.lower() in lex.lower:
                        continue
                    out |= HYPHENATION
        m = HYPHEN_END.search(text)
        if m and m.group(1).lower() not in lex.heads:
            out |= HYPHENATION
    if "­" in original and SOFT.search(original):
        out |= HYPHENATION
    words = set(ALPHA.findall(text))
    if not words.isdisjoint(lex.bad):
        out |= MISREAD
    rare: list[str] = []
    if not out & MISREAD:
        rare = [w for w in words - lex.words if "-" not in w and len(w) >= 4]
        for m in MIXED.finditer(text):
            w = m.group()
            if _mixed(w, text, m.start(), lex):
                out |= MISREAD
                rare = []
                break
    if not out & MISREAD and ODD_HINT.search(text):
        m = ODD_NUMBER.search(text)
        if m and any(c.isalpha() for c in m.group()) and any(c.isdigit() for c in m.group()):
            out |= MISREAD
    if not out & MISREAD and ("." in text and ODD_MAIL.search(text) or "@" in text and MAIL_WORD.search(text)):
        if any("@" not in m.group() for m in ODD_MAIL.finditer(text)) or MAIL_WORD.search(text):
            out |= MISREAD
    if not out & MISREAD and "." in text and "@" not in text:
        m = LABELLED_MAIL.search(text)
        if m and not any(x in text for x in ("(arroba)", "[at]", "(at)")):
            out |= MISREAD
    return out | page_bits(text), rare if not out & MISREAD else []


def page_bits(text: str) -> int:
    """PAGE or BARE of a text in its consistent form."""
    if PAGES.search(text) or DASHED.search(text) or DASHED_FIRST.match(text):
        return PAGE
    return BARE if BARE_PAGE.fullmatch(text.rstrip().rsplit("\n", 1)[-1]) else 0


def _mixed(w: str, text: str, at: int, lex: Lexicon) -> bool:
    """Is a word of letters with digits or signs a misread word?"""
    n = sum(c.isdigit() or c in "!|" for c in w)
    if n > 2 or len(w) - n < 2 or "_" in w:
        return False
    if w[-1] in "!|" and n == 1 and w[:-1].lower() in lex.lower:
        return False
    if len(w) - n >= 3 or w[0].isalpha():
        if unread(w).lower() in lex.lower:
            return True
        for x in reversals(w):
            if x.lower() in lex.lower or n > 1 and any(y.lower() in lex.lower for y in reversals(x)):
                return True
    # an unknown name: one sign between lower-case letters, and no code
    if n == 1 and len(w) >= 5 and re.search(r"[a-zà-ú][01569!|][a-zà-ú]", w):
        if len(w) == 9 and w[3].isdigit() and w[4] in "abcdef":
            return False
        return w[1:].islower() or not any(c.isupper() for c in w[1:])
    return False


def flags(df: DataFrame, key: str, fields: list[str], lexicon, layout: bool) -> DataFrame:
    """(row_key, at, mask, rare): bits of every delivery; rare holds "field:word" to look up. Without a lexicon: page numbers only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, memo = lexicon and lexicon.value, {}

        def fn(texts: list) -> list:
            normal = normalize(pa.array(texts, pa.large_string()))[0].to_pylist()
            if lex is None:
                return [(page_bits(n), []) if n else (0, []) for n in normal]
            return [detect(n, t, lex) if t else (0, []) for n, t in zip(normal, texts)]

        for b in batches:
            if not b.num_rows:
                continue
            cols = over_texts(b, fields, fn, object, memo)
            mask = np.zeros(b.num_rows, np.int64)
            rare: list[list[str]] = [[] for _ in range(b.num_rows)]
            for f, col in enumerate(cols):
                for i, x in enumerate(col):
                    if x:
                        if x[0]:
                            mask[i] |= x[0] << (f * BITS)
                        for w in x[1]:
                            rare[i].append(f"{f}:{w}")
            if layout:
                hit = np.flatnonzero(mask & BARE)
                if len(hit):
                    text, page, margin, whole, kind = (b.column(c) for c in (fields[0], "page_number", "margin", "whole", "element_type"))
                    for i in map(int, hit):
                        mask[i] &= ~BARE
                        if bare_page(text[i].as_py(), page[i].as_py(), margin[i].as_py(), whole[i].as_py(), kind[i].as_py()):
                            mask[i] |= PAGE
            else:
                mask &= ~sum(BARE << (f * BITS) for f in range(len(fields)))
            yield pa.RecordBatch.from_arrays([b.column("row_key"), b.column("at"), pa.array(mask), pa.array(rare, pa.list_(pa.string()))], names=["row_key", "at", "mask", "rare"])

    return df.mapInArrow(run, "row_key long, at long, mask long, rare array<string>")


def bare_page(text: str, page: int | None, margin: bool | None, whole: bool | None, kind: str | None) -> bool:
    """Is a number alone on the last line of an element, or alone in it, the number of the page?"""
    line = text.rstrip().rsplit("\n", 1)[-1]
    m = BARE_PAGE.fullmatch(normalize(pa.array([line], pa.large_string()))[0][0].as_py())
    if not m:
        return False
    n, total = int(m.group(1)), int(m.group(2)) if m.group(2) else None
    if total is not None and n > total:
        return False
    if "\n" in text.strip() and not whole:
        return False
    place = margin or whole or (kind or "").strip().lower() == "foot"
    if page is None:
        return bool(place)
    if n != page:
        return False
    return bool(place) or total is not None and margin is None


def margins(elements: DataFrame) -> DataFrame:
    """elements with margin (is its box at the top or bottom of the page? null where it has no box) and whole.

    whole: a page, or a large part of one, given in one piece: several lines that no layout label sets apart, or in a tall box.
    """
    height = elements.select(F.percentile_approx(F.col("bounding_box.y") + F.coalesce("bounding_box.h", F.lit(0.0)), 0.99, 10_000).alias("h")).first()[0]
    y = F.col("bounding_box.y")
    flat = F.coalesce(F.col("bounding_box.h"), F.lit(0.0)) < 0.1 * (height or 0)
    kind = F.lower(F.trim(F.coalesce("element_type", F.lit(""))))
    whole = F.coalesce(F.instr(F.trim("text"), "\n") > 0, F.lit(False)) & (kind.isin("", "text") | ~flat)
    return elements.withColumn("margin", ((y < TOP * (height or 0)) | (y > BOTTOM * (height or 0))) & flat).withColumn("whole", whole)


def header_keys(elements: DataFrame) -> DataFrame:
    """(document_id, key): lines at the top or bottom of at least two pages. elements: with margin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            normal = normalize(b.column("text"))[0].to_pylist()
            at, keys, boxed, formed = [], [], [], []
            for i, (t, m, w) in enumerate(zip(normal, b.column("margin").to_pylist(), b.column("whole").to_pylist())):
                for k, box, form in edge_keys(t, bool(m), bool(w)):
                    at.append(i)
                    keys.append(k)
                    boxed.append(box)
                    formed.append(form)
            idx = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(idx) for c in ("document_id", "engine_id", "page_number")), pa.array(keys, pa.string()), pa.array(boxed, pa.bool_()), pa.array(formed, pa.bool_())], names=["document_id", "engine_id", "page_number", "key", "boxed", "formed"])

    how = F.max("boxed").alias("boxed"), F.min("formed").alias("formed")
    edge = elements.filter("text is not null and (margin or whole)").select("document_id", "engine_id", "page_number", "text", "margin", "whole")
    seen = edge.mapInArrow(run, "document_id string, engine_id string, page_number int, key string, boxed boolean, formed boolean").groupBy("document_id", "engine_id", "page_number", "key").agg(*how)
    # an element without a page is on another page than those that the same engine has numbered
    by_engine = seen.groupBy("document_id", "engine_id", "key").agg(F.count("*").alias("n"), *how).select("document_id", "key", "n", "boxed", "formed")
    numbered = seen.filter("page_number is not null").groupBy("document_id", "page_number", "key").agg(*how).groupBy("document_id", "key").agg(F.count("*").alias("n"), *how)
    keys = by_engine.unionByName(numbered).groupBy("document_id", "key").agg(F.max("n").alias("n"), *how)
    pages = elements.filter("page_number is not null").select("document_id", "page_number").distinct().groupBy("document_id").agg(F.count("*").alias("pages"))
    return keys.filter("n > 1").join(pages, "document_id", "left").filter(f"boxed or formed or n >= {PART} * pages").select("document_id", "key")


#: A line of the body: an amount or a share, a list, table or heading sign first, a lower-case beginning, a sentence's end or a cut.
BODY_LINE = re.compile(r"R\$|\d,\d{2}(?!\d)|\d ?%|^\s*(?:[-*•=#|>{]|\\|<h\d|[a-zà-ú])|[a-zà-ú\d]{3}[.;]\W*$|[,:\-‐¬]\s*$")


def edge_keys(text: str | None, margin: bool, whole: bool) -> list[tuple[str, bool, bool]]:
    """(key, in the margin by its box, in form a header) of the lines of a text that may be running headers."""
    if not text or not text.strip():
        return []
    lines = [x for x in text.split("\n") if x.strip()]
    if whole and len(lines) > 1:
        last = -1 if line_key(lines[-1]) not in ("", "#") else -2
        # a line that goes on in the next one is wrapped text
        first_form = not BODY_LINE.search(lines[0]) and not lines[1].lstrip()[:1].islower()
        chosen = [(lines[0], False, first_form)]
        if len(lines) + last > 0:
            last_form = not BODY_LINE.search(lines[last]) and not re.search(r"\d", lines[last]) and bool(re.search(r"[.!?:;]\W*$|\d\W*$", lines[last - 1]))
            chosen.append((lines[last], False, last_form))
    elif margin:
        chosen = [(" ".join(lines), True, True)]
    else:
        return []
    out: dict[str, tuple[str, bool, bool]] = {}
    for x, box, form in chosen:
        k = line_key(x)
        if k.strip("#"):
            out.setdefault(k, (k, box, form))
    return list(out.values())


def joined_key(keys: list[str]) -> str:
    """The key of lines written in one: numbers that meet are one sign."""
    out = ""
    for k in keys:
        out += k[1:] if k[:1] == "#" and out[-1:] == "#" else k
    return out


def all_keys(text: str | None) -> list[str]:
    """Keys under which a text may contain a header: its lines, and the whole text."""
    if not text:
        return []
    lines = [line_key(x) for x in text.split("\n") if x.strip()]
    return [k for k in dict.fromkeys([joined_key(lines), *lines]) if k.strip("#")]


def _time(df: DataFrame) -> DataFrame:
    return df.withColumn("at", F.coalesce(F.unix_micros(F.col("loaded_at").cast("timestamp")), F.lit(-(2**62)).cast("long")))


#: Tasks over which the rows of one document are spread when they meet its headers.
SALT = 32
MARKED = re.compile(r"[\\`{}~>]|\*\*|''")


def header_hits(rows: DataFrame, headers: DataFrame, fields: list[str], contains: bool) -> DataFrame:
    """(row_key, at, mask, lines, parts) of rows with a header of their document in one of the fields.

    lines: keys that a line of a field, or the whole of it, is; parts: keys that a field contains. A field is
    searched for contained headers if `contains`, or if it has markup, whose words would change a line's key.
    Rows and headers come in one stream sorted by (document, salt), headers first: only the headers of the
    document in hand are held.
    """
    salt = F.pmod(F.xxhash64("row_key"), F.lit(SALT)).cast("int")
    some = rows.filter(F.coalesce(*fields).isNotNull()).join(headers.select("document_id").distinct(), "document_id", "left_semi")
    a = some.select("document_id", salt.alias("salt"), F.lit(1).alias("turn"), "row_key", "at", *fields)
    none = F.lit(None).cast("string")
    b = headers.select("document_id", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"), F.lit(0).alias("turn"), F.lit(None).cast("long").alias("row_key"), F.lit(None).cast("long").alias("at"), F.col("key").alias(fields[0]), *[none.alias(f) for f in fields[1:]])
    stream = a.unionByName(b).repartition("document_id", "salt").sortWithinPartitions("document_id", "salt", "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        here, keys, tree = None, set(), None
        for b in batches:
            docs, salts, turn = (b.column(c).to_pylist() for c in ("document_id", "salt", "turn"))
            cols = [b.column(f).to_pylist() for f in fields]
            new = [t for t in dict.fromkeys(t for c in cols for t, k in zip(c, turn) if k) if t and t not in memo]
            if len(memo) > MEMO:
                memo.clear()
                new = list(dict.fromkeys(t for c in cols for t, k in zip(c, turn) if k and t))
            for t, n in zip(new, normalize(pa.array(new, pa.large_string()))[0].to_pylist() if new else ()):
                memo[t] = ([] if contains else all_keys(n), joined_key([line_key(x) for x in n.split("\n")]) if contains or MARKED.search(n) else "")
            idx, masks, lines, parts = [], [], [], []
            for i, (d, z, k) in enumerate(zip(docs, salts, turn)):
                if (d, z) != here:
                    here, keys, tree = (d, z), set(), None
                if not k:
                    keys.add(cols[0][i])
                    continue
                mask, mine, inner = 0, [], []
                for f, c in enumerate(cols):
                    if not c[i]:
                        continue
                    own, whole = memo[c[i]]
                    hit = [x for x in own if x in keys]
                    if whole:
                        if tree is None:
                            tree = ahocorasick.Automaton()
                            for x in keys:
                                tree.add_word(x, x)
                            tree.make_automaton()
                        within = [x for x in dict.fromkeys(x for _, x in tree.iter(whole)) if contains or x not in hit]
                    else:
                        within = []
                    if hit or within:
                        mask |= HEADER << (f * BITS)
                        mine += hit
                        inner += within
                if mask:
                    idx.append(i)
                    masks.append(mask)
                    lines.append(mine)
                    parts.append(inner)
            at = pa.array(idx, pa.int64())
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([b.column("row_key").take(at), b.column("at").take(at), pa.array(masks, pa.int64()), pa.array(lines, strings), pa.array(parts, strings)], names=["row_key", "at", "mask", "lines", "parts"])

    return stream.mapInArrow(run, "row_key long, at long, mask long, lines array<string>, parts array<string>")


def header_rows(elements: DataFrame, headers: DataFrame) -> DataFrame:
    """header_hits of elements, line by line."""
    return header_hits(elements.select("row_key", "at", "document_id", "text"), headers, ["text"], False)


def header_fields(rows: DataFrame, headers: DataFrame, fields: list[str]) -> DataFrame:
    """header_hits of one-line fields, which may contain a header."""
    return header_hits(rows.select("row_key", "at", "document_id", *fields), headers, fields, True)


def collect_lexicon(words: DataFrame, wrong: DataFrame):
    """The broadcast lexicon: frequent words and frequent misread forms."""
    total = words.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST, int(SHARE * total))
    frequent = [(r[0], r[1]) for r in words.filter(F.col("n") >= least).collect()]  # at most 1 / SHARE rows
    bad = {r[0]: r[1] for r in wrong.filter(f"n >= {least} and times >= {RATIO_FREQUENT} * n").select("word", "meant").collect()}  # frequent themselves
    return words.sparkSession.sparkContext.broadcast(Lexicon([x for x in frequent if x[0] not in bad], bad))


def looked_up(flagged: DataFrame, wrong: DataFrame) -> DataFrame:
    """(row_key, at, mask) of rows with a rare word that is a misread form."""
    rare = flagged.filter("size(rare) > 0").select("row_key", "at", F.explode("rare").alias("x"))
    rare = rare.select("row_key", "at", F.substring_index("x", ":", 1).cast("int").alias("f"), F.expr("substring(x, instr(x, ':') + 1)").alias("word"))
    return rare.join(wrong.select("word"), "word").select("row_key", "at", F.expr(f"shiftleft(cast({MISREAD} as long), f * {BITS})").alias("mask"))


def merged(parts: list[DataFrame]) -> DataFrame:
    """(row_key, mask): all bits of the latest delivery."""
    out = parts[0].select("row_key", "at", "mask")
    for p in parts[1:]:
        out = out.unionByName(p.select("row_key", "at", "mask"))
    both = out.groupBy("row_key", "at").agg(F.bit_or("mask").alias("mask"))
    return both.groupBy("row_key").agg(F.max(F.struct("at", "mask"))["mask"].alias("mask")).filter("mask <> 0")


CAND_FIELDS = ["line_text", "context_text"]


def analysed(artifacts: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, object]:
    """(elements with key, time and margin, (document_id, key) of headers, misread forms, the broadcast lexicon)."""
    artifacts = artifacts.select("artifact_id", "document_id", "engine_id", "text", "page_number", "bounding_box", "element_type", "loaded_at")
    pairs = cut(neighbours([(artifacts, ["text"]), (candidates, CAND_FIELDS)]))
    words = cut(word_counts(pairs))
    wrong = cut(misread_forms(words, pairs))
    lexicon = collect_lexicon(words, wrong)
    elements = _time(margins(artifacts)).withColumnRenamed("artifact_id", "row_key")
    return elements, cut(header_keys(elements)), wrong, lexicon


def element_flags(elements: DataFrame, lexicon) -> DataFrame:
    return cut(flags(elements.select("row_key", "at", "text", "page_number", "margin", "whole", "element_type"), "row_key", ["text"], lexicon, True))


def found(artifacts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(source_table, row_key, field_name, noise_kind)."""
    elements, headers, wrong, lexicon = analysed(artifacts, candidates)
    cands = _time(candidates.select("cand_id", "document_id", *CAND_FIELDS, "loaded_at")).withColumnRenamed("cand_id", "row_key")
    a = element_flags(elements, lexicon)
    c = cut(flags(cands.select("row_key", "at", *CAND_FIELDS), "row_key", CAND_FIELDS, lexicon, False))
    masks_a = merged([a, looked_up(a, wrong), header_rows(elements, headers)])
    masks_c = merged([c, looked_up(c, wrong), header_fields(cands, headers, CAND_FIELDS)])
    kinds = explode_masks(masks_a, ["text"], KINDS, BITS, "noise_kind", "raw_artifacts")
    return kinds.unionByName(explode_masks(masks_c, CAND_FIELDS, KINDS, BITS, "noise_kind", "candidates"))


def repair(text: str, wrong: dict[str, str], lex: Lexicon) -> str:
    """A text with its cut words joined and misread words put right."""

    def join(m: re.Match) -> str:
        a, b = (m.group(1), m.group(2)) if m.group(1) else (m.group(3), m.group(4))
        if f"{a}-{b}".lower() in lex.compounds:
            return f"{a}-{b}"
        if b[0].islower() or a.isupper() and b.isupper():
            return a + b
        return m.group()

    text = HYPHEN.sub(join, text)
    text = ALPHA.sub(lambda m: wrong.get(m.group(), m.group()), text)

    def fix(m: re.Match) -> str:
        w = m.group()
        if not _mixed(w, text, m.start(), lex):
            return w
        s = unread(w)
        if s.lower() in lex.lower:
            return s
        return next((x for x in reversals(w) if x.lower() in lex.lower), s)

    text = MIXED.sub(fix, text)
    return ODD_NUMBER.sub(lambda m: m.group().translate(str.maketrans("OolISBZ", "0011582")) if any(c.isdigit() for c in m.group()) else m.group(), text)


def fixes(rows: DataFrame, key: str, text: str, wrong: DataFrame, lexicon) -> DataFrame:
    """(key, fixes): {misread word: meant word} of every row that has one. Rare words are joined, each under its own key."""
    kind = dict(rows.dtypes)[key]

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = lexicon.value
        for b in batches:
            idx, out = [], []
            for i, t in enumerate(normalize(b.column(1))[0].to_pylist()):
                for w in set(ALPHA.findall(t)) - lex.words if t else ():
                    if w not in lex.bad:
                        idx.append(i)
                        out.append(w)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(idx, pa.int64())), pa.array(out, pa.string())], names=[key, "word"])

    words = rows.select(key, text).mapInArrow(rare, f"`{key}` {kind}, word string")
    hit = words.join(wrong.select("word", "meant"), "word").groupBy(key).agg(F.collect_set(F.struct("word", "meant")).alias("pairs"))
    return hit.select(key, F.map_from_entries("pairs").alias("fixes"))


def repaired(rows: DataFrame, text: str, lexicon) -> DataFrame:
    """rows with text repaired by the words of their column fixes (dropped) and the frequent misread forms."""
    keep = [n for n in rows.columns if n != "fixes"]
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = lexicon.value
        for b in batches:
            normal = normalize(b.column(text))[0].to_pylist()
            fixed = []
            for t, own in zip(normal, b.column("fixes").to_pylist()):
                if t is not None and not LAYOUT.search(t):
                    t = " ".join(repair(t, lex.meant | dict(own) if own else lex.meant, lex).split("\n"))
                fixed.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(fixed, pa.string()) if c == text else b.column(c) for c in keep], names=keep)

    return rows.mapInArrow(run, ", ".join(f"`{n}` {kinds[n]}" for n in keep))


LAYOUT = re.compile(r"\|\s*:?-{2,}|<t[dr]\b")


def without_pages(line: str) -> str:
    """A line without the page numbers printed in it; one that a sentence mentions stays."""
    if DASHED.fullmatch(line):
        return ""
    line = DASHED_FIRST.sub("", line)
    out, at = [], 0
    for m in PAGES.finditer(line):
        a, b = line[at : m.start()], line[m.end() :]
        last = not re.search(r"\w", b)
        if SEPARATED.search(a) and SEPARATES.match(b) or last and re.search(r"\d\s*(?:/|de|of|dc|0f)\s*\w+$", m.group(), re.I):
            out.append(re.sub(r"[\s\-–—|·•:;,]+$", " ", a) if last else a)
            at = m.end()
    return "".join(out) + line[at:]


def without_noise(text: str, page: bool, lines: list[str], parts: list[str]) -> str:
    """A text in its consistent form without the header lines of these keys and, if page, without page numbers; empty if nothing else is left.

    parts: keys of headers amid markup; they are cut out where they begin or end a line.
    """
    rows = text.split("\n")
    if lines:
        keys = set(lines)
        if joined_key([line_key(x) for x in rows if x.strip()]) in keys:
            return ""
        rows = [x for x in rows if not x.strip() or line_key(x) not in keys]
    if parts:
        text = "\n".join(rows)
        for key in sorted(parts, key=len, reverse=True):
            words = key_words(text)
            starts, ends, at = {}, {}, 0
            for x, a, b in words:
                starts.setdefault(at, a)
                at += len(x)
                ends[at] = b
            whole = "".join(x for x, _, _ in words)
            at = whole.find(key)
            while at >= 0:
                a, b = starts.get(at), ends.get(at + len(key))
                if a is not None and b is not None:
                    before, after = text[:a].rsplit("\n", 1)[-1], text[b:].split("\n", 1)[0]
                    if not line_key(before) or not line_key(after):
                        text = text[:a] + text[b:]
                        break
                at = whole.find(key, at + 1)
        rows = [x for x in text.split("\n") if line_key(x) or PAGES.search(x) or not SPOILT.search(x)]
    if page:
        if any(PAGES.search(x) or DASHED.search(x) or DASHED_FIRST.match(x) for x in rows):
            rows = [y for x in rows if (y := without_pages(x)) == x or re.search(r"\w", SPOILT.sub(" ", y))]
        else:
            last = max((i for i, x in enumerate(rows) if x.strip()), default=-1)
            if last >= 0 and BARE_PAGE.fullmatch(rows[last]):
                del rows[last]
    if not re.search(r"\w", SPOILT.sub(" ", "\n".join(rows))):
        return ""
    return "\n".join(rows)


def cleared(rows: DataFrame) -> DataFrame:
    """rows with text rid of its noise. rows: with at and noise (what was seen in each delivery), which are dropped."""
    keep = [n for n in rows.columns if n not in ("at", "noise")]
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, noise, at = (b.column(c).to_pylist() for c in ("text", "noise", "at"))
            hit = [i for i, x in enumerate(noise) if x and text[i]]
            for i, t in zip(hit, normalize(pa.array([text[i] for i in hit], pa.large_string()))[0].to_pylist() if hit else ()):
                seen = [x for x in noise[i] if x["at"] == at[i]]
                if seen:
                    text[i] = without_noise(t, any(x["mask"] & PAGE for x in seen), [k for x in seen for k in x["lines"]], list({k for x in seen for k in x["parts"]}))
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()) if c == "text" else b.column(c) for c in keep], names=keep)

    return rows.mapInArrow(run, ", ".join(f"`{n}` {kinds[n]}" for n in keep))


def reflowed(artifacts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(document_id, engine_id, page_number, paragraph_no, paragraph): continuous paragraphs of every page.

    Header lines and page numbers are taken out, and elements of nothing else dropped; a paragraph goes on in the
    next element unless it ends a sentence or the next one is a heading, a label or a table.
    """
    elements, keys, wrong, lexicon = analysed(artifacts, candidates)
    headers, marked = header_rows(elements, keys), element_flags(elements, None)
    at = F.coalesce(F.unix_micros(F.col("loaded_at").cast("timestamp")), F.lit(-(2**62)).cast("long"))
    base = artifacts.groupBy("artifact_id").agg(F.max(F.struct(at.alias("at"), "document_id", "engine_id", "page_number", "ordinal", "element_type", "text")).alias("r")).select("artifact_id", "r.*")
    none = F.array().cast("array<string>")
    noise = headers.select("row_key", "at", "mask", "lines", "parts").unionByName(marked.filter(F.col("mask").bitwiseAND(PAGE) != 0).select("row_key", "at", "mask", none.alias("lines"), none.alias("parts")))
    noise = noise.groupBy(F.col("row_key").alias("artifact_id")).agg(F.collect_list(F.struct("at", "mask", "lines", "parts")).alias("noise"))
    both = base.join(noise, "artifact_id", "left").join(fixes(base, "artifact_id", "text", wrong, lexicon), "artifact_id", "left")
    kept = cleared(both).filter("text is not null and trim(text) <> ''")
    fixed = repaired(kept, "text", lexicon)
    w = Window.partitionBy("document_id", "engine_id", "page_number").orderBy("ordinal", "artifact_id")
    before, kind = F.lag("text").over(w), F.lag("element_type").over(w)
    starts = before.isNull() | before.rlike("[.!?:;]\\s*$") | (kind != F.col("element_type")) | ~F.col("text").rlike("^\\s*[a-zà-ú]")
    para = fixed.withColumn("paragraph_no", F.sum(starts.cast("int")).over(w))
    parts = para.groupBy("document_id", "engine_id", "page_number", "paragraph_no").agg(F.array_sort(F.collect_list(F.struct("ordinal", "artifact_id", "text"))).alias("p"))
    text = F.regexp_replace(F.array_join(F.transform("p", lambda x: x["text"]), " "), "([a-zà-ú])[-‐¬] ([a-zà-ú])", "$1$2")
    return parts.select("document_id", "engine_id", "page_number", "paragraph_no", text.alias("paragraph"))


def repaired_fields(artifacts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(source_table, row_key, field_name, repaired_text): line_text and context_text of the latest delivery of every candidate.

    Headers of the candidate's document and page numbers are taken out, cut and misread words repaired; null stays null.
    """
    _, headers, wrong, lexicon = analysed(artifacts, candidates)
    at = F.coalesce(F.unix_micros(F.col("loaded_at").cast("timestamp")), F.lit(-(2**62)).cast("long"))
    base = candidates.groupBy(F.col("cand_id").alias("row_key")).agg(F.max(F.struct(at.alias("at"), "document_id", *CAND_FIELDS)).alias("r")).select("row_key", "r.*")
    fields = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in CAND_FIELDS])
    long = base.select("row_key", "at", "document_id", F.explode(fields).alias("x")).select("row_key", "at", "document_id", "x.*").withColumn("id", F.concat_ws(":", "row_key", "field_name"))
    inside = header_fields(base, headers, CAND_FIELDS)
    hit = F.array_compact(F.array(*[F.when(F.col("mask").bitwiseAND(HEADER << (i * BITS)) != 0, F.lit(f)) for i, f in enumerate(CAND_FIELDS)]))
    noise = inside.select(F.explode(hit).alias("field_name"), "row_key", F.struct("at", F.lit(HEADER | PAGE).cast("long").alias("mask"), "lines", "parts").alias("n"))
    noise = noise.groupBy(F.concat_ws(":", "row_key", "field_name").alias("id")).agg(F.collect_list("n").alias("noise"))
    none = F.array().cast("array<string>")
    every = F.array(F.struct(F.col("at"), F.lit(PAGE).cast("long").alias("mask"), none.alias("lines"), none.alias("parts")))  # page numbers are looked for in every field
    both = long.join(noise, "id", "left").withColumn("noise", F.coalesce("noise", every)).join(fixes(long.filter("text is not null"), "id", "text", wrong, lexicon), "id", "left")
    done = repaired(cleared(both.drop("document_id", "id")), "text", lexicon)
    return done.select(F.lit("candidates").alias("source_table"), "row_key", "field_name", F.col("text").alias("repaired_text"))
