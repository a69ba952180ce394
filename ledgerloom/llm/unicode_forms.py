"""Problem 4: one consistent form for texts that look alike.

Arrow text buffers become numpy code-point arrays; every step is a table gather, a scatter, a sort or a
cumulative sum over the whole batch. No Python string is made for a row. Letters with marks are taken apart,
their marks put in canonical order and composed again, so that it does not matter in which order they were typed.

Results for odd input: null stays null and has no form; empty stays empty; a text of marks only keeps
them (nothing to compose with); ties and repeated rows do not matter (row-wise); extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_text, explode_masks

KINDS = ["full_width", "combining", "zero_width", "odd_space", "look_alike"]
FULL, COMB, ZERO, SPACE, ALIKE, LATIN, LETTER, GREEKCYR = (1 << i for i in range(8))

# Greek and Cyrillic letters and the Latin letters they look like.
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹαικνορυχϲϳ", "ABEZHIKMNOPTYXCaikvopuxcj")
CYRILLIC = ("АВЕЅІЈКМНОРСТУХЗҺаеѕіјкорсухһԁԛԝӏ", "ABESIJKMHOPCTYX3haesijkopcyxhdqwl")
#: Spaces other than the ordinary one; the ideographic space counts as full-width.
SPACES = [0x00A0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F]
#: Invisible characters.
INVISIBLE = [0x00AD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), 0xFEFF]
TOP = 0x110000


def offsets(long: dict[int, list[int]], width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each code point's expansion begins, all expansions in a row); their lengths go into width."""
    at = np.zeros(TOP, np.int32)
    to: list[int] = []
    for c, x in long.items():
        at[c], width[c] = len(to), len(x)
        to += x
    return at, np.array(to, np.uint32)


def expanded(out: np.ndarray, cp: np.ndarray, start: np.ndarray, width: np.ndarray, at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, row starts): out where the width is one, the expansion of cp where it is more, nothing where it is none."""
    where = np.concatenate([[0], np.cumsum(width)])
    res = np.zeros(where[-1], np.uint32)
    one = width == 1
    res[where[:-1][one]] = out[one]
    many = np.flatnonzero(width > 1)
    if len(many):
        n = width[many]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        res[np.repeat(where[many], n) + inner] = to[np.repeat(at[cp[many]], n) + inner]
    return res, where[start]


def composed(res: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, row starts) with the marks of every letter in canonical order and composed with it as far as they go."""
    t = Tables.get()
    if not (t.order[res] > 0).any():
        return res, start
    begins = np.zeros(len(res) + 1, bool)
    begins[start] = True
    follows = np.append(t.order[res[1:]] > 0, False) & ~begins[1:]  # a mark comes next
    width = np.where(follows | (t.order[res] > 0), t.apart[res], 1).astype(np.int64)
    if (width > 1).any():
        res, start = expanded(res, res, start, width, t.apart_at, t.apart_to)
        begins = np.zeros(len(res) + 1, bool)
        begins[start] = True
    mark = np.flatnonzero(t.order[res] > 0)
    fresh = np.ones(len(mark), bool)
    fresh[1:] = (mark[1:] != mark[:-1] + 1) | begins[mark[1:]]
    run = np.cumsum(fresh) - 1
    res[mark] = res[mark[np.lexsort((mark, t.order[res[mark]], run))]]
    first = mark[fresh]
    length = np.bincount(run)
    has = ~begins[first] & (first > 0)  # marks that begin a text have no letter
    first, length = first[has], length[has]
    last = np.zeros(len(first), np.uint8)
    keep = np.ones(len(res), bool)
    live, k = np.arange(len(first)), 0
    while len(live):
        at = first[live] + k
        own = t.order[res[at]]
        key = (res[first[live] - 1].astype(np.uint64) << np.uint64(21)) | res[at].astype(np.uint64)
        j = np.minimum(np.searchsorted(t.pair_keys, key), len(t.pair_keys) - 1)
        ok = (t.pair_keys[j] == key) & ((last[live] == 0) | (last[live] < own))
        res[first[live[ok]] - 1] = t.pair_to[j[ok]]
        keep[at[ok]] = False
        last[live[~ok]] = own[~ok]
        k += 1
        live = live[length[live] > k]
    return res[keep], np.concatenate([[0], np.cumsum(keep)])[start]


class Tables:
    """Lookup tables over code points, made once a worker."""

    _own: "Tables | None" = None

    def __init__(self) -> None:
        cls = np.zeros(TOP, np.uint8)
        cls[np.r_[0xFF01:0xFF5F, 0xFFE0:0xFFE7, 0x3000]] |= FULL
        marks = np.r_[0x0300:0x034F, 0x0350:0x0370, 0x1AB0:0x1AC0, 0x1DC0:0x1E00, 0x20D0:0x20F1]
        cls[marks] |= COMB
        cls[np.array(INVISIBLE)] |= ZERO
        cls[np.array(SPACES)] |= SPACE
        letters = [c for c in range(0x41, 0x2E80) if unicodedata.category(chr(c))[0] == "L"]
        cls[np.array(letters)] |= LETTER
        latin = [c for c in letters if c < 0x250 or 0x1E00 <= c < 0x1F00]
        wide = np.r_[0xFF21:0xFF3B, 0xFF41:0xFF5B]
        cls[np.array(latin)] |= LATIN
        cls[wide] |= LATIN | LETTER
        cls[np.r_[0x0370:0x0530]] |= GREEKCYR & 0xFF
        to = np.arange(TOP, dtype=np.uint32)
        to[0xFF01:0xFF5F] = np.arange(0x21, 0x7F)
        to[0x3000] = 0x20
        to[np.array(SPACES)] = 0x20
        alike = np.zeros(TOP, np.uint32)
        for a, b in (GREEK, CYRILLIC):
            for x, y in zip(a, b):
                if y.isalpha():
                    alike[ord(x)] = ord(y)
        cls[alike > 0] |= ALIKE
        # compatibility characters that become several: offsets into one array
        long = {c: [ord(x) for x in unicodedata.normalize("NFKC", chr(c)).replace("⁄", "/")] for c in [*range(0xFB00, 0xFB07), 0x2026, 0x2025, 0x00BC, 0x00BD, 0x00BE, 0x2103]}
        width = np.ones(TOP, np.uint8)
        width[np.array(INVISIBLE)] = 0
        self.long_at, self.long_to = offsets(long, width)
        # letters with marks: their full decomposition, and the classes that order marks
        apart = {}
        for c in range(0xC0, 0x3000):
            if unicodedata.decomposition(chr(c)) and unicodedata.decomposition(chr(c))[0] != "<":
                x = unicodedata.normalize("NFC", chr(c))
                if len(x) == 1:
                    to[c] = ord(x)
                apart[c] = [ord(y) for y in unicodedata.normalize("NFD", x)]
        self.apart = np.ones(TOP, np.uint8)
        self.apart_at, self.apart_to = offsets(apart, self.apart)
        order = np.zeros(TOP, np.uint8)
        order[marks] = [unicodedata.combining(chr(c)) for c in marks]
        self.order = order
        pairs = {}
        for c in range(0xC0, 0x2000):
            d = unicodedata.decomposition(chr(c))
            if d and d[0] != "<" and " " in d and unicodedata.normalize("NFC", chr(c)) == chr(c):
                a, b = (int(x, 16) for x in d.split())
                pairs[(a << 21) | b] = c
        keys = np.array(sorted(pairs), np.uint64)
        self.pair_keys, self.pair_to = keys, np.array([pairs[int(k)] for k in keys], np.uint32)
        self.cls, self.to, self.alike, self.width = cls, to, alike, width
        low = np.arange(TOP, dtype=np.uint32)
        for c in range(0x250):
            x = unicodedata.normalize("NFD", chr(c).lower())[0] if chr(c).isalpha() and c not in (0xAA, 0xBA) else chr(c)
            low[c] = ord(x)
        low[[9, 10, 13]] = 32
        words = np.full(TOP, 32, np.uint32)
        words[cls & LETTER != 0] = low[cls & LETTER != 0]
        self.low, self.words = low, words

    @classmethod
    def get(cls) -> "Tables":
        if cls._own is None:
            cls._own = cls()
        return cls._own


def decode(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a batch and where each row starts (one more than rows)."""
    arr = arrow_text(arr).fill_null("")
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(bufs[2], np.uint8)[off[0] : off[-1]] if bufs[2] is not None and len(off) else np.zeros(0, np.uint8)
    off = off - off[0]
    if not len(raw) or raw.max() < 0x80:
        return raw.astype(np.uint32), off
    lead = (raw & 0xC0) != 0x80
    pos = np.flatnonzero(lead)
    pad = np.concatenate([raw, np.zeros(3, np.uint8)])
    cp = pad[pos].astype(np.uint32)
    for low, high, n, keep in ((0xC0, 0xE0, 1, 0x1F), (0xE0, 0xF0, 2, 0x0F), (0xF0, 0x100, 3, 0x07)):
        at = np.flatnonzero((cp >= low) & (cp < high) & (pad[pos] >= low))
        if len(at):
            p = pos[at]
            v = cp[at] & keep
            for k in range(1, n + 1):
                v = (v << 6) | (pad[p + k] & 0x3F)
            cp[at] = v
    return cp, np.concatenate([[0], np.cumsum(lead)])[off]


def encode(cp: np.ndarray, start: np.ndarray, valid: pa.Array | None) -> pa.Array:
    """Code points back to an Arrow large_string array."""
    size = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
    at = np.concatenate([[0], np.cumsum(size)])
    raw = np.zeros(at[-1], np.uint8)
    p = at[:-1]
    one = size == 1
    raw[p[one]] = cp[one]
    for n, head in ((2, 0xC0), (3, 0xE0), (4, 0xF0)):
        m = np.flatnonzero(size == n)
        if len(m):
            c, q = cp[m], p[m]
            raw[q] = head | (c >> (6 * (n - 1)))
            for k in range(1, n):
                raw[q + k] = 0x80 | ((c >> (6 * (n - 1 - k))) & 0x3F)
    out = pa.Array.from_buffers(pa.large_string(), len(start) - 1, [None, pa.py_buffer(at[start].astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())])
    if valid is not None and valid.null_count:
        out = pa.compute.if_else(valid.is_valid(), out, pa.scalar(None, pa.large_string()))
    return out


def forms(cp: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits of KINDS per row, which code points are look-alikes to replace)."""
    t = Tables.get()
    rows = len(start) - 1
    kinds = np.zeros(rows, np.int64)
    swap = np.zeros(len(cp), bool)
    if not len(cp):
        return kinds, swap
    cl = t.cls[cp]
    odd = cl & (FULL | COMB | ZERO | SPACE | ALIKE)
    hit = np.flatnonzero(odd)
    if not len(hit):
        return kinds, swap
    row = np.searchsorted(start, hit, side="right") - 1
    np.bitwise_or.at(kinds, row, (odd[hit] & FULL).astype(np.int64))
    np.bitwise_or.at(kinds, row, np.where(odd[hit] & ZERO, 4, 0))
    np.bitwise_or.at(kinds, row, np.where(odd[hit] & SPACE, 8, 0))
    # what follows needs neighbours without invisible characters
    see = np.flatnonzero((cl & ZERO) == 0)
    c = cl[see]
    r = np.searchsorted(start, see, side="right") - 1
    comb = np.flatnonzero((c & COMB) != 0)
    comb = comb[comb > 0]
    comb = comb[((c[comb - 1] & (LETTER | COMB)) != 0) & (r[comb - 1] == r[comb])]
    np.bitwise_or.at(kinds, r[comb], 2)
    if (c & ALIKE).any():
        word = (c & (LETTER | COMB)) != 0
        new = np.empty(len(c), bool)
        new[0] = True
        new[1:] = (word[1:] != word[:-1]) | (r[1:] != r[:-1])
        run = np.cumsum(new) - 1
        n = run[-1] + 1
        has = np.zeros(n, bool)
        has[run[((c & LATIN) != 0) & word]] = True
        # a letter of the other script without a Latin twin: a foreign word or a symbol
        alien = np.zeros(n, bool)
        alien[run[word & ((c & GREEKCYR) != 0) & ((c & ALIKE) == 0)]] = True
        # a short word that lost all its letters to look-alikes: the text around it is Latin throughout
        rows_latin = np.zeros(rows, bool)
        rows_latin[r[(c & LATIN) != 0]] = True
        rows_alien = np.zeros(rows, bool)
        rows_alien[r[word & ((c & GREEKCYR) != 0) & ((c & ALIKE) == 0)]] = True
        around = rows_latin[r] & ~rows_alien[r]
        bad = ((c & ALIKE) != 0) & (has[run] & ~alien[run] | around)
        swap[see[bad]] = True
        np.bitwise_or.at(kinds, r[bad], 16)
    return kinds, swap


def normalize(arr: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The consistent form of every text and the KINDS bits that were found."""
    arr = arrow_text(arr)
    cp, start = decode(arr)
    t = Tables.get()
    kinds, swap = forms(cp, start)
    if not kinds.any() and not ((t.width[cp] != 1) | (t.to[cp] != cp) | (t.order[cp] > 0)).any():
        return arr, kinds
    out = t.to[cp]
    out[swap] = t.alike[cp[swap]]
    res, start = expanded(out, cp, start, t.width[cp].astype(np.int64), t.long_at, t.long_to)
    res, start = composed(res, start)
    return encode(res, start, arr), kinds


def bare_forms(arr: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Of texts in their consistent form: (lower case without accents, the same with spaces for all but letters), as long as the texts."""
    cp, start = decode(arr)
    t = Tables.get()
    return encode(t.low[cp], start, None), encode(t.words[cp], start, None)


def kinds_of(arr: pa.Array) -> np.ndarray:
    return forms(*decode(arr))[0]


def normalized(df: DataFrame, field: str, out: str = "normalized_text") -> DataFrame:
    """df with the consistent form of a text column (other columns unchanged)."""
    if out in df.columns:
        raise ValueError(f"column {out} exists already")
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + f", `{out}` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                text, _ = normalize(b.column(field))
                yield pa.RecordBatch.from_arrays([*b.columns, text.cast(pa.string())], names=[*b.schema.names, out])

    return df.mapInArrow(run, schema)


def found(df: DataFrame, key: str, field: str, source: str) -> DataFrame:
    """(source_table, row_key, field_name, form_kind) of the latest delivery of every key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(kinds_of(b.column(2)))], names=["row_key", "at", "mask"])

    at = F.coalesce(F.unix_micros(F.col("loaded_at").cast("timestamp")), F.lit(-(2**62)).cast("long"))
    src = df.select(F.col(key).cast("long").alias("row_key"), at.alias("at"), F.col(field).alias("t"))
    got = src.mapInArrow(run, "row_key long, at long, mask long")
    masks = got.groupBy("row_key").agg(F.max(F.struct("at", "mask"))["mask"].alias("mask")).filter("mask <> 0")
    return explode_masks(masks, [field], KINDS, 8, "form_kind", source)
