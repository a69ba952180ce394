"""Problem 9: texts over a size cut into pieces at natural boundaries, with an overlap.

Agglomerative merging: a text is cut into atomic segments (lines and sentences; a longer one into clauses,
words, and at last characters). Adjacent segments stand in a heap by the strength of the boundary between
them, then by their joint size; the weakest boundary is merged first, as long as both segments with the
overlap fit. What is left are the pieces, cut at the strongest boundaries that the size allows. A piece
after the first begins with the last words of the piece before, as many as fit into the overlap.

Odd input: null and empty texts and those that fit have no pieces; blanks between pieces belong to none;
a word longer than the size is cut between characters; repeated rows are cut alike.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tok import CHUNK, VOCABULARY, encoding

MEMO = 400_000
#: Strength of boundaries: word, clause, sentence, line, paragraph, heading.
WORD, CLAUSE, SENTENCE, LINE, PARAGRAPH, HEADING = range(6)
KINDS = ["word", "clause", "sentence", "line", "paragraph", "heading"]


class Counter:
    """Token counts and boundary strengths of chunks, kept while they are few."""

    def __init__(self, path: str) -> None:
        self.enc = encoding(path)
        self.memo: dict[str, tuple[int, int, int]] = {}
        self.bare: dict[str, int] = {}

    def look(self, chunk: str) -> tuple[int, int, int]:
        """(tokens, strength of the boundary before it, strength of the boundary after it)."""
        n = len(self.enc.encode_ordinary(chunk))
        lead = 0
        if "\n" in chunk or "\r" in chunk or "\f" in chunk:
            body = chunk.lstrip()
            blanks = chunk[: len(chunk) - len(body)]
            lines = blanks.count("\n") + (blanks.count("\r") if "\n" not in blanks else 0)
            lead = 0 if not lines else PARAGRAPH if lines > 1 or "\f" in blanks else LINE
            if lines and (body.startswith("#") or body.startswith("==")):
                lead = HEADING
        end = chunk.rstrip("\"')]*_»”")[-1:]
        trail = SENTENCE if end in ".!?…" and end and not chunk.strip()[:-1].replace(".", "").isdigit() else CLAUSE if end in ";:," and end else WORD
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[chunk] = x = (n, lead, trail)
        return x

    def stripped(self, chunk: str) -> int:
        """Tokens of a chunk without the blanks before it."""
        n = self.bare.get(chunk)
        if n is None:
            if len(self.bare) >= MEMO:
                self.bare.clear()
            n = self.bare[chunk] = len(self.enc.encode_ordinary(chunk.lstrip()))
        return n

    def short(self, chunk: str, most: int) -> list[str]:
        """A chunk of more than most tokens cut between characters into parts of at most most."""
        out: list[str] = []
        step = most
        at = 0
        while at < len(chunk):
            n = min(len(chunk) - at, step * 4)
            while n > 1 and len(self.enc.encode_ordinary(chunk[at : at + n])) > most:
                n = max(1, n * 3 // 4)
            out.append(chunk[at : at + n])
            at += n
        return out


def merge(sizes: list[int], strength: list[int], room: int) -> list[int]:
    """First segments of the pieces: adjacent segments merged, weakest boundary first, up to room tokens.

    strength[i] is that of the boundary before segment i.
    """
    n = len(sizes)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    size = list(sizes)
    heap = [(strength[i], size[i - 1] + size[i], i) for i in range(1, n) if size[i - 1] + size[i] <= room]
    heapq.heapify(heap)
    live = [True] * n
    while heap:
        s, total, i = heapq.heappop(heap)
        if not live[i]:
            continue
        a = left[i]
        if size[a] + size[i] != total:  # a neighbour has grown since
            if size[a] + size[i] <= room:
                heapq.heappush(heap, (s, size[a] + size[i], i))
            continue
        live[i] = False
        size[a] = total
        right[a] = b = right[i]
        if b < n:
            left[b] = a
    return [i for i in range(n) if live[i]]


def split_text(text: str, limits: list[tuple[int, int, int]], counter: Counter) -> list[tuple[int, int, int, int, int, int, int, str]]:
    """(limit_id, piece_no, begin, end, new_from, tokens, overlap, boundary kind) of every piece for every limit that the text exceeds."""
    chunks = CHUNK.findall(text)
    memo, look = counter.memo, counter.look
    info = [memo.get(c) or look(c) for c in chunks]
    total = sum(x[0] for x in info)
    out: list[tuple[int, int, int, int, int, int, int, str]] = []
    least = min((m - o for _, m, o in limits if total > m), default=0)
    if not least:
        return out
    if any(x[0] > least for x in info):
        small: list[str] = []
        glued: set[int] = set()
        for c, x in zip(chunks, info):
            if x[0] > least:
                parts = counter.short(c, least)
                glued.update(range(len(small) + 1, len(small) + len(parts)))
                small += parts
            else:
                small.append(c)
        chunks = small
        info = [memo.get(c) or look(c) for c in chunks]
    else:
        glued = set()
    n = len(chunks)
    counts = [x[0] for x in info]
    begin = [0] * (n + 1)
    cum = [0] * (n + 1)
    for i, c in enumerate(chunks):
        begin[i + 1] = begin[i] + len(c)
        cum[i + 1] = cum[i] + counts[i]
    strength = [0] * n
    for i in range(1, n):
        a, b = info[i][1], info[i - 1][2]
        strength[i] = a if a > b else b
    for i in glued:
        strength[i] = -1
    # atoms are the same for every limit but for those that are too large
    for limit_id, most, lap in limits:
        if total <= most:
            continue
        room = most - lap
        starts = [0] + [i for i in range(1, n) if strength[i] >= SENTENCE]
        starts = _refine(starts, n, cum, strength, room, CLAUSE)
        starts = _refine(starts, n, cum, strength, room, -1)
        ends = starts[1:] + [n]
        first = merge([cum[b] - cum[a] for a, b in zip(starts, ends)], [strength[a] for a in starts], room)
        heads = [starts[i] for i in first]
        no = 0
        for h, e in zip(heads, heads[1:] + [n]):
            k = h
            if h:
                while k > 0 and cum[h] - cum[k - 1] <= lap:
                    k -= 1
                while k < h and cum[e] - cum[k] - counts[k] + counter.stripped(chunks[k]) > most:
                    k += 1
            lead = len(chunks[k]) - len(chunks[k].lstrip())
            tokens = cum[e] - cum[k] - counts[k] + counter.stripped(chunks[k])
            if begin[k] + lead >= begin[e]:
                continue  # blanks only
            if glued:  # parts of one word may count fewer tokens together
                tokens = len(counter.enc.encode_ordinary(text[begin[k] + lead : begin[e]]))
            fresh = begin[h] + (len(chunks[h]) - len(chunks[h].lstrip()))
            out.append((limit_id, no, begin[k] + lead, begin[e], fresh, tokens, cum[h] - cum[k], "start" if not h else KINDS[max(0, strength[h])]))
            no += 1
    return out


def _refine(starts: list[int], n: int, cum: list[int], strength: list[int], room: int, least: int) -> list[int]:
    """Starts with every segment over room cut where the strength is at least `least`; -1: anywhere, by size."""
    out: list[int] = []
    for a, b in zip(starts, starts[1:] + [n]):
        out.append(a)
        if cum[b] - cum[a] <= room:
            continue
        if least > -1:
            out += [i for i in range(a + 1, b) if strength[i] >= least]
            continue
        at = a
        for i in range(a + 1, b + 1):
            if cum[i] - cum[at] > room:
                out.append(i - 1)
                at = i - 1
    return out


def pieces(corpus: DataFrame, limits: list[tuple[int, int, int]], doc: str = "doc_id", path: str = VOCABULARY) -> DataFrame:
    """(limit_id, doc_id, piece_no, begin, end, new_from, tokens, overlap_tokens, boundary, piece).

    limits: (limit_id, most tokens, overlap tokens). begin and end are character offsets; the overlap with
    the piece before reaches to new_from; boundary is the kind of cut before the piece.
    """
    names = ["limit_id", "doc_id", "piece_no", "begin", "end", "new_from", "tokens", "overlap_tokens", "boundary", "piece"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)

        def batch(rows: list) -> pa.RecordBatch:
            cols = zip(*rows) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)

        rows: list = []
        held = 0
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                text = t.as_py()
                if not text:
                    continue
                for p in split_text(text, limits, counter):
                    rows.append((p[0], d, *p[1:], text[p[2] : p[3]]))
                    held += p[3] - p[2]
                if held > 2_000_000:
                    yield batch(rows)
                    rows, held = [], 0
        yield batch(rows)

    schema = "limit_id int, doc_id long, piece_no int, begin int, end int, new_from int, tokens int, overlap_tokens int, boundary string, piece string"
    return corpus.selectExpr(f"cast(`{doc}` as long) doc_id", "text").filter("text is not null").mapInArrow(run, schema)


def split(corpus: DataFrame, limits: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """pieces() over the `split` rows of size_limits."""
    rows = limits.filter("purpose = 'split'").select("limit_id", "max_tokens", "overlap_tokens").orderBy("limit_id").collect()
    return pieces(corpus, [tuple(r) for r in rows], path=path)


def rebuilt(cut_up: DataFrame, corpus: DataFrame, limits: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(limit_id, doc_id, n_chars, digest) of every document and limit: the text put together from the pieces, without their overlaps and blanks.

    A document that has no pieces under a limit fits it and is taken as it is. The parts of one document meet in one row, as its text did.
    """
    fresh = F.regexp_replace(F.substring(F.col("piece"), F.col("new_from") - F.col("begin") + 1, F.length("piece")), r"[\s\x{85}\p{Z}]+", "")
    whole = cut_up.groupBy("limit_id", "doc_id").agg(F.array_sort(F.collect_list(F.struct("piece_no", fresh.alias("t")))).alias("p"))
    whole = whole.select("limit_id", "doc_id", F.array_join(F.transform("p", lambda x: x["t"]), "").alias("joined"))
    every = corpus.select(F.col(doc).cast("long").alias("doc_id"), "text").filter("text is not null").crossJoin(F.broadcast(limits.filter("purpose = 'split'").select("limit_id")))  # a handful of limits
    both = every.join(whole, ["limit_id", "doc_id"], "left")
    text = F.coalesce("joined", F.regexp_replace("text", r"[\s\x{85}\p{Z}]+", ""))
    return both.select("limit_id", "doc_id", F.length(text).alias("n_chars"), F.md5(text.cast("binary")).alias("digest"))
