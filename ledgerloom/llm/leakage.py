"""Problem 8: passages of held-out items inside a corpus.

A set join with a prefix filter. Texts are sets of three-word shingles in bare lower case. Only an item's
own shingles count: those of one item text, or of several that are versions of one (see `versions`; each of them
is reported). Shared instructions, notices and stock phrases stand in texts of other content and drop out. Items of
equal words are one text, and each of them is reported. Shingles are ordered by rarity in the corpus; of
every item-sized window all but its `need` - 1 most frequent shingles are the prefix, and a document that
shares `need` shingles of a window has one of its prefix. Pairs that pass are bounded by length (distinct
shared shingles) and by position (as many of them must follow each other in the item's order: the longest
increasing run of their places), and then verified over item-sized windows: around each group of shared
shingles the document is cut into stretches of the item's length, the blocks of words that agree exactly are
chained in the order of both, and some run of the item of at least `words` words must be there but for single
words. The items are broadcast in parts of at most `MOST_CHARS` characters, one pass over the corpus for each;
the corpus is never shuffled, only (shingle, count) and the found pairs are.

Odd input: null, empty and blank documents contain nothing; items too short for `words` words, or without
own shingles, are found nowhere; very long texts are read whole; repeated documents count each; an item_id
given twice, with one text or with two, is one item.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_text
from .common import cut as checkpointed
from .unicode_forms import Tables, decode, normalize

SIZE = 3
WORDS = 20
NEED = 6
ALIKE = 0.4  # of a text's shingles; as many are left when every fifth word has been changed
MOST_CHARS = 10_000_000
SLICE = 1_000_000  # characters that are held as numbers at once
_M1, _M2, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BI = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def slices(arr: pa.Array, most: int = SLICE) -> Iterator[tuple[int, pa.Array]]:
    """(first row, part) of parts of about `most` bytes; a longer text is a part of its own."""
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    at = 0
    while at < len(arr):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        yield at, arr.slice(at, to - at)
        at = to


def tokens(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token of letters and digits, row starts in tokens); texts in any form."""
    cp, start = decode(normalize(arr)[0])
    t = Tables.get()
    low = t.low[cp]
    word = ((t.cls[cp] & 64) != 0) & (low != 0xAA) & (low != 0xBA) | (low >= 48) & (low <= 57)
    edge = np.zeros(len(cp) + 1, bool)
    edge[start] = True
    w = np.concatenate([[False], word, [False]])
    begin = np.flatnonzero(w[1:-1] & (~w[:-2] | edge[:-1])) if len(cp) else np.zeros(0, np.int64)
    end = np.flatnonzero(w[1:-1] & (~w[2:] | edge[1:])) + 1 if len(cp) else np.zeros(0, np.int64)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(start), np.int64)
    power = np.ones(len(cp) + 1, np.uint64)
    np.multiply.accumulate(np.full(len(cp), _B), out=power[1:])
    inverse = np.ones(len(cp) + 1, np.uint64)
    np.multiply.accumulate(np.full(len(cp), _BI), out=inverse[1:])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(7)) * power[:-1], dtype=np.uint64)])
    h = mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    return h, np.searchsorted(begin, start)


def shingles(h: np.ndarray) -> np.ndarray:
    """Hashes of SIZE following tokens (of one row, or of many: the caller drops those over a row's end)."""
    if len(h) < SIZE:
        return np.zeros(0, np.uint64)
    s = np.zeros(len(h) - SIZE + 1, np.uint64)
    for k in range(SIZE):
        s = mix(s * _M2 + h[k : k + len(s)])
    return s


def item_tokens(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """(tokens of an item, the number of the blank-separated word of each, words): "14.643,69" is one word of three tokens."""
    parts = (normalize(pa.array([text or ""], pa.large_string()))[0][0].as_py()).split()
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    h, start = tokens(pa.array(parts, pa.large_string()))
    n = np.diff(start)
    full = np.flatnonzero(n)
    return h, np.repeat(np.arange(len(full)), n[full]), len(full)


class Items:
    """Distinct item texts as arrays: their ids, tokens, words and own shingles."""

    def __init__(self, ids: list[list[int]], texts: list[str], own: np.ndarray) -> None:
        """ids: the items of each text; own: sorted shingles that only one text of the whole benchmark, or versions of one, have."""
        self.ids = ids
        got = [item_tokens(t) for t in texts]
        self.tok, self.word, self.count = [g[0] for g in got], [g[1] for g in got], [g[2] for g in got]
        self.sh = [shingles(h) for h in self.tok]
        mine = [np.unique(s[_member(s, own)]) for s in self.sh]
        who = [np.full(len(m), i, np.int32) for i, m in enumerate(mine)]
        # where in its item an own shingle stands first
        place = [np.array([int(np.argmax(s == k)) for k in m], np.int64) for s, m in zip(self.sh, mine)]
        keys = np.concatenate(mine) if mine else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        # one number for each key; its texts, in rising order, are the places begin[number] to begin[number + 1] of who and place
        self.keys, first = np.unique(keys[order], return_index=True)
        self.begin = np.append(first, len(keys)).astype(np.int64)
        self.who = (np.concatenate(who) if who else np.zeros(0, np.int32))[order]
        self.place = (np.concatenate(place) if place else np.zeros(0, np.int64))[order]

    def of_texts(self, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the key numbers j, place in who) for every text that has the key."""
        n = self.begin[j + 1] - self.begin[j]
        which = np.repeat(np.arange(len(j)), n)
        return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + self.begin[j][which]

    def prefix(self, freq: np.ndarray, need: int) -> np.ndarray:
        """Which own shingles, by place in who, are in the prefix of some window of their item, given their keys' corpus frequency."""
        out = np.zeros(len(self.who), bool)
        # rising, as places are ordered by key and text
        pair = np.repeat(np.arange(len(self.keys)), np.diff(self.begin)) * len(self.ids) + self.who
        for i, s in enumerate(self.sh):
            at = np.searchsorted(self.keys, s)
            at = np.minimum(at, max(0, len(self.keys) - 1))
            mine = np.flatnonzero(self.keys[at] == s) if len(self.keys) else np.zeros(0, np.int64)
            if not len(mine):
                continue
            first = self.word[i][mine]
            for w in range(max(1, self.count[i] - WORDS + 1)):
                inside = at[mine[(first >= w) & (first < w + WORDS)]]
                inside = np.unique(inside)
                if len(inside) >= need:
                    order = np.lexsort((inside, freq[inside]))
                    out[np.searchsorted(pair, inside[order[: len(inside) - need + 1]] * len(self.ids) + i)] = True
        return out

    def in_order(self, j: np.ndarray) -> int:
        """The most shared shingles (places j in who, in the document's order) that follow each other in their item's order."""
        ends: list[int] = []
        for p in self.place[j].tolist():
            k = bisect_left(ends, p)
            ends[k : k + 1] = [p]
        return len(ends)

    def verified(self, i: int, doc: np.ndarray, hits: np.ndarray, words: int) -> bool:
        """Is a run of at least `words` words of text i in the document, in order, but for single words?

        hits: token positions of shared shingles. Stretches of the item's length around them are compared; blocks
        of different stretches are chained where they follow each other in the item and in the document.
        """
        item = self.tok[i]
        size = len(item)
        sm = SequenceMatcher(None, autojunk=False)
        sm.set_seq2(item.tolist())
        blocks: list[tuple[int, int, int]] = []
        at = 0
        done = 0  # tokens of the document that have been compared
        while at < len(hits):
            lo = max(done, int(hits[at]) - size)
            hi = min(len(doc), int(hits[at]) + size + SIZE)
            while at < len(hits) and hits[at] < hi:
                at += 1
            if at < len(hits):
                hi = min(hi, int(hits[at - 1]) + size + SIZE)
            sm.set_seq1(doc[lo:hi].tolist())
            blocks += [(a, lo + b, n) for b, a, n in sm.get_matching_blocks() if n]
            done = max(done, int(hits[at - 1]) + SIZE)
        ok = np.zeros(size, bool)
        for a, n in _chained(blocks):
            ok[a : a + n] = True
        good = np.ones(self.count[i], bool)
        np.logical_and.at(good, self.word[i], ok)
        # the best run: a word found is worth 1, a word missing costs 3
        score = 0.0
        begin = 0
        for w, g in enumerate(good):
            if score <= 0:
                score, begin = 0.0, w
            score += 1 if g else -3
            if g and score > 0 and w - begin + 1 >= words and good[begin : w + 1].sum() >= words * 0.8:
                return True
        return False


def _member(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values are among the sorted keys."""
    if not len(keys):
        return np.zeros(len(values), bool)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def _chained(blocks: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(place in the item, length) of the heaviest chain of blocks (item, document, length) that follow each other in both.

    Blocks come in the document's order. best holds, by the item's end, the greatest weight of a chain that ends there.
    """
    ends: list[int] = []
    best: list[tuple[int, int]] = []  # (weight, block) of rising weight
    back = [-1] * len(blocks)
    pending: list[tuple[int, int, int, int]] = []  # chains become available when the document is past their end
    for k, (a, b, n) in sorted(enumerate(blocks), key=lambda x: (x[1][1], x[1][0])):
        for p in [p for p in pending if p[0] <= b]:
            pending.remove(p)
            _, end, weight, block = p
            at = bisect_left(ends, end)
            if (at == 0 or best[at - 1][0] < weight) and not (at < len(ends) and ends[at] == end and best[at][0] >= weight):
                stop = at
                while stop < len(ends) and best[stop][0] <= weight:
                    stop += 1
                ends[at:stop] = [end]
                best[at:stop] = [(weight, block)]
        at = bisect_left(ends, a + 1) - 1
        weight = n + (best[at][0] if at >= 0 else 0)
        back[k] = best[at][1] if at >= 0 else -1
        pending.append((b + n, a + n, weight, k))
    for _, end, weight, block in pending:
        best.append((weight, block))
    out: list[tuple[int, int]] = []
    k = max(best)[1] if best else -1
    while k >= 0:
        out.append((blocks[k][0], blocks[k][2]))
        k = back[k]
    return out


def matches(arr: pa.Array, items: Items) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, tokens, row starts, token positions of own shingles, their keys' numbers) by slices of a batch."""
    for at, part in slices(arr):
        h, start = tokens(part)
        s = shingles(h)
        if not len(s) or not len(items.keys):
            continue
        j = np.minimum(np.searchsorted(items.keys, s), len(items.keys) - 1)
        pos = np.flatnonzero(items.keys[j] == s)
        if len(pos):
            row = np.searchsorted(start, pos, side="right") - 1
            pos = pos[pos + SIZE <= start[row + 1]]  # not over a row's end
        if len(pos):
            yield at, h, start, pos, j[pos]


def item_words(text: str) -> tuple[list[int], list[int], list[int]]:
    """Hashes of the distinct words of an item: of all, of numbers and codes, of words with a capital that begin no sentence or line."""
    said: dict[str, int] = {}  # 1: number or code, 2: name
    for line in normalize(pa.array([text], pa.large_string()))[0][0].as_py().splitlines():
        inside = False
        for w in line.split():
            kind = 1 if any(c.isdigit() for c in w) else 2 if inside and any(c.isupper() for c in w) else 0
            said[w] = said.get(w, 0) | kind
            inside = w[-1] not in ".!?:;"
    h, start = tokens(pa.array(list(said), pa.large_string()))
    every, numbers, names = set(), set(), set()
    for kind, a, b in zip(said.values(), start[:-1].tolist(), start[1:].tolist()):
        if a < b:
            key = int.from_bytes(hashlib.sha256(h[a:b].tobytes()).digest()[:8], "little", signed=True)
            every.add(key)
            if kind & 1:
                numbers.add(key)
            if kind & 2:
                names.add(key)
    return sorted(every), sorted(numbers), sorted(names)


def versions(a: dict[str, np.ndarray], b: dict[str, np.ndarray], need: int) -> bool:
    """Is text a, the shorter one, a version of text b?

    It is where both are texts of one item. Otherwise b must have `ALIKE` of its shingles. If then no window of a has `need`
    shingles that b lacks, nothing could tell the two apart. Where they can be told apart, half of its numbers and codes and half
    of its names must be in b: common wording with other numbers, codes and names makes no versions.
    """
    if np.isin(a["ids"], b["ids"]).any():
        return True
    keys, first = np.unique(a["run"], return_index=True)
    apart = ~np.isin(keys, b["run"])
    if len(keys) - apart.sum() < ALIKE * len(keys):
        return False
    at = np.sort(a["at"][first[apart]])
    if (np.searchsorted(at, at + WORDS) - np.arange(len(at)) < need).all():
        return True
    return all(2 * np.isin(a[c], b["words"]).sum() >= len(a[c]) for c in ("numbers", "names"))


def item_parts(benchmark: DataFrame, item: str, most: int, need: int = NEED) -> Iterator[Items]:
    """The benchmark in parts of about `most` characters (a longer item is a part of its own).

    Which shingles are own is settled over all parts: those of one text, and those of several texts if every one is a version
    of the longest of them; a shingle of two texts of other content is nobody's.
    """
    rows = benchmark.select(F.col(item).cast("long").alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    lists = ["run", "at", "words", "numbers", "names"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            same, got = [], []
            for t in b.column(1).to_pylist():
                h, word, _ = item_tokens(t)
                run = shingles(h).view(np.int64)
                # equal tokens that blanks part otherwise are other words: a text of its own
                same.append(hashlib.sha256(h.tobytes() + word.tobytes()).hexdigest())
                got.append([run, word[: len(run)], *item_words(t)])
            more = [pa.array([g[k] for g in got], pa.list_(pa.int64())) for k in range(len(lists))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(same, pa.string()), b.column(1), *more], names=["item", "same", "text", *lists])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            two = [{c.name: b.column(side).field(c.name) for c in b.column(side).type} for side in ("a", "b")]
            keep = [not versions(*({c: np.asarray(v[k].values) for c, v in t.items()} for t in two), need) for k in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column("same"), b.column("top")], names=["same", "top"]).filter(pa.array(keep, pa.bool_()))

    texts = rows.mapInArrow(cut, "item long, same string, text string" + "".join(f", {c} array<long>" for c in lists))
    texts = texts.groupBy("same").agg(F.array_sort(F.collect_set("item")).alias("ids"), F.min_by(F.struct("text", *lists), "item").alias("first")).select("same", "ids", "first.*")
    texts = checkpointed(texts)
    chars, n = texts.agg(F.sum(F.length("text")), F.count("*")).first()
    parts = max(1, min(-(-(chars or 0) // most), n))
    part = F.pmod(F.xxhash64("same"), F.lit(parts)).cast("int").alias("part")
    held = texts.select("same", F.array_distinct("run").alias("keys")).select("same", F.size("keys").alias("size"), F.explode("keys").alias("key"))
    tops = held.groupBy("key").agg(F.count("*").alias("n"), F.max(F.struct("size", "same"))["same"].alias("top"))
    shared = checkpointed(held.join(tops.filter("n > 1"), "key").select("key", "same", "top"))
    # a text is compared with the longest one only: a notice of all items is no join of all with all
    beside = shared.filter("same <> top").select("same", "top").distinct()
    a = texts.select("same", F.struct("ids", "run", "at", "numbers", "names").alias("a"))
    b = texts.select(F.col("same").alias("top"), F.struct("ids", "run", "words").alias("b"))
    other = beside.join(a, "same").join(b, "top").mapInArrow(others, "same string, top string")
    common = shared.join(other, ["same", "top"]).select("key").distinct()
    single = tops.filter("n = 1").select("key", F.col("top").alias("same"))
    own = single.unionByName(shared.join(common, "key", "left_anti").select("key", "same")).select("key", part).distinct()
    if parts > 1:
        own = checkpointed(own)
    for p in range(parts):
        got = texts.select("ids", "text", part).filter(F.col("part") == p).select("ids", "text").collect()
        keys = np.sort(np.array([r[0] for r in own.filter(F.col("part") == p).select("key").collect()], np.int64).view(np.uint64))
        got.sort(key=lambda r: r[0])
        yield Items([list(r[0]) for r in got], [r[1] for r in got], keys)


def found(corpus: DataFrame, benchmark: DataFrame, words: int = WORDS, need: int = NEED, doc: str = "doc_id", item: str = "item_id", most: int = MOST_CHARS) -> DataFrame:
    """(doc_id, item_id) of the documents that contain at least `words` words of an item's own passage.

    A benchmark of more than `most` characters is searched in parts, whose rows are written to the shared folder.
    """
    out: DataFrame | None = None
    texts = corpus.select(F.col(doc).cast("long").alias("doc_id"), "text").filter("text is not null")
    for items in item_parts(benchmark, item, most, need):
        got = _search(texts, items, words, need)
        out = got if out is None else checkpointed(out.unionByName(got))
    return out.distinct()  # an item of two texts is found once


def _search(texts: DataFrame, items: Items, words: int, need: int) -> DataFrame:
    sc = texts.sparkSession.sparkContext
    shared = sc.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it = shared.value
        n = np.zeros(len(it.keys), np.int64)
        for b in batches:
            for _, _, start, pos, j in matches(arrow_text(b.column(0)), it):
                row = np.searchsorted(start, pos, side="right") - 1
                np.add.at(n, np.unique(row.astype(np.int64) * len(it.keys) + j) % len(it.keys), 1)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["s", "n"])

    # one row for each own shingle at most: bounded by the part of the benchmark
    freq = np.zeros(len(items.keys), np.int64)
    for r in texts.select("text").mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).collect():
        freq[r[0]] = r[1]
    first = sc.broadcast(items.prefix(freq, need))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it, prefix = shared.value, first.value
        for b in batches:
            ids = np.asarray(b.column(0))
            docs: list[int] = []
            who: list[int] = []
            for at, h, start, pos, j in matches(arrow_text(b.column(1)), it):
                row = np.searchsorted(start, pos, side="right") - 1
                which, j = it.of_texts(j)
                row, pos = row[which], pos[which]
                pair = row.astype(np.int64) * len(it.ids) + it.who[j]
                order = np.argsort(pair, kind="stable")
                keys, begin, n = np.unique(pair[order], return_index=True, return_counts=True)
                for p, k, m in zip(keys.tolist(), begin.tolist(), n.tolist()):
                    if m < need:
                        continue
                    mine = order[k : k + m]
                    # prefix, length and position bounds
                    if not prefix[j[mine]].any() or len(np.unique(j[mine])) < need or it.in_order(j[mine]) < need:
                        continue
                    r, i = divmod(p, len(it.ids))
                    if it.verified(i, h[start[r] : start[r + 1]], pos[mine] - start[r], words):
                        docs += [int(ids[at + r])] * len(it.ids[i])
                        who += it.ids[i]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(who, pa.int64())], names=["doc_id", "item_id"])

    return texts.mapInArrow(join, "doc_id long, item_id long")
