"""Token counts with a public vocabulary. The file's path is a parameter; it is read once a worker."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public split pattern of that vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The pattern never joins a sign with the blanks after it, so counts of blanks-and-word chunks add up exactly.
CHUNK = re.compile(r"\s*\S+|\s+")
_own: dict[str, object] = {}


def encoding(path: str = VOCABULARY):
    if path not in _own:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _own[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _own[path]


def count(text: str | None, path: str = VOCABULARY) -> int:
    return len(encoding(path).encode_ordinary(text)) if text else 0


def sizes(df: DataFrame, doc: str = "doc_id", path: str = VOCABULARY) -> DataFrame:
    """(doc_id, tokens) of every row; null text has null tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for b in batches:
            n = [None if t is None else len(enc.encode_ordinary(t)) for t in (x.as_py() for x in b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["doc_id", "tokens"])

    return df.selectExpr(f"cast(`{doc}` as long) doc_id", "text").mapInArrow(run, "doc_id long, tokens long")
