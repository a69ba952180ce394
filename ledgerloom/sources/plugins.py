"""Where foreign code comes in: page converters, page hooks, engines. Each runs in Arrow batches, once a worker is it made."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: What a converter makes of the bytes of a file: the bytes of its pages.
Converter = Callable[[bytes], list[bytes]]
Hook = Callable[[bytes], bytes]

PAGE = "document_id string, page_number int, image binary, source_kind string, normalization_steps array<string>, error string"


def by_name(path: str):
    """An object by its dotted path, as module:name or module.name."""
    module, _, name = path.replace(":", ".").rpartition(".")
    if not module:
        raise ValueError(f"{path} names no module")
    return getattr(importlib.import_module(module), name)


def pages(docs: DataFrame, converters: dict[str, Converter], hooks: list[tuple[str, Hook]] = (), strict: bool = False) -> DataFrame:
    """PAGE rows of documents (document_id, media_type, content): pages numbered from 1, every hook applied in order.

    converters: by media type; image types without one are a page of their own. A type without a converter, a document without
    pages and a failing converter or hook become a row with an error (page 0), so one bad file stops no batch; strict: they stop it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, kind, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                try:
                    if content is None:
                        raise ValueError("no content")
                    if kind in converters:
                        images, source = converters[kind](content), "document"
                    elif (kind or "").startswith("image/"):
                        images, source = [content], "image"
                    else:
                        raise ValueError(f"no converter for {kind}")
                    if not images:
                        raise ValueError("no pages")
                    done = []
                    for image in images:
                        for _, hook in hooks:
                            image = hook(image)
                        done.append(image)
                    rows += [(doc, i, image, source, [n for n, _ in hooks], None) for i, image in enumerate(done, 1)]
                except Exception as e:
                    if strict:
                        raise
                    rows.append((doc, 0, None, None, None, f"{type(e).__name__}: {e}"))
            cols = list(zip(*rows)) or [[]] * 6
            types = [pa.string(), pa.int32(), pa.binary(), pa.string(), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=[x.split()[0] for x in PAGE.split(", ")])

    return docs.select("document_id", "media_type", "content").mapInArrow(run, PAGE)


def predicted(pages_: DataFrame, factory: Callable[[], Callable[[list[bytes]], list[str]]], batch: int = 4) -> DataFrame:
    """(document_id, page_number, payload, error): what an engine says of every page, as JSON, `batch` pages a call.

    factory makes the engine once a worker. A call that fails leaves its pages with an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = None
        for b in batches:
            images = b.column(2).to_pylist()
            out: list[str | None] = []
            faults: list[str | None] = []
            for i in range(0, len(images), batch):
                part = images[i : i + batch]
                try:
                    engine = engine or factory()
                    got = engine(part)
                    if len(got) != len(part):
                        raise ValueError(f"{len(got)} results for {len(part)} pages")
                    out += got
                    faults += [None] * len(part)
                except Exception as e:
                    out += [None] * len(part)
                    faults += [f"{type(e).__name__}: {e}"] * len(part)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array(faults, pa.string())], names=["document_id", "page_number", "payload", "error"])

    return pages_.filter("error is null").select("document_id", "page_number", "image").mapInArrow(run, "document_id string, page_number int, payload string, error string")
