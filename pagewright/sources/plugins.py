"""Where document parsers and recognisers plug in.

A plug-in is a function without arguments that makes an extractor; each Python worker calls it once and keeps what it
gets, so that models are loaded once a worker. A document that can't be read is a row with an error, never a failed
task, so that one bad file doesn't stop a batch; a lost executor is Spark's to make good.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES = "path string, file_hash string, page_no int, text string, page_count int, error string"


class ExtractionError(RuntimeError):
    """A document can't be read; its message is what the document's error row says."""


class Extractor(Protocol):
    def extract(self, content: bytes, filename: str) -> dict[int, str]:
        """Text by page number."""


class Recogniser(Protocol):
    def ocr(self, image: bytes) -> list[tuple[list[tuple[float, float]] | None, str, float | None]]:
        """(polygon, text, confidence) of each line of a page's image."""


_made: dict[Any, Any] = {}


def once(make: Callable[[], Any]) -> Any:
    """What make returns, made once in this worker."""
    key = (getattr(make, "__module__", ""), getattr(make, "__qualname__", repr(make)))
    if key not in _made:
        _made[key] = make()
    return _made[key]


def checked(pages: dict[int, str], filename: str) -> dict[int, str]:
    """Pages that are numbered from 1 without a gap, else an error."""
    if not pages:
        raise ExtractionError(f"{filename}: no pages")
    if sorted(pages) != list(range(1, len(pages) + 1)):
        raise ExtractionError(f"{filename}: page numbers have gaps")
    return pages


def extract(files: DataFrame, make: Callable[[], Extractor]) -> DataFrame:
    """PAGES rows of files(path, content), each distinct content read once: one row a page, or one with an error for a file that can't be read."""
    hashed = files.select("path", "content", F.sha2("content", 256).alias("file_hash"))
    once_each = hashed.groupBy("file_hash").agg(F.min("path").alias("path"))
    work = hashed.join(once_each, ["file_hash", "path"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extractor = once(make)
        for b in batches:
            out = []
            for path, content, digest in zip(b["path"], b["content"], b["file_hash"]):
                name = path.rsplit("/", 1)[-1]
                try:
                    pages = checked(extractor.extract(bytes(content), name), name)
                    out += [(path, digest, n, t, len(pages), None) for n, t in sorted(pages.items())]
                except Exception as e:  # noqa: BLE001
                    out.append((path, digest, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "file_hash", "page_no", "text", "page_count", "error"]).astype({"page_no": "Int32", "page_count": "Int32"})

    return work.select("path", "content", "file_hash").mapInPandas(run, PAGES)


def recognise(images: DataFrame, make: Callable[[], Recogniser]) -> DataFrame:
    """(doc_id, page_no, idx, text, confidence, polygon) of images(doc_id, page_no, image); a page without lines keeps one row of nulls."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = once(make)
        for b in batches:
            out = []
            for doc, page, image in zip(b["doc_id"], b["page_no"], b["image"]):
                lines = [(p, t.strip(), c) for p, t, c in reader.ocr(bytes(image)) if t and t.strip()]
                out += [(doc, page, i, t, c, None if p is None else [{"x": float(x), "y": float(y)} for x, y in p]) for i, (p, t, c) in enumerate(lines)] or [(doc, page, None, None, None, None)]
            yield pd.DataFrame(out, columns=["doc_id", "page_no", "idx", "text", "confidence", "polygon"]).astype({"idx": "Int32", "confidence": "Float64"})

    return images.select("doc_id", "page_no", "image").mapInPandas(run, "doc_id bigint, page_no int, idx int, text string, confidence double, polygon array<struct<x:double,y:double>>")
