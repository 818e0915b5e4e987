"""Transcripts: pages, bodies, cleaning and overlapping duplicates."""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as T


def split_pages(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, page_no, text) for each page mark of a transcript; one row with a null page for a text without marks. Null texts give none."""
    rows = texts.where("text IS NOT NULL").select(key, "text")
    numbers = F.regexp_extract_all("text", F.lit(T.PAGE_MARK), F.lit(1))
    parts = F.split("text", T.PAGE_MARK, -1)
    marked = F.transform(numbers, lambda n, i: F.struct(n.cast("int").alias("page_no"), F.get(parts, i + 1).alias("text")))
    whole = F.array(F.struct(F.lit(None).cast("int").alias("page_no"), F.col("text").alias("text")))
    return rows.select(key, F.inline(F.when(F.size(numbers) > 0, marked).otherwise(whole)))


def body(c):
    """A transcript after its first blank line, or whole without one."""
    at = F.instr(c, "\n\n")
    return F.when(at > 0, F.substr(c, at + 2)).otherwise(c)


def transcript(filename, text):
    """The published form of a document's pages."""
    return F.concat(F.lit("DOCUMENT: "), filename, F.lit("\n\n"), text, F.lit("\n"))


def clean(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, cleaned) of a column text: a readable view without positions, section headers and overlapping repeats.

    Lines are a sequence whose state (section, lines kept so far) decides about each, so this is one Arrow function a
    text. Null texts stay null.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], "cleaned": [None if t is None else clean_text(t) for t in b["text"]]})

    kind = dict(texts.dtypes)[key]
    return texts.select(key, "text").mapInPandas(run, f"{key} {kind}, cleaned string")


_PLACE = re.compile(T.POSITION)
_GAPS = re.compile(r"[\t ]+")


def clean_text(text: str) -> str:
    """One transcript, cleaned. A final line feed follows unless nothing is left."""
    lines = [x.strip() for x in unicodedata.normalize("NFC", text.replace("\u00a0", " ")).splitlines()]
    # A header opens a section, a page mark ends it: lines get the number of the header they follow, or 0.
    marks = [(i, 0 if x not in T.SECTIONS else i + 1) for i, x in enumerate(lines) if x in T.SECTIONS or x.startswith("=== PAGE ") and x.endswith(" ===")]
    section = [0] * len(lines)
    for (at, number), (end, _) in zip(marks, [*marks[1:], (len(lines), 0)]):
        section[at:end] = [number] * (end - at)
    places = [_PLACE.match(x) for x in lines]
    bodies = [_GAPS.sub(" ", x[p.end() :] if p else x).strip() for x, p in zip(lines, places)]
    shown = [x not in T.SECTIONS for x in lines]
    # Only lines of the same words in the same section can be repeats of each other.
    alike: dict[tuple[int, str], list[int]] = {}
    for i, (number, x) in enumerate(zip(section, bodies)):
        if number and x and shown[i]:
            alike.setdefault((number, " ".join(x.casefold().split())), []).append(i)
    for rows in alike.values():
        if len(rows) > 1:
            for i in _repeats(rows, [tuple(map(float, p.groups())) if (p := places[i]) and p[1] is not None else None for i in rows]):
                shown[i] = False
    blocks = [list(g) for full, g in itertools.groupby(itertools.compress(bodies, shown), bool) if full]
    return "\n\n".join("\n".join(b) for b in blocks) + "\n" if blocks else ""


def _repeats(rows: list[int], boxes: list[tuple | None]) -> list[int]:
    """The rows whose box covers, or is covered by, that of an earlier row which stays itself."""
    stay: list[tuple] = []
    gone = []
    for row, box in zip(rows, boxes):
        if box is None:
            continue
        if any(_covered(box, other) for other in stay):
            gone.append(row)
        else:
            stay.append(box)
    return gone


def _covered(a: tuple, b: tuple) -> bool:
    """Whether two boxes (left, right, top, bottom in the order of the prefix, read as left, top, right, bottom) share 0.8 of the smaller."""
    shared = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    size = [max(0.0, x[2] - x[0]) * max(0.0, x[3] - x[1]) for x in (a, b)]
    return min(size) > 0 and shared / min(size) >= 0.8
