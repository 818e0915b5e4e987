"""The share of a text that repeats itself, and how far its histograms stray from its language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.profiles import CLASS_OF, CLASSES, FUNCTION_WORDS, LANGUAGES, codes, histogram, js_distance
from pagewright.llm.words import LETTERS, split

_PLACE = {w: i for i, w in enumerate(sorted({w for ws in FUNCTION_WORDS.values() for w in ws}))}
_WEIGHT = np.array([[w in FUNCTION_WORDS[lang] for w in _PLACE] for lang in LANGUAGES], float)
_WIDTH = len(CLASSES) + len(_PLACE)
#: Texts under these counts are too short for a divergence to mean anything; it is then null.
LEAST_CHARS, LEAST_WORDS = 40, 20


def repeated_words(owner: np.ndarray, codes_: np.ndarray, texts: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, repeated words) of each text. A word is repeated if it lies in a run that occurs at least twice in its text.

    Runs get exact numbers, no hashes, by pairing the numbers of their parts.
    """
    words = np.bincount(owner, minlength=texts)
    if len(codes_) < run:
        return words, np.zeros(texts, np.int64)

    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return pd.factorize(a * (int(b.max()) + 1) + b)[0]

    # Numbers of runs of 1, 2, 4, ... words, then the wanted length from overlapping parts.
    size, number = 1, codes_.astype(np.int64)
    while size * 2 <= run:
        number = join(number[:-size], number[size:])
        size *= 2
    if size < run:
        gap = run - size
        number = join(number[: len(number) - gap], number[gap:])
    inside = owner[: len(number)] == owner[run - 1 :]
    key = join(number[inside], owner[: len(number)][inside])
    twice = np.bincount(key)[key] > 1
    step = np.zeros(len(codes_) + 1, np.int64)
    at = np.flatnonzero(inside)[twice]
    np.add.at(step, at, 1)
    np.add.at(step, at + run, -1)
    covered = np.cumsum(step[:-1]) > 0
    return words, np.bincount(owner[covered], minlength=texts)


def _histograms(texts: list[str], owner: np.ndarray, word: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    kinds = np.concatenate([CLASS_OF[codes(t)].astype(np.int64) for t in texts]) if texts else np.zeros(0, np.int64)
    chars = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    place = np.array([_PLACE.get(w, -1) for w in distinct], np.int64)
    common = place[word] if len(word) else word
    return np.hstack([histogram(chars, kinds, len(texts), len(CLASSES)), histogram(owner, common, len(texts), len(_PLACE))])


def _language(h: np.ndarray) -> np.ndarray:
    return np.argmax(h[:, len(CLASSES) :] @ _WEIGHT.T, axis=1)


def language_references(texts: DataFrame) -> np.ndarray:
    """The summed histograms of each language over all texts: as many rows as languages, whatever the size of the table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(LANGUAGES), _WIDTH), np.int64)
        for b in batches:
            t = list(b["text"])
            h = _histograms(t, *split(t, LETTERS))
            np.add.at(total, _language(h), h)
        yield pd.DataFrame({"lang": np.repeat(np.arange(len(LANGUAGES)), _WIDTH), "at": np.tile(np.arange(_WIDTH), len(LANGUAGES)), "n": total.ravel()})

    rows = texts.mapInPandas(run, "lang int, at int, n bigint").groupBy("lang", "at").agg(F.sum("n").alias("n")).collect()  # at most languages x width rows
    out = np.ones((len(LANGUAGES), _WIDTH))
    for r in rows:
        out[r["lang"], r["at"]] += r["n"]
    return out


def repetition(docs: DataFrame, run: int = 6, divergence: bool = True) -> DataFrame:
    """(doc_id, words, repeated, share, lang, class_distance, common_word_distance) of docs(doc_id, text), whatever its further columns.

    Words are runs of letters in lower case. share: words that lie in a run of `run` successive words which occurs
    twice or more in the text, by all words; 0 for a text without words. The two Jensen-Shannon distances compare the
    text's character classes and common words with those of its language over all texts; they are null below the
    least lengths, and everywhere without `divergence`. Divergence alone can't tell a share (a text that repeats an
    ordinary sentence has ordinary histograms), so the share is counted. Null texts give no row, empty ones a row of
    zeros, repeated rows one row; an empty table gives an empty result. Each text is one row of one task.
    """
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    reference = docs.sparkSession.sparkContext.broadcast(language_references(texts) if divergence else None)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            t = list(b["text"])
            owner, word, distinct = split(t, LETTERS)
            words, repeated = repeated_words(owner, word, len(t), run)
            out = pd.DataFrame({"doc_id": b["doc_id"], "words": words, "repeated": repeated, "share": repeated / np.maximum(words, 1)})
            out["lang"] = out["class_distance"] = out["common_word_distance"] = None
            if reference.value is not None and len(t):
                h = _histograms(t, owner, word, distinct)
                lang, n = _language(h), len(CLASSES)
                chars, common = h[:, :n], h[:, n:]
                out["lang"] = np.where(common.sum(axis=1) > 0, np.array(LANGUAGES)[lang], None)
                d = js_distance(chars, reference.value[lang, :n])
                out["class_distance"] = np.where(chars.sum(axis=1) >= LEAST_CHARS, d, np.nan)
                d = js_distance(common, reference.value[lang, n:])
                out["common_word_distance"] = np.where((words >= LEAST_WORDS) & (common.sum(axis=1) > 0), d, np.nan)
            yield out

    rows = texts.mapInPandas(work, "doc_id bigint, words bigint, repeated bigint, share double, lang string, class_distance double, common_word_distance double")
    return rows.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("class_distance", "common_word_distance")}).distinct()
