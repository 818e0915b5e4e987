"""Similarity of character and token sequences by longest matching blocks.

Spark has no such function, so these are Arrow functions over the standard library's matcher, whose treatment of popular
elements and of the order of arguments is part of the result. Equal pairs within a batch are computed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from pagewright.functions import text as T

ALIKE = 0.82


def _ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def _each(f, *columns: pd.Series) -> pd.Series:
    known: dict = {}

    def one(*x):
        key = tuple(tuple(v) if hasattr(v, "__iter__") and not isinstance(v, str) else v for v in x)
        if key not in known:
            known[key] = f(*key)
        return known[key]

    return pd.Series([one(*x) for x in zip(*columns)], dtype=object)


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Of two normalised texts; 0 if either is empty or null."""
    return _each(lambda x, y: _ratio(x or "", y or ""), a, b).astype(float)


def _matches(token: str, others: tuple, least: int) -> bool:
    return token in others or (len(token) > least and any(SequenceMatcher(None, token, o).ratio() >= ALIKE for o in others))


@F.pandas_udf(DoubleType())
def token_coverage(first: pd.Series, second: pd.Series) -> pd.Series:
    """Share of the first's tokens that equal or resemble one of the second's; 0 without tokens."""
    return _each(lambda a, b: sum(_matches(t, b, 0) for t in a) / len(a) if a else 0.0, first, second).astype(float)


@F.pandas_udf(DoubleType())
def token_support(first: pd.Series, second: pd.Series) -> pd.Series:
    """As token_coverage, but tokens of up to two characters must be equal."""
    return _each(lambda a, b: sum(_matches(t, b, 2) for t in a) / len(a) if a else 0.0, first, second).astype(float)


def similar_in_region(pairs: DataFrame, key: str, needle: str, region: str) -> DataFrame:
    """(key) of the pairs whose needle stands in the region, or about as many of the region's tokens are alike; both are token arrays.

    Windows of the region and their bound, that no ratio exceeds twice the shorter length by both, are columns: only
    windows within it, of needles of six characters and more that don't stand there as they are, reach the matcher.
    """
    needle, region = F.col(needle), F.col(region)
    text, n, m = F.array_join(needle, " "), F.size(needle), F.size(region)
    sizes = F.filter(F.array(n - 1, n, n + 1), lambda k: (k >= 1) & (k <= m))
    windows = F.flatten(F.transform(sizes, lambda k: F.transform(F.sequence(F.lit(1), m - k + 1), lambda i: F.array_join(F.slice(region, i, k), " "))))
    close = F.filter(windows, lambda w: 2.0 * F.least(F.length(w), F.length(text)) >= (ALIKE - 1e-9) * (F.length(w) + F.length(text)))
    there = T.contains_sequence(region, needle)
    rows = pairs.select(key, there.alias("there"), text.alias("text"), F.when(~there & (n > 0) & (F.length(F.array_join(needle, "")) >= 6), close).alias("asked"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            alike = _each(lambda t, cs: cs is not None and any(SequenceMatcher(None, t, c).ratio() >= ALIKE for c in cs), b["text"], b["asked"])
            yield b.loc[b["there"].to_numpy(bool) | alike.to_numpy(bool), [key]]

    return rows.where("there OR size(asked) > 0").mapInPandas(run, f"{key} {dict(pairs.dtypes)[key]}")


@F.pandas_udf(DoubleType())
def sequence_similarity(first: pd.Series, second: pd.Series) -> pd.Series:
    """Of two token lists, in per cent; 100 if both are empty, null if one is missing."""

    def one(a, b):
        if a is None or b is None:
            return None
        return 100.0 if not a and not b else 100 * SequenceMatcher(None, a, b).ratio()

    return _each(one, first, second).astype(float)


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Composed form, with no-break spaces as spaces."""
    import unicodedata

    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t.replace(" ", " ")))
