"""Text that was decoded with the wrong character encoding: finding and restoring it.

Method: each swap of code pages is a substitution cipher whose symbols are the characters, or for a multi-byte encoding
the short sequences, that letters have turned into. Code pages give the letters a symbol may stand for; which of them,
if any, is learned by expectation-maximisation against the bigrams of all texts. The E step weighs, for each symbol
between its two neighbours, every reading by its bigrams and by how often the symbol has that reading; the M step counts
bigrams and readings again with those weights. Wrong readings so lose the bigrams they had spoiled. A source's own
readings decide what the texts of all sources leave open. Restoring is a translate() of the symbols by their readings.

What the EM needs is one table of (left, symbol, right) counts: its size is bounded by the alphabets, not by the rows.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Code pages that text was meant in and was wrongly read in.
MEANT = ("cp1252", "mac_roman", "cp850", "cp437", "cp1250", "cp1251", "koi8_r", "iso8859_2", "iso8859_5", "cp866")
READ = ("cp1252", "latin_1", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp1250", "cp866", "iso8859_2")
#: Neighbours that are not ASCII are told apart only by kind.
LOWER, UPPER, MARK, LOST = "", "", "", "�"
#: Log odds that a symbol must have beyond its chance, evidence of a case by itself, and with others like it in its source.
PENALTY, SURE, LIKELY, FELLOWS = 2.5, 5.0, 1.5, 3
ROUNDS = 4


def _wanted(c: str) -> bool:
    """Whether a character can be meant: letters of the European scripts, typographic marks and common signs."""
    o = ord(c)
    return (0xA1 <= o <= 0x17F and o not in (0xA4, 0xA6, 0xA8, 0xAD, 0xAF, 0xB4, 0xB8)) or 0x391 <= o <= 0x3C9 or 0x401 <= o <= 0x451 or c in "–—‘’‚“”„†‡•…‰′″€™Ω←↑→↓−∞≈≠≤≥■□▪▫►●◦ﬁﬂșțȘȚ№"


def _bytes(s: str, page: str) -> bytes | None:
    """s as the bytes a reader of the page has seen; the page's unused places are read as the control characters of the same number."""
    out = bytearray()
    for c in s:
        try:
            out += c.encode(page)
        except UnicodeEncodeError:
            if 0x80 <= ord(c) < 0xA0:
                out.append(ord(c))
            else:
                return None
    return bytes(out)


@functools.lru_cache(maxsize=200_000)
def sequence(s: str) -> tuple[str, str] | None:
    """(character, swap) that a sequence stands for, if it is that character's UTF-8 read as a code page, once or twice."""
    for page in READ:
        b = _bytes(s, page)
        if b is None:
            continue
        try:
            t = b.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if len(t) == 1 and _wanted(t):
            return t, f"utf_8>{page}"
        if 1 < len(t) < len(s) and (again := sequence(t)):
            return again[0], f"{again[1]}>>{page}"
    return None


@functools.lru_cache(maxsize=100_000)
def single(c: str) -> tuple[tuple[str, str], ...]:
    """The letters and signs that one character may stand for in a swap of two single-byte code pages, with the swap."""
    out = {}
    for read in READ:
        b = _bytes(c, read)
        if b is None or len(b) != 1 or b[0] < 0x80:
            continue
        for meant in MEANT:
            try:
                t = b.decode(meant)
            except UnicodeDecodeError:
                continue
            if t != c and _wanted(t):
                out.setdefault(t, f"{meant}>{read}")
    return tuple(out.items())


@functools.lru_cache(maxsize=200_000)
def symbols(run: str) -> tuple[str, ...]:
    """A run of non-ASCII characters as cipher symbols: the longest sequences that stand for one character, else single characters."""
    out, i = [], 0
    while i < len(run):
        for n in range(min(16, len(run) - i), 1, -1):
            if sequence(run[i : i + n]):
                break
        else:
            n = 1
        out.append(run[i : i + n])
        i += n
    return tuple(out)


def readings(symbol: str) -> tuple[tuple[str, str], ...]:
    """(character, swap) of each reading of a symbol besides itself."""
    if len(symbol) > 1:
        found = sequence(symbol)
        return (found,) if found else ()
    return single(symbol)


_RUN = re.compile(r"[^\x00-\x7f]+")


@functools.lru_cache(maxsize=10_000)
def kind(c: str) -> str:
    """A neighbour as the bigrams know it."""
    if c < "\x80":
        return c
    if c == LOST:
        return c
    return LOWER if c.islower() else UPPER if c.isalpha() else MARK


def occurrences(text: str) -> Iterator[tuple[int, str, str, str]]:
    """(place, left neighbour, symbol, right neighbour) of each symbol."""
    for m in _RUN.finditer(text):
        a, z = m.span()
        parts = symbols(m[0])
        for k, s in enumerate(parts):
            left = (text[a - 1] if a else "\n") if k == 0 else kind(_likely(parts[k - 1]))
            right = (text[z] if z < len(text) else "\n") if k == len(parts) - 1 else kind(_likely(parts[k + 1]))
            yield a, left, s, right
            a += len(s)


def _likely(symbol: str) -> str:
    return sequence(symbol)[0] if len(symbol) > 1 and sequence(symbol) else symbol[0]


class Cipher:
    """Learned bigrams and readings."""

    def __init__(self, contexts: dict[tuple[str, str, str], int]):
        self.left: dict = defaultdict(float)
        self.right: dict = defaultdict(float)
        self.reads: dict = {}
        self.total: dict = defaultdict(float)
        rows = list(contexts.items())
        # At first sequences are what they stand for and single characters are themselves.
        weights = [{_likely(s): 1.0} for (_, s, _), _ in rows]
        for _ in range(ROUNDS):
            left, right, reads, total = (defaultdict(float) for _ in range(4))
            for ((a, s, b), n), w in zip(rows, weights):
                for c, p in w.items():
                    left[a, c] += n * p
                    right[c, b] += n * p
                    total[c] += n * p
                    reads[s, c] += n * p
            self.left, self.right, self.reads, self.total = dict(left), dict(right), dict(reads), dict(total)
            self.seen = defaultdict(float)
            for (s, _), n in self.reads.items():
                self.seen[s] += n
            weights = [self.posterior(a, s, b) for (a, s, b), _ in rows]

    def fit(self, a: str, c: str, b: str) -> float:
        """Log of how well a character fits between its neighbours, from both bigrams and its frequency."""
        n = self.total.get(c, 0.0)
        return math.log(self.left.get((a, c), 0.0) + 0.02) + math.log(self.right.get((c, b), 0.0) + 0.02) - math.log(n + 1)

    def odds(self, a: str, s: str, b: str) -> tuple[float, str, str]:
        """(log odds of the best reading against the symbol itself, that reading, its swap)."""
        own = self.fit(a, s, b) if len(s) == 1 else -8.0 - 2 * len(s)
        if len(s) == 1 and not _fits_word(a, s, b):
            own -= 4
        best = (-99.0, s, "")
        for c, swap in readings(s):
            d = self.fit(a, c, b) - own
            if len(s) == 1 and not _fits_word(a, c, b):
                d -= 4
            if d > best[0]:
                best = (d, c, swap)
        return best

    def posterior(self, a: str, s: str, b: str) -> dict[str, float]:
        scores = {s: self.fit(a, s, b) + (0 if _fits_word(a, s, b) else -4)} if len(s) == 1 else {}
        for c, _ in readings(s):
            share = (self.reads.get((s, c), 0.0) + 0.05) / (self.seen.get(s, 0.0) + 1)
            scores[c] = self.fit(a, c, b) + math.log(share) + (0 if len(s) > 1 or _fits_word(a, c, b) else -4)
        if not scores:
            return {s[0]: 1.0}
        top = max(scores.values())
        e = {c: math.exp(v - top) for c, v in scores.items() if v > top - 12}
        z = sum(e.values())
        return {c: v / z for c, v in e.items()}


def _fits_word(a: str, c: str, b: str) -> bool:
    """Whether a character can stand there in any orthography: no capital after a small letter, no sign or other script inside a word."""
    la, lb = a.isalpha() or a in (LOWER, UPPER), b.isalpha() or b in (LOWER, UPPER)
    if c.isalpha():
        low = a.islower() or a == LOWER
        if c.isupper() and low:
            return False
        latin = ord(c) < 0x250
        if not latin and c not in "µΩΔ" and (a.isascii() and la or b.isascii() and lb):
            return False
        return not (c.islower() and a.isupper() and (b.isupper() or b == UPPER))
    return not (la and lb) or c in "’'-–·—…"


def _contexts(texts: DataFrame) -> dict:
    """Counts of (left, symbol, right) over all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter = Counter()
        for b in batches:
            for t in b["text"]:
                if not t.isascii():
                    n.update((a, s, z) for _, a, s, z in occurrences(t))
        if n:
            yield pd.DataFrame([(*k, v) for k, v in n.items()], columns=["a", "s", "z", "n"])

    rows = texts.mapInPandas(run, "a string, s string, z string, n bigint").groupBy("a", "s", "z").agg(F.sum("n").alias("n"))
    out: dict = {}
    for r in rows.toLocalIterator():
        # Scripts without a place in any code page can't be meant or misread; they would only grow the table.
        if readings(r["s"]) or _wanted(r["s"][0]):
            out[r["a"], r["s"], r["z"]] = r["n"]
    return out


def garbled(regions: DataFrame, key: str = "region_id", source: str = "doc_id") -> DataFrame:
    """(key, source, evidence, swap, restored) of the texts that were decoded wrongly, wholly or in part.

    regions has columns key, source and text; further ones don't matter. evidence: log odds, summed over the text's
    symbols, that they stand for other characters. swap: the likeliest swap of code pages, as meant>read. restored: the
    text with all symbols read rightly, null where characters were lost (U+FFFD). A text is a case if characters were
    lost, if its evidence is beyond doubt, or if it is likely and its source has several such texts of the same swap.
    Null, empty and pure ASCII texts are never cases; repeated rows give one row; an empty table gives an empty result.
    """
    rows = regions.select(F.col(key).alias("key"), F.col(source).alias("source"), "text").where("text IS NOT NULL AND text RLIKE '[^\\\\x00-\\\\x7F]'")
    cipher = regions.sparkSession.sparkContext.broadcast(Cipher(_contexts(rows.select("text"))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}

        def look(a: str, s: str, z: str) -> tuple[float, str, str]:
            if (a, s, z) not in known:
                if len(known) > 500_000:
                    known.clear()
                known[a, s, z] = cipher.value.odds(a, s, z)
            return known[a, s, z]

        for b in batches:
            out = []
            for k, src, t in zip(b["key"], b["source"], b["text"]):
                evidence, lost, by, spans = 0.0, False, Counter(), []
                for at, a, s, z in occurrences(t):
                    if s == LOST:
                        lost = True
                        continue
                    d, c, swap = look(a, s, z)
                    if d > PENALTY:
                        evidence += d - PENALTY
                        by[swap] += d
                        spans.append((at, s, c))
                if lost or evidence > LIKELY:
                    out.append((k, src, 99.0 if lost else evidence, "lost" if lost else by.most_common(1)[0][0], None if lost else restore(t, spans)))
            yield pd.DataFrame(out, columns=["key", "source", "evidence", "swap", "restored"])

    kinds = dict(rows.dtypes)
    seen = rows.mapInPandas(run, f"key {kinds['key']}, source {kinds['source']}, evidence double, swap string, restored string").distinct()
    # What a source's texts agree on; only suspects get here, and they are counted before the join.
    fellows = seen.where(F.col("evidence") > SURE).groupBy("source", "swap").agg(F.count("*").alias("fellows"))
    judged = seen.join(fellows, ["source", "swap"], "left").where((F.col("evidence") > SURE) | (F.col("fellows") >= FELLOWS))
    return judged.select(F.col("key").alias(key), F.col("source").alias(source), "evidence", "swap", "restored")


def restore(text: str, spans: list[tuple[int, str, str]]) -> str:
    """The text with its symbols read: those of one reading by translate(), sequences and symbols of several readings in place."""
    read: dict[str, set] = defaultdict(set)
    for _, s, c in spans:
        read[s].add(c)
    count = Counter(s for _, s, _ in spans)
    simple = {s: next(iter(c)) for s, c in read.items() if len(s) == 1 and len(c) == 1 and text.count(s) == count[s]}
    parts, at = [], 0
    for place, s, c in spans:
        if s in simple:
            continue
        parts += [text[at:place], c]
        at = place + len(s)
    # Characters that a sequence was read as must not be read again.
    done = {ord(c) for s, cs in read.items() if s not in simple for c in cs}
    whole = "".join([*parts, text[at:]])
    return whole if done & set(map(ord, simple)) else whole.translate({ord(s): c for s, c in simple.items()})
