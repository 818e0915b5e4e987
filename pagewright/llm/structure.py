"""Statistics of a text and its structural profile: prose, list, table, form, index, title list or junk.

Method: each line becomes a histogram of marks (character classes, gaps, leaders, kinds of words, function words of the
languages), in which rare telling marks weigh more than letters. Lines whose basic counts leave no doubt have their
profile from these. A first pass over all texts averages their histograms by profile; a second adds up the histograms
of the other lines of each text, with its undoubted prose, and gives them the profile whose average has the least
Jensen-Shannon divergence. A line alone is too short for a divergence: of 226,000 undoubted lines, one by one, it names
98 % rightly, but it takes a third of the others, mostly broken-off lines of paragraphs, for something else than prose.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.profiles import CLASS_OF, CLASSES, FUNCTION_WORDS, LANGUAGES, codes
from pagewright.llm.words import LETTERS, split

#: Marks of a line and the weight of one of each, in characters.
MARKS = {
    "lower": 0.3, "upper": 0.5, "digit": 1.5, "separator": 8, "gap": 4, "dot_run": 4, "lead_bullet": 30, "lead_number": 30,
    "end_stop": 6, "end_digit": 6, "inner_stop": 4, "comma": 3, "colon": 4, "cap_word": 3, "low_word": 1.5, "code_word": 4, "function_word": 8,
    "symbol": 5, "control": 8, "long_token": 1.5,
}
_AT = {m: i for i, m in enumerate(MARKS)}
_WEIGHTS = np.array(list(MARKS.values()))
PROFILES = ("prose", "list", "table", "form", "index", "titles", "enumeration", "junk")
_PROSE = PROFILES.index("prose")
#: A line with fewer characters has no profile of its own; a token is long from so many characters.
LEAST_LINE, LONG = 12, 24
#: Words of a text from which the lack of function words means anything.
LEAST_WORDS = 8

# Function words of further languages, which only count as such.
_MORE = "da do de e o os as um uma na no em com após para não w z na i do po o się jest и в на не с по из для после при над под или".split()
_FUNCTION = {w for ws in FUNCTION_WORDS.values() for w in ws if len(w) > 1} | {w for w in _MORE if len(w) > 1 or w > "z"}
_LANG = {lang: {w for w in ws if sum(w in x for x in FUNCTION_WORDS.values()) == 1} for lang, ws in FUNCTION_WORDS.items()}
_K = {c: i for i, c in enumerate(CLASSES)}
#: Characters that are worked on at a time, so that memory doesn't grow with a batch and the arrays stay in the processor's caches.
_CHUNK = 1 << 18


def _parts(texts: list[str]) -> Iterator[slice]:
    """Ranges of successive texts that have up to _CHUNK characters together, or of a single longer one."""
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) >= _CHUNK:
            yield slice(first, i)
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield slice(first, len(texts))


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows a few at a time: a batch has up to 10,000 texts or 64 MB, and the arrays over them many times that."""
    for b in batches:
        for part in _parts(list(b["text"])):
            yield b.iloc[part]


class Lines:
    """The lines of some texts and their marks; what needs an array over characters is done for a part of the lines at a time."""

    def __init__(self, texts: list[str]):
        lines, owner = [], []
        for i, t in enumerate(texts):
            part = [x.strip(" ") for x in t.splitlines() if x.strip() and not (x.startswith("=== PAGE ") and x.rstrip().endswith("==="))]
            lines += part
            owner += [i] * len(part)
        self.owner, self.texts = np.array(owner, np.int64), len(texts)
        n = self.n = len(lines)
        self.size = np.array([len(x) for x in lines], np.int64)
        self.marks = np.zeros((n, len(MARKS)))
        self.slashes, self.ascii, self.tokens, self.words = np.zeros((4, n), np.int64)
        self.letters, self.lang = np.zeros(n), np.zeros((n, len(LANGUAGES)))
        for part in _parts(lines):
            self._mark(part, lines[part])
        self.function = self.col("function_word")

    def _mark(self, part: slice, lines: list[str]) -> None:
        n, size, marks = len(lines), self.size[part], self.marks[part]
        c = codes("\n" + "\n".join(lines) + "\n\n").astype(np.uint16)
        kind = CLASS_OF[c]
        prev, c, nxt = c[:-2], c[1:-1], c[2:]
        kind_prev, kind, kind_nxt = kind[:-2], kind[1:-1], kind[2:]
        start = np.r_[0, np.cumsum(size + 1)[:-1]]
        line = np.repeat(np.arange(n, dtype=np.int32), size + 1)

        def count(name: str, where: np.ndarray) -> None:
            marks[:, _AT[name]] = np.bincount(line[where], minlength=n)

        is_dot, is_space = c == 46, kind == _K["space"]
        count("lower", kind == _K["lower"])
        count("upper", kind == _K["upper"])
        count("digit", kind == _K["digit"])
        count("separator", kind == _K["separator"])
        count("gap", is_space & (prev == c))
        count("dot_run", is_dot & (prev == 46))
        count("inner_stop", (kind == _K["stop"]) & (kind_nxt == _K["space"]) & (kind_prev == _K["lower"]))
        count("comma", kind == _K["comma"])
        count("colon", (kind == _K["colon"]) & (kind_nxt == _K["space"]))
        # Inside words a dash, quote or a letter's sign is nothing special.
        count("symbol", ((kind == _K["symbol"]) | (kind == _K["bullet"]) | (kind == _K["quote"]) | (kind == _K["bracket"])) & ~((kind_prev <= 1) & (kind_nxt <= 1)))
        count("control", kind == _K["control"])
        self.slashes[part] = np.bincount(line[c == 47], minlength=n)
        self.ascii[part] = np.bincount(line[(c >= 97) & (c < 123)], minlength=n)
        first = (kind <= 1) & (kind_prev > 1)
        code = first & (kind_prev == _K["digit"]) | (kind == _K["digit"]) & (kind_prev <= 1)
        count("cap_word", first & (kind == _K["upper"]) & (kind_nxt == _K["lower"]) & (prev != 39) & (prev != 0x2019))
        count("low_word", first & (kind == _K["lower"]) & (kind_nxt == _K["lower"]))
        count("code_word", code)
        # Tokens between white space.
        gap = np.flatnonzero(is_space | (kind == _K["line"]) | (c == 9))
        run = np.diff(np.r_[-1, gap]) - 1
        at = line[gap]
        self.tokens[part] = np.bincount(at[run > 0], minlength=n)
        marks[:, _AT["long_token"]] = np.bincount(at, weights=np.where(run >= LONG, run, 0), minlength=n)
        # Ends and beginnings.
        last = start + size - 1
        marks[:, _AT["end_stop"]] = (kind[last] == _K["stop"]) & (prev[last] != 46)
        marks[:, _AT["end_digit"]] = kind[last] == _K["digit"]
        far = len(c) - 1
        a, b, d, e = c[start], c[np.minimum(start + 1, far)], c[np.minimum(start + 2, far)], c[np.minimum(start + 3, far)]
        marks[:, _AT["lead_bullet"]] = ((CLASS_OF[a] == _K["bullet"]) | np.isin(a, [45, 0x2013, 0x2014])) & (b == 32) | (CLASS_OF[a] == _K["bullet"])
        close = lambda x: (x == 41) | (x == 46)
        digit = lambda x: CLASS_OF[x] == _K["digit"]
        marks[:, _AT["lead_number"]] = (digit(a) & close(b) & (d == 32)) | (digit(a) & digit(b) & close(d) & (e == 32)) | ((CLASS_OF[a] == _K["lower"]) & (b == 41) & (d == 32))
        own, word, distinct = split(lines, LETTERS)
        self.words[part] = np.bincount(own, minlength=n)
        if len(word):
            common = np.array([w in _FUNCTION for w in distinct], bool)
            self.letters[part] = np.bincount(own, weights=np.array([len(w) for w in distinct], float)[word], minlength=n)
            marks[:, _AT["function_word"]] = np.bincount(own[common[word]], minlength=n)
            per = np.array([[w in _LANG[x] for x in LANGUAGES] for w in distinct], float)
            self.lang[part] = np.stack([np.bincount(own, weights=per[word, k], minlength=n) for k in range(len(LANGUAGES))], axis=1)

    def col(self, name: str) -> np.ndarray:
        return self.marks[:, _AT[name]]

    def weighted(self) -> np.ndarray:
        return self.marks * _WEIGHTS

    def seeds(self) -> np.ndarray:
        """The profile of lines that leave no doubt, else -1."""
        g = self.col
        seed = np.full(self.n, -1)
        words, size = self.words, self.size
        odd = (g("symbol") + g("control")) / np.maximum(size, 1)
        lead = (g("lead_bullet") > 0) | (g("lead_number") > 0)
        plain = (g("separator") == 0) & (g("gap") < 2) & (g("dot_run") == 0) & ~lead
        stops = g("end_stop") + g("inner_stop")
        letters = g("lower") + g("upper")
        seed[plain & (stops > 0) & (self.function >= 2) & (words >= 6)] = _PROSE
        seed[plain & (self.function >= 3) & (self.function >= 0.25 * words) & (g("lower") > 0.6 * size) & (g("comma") < 3) & (g("end_digit") == 0)] = _PROSE
        seed[lead & (stops == 0)] = 1
        seed[(g("separator") >= 2) & (g("end_stop") == 0)] = 2
        seed[(g("gap") >= 6) & (g("digit") >= 2)] = 2
        label = plain & (g("colon") == 1) & (stops == 0) & (g("comma") == 0) & (words <= 10)
        many = np.bincount(self.owner[label], minlength=self.texts)[self.owner] >= 3
        seed[label & (many | (g("code_word") >= 1))] = 3
        seed[(g("dot_run") >= 4) & (g("end_digit") > 0)] = 4
        seed[plain & (g("comma") >= 2) & (g("end_digit") > 0) & (g("digit") >= 3) & (stops == 0)] = 4
        seed[plain & (g("cap_word") >= 3) & (g("low_word") == 0) & (stops == 0) & (g("lower") > g("upper"))] = 5
        seed[plain & (g("comma") >= 5) & (stops == 0) & (words <= 6.5 * (g("comma") + 1)) & (g("digit") == 0) & (self.function < 0.5 * words)] = 6
        seed[(odd > 0.35) & (letters < 0.4 * size)] = 7
        seed[(g("long_token") > 0.6 * size) & ((g("digit") + g("upper") > 0.25 * size) | (self.slashes >= 3))] = 7
        seed[(self.tokens >= 6) & (size <= 3.5 * self.tokens) & (g("digit") > 0.2 * size) & (self.function == 0) & (g("comma") == 0)] = 7
        # Letters without the words of any language, over what would be the prose of the text.
        could = plain & ((seed == _PROSE) | (seed < 0))
        by = lambda v: np.bincount(self.owner[could], weights=v[could], minlength=self.texts)[self.owner]
        latin = by(self.ascii) >= 0.9 * by(letters)
        loose = by(words) >= 6.5 * (by(g("comma")) + 1)
        seed[could & (by(words) >= LEAST_WORDS) & (by(self.function) < 0.06 * by(words)) & latin & (loose | (by(g("comma")) == 0)) & (by(g("cap_word")) < 0.2 * by(words))] = 7
        return seed


def structural_profiles(texts: DataFrame) -> np.ndarray:
    """The average weighted marks of each profile over the undoubted lines of all texts: a row a profile, whatever the size of the table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(PROFILES), len(MARKS)))
        for b in _batches(batches):
            x = Lines(list(b["text"]))
            seed, w = x.seeds(), x.weighted()
            ok = (seed >= 0) & (x.size >= LEAST_LINE)
            w = w / np.maximum(w.sum(axis=1, keepdims=True), 1e-9)
            for p in range(len(PROFILES)):
                total[p] += w[ok & (seed == p)].sum(axis=0)
        # Whole numbers add up alike in any order.
        yield pd.DataFrame({"profile": np.repeat(np.arange(len(PROFILES)), len(MARKS)), "mark": np.tile(np.arange(len(MARKS)), len(PROFILES)), "n": np.round(total.ravel() * 1e6).astype(np.int64)})

    rows = texts.mapInPandas(run, "profile int, mark int, n bigint").groupBy("profile", "mark").agg(F.sum("n").alias("n")).collect()  # profiles x marks
    out = np.zeros((len(PROFILES), len(MARKS)))
    for r in rows:
        out[r["profile"], r["mark"]] = r["n"]
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def divergences(weighted: np.ndarray, profiles: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence of each row from each profile; infinite from a profile without lines."""
    p = weighted / np.maximum(weighted.sum(axis=1, keepdims=True), 1e-9)
    out = np.full((len(p), len(profiles)), np.inf)

    def h(x: np.ndarray) -> np.ndarray:
        return -np.where(x > 0, x * np.log2(np.maximum(x, 1e-12)), 0).sum(axis=1)

    hp = h(p)
    for k, q in enumerate(profiles):
        if q.sum() > 0:
            out[:, k] = h((p + q) / 2) - (hp + h(q[None, :])) / 2
    return out


def _line_profiles(x: Lines, profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(profile of each line, divergence from prose of each text)."""
    best, w = x.seeds(), x.weighted()
    prose = best == _PROSE
    open_ = best < 0
    pooled = np.zeros((x.texts, len(MARKS)))
    np.add.at(pooled, x.owner[open_ | prose], w[open_ | prose])
    d = divergences(pooled, profiles)
    running = [PROFILES.index(p) for p in ("prose", "titles", "enumeration", "junk")]
    nearest = np.array(running)[np.argmin(np.where(np.isfinite(d[:, running]), d[:, running], 9), axis=1)]
    seeded = np.zeros((x.texts, len(PROFILES)))
    np.add.at(seeded, (x.owner[~open_], best[~open_]), x.size[~open_])
    # Where a text has undoubted lines but no prose among them, the rest, such as a heading, goes with most of them.
    rest = np.where((seeded.sum(axis=1) > 0) & (seeded[:, _PROSE] == 0), np.argmax(seeded, axis=1), nearest)
    best = np.where(open_, rest[x.owner], best) if x.n else best
    whole = np.zeros((x.texts, len(MARKS)))
    np.add.at(whole, x.owner, w)
    return best, divergences(whole, profiles[_PROSE : _PROSE + 1])[:, 0]


def text_statistics(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Statistics of each text of a DataFrame with `keys` and a column text; further columns are dropped.

    words, mean_word_length, symbol_ratio (marks that are neither letters, digits, white space nor common punctuation,
    by characters), stop_line_share (lines that end a sentence), common_word_share (function words by words), lang (by
    function words), prose_divergence (Jensen-Shannon divergence of all its lines from prose, nan for a blank text), profile (the one
    that holds most characters) and other_share (characters of lines that aren't prose, by all). A text of one short
    line without marks, such as a heading or caption, has the profile 'heading' and other_share 0; blank texts have
    'blank' and 0. Null texts give no row, repeated rows one; an empty table gives an empty result.
    """
    rows = texts.select(*keys, "text").where("text IS NOT NULL")
    shared = texts.sparkSession.sparkContext.broadcast(structural_profiles(rows.select("text")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _batches(batches):
            t = list(b["text"])
            n = len(t)
            x = Lines(t)
            best, far = _line_profiles(x, shared.value)

            def by(weights: np.ndarray) -> np.ndarray:
                return np.bincount(x.owner, weights=weights, minlength=n) if x.n else np.zeros(n)  # noqa: B023

            chars = by(x.size)
            held = np.stack([by(x.size * (best == k)) for k in range(len(PROFILES))], axis=1)
            words, lines = by(x.words), by(np.ones(x.n))
            g = x.col if x.n else (lambda name: np.zeros(0))
            marked = by(g("separator") + g("lead_bullet") + g("lead_number") + (g("gap") >= 3) + g("dot_run") + (g("comma") >= 3) + (g("long_token") > 0) + (g("symbol") + g("control") > 3))
            heading = (lines == 1) & (words <= 9) & (marked == 0)
            profile = np.where(chars == 0, "blank", np.where(heading, "heading", np.array(PROFILES)[np.argmax(held, axis=1)]))
            lang = np.stack([by(x.lang[:, k]) if x.n else np.zeros(n) for k in range(len(LANGUAGES))], axis=1)
            out = b[keys].copy()
            out["words"] = words.astype(np.int64)
            out["mean_word_length"] = by(x.letters if x.n else np.zeros(0)) / np.maximum(words, 1)
            out["symbol_ratio"] = by(g("symbol") + g("control")) / np.maximum(chars, 1)
            out["stop_line_share"] = by(g("end_stop")) / np.maximum(lines, 1)
            out["common_word_share"] = by(x.function) / np.maximum(words, 1)
            out["lang"] = np.where(lang.sum(axis=1) > 0, np.array(LANGUAGES)[np.argmax(lang, axis=1)], None)
            out["prose_divergence"] = np.where(np.isfinite(far) & (chars > 0), far, np.nan)
            out["profile"] = profile
            out["other_share"] = np.where(heading, 0, 1 - held[:, _PROSE] / np.maximum(chars, 1)) * (chars > 0)
            yield out

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", words bigint, mean_word_length double, symbol_ratio double, stop_line_share double, common_word_share double, lang string, prose_divergence double, profile string, other_share double"
    return rows.mapInPandas(run, schema).distinct()
