"""Noise of scanned text: running headers and page numbers, words split across lines, misread characters.

Method: lines at either edge of a page that come again at that place on other pages of their document are furniture,
compared by a skeleton in which characters that recognisers confuse are the same, unless more lines come again than
furniture has, the text runs on through them or they stand inside pages too; what the topmost such lines look like, by their words, also tells the
header of a document of one page. Page numbers are told by their form. Line ends are joined by the words of the corpus:
a hyphen is dropped where the joined word is commoner than the compound. A word is misread if another of the same
skeleton is far commoner; how far depends on whether the characters confused are confused in other words too, so that
value isn't taken for valve. All these are ratios of counts: a corpus that is repeated gives the same.

The corpus's words are counted over all texts and compared within their skeletons where they are. What is sent around is
whole: the wrong spellings, the known words, and what was found for the line ends and edge lines that occur.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.session import materialise

#: How often the right spelling is commoner than a wrong one at least; if the wrong one could be a word and its confusion is hardly seen in others; share of all sightings that the known words make up.
RATIO, STEADY, KNOWN = 12, 45, 0.985
#: What an edge word's rate is raised by, among header words and body words.
FLOOR = 1e-3
#: Lines from either end of a page that can be furniture, beside page numbers; the length of a header that is known by its words.
EDGE, LONGEST = 2, 80
#: Characters of an edge line's skeleton from which one edit may part it from the same line on another page.
NEAR = 8

#: Everything in ASCII but letters, digits and the two signs that stand for letters becomes a space; one table keeps hyphens.
_APART = bytes(i if i >= 128 or chr(i).isalnum() or chr(i) in "@|" else 32 for i in range(256))
_WITH_HYPHENS = bytes(45 if i == 45 else c for i, c in enumerate(_APART))
_OTHER = re.compile(r"[^\w\x00-\x7f]+")
_COMPOUND = re.compile(r"[^\W\d_]{2,}-[^\W\d_]{2,}")
_PAGE = re.compile(r"^=== PAGE \d+ ===\s*$", re.M)
# Forms of page numbers.
_NUMBER = re.compile(r"^(?:(?:page|seite|página|pagina|p\.|s\.|pág\.|pag\.)\s*)?[-–—(\[]?\s*(?:[\dOolI|]{1,5}|[ivxlc]{1,7})\s*[-–—)\]]?(?:\s*(?:of|von|de|sur|/)\s*[\dOolI|]{1,5})?$", re.I)
_WITH_NUMBER = re.compile(r"(?:\s{2,}|\t)[-–—(\[]?\s*(?:\d{1,5}|[ivxlc]{1,7})\s*[-–—)\]]?$")
#: What no page number ends in.
_NO_NUMBER_ENDS = frozenset(c for c in map(chr, range(33, 127)) if not c.isdigit() and c not in "|oOlLiIvVxXcC-)]")
_NUMBER_ENDS = frozenset("ivxlc-–—)]")
_ROMAN = re.compile(r"^(?=[ivxlc])(?:x[cl]|l?x{0,3})(?:i[xv]|v?i{0,3})$", re.I)
_BREAK = ("-", "­", "¬")
_BROKEN = tuple(x + "\n" for x in _BREAK)
_THREE_LETTERS = re.compile(r"(?:[^\W\d_].*?){3}", re.S)
_TOKEN = re.compile(r"(?:[^\W_]|[@|])+")
_NO_HEADER = re.compile(r"[|;\t]")

# Characters and sequences that recognisers confuse; after them, all spellings of a word look the same.
_SAME = str.maketrans({"0": "o", "1": "l", "|": "l", "i": "l", "!": "l", "5": "s", "@": "a", "9": "g", "e": "c", "t": "f", "v": "u", "b": "h", "8": "h", "2": "z", "6": "g"})
_PAIRS = (("vv", "w"), ("rn", "m"))
_LATER = (("ll", "h"), ("cl", "d"))
#: Confusions that hardly ever make one word of another.
_HARMLESS = {("e", "c"), ("m", "rn"), ("w", "vv")}
_TAKEN = tuple(x for a, b in (("rn", "m"), ("vv", "w"), ("cl", "d"), ("li", "h"), ("ll", "h"), ("il", "b"), ("li", "b")) for x in ((a, b), (b, a)))


def raw_tokens(text: str, table: bytes = _APART) -> list[bytes]:
    """Runs of letters, digits, @ and |, in UTF-8; signs beyond ASCII part them too."""
    if not text.isascii():
        text = _OTHER.sub(" ", text)
    return text.encode("utf-8", "surrogatepass").translate(table).split()


def tokens(text: str) -> list[str]:
    return [t.decode("utf-8", "surrogatepass") for t in raw_tokens(text)]


@functools.lru_cache(maxsize=500_000)
def skeleton(word: str) -> str:
    """What is left of a word in lower case when all confusable characters are made the same."""
    for a, b in _PAIRS:
        word = word.replace(a, b)
    word = word.translate(_SAME)
    for a, b in _LATER:
        word = word.replace(a, b)
    return word


def confusions(right: str, wrong: str) -> set[tuple[str, str]]:
    """What was taken for what in a spelling of a word, from its start on."""
    out, i, j = set(), 0, 0
    while i < len(right) or j < len(wrong):
        if right[i : i + 1] == wrong[j : j + 1]:
            i, j = i + 1, j + 1
            continue
        a, b = next(((a, b) for a, b in _TAKEN if right.startswith(a, i) and wrong.startswith(b, j)), (right[i : i + 1], wrong[j : j + 1]))
        out.add((a, b))
        i, j = i + len(a), j + len(b)
    return out


def misread(candidates: list[tuple[str, int, str, int]]) -> dict[str, str]:
    """The right spelling of each wrong one, from (spelling, its count, the commonest of its skeleton, that one's count).

    What has a digit or sign in it is no word, nor is what is never seen but in halves. Another spelling could be a word
    of its own; it needs no more than RATIO if each of its confusions is harmless or seen as often in other spellings together.
    """
    taken: Counter = Counter()
    made = {}
    for x, own, t, n in candidates:
        if own and x.isalpha() and n >= RATIO * own:
            made[x] = confusions(t, x)
            for c in made[x]:
                taken[c] += own
    far = lambda x, own: STEADY if x in made and any(taken[c] < 2 * own for c in made[x] - _HARMLESS) else RATIO
    return {x: t for x, own, t, n in candidates if n and n >= far(x, own) * own}


@functools.lru_cache(maxsize=100_000)
def line_skeleton(line: str) -> str:
    """The skeleton of a line, without a page number beside it; whole numbers and codes are all the same."""
    line = _WITH_NUMBER.sub("", line)
    return " ".join(map(_mark, tokens(line.lower())))


@functools.lru_cache(maxsize=200_000)
def _mark(t: str) -> str:
    return skeleton(t) if t.isalpha() or sum(map(str.isdigit, t)) * 2 < len(t) else "#"


@functools.lru_cache(maxsize=100_000)
def line_ends(line: str) -> tuple[str, str]:
    """The first and the last word of :func:`edge_key`, without making all of it: lines that agree in neither aren't one edit apart either."""
    if not _THREE_LETTERS.search(line):
        return line.partition(" ")[0], line.rpartition(" ")[2]
    tail = line[-80:]
    if "  " in tail or "\t" in tail:
        tail = _WITH_NUMBER.sub("", tail)
    if len(tail) < len(line) or not (last := _TOKEN.findall(tail.rpartition(" ")[2])):
        last = _TOKEN.findall(tail)
    if len(last) < 2 < len(line) - len(tail):
        key = edge_key(line)
        return key.partition(" ")[0], key.rpartition(" ")[2]
    return _mark(_TOKEN.search(line)[0].lower()), _mark(last[-1].lower()) if last else ""


def line_start(line: str) -> str:
    """The first of :func:`line_ends`, without looking for the other where it doesn't matter to it."""
    if len(line) > 80 or "  " in line or "\t" in line:
        return line_ends(line)[0]
    return _mark(_TOKEN.search(line)[0].lower()) if _THREE_LETTERS.search(line) else line.partition(" ")[0]


def is_page_number(line: str) -> bool:
    s = line.strip()
    if not _NUMBER.match(s):
        return False
    digits = any(c.isdigit() for c in s)
    return digits or bool(_ROMAN.match(s.strip("-–—()[] ")))


def pages_of(text: str) -> list[list[str]]:
    """The lines of each page of an extraction, blank ones left out."""
    parts = _PAGE.split(text)
    return [lines for p in parts if (lines := [x for x in map(str.strip, p.splitlines()) if x])]


def _can_be_header(line: str) -> bool:
    last = line[-1:]
    if last in _NUMBER_ENDS or last.isdigit() or last.isspace():  # else no number stands there
        line = _WITH_NUMBER.sub("", line)
    return len(line) <= LONGEST and not line.endswith((".", ",", ";", *_BREAK)) and not _NO_HEADER.search(line) and bool(_THREE_LETTERS.search(line))


def is_word(token: str) -> bool:
    """Whether a token is a word, misread or not, and no number or code."""
    letters = sum(c.isalpha() for c in token)
    if letters == len(token):
        return True
    marks = sum(c.isdigit() for c in token)
    return letters >= 1 and len(token) >= 2 and marks * 2 <= len(token) and not any(c.isupper() for c in token[1:])


def can_be_misread(token: str) -> bool:
    return is_word(token) and (len(token) > 2 or not token.isalpha())


@functools.lru_cache(maxsize=1_000)
def split_parts(line: str, after: str | None) -> tuple[str, str] | None:
    """The two halves of a word that a line may be broken in, if it ends in a hyphen and goes on in a small letter."""
    if not line.endswith(_BREAK) or len(line) < 2 or not after:
        return None
    a, b = tokens(line[:-1].rpartition(" ")[2]), tokens(after.partition(" ")[0])
    if not a or not line[:-1].endswith(a[-1]) or not b or not after.startswith(b[0]) or not (b[0][0].islower() or b[0][0] in "015|@9"):
        return None
    return a[-1], b[0]


class Lexicon:
    """What was found out about the corpus's words: the right spellings of wrong ones, the known words, the parts of split words, the skeletons of headers."""

    def __init__(self, wrong: dict[str, str], known: set[str], splits: set[tuple[str, str]], headers: set[str]):
        self.wrong, self.commonest, self.splits, self.headers = wrong, known, splits, headers
        self._fine: set[bytes] = set()
        self._bad: dict[bytes, str] = {}
        self._words: dict[str, bool] = {}

    def doubtful(self, text: str) -> set[str]:
        """Those of a text's tokens, as they are written, that are misread words."""
        out = set()
        for raw in set(raw_tokens(text)) - self._fine:
            if raw in self._bad:
                out.add(self._bad[raw])
                continue
            t = raw.decode("utf-8", "surrogatepass")
            low = t.lower()
            if is_word(t) and self.right(low) != low:
                out.add(t)
                if len(self._bad) < 1_000_000:
                    self._bad[raw] = t
            elif len(self._fine) < 1_000_000:
                self._fine.add(raw)
        return out

    def right(self, token: str) -> str:
        """The spelling of a token in lower case: itself unless it is misread."""
        return self.wrong.get(token, token)

    def known(self, token: str) -> bool:
        return self.right(token) in self.commonest

    def is_known_word(self, token: str) -> bool:
        """Whether a token, as it is written, is a word, and a known one when it is read right."""
        found = self._words.get(token)
        if found is None:
            found = is_word(token) and self.known(token.lower())
            if len(self._words) < 1_000_000:
                self._words[token] = found
        return found

    def is_split(self, line: str, after: str | None) -> bool:
        """Whether a line ends inside a word that was split there."""
        if not line.endswith(_BREAK) or len(line) < 2:
            return False
        parts = split_parts(line, after)
        if not line.endswith("-"):
            return len(line) > 1 and (line[-2].isalnum() or line[-2] in "@|")
        if not parts:
            return False
        return tuple(p.lower() for p in parts) in self.splits

    def is_header(self, line: str) -> bool:
        """Whether a line's words are those of running headers."""
        return _can_be_header(line) and line_skeleton(line) in self.headers


def _count(n: Counter, ends: set, lines: list[str], after: str | None = None) -> None:
    """Count the words of lines that follow each other, hyphens kept; halves of broken words count as seen 0 times, as do the words they make. ends: gets the halves."""
    text = "\n".join(lines)
    if text.endswith(_BREAK) or any(x in text for x in _BROKEN):
        whole, skip = [], False
        for x, then in zip(lines, [*lines[1:], after]):
            broken = x.endswith(_BREAK)
            if broken and (parts := split_parts(x, then)):
                a, b = (p.lower() for p in parts)
                ends.add((a, b))
                _occur(n, f"{a} {b} {a}{b}")
            if skip or broken:
                _occur(n, x)
            x = x.partition(" ")[2] if skip else x
            whole.append(x.rpartition(" ")[0] if broken else x)
            skip = broken
        text = "\n".join(whole)
    n.update(raw_tokens(text.lower(), _WITH_HYPHENS))


def _occur(n: Counter, text: str) -> None:
    for t in raw_tokens(text.lower()):
        n.setdefault(t, 0)


class _Counts:
    """What a part of the corpus is counted for."""

    def __init__(self):
        self.seen: Counter = Counter()
        self.edges = {"h": Counter(), "b": Counter()}
        self.ends: set[tuple[str, str]] = set()
        self.tops: set[str] = set()

    def full(self) -> bool:
        return len(self.seen) + len(self.ends) + len(self.tops) > 500_000

    def rows(self) -> pd.DataFrame:
        """Compounds are parted, and what is no word left out, here, once for each distinct token."""
        words: Counter = Counter()
        out = []
        for raw, n in self.seen.items():
            t = raw.decode("utf-8", "surrogatepass")
            if "-" in t:
                if _COMPOUND.fullmatch(t):
                    out.append(("c", t, n))
                for part in t.split("-"):
                    words[part] += n
            else:
                words[t] += n
        out += [("w", w, n) for w, n in words.items() if w and is_word(w)]
        out += [(kind, w, n) for kind, c in self.edges.items() for w, n in c.items()]
        out += [("e", f"{a} {b}", 0) for a, b in self.ends]
        out += [("l", x, 0) for x in self.tops]
        return pd.DataFrame(out, columns=["kind", "word", "n"])


def _lexicon(counts: DataFrame) -> Lexicon:
    """Words are compared with those of their skeleton, line ends and edge lines with their words, by aggregations and joins over all of them; only findings reach the driver."""
    skeletons = F.pandas_udf(lambda s: s.map(skeleton), "string")
    candidate = F.pandas_udf(lambda s: s.map(can_be_misread), "boolean")
    alpha = F.pandas_udf(lambda s: s.map(str.isalpha), "boolean")
    words = materialise(counts.where("kind = 'w'").select("word", "n", skeletons("word").alias("skeleton"), alpha("word").alias("alpha"), candidate("word").alias("candidate")), "scan-skeletons")
    best = words.where("alpha").groupBy("skeleton").agg(F.max(F.struct("n", "word")).alias("best"))
    rivals = words.join(best, "skeleton").where(f"candidate AND word <> best.word AND best.n > 0 AND best.n >= {RATIO} * n")
    wrong = misread([tuple(r) for r in rivals.select("word", "n", "best.word", "best.n").toLocalIterator()])

    # The commonest words that make up KNOWN of all sightings, by how many words are seen how often.
    often = sorted(((r["n"], r["k"]) for r in words.where("n > 0").groupBy("n").agg(F.count("*").alias("k")).toLocalIterator()), reverse=True)
    left, least = KNOWN * sum(n * k for n, k in often), 1
    for n, k in often:
        if left <= 0:
            break
        left, least = left - n * k, n
    known = {r["word"] for r in words.where(F.col("n") >= least).select("word").toLocalIterator()}

    right = lambda w: wrong.get(w, w)
    spark = counts.sparkSession
    shared = spark.sparkContext.broadcast(wrong)
    righted = F.pandas_udf(lambda s: s.map(lambda w: shared.value.get(w, w)), "string")
    a, b = F.split("word", " ")[0], F.split("word", " ")[1]
    ends = counts.where("kind = 'e'").select(a.alias("a"), b.alias("b"))
    ends = ends.select("a", "b", righted(F.concat("a", "b")).alias("joined"), F.concat_ws("-", righted("a"), righted("b")).alias("compound"))
    ends = ends.join(words.select(F.col("word").alias("joined"), F.col("n").alias("whole")), "joined", "left")
    ends = ends.join(counts.where("kind = 'c'").select(F.col("word").alias("compound"), F.col("n").alias("parts")), "compound", "left")
    ends = ends.select("a", "b", F.coalesce("whole", F.lit(0)).alias("whole"), F.coalesce("parts", F.lit(0)).alias("parts")).where("whole > parts OR whole = 0 AND parts = 0")
    # Seldom words: two words of their own make a compound, else it is one word.
    splits = {(r["a"], r["b"]) for r in ends.toLocalIterator() if r["whole"] > r["parts"] or not (right(r["a"]) in known and right(r["b"]) in known)}

    odds = counts.where("kind IN ('h', 'b')").groupBy("word").pivot("kind", ["h", "b"]).agg(F.sum("n")).na.fill(0)
    total = counts.where("kind IN ('h', 'b')").groupBy("kind").agg(F.sum("n")).collect()
    ph, pb = (max([r[1] for r in total if r[0] == kind] or [1]) for kind in "hb")
    odds = odds.select("word", (F.log(F.col("h") / ph + FLOOR) - F.log(F.col("b") / pb + FLOOR)).alias("odds"))
    tops = counts.where("kind = 'l'").select(F.col("word").alias("line"), F.explode(F.split("word", " ")).alias("word"))
    headers = tops.join(odds, "word").groupBy("line").agg(F.sum("odds").alias("odds")).where("odds > 2").select("line")
    return Lexicon(wrong, known, splits, {r["line"] for r in headers.toLocalIterator()})


def _extraction_counts(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = _Counts()
        for batch in batches:
            for t in batch["text"]:
                pages = pages_of(t)
                firsts = [[p[i] for i, _ in edge_lines(p, False)] for p in pages]
                for p, first in zip(pages, firsts):
                    _count(n.seen, n.ends, p)
                    n.tops.update(line_skeleton(x) for x in first[: EDGE if len(p) > 3 else 1] if _can_be_header(x))
                if len(pages) > 1:
                    for k, many in Counter(line_skeleton(x[0]) for x in firsts if x and _can_be_header(x[0])).items():
                        for word in k.split():
                            n.edges["h" if many > 1 else "b"][word] += many
            if n.full():
                yield n.rows()
                n = _Counts()
        yield n.rows()

    return texts.mapInPandas(run, "kind string, word string, n bigint")


_PAGE_OF = ["doc_id", "engine", "page_no"]


def _ocr_pages(lines: DataFrame) -> DataFrame:
    """Pages with their distinct lines in order, whether their document has several pages, and which of their edge lines come again on others.

    A page is one row; a document isn't, so its number of lines doesn't matter.
    """
    rows = lines.select(*_PAGE_OF, "idx", "line_id", F.trim("text").alias("text")).where("text IS NOT NULL AND trim(text) <> ''")
    items = F.array_sort(F.collect_set(F.struct("idx", "line_id", "text")))
    pages = materialise(rows.groupBy(*_PAGE_OF).agg(items.alias("items")).select(*_PAGE_OF, F.col("items.line_id").alias("ids"), F.col("items.text").alias("texts")), "scan-lines")
    kinds = dict(pages.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in _PAGE_OF)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for *page, ids, texts in zip(*(batch[c] for c in _PAGE_OF), batch["ids"], batch["texts"]):
                texts = _distinct(ids, texts)[1]
                if len(texts) > 1:
                    out += [(*page, side, d, k, on) for side in (0, 1) for d, (i, on) in enumerate(edge_lines(texts, bool(side))) for k in [edge_key(texts[i])]]
            yield pd.DataFrame(out, columns=[*_PAGE_OF, "side", "depth", "key", "on"])

    edges = materialise(pages.mapInPandas(run, schema + ", side int, depth int, key string, on boolean"), "scan-edges")
    place = ["doc_id", "engine", "side", "depth"]
    # A line is also taken for the commonest of the lines that agree with it in one half, if one edit parts them. What is
    # compared stands at one place of a document, so lines are sent around by that once, and compared where they are; a
    # number is sorted faster than all that must agree.
    keys = edges.repartition(*place).groupBy(*place, "key").agg(F.count("*").alias("pages"))
    many = F.length("key") - F.length(F.replace("key", F.lit(" "), F.lit(""))) + 1
    parts = keys.where((many > 1) & (F.length("key") >= NEAR)).select(*place, "key", "pages", many.alias("many"))
    half = F.expr("explode(array(concat('a', substring_index(key, ' ', CAST(ceil(many / 2) AS INT))), concat('b', substring_index(key, ' ', CAST(ceil(many / 2) AS INT) - many))))")
    parts = parts.select(*place, "key", "pages", half.alias("half"))
    best = parts.withColumn("other", F.max(F.struct("pages", "key")).over(Window.partitionBy(F.xxhash64(*place, "half"), *place, "half"))["key"])
    near = best.where((F.col("key") != F.col("other")) & (F.levenshtein("key", "other", 1) == 1)).select(*place, "key", "other").distinct()
    named = edges.unionByName(edges.join(near, [*place, "key"]).drop("key").withColumnRenamed("other", "key"))
    same = Window.partitionBy(F.xxhash64(*place, "key"), *place, "key")
    again = named.repartition(*place).select(*_PAGE_OF, "side", "depth", (F.min("page_no").over(same) < F.max("page_no").over(same)).alias("again"), F.min("on").over(same).alias("through")).where("again")
    marks = again.groupBy(*_PAGE_OF).agg(F.collect_list(F.struct("side", "depth", "through")).alias("marks"))
    # Documents of one page can't show what a running header is.
    several = pages.groupBy("doc_id", "engine").agg((F.max("page_no") > F.min("page_no")).alias("several")).where("several")
    return pages.join(pages.select(*_PAGE_OF).join(several, ["doc_id", "engine"]).join(marks, _PAGE_OF, "left"), _PAGE_OF, "left")


def _distinct(ids, texts) -> tuple[list, list[str]]:
    """The ids and texts of a page's lines, each id once."""
    lines: dict = {}
    for i, t in zip(ids.tolist(), texts.tolist()):
        lines.setdefault(i, t)
    return list(lines), list(lines.values())


def _marks(marks: list | None) -> dict[tuple[int, int], bool]:
    out: dict[tuple[int, int], bool] = {}
    for m in [] if marks is None else marks:
        place = m["side"], m["depth"]
        out[place] = out.get(place, True) and bool(m["through"])
    return out


def _ocr_counts(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = _Counts()
        for batch in batches:
            for ids, texts, several, marks in zip(batch["ids"], batch["texts"], batch["several"], batch["marks"]):
                texts = _distinct(ids, texts)[1]
                _count(n.seen, n.ends, texts)
                first = [texts[i] for i, _ in edge_lines(texts, False)]
                n.tops.update(line_skeleton(x) for x in first[: EDGE if len(texts) > 3 else 1] if _can_be_header(x))
                if several is True and first and _can_be_header(first[0]):
                    n.edges["h" if (0, 0) in _marks(marks) else "b"].update(line_skeleton(first[0]).split())
            if n.full():
                yield n.rows()
                n = _Counts()
        yield n.rows()

    return rows.select("ids", "texts", "several", "marks").mapInPandas(run, "kind string, word string, n bigint")


def _body_noise(lex: Lexicon, line: str, before: str | None, after: str | None, doubtful: set[str]) -> tuple[bool, bool]:
    """(ends in a split word, has a misread word) of a line of body text. doubtful: the misread words of its page."""
    split = lex.is_split(line, after)
    if line.startswith("|") and line.endswith("|") and len(line) > 1:
        return split, False
    bad = {t for t in doubtful if t in line}
    tail = before is not None and before.endswith(_BREAK)
    if not bad and not tail and not line.endswith(_BREAK):
        return split, False
    raw = words = tokens(line) if bad or tail else []
    misread = False
    if split and (parts := split_parts(line, after)):
        a, b = (p.lower() for p in parts)
        whole = lex.right(a + b)
        misread = whole != a + b and not whole.startswith(a)
    if line.endswith(_BREAK):
        words = words[:-1]
    if tail and words and lex.is_split(before, line) and (parts := split_parts(before, line)):
        a, b = (p.lower() for p in parts)
        whole = lex.right(a + b)
        misread = misread or (whole != a + b and not whole.endswith(b))
        words = words[1:]
    if not misread and bad and not bad.isdisjoint(words):
        # Among codes or junk a token that could be a word isn't one.
        misread = 2 * sum(map(lex.is_known_word, words)) > len(raw)
    return split, misread


def _lines_to_look_at(body: list[str], text: str, doubtful: set[str]) -> Iterator[tuple[int, str, str | None, str | None]]:
    """(place, line, the one before, the one after) of the lines that can hold noise: they are broken, follow a broken one or have a doubtful word."""
    places = {i for t in doubtful for i, x in enumerate(body) if t in x}
    if any(x in text for x in _BROKEN) or text.endswith(_BREAK):
        for i, x in enumerate(body):
            if x.endswith(_BREAK):
                places.update((i, i + 1))
    last = len(body) - 1
    for i in sorted(places):
        if i <= last:
            yield i, body[i], body[i - 1] if i else None, body[i + 1] if i < last else None


def _text_noise(lex: Lexicon, body: list[str]) -> set[str]:
    """The noises of a page's body; lines are only looked at one by one where there is something to find."""
    text = "\n".join(body)
    doubtful = lex.doubtful(text)
    found = set()
    for _, x, before, after in _lines_to_look_at(body, text, doubtful):
        split, misread = _body_noise(lex, x, before, after, doubtful)
        if split:
            found.add("hyphen")
        if misread:
            found.add("misread")
        if len(found) == 2:
            break
    return found


def _is_number_at(page: list[str], k: int, i: int) -> bool:
    """Whether the line at place i, the k-th from its edge, is a page number there."""
    return k < EDGE and len(page) > (1 if k == 0 else 3) and page[i][-1:] not in _NO_NUMBER_ENDS and len(page[i]) <= LONGEST and is_page_number(page[i])


def edge_lines(page: list[str], bottom: bool) -> list[tuple[int, bool]]:
    """(place, whether the text runs on through it) of the lines from an edge on that aren't page numbers: one more than can be furniture."""
    out = []
    n = len(page)
    for k in range(min(n, 2 * EDGE + 1)):
        i = n - 1 - k if bottom else k
        if len(out) > EDGE:
            break
        if _is_number_at(page, k, i):
            continue
        line = page[i]
        if bottom:
            on = i > 0 and (line[:1].islower() and not page[i - 1].endswith((".", "!", "?", ":")) or line[:1] == page[i - 1][:1] == "|")
        else:
            on = i + 1 < n and (page[i + 1][:1].islower() or line[:1] == page[i + 1][:1] == "|")
        out.append((i, on))
    return out


def edge_key(line: str) -> str:
    """What furniture is compared by. Numbers and codes are all the same in a skeleton: without words, lines must agree themselves."""
    return line_skeleton(line) if _THREE_LETTERS.search(line) else line


def halves(key: str) -> list[str]:
    """The first and the last words of a key: where a single edit parts two keys, they still agree in one of these."""
    words = key.split(" ")
    if len(words) < 2 or len(key) < NEAR:
        return []
    at = (len(words) + 1) // 2
    return ["a" + " ".join(words[:at]), "b" + " ".join(words[at:])]


def one_edit(a: str, b: str) -> bool:
    """Whether one character was added, lost or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k:] == b[k + 1 :] or len(a) == len(b) and a[k + 1 :] == b[k + 1 :]


def near_keys(counts: Counter) -> dict[str, set[str]]:
    """For each key the keys one edit away from it, of those that are the commonest of the keys with the same half."""
    best: dict[str, tuple[int, str]] = {}
    for k, n in counts.items():
        for h in halves(k):
            best[h] = max(best.get(h, (0, "")), (n, k))
    out: dict[str, set[str]] = {}
    for k in counts:
        near = {best[h][1] for h in halves(k) if one_edit(k, best[h][1])}
        if near:
            out[k] = near
    return out


def _is_alone(page: list[str], i: int) -> bool:
    """Whether no other line of the page is the same as the one at place i."""
    start, ends, key = line_start(page[i]), line_ends(page[i]), edge_key(page[i])
    return not any(k != i and line_start(x) == start and line_ends(x) == ends and edge_key(x) == key for k, x in enumerate(page))


def _odd(page: list[str], marks: dict[tuple[int, int], bool], lex: Lexicon, edges: tuple[list, list] | None = None) -> set[int]:
    """The places of the furniture on a page. edges: its edge lines at the top and the bottom, if they are known. marks: for each (0 top or 1 bottom, depth) that comes again on other pages, whether the text runs on through it on all of them."""
    if not marks:
        return _odd_alone(page, lex)
    found: set[int] = set()
    for side in (0, 1) if len(page) > 1 else (0,):
        depths = {i: d for d, (i, _) in enumerate(edges[side] if edges else edge_lines(page, bool(side)))}
        # If more comes again than furniture has, the text itself is repeated.
        text = all((side, d) in marks for d in range(EDGE + 1))
        for k in range(min(len(page), 2 * EDGE)):
            i = len(page) - 1 - k if side else k
            d = depths.get(i)
            if d is None:
                if not _is_number_at(page, k, i):
                    break
            elif d >= EDGE:
                break
            else:
                first = side == 0 and d == 0 and _can_be_header(page[i])
                again = (side, d) in marks and (first or len(page) > 1 and not text and not marks[side, d] and _is_alone(page, i))
                if not again and not (side == 0 and (d == 0 or len(page) > 3) and lex.is_header(page[i])):
                    break
            found.add(i)
    return found


def _odd_alone(page: list[str], lex: Lexicon) -> set[int]:
    """The places of the furniture on a page of which nothing comes again: page numbers, and at the top what looks like a header."""
    found: set[int] = set()
    n, d = len(page), 0
    for i in range(min(n, 2 * EDGE)):
        if not _is_number_at(page, i, i):
            if d >= EDGE or not ((d == 0 or n > 3) and lex.is_header(page[i])):
                break
            d += 1
        found.add(i)
    for k in range(min(n, 2 * EDGE) if n > 1 else 0):
        if not _is_number_at(page, k, n - 1 - k):
            break
        found.add(n - 1 - k)
    return found


def _furniture(pages: list[list[str]], lex: Lexicon) -> list[set[int]]:
    """The places of the furniture on each page of an extraction."""
    if len(pages) == 1:
        return [_odd(pages[0], {}, lex)]
    sides = [(edge_lines(p, False), edge_lines(p, True)) for p in pages]
    # Most edge lines begin and end like no other at their place; only the others get a key.
    edges: list[list] = [[] for _ in pages]
    for side in (0, 1):
        for d in range(EDGE + 1):
            there = [(e, p[both[side][d][0]], both[side][d][1]) for e, p, both in zip(edges, pages, sides) if len(both[side]) > d]
            ends = [line_ends(x) for _, x, _ in there] if len(there) > 1 else []
            if len({first for first, _ in ends}) < len(ends) or len({last for _, last in ends}) < len(ends):
                firsts, lasts = Counter(first for first, _ in ends), Counter(last for _, last in ends)
                for (e, x, on), (first, last) in zip(there, ends):
                    if firsts[first] > 1 or lasts[last] > 1:
                        e.append((side, d, edge_key(x), on))
    if not any(edges):
        return [_odd(p, {}, lex, both) for p, both in zip(pages, sides)]
    through: dict[tuple, list[bool]] = {}
    counts: dict[tuple, Counter] = {}
    for e in edges:
        for side, d, k, on in e:
            through.setdefault((side, d, k), []).append(on)
            counts.setdefault((side, d), Counter())[k] += 1
    near: dict[tuple, set[str]] = {(*place, k): others for place, c in counts.items() for k, others in near_keys(c).items()}
    own = dict(through)
    for (side, d, k), others in near.items():
        for other in others:
            through[side, d, other] = through[side, d, other] + own[side, d, k]
    # What also stands inside pages is body text that comes again, as is what the text runs on through.
    headers = {edge_key(p[top[0][0]]) for p, (top, _) in zip(pages, sides) if top and _can_be_header(p[top[0][0]])}
    again = {k for (side, d, k), t in through.items() if len(t) > 1 and not all(t) and not (side == d == 0 and k in headers)}
    firsts = {k.partition(" ")[0] for k in again}
    lines = Counter(k for p in pages for x in p if line_start(x) in firsts and (k := edge_key(x)) in again) if again else {}
    for (_, _, k), t in through.items():
        if lines.get(k, 0) > len(t) > 1:
            t[:] = [True] * len(t)

    def marks(e: list) -> dict[tuple[int, int], bool]:
        found = {}
        for side, d, k, _ in e:
            seen = [t for x in {k, *near.get((side, d, k), ())} if len(t := through.get((side, d, x), ())) > 1]
            if seen:
                found[side, d] = all(all(t) for t in seen)
        return found

    return [_odd(p, marks(e), lex, both) for p, e, both in zip(pages, edges, sides)]


def scan_noise(extractions: DataFrame, lines: DataFrame) -> DataFrame:
    """(record_kind, record_id, noise) of extractions(doc_id, text) and lines(line_id, doc_id, engine, page_no, idx, text); further columns don't matter.

    One row for each noise that a record holds: 'furniture', 'hyphen', 'misread'. A line of furniture holds nothing
    else. Null and blank texts hold none, repeated rows count once, lines of equal place are ordered by line_id; either
    table may be empty.
    """
    spark = extractions.sparkSession
    texts = extractions.select("doc_id", "text").where("text IS NOT NULL")
    rows = materialise(_ocr_pages(lines), "scan-pages")
    counts = materialise(_extraction_counts(texts).unionAll(_ocr_counts(rows)).groupBy("kind", "word").agg(F.sum("n").alias("n")), "scan-words")
    shared = spark.sparkContext.broadcast(_lexicon(counts))
    schema = "record_kind string, record_id bigint, noise string"

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = shared.value
        for b in batches:
            out = []
            for doc, t in zip(b["doc_id"], b["text"]):
                pages = pages_of(t)
                found = set()
                for p, odd in zip(pages, _furniture(pages, lex)):
                    if odd:
                        found.add("furniture")
                    if not found >= {"hyphen", "misread"}:
                        found |= _text_noise(lex, [x for i, x in enumerate(p) if i not in odd] if odd else p)
                out += [("extraction", doc, f) for f in found]
            yield pd.DataFrame(out, columns=["record_kind", "record_id", "noise"])

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = shared.value
        for b in batches:
            out = []
            for ids, texts, marks in zip(b["ids"], b["texts"], b["marks"]):
                keys, page = _distinct(ids, texts)
                odd = _odd(page, _marks(marks), lex) if len(page) > 1 else set()  # a line alone on its page is its body
                out += [("ocr_line", keys[i], "furniture") for i in odd]
                if odd:
                    page, keys = ([x for i, x in enumerate(y) if i not in odd] for y in (page, keys))
                text = "\n".join(page)
                doubtful = lex.doubtful(text)
                for i, x, before, after in _lines_to_look_at(page, text, doubtful):
                    split, misread = _body_noise(lex, x, before, after, doubtful)
                    if split:
                        out.append(("ocr_line", keys[i], "hyphen"))
                    if misread:
                        out.append(("ocr_line", keys[i], "misread"))
            yield pd.DataFrame(out, columns=["record_kind", "record_id", "noise"])

    a = texts.mapInPandas(whole, schema)
    b = rows.select("ids", "texts", "marks").mapInPandas(single, schema)
    return a.unionAll(b).distinct()


def _repaired(lex: Lexicon, line: str) -> str:
    """A line with its misread words put right, in the case they are written in."""
    bad = lex.doubtful(line)
    if not bad:
        return line

    def right(m: re.Match) -> str:
        t = m[0]
        if t not in bad:
            return t
        w = lex.right(t.lower())
        return w.upper() if t.isupper() and len(t) > 1 else w.capitalize() if t[0].isupper() else w

    return re.sub(r"(?:[^\W_]|[@|])+", right, line)


_OWN_LINE = re.compile(r"^(?:[-–•◦▪*]|\d{1,3}[.)]\s|[a-z]\)\s|\|)|\t|\s{3,}|\.{4,}")


def _paragraphs(lex: Lexicon, body: list[str]) -> str:
    """Lines of body text as paragraphs: split words joined, broken lines run on, list items, rows and headings kept apart."""
    widest = max((len(x) for x in body), default=0)
    out: list[str] = []
    whole = True  # whether the line before ended its paragraph
    for before, line, after in zip([None, *body[:-1]], body, [*body[1:], None]):
        split = lex.is_split(line, after)
        text = line[:-1] if split else line
        own = bool(_OWN_LINE.search(line))
        if out and not whole and not own:
            joined = before is not None and lex.is_split(before, line)
            # A compound keeps its hyphen and goes on without a space.
            space = "" if joined or before is not None and before.endswith("-") else " "
            out[-1] += space + text
        else:
            out.append(text)
        ended = line.endswith((".", "!", "?", ":")) and len(line) < 0.85 * widest
        heading = not split and not line.endswith((*_BREAK, ".", ",", ";")) and len(line) < 0.6 * widest and after is not None and after[:1].isupper()
        whole = own or ended or heading
    return "\n\n".join(_repaired(lex, x) for x in out)


def repaired_pages(extractions: DataFrame, lines: DataFrame) -> DataFrame:
    """(record_kind, record_id, engine, page, text): the pages of extractions and of recognised lines as readable paragraphs.

    Inputs and edge cases as for :func:`scan_noise`; record_id is the document's. Running headers and page numbers are
    gone, split words joined, misread words right; pages count from 1 in an extraction and have their number for lines.
    A page is gathered as one row. Pages of blank text give no row.
    """
    spark = extractions.sparkSession
    texts = extractions.select("doc_id", "text").where("text IS NOT NULL").distinct()
    rows = materialise(_ocr_pages(lines), "repair-pages")
    counts = materialise(_extraction_counts(texts.select("text")).unionAll(_ocr_counts(rows)).groupBy("kind", "word").agg(F.sum("n").alias("n")), "repair-words")
    shared = spark.sparkContext.broadcast(_lexicon(counts))
    schema = "record_kind string, record_id bigint, engine string, page int, text string"

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = shared.value
        for b in batches:
            out = []
            for doc, t in zip(b["doc_id"], b["text"]):
                pages = pages_of(t)
                for k, (p, odd) in enumerate(zip(pages, _furniture(pages, lex)), 1):
                    text = _paragraphs(lex, [x for i, x in enumerate(p) if i not in odd])
                    if text:
                        out.append(("extraction", doc, None, k, text))
            yield pd.DataFrame(out, columns=["record_kind", "record_id", "engine", "page", "text"]).astype({"page": "Int32"})

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = shared.value
        for b in batches:
            out = []
            for doc, engine, page, ids, texts, marks in zip(b["doc_id"], b["engine"], b["page_no"], b["ids"], b["texts"], b["marks"]):
                texts = _distinct(ids, texts)[1]
                odd = _odd(texts, _marks(marks), lex) if len(texts) > 1 else set()
                body = [x for i, x in enumerate(texts) if i not in odd]
                text = _paragraphs(lex, body)
                if text:
                    out.append(("ocr_page", doc, engine, page, text))
            yield pd.DataFrame(out, columns=["record_kind", "record_id", "engine", "page", "text"]).astype({"page": "Int32"})

    return texts.mapInPandas(whole, schema).unionAll(rows.mapInPandas(single, schema))
