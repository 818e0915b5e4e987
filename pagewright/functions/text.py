"""Text expressions. All are plain columns, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, characters and bounds whose results must agree with the published behaviour.
WORD = r"[A-Za-z]+(?:['’\-][A-Za-z]+)?"
TOKEN = r"[a-z0-9]+(?:['’][a-z0-9]+)?"
ANY_CASE_TOKEN = r"[A-Za-z0-9]+(?:['’][A-Za-z0-9]+)?"
REVIEW_TOKEN = r"[A-Za-z0-9][A-Za-z0-9'’._+/\-]*"
SUSPICIOUS = r"[A-Za-z][~`#$%&+<>;|][A-Za-z]|([A-Za-z])\1\1|[A-Z][a-z]+[A-Z][a-z]"
ODD_CHARACTERS = r"[~`#$%&<>|^]"
PAGE_MARK = r"(?m)^=== PAGE (\d+) ===\s*$"
POSITION = r"^\[(?:x=(\d+(?:\.\d+)?)\.\.(\d+(?:\.\d+)?), y=(\d+(?:\.\d+)?)\.\.(\d+(?:\.\d+)?)|position unavailable)\]\s*"
SECTIONS = (
    "[OCR line positions are normalized to page size]",
    "[OCR text not represented in the PDF text layer; positions are normalized to page size]",
)
SPACE = r"(?U)\s+"


def casefold(c: Column) -> Column:
    """Lower case with sharp s spelled out; the foldings of other single letters are those of lower case."""
    return F.lower(F.regexp_replace(c, "[ßẞ]", "ss"))


def stripped(c: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    return ~c.rlike(r"(?U)\S")


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(casefold(c), F.lit(TOKEN), F.lit(0))


def normalised(c: Column) -> Column:
    return F.array_join(tokens(c), " ")


def collapsed(c: Column) -> Column:
    """For comparing texts apart from case and spacing."""
    return stripped(F.regexp_replace(casefold(c), SPACE, " "))


def count_of(c: Column, others: str) -> Column:
    """How many characters of a class a text has, given a pattern of runs of all others: these are fewer than the characters."""
    return F.length(F.regexp_replace(c, others, ""))


def alnum_count(c: Column) -> Column:
    return count_of(c, r"[^\p{L}\p{N}]+")


def alpha_count(c: Column) -> Column:
    return count_of(c, r"\P{L}+")


def alpha_ratio(c: Column) -> Column:
    n = alnum_count(c)
    return F.when(n > 0, alpha_count(c) / n).otherwise(F.lit(0.0))


def suspicious_words(c: Column) -> Column:
    # A text without the patterns has no word with them, so most texts aren't cut into words.
    return F.when(c.rlike(SUSPICIOUS), F.size(F.filter(words(c), lambda w: w.rlike(SUSPICIOUS)))).otherwise(0 * F.length(c))


def too_little(c: Column, alnum: Column | None = None, alpha: Column | None = None) -> Column:
    alnum, alpha = alnum_count(c) if alnum is None else alnum, alpha_count(c) if alpha is None else alpha
    return F.when((alnum < 20) & (alpha < 5), F.size(words(c)) < 2).otherwise(alnum < 0)


def low_alpha(c: Column, alnum: Column | None = None, alpha: Column | None = None) -> Column:
    alnum, alpha = alnum_count(c) if alnum is None else alnum, alpha_count(c) if alpha is None else alpha
    return (alnum >= 100) & (alpha < 0.05 * alnum)


def has_control(c: Column) -> Column:
    return c.rlike(r"[\x00-\x08\x0B\x0E-\x1F]")


def odd_count(c: Column) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, ODD_CHARACTERS, ""))


def is_suspicious(c: Column) -> Column:
    return (suspicious_words(c) >= 2) | (odd_count(c) >= 2)


def reasons(c: Column, alnum: Column | None = None, alpha: Column | None = None) -> Column:
    """Why a text layer can't be trusted, in order; empty if it can. alnum, alpha: its counts, where they are known already."""
    if alnum is None or alpha is None:
        # Bound by a lambda, so that a text is counted once and not once for each check.
        return F.transform(F.array(F.struct(alnum_count(c).alias("alnum"), alpha_count(c).alias("alpha"))), lambda n: reasons(c, n.alnum, n.alpha))[0]
    checks = (
        (is_blank(c), "empty_text"),
        (c.contains("�"), "replacement_character"),
        (has_control(c), "control_character"),
        (too_little(c, alnum, alpha), "too_little_text"),
        (low_alpha(c, alnum, alpha), "very_low_alphabetic_ratio"),
        (is_suspicious(c), "suspicious_character_patterns"),
    )
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in checks]))


def noise_score(c: Column) -> Column:
    """Share of suspicious tokens, single letters counting half; 1 without tokens."""
    t = F.regexp_extract_all(c, F.lit(ANY_CASE_TOKEN), F.lit(0))
    odd = F.size(F.filter(t, lambda w: w.rlike(SUSPICIOUS)))
    short = F.size(F.filter(t, lambda w: (F.length(w) == 1) & w.rlike("[A-Za-z]")))
    return F.when(F.size(t) > 0, (odd + 0.5 * short) / F.size(t)).otherwise(F.lit(1.0))


def contains_sequence(haystack: Column, needle: Column) -> Column:
    """Whether the tokens of needle stand together in haystack; an empty needle doesn't."""
    n, m = F.size(haystack), F.size(needle)
    # Both ends of every token are marked, so a token never matches a part of another.
    flat = lambda a: F.concat(F.lit("\x1f"), F.array_join(a, "\x1f"), F.lit("\x1f"))
    return (m > 0) & (m <= n) & F.contains(flat(haystack), flat(needle))


def review_tokens(c: Column) -> Column:
    return F.filter(F.regexp_extract_all(c, F.lit(REVIEW_TOKEN), F.lit(0)), lambda w: w.rlike(SUSPICIOUS))


def strip_annotations(c: Column) -> Column:
    """The recognised text alone: no document line, page marks, section headers or positions; lines joined by line feeds."""
    lines = F.transform(F.split(c, r"\R"), stripped)
    body = F.filter(lines, lambda x: ~x.isin(*SECTIONS) & ~x.rlike(r"^DOCUMENT:") & ~x.rlike(r"(?i)^=== PAGE \d+ ===$"))
    bare = F.transform(body, lambda x: stripped(F.regexp_replace(x, POSITION, "")))
    return F.array_join(F.filter(bare, lambda x: x != ""), "\n")


def duration(seconds: Column) -> Column:
    """The two largest units of a number of seconds that aren't 0, as in '2h 5m'; halves of a second go to the even one."""
    s = F.greatest(F.bround(seconds, 0).cast("bigint"), F.lit(0).cast("bigint"))
    parts = ((F.floor(s / 86400), "d"), (F.floor(s / 3600) % 24, "h"), (F.floor(s / 60) % 60, "m"), (s % 60, "s"))
    known = F.array_compact(F.array(*[F.when(n > 0, F.concat(n.cast("string"), F.lit(u))) for n, u in parts]))
    return F.when(s > 0, F.array_join(F.slice(known, 1, 2), " ")).otherwise(F.lit("0s"))
