"""Common table expressions for DuckDB that mirror pagewright.plans.views."""

from __future__ import annotations

from pagewright.plans.views import SPECIAL


def literal(s: str) -> str:
    """A string as a DuckDB literal with escapes."""
    return "E'" + "".join(c if c.isascii() and c.isprintable() and c not in "'\\" else f"\\x{ord(c):02x}" if ord(c) < 128 else c for c in s) + "'"


TRIPLE = "|".join(c * 3 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
SUSPICIOUS = rf"[A-Za-z][~`#$%&+<>;|][A-Za-z]|{TRIPLE}|[A-Z][a-z]+[A-Z][a-z]"
WORD = "[A-Za-z]+(?:[''’\\-][A-Za-z]+)?"
TOKEN = "[a-z0-9]+(?:[''’][a-z0-9]+)?"
ANY_CASE_TOKEN = "[A-Za-z0-9]+(?:[''’][A-Za-z0-9]+)?"
REVIEW_TOKEN = "[A-Za-z0-9][A-Za-z0-9''’._+/\\-]*"

PG = rf"""ex AS (SELECT doc_id, text FROM (SELECT DISTINCT doc_id, text FROM pdf_extractions) WHERE text IS NOT NULL),
cut AS (SELECT doc_id, text, regexp_extract_all(text, '(?m)^=== PAGE (\d+) ===\s*$', 1) AS n, string_split_regex(text, '(?m)^=== PAGE \d+ ===\s*$') AS p FROM ex),
own AS (SELECT doc_id, n[i]::INT AS page_no, p[i + 1] AS text FROM (SELECT *, unnest(range(1, len(n) + 1)) AS i FROM cut)
    UNION ALL SELECT doc_id, NULL, text FROM cut WHERE len(n) = 0),
pg AS (SELECT * FROM own UNION ALL SELECT * FROM (VALUES {", ".join(f"({d}, 1, {literal(t)})" for d, t in SPECIAL)}) v(doc_id, page_no, text))"""

FOLD = lambda x: f"lower(regexp_replace({x}, '[ßẞ]', 'ss', 'g'))"
TOKENS = lambda x: f"regexp_extract_all({FOLD(x)}, '{TOKEN}')"
ALNUM = lambda x: f"length(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))"
ALPHA = lambda x: f"length(regexp_replace({x}, '[^\\p{{L}}]', '', 'g'))"
SPACES = "[\\s\\x0b\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{0085}]"
ODD = lambda x: f"length(regexp_replace({x}, '[^~`#$%&<>|^]', '', 'g'))"

A = rf"""{PG},
f AS (SELECT doc_id, page_no, text, length(text) AS characters, {ALNUM('text')} AS alnum, {ALPHA('text')} AS alpha, len(regexp_extract_all(text, '{WORD}')) AS words,
    len(list_filter(regexp_extract_all(text, '{WORD}'), lambda w: regexp_matches(w, '{SUSPICIOUS}'))) AS odd_words, {ODD('text')} AS odd_chars FROM pg),
a AS (SELECT *, regexp_replace(text, '{SPACES}', '', 'g') = '' AS r1, contains(text, '�') AS r2, regexp_matches(text, '[\x00-\x08\x0b\x0e-\x1f]') AS r3,
    alnum < 20 AND alpha < 5 AND words < 2 AS r4, NOT (alnum < 20 AND alpha < 5 AND words < 2) AND alnum >= 100 AND alpha / alnum < 0.05 AS r5, odd_words >= 2 OR odd_chars >= 2 AS r6 FROM f),
s AS (SELECT *, list_filter([CASE WHEN r1 THEN 'empty_text' END, CASE WHEN r2 THEN 'replacement_character' END, CASE WHEN r3 THEN 'control_character' END, CASE WHEN r4 THEN 'too_little_text' END,
    CASE WHEN r5 THEN 'very_low_alphabetic_ratio' END, CASE WHEN r6 THEN 'suspicious_character_patterns' END], lambda x: x IS NOT NULL) AS reasons FROM a)"""

LN = """ln AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY line_id) AS rr FROM ocr_lines) WHERE rr = 1)"""
RG = """rg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY region_id) AS rr FROM native_regions) WHERE rr = 1)"""
EN = rf"""{LN},
t0 AS (SELECT line_id, doc_id, page_no, idx, text, confidence, polygon FROM ln WHERE text IS NOT NULL),
en AS (SELECT *, 'tesseract' AS engine FROM t0 UNION ALL
    SELECT line_id, doc_id, page_no, idx, CASE WHEN line_id % 5 = 0 THEN replace(text, 'o', '0') ELSE text END, CASE WHEN line_id % 23 <> 0 THEN (50 + (line_id * 7919) % 50) / 100.0 END,
    CASE WHEN line_id % 19 <> 0 THEN list_transform(polygon, lambda p: {{'x': p.x, 'y': CASE WHEN line_id % 7 = 0 THEN p.y + 0.3 ELSE p.y END}}) END, 'paddleocr' FROM t0 WHERE line_id % 13 <> 0)"""


def hull(p: str, strict: bool = True) -> str:
    """l, t, r, b of a polygon as a struct, null without area."""
    xs, ys = f"list_transform({p}, lambda q: q.x)", f"list_transform({p}, lambda q: q.y)"
    made = f"{{'l': list_min({xs}), 't': list_min({ys}), 'r': list_max({xs}), 'b': list_max({ys})}}"
    ok = f"len({p}) > 0" + (f" AND list_max({xs}) > list_min({xs}) AND list_max({ys}) > list_min({ys})" if strict else "")
    return f"CASE WHEN {ok} THEN {made} END"


def area(b: str) -> str:
    return f"(greatest(0.0, {b}.r - {b}.l) * greatest(0.0, {b}.b - {b}.t))"


def shared(a: str, b: str) -> str:
    return f"(greatest(0.0, least({a}.r, {b}.r) - greatest({a}.l, {b}.l)) * greatest(0.0, least({a}.b, {b}.b) - greatest({a}.t, {b}.t)))"


LR = rf"""lr AS (SELECT * FROM (SELECT line_id AS region_id, doc_id, page_no, CASE WHEN line_id % 4 = 0 THEN replace(text, 'e', 'c') ELSE text END AS text, {hull('polygon')} AS box FROM ln WHERE text IS NOT NULL AND line_id % 3 <> 0) WHERE box IS NOT NULL)"""
