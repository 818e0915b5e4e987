import unicodedata

from pyspark.sql import functions as F

from pagewright.functions import fuzzy
from pagewright.functions import text as T
from pagewright.operators import quality, transcript
from pagewright.plans.views import SPECIAL


def reasons(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[1] for r in df.select("i", T.reasons(F.col("text"))).orderBy("i").collect()]


def test_reasons_of_special_rows(spark):
    got = dict(zip((d for d, _ in SPECIAL), reasons(spark, *(t for _, t in SPECIAL))))
    empty = ["empty_text", "too_little_text"]
    assert got[-1] == got[-2] == got[-3] == empty
    assert got[-4] == ["replacement_character"] and got[-5] == ["control_character"] == got[-6] and got[-7] == []
    assert got[-8] == ["too_little_text"] and got[-9] == []
    assert got[-10] == ["very_low_alphabetic_ratio"] and got[-11] == []
    assert got[-12] == ["suspicious_character_patterns"] == got[-13]


def test_odd_characters_need_two(spark):
    assert reasons(spark, "a plain line of words | here", "a | b | plain line of words") == [[], ["suspicious_character_patterns"]]


def test_split_pages(spark):
    text = "=== PAGE 1 ===\n\nfirst\n\n=== PAGE 12 ===\n\nsecond === PAGE 3 ===\n"
    df = spark.createDataFrame([(1, text, 0), (2, "no marks", 0), (3, None, 0), (4, "", 0)], "doc_id bigint, text string, page_no int")
    rows = sorted(((r["doc_id"], r["page_no"], r["text"].strip()) for r in transcript.split_pages(df).collect()), key=str)
    assert rows == [(1, 1, "first"), (1, 12, "second === PAGE 3 ==="), (2, None, "no marks"), (4, None, "")]


def test_clean_drops_covered_repeats_of_kept_lines():
    head = T.SECTIONS[0]
    a, b, c = "[x=0.000..0.500, y=0.000..0.500] Same  text", "[x=0.000..0.500, y=0.100..0.500] same text", "[x=0.900..0.950, y=0.900..0.950] Same text"
    out = transcript.clean_text(f"=== PAGE 1 ===\n{head}\n{a}\n{b}\n{c}\n\n\n[position unavailable] tail\n\n")
    assert out.startswith("=== PAGE 1 ===\nSame text\n") and out.endswith("tail\n") and "\n\n\n" not in out


def test_clean_outside_sections_keeps_repeats():
    line = "[x=0.000..0.500, y=0.000..0.500] twice"
    assert transcript.clean_text(f"{line}\n{line}") == "twice\ntwice\n"
    assert transcript.clean_text("  \n ") == "" and transcript.clean_text("a b") == "a b\n"
    assert transcript.clean_text(unicodedata.normalize("NFD", "é")) == "é\n"


def test_tokens_and_sequences(spark):
    df = spark.createDataFrame([("Straße it's OK", ["b", "c"], ["a", "b", "c"]), ("", [], ["a"]), (None, ["bc"], ["a", "b", "c"])], "text string, n array<string>, h array<string>")
    rows = df.select(T.tokens(F.col("text")), T.contains_sequence(F.col("h"), F.col("n"))).collect()
    assert rows[0][0] == ["strasse", "it's", "ok"] and [r[1] for r in rows] == [True, False, False] and rows[2][0] is None


def test_duration(spark):
    got = spark.createDataFrame([(s,) for s in (0.0, 59.4, 60.0, 3600.0, 3661.0, 86400.0, 90061.0, 86460.0, -5.0)], "s double").select(T.duration(F.col("s"))).collect()
    assert [r[0] for r in got] == ["0s", "59s", "1m", "1h", "1h 1m", "1d", "1d 1h", "1d 1m", "0s"]


def test_similarities(spark):
    df = spark.createDataFrame([("cover plate", "covor plate"), ("", "x"), (None, "x")], "a string, b string")
    got = [r[0] for r in df.select(fuzzy.similarity("a", "b")).collect()]
    assert 0.9 < got[0] < 1 and got[1:] == [0.0, 0.0]
    df = spark.createDataFrame([(["ab", "cover"], ["ac", "covor"]), ([], ["a"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(fuzzy.token_support("a", "b")).collect()] == [0.0, 0.0]
    got = [r[0] for r in df.select(fuzzy.sequence_similarity("a", "b")).collect()]
    assert got == [0.0, 0.0]


def test_page_quality_edges(spark):
    lines = spark.createDataFrame([(1, "e", 1, 0, "fine words", None), (1, "e", 2, 0, "fine words", 1.0), (1, "e", 2, 1, "Helllo", 0.5)], "doc_id bigint, engine string, page_no int, idx int, text string, confidence double")
    pages = spark.createDataFrame([(1, "e", p) for p in (1, 2, 3)], "doc_id bigint, engine string, page_no int")
    got = {r["page_no"]: r for r in quality.page_quality(lines, pages=pages).collect()}
    assert got[1]["score"] == 100.0 and got[3]["score"] == 0.0 and got[3]["lines"] == 0
    assert abs(got[2]["score"] - (75 * 0.45 + 50 * 0.2) / 0.65) < 1e-9
    doc = quality.document_quality(quality.page_quality(lines, pages=pages)).first()
    assert doc["scored_pages"] == 3 and doc["weakest_score"] == 0.0
