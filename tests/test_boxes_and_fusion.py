from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import scoring as C
from pagewright.operators import fusion

POLY = "array<struct<x:double,y:double>>"


def square(x, y, w=0.2, h=0.05):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def test_polygons(spark):
    nan = float("nan")
    rows = [([(0.0, 0.0), (300.0, -5.0), (900.0, 50.0)], 600.0), ([(0.0, 0.0), (1.0, 1.0)], 600.0), (None, 600.0), ([(nan, 0.0)] * 3, 600.0), (square(0.0, 0.0), 0.0)]
    got = [r[0] for r in spark.createDataFrame(rows, f"p {POLY}, w double").select(G.normal_polygon(F.col("p"), F.col("w"), F.lit(100.0))).collect()]
    assert [(p.x, p.y) for p in got[0]] == [(0.0, 0.0), (0.5, 0.0), (1.0, 0.5)] and got[1:] == [None] * 4


def test_hulls_without_area(spark):
    df = spark.createDataFrame([([(0.1, 0.1)] * 3,), ([],), (None,)], f"p {POLY}")
    assert [r[0] for r in df.select(G.hull(F.col("p"))).collect()] == [None] * 3
    assert df.select(G.hull(F.col("p"), degenerate=True)).first()[0] is not None


def test_native_boxes(spark):
    nan = float("nan")
    df = spark.createDataFrame([((10.0, 90.0, 50.0, 80.0), True), ((50.0, 20.0, 10.0, 10.0), False), ((0.0, 0.0, 0.0, 5.0), False), ((nan, 0.0, 1.0, 1.0), False), (None, False)], "b struct<l:double,t:double,r:double,b:double>, o boolean")
    got = [r[0] and tuple(round(v, 6) for v in r[0]) for r in df.select(G.normal_box(F.col("b"), F.lit(100.0), F.lit(100.0), F.col("o"))).collect()]
    assert got == [(0.1, 0.1, 0.5, 0.2), (0.1, 0.1, 0.5, 0.2), None, None, None]


def test_preference_edges(spark):
    cases = [(77.0, 85.0, "paddleocr"), (77.1, 85.0, None), (None, 85.0, "paddleocr"), (85.0, None, "tesseract"), (84.9, None, None), (95.0, 86.0, "tesseract")]
    df = spark.createDataFrame([c[:2] for c in cases], "a double, b double")
    assert [r[0] for r in df.select(C.preferred_engine(F.col("a"), F.col("b"))).collect()] == [c[2] for c in cases]
    bands = spark.createDataFrame([(89.96,), (90.0,), (74.96,), (None,)], "s double").select(C.band(F.col("s"))).collect()
    assert [r[0] for r in bands] == ["review", "high", "low", "unrated"]


LINES = f"line_id bigint, doc_id bigint, page_no int, engine string, idx int, text string, confidence double, polygon {POLY}"


def test_matching_is_greedy_and_ties_fall(spark):
    # Both engines see the same words twice in the same place: equal weights, so the last places pair first.
    rows = [(e * 10 + i, 1, 1, name, i, "same words", 0.9, None) for e, name in ((1, "tesseract"), (2, "paddleocr")) for i in range(2)]
    df = spark.createDataFrame(rows, LINES)
    pairs = fusion.match(fusion.candidates(fusion.side(df, "tesseract", "a"), fusion.side(df, "paddleocr", "b")))
    assert sorted((r["ak"], r["bk"]) for r in pairs.collect()) == [(0, 0), (1, 1)]


def test_fuse(spark):
    rows = [
        (1, 1, 1, "tesseract", 0, "Replace the filter", 0.9, square(0.1, 0.1)), (2, 1, 1, "tesseract", 1, "only here", 0.9, square(0.1, 0.5)),
        (3, 1, 1, "paddleocr", 0, "Replace the f!!xx", 0.9, square(0.1, 0.1)), (4, 1, 1, "paddleocr", 1, "and there", 0.9, None),
        (5, 1, 2, "tesseract", 0, "bad page", 0.1, None), (6, 1, 2, "paddleocr", 0, "good page", 0.9, None),
    ]
    lines = spark.createDataFrame(rows, LINES)
    regions = spark.createDataFrame([(1, 1, "Replace the filter", (0.05, 0.05, 0.5, 0.2))], "doc_id bigint, page_no int, text string, box struct<l:double,t:double,r:double,b:double>")
    scores = spark.createDataFrame([(1, 1, 80.0, 80.0), (1, 2, 10.0, 90.0)], "doc_id bigint, page_no int, first double, second double")
    got = sorted((r["page_no"], r["place"], r["line_id"], r["source"], r["reason"]) for r in fusion.fuse(lines, regions, scores).collect())
    assert [g[:4] for g in got] == [(1, 1, 1, "tesseract"), (1, 2, 2, "tesseract"), (1, 3, 4, "paddleocr"), (2, 1, 6, "paddleocr")]
    assert got[0][4] == "stronger_native_text_support"


def test_empty_pages(spark):
    lines = spark.createDataFrame([], LINES)
    regions = spark.createDataFrame([], "doc_id bigint, page_no int, text string, box struct<l:double,t:double,r:double,b:double>")
    scores = spark.createDataFrame([], "doc_id bigint, page_no int, first double, second double")
    assert fusion.fuse(lines, regions, scores).count() == 0
