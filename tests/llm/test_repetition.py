import re

from pagewright.llm import repetition


def brute(text, run=6):
    w = re.findall(r"[^\W\d_]+", text.lower())
    seen = {}
    for i in range(len(w) - run + 1):
        seen.setdefault(tuple(w[i : i + run]), []).append(i)
    hit = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(run)}
    return len(w), len(hit)


def test_shares_equal_brute_force(spark, prose):
    texts = [prose(1, 40), prose(1, 20) + " " + prose(1, 20), "spam ham " * 30, "a b c d e f a b c d e f", "x " * 6, "x " * 7, "", "12 34", prose(3, 2000) + prose(3, 900)]
    rows = [(i, t, 0.0) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[0], (99, None, 0.0)], "doc_id bigint, text string, share double")
    got = {r["doc_id"]: r for r in repetition.repetition(df).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, t in enumerate(texts):
        n, k = brute(t)
        assert (got[i]["words"], got[i]["repeated"]) == (n, k) and got[i]["share"] == k / max(n, 1)
    assert got[6]["class_distance"] is None and got[6]["lang"] is None and got[0]["class_distance"] >= 0


def test_empty(spark):
    assert repetition.repetition(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
