import numpy as np

from pagewright.llm import leakage


def found(spark, docs, items, monkeypatch, keys, **more):
    monkeypatch.setattr(leakage, "BROADCAST_KEYS", keys)
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    return {tuple(r) for r in leakage.leaks(d, i, **more).collect()}


def test_first_words_run_together_are_found_whatever_the_size_of_the_index(spark, prose, monkeypatch):
    items = [(i, prose(300 + i, 10)) for i in range(5)]
    docs = [(i, prose(i, 20) + t + " " + prose(50 + i, 20)) for i, t in items]
    want = {(i, i) for i, _ in items}
    for keys in (4_000_000, 0):
        got = found(spark, docs, items, monkeypatch, keys)
        assert {(d, i) for d, i, e in got if e == 0} == want


def test_edits_of_any_width_are_judged_alike_whatever_the_size_of_the_index(spark, prose, monkeypatch):
    r = np.random.default_rng(4)
    letters = [str.maketrans("aeo", "äéö"), str.maketrans("aeo", "аео"), {}]
    items = [(i, prose(600 + i, 10).translate(letters[i % 3])) for i in range(60)]
    docs = []
    for i, t in items:
        s = list(t)
        for _ in range(2):
            at = int(r.integers(1, len(s) // 3))
            s[at:at] = ["漢" if i % 2 else "𠀀"]
        docs.append((i, prose(i, 20) + " " + "".join(s) + " " + prose(50 + i, 20)))
    ways = [found(spark, docs, items, monkeypatch, keys) for keys in (4_000_000, 0)]
    assert ways[0] == ways[1] and sum(d == i and e == 2 for d, i, e in ways[0]) >= 20
