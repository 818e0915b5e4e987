import random

import numpy as np
import pytest

from pagewright.llm import leakage

DOCS, ITEMS = "doc_id bigint, text string, item_id int", "item_id bigint, text string, doc_id int"


def run(spark, docs, items, most=0, **more):
    d, i = spark.createDataFrame([(*x, 0) for x in docs], DOCS), spark.createDataFrame([(*x, 0) for x in items], ITEMS)
    return {(r["doc_id"], r["item_id"]) for r in leakage.leaks(d, i, **more).where(f"edits <= {most}").collect()}


def test_ten_words_and_no_fewer(spark, prose):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    w = item.split()
    docs = [(1, prose(1) + " " + " ".join(w[1:11]) + " " + prose(2)), (2, prose(1) + " " + " ".join(w[:9]) + " " + prose(2)), (3, "Alpha, BETA\ngam-\nma: delta; epsilon zeta — eta (theta) iota kappa!"), (4, None), (5, ""), (6, " ".join(w[:5]) + " now " + " ".join(w[5:])), (1, prose(1) + " " + " ".join(w[1:11]) + " " + prose(2))]
    items = [(10, item), (10, item), (11, "too short"), (12, None), (13, "other words " + item)]
    assert run(spark, docs, items) == {(1, 10), (1, 13), (3, 10), (3, 13)}


@pytest.mark.parametrize("keys", [4_000_000, 0])
def test_equal_brute_force_sent_around_or_joined(spark, prose, monkeypatch, keys):
    monkeypatch.setattr(leakage, "BROADCAST_KEYS", keys)
    r = random.Random(2)
    items = [(i, prose(100 + i, 25)) for i in range(8)]
    docs = []
    for d in range(40):
        _, t = r.choice(items)
        w = t.split()
        at = r.randrange(12)
        docs.append((d, prose(d, 30) + " " + " ".join(w[at : at + r.choice((6, 9, 10, 12))]) + " " + prose(d + 500, 10)))
    flat = lambda t: "".join(t.split())
    want = {(d, i) for d, t in docs for i, s in items if any(flat(" ".join(s.split()[k : k + 10])) in flat(t) for k in range(16))}
    assert run(spark, docs, items) == want and want


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_recall_of_a_thousand_edited_passages(spark, prose, edits):
    r = np.random.default_rng(edits)
    items = [(i, prose(2000 + i, 10)) for i in range(1000)]
    docs = []
    for i, t in items:
        edited = leakage._edited(t.encode(), b"", edits, r).decode()
        docs.append((i, prose(i, 20) + " " + edited + " " + prose(i + 5000, 20)))
    found = run(spark, docs, items, most=edits, edits=edits, recall=0.95)
    # An edit that adds or takes a blank changes nothing that is compared; the others must be found.
    assert len({(i, i) for i, _ in items} & found) >= 950


def test_short_windows_and_first_words_run_together(spark, prose):
    assert run(spark, [(1, "x a b c then more words"), (2, "x a b d")], [(7, "a b c")], words=3) == {(1, 7)}
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    assert run(spark, [(1, prose(1) + item + " " + prose(2))], [(7, item)]) == {(1, 7)}


def test_distance():
    assert [leakage.within(a, b, 2) for a, b in (("abcd", "abcdxx"), ("abcd", "abxdxx"), ("abcd", "acdxx"), ("abcd", "zzzzz"), ("abcd", ""))] == [0, 1, 1, 3, 3]


def test_empty(spark):
    assert run(spark, [], [(1, "a b c d e f g h i j k")]) == set() and run(spark, [(1, "a b")], []) == set()
