import math

import pytest

from pagewright.llm import mixing

pytest.importorskip("public_tokenizers")
DOCS, AIMS = "doc_id bigint, source string, text string, tokens string", "source string, target_share double, max_repeats int, tokens string"


def run(spark, docs, aims, **more):
    d, a = spark.createDataFrame([(*x, "") for x in docs], DOCS), spark.createDataFrame([(*x, "") for x in aims], AIMS)
    taken, shares = mixing.mix(d, a, mixing.default_tokenizer(), **more)
    return taken.collect(), {r["source"]: r for r in shares.collect()}


def test_shares_and_repeats(spark, prose):
    docs = [(i, ("a", "b", "c")[0 if i < 100 else 1 if i < 140 else 2], prose(i, 20 + i % 37)) for i in range(150)]
    docs += [(900, "a", None), (901, "a", ""), (902, None, "text"), (903, "other", "text"), docs[0]]
    taken, shares = run(spark, docs, [("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 5)])
    caps = {"a": 1, "b": 3, "c": 5}
    assert all(0 <= r["copies"] <= caps[r["source"]] and r["rate"] <= caps[r["source"]] + 1e-9 for r in taken)
    assert {r["doc_id"] for r in taken} == {*range(150), 900, 901} and sum(r["copies"] for r in taken if r["doc_id"] >= 900) == 0
    for s, r in shares.items():
        assert abs(r["share"] - r["target_share"]) < 0.02, (s, r)


def test_rates_are_exponential_in_tokens(spark, prose):
    docs = [(i, "a" if i % 2 else "b", prose(i, 20 + i)) for i in range(60)]
    taken, _ = run(spark, docs, [("a", 0.7, 4), ("b", 0.3, 4)])
    b = [(r["tokens"], math.log(r["rate"])) for r in taken if r["source"] == "b" and r["rate"] < 4]
    slope = {round(y / x, 9) for x, y in b}
    assert len(slope) == 1


def test_total_missing_source_and_empty(spark, prose):
    docs = [(i, "a", prose(i, 30)) for i in range(40)]
    taken, shares = run(spark, docs, [("a", 0.5, 2), ("z", 0.5, 2)], total=600)
    assert shares["z"]["share"] == 0 and shares["a"]["share"] == 1 and abs(shares["a"]["tokens"] - 600) < 60
    taken, shares = run(spark, [], [("a", 1.0, 2)])
    assert taken == [] and shares["a"]["share"] == 0
    taken, shares = run(spark, docs, [])
    assert taken == [] and shares == {}
