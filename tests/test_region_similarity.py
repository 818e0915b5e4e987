import os
from difflib import SequenceMatcher

import pytest
from against_sql import SF
from pyspark.sql import functions as F

from pagewright.functions import fuzzy
from pagewright.functions import text as T
from pagewright.plans import text_queries


def plainly(needle, region):
    """The definition, window by window."""
    n = len(needle)
    if not n:
        return False
    if any(region[i : i + n] == needle for i in range(len(region) - n + 1)):
        return True
    if len("".join(needle)) < 6:
        return False
    windows = (region[i : i + k] for k in (n - 1, n, n + 1) if k >= 1 for i in range(len(region) - k + 1))
    return any(SequenceMatcher(None, " ".join(needle), " ".join(w)).ratio() >= fuzzy.ALIKE for w in windows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_query_gives_each_line_its_answer(spark):
    got = {r["line_id"]: r["similar"] for r in text_queries.x6_similar_in_region(spark, SF).collect()}
    pairs = text_queries._two(spark, SF).select("line_id", T.tokens(F.col("b")), T.tokens(F.col("a"))).collect()
    assert got == {i: plainly(b, a) for i, b, a in pairs} and set(got.values()) == {True, False}


def test_pairs_on_odd_tokens(spark):
    rows = [(1, ["cover", "plate"], ["the", "covor", "plate", "on"]), (2, [], ["a"]), (3, ["ab"], ["ac"]), (4, ["ab"], ["x", "ab"]), (5, ["pump"], []), (6, ["gearbox"], ["gear", "box"]), (7, ["valves"], ["rotors"])]
    df = spark.createDataFrame(rows, "line_id bigint, n array<string>, r array<string>")
    got = {r["line_id"] for r in fuzzy.similar_in_region(df, "line_id", "n", "r").collect()}
    assert got == {i for i, n, r in rows if plainly(n, r)} and {1, 4} <= got
