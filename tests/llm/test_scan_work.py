import pytest

from pagewright.llm import scan


def test_edge_lines_are_looked_for_once_at_either_edge(prose, monkeypatch):
    pages = [["Running head of all", *(prose(10 * p + k, 8) for k in range(6)), f"- {p} -"] for p in range(5)]
    asked = []
    keep = scan.edge_lines
    monkeypatch.setattr(scan, "edge_lines", lambda page, bottom: asked.append(bottom) or keep(page, bottom))
    odd = scan._furniture(pages, scan.Lexicon({}, set(), set(), set()))
    assert odd == [{0, 7}] * 5 and len(asked) == 2 * len(pages)


@pytest.mark.parametrize("line", ["Annual report   12", "Annual report\t[ xiv ]", "Annual report  7 ", "Annual report  ٣", "Annual report.  12", "Annual report", "Annual, report.", "12", "", "a b 12."])
def test_headers_with_and_without_a_number(line):
    bare = scan._WITH_NUMBER.sub("", line)
    want = len(bare) <= scan.LONGEST and not bare.endswith((".", ",", ";", *scan._BREAK)) and not scan._NO_HEADER.search(bare) and bool(scan._THREE_LETTERS.search(bare))
    assert scan._can_be_header(line) == want


def test_lines_of_a_place_are_sent_around_once_to_be_compared(spark):
    rows = [(10 * p + k, 1, "a", p, k, t) for p in range(1, 5) for k, t in enumerate(["Anual report of all" if p == 3 else "Annual report of all", f"{('Pumps', 'Valves', 'Motors', 'Cables')[p - 1]} are described here", "and goes on"])]
    lines = spark.createDataFrame(rows, "line_id bigint, doc_id bigint, engine string, page_no int, idx int, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = scan._ocr_pages(lines)
        got = {r["page_no"]: {(m["side"], m["depth"]) for m in r["marks"] or []} for r in pages.collect()}
        plan = pages._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # A misread header is that of the other pages; what ends all pages comes again too.
    assert got == {p: {(0, 0), (0, 2), (1, 0), (1, 2)} for p in range(1, 5)}
    assert "Window" in plan and "count(distinct" not in plan.lower()


def test_starts_of_lines_are_those_of_their_ends():
    for line in ("Annual report  12", "a", "", "-- xiv", "xx\t- 3 -", "Wort, zwei ...", "@|x y.z", "w" * 90, "one " * 30 + "." * 85, "ab1cd 22 Öl"):
        assert scan.line_start(line) == scan.line_ends(line)[0]


def test_pages_with_nothing_that_comes_again_skip_the_search_for_edge_lines(prose, monkeypatch):
    page = ["- 7 -", *(prose(k, 8) for k in range(6)), "12"]
    monkeypatch.setattr(scan, "edge_lines", lambda page, bottom: pytest.fail("not needed"))
    assert scan._odd(page, {}, scan.Lexicon({}, set(), set(), set())) == {0, 7}
