from pagewright.llm import structure

PROSE = "The valve was checked by the crew and the gauge was read twice. When the pump is warm, turn the handle to the left and wait for the light.\nIt should not be opened before the pressure has dropped to zero."
CASES = {
    "prose": PROSE, "list": "- upper valve\n- lower valve\n- spare hose\n- main seal ring", "numbered": "1. upper valve, 34 rpm\n2. lower valve, 12 bar\n3. spare hose, 7 hours",
    "table": "| Item | Value |\n|---|---|\n| upper valve | 3.4 |\n| lower valve | 9.1 |", "columns": "upper valve            34    3.1  rpm\nlower valve            12    9.5  bar\nspare hose               7    1.5  mm",
    "form": "Upper valve: KD-31\nLower valve: L290-W\nSpare hose: RL545\nMain seal: M9x5", "contents": "Upper valve ......... 12\nLower valve ................ 34\nSpare hose ...... 56",
    "titles": "Upper Relief Valve\nLower Relief Valve\nSpare Rubber Hose\nMain Seal Ring", "enumeration": "upper valve, lower valve, spare hose, main seal, long bolt, small nut, front cover, rear door",
    "base64": "HF6zg6tpcJVmqZJzcYeXIiKGZxOOkP0P8TyxfREA5cO3MHFmzQ", "symbols": "◊▯§□◊◊|,¬§`¬|,◊■`|§¬■□", "shifted": "qn qv lwcjb, zmilqvoa nzwu bpm bpzmilml kwwtqvo niv emzm zwbibml beqkm xzqwz bw abwziom.",
    "heading": "Care of the upper valve", "caption": "Prüfung: der Ölbehälter", "blank": "  \n ", "size": "Ø 830 mm × 725 mm",
}
OTHER = {"list", "numbered", "table", "columns", "form", "contents", "titles", "enumeration", "base64", "symbols", "shifted"}


def stats(spark, texts):
    rows = [(k, t, 1) for k, t in texts]
    return {r["key"]: r for r in structure.text_statistics(spark.createDataFrame(rows, "key string, text string, words int"), ["key"]).collect()}


def test_profiles(spark):
    filler = [(f"f{i}", PROSE) for i in range(5)]
    got = stats(spark, [*CASES.items(), *filler, filler[0], ("none", None), ("", "")])
    assert "none" not in got and got[""]["other_share"] == 0
    assert {k for k in CASES if got[k]["other_share"] > 0.5} == OTHER
    assert got["heading"]["profile"] == "heading" and got["blank"]["profile"] == "blank" and got["prose"]["profile"] == "prose"
    assert got["prose"]["lang"] == "en" and got["prose"]["words"] == len(PROSE.replace(".", "").replace(",", "").split()) and got["prose"]["stop_line_share"] == 1


def test_mixed_by_share(spark):
    got = stats(spark, [("half", PROSE + "\n- one item"), ("most", "Short words are in it, and so on.\n" + "- a much longer list item here\n" * 12), ("p", PROSE)])
    assert got["half"]["other_share"] < 0.5 < got["most"]["other_share"]


def test_empty(spark):
    assert stats(spark, []) == {}
