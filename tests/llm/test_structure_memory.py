import tracemalloc

import numpy as np
import pandas as pd

from pagewright.llm import structure

PROSE = "The valve was checked by the crew and the gauge was read twice. When the pump is warm, turn the handle to the left.\n"
ODD = [".", "1. upper valve, 34 rpm", "- a\n\n…\n.", "| Item | Value |", "Prüfung: der Ölbehälter\t4", "HF6zg6tpcJVmqZJzcYeXIiKGZxOOkP0P8TyxfREA5cO3MHFmzQ", "12.", "x) y", "\U0001f600 le 3x4 bar/h"]


def test_memory_does_not_grow_with_a_batch_or_a_text(spark, monkeypatch):
    df = spark.createDataFrame([(1, PROSE)], "key int, text string")
    runs, plan = [], type(df).mapInPandas
    monkeypatch.setattr(type(df), "mapInPandas", lambda self, f, schema: runs.append(f) or plan(self, f, schema))
    structure.text_statistics(df, ["key"])
    assert len(runs) == 2
    for texts in ([PROSE * 30] * 1000, [PROSE * 30_000]):
        b = pd.DataFrame({"key": range(len(texts)), "text": texts})
        for run in runs:
            tracemalloc.start()
            try:
                got = pd.concat(run(iter([b])))
                most = tracemalloc.get_traced_memory()[1] / 1e6
            finally:
                tracemalloc.stop()
            assert most < 60
        assert got["key"].tolist() == b["key"].tolist() and set(got["words"]) == {texts[0].count(" ") + texts[0].count("\n")}


def test_marks_of_a_line_are_the_same_in_any_part(monkeypatch):
    names = ("marks", "size", "words", "letters", "lang", "tokens", "slashes", "ascii")
    alone = [structure.Lines([t]) for t in ODD]
    for chunk in (1, 40, 1 << 18):
        monkeypatch.setattr(structure, "_CHUNK", chunk, raising=False)
        together = structure.Lines(ODD + ODD)
        for k in names:
            np.testing.assert_array_equal(getattr(together, k), np.concatenate([getattr(x, k) for x in alone + alone]))
