from pagewright.llm import encoding

RIGHT = [
    "Der Kühler wurde geprüft und die Abdeckung geöffnet, während das Gerät außen gelöst war.", "Le tableau électrique était réparé, mais la pièce forgée a été usée à l'arrêt.",
    "La válvula de alivio está en el taller y el año de fábrica quedó en la señal.", "Keep the relief valve below 54 °C — the crew’s note was kept.", "Замените фильтр после часов работы и проверьте давление насоса",
    "ANEXO Â: VERIFICAÇÃO Nº 12", "ΔP = 25 kPa, η ≈ 0,8", "◊▯§□◊◊|,¬§`¬|`", "plain ascii only", "", None, "🙂 日本語のテキスト",
]


def garble(t, meant, read):
    return t.encode(meant).decode(read, "replace")


def frame(spark, extra):
    rows = [(i, i % 3, t, "x") for i, t in enumerate(RIGHT * 12)]
    rows += [(1000 + i, 5, t, "x") for i, t in enumerate(extra)]
    return spark.createDataFrame([*rows, rows[0], rows[-1]], "region_id bigint, doc_id bigint, text string, swap string")


def test_swaps_are_found_and_restored(spark):
    pairs = [(RIGHT[0], "utf_8", "latin_1"), (RIGHT[1], "utf_8", "mac_roman"), (RIGHT[2], "utf_8", "cp437"), (RIGHT[0], "cp1252", "mac_roman"), (RIGHT[0], "cp1252", "cp1251"), (RIGHT[4], "utf_8", "latin_1")]
    extra = [garble(*p) for p in pairs]
    extra.append(garble(garble(RIGHT[2], "utf_8", "latin_1"), "utf_8", "latin_1"))
    extra.append(RIGHT[0] + " " + garble("Die Tür ist geschlossen.", "utf_8", "latin_1"))
    extra.append("Der K�hler")
    got = {r["region_id"]: r for r in encoding.garbled(frame(spark, extra)).collect()}
    assert sorted(got) == [1000 + i for i in range(len(extra))]
    for i, (t, _, _) in enumerate(pairs):
        assert got[1000 + i]["restored"] == t
    assert got[1006]["restored"] == RIGHT[2] and got[1007]["restored"] == RIGHT[0] + " Die Tür ist geschlossen." and got[1008]["restored"] is None


def test_empty(spark):
    assert encoding.garbled(spark.createDataFrame([], "region_id bigint, doc_id bigint, text string")).count() == 0
