from pagewright.llm import scan

BODY = ["The upper valve was checked by the crew before the", "pump was started. The spring-loaded cover and the", "gauge plate were cleaned when the pressure dropped.", "Then the intermediate shaft was turned to the left."]


def page(n, *lines):
    return f"=== PAGE {n} ===\n\n" + "\n".join(lines) + "\n"


EX = "doc_id bigint, text string, noise string"
LN = "line_id bigint, doc_id bigint, engine string, page_no int, idx int, text string, noise string"


def noise(spark, extractions, lines=()):
    clean = [(1000 + i, page(1, *BODY) + page(2, *BODY[1:], BODY[0]), "") for i in range(15)]
    return {tuple(r) for r in scan.scan_noise(spark.createDataFrame([*clean, *[(*e, "") for e in extractions]], EX), spark.createDataFrame([(*x, "") for x in lines], LN)).collect()}


def test_extractions(spark):
    ex = [
        (1, page(1, "Pump Fitting Notes Rev A", *BODY, "[12]") + page(2, "PUMP FITTING NOTES REV A", *BODY, "[13]")),
        (2, page(1, BODY[0], "pump was started. The inter-", "mediate shaft was turned.", BODY[3])),
        (3, page(1, "The pump and the spring-", "loaded cover were cleaned.", *BODY)),
        (4, page(1, *BODY[:2], "gauge platc were cleaned whcn the pressure dropped.", BODY[3])),
        (5, page(1, "Care of the upper valve", *BODY)), (6, None), (7, ""), (7, ""), (8, page(1, BODY[0], "pump was started. The inter¬", "medjate shaft was turned.", BODY[3])),
    ]
    got = noise(spark, ex)
    assert {g for g in got if g[1] < 1000} >= {("extraction", 1, "furniture"), ("extraction", 2, "hyphen"), ("extraction", 4, "misread"), ("extraction", 8, "hyphen")}
    assert {g[1] for g in got} == {1, 2, 4, 8} and ("extraction", 1, "misread") not in got and ("extraction", 2, "misread") not in got


def test_lines(spark):
    rows, k = [], 0
    for p in (1, 2):
        for i, t in enumerate(["Pump Fitting Notes Rev A", "The upper va1ve was checked by the", "crew before the inter-", "mediate shaft was turned.", f"Page {p} of 2"]):
            k += 1
            rows.append((k, 5, "tesseract", p, i, t))
    rows += [rows[0], (90, 5, "tesseract", 3, 0, None), (91, 6, "tesseract", 1, 0, "  ")]
    got = noise(spark, [], rows)
    want = {("ocr_line", i, n) for i, n in ((1, "furniture"), (2, "misread"), (3, "hyphen"), (5, "furniture"), (6, "furniture"), (7, "misread"), (8, "hyphen"), (10, "furniture"))}
    assert got == want


def test_skeletons_of_confused_words_agree():
    for a, b in (("because", "becavse"), ("hydraulic", "hydrauhc"), ("modern", "modem"), ("cloth", "c1oth"), ("where", "vvhere"), ("line", "1ine"), ("roller", "rol1er"), ("after", "affer"), ("that", "tbat"), ("once", "0nce"), ("camshaft", "carnshaft")):
        assert scan.skeleton(a) == scan.skeleton(b)


def test_page_numbers():
    assert all(map(scan.is_page_number, ("12", "[9]", "- 58 -", "p. 7", "Page 3 of 12", "iv", "Seite 4")))
    assert not any(map(scan.is_page_number, ("4.5 Threaded gasket", "mm.", "12 bar", "Page", "vivid", "")))


def test_empty(spark):
    e, x = spark.createDataFrame([], EX), spark.createDataFrame([], LN)
    assert scan.scan_noise(e, x).count() == 0


def test_repaired_pages(spark):
    clean = [(1000 + i, page(1, *BODY) + page(2, *BODY[1:], BODY[0]), "") for i in range(15)]
    noisy = (1, page(1, "Pump Fitting Notes Rev A", BODY[0], "pump was started. The inter-", "mediate shaft and the spring-", "loaded covcr were cleaned.", "- first item", "- second item", "[12]") + page(2, "PUMP FITTING NOTES REV A", *BODY, "[13]"), "")
    lines = [(i, 5, "tesseract", 1, i, t, "") for i, t in enumerate(["The upper va1ve was checked by the", "crew before the inter-", "mediate shaft was turned.", "Page 1 of 2"])]
    rows = scan.repaired_pages(spark.createDataFrame([*clean, noisy, noisy, (2, None, ""), (3, " ", "")], EX), spark.createDataFrame([*lines, lines[0]], LN)).collect()
    got = {(r["record_kind"], r["record_id"], r["page"]): r["text"] for r in rows if r["record_id"] < 1000}
    assert len(got) == 3 and len(rows) == 33
    assert got["extraction", 1, 1] == BODY[0] + " pump was started. The intermediate shaft and the spring-loaded cover were cleaned.\n\n- first item\n\n- second item"
    assert got["ocr_page", 5, 1] == "The upper valve was checked by the crew before the intermediate shaft was turned."


def test_a_corpus_repeated_ten_times_gives_the_same_rows(spark):
    # 'r0se' is 1 of 36 sightings, 'value' a word of its own at 1 of 40, 'platc' and 'whcn' are wrong; seven more are too few to repair by.
    lines = ["the rose valve was clean"] * 35 + ["the r0se valve was clean", "the valve platc was clean whcn cold", "the value was clean"] + ["the valve was clean"] * 4 + ["the plate was clean when cold"] * 24
    wrong = {35: "misread", 36: "misread"}

    def rows(times):
        made = [(1000 * k + i, 1000 * k + i, "tesseract", 1, 0, t, "") for k in range(times) for i, t in enumerate(lines)]
        return {tuple(r) for r in scan.scan_noise(spark.createDataFrame([], EX), spark.createDataFrame(made, LN)).collect()}

    once, ten = rows(1), rows(10)
    assert once == {("ocr_line", i, n) for i, n in wrong.items()}
    assert ten == {("ocr_line", 1000 * k + i, n) for k in range(10) for _, i, n in once}


def test_words_beyond_the_commonest_count(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = " ".join("q" + "".join(letters[k // 26**i % 26] for i in range(4)) for k in range(200_010))
    texts = [(1, "The intermediate shaft was turned."), (2, "The inter-\nmediate shaft was turned."), (3, many), (4, many), (5, "inter mediate " * 50)]
    got = scan.scan_noise(spark.createDataFrame([(*t, "") for t in texts], EX), spark.createDataFrame([], LN)).collect()
    assert ("extraction", 2, "hyphen") in {tuple(r) for r in got}


def test_repeated_lines_at_both_edges(spark):
    bodies = [BODY, [*BODY[1:], "Each bolt was held."], ["Every hose was checked.", BODY[3], *BODY[:2]]]
    foot = "Property of Northgate Works; do not copy, pass on or keep after the date that is printed on the cover."
    ex = [(1, "".join(page(k, *b, foot) for k, b in enumerate(bodies, 1)))]
    lines = [(100 * k + i, 5, "tesseract", k, i, t) for k, b in enumerate(bodies, 1) for i, t in enumerate([f"{k}", "Pump | Notes.", *b, foot])]
    got = {g for g in noise(spark, ex, lines) if g[2] == "furniture"}
    assert got == {("extraction", 1, "furniture"), *(("ocr_line", 100 * k + i, "furniture") for k, b in enumerate(bodies, 1) for i in (0, 1, len(b) + 2))}


def test_edge_lines_that_one_edit_parts(spark):
    bodies = [BODY, [*BODY[1:], "Each bolt was held."], ["Every hose was checked.", BODY[3], *BODY[:2]]]
    feet = ["Acme Pump Handbook Confidential", "Acme Pup Handbook Confidential", "Acme Pump Handbook Confidentials"]
    ex = [(1, "".join(page(k, *b, f) for k, (b, f) in enumerate(zip(bodies, feet), 1))), (2, "".join(page(k, f, *b) for k, (b, f) in enumerate(zip(bodies, feet), 1)))]
    lines = [(100 * k + i, 5, "tesseract", k, i, t) for k, (b, f) in enumerate(zip(bodies, feet), 1) for i, t in enumerate([f"{k}", *b, f])]
    got = {g for g in noise(spark, ex, lines) if g[2] == "furniture"}
    assert got == {("extraction", 1, "furniture"), ("extraction", 2, "furniture"), *(("ocr_line", 100 * k + i, "furniture") for k, b in enumerate(bodies, 1) for i in (0, len(b) + 1))}


def test_one_edit():
    assert all(scan.one_edit(*x) for x in (("pump", "pup"), ("pup", "pump"), ("pump", "pumps"), ("pump", "bump"), ("a", "")))
    assert not any(scan.one_edit(*x) for x in (("pump", "pump"), ("pump", "pu"), ("pump", "upmp"), ("abcd", "abdc")))
