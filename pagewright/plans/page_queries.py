"""Queries over lines, boxes and pages: geometry, quality, matching and fusion."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagewright.functions import fuzzy
from pagewright.functions import geometry as G
from pagewright.functions import scoring as C
from pagewright.functions import text as T
from pagewright.operators import fusion, quality
from pagewright.plans import sql as S
from pagewright.plans import views
from pagewright.plans.registry import query

PAGE = ["doc_id", "page_no"]


def _boxes(spark, sf_dir):
    """Pairs of neighbouring boxed lines of a page."""
    rows = views.lines(spark, sf_dir).select("line_id", *PAGE, "idx", G.hull(F.col("polygon")).alias("box"))
    nxt = rows.select(*PAGE, (F.col("idx") - 1).alias("idx"), F.col("line_id").alias("other_id"), F.col("box").alias("other"))
    return rows.join(nxt, [*PAGE, "idx"]).where("box IS NOT NULL AND other IS NOT NULL")


_BX = f"""{S.LN}, hx AS (SELECT line_id, doc_id, page_no, idx, {S.hull('polygon')} AS u FROM ln), bx AS (SELECT x.line_id, y.line_id AS other_id, x.u AS p, y.u AS q FROM hx x JOIN hx y ON x.doc_id = y.doc_id AND x.page_no = y.page_no AND y.idx = x.idx + 1 WHERE x.u IS NOT NULL AND y.u IS NOT NULL)"""


@query(rf"""WITH {S.LN} SELECT line_id, regexp_replace(text, '^{S.SPACES}+|{S.SPACES}+$', '', 'g') AS text, confidence, avg(confidence) OVER (PARTITION BY doc_id, page_no) AS page_confidence
    FROM ln WHERE regexp_replace(text, '{S.SPACES}', '', 'g') <> ''""")
def l1_ocr_lines(spark, sf_dir):
    rows = views.lines(spark, sf_dir).where(~T.is_blank(F.col("text")))
    return rows.select("line_id", T.stripped(F.col("text")).alias("text"), "confidence", F.avg("confidence").over(Window.partitionBy(*PAGE)).alias("page_confidence"))


@query(rf"""WITH {S.LN}, w AS (SELECT line_id, list_transform(polygon, lambda p: {{'x': p.x * 640 - 3, 'y': p.y * 480}}) AS g, CASE WHEN line_id % 37 = 0 THEN 0 ELSE 600 END AS w FROM ln)
    SELECT line_id, list_aggregate(list_transform(g, lambda p: greatest(0.0, least(1.0, p.x / w))), 'max') AS max_x, list_aggregate(list_transform(g, lambda p: greatest(0.0, least(1.0, p.x / w))), 'min') AS min_x FROM w WHERE w > 0 AND len(g) >= 3""")
def l2_polygon_normalise(spark, sf_dir):
    k = F.col("line_id")
    raw = F.transform("polygon", lambda p: F.struct((p.x * 640 - 3).alias("x"), (p.y * 480).alias("y")))
    rows = views.lines(spark, sf_dir).select("line_id", G.normal_polygon(raw, F.when(k % 37 == 0, 0).otherwise(600), F.lit(480)).alias("g")).where("g IS NOT NULL")
    xs = F.transform("g", lambda p: p.x)
    return rows.select("line_id", F.array_max(xs).alias("max_x"), F.array_min(xs).alias("min_x"))


@query(rf"""WITH {S.RG}, u AS (SELECT region_id, greatest(0.0, least(1.0, bbox.l)) AS x, greatest(0.0, least(1.0, bbox.r)) AS y,
    greatest(0.0, least(1.0, CASE WHEN region_id % 2 = 0 THEN 1 - bbox.t ELSE bbox.t END)) AS z, greatest(0.0, least(1.0, CASE WHEN region_id % 2 = 0 THEN 1 - bbox.b ELSE bbox.b END)) AS w FROM rg WHERE bbox IS NOT NULL)
    SELECT region_id, round(least(x, y), 6) AS l, round(least(z, w), 6) AS t, round(greatest(x, y), 6) AS r, round(greatest(z, w), 6) AS b FROM u WHERE x <> y AND z <> w""")
def l3_bbox_normalise(spark, sf_dir):
    b = G.normal_box(F.col("bbox"), F.lit(1.0), F.lit(1.0), F.col("region_id") % 2 == 0)
    rows = views.regions(spark, sf_dir).select("region_id", b.alias("n")).where("n IS NOT NULL")
    return rows.select("region_id", *[F.round(F.col(f"n.{c}"), 6).alias(c) for c in "ltrb"])


@query(f"WITH {S.LN}, h AS (SELECT line_id, {S.hull('polygon')} AS u FROM ln) SELECT line_id, u.l AS l, u.t AS t, u.r AS r, u.b AS b FROM h WHERE u IS NOT NULL")
def l4_hull(spark, sf_dir):
    rows = views.lines(spark, sf_dir).select("line_id", G.hull(F.col("polygon")).alias("u")).where("u IS NOT NULL")
    return rows.select("line_id", "u.l", "u.t", "u.r", "u.b")


@query(f"WITH {_BX} SELECT line_id, other_id, round({S.shared('p', 'q')}, 6) AS area FROM bx")
def l5_intersection(spark, sf_dir):
    return _boxes(spark, sf_dir).select("line_id", "other_id", F.round(G.intersection(F.col("box"), F.col("other")), 6).alias("area"))


@query(f"WITH {_BX} SELECT line_id, other_id, round({S.shared('p', 'q')} / {S.area('p')}, 6) AS overlap FROM bx")
def l6_overlap_of_first(spark, sf_dir):
    return _boxes(spark, sf_dir).select("line_id", "other_id", F.round(G.overlap_of_first(F.col("box"), F.col("other")), 6).alias("overlap"))


@query(f"WITH {_BX} SELECT line_id, other_id, round({S.shared('p', 'q')} / least({S.area('p')}, {S.area('q')}), 6) AS overlap FROM bx")
def l7_overlap_of_smaller(spark, sf_dir):
    return _boxes(spark, sf_dir).select("line_id", "other_id", F.round(G.overlap_of_smaller(F.col("box"), F.col("other")), 6).alias("overlap"))


_ROW = lambda p, q: f"(greatest(0.0, least({p}.b, {q}.b) - greatest({p}.t, {q}.t)) / least({p}.b - {p}.t, {q}.b - {q}.t) >= 0.45)"
_GAP = lambda p, q: f"CASE WHEN {p}.r < {q}.l THEN {q}.l - {p}.r WHEN {q}.r < {p}.l THEN {p}.l - {q}.r ELSE 0 END"


@query(f"WITH {_BX} SELECT line_id, other_id, {_ROW('p', 'q')} AS same_row FROM bx")
def l8_same_row(spark, sf_dir):
    return _boxes(spark, sf_dir).select("line_id", "other_id", G.same_row(F.col("box"), F.col("other")).alias("same_row"))


@query(f"WITH {_BX} SELECT line_id, other_id, round({_GAP('p', 'q')}, 6) AS gap FROM bx")
def l9_horizontal_gap(spark, sf_dir):
    return _boxes(spark, sf_dir).select("line_id", "other_id", F.round(G.horizontal_gap(F.col("box"), F.col("other")), 6).alias("gap"))


@query(f"""WITH {S.EN}, h AS (SELECT line_id, engine, doc_id, page_no, idx, {S.hull('polygon')} AS u FROM en)
    SELECT line_id, engine, row_number() OVER (PARTITION BY doc_id, page_no, engine ORDER BY coalesce(u.t, 2.0), coalesce(u.l, 2.0), idx, line_id) AS place FROM h""")
def l10_reading_order(spark, sf_dir):
    rows = views.engines(spark, sf_dir).withColumn("box", G.hull(F.col("polygon")))
    w = Window.partitionBy(*PAGE, "engine").orderBy(*G.reading_key(F.col("box"), F.col("idx")), "line_id")
    return rows.select("line_id", "engine", F.row_number().over(w).cast("bigint").alias("place"))


@query(f"WITH {S.EN}, h AS (SELECT line_id, engine, {S.hull('polygon')} AS u FROM en) SELECT line_id, engine, round(u.l, 6) AS l, round(u.b, 6) AS b FROM h")
def l11_bbox_metadata(spark, sf_dir):
    rows = views.engines(spark, sf_dir).select("line_id", "engine", G.rounded(G.hull(F.col("polygon"))).alias("u"))
    return rows.select("line_id", "engine", F.get("u", 0).alias("l"), F.get("u", 3).alias("b"))


@query("""SELECT doc_id, count(*) AS pages, min(page_no) AS first_page, max(page_no) AS last_page, bool_and(page_count IS NOT NULL) AND max(page_count) = count(*) AND min(page_no) = 1 AND max(page_no) = count(*) AND count(DISTINCT page_no) = count(*) AS valid
    FROM own JOIN (SELECT DISTINCT doc_id, page_count FROM pdf_extractions) USING (doc_id) GROUP BY doc_id""".replace("SELECT doc_id, count(*) AS pages", f"WITH {S.PG} SELECT doc_id, count(*) AS pages", 1))
def s4_page_map_validation(spark, sf_dir):
    from pagewright.operators.transcript import split_pages

    e = views.extractions(spark, sf_dir)
    rows = split_pages(e).join(e.select("doc_id", "page_count"), "doc_id").groupBy("doc_id")
    n, lo, hi = F.count("*"), F.min("page_no"), F.max("page_no")
    good = (F.count("page_count") == n) & (F.max("page_count") == n) & (lo == 1) & (hi == n) & (F.count_distinct("page_no") == n)
    return rows.agg(n.alias("pages"), lo.alias("first_page"), hi.alias("last_page"), good.alias("valid"))


@query(rf"""WITH {S.RG} SELECT doc_id, page_no, count(*) AS regions, sha256(string_agg(regexp_replace(text, '^{S.SPACES}+|{S.SPACES}+$', '', 'g'), E'\n' ORDER BY idx, region_id)) AS hash
    FROM rg WHERE text IS NOT NULL AND regexp_replace(text, '{S.SPACES}', '', 'g') <> '' GROUP BY doc_id, page_no""")
def s5_native_page_text(spark, sf_dir):
    rows = views.regions(spark, sf_dir).where(F.col("text").isNotNull() & ~T.is_blank(F.col("text")))
    items = F.array_sort(F.collect_list(F.struct("idx", "region_id", T.stripped(F.col("text")).alias("text"))))
    return rows.groupBy(*PAGE).agg(F.count("*").alias("regions"), F.sha2(F.array_join(F.transform(items, lambda s: s.text), "\n"), 256).alias("hash"))


@query(f"""WITH {S.PG}, d AS (SELECT DISTINCT doc_id, ocr_pages FROM pdf_extractions)
    SELECT own.doc_id, own.page_no FROM own JOIN d USING (doc_id) WHERE own.page_no IS NOT NULL AND extraction_is_ocr AND (len(ocr_pages) = 0 OR list_contains(ocr_pages, own.page_no))""".replace("extraction_is_ocr", "ocr_pages IS NOT NULL"))
def s6_picture_pages(spark, sf_dir):
    from pagewright.operators.transcript import split_pages

    # Pictures that name no page stand for all pages of their document.
    e = views.extractions(spark, sf_dir)
    rows = split_pages(e).where("page_no IS NOT NULL").join(e.where("ocr_pages IS NOT NULL").select("doc_id", "ocr_pages"), "doc_id")
    return rows.where((F.size("ocr_pages") == 0) | F.array_contains("ocr_pages", F.col("page_no"))).select("doc_id", "page_no")


@query(rf"""WITH {S.LN}, w AS (SELECT line_id, doc_id, page_no, confidence, k, string_split_regex(text, '[ ]+')[k] AS word FROM (SELECT *, unnest(range(1, len(string_split_regex(text, '[ ]+')) + 1)) AS k FROM ln WHERE text IS NOT NULL))
    SELECT line_id, string_agg(word, ' ' ORDER BY k) AS text, round(avg(((line_id + k) % 100) / 100.0), 6) AS confidence FROM w WHERE word <> '' AND (line_id + k) % 17 <> 0 GROUP BY line_id""")
def s8_word_to_line(spark, sf_dir):
    rows = views.lines(spark, sf_dir).where("text IS NOT NULL").select("line_id", F.posexplode(F.split("text", "[ ]+")).alias("k", "word"))
    rows = rows.withColumn("k", F.col("k") + 1).where("word <> '' AND (line_id + k) % 17 <> 0")
    words = F.array_sort(F.collect_list(F.struct("k", "word")))
    return rows.groupBy("line_id").agg(F.array_join(F.transform(words, lambda s: s.word), " ").alias("text"), F.round(F.avg((F.col("line_id") + F.col("k")) % 100 / 100.0), 6).alias("confidence"))


@query(f"WITH {S.EN} SELECT doc_id, engine, page_no, round(avg(confidence), 6) AS confidence, count(confidence) AS known FROM en GROUP BY ALL")
def a4_mean_confidence(spark, sf_dir):
    return views.engines(spark, sf_dir).groupBy("doc_id", "engine", "page_no").agg(F.round(F.avg("confidence"), 6).alias("confidence"), F.count("confidence").alias("known"))


_FL = f"""fl AS (SELECT *, list_filter(regexp_extract_all(text, '{S.REVIEW_TOKEN}'), lambda w: regexp_matches(w, '{S.SUSPICIOUS}')) AS odd FROM en)"""


@query(f"""WITH {S.EN}, {_FL} SELECT line_id, engine, array_to_string(odd, ' ') AS tokens, CASE WHEN len(odd) > 0 AND confidence < 0.8 THEN 'suspicious_character_pattern,low_ocr_confidence' WHEN len(odd) > 0 THEN 'suspicious_character_pattern' ELSE 'low_ocr_confidence' END AS reasons
    FROM fl WHERE len(odd) > 0 OR confidence < 0.8""")
def a5_review_flags(spark, sf_dir):
    e = views.engines(spark, sf_dir)
    rows = quality.review_flags(e).join(e.select("line_id", "doc_id", "engine", "page_no", "idx"), ["doc_id", "engine", "page_no", "idx"])
    return rows.select("line_id", "engine", F.array_join("suspicious_tokens", " ").alias("tokens"), F.array_join("reasons", ",").alias("reasons"))


_EXACT = f"""{S.LR}, mt AS (SELECT line_id, doc_id, engine, page_no, {S.hull('polygon', False)} AS u, {S.TOKENS('text')} AS w FROM en), rt AS (SELECT doc_id, page_no, box AS v, {S.TOKENS('text')} AS x FROM lr),
    cv AS (SELECT line_id, m.doc_id, engine, m.page_no, max(len(list_filter(w, lambda k: list_contains(x, k))) / len(w)) AS c FROM mt m JOIN rt r ON m.doc_id = r.doc_id AND m.page_no = r.page_no
        WHERE u IS NOT NULL AND len(w) > 0 AND len(x) > 0 AND {S.area('u')} > 0 AND {S.shared('u', 'v')} / {S.area('u')} >= 0.35 GROUP BY ALL),
    ag AS (SELECT doc_id, engine, page_no, avg(c) AS agreement, count(*) AS compared FROM cv GROUP BY ALL)"""
_EN_EXACT = f"{S.EN}, {_EXACT}"


def exact_coverage(a, b):
    return F.size(F.filter(a, lambda x: F.array_contains(b, x))) / F.size(a)


@query(f"WITH {_EN_EXACT} SELECT doc_id, engine, page_no, round(agreement, 6) AS agreement, compared FROM ag")
def j4_exact_agreement(spark, sf_dir):
    rows = quality.agreement(views.engines(spark, sf_dir), views.line_regions(spark, sf_dir), exact_coverage)
    return rows.withColumn("agreement", F.round("agreement", 6))


@query()
def j4_native_agreement(spark, sf_dir):
    rows = quality.agreement(views.engines(spark, sf_dir), views.line_regions(spark, sf_dir), fuzzy.token_coverage)
    return rows.withColumn("agreement", F.round("agreement", 6))


_PQ = f"""{_EN_EXACT}, {_FL}, lq AS (SELECT doc_id, engine, page_no, count(*) AS lines, avg(confidence) AS conf, count(*) FILTER (len(odd) > 0) AS odd FROM fl GROUP BY ALL),
    pq AS (SELECT lq.*, agreement, greatest(0.0, least(100.0, (coalesce(conf * 100, 0) * 0.45 + coalesce(agreement * 100, 0) * 0.35 + (1 - odd / lines) * 100 * 0.2)
        / (CASE WHEN conf IS NOT NULL THEN 0.45 ELSE 0 END + CASE WHEN agreement IS NOT NULL THEN 0.35 ELSE 0 END + 0.2))) AS score FROM lq LEFT JOIN ag USING (doc_id, engine, page_no))"""
_BAND = lambda x: f"CASE WHEN {x} IS NULL THEN 'unrated' WHEN {x} >= 90 THEN 'high' WHEN {x} >= 75 THEN 'review' ELSE 'low' END"


def _quality(spark, sf_dir):
    e = views.engines(spark, sf_dir)
    return quality.page_quality(e, quality.agreement(e, views.line_regions(spark, sf_dir), exact_coverage))


@query(f"WITH {_PQ} SELECT doc_id, engine, page_no, lines, odd AS suspicious, round(score, 4) AS score, score < 85 AS review FROM pq")
def a1_page_quality(spark, sf_dir):
    return _quality(spark, sf_dir).select("doc_id", "engine", "page_no", "lines", "suspicious", F.round("score", 4).alias("score"), (F.col("score") < C.REVIEW).alias("review"))


_DQ = f"{_PQ}, dq AS (SELECT doc_id, engine, count(*) AS pages, avg(score) AS mean, min(score) AS least, 0.75 * avg(score) + 0.25 * min(score) AS score FROM pq GROUP BY ALL)"


@query(f"WITH {_DQ} SELECT doc_id, engine, pages AS scored_pages, round(mean, 4) AS mean_score, round(least, 4) AS weakest_score, round(score, 4) AS score FROM dq")
def a2_document_quality(spark, sf_dir):
    rows = quality.document_quality(_quality(spark, sf_dir))
    return rows.select("doc_id", "engine", "scored_pages", *[F.round(c, 4).alias(c) for c in ("mean_score", "weakest_score", "score")])


@query(f"WITH {_DQ} SELECT doc_id, engine, {_BAND('round(score, 6)')} AS band, round(score, 6) < 85 AS review FROM dq")
def a3_quality_band(spark, sf_dir):
    score = F.round("score", 6)
    return quality.document_quality(_quality(spark, sf_dir)).select("doc_id", "engine", C.band(score).alias("band"), (score < C.REVIEW).alias("review"))


@query(f"WITH {_DQ} SELECT doc_id, engine, row_number() OVER (PARTITION BY engine ORDER BY round(score, 4), doc_id) AS rank FROM dq")
def w7_quality_ranking(spark, sf_dir):
    w = Window.partitionBy("engine").orderBy(F.round("score", 4), "doc_id")
    return quality.document_quality(_quality(spark, sf_dir)).select("doc_id", "engine", F.row_number().over(w).cast("bigint").alias("rank"))


_SD = f"""sd AS (SELECT line_id, engine, doc_id, page_no, text, {S.hull('polygon')} AS u, row_number() OVER (PARTITION BY engine, doc_id, page_no ORDER BY idx, line_id) - 1 AS k FROM en)"""


@query(f"""WITH {S.EN}, {_SD} SELECT a.line_id AS aid, b.line_id AS bid, round({S.shared('a.u', 'b.u')} / least({S.area('a.u')}, {S.area('b.u')}), 4) AS overlap FROM sd a JOIN sd b ON a.doc_id = b.doc_id AND a.page_no = b.page_no AND b.engine = 'paddleocr'
    WHERE a.engine = 'tesseract' AND a.u IS NOT NULL AND b.u IS NOT NULL AND {_ROW('a.u', 'b.u')} AND ({S.shared('a.u', 'b.u')} / least({S.area('a.u')}, {S.area('b.u')}) >= 0.15 OR {_GAP('a.u', 'b.u')} <= 0.04)""")
def j1_geometry_candidates(spark, sf_dir):
    e = views.engines(spark, sf_dir)
    rows = fusion.geometry_candidates(fusion.side(e, "tesseract", "a"), fusion.side(e, "paddleocr", "b"))
    return rows.select("aid", "bid", F.round("overlap", 4).alias("overlap"))


def _sides(spark, sf_dir):
    e = views.engines(spark, sf_dir)
    return fusion.side(e, "tesseract", "a"), fusion.side(e, "paddleocr", "b")


@query()
def j1_match_lines(spark, sf_dir):
    return fusion.match(fusion.candidates(*_sides(spark, sf_dir)))


@query()
def o4_candidate_sort(spark, sf_dir):
    w = Window.partitionBy(*PAGE).orderBy(F.desc("weight"), F.desc("ak"), F.desc("bk"))
    return fusion.candidates(*_sides(spark, sf_dir)).select(*PAGE, "ak", "bk", F.round("weight", 6).alias("weight"), F.row_number().over(w).alias("place"))


@query()
def o6_unmatched(spark, sf_dir):
    a, b = _sides(spark, sf_dir)
    pairs = fusion.match(fusion.candidates(a, b))
    lone = [r.join(pairs, [*PAGE, f"{p}k"], "left_anti").select(*PAGE, F.col(f"{p}id").alias("line_id"), F.lit(e).alias("engine")) for p, e, r in (("a", "tesseract", a), ("b", "paddleocr", b))]
    return lone[0].unionByName(lone[1])


_CM = f"lower(regexp_replace(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g'), '[ßẞ]', 'ss', 'g'))"
_WD = f"list_transform(regexp_extract_all(text, '{S.WORD}'), lambda x: {S.FOLD('x')})"


@query(rf"""WITH {S.LN}, {S.PG}, q AS (SELECT line_id, doc_id, page_no, {_WD} AS w, {_CM} AS c FROM ln WHERE text IS NOT NULL AND {S.hull('polygon')} IS NULL), h AS (SELECT doc_id, page_no, {_WD} AS h, {_CM} AS hc FROM own)
    SELECT q.line_id, coalesce((length(c) >= 8 AND contains(hc, c)) OR (len(w) > 0 AND contains(chr(31) || array_to_string(h, chr(31)) || chr(31), chr(31) || array_to_string(w, chr(31)) || chr(31))), false) AS covered
    FROM q LEFT JOIN h USING (doc_id, page_no) WHERE c <> ''""")
def j2_uncovered_boxless(spark, sf_dir):
    rows = views.lines(spark, sf_dir).where("text IS NOT NULL").where(G.hull(F.col("polygon")).isNull()).withColumn("polygon", F.lit(None).cast("array<struct<x:double,y:double>>"))
    from pagewright.operators.transcript import split_pages

    left = fusion.uncovered(rows, views.line_regions(spark, sf_dir), split_pages(views.extractions(spark, sf_dir))).withColumn("open", F.lit(True))
    asked = rows.where(F.regexp_replace("text", r"[^\p{L}\p{N}]", "") != "").select("line_id")
    return asked.join(left, "line_id", "left").select("line_id", F.col("open").isNull().alias("covered"))


@query()
def j2_uncovered_lines(spark, sf_dir):
    from pagewright.operators.transcript import split_pages

    rows = views.engines(spark, sf_dir).where("engine = 'paddleocr'")
    return fusion.uncovered(rows, views.line_regions(spark, sf_dir), split_pages(views.extractions(spark, sf_dir)))


@query()
def j3_native_support(spark, sf_dir):
    return fusion.native_support(views.engines(spark, sf_dir), views.line_regions(spark, sf_dir)).withColumn("support", F.round("support", 6))


def _scores(spark, sf_dir):
    """Rounded page scores of the two engines side by side."""
    rows = _quality(spark, sf_dir).withColumn("score", F.round(F.round("score", 6), 1))
    return rows.groupBy(*PAGE).agg(F.max(F.when(F.col("engine") == "tesseract", F.col("score"))).alias("first"), F.max(F.when(F.col("engine") == "paddleocr", F.col("score"))).alias("second"))


_SC = f"""{_PQ}, sc AS (SELECT doc_id, page_no, max(round(round(score, 6), 1)) FILTER (engine = 'tesseract') AS first, max(round(round(score, 6), 1)) FILTER (engine = 'paddleocr') AS second FROM pq GROUP BY ALL)"""


@query(f"""WITH {_SC} SELECT doc_id, page_no, CASE WHEN second >= 85 AND (first IS NULL OR second - first >= 8) THEN 'paddleocr' WHEN first >= 85 AND (second IS NULL OR first - second >= 8) THEN 'tesseract' END AS preferred FROM sc""")
def f1_page_preference(spark, sf_dir):
    return _scores(spark, sf_dir).select(*PAGE, C.preferred_engine(F.col("first"), F.col("second")).alias("preferred"))


@query(f"WITH {_SC} SELECT doc_id, page_no, first IS NULL OR first <= 90 AS second_engine FROM sc")
def f4_threshold_gate(spark, sf_dir):
    return _scores(spark, sf_dir).select(*PAGE, (F.col("first").isNull() | (F.col("first") <= 90)).alias("second_engine"))


_NS = lambda x: f"(CASE WHEN len(regexp_extract_all({x}, '{S.ANY_CASE_TOKEN}')) = 0 THEN 1.0 ELSE (len(list_filter(regexp_extract_all({x}, '{S.ANY_CASE_TOKEN}'), lambda z: regexp_matches(z, '{S.SUSPICIOUS}'))) + 0.5 * len(list_filter(regexp_extract_all({x}, '{S.ANY_CASE_TOKEN}'), lambda z: regexp_matches(z, '^[A-Za-z]$')))) / len(regexp_extract_all({x}, '{S.ANY_CASE_TOKEN}')) END)"
_SAME = f"trim(regexp_replace({S.FOLD('a')}, '{S.SPACES}+', ' ', 'g')) = trim(regexp_replace({S.FOLD('b')}, '{S.SPACES}+', ' ', 'g'))"


@query(f"""WITH {S.EN}, tw AS (SELECT x.line_id, x.text AS a, y.text AS b, CASE WHEN x.line_id % 3 <> 0 THEN (x.line_id % 11) / 10.0 END AS p, (x.line_id % 7) / 7.0 AS q FROM en x JOIN en y ON y.line_id = x.line_id AND y.engine = 'paddleocr' WHERE x.engine = 'tesseract')
    SELECT line_id, CASE WHEN p - q >= 0.12 THEN 'tesseract' WHEN q - p >= 0.12 THEN 'paddleocr' WHEN {_NS('a')} + 0.15 < {_NS('b')} THEN 'tesseract' WHEN {_NS('b')} + 0.15 < {_NS('a')} THEN 'paddleocr' WHEN {_SAME} THEN 'tesseract' ELSE 'paddleocr' END AS winner,
    CASE WHEN abs(p - q) >= 0.12 THEN 'stronger_native_text_support' WHEN abs({_NS('a')} - {_NS('b')}) > 0.15 THEN 'fewer_suspicious_tokens' WHEN {_SAME} THEN 'engine_agreement' ELSE 'ambiguous_conflict_defaulted_to_fallback_engine' END AS reason FROM tw""")
def f2_choose_line(spark, sf_dir):
    e, k = views.engines(spark, sf_dir), F.col("line_id")
    a = e.where("engine = 'tesseract'").select("line_id", F.col("text").alias("atext"), F.when(k % 3 != 0, k % 11 / 10.0).alias("asupport"), (k % 7 / 7.0).alias("bsupport"))
    return fusion.choose(a.join(e.where("engine = 'paddleocr'").select("line_id", F.col("text").alias("btext")), "line_id")).select("line_id", "winner", "reason")


def _fused(spark, sf_dir):
    return fusion.fuse(views.engines(spark, sf_dir), views.line_regions(spark, sf_dir), _scores(spark, sf_dir))


@query()
def f3_fuse_lines(spark, sf_dir):
    return _fused(spark, sf_dir)


@query()
def a6_fusion_counts(spark, sf_dir):
    return fusion.fusion_counts(_fused(spark, sf_dir))


@query()
def o2_reading_sort(spark, sf_dir):
    rows = _fused(spark, sf_dir)
    return rows.groupBy(*PAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line_id"))), lambda s: s.line_id.cast("string")), ",").alias("order"))


_HEADERS = [S.literal(x + "\n") for x in T.SECTIONS]


@query(rf"""WITH {S.A}, {S.LN}, sp AS (SELECT DISTINCT doc_id, page_no, text, len(reasons) > 0 AS flagged, {_WD} AS h, {_CM} AS hc FROM s WHERE page_no IS NOT NULL), q AS (SELECT line_id, doc_id, page_no, idx, '[position unavailable] ' || text AS line, {_WD} AS w, {_CM} AS c FROM ln WHERE text IS NOT NULL),
    v AS (SELECT q.*, c <> '' AND NOT coalesce((length(c) >= 8 AND contains(hc, c)) OR (len(w) > 0 AND contains(chr(31) || array_to_string(h, chr(31)) || chr(31), chr(31) || array_to_string(w, chr(31)) || chr(31))), false) AS open FROM q LEFT JOIN sp USING (doc_id, page_no)),
    o AS (SELECT doc_id, page_no, string_agg(line, E'\n' ORDER BY idx, line_id) AS lines, string_agg(line, E'\n' ORDER BY idx, line_id) FILTER (open) AS more FROM v GROUP BY ALL)
    SELECT doc_id, page_no, sha256(CASE WHEN lines IS NULL THEN text WHEN flagged THEN {_HEADERS[0]} || lines WHEN more IS NOT NULL THEN text || E'\n\n' || {_HEADERS[1]} || more ELSE text END) AS hash FROM sp LEFT JOIN o USING (doc_id, page_no)""")
def f5_assemble_page(spark, sf_dir):
    """Pages with the lines of one engine whose boxes aren't known, so that SQL can say what they cover."""
    bare = views.lines(spark, sf_dir).withColumn("polygon", F.lit(None).cast("array<struct<x:double,y:double>>"))
    pages = views.pages(spark, sf_dir).where("page_no IS NOT NULL")
    return fusion.assemble(pages, bare, views.line_regions(spark, sf_dir)).select(*PAGE, F.sha2("text", 256).alias("hash"))


@query()
def f5_assemble_boxed(spark, sf_dir):
    return fusion.assemble(views.pages(spark, sf_dir).where("page_no IS NOT NULL"), views.lines(spark, sf_dir), views.line_regions(spark, sf_dir)).select(*PAGE, F.sha2("text", 256).alias("hash"))
