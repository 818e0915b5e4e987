"""Queries over page texts: native assessment, routing, tokens, transcripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import fuzzy
from pagewright.functions import text as T
from pagewright.operators import quality, transcript
from pagewright.plans import sql as S
from pagewright.plans import views
from pagewright.plans.registry import query

def _t():
    return F.col("text")


def _pages(spark, sf_dir, **columns):
    return views.pages(spark, sf_dir).select("doc_id", "page_no", *[c.alias(n) for n, c in columns.items()]).distinct()


def _assessed(spark, sf_dir):
    return quality.assess_pages(views.pages(spark, sf_dir)).distinct()


@query(f"WITH {S.A} SELECT doc_id, page_no, r1 AS empty_text FROM a")
def t1_empty_text(spark, sf_dir):
    return _pages(spark, sf_dir, empty_text=T.is_blank(_t()))


@query(f"WITH {S.A} SELECT doc_id, page_no, r2 AS replacement_character FROM a")
def t2_replacement_character(spark, sf_dir):
    return _pages(spark, sf_dir, replacement_character=_t().contains("�"))


@query(f"WITH {S.A} SELECT doc_id, page_no, r3 AS control_character FROM a")
def t3_control_character(spark, sf_dir):
    return _pages(spark, sf_dir, control_character=T.has_control(_t()))


@query(f"WITH {S.A} SELECT doc_id, page_no, characters, alnum, alpha, round(CASE WHEN alnum > 0 THEN alpha / alnum ELSE 0 END, 4) AS alpha_ratio FROM f")
def t4_alpha_ratio(spark, sf_dir):
    return _pages(spark, sf_dir, characters=F.length(_t()), alnum=T.alnum_count(_t()), alpha=T.alpha_count(_t()), alpha_ratio=F.round(T.alpha_ratio(_t()), 4))


@query(f"WITH {S.PG} SELECT doc_id, page_no, len(w) AS words, coalesce(w[1], '') AS first_word FROM (SELECT doc_id, page_no, regexp_extract_all(text, '{S.WORD}') AS w FROM pg)")
def t5_words(spark, sf_dir):
    return _pages(spark, sf_dir, words=F.size(T.words(_t())), first_word=F.coalesce(F.get(T.words(_t()), 0), F.lit("")))


@query(f"WITH {S.A} SELECT doc_id, page_no, CASE WHEN r4 THEN 'too_little_text' WHEN r5 THEN 'very_low_alphabetic_ratio' END AS reason FROM a")
def t6_too_little_or_low_alpha(spark, sf_dir):
    return _pages(spark, sf_dir, reason=F.when(T.too_little(_t()), "too_little_text").when(T.low_alpha(_t()), "very_low_alphabetic_ratio"))


@query(f"WITH {S.A} SELECT doc_id, page_no, odd_words, odd_chars, r6 AS suspicious FROM a")
def t7_suspicious_patterns(spark, sf_dir):
    return _pages(spark, sf_dir, odd_words=T.suspicious_words(_t()), odd_chars=T.odd_count(_t()), suspicious=T.is_suspicious(_t()))


@query(f"WITH {S.A} SELECT doc_id, page_no, array_to_string(reasons, ',') AS reasons, len(reasons) > 0 AS ocr_recommended FROM s")
def t8_reasons(spark, sf_dir):
    return _assessed(spark, sf_dir).select("doc_id", "page_no", F.array_join("reasons", ",").alias("reasons"), "ocr_recommended")


@query(f"""WITH {S.A} SELECT doc_id, count(*) AS pages, coalesce(array_to_string(list_sort(list(page_no) FILTER (len(reasons) > 0)), ','), '') AS flagged_pages, bool_or(len(reasons) > 0) AS ocr_recommended
    FROM s GROUP BY doc_id""")
def t10_document_assessment(spark, sf_dir):
    rows = quality.assess_documents(_assessed(spark, sf_dir))
    return rows.withColumn("flagged_pages", F.array_join("flagged_pages", ","))


_IMG = "im AS (SELECT DISTINCT doc_id, unnest(ocr_pages)::INT AS page_no FROM pdf_extractions)"


def _image_pages(spark, sf_dir):
    return views.extractions(spark, sf_dir).select("doc_id", F.explode("ocr_pages").alias("page_no"))


@query(f"""WITH {S.A}, {_IMG}, w AS (SELECT s.doc_id, s.page_no, CASE WHEN im.doc_id IS NOT NULL THEN 'image_resources' ELSE reasons[1] END AS why
    FROM s LEFT JOIN im ON im.doc_id = s.doc_id AND im.page_no = s.page_no)
    SELECT doc_id, CASE WHEN count(why) = 0 THEN 'native' ELSE 'ocr' END AS workload_type, coalesce(arg_min(why, coalesce(page_no, -1)) FILTER (why IS NOT NULL), 'confident_native_text') AS reason FROM w GROUP BY doc_id""")
def c1_classify_document(spark, sf_dir):
    return quality.classify(_assessed(spark, sf_dir), _image_pages(spark, sf_dir))


@query(f"WITH {S.A}, {_IMG} SELECT doc_id, page_no FROM s WHERE len(reasons) > 0 AND page_no IS NOT NULL UNION SELECT doc_id, page_no FROM im WHERE page_no IS NOT NULL")
def c4_pages_to_ocr(spark, sf_dir):
    flagged = _assessed(spark, sf_dir).where("ocr_recommended AND page_no IS NOT NULL").select("doc_id", "page_no")
    return flagged.unionByName(_image_pages(spark, sf_dir).where("page_no IS NOT NULL")).distinct()


@query(f"""WITH {S.A}, {_IMG} SELECT doc_id, CASE WHEN bool_or(o) THEN 'ocr' ELSE 'native' END AS method FROM (SELECT doc_id, len(reasons) > 0 AS o FROM s UNION ALL SELECT doc_id, true FROM im) GROUP BY doc_id""")
def c5_extraction_method(spark, sf_dir):
    flags = _assessed(spark, sf_dir).select("doc_id", F.col("ocr_recommended").alias("o"))
    both = flags.unionByName(_image_pages(spark, sf_dir).select("doc_id", F.lit(True).alias("o")))
    return both.groupBy("doc_id").agg(F.when(F.max("o"), "ocr").otherwise("native").alias("method"))


@query(f"WITH {S.A} SELECT doc_id, arg_min(reasons[1], page_no) FILTER (len(reasons) > 0) AS first_reason FROM s WHERE page_no IS NOT NULL GROUP BY doc_id")
def w5_first_reason(spark, sf_dir):
    rows = _assessed(spark, sf_dir).where("page_no IS NOT NULL")
    return rows.groupBy("doc_id").agg(F.min_by(F.get("reasons", 0), F.when(F.size("reasons") > 0, F.col("page_no"))).alias("first_reason"))


@query(f"WITH {S.A} SELECT reason, count(*) AS pages FROM (SELECT unnest(CASE WHEN len(reasons) > 0 THEN reasons ELSE ['none'] END) AS reason FROM s) GROUP BY reason")
def a8_reason_histogram(spark, sf_dir):
    rows = _assessed(spark, sf_dir)
    return rows.select(F.explode(F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(F.array(F.lit("none")))).alias("reason")).groupBy("reason").agg(F.count("*").alias("pages"))


@query(f"WITH {S.PG}, {_IMG} SELECT doc_id, page_no FROM pg WHERE page_no IS NOT NULL UNION SELECT doc_id, page_no FROM im WHERE page_no IS NOT NULL")
def o5_page_union(spark, sf_dir):
    return views.pages(spark, sf_dir).select("doc_id", "page_no").unionByName(_image_pages(spark, sf_dir)).where("page_no IS NOT NULL").distinct()


@query(f"WITH {S.PG} SELECT doc_id, page_no, length(text) AS characters, sha256(text) AS hash FROM own")
def w1_page_segmentation(spark, sf_dir):
    from pagewright.session import table

    rows = transcript.split_pages(table(spark, sf_dir, "pdf_extractions"))
    return rows.select("doc_id", "page_no", F.length("text").alias("characters"), F.sha2("text", 256).alias("hash")).distinct()


_TR = "tr AS (SELECT DISTINCT e.doc_id, 'DOCUMENT: ' || d.filename || E'\\n\\n' || e.text || E'\\n' AS text FROM pdf_extractions e JOIN tracked_documents d ON d.id = e.doc_id WHERE e.text IS NOT NULL AND d.filename IS NOT NULL)"


def _transcripts(spark, sf_dir):
    from pagewright.session import table

    names = table(spark, sf_dir, "tracked_documents").select(F.col("id").alias("doc_id"), "filename").where("filename IS NOT NULL").distinct()
    return views.extractions(spark, sf_dir).where("text IS NOT NULL").join(names, "doc_id").select("doc_id", transcript.transcript(F.col("filename"), _t()).alias("text"))


@query(f"WITH {_TR} SELECT doc_id, sha256(CASE WHEN instr(text, E'\\n\\n') > 0 THEN substr(text, instr(text, E'\\n\\n') + 2) ELSE text END) AS body_hash FROM tr")
def w2_body_split(spark, sf_dir):
    return _transcripts(spark, sf_dir).select("doc_id", F.sha2(transcript.body(_t()), 256).alias("body_hash"))


@query(f"""WITH {S.A}, m AS (SELECT doc_id, extraction_method FROM (SELECT DISTINCT doc_id, extraction_method FROM pdf_extractions) WHERE extraction_method = 'native'),
    d AS (SELECT s.doc_id, len(list(1) FILTER (len(reasons) > 0)) AS flagged FROM s JOIN m ON m.doc_id = s.doc_id GROUP BY s.doc_id)
    SELECT (SELECT count(*) FROM m) AS scanned, (SELECT count(*) FROM m WHERE doc_id NOT IN (SELECT doc_id FROM d)) AS missing_text, count(*) FILTER (flagged > 0) AS flagged_documents, coalesce(sum(flagged), 0)::BIGINT AS flagged_pages FROM d""")
def a9_native_audit(spark, sf_dir):
    native = views.extractions(spark, sf_dir).where("extraction_method = 'native'").select("doc_id", "text")
    flags = quality.assess_pages(transcript.split_pages(native)).groupBy("doc_id").agg(F.count_if("ocr_recommended").alias("flagged"))
    rows = native.join(flags, "doc_id", "left")
    return rows.agg(F.count("*").alias("scanned"), F.count_if(F.col("flagged").isNull()).alias("missing_text"), F.count_if(F.col("flagged") > 0).alias("flagged_documents"), F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged_pages"))


@query("""SELECT d.id AS doc_id, CASE WHEN e.text IS NULL THEN 'missing_text_output' ELSE 'present' END AS state FROM (SELECT DISTINCT id FROM tracked_documents WHERE status = 'COMPLETE') d
    LEFT JOIN (SELECT DISTINCT doc_id, text FROM pdf_extractions) e ON e.doc_id = d.id""")
def j5_missing_transcript(spark, sf_dir):
    from pagewright.session import table

    done = table(spark, sf_dir, "tracked_documents").where("status = 'COMPLETE'").select(F.col("id").alias("doc_id")).distinct()
    texts = views.extractions(spark, sf_dir).select("doc_id", "text")
    return done.join(texts, "doc_id", "left").select("doc_id", F.when(_t().isNull(), "missing_text_output").otherwise("present").alias("state"))


@query(rf"""WITH {S.LN}, b AS (SELECT line_id, text, {S.hull('polygon')} AS bx FROM ln WHERE text IS NOT NULL)
    SELECT line_id, CASE WHEN bx IS NULL THEN '[position unavailable]' ELSE printf('[x=%.3f..%.3f, y=%.3f..%.3f]', bx.l, bx.r, bx.t, bx.b) END || ' ' || text AS line FROM b""")
def l12_format_lines(spark, sf_dir):
    from pagewright.functions import geometry as G

    return views.lines(spark, sf_dir).where("text IS NOT NULL").select("line_id", F.concat(G.position_label(G.hull(F.col("polygon"))), F.lit(" "), _t()).alias("line"))


_POS = r"^\[x=([0-9.]+)\.\.([0-9.]+), y=([0-9.]+)\.\.([0-9.]+)\]"


@query(rf"""WITH {S.LN}, b AS (SELECT line_id, text, {S.hull('polygon')} AS bx FROM ln WHERE text IS NOT NULL)
    SELECT line_id, round(bx.l, 3) AS x0, round(bx.r, 3) AS x1, round(bx.t, 3) AS y0, round(bx.b, 3) AS y1 FROM b""")
def x13_position_prefix(spark, sf_dir):
    rows = l12_format_lines(spark, sf_dir)
    part = lambda k: F.expr(f"try_cast(nullif(regexp_extract(line, r'{T.POSITION}', {k}), '') AS double)")
    return rows.select("line_id", *[part(k + 1).alias(n) for k, n in enumerate(("x0", "x1", "y0", "y1"))])


@query(rf"""WITH {_TR} SELECT doc_id, array_to_string(list_filter(list_transform(string_split_regex(text, '\r\n|[\n\x0b\x0c\r\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: regexp_replace(x, '^{S.SPACES}+|{S.SPACES}+$', '', 'g')),
    lambda x: x <> '' AND NOT starts_with(x, 'DOCUMENT:') AND NOT regexp_matches(x, '^(?i)=== PAGE [0-9]+ ===$')), E'\n') AS body FROM tr""")
def x10_strip_annotations(spark, sf_dir):
    return _transcripts(spark, sf_dir).select("doc_id", T.strip_annotations(_t()).alias("body"))


@query(rf"""WITH {S.LN} SELECT line_id, nfc_normalize(replace(text, chr(160), ' ')) AS text FROM ln WHERE text IS NOT NULL""")
def x14_nfc(spark, sf_dir):
    return views.lines(spark, sf_dir).where("text IS NOT NULL").select("line_id", fuzzy.nfc("text").alias("text"))


@query()
def w3_clean_transcript(spark, sf_dir):
    rows = l12_format_lines(spark, sf_dir).join(views.lines(spark, sf_dir).select("line_id", "doc_id", "page_no", "idx"), "line_id")
    page = rows.groupBy("doc_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "line_id", "line"))), lambda s: s.line), "\n").alias("body"))
    text = F.concat(F.format_string("=== PAGE %d ===\n\n", "page_no"), F.lit(T.SECTIONS[0] + "\n"), F.col("body"))
    return transcript.clean(page.select(F.concat_ws("/", "doc_id", "page_no").alias("page"), text.alias("text")), "page")


@query(f"WITH {S.LN} SELECT line_id, array_to_string({S.TOKENS('text')}, ' ') AS tokens, len({S.TOKENS('text')}) AS n FROM ln WHERE text IS NOT NULL")
def x1_tokens(spark, sf_dir):
    return views.lines(spark, sf_dir).where("text IS NOT NULL").select("line_id", T.normalised(_t()).alias("tokens"), F.size(T.tokens(_t())).alias("n"))


@query(f"WITH {S.EN} SELECT line_id, engine, array_to_string({S.TOKENS('text')}, ' ') AS normalised FROM en")
def x2_normalised_text(spark, sf_dir):
    return views.engines(spark, sf_dir).select("line_id", "engine", T.normalised(_t()).alias("normalised"))


def _two(spark, sf_dir):
    e = views.engines(spark, sf_dir)
    a = e.where("engine = 'tesseract'").select("line_id", F.col("text").alias("a"))
    return a.join(e.where("engine = 'paddleocr'").select("line_id", F.col("text").alias("b")), "line_id")


_TWO = f"{S.EN}, tw AS (SELECT x.line_id, x.text AS a, y.text AS b FROM en x JOIN en y ON y.line_id = x.line_id AND y.engine = 'paddleocr' WHERE x.engine = 'tesseract')"
_SAME = lambda x: f"trim(regexp_replace({S.FOLD(x)}, '{S.SPACES}+', ' ', 'g'))"


@query(f"WITH {_TWO} SELECT line_id, {_SAME('a')} = {_SAME('b')} AS same FROM tw")
def x3_same_text(spark, sf_dir):
    return _two(spark, sf_dir).select("line_id", (T.collapsed(F.col("a")) == T.collapsed(F.col("b"))).alias("same"))


@query(f"""WITH {S.LN}, {S.PG}, k AS (SELECT line_id, doc_id, page_no, {S.TOKENS('text')} AS n FROM ln WHERE text IS NOT NULL), h AS (SELECT doc_id, page_no, {S.TOKENS('text')} AS h FROM own)
    SELECT line_id, len(n) > 0 AND contains(chr(31) || array_to_string(h, chr(31)) || chr(31), chr(31) || array_to_string(n, chr(31)) || chr(31)) AS covered FROM k JOIN h USING (doc_id, page_no)""")
def x5_token_subsequence(spark, sf_dir):
    pages = transcript.split_pages(views.extractions(spark, sf_dir)).select("doc_id", "page_no", T.tokens(_t()).alias("h"))
    rows = views.lines(spark, sf_dir).where("text IS NOT NULL").select("line_id", "doc_id", "page_no", T.tokens(_t()).alias("n")).join(pages, ["doc_id", "page_no"])
    return rows.select("line_id", T.contains_sequence(F.col("h"), F.col("n")).alias("covered"))


@query(f"""WITH {S.EN}, k AS (SELECT line_id, engine, regexp_extract_all(text, '{S.ANY_CASE_TOKEN}') AS w FROM en)
    SELECT line_id, engine, round(CASE WHEN len(w) = 0 THEN 1.0 ELSE (len(list_filter(w, lambda x: regexp_matches(x, '{S.SUSPICIOUS}'))) + 0.5 * len(list_filter(w, lambda x: regexp_matches(x, '^[A-Za-z]$')))) / len(w) END, 6) AS noise FROM k""")
def x8_noise_score(spark, sf_dir):
    return views.engines(spark, sf_dir).select("line_id", "engine", F.round(T.noise_score(_t()), 6).alias("noise"))


@query()
def x4_text_similarity(spark, sf_dir):
    return _two(spark, sf_dir).select("line_id", F.round(fuzzy.similarity(T.normalised(F.col("a")), T.normalised(F.col("b"))), 6).alias("similarity"))


@query()
def x7_token_coverage(spark, sf_dir):
    return _two(spark, sf_dir).select("line_id", F.round(fuzzy.token_coverage(T.tokens(F.col("a")), T.tokens(F.col("b"))), 6).alias("coverage"))


@query(f"""WITH {_TWO}, k AS (SELECT line_id, {S.TOKENS('a')} AS a, {S.TOKENS('b')} AS b FROM tw)
    SELECT line_id, round(CASE WHEN len(a) = 0 THEN 0.0 ELSE len(list_filter(a, lambda x: list_contains(b, x))) / len(a) END, 6) AS coverage FROM k""")
def x7_exact_coverage(spark, sf_dir):
    rows = _two(spark, sf_dir).select("line_id", T.tokens(F.col("a")).alias("a"), T.tokens(F.col("b")).alias("b"))
    n = F.size(F.filter("a", lambda x: F.array_contains("b", x)))
    return rows.select("line_id", F.round(F.when(F.size("a") > 0, n / F.size("a")).otherwise(0.0), 6).alias("coverage"))


@query()
def x6_similar_in_region(spark, sf_dir):
    pairs = _two(spark, sf_dir).select("line_id", T.tokens(F.col("b")).alias("needle"), T.tokens(F.col("a")).alias("region"))
    found = fuzzy.similar_in_region(pairs, "line_id", "needle", "region").withColumn("similar", F.lit(True))
    return pairs.select("line_id").join(found, "line_id", "left").select("line_id", F.coalesce("similar", F.lit(False)).alias("similar"))
