"""Queries over the tracking tables: registration, states, caches, reports, attachments."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagewright.functions import fuzzy
from pagewright.functions import text as T
from pagewright.operators import attachments, incremental, quality, tracking, transcript
from pagewright.plans import sql as S
from pagewright.plans import views
from pagewright.plans.registry import query
from pagewright.session import table

_H = "nullif(lower(trim(file_hash, E' \\t\\n\\r')), '')"
TK = f"tk AS (SELECT DISTINCT id, filename, file_path, {_H} AS file_hash, page_count, extraction_method, status, completed_at FROM tracked_documents)"


def _docs(spark, sf_dir):
    return tracking.documents(table(spark, sf_dir, "tracked_documents"))


@query("SELECT doc_id, sha256(text) AS hash FROM (SELECT DISTINCT doc_id, text FROM pdf_extractions) WHERE text IS NOT NULL")
def s2_content_hash(spark, sf_dir):
    return table(spark, sf_dir, "pdf_extractions").where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("hash")).distinct()


@query(f"""WITH {TK}, f AS (SELECT DISTINCT file_path, {_H} AS file_hash FROM file_arrivals WHERE file_path IS NOT NULL), d AS (SELECT DISTINCT file_path, file_hash FROM tk WHERE status = 'COMPLETE' AND completed_at IS NOT NULL)
    SELECT f.file_path, f.file_hash, f.file_hash IS NULL AS unreadable FROM f WHERE f.file_hash IS NULL OR NOT EXISTS (SELECT 1 FROM d WHERE d.file_path = f.file_path AND d.file_hash = f.file_hash)""")
def s3_inventory_pending(spark, sf_dir):
    files = table(spark, sf_dir, "file_arrivals").where("file_path IS NOT NULL").select("file_path", incremental.normal_hash("file_hash").alias("file_hash")).distinct()
    done = _docs(spark, sf_dir).where("status = 'COMPLETE' AND completed_at IS NOT NULL").select("file_path", "file_hash").distinct()
    return files.join(done, ["file_path", "file_hash"], "left_anti").withColumn("unreadable", F.col("file_hash").isNull())


@query(f"""WITH {TK}, n AS (SELECT DISTINCT file_path, {_H} AS file_hash FROM file_arrivals WHERE file_path IS NOT NULL AND {_H} IS NOT NULL)
    SELECT file_path, file_hash, (SELECT max(id) FROM tk) + row_number() OVER (ORDER BY file_path, file_hash) AS id FROM n WHERE NOT EXISTS (SELECT 1 FROM tk WHERE tk.file_path = n.file_path AND tk.file_hash = n.file_hash)""")
def d1_register(spark, sf_dir):
    return tracking.register(_docs(spark, sf_dir), table(spark, sf_dir, "file_arrivals"))


_CC = f"cc AS (SELECT DISTINCT file_hash, CASE WHEN id % 5 = 0 THEN '0' ELSE '1' END AS classifier_version, extraction_method AS workload_type, 'observed' AS reason, id AS seq FROM tk WHERE status = 'COMPLETE' AND extraction_method IS NOT NULL AND file_hash IS NOT NULL)"
_CL = f"{TK}, {_CC}, ca AS (SELECT * FROM cc QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY seq DESC) = 1)"


def _cache_rows(spark, sf_dir):
    rows = _docs(spark, sf_dir).where("status = 'COMPLETE' AND extraction_method IS NOT NULL AND file_hash IS NOT NULL")
    return rows.select("file_hash", F.when(F.col("id") % 5 == 0, "0").otherwise("1").alias("classifier_version"), F.col("extraction_method").alias("workload_type"), F.lit("observed").alias("reason"), F.col("id").alias("seq"))


def _cache(spark, sf_dir):
    rows = _cache_rows(spark, sf_dir)
    return tracking.upsert_classification(rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1"))


@query(f"WITH {_CL} SELECT file_hash, classifier_version, workload_type, seq FROM ca")
def d3_upsert_classification(spark, sf_dir):
    return _cache(spark, sf_dir).select("file_hash", "classifier_version", "workload_type", "seq")


@query(f"WITH {_CL} SELECT t.id, ca.workload_type FROM tk t LEFT JOIN ca ON ca.file_hash = t.file_hash AND ca.classifier_version = '1'")
def d2_lookup_classification(spark, sf_dir):
    return tracking.lookup_classification(_docs(spark, sf_dir).select("id", "file_hash"), _cache(spark, sf_dir), tracking.CLASSIFIER_VERSION).select("id", "workload_type")


_UP = "CASE id % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'PROCESSING' WHEN 2 THEN 'FAILED' ELSE 'COMPLETE' END"


def _updates(spark, sf_dir):
    """An update for each document, and as many for ids that don't exist."""
    ids = _docs(spark, sf_dir).select("id")
    return ids.unionByName(ids.select((-F.col("id")).alias("id")))


@query(f"""WITH {TK}, u AS (SELECT id FROM tk UNION ALL SELECT -id FROM tk), n AS (SELECT u.id, tk.status AS old, CASE abs(u.id) % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'PROCESSING' WHEN 2 THEN 'FAILED' ELSE 'COMPLETE' END AS new FROM u LEFT JOIN tk USING (id))
    SELECT id, CASE WHEN old IS NULL OR new = 'COMPLETE' THEN old ELSE new END AS status, CASE WHEN old IS NULL THEN 'unknown_document' WHEN new = 'COMPLETE' THEN 'complete_needs_results' END AS rejected FROM n""")
def d4_set_status(spark, sf_dir):
    state = F.element_at(F.array(*[F.lit(s) for s in ("PENDING", "PROCESSING", "FAILED", "COMPLETE")]), (F.abs("id") % 4 + 1).cast("int"))
    return tracking.set_status(_docs(spark, sf_dir), _updates(spark, sf_dir).withColumn("new_status", state))


@query(f"""WITH {TK}, u AS (SELECT id FROM tk UNION ALL SELECT -id FROM tk), n AS (SELECT u.id, tk.id AS known, tk.page_count AS old, (abs(u.id) % 9 - 1)::INT AS new FROM u LEFT JOIN tk USING (id))
    SELECT id, CASE WHEN known IS NULL OR new < 0 THEN old ELSE new END AS page_count, CASE WHEN known IS NULL THEN 'unknown_document' WHEN new < 0 THEN 'negative_page_count' END AS rejected FROM n""")
def d5_page_count(spark, sf_dir):
    return tracking.set_page_count(_docs(spark, sf_dir), _updates(spark, sf_dir).withColumn("new_count", (F.abs("id") % 9 - 1).cast("int")))


@query(f"""WITH {TK}, n AS (SELECT id, status, page_count, extraction_method, (id % 9 - 1)::INT AS c, CASE WHEN id % 2 = 0 THEN 'native' ELSE 'ocr' END AS m FROM tk)
    SELECT id, CASE WHEN status = 'PROCESSING' AND c >= 0 THEN 'COMPLETE' ELSE status END AS status, CASE WHEN status = 'PROCESSING' AND c >= 0 THEN c ELSE page_count END AS page_count,
    CASE WHEN status = 'PROCESSING' AND c >= 0 THEN m ELSE extraction_method END AS extraction_method, CASE WHEN status <> 'PROCESSING' THEN 'not_processing' WHEN c < 0 THEN 'negative_page_count' END AS rejected FROM n""")
def d6_complete(spark, sf_dir):
    k = F.col("id")
    new = _docs(spark, sf_dir).select("id", (k % 9 - 1).cast("int").alias("new_count"), F.when(k % 2 == 0, "native").otherwise("ocr").alias("new_method"))
    return tracking.complete(_docs(spark, sf_dir), new)


@query(rf"""WITH {TK}, e AS (SELECT DISTINCT id, document_id, regexp_replace(error, '^{S.SPACES}+|{S.SPACES}+$', '', 'g') AS error FROM errors)
    SELECT id, document_id, error FROM e WHERE error <> '' AND document_id IN (SELECT id FROM tk)""")
def d7_record_error(spark, sf_dir):
    return tracking.accepted_errors(table(spark, sf_dir, "errors"), _docs(spark, sf_dir))


@query(f"WITH {TK}, f AS (SELECT DISTINCT {_H} AS file_hash FROM file_arrivals) SELECT file_hash FROM f WHERE file_hash IN (SELECT file_hash FROM tk WHERE status = 'COMPLETE')")
def d8_has_completed_hash(spark, sf_dir):
    files = table(spark, sf_dir, "file_arrivals").select(incremental.normal_hash("file_hash").alias("file_hash")).distinct()
    return tracking.with_completed_hash(files, _docs(spark, sf_dir))


@query(f"WITH {TK} SELECT id, CASE WHEN status = 'PROCESSING' THEN 'PENDING' ELSE status END AS status, coalesce(status = 'PROCESSING', false) AS was_reset FROM tk")
def d9_reset_interrupted(spark, sf_dir):
    return tracking.reset_interrupted(_docs(spark, sf_dir))


@query(f"WITH {TK} SELECT file_hash, id FROM tk WHERE status = 'COMPLETE' AND file_hash IS NOT NULL QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY completed_at DESC NULLS LAST, id DESC) = 1")
def d10_latest_completed(spark, sf_dir):
    return tracking.latest_completed(_docs(spark, sf_dir))


_FF = f"ff AS (SELECT DISTINCT file_path, {_H} AS file_hash FROM file_arrivals WHERE file_path IS NOT NULL AND {_H} IS NOT NULL)"


@query(f"""WITH {TK}, {_FF}, t AS (SELECT file_path, file_hash, max(id) AS id, bool_or(status = 'COMPLETE') AS done FROM tk GROUP BY ALL)
    SELECT ff.file_path, ff.file_hash, t.id, CASE WHEN done THEN 'kept_complete' WHEN t.id IS NULL THEN 'registered_failed' ELSE 'failed' END AS outcome FROM ff LEFT JOIN t ON t.file_path = ff.file_path AND t.file_hash = ff.file_hash""")
def d11_worker_failure(spark, sf_dir):
    files = table(spark, sf_dir, "file_arrivals").select("file_path", incremental.normal_hash("file_hash").alias("file_hash")).dropna().distinct()
    return tracking.worker_failures(_docs(spark, sf_dir), files)


@query(rf"""WITH {TK}, e AS (SELECT document_id, count(*) AS n, max(lower(regexp_replace(error, '^{S.SPACES}+|{S.SPACES}+$', '', 'g'))) AS last FROM (SELECT DISTINCT * FROM errors) GROUP BY ALL)
    SELECT tk.id, 'FAILED' AS status, n::BIGINT AS errors, last AS last_error FROM tk JOIN e ON e.document_id = tk.id WHERE status <> 'COMPLETE'""")
def d12_fail_document(spark, sf_dir):
    told = table(spark, sf_dir, "errors").dropDuplicates(["id"]).groupBy(F.col("document_id").alias("id")).agg(F.count("*").alias("errors"), F.max(F.lower(T.stripped(F.col("error")))).alias("last_error"))
    return _docs(spark, sf_dir).where("status <> 'COMPLETE'").join(told, "id").select("id", F.lit("FAILED").alias("status"), "errors", "last_error")


@query(f"""WITH {_CL}, p AS (SELECT DISTINCT file_hash FROM tk WHERE status <> 'COMPLETE' AND file_hash IS NOT NULL), v AS (SELECT * FROM ca WHERE classifier_version = '1')
    SELECT p.file_hash, coalesce(v.workload_type, CASE WHEN substr(p.file_hash, 1, 1) < '8' THEN 'native' ELSE 'ocr' END) AS workload_type, coalesce(v.reason, 'computed') AS reason, v.file_hash IS NOT NULL AS cached FROM p LEFT JOIN v ON v.file_hash = p.file_hash""")
def c3_classification_cache(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    computed = docs.where("file_hash IS NOT NULL").select("file_hash").distinct().select("file_hash", F.when(F.substring("file_hash", 1, 1) < "8", "native").otherwise("ocr").alias("workload_type"), F.lit("computed").alias("reason"))
    return tracking.classify_pending(docs, _cache(spark, sf_dir), computed, tracking.CLASSIFIER_VERSION)


@query(f"""WITH {_CL} SELECT count(*) AS wrong_predictions, count(DISTINCT tk.file_hash) AS hashes FROM tk JOIN ca ON ca.file_hash = tk.file_hash WHERE ca.workload_type = 'native' AND tk.extraction_method = 'ocr'""")
def c6_feedback(spark, sf_dir):
    rows = _docs(spark, sf_dir).where("extraction_method = 'ocr'").join(_cache(spark, sf_dir).where("workload_type = 'native'").select("file_hash"), "file_hash")
    return rows.agg(F.count("*").alias("wrong_predictions"), F.count_distinct("file_hash").alias("hashes"))


@query(f"""WITH {TK}, l AS (SELECT file_hash, id AS source_id FROM tk WHERE status = 'COMPLETE' AND file_hash IS NOT NULL QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY completed_at DESC NULLS LAST, id DESC) = 1)
    SELECT tk.id, l.source_id, tk.id = l.source_id AS own FROM tk JOIN l USING (file_hash)""")
def j8_reuse_by_hash(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    source = tracking.latest_completed(docs).withColumnRenamed("id", "source_id")
    return docs.select("id", "file_hash").join(source, "file_hash").select("id", "source_id", (F.col("id") == F.col("source_id")).alias("own"))


_SC = f"""sc AS (SELECT t.id, t.file_hash AS expected_hash, CASE WHEN id % 11 = 0 THEN NULL ELSE t.file_hash END AS file_hash, CASE WHEN id % 7 = 0 THEN 9 ELSE 10 END AS pipeline_version, CASE WHEN id % 3 = 0 THEN 'paddleocr' WHEN id % 3 = 1 THEN 'fused' END AS ocr_engine,
    CASE WHEN id % 5 = 0 THEN 85.0 ELSE 90.0 END AS threshold, id % 2 = 0 AS fallback, CASE WHEN id % 13 = 0 THEN 1 ELSE 2 END AS algorithm, e.text, t.extraction_method FROM tk t LEFT JOIN (SELECT DISTINCT doc_id, text FROM pdf_extractions) e ON e.doc_id = t.id)"""


def _sidecars(spark, sf_dir):
    k = F.col("id")
    rows = _docs(spark, sf_dir).join(views.extractions(spark, sf_dir).select(F.col("doc_id").alias("id"), "text"), "id", "left")
    return rows.select("id", F.col("file_hash").alias("expected_hash"), F.when(k % 11 != 0, F.col("file_hash")).alias("file_hash"), F.when(k % 7 == 0, 9).otherwise(10).alias("pipeline_version"), F.when(k % 3 == 0, "paddleocr").when(k % 3 == 1, "fused").alias("ocr_engine"), F.when(k % 5 == 0, 85.0).otherwise(90.0).alias("threshold"), (k % 2 == 0).alias("fallback"), F.when(k % 13 == 0, 1).otherwise(2).alias("algorithm"), "text", "extraction_method")


@query(f"""WITH {TK}, {_SC} SELECT id, CASE WHEN file_hash IS DISTINCT FROM expected_hash THEN 'hash' WHEN pipeline_version <> 10 THEN 'version' WHEN coalesce(ocr_engine, 'paddleocr') <> 'fused' THEN 'engine' WHEN threshold <> 90 THEN 'threshold' WHEN fallback AND algorithm <> 2 THEN 'algorithm'
    WHEN text IS NULL THEN 'missing_text' WHEN extraction_method = 'native' AND len(list_filter(string_split_regex(text, '(?m)^=== PAGE \\d+ ===\\s*$'), lambda p: {S.ALNUM('p')} >= 100 AND {S.ALPHA('p')} / {S.ALNUM('p')} < 0.05)) > 0 THEN 'low_alphabetic_text' ELSE 'valid' END AS state FROM sc""")
def j9_sidecar_validity(spark, sf_dir):
    return tracking.sidecar_state(_sidecars(spark, sf_dir), "fused", 90.0).select("id", "state")


@query(f"""WITH {TK}, {_SC} SELECT id, text IS NOT NULL AS has_text, ocr_engine IS NOT NULL AS has_engine, coalesce(length(text), 0) AS characters FROM sc""")
def s11_sidecar_scan(spark, sf_dir):
    # Sidecars as lines of JSON, read back under a fixed schema; absent keys are null.
    rows = _sidecars(spark, sf_dir)
    made = rows.select("id", "text", F.to_json(F.struct("file_hash", "pipeline_version", "ocr_engine")).alias("json"))
    read = made.select("id", "text", F.from_json("json", "file_hash string, pipeline_version int, ocr_engine string").alias("m"))
    return read.select("id", F.col("text").isNotNull().alias("has_text"), F.col("m.ocr_engine").isNotNull().alias("has_engine"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("characters"))


@query("""SELECT doc_id, round(ocr_time_seconds, 4) AS ocr_time_seconds, coalesce(len(ocr_pages), 0)::BIGINT AS ocr_page_count, (page_count IS NOT NULL)::INT + (extraction_method IS NOT NULL)::INT + (ocr_engine IS NOT NULL)::INT + (ocr_time_seconds IS NOT NULL)::INT AS keys
    FROM (SELECT DISTINCT doc_id, page_count, extraction_method, ocr_engine, ocr_pages, ocr_time_seconds FROM pdf_extractions)""")
def k2_metadata(spark, sf_dir):
    # What is published leaves out keys without a value.
    e = views.extractions(spark, sf_dir)
    json = F.to_json(F.struct("page_count", "extraction_method", "ocr_engine", F.round("ocr_time_seconds", 4).alias("ocr_time_seconds")), {"ignoreNullFields": "true"})
    rows = e.select("doc_id", "ocr_pages", json.alias("json"))
    return rows.select("doc_id", F.get_json_object("json", "$.ocr_time_seconds").cast("double").alias("ocr_time_seconds"), F.when(F.col("ocr_pages").isNull(), 0).otherwise(F.size("ocr_pages")).cast("bigint").alias("ocr_page_count"), F.size(F.json_object_keys("json")).alias("keys"))


@query(f"""WITH {TK}, l AS (SELECT file_hash, id AS source_id FROM tk WHERE status = 'COMPLETE' AND file_hash IS NOT NULL QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY completed_at DESC NULLS LAST, id DESC) = 1)
    SELECT tk.id, sha256('DOCUMENT: ' || tk.filename || E'\\n\\n' || e.text || E'\\n') AS hash FROM tk JOIN l USING (file_hash) JOIN (SELECT DISTINCT doc_id, text FROM pdf_extractions) e ON e.doc_id = l.source_id WHERE tk.id <> l.source_id AND e.text IS NOT NULL AND tk.filename IS NOT NULL""")
def k3_republish_duplicate(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    source = tracking.latest_completed(docs).withColumnRenamed("id", "source_id")
    texts = views.extractions(spark, sf_dir).where("text IS NOT NULL").select(F.col("doc_id").alias("source_id"), transcript.transcript(F.lit("source.pdf"), F.col("text")).alias("published"))
    rows = docs.where("filename IS NOT NULL").select("id", "file_hash", "filename").join(source, "file_hash").where("id <> source_id").join(texts, "source_id")
    # The body of the published transcript under the duplicate's own name.
    return rows.select("id", F.sha2(F.concat(F.lit("DOCUMENT: "), "filename", F.lit("\n\n"), transcript.body(F.col("published"))), 256).alias("hash"))


@query(r"""SELECT DISTINCT file_path, CASE WHEN starts_with(file_path, '/data/input/') THEN '/data/output/' || regexp_replace(substr(file_path, 13), '\.[^./]*$', '') || '.txt' END AS text_path,
    CASE WHEN starts_with(file_path, '/data/input/') THEN '/data/failed/' || substr(file_path, 13) END AS failed_path FROM tracked_documents""")
def k6_output_path(spark, sf_dir):
    from pagewright.sources.files import failed_path, output_path

    rows = table(spark, sf_dir, "tracked_documents").select("file_path").distinct()
    return rows.select("file_path", output_path(F.col("file_path"), "/data/input/", "/data/output/", ".txt").alias("text_path"), failed_path(F.col("file_path"), "/data/input/", "/data/failed/").alias("failed_path"))


@query(f"""WITH {TK} SELECT id, CASE WHEN status = 'FAILED' THEN 'ERROR: ' || filename WHEN completed_at IS NULL THEN '  ' || rpad(filename, greatest(32, length(filename))::INT, ' ') || ' already complete; skipped'
    ELSE '  ' || rpad(filename, greatest(32, length(filename))::INT, ' ') || CASE WHEN page_count IS NULL THEN ' page count unknown' ELSE lpad(page_count::VARCHAR, 8, ' ') || ' pages' END || '   ' || coalesce(upper(extraction_method), 'UNKNOWN') END AS line FROM tk""")
def k8_report_lines(spark, sf_dir):
    name = F.concat(F.lit("  "), F.rpad("filename", F.greatest(F.lit(32), F.length("filename")), F.lit(" ")))
    pages = F.when(F.col("page_count").isNull(), " page count unknown").otherwise(F.concat(F.lpad(F.col("page_count").cast("string"), 8, " "), F.lit(" pages")))
    done = F.concat(name, pages, F.lit("   "), F.coalesce(F.upper("extraction_method"), F.lit("UNKNOWN")))
    line = F.when(F.col("status") == "FAILED", F.concat(F.lit("ERROR: "), "filename")).when(F.col("completed_at").isNull(), F.concat(name, F.lit(" already complete; skipped"))).otherwise(done)
    return _docs(spark, sf_dir).select("id", line.alias("line"))


@query(f"""WITH {TK}, r AS (SELECT *, status = 'COMPLETE' AND id % 10 = 0 AS skipped FROM tk) SELECT count(*) AS discovered, count(*) FILTER (status <> 'FAILED' AND NOT skipped) AS documents, coalesce(sum(page_count) FILTER (status <> 'FAILED' AND NOT skipped), 0)::BIGINT AS pages,
    coalesce(sum(page_count) FILTER (status <> 'FAILED' AND NOT skipped AND extraction_method = 'native'), 0)::BIGINT AS native_pages, coalesce(sum(page_count) FILTER (status <> 'FAILED' AND NOT skipped AND extraction_method = 'ocr'), 0)::BIGINT AS ocr_pages,
    count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status <> 'FAILED' AND skipped) AS skipped FROM r""")
def a7_batch_summary(spark, sf_dir):
    return tracking.batch_summary(_docs(spark, sf_dir).withColumn("skipped", (F.col("status") == "COMPLETE") & (F.col("id") % 10 == 0)))


@query(f"""WITH {TK}, e AS (SELECT DISTINCT doc_id, text FROM pdf_extractions), d AS (SELECT DISTINCT file_hash FROM tk WHERE status = 'COMPLETE')
    SELECT tk.id, CASE WHEN status = 'COMPLETE' THEN 'skipped' WHEN tk.file_hash IN (SELECT file_hash FROM d WHERE file_hash IS NOT NULL) THEN 'reused' WHEN tk.id IN (SELECT document_id FROM errors) THEN 'failed' ELSE 'extract' END AS outcome FROM tk""")
def process_p1_status_outcome(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    done = docs.where("status = 'COMPLETE' AND file_hash IS NOT NULL").select("file_hash").distinct().withColumn("reusable", F.lit(True))
    bad = table(spark, sf_dir, "errors").select(F.col("document_id").alias("id")).distinct().withColumn("broken", F.lit(True))
    rows = docs.select("id", "status", "file_hash").join(done, "file_hash", "left").join(bad, "id", "left")
    return rows.select("id", F.when(F.col("status") == "COMPLETE", "skipped").when(F.col("reusable"), "reused").when(F.col("broken"), "failed").otherwise("extract").alias("outcome"))


_AT = """WITH RECURSIVE nd AS (SELECT DISTINCT k.id AS doc_id, nullif(k.id // 3, 0) AS parent_id, (k.id % 3 + 1)::INT AS idx, k.filename, coalesce(g.h, trim(lower(k.file_hash))) AS file_hash, k.status, k.extraction_method, k.page_count
        FROM tracked_documents k LEFT JOIN (SELECT DISTINCT id, trim(lower(file_hash)) AS h FROM tracked_documents) g ON k.id % 50 = 0 AND g.id = k.id // 9),
    tr AS (SELECT doc_id, doc_id AS root_id, 0 AS depth, coalesce(filename, 'attachment.pdf') AS path, []::VARCHAR[] AS ancestors, file_hash, false AS cycle FROM nd WHERE parent_id IS NULL
    UNION ALL SELECT a.doc_id, t.root_id, t.depth + 1, t.path || '.embedded/' || printf('%04d', a.idx) || '-' || coalesce(a.filename, 'attachment.pdf'), list_append(t.ancestors, t.file_hash), a.file_hash, coalesce(list_contains(list_append(t.ancestors, t.file_hash), a.file_hash), false)
    FROM nd a JOIN tr t ON a.parent_id = t.doc_id WHERE NOT t.cycle)"""


@query(f"{_AT} SELECT doc_id, root_id, depth, path, cycle FROM tr")
def j10_attachment_tree(spark, sf_dir):
    return attachments.tree(views.attachments(spark, sf_dir)).select("doc_id", "root_id", "depth", "path", "cycle")


@query(f"{_AT} SELECT doc_id, 'cycle detected' AS error FROM tr WHERE cycle")
def j10_cycle_failures(spark, sf_dir):
    return attachments.tree(views.attachments(spark, sf_dir)).where("cycle").select("doc_id", F.lit("cycle detected").alias("error"))


@query(f"""{_AT} SELECT tr.root_id, CASE WHEN bool_or(nd.status <> 'PENDING' AND nd.extraction_method = 'ocr') THEN 'ocr' WHEN bool_or(nd.status <> 'PENDING' AND nd.extraction_method = 'native') THEN 'native' ELSE 'unclassified' END AS workload,
    coalesce(sum(nd.page_count) FILTER (nd.status <> 'PENDING'), 0)::BIGINT AS pages, count(*) FILTER (nd.status <> 'PENDING') AS documents FROM tr JOIN nd USING (doc_id) GROUP BY tr.root_id""")
def c7_workload_profile(spark, sf_dir):
    nodes = views.attachments(spark, sf_dir)
    rows = attachments.tree(nodes).select("doc_id", "root_id").join(nodes.select("doc_id", "extraction_method", "page_count", (F.col("status") == "PENDING").alias("skipped")), "doc_id")
    return attachments.workload_profile(rows)


# Reports that compare engines.
_OUT = """o AS (SELECT DISTINCT doc_id, ocr_engine, ocr_time_seconds, extraction_time_seconds FROM pdf_extractions),
p AS (SELECT doc_id AS key, CASE WHEN ocr_time_seconds >= 0 THEN ocr_time_seconds END AS s FROM o WHERE doc_id % 4 <> 0), q AS (SELECT doc_id AS key, CASE WHEN extraction_time_seconds >= 0 THEN extraction_time_seconds END AS s FROM o WHERE doc_id % 3 <> 0),
f AS (SELECT doc_id AS key, CASE WHEN ocr_time_seconds >= 0 THEN ocr_time_seconds END AS s FROM o WHERE doc_id % 5 = 0)"""


def _outputs(spark, sf_dir):
    """The outputs of three engines, each of which lacks some documents."""
    o, k = views.extractions(spark, sf_dir), F.col("doc_id")
    safe = lambda c: F.when(F.col(c) >= 0, F.col(c))
    return (
        o.where(k % 4 != 0).select(k.alias("key"), safe("ocr_time_seconds").alias("paddle")),
        o.where(k % 3 != 0).select(k.alias("key"), safe("extraction_time_seconds").alias("tesseract")),
        o.where(k % 5 == 0).select(k.alias("key"), safe("ocr_time_seconds").alias("fused")),
    )


@query(f"WITH {_OUT} SELECT key, p.s AS paddle, q.s AS tesseract, f.s AS fused FROM p FULL JOIN q USING (key) FULL JOIN f USING (key)")
def j6_engine_outer_join(spark, sf_dir):
    p, q, f = _outputs(spark, sf_dir)
    return p.join(q, "key", "full_outer").join(f, "key", "full_outer")


@query(f"WITH {_OUT} SELECT key, p.s AS paddle, q.s AS tesseract FROM p JOIN q USING (key) WHERE p.s IS NOT NULL AND q.s IS NOT NULL")
def j7_timed_by_both(spark, sf_dir):
    p, q, _ = _outputs(spark, sf_dir)
    return p.where("paddle IS NOT NULL").join(q.where("tesseract IS NOT NULL"), "key")


@query(f"WITH {_OUT} SELECT count(*) AS documents, round(sum(p.s), 4) AS paddle, round(sum(q.s), 4) AS tesseract, round(CASE WHEN sum(q.s) > 0 THEN sum(p.s) / sum(q.s) END, 4) AS speedup FROM p JOIN q USING (key) WHERE p.s IS NOT NULL AND q.s IS NOT NULL")
def a10_engine_totals(spark, sf_dir):
    a, b = F.sum("paddle"), F.sum("tesseract")
    return j7_timed_by_both(spark, sf_dir).agg(F.count("*").alias("documents"), F.round(a, 4).alias("paddle"), F.round(b, 4).alias("tesseract"), F.round(F.when(b > 0, a / b), 4).alias("speedup"))


@query(f"WITH {_OUT} SELECT key, coalesce(printf('%.2f', p.s), '—') AS paddle, coalesce(printf('%.2f', q.s), '—') AS tesseract, CASE WHEN p.s IS NOT NULL AND q.s > 0 THEN printf('%.2f', p.s / q.s) || 'x' ELSE '—' END AS speedup FROM p FULL JOIN q USING (key)")
def k10_compare_report(spark, sf_dir):
    p, q, _ = _outputs(spark, sf_dir)
    show = lambda c: F.when(c.isNull(), F.lit("—")).otherwise(F.format_string("%.2f", c))
    ratio = F.when(F.col("tesseract") > 0, F.col("paddle") / F.col("tesseract"))
    rows = p.join(q, "key", "full_outer")
    return rows.select("key", show(F.col("paddle")).alias("paddle"), show(F.col("tesseract")).alias("tesseract"), F.when(ratio.isNull(), F.lit("—")).otherwise(F.concat(show(ratio), F.lit("x"))).alias("speedup"))


_STEM = r"lower(regexp_replace(regexp_replace(file_path, '^.*/', ''), '\.[^.]*$', ''))"


@query(rf"""WITH t AS (SELECT DISTINCT file_path FROM tracked_documents WHERE file_path IS NOT NULL), n AS (SELECT file_path, {_STEM} AS stem, row_number() OVER (PARTITION BY {_STEM} ORDER BY file_path) AS r FROM t)
    SELECT file_path, CASE WHEN r = 1 THEN stem ELSE lower(regexp_replace(substr(file_path, 13), '\.[^./]*$', '')) END AS key FROM n""")
def a12_compare_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "tracked_documents").where("file_path IS NOT NULL").select("file_path").distinct()
    stem = F.lower(F.regexp_replace(F.regexp_replace("file_path", r"^.*/", ""), r"\.[^.]*$", ""))
    # The first path of a stem has it for its key. A stem that many paths share needs only its least path, no window.
    first = rows.select(stem.alias("stem"), "file_path").groupBy("stem").agg(F.min("file_path").alias("first"))
    rows = rows.withColumn("stem", stem).join(first, "stem")
    return rows.select("file_path", F.when(F.col("file_path") == F.col("first"), F.col("stem")).otherwise(F.lower(F.regexp_replace(F.expr("substr(file_path, 13)"), r"\.[^./]*$", ""))).alias("key"))


@query("SELECT DISTINCT doc_id, CASE WHEN try_cast(CASE WHEN doc_id % 6 = 0 THEN 'n/a' WHEN doc_id % 6 = 1 THEN '-' || ocr_time_seconds ELSE ocr_time_seconds::VARCHAR END AS DOUBLE) >= 0 THEN try_cast(CASE WHEN doc_id % 6 = 0 THEN 'n/a' WHEN doc_id % 6 = 1 THEN '-' || ocr_time_seconds ELSE ocr_time_seconds::VARCHAR END AS DOUBLE) END AS seconds FROM pdf_extractions")
def x11_safe_seconds(spark, sf_dir):
    k = F.col("doc_id")
    raw = F.when(k % 6 == 0, "n/a").when(k % 6 == 1, F.concat(F.lit("-"), F.col("ocr_time_seconds").cast("string"))).otherwise(F.col("ocr_time_seconds").cast("string"))
    return views.extractions(spark, sf_dir).select("doc_id", raw.alias("raw")).selectExpr("doc_id", "CASE WHEN try_cast(raw AS double) >= 0 THEN try_cast(raw AS double) END AS seconds")


@query()
def x9_token_sequence_similarity(spark, sf_dir):
    e = views.engines(spark, sf_dir)
    doc = lambda engine: e.where(F.col("engine") == engine).groupBy("doc_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "line_id", "text"))), lambda s: s.text), "\n").alias("text"))
    a, b = (doc(n).select("doc_id", "page_no", T.tokens(F.col("text")).alias(n)) for n in ("paddleocr", "tesseract"))
    return a.join(b, ["doc_id", "page_no"], "full_outer").select("doc_id", "page_no", F.round(fuzzy.sequence_similarity("paddleocr", "tesseract"), 4).alias("similarity"))


@query(f"""WITH {S.EN}, b AS (SELECT line_id, engine, doc_id, page_no, idx, lower(text) AS norm, {S.hull('polygon')} AS u FROM en)
    SELECT x.line_id, x.engine, y.line_id AS earlier_id, y.engine AS earlier_engine FROM b x JOIN b y ON x.doc_id = y.doc_id AND x.page_no = y.page_no AND x.norm = y.norm AND (y.idx, y.line_id, y.engine) < (x.idx, x.line_id, x.engine) WHERE x.u IS NOT NULL AND y.u IS NOT NULL AND {S.shared('x.u', 'y.u')} / least({S.area('x.u')}, {S.area('y.u')}) >= 0.8""")
def w4_duplicate_pairs(spark, sf_dir):
    from pagewright.functions import geometry as G

    rows = views.engines(spark, sf_dir).select("line_id", "engine", "doc_id", "page_no", "idx", F.lower("text").alias("norm"), G.hull(F.col("polygon")).alias("u")).where("u IS NOT NULL")
    early = rows.select("doc_id", "page_no", "norm", F.col("idx").alias("i"), F.col("line_id").alias("earlier_id"), F.col("engine").alias("earlier_engine"), F.col("u").alias("v"))
    pairs = rows.join(early, ["doc_id", "page_no", "norm"]).where(F.struct("i", "earlier_id", "earlier_engine") < F.struct("idx", "line_id", "engine"))
    return pairs.where(G.overlap_of_smaller(F.col("u"), F.col("v")) >= 0.8).select("line_id", "engine", "earlier_id", "earlier_engine")


@query()
def w4_overlap_dedup(spark, sf_dir):
    """Both engines' lines of a page in one transcript, of which overlapping repeats are dropped."""
    from pagewright.functions import geometry as G

    line = F.concat(G.position_label(G.hull(F.col("polygon"))), F.lit(" "), F.col("text"))
    rows = views.engines(spark, sf_dir).groupBy("doc_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "line_id", "engine", line.alias("line")))), lambda s: s.line), "\n").alias("body"))
    text = F.concat(F.format_string("=== PAGE %d ===\n\n", "page_no"), F.lit(T.SECTIONS[0] + "\n"), F.col("body"))
    return transcript.clean(rows.select(F.concat_ws("/", "doc_id", "page_no").alias("page"), text.alias("text")), "page")
