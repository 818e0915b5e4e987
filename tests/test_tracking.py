from pyspark.sql import functions as F

from pagewright.operators import attachments, metrics, tracking
from pagewright.sources import files

DOCS = "id bigint, file_path string, file_hash string, status string, page_count int, extraction_method string, completed_at timestamp"


def docs(spark, *rows):
    return spark.createDataFrame([(*r, None) for r in rows], DOCS)


def test_register_is_idempotent_and_numbers_on(spark):
    old = docs(spark, (7, "/a", "h1", "COMPLETE", 1, "native"))
    new = spark.createDataFrame([("/a", "H1 "), ("/a", "h2"), ("/b", "h1"), ("/b", "h1"), (None, "x"), ("/c", None)], "file_path string, file_hash string")
    got = sorted(tuple(r) for r in tracking.register(old, new).select("id", "file_path", "file_hash").collect())
    assert got == [(8, "/a", "h2"), (9, "/b", "h1")]
    empty = docs(spark)
    assert tracking.register(empty, new.limit(0)).count() == 0


def test_states(spark):
    d = docs(spark, (1, "/a", "x", "PROCESSING", None, None), (2, "/b", "y", "PENDING", 3, "ocr"))
    up = spark.createDataFrame([(1, 4, "ocr"), (2, 4, "ocr"), (3, 4, "ocr")], "id bigint, new_count int, new_method string")
    got = {r["id"]: (r["status"], r["page_count"], r["rejected"]) for r in tracking.complete(d, up).collect()}
    assert got == {1: ("COMPLETE", 4, None), 2: ("PENDING", 3, "not_processing"), 3: (None, None, "not_processing")}
    up = spark.createDataFrame([(1, "COMPLETE"), (2, "FAILED"), (9, "FAILED"), (1, "odd")], "id bigint, new_status string")
    assert sorted((r["id"], r["rejected"]) for r in tracking.set_status(d, up).collect() if r["rejected"]) == [(1, "complete_needs_results"), (1, "unknown_status"), (9, "unknown_document")]
    assert [r["status"] for r in tracking.reset_interrupted(d).orderBy("id").collect()] == ["PENDING", "PENDING"]


def test_errors_need_text_and_document(spark):
    d = docs(spark, (1, "/a", "x", "FAILED", None, None))
    e = spark.createDataFrame([(1, 1, " bad "), (1, 1, " bad "), (2, 1, " \t"), (3, 5, "lost"), (4, 1, None)], "id bigint, document_id bigint, error string")
    assert [tuple(r) for r in tracking.accepted_errors(e, d).collect()] == [(1, 1, "bad")]


def test_cache_last_write_wins(spark):
    schema = "file_hash string, classifier_version string, workload_type string, reason string, seq bigint"
    old, new = spark.createDataFrame([("h", "1", "native", "a", 1)], schema), spark.createDataFrame([("h", "2", "ocr", "b", 2), ("g", "1", "odd", "c", 3)], schema)
    cache = tracking.upsert_classification(old, new)
    assert [(r["file_hash"], r["workload_type"]) for r in cache.collect()] == [("h", "ocr")]
    f = spark.createDataFrame([("h",)], "file_hash string")
    assert tracking.lookup_classification(f, cache, "1").first()["workload_type"] is None


def test_attachment_cycles_and_paths(spark):
    rows = [(1, None, 1, "a.pdf", "h"), (2, 1, 1, "dir/b.pdf", "i"), (3, 2, 2, "c.pdf", "h"), (4, 3, 1, "below.pdf", "j"), (5, 99, 1, "orphan.pdf", "k"), (6, None, 1, None, None), (6, None, 1, None, None)]
    got = {r["doc_id"]: r for r in attachments.tree(spark.createDataFrame(rows, "doc_id bigint, parent_id bigint, idx int, filename string, file_hash string")).collect()}
    assert set(got) == {1, 2, 3, 6} and got[3]["cycle"] and not got[2]["cycle"]
    assert got[2]["path"] == "a.pdf.embedded/0001-b.pdf" and got[3]["depth"] == 2 and got[6]["path"] == "attachment.pdf"


def test_metrics_skip_standing_time_and_floor_work(spark):
    rows = [(1, 1, 0, 0, 100), (1, 2, 1_000_000, 200, 300), (1, 3, 1_000_000, 900, 300), (1, 4, 3_000_000, 100, 100)]
    s = spark.createDataFrame(rows, "run_id bigint, seq bigint, elapsed_us bigint, cpu_hundredths bigint, memory_bytes bigint")
    d = metrics.deltas(s)
    assert [(r["seq"], r["us"], r["work"]) for r in d.orderBy("seq").collect()] == [(2, 1_000_000, 200), (4, 2_000_000, 0)]
    m = metrics.summarise(d, s, ["run_id"], 8.0).first()
    assert m["average_cores"] == 0.667 and m["max_cores"] == 2.0 and m["average_memory"] == 200 and m["max_above_baseline"] == 200


def test_files(spark, tmp_path):
    for name in ("a/first.PDF", "second.pdf", "note.txt", "bare"):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"%PDF-1.4")
    got = files.in_order(files.scan_pdfs(spark, str(tmp_path))).select("path", files.content_hash(F.col("content")).alias("h")).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in got] == ["first.PDF", "second.pdf"] and len({r["h"] for r in got}) == 1
    out = tmp_path / "out"
    files.publish(spark.createDataFrame([("x/y.txt", "hello"), ("z.txt", "")], "path string, body string"), str(out))
    assert (out / "x/y.txt").read_text() == "hello" and (out / "z.txt").read_text() == ""
    (out / "z.json").write_text('{"file_hash": "h"}')
    (out / "bad.json").write_text("{")
    rows = {r["stem"].rsplit("/", 1)[1]: (r["file_hash"], r["text"]) for r in files.read_sidecars(spark, str(out), "file_hash string").collect()}
    assert rows == {"z": ("h", None), "bad": (None, None)} or rows == {"z": ("h", ""), "bad": (None, None)}
    one = spark.createDataFrame([("a.PDF", b"x"), ("b", b"junk %PDF-1"), ("c", b"no")], "n string, c binary").select(files.is_pdf(F.col("n"), F.col("c"))).collect()
    assert [r[0] for r in one] == [True, True, False]
