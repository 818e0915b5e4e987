"""One batch from a folder of files to published texts: scan, skip what is done, extract, publish, track, sum up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.config import Settings
from pagewright.operators.incremental import VersionedTable
from pagewright.operators.tracking import PIPELINE_VERSION, batch_summary, numbered
from pagewright.operators.transcript import clean, transcript
from pagewright.session import materialise
from pagewright.sources import files as S
from pagewright.sources.plugins import Extractor, extract

TRACKED = "id bigint, filename string, file_path string, file_hash string, page_count int, extraction_method string, status string, error string, modified_at timestamp, size_bytes bigint"


def run(spark: SparkSession, settings: Settings, make: Callable[[], Extractor]) -> tuple[dict, int]:
    """(counts, exit code) of one batch; the code is 1 if a document failed.

    A file whose path, time and length are those of a complete row is skipped unread; of the others each is hashed once,
    and skipped if its content is complete at its path. Each distinct new content is read by a parser once; further paths
    of it take over its text and count as skipped. Texts are published before the tracker's new version is committed, so
    a batch that is lost between the two is done again and publishes the same. The tracker's commit hides the rows that
    changed and adds the new ones; others aren't written again. Failed documents are tried again by the next batch.
    """
    tracker = VersionedTable(spark, f"{settings.output_dir}/_tracker")
    base = tracker.version()
    live = tracker.rows(tracker.manifest(base)["files"]) if base else spark.createDataFrame([], TRACKED + ", _file string, _row bigint")
    old = live.drop("_file", "_row")
    found = S.scan_pdfs(spark, settings.input_dir, content=False).select("path", F.col("modificationTime").alias("modified_at"), F.col("length").alias("size_bytes"))
    done = old.where("status = 'COMPLETE'").select(F.col("file_path").alias("path"), "file_hash", "modified_at", "size_bytes")
    unread = found.join(done.select("path", "modified_at", "size_bytes"), ["path", "modified_at", "size_bytes"], "left_anti")
    hashed = _contents(spark, unread).select("path", F.sha2("content", 256).alias("file_hash"), F.col("modificationTime").alias("modified_at"), F.col("length").alias("size_bytes"))
    pending = materialise(hashed.join(done.select("path", "file_hash"), ["path", "file_hash"], "left_anti"), "batch-pending")
    # One path for each content is parsed.
    first = pending.groupBy("file_hash").agg(F.min("path").alias("path"))
    pages = materialise(extract(_contents(spark, first).select("path", "content"), make), "batch-pages")
    marked = F.concat(F.lit("=== PAGE "), F.col("page_no").cast("string"), F.lit(" ===\n\n"), "text")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", marked.alias("t")))), lambda s: s.t), "\n\n")
    read = pages.groupBy("file_hash").agg(F.min("path").alias("first"), F.max("error").alias("error"), F.max("page_count").alias("page_count"), whole.alias("text"))
    name = F.regexp_replace("path", r"^.*/", "")
    results = pending.join(read, "file_hash").withColumns({"filename": name, "status": F.when(F.col("error").isNull(), "COMPLETE").otherwise("FAILED"), "skipped": F.col("path") != F.col("first")})
    results = materialise(results, "batch-results")
    _publish(spark, results, settings)
    keys = ["file_path", "file_hash"]
    new = results.select("filename", F.col("path").alias("file_path"), "file_hash", F.col("page_count").cast("int"), F.lit("native").alias("extraction_method"), "status", "error", "modified_at", "size_bytes")
    known = new.join(old.select("id", *keys), keys)
    fresh = numbered(new.join(old.select(*keys), keys, "left_anti"), keys, old.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0])
    columns = [c.split()[0] for c in TRACKED.split(", ")]
    changed = live.join(new.select(*keys), keys, "left_semi")
    tracker.commit(add=known.select(*columns).unionByName(fresh.select(*columns)), delete=changed if base else None, properties={"pipeline_version": PIPELINE_VERSION}, base=base)
    rows = results.select("status", "skipped", "page_count", F.lit("native").alias("extraction_method"))
    rows = rows.unionByName(found.join(pending.select("path"), "path", "left_anti").select(F.lit("COMPLETE").alias("status"), F.lit(True).alias("skipped"), F.lit(None).cast("int").alias("page_count"), F.lit(None).cast("string").alias("extraction_method")))
    counts = batch_summary(rows).first().asDict()
    return counts, int(counts["failed"] > 0)


def _contents(spark: SparkSession, files: DataFrame) -> DataFrame:
    """binaryFile rows of files(path) alone. Paths pass the driver, as the listing of any read does; no content does."""
    paths = [r["path"] for r in files.select("path").toLocalIterator()]
    whole = spark.read.format("binaryFile")
    return whole.load(paths) if paths else spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary")


def _publish(spark: SparkSession, results: DataFrame, settings: Settings) -> None:
    """A text, its cleaned form and a JSON for each complete document, at its place under the output folder; a failed document is copied to the folder of failed ones and loses what an earlier version left."""
    source = settings.input_dir.rstrip("/") + "/"
    inside = lambda c: F.regexp_replace(F.regexp_replace(c, r"^file:/+", "/"), "^" + source.replace(".", r"\."), "")
    rows = results.withColumns({"rest": inside(F.col("path")), "text": transcript(F.col("filename"), F.col("text"))}).withColumn("stem", F.regexp_replace("rest", r"\.[^./]*$", ""))
    good, bad = rows.where("status = 'COMPLETE'"), rows.where("status = 'FAILED'")
    meta = F.to_json(F.struct("filename", "file_hash", F.lit(PIPELINE_VERSION).alias("pipeline_version"), "page_count", F.lit("native").alias("extraction_method"), "status"), {"ignoreNullFields": "true"})
    named = lambda df, suffix, body: df.select(F.concat("stem", F.lit(suffix)).alias("path"), body.alias("body"))
    cleaned = clean(good.select("stem", "text"), "stem")
    none = F.lit(None).cast("string")
    out = named(good, ".txt", F.col("text")).unionAll(named(cleaned, ".cleaned.txt", F.col("cleaned"))).unionAll(named(good, ".json", meta))
    for suffix in (".txt", ".cleaned.txt", ".json"):
        out = out.unionAll(named(bad, suffix, none))
    S.publish(out, settings.output_dir)
    if settings.failed_dir:
        copies = _contents(spark, bad.select("path")).select(inside(F.col("path")).alias("path"), F.col("content").alias("body"))
        S.publish(copies.unionAll(good.select(F.col("rest").alias("path"), F.lit(None).cast("binary").alias("body"))), settings.failed_dir)
