"""The tracking table: documents, classifications and errors as DataFrames.

A file of this kind has no updates in place, so each operation takes a table and gives its new version; what breaks a
rule comes back as rejected rows and changes nothing. One writer at a time makes a version; see
:mod:`pagewright.operators.incremental` for how versions are committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.operators.incremental import normal_hash
from pagewright.session import materialise

STATES = ("PENDING", "PROCESSING", "COMPLETE", "FAILED")
PIPELINE_VERSION, FUSION_VERSION, CLASSIFIER_VERSION = 10, 2, "1"


def documents(tracked: DataFrame) -> DataFrame:
    """One row a document: repeated rows dropped, hashes trimmed and in lower case."""
    return tracked.dropDuplicates(["id"]).withColumn("file_hash", normal_hash("file_hash"))


def numbered(rows: DataFrame, keys: list[str], start: int) -> DataFrame:
    """rows with an id from start + 1 in the order of unique keys, without putting them all in one task.

    Rows are ranged over the partitions once and written; the rank within a partition is added to the sizes of those
    before it, and only these sizes reach the driver.
    """
    ranged = materialise(rows.repartitionByRange(*keys).withColumn("_p", F.spark_partition_id()), "numbered")
    sizes = sorted((r["_p"], r["n"]) for r in ranged.groupBy("_p").agg(F.count("*").alias("n")).collect())
    before, at = {}, start
    for p, n in sizes:
        before[p] = at
        at += n
    base = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("_p")) if before else F.lit(start)
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(*keys))
    return ranged.withColumn("id", (base + rank).cast("bigint")).drop("_p")


def register(tracked: DataFrame, files: DataFrame) -> DataFrame:
    """(id, file_path, file_hash) of the files that aren't tracked yet; a pair of path and hash is registered once however often it comes."""
    keys = ["file_path", "file_hash"]
    new = files.select("file_path", normal_hash("file_hash").alias("file_hash")).dropna().distinct()
    start = tracked.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return numbered(new.join(tracked.select(*keys), keys, "left_anti"), keys, start)


def lookup_classification(files: DataFrame, cache: DataFrame, version: str) -> DataFrame:
    """files with the cached workload_type and reason of their hash, null where there is none of this version."""
    hit = cache.where(F.col("classifier_version") == version).select("file_hash", "workload_type", "reason")
    return files.join(hit, "file_hash", "left")


def upsert_classification(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The cache after new rows: for each hash the row with the greatest seq; max of a struct combines before the shuffle."""
    both = cache.unionByName(new).where(F.col("workload_type").isin("native", "ocr") & F.col("file_hash").isNotNull())
    rest = [c for c in both.columns if c not in ("file_hash", "seq")]
    return both.groupBy("file_hash").agg(F.max(F.struct("seq", *rest)).alias("v")).select("file_hash", "v.*")


def set_status(tracked: DataFrame, updates: DataFrame) -> DataFrame:
    """(id, status, completed_at, rejected) for updates(id, new_status), one an id: COMPLETE can't be set so, and an unknown id is rejected."""
    rows = updates.join(tracked.select("id", F.col("status").alias("old")), "id", "left")
    why = F.when(F.col("old").isNull(), "unknown_document").when(F.col("new_status") == "COMPLETE", "complete_needs_results").when(~F.col("new_status").isin(*STATES), "unknown_status")
    return rows.select("id", F.when(why.isNull(), F.col("new_status")).otherwise(F.col("old")).alias("status"), why.alias("rejected"))


def set_page_count(tracked: DataFrame, updates: DataFrame) -> DataFrame:
    """(id, page_count, rejected) for updates(id, new_count)."""
    rows = updates.join(tracked.select("id", "page_count", F.lit(True).alias("known")), "id", "left")
    why = F.when(F.col("known").isNull(), "unknown_document").when(F.col("new_count").isNull() | (F.col("new_count") < 0), "negative_page_count")
    return rows.select("id", F.when(why.isNull(), F.col("new_count")).otherwise(F.col("page_count")).alias("page_count"), why.alias("rejected"))


def complete(tracked: DataFrame, updates: DataFrame) -> DataFrame:
    """(id, status, page_count, extraction_method, rejected) for updates(id, new_count, new_method): only a document in work can be completed."""
    rows = updates.join(tracked.select("id", "status", "page_count", "extraction_method"), "id", "left")
    why = F.when(F.col("status").isNull() | (F.col("status") != "PROCESSING"), "not_processing").when(F.col("new_count").isNull() | (F.col("new_count") < 0), "negative_page_count").when(~F.col("new_method").isin("native", "ocr"), "unknown_method")
    ok = why.isNull()
    return rows.select("id", F.when(ok, "COMPLETE").otherwise(F.col("status")).alias("status"), F.when(ok, F.col("new_count")).otherwise(F.col("page_count")).alias("page_count"), F.when(ok, F.col("new_method")).otherwise(F.col("extraction_method")).alias("extraction_method"), why.alias("rejected"))


def accepted_errors(errors: DataFrame, tracked: DataFrame) -> DataFrame:
    """(id, document_id, error) of errors with a text and a known document, trimmed, each id once."""
    rows = errors.dropDuplicates(["id"]).withColumn("error", T.stripped(F.col("error"))).where("error <> ''")
    return rows.join(tracked.select(F.col("id").alias("document_id")), "document_id", "left_semi").select("id", "document_id", "error")


def with_completed_hash(files: DataFrame, tracked: DataFrame) -> DataFrame:
    """files whose content was completed under any path."""
    return files.join(tracked.where("status = 'COMPLETE'").select("file_hash").distinct(), "file_hash", "left_semi")


def reset_interrupted(tracked: DataFrame) -> DataFrame:
    """(id, status, was_reset): documents in work are pending again after a restart."""
    stuck = F.coalesce(F.col("status") == "PROCESSING", F.lit(False))
    return tracked.select("id", F.when(stuck, "PENDING").otherwise(F.col("status")).alias("status"), stuck.alias("was_reset"))


def latest_completed(tracked: DataFrame) -> DataFrame:
    """(file_hash, id): for each hash the document completed last, then of the greatest id."""
    done = tracked.where("status = 'COMPLETE' AND file_hash IS NOT NULL")
    return done.groupBy("file_hash").agg(F.max(F.struct("completed_at", "id")).alias("v")).select("file_hash", "v.id")


def worker_failures(tracked: DataFrame, failures: DataFrame) -> DataFrame:
    """(file_path, file_hash, id, outcome) for failures(file_path, file_hash): complete documents are left, tracked ones fail, others are registered failed (id null until numbered)."""
    rows = failures.join(tracked.groupBy("file_path", "file_hash").agg(F.max("id").alias("id"), F.max(F.col("status") == "COMPLETE").alias("done")), ["file_path", "file_hash"], "left")
    return rows.select("file_path", "file_hash", "id", F.when(F.col("done"), "kept_complete").when(F.col("id").isNull(), "registered_failed").otherwise("failed").alias("outcome"))


def classify_pending(tracked: DataFrame, cache: DataFrame, computed: DataFrame, version: str) -> DataFrame:
    """(file_hash, workload_type, reason, cached) for the hashes of pending documents: from the cache where it has this version, else as computed(file_hash, workload_type, reason).

    computed is only asked for hashes that the cache lacks: it is joined after the anti-join, which matters when it is costly.
    """
    pending = tracked.where("status <> 'COMPLETE' AND file_hash IS NOT NULL").select("file_hash").distinct()
    valid = cache.where(F.col("classifier_version") == version).select("file_hash", "workload_type", "reason")
    hit = pending.join(valid, "file_hash").withColumn("cached", F.lit(True))
    missing = pending.join(valid.select("file_hash"), "file_hash", "left_anti")
    return hit.unionByName(missing.join(computed, "file_hash").withColumn("cached", F.lit(False)))


def batch_summary(results: DataFrame) -> DataFrame:
    """One row of counts from results(status, skipped, page_count, extraction_method); skipped documents count nowhere else."""
    done = (F.col("status") != "FAILED") & ~F.col("skipped")
    pages = lambda test: F.coalesce(F.sum(F.when(done & test, F.col("page_count"))), F.lit(0)).cast("bigint")
    return results.agg(F.count("*").alias("discovered"), F.count_if(done).alias("documents"), pages(F.lit(True)).alias("pages"), pages(F.col("extraction_method") == "native").alias("native_pages"), pages(F.col("extraction_method") == "ocr").alias("ocr_pages"), F.count_if(F.col("status") == "FAILED").alias("failed"), F.count_if((F.col("status") != "FAILED") & F.col("skipped")).alias("skipped"))


def sidecar_state(sidecars: DataFrame, engine: str, threshold: float) -> DataFrame:
    """sidecars with state: 'valid' or the first reason why the output can't be used again.

    Columns: file_hash, expected_hash, pipeline_version, ocr_engine, threshold, fallback, algorithm, text,
    extraction_method. A missing engine means paddleocr; native text is refused only for a very low share of letters.
    """
    c = F.col
    low = F.exists(F.filter(F.split("text", T.PAGE_MARK), lambda p: ~T.is_blank(p)), lambda p: T.low_alpha(p))
    checks = [
        (~c("file_hash").eqNullSafe(c("expected_hash")), "hash"),
        (~c("pipeline_version").eqNullSafe(F.lit(PIPELINE_VERSION)), "version"),
        (F.coalesce("ocr_engine", F.lit("paddleocr")) != engine, "engine"),
    ]
    if engine == "fused":
        checks += [(~c("threshold").eqNullSafe(F.lit(threshold)), "threshold"), (F.coalesce("fallback", F.lit(False)) & ~c("algorithm").eqNullSafe(F.lit(FUSION_VERSION)), "algorithm")]
    checks += [(c("text").isNull(), "missing_text"), ((c("extraction_method") == "native") & low, "low_alphabetic_text")]
    state = None
    for test, name in checks:
        state = F.when(test, name) if state is None else state.when(test, name)
    return sidecars.withColumn("state", state.otherwise("valid"))
