"""The test tables as the inputs that the operators take.

No table holds two recognisers' lines of one page, boxes of the same pages as lines, page sizes or attachments; these
are derived from what is there by integer arithmetic on ids, over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import text as T
from pagewright.session import table

#: Rows for branches that the tables don't reach: (doc_id, text).
SPECIAL = (
    (-1, ""), (-2, " \t\n"), (-3, " "), (-4, "Valid readable words � here"), (-5, "control \x01 here and there"), (-6, "vertical \x0b tab in here"),
    (-7, "form \x0c feed in here"), (-8, "12"), (-9, "ab cd"), (-10, "7" * 100), (-11, "7" * 100 + "abcdef"), (-12, "Helllo Worrrld"), (-13, "McDonald MacArthur"),
)


def extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pdf_extractions").dropDuplicates(["doc_id"])


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, text): each page of each extraction, and the special rows as pages of their own.

    Repeated rows give repeated pages: queries drop them from their own small results, so that no text is shuffled.
    """
    special = spark.createDataFrame([(d, 1, t) for d, t in SPECIAL], "doc_id bigint, page_no int, text string")
    from pagewright.operators.transcript import split_pages

    return split_pages(table(spark, sf_dir, "pdf_extractions").select("doc_id", "text")).unionByName(special)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ocr_lines").dropDuplicates(["line_id"])


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "native_regions").dropDuplicates(["region_id"])


def engines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_id, doc_id, page_no, engine, idx, text, confidence, polygon): each page as two engines see it.

    The first engine, 'tesseract', has the lines as they are. The second, 'paddleocr', misses each thirteenth line,
    reads o as 0 in each fifth, is sure to another degree, and sees each seventh further down.
    """
    own = lines(spark, sf_dir).where("text IS NOT NULL").select("line_id", "doc_id", "page_no", "idx", "text", "confidence", "polygon")
    k = F.col("line_id")
    moved = F.transform("polygon", lambda p: F.struct(p.x.alias("x"), F.when(k % 7 == 0, p.y + 0.3).otherwise(p.y).alias("y")))
    other = own.where(k % 13 != 0).withColumns({
        "text": F.when(k % 5 == 0, F.regexp_replace("text", "o", "0")).otherwise(F.col("text")),
        "confidence": F.when(k % 23 != 0, (50 + (k * 7919) % 50) / 100.0),
        "polygon": F.when(k % 19 != 0, moved),
    })
    return own.withColumn("engine", F.lit("tesseract")).unionByName(other.withColumn("engine", F.lit("paddleocr")))


def line_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(region_id, doc_id, page_no, text, box): native regions under two thirds of the lines, their text slightly different in each fourth."""
    k = F.col("line_id")
    b = G.hull(F.col("polygon"))
    rows = lines(spark, sf_dir).where("text IS NOT NULL").where(k % 3 != 0)
    text = F.when(k % 4 == 0, F.regexp_replace("text", "e", "c")).otherwise(F.col("text"))
    return rows.select(k.alias("region_id"), "doc_id", "page_no", text.alias("text"), b.alias("box")).where("box IS NOT NULL")


def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, parent_id, idx, filename, file_hash): tracked documents as one tree of arity three, whose depth grows with the logarithm of the table; each fiftieth has the content of the parent of its parent."""
    rows = table(spark, sf_dir, "tracked_documents").dropDuplicates(["id"]).withColumn("own", F.trim(F.lower("file_hash")))
    k = F.col("id")
    parent = F.floor(k / 3).cast("bigint")
    above = rows.select(k.alias("above"), F.col("own").alias("theirs"))
    rows = rows.join(above, (k % 50 == 0) & (F.floor(k / 9).cast("bigint") == F.col("above")), "left")
    return rows.select(k.alias("doc_id"), F.when(parent > 0, parent).alias("parent_id"), (k % 3 + 1).cast("int").alias("idx"), "filename", F.coalesce("theirs", "own").alias("file_hash"), "status", "extraction_method", "page_count")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, seq, elapsed, cpu_seconds, memory_bytes): events as samples of a run, one run a user."""
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    us = micros - F.min(micros).over(Window.partitionBy("user_id"))
    cpu = F.sum(F.round(F.col("value") * 100).cast("bigint")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return e.select(F.col("user_id").alias("run_id"), F.row_number().over(w).cast("bigint").alias("seq"), "event_type", us.alias("elapsed_us"), (cpu - F.when(F.col("event_id") % 11 == 0, 300).otherwise(0)).alias("cpu_hundredths"), F.round(F.col("value") * 1000).cast("bigint").alias("memory_bytes"))
