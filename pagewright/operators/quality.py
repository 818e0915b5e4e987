"""Assessment of native text and of recognised pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import scoring as S
from pagewright.functions import text as T


def assess_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, counts, alpha_ratio, reasons, ocr_recommended) of pages(doc_id, page_no, text)."""
    t = F.col("text")
    rows = pages.select("doc_id", "page_no", "text", F.length(t).alias("characters"), T.alnum_count(t).alias("alnum"), T.alpha_count(t).alias("alpha"))
    ratio = F.when(F.col("alnum") > 0, F.col("alpha") / F.col("alnum")).otherwise(F.lit(0.0))
    rows = rows.select("doc_id", "page_no", "characters", "alnum", "alpha", F.round(ratio, 4).alias("alpha_ratio"), T.reasons(t, F.col("alnum"), F.col("alpha")).alias("reasons"))
    return rows.withColumn("ocr_recommended", F.size("reasons") > 0)


def assess_documents(assessed: DataFrame) -> DataFrame:
    """(doc_id, pages, flagged_pages, ocr_recommended): flagged pages in order."""
    flagged = F.array_sort(F.collect_list(F.when(F.col("ocr_recommended"), F.col("page_no"))))
    return assessed.groupBy("doc_id").agg(F.count("*").alias("pages"), flagged.alias("flagged_pages"), F.max("ocr_recommended").alias("ocr_recommended"))


def classify(assessed: DataFrame, image_pages: DataFrame) -> DataFrame:
    """(doc_id, workload_type, reason): the first page in order that has an image or a reason decides; else the text is trusted."""
    image = image_pages.select("doc_id", "page_no", F.lit(True).alias("has_image")).distinct()
    page = assessed.join(image, ["doc_id", "page_no"], "left")
    why = F.when(F.col("has_image"), "image_resources").otherwise(F.get("reasons", 0))
    first = page.groupBy("doc_id").agg(F.min(F.when(why.isNotNull(), F.struct("page_no", why.alias("why")))).alias("first"))
    return first.select("doc_id", F.when(F.col("first").isNull(), "native").otherwise("ocr").alias("workload_type"), F.coalesce("first.why", F.lit("confident_native_text")).alias("reason"))


def review_flags(lines: DataFrame) -> DataFrame:
    """(doc_id, engine, page_no, idx, reasons, suspicious_tokens) of lines that someone should look at."""
    odd = T.review_tokens(F.col("text"))
    rows = lines.withColumn("suspicious_tokens", odd)
    why = F.array_compact(F.array(F.when(F.size("suspicious_tokens") > 0, F.lit("suspicious_character_pattern")), F.when(F.col("confidence") < S.SURE, F.lit("low_ocr_confidence"))))
    return rows.withColumn("reasons", why).where(F.size("reasons") > 0).select("doc_id", "engine", "page_no", "idx", "reasons", "suspicious_tokens")


def agreement(lines: DataFrame, regions: DataFrame, coverage) -> DataFrame:
    """(doc_id, engine, page_no, agreement, compared): the mean over lines of their best coverage by a region they lie on.

    lines have a box that may lack area, regions a box; coverage is a function of two token columns. The join is on
    document and page, so candidates are those of one page.
    """
    mine = lines.select("line_id", "doc_id", "engine", "page_no", G.hull(F.col("polygon"), degenerate=True).alias("box"), T.tokens(F.col("text")).alias("tokens")).where("box IS NOT NULL AND size(tokens) > 0")
    theirs = regions.select("doc_id", "page_no", F.col("box").alias("region_box"), T.tokens(F.col("text")).alias("region_tokens")).where("box IS NOT NULL AND size(region_tokens) > 0")
    near = mine.join(theirs, ["doc_id", "page_no"]).where(G.overlap_of_first(F.col("box"), F.col("region_box")) >= 0.35)
    best = near.withColumn("coverage", coverage(F.col("tokens"), F.col("region_tokens"))).groupBy("line_id", "doc_id", "engine", "page_no").agg(F.max("coverage").alias("coverage"))
    return best.groupBy("doc_id", "engine", "page_no").agg(F.avg("coverage").alias("agreement"), F.count("*").alias("compared"))


def page_quality(lines: DataFrame, agreed: DataFrame | None = None, pages: DataFrame | None = None) -> DataFrame:
    """(doc_id, engine, page_no, lines, confidence, agreement, suspicious, score): the score is unrounded.

    pages(doc_id, engine, page_no) adds recognised pages that have no lines; they score 0.
    """
    odd = F.size(T.review_tokens(F.col("text"))) > 0
    keys = ["doc_id", "engine", "page_no"]
    rows = lines.groupBy(*keys).agg(F.count("*").alias("lines"), F.avg("confidence").alias("confidence"), F.count_if(odd).alias("suspicious"))
    if pages is not None:
        rows = pages.select(*keys).distinct().join(rows, keys, "left").fillna(0, ["lines", "suspicious"])
    rows = rows.join(agreed, keys, "left") if agreed is not None else rows.withColumns({"agreement": F.lit(None).cast("double"), "compared": F.lit(None).cast("bigint")})
    return rows.withColumn("score", S.page_score(F.col("confidence"), F.col("agreement"), F.col("suspicious"), F.col("lines")))


def document_quality(pages: DataFrame) -> DataFrame:
    """(doc_id, engine, scored_pages, mean_score, weakest_score, score) from unrounded page scores."""
    rows = pages.groupBy("doc_id", "engine").agg(F.count("*").alias("scored_pages"), F.avg("score").alias("mean_score"), F.min("score").alias("weakest_score"))
    return rows.withColumn("score", S.document_score(F.col("mean_score"), F.col("weakest_score")))
