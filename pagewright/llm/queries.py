"""The queries of this subpackage, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import abuse, encoding, leakage, mixing, neardup, repetition, scan, structure
from pagewright.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions whose text was decoded wrongly, wholly or in part."""
    return encoding.garbled(table(spark, sf_dir, "native_regions")).select("region_id").distinct()


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those regions with the swap of code pages and, where it can be had, their right text."""
    return encoding.garbled(table(spark, sf_dir, "native_regions")).select("region_id", "doc_id", "swap", "restored")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extractions of which at least 0.4 repeats."""
    return repetition.repetition(table(spark, sf_dir, "pdf_extractions"), divergence=False).where("share >= 0.4").select("doc_id").distinct()


def p2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of repeated content of each extraction, and its divergence from its language."""
    return repetition.repetition(table(spark, sf_dir, "pdf_extractions"))


def _page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_kind, record_id, text) of extractions and regions."""
    whole = table(spark, sf_dir, "pdf_extractions").select(F.lit("extraction").alias("record_kind"), F.col("doc_id").alias("record_id"), "text")
    return whole.unionByName(table(spark, sf_dir, "native_regions").select(F.lit("region").alias("record_kind"), F.col("region_id").alias("record_id"), "text"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of which more than half is lists, tables, forms or junk."""
    return structure.text_statistics(_page_texts(spark, sf_dir), ["record_kind", "record_id"]).where("other_share > 0.5").select("record_kind", "record_id").distinct()


def p4_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics and the structural profile of each text."""
    return structure.text_statistics(_page_texts(spark, sf_dir), ["record_kind", "record_id"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of scan noise that each extraction and line holds."""
    return scan.scan_noise(table(spark, sf_dir, "pdf_extractions"), table(spark, sf_dir, "ocr_lines"))


def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of extractions and lines as readable paragraphs."""
    return scan.repaired_pages(table(spark, sf_dir, "pdf_extractions"), table(spark, sf_dir, "ocr_lines"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of extractions whose sets of three successive words reach a similarity of 0.5."""
    return neardup.similar_pairs(table(spark, sf_dir, "pdf_extractions"), threshold=0.5, shingle=3, least=20).select("doc_id_a", "doc_id_b")


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each extraction with the class of its equal sets and its number of links, at five words and 0.8."""
    return neardup.similar_classes(table(spark, sf_dir, "pdf_extractions"))


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups of extractions that links of p6_found hold together, with the file names of their tracked documents."""
    groups = neardup.similar_groups(table(spark, sf_dir, "pdf_extractions"), threshold=0.5, shingle=3, least=20)
    names = table(spark, sf_dir, "tracked_documents").groupBy(F.col("id").alias("doc_id")).agg(F.max("filename").alias("filename"))
    return groups.join(names, "doc_id", "left")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain ten successive words of an evaluation item."""
    return p7_near(spark, sf_dir).where("edits = 0").select("doc_id", "item_id")


def p7_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain ten successive words of an evaluation item with at most two characters changed, and how many."""
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken so that the sources reach their target shares."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), mixing.default_tokenizer())[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares of tokens that the mixture reaches."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), mixing.default_tokenizer())[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an abusive, hateful or sexual passage."""
    docs = table(spark, sf_dir, "documents")
    return abuse.score(docs, abuse.fit(docs, table(spark, sf_dir, "review_labels"))).where(F.col("score") >= abuse.OFFENDING).select("doc_id").distinct()


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of offending documents of each source, and the mean score of each kind; unknown sources count together."""
    docs = table(spark, sf_dir, "documents")
    marks = abuse.score(docs, abuse.fit(docs, table(spark, sf_dir, "review_labels"), kinds=True))
    rated = docs.select("doc_id", "source").distinct().join(marks, "doc_id")
    kinds = [F.round(F.avg(k), 6).alias(k) for k in abuse.KINDS]
    return rated.groupBy("source").agg(F.count("*").alias("documents"), F.count_if(F.col("score") >= abuse.OFFENDING).alias("offending"), F.round(F.avg((F.col("score") >= abuse.OFFENDING).cast("double")), 6).alias("rate"), *kinds)


def p9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentences that made documents offending, with their probabilities."""
    docs = table(spark, sf_dir, "documents")
    found = abuse.offending_passages(docs, abuse.fit(docs, table(spark, sf_dir, "review_labels")))
    return found.withColumn("probability", F.round("probability", 6))


QUERIES = {f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_repetition, p4_found, p4_statistics, p5_found, p5_repaired, p6_found, p6_classes, p6_groups, p7_found, p7_near, p8_mix, p8_shares, p9_found, p9_rates, p9_passages)}
