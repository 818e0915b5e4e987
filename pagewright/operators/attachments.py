"""Trees of attachments: depth, paths, cycles by content, and profiles by root."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import materialise


def tree(nodes: DataFrame) -> DataFrame:
    """(doc_id, root_id, depth, path, ancestors, cycle) of nodes(doc_id, parent_id, idx, filename, file_hash).

    A level is one join with the level above it, written before the next begins, so that a lost executor costs no
    earlier level; levels are made until one is empty. A node whose content equals an ancestor's is a cycle, and nothing below it is followed. Nodes under
    unknown parents, or in a ring of parents without a root, aren't reached, so that the levels end. ancestors are the hashes from the root to the parent.
    """
    name = F.regexp_replace(F.coalesce("filename", F.lit("attachment.pdf")), r"^.*/", "")
    rows = nodes.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "parent_id", "idx", "file_hash", name.alias("name"))
    level = rows.where("parent_id IS NULL").select("doc_id", F.col("doc_id").alias("root_id"), F.lit(0).alias("depth"), F.col("name").alias("path"), F.array().cast("array<string>").alias("ancestors"), F.col("file_hash").alias("own"), F.lit(False).alias("cycle"))
    out = level = materialise(level, "tree-0")
    children = rows.where("parent_id IS NOT NULL")
    depth = 0
    while True:
        depth += 1
        up = level.where("NOT cycle").select(F.col("doc_id").alias("parent_id"), "root_id", F.col("path").alias("above"), F.concat("ancestors", F.array("own")).alias("ancestors"))
        place = F.format_string("%s.embedded/%04d-%s", "above", "idx", "name")
        found = children.join(up, "parent_id").select("doc_id", "root_id", F.lit(depth).alias("depth"), place.alias("path"), "ancestors", F.col("file_hash").alias("own"), F.array_contains("ancestors", F.col("file_hash")).alias("cycle"))
        level = materialise(found.withColumn("cycle", F.coalesce("cycle", F.lit(False))), f"tree-{depth}")
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out.drop("own")


def workload_profile(members: DataFrame) -> DataFrame:
    """(root_id, workload, pages, documents) of members(root_id, extraction_method, page_count, skipped): ocr if any was recognised, else native if any was read, else unclassified."""
    live = ~F.col("skipped")
    any_ = lambda m: F.coalesce(F.max(live & (F.col("extraction_method") == m)), F.lit(False))
    kind = F.when(any_("ocr"), "ocr").when(any_("native"), "native").otherwise("unclassified")
    return members.groupBy("root_id").agg(kind.alias("workload"), F.coalesce(F.sum(F.when(live, F.col("page_count"))), F.lit(0)).cast("bigint").alias("pages"), F.count_if(live).alias("documents"))
