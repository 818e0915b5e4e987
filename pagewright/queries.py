"""The queries of the core, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.operators import incremental
from pagewright.plans import metric_queries, page_queries, registry, text_queries, tracking_queries  # noqa: F401
from pagewright.session import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content that the next run must still process."""
    return incremental.pending_by_versions(table(spark, sf_dir, "file_arrivals"), table(spark, sf_dir, "tracked_documents"))


def p3_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both directions of the difference between the committed and the live manifest."""
    live = incremental.live_manifest(table(spark, sf_dir, "file_arrivals")).select("file_hash")
    return incremental.diff_manifests(incremental.committed_manifest(table(spark, sf_dir, "tracked_documents")), live, ["file_hash"])


QUERIES = registry.QUERIES | {f.__name__: f for f in (p3_found, p3_changes)}

_LIVE = r"""live AS (SELECT DISTINCT h FROM (
    SELECT nullif(lower(trim(file_hash, E' \t\n\r')), '') AS h, row_number() OVER (PARTITION BY file_path ORDER BY modified_at DESC NULLS LAST, arrival_id DESC NULLS LAST) AS r
    FROM file_arrivals WHERE file_path IS NOT NULL) WHERE r = 1 AND h IS NOT NULL),
done AS (SELECT DISTINCT nullif(lower(trim(file_hash, E' \t\n\r')), '') AS h FROM tracked_documents WHERE status = 'COMPLETE' AND completed_at IS NOT NULL)"""

SQL = registry.SQL | {
    "p3_found": f"WITH {_LIVE} SELECT h AS file_hash FROM live WHERE h NOT IN (SELECT h FROM done WHERE h IS NOT NULL)",
    "p3_changes": f"""WITH {_LIVE} SELECT coalesce(live.h, done.h) AS file_hash, CASE WHEN done.h IS NULL THEN 'added' ELSE 'removed' END AS change
        FROM live FULL JOIN (SELECT h FROM done WHERE h IS NOT NULL) done ON live.h = done.h WHERE live.h IS NULL OR done.h IS NULL""",
}
