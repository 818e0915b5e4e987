"""Quality scores and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights and bounds of the published heuristic.
CONFIDENCE, AGREEMENT, INTEGRITY = 0.45, 0.35, 0.20
REVIEW, HIGH, FAIR, SURE = 85.0, 90.0, 75.0, 0.80
LEAD, SUPPORT_LEAD, NOISE_LEAD = 8.0, 0.12, 0.15


def band(score: Column) -> Column:
    return F.when(score.isNull(), "unrated").when(score >= HIGH, "high").when(score >= FAIR, "review").otherwise("low")


def page_score(confidence: Column, agreement: Column, suspicious: Column, lines: Column) -> Column:
    """0 to 100 from what there is of confidence, agreement and integrity; weights of missing parts go to the others; 0 for a page without lines."""
    has = lambda c, w: F.when(c.isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
    top = F.coalesce(confidence * 100, F.lit(0.0)) * CONFIDENCE + F.coalesce(agreement * 100, F.lit(0.0)) * AGREEMENT + (1 - suspicious / lines) * 100 * INTEGRITY
    score = top / (has(confidence, CONFIDENCE) + has(agreement, AGREEMENT) + INTEGRITY)
    return F.when(lines > 0, F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))).otherwise(F.lit(0.0))


def document_score(mean: Column, least: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), 0.75 * mean + 0.25 * least))


def preferred_engine(first: Column, second: Column) -> Column:
    """'paddleocr' (second) or 'tesseract' (first) where one score is good and leads clearly, else null; the second is tried first."""
    wins = lambda a, b: (a >= REVIEW) & (b.isNull() | (a - b >= LEAD))
    return F.when(wins(second, first), "paddleocr").when(wins(first, second), "tesseract")
