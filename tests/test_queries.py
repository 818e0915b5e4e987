import os

import pytest
from against_sql import SF, compare

from pagewright import queries

#: By default some of each kind; ALL_QUERIES=1 runs all, which takes minutes. The driver compares all of them as well.
SOME = "t8_reasons t10_document_assessment c1_classify_document w1_page_segmentation a9_native_audit x10_strip_annotations x5_token_subsequence l3_bbox_normalise l10_reading_order a1_page_quality f2_choose_line f5_assemble_page j1_geometry_candidates j2_uncovered_boxless d1_register d3_upsert_classification c3_classification_cache j9_sidecar_validity j10_attachment_tree w4_duplicate_pairs m1_resource_summary m6_interval_attribution s13_gpu_parse x12_duration_format p3_found f3_fuse_lines x9_token_sequence_similarity".split()
NAMES = sorted(queries.QUERIES) if os.environ.get("ALL_QUERIES") else SOME
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", [n for n in NAMES if n in queries.SQL])
def test_equals_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", [n for n in NAMES if n not in queries.SQL])
def test_rows_only(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0
