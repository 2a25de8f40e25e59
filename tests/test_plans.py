"""Shapes of physical plans: pruned scans, no nested loops over data, limits before shuffles."""

import os

import pytest
from pyspark.sql import functions as F

from wayloom.operators import spatial
from wayloom.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")
#: Their nested loops join one row, nine offsets or seven classes.
TINY = {"label_share", "rarest_class", "atlas_block", "point_in_ring", "nearest_class_block", "coarse_density", "view_percentiles"}


def plan(spark, name):
    return catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - TINY))
def test_no_nested_loops_and_no_row_functions(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "BatchEvalPython" not in text


def test_scans_are_pruned(spark):
    text = plan(spark, "tag_filter")
    assert "ReadSchema: struct<o_orderkey:bigint>" in text
    text = plan(spark, "way_tile_binning")
    assert "l_orderkey" in text and "l_extendedprice" not in text


def test_ranks_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(spark, "tile_top6")


def test_sums_are_combined_before_the_shuffle(spark):
    for name in ("window_sum", "cover_mask", "thin_blocks", "atlas_mask"):
        assert "partial_" in plan(spark, name)


def test_areas_are_neither_broadcast_nor_shuffled_by_cell(spark):
    """However small the file of the areas, masks are combined before anything is joined."""
    cells = spark.range(10).selectExpr("id as cx", "id as cy")
    areas = spark.range(3).select(F.lit("wood").alias("kind"), F.array(F.array(*(F.struct(F.lit(a).alias("lat"), F.lit(b).alias("lng")) for a, b in [(0.0, 0.0), (0.0, 0.01), (0.01, 0.01), (0.01, 0.0)]))).alias("rings"), *(F.lit(v).alias(c) for c, v in {"lat0": 0.0, "lat1": 0.01, "lng0": 0.0, "lng1": 0.01}.items()))
    got = spatial.cover_masks(cells, areas)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < text.index("Join ") < text.index("bit_or(") < text.index("Generate ")
    assert {(r.cx, r.cy, r.mask) for r in got.collect()} == {(k, k, 15) for k in range(6)} | {(6, 6, 1)}
