"""Queries take whole tables, and their results show it."""

import os

import pytest
from pyspark.sql import functions as F

from wayloom.functions import grid, tags
from wayloom.operators import spatial
from wayloom.plans import catalogue
from wayloom.plans import fixtures as fx

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")


def test_no_length_is_lost(spark):
    got = catalogue.QUERIES["way_length_by_cell"](spark, SF).agg(F.sum("metres")).first()[0]
    kinds = {r.way_id for r in fx.way(spark, SF).where(tags.habitat_group(F.col("highway")).isNotNull()).collect()}
    v = fx.vertex(spark, SF).where(F.col("way_id").isin(kinds))
    a, b = v.alias("a"), v.alias("b")
    both = a.join(b, (F.col("a.way_id") == F.col("b.way_id")) & (F.col("b.n") == F.col("a.n") + 1))
    want = both.agg(F.sum(grid.metres(F.col("a.lat"), F.col("a.lng"), F.col("b.lat"), F.col("b.lng")))).first()[0]
    assert abs(got - want) < 1e-3 * 20000


def test_every_row_is_handled(spark):
    sf = "/root/testdata/sf0.01"
    n = fx.table(spark, sf, "customer").count()
    assert catalogue.QUERIES["slug_suffix"](spark, sf).count() == n
    assert catalogue.QUERIES["retention_two"](spark, sf).count() == n
    tiles = fx.tile(spark, sf)
    blocks = tiles.select("part", F.floor(F.col("i") * 13 / 10).alias("bi"), F.floor(F.col("j") * 7 / 10).alias("bj")).distinct()
    filled = catalogue.QUERIES["cover_gap_fill"](spark, sf)
    assert blocks.join(filled, ["part", "bi", "bj"], "left_anti").isEmpty()
    # Blocks of gaps have no tile of their own.
    assert filled.count() > blocks.count()


def test_nearest_blocks_are_found_however_far(spark):
    targets = [(0, 0), (3, -5), (-700, 40), (900, 900)]
    blocks = [("a", 100, 0), ("a", -70, 0), ("b", 1200, -300), ("c", 64, 64), ("c", -65, 1)]
    found = spatial.nearest_by_rings(spark.createDataFrame(targets, "bx long, by long"), spark.createDataFrame(blocks, "class string, bx long, by long"))
    got = {(r.bx, r.by, r["class"]): (r.distance, r.x, r.y) for r in found.collect()}
    want = {(x, y, k): min((max(abs(a - x), abs(b - y)), a, b) for kind, a, b in blocks if kind == k) for x, y in targets for k in "abc"}
    assert got == want
