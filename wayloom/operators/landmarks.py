"""Ranking of landmarks inside tiles and of anchors inside slices."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import grid

# Fixed values.
PER_TILE, SETTLEMENTS_PER_TILE = 6, 2
DENSITY_PER_KM2 = 15 / (math.pi * 100**2)
LEAST_SIGNIFICANCE = 0.0


def largest_of_name(listings: DataFrame, within: list[str], area: str = "area", key: str = "key") -> DataFrame:
    """One listing for each kind and name: the largest, ties by the least key."""
    best = F.max_by(F.struct(*[c for c in listings.columns if c not in (*within, "kind", "name")]), F.struct(F.col(area), F.lit(0)))
    if key not in listings.columns:
        return listings.groupBy(*within, "kind", "name").agg(best.alias("b")).select(*within, "kind", "name", "b.*")
    order = Window.partitionBy(*within, "kind", "name").orderBy(F.col(area).desc(), F.col(key))
    return listings.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def top_of_tile(listings: DataFrame) -> DataFrame:
    """At most six listings of a tile, two of them settlements. listings: i, j, anchor, tier, area, distance, name.

    Two ranked passes: settlements past the second go first, then the rest is cut. Both
    filters sit on row_number, so Spark keeps only the best rows of a tile before the shuffle.
    """
    order = [F.col("anchor").desc(), F.col("tier"), F.col("area").desc(), F.col("distance"), F.col("name")]
    tile = ["i", "j"]
    few = listings.where("tier <= 1").withColumn("_s", F.row_number().over(Window.partitionBy(*tile).orderBy(*order))).where(f"_s <= {SETTLEMENTS_PER_TILE}").drop("_s")
    rest = listings.where("tier > 1").unionByName(few)
    return rest.withColumn("rank", F.row_number().over(Window.partitionBy(*tile).orderBy(*order))).where(f"rank <= {PER_TILE}")


def anchor_cap(area_km2: float) -> int:
    """How many anchors a slice of so many square kilometres gets: one at least."""
    return max(1, math.floor(DENSITY_PER_KM2 * area_km2 + 0.5))


def ranked_candidates(candidates: DataFrame) -> DataFrame:
    """Every candidate with its group, half-degree cell and place in that cell, those under the least significance too: what the choice is made from."""
    order = [F.col("np").desc(), F.col("sig").desc(), F.col("key")]
    placed = _grouped(candidates).withColumn("place", F.row_number().over(Window.partitionBy("slice", "grp", "ai", "aj").orderBy(*order)))
    return placed.withColumn("above", F.col("sig") >= LEAST_SIGNIFICANCE)


def _grouped(candidates: DataFrame) -> DataFrame:
    return candidates.withColumns({"grp": F.when(F.col("kind") == "peak", "peak").otherwise("areal"), "ai": grid.anchor("lat"), "aj": grid.anchor("lng"), "np": (F.col("kind") == "national_park").cast("int")})


def select_anchors(candidates: DataFrame, caps: DataFrame) -> DataFrame:
    """The anchors of each slice: the best of each group and half-degree cell, national parks first, up to the slice's cap.

    As a taken cell costs nothing of the cap, the greedy choice is the first row of each
    cell followed by the first rows of the slice. candidates: slice, kind, lat, lng, sig,
    key. caps: slice, cap.
    """
    ranked = _grouped(candidates.where(f"sig >= {LEAST_SIGNIFICANCE}"))
    order = [F.col("np").desc(), F.col("sig").desc(), F.col("key")]
    seats = ranked.withColumn("_c", F.row_number().over(Window.partitionBy("slice", "grp", "ai", "aj").orderBy(*order))).where("_c = 1")
    placed = seats.withColumn("seat", F.row_number().over(Window.partitionBy("slice").orderBy(*order)))
    return placed.join(caps, "slice").where("seat <= cap").drop("_c", "cap")


def flag_anchors(listings: DataFrame, anchors: DataFrame, key: str = "key") -> DataFrame:
    """listings with anchor: true where the landmark's key is in the anchor set, null elsewhere."""
    marked = anchors.select(key).distinct().withColumn("anchor", F.lit(True))
    return listings.drop("anchor").join(marked, key, "left")


def anchor_mismatch(listings: DataFrame, anchors: DataFrame, key: str = "key") -> DataFrame:
    """(key, side): anchors that no tile flags, and flags without an anchor."""
    flagged = listings.where("anchor").select(key).distinct()
    own = anchors.select(key).distinct()
    return own.join(flagged, key, "left_anti").withColumn("side", F.lit("unflagged")).unionByName(flagged.join(own, key, "left_anti").withColumn("side", F.lit("unranked")))
