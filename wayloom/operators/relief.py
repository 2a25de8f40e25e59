"""Elevation sampling and sliding relief over spawn cells."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import grid

# Fixed values.
RELIEF_RADIUS_M = 5000.0
PEAK_RADIUS_M = 8000.0
#: Cells along a block's side: with a 5 km disc, a block sees some 1.8 times its own cells.
BLOCK = 256


def disc(radius_m: float, lat: float, size: float = grid.SPAWN_DEG) -> list[tuple[int, int]]:
    """(dy, half width in cells) of each row of a disc around a cell at a latitude; rows beyond it are left out."""
    ns, ew = size * grid.M_PER_DEG, size * grid.M_PER_DEG * math.cos(math.radians(lat))
    out = []
    for dy in range(-math.ceil(radius_m / ns), math.ceil(radius_m / ns) + 1):
        rest = radius_m**2 - (dy * ns) ** 2
        if rest >= 0:
            out.append((dy, math.floor(math.sqrt(rest) / ew)))
    return out


def slide(grid_: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Extreme of every `width` neighbours along rows, by doubling the span."""
    out, span = grid_, 1
    while span * 2 <= width:
        out = best(out[:, :-span], out[:, span:])
        span *= 2
    return best(out[:, : out.shape[1] - (width - span)], out[:, width - span :]) if span < width else out


def relief(cells: DataFrame, radius_m: float = RELIEF_RADIUS_M, lat: float | None = None, value: str = "e") -> DataFrame:
    """(cx, cy, relief): highest less lowest value in the disc around each measured cell; unmeasured cells count for nothing.

    The plane is cut into blocks of BLOCK x BLOCK cells; each block also gets the cells
    around it that its discs reach, so a group has a fixed size whatever the slice. In a
    block the disc is a stack of row ranges: for each distinct width one sliding pass,
    then one comparison for each row. lat: of the whole slice, as the disc is one for all.
    """
    rows = disc(radius_m, lat if lat is not None else 0.0)
    rx, ry = max(h for _, h in rows), max(abs(dy) for dy, _ in rows)
    known = cells.where(F.col(value).isNotNull()).select("cx", "cy", F.col(value).cast("double").alias("v"))
    reach = lambda c, r: F.sequence(grid.floor_div(F.col(c) - r, BLOCK), grid.floor_div(F.col(c) + r, BLOCK))
    dealt = known.select("*", F.explode(reach("cx", rx)).alias("bx")).select("*", F.explode(reach("cy", ry)).alias("by"))

    def run(key, table):
        x0, y0 = key[0].as_py() * BLOCK, key[1].as_py() * BLOCK
        cx, cy, v = (table[k].to_numpy() for k in ("cx", "cy", "v"))
        x, y = cx - x0 + rx, cy - y0 + ry
        ends = []
        for best, none in ((np.maximum, -np.inf), (np.minimum, np.inf)):
            plane = np.full((BLOCK + 2 * ry, BLOCK + 2 * rx), none)
            plane[y, x] = v
            out = np.full((BLOCK, BLOCK), none)
            for half in {h for _, h in rows}:
                line = slide(plane, 2 * half + 1, best)[:, rx - half : rx - half + BLOCK]
                for dy in (d for d, h in rows if h == half):
                    best(out, line[ry + dy : ry + dy + BLOCK], out=out)
            ends.append(out)
        own = (x >= rx) & (x < rx + BLOCK) & (y >= ry) & (y < ry + BLOCK)
        at = (y[own] - ry, x[own] - rx)
        return pa.table({"cx": cx[own], "cy": cy[own], "relief": ends[0][at] - ends[1][at]})

    found = dealt.groupBy("bx", "by").applyInArrow(run, "cx bigint, cy bigint, relief double")
    return found.select("cx", "cy", F.col("relief").cast(cells.schema[value].dataType).alias("relief"))


def drops(peaks: DataFrame, posts: DataFrame, radius_m: float = PEAK_RADIUS_M, lat: float = 0.0, size: float = grid.SPAWN_DEG) -> DataFrame:
    """peaks with drop: own height less the lowest in the disc; null where its own post is unmeasured.

    peaks: peak, cx, cy. posts: cx, cy, e. A peak is exploded to the rows of its disc,
    and joined on row and column group, so no cell meets more posts than its window.
    """
    rows = disc(radius_m, lat, size)
    span = max(1, 2 * max(h for _, h in rows))
    reach = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(h).alias("h")) for dy, h in rows))
    wide = peaks.select("peak", F.col("cx").alias("x"), F.col("cy").alias("y"), F.explode(reach).alias("r")).withColumn("row", F.col("y") + F.col("r.dy"))
    group = lambda c: grid.floor_div(c, span)
    wide = wide.select("*", F.explode(F.sequence(group(F.col("x") - F.col("r.h")), group(F.col("x") + F.col("r.h")))).alias("g"))
    known = posts.where("e is not null").select(F.col("cx").alias("px"), F.col("cy").alias("row"), "e").withColumn("g", group("px"))
    low = wide.join(known, ["row", "g"]).where(F.abs(F.col("px") - F.col("x")) <= F.col("r.h")).groupBy("peak").agg(F.min("e").alias("low"))
    own = peaks.join(posts.select("cx", "cy", "e"), ["cx", "cy"], "left")
    return own.join(low, "peak", "left").withColumn("drop", F.col("e") - F.col("low")).drop("low")


def one_width(headers: DataFrame) -> DataFrame:
    """(tile_lat, width) of latitude bands whose tiles all have one width; a band that mixes them is an error."""
    ends = headers.groupBy("tile_lat").agg(F.min("width").alias("width"), F.max("width").alias("most"))
    mixed = F.raise_error(F.concat(F.lit("elevation: tiles of latitude "), F.col("tile_lat").cast("string"), F.lit(" differ in width")))
    return ends.select("tile_lat", F.when(F.col("width") == F.col("most"), F.col("width")).otherwise(mixed.cast("int")).alias("width"))


def nearest_post(cells: DataFrame, posts: DataFrame, width: int) -> DataFrame:
    """cells with the elevation of the post nearest their centre, null if it isn't published. posts: kx, ky, e."""
    keyed = cells.withColumns({"kx": grid.post("cx", width), "ky": grid.post("cy", grid.DEM_ROWS)})
    return keyed.join(posts, ["kx", "ky"], "left")


def band_width(headers: DataFrame) -> DataFrame:
    """(tile_lat, width): columns a degree of a latitude band, as its westernmost published tile has them."""
    return headers.groupBy("tile_lat").agg(F.min_by("width", "tile_lng").alias("width"))


def window_sum(cells: DataFrame, radii: list[tuple[int, int]], value: str = "bytes") -> DataFrame:
    """(i, j, ri, rj, total): sum of the values within ri rows and rj columns of every cell, for each pair of radii.

    First the rows that a cell reaches are summed (a map-side combined shuffle), then
    one window slides along each row.
    """
    out = None
    for ri, rj in radii:
        spread = cells.select(F.explode(F.sequence(F.col("i") - ri, F.col("i") + ri)).alias("i"), "j", F.col(value).cast("bigint").alias("v"))
        every = spread.unionByName(cells.select("i", "j", F.lit(0).cast("bigint").alias("v"))).groupBy("i", "j").agg(F.sum("v").alias("v"))
        slid = every.withColumn("total", F.sum("v").over(Window.partitionBy("i").orderBy("j").rangeBetween(-rj, rj)))
        part = cells.select("i", "j").join(slid, ["i", "j"]).select("i", "j", F.lit(ri).alias("ri"), F.lit(rj).alias("rj"), "total")
        out = part if out is None else out.unionByName(part)
    return out
