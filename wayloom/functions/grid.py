"""Coordinate grids: tile, spawn, cover, atlas and anchor cells, tile ids, elevation posts.

All take and return columns. Divisions of negative coordinates floor, they never
truncate. Degree arguments are doubles; cells are long.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model.
TILE_DEG = 0.01
SPAWN_DEG = 0.0015
ANCHOR_DEG = 0.5
COVER_BLOCK = 10
ATLAS_BLOCK = 64
BOX_HALF_M = 1200.0
M_PER_DEG = 111320.0
DEM_ROWS = 3600
ID_ROWS, ID_COLS = 9000, 18000
ID_STRIDE = 36001


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def floor_div(x: Column | str, n: int) -> Column:
    """Floor of a whole number divided by n, for either sign."""
    x = _col(x)
    return F.call_function("div", x - F.pmod(x, F.lit(n)), F.lit(n))


def cell(deg: Column | str, size: float) -> Column:
    """Index of the cell that a coordinate lies in: floor of the quotient, as the edges depend on it."""
    return F.floor(_col(deg) / F.lit(size)).cast("bigint")


def tile(deg: Column | str) -> Column:
    return cell(deg, TILE_DEG)


def spawn(deg: Column | str) -> Column:
    return cell(deg, SPAWN_DEG)


def anchor(deg: Column | str) -> Column:
    return cell(deg, ANCHOR_DEG)


def span(index: Column | str) -> tuple[Column, Column]:
    """First spawn cell of a tile row or column, and how many it touches (7 or 8): a tile is 20/3 cells."""
    index = _col(index)
    first = floor_div(index * 20, 3)
    last = -floor_div(-(index + 1) * 20, 3) - 1
    return first, last - first + 1


def tile_id(i: Column | str, j: Column | str) -> Column:
    return (_col(i) + ID_ROWS) * F.lit(ID_STRIDE).cast("bigint") + (_col(j) + ID_COLS)


def cell_of_id(number: Column | str) -> tuple[Column, Column]:
    number = _col(number)
    return floor_div(number, ID_STRIDE) - ID_ROWS, F.pmod(number, F.lit(ID_STRIDE)) - ID_COLS


def cover_block(index: Column | str) -> Column:
    return floor_div(index, COVER_BLOCK)


def atlas_block(index: Column | str) -> Column:
    return floor_div(index, ATLAS_BLOCK)


def post(index: Column | str, width: Column | int) -> Column:
    """Elevation post nearest a spawn cell's centre, for so many posts a degree; halves round up."""
    width = F.lit(width) if isinstance(width, int) else width
    return floor_div((_col(index) * 2 + 1) * 3 * width + 2000, 4000)


def dem_row(ky: Column | str) -> Column:
    """Latitude of the elevation tile holding a row of posts; its north edge belongs to it."""
    return floor_div(_col(ky) - 1, DEM_ROWS)


def dem_name(lat: Column | str, lng: Column | str) -> Column:
    """Name of the elevation tile whose south-west corner is at whole degrees."""
    lat, lng = _col(lat), _col(lng)
    return F.concat(
        F.when(lat >= 0, "N").otherwise("S"), F.lpad(F.abs(lat).cast("string"), 2, "0"), F.lit("_00_"),
        F.when(lng >= 0, "E").otherwise("W"), F.lpad(F.abs(lng).cast("string"), 3, "0"), F.lit("_00"),
    )


def box_degrees(lat: Column | str, radius_m: float = BOX_HALF_M) -> tuple[Column, Column]:
    """Half height and half width in degrees of a square box around a latitude."""
    return F.lit(radius_m / M_PER_DEG), F.lit(radius_m) / (F.lit(M_PER_DEG) * F.cos(F.radians(_col(lat))))


def window_radii(i: Column | str, radius_m: float) -> tuple[Column, Column]:
    """Tile rows and columns that a radius around a tile row's centre reaches, one at least."""
    centre = (_col(i).cast("double") + 0.5) * TILE_DEG
    rows = F.greatest(F.lit(1), F.ceil(F.lit(radius_m / (M_PER_DEG * TILE_DEG))))
    cols = F.greatest(F.lit(1), F.ceil(F.lit(radius_m) / (F.lit(M_PER_DEG * TILE_DEG) * F.cos(F.radians(centre)))))
    return rows.cast("bigint"), cols.cast("bigint")


def row_km2(i: Column | str) -> Column:
    """Area of a tile of a row."""
    side = TILE_DEG * M_PER_DEG / 1000.0
    return F.lit(side * side) * F.cos(F.radians((_col(i).cast("double") + 0.5) * TILE_DEG))


def metres(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Distance on a plane that is true at the first latitude."""
    dy = (lat2 - lat1) * M_PER_DEG
    dx = (lng2 - lng1) * M_PER_DEG * F.cos(F.radians(lat1))
    return F.sqrt(dy * dy + dx * dx)


def cells_near(lat: Column, lng: Column, radius_m: Column | float) -> Column:
    """Array of (i, j) tiles whose centre may be within a radius of a point: candidates for an exact test.

    This turns a distance join into an equality join on the tile.
    """
    radius = F.lit(radius_m) if isinstance(radius_m, (int, float)) else radius_m
    dy = F.ceil(radius / (M_PER_DEG * TILE_DEG)).cast("bigint") + 1
    dx = F.ceil(radius / (F.lit(M_PER_DEG * TILE_DEG) * F.cos(F.radians(F.least(F.lit(89.0), F.abs(lat) + radius / M_PER_DEG))))).cast("bigint") + 1
    rows = F.sequence(tile(lat) - dy, tile(lat) + dy)
    cols = F.sequence(tile(lng) - dx, tile(lng) + dx)
    return F.flatten(F.transform(rows, lambda i: F.transform(cols, lambda j: F.struct(i.alias("i"), j.alias("j")))))


def cells_of_box(lat0: Column, lat1: Column, lng0: Column, lng1: Column, size: float = TILE_DEG) -> Column:
    """Array of (i, j) cells that a box of coordinates touches."""
    rows, cols = F.sequence(cell(lat0, size), cell(lat1, size)), F.sequence(cell(lng0, size), cell(lng1, size))
    return F.flatten(F.transform(rows, lambda i: F.transform(cols, lambda j: F.struct(i.alias("i"), j.alias("j")))))
