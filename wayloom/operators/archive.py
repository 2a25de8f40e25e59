"""Directory, coverage bitmap and lookups of tile archives, as relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import grid

# Fixed values.
FILL_MOST = 8


def directory(tiles: DataFrame, within: list[str] | None = None, length: str = "bytes") -> DataFrame:
    """tiles with id, delta to the id before and offset of the body. within: columns of an archive."""
    keyed = tiles.withColumn("id", grid.tile_id("i", "j"))
    by = Window.partitionBy(*(within or [])).orderBy("id")
    return keyed.withColumns({"delta": F.col("id") - F.coalesce(F.lag("id").over(by), F.lit(0)), "offset": F.coalesce(F.sum(length).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})


def duplicate_ids(tiles: DataFrame, within: list[str] | None = None) -> DataFrame:
    """Tiles listed more than once, which an archive refuses."""
    return tiles.groupBy(*(within or []), "i", "j").count().where("count > 1")


def filled_blocks(cells: DataFrame, within: list[str] | None = None) -> DataFrame:
    """(bi, bj): blocks with a cell, and gaps of up to eight blocks between two of them in a row."""
    within = within or []
    blocks = cells.select(*within, grid.cover_block("i").alias("bi"), grid.cover_block("j").alias("bj")).distinct()
    ahead = F.lead("bj").over(Window.partitionBy(*within, "bi").orderBy("bj"))
    gap = blocks.withColumn("next", ahead).withColumn("gap", F.col("next") - F.col("bj") - 1)
    reach = F.when(F.col("gap").between(1, FILL_MOST), F.col("next") - 1).otherwise(F.col("bj"))
    return gap.select(*within, "bi", F.explode(F.sequence(F.col("bj"), reach)).alias("bj"))


def cover_bytes(cells: DataFrame, within: list[str]) -> DataFrame:
    """Bitmap of each archive: origin, dims, and its bytes as (byte, value), lowest bit first.

    A byte is the sum of its blocks' bits; the writer joins the few bytes of an archive.
    """
    blocks = filled_blocks(cells, within)
    frame = blocks.groupBy(*within).agg(F.min("bi").alias("bi0"), F.min("bj").alias("bj0"), F.max("bi").alias("bi1"), F.max("bj").alias("bj1"))
    placed = blocks.join(frame, within).withColumn("bit", (F.col("bi") - F.col("bi0")) * (F.col("bj1") - F.col("bj0") + 1) + F.col("bj") - F.col("bj0"))
    return placed.groupBy(*within, "bi0", "bj0", "bi1", "bj1", grid.floor_div("bit", 8).alias("byte")).agg(F.sum(F.expr("shiftleft(1, cast(bit % 8 as int))")).alias("value"))


def bounds(tiles: DataFrame, within: list[str] | None = None) -> DataFrame:
    """Bounding box of tiles; zeros if there are none."""
    agg = [F.coalesce(f(c), F.lit(0)).cast("bigint").alias(n) for f, c, n in ((F.min, "i", "min_i"), (F.max, "i", "max_i"), (F.min, "j", "min_j"), (F.max, "j", "max_j"))]
    return (tiles.groupBy(*within) if within else tiles).agg(*agg)


def first_holes(tiles: DataFrame, within: list[str]) -> DataFrame:
    """The first cell, by row then column, of each archive's bounding box that has no tile.

    Found between neighbours of a row and at its ends, so the box is never enumerated.
    """
    frame = bounds(tiles, within)
    rows = tiles.select(*within, "i", "j").distinct()
    ahead = F.lead("j").over(Window.partitionBy(*within, "i").orderBy("j"))
    inner = rows.withColumn("next", ahead).where("next > j + 1").select(*within, "i", (F.col("j") + 1).alias("j"))
    ends = rows.groupBy(*within, "i").agg(F.min("j").alias("lo"), F.max("j").alias("hi")).join(frame, within)
    west = ends.where("lo > min_j").select(*within, "i", F.col("min_j").alias("j"))
    east = ends.where("hi < max_j").select(*within, "i", (F.col("hi") + 1).alias("j"))
    below = F.lead("i").over(Window.partitionBy(*within).orderBy("i"))
    bare = rows.select(*within, "i").distinct().withColumn("next", below).where("next > i + 1").join(frame, within).select(*within, (F.col("i") + 1).alias("i"), F.col("min_j").alias("j"))
    every = inner.unionByName(west).unionByName(east).unionByName(bare)
    return every.groupBy(*within).agg(F.min(F.struct("i", "j")).alias("h")).select(*within, "h.i", "h.j")


def stride_sample(tiles: DataFrame, within: list[str], wanted: int = 512) -> DataFrame:
    """Every n-th tile of an archive by id, from the first, n such that about `wanted` are taken."""
    by = Window.partitionBy(*within)
    numbered = tiles.withColumn("id", grid.tile_id("i", "j")).withColumns({"n": F.row_number().over(by.orderBy("id")) - 1, "count": F.count(F.lit(1)).over(by)})
    stride = F.greatest(F.lit(1), F.floor(F.col("count") / wanted))
    return numbered.where(F.col("n") % stride == 0).drop("n", "count")


def resolve(cells: DataFrame, cover: DataFrame, tiles: DataFrame) -> DataFrame:
    """Each cell's state: tile, hole or uncovered, and the slice that answers.

    Of the slices whose bitmap claims the cell's block, the first by name that lists the
    cell answers; if none does, it is a hole of the first. cells: i, j. cover: slice, bi,
    bj. tiles: slice, i, j and payload.
    """
    keyed = cells.withColumns({"bi": grid.cover_block("i"), "bj": grid.cover_block("j")})
    claimed = keyed.join(cover, ["bi", "bj"], "left")
    listed = claimed.join(tiles.withColumn("listed", F.lit(True)), ["slice", "i", "j"], "left")
    payload = [c for c in tiles.columns if c not in ("slice", "i", "j")]
    first = F.min_by(F.struct("slice", *payload, "listed"), F.struct(F.coalesce(~F.col("listed"), F.lit(True)), "slice"))
    best = listed.groupBy("i", "j").agg(first.alias("r"))
    kind = F.when(F.col("r.slice").isNull(), "uncovered").when(F.col("r.listed"), "tile").otherwise("hole")
    return best.select("i", "j", kind.alias("kind"), "r.slice", *(F.col(f"r.{c}") for c in payload))
