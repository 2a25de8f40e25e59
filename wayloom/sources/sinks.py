"""Writers of tiles, manifests, sidecars, atlases and build stamps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codec, grid
from .archive import pack

#: Keys of a tile in the order they are written, by version.
TILE_KEYS = {
    "v4": ["v", "ways", "names", "crossings"],
    "v5": ["v", "ways", "names", "crossings", "landcover", "landmarks", "habitat", "hazards"],
    "v5c": ["v", "landcover"],
}
TILE_VERSIONS = {"v4": 4, "v5": 5, "v5c": 1}


def tile_json(tiles: DataFrame, version: str) -> Column:
    """Canonical JSON of a tile: its keys in document order, missing values left out."""
    present = [F.lit(TILE_VERSIONS[version]).alias("v"), *(F.col(k) for k in TILE_KEYS[version][1:] if k in tiles.columns)]
    return F.to_json(F.struct(*present))


def tile_bodies(tiles: DataFrame, version: str) -> DataFrame:
    """(slice, version, i, j, sha, body): packed tiles with the digest of their JSON before packing."""
    rows = tiles.select("slice", F.lit(version).alias("version"), "i", "j", tile_json(tiles, version).alias("json"))
    rows = rows.withColumn("sha", F.sha2("json", 256)).select("slice", "version", "i", "j", "sha", F.col("json").alias("body"))
    schema = ", ".join(f"{f.name} {'binary' if f.name == 'body' else f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_pack_bodies, schema)


def _pack_bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.names.index("body")
        yield batch.set_column(at, "body", pa.array([pack(x.encode()) for x in batch.column(at).to_pylist()], pa.binary()))


def habitat_sidecar(cells: DataFrame) -> DataFrame:
    """Rows of a habitat sidecar: cells with a walkable way, by row, then column. cells: cx, cy, record."""
    total = codec.field("record", "res") + codec.field("record", "foot") + codec.field("record", "road")
    rows = cells.where(total > 0).select("cx", "cy", codec.to_chars("record").alias("f"), codec.classes(codec.classify("record")).alias("classes"))
    return rows.orderBy("cy", "cx")


def anchor_candidates(ranked: DataFrame) -> DataFrame:
    """Rows of a dump of all anchor candidates, before any is cut: to be written beside the sidecar."""
    return ranked.select("slice", "key", "kind", "lat", "lng", "sig", F.col("grp").alias("group"), "ai", "aj", "place", "above").orderBy("slice", F.col("sig").desc(), "key")


def anchor_sidecar(anchors: DataFrame) -> DataFrame:
    """Rows of an anchor sidecar by key; only peaks have an elevation."""
    return anchors.select("key", "kind", "lat", "lng", F.when(F.col("kind") == "peak", F.col("ele")).alias("ele"), "name").orderBy("key")


def atlas(blocks: DataFrame, slice_name: str) -> DataFrame:
    """One row: the raster of a slice's block masks as text, south to north, west to east. blocks: bx, by, mask.

    Only blocks with a mask are shuffled; each row of the raster is put together with its
    empty slots, then the rows.
    """
    frame = blocks.agg(F.min("bx").alias("x0"), F.max("bx").alias("x1"), F.min("by").alias("y0"), F.max("by").alias("y1"))
    lines = blocks.groupBy("by").agg(F.map_from_entries(F.collect_list(F.struct("bx", codec.chars_of_mask("mask")))).alias("m"))
    every = frame.select("*", F.explode(F.sequence("y0", "y1")).alias("by")).join(lines, "by", "left")
    text = F.array_join(F.transform(F.sequence("x0", "x1"), lambda x: F.coalesce(F.try_element_at("m", x), F.lit("AA"))), "")
    joined = every.select("x0", "x1", "y0", "y1", F.struct("by", text.alias("t")).alias("line"))
    whole = joined.groupBy("x0", "x1", "y0", "y1").agg(F.array_join(F.transform(F.sort_array(F.collect_list("line")), lambda r: r["t"]), "").alias("blocks"))
    return whole.select(
        F.lit(2).alias("v"), F.lit(slice_name).alias("slice"), F.lit(grid.SPAWN_DEG).alias("cellDeg"), F.lit(grid.ATLAS_BLOCK).alias("blockCells"), F.lit(2).alias("blockChars"), F.col("x0").alias("bx0"), F.col("y0").alias("by0"),
        (F.col("x1") - F.col("x0") + 1).cast("int").alias("cols"), (F.col("y1") - F.col("y0") + 1).cast("int").alias("rows"), F.array(*(F.lit(c) for c in codec.CLASS_BITS)).alias("classes"), "blocks",
    )


def build_stamp(tiles: DataFrame, phases: dict[str, int]) -> DataFrame:
    """One row for each slice: tiles and bytes of each version, and the seconds of each phase. tiles: slice, version, body."""
    sizes = tiles.groupBy("slice", "version").agg(F.count(F.lit(1)).alias("tiles"), F.sum(F.octet_length("body")).alias("bytes"))
    spent = F.create_map(*(F.lit(x) for k, v in phases.items() for x in (k, v))) if phases else F.create_map().cast("map<string,int>")
    return sizes.groupBy(F.col("slice").alias("name")).agg(F.map_from_entries(F.collect_list(F.struct("version", F.struct("tiles", "bytes")))).alias("versions")).withColumns(
        {"bakedAt": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"), "removed": F.lit(0), "phases": spent, "seconds": F.lit(sum(phases.values())).cast("bigint")}
    )
