"""Readers of feature streams, boundaries, registries, sidecars, atlases and tile trees."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codec, tags, text
from ..functions.geometry import RING

FEATURE = "type string, id string, properties map<string,string>, geometry struct<type:string,coordinates:string>"
HABITAT = "cx long, cy long, f string, classes array<string>"
ANCHOR = "key string, kind string, lat double, lng double, ele int, name string"
ATLAS = "v int, slice string, cellDeg double, blockCells int, blockChars int, bx0 long, by0 long, cols int, rows int, classes array<string>, blocks string"
CATALOGUE = "features array<struct<properties:struct<id:string,parent:string,urls:struct<pbf:string>>>>"
INDEX = "slice string, version string, path string, bytes long, sha256 string, tileCount int, tileBytes long, grid int, bbox array<int>, dir array<long>, dirBytesRaw long, tileData array<long>, coverBlock int, cover struct<origin:array<int>,dims:array<int>,bits:string>"


def _point(pair: Column) -> Column:
    return F.struct(F.get(pair, F.lit(1)).alias("lat"), F.get(pair, F.lit(0)).alias("lng"))


def _open(ring: Column) -> Column:
    """A ring without the repeat of its first point."""
    closed = (F.size(ring) > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1))
    return F.when(closed, F.slice(ring, 1, F.size(ring) - 1)).otherwise(ring)


def features(spark: SparkSession, path: str) -> DataFrame:
    """(id, object, tags, point, line, polygons) of a stream of one feature a line, record separators allowed.

    object: n, w or a, from the id. Coordinates come as longitude, latitude; polygons are
    lists of open rings, the outer one first. Malformed lines are left out.
    """
    lines = spark.read.text(path).select(F.from_json(F.regexp_replace("value", "^\\x1e", ""), FEATURE).alias("f")).where("f.id is not null").select("f.*")
    kind, raw = F.col("geometry.type"), F.col("geometry.coordinates")
    rings = F.when(kind == "Polygon", F.array(F.from_json(raw, "array<array<array<double>>>"))).when(kind == "MultiPolygon", F.from_json(raw, "array<array<array<array<double>>>>"))
    return lines.select(
        "id",
        F.substring("id", 1, 1).alias("object"),
        F.col("properties").alias("tags"),
        F.when(kind == "Point", _point(F.from_json(raw, "array<double>"))).alias("point"),
        F.when(kind == "LineString", F.transform(F.from_json(raw, "array<array<double>>"), _point)).alias("line"),
        F.transform(rings, lambda p: F.transform(p, lambda r: _open(F.transform(r, _point)))).alias("polygons"),
    )


def selected(rows: DataFrame) -> DataFrame:
    """Features that any layer uses, so that nothing else is read further."""
    return rows.where(tags.selected(F.col("object"), lambda k: F.col("tags")[k]))


def parse_boundary(body: str) -> list[dict]:
    """Rings of a boundary file: sections of longitude and latitude, a name beginning with ! being a hole."""
    out, ring, hole = [], None, False
    for line in body.splitlines()[1:]:
        line = line.strip()
        if not line:
            continue
        if line == "END":
            if ring is not None:
                points = ring[:-1] if len(ring) > 1 and ring[0] == ring[-1] else ring
                out.append({"hole": hole, "ring": [{"lat": a, "lng": b} for a, b in points]})
            ring = None
        elif ring is None:
            ring, hole = [], line.startswith("!")
        else:
            lng, lat = line.split()[:2]
            ring.append((float(lat), float(lng)))
    return out


RINGS = T.ArrayType(T.StructType([T.StructField("hole", T.BooleanType()), T.StructField("ring", RING)]))


@F.arrow_udf(RINGS)
def rings(bodies: pa.Array) -> pa.Array:
    """Arrow function: rings of the text of boundary files."""
    kind = pa.list_(pa.struct([("hole", pa.bool_()), ("ring", pa.list_(pa.struct([("lat", pa.float64()), ("lng", pa.float64())])))]))
    return pa.array([parse_boundary(x or "") for x in bodies.to_pylist()], kind)


def boundaries(spark: SparkSession, path: str) -> DataFrame:
    """(slice, rings) of boundary files named after their slice. A slice without a file owns all it is given."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.poly$", 1).alias("slice"), rings("value").alias("rings"))


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(id, parent, url) of the extracts of a catalogue that can be downloaded."""
    rows = spark.read.schema(CATALOGUE).option("multiLine", True).json(path).select(F.explode("features.properties").alias("p"))
    return rows.select("p.id", "p.parent", F.col("p.urls.pbf").alias("url")).where("id is not null and url is not null")


def registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, url string, day int").option("multiLine", True).json(path)


def habitat_sidecar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HABITAT).json(path)


def anchor_sidecar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANCHOR).json(path)


def archive_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).option("multiLine", True).json(path)


def atlas(spark: SparkSession, path: str) -> DataFrame:
    """(slice, bx, by, mask) of the blocks of atlases that hold anything; one or two characters a block."""
    raw = spark.read.schema(ATLAS).option("multiLine", True).json(path).withColumn("width", F.coalesce("blockChars", F.lit(1)))
    slots = raw.select("slice", "bx0", "by0", "cols", "width", "blocks", F.explode(F.sequence(F.lit(0), F.col("cols") * F.col("rows") - 1)).alias("k"))
    code = F.substring(F.col("blocks"), F.col("k") * F.col("width") + 1, F.col("width"))
    mask = F.when(F.col("width") == 2, codec.mask_of_chars(code, 2)).otherwise(codec.mask_of_chars(code, 1))
    cells = slots.select("slice", (F.col("bx0") + F.col("k") % F.col("cols")).alias("bx"), (F.col("by0") + F.call_function("div", F.col("k"), F.col("cols"))).alias("by"), mask.alias("mask"))
    return cells.where("mask > 0")


def unpack_json(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bodies as text: unzipped where they begin like gzip, as they are elsewhere."""
    for batch in batches:
        at = batch.schema.names.index("body")
        body = [None if x is None else (gzip.decompress(x) if x[:2] == b"\x1f\x8b" else x).decode() for x in batch.column(at).to_pylist()]
        yield batch.set_column(at, "body", pa.array(body, pa.string()))


def payloads(bodies: DataFrame) -> DataFrame:
    """bodies with a binary `body` column turned into JSON text."""
    schema = ", ".join(f"`{f.name}` {'string' if f.name == 'body' else f.dataType.simpleString()}" for f in bodies.schema)
    return bodies.mapInArrow(unpack_json, schema)


def tile_tree(spark: SparkSession, root: str) -> DataFrame:
    """(i, j, bytes, body) of a tree of tile files, body still packed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json.gz").load(root)
    i, j = text.tile_path_cell("path")
    return files.select(i.alias("i"), j.alias("j"), F.col("length").alias("bytes"), F.col("content").alias("body")).where("i is not null")
