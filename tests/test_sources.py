"""Archives, rasters, feature streams, sidecars and atlases: what is written is read back."""

import gzip
import json
import math
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayloom.functions import codec
from wayloom.operators import archive as rel
from wayloom.sources import archive, elevation, features, sinks


def test_directory_and_cover_goldens():
    raw = archive.encode_directory([(archive.tile_id(4236, -7106), 100), (archive.tile_id(4236, -7105), 300), (archive.tile_id(4237, -7106), 5)])
    assert raw.hex() == "03c2bd9ce30101a0990264ac0205"
    assert [(n, at, size) for n, at, size in archive.decode_directory(raw)] == [(476520130, 0, 100), (476520131, 100, 300), (476556131, 400, 5)]
    assert archive.encode_cover([(4236, -7106), (4236, -7066), (4250, -7106)]) == {"origin": [423, -711], "dims": [3, 5], "bits": "HwQ="}
    assert archive.encode_cover([(0, 0), (0, 90)]) == {"origin": [0, 0], "dims": [1, 10], "bits": "/wM="}
    assert archive.encode_cover([(0, 0), (0, 100)]) == {"origin": [0, 0], "dims": [1, 11], "bits": "AQQ="}
    cover = archive.encode_cover([(0, 0), (0, 90)])
    assert archive.cover_has(cover, 5, 45) and not archive.cover_has(cover, 10, 0) and not archive.cover_has(cover, 0, 100)
    for bad in ([(5, 1), (5, 1)], [(0, 1)]):
        with pytest.raises(ValueError):
            archive.encode_directory(bad)


def test_header_rejects_what_it_does_not_know():
    raw = archive.build("s", "v5", [(1, 2, b"x")])
    assert raw[:4] == b"WTA1" and len(raw[:128]) == 128
    for bad in (raw[:100], b"NOPE" + raw[4:], raw[:4] + b"\2" + raw[5:]):
        with pytest.raises(ValueError):
            archive.Head.decode(bad)


def test_archives_round_trip_through_the_data_source(spark, tmp_path):
    rows = [("utah", "v5", i, j, archive.pack(f'{{"i":{i},"j":{j}}}'.encode())) for i in range(10, 40) for j in range(-5, 5) if (i + j) % 3] + [("iowa", "v5", -1, 7, b"plain")]
    tiles = spark.createDataFrame(rows, "slice string, version string, i int, j int, body binary").repartition(4)
    index = archive.write_archives(tiles, str(tmp_path)).collect()
    assert {r.slice: r.tileCount for r in index} == {"utah": len(rows) - 1, "iowa": 1}
    for r in index:
        assert os.path.getsize(r.path) == r.bytes and r.path.endswith(f"{r.slice}-{r.sha256[:12]}.wta")
    again = archive.write_archives(tiles, str(tmp_path)).collect()
    assert sorted(r.sha256 for r in index) == sorted(r.sha256 for r in again)
    assert len(os.listdir(tmp_path / "v5")) == 2
    back = archive.read_archives(spark, str(tmp_path / "v5"), 500)
    assert spark.read.format("wta").load(str(tmp_path / "v5")).count() == len(rows)
    got = {(r.slice, r.i, r.j): bytes(r.body) for r in back.collect()}
    assert got == {(s, i, j): b for s, _, i, j, b in rows}
    assert back.where("i = 12 and slice = 'utah'").count() == sum(1 for r in rows if r[2] == 12)
    assert rel.duplicate_ids(back).count() == 0
    assert archive.first_difference(back.where("slice = 'utah'"), tiles.where("slice = 'utah'")).count() == 0
    utah = next(r for r in index if r.slice == "utah")
    head, meta, entries = archive.read_head(utah.path)
    number, at, size = entries[3]
    assert archive.read_range(utah.path, head.tiles[0] + at, head.tiles[0] + at + size - 1) in [r[4] for r in rows]
    assert list(meta) == ["format", "formatVersion", "slice", "version", "gridDenom", "tileCount", "bbox", "contentType", "contentEncoding"]
    with pytest.raises(OSError):
        archive.read_range(utah.path, utah.bytes - 1, utah.bytes + 5)


def raster(path, values, block=16):
    """A tiny elevation tile of the accepted layout."""
    rows, width = values.shape
    across, down = -(-width // block), -(-rows // block)
    blocks = []
    for by in range(down):
        for bx in range(across):
            part = np.full((block, block), np.nan, np.float32)
            own = values[by * block : (by + 1) * block, bx * block : (bx + 1) * block]
            part[: own.shape[0], : own.shape[1]] = own
            blocks.append(elevation.encode_block(part))
    tags = {256: width, 257: rows, 258: 32, 259: 8, 277: 1, 317: 3, 322: block, 323: block, 339: 3}
    n = len(tags) + 2
    lists = 8 + 2 + 12 * n + 4
    data = lists + 8 * len(blocks)
    offsets = [data + sum(map(len, blocks[:k])) for k in range(len(blocks))]
    entries = sorted([(t, 3, 1, struct.pack("<HH", v, 0)) for t, v in tags.items()] + [(324, 4, len(blocks), struct.pack("<I", lists)), (325, 4, len(blocks), struct.pack("<I", lists + 4 * len(blocks)))])
    out = b"II" + struct.pack("<HI", 42, 8) + struct.pack("<H", n) + b"".join(struct.pack("<HHI", t, k, c) + v for t, k, c, v in entries) + struct.pack("<I", 0)
    out += struct.pack(f"<{len(blocks)}I", *offsets) + struct.pack(f"<{len(blocks)}I", *map(len, blocks)) + b"".join(blocks)
    path.write_bytes(out)


def test_elevation_blocks_are_pruned_and_decoded(spark, tmp_path):
    rows = 48
    values = np.random.default_rng(1).normal(500, 200, (rows, rows)).astype(np.float32)
    values[3, 4] = np.nan
    raster(tmp_path / "N42_00_W072_00.tif", values)
    spark.dataSource.register(elevation.ElevationSource)
    box = {"south": 42.0, "north": 43.0, "west": -72.0, "east": -71.0001, "rows": rows}
    got = {(r.kx, r.ky): r.e for r in spark.read.format("dem").options(**box).load(str(tmp_path)).collect()}
    for y in range(rows):
        for x in range(rows):
            e = got[(-72 * rows + x, 43 * rows - y)]
            assert (e is None and math.isnan(values[y, x])) or np.float32(e) == values[y, x]
    small = dict(box, south=42.9, north=42.95, west=-71.9, east=-71.85)
    few = spark.read.format("dem").options(**small).load(str(tmp_path))
    assert 0 < few.count() < 40
    assert spark.read.format("dem").options(**dict(box, south=10.0, north=11.0)).load(str(tmp_path)).count() == 0
    raw = (tmp_path / "N42_00_W072_00.tif").read_bytes()
    for bad in (b"MM" + raw[2:], raw[:2] + b"\x2b\0" + raw[4:]):
        with pytest.raises(ValueError):
            elevation.parse_header(bad, rows)
    with pytest.raises(ValueError):
        elevation.parse_header(raw)  # not 3600 rows


LINES = [
    {"type": "Feature", "id": "w1", "properties": {"highway": "footway", "name": "River Path", "lit": "yes"}, "geometry": {"type": "LineString", "coordinates": [[-71.06, 42.36], [-71.061, 42.361]]}},
    {"type": "Feature", "id": "n9", "properties": {"highway": "crossing"}, "geometry": {"type": "Point", "coordinates": [-71.0595, 42.3595]}},
    {"type": "Feature", "id": "a4", "properties": {"leisure": "park", "name": "Common"}, "geometry": {"type": "Polygon", "coordinates": [[[-71.07, 42.35], [-71.05, 42.35], [-71.05, 42.37], [-71.07, 42.37], [-71.07, 42.35]]]}},
]


def write_features(path):
    path.write_text("".join("\x1e" + json.dumps(x) + "\n" for x in LINES) + "not json\n")
    return str(path)


def test_feature_stream(spark, tmp_path):
    got = {r.id: r for r in features.features(spark, write_features(tmp_path / "f.geojsonl")).collect()}
    assert set(got) == {"w1", "n9", "a4"}
    assert got["w1"].object == "w" and got["w1"].tags["highway"] == "footway" and got["w1"].line[0].lat == 42.36
    assert got["n9"].point.lng == -71.0595 and got["n9"].line is None
    assert [len(r) for r in got["a4"].polygons[0]] == [4]


def test_boundaries(spark, tmp_path):
    (tmp_path / "utah.poly").write_text("utah\n1\n 0 0\n 1 0\n 1 1\n 0 0\nEND\n!2\n 0.2 0.2\n 0.3 0.2\n 0.3 0.3\nEND\nEND\n")
    row = features.boundaries(spark, str(tmp_path / "*.poly")).first()
    assert row.slice == "utah" and [r.hole for r in row.rings] == [False, True] and len(row.rings[0].ring) == 3
    assert row.rings[0].ring[1].lng == 1.0 and row.rings[0].ring[1].lat == 0.0


def test_registry_and_catalogue(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"features": [{"properties": {"id": "us", "urls": {"pbf": "u"}}}, {"properties": {"id": "us/ut", "parent": "us", "urls": {"pbf": "v"}}}, {"properties": {"id": "x"}}]}, indent=1))
    (tmp_path / "s.json").write_text(json.dumps([{"name": "utah", "url": "u", "day": 7}], indent=1))
    assert {r.id for r in features.catalogue(spark, str(tmp_path / "c.json")).collect()} == {"us", "us/ut"}
    assert features.registry(spark, str(tmp_path / "s.json")).first().day == 7


def test_tile_tree_and_payloads(spark, tmp_path):
    for i, j, raw in ((4236, -7106, gzip.compress(b'{"v":4}')), (1, 2, b'{"v":5}')):
        (tmp_path / "v5" / str(i)).mkdir(parents=True)
        (tmp_path / "v5" / str(i) / f"{j}.json.gz").write_bytes(raw)
    got = {(r.i, r.j): r.body for r in features.payloads(features.tile_tree(spark, str(tmp_path / "v5"))).collect()}
    assert got == {(4236, -7106): '{"v":4}', (1, 2): '{"v":5}'}


def test_sidecars_and_atlas_round_trip(spark, tmp_path):
    cells = spark.createDataFrame([(-5, 3, 90 << 8 | 15 << 24 | 511 << 36), (7, 2, 511 << 36), (64, 2, 91 << 8 | 511 << 36)], "cx long, cy long, record long")
    side = sinks.habitat_sidecar(cells)
    side.coalesce(1).write.json(str(tmp_path / "h"))
    back = features.habitat_sidecar(spark, str(tmp_path / "h")).collect()
    assert [(r.cx, r.cy) for r in side.collect()] == [(64, 2), (-5, 3)] and len(back) == 2
    blocks = spark.createDataFrame([(-1, 0, 85), (2, 0, 64), (0, 3, 1)], "bx long, by long, mask int")
    row = sinks.atlas(blocks, "utah")
    assert row.first().blocks[:2] == "BV" and len(row.first().blocks) == 2 * 4 * 4
    row.coalesce(1).write.json(str(tmp_path / "a"))
    got = {(r.bx, r.by): r["mask"] for r in features.atlas(spark, str(tmp_path / "a")).collect()}
    assert got == {(-1, 0): 85, (2, 0): 64, (0, 3): 1}
    assert codec.DISPLAY_ORDER[0] == "mountain"
    anchors = spark.createDataFrame([("b", "peak", 1.0, 2.0, 9, "x"), ("a", "park", 1.0, 2.0, 9, "y")], "key string, kind string, lat double, lng double, ele int, name string")
    assert [(r.key, r.ele) for r in sinks.anchor_sidecar(anchors).collect()] == [("a", None), ("b", 9)]
    tiles = spark.createDataFrame([("utah", "v4", b"ab"), ("utah", "v5", b"abc")], "slice string, version string, body binary")
    stamp = sinks.build_stamp(tiles, {"pack": 3, "publish": 4}).first()
    assert stamp["name"] == "utah" and stamp.versions["v5"].bytes == 3 and stamp.seconds == 7

