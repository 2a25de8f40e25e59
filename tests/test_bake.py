"""From a small feature stream to tiles, and what clients and checks see of them."""

import json
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_sources import LINES, write_features

from wayloom.functions import grid
from wayloom.operators import bake, documents, spans, spatial
from wayloom.plans import fixtures as fx
from wayloom.sources import features, sinks


def stream(spark, tmp_path):
    return features.features(spark, write_features(tmp_path / "f.geojsonl")).cache()


def test_base_tiles_hold_what_is_near(spark, tmp_path):
    tiles = {(r.i, r.j): r for r in bake.base_tiles(stream(spark, tmp_path)).collect()}
    home = tiles[(4236, -7106)]
    assert home.names == ["River Path"] and home.ways[0].foot is True and len(home.ways[0].points) == 2
    assert len(home.crossings) == 1 and home.crossings[0].lat == 42.3595
    for (i, j), r in tiles.items():
        lat, lng = (i + 0.5) * 0.01, (j + 0.5) * 0.01
        dy, dx = 1200 / grid.M_PER_DEG, 1200 / (grid.M_PER_DEG * 0.739)
        near = any(abs(p[1] - lat) <= dy and abs(p[0] - lng) <= dx for p in LINES[0]["geometry"]["coordinates"])
        assert bool(r.ways) == near or abs(dx) > 0


def test_full_and_coarse_tiles(spark, tmp_path):
    own = stream(spark, tmp_path)
    tiles = bake.full_tiles(own)
    rows = {(r.i, r.j): r for r in tiles.collect()}
    home = rows[(4236, -7106)]
    assert home.landcover[0].kind == "green" and home.ways[0].lit is True
    assert [lm.name for lm in home.landmarks] == ["Common"] and home.landmarks[0].anchor is None
    assert len(home.habitat.feat) == 8 * home.habitat.cols * home.habitat.rows
    assert home.hazards is None
    text = tiles.where("i = 4236 and j = -7106").select(sinks.tile_json(tiles, "v5").alias("t")).first().t
    doc = json.loads(text)
    assert list(doc)[:5] == ["v", "ways", "names", "crossings", "landcover"] and doc["v"] == 5 and "hazards" not in doc and "access" not in doc["ways"][0]
    coarse = bake.coarse_tiles(own).collect()
    assert coarse and all(isinstance(x, float) for r in coarse for e in r.landcover for ring in e.rings for x in ring)


def test_way_lengths_and_habitat(spark, tmp_path):
    own = stream(spark, tmp_path)
    cells = bake.way_lengths(own).collect()
    total = sum(r.foot for r in cells)
    assert abs(total - 138.2) < 2 and all(r.res == 0 and r.road == 0 for r in cells)
    habitat = bake.habitat_cells(own, spark.createDataFrame([(cells[0].cx, cells[0].cy, 700.0)], "cx long, cy long, relief double"))
    assert habitat.where(F.col("record").isNull()).count() == 0 and habitat.count() > 50


def test_visible_ways_are_listed_once(spark, tmp_path):
    tiles = bake.base_tiles(stream(spark, tmp_path))
    here = spark.createDataFrame([(1, 42.3605, -71.0605)], "pos int, lat double, lng double")
    assert bake.visible(tiles, here).count() == 1


def test_empty_stream(spark, tmp_path):
    own = stream(spark, tmp_path).limit(0)
    assert bake.base_tiles(own).count() == 0 and bake.full_tiles(own).count() == 0


def test_totals_are_those_of_what_is_visible(spark):
    """Ways of one seam, in several tiles, twice in one, and positions that share tiles, stand twice, see nothing or have no place."""
    at = lambda *p: {"points": [{"lat": a, "lng": b} for a, b in p]}
    one, two, three = at((42.0, -71.0), (42.1, -71.1)), at((42.0, -71.0), (42.2, -71.0), (42.1, -71.1)), at((42.001, -71.0), (42.1, -71.1))
    rows = [(4200, -7100, [one, two, one]), (4201, -7100, [one]), (4204, -7100, [two, three]), (4200, -7110, [three])]
    tiles = spark.createDataFrame(rows, "i long, j long, ways array<struct<points:array<struct<lat:double,lng:double>>>>")
    spots = [(1, 42.005, -70.995), (2, 42.006, -70.994), (3, 42.025, -70.995), (4, 10.0, 10.0), (5, None, 1.0), (6, 42.005, -70.995), (6, 42.005, -71.095)]
    here = spark.createDataFrame(spots, "pos long, lat double, lng double")
    want = bake.visible(tiles, here).groupBy("pos").agg(F.count(F.lit(1)).alias("ways"), F.sum(F.size("w.points")).alias("points"))
    got = bake.visible_totals(tiles.select("i", "j", F.explode("ways").alias("w")), here)
    assert sorted(got.collect()) == sorted(want.collect()) and {r.pos: (r.ways, r.points) for r in got.collect()}[6] == (3, 7)


def test_no_way_is_paired_with_a_position(spark):
    from wayloom.plans import catalogue

    text = catalogue.QUERIES["seam_dedupe"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    tiles = text[: text.index("l_orderkey")]
    # Below the joins with positions, ways are already counted by the tiles that list them.
    assert tiles.rindex("Join ") < tiles.index("AS tiles#") < tiles.rindex("Aggregate")


def test_lines_find_the_tiles_of_their_vertices(spark):
    lines = spark.createDataFrame([(1, [(42.001, -71.0), (42.05, -71.02)]), (2, [(-0.004, 0.0), (None, 3.0), (0.02, -0.03)]), (3, [(70.0, 25.0)]), (4, []), (5, None)], "way_id long, points array<struct<lat:double,lng:double>>")
    got = spatial.lines_in_tiles(lines).select("i", "j", "way_id")
    want = spatial.ways_in_tiles(lines.select("way_id", F.explode("points").alias("p")).select("way_id", "p.lat", "p.lng"))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 28
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_sizes_are_those_of_base_tiles(spark):
    own = fx.features(spark, "/root/testdata/sf0.001").cache()
    tiles = bake.base_tiles(own).select("i", "j", F.size("ways").alias("ways"), F.size(F.filter("names", lambda n: n.isNotNull())).alias("named"), F.size(F.filter("ways", lambda w: w["foot"])).alias("feet"), F.size("crossings").alias("crossings"))
    sizes = bake.base_sizes(own)
    assert sorted(sizes.collect()) == sorted(tiles.collect()) and sizes.dtypes == tiles.dtypes
    assert "collect_list" not in sizes.drop("ways")._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]


def odd_features(spark):
    """A feature stream with ids that stand twice, names to escape, holes, hazards far from anything, and lines without places."""
    at = lambda *p: [{"lat": a, "lng": b} for a, b in p]
    square = lambda y, x, d: at((y, x), (y, x + d), (y + d, x + d), (y + d, x))
    home = at((42.001, -71.0), (42.0121234567, -71.02))
    rows = [
        ("w2", "w", {"highway": "footway", "name": ']"q"\\ é[', "footway": "crossing", "lit": "yes"}, home, None, None),
        ("w10", "w", {"highway": "path", "access": "no"}, home, None, None),
        ("w2", "w", {"highway": "service"}, at((42.0, -71.0)), None, None),
        ("w2", "w", {"highway": "footway", "name": "null"}, home, None, None),
        ("w3", "w", {"highway": "primary", "footway": "crossing"}, at((42.0, -71.001), (42.1, -71.2)), None, None),
        ("w4", "w", {"highway": "motorway"}, at((10.0, 10.0), (10.01, 10.0)), None, None),
        ("w5", "w", {"highway": "path", "name": "nowhere"}, at((None, 3.0)), None, None),
        ("w6", "w", {"highway": "path", "name": "empty"}, [], None, None),
        ("n1", "n", {"highway": "crossing"}, None, {"lat": 42.003, "lng": -71.003}, None),
        ("n2", "n", {"place": "town", "name": "Town"}, None, {"lat": 42.004, "lng": -71.004}, None),
        ("a1", "a", {"natural": "water"}, None, None, [[square(42.0, -71.0, 0.03), square(42.005, -70.995, 0.004), square(42.012, -70.99, 0.0001)], [square(42.1, -71.1, 0.01)]]),
        ("a2", "a", {"leisure": "park", "name": "Park"}, None, None, [[square(42.0, -71.0, 0.03)]]),
        ("a2", "a", {"leisure": "park", "name": "Park"}, None, None, [[square(42.3, -71.3, 0.001)]]),
    ]
    point = "struct<lat:double,lng:double>"
    return spark.createDataFrame(rows, f"id string, object string, tags map<string,string>, line array<{point}>, point {point}, polygons array<array<array<{point}>>>")


@pytest.mark.parametrize("source", ["odd", "fixtures"])
def test_spans_are_the_json_of_whole_tiles(spark, source):
    """Put one behind another, the spans of each tile are its canonical JSON, in however many batches they are made."""
    own = (odd_features(spark) if source == "odd" else fx.features(spark, "/root/testdata/sf0.001")).cache()
    tiles = bake.full_tiles(own)
    whole = {(r.i, r.j): r.t for r in tiles.select("i", "j", sinks.tile_json(tiles, "v5").alias("t")).collect()}
    sizes = {(r.i, r.j): r for r in bake.full_sizes(own).select("*", F.to_json("habitat").alias("h")).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3" if source == "odd" else "100")
    try:
        parts = defaultdict(list)
        for r in bake.full_spans(own).collect():
            parts[r.i, r.j, r.layer].append((r.at, r.json[1:-1]))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    listed = lambda at, layer: f',"{layer}":[' + ",".join(x for _, x in sorted(parts[(*at, layer)])) + "]"
    assert max(len(p) for p in parts.values()) > 1
    assert sizes.keys() == whole.keys() and {at[:2] for at in list(parts)} >= whole.keys()
    for at, text in whole.items():
        assert text == '{"v":5' + "".join(listed(at, n) for n in ("ways", "names", "crossings", "landcover", "landmarks")) + f',"habitat":{sizes[at].h}' + (listed(at, "hazards") if parts[(*at, "hazards")] else "") + "}"
        doc = json.loads(text)
        assert [sizes[at][n] for n in sinks.TILE_KEYS["v5"][1:] if n != "habitat"] == [len(doc.get(n, [])) for n in sinks.TILE_KEYS["v5"][1:] if n != "habitat"] and not sizes[at].broken


def test_spans_are_of_bounded_size(monkeypatch):
    monkeypatch.setattr(spans, "SPAN_BYTES", 20)
    texts, row, tile = pa.array(["1", "22", "x" * 50, "4"]), np.array([0, 0, 1, 1, 2, 3, 3, 3]), np.array([7, 8, 7, 8, 8, 7, 8, 9])
    found = [r for b in spans._spans("ways", texts, row, tile, np.zeros(8, int), 5) for r in b.to_pylist()]
    by_tile = defaultdict(list)
    for r in sorted(found, key=lambda r: r["at"]):
        by_tile[r["j"] + grid.ID_COLS].append(r["json"])
    assert by_tile == {7: ["[1,22]", "[4]"], 8: ["[1,22]", "[" + "x" * 50 + "]", "[4]"], 9: ["[4]"]}


def test_the_query_of_full_tiles_puts_no_tile_together(spark):
    from wayloom.plans import catalogue

    text = catalogue.QUERIES["full_tiles"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in text and "collect_list(struct(way_id" not in text and "collect_list(e#" not in text and "FullOuter" in text


def test_batched_tiles_and_lengths_are_those_of_rows(spark):
    rng = np.random.default_rng(5)
    near = lambda n: [(float(a), float(b)) for a, b in zip(rng.uniform(-0.05, 0.05, n) + rng.choice([0, 42, 70, -89], 1), rng.uniform(-0.05, 0.05, n), strict=True)]
    rows = [(k, near(k % 6)) for k in range(60)] + [(60, [(42.0, -71.0), (None, 1.0), (42.2, -71.0)]), (61, None)]
    lines = spark.createDataFrame(rows, "id long, points array<struct<lat:double,lng:double>>").repartition(2)
    want = {(r.id, r.i, r.j) for r in spatial.lines_in_tiles(lines).collect()}
    made = spans.of_lines(lines.select("id", F.lit("hazards").alias("layer"), "points", F.col("id").cast("string").alias("json"), F.lit("null").alias("names"))).collect()
    got = [(k, r.i, r.j) for r in made for k in json.loads(r.json)]
    assert len(got) == len(set(got)) and set(got) == want
    segments = [(("res", "foot")[k % 2], *(float(x) for x in rng.uniform(-0.02, 0.02, 4))) for k in range(40)] + [("road", 1.0, 2.0, 1.0, 2.0), ("road", 1.0, 2.0, None, 2.0)]
    segments = spark.createDataFrame(segments, "group string, lat1 double, lng1 double, lat2 double, lng2 double")
    one, two = ({(r.cx, r.cy, r.group): r.metres for r in f(segments).where("metres is not null").collect()} for f in (spatial.segment_lengths, spatial.batched_lengths))
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-6 for k in one)


def _document(pieces):
    return documents.Document(iter(pieces))


@pytest.mark.parametrize("source", ["odd", "fixtures"])
def test_documents_of_base_tiles_are_whole(spark, source, monkeypatch):
    """Byte by byte the canonical JSON of the tiles, and the query takes its sizes from them."""
    own = (odd_features(spark) if source == "odd" else fx.features(spark, "/root/testdata/sf0.001")).cache()
    tiles = bake.base_tiles(own)
    want = {(r.i, r.j): r.t for r in tiles.select("i", "j", sinks.tile_json(tiles, "v4").alias("t")).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3" if source == "odd" else "100")
    try:
        rows = documents.documents(bake.base_entries(own), "v4").collect()
        read = documents.sizes(bake.base_entries(own), "v4").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(rows) == len(want) and {(r.i, r.j): r.json for r in rows} == want
    assert {(r.i, r.j): r.bytes for r in read} == {at: len(t.encode()) for at, t in want.items()} and not any(r.broken for r in read)
    docs = {at: json.loads(t) for at, t in want.items()}
    counts = lambda d: (len(d["ways"]), len(d["names"]), sum(n is not None for n in d["names"]), sum(w["foot"] for w in d["ways"]), len(d["crossings"]))
    assert {(r.i, r.j): (r.ways, r.names, r.named, r.feet, r.crossings) for r in read} == {at: counts(d) for at, d in docs.items()}


def test_the_query_of_base_tiles_puts_tiles_together(spark):
    from wayloom.plans import catalogue

    text = catalogue.QUERIES["base_tiles"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "documents_read(" in text and "_packs(" in text


def test_documents_are_read_to_their_end(monkeypatch):
    """In pieces that end anywhere, and nothing that is cut off, lacks a layer or goes on counts as read."""
    point, names = '{"lat":1.5,"lng":2.0}', ['"a,b"', "null", r'"x\",\"y"', r'"\\"', '",null,"', '"null"']
    ways = [f'{{"points":[{point}],"foot":true}}', f'{{"points":[{point},{point}],"foot":false}}', '{"points":[{"lng":2.0}],"foot":true,"lit":true}']
    whole = f'{{"v":4,"ways":[{",".join(ways * 5)}],"names":[{",".join(names * 5)}],"crossings":[{",".join([point] * 7)}]}}'.encode()
    assert len(json.loads(whole)["names"]) == 30
    want = {"v": 4, "ways": 15, "feet": 10, "names": 30, "named": 25, "crossings": 7}
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(documents, "READ_BYTES", size)
        assert documents.document_sizes(_document(whole[k : k + size] for k in range(0, len(whole), size)), "v4") == want
    for bad in (whole[:-1], whole[:-40], whole + b" ", whole.replace(b'"names"', b'"other"'), whole.replace(b'"lng":2.0}],"foot":true}', b'"lng":2.0],"foot":true}', 1), whole.replace(b"null", b"nul", 1), whole.replace(b'"v":4', b'"v":5'), b""):
        with pytest.raises(ValueError):
            documents.document_sizes(_document([bad]), "v4")


@pytest.mark.parametrize("source", ["odd", "fixtures"])
def test_documents_of_full_tiles_are_whole(spark, source):
    """Byte by byte the canonical JSON of the tiles, with their habitat and hazards, and their sizes."""
    own = (odd_features(spark) if source == "odd" else fx.features(spark, "/root/testdata/sf0.001")).cache()
    tiles = bake.full_tiles(own)
    want = {(r.i, r.j): r.t for r in tiles.select("i", "j", sinks.tile_json(tiles, "v5").alias("t")).collect()}
    rows = documents.documents(bake.full_entries(own), "v5").collect()
    assert len(rows) == len(want) and {(r.i, r.j): r.json for r in rows} == want
    keys = [k for k in sinks.TILE_KEYS["v5"][1:] if k != "habitat"]
    read = {(r.i, r.j): [r[k] for k in keys] for r in documents.sizes(bake.full_entries(own), "v5").where("not broken and v = 5").collect()}
    assert read == {at: [len(d.get(k, [])) for k in keys] for at, d in ((at, json.loads(t)) for at, t in want.items())}


def test_the_query_of_full_tiles_puts_tiles_together(spark):
    from wayloom.plans import catalogue

    text = catalogue.QUERIES["full_tiles"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "documents_read(" in text and "_packs(" in text
