"""Publishing in order, reports, dumps and checks that go with a bake."""

import json
import os

import pytest
from pyspark.sql import functions as F

from wayloom.operators import analytics, landmarks, relief, slices, verify
from wayloom.sources import archive, features, publish, rasters, shared, sinks


def tiles(spark, n, version="v5"):
    rows = [(s, version, i, 1, f"{s} {i} {n}".encode()) for s in ("utah", "iowa") for i in range(1, n)]
    return spark.createDataFrame(rows, "slice string, version string, i int, j int, body binary")


def test_archives_then_sidecars_then_index_then_old_ones(spark, tmp_path):
    side = tmp_path / "habitat"
    side.write_text("{}")
    sidecars = {"utah": {"utah.habitat.jsonl": str(side)}}
    store, seen = str(tmp_path / "store"), []
    for n in (4, 4, 5, 6, 7):
        entries = archive.write_archives(tiles(spark, n), str(tmp_path / "packed")).cache()
        seen.append(publish.publish(spark, entries, store, sidecars))
    first = seen[0]
    assert [x[0] for x in first] == ["archive", "archive", "sidecar", "index", "index"]
    assert [x[0] for x in seen[1]] == ["skip", "skip"]
    assert [x[0] for x in seen[2]] == first_steps(first) and [x[0] for x in seen[3]].count("retire") == 2
    index = features.archive_index(spark, f"{store}/index.json").collect()
    assert {(r.slice, r.tileCount) for r in index} == {("utah", 6), ("iowa", 6)}
    assert len(os.listdir(f"{store}/v5")) == 4 and os.path.exists(f"{store}/utah.habitat.jsonl")
    assert not [x for x in os.listdir(f"{store}/v5") if x.endswith(".part")]
    for r in index:
        assert archive.read_head(f"{store}/{r.path}")[0].tile_count == 6
    assert len(publish.drop_older(spark, str(tmp_path / "packed" / "v5"), ["utah", "iowa"])) == 6
    assert len(os.listdir(tmp_path / "packed" / "v5")) == 2


def first_steps(log):
    return [x[0] for x in log]


def test_versions_are_chosen(spark, tmp_path):
    both = tiles(spark, 3).unionByName(tiles(spark, 3, "v4"))
    assert {r.version for r in archive.write_archives(both, str(tmp_path), ["v4"]).collect()} == {"v4"}


def test_what_is_not_there_before_the_first_run(spark, tmp_path):
    path = f"{tmp_path}/anchors"
    assert shared.optional(features.anchor_sidecar, spark, path) is None
    rows = spark.createDataFrame([("a", "peak", 1.0, 2.0, 3, "x")], "key string, kind string, lat double, lng double, ele int, name string")
    sinks.anchor_sidecar(rows).write.json(path)
    assert shared.optional(features.anchor_sidecar, spark, path).count() == 1


def test_reports(spark):
    judged = spark.createDataFrame([("utah", "p1", "v5", []), ("utah", "p2", "v5", ["no ways", "version"]), ("ohio", "p3", "v4", [])], "slice string, probe string, version string, problems array<string>")
    assert verify.report(judged, ["utah"]) == "utah p2 v5: no ways, version\n1 passed, 1 failed, 1 skipped"
    assert json.loads(verify.report(judged, ["utah"], as_json=True)) == {"passed": 1, "failed": 1, "skipped": 1, "problems": [{"slice": "utah", "probe": "p2", "version": "v5", "problems": ["no ways", "version"]}]}
    with pytest.raises(RuntimeError):
        verify.require(verify.totals(judged, ["utah"]))


def test_all_candidates_are_dumped(spark, tmp_path):
    rows = [("s", f"k{n}", "peak" if n % 2 else "park", 40.0 + n, -70.0, float(n - 2)) for n in range(6)]
    own = landmarks.ranked_candidates(spark.createDataFrame(rows, "slice string, key string, kind string, lat double, lng double, sig double"))
    sinks.anchor_candidates(own).write.json(f"{tmp_path}/c")
    back = spark.read.json(f"{tmp_path}/c").collect()
    assert len(back) == 6 and sum(r.above for r in back) == 4 and {r.place for r in back} == {1}


def test_a_band_of_two_widths_is_an_error(spark):
    heads = spark.createDataFrame([(42, -72, 3600), (42, -71, 3600), (51, 0, 2400)], "tile_lat int, tile_lng int, width int")
    assert {(r.tile_lat, r.width) for r in relief.one_width(heads).collect()} == {(42, 3600), (51, 2400)}
    mixed = heads.unionByName(spark.createDataFrame([(51, 1, 1800)], heads.schema))
    with pytest.raises(Exception, match="latitude 51 differ in width"):
        relief.one_width(mixed).collect()


def test_grids_without_records_give_no_cells(spark):
    grids = spark.createDataFrame([(5, 7, 2, "AAAAAAAABAAAAAAACAAAAAAA"), (1, 1, 2, None), (1, 1, 2, "")], "cx0 long, cy0 long, cols long, feat string")
    assert sorted((r.cx, r.cy, r.f[0]) for r in analytics.grid_cells(grids).collect()) == [(5, 7, "A"), (5, 8, "C"), (6, 7, "B")]


def test_slugs_are_numbered_as_in_a_dictionary(spark):
    rows = spark.createDataFrame([("b", "Ohio!"), ("B", "ohio"), ("a", "OHIO?"), ("x", "utah")], "k string, id string")
    got = {r.k: r.slug for r in slices.slugged(rows, "id", "k").collect()}
    assert got == {"a": "ohio", "b": "ohio-2", "B": "ohio-3", "x": "utah"}


def test_one_block_rasters_are_read(spark, tmp_path):
    import numpy as np

    from wayloom.sources import elevation

    values = np.arange(64, dtype=np.float32).reshape(8, 8)
    rasters.write(str(tmp_path), 42, -72, values, 8)
    spark.dataSource.register(elevation.ElevationSource)
    posts = spark.read.format("dem").options(south=42.0, north=43.0, west=-72.0, east=-71.001, rows=8).load(str(tmp_path))
    assert posts.agg(F.sum("e")).first()[0] == values.sum()
