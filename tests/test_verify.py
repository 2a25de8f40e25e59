"""Probes are judged, skipped ones counted, and a check of nothing fails."""

import pytest

from wayloom.operators import publish, verify


def test_judging_and_the_guard_against_nothing(spark):
    probes = spark.createDataFrame(
        [(1, "utah", 0.125, 0.155, "any", "v5"), (2, "utah", 0.135, 0.155, "empty", "v5"), (3, "utah", 9.0, 9.0, "uncovered", "v5"), (4, "utah", 0.135, 0.155, "dense", "v5"), (5, "iowa", 9.0, 9.0, "any", "v5")],
        "probe int, slice string, lat double, lng double, expect string, version string",
    )
    cover = spark.createDataFrame([("utah", 1, 1)], "slice string, bi long, bj long")
    tiles = spark.createDataFrame([("utah", 12, 15, 5)], "slice string, i long, j long, v int")
    metrics = spark.createDataFrame([(12, 15, 3, 1, 0, 1, 9)], "i long, j long, ways int, named int, crossings int, landcover int, points_in_cell int")
    judged = verify.judge(probes, cover, tiles, metrics)
    assert {r.probe: (r.kind, r.problems) for r in judged.collect()} == {1: ("tile", []), 2: ("hole", []), 3: ("uncovered", []), 4: ("hole", ["dropped"]), 5: ("uncovered", ["not baked"])}
    row = verify.totals(judged, ["utah"]).first()
    assert (row.passed, row.failed, row.skipped) == (3, 1, 1)
    with pytest.raises(RuntimeError):
        verify.require(verify.totals(judged, ["utah"]))
    with pytest.raises(RuntimeError):
        verify.require(verify.totals(judged, []))
    verify.require(verify.totals(judged.where("probe <> 4"), ["utah"]))


def test_due_slices_and_the_index_guard(spark):
    slices = spark.createDataFrame([("a", 28), ("b", 3)], "name string, day int")
    assert [r["name"] for r in publish.due(slices, 31).collect()] == ["a"]
    assert publish.due(slices, 1, force_all=True).count() == 2 and publish.due(slices, 28, only="b").first()["name"] == "b"
    index = spark.createDataFrame([("a", "ab" * 32)], "slice string, sha string")
    publish.assert_indexed(index, "a", "ab" * 32)
    with pytest.raises(RuntimeError):
        publish.assert_indexed(index, "a", "cd" * 32)
