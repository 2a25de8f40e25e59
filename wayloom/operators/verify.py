"""Checks of published tiles against probes: where they resolve, what they hold, what is missing."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codec, grid
from . import analytics, archive

#: Slices whose probes must run; those of others are skipped aloud.
WANT = "struct<landmark:struct<kinds:array<string>,name:string,ele_min:double,ele_max:double,anchor:boolean>,attr_ways:int,has:string,lacks:string>"


def glyphs(habitat: Column) -> Column:
    """One character for the class shown of each cell of a grid; none for a grid without records."""
    n = F.call_function("div", F.length(habitat), F.lit(codec.CHARS)).cast("int")
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda k: codec.glyph(codec.classify(codec.from_chars(F.substring(habitat, k * codec.CHARS + 1, F.lit(codec.CHARS))))))
    return F.when(F.coalesce(n, F.lit(0)) > 0, F.array_join(each, "")).otherwise(F.lit(""))


def lacking(want: Column, landmarks: Column, attr_ways: Column, cells: Column) -> Column:
    """What a tile lacks of a probe's wants, as an array of short names."""
    lm = want["landmark"]

    def fits(x: Column) -> Column:
        ele = x["ele"].cast("double")
        return (
            (lm["kinds"].isNull() | F.array_contains(lm["kinds"], x["kind"]))
            & (lm["name"].isNull() | F.coalesce(F.contains(x["name"], lm["name"]), F.lit(False)))
            & (lm["ele_min"].isNull() | F.coalesce(ele >= lm["ele_min"], F.lit(False)))
            & (lm["ele_max"].isNull() | F.coalesce(ele <= lm["ele_max"], F.lit(False)))
            & (lm["anchor"].isNull() | F.coalesce(x["anchor"], F.lit(False)))
        )

    none = F.array().cast("array<string>")
    chars = lambda c: F.when(F.coalesce(F.length(c), F.lit(0)) > 0, F.split(c, "")).otherwise(none)
    missing = F.transform(F.filter(chars(want["has"]), lambda c: ~F.contains(cells, c)), lambda c: F.concat(F.lit("no "), c))
    extra = F.transform(F.filter(chars(want["lacks"]), lambda c: F.contains(cells, c)), lambda c: F.concat(F.lit("has "), c))
    first = F.array_compact(F.array(F.when(lm.isNotNull() & ~F.exists(landmarks, fits), "no landmark"), F.when(attr_ways < want["attr_ways"], "few attributes")))
    return F.concat(first, missing, extra)


def resolve_objects(cells: DataFrame, tiles: DataFrame) -> DataFrame:
    """Cells of the object layout: a tile, or absent, which may be a hole or never made."""
    found = cells.join(tiles.withColumn("found", F.lit(True)), ["i", "j"], "left")
    return found.withColumn("kind", F.when(F.col("found"), "tile").otherwise("absent")).drop("found")


def judge(probes: DataFrame, cover: DataFrame, tiles: DataFrame, metrics: DataFrame) -> DataFrame:
    """probes with kind and problems.

    probes: probe, slice, lat, lng, expect, version. cover: slice, bi, bj. tiles: slice, i,
    j, v. metrics: i, j and the counts of `analytics.tile_metrics`.
    """
    keyed = probes.withColumns({"i": grid.tile("lat"), "j": grid.tile("lng")})
    found = archive.resolve(keyed.select("i", "j").distinct(), cover, tiles.select("slice", "i", "j", "v")).withColumnRenamed("slice", "answered_by")
    rows = keyed.join(found, ["i", "j"], "left").join(metrics, ["i", "j"], "left")
    own = {k: F.coalesce(k, F.lit(0)) for k in ("v", "ways", "named", "crossings", "landcover", "points_in_cell")}
    return rows.withColumn("problems", analytics.problems(F.col("kind"), F.col("expect"), F.col("version"), own))


def probed_versions(slices: DataFrame, coarse: Column) -> DataFrame:
    """slices with each version that is probed: the coarse one only where it is published."""
    wanted = F.when(coarse, F.array(*map(F.lit, ("v4", "v5", "v5c")))).otherwise(F.array(*map(F.lit, ("v4", "v5"))))
    return slices.withColumn("version", F.explode(wanted))


def report(judged: DataFrame, expected: list[str], as_json: bool = False) -> str:
    """What failed and the totals, as text or as one JSON document. Probes are written by hand, so they are few."""
    failed = judged.where(F.size("problems") > 0).orderBy("slice", "probe").select("slice", "probe", "version", "problems").collect()
    total = totals(judged, expected).first().asDict()
    if as_json:
        return json.dumps(total | {"problems": [r.asDict() for r in failed]}, separators=(",", ":"))
    lines = [f"{r.slice} {r.probe} {r.version}: {', '.join(r.problems)}" for r in failed]
    return "\n".join([*lines, f"{total['passed']} passed, {total['failed']} failed, {total['skipped']} skipped"])


def totals(judged: DataFrame, expected: list[str]) -> DataFrame:
    """One row: probes passed, failed and skipped. A probe of an unexpected slice is skipped; `unbaked` always counts."""
    skipped = ~F.col("slice").isin([*expected, "unbaked"])
    bad = F.size("problems") > 0
    return judged.agg(F.count_if(~skipped & ~bad).alias("passed"), F.count_if(~skipped & bad).alias("failed"), F.count_if(skipped).alias("skipped"))


def require(summary: DataFrame) -> None:
    """Fail if a probe failed, and also if none ran: a check of nothing proves nothing."""
    row = summary.first()
    if row.failed or not row.passed:
        raise RuntimeError(f"{row.passed} probes passed, {row.failed} failed, {row.skipped} were skipped")
