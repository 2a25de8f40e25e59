"""Counts and shares over habitat cells, atlases, ways and tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codec, grid
from ..operators import analytics, bake, slices
from . import fixtures as fx
from .registry import query

col = F.col
_BITS = codec.CLASS_BITS
_CLASSES = "(values " + ", ".join(f"('{n}', {b})" for n, b in _BITS.items()) + ") c(class, b)"
_SHOWN = "coalesce(" + ", ".join(f"case when mask & {_BITS[n]} <> 0 then '{n}' end" for n in codec.DISPLAY_ORDER) + ")"


@query(
    "label_share",
    fx.sql("fx_mask", f"select class, count(*) as n, round(100.0 * count(*) / (select count(*) from fx_mask), 4) as pct from fx_mask, {_CLASSES} where mask & b <> 0 group by class"),
)
def label_share(spark, sf):
    """The flagship: observations to cells, to feature records, to classes, to their share."""
    cells = fx.record(spark, sf)
    total = cells.agg(F.count(F.lit(1)).alias("cells"))
    return analytics.label_counts(cells).crossJoin(F.broadcast(total)).select("class", "n", F.round(F.lit(100.0) * col("n") / col("cells"), 4).alias("pct"))


@query("mask_counts", fx.sql("fx_cell", """select m as mask, count(*) as n from (select case when total = 0 then 32 else coalesce(nullif(case when total >= 90 and r * 100 <= 35 * total then 1 else 0 end + case when r >= 12 and r * 10 >= 4 * total then 2 else 0 end + case when f >= 12 and f * 10 >= 7 * total then 8 else 0 end, 0), 32) end as m
  from (select *, r + f + d as total from (select least(255, cast(floor(res / 100.0) as bigint)) as r, least(255, cast(floor(foot / 100.0) as bigint)) as f, least(255, cast(floor(road / 100.0) as bigint)) as d from fx_cell))) group by m"""))
def mask_counts(spark, sf):
    zero, none = F.lit(0), F.lit(None).cast("bigint")
    record = codec.encode_int(col("res") / 10, col("foot") / 10, col("road") / 10, zero, zero, zero, none)
    return fx.cell(spark, sf).select(codec.classify(record).alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("n"))


@query("way_length_by_group", fx.sql("fx_cell", "select cx, cy, res, foot, road from fx_cell"))
def way_length_by_group(spark, sf):
    """Credited lengths by cell and group: views are residential, clicks footways, the rest roads."""
    group = F.expr("case event_type when 'view' then 'res' when 'click' then 'foot' else 'road' end").alias("group")
    return analytics.lengths_by_group(fx.obs_cells(spark, sf).select("cx", "cy", group, col("len_dm").alias("metres")))


@query("display_share", fx.sql("fx_mask", f"select {_SHOWN} as class, count(*) as n from fx_mask group by 1"))
def display_share(spark, sf):
    return analytics.display_counts(fx.record(spark, sf))


@query("multi_label_count", fx.sql("fx_mask", "select cast(sum(case when bit_count(cast(mask as bigint)) > 1 then 1 else 0 end) as bigint) as several, count(*) as cells from fx_mask"))
def multi_label_count(spark, sf):
    return analytics.several_classes(fx.record(spark, sf))


@query("distinct_cells", fx.sql("fx_mask", "select cx, cy, cast(mask as integer) as mask from fx_mask"))
def distinct_cells(spark, sf):
    cells = fx.record(spark, sf)
    return analytics.distinct_cells(cells.unionByName(cells)).select("cx", "cy", "mask")


@query("saturation", fx.sql("fx_mask", "select max(r) * 10 as res, max(f) * 10 as foot, max(d) * 10 as road, cast(sum(case when r >= 20 then 1 else 0 end) as bigint) as saturated, cast(sum(case when h = 511 then 1 else 0 end) as bigint) as bare from fx_mask"))
def saturation(spark, sf):
    cells = fx.record(spark, sf)
    f = lambda n: codec.field("record", n)
    return cells.agg(F.max(f("res")).alias("res"), F.max(f("foot")).alias("foot"), F.max(f("road")).alias("road"), F.count_if(f("res") >= 200).alias("saturated"), F.count_if(f("relief").isNull()).alias("bare"))


_BLOCK = "cast(floor(cx / 64.0) as bigint) as bx, cast(floor(cy / 64.0) as bigint) as b_y"


@query("atlas_mask", fx.sql("fx_mask", f"select {_BLOCK}, cast(bit_or(mask) as integer) as mask from fx_mask group by 1, 2"))
def atlas_mask(spark, sf):
    return analytics.block_masks(fx.record(spark, sf)).withColumnRenamed("by", "b_y")


@query("atlas_occupancy", fx.sql("fx_mask", f"select class, count(*) as blocks from (select {_BLOCK}, bit_or(mask) as mask from fx_mask group by 1, 2), {_CLASSES} where mask & b <> 0 group by class"))
def atlas_occupancy(spark, sf):
    return analytics.label_counts(analytics.block_masks(fx.record(spark, sf))).withColumnRenamed("n", "blocks")


@query("thin_blocks", fx.sql("fx_mask", f"select class, count(*) as claims, cast(sum(case when n = 1 then 1 else 0 end) as bigint) as thin from (select {_BLOCK}, class, count(*) as n from fx_mask, {_CLASSES} where mask & b <> 0 group by 1, 2, 3) group by class"))
def thin_blocks(spark, sf):
    return analytics.thin_blocks(fx.record(spark, sf))


_ATLAS = f"a as (select {_BLOCK}, bit_or(mask) as m from fx_mask group by 1, 2), b as (select {_BLOCK}, bit_or(mask & 119) as m from fx_mask where cx % 3 <> 0 group by 1, 2)"


@query("atlas_crosscheck", fx.sql("fx_mask", "select * from (select coalesce(a.bx, b.bx) as bx, coalesce(a.b_y, b.b_y) as b_y, cast(coalesce(a.m, 0) & ~coalesce(b.m, 0) as integer) as missing, cast(coalesce(b.m, 0) & ~coalesce(a.m, 0) as integer) as extra from a full join b on a.bx = b.bx and a.b_y = b.b_y) where missing <> 0 or extra <> 0", _ATLAS))
def atlas_crosscheck(spark, sf):
    cells = fx.record(spark, sf)
    other = analytics.block_masks(cells.where("cx % 3 <> 0").withColumn("mask", col("mask").bitwiseAND(F.lit(119))))
    return analytics.atlas_check(cells, other).withColumnRenamed("by", "b_y")


@query("atlas_codes", fx.sql("fx_mask", f"select bx, b_y, substr('{codec.ALPHABET}', cast((m >> 6) & 63 as integer) + 1, 1) || substr('{codec.ALPHABET}', cast(m & 63 as integer) + 1, 1) as code, cast(m as integer) as mask from a", _ATLAS))
def atlas_codes(spark, sf):
    blocks = analytics.block_masks(fx.record(spark, sf)).withColumn("code", codec.chars_of_mask("mask"))
    return blocks.select("bx", col("by").alias("b_y"), "code", codec.mask_of_chars("code").alias("mask"))


_RARE = "t as (select " + ", ".join(f"sum(case when mask & {_BITS[n]} <> 0 then 1 else 0 end) as n{k}" for k, n in enumerate(codec.DISPLAY_ORDER)) + " from fx_mask)"
_LIST = "list_min(list_filter([" + ", ".join(f"case when mask & {_BITS[n]} <> 0 then lpad(cast(n{k} as varchar), 9, '0') || '{k}{n}' end" for k, n in enumerate(codec.DISPLAY_ORDER)) + "], lambda x: x is not null))"


@query("rarest_class", fx.sql("fx_mask", f"select cx, cy, substr({_LIST}, 11) as rarest from fx_mask, t", _RARE))
def rarest_class(spark, sf):
    return analytics.rarest_class(fx.record(spark, sf)).select("cx", "cy", "rarest")


@query("class_drift", fx.sql("fx_mask", f"select cast(0 as bigint) as malformed, cast(sum(case when {_SHOWN} <> 'rural' and cx % 4 = 0 then 1 else 0 end) as bigint) as drifted from fx_mask"))
def class_drift(spark, sf):
    cells = fx.record(spark, sf)
    stored = F.when((col("cx") % 4 == 0) & (codec.display("mask") != "rural"), F.array(F.lit("rural"))).otherwise(codec.classes("mask"))
    return analytics.drift(cells.select(codec.to_chars("record").alias("f"), stored.alias("classes")))


@query("percentile_floor_index", fx.sql("fx_tile", "select part, list_sort(list(bytes))[cast(least(count(*) - 1, floor(0.5 * count(*))) as integer) + 1] as p50, list_sort(list(bytes))[cast(least(count(*) - 1, floor(0.95 * count(*))) as integer) + 1] as p95, max(bytes) as p100 from fx_tile group by part"))
def percentile_floor_index(spark, sf):
    return analytics.floor_percentile(fx.tile(spark, sf), "bytes", {"p50": 0.5, "p95": 0.95, "p100": 1.0}, ["part"])


@query("tiles_by_version", fx.sql("fx_tile", "select part, count(*) as tiles, cast(sum(bytes) as bigint) as bytes, round(cast(sum(bytes) as double) / 1048576, 6) as mb from fx_tile group by part"))
def tiles_by_version(spark, sf):
    return analytics.sizes(fx.tile(spark, sf), ["part"])


@query("coarse_totals", fx.sql("fx_poly", "select kind, count(*) as polys, cast(sum(case when poly_id % 3 = 0 then 8 else 4 end) as bigint) as points from fx_poly group by kind"))
def coarse_totals(spark, sf):
    """Every third polygon with its ring twice, as if it had a hole."""
    flat = F.flatten(F.transform("ring", lambda p: F.array(p["lat"], p["lng"])))
    return analytics.coarse_totals(fx.poly(spark, sf).select("kind", F.when(col("poly_id") % 3 == 0, F.array(flat, flat)).otherwise(F.array(flat)).alias("rings")))


@query("landcover_counts", fx.sql("fx_poly", "select kind, count(*) as n from fx_poly group by kind"))
def landcover_counts(spark, sf):
    return analytics.histogram(fx.poly(spark, sf), "kind")


@query("lit_access_counts", fx.sql("fx_way", "select highway, cast(sum(case when lit in ('yes', '24/7', 'no', 'disused') then 1 else 0 end) as bigint) as lit, cast(sum(case when access in ('private', 'no', 'permissive') then 1 else 0 end) as bigint) as access from fx_way group by highway"))
def lit_access_counts(spark, sf):
    from ..functions import tags

    ways = fx.way(spark, sf).select("highway", tags.lit(col("lit")).alias("l"), tags.access(col("access")).alias("a"))
    return ways.groupBy("highway").agg(F.count("l").alias("lit"), F.count("a").alias("access"))


@query("layer_cells", fx.sql("fx_tile", "select coalesce(a.i, b.i) as i, coalesce(a.j, b.j) as j, a.i is not null as fine, b.i is not null as coarse from (select i, j from fx_tile where part = 0) a full join (select distinct i, j from fx_tile where part in (0, 2) and n > 1 or part = 2) b on a.i = b.i and a.j = b.j"))
def layer_cells(spark, sf):
    tiles = fx.tile(spark, sf)
    return analytics.layer_cells(tiles.where("part = 0"), tiles.where("part in (0, 2) and n > 1 or part = 2"))


@query("atlas_sidecar_pairs", fx.sql("fx_slice", "select a.id, a.number as atlas, b.number as sidecar from fx_slice a join fx_slice b on a.id = b.id where a.number % 2 = 0"))
def atlas_sidecar_pairs(spark, sf):
    own = fx.extract(spark, sf)
    return slices.paired(own.where("number % 2 = 0").select("id", col("number").alias("atlas")), own.select("id", col("number").alias("sidecar")))


@query(
    "probe_metrics",
    fx.sql(
        "fx_vertex fx_way",
        "select i, j, cast(count(*) as integer) as ways, cast(sum(case when name is not null and name <> '' then 1 else 0 end) as integer) as named, cast(sum(case when is_lit or acc then 1 else 0 end) as integer) as attr_ways, cast(sum(inside) as integer) as points_in_cell from "
        "(select t.i, t.j, w.way_id, w.name, w.lit in ('yes', '24/7', 'no', 'disused') as is_lit, w.access in ('private', 'no', 'permissive') as acc, (select count(*) from fx_vertex v where v.way_id = w.way_id and cast(floor(cast(lat_e6 as double) / 1e6 / cast(0.01 as double)) as bigint) = t.i and cast(floor(cast(lng_e6 as double) / 1e6 / cast(0.01 as double)) as bigint) = t.j) as inside "
        "from t join fx_way w on t.way_id = w.way_id) group by i, j",
        "t as (select way_id, cast(floor(cast(min(lat_e6) as double) / 1e6 / cast(0.01 as double)) as bigint) as i, cast(floor(cast(min(lng_e6) as double) / 1e6 / cast(0.01 as double)) as bigint) as j from fx_vertex where n = 1 group by way_id)",
    ),
)
def probe_metrics(spark, sf):
    """Tiles with nested ways, and the counts a probe takes from each."""
    from ..functions import tags

    v = fx.vertex(spark, sf)
    shape = v.groupBy("way_id").agg(F.sort_array(F.collect_list(F.struct("n", "lat", "lng"))).alias("p"), F.min(F.when(col("n") == 1, col("lat"))).alias("lat"), F.min(F.when(col("n") == 1, col("lng"))).alias("lng")).where("lat is not null")
    shape = shape.select("way_id", "p", F.struct(grid.tile("lat").alias("i"), grid.tile("lng").alias("j")).alias("home"))
    ways = shape.join(fx.way(spark, sf), "way_id").select("home.i", "home.j", "name", F.struct(F.transform("p", lambda x: F.struct(x["lat"].alias("lat"), x["lng"].alias("lng"))).alias("points"), tags.lit(col("lit")).alias("lit"), tags.access(col("access")).alias("access")).alias("way"))
    tiles = ways.groupBy("i", "j").agg(F.collect_list("way").alias("ways"), F.collect_list(F.coalesce("name", F.lit(""))).alias("names"))
    tiles = tiles.withColumns({"crossings": F.array().cast("array<string>"), "landcover": F.array().cast("array<string>")})
    return analytics.tile_metrics(tiles).select("i", "j", "ways", "named", "attr_ways", "points_in_cell")


@query(
    "habitat_grids",
    fx.sql(
        "fx_mask",
        "select f.i, f.j, f.cx, f.cy, cast(coalesce(m.record, 511 * 68719476736) as bigint) as record from f left join fx_mask m on m.cx = f.cx and m.cy = f.cy",
        "t as (select distinct cast(floor(cy * 3 / 20.0) as bigint) as i, cast(floor(cx * 3 / 20.0) as bigint) as j from fx_mask), "
        "f as (select i, j, unnest(range(cast(floor(j * 20 / 3.0) as bigint), cast(ceil((j + 1) * 20 / 3.0) as bigint))) as cx, cy from (select i, j, unnest(range(cast(floor(i * 20 / 3.0) as bigint), cast(ceil((i + 1) * 20 / 3.0) as bigint))) as cy from t))",
    ),
)
def habitat_grids(spark, sf):
    """Records written into the grids of tiles and read from them again; a grid without records gives none."""
    cells = fx.record(spark, sf)
    tiles = cells.select(grid.floor_div(col("cy") * 3, 20).alias("i"), grid.floor_div(col("cx") * 3, 20).alias("j")).distinct()
    grids = bake.habitat_grids(tiles, cells.select("cx", "cy", "record")).select("i", "j", "habitat.*")
    legacy = grids.withColumn("feat", F.lit(None).cast("string"))
    back = analytics.grid_cells(grids.unionByName(legacy), ["i", "j"])
    return back.select("i", "j", "cx", "cy", codec.from_chars("f").alias("record"))
