"""Queries that select features, judge tiles and report sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codec, grid, tags
from ..operators import analytics, relief, verify
from . import fixtures as fx
from .registry import query

col = F.col
_OBJ = ["case o_orderkey % 4 when 0 then 'n' when 1 then 'a' else 'w' end as object", "case o_orderkey % 6 when 0 then 'natural' when 1 then 'leisure' when 2 then 'place' when 3 then 'landuse' else 'highway' end as k"]
_VAL = "case o_orderkey % 11 when 0 then 'wood' when 1 then 'peak' when 2 then 'park' when 3 then 'city' when 4 then 'forest' when 5 then 'path' when 6 then 'trunk' when 7 then 'crossing' when 8 then 'cemetery' else 'other' end as val"
_RULE = " or ".join(f"(object = '{o}' and k = '{k}' and val in ({', '.join(repr(v) for v in values)}))" for o, k, values in tags.SELECTED)


@query("feature_filter", f"select id, object from (select o_orderkey as id, {', '.join(_OBJ)}, {_VAL} from orders) where {_RULE}")
def feature_filter(spark, sf):
    rows = fx.table(spark, sf, "orders").selectExpr("o_orderkey as id", *_OBJ, _VAL)
    return rows.where(tags.selected(col("object"), lambda key: F.when(col("k") == key, col("val")))).select("id", "object")


_TIER_KINDS = "['peak', 'park']"


@query(
    "probe_wants",
    fx.sql(
        "fx_landmark fx_mask",
        "select p.i, p.j, concat_ws(';', case when not exists (select 1 from l where l.i = p.i and l.j = p.j and kind in ('peak', 'park') and ele >= 300) then 'no landmark' end, case when n < 3 then 'few attributes' end, case when not coalesce(has_m, false) then 'no m' end, case when coalesce(has_w, false) then 'has w' end) as problems from p left join g on p.i = g.i and p.j = g.j",
        "l as (select *, cast(floor(lat_e6 / 10000.0) as bigint) as i, cast(floor(lng_e6 / 10000.0) as bigint) as j from fx_landmark), p as (select i, j, count(*) as n from l group by i, j), "
        "g as (select cast(floor(cy * 3 / 20.0) as bigint) as i, cast(floor(cx * 3 / 20.0) as bigint) as j, bool_or(mask & 16 <> 0) as has_m, bool_or(mask & 4 <> 0 and mask & 16 = 0 and mask & 64 = 0) as has_w from fx_mask group by 1, 2)",
    ),
)
def probe_wants(spark, sf):
    lm = fx.landmark(spark, sf).select(F.floor(col("lat_e6") / 10000).cast("bigint").alias("i"), F.floor(col("lng_e6") / 10000).cast("bigint").alias("j"), F.struct("kind", "name", "ele", F.lit(None).cast("boolean").alias("anchor")).alias("lm"))
    tiles = lm.groupBy("i", "j").agg(F.collect_list("lm").alias("landmarks"), F.count(F.lit(1)).alias("n"))
    cells = fx.record(spark, sf).select(grid.floor_div(col("cy") * 3, 20).alias("i"), grid.floor_div(col("cx") * 3, 20).alias("j"), codec.to_chars("record").alias("f"))
    feats = cells.groupBy("i", "j").agg(F.array_join(F.collect_list("f"), "").alias("feat"))
    want = F.from_json(F.lit('{"landmark":{"kinds":["peak","park"],"ele_min":300},"attr_ways":3,"has":"m","lacks":"w"}'), verify.WANT)
    rows = tiles.join(feats, ["i", "j"], "left").withColumn("want", want)
    found = verify.lacking(col("want"), col("landmarks"), col("n"), verify.glyphs(F.coalesce("feat", F.lit(""))))
    return rows.select("i", "j", F.array_join(found, ";").alias("problems"))


@query("object_layout", fx.sql("fx_tile", "select c.i, c.j, case when t.i is null then 'absent' else 'tile' end as kind, t.bytes from (select distinct 4190 + event_id % 80 as i, -7160 + (event_id * 7) % 85 as j from events) c left join fx_tile t on t.part = 1 and t.i = c.i and t.j = c.j"))
def object_layout(spark, sf):
    cells = fx.table(spark, sf, "events").selectExpr("4190 + event_id % 80 as i", "-7160 + (event_id * 7) % 85 as j").distinct()
    return verify.resolve_objects(cells, fx.tile(spark, sf).where("part = 1").select("i", "j", "bytes")).select("i", "j", "kind", "bytes")


_WIN = "t as (select i, j, sum(bytes) as bytes from fx_tile where part = 0 group by i, j), w as (select a.i, a.j, sum(b.bytes) as total from t a, t b where abs(a.i - b.i) <= 5 and abs(a.j - b.j) <= 7 group by a.i, a.j)"


@query("view_percentiles", fx.sql("fx_tile", "select cast(list_sort(list(total))[cast(least(count(*) - 1, floor(0.5 * count(*))) as integer) + 1] as bigint) as p50, cast(list_sort(list(total))[cast(least(count(*) - 1, floor(0.95 * count(*))) as integer) + 1] as bigint) as p95, cast(max(total) as bigint) as most from w", _WIN))
def view_percentiles(spark, sf):
    tiles = fx.tile(spark, sf).where("part = 0").groupBy("i", "j").agg(F.sum("bytes").alias("bytes"))
    return analytics.floor_percentile(relief.window_sum(tiles, [(5, 7)]), "total", {"p50": 0.5, "p95": 0.95, "most": 1.0})


@query("coarse_density", fx.sql("fx_tile", "select part, round(cast(sum(bytes) as double) / sum(1.1132 * 1.1132 * cos(radians((i + 0.5) * 0.01))), 4) as bytes_km2, round(100.0 * cast(sum(bytes) as double) / (select cast(sum(bytes) as double) from fx_tile), 4) as pct from fx_tile group by part"))
def coarse_density(spark, sf):
    tiles = fx.tile(spark, sf)
    whole = tiles.agg(F.sum("bytes").alias("whole"))
    own = tiles.groupBy("part").agg(F.sum("bytes").cast("double").alias("b"), F.sum(grid.row_km2("i")).alias("km2"))
    return own.crossJoin(F.broadcast(whole)).select("part", F.round(col("b") / col("km2"), 4).alias("bytes_km2"), F.round(F.lit(100.0) * col("b") / col("whole"), 4).alias("pct"))


@query("reader_counters", "select event_type, count(distinct user_id) as tiles, count(*) as blocks, cast(sum(case when event_id % 3 = 0 then event_id else 0 end) as bigint) as fetched, cast(sum(case when event_id % 3 <> 0 then event_id else 0 end) as bigint) as cached from events group by event_type")
def reader_counters(spark, sf):
    log = fx.table(spark, sf, "events").select("event_type", col("user_id").alias("tile"), col("event_id").alias("bytes"), (col("event_id") % 3 == 0).alias("cold"))
    return analytics.reader_counters(log, ["event_type"])
