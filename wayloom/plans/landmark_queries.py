"""Queries that rank, dedupe and cross-check landmarks and anchors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry, tags, text
from ..operators import analytics, landmarks, spatial
from . import fixtures as fx
from .registry import query

col = F.col
_TIER = "case " + " ".join(f"when kind = '{k}' then {v}" for k, v in tags.TIERS.items()) + " end"
_P = "p as (select *, cast(lat_e6 as double) / 1e6 as lat, cast(lng_e6 as double) / 1e6 as lng from fx_landmark)"
# Listings for the ranking queries: every landmark in the nine tiles of its neighbourhood at tile size 0.02 degrees.
_LIST = (
    f"l as (select lm_id, name, kind, {_TIER} as tier, area_m2 as area, cast(floor(lat_e6 / 20000.0) as bigint) + di as i, cast(floor(lng_e6 / 20000.0) as bigint) + dj as j, abs(di) + abs(dj) as distance, lm_id % 17 = 0 as anchor, "
    "kind || '@' || cast(lat_e6 as varchar) || ',' || cast(lng_e6 as varchar) as key from fx_landmark, (values (-1), (0), (1)) a(di), (values (-1), (0), (1)) b(dj))"
)


def listings(spark, sf):
    lm = fx.landmark(spark, sf)
    near = F.explode(F.expr("flatten(transform(array(-1L, 0L, 1L), di -> transform(array(-1L, 0L, 1L), dj -> struct(di as di, dj as dj))))")).alias("d")
    cells = lm.select("*", near)
    return cells.select(
        "lm_id", "name", "kind", tags.tier(col("kind")).alias("tier"), col("area_m2").alias("area"), (F.floor(col("lat_e6") / 20000).cast("bigint") + col("d.di")).alias("i"), (F.floor(col("lng_e6") / 20000).cast("bigint") + col("d.dj")).alias("j"),
        (F.abs("d.di") + F.abs("d.dj")).cast("int").alias("distance"), (col("lm_id") % 17 == 0).alias("anchor"), text.anchor_key(col("kind"), col("lat"), col("lng")).alias("key"),
    )


_ORDER = "anchor desc, tier, area desc, distance, name"


@query(
    "tile_top6",
    fx.sql(
        "fx_landmark",
        f"select i, j, lm_id, cast(row_number() over (partition by i, j order by {_ORDER}) as integer) as rank from (select *, row_number() over (partition by i, j, tier <= 1 order by {_ORDER}) as s from l) where tier > 1 or s <= 2 qualify row_number() over (partition by i, j order by {_ORDER}) <= 6",
        _LIST,
    ),
)
def tile_top6(spark, sf):
    return landmarks.top_of_tile(listings(spark, sf)).select("i", "j", "lm_id", "rank")


@query("dedupe_kind_name", fx.sql("fx_landmark", "select i, j, kind, grp as name, lm_id, area from (select *, 'n' || cast(lm_id % 5 as varchar) as grp from l) qualify row_number() over (partition by i, j, kind, grp order by area desc, key) = 1", _LIST))
def dedupe_kind_name(spark, sf):
    named = listings(spark, sf).withColumn("name", F.concat(F.lit("n"), (col("lm_id") % 5).cast("string")))
    return landmarks.largest_of_name(named, ["i", "j"]).select("i", "j", "kind", "name", "lm_id", "area")


_CAND = (
    "c as (select 's' || cast(lm_id % 4 as varchar) as slice, lm_id, kind, key, cast(floor(lat_e6 * 31 / 500000.0) as bigint) as ai, cast(floor(lng_e6 * 31 / 500000.0) as bigint) as aj, cast((lm_id * 7919) % 1000 as double) / 100 - 2 as sig from (select *, "
    "kind || '@' || cast(lat_e6 as varchar) || ',' || cast(lng_e6 as varchar) as key from fx_landmark)), r as (select *, case when kind = 'peak' then 'peak' else 'areal' end as grp, case when kind = 'national_park' then 1 else 0 end as np from c where sig >= 0), "
    "s as (select * from r qualify row_number() over (partition by slice, grp, ai, aj order by np desc, sig desc, key) = 1)"
)


def candidates(spark, sf):
    """Landmarks spread out so that they fall into many half-degree cells, with an invented significance."""
    lm = fx.landmark(spark, sf)
    return lm.select(
        F.concat(F.lit("s"), (col("lm_id") % 4).cast("string")).alias("slice"), "lm_id", "kind", text.anchor_key(col("kind"), col("lat"), col("lng")).alias("key"), (col("lat_e6") * 31 / 1e6).alias("lat"), (col("lng_e6") * 31 / 1e6).alias("lng"),
        ((col("lm_id") * 7919) % 1000 / 100 - 2).alias("sig"),
    )


@query("anchor_greedy", fx.sql("fx_landmark", "select slice, lm_id, key, cast(row_number() over (partition by slice order by np desc, sig desc, key) as integer) as seat from s qualify row_number() over (partition by slice order by np desc, sig desc, key) <= case slice when 's0' then 3 when 's1' then 12 else 1 end", _CAND))
def anchor_greedy(spark, sf):
    found = candidates(spark, sf)
    caps = found.select("slice").distinct().withColumn("cap", F.expr("case slice when 's0' then 3 when 's1' then 12 else 1 end"))
    return landmarks.select_anchors(found, caps).select("slice", "lm_id", "key", "seat")


@query(
    "anchor_candidates",
    fx.sql("fx_landmark", "select slice, lm_id, case when kind = 'peak' then 'peak' else 'areal' end as grp, ai, aj, sig >= 0 as above, cast(row_number() over (partition by slice, case when kind = 'peak' then 'peak' else 'areal' end, ai, aj order by case when kind = 'national_park' then 1 else 0 end desc, sig desc, key) as integer) as place from c", _CAND),
)
def anchor_candidates(spark, sf):
    return landmarks.ranked_candidates(candidates(spark, sf)).select("slice", "lm_id", "grp", "ai", "aj", "above", "place")


@query("anchor_cap", "select n_nationkey as k, cast(greatest(1, floor(15 / (pi() * 10000) * n_nationkey * 10000.0 + 0.5)) as bigint) as cap from nation")
def anchor_cap(spark, sf):
    n = fx.table(spark, sf, "nation")
    return n.select(col("n_nationkey").alias("k"), F.greatest(F.lit(1), F.floor(F.lit(landmarks.DENSITY_PER_KM2) * col("n_nationkey") * 10000.0 + 0.5)).cast("bigint").alias("cap"))


@query("anchor_flag_join", fx.sql("fx_landmark", "select i, j, l.lm_id, case when a.key is not null then true end as anchor from l left join (select key from l where anchor and distance = 0) a on l.key = a.key", _LIST))
def anchor_flag_join(spark, sf):
    own = listings(spark, sf)
    return landmarks.flag_anchors(own, own.where("anchor and distance = 0")).select("i", "j", "lm_id", "anchor")


@query(
    "anchor_anti_both",
    fx.sql("fx_landmark", "select key, 'unflagged' as side from (select distinct key from l where lm_id % 5 = 0) where key not in (select key from l where anchor) union all select key, 'unranked' from (select distinct key from l where anchor) where key not in (select key from l where lm_id % 5 = 0)", _LIST),
)
def anchor_anti_both(spark, sf):
    own = listings(spark, sf)
    return landmarks.anchor_mismatch(own, own.where("lm_id % 5 = 0"))


@query("landmark_listings_distinct", fx.sql("fx_landmark", "select kind, count(*) as listings, count(distinct key) as own from l group by kind", _LIST))
def landmark_listings_distinct(spark, sf):
    return analytics.listings_by_kind(listings(spark, sf))


@query("names_by_kind", fx.sql("fx_landmark", "select kind, count(distinct name) as n, array_to_string(list_sort(list(distinct name))[1:6], '|') as first from l group by kind", _LIST))
def names_by_kind(spark, sf):
    return analytics.names_by_kind(listings(spark, sf))


@query(
    "ele_median_distinct",
    fx.sql("fx_landmark", "select kind, min(ele) as least, max(ele) as most, list_sort(list(distinct ele))[cast(floor(count(distinct ele) / 2.0) as integer) + 1] as median from fx_landmark group by kind"),
)
def ele_median_distinct(spark, sf):
    return analytics.distinct_median(fx.landmark(spark, sf), "ele", ["kind"])


_AREA = "abs({0}) * (cos(radians({1})) * 6196071200.0)"
_SHOELACE = "0.0 + (x1 * y2 - x2 * y1) + (x2 * y3 - x3 * y2) + (x3 * y4 - x4 * y3) + (x4 * y1 - x1 * y4)"
_DEG = "cast({0}_e6 as double) / 1e6"


@query(
    "simplify_rings",
    fx.sql(
        "fx_poly",
        f"select poly_id, kind, 32 as before, 4 as after, round({_AREA.format(_SHOELACE, 'y1')}, 1) as area_m2 from r",
        f"r as (select poly_id, kind, {_DEG.format('lat0')} as y1, {_DEG.format('lng0')} as x1, {_DEG.format('lat0')} as y2, {_DEG.format('lng1')} as x2, {_DEG.format('lat1')} as y3, {_DEG.format('lng1')} as x3, {_DEG.format('lat1')} as y4, {_DEG.format('lng0')} as x4 from fx_poly)",
    ),
)
def simplify_rings(spark, sf):
    """Each part's rectangle with seven points more on every side, simplified: only its corners are left."""
    polys = fx.poly(spark, sf)
    dense = F.flatten(F.zip_with("ring", F.concat(F.slice("ring", 2, 3), F.slice("ring", 1, 1)), lambda a, b: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.struct((a["lat"] + (b["lat"] - a["lat"]) * k / 8).alias("lat"), (a["lng"] + (b["lng"] - a["lng"]) * k / 8).alias("lng")))))
    rings = polys.select("poly_id", "kind", dense.alias("ring"))
    done = rings.withColumn("simple", geometry.simplify(geometry.SIMPLIFY_M)(col("ring")))
    return done.select("poly_id", "kind", F.size("ring").alias("before"), F.size("simple").alias("after"), F.round(geometry.area_m2(col("simple")), 1).alias("area_m2"))


_CLIPPED = (
    "b as (select poly_id, kind, cast(i as bigint) as i, cast(j as bigint) as j, (i + 0.5) * cast(0.01 as double) - 1200 / cast(111320 as double) as s, (i + 0.5) * cast(0.01 as double) + 1200 / cast(111320 as double) as n, "
    "(j + 0.5) * cast(0.01 as double) - 1200 / cast(111320 as double) / cos(radians((i + 0.5) * cast(0.01 as double))) as w, (j + 0.5) * cast(0.01 as double) + 1200 / cast(111320 as double) / cos(radians((i + 0.5) * cast(0.01 as double))) as e, "
    f"{_DEG.format('lat0')} as a0, {_DEG.format('lat1')} as a1, {_DEG.format('lng0')} as o0, {_DEG.format('lng1')} as o1 from fx_poly, (select unnest(range(4190, 4226)) as i), (select unnest(range(-7165, -7124)) as j)), "
    "c as (select *, greatest(a0, s) as lo, least(a1, n) as hi, greatest(o0, w) as le, least(o1, e) as ri from b where a0 < n and a1 > s and o0 < e and o1 > w), "
    # The clipped ring begins at a cut of the north side, if there is one, and further east if that is cut too.
    "r as (select *, case when a1 > n then n else lo end as y1, case when a1 > n and o1 > e then ri else le end as x1, case when a1 > n and o1 > e then n else lo end as y2, case when a1 > n then le else ri end as x2, "
    "case when a1 > n then lo else hi end as y3, case when a1 > n and o1 > e then le else ri end as x3, case when a1 > n and o1 > e then lo else hi end as y4, case when a1 > n then ri else le end as x4 from c)"
)


@query("clip_polygons", fx.sql("fx_poly", f"select i, j, poly_id, kind, 4 as points, round({_AREA.format(_SHOELACE, 'y1')}, 1) as area_m2 from r where round({_AREA.format(_SHOELACE, 'y1')}, 1) >= 1000", _CLIPPED))
def clip_polygons(spark, sf):
    """Each part's rectangle clipped to the boxes of the tiles it may reach, with what is left of it."""
    half = geometry.M_PER_DEG
    cells = spatial.boxes_in_tiles(fx.poly(spark, sf), ["poly_id", "kind", "ring"])
    lat, lng = (col("i") + 0.5) * 0.01, (col("j") + 0.5) * 0.01
    dy, dx = F.lit(1200 / half), F.lit(1200 / half) / F.cos(F.radians(lat))
    cut = cells.withColumn("part", geometry.clip(col("ring"), lat - dy, lat + dy, lng - dx, lng + dx)).where(F.size("part") > 2)
    area = geometry.area_m2(col("part"))
    return cut.withColumn("area_m2", F.round(area, 1)).where(col("area_m2") >= geometry.LEAST_CLIPPED_M2).select("i", "j", "poly_id", "kind", F.size("part").alias("points"), "area_m2")


_KEPT = "m as (select kind, cast((lat1_e6 - lat0_e6) * (lng1_e6 - lng0_e6) as bigint) as a from fx_poly)"


@query("kept_area_share", fx.sql("fx_poly", "select kind, round(100.0 * cast(sum(case when a >= 25000000 then 1 else 0 end) as double) / count(*), 4) as polys_pct, round(100.0 * cast(sum(case when a >= 25000000 then a else 0 end) as double) / cast(sum(a) as double), 4) as area_pct from m group by kind", _KEPT))
def kept_area_share(spark, sf):
    return analytics.kept_share(fx.poly(spark, sf).select("kind", ((col("lat1_e6") - col("lat0_e6")) * (col("lng1_e6") - col("lng0_e6"))).alias("area")), 25_000_000)
