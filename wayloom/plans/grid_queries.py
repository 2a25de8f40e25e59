"""Queries over grids, codecs, tags and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codec, geometry, grid, tags, text
from . import fixtures as fx
from .registry import query

col = F.col
LATLNG = "p as (select *, cast(lat_e6 as double) / 1e6 as lat, cast(lng_e6 as double) / 1e6 as lng from fx_obs)"


def _floor(expr: str, size: float) -> str:
    return f"cast(floor({expr} / cast({size} as double)) as bigint)"


@query("tile_key", fx.sql("fx_obs", f"select event_id, {_floor('lat', 0.01)} as i, {_floor('lng', 0.01)} as j from p", LATLNG))
def tile_key(spark, sf):
    return fx.obs(spark, sf).select("event_id", grid.tile("lat").alias("i"), grid.tile("lng").alias("j"))


@query("spawn_cell", fx.sql("fx_obs", f"select event_id, {_floor('lng', 0.0015)} as cx, {_floor('lat', 0.0015)} as cy from p", LATLNG))
def spawn_cell(spark, sf):
    return fx.obs(spark, sf).select("event_id", grid.spawn("lng").alias("cx"), grid.spawn("lat").alias("cy"))


_SPAN0 = "cast(floor(20 * {0} / 3.0) as bigint)"
_SPAN1 = "cast(ceil(20 * ({0} + 1) / 3.0) as bigint) - 1"


@query(
    "tile_span",
    fx.sql("fx_tile", f"select distinct i, j, {_SPAN0.format('j')} as cx0, {_SPAN0.format('i')} as cy0, {_SPAN1.format('j')} - {_SPAN0.format('j')} + 1 as cols, {_SPAN1.format('i')} - {_SPAN0.format('i')} + 1 as n_rows from fx_tile"),
)
def tile_span(spark, sf):
    (cx0, cols), (cy0, rows) = grid.span("j"), grid.span("i")
    return fx.tile(spark, sf).select("i", "j").distinct().select("i", "j", cx0.alias("cx0"), cy0.alias("cy0"), cols.alias("cols"), rows.alias("n_rows"))


@query("tile_id_roundtrip", fx.sql("fx_tile", "select distinct i, j, (i + 9000) * 36001 + j + 18000 as id, cast(i as bigint) as i2, cast(j as bigint) as j2 from fx_tile"))
def tile_id_roundtrip(spark, sf):
    ids = fx.tile(spark, sf).select("i", "j").distinct().withColumn("id", grid.tile_id("i", "j"))
    i, j = grid.cell_of_id("id")
    return ids.select("i", "j", "id", i.alias("i2"), j.alias("j2"))


@query("cover_block", fx.sql("fx_tile", "select distinct i, j, cast(floor(i / 10.0) as bigint) as bi, cast(floor(j / 10.0) as bigint) as bj from fx_tile"))
def cover_block(spark, sf):
    return fx.tile(spark, sf).select("i", "j", grid.cover_block("i").alias("bi"), grid.cover_block("j").alias("bj")).distinct()


@query(
    "atlas_block",
    fx.sql(
        "fx_dem",
        "select cx, cy, bx, b_y, cast(2 * ((b_y - (select min(b_y) from b)) * ((select max(bx) from b) - (select min(bx) from b) + 1) + bx - (select min(bx) from b)) as bigint) as slot from b",
        "b as (select cx, cy, cast(floor(cx / 64.0) as bigint) as bx, cast(floor(cy / 64.0) as bigint) as b_y from fx_dem)",
    ),
)
def atlas_block(spark, sf):
    cells = fx.dem(spark, sf).select("cx", "cy", grid.atlas_block("cx").alias("bx"), grid.atlas_block("cy").alias("b_y"))
    frame = cells.agg(F.min("bx").alias("x0"), F.max("bx").alias("x1"), F.min("b_y").alias("y0"))
    slot = 2 * ((col("b_y") - col("y0")) * (col("x1") - col("x0") + 1) + col("bx") - col("x0"))
    return cells.crossJoin(F.broadcast(frame)).select("cx", "cy", "bx", "b_y", slot.alias("slot"))


@query("anchor_cell", fx.sql("fx_landmark", "select lm_id, cast(floor(cast(lat_e6 as double) / 1e6 / 0.5) as bigint) as ai, cast(floor(cast(lng_e6 as double) / 1e6 / 0.5) as bigint) as aj from fx_landmark"))
def anchor_cell(spark, sf):
    return fx.landmark(spark, sf).select("lm_id", grid.anchor("lat").alias("ai"), grid.anchor("lng").alias("aj"))


@query(
    "dem_tile_name",
    fx.sql(
        "",
        "select k, case when lat >= 0 then 'N' else 'S' end || lpad(cast(abs(lat) as varchar), 2, '0') || '_00_' || case when lng >= 0 then 'E' else 'W' end || lpad(cast(abs(lng) as varchar), 3, '0') || '_00' as name from p",
        "p as (select c_custkey as k, cast(c_custkey % 170 as bigint) - 85 as lat, cast(c_custkey * 7 % 358 as bigint) - 179 as lng from customer)",
    ),
)
def dem_tile_name(spark, sf):
    p = fx.table(spark, sf, "customer").select(col("c_custkey").alias("k"), (col("c_custkey") % 170 - 85).alias("lat"), (col("c_custkey") * 7 % 358 - 179).alias("lng"))
    return p.select("k", grid.dem_name("lat", "lng").alias("name"))


@query(
    "post_for_cell",
    fx.sql("fx_dem", "select cx, cy, cast(floor(((2 * cx + 1) * 7200 + 2000) / 4000.0) as bigint) as kx, ky, cast(floor((ky - 1) / 3600.0) as bigint) as tile_lat from (select cx, cy, cast(floor(((2 * cy + 1) * 10800 + 2000) / 4000.0) as bigint) as ky from fx_dem)"),
)
def post_for_cell(spark, sf):
    posts = fx.dem(spark, sf).select("cx", "cy", grid.post("cx", 2400).alias("kx"), grid.post("cy", 3600).alias("ky"))
    return posts.withColumn("tile_lat", grid.dem_row("ky"))


_CHARS = " || ".join(f"substr('{codec.ALPHABET}', cast((record >> {6 * k}) & 63 as integer) + 1, 1)" for k in range(7, -1, -1))
_FIELDS = "r * 10 as res, f * 10 as foot, d * 10 as road, wood, green, water, case when h < 511 then h * 10 end as relief"


@query("feature_encode", fx.sql("fx_mask", f"select cx, cy, record, {_CHARS} as f from fx_mask"))
def feature_encode(spark, sf):
    return fx.record(spark, sf).select("cx", "cy", "record", codec.to_chars("record").alias("f"))


@query("feature_decode", fx.sql("fx_mask", f"select cx, cy, {_FIELDS} from fx_mask"))
def feature_decode(spark, sf):
    raw = fx.record(spark, sf).select("cx", "cy", codec.from_chars(codec.to_chars("record")).alias("raw"))
    return raw.select("cx", "cy", *(codec.field("raw", n).alias(n) for n, _, _ in codec.FIELDS))


@query("classify_mask", fx.sql("fx_mask", "select cx, cy, cast(mask as integer) as mask from fx_mask"))
def classify_mask(spark, sf):
    return fx.record(spark, sf).select("cx", "cy", "mask")


_BITS = codec.CLASS_BITS
_LABELS = ", ".join(f"case when mask & {_BITS[n]} <> 0 then '{n}' end" for n in codec.DISPLAY_ORDER)


@query("classes_of", fx.sql("fx_mask", f"select cx, cy, concat_ws('+', {_LABELS}) as classes from fx_mask"))
def classes_of(spark, sf):
    return fx.record(spark, sf).select("cx", "cy", F.array_join(codec.classes("mask"), "+").alias("classes"))


@query("display_class", fx.sql("fx_mask", f"select cx, cy, coalesce({_LABELS}) as class, case coalesce({_LABELS}) " + " ".join(f"when '{k}' then '{v}'" for k, v in codec.GLYPHS.items()) + " end as glyph from fx_mask"))
def display_class(spark, sf):
    return fx.record(spark, sf).select("cx", "cy", codec.display("mask").alias("class"), codec.glyph("mask").alias("glyph"))


# A creature's affinity to each class, for the consumer's rule that the greatest counts.
_WEIGHTS = {"urban": 3, "residential": 5, "woodland": 9, "greenspace": 7, "mountain": 8, "rural": 1, "water": 6}


@query("weight_max", fx.sql("fx_mask", "select cx, cy, greatest(" + ", ".join(f"case when mask & {_BITS[n]} <> 0 then {w} else 0 end" for n, w in _WEIGHTS.items()) + ") as weight from fx_mask"))
def weight_max(spark, sf):
    return fx.record(spark, sf).select("cx", "cy", codec.strongest("mask", _WEIGHTS).alias("weight"))


@query("green_kind", fx.sql("fx_mask", "select cx, cy, case when woody then 'woodland' else 'greenspace' end as kind, bit_count(wood) as w, bit_count(green) as g from fx_mask"))
def green_kind(spark, sf):
    r = fx.rec(spark, sf)
    return r.select("cx", "cy", codec.green_kind(col("wood"), col("green")).alias("kind"), F.bit_count("wood").alias("w"), F.bit_count("green").alias("g"))


@query(
    "malformed_records",
    "select event_id, cast(case when regexp_matches(f, '^[A-Za-z0-9_-]{8}$') then 0 else 1 end as integer) as malformed from (select event_id, substr(replace(props || 'AAAAAAAA', ':', case when event_id % 2 = 0 then 'A' else ':' end), 3, 8) as f from events)",
)
def malformed_records(spark, sf):
    f = F.expr("substr(replace(props || 'AAAAAAAA', ':', case when event_id % 2 = 0 then 'A' else ':' end), 3, 8)")
    return fx.table(spark, sf, "events").select("event_id", codec.from_chars(f).isNull().cast("int").alias("malformed"))


_IN = lambda values: "(" + ", ".join(f"'{v}'" for v in values) + ")"


@query("lit_access", fx.sql("fx_way", f"select way_id, case when lit in {_IN(tags.LIT_YES)} then true when lit in {_IN(tags.LIT_NO)} then false end as is_lit, case when access in {_IN(tags.ACCESS)} then access end as kept from fx_way"))
def lit_access(spark, sf):
    return fx.way(spark, sf).select("way_id", tags.lit(col("lit")).alias("is_lit"), tags.access(col("access")).alias("kept"))


@query(
    "way_groups",
    fx.sql(
        "fx_way",
        f"select way_id, case when highway in {_IN(tags.FOOT)} then true when highway in {_IN(tags.NOT_FOOT)} then false end as foot, highway in {_IN(tags.HAZARDS)} as hazard, "
        f"case when highway in {_IN(tags.HABITAT_RES)} then 'res' when highway in {_IN(tags.HABITAT_FOOT)} then 'foot' when highway in {_IN(tags.HABITAT_ROAD)} then 'road' end as grp from fx_way",
    ),
)
def way_groups(spark, sf):
    h = col("highway")
    return fx.way(spark, sf).select("way_id", tags.foot(h).alias("foot"), tags.hazard(h).alias("hazard"), tags.habitat_group(h).alias("grp"))


@query("tag_filter", fx.sql("fx_way", f"select way_id, highway from fx_way where highway in {_IN(tags.FOOT + tags.NOT_FOOT)}"))
def tag_filter(spark, sf):
    return fx.way(spark, sf).where(tags.walkable(col("highway"))).select("way_id", "highway")


_AREA_TAGS = [
    "case p_size % 4 when 0 then 'water' when 1 then 'wood' end as nat", "case p_size % 5 when 0 then 'forest' when 1 then 'basin' when 2 then 'grass' when 3 then 'farmland' end as landuse",
    "case p_size % 3 when 0 then 'park' end as leisure",
]


@query(
    "landcover_kind",
    f"select id, case when nat = 'water' or landuse in ('reservoir', 'basin') then 'water' when nat = 'wood' or landuse = 'forest' then 'wood' when leisure in ('park', 'garden', 'common') or landuse in ('grass', 'meadow', 'recreation_ground', 'village_green') then 'green' when landuse in ('farmland', 'farmyard', 'orchard') then 'field' end as kind from (select p_partkey as id, {', '.join(_AREA_TAGS)} from part)",
)
def landcover_kind(spark, sf):
    areas = fx.table(spark, sf, "part").selectExpr("p_partkey as id", *_AREA_TAGS)
    own = {"natural": "nat", "landuse": "landuse", "leisure": "leisure"}
    return areas.select("id", tags.landcover(lambda k: col(own[k]) if k in own else F.lit(None).cast("string")).alias("kind"))


_MARK_TAGS = [
    "case s_suppkey % 9 when 0 then 'city' when 1 then 'hamlet' end as place", "case s_suppkey % 7 when 2 then 'peak' end as nat", "case s_suppkey % 5 when 0 then 'national_park' when 1 then 'protected_area' end as boundary",
    "case s_suppkey % 4 when 1 then '2' else '5' end as protect_class", "case s_suppkey % 6 when 0 then 'park' when 1 then 'nature_reserve' when 2 then 'common' end as leisure", "case s_suppkey % 11 when 3 then 'library' end as amenity",
    "case s_suppkey % 13 when 4 then 'cemetery' end as landuse", "s_suppkey % 2 = 0 as is_node", "cast(s_suppkey as double) * 1000000.0 as area",
]


@query(
    "landmark_kind",
    "select id, case when is_node and place in ('city', 'hamlet') then place when is_node and nat = 'peak' then 'peak' when (boundary = 'national_park' or (boundary = 'protected_area' and protect_class = '2')) and area >= 5e7 then 'national_park' "
    "when boundary = 'protected_area' then 'protected_area' when leisure = 'park' then 'park' when amenity = 'library' then 'library' when landuse = 'cemetery' then 'cemetery' when leisure = 'nature_reserve' then 'nature_reserve' when leisure = 'common' then 'common' "
    f"when boundary = 'national_park' then 'protected_area' end as kind from (select s_suppkey as id, {', '.join(_MARK_TAGS)} from supplier)",
)
def landmark_kind(spark, sf):
    marks = fx.table(spark, sf, "supplier").selectExpr("s_suppkey as id", *_MARK_TAGS)
    own = {"natural": "nat"} | {k: k for k in ("place", "boundary", "protect_class", "leisure", "amenity", "landuse")}
    return marks.select("id", tags.landmark(lambda k: col(own[k]) if k in own else F.lit(None).cast("string"), col("area"), col("is_node")).alias("kind"))


@query("tier_radius", fx.sql("fx_landmark", "select lm_id, case " + " ".join(f"when kind = '{k}' then {v}" for k, v in tags.TIERS.items()) + " end as tier, case " + " ".join(f"when kind = '{k}' then cast({v} as double)" for k, v in tags.RADII.items()) + " else cast(1200 as double) end as radius from fx_landmark"))
def tier_radius(spark, sf):
    return fx.landmark(spark, sf).select("lm_id", tags.tier(col("kind")).alias("tier"), tags.radius(col("kind")).alias("radius"))


_REF = "case " + " ".join(f"when kind = '{k}' then cast({v} as double)" for k, v in tags.REFERENCE.items()) + " end"


@query(
    "significance",
    fx.sql(
        "fx_landmark",
        f"select lm_id, cast(case when kind in {_IN(tags.SETTLEMENTS)} then null when kind = 'peak' then case when ele > 0 then round(2 * log2(ele / cast(95 as double)), 6) else -999 end else case when area_m2 > 0 then round(log2(area_m2 / {_REF}), 6) else -999 end end as double) as sig from fx_landmark",
    ),
)
def significance(spark, sf):
    sig = tags.significance(col("kind"), col("area_m2").cast("double"), col("ele").cast("double"))
    return fx.landmark(spark, sf).select("lm_id", F.when(sig == float("-inf"), -999.0).otherwise(F.round(sig, 6)).alias("sig"))


@query("anchor_key", fx.sql("fx_landmark", "select lm_id, kind || '@' || cast(lat_e6 as varchar) || ',' || cast(lng_e6 as varchar) as key from fx_landmark"))
def anchor_key(spark, sf):
    return fx.landmark(spark, sf).select("lm_id", text.anchor_key(col("kind"), col("lat"), col("lng")).alias("key"))


@query("coordinate_rounding", fx.sql("fx_obs", "select event_id, cast(floor(cast(lat_e6 as double) / 1e6 * 1e5 + 0.5) as bigint) as lat_e5, cast(floor(cast(lng_e6 as double) / 1e6 * 1e5 + 0.5) as bigint) as lng_e5 from fx_obs"))
def coordinate_rounding(spark, sf):
    return fx.obs(spark, sf).select("event_id", text.round_half_up(col("lat"), 1e5).alias("lat_e5"), text.round_half_up(col("lng"), 1e5).alias("lng_e5"))


@query(
    "slice_day",
    fx.sql("fx_slice", "select id, cast(list_reduce(list_prepend(cast(0 as bigint), list_transform(string_split(id, ''), lambda c: cast(ascii(c) as bigint))), lambda h, c: (h * 31 + c) % 4294967296) % 28 + 1 as bigint) as day from fx_slice"),
)
def slice_day(spark, sf):
    return fx.extract(spark, sf).select("id", text.day_of("id").alias("day"))


@query(
    "slug_names",
    "select c_custkey as id, trim(regexp_replace(lower(raw), '[^a-z0-9]+', '-', 'g'), '-') as slug from (select c_custkey, c_mktsegment || ' (' || c_name || ')' as raw from customer)",
)
def slug_names(spark, sf):
    return fx.table(spark, sf, "customer").select(col("c_custkey").alias("id"), text.slug(F.concat("c_mktsegment", F.lit(" ("), "c_name", F.lit(")"))).alias("slug"))


@query("tile_paths", fx.sql("fx_tile", "select distinct 'v5/' || i || '/' || j || '.json.gz' as path, cast(i as bigint) as i, cast(j as bigint) as j from fx_tile"))
def tile_paths(spark, sf):
    paths = fx.tile(spark, sf).select(F.format_string("v5/%d/%d.json.gz", "i", "j").alias("path")).distinct()
    i, j = text.tile_path_cell("path")
    return paths.select("path", i.alias("i"), j.alias("j"))


@query(
    "byte_ranges",
    "select event_id, case when event_id % 3 = 0 then user_id end as first, case when event_id % 3 = 0 then user_id + event_id end as last from events",
)
def byte_ranges(spark, sf):
    header = F.expr("case event_id % 3 when 0 then concat('bytes=', user_id, '-', user_id + event_id) when 1 then concat('bytes=', user_id, '-') else 'bytes=0-1,3-4' end")
    first, last = text.parse_range("header")
    return fx.table(spark, sf, "events").withColumn("header", header).select("event_id", first.alias("first"), last.alias("last"))


@query("elevation_tags", "select s_suppkey as id, case when s_suppkey % 4 = 0 then null else cast(floor(abs(s_acctbal) + 0.5) as integer) end as ele from supplier")
def elevation_tags(spark, sf):
    tag = F.expr("case s_suppkey % 4 when 0 then 'about a mile' when 1 then concat(cast(abs(s_acctbal) as decimal(12, 2)), ' m') else cast(cast(abs(s_acctbal) as decimal(12, 2)) as string) end")
    return fx.table(spark, sf, "supplier").select(col("s_suppkey").alias("id"), text.elevation(tag).alias("ele"))


@query("window_radii", fx.sql("fx_tile", "select distinct i, greatest(1, cast(ceil(5200 / 1113.2) as bigint)) as ri, greatest(1, cast(ceil(5200 / (1113.2 * cos(radians((i + 0.5) * 0.01)))) as bigint)) as rj, round(1.1132 * 1.1132 * cos(radians((i + 0.5) * 0.01)), 6) as km2 from fx_tile"))
def window_radii(spark, sf):
    ri, rj = grid.window_radii("i", 5200.0)
    return fx.tile(spark, sf).select("i").distinct().select("i", ri.alias("ri"), rj.alias("rj"), F.round(grid.row_km2("i"), 6).alias("km2"))


@query("ring_area", fx.sql("fx_poly", "select poly_id, 2 * (lat1_e6 - lat0_e6) * (lng1_e6 - lng0_e6) as twice from fx_poly"))
def ring_area(spark, sf):
    shift = lambda c, by: F.transform(c, lambda p: F.struct(F.round(p["lat"] * 1e6 - 4.2e7).alias("lat"), F.round(p["lng"] * 1e6 + 7.15e7).alias("lng"))) if by else c
    return fx.poly(spark, sf).select("poly_id", F.abs(geometry.cross_sum(shift(col("ring"), True))).cast("bigint").alias("twice"))


@query(
    "ring_centroid",
    fx.sql("fx_poly", "select poly_id, cast(floor((lat0_e6 + lat1_e6) / 2.0 + 0.25) as bigint) as lat_e6, cast(floor((lng0_e6 + lng1_e6) / 2.0 + 0.25) as bigint) as lng_e6 from fx_poly"),
)
def ring_centroid(spark, sf):
    c = geometry.centroid(col("ring"))
    return fx.poly(spark, sf).withColumn("c", c).select("poly_id", F.floor(col("c.lat") * 1e6 + 0.25).cast("bigint").alias("lat_e6"), F.floor(col("c.lng") * 1e6 + 0.25).cast("bigint").alias("lng_e6"))


@query(
    "point_in_ring",
    fx.sql(
        "fx_obs fx_poly",
        "select event_id, poly_id, lat0_e6 <= lat_e6 and lat_e6 < lat1_e6 and lng0_e6 <= lng_e6 and lng_e6 < lng1_e6 as inside from (select *, event_id % (select count(*) from part) + 1 as pid from fx_obs) join fx_poly on pid = poly_id",
    ),
)
def point_in_ring(spark, sf):
    polys = fx.poly(spark, sf)
    n = fx.table(spark, sf, "part").agg(F.count(F.lit(1)).alias("n"))
    points = fx.obs(spark, sf).crossJoin(F.broadcast(n)).withColumn("poly_id", col("event_id") % col("n") + 1)
    return points.select("event_id", "poly_id", "lat", "lng").join(polys.select("poly_id", "rings"), "poly_id").select("event_id", "poly_id", geometry.contains(col("rings"), col("lat"), col("lng")).alias("inside"))


@query("due_slices", fx.sql("fx_slice", "select id, number from fx_slice where least(number % 31 + 1, 28) = 28 or id = 'france'"))
def due_slices(spark, sf):
    slices = fx.extract(spark, sf).withColumn("day", text.fold_day(col("number") % 31 + 1))
    return slices.where((col("day") == text.fold_day(F.lit(31))) | (col("id") == "france")).select("id", "number")


@query("generation_names", "select n_nationkey as k, n_nationkey % 3 = 0 as own from nation")
def generation_names(spark, sf):
    tail = F.expr("case n_nationkey % 3 when 0 then concat(substr(sha2(n_name, 256), 1, 12), '.wta') when 1 then 'XYZ.wta' else concat('old-', substr(sha2(n_name, 256), 1, 12), '.wta') end")
    n = fx.table(spark, sf, "nation")
    return n.select(col("n_nationkey").alias("k"), text.is_generation(F.concat(F.lower("n_name"), F.lit("-"), tail), F.lower("n_name")).alias("own"))
