"""Map relations derived from the supplied tables by whole-number arithmetic.

None of the supplied tables is geographic. Each relation here exists twice: as a
DataFrame and as the text of a common table expression for the oracle. Both use the
same formulas on operands that are never negative under a remainder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Vocabularies that row numbers are mapped to.
HIGHWAYS = ["footway", "path", "pedestrian", "steps", "track", "living_street", "residential", "service", "unclassified", "primary", "tertiary_link", "motorway"]
LITS = ["yes", "24/7", "no", "disused", "maybe"]
ACCESSES = ["private", "no", "permissive", "destination"]
KINDS = ["city", "town", "village", "hamlet", "suburb", "peak", "national_park", "protected_area", "park", "library", "cemetery", "nature_reserve"]

LAT = "42000000 + ({} * 7919 + {} * 104729) % 60000"
LNG = "-71500000 + ({} * 15877 + {} * 1299709) % 60000"


def _case(expr: str, values: list[str]) -> str:
    return f"case {expr} " + " ".join(f"when {k} then '{v}'" for k, v in enumerate(values)) + " end"


_OBS = [
    "event_id", "event_type", f"{LAT.format('event_id', 'user_id')} as lat_e6", f"{LNG.format('event_id', 'user_id')} as lng_e6", "cast(floor(value * 10) as bigint) as len_dm",
]
_CELL_KEYS = ["cast(floor(lng_e6 / 1500.0) as bigint) as cx", "cast(floor(lat_e6 / 1500.0) as bigint) as cy"]
_DEM_E = "case when (1000000 + cx * 7 + cy * 13) % 10 = 0 then null else ((1000000 + cx) * 31 + cy * cy * 17 + (1000000 + cx) * cy * 7) % 1200 end as e"
_SUMS = [
    "cast(sum(case when event_type = 'view' then len_dm else 0 end) as bigint) as res", "cast(sum(case when event_type = 'click' then len_dm else 0 end) as bigint) as foot",
    "cast(sum(case when event_type not in ('view', 'click') then len_dm else 0 end) as bigint) as road",
]
_MASKS = ["(1000000 + cx + cy) % 16 as wood", "(1000000 + cx * 3 + cy) % 16 as green", "case when (1000000 + cx + cy * 5) % 7 = 0 then 15 else 0 end as water"]
_POLY = [
    "p_partkey as poly_id",
    "case when p_type like 'ECONOMY%' then 'water' when p_type like 'PROMO%' then 'wood' when p_type like 'STANDARD%' then 'green' else 'field' end as kind",
    "42000000 + (p_partkey * 7919) % 60000 as lat0_e6",
    "-71500000 + (p_partkey * 15877) % 60000 as lng0_e6",
    "42000000 + (p_partkey * 7919) % 60000 + p_size * 200 as lat1_e6",
    "-71500000 + (p_partkey * 15877) % 60000 + p_size * 200 as lng1_e6",
]
_LANDMARK = [
    "s_suppkey as lm_id", "s_name as name", f"{_case('s_suppkey % 12', KINDS)} as kind", "42000000 + (s_suppkey * 7919) % 60000 as lat_e6", "-71500000 + (s_suppkey * 15877) % 60000 as lng_e6",
    "greatest(0, cast(floor(s_acctbal * 100) as bigint) * 20) as area_m2", "cast(s_suppkey * 37 % 900 as bigint) as ele",
]
_WAY = [
    "o_orderkey as way_id", f"{_case('o_orderkey % 12', HIGHWAYS)} as highway", f"{_case('o_orderkey % 7', LITS)} as lit", f"{_case('o_orderkey % 9', ACCESSES)} as access",
    "case when o_orderkey % 3 = 0 then o_orderpriority end as name",
]
_VERTEX = ["l_orderkey as way_id", "l_linenumber as n", f"{LAT.format('l_orderkey', 'l_linenumber')} as lat_e6", f"{LNG.format('l_orderkey', 'l_linenumber')} as lng_e6"]
_TILE = ["4200 + (c_custkey * 7919) % 60 as i", "-7150 + (c_custkey * 15877 + c_nationkey * 31) % 60 as j", "100 + cast(floor(abs(c_acctbal)) as bigint) as sz", "c_nationkey % 4 as part"]

_join = ", ".join
CTE = {
    "fx_obs": f"select {_join(_OBS)} from events",
    "fx_dem": f"select cx, cy, {_DEM_E} from (select distinct {_join(_CELL_KEYS)} from fx_obs)",
    "fx_cell": f"select cx, cy, {_join(_SUMS)} from (select {_join(_CELL_KEYS)}, event_type, len_dm from fx_obs) group by cx, cy",
    "fx_rec": f"select c.cx, c.cy, res, foot, road, {_join(m.replace('cx', 'c.cx').replace('cy', 'c.cy') for m in _MASKS)}, e as relief from fx_cell c join fx_dem d on c.cx = d.cx and c.cy = d.cy",
    "fx_poly": f"select {_join(_POLY)} from part",
    "fx_landmark": f"select {_join(_LANDMARK)} from supplier",
    "fx_way": f"select {_join(_WAY)} from orders",
    "fx_vertex": f"select {_join(_VERTEX)} from lineitem",
    "fx_tile": f"select part, i, j, cast(count(*) as bigint) as n, cast(sum(sz) as bigint) as bytes from (select {_join(_TILE)} from customer) group by part, i, j",
    "fx_slice": "select lower(n_name) as id, lower(r_name) as parent, n_nationkey as number from nation join region on n_regionkey = r_regionkey union all select lower(r_name), cast(null as varchar(20)), 1000 + r_regionkey from region",
}
NEEDS = {"fx_dem": ["fx_obs"], "fx_cell": ["fx_obs"], "fx_rec": ["fx_cell", "fx_dem"]}

#: The record of fx_rec, its fields in steps of ten metres, and its class mask, as SQL.
RECORD_SQL = """fx_code as (select cx, cy, least(255, cast(floor(res / 100.0) as bigint)) as r, least(255, cast(floor(foot / 100.0) as bigint)) as f, least(255, cast(floor(road / 100.0) as bigint)) as d,
  cast(wood as bigint) as wood, cast(green as bigint) as green, cast(water as bigint) as water, case when relief is null then 511 else least(510, cast(floor(relief / 10.0) as bigint)) end as h from fx_rec),
fx_record as (select *, r + f * 256 + d * 65536 + wood * 16777216 + green * 268435456 + water * 4294967296 + h * 68719476736 as record, r + f + d as total from fx_code),
fx_rule as (select *, bit_count(wood | green) * 2 >= 4 and f > 0 or (f >= 12 and f * 10 >= total * 7) as is_green, bit_count(wood) > 0 and bit_count(wood) >= bit_count(green) as woody from fx_record),
fx_mask as (select *, case when total = 0 then 32 else coalesce(nullif(
  case when total >= 90 and r * 100 <= total * 35 then 1 else 0 end + case when r >= 12 and r * 10 >= total * 4 then 2 else 0 end
  + case when is_green and woody then 4 else 0 end + case when is_green and not woody then 8 else 0 end
  + case when h < 511 and h >= 50 then 16 else 0 end + case when bit_count(water) >= 1 and f > 0 then 64 else 0 end, 0), 32) end as mask from fx_rule)"""


def sql(names: str, body: str, more: str = "") -> str:
    """An oracle: the named relations (and what they need), more expressions, and the query."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in names.split():
        add("fx_rec" if name == "fx_mask" else name)
    parts = [f"{n} as ({CTE[n]})" for n in order]
    if "fx_mask" in names.split():
        parts.append(RECORD_SQL)
    if more:
        parts.append(more)
    return "with " + ",\n".join(parts) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_OBS).withColumns({"lat": F.col("lat_e6") / F.lit(1e6), "lng": F.col("lng_e6") / F.lit(1e6)})


def obs_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs(spark, sf_dir).selectExpr("*", *_CELL_KEYS)


def dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_cells(spark, sf_dir).select("cx", "cy").distinct().selectExpr("cx", "cy", _DEM_E)


def cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_cells(spark, sf_dir).groupBy("cx", "cy").agg(*(F.expr(x) for x in _SUMS))


def rec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cell(spark, sf_dir).join(dem(spark, sf_dir), ["cx", "cy"]).selectExpr("cx", "cy", "res", "foot", "road", *_MASKS, "e as relief")


def record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cx, cy, record and mask of every observed cell."""
    from ..functions import codec

    col = F.col
    r = codec.encode_int(col("res") / 10, col("foot") / 10, col("road") / 10, col("wood"), col("green"), col("water"), col("relief"))
    return rec(spark, sf_dir).withColumn("record", r).withColumn("mask", codec.classify("record")).select("cx", "cy", "record", "mask")


def poly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles with their box in degrees and their ring."""
    df = table(spark, sf_dir, "part").selectExpr(*_POLY)
    df = df.withColumns({k: F.col(f"{k}_e6") / F.lit(1e6) for k in ("lat0", "lat1", "lng0", "lng1")})
    corner = lambda a, b: F.struct(F.col(a).alias("lat"), F.col(b).alias("lng"))
    ring = F.array(corner("lat0", "lng0"), corner("lat0", "lng1"), corner("lat1", "lng1"), corner("lat1", "lng0"))
    return df.withColumn("ring", ring).withColumn("rings", F.array("ring"))


def landmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "supplier").selectExpr(*_LANDMARK)
    return df.withColumns({"lat": F.col("lat_e6") / F.lit(1e6), "lng": F.col("lng_e6") / F.lit(1e6)})


def way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_WAY)


def vertex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_VERTEX).withColumns({"lat": F.col("lat_e6") / F.lit(1e6), "lng": F.col("lng_e6") / F.lit(1e6)})


def tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").selectExpr(*_TILE)
    return df.groupBy("part", "i", "j").agg(F.count(F.lit(1)).alias("n"), F.sum("sz").alias("bytes"))


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    inner = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr("lower(n_name) as id", "lower(r_name) as parent", "n_nationkey as number")
    return inner.unionByName(region.selectExpr("lower(r_name) as id", "cast(null as string) as parent", "1000 + r_regionkey as number"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(way_id, points) of all ways, their points in order."""
    own = vertex(spark, sf_dir).groupBy("way_id").agg(F.sort_array(F.collect_list(F.struct("n", "lat", "lng"))).alias("p"))
    return own.select("way_id", F.transform("p", lambda x: F.struct(x["lat"].alias("lat"), x["lng"].alias("lng"))).alias("points"))


def _tags(**values) -> F.Column:
    pairs = F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items()))
    return F.map_from_entries(F.filter(pairs, lambda x: x["value"].isNotNull()))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as a stream has them: ways (footways are crossings too), observed nodes (every third a crossing), and parts as areas."""
    ways = way(spark, sf_dir).join(lines(spark, sf_dir), "way_id")
    crossing = F.when(F.col("highway") == "footway", "crossing")
    line = ways.select(F.concat(F.lit("w"), F.col("way_id").cast("string")).alias("id"), F.lit("w").alias("object"), _tags(highway=F.col("highway"), lit=F.col("lit"), access=F.col("access"), name=F.col("name"), footway=crossing).alias("tags"), F.col("points").alias("line"))
    third = F.col("event_id") % 3 == 0
    node = obs(spark, sf_dir).select(F.concat(F.lit("n"), F.col("event_id").cast("string")).alias("id"), F.lit("n").alias("object"), _tags(highway=F.when(third, "crossing"), natural=F.when(~third, "tree")).alias("tags"), F.struct("lat", "lng").alias("point"))
    is_kind = lambda kind, value: F.when(F.col("kind") == kind, value)
    area = poly(spark, sf_dir).select(F.concat(F.lit("a"), F.col("poly_id").cast("string")).alias("id"), F.lit("a").alias("object"), _tags(natural=F.coalesce(is_kind("water", "water"), is_kind("wood", "wood")), leisure=is_kind("green", "park"), landuse=is_kind("field", "farmland")).alias("tags"), F.array("rings").alias("polygons"))
    return line.unionByName(node, allowMissingColumns=True).unionByName(area, allowMissingColumns=True)


def stream(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write the features as a stream of one JSON feature a line, record separators before them; returns the path."""
    pair = lambda p: F.array(p["lng"], p["lat"])
    ring = lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), pair)
    shape = lambda kind, at: F.concat(F.lit('{"type":"' + kind + '","coordinates":'), at, F.lit("}"))
    point = F.concat(F.lit("["), F.col("point.lng").cast("string"), F.lit(","), F.col("point.lat").cast("string"), F.lit("]"))
    geometry = F.when(F.col("point").isNotNull(), shape("Point", point)).when(F.col("line").isNotNull(), shape("LineString", F.to_json(F.transform("line", pair)))).otherwise(shape("MultiPolygon", F.to_json(F.transform("polygons", lambda p: F.transform(p, ring)))))
    whole = F.concat(F.lit('\x1e{"type":"Feature","id":"'), F.col("id"), F.lit('","properties":'), F.to_json("tags"), F.lit(',"geometry":'), geometry, F.lit("}"))
    features(spark, sf_dir).select(whole.alias("value")).write.text(path)
    return path
