"""Queries over archive directories, coverage, lookups, publishing and slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import grid, text
from ..operators import analytics, archive, publish, slices, verify
from ..sources import archive as files
from ..sources import features, shared, sinks
from . import fixtures as fx
from .registry import query

col = F.col
_ID = "(i + 9000) * 36001 + j + 18000"


@query("dir_delta_offset", fx.sql("fx_tile", f"select part, i, j, {_ID} as id, {_ID} - coalesce(lag({_ID}) over w, 0) as delta, cast(coalesce(sum(bytes) over (partition by part order by {_ID} rows between unbounded preceding and 1 preceding), 0) as bigint) as start from fx_tile window w as (partition by part order by {_ID})"))
def dir_delta_offset(spark, sf):
    return archive.directory(fx.tile(spark, sf), ["part"]).select("part", "i", "j", "id", "delta", col("offset").alias("start"))


@query("duplicate_ids", fx.sql("fx_tile", "select i, j, count(*) as n from fx_tile group by i, j having count(*) > 1"))
def duplicate_ids(spark, sf):
    return archive.duplicate_ids(fx.tile(spark, sf)).select("i", "j", col("count").alias("n"))


#: Tiles further apart, so that coverage has gaps.
APART = 7
_FILL = f"t as (select part, i * 13 as i, j * {APART} as j from fx_tile), b as (select distinct part, cast(floor(i / 10.0) as bigint) as bi, cast(floor(j / 10.0) as bigint) as bj from t), g as (select *, lead(bj) over (partition by part, bi order by bj) as nx from b), f as (select part, bi, unnest(range(bj, case when nx - bj - 1 between 1 and 8 then nx else bj + 1 end)) as bj from g)"


def _spread(spark, sf):
    return fx.tile(spark, sf).selectExpr("part", "i * 13 as i", f"j * {APART} as j")


@query("cover_gap_fill", fx.sql("fx_tile", "select part, bi, bj from f", _FILL))
def cover_gap_fill(spark, sf):
    return archive.filled_blocks(_spread(spark, sf), ["part"])


@query(
    "cover_bitmap",
    fx.sql(
        "fx_tile",
        "select part, cast(floor(bit / 8.0) as bigint) as at, cast(sum(1 << cast(bit % 8 as integer)) as bigint) as value from (select f.part, (bi - bi0) * (bj1 - bj0 + 1) + bj - bj0 as bit from f join (select part, min(bi) as bi0, min(bj) as bj0, max(bj) as bj1 from f group by part) e on f.part = e.part) group by 1, 2",
        _FILL,
    ),
)
def cover_bitmap(spark, sf):
    return archive.cover_bytes(_spread(spark, sf), ["part"]).select("part", col("byte").alias("at"), "value")


@query("bbox", fx.sql("fx_tile", "select part, cast(min(i) as bigint) as min_i, cast(max(i) as bigint) as max_i, cast(min(j) as bigint) as min_j, cast(max(j) as bigint) as max_j from fx_tile group by part"))
def bbox(spark, sf):
    return archive.bounds(fx.tile(spark, sf), ["part"])


@query("stride_sample", fx.sql("fx_tile", f"select part, i, j from (select *, row_number() over (partition by part order by {_ID}) - 1 as rn, count(*) over (partition by part) as c from fx_tile) where rn % cast(greatest(1, floor(c / 50.0)) as bigint) = 0"))
def stride_sample(spark, sf):
    return archive.stride_sample(fx.tile(spark, sf), ["part"], 50).select("part", "i", "j")


@query(
    "first_hole",
    fx.sql("fx_tile", "select part, i, j from (select distinct e.part, i, j from e, (select unnest(range(4200, 4261)) as i) ii, (select unnest(range(-7151, -7089)) as j) jj where i between i0 and i1 and j between j0 and j1) c where not exists (select 1 from fx_tile t where t.part = c.part and t.i = c.i and t.j = c.j) qualify row_number() over (partition by part order by i, j) = 1", "e as (select part, min(i) as i0, max(i) as i1, min(j) as j0, max(j) as j1 from fx_tile group by part)"),
)
def first_hole(spark, sf):
    return archive.first_holes(fx.tile(spark, sf), ["part"])


_RES = "c as (select distinct 4190 + event_id % 80 as i, -7160 + (event_id * 7) % 85 as j from events), cov as (select distinct part, cast(floor(i / 10.0) as bigint) as bi, cast(floor(j / 10.0) as bigint) as bj from fx_tile where (i + j) % 4 <> 0 or part > 1)"


@query(
    "resolve_cell",
    fx.sql(
        "fx_tile",
        "select c.i, c.j, case when m.part is null then 'uncovered' when t.n is not null then 'tile' else 'hole' end as kind, m.part, t.bytes from c left join cov m on m.bi = cast(floor(c.i / 10.0) as bigint) and m.bj = cast(floor(c.j / 10.0) as bigint) left join fx_tile t on t.part = m.part and t.i = c.i and t.j = c.j qualify row_number() over (partition by c.i, c.j order by case when t.n is null then 1 else 0 end, m.part) = 1",
        _RES,
    ),
)
def resolve_cell(spark, sf):
    tiles = fx.tile(spark, sf)
    cells = fx.table(spark, sf, "events").selectExpr("4190 + event_id % 80 as i", "-7160 + (event_id * 7) % 85 as j").distinct()
    cover = tiles.where("(i + j) % 4 <> 0 or part > 1").select(col("part").alias("slice"), grid.cover_block("i").alias("bi"), grid.cover_block("j").alias("bj")).distinct()
    found = archive.resolve(cells, cover, tiles.withColumnRenamed("part", "slice").drop("n"))
    return found.select("i", "j", "kind", col("slice").alias("part"), "bytes")


@query("manifest_diff", fx.sql("fx_tile", "select coalesce(a.i, b.i) as i, coalesce(a.j, b.j) as j, case when a.i is null then 'new' when b.i is null then 'removed' else 'changed' end as change from a full join b on a.i = b.i and a.j = b.j where a.i is null or b.i is null or a.sha <> b.sha", "a as (select i, j, sha256(cast(bytes as varchar)) as sha from fx_tile where part = 0), b as (select i, j, sha256(cast(bytes + i % 2 as varchar)) as sha from fx_tile where part = 0 and j % 5 <> 0 or part = 1)"))
def manifest_diff(spark, sf):
    tiles = fx.tile(spark, sf)
    sha = lambda e: F.sha2(F.expr(e).cast("string"), 256).alias("sha")
    return publish.manifest_diff(tiles.where("part = 0").select("i", "j", sha("bytes")), tiles.where("part = 0 and j % 5 <> 0 or part = 1").select("i", "j", sha("bytes + i % 2")))


@query("leaf_extracts", fx.sql("fx_slice", "select id, number from fx_slice where id not in (select parent from fx_slice where parent is not null)"))
def leaf_extracts(spark, sf):
    return slices.leaves(fx.extract(spark, sf)).select("id", "number")


@query("slug_suffix", "select c_custkey as id, case when n > 1 then base || '-' || cast(n as varchar) else base end as slug from (select *, row_number() over (partition by base order by name) as n from (select c_custkey, c_name as name, lower(c_mktsegment) as base from customer))")
def slug_suffix(spark, sf):
    return slices.slugged(fx.table(spark, sf, "customer"), "c_mktsegment", "c_name").select(col("c_custkey").alias("id"), "slug")


_DAY = "cast(list_reduce(list_prepend(cast(0 as bigint), list_transform(string_split(id, ''), lambda c: cast(ascii(c) as bigint))), lambda h, c: (h * 31 + c) % 4294967296) % 28 + 1 as bigint)"


@query("slice_day_balance", fx.sql("fx_slice", f"select min(n) as least, max(n) as most, count(*) as days from (select {_DAY} as day, count(*) as n from fx_slice group by 1)"))
def slice_day_balance(spark, sf):
    return slices.day_balance(fx.extract(spark, sf).select("id", text.day_of("id").alias("day")))


@query("slice_registry", fx.sql("fx_slice", f"select slug as name, 'x/' || id as url, {_DAY.replace('split(id', 'split(slug')} as day from (select id, regexp_replace(id, '[^a-z0-9]+', '-', 'g') as slug from fx_slice)"))
def slice_registry(spark, sf):
    return slices.registry(fx.extract(spark, sf).withColumn("url", F.concat(F.lit("x/"), "id")))


_GEN = "g as (select 's' || cast(c_custkey % 9 as varchar) as slice, 's' || cast(c_custkey % 9 as varchar) || '-' || substr(sha256(c_name), 1, 12) || '.wta' as file, c_custkey * 31 % 997 as modified from customer)"


def _generations(spark, sf):
    name = F.concat(F.lit("s"), (col("c_custkey") % 9).cast("string"))
    return fx.table(spark, sf, "customer").select(name.alias("slice"), F.concat(name, F.lit("-"), text.short_digest("c_name"), F.lit(".wta")).alias("file"), (col("c_custkey") * 31 % 997).alias("modified"))


@query("retention_two", f"with {_GEN} select slice, file, row_number() over (partition by slice order by modified desc, file desc) <= 2 as keep from g")
def retention_two(spark, sf):
    return publish.retained(_generations(spark, sf)).select("slice", "file", "keep")


@query("own_generations", f"with {_GEN} select file, slice from g where slice in ('s1', 's4')")
def own_generations(spark, sf):
    files = _generations(spark, sf)
    return publish.own_generations(files.select("file"), files.select(col("slice").alias("name")).distinct().where("name in ('s1', 's4')"))


@query(
    "publish_gate",
    f"with {_GEN}, n as (select slice, 'v5' as version, max(file) as sha from g group by slice), o as (select slice, 'v5' as version, case when slice in ('s1', 's2') then max(file) else min(file) end as sha from g where slice <> 's3' group by slice) select n.slice, n.version, n.sha from n left join o on n.slice = o.slice where o.sha is null or n.sha <> o.sha",
)
def publish_gate(spark, sf):
    g = _generations(spark, sf)
    own = lambda sha: [F.lit("v5").alias("version"), sha.alias("sha")]
    built = g.groupBy("slice").agg(*own(F.max("file")))
    old = g.where("slice <> 's3'").groupBy("slice").agg(F.lit("v5").alias("version"), F.when(col("slice").isin("s1", "s2"), F.max("file")).otherwise(F.min("file")).alias("sha"))
    return publish.to_upload(built, old).select("slice", "version", "sha")


def _bodies(spark, sf):
    """Every part's tiles as packed bodies of an archive."""
    empty = lambda kind: F.array().cast(kind)
    tiles = fx.tile(spark, sf).withColumns({"slice": F.concat(F.lit("s"), col("part").cast("string")), "ways": empty("array<struct<points:array<struct<lat:double,lng:double>>,foot:boolean>>"), "names": F.array(col("n").cast("string")), "crossings": empty("array<struct<lat:double,lng:double>>")})
    return sinks.tile_bodies(tiles, "v4")


@query("archive_index", fx.sql("fx_tile", "select 's' || cast(part as varchar) as slice, cast(count(*) as integer) as tile_count, min(i) || ',' || max(i) || ',' || min(j) || ',' || max(j) as bbox, cast(count(*) * 2 as integer) as copies from fx_tile group by part"))
def archive_index(spark, sf):
    """Index entries of every part's archive, of two versions of which one is packed, written down and read again."""
    folder = shared.folder(spark, "archives")
    both = _bodies(spark, sf).unionByName(_bodies(spark, sf).withColumn("version", F.lit("v5")))
    entries = files.write_archives(both, folder, ["v5"])
    entries.agg(F.to_json(F.collect_list(F.struct(*entries.columns))).alias("value")).coalesce(1).write.text(f"{folder}/index")
    index = features.archive_index(spark, f"{folder}/index")
    return index.where("version = 'v5'").select("slice", col("tileCount").alias("tile_count"), F.concat_ws(",", F.transform("bbox", lambda x: x.cast("string"))).alias("bbox"), (col("tileCount") * 2).alias("copies"))


@query("unfinished_slices", fx.sql("fx_slice", "select id as name from fx_slice where number % 3 <> 0"))
def unfinished_slices(spark, sf):
    own = fx.extract(spark, sf).withColumnRenamed("id", "name")
    return publish.unfinished(own.select("name"), own.where("number % 3 = 0"))


@query("body_equality", fx.sql("fx_tile", "select coalesce(a.i, b.i) as i, coalesce(a.j, b.j) as j from (select * from fx_tile where part = 0) a full join (select * from fx_tile where part = 1) b on a.i = b.i and a.j = b.j where a.n is null or b.n is null or a.n <> b.n"))
def body_equality(spark, sf):
    """Tiles of two parts whose packed bodies differ, or that one of them lacks."""
    bodies = _bodies(spark, sf)
    return files.first_difference(bodies.where("slice = 's0'"), bodies.where("slice = 's1'"))


_STATES = "case event_id % 7 when 0 then 'hole' when 1 then 'uncovered' when 2 then 'noindex' when 3 then 'absent' when 4 then 'error' else 'tile' end"
_EXPECTS = "case event_id % 5 when 0 then 'dense' when 1 then 'sparse' when 2 then 'any' when 3 then 'empty' else 'uncovered' end"
_PROBE = f"p as (select event_id, {_STATES} as kind, {_EXPECTS} as expect, case when user_id % 3 = 0 then 'v4' else 'v5' end as version, event_id % 300 as ways, user_id % 40 as named, event_id % 90 as crossings, event_id % 150 as pts, event_id % 2 as landcover, 4 + event_id % 2 as v from events)"


@query(
    "probe_judge",
    f"with {_PROBE}, "
    "a as (select *, case when kind = 'error' then 'unresolved' when expect = 'empty' then case when kind = 'hole' or (kind = 'absent' and version = 'v4') then null when kind = 'uncovered' then 'not covered' when kind = 'noindex' then 'no index' else 'not empty' end "
    "when expect = 'uncovered' then case when kind = 'uncovered' or (kind = 'absent' and version = 'v4') then null when kind = 'hole' then 'claimed' when kind = 'noindex' then 'no index' else 'present' end "
    "else case kind when 'noindex' then 'no index' when 'absent' then 'no object' when 'uncovered' then 'not baked' when 'hole' then 'dropped' end end as first, kind = 'tile' and expect not in ('empty', 'uncovered') as judged from p) "
    "select event_id, concat_ws(';', first, case when judged and v <> case when version = 'v5' then 5 else 4 end then 'version' end, case when judged and expect <> 'any' and ways < 1 then 'no ways' end, case when judged and expect <> 'any' and pts < 1 then 'no geometry' end, "
    "case when judged and expect = 'dense' and ways < 200 then 'few ways' end, case when judged and expect = 'dense' and named < 20 then 'few named' end, case when judged and expect = 'dense' and crossings < 50 then 'few crossings' end, case when judged and expect = 'dense' and pts < 100 then 'few points_in_cell' end, "
    "case when judged and expect = 'dense' and version = 'v5' and landcover < 1 then 'no landcover' end) as problems from a",
)
def probe_judge(spark, sf):
    p = fx.table(spark, sf, "events").selectExpr("event_id", f"{_STATES} as kind", f"{_EXPECTS} as expect", "case when user_id % 3 = 0 then 'v4' else 'v5' end as version", "event_id % 300 as ways", "user_id % 40 as named", "event_id % 90 as crossings", "event_id % 150 as pts", "event_id % 2 as landcover", "4 + event_id % 2 as v")
    metrics = {k: col(k) for k in ("ways", "named", "crossings", "landcover", "v")} | {"points_in_cell": col("pts")}
    found = analytics.problems(col("kind"), col("expect"), col("version"), metrics)
    return p.select("event_id", F.array_join(found, ";").alias("problems"))


@query("probe_totals", f"with {_PROBE}, q as (select kind = 'error' as bad, expect in ('dense', 'any', 'empty') as own from p) select cast(sum(case when own and not bad then 1 else 0 end) as bigint) as passed, cast(sum(case when own and bad then 1 else 0 end) as bigint) as failed, cast(sum(case when not own then 1 else 0 end) as bigint) as skipped from q")
def probe_totals(spark, sf):
    """Probes of three expected slices, named like what they expect; an unreadable cell fails."""
    p = fx.table(spark, sf, "events").selectExpr(f"{_EXPECTS} as slice", f"case when ({_STATES}) = 'error' then array('unresolved') else cast(array() as array<string>) end as problems")
    return verify.totals(p, ["dense", "any", "empty"])


@query("probe_versions", fx.sql("fx_slice", "select id, v as version from fx_slice, (select unnest(['v4', 'v5', 'v5c']) as v) where number % 2 = 0 or v <> 'v5c'"))
def probe_versions(spark, sf):
    return verify.probed_versions(fx.extract(spark, sf).select("id", "number"), col("number") % 2 == 0).select("id", "version")


@query("cache_expiry", f"select event_id, kind, ts + to_seconds(case kind when 'hole' then 2592000 when 'uncovered' then 300 else 3600 end) as expires_at from (select event_id, ts, {_STATES} as kind from events)")
def cache_expiry(spark, sf):
    e = fx.table(spark, sf, "events").select("event_id", "ts", F.expr(_STATES).alias("kind"))
    return publish.expiry(e, "ts").select("event_id", "kind", "expires_at")


@query("archive_roundtrip", fx.sql("fx_tile", "select 's' || cast(part as varchar) as slice, count(*) as tiles, count(*) as same from fx_tile group by part"))
def archive_roundtrip(spark, sf):
    """Each part's tiles packed into an archive and read back through its directory: whether every byte returned."""
    folder = shared.folder(spark, "archives")
    bodies = _bodies(spark, sf)
    written = files.write_archives(bodies, folder).agg(F.sum("tileCount")).first()[0]
    back = files.read_archives(spark, f"{folder}/v4")
    both = back.join(bodies.select("slice", "i", "j", col("body").alias("was")), ["slice", "i", "j"], "full_outer")
    own = both.groupBy("slice").agg(F.count("body").alias("tiles"), F.count_if(col("body") == col("was")).alias("same"))
    return own.where(F.lit(written) > 0)


@query("tile_bodies", fx.sql("fx_tile", "select 's' || cast(part as varchar) as slice, i, j, sha256('{\"v\":4,\"ways\":[],\"names\":[\"' || cast(n as varchar) || '\"],\"crossings\":[]}') as sha, true as same from fx_tile"))
def tile_bodies(spark, sf):
    """Canonical JSON of tiles, packed and unpacked again: digest and whether it came back."""
    return features.payloads(_bodies(spark, sf)).select("slice", "i", "j", "sha", (F.sha2("body", 256) == col("sha")).alias("same"))


@query("raster_blocks", fx.sql("fx_dem", "select cast(floor(cx / 16.0) as bigint) as bx, cast(floor(cy / 16.0) as bigint) as b_y, count(*) as cells, cast(coalesce(sum(e), 0) as bigint) as total, cast(0 as bigint) as bad from fx_dem group by 1, 2"))
def raster_blocks(spark, sf):
    """Elevations by block of 16 x 16 cells, encoded as a raster block and decoded again: cells, their sum and differences."""
    import numpy as np
    import pyarrow as pa

    from ..sources import elevation

    def run(table: pa.Table) -> pa.Table:
        x, y = table["cx"].to_numpy(), table["cy"].to_numpy()
        e = table["e"].to_numpy(zero_copy_only=False).astype(np.float32)
        block = np.full((16, 16), np.nan, np.float32)
        block[y % 16, x % 16] = e
        back = elevation.decode_block(elevation.encode_block(block), 16, 16)
        bad = int(((back != block) & ~(np.isnan(back) & np.isnan(block))).sum())
        return pa.table({"bx": [int(x[0] // 16)], "b_y": [int(y[0] // 16)], "cells": [len(x)], "total": [int(np.nansum(back))], "bad": [bad]})

    cells = fx.dem(spark, sf).withColumns({"bx": grid.floor_div("cx", 16), "b_y": grid.floor_div("cy", 16)})
    return cells.groupBy("bx", "b_y").applyInArrow(run, "bx long, b_y long, cells long, total long, bad long")
