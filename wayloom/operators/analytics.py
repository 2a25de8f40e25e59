"""Counts and shares over habitat cells, atlases, landmarks and tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codec, grid

PERCENTILE_BINS = 4096


def distinct_cells(grids: DataFrame) -> DataFrame:
    """One row for each spawn cell of overlapping tile grids; a cell's records agree by construction."""
    return grids.dropDuplicates(["cx", "cy"])


def label_counts(cells: DataFrame, mask: str = "mask") -> DataFrame:
    """(class, n): cells with each class; a cell counts for each of its classes."""
    return cells.select(F.explode(codec.classes(mask)).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def display_counts(cells: DataFrame, mask: str = "mask") -> DataFrame:
    return cells.groupBy(codec.display(mask).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def several_classes(cells: DataFrame, mask: str = "mask") -> DataFrame:
    return cells.agg(F.count_if(F.bit_count(F.col(mask)) > 1).alias("several"), F.count(F.lit(1)).alias("cells"))


def floor_percentile(df: DataFrame, value: str, shares: dict[str, float], within: list[str] | None = None) -> DataFrame:
    """Percentiles by index floor(p * n), the last at most: not the discrete percentile. The value is a number.

    Values are counted first, and dealt into at most PERCENTILE_BINS bins between their
    least and greatest. Running counts go over the bins, which are few, and inside each
    bin, so neither a group's values nor all values meet in one task.
    """
    within = within or []
    counted = df.where(F.col(value).isNotNull()).groupBy(*within, value).agg(F.count(F.lit(1)).alias("c"))
    ends = [F.min(value).alias("lo"), F.max(value).alias("hi"), F.sum("c").alias("n")]
    frame = counted.groupBy(*within).agg(*ends) if within else counted.agg(*ends)
    part = F.try_divide((F.col(value) - F.col("lo")) * F.lit(float(PERCENTILE_BINS)), (F.col("hi") - F.col("lo")).cast("double"))
    rows = counted.join(frame, within) if within else counted.crossJoin(F.broadcast(frame))
    rows = rows.withColumn("bin", F.coalesce(F.floor(part), F.lit(0)).cast("int"))
    before = F.sum("b").over(Window.partitionBy(*within).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    bins = rows.groupBy(*within, "bin").agg(F.sum("c").alias("b")).withColumn("before", F.coalesce(before, F.lit(0))).drop("b")
    upto = F.col("before") + F.sum("c").over(Window.partitionBy(*within, "bin").orderBy(value))
    run = rows.join(bins, [*within, "bin"]).withColumn("upto", upto)
    index = lambda p: F.least(F.col("n") - 1, F.floor(F.col("n") * p))
    agg = [F.min(F.when(F.col("upto") > index(p), F.col(value))).alias(name) for name, p in shares.items()]
    return (run.groupBy(*within) if within else run).agg(*agg)


def distinct_median(df: DataFrame, value: str, within: list[str]) -> DataFrame:
    """Least, greatest and median of the distinct values: the one at index floor(n / 2)."""
    own = df.where(F.col(value).isNotNull()).select(*within, value).distinct()
    middle = floor_percentile(own, value, {"median": 0.5}, within)
    return own.groupBy(*within).agg(F.min(value).alias("least"), F.max(value).alias("most")).join(middle, within)


def block_masks(cells: DataFrame, mask: str = "mask") -> DataFrame:
    """(bx, by, mask): all classes of each atlas block."""
    return cells.groupBy(grid.atlas_block("cx").alias("bx"), grid.atlas_block("cy").alias("by")).agg(F.bit_or(mask).alias("mask"))


def thin_blocks(cells: DataFrame, mask: str = "mask") -> DataFrame:
    """(class, claims, thin): blocks that claim each class, and those where it rests on one cell."""
    each = cells.select(grid.atlas_block("cx").alias("bx"), grid.atlas_block("cy").alias("by"), F.explode(codec.classes(mask)).alias("class"))
    return each.groupBy("bx", "by", "class").count().groupBy("class").agg(F.count(F.lit(1)).alias("claims"), F.count_if(F.col("count") == 1).alias("thin"))


def atlas_check(cells: DataFrame, atlas: DataFrame, mask: str = "mask") -> DataFrame:
    """(bx, by, missing, extra): bits that an atlas lacks or has too many against its cells. atlas: bx, by, mask."""
    real = block_masks(cells, mask).withColumnRenamed("mask", "a")
    both = real.join(atlas.select("bx", "by", F.col("mask").alias("b")), ["bx", "by"], "full_outer").select("bx", "by", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    missing, extra = F.col("a").bitwiseAND(F.bitwise_not(F.col("b"))), F.col("b").bitwiseAND(F.bitwise_not(F.col("a")))
    return both.select("bx", "by", missing.alias("missing"), extra.alias("extra")).where("missing <> 0 or extra <> 0")


def rarest_class(blocks: DataFrame, mask: str = "mask") -> DataFrame:
    """blocks with the rarest class they have; rarity is over all blocks, ties in display order.

    The seven totals are one row, so the join is with a relation of fixed size.
    """
    total = blocks.agg(*(F.count_if(codec.has_class(mask, n)).alias(f"n_{n}") for n in codec.DISPLAY_ORDER))
    joined = blocks.crossJoin(F.broadcast(total))
    options = F.array_compact(F.array(*(F.when(codec.has_class(mask, n), F.struct(F.col(f"n_{n}").alias("n"), F.lit(k).alias("k"), F.lit(n).alias("class"))) for k, n in enumerate(codec.DISPLAY_ORDER))))
    return joined.withColumn("rarest", F.array_min(options)["class"]).drop(*(f"n_{n}" for n in codec.DISPLAY_ORDER))


def drift(cells: DataFrame, stored: str = "classes", record: str = "f") -> DataFrame:
    """How many cells store classes that their record doesn't imply, and how many records are malformed."""
    raw = codec.from_chars(record)
    derived = codec.classes(codec.classify(raw))
    return cells.agg(F.count_if(raw.isNull()).alias("malformed"), F.count_if(raw.isNotNull() & (F.sort_array(F.col(stored)) != F.sort_array(derived))).alias("drifted"))


def histogram(df: DataFrame, key: str) -> DataFrame:
    """(key, n), most frequent first, ties by name."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), key)


def lengths_by_group(credited: DataFrame) -> DataFrame:
    """(cx, cy, res, foot, road): metres of each group of ways in a spawn cell. credited: cx, cy, group, metres."""
    none = F.lit(0).cast(credited.schema["metres"].dataType)
    return credited.groupBy("cx", "cy").agg(*(F.coalesce(F.sum(F.when(F.col("group") == g, F.col("metres"))), none).alias(g) for g in ("res", "foot", "road")))


def listings_by_kind(listings: DataFrame) -> DataFrame:
    """(kind, listings, own): how often landmarks of a kind are listed, and how many different ones."""
    return listings.groupBy("kind").agg(F.count(F.lit(1)).alias("listings"), F.countDistinct("key").alias("own"))


def names_by_kind(listings: DataFrame, most: int = 6) -> DataFrame:
    """(kind, n, first): different names of a kind, and the first of them by name."""
    names = listings.select("kind", "name").where("name is not null").distinct()
    first = names.withColumn("nth", F.row_number().over(Window.partitionBy("kind").orderBy("name"))).where(F.col("nth") <= most)
    shown = first.groupBy("kind").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "name"))), lambda x: x["name"]), "|").alias("first"))
    return names.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).join(shown, "kind")


def kept_share(areas: DataFrame, least: float, area: str = "area") -> DataFrame:
    """(kind, polys_pct, area_pct): share of polygons, and of their area, that are of the least area at least."""
    big, a = F.col(area) >= least, F.col(area)
    share = lambda part, whole: F.round(F.lit(100.0) * part / whole, 4)
    kept = F.sum(F.when(big, a).otherwise(0)).cast("double")
    return areas.groupBy("kind").agg(share(F.count_if(big), F.count(F.lit(1))).alias("polys_pct"), share(kept, F.sum(a).cast("double")).alias("area_pct"))


def reader_counters(log: DataFrame, within: list[str]) -> DataFrame:
    """What a reader did: tiles seen, blocks read, bytes fetched cold and taken from its cache. log: tile, bytes, cold."""
    part = lambda c: F.sum(F.when(c, F.col("bytes")).otherwise(0))
    return log.groupBy(*within).agg(F.countDistinct("tile").alias("tiles"), F.count(F.lit(1)).alias("blocks"), part(F.col("cold")).alias("fetched"), part(~F.col("cold")).alias("cached"))


def sizes(tiles: DataFrame, within: list[str]) -> DataFrame:
    """Tiles, bytes and megabytes of each version. tiles: bytes."""
    return tiles.groupBy(*within).agg(F.count(F.lit(1)).alias("tiles"), F.sum("bytes").alias("bytes"), F.round(F.sum("bytes") / (1 << 20), 6).alias("mb"))


def coarse_totals(polygons: DataFrame) -> DataFrame:
    """(kind, polys, points): polygons of coarse tiles and their points. polygons: kind, rings as flat arrays of latitudes and longitudes."""
    numbers = F.aggregate(F.transform("rings", lambda r: F.size(r)), F.lit(0), lambda a, n: a + n)
    return polygons.groupBy("kind").agg(F.count(F.lit(1)).alias("polys"), F.call_function("div", F.sum(numbers), F.lit(2)).alias("points"))


def layer_cells(fine: DataFrame, coarse: DataFrame) -> DataFrame:
    """(i, j, fine, coarse): cells of either layer, and which of them have it."""
    a, b = (df.select("i", "j").distinct().withColumn(c, F.lit(True)) for df, c in ((fine, "a"), (coarse, "b")))
    return a.join(b, ["i", "j"], "full_outer").select("i", "j", F.col("a").isNotNull().alias("fine"), F.col("b").isNotNull().alias("coarse"))


def grid_cells(grids: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(keep, cx, cy, f) of the cells of habitat grids (cx0, cy0, cols, feat); one from before there were records has no feat and gives none."""
    n = F.call_function("div", F.length("feat"), F.lit(codec.CHARS)).cast("int")
    keep = keep or []
    slots = grids.where(F.coalesce(n, F.lit(0)) > 0).select(*keep, "cx0", "cy0", "cols", "feat", F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    code = F.substring(F.col("feat"), F.col("k") * codec.CHARS + 1, F.lit(codec.CHARS))
    return slots.select(*keep, (F.col("cx0") + F.col("k") % F.col("cols")).alias("cx"), (F.col("cy0") + F.call_function("div", F.col("k"), F.col("cols"))).alias("cy"), code.alias("f"))


def tile_metrics(tiles: DataFrame) -> DataFrame:
    """Counts that a probe looks at, from tiles with nested ways, names, crossings and land cover."""
    ways = F.coalesce(F.col("ways"), F.array().cast(tiles.schema["ways"].dataType))
    inside = lambda p: (grid.tile(p["lat"]) == F.col("i")) & (grid.tile(p["lng"]) == F.col("j"))
    named = F.filter(F.col("names"), lambda n: n.isNotNull() & (n != ""))
    return tiles.select(
        "i",
        "j",
        F.size(ways).alias("ways"),
        F.size(named).alias("named"),
        F.size("crossings").alias("crossings"),
        F.size("landcover").alias("landcover"),
        F.size(F.filter(ways, lambda w: w["lit"].isNotNull() | w["access"].isNotNull())).alias("attr_ways"),
        F.aggregate(ways, F.lit(0), lambda s, w: s + F.size(F.filter(w["points"], inside))).alias("points_in_cell"),
        F.get(named, F.lit(0)).alias("sample_name"),
    )


def problems(kind: Column, expect: Column, version: Column, metrics: dict[str, Column]) -> Column:
    """What is wrong with a probe's answer, as an array of short names; empty if nothing.

    A cell that could not be read is never an absence; a hole and an uncovered cell are
    told apart.
    """
    m = metrics
    legacy = version == "v4"
    is_tile = kind == "tile"
    # Least counts of a dense city cell.
    floors = {"ways": 200, "named": 20, "crossings": 50, "points_in_cell": 100}
    want_v = F.when(version == "v5", 5).otherwise(4)
    answer = F.when(kind == "error", "unresolved")
    empty = F.when((kind == "hole") | ((kind == "absent") & legacy), None).when(kind == "uncovered", "not covered").when(kind == "noindex", "no index").otherwise("not empty")
    bare = F.when((kind == "uncovered") | ((kind == "absent") & legacy), None).when(kind == "hole", "claimed").when(kind == "noindex", "no index").otherwise("present")
    data = F.when(kind == "noindex", "no index").when(kind == "absent", "no object").when(kind == "uncovered", "not baked").when(kind == "hole", "dropped")
    first = F.coalesce(answer, F.when(expect == "empty", empty).when(expect == "uncovered", bare).otherwise(data))
    judged = is_tile & ~expect.isin("empty", "uncovered")
    full = judged & (expect != "any")
    dense = judged & (expect == "dense")
    checks = [
        F.when(judged & (m["v"] != want_v), "version"),
        F.when(full & (m["ways"] < 1), "no ways"),
        F.when(full & (m["points_in_cell"] < 1), "no geometry"),
        *(F.when(dense & (m[k] < n), f"few {k}") for k, n in floors.items()),
        F.when(dense & (version == "v5") & (m["landcover"] < 1), "no landcover"),
    ]
    return F.array_compact(F.array(first, *checks))
