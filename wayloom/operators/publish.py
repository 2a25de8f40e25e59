"""What changed, what to upload, what to keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def manifest_diff(old: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, change): cells that are new, changed or removed between two manifests of digests."""
    keys = keys or ["i", "j"]
    both = old.select(*keys, F.col("sha").alias("a")).join(new.select(*keys, F.col("sha").alias("b")), keys, "full_outer")
    change = F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return both.withColumn("change", change).where("change is not null").drop("a", "b")


def retained(generations: DataFrame, keep: int = 2) -> DataFrame:
    """Generations with whether they stay: the newest of a slice. generations: slice, file, modified."""
    order = Window.partitionBy("slice").orderBy(F.col("modified").desc(), F.col("file").desc())
    return generations.withColumn("keep", F.row_number().over(order) <= keep)


def own_generations(files: DataFrame, slices: DataFrame) -> DataFrame:
    """Archive files with the slice they are a generation of. Longer names win nothing: the digest's pattern tells them apart."""
    named = files.withColumn("slice", F.regexp_extract("file", r"^(.*)-[0-9a-f]{12}\.wta$", 1)).where("slice <> ''")
    return named.join(slices.select(F.col("name").alias("slice")).distinct(), "slice", "left_semi")


def to_upload(built: DataFrame, published: DataFrame) -> DataFrame:
    """Archives whose digest isn't the published one. Both: slice, version, sha."""
    now = published.select("slice", "version", F.col("sha").alias("old"))
    return built.join(now, ["slice", "version"], "left").where(~F.col("sha").eqNullSafe(F.col("old"))).drop("old")


def assert_indexed(index: DataFrame, slice_name: str, sha: str) -> None:
    """Fail unless the index holds an archive just published."""
    if index.where((F.col("slice") == slice_name) & (F.col("sha") == sha)).isEmpty():
        raise RuntimeError(f"{slice_name} isn't in the index under {sha[:12]}")


def unfinished(slices: DataFrame, done: DataFrame) -> DataFrame:
    """Slices still to be made: those without a mark of an earlier run."""
    return slices.join(done.select("name").distinct(), "name", "left_anti")


def due(slices: DataFrame, day: int, only: str | None = None, force_all: bool = False) -> DataFrame:
    """Slices of a day of the month; a named slice comes before all, and all before the day."""
    if only:
        return slices.where(F.col("name") == only)
    return slices if force_all else slices.where(F.col("day") == text.fold_day(F.lit(day)))


def expiry(resolved: DataFrame, now: str = "fetched_at") -> DataFrame:
    """When a client may ask again: holes keep for 30 days, uncovered cells five minutes, all else an hour."""
    life = F.when(F.col("kind") == "hole", 30 * 86400).when(F.col("kind") == "uncovered", 300).otherwise(3600)
    return resolved.withColumn("expires_at", F.col(now) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), life.cast("decimal(18,6)")))
