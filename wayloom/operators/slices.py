"""The catalogue of extracts and its registry of slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def leaves(extracts: DataFrame) -> DataFrame:
    """Extracts that are no other's parent. extracts: id, parent."""
    parents = extracts.where("parent is not null").select(F.col("parent").alias("id")).distinct()
    return extracts.join(parents, "id", "left_anti")


def slugged(extracts: DataFrame, name: str = "id", order: str | None = None) -> DataFrame:
    """extracts with a slug of their name; the n-th of one slug, by name or another column, gets -n from the second on.

    The order is that of a dictionary. Numbers are dealt within a slug, so no row sees more than its namesakes.
    """
    base, by = extracts.withColumn("base", text.slug(name)), order or name
    n = F.row_number().over(Window.partitionBy("base").orderBy(F.collate(F.col(by), "UNICODE"), by))
    return base.withColumn("n", n).withColumn("slug", F.when(F.col("n") > 1, F.concat_ws("-", "base", "n")).otherwise(F.col("base"))).drop("base", "n")


def registry(extracts: DataFrame, url: str = "url") -> DataFrame:
    """(name, url, day) of every slice."""
    return slugged(extracts).select(F.col("slug").alias("name"), F.col(url).alias("url"), text.day_of("slug").alias("day"))


def document(slices: DataFrame) -> DataFrame:
    """One row: the registry as a JSON array by name. A registry is written by hand or made from a catalogue, so it is small."""
    rows = F.transform(F.sort_array(F.collect_list(F.struct("name", "url", "day"))), lambda x: x)
    return slices.agg(F.to_json(rows).alias("document"))


def paired(atlases: DataFrame, sidecars: DataFrame, on: str = "id") -> DataFrame:
    """Atlases with the sidecar of the same slice; one without the other isn't checked."""
    return atlases.join(sidecars, on)


def day_balance(slices: DataFrame) -> DataFrame:
    """Fewest and most slices of a day, and how many days have any."""
    return slices.groupBy("day").count().agg(F.min("count").alias("least"), F.max("count").alias("most"), F.count(F.lit(1)).alias("days"))
