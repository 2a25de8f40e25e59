"""Continuous bakes: changed cells of arriving manifests, and lookups of arriving cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import publish


def follow_manifests(manifests: DataFrame, state: str, changes: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Compare each micro-batch of manifests (slice, i, j, sha) with the latest state and append what changed.

    The state is a table under `state`, one folder for each batch, so a repeated batch
    reads the same predecessor and overwrites its own folder only.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        slices = batch.select("slice").distinct()
        new = batch.groupBy("slice", "i", "j").agg(F.max("sha").alias("sha"))
        old = spark.read.parquet(f"{state}/{number - 1}") if number else new.limit(0)
        touched = old.join(slices, "slice", "left_semi")
        keys = ["slice", "i", "j"]
        publish.manifest_diff(touched, new, keys).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{changes}/batch={number}")
        old.join(slices, "slice", "left_anti").select(*keys, "sha").unionByName(new.select(*keys, "sha")).write.mode("overwrite").parquet(f"{state}/{number}")

    writer = manifests.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def answer_cells(requests: DataFrame, cover: DataFrame, tiles: DataFrame, now: str = "fetched_at") -> DataFrame:
    """Answers to a stream of requested cells (request, i, j, fetched_at): a stream-static join, with an expiry.

    An unclaimed cell is uncovered, a claimed one without a tile a hole. One answer for
    each claiming slice; a batch lookup (`archive.resolve`) also picks the first of them.
    """
    from ..functions import grid

    keyed = requests.withColumns({"bi": grid.cover_block("i"), "bj": grid.cover_block("j")})
    listed = keyed.join(cover, ["bi", "bj"], "left").join(tiles.select("slice", "i", "j", F.lit(True).alias("listed")), ["slice", "i", "j"], "left")
    kind = F.when(F.col("slice").isNull(), "uncovered").when(F.col("listed"), "tile").otherwise("hole")
    return publish.expiry(listed.withColumn("kind", kind), now).select("request", "i", "j", "slice", "kind", "expires_at")


def daily_lookups(answers: DataFrame, time: str, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Answers of each kind in tumbling windows of event time, late ones dropped past the watermark."""
    return answers.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), "kind").agg(F.count(F.lit(1)).alias("n")).select("w.start", "kind", "n")


__all__ = ["answer_cells", "daily_lookups", "follow_manifests"]
