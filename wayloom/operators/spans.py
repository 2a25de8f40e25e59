"""Tiles' documents in spans: JSON arrays of bounded size, so that no tile has to be one value.

A span holds some entries of one layer of one tile. The entries of a layer's spans, in the
order of `at`, are the layer's entries in the tile's canonical JSON, byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from .spatial import reach, reached_by

SCHEMA = "i bigint, j bigint, layer string, at bigint, json string"
#: Bytes of entries that are put together at a time: the most that a span holds, but for a single longer entry.
SPAN_BYTES = 8 << 20


def of_lines(lines: DataFrame) -> DataFrame:
    """Spans of lines by id, in every tile whose box has a point of the line in it, as in `spatial.lines_in_tiles`.

    lines: id, layer, points, the columns that order lines of the same id, and json; names (JSON as
    well) are a layer of their own beside the layer ways. Lines are sorted once; what a tile
    lists is never shuffled, as it is put together from each batch of lines.
    """
    return placed(lines).mapInArrow(_lines, SCHEMA)


def placed(lines: DataFrame) -> DataFrame:
    """(layer, points, first, wide, json, names): lines in their order with the tile rows that they may reach, as `listings` takes them."""
    ties = [c for c in lines.columns if c not in ("id", "layer", "points", "json", "names")]
    lats, half = F.col("points")["lat"], F.lit(grid.BOX_HALF_M / grid.M_PER_DEG)
    first, last = reach(F.array_min(lats), half)[0], reach(F.array_max(lats), half)[1]
    # How wide a tile's box is comes with the line, so that it is the same number everywhere.
    wide = F.transform(F.sequence(first, last), lambda i: grid.box_degrees((i + 0.5) * grid.TILE_DEG)[1])
    return lines.sortWithinPartitions("id", "layer", *ties).select("layer", "points", F.coalesce(first, F.lit(0)).alias("first"), F.coalesce(wide, F.array().cast("array<double>")).alias("wide"), "json", "names")


def of_entries(entries: DataFrame, layer: str, band: Column, order: list[str], json: Column) -> DataFrame:
    """Spans of entries that have their tile, i and j, in an order of their own.

    band: a whole number that never falls along that order. Entries of a tile and band are
    sorted together, those of a tile need not be.
    """
    dealt = entries.withColumn("band", band.cast("bigint")).repartition("i", "j", "band")
    return dealt.sortWithinPartitions("i", "j", "band", *order).select(F.lit(layer).alias("layer"), "i", "j", "band", json.alias("json")).mapInArrow(_entries, SCHEMA)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, nth = TaskContext.get().partitionId(), 0
    for name, texts, row, tile in listings(batches):
        for out in _spans(name, texts, row, tile, np.full(len(row), part), nth):
            nth += 1
            yield out


def listings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    """(layer, texts, row, tile) of each layer of each batch: the text at row is listed by a tile."""
    for batch in batches:
        for layer in pc.unique(batch["layer"]).to_pylist():
            own = batch.filter(pc.equal(batch["layer"], layer))
            points = own["points"]
            lat, lng = (c.to_numpy(zero_copy_only=False) for c in points.flatten().flatten())
            size = pc.fill_null(pc.list_value_length(points), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            row, tile = reached_by(lat, lng, size, own["first"].to_numpy(), own["wide"].flatten().to_numpy(zero_copy_only=False), pc.list_value_length(own["wide"]).to_numpy(zero_copy_only=False).astype(np.int64))
            for name, texts in [(layer, own["json"])] + [("names", own["names"])] * (layer == "ways"):
                yield name, texts, row, tile


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nth = 0
    for batch in batches:
        tile = (batch["i"].to_numpy() + grid.ID_ROWS) * grid.ID_STRIDE + batch["j"].to_numpy() + grid.ID_COLS
        for out in _spans(batch["layer"][0].as_py() if len(batch) else "", batch["json"], np.arange(len(batch)), tile, batch["band"].to_numpy(), nth):
            nth += 1
            yield out


def _spans(layer: str, texts: pa.Array, row: np.ndarray, tile: np.ndarray, band: np.ndarray, nth: int) -> Iterator[pa.RecordBatch]:
    """The texts that tiles list, put together. row: of each listing's text, never falling; band: comes before nth in the order."""
    end = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)[row] + 1)
    begin = 0
    while begin < len(row):
        done = end[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(end, done + SPAN_BYTES, "right")))
        order = begin + np.argsort(tile[begin:stop], kind="stable")
        t, b = tile[order], band[order]
        head = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (b[1:] != b[:-1])])
        listed = pa.ListArray.from_arrays(pa.array(np.r_[head, len(t)], pa.int32()), texts.take(pa.array(row[order])))
        json = pc.binary_join_element_wise("[", pc.binary_join(listed, ","), "]", "")
        t = t[head]
        at = ((b[head].astype(np.int64) + 4096) << 40) + nth
        yield pa.RecordBatch.from_arrays([pa.array(t // grid.ID_STRIDE - grid.ID_ROWS), pa.array(t % grid.ID_STRIDE - grid.ID_COLS), pa.array([layer] * len(t), pa.string()), pa.array(at), json], names=["i", "j", "layer", "at", "json"])
        nth += 1
        begin = stop
