"""Elevation rasters: one-degree TIFF tiles of deflated float blocks, read block by block.

Tiles are TIFF 6.0 files with the floating-point predictor. What is accepted is declared
in PROFILE; any other layout is an error, as a raster decoded wrongly would be a wrong
elevation. Format "dem" makes a partition of every block that a box touches.
"""

from __future__ import annotations

import math
import zlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.grid import DEM_ROWS
from . import ranges

#: Fixed values of TIFF 6.0: byte order marks, the field types by their codes, the fields used and their defaults.
ORDERS = {b"II": "<", b"MM": ">"}
TYPES = {1: "u1", 2: "S1", 3: "u2", 4: "u4", 5: "2u4", 6: "i1", 7: "V1", 8: "i2", 9: "i4", 10: "2i4", 11: "f4", 12: "f8"}
FIELDS = {"ImageWidth": 256, "ImageLength": 257, "BitsPerSample": 258, "Compression": 259, "SamplesPerPixel": 277, "Predictor": 317, "TileWidth": 322, "TileLength": 323, "TileOffsets": 324, "TileByteCounts": 325, "SampleFormat": 339}
DEFAULTS = {"BitsPerSample": 1, "Compression": 1, "SamplesPerPixel": 1, "Predictor": 1, "SampleFormat": 1}
#: What the rasters have: 32-bit floats, one a pixel, deflated with the floating-point predictor.
PROFILE = {"BitsPerSample": 32, "SamplesPerPixel": 1, "SampleFormat": 3, "Compression": 8, "Predictor": 3}
HEAD_BYTES = 1 << 16


@dataclass
class Raster:
    width: int
    height: int
    block_width: int
    block_height: int
    offsets: list[int]
    counts: list[int]


class Directory:
    """The first image file directory of a TIFF, whose fields are looked up by name."""

    def __init__(self, raw: bytes):
        self.raw, self.order = raw, ORDERS.get(bytes(raw[:2]))
        if self.order is None or len(raw) < 8 or self._array("u2", 2, 1)[0] != 42:
            raise ValueError("no classic TIFF")
        place = int(self._array("u4", 4, 1)[0])
        entry = np.dtype([("tag", f"{self.order}u2"), ("type", f"{self.order}u2"), ("count", f"{self.order}u4"), ("value", "V4")])
        many = int(self._array("u2", place, 1)[0])
        self._need(place + 2, many * entry.itemsize)
        self.first = place + 2
        self.entries = np.frombuffer(raw, entry, many, self.first)

    def _need(self, place: int, size: int) -> None:
        if place + size > len(self.raw):
            raise ValueError(f"bytes {place} to {place + size} lie behind the {len(self.raw)} that were read")

    def _array(self, kind: str, place: int, count: int) -> np.ndarray:
        dtype = np.dtype(kind).newbyteorder(self.order)
        self._need(place, dtype.itemsize * count)
        return np.frombuffer(self.raw, dtype, count, place)

    def values(self, name: str) -> np.ndarray:
        """All values of a field; its default if it is missing."""
        found = np.flatnonzero(self.entries["tag"] == FIELDS[name])
        if not len(found):
            if name not in DEFAULTS:
                raise ValueError(f"{name} is missing")
            return np.array([DEFAULTS[name]])
        kind, count = int(self.entries["type"][found[0]]), int(self.entries["count"][found[0]])
        if kind not in TYPES or not count:
            raise ValueError(f"{name} has {count} values of the type {kind}")
        place = self.first + int(found[0]) * self.entries.itemsize + 8
        if np.dtype(TYPES[kind]).itemsize * count > 4:  # longer values stand elsewhere
            place = int(self._array("u4", place, 1)[0])
        return self._array(TYPES[kind], place, count)

    def number(self, name: str) -> int:
        return int(self.values(name)[0])


def parse_header(raw: bytes, rows: int = DEM_ROWS) -> Raster:
    """Layout of a raster from its first bytes; one that is not as declared is refused with all that differs."""
    try:
        d = Directory(raw)
        wrong = [f"{name} is {d.number(name)}, not {want}" for name, want in (PROFILE | {"ImageLength": rows}).items() if d.number(name) != want]
        if wrong:
            raise ValueError("; ".join(wrong))
        return Raster(d.number("ImageWidth"), rows, d.number("TileWidth"), d.number("TileLength"), d.values("TileOffsets").tolist(), d.values("TileByteCounts").tolist())
    except ValueError as e:
        raise ValueError(f"elevation raster refused: {e}") from None


def decode_block(raw: bytes, width: int, height: int) -> np.ndarray:
    """Floats of a deflated block: undo the running byte sum of each row, then put the byte planes together."""
    data = zlib.decompress(raw)
    if len(data) != 4 * width * height:
        raise ValueError(f"elevation: a block of {len(data)} bytes, not {4 * width * height}")
    planes = np.cumsum(np.frombuffer(data, np.uint8).reshape(height, 4 * width), axis=1, dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(height, 4, width).transpose(0, 2, 1)).view(">f4").reshape(height, width).astype(np.float32)


def encode_block(values: np.ndarray) -> bytes:
    """The inverse of `decode_block`, for tests and for staging."""
    height, width = values.shape
    planes = values.astype(">f4").view(np.uint8).reshape(height, width, 4).transpose(0, 2, 1).reshape(height, 4 * width)
    return zlib.compress(np.diff(planes, axis=1, prepend=np.zeros((height, 1), np.uint8)).astype(np.uint8).tobytes())


def tile_name(lat: int, lng: int) -> str:
    return f"{'N' if lat >= 0 else 'S'}{abs(lat):02d}_00_{'E' if lng >= 0 else 'W'}{abs(lng):03d}_00"


@dataclass
class _Block(InputPartition):
    path: str
    lat: int
    lng: int
    column: int
    row: int
    raster: Raster | None
    number: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"].rstrip("/")
        self.rows = int(options.get("rows", DEM_ROWS))
        self.cache = options.get("cache")
        self.box = [float(options[k]) for k in ("south", "north", "west", "east")]

    def _head(self, corner: tuple[int, int]) -> Raster | None:
        raw = ranges.cached(self.cache, self._path(corner), 0, HEAD_BYTES)
        return None if raw is None else parse_header(raw, self.rows)

    def _path(self, corner: tuple[int, int]) -> str:
        return f"{self.folder}/{tile_name(*corner)}.tif"

    def partitions(self):
        """Blocks that the box touches, with a margin of one post. A missing file is an unpublished tile: no data."""
        south, north, west, east = self.box
        margin = 1 / self.rows
        corners = [(lat, lng) for lat in range(math.floor(south - margin), math.floor(north + margin) + 1) for lng in range(math.floor(west - margin), math.floor(east + margin) + 1)]
        with ThreadPoolExecutor(16) as pool:
            heads = {c: r for c, r in zip(corners, pool.map(self._head, corners), strict=True) if r is not None}
        out: list[_Block] = []
        for (lat, lng), r in heads.items():
            if any(other.width != r.width for (band, _), other in heads.items() if band == lat):
                raise ValueError(f"elevation: tiles of latitude {lat} differ in width")
            across = -(-r.width // r.block_width)
            for number in range(len(r.offsets)):
                row, column = divmod(number, across)
                top, left = lat + 1 - row * r.block_height / r.height, lng + column * r.block_width / r.width
                bottom, right = top - r.block_height / r.height, left + r.block_width / r.width
                if bottom - margin <= north and top + margin >= south and left - margin <= east and right + margin >= west:
                    out.append(_Block(self._path((lat, lng)), lat, lng, column, row, r, number))
        return out or [_Block("", 0, 0, 0, 0, None, 0)]

    def read(self, partition):
        """One batch: the block's posts inside the box. The first row is the tile's north edge."""
        r = partition.raster
        if r is None:
            return
        place, size = r.offsets[partition.number], r.counts[partition.number]
        raw = ranges.cached(self.cache, partition.path, place, size)
        if raw is None or len(raw) != size:
            raise OSError(f"{partition.path}: block {partition.number} is cut off")
        values = decode_block(raw, r.block_width, r.block_height)
        south, north, west, east = self.box
        ky = (partition.lat + 1) * r.height - partition.row * r.block_height - np.arange(r.block_height)
        kx = partition.lng * r.width + partition.column * r.block_width + np.arange(r.block_width)
        rows = np.flatnonzero((ky > partition.lat * r.height) & (ky / r.height >= south - 1 / r.height) & (ky / r.height <= north + 1 / r.height))
        columns = np.flatnonzero((kx < (partition.lng + 1) * r.width) & (kx / r.width >= west - 1 / r.width) & (kx / r.width <= east + 1 / r.width))
        e = values[np.ix_(rows, columns)].ravel()
        own = [np.tile(kx[columns], len(rows)), np.repeat(ky[rows], len(columns)), np.full(len(e), r.width)]
        yield pa.RecordBatch.from_arrays([pa.array(own[0], pa.int64()), pa.array(own[1], pa.int64()), pa.array(own[2], pa.int32()), pa.array(e, pa.float32(), mask=np.isnan(e))], names=["kx", "ky", "width", "e"])


class ElevationSource(DataSource):
    """spark.read.format("dem").option(south, north, west, east).load(folder): posts (kx, ky, width, e) of a box.

    The folder may be local, an HTTP URL or one of a file system that Arrow knows. Option
    `cache`: a folder that executors share, which keeps blocks and what tiles there aren't.
    """

    @classmethod
    def name(cls) -> str:
        return "dem"

    def schema(self) -> str:
        return "kx long, ky long, width int, e float"

    def reader(self, schema):
        return _Reader(self.options)
