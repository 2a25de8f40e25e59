"""Tile archives: one file for a slice, with a directory for random access.

`write_archives` packs tiles, `ArchiveSource` (format "wta") reads them. The layout is a
128-byte header, packed meta data, a packed directory and the tile bodies in order of
their ids; nothing in a file depends on when or where it was made.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

from ..functions import grid
from . import ranges

# Fixed values of the format.
MAGIC = b"WTA1"
HEADER_BYTES = 128
VERSION = 1
GRID_DENOM = 100
COVER_FILL = 8
ENTRY = "slice string, version string, path string, bytes long, sha256 string, tileCount int, tileBytes long, grid int, bbox array<int>, dir array<long>, dirBytesRaw long, tileData array<long>, coverBlock int, cover struct<origin:array<int>,dims:array<int>,bits:string>"
_HEADER = struct.Struct("<4s4B2I4i6Q")


def put_varint(out: bytearray, n: int) -> None:
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)


def get_varint(raw: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = raw[at]
        at += 1
        n |= (b & 0x7F) << shift
        if b < 0x80:
            return n, at
        shift += 7


def tile_id(i: int, j: int) -> int:
    return (i + grid.ID_ROWS) * grid.ID_STRIDE + j + grid.ID_COLS


def encode_directory(entries: list[tuple[int, int]]) -> bytes:
    """Count, then the steps from id to id, then the lengths of the bodies. Ids rise strictly from above 0."""
    out = bytearray()
    put_varint(out, len(entries))
    last = 0
    for number, _ in entries:
        if number <= last:
            raise ValueError(f"tile ids must rise: {number} after {last}")
        put_varint(out, number - last)
        last = number
    for _, length in entries:
        put_varint(out, length)
    return bytes(out)


def decode_directory(raw: bytes) -> list[tuple[int, int, int]]:
    """(id, offset, length) of every tile; bodies lie back to back."""
    n, at = get_varint(raw, 0)
    values = []
    for _ in range(2 * n):
        value, at = get_varint(raw, at)
        values.append(value)
    ids = list(accumulate(values[:n]))
    starts = list(accumulate(values[n:], initial=0))
    return list(zip(ids, starts, values[n:], strict=False))


def encode_cover(cells: list[tuple[int, int]], block: int = grid.COVER_BLOCK) -> dict:
    """Bitmap of the blocks with a cell, row gaps of up to eight blocks filled; the lowest bit comes first."""
    if not cells:
        return {"origin": [0, 0], "dims": [0, 0], "bits": ""}
    rows: dict[int, set[int]] = {}
    for i, j in cells:
        rows.setdefault(i // block, set()).add(j // block)
    i0, j0 = min(rows), min(min(r) for r in rows.values())
    height, width = max(rows) - i0 + 1, max(max(r) for r in rows.values()) - j0 + 1
    bits = bytearray(-(-height * width // 8))
    for i, own in rows.items():
        line = sorted(own)
        full = set(line)
        for a, b in zip(line, line[1:], strict=False):
            if 1 <= b - a - 1 <= COVER_FILL:
                full.update(range(a + 1, b))
        for j in full:
            bit = (i - i0) * width + j - j0
            bits[bit >> 3] |= 1 << (bit & 7)
    return {"origin": [i0, j0], "dims": [height, width], "bits": base64.b64encode(bytes(bits)).decode()}


def cover_has(cover: dict, i: int, j: int, block: int = grid.COVER_BLOCK) -> bool:
    """Whether a bitmap claims the block of a cell."""
    rows, cols = cover["dims"]
    r, c = i // block - cover["origin"][0], j // block - cover["origin"][1]
    if not (0 <= r < rows and 0 <= c < cols):
        return False
    bit = r * cols + c
    raw = base64.b64decode(cover["bits"])
    return bit >> 3 < len(raw) and bool(raw[bit >> 3] >> (bit & 7) & 1)


def pack(body: bytes) -> bytes:
    """gzip without a time stamp, so equal bodies give equal bytes."""
    return gzip.compress(body, 9, mtime=0)


@dataclass
class Head:
    tile_count: int
    bbox: tuple[int, int, int, int]
    meta: tuple[int, int]
    directory: tuple[int, int]
    tiles: tuple[int, int]

    def encode(self) -> bytes:
        raw = _HEADER.pack(MAGIC, VERSION, 1, 1, 0, GRID_DENOM, self.tile_count, *self.bbox, *self.meta, *self.directory, *self.tiles)
        return raw.ljust(HEADER_BYTES, b"\0")

    @classmethod
    def decode(cls, raw: bytes) -> Head:
        if len(raw) < HEADER_BYTES:
            raise ValueError("archive: short header")
        magic, version, _, _, _, _, count, i0, i1, j0, j1, *spans = _HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError(f"archive: bad magic {magic!r}")
        if version != VERSION:
            raise ValueError(f"archive: format version {version}")
        return cls(count, (i0, i1, j0, j1), tuple(spans[:2]), tuple(spans[2:4]), tuple(spans[4:]))


def build(slice_name: str, version: str, tiles: list[tuple[int, int, bytes]]) -> bytes:
    """A whole archive in memory, of tiles (i, j, body) in any order."""
    ordered = sorted(tiles, key=lambda t: tile_id(t[0], t[1]))
    raw = encode_directory([(tile_id(i, j), len(b)) for i, j, b in ordered])
    rows, cols = [t[0] for t in ordered], [t[1] for t in ordered]
    bbox = (min(rows), max(rows), min(cols), max(cols)) if rows else (0, 0, 0, 0)
    head, meta, directory = layout(slice_name, version, len(ordered), bbox, raw, sum(len(t[2]) for t in ordered))
    return b"".join([head.encode(), meta, directory, *(t[2] for t in ordered)])


def layout(slice_name: str, version: str, count: int, bbox: tuple[int, int, int, int], raw: bytes, size: int) -> tuple[Head, bytes, bytes]:
    """(header, packed meta data, packed directory) of an archive whose bodies take `size` bytes."""
    keys = {"format": MAGIC.decode(), "formatVersion": VERSION, "slice": slice_name, "version": version, "gridDenom": GRID_DENOM, "tileCount": count, "bbox": list(bbox), "contentType": "application/json", "contentEncoding": "gzip"}
    meta, directory = pack(json.dumps(keys, separators=(",", ":")).encode()), pack(raw)
    at = HEADER_BYTES + len(meta)
    return Head(count, bbox, (HEADER_BYTES, len(meta)), (at, len(directory)), (at + len(directory), size)), meta, directory


def parse(raw: bytes) -> tuple[Head, dict, list[tuple[int, int, int]]]:
    """Header, meta data and directory of an archive in memory."""
    head = Head.decode(raw)
    part = lambda span: gzip.decompress(raw[span[0] : span[0] + span[1]])
    return head, json.loads(part(head.meta)), decode_directory(part(head.directory))


class Packer:
    """Writes one archive: bodies go to a side file as they come, the head is put before them at the end."""

    def __init__(self, folder: str, slice_name: str, version: str):
        self.folder, self.slice, self.version = folder, slice_name, version
        self.body = os.path.join(folder, f".{uuid.uuid4().hex}.body")
        self.file = open(self.body, "wb")  # noqa: SIM115
        self.entries: list[tuple[int, int]] = []
        self.cells: list[tuple[int, int]] = []

    def add(self, i: int, j: int, body: bytes) -> None:
        self.entries.append((tile_id(i, j), len(body)))
        self.cells.append((i, j))
        self.file.write(body)

    def finish(self) -> dict:
        """Put the archive in place under its digest and return its index entry."""
        self.file.close()
        rows, cols = [c[0] for c in self.cells], [c[1] for c in self.cells]
        bbox = (min(rows), max(rows), min(cols), max(cols)) if rows else (0, 0, 0, 0)
        raw = encode_directory(self.entries)
        size = sum(n for _, n in self.entries)
        head, meta, directory = layout(self.slice, self.version, len(self.entries), bbox, raw, size)
        whole, digest, total = self.body[: -len(".body")] + ".tmp", hashlib.sha256(), 0
        with open(whole, "wb") as out:
            for part in (head.encode(), meta, directory):
                out.write(part)
                digest.update(part)
                total += len(part)
            with open(self.body, "rb") as bodies:
                while chunk := bodies.read(1 << 20):
                    out.write(chunk)
                    digest.update(chunk)
                    total += len(chunk)
        if os.path.getsize(whole) != total or total != head.tiles[0] + size:
            raise OSError(f"archive: wrote {os.path.getsize(whole)} of {head.tiles[0] + size} bytes")
        sha = digest.hexdigest()
        path = os.path.join(self.folder, f"{self.slice}-{sha[:12]}.wta")
        os.replace(whole, path)
        os.remove(self.body)
        return {
            "slice": self.slice, "version": self.version, "path": path, "bytes": total, "sha256": sha, "tileCount": len(self.entries), "tileBytes": size, "grid": GRID_DENOM, "bbox": list(bbox),
            "dir": list(head.directory), "dirBytesRaw": len(raw), "tileData": list(head.tiles), "coverBlock": grid.COVER_BLOCK, "cover": encode_cover(self.cells),
        }


_ENTRY = pa.schema(
    [
        ("slice", pa.string()), ("version", pa.string()), ("path", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("tileCount", pa.int32()), ("tileBytes", pa.int64()), ("grid", pa.int32()), ("bbox", pa.list_(pa.int32())),
        ("dir", pa.list_(pa.int64())), ("dirBytesRaw", pa.int64()), ("tileData", pa.list_(pa.int64())), ("coverBlock", pa.int32()), ("cover", pa.struct([("origin", pa.list_(pa.int32())), ("dims", pa.list_(pa.int32())), ("bits", pa.string())])),
    ]
)


def write_archives(tiles: DataFrame, folder: str, versions: list[str] | None = None) -> DataFrame:
    """Pack tiles (slice, version, i, j, body) into an archive for each slice and version (all, or those named); returns their index entries.

    Slices are packed side by side, each in one task that streams its sorted tiles. A file
    is named by its digest and moved into place when whole, so a repeated task changes
    nothing. `folder` must be one that all executors share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        current, packer = None, None
        for batch in batches:
            for s, v, i, j, body in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if (s, v) != current:
                    if packer:
                        yield pa.RecordBatch.from_pylist([packer.finish()], _ENTRY)
                    os.makedirs(os.path.join(folder, v), exist_ok=True)
                    current, packer = (s, v), Packer(os.path.join(folder, v), s, v)
                packer.add(i, j, body)
        if packer:
            yield pa.RecordBatch.from_pylist([packer.finish()], _ENTRY)

    wanted = tiles if versions is None else tiles.where(F.col("version").isin(versions))
    keyed = wanted.withColumn("id", grid.tile_id("i", "j"))
    ordered = keyed.repartition("slice", "version").sortWithinPartitions("slice", "version", "id")
    return ordered.select("slice", "version", F.col("i").cast("int"), F.col("j").cast("int"), "body").mapInArrow(run, ENTRY)


def read_head(path: str) -> tuple[Head, dict, list[tuple[int, int, int]]]:
    """Header, meta data and directory of an archive, wherever it is."""
    head = Head.decode(ranges.read_all(path, 0, HEADER_BYTES))
    part = lambda span: gzip.decompress(ranges.read_all(path, *span))
    return head, json.loads(part(head.meta)), decode_directory(part(head.directory))


def read_range(path: str, first: int, last: int) -> bytes:
    """Bytes first to last of a file; anything but all of them is an error."""
    return ranges.read_all(path, first, last - first + 1)


@dataclass
class _Span(InputPartition):
    path: str
    slice: str
    version: str
    base: int
    entries: list[tuple[int, int, int]]


class _Reader(DataSourceReader):
    """Directory entries in spans of about `splitbytes` of bodies, a partition each."""

    def __init__(self, options: dict):
        self.paths = [p for p in options["path"].split(",") if p]
        self.split = int(options.get("splitbytes", 64 << 20))
        self.wanted: dict[str, set[int]] = {}

    def partitions(self):
        out = []
        for path in self.paths:
            files = [os.path.join(path, x) for x in sorted(os.listdir(path)) if x.endswith(".wta")] if os.path.isdir(path) else [path]
            for file in files:
                head, meta, entries = read_head(file)
                part: list[tuple[int, int, int]] = []
                size = 0
                for entry in entries:
                    i, j = entry[0] // grid.ID_STRIDE - grid.ID_ROWS, entry[0] % grid.ID_STRIDE - grid.ID_COLS
                    if any(v != x for k, x in (("i", i), ("j", j)) for v in self.wanted.get(k, ())):
                        continue
                    part.append(entry)
                    size += entry[2]
                    if size >= self.split:
                        out.append(_Span(file, meta["slice"], meta["version"], head.tiles[0], part))
                        part, size = [], 0
                if part:
                    out.append(_Span(file, meta["slice"], meta["version"], head.tiles[0], part))
        return out or [_Span("", "", "", 0, [])]

    def read(self, partition):
        if not partition.entries:
            return
        for part in self._stretches(partition.entries):
            start, end = part[0][1], part[-1][1] + part[-1][2]
            raw = ranges.read_all(partition.path, partition.base + start, end - start)
            for number, offset, length in part:
                yield (partition.slice, partition.version, number // grid.ID_STRIDE - grid.ID_ROWS, number % grid.ID_STRIDE - grid.ID_COLS, offset, length, raw[offset - start : offset - start + length])

    @staticmethod
    def _stretches(entries: list[tuple[int, int, int]], most: int = 1 << 22) -> Iterator[list[tuple[int, int, int]]]:
        """Entries whose bodies lie back to back, up to some bytes: a read for each."""
        part: list[tuple[int, int, int]] = []
        for entry in entries:
            if part and (entry[1] != part[-1][1] + part[-1][2] or entry[1] + entry[2] - part[0][1] > most):
                yield part
                part = []
            part.append(entry)
        if part:
            yield part


class _PruningReader(_Reader):
    def pushFilters(self, filters):  # noqa: N802 - the interface's name
        """Equality on i or j prunes directory entries; the rest is left to Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute in (("i",), ("j",)):
                self.wanted.setdefault(f.attribute[0], set()).add(f.value)
            else:
                yield f


class ArchiveSource(DataSource):
    """spark.read.format("wta").load(path): tiles of an archive, or of a folder of archives (register it first)."""

    @classmethod
    def name(cls) -> str:
        return "wta"

    def schema(self) -> str:
        return "slice string, version string, i int, j int, offset long, length long, body binary"

    def reader(self, schema):
        return (_PruningReader if self.options.get("prune") == "true" else _Reader)(self.options)


def read_archives(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """Tiles of an archive or a folder of archives; equality on i or j reads only what it needs."""
    spark.dataSource.register(ArchiveSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("wta").option("prune", "true").option("splitbytes", split_bytes).load(path)


def first_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Tiles of two relations (i, j, body) that aren't byte for byte the same, or are in one alone."""
    both = a.select("i", "j", F.sha2("body", 256).alias("x")).join(b.select("i", "j", F.sha2("body", 256).alias("y")), ["i", "j"], "full_outer")
    return both.where(~F.col("x").eqNullSafe(F.col("y"))).select("i", "j")
