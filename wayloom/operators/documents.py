"""Tiles put together: the whole document of every tile, its canonical JSON from the first byte to the last.

What tiles list is dealt to blocks of tiles, a line once to each block that lists it and not once to each tile,
and packed. The task of a block puts its tiles together one after another, each as one document. Packs that are
more than a few lie in a file of the task's own meanwhile; a document that is being made or read is held compressed.
"""

from __future__ import annotations

import ctypes
import json
import tempfile
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import json as arrow_json
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codec, grid
from ..sources.sinks import TILE_KEYS, TILE_VERSIONS
from . import spans

#: Tiles on a side of a block; a listing's mask has a bit for each tile of a block.
BLOCK = 4
LAYERS = TILE_KEYS["v5"]
#: Layers of lines, which come in packs, and those that make a tile.
LINES, OWN = {"ways", "names", "crossings", "hazards"}, ("ways", "crossings", "landcover", "landmarks")
ENTRIES = "block bigint, layer int, tile bigint, at bigint, area double, id string, part int, kind string, pack binary"
ORDER = ["block", "layer", "tile", "at", "area", "id", "part", "kind"]
DOCUMENTS = "i bigint, j bigint, json string"
COUNTS = ["ways", "names", "named", "feet", "crossings", "landcover", "landmarks", "hazards"]
SIZES = "i bigint, j bigint, v int, bytes bigint, broken boolean, " + ", ".join(f"{c} int" for c in COUNTS)
#: How entries of layers that may be long begin. No string of a document has a bare quote in it, so nothing else looks so.
HEADS = {"ways": b',{"points":', "crossings": b',{"lat":', "landcover": b',{"kind":', "hazards": b',{"points":'}
#: Bytes of a block's packs that are held in memory.
HELD_BYTES = 16 << 20
_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
#: About how many bytes of a document are compressed, and read, at a time.
READ_BYTES = 4 << 20
_BARE = codec.NO_RELIEF << next(at for name, at, _ in codec.FIELDS if name == "relief")
#: What a grid has for a cell without a record.
BARE = "".join(codec.ALPHABET[_BARE >> 6 * k & 63] for k in range(codec.CHARS - 1, -1, -1))


def of_lines(lines: DataFrame) -> DataFrame:
    """Entries of lines, which `spans.of_lines` describes: a row for each block that a batch of them reaches."""
    return spans.placed(lines).mapInArrow(_packs, "block bigint, layer int, at bigint, pack binary")


def of_tiles(rows: DataFrame, layer: str, json: Column, **order: Column) -> DataFrame:
    """Entries of a layer from rows with their tile, i and j. order: of at, area, id, part and kind, those that order a tile's entries."""
    block = grid.tile_id(grid.floor_div("i", BLOCK), grid.floor_div("j", BLOCK))
    return rows.select(block.alias("block"), F.lit(LAYERS.index(layer)).alias("layer"), grid.tile_id("i", "j").alias("tile"), *(c.alias(n) for n, c in order.items()), json.cast("binary").alias("pack"))


def together(layers: list[DataFrame]) -> DataFrame:
    """Entries of all layers by block, in the order of their tiles' documents. Arrow batches get `BATCH_BYTES` at most from then on, as packs are large."""
    layers[0].sparkSession.conf.set(_BATCH, str(BATCH_BYTES))
    kinds = dict(x.split() for x in ENTRIES.split(", "))
    lack = {"tile": 0, "at": 0}
    filled = [rows.select(*(F.col(c) if c in rows.columns else F.lit(lack.get(c)).cast(kind).alias(c) for c, kind in kinds.items())) for rows in layers]
    return reduce(DataFrame.unionByName, filled).repartition("block").sortWithinPartitions(*ORDER).select("block", "layer", "tile", "at", "pack")


def documents(entries: DataFrame, version: str) -> DataFrame:
    """(i, j, json): every tile's document as one value."""

    def whole_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, j, document in _documents(batches, version):
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([j]), pa.array([b"".join(document.read()).decode()])], names=["i", "j", "json"])

    return entries.mapInArrow(whole_documents, DOCUMENTS)


def sizes(entries: DataFrame, version: str) -> DataFrame:
    """(i, j, v, bytes, broken, sizes of layers): every tile's document is put together, and then read from its beginning to its end.

    It is read in the task that made it. named: names that aren't null. feet: ways for walkers. A layer that
    isn't there has size 0; broken documents can't be read and have no sizes.
    """

    def documents_read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, j, document in _documents(batches, version):
            try:
                found = document_sizes(document, version)
            except (ValueError, KeyError):
                found = {}
            row = {"i": i, "j": j, "v": found.get("v"), "bytes": document.size, "broken": not found} | {c: found.get(c, 0 if found else None) for c in COUNTS}
            kinds = {"i": pa.int64(), "j": pa.int64(), "bytes": pa.int64(), "broken": pa.bool_()}
            yield pa.RecordBatch.from_arrays([pa.array([v], kinds.get(c, pa.int32())) for c, v in row.items()], names=list(row))

    return entries.mapInArrow(documents_read, SIZES)


class Packs:
    """The packs of a block, which are read once for each of its tiles."""

    def __init__(self):
        self.file, self.places, self.listed = tempfile.SpooledTemporaryFile(HELD_BYTES), defaultdict(list), defaultdict(int)

    def add(self, layer: str, packs: pa.Array) -> None:
        for pack in packs:
            data = pack.as_buffer()
            self.places[layer].append((self.file.tell(), data.size))
            self.listed[layer] |= int(np.frombuffer(data, np.int64, 1, 16)[0])
            self.file.write(data)

    def lists(self, layer: str, bit: int) -> bool:
        return bool(self.listed.get(layer, 0) >> bit & 1)

    def of(self, layer: str) -> Iterator[bytes]:
        for at, size in self.places[layer]:
            self.file.seek(at)
            yield self.file.read(size)


class Document:
    """The text of a tile, written once and read as often as need be."""

    def __init__(self, pieces: Iterator[bytes]):
        self.size, self.zipped, text = 0, [], []
        for piece in pieces:
            text.append(piece)
            self.size += len(piece)
            if len(piece) > READ_BYTES or self.size % READ_BYTES < len(piece):
                self.zipped.append(_zipped(b"".join(text)))
                text = []
        self.zipped.append(_zipped(b"".join(text)))

    def read(self) -> Iterator[bytes]:
        """Its bytes from the beginning to the end, some megabytes at a time."""
        return (_unzipped(*x) for x in self.zipped)


def _release() -> None:
    """Give memory that is free in this process back to the machine, as tiles of any size follow each other."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def _zipped(text: bytes) -> tuple[int, bytes]:
    return len(text), pa.compress(text, codec="zstd", asbytes=True)


def _unzipped(size: int, data: bytes) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = TaskContext.get().partitionId() << 32
    for layer, texts, row, tile in spans.listings(batches):
        if not len(row):
            continue
        if layer != "names":  # which go where their ways go
            block, line, mask = _by_block(row, tile)
            # A pack's texts have so many bytes at most, or are one longer text.
            group = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // spans.SPAN_BYTES
            head = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (group[line[1:]] != group[line[:-1]])])
        packs = [_pack(texts.take(pa.array(line[a:b])), mask[a:b]) for a, b in zip(head, [*head[1:], len(line)], strict=True)]
        n = len(head)
        yield pa.RecordBatch.from_arrays([pa.array(block[head]), pa.array([LAYERS.index(layer)] * n, pa.int32()), pa.array(at + np.arange(n)), pa.array(packs, pa.binary())], names=["block", "layer", "at", "pack"])
        at += n


def _by_block(row: np.ndarray, tile: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, row, mask): which tiles of each block list a row, by block, then row. row never falls."""
    i, j = tile // grid.ID_STRIDE - grid.ID_ROWS, tile % grid.ID_STRIDE - grid.ID_COLS
    block = (i // BLOCK + grid.ID_ROWS) * grid.ID_STRIDE + j // BLOCK + grid.ID_COLS
    y, x = i // BLOCK - (i // BLOCK).min(), j // BLOCK - (j // BLOCK).min()
    wide = int(x.max()) + 1
    # Where lines are near each other, blocks have short numbers, which are sorted faster.
    order = np.argsort((y * wide + x).astype(np.uint16) if (int(y.max()) + 1) * wide < 1 << 16 else block, kind="stable")
    block, row, bit = block[order], row[order], (1 << (i % BLOCK * BLOCK + j % BLOCK))[order]
    head = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (row[1:] != row[:-1])])
    return block[head], row[head], np.bitwise_or.reduceat(bit, head).astype(np.uint16)


def _pack(texts: pa.Array, mask: np.ndarray) -> bytes:
    """Texts and which tiles of a block list them. Before them how many there are, their bytes and the tiles that list any."""
    length = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int32)
    begin = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset] if len(texts) else 0
    text = texts.buffers()[2].slice(int(begin), int(length.sum()))
    size, data = _zipped(b"".join((length.tobytes(), mask.tobytes(), text)))
    return np.array([len(mask), size, np.bitwise_or.reduce(mask)], np.int64).tobytes() + data


def _selected(pack: bytes, bit: int) -> bytes:
    """The texts that a tile lists, with commas between them."""
    n, size = (int(x) for x in np.frombuffer(pack, np.int64, 2))
    raw = pa.decompress(memoryview(pack)[24:], decompressed_size=size, codec="zstd")
    length, mask = np.frombuffer(raw, np.int32, n), np.frombuffer(raw, np.uint16, n, 4 * n)
    end = np.r_[0, np.cumsum(length)].astype(np.int32)
    texts = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(end), raw.slice(6 * n)])
    return _joined(texts.filter(pa.array((mask >> bit & 1).astype(bool))))


def _joined(texts: pa.Array) -> bytes:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), b",")[0].as_py()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Packs, dict]]:
    """(block, its packs, what each tile has of its own by layer)."""
    block, lines, own = None, Packs(), {}
    for batch in batches:
        if not len(batch):
            continue
        blocks, layers, tiles, at = (batch[c].to_numpy() for c in ("block", "layer", "tile", "at"))
        head = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]) | (layers[1:] != layers[:-1]) | (tiles[1:] != tiles[:-1])])
        for a, b in zip(head, [*head[1:], len(blocks)], strict=True):
            if blocks[a] != block:
                if block is not None:
                    yield block, lines, own
                lines.file.close()
                block, lines, own = int(blocks[a]), Packs(), defaultdict(lambda: defaultdict(list))
            layer, packs = LAYERS[layers[a]], batch["pack"].slice(a, b - a)
            if layer in LINES:
                lines.add(layer, packs)
            elif layer == "habitat":
                own[int(tiles[a])][layer].extend(zip(at[a:b].tolist(), packs.to_pylist(), strict=True))
            else:
                own[int(tiles[a])][layer].append(_zipped(_joined(packs)))
    if block is not None:
        yield block, lines, own
    lines.file.close()


def _documents(batches: Iterator[pa.RecordBatch], version: str) -> Iterator[tuple[int, int, Document]]:
    """(i, j, document) of every tile that has a layer of its own; hazards and habitat alone make none."""
    for block, lines, own in _blocks(batches):
        i0, j0 = (block // grid.ID_STRIDE - grid.ID_ROWS) * BLOCK, (block % grid.ID_STRIDE - grid.ID_COLS) * BLOCK
        for bit in range(BLOCK * BLOCK):
            i, j = i0 + bit // BLOCK, j0 + bit % BLOCK
            mine = own.pop((i + grid.ID_ROWS) * grid.ID_STRIDE + j + grid.ID_COLS, {})
            if any(lines.lists(layer, bit) or layer in mine for layer in OWN):
                yield i, j, Document(_text(version, i, j, bit, lines, mine))
                _release()


def _text(version: str, i: int, j: int, bit: int, lines: Packs, mine: dict) -> Iterator[bytes]:
    """A document in the order of its keys. Hazards are left out where there are none."""
    yield b'{"v":%d' % TILE_VERSIONS[version]
    for layer in TILE_KEYS[version][1:]:
        if layer == "habitat":
            yield b',"habitat":' + _habitat(i, j, mine.get(layer, []))
        elif layer != "hazards" or lines.lists(layer, bit):
            yield b',"%s":[' % layer.encode()
            between = b""
            for piece in (_selected(p, bit) for p in lines.of(layer)) if layer in LINES else (_unzipped(*p) for p in mine.get(layer, [])):
                if piece:
                    yield between
                    yield piece
                    between = b","
            yield b"]"
    yield b"}"


def _habitat(i: int, j: int, cells: list[tuple[int, bytes]]) -> bytes:
    """The grid of a tile's spawn cells, as `bake.habitat_grids` has it. cells: place in the grid and characters."""
    (cx0, cols), (cy0, rows) = ((x * 20 // 3, -(-(x + 1) * 20 // 3) - x * 20 // 3) for x in (j, i))
    found = {k: f.decode() for k, f in cells}
    return json.dumps({"cellDeg": grid.SPAWN_DEG, "cx0": cx0, "cy0": cy0, "cols": cols, "rows": rows, "feat": "".join(found.get(k, BARE) for k in range(cols * rows))}, separators=(",", ":")).encode()


def document_sizes(document: Document, version: str) -> dict[str, int]:
    """The version and the sizes of layers of a document, all of which is read. ValueError if it isn't one."""
    source, text, found = document.read(), b"", {}

    def expect(what: bytes) -> None:
        nonlocal text
        while len(text) < len(what) and (more := next(source, b"")):
            text += more
        if not text.startswith(what):
            raise ValueError(f"{what!r} is not where it belongs")
        text = text[len(what) :]

    def pieces(end: bytes | None, head: bytes | None) -> Iterator[bytes]:
        """Whole entries up to the end of their list, or of the document, which is read as well."""
        nonlocal text
        while True:
            at = text.find(end) if end else -1
            if at >= 0:
                piece, text = text[:at], text[at:]
                yield piece
                return
            more = next(source, b"")
            if not more:
                if end or not text.endswith(b"]}"):
                    raise ValueError("a list has no end")
                piece, text = text[:-2], text[-2:]
                yield piece
                return
            cut = text.rfind(head) if head else _comma(text) if layer == "names" else -1
            if cut > 0:
                piece, text = text[:cut], text[cut + 1 :]
                yield piece
            text += more

    expect(b'{"v":%d' % TILE_VERSIONS[version])
    found["v"] = TILE_VERSIONS[version]
    keys = TILE_KEYS[version][1:]
    for k, layer in enumerate(keys):
        if layer == "hazards":
            if text[:1] == b"}":
                break
        expect(b',"%s":' % layer.encode())
        if layer == "habitat":
            (grid_text,) = pieces(b"}", None)
            if len((h := json.loads(grid_text + b"}"))["feat"]) != codec.CHARS * h["cols"] * h["rows"]:
                raise ValueError("a grid lacks cells")
            expect(b"}")
            # At least a byte of what follows, for whether there are hazards.
            text = text or next(source, b"")
            continue
        expect(b"[")
        end = b'],"%s":' % keys[k + 1].encode() if k + 1 < len(keys) and keys[k + 1] != "hazards" else None
        for piece in pieces(end, HEADS.get(layer)):
            for name, n in _counts(layer, piece).items():
                found[name] = found.get(name, 0) + n
        expect(b"]")
    expect(b"}")
    if text or any(source):
        raise ValueError("a document goes on after its end")
    return found


def _comma(text: bytes) -> int:
    """Where the last comma between entries of a list of strings is, not in one and not behind the list; -1 if there is none."""
    at = text.rfind(b",")
    while at >= 0:
        before = text[:at].replace(b"\\\\", b"")
        if text[at - 1 : at] != b"]" and (before.count(b'"') - before.count(b'\\"')) % 2 == 0:
            return at
        at = text.rfind(b",", 0, at)
    return -1


#: What is taken out of entries when they are parsed.
_TAKEN = {"ways": pa.schema([("foot", pa.bool_())]), "crossings": pa.schema([("lat", pa.float64())]), "landcover": pa.schema([("kind", pa.string())]), "hazards": pa.schema([("", pa.null())])}


def _counts(layer: str, piece: bytes) -> dict[str, int]:
    """How many entries a piece of a layer has; of names those that aren't null as well, of ways those for walkers."""
    if not piece:
        return {layer: 0}
    if layer in _TAKEN:
        lines = piece.replace(HEADS[layer], b"\n" + HEADS[layer][1:])
        try:
            read = arrow_json.read_json(
                pa.BufferReader(lines), arrow_json.ReadOptions(use_threads=False, block_size=len(lines) + 1), arrow_json.ParseOptions(explicit_schema=_TAKEN[layer], unexpected_field_behavior="ignore")
            )
            return {layer: len(read)} | ({"feet": pc.sum(read["foot"], min_count=0).as_py()} if layer == "ways" else {})
        except pa.ArrowInvalid:
            pass  # such as a coordinate that is no number, which JSON writes as a string
    entries = json.loads(b"[" + piece + b"]")
    if layer == "ways":
        return {layer: len(entries), "feet": sum(e.get("foot") is True for e in entries)}
    return {layer: len(entries)} | ({"named": sum(e is not None for e in entries)} if layer == "names" else {})
