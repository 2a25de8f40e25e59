"""Writing elevation tiles of the layout that `elevation` reads: staging, fixtures and tests."""

from __future__ import annotations

import os
import struct

import numpy as np

from . import elevation


def encode(values: np.ndarray, block: int) -> bytes:
    """A TIFF of square blocks; posts that aren't measured are NaN, as is what blocks have beyond the edges."""
    rows, width = values.shape
    down, across = -(-rows // block), -(-width // block)
    padded = np.full((down * block, across * block), np.nan, np.float32)
    padded[:rows, :width] = values
    blocks = [elevation.encode_block(padded[y * block : (y + 1) * block, x * block : (x + 1) * block]) for y in range(down) for x in range(across)]
    numbers = elevation.PROFILE | {"ImageWidth": width, "ImageLength": rows, "TileWidth": block, "TileLength": block}
    head = 8 + 2 + 12 * (len(numbers) + 2) + 4
    data = head + 8 * len(blocks)
    starts = np.cumsum([data, *map(len, blocks)])[:-1].tolist()
    # A list of one number stands in its entry, a longer one behind the directory.
    where = [(head, head + 4 * len(blocks)), (starts[0], len(blocks[0]))][len(blocks) == 1]
    entries = [(elevation.FIELDS[k], 3, 1, struct.pack("<HH", v, 0)) for k, v in numbers.items()]
    entries += [(elevation.FIELDS[k], 4, len(blocks), struct.pack("<I", at)) for k, at in zip(("TileOffsets", "TileByteCounts"), where, strict=True)]
    out = b"II" + struct.pack("<HIH", 42, 8, len(entries))
    out += b"".join(struct.pack("<HHI", t, kind, n) + v for t, kind, n, v in sorted(entries)) + struct.pack("<I", 0)
    return out + struct.pack(f"<{len(blocks)}I", *starts) + struct.pack(f"<{len(blocks)}I", *map(len, blocks)) + b"".join(blocks)


def write(folder: str, lat: int, lng: int, values: np.ndarray, block: int = 512) -> str:
    """Write the tile of a south-west corner; returns its path."""
    folder = folder.removeprefix("file://")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{elevation.tile_name(lat, lng)}.tif")
    with open(path, "wb") as f:
        f.write(encode(values, block))
    return path
