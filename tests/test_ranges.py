"""Ranges of files and over HTTP, their cache, and rasters read through both."""

import http.server
import struct
import threading
import zlib

import numpy as np
import pytest
from test_sources import raster

from wayloom.sources import archive, elevation, ranges


class Handler(http.server.SimpleHTTPRequestHandler):
    asked: list[str] = []
    failures = 0

    def do_GET(self):
        type(self).asked.append(self.path)
        if type(self).failures:
            type(self).failures -= 1
            self.send_error(503)
            return
        try:
            body = open(self.translate_path(self.path), "rb").read()
        except OSError:
            self.send_error(404)
            return
        first, last = (int(x) for x in self.headers["Range"].removeprefix("bytes=").split("-"))
        body = body[first : last + 1]
        self.send_response(206)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *a):
        pass


@pytest.fixture
def site(tmp_path):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), lambda *a: Handler(*a, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Handler.asked, Handler.failures = [], 0
    yield f"http://127.0.0.1:{server.server_port}", tmp_path
    server.shutdown()


def test_ranges_are_retried_absent_or_errors(site):
    url, folder = site
    (folder / "x.bin").write_bytes(bytes(range(100)))
    for path in (f"{url}/x.bin", str(folder / "x.bin"), (folder / "x.bin").as_uri()):
        assert ranges.read(path, 10, 5) == bytes(range(10, 15)) and ranges.read(path, 98, 10) == b"bc"
        with pytest.raises(OSError):
            ranges.read_all(path, 98, 10)
    assert ranges.read(f"{url}/none", 0, 5) is None and ranges.read(str(folder / "none"), 0, 5) is None
    Handler.failures = 2
    assert ranges.read(f"{url}/x.bin", 0, 3, pause=0.01) == b"\0\1\2"
    Handler.failures = 9
    with pytest.raises(OSError):
        ranges.read(f"{url}/x.bin", 0, 3, tries=3, pause=0.01)


def test_what_was_fetched_is_kept(site):
    url, folder = site
    (folder / "x.bin").write_bytes(b"hello")
    for _ in range(3):
        assert ranges.cached(str(folder / "kept"), f"{url}/x.bin", 1, 3) == b"ell"
        assert ranges.cached(str(folder / "kept"), f"{url}/none", 1, 3) is None
    assert sorted(Handler.asked) == ["/none", "/x.bin"]


def test_rasters_and_archives_over_http(spark, site):
    url, folder = site
    values = np.random.default_rng(2).normal(300, 90, (48, 48)).astype(np.float32)
    raster(folder / "N42_00_W072_00.tif", values)
    spark.dataSource.register(elevation.ElevationSource)
    box = {"south": 42.0, "north": 43.0, "west": -72.0, "east": -71.0001, "rows": 48, "cache": str(folder / "kept")}
    got = {(r.kx, r.ky): r.e for r in spark.read.format("dem").options(**box).load(url).collect()}
    assert len(got) == 48 * 48 and all(np.float32(got[(-72 * 48 + x, 43 * 48 - y)]) == values[y, x] for y in range(48) for x in range(48))
    (folder / "a.wta").write_bytes(archive.build("s", "v5", [(1, 2, b"xy"), (3, 4, b"z")]))
    rows = archive.read_archives(spark, f"{url}/a.wta").collect()
    assert sorted((r.i, r.j, bytes(r.body)) for r in rows) == [(1, 2, b"xy"), (3, 4, b"z")]


def test_directories_of_either_byte_order():
    def head(order, **other):
        fields = {"ImageWidth": (3, 48), "ImageLength": (3, 48), "BitsPerSample": (3, 32), "Compression": (3, 8), "SamplesPerPixel": (3, 1), "Predictor": (3, 3), "TileWidth": (3, 48), "TileLength": (4, 48), "TileOffsets": (4, 999), "TileByteCounts": (4, 7), "SampleFormat": (3, 3)} | other
        own = sorted((elevation.FIELDS[k], t, v) for k, (t, v) in fields.items() if t)
        out = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HIH", 42, 8, len(own))
        for tag, kind, v in own:
            out += struct.pack(f"{order}HHI", tag, kind, 1) + struct.pack(f"{order}{'HH' if kind == 3 else 'I'}", *([v, 0] if kind == 3 else [v]))
        return out + struct.pack(f"{order}I", 0)

    for order in "<>":
        assert elevation.parse_header(head(order), 48) == elevation.Raster(48, 48, 48, 48, [999], [7])
        with pytest.raises(ValueError, match="Compression is 5, not 8; Predictor is 1|Predictor is 1.*Compression|Compression is 5, not 8"):
            elevation.parse_header(head(order, Compression=(3, 5), Predictor=(0, 0)), 48)
        for bad in (head(order, ImageLength=(3, 47)), head(order, TileOffsets=(0, 0)), head(order, SampleFormat=(3, 1)), head(order)[:40]):
            with pytest.raises(ValueError):
                elevation.parse_header(bad, 48)


def test_blocks_are_those_of_the_floating_point_predictor():
    # Written out by hand: bytes of a row by significance, then differences of neighbours.
    values = np.array([[1.5, -2.25, 300.0], [0.0, 8000.125, -1.0]], np.float32)
    raw = b""
    for row in values:
        big = [struct.pack(">f", x) for x in row]
        line = bytes(b[k] for k in range(4) for b in big)
        raw += bytes([line[0]]) + bytes((line[k] - line[k - 1]) % 256 for k in range(1, len(line)))
    assert (elevation.decode_block(zlib.compress(raw), 3, 2) == values).all()
    assert zlib.decompress(elevation.encode_block(values)) == raw
