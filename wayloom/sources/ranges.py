"""Byte ranges of files wherever they are, and a folder that keeps what was fetched.

Local paths and `file:` URLs are read as files, `http:` and `https:` URLs with range
requests, anything else through Arrow's file systems. A file that isn't there (over HTTP
also one that is forbidden) is None; every other failure is tried again with growing
pauses and is then an error, as an unread range must never pass for missing data.
"""

from __future__ import annotations

import hashlib
import os
import time
import urllib.error
import urllib.request
import uuid
from urllib.parse import unquote, urlsplit

#: Tries and the first pause, which doubles; answers that mean that there is no such file.
TRIES, PAUSE_S = 4, 0.4
NONE_THERE = [403, 404]


def _over_http(url: str, first: int, size: int) -> bytes | None:
    ask = urllib.request.Request(url, headers={"Range": f"bytes={first}-{first + size - 1}"})
    try:
        with urllib.request.urlopen(ask, timeout=60) as answer:
            # A server that knows no ranges sends the whole file.
            return answer.read() if answer.status == 206 else answer.read()[first : first + size]
    except urllib.error.HTTPError as e:
        if e.code in NONE_THERE:
            return None
        if e.code == 416:
            return b""
        raise


def _from_file(path: str, first: int, size: int) -> bytes | None:
    if not os.path.exists(path):
        return None
    with open(path, "rb") as f:
        f.seek(first)
        return f.read(size)


def _through_arrow(url: str, first: int, size: int) -> bytes | None:
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(url)
    if where.get_file_info(path).type == fs.FileType.NotFound:
        return None
    with where.open_input_file(path) as f:
        f.seek(min(first, f.size()))
        return f.read(size)


def read(path: str, first: int, size: int, tries: int = TRIES, pause: float = PAUSE_S) -> bytes | None:
    """At most `size` bytes of a file from byte `first` on; None if there is no such file."""
    parts = urlsplit(path)
    if parts.scheme in ("http", "https"):
        get, where = _over_http, path
    elif parts.scheme in ("", "file"):
        get, where = _from_file, unquote(parts.path) if parts.scheme else path
    else:
        get, where = _through_arrow, path
    for k in range(tries):
        try:
            return get(where, first, size)
        except Exception as e:
            if k + 1 == tries:
                raise OSError(f"{path}: bytes {first}-{first + size - 1} can't be read") from e
            time.sleep(pause * 2**k)


def read_all(path: str, first: int, size: int) -> bytes:
    """Exactly `size` bytes of a file from byte `first` on."""
    got = read(path, first, size)
    if got is None or len(got) != size:
        raise OSError(f"{path}: wanted {size} bytes from {first} on, got {None if got is None else len(got)}")
    return got


def cached(folder: str | None, path: str, first: int, size: int) -> bytes | None:
    """As `read`, but kept in a folder that executors share: also that there is no such file, so it's asked for once."""
    if not folder:
        return read(path, first, size)
    name = os.path.join(folder, hashlib.sha256(f"{path} {first} {size}".encode()).hexdigest())
    for suffix in (".bytes", ".absent"):
        if os.path.exists(name + suffix):
            return _from_file(name + suffix, 0, size) if suffix == ".bytes" else None
    got = read(path, first, size)
    os.makedirs(folder, exist_ok=True)
    temporary = f"{name}.{uuid.uuid4().hex}"
    with open(temporary, "wb") as f:
        f.write(got or b"")
    os.replace(temporary, name + (".absent" if got is None else ".bytes"))
    return got
