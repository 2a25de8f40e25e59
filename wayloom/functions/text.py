"""Names, keys, hashes and small parsers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .grid import _col

TILE_PATH = r"(-?\d+)/(-?\d+)\.json\.gz$"
MB = 1 << 20


def round_half_up(x: Column, scale: float) -> Column:
    """Whole number nearest x * scale; halves go up, also below zero."""
    return F.floor(x * F.lit(scale) + 0.5).cast("bigint")


def anchor_key(kind: Column, lat: Column, lng: Column) -> Column:
    """Kind and point in millionths of a degree."""
    return F.concat(kind, F.lit("@"), round_half_up(lat, 1e6).cast("string"), F.lit(","), round_half_up(lng, 1e6).cast("string"))


def tile_path_cell(path: Column | str) -> tuple[Column, Column]:
    """(i, j) of a tile file's path; null if it is none."""
    part = lambda k: F.when(_col(path).rlike(TILE_PATH), F.regexp_extract(_col(path), TILE_PATH, k).cast("bigint"))
    return part(1), part(2)


def day_of(name: Column | str) -> Column:
    """Day of the month, 1 to 28, on which a slice is made: a multiplicative hash of its name."""
    codes = F.transform(F.split(_col(name), ""), lambda c: F.ascii(c).cast("bigint"))
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda h, c: F.pmod(h * 31 + c, F.lit(4294967296))) % 28 + 1


def slug(name: Column | str) -> Column:
    """Lower case with hyphens for everything but letters and digits, one hyphen trimmed off each end."""
    return F.regexp_replace(F.regexp_replace(F.lower(_col(name)), "[^a-z0-9]+", "-"), "^-|-$", "")


def fold_day(day: Column | str) -> Column:
    """Days 29 to 31 count as 28."""
    return F.least(_col(day), F.lit(28))


def is_generation(file: Column, name: Column) -> Column:
    """Whether a file is an archive generation of a slice."""
    return F.coalesce(file.startswith(F.concat(name, F.lit("-"))) & F.substring(file, F.length(name) + 2, F.length(file)).rlike(r"^[0-9a-f]{12}\.wta$"), F.lit(False))


def parse_range(header: Column | str) -> tuple[Column, Column]:
    """(first, last) byte of a single `bytes=a-b` range; null if it is anything else."""
    pattern = r"^bytes=(\d+)-(\d+)$"
    part = lambda k: F.when(_col(header).rlike(pattern), F.regexp_extract(_col(header), pattern, k).cast("bigint"))
    return part(1), part(2)


def elevation(tag: Column | str) -> Column:
    """Whole metres of an elevation tag; null if it does not begin with a number."""
    number = F.regexp_extract(_col(tag), r"^\s*(-?\d+(?:\.\d+)?)", 1)
    return F.when(number != "", F.floor(number.cast("double") + 0.5).cast("int"))


def digest(body: Column | str) -> Column:
    return F.sha2(_col(body), 256)


def short_digest(body: Column | str) -> Column:
    """The part of a digest that names a generation."""
    return F.substring(digest(body), 1, 12)


def percent(part: Column, whole: Column) -> Column:
    return F.format_number(F.lit(100.0) * part / whole, 1)


def megabytes(size: Column | str) -> Column:
    return F.format_number(_col(size) / MB, 1)
