"""The 48-bit feature record of a spawn cell, its text form, and the classes it implies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .grid import _col

# Fixed values of the format.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
CHARS = 8
QUANTUM = 10
NO_RELIEF = 511
CLASS_BITS = {"urban": 1, "residential": 2, "woodland": 4, "greenspace": 8, "mountain": 16, "rural": 32, "water": 64}
DISPLAY_ORDER = ["mountain", "water", "woodland", "greenspace", "urban", "residential", "rural"]
GLYPHS = {"urban": "u", "residential": "r", "woodland": "w", "greenspace": "s", "mountain": "m", "rural": ".", "water": "~"}
#: Fields from the lowest bit: name, first bit, bits.
FIELDS = [("res", 0, 8), ("foot", 8, 8), ("road", 16, 8), ("wood", 24, 4), ("green", 28, 4), ("water", 32, 4), ("relief", 36, 9)]


def _step(value: Column, top: int) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(top), F.floor(value / QUANTUM))).cast("bigint")


def encode_int(res: Column, foot: Column, road: Column, wood: Column, green: Column, water: Column, relief: Column) -> Column:
    """The record: lengths and relief in steps of ten metres, cut off at the top; no relief is 511."""
    parts = {
        "res": _step(res, 255), "foot": _step(foot, 255), "road": _step(road, 255), "wood": wood, "green": green, "water": water,
        "relief": F.when(relief.isNull(), NO_RELIEF).otherwise(_step(relief, 510)),
    }
    return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(parts[n].cast("bigint"), at) for n, at, _ in FIELDS])


def to_chars(record: Column | str) -> Column:
    """Eight characters, the highest six bits first."""
    record = _col(record)
    return F.concat(*(F.substring(F.lit(ALPHABET), (F.shiftright(record, 6 * k).bitwiseAND(F.lit(63)) + 1).cast("int"), F.lit(1)) for k in range(CHARS - 1, -1, -1)))


def from_chars(text: Column | str) -> Column:
    """The record of eight characters, null if any is not in the alphabet."""
    text = _col(text)
    return F.when(text.rlike(f"^[A-Za-z0-9_-]{{{CHARS}}}$"), reduce(lambda a, b: a.bitwiseOR(b), [_place(text, k) for k in range(CHARS)]))


def _place(text: Column, k: int) -> Column:
    return F.shiftleft((F.instr(F.lit(ALPHABET), F.substring(text, k + 1, 1)) - 1).cast("bigint"), 6 * (CHARS - 1 - k))


def field(record: Column | str, name: str) -> Column:
    """A field of a record, in metres for lengths and relief; no relief is null. Reserved bits are ignored."""
    at, bits = next((a, b) for n, a, b in FIELDS if n == name)
    raw = F.shiftright(_col(record), at).bitwiseAND(F.lit((1 << bits) - 1))
    if name == "relief":
        return F.when(raw != NO_RELIEF, raw * QUANTUM)
    return raw * QUANTUM if bits == 8 else raw


def green_kind(wood: Column, green: Column) -> Column:
    """The greener of two: woodland if it has any samples and no fewer than greenspace."""
    w, g = F.bit_count(wood), F.bit_count(green)
    return F.when((w > 0) & (w >= g), "woodland").otherwise("greenspace")


def classify(record: Column | str) -> Column:
    """Bit mask of the classes of a record: five rules that hold or not on their own, else rural.

    Lengths are compared in their steps of ten metres and shares as whole numbers, so no
    rounding decides. Without a walkable way no rule holds. The last step is a lookup,
    so that the rules stand in the generated code once.
    """
    f = {n: F.shiftright(_col(record), at).bitwiseAND(F.lit((1 << bits) - 1)) for n, at, bits in FIELDS}
    total = f["res"] + f["foot"] + f["road"]
    walked = f["foot"] > 0
    green = ((F.bit_count(f["wood"].bitwiseOR(f["green"])) >= 2) & walked) | ((f["foot"] >= 12) & (f["foot"] * 10 >= total * 7))
    woody = green_kind(f["wood"], f["green"]) == "woodland"
    mask = (
        F.when((total >= 90) & (f["res"] * 100 <= total * 35), CLASS_BITS["urban"]).otherwise(0)
        .bitwiseOR(F.when((f["res"] >= 12) & (f["res"] * 10 >= total * 4), CLASS_BITS["residential"]).otherwise(0))
        .bitwiseOR(F.when(green, F.when(woody, CLASS_BITS["woodland"]).otherwise(CLASS_BITS["greenspace"])).otherwise(0))
        .bitwiseOR(F.when(f["relief"].between(50, NO_RELIEF - 1) & (total > 0), CLASS_BITS["mountain"]).otherwise(0))
        .bitwiseOR(F.when((f["water"] > 0) & walked, CLASS_BITS["water"]).otherwise(0))
    )
    return F.get(F.lit([CLASS_BITS["rural"], *range(1, 128)]), mask)


def has_class(mask: Column | str, name: str) -> Column:
    return _col(mask).bitwiseAND(F.lit(CLASS_BITS[name])) != 0


def classes(mask: Column | str) -> Column:
    """Names of a mask's classes in display order."""
    return F.array_compact(F.array(*(F.when(has_class(mask, n), n) for n in DISPLAY_ORDER)))


def display(mask: Column | str) -> Column:
    """The first of a mask's classes in display order."""
    return F.coalesce(*(F.when(has_class(mask, n), n) for n in DISPLAY_ORDER))


def glyph(mask: Column | str) -> Column:
    """One character for the class displayed, '?' for a malformed record."""
    return F.coalesce(*(F.when(has_class(mask, n), GLYPHS[n]) for n in DISPLAY_ORDER), F.lit("?"))


def strongest(mask: Column | str, weights: dict[str, int]) -> Column:
    """The greatest weight among a mask's classes."""
    return F.array_max(F.array(*(F.when(has_class(mask, n), w) for n, w in weights.items())))


def chars_of_mask(mask: Column | str) -> Column:
    """A mask as two characters of an atlas."""
    mask = _col(mask)
    return F.concat(*(F.substring(F.lit(ALPHABET), (F.shiftright(mask, 6 * k).bitwiseAND(F.lit(63)) + 1).cast("int"), F.lit(1)) for k in (1, 0)))


def mask_of_chars(text: Column | str, width: int = 2) -> Column:
    """A mask from the characters of an atlas slot, one or two."""
    text = _col(text)
    return reduce(lambda a, b: a + b, [F.shiftleft((F.instr(F.lit(ALPHABET), F.substring(text, k + 1, 1)) - 1).cast("int"), 6 * (width - 1 - k)) for k in range(width)])
