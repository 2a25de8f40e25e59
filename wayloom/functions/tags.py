"""Rules over map tags: which ways are walkable, what an area or a landmark is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tag vocabularies of the data model.
FOOT = ["footway", "path", "pedestrian", "steps", "track", "living_street"]
NOT_FOOT = ["residential", "service", "unclassified"]
HABITAT_RES = ["residential", "living_street"]
HABITAT_FOOT = ["footway", "path", "pedestrian", "steps", "track"]
HABITAT_ROAD = ["service", "unclassified"]
HAZARDS = ["tertiary", "tertiary_link", "secondary", "secondary_link", "primary", "primary_link", "trunk", "trunk_link", "motorway", "motorway_link"]
#: What is taken from an extract: object (n node, w way, a area), key, values.
SELECTED = [
    ("w", "highway", FOOT + NOT_FOOT + HAZARDS),
    ("n", "highway", ["crossing"]),
    ("w", "footway", ["crossing"]),
    ("a", "natural", ["wood", "water"]),
    ("a", "waterway", ["riverbank"]),
    ("a", "landuse", ["forest", "reservoir", "basin", "grass", "meadow", "recreation_ground", "village_green", "farmland", "farmyard", "orchard", "cemetery"]),
    ("a", "leisure", ["park", "garden", "common", "nature_reserve"]),
    ("a", "amenity", ["library"]),
    ("n", "amenity", ["library"]),
    ("n", "place", ["city", "town", "village", "hamlet", "suburb"]),
    ("n", "natural", ["peak"]),
    ("a", "boundary", ["national_park", "protected_area"]),
]
LIT_YES = ["yes", "24/7", "sunset-sunrise", "dusk-dawn", "automatic"]
LIT_NO = ["no", "disused"]
ACCESS = ["private", "no", "permissive"]
#: Land cover kinds in the order they are tried, with the tag values of each.
LANDCOVER = [
    ("water", {"natural": ["water"], "waterway": ["riverbank"], "landuse": ["reservoir", "basin"]}),
    ("wood", {"natural": ["wood"], "landuse": ["forest"]}),
    ("green", {"leisure": ["park", "garden", "common"], "landuse": ["grass", "meadow", "recreation_ground", "village_green"]}),
    ("field", {"landuse": ["farmland", "farmyard", "orchard"]}),
]
NATIONAL_PARK_M2 = 5e7
TIERS = {"city": 0, "town": 0, "village": 1, "hamlet": 1, "suburb": 1, "peak": 2, "national_park": 3, "protected_area": 3, "park": 4, "library": 4, "cemetery": 4, "nature_reserve": 4, "common": 4}
RADII = {"city": 8000.0, "town": 4000.0, "village": 2000.0, "hamlet": 1200.0, "suburb": 2000.0}
RADIUS = 1200.0
SETTLEMENTS = ["city", "town", "village", "hamlet", "suburb"]
#: Size at which a landmark of a kind has no significance yet; settlements have none at all.
REFERENCE = {"national_park": 5e7, "protected_area": 5e6, "park": 1e5, "library": 1e4, "cemetery": 5e4, "nature_reserve": 5e5, "common": 1e5}
PEAK_REFERENCE_M = 95.0


def selected(kind: Column, tag) -> Column:
    """Whether an object of an extract is wanted at all. tag: a function from a key to its column."""
    out = F.lit(False)
    for obj, key, values in SELECTED:
        out = out | ((kind == obj) & F.coalesce(tag(key).isin(values), F.lit(False)))
    return out


def walkable(highway: Column) -> Column:
    return F.coalesce(highway.isin(FOOT + NOT_FOOT), F.lit(False))


def hazard(highway: Column) -> Column:
    return F.coalesce(highway.isin(HAZARDS), F.lit(False))


def foot(highway: Column) -> Column:
    """Whether a walkable way is for walkers; null for other ways."""
    return F.when(highway.isin(FOOT), True).when(highway.isin(NOT_FOOT), False)


def habitat_group(highway: Column) -> Column:
    return F.when(highway.isin(HABITAT_RES), "res").when(highway.isin(HABITAT_FOOT), "foot").when(highway.isin(HABITAT_ROAD), "road")


def lit(value: Column) -> Column:
    """True, false, or null where nothing is known."""
    return F.when(value.isin(LIT_YES), True).when(value.isin(LIT_NO), False)


def access(value: Column) -> Column:
    return F.when(value.isin(ACCESS), value)


def landcover(tag) -> Column:
    """Land cover kind: the first that matches. tag: a function from a key to its column."""
    out = None
    for kind, keys in LANDCOVER:
        hit = F.lit(False)
        for key, values in keys.items():
            hit = hit | F.coalesce(tag(key).isin(values), F.lit(False))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


def landmark(tag, area: Column, is_node: Column) -> Column:
    """Landmark kind, most specific tag first; null if it is none. A national park needs its size as well as a tag."""
    eq = lambda key, *values: F.coalesce(tag(key).isin(list(values)), F.lit(False))
    claimed = eq("boundary", "national_park") | (eq("boundary", "protected_area") & (eq("protect_class", "2") | eq("protected_area", "national_park")))
    return (
        F.when(is_node & eq("place", *SETTLEMENTS), tag("place"))
        .when(is_node & eq("natural", "peak"), "peak")
        .when(claimed & (F.coalesce(area, F.lit(0.0)) >= NATIONAL_PARK_M2), "national_park")
        .when(eq("boundary", "protected_area"), "protected_area")
        .when(eq("leisure", "park"), "park")
        .when(eq("amenity", "library"), "library")
        .when(eq("landuse", "cemetery"), "cemetery")
        .when(eq("leisure", "nature_reserve"), "nature_reserve")
        .when(eq("leisure", "common"), "common")
        .when(eq("boundary", "national_park"), "protected_area")
    )


def _table(kind: Column, values: dict, other=None) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(kind == k, v) if out is None else out.when(kind == k, v)
    return out if other is None else out.otherwise(other)


def tier(kind: Column) -> Column:
    return _table(kind, TIERS)


def radius(kind: Column) -> Column:
    """How far from its point a landmark is listed, in metres."""
    return _table(kind, RADII, RADIUS)


def significance(kind: Column, area: Column, drop: Column) -> Column:
    """Doublings over a kind's reference: of its area, or twice those of a peak's drop. Settlements have none; without a size it is the least."""
    none = F.lit(float("-inf"))
    peak = F.when(drop > 0, 2 * F.log2(drop / PEAK_REFERENCE_M)).otherwise(none)
    areal = F.when(area > 0, F.log2(area / _table(kind, REFERENCE))).otherwise(none)
    return F.when(kind.isin(SETTLEMENTS), F.lit(None).cast("double")).when(kind == "peak", peak).otherwise(areal)
