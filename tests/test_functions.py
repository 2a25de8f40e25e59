"""Golden values of the grids, the record codec, the classifier, names and rings."""

import math
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayloom.functions import codec, geometry, grid, tags, text
from wayloom.operators import landmarks, relief


def one(spark, *cols):
    return tuple(spark.range(1).select(*(c.alias(f"c{k}") for k, c in enumerate(cols))).first())


def test_grid_goldens(spark):
    lit = F.lit
    ids = [(4236, -7106), (4054, -11189), (0, 0), (-9000, -18000), (8999, 17999)]
    assert one(spark, *(grid.tile_id(lit(i), lit(j)) for i, j in ids)) == (476520130, 469963865, 324027000, 0, 648017998)
    for i, j in ids:
        assert one(spark, *grid.cell_of_id(grid.tile_id(lit(i), lit(j)))) == (i, j)
    assert one(spark, grid.tile(lit(42.3601)), grid.tile(lit(-71.0589)), grid.tile(lit(40.3907)), grid.tile(lit(-111.6457))) == (4236, -7106, 4039, -11165)
    for (i, j), want in {(4236, -7106): (-47374, 28240, 8, 7), (4475, -7322): (-48814, 29833, 8, 7), (0, 0): (0, 0, 7, 7), (-1, -1): (-7, -7, 7, 7)}.items():
        (cx0, cols), (cy0, rows) = grid.span(lit(j)), grid.span(lit(i))
        assert one(spark, cx0, cy0, cols, rows) == want
    assert one(spark, *(grid.post(lit(c), 3600) for c in (0, 1, 2, 3, 4, -1, -2, -3))) == (3, 8, 14, 19, 24, -3, -8, -13)
    assert one(spark, *(grid.post(lit(c), 2400) for c in (2, -3))) == (9, -9)
    assert one(spark, *grid.window_radii(lit(3879), 5200.0), *grid.window_radii(lit(4273), 5200.0)) == (5, 6, 5, 7)
    assert one(spark, grid.atlas_block(lit(-5)), grid.cover_block(lit(-1)), grid.cover_block(lit(-10))) == (-1, -1, -1)


# Golden records: fields in metres and masks, eight characters, number, class mask.
RECORDS = [
    ({"res": 349, "foot": 91, "road": 1271, "wood": 10, "green": 4, "water": 8, "relief": 517}, "AzhKfwki", 3540302891298, 85),
    ({}, "H_AAAAAA", 35115652612096, 32),
    ({"res": 10}, "H_AAAAAB", 35115652612097, 32),
    ({"res": 10, "relief": 0}, "AAAAAAAB", 1, 32),
    ({"relief": 5100}, "H-AAAAAA", 35046933135360, 32),
    ({"foot": 200, "road": 100, "wood": 15, "relief": 900}, "BaAPChQA", 6185005224960, 20),
    ({"foot": 300, "water": 12, "wood": 15}, "H_wPAB4A", 35167443885568, 68),
    ({"water": 15}, "H_8AAAAA", 35180077121536, 32),
    ({"road": 500}, "H_AAMgAA", 35115655888896, 32),
    ({"road": 500, "relief": 500}, "AyAAMgAA", 3435977113600, 16),
    ({"road": 500, "relief": 490}, "AxAAMgAA", 3367257636864, 32),
    ({"foot": 900, "road": 100, "green": 15}, "H_DwCloA", 35119679822336, 9),
    ({"res": 99999, "relief": 10200}, "H-AAAAD_", 35046933135615, 18),
]


def test_record_goldens(spark):
    names = ["res", "foot", "road", "wood", "green", "water", "relief"]
    rows = [[r.get(n, None if n == "relief" else 0) for n in names] for r, *_ in RECORDS]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, " + ", ".join(f"{n} long" for n in names)).withColumn("record", codec.encode_int(*map(F.col, names)))
    got = df.select("k", "record", codec.to_chars("record").alias("f"), codec.classify("record").alias("mask"), codec.from_chars(codec.to_chars("record")).alias("back")).orderBy("k").collect()
    assert [(r.f, r.record, r["mask"]) for r in got] == [(f, n, m) for _, f, n, m in RECORDS]
    assert all(r.record == r.back for r in got)
    first = one(spark, *(codec.field(F.lit(3540302891298), n) for n in ("res", "foot", "road", "relief")))
    assert first == (340, 90, 1270, 510)
    raw = codec.from_chars(F.lit("H_APAAoA"))
    assert one(spark, codec.classify(raw), codec.field(raw, "foot"), codec.field(raw, "wood"), codec.field(raw, "relief")) == (4, 100, 15, None)
    assert one(spark, codec.from_chars(F.lit("AAAAAA*A")), codec.from_chars(F.lit("AAAA")), codec.glyph(F.lit(None).cast("int"))) == (None, None, "?")
    assert one(spark, codec.classes(F.lit(85)), codec.display(F.lit(85)), codec.mask_of_chars(codec.chars_of_mask(F.lit(85)))) == (["mountain", "water", "woodland", "urban"], "mountain", 85)


def classify(res, foot, road, wood, green, water, h):
    """The rules as the data model states them, with shares as fractions."""
    total = 10 * (res + foot + road)
    if not total:
        return 32
    mask = 16 * (h != 511 and 10 * h >= 500) + 64 * (bin(water).count("1") / 4 >= 0.25 and foot > 0)
    cover = bin(wood | green).count("1") / 4
    if (cover >= 0.5 and foot > 0) or (10 * foot >= 120 and 10 * foot / total >= 0.7):
        w, g = bin(wood).count("1"), bin(green).count("1")
        mask += 4 if w > 0 and w >= g else 8
    mask += 1 * (total >= 900 and 10 * res / total <= 0.35) + 2 * (10 * res >= 120 and 10 * res / total >= 0.4)
    return mask or 32


def test_classifier_against_plain_rules(spark):
    r = random.Random(7)
    rows = [(r.choice([0, 3, 12, 40, r.randint(0, 255)]), r.choice([0, 1, 12, r.randint(0, 255)]), r.choice([0, 5, r.randint(0, 255)]), r.randint(0, 15), r.randint(0, 15), r.randint(0, 15), r.choice([0, 49, 50, 510, 511])) for _ in range(3000)]
    records = [(k, a | b << 8 | c << 16 | w << 24 | g << 28 | z << 32 | h << 36 | r.choice([0, 1 << 45])) for k, (a, b, c, w, g, z, h) in enumerate(rows)]
    got = spark.createDataFrame(records, "k long, record long").select("k", codec.classify("record").alias("m")).orderBy("k").collect()
    assert [x.m for x in got] == [classify(*row) for row in rows]


def test_names(spark):
    assert one(spark, *(text.day_of(F.lit(n)) for n in ("vermont", "massachusetts", "utah", "district-of-columbia"))) == (20, 11, 7, 18)
    assert one(spark, text.slug(F.lit("--A b!C--")), text.anchor_key(F.lit("peak"), F.lit(-0.0000005), F.lit(1.5))) == ("a-b-c", "peak@0,1500000")
    assert one(spark, text.elevation(F.lit("1340.5 m")), text.elevation(F.lit("high")), text.fold_day(F.lit(31))) == (1341, None, 28)
    assert one(spark, text.is_generation(F.lit("utah-0123456789ab.wta"), F.lit("utah")), text.is_generation(F.lit("utah-x-0123456789ab.wta"), F.lit("utah"))) == (True, False)


def test_landmark_rules(spark):
    t = lambda **k: tags.landmark(lambda key: F.lit(k.get(key)).cast("string"), F.lit(k.get("area", 0.0)), F.lit(k.get("node", False)))
    got = one(
        spark,
        t(place="city", node=True), t(place="city"), t(boundary="protected_area", protect_class="2", leisure="nature_reserve", area=6e7), t(boundary="protected_area", protect_class="2", area=1e6),
        t(boundary="national_park", leisure="park", area=1e4), t(boundary="national_park", area=1e4), t(amenity="library", node=True),
    )
    assert got == ("city", None, "national_park", "protected_area", "park", "protected_area", "library")
    sig = one(spark, tags.significance(F.lit("peak"), F.lit(0.0), F.lit(190.0)), tags.significance(F.lit("city"), F.lit(1.0), F.lit(1.0)), tags.significance(F.lit("park"), F.lit(4e5), F.lit(None).cast("double")), tags.significance(F.lit("peak"), F.lit(0.0), F.lit(None).cast("double")))
    assert sig == (2.0, None, 2.0, -math.inf)
    assert [landmarks.anchor_cap(a) for a in (24991, 219882, 186)] == [12, 105, 1]


def test_relief_disc():
    halves = {dy: h for dy, h in relief.disc(5000.0, 43.9)}
    assert [halves[d] for d in range(30)] == [41] * 5 + [40] * 4 + [39, 39, 38, 38, 37, 36, 35, 35, 34, 33, 32, 30, 29, 28, 26, 24, 22, 20, 17, 14, 10]
    assert 30 not in halves


points = st.lists(st.tuples(st.floats(-1, 1), st.floats(-1, 1)), min_size=3, max_size=12)


@given(points)
def test_simplify_and_clip_keep_their_promises(ring):
    kept = geometry.simplify_points(ring, 10.0)
    assert set(kept) <= set(ring)
    inside = geometry.clip_points(ring, -0.5, 0.5, -0.25, 0.75)
    assert all(-0.5 - 1e-9 <= a <= 0.5 + 1e-9 and -0.25 - 1e-9 <= b <= 0.75 + 1e-9 for a, b in inside)


def test_rings(spark):
    square = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0)]
    hole = [(0.4, 0.4), (0.4, 0.6), (0.6, 0.6), (0.6, 0.4)]
    ring = lambda r: F.array(*(F.struct(F.lit(a).alias("lat"), F.lit(b).alias("lng")) for a, b in r))
    rings = F.array(ring(square), ring(hole))
    assert one(spark, *(geometry.contains(rings, F.lit(a), F.lit(b)) for a, b in ((0.1, 0.1), (0.5, 0.5), (1.5, 0.5), (0.0, 0.0), (1.0, 0.5)))) == (True, False, False, True, False)
    c = one(spark, geometry.centroid(ring(square)))[0]
    assert abs(c.lat - 0.5) < 1e-9 and abs(c.lng - 0.5) < 1e-9
    assert abs(geometry.area_km2([square, hole]) / (111.32**2 * 0.96) - 1) < 0.01
    assert sorted(geometry.clip_points(square, 0.25, 0.75, -1, 2)) == [(0.25, 0.0), (0.25, 1.0), (0.75, 0.0), (0.75, 1.0)]
