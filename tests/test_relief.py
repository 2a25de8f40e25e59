"""Relief in blocks against the plain definition, across block edges and gaps."""

import random

from wayloom.operators import relief


def test_relief_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(relief, "BLOCK", 16)
    r = random.Random(5)
    cells = {(x, y): r.randint(0, 900) for x in range(-30, 25) for y in range(-20, 22) if r.random() < 0.8}
    rows = [(x, y, e) for (x, y), e in cells.items()] + [(100, 100, None)]
    got = {(g.cx, g.cy): g.relief for g in relief.relief(spark.createDataFrame(rows, "cx long, cy long, e int"), 900.0, 42.0).collect()}
    disc = relief.disc(900.0, 42.0)
    want = {}
    for (x, y) in cells:
        seen = [cells[x + dx, y + dy] for dy, h in disc for dx in range(-h, h + 1) if (x + dx, y + dy) in cells]
        want[x, y] = max(seen) - min(seen)
    assert got == want
