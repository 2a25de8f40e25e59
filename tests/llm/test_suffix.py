import random

import numpy as np
from oddities import odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from wayloom.llm import suffix_array as sa
from wayloom.llm import suffix_dedup as sd


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), max_size=80))
def test_suffix_array_is_sorted(symbols):
    s = symbols + [0]
    assert sa.suffix_array(np.array(s), 6).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_recursion_and_large_alphabets(monkeypatch):
    r = random.Random(2)
    for limit in (1, 1 << 30):
        monkeypatch.setattr(sa, "SMALL_ALPHABET", limit)
        for _ in range(30):
            s = [r.randint(1, 3) for _ in range(r.randint(1, 200))] * r.randint(1, 3) + [0]
            assert sa.suffix_array(np.array(s), 4).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_prefixes_are_common_prefixes():
    r = random.Random(7)
    segs = list({bytes(r.choice(b"ab") for _ in range(r.randint(1, 40))) for _ in range(30)})
    start = np.cumsum([0, *(len(x) + 1 for x in segs[:-1])])
    whole = np.frombuffer(b"\0".join(segs) + b"\0\0", np.uint8)
    s = np.where(whole > 0, whole, 1)
    s[-1] = 0
    order = sa.suffix_array(s, 200)
    got = sa.permuted_prefixes(whole, order, start, np.array([len(x) for x in segs]))
    tail = lambda i: bytes(whole[i:]).split(b"\0")[0]
    for a, b in zip(order, order[1:], strict=False):
        x, y = tail(a), tail(b)
        assert got[b] == next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))


def test_earliest_owner_of_every_window():
    r = random.Random(3)
    for _ in range(60):
        segs = list({bytes(r.choice(b"ab") for _ in range(r.randint(4, 25))) for _ in range(r.randint(1, 15))})
        owner = np.array([r.randint(0, 9) for _ in segs])
        for x, got in zip(segs, sa.earliest(segs, owner, 4), strict=True):
            assert got.tolist() == [min(int(owner[k]) for k, y in enumerate(segs) if x[o : o + 4] in y) for o in range(len(x) - 3)]


def brute(rows, width=50):
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - width + 1):
            w = raw[p : p + width]
            if i is not None and (w not in first or i < first[w]):
                first[w] = i
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            if i is not None and first[raw[p : p + width]] < i:
                gone[p : p + width] = b"\1" * width
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out.append((-1 if i is None else i, len(raw), sum(gone), spans, bytes(x for x, y in zip(raw, gone, strict=True) if not y)))
    return sorted(out)


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sd.spans(df, **options).collect())
    assert got == brute(rows)


def test_spans_match_brute_force(spark):
    r = random.Random(9)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(40)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = [text(25) for _ in range(4)]
    rows = []
    for k in range(80):
        parts = [text(r.randint(0, 30))]
        for _ in range(r.randint(0, 2)):
            parts += [r.choice(shared)[r.randint(0, 9) :], text(r.randint(0, 8))]
        rows.append((r.randint(-50, 1000), " ".join(parts)))
    near = rows[0][1] * 3
    rows += [(2000 + k, near[:k] + "Q" + near[k + 1 :]) for k in range(60, 75)] + [(-99, "ab" * 200), (7, "ab" * 150), (8, "a" * 60), (9, "a" * 120), (9, "a" * 120)]
    check(spark, rows)
    check(spark, rows, slice_bytes=2000, hot_rows=2)
    # Through groups of slices; and with hashes that all collide, so that only bytes decide.
    check(spark, rows, slice_bytes=1000, hot_rows=3, fan=4)
    check(spark, rows, slice_bytes=2000, bits=1)
    check(spark, rows, slice_bytes=4000, bits=1, hot_rows=0, fan=2)


def test_slices_grow_with_the_root_of_the_input():
    assert sd.fitting_slice(0) == sd.fitting_slice(10**9) == sd.SLICE
    assert sd.fitting_slice(100 * 10**9) == 10 * sd.SLICE and sd.fitting_slice(10**14) == sd.SLICE_MOST


def test_shards_in_several_arrays(monkeypatch):
    r = random.Random(8)
    text = bytes(r.choice(b"abc") for _ in range(3000))
    segs = [text[a : a + n] for a, n in ((r.randint(0, 2900), r.randint(50, 80)) for _ in range(300))]
    cut = [x for x in segs if len(x) >= 50]
    runs = [sd.Runs(np.frombuffer(x, np.uint8), np.array([0, len(x)]), 50) for x in cut]
    pieces = {(x[f : f + c + 49], a - f, i) for i, (x, q) in enumerate(zip(cut, runs, strict=True)) for f, c, a in zip(q.first.tolist(), q.count.tolist(), q.at.tolist(), strict=True)}
    rows = sorted(pieces)
    column = lambda v: [sd.pack(np.array(v, np.int64))]
    table = sd._table({"slice": [0], "shard": [0]}, run=column(range(len(rows))), nth=column([0] * len(rows)), at=column([a for _, a, _ in rows]), low=column([i for *_, i in rows]), more=column([0] * len(rows)), size=column([len(x) for x, *_ in rows]), blob=[b"".join(x for x, *_ in rows)])
    owners = []
    for most in (1 << 22, 200):
        monkeypatch.setattr(sd, "ARRAY", most)
        s = sd.Shard(table)
        start, size, own = s.owners(50)
        owners.append([np.resize(own[a : a + n], len(x) - 49).tolist() if n == 1 else own[a : a + n].tolist() for x, a, n in zip(s.segments, start, size, strict=True)])
    assert owners[0] == owners[1]
    least = {}
    for x, _, i in rows:
        for k in range(len(x) - 49):
            least[x[k : k + 50]] = min(i, least.get(x[k : k + 50], i))
    assert owners[0] == [[least[x[k : k + 50]] for k in range(len(x) - 49)] for x in s.segments]


def test_anchors_do_not_depend_on_the_chunks(monkeypatch):
    r = random.Random(5)
    texts = [bytes(r.choice(b"ab") for _ in range(n)) for n in (0, 10, 49, 50, 400, 0, 900, 51)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    def windows():
        runs = sd.Runs(data, offsets, 50)
        out = {}
        for first, count, row, at, anchor in zip(*(x.tolist() for x in (runs.first, runs.count, runs.row, runs.at, runs.anchor)), strict=True):
            assert offsets[row] <= first <= at and at + sd.GRAM <= first + 50 and first + count + 49 <= offsets[row + 1]
            out |= {k: (at, anchor) for k in range(first, first + count)}
        return out

    want = windows()
    assert set(want) == {k for a, b in zip(offsets, offsets[1:], strict=False) for k in range(a, b - 49)}
    for chunk in (1, 7, 100):
        monkeypatch.setattr(sd, "CHUNK", chunk)
        assert windows() == want


def test_odd_rows_and_empty_tables(spark, odd):
    rows = odd_rows()
    check(spark, rows)
    assert sd.spans(odd.limit(0)).count() == 0
    out = sd.dedupe(odd)
    assert out.columns == odd.columns
    # Row 1 is a copy of row 0 and goes, twice; all else stays.
    assert out.count() == len(rows) - 2


def test_dedupe_leaves_valid_text(spark):
    shared = "é" * 40
    rows = [(1, "x" + shared), (2, "yy" + shared + "z"), (3, "clean")]
    got = {r.doc_id: r.text for r in sd.dedupe(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "x" + shared and got[3] == "clean" and got[2].startswith("yy") and got[2].endswith("z")
    got[2].encode()


def test_packed_integers():
    for x in ([], [5], [-(2**63), 2**63 - 1], [7, -3, 1000000], list(range(300))):
        assert sd.unpack(sd.pack(np.array(x, np.int64))).tolist() == x


def test_windows_of_segments_of_all_bytes_have_their_earliest_owner():
    r = np.random.default_rng(11)
    for letters in (2, 5, 254, 255, 256):
        segs = list({r.integers(0, letters, r.integers(0, 60)).astype(np.uint8).tobytes() for _ in range(300)} | {b"", b"\0", b"\xff" * 9, b"\0" * 9, bytes(range(letters)) * 2})
        owner = r.integers(-5, 1000, len(segs))
        least = {}
        for x, o in zip(segs, owner.tolist(), strict=True):
            for a in range(len(x) - 3):
                least[x[a : a + 4]] = min(o, least.get(x[a : a + 4], o))
        flat, many = sa.earliest_windows(segs, owner, 4)
        assert many.tolist() == [max(len(x) - 3, 0) for x in segs]
        assert flat.tolist() == [least[x[a : a + 4]] for x in segs for a in range(len(x) - 3)]
