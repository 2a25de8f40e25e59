import hashlib
import random
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from wayloom.llm import winnow


def gram(text, position):
    h = xxhash.xxh64(text.encode(), seed=42).intdigest()
    h -= (1 << 64) * (h >> 63)
    return ((h >> 31) << 30) | ((1 << 30) - 1 - position)


def brute(text, k=winnow.K, w=winnow.W):
    if not text:
        return []
    grams = [gram(text[i : i + k], i) for i in range(max(1, len(text) - k + 1))]
    out = []
    for i in range(max(1, len(grams) - w + 1)):
        m = min(grams[i : i + w])
        if m not in out:
            out.append(m)
    return out


def jaccard(a, b):
    a, b = {x >> 30 for x in a}, {x >> 30 for x in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def cases():
    r = random.Random(1)
    texts = ["", None, "a", "éà", "x" * 7, "x" * 8, "line\nbreak and\ttab", "aaaa" * 40, "😀" * 30 + "z"]
    texts += ["".join(r.choice("abcd é") for _ in range(r.randint(0, 90))) for _ in range(60)]
    return texts + texts[10:14]


def test_fingerprint_matches_brute_force(spark):
    rows = list(enumerate(cases()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.grams for r in winnow.fingerprint(df).collect()}
    for i, t in rows:
        assert got[i] == brute(t or ""), (i, t)


def test_long_texts_in_pieces_are_the_same(spark):
    r = random.Random(6)
    texts = ["".join(r.choice("abcé 😀") for _ in range(n)) for n in (0, 5, 22, 23, 24, 25, 29, 30, 31, 47, 48, 49, 50, 77, 100, 230)] + ["a" * 100]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, t string")
    for piece in (24, 25, 37, 100):
        got = {x.doc_id: x.m for x in winnow.with_minima(df, "t", "m", offset=F.lit(3), piece=piece).collect()}
        for i, t in enumerate(texts):
            want = winnow_all(t, 3)
            assert got[i] == want, (piece, len(t))


def winnow_all(text, shift, k=winnow.K, w=winnow.W):
    if not text:
        return []
    grams = [gram(text[i : i + k], i + shift) for i in range(max(1, len(text) - k + 1))]
    return [min(grams[i : i + w]) for i in range(max(1, len(grams) - w + 1))]


def test_very_long_texts(spark):
    t = "".join(random.Random(1).choice("abcdefgh ") for _ in range(2_000_000))
    df = spark.createDataFrame([(1, t), (2, t[:100] + "x" + t[100:])], "doc_id long, text string")
    rows = {x.doc_id: x for x in winnow.compare_with_next(df).select("doc_id", "n_chars", "near_next", F.size("grams").alias("n")).collect()}
    assert rows[1].n_chars == 2_000_000 and rows[1].near_next > 0.999 and rows[1].n > 200_000


def test_next_document_across_buckets(spark):
    texts = cases()
    ids = random.Random(2).sample(range(-500, 100000), len(texts))
    rows = sorted(zip(ids, texts, strict=True), reverse=True)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in winnow.compare_with_next(df, per_bucket=5).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + nxt[:third]
        r = got[i]
        assert r.n_chars == len(t)
        assert hashlib.sha256(r.edited.encode()).digest() == hashlib.sha256(edited.encode()).digest()
        assert r.grams == brute(t) and r.edited_grams == brute(edited)
        assert abs(r.near_edited - jaccard(brute(t), brute(edited))) < 1e-12
        assert abs(r.near_next - jaccard(brute(t), brute(nxt))) < 1e-12


def test_buckets_hold_up_against_outliers_and_a_hot_id(spark):
    r = random.Random(4)
    ids = [10**15 + k for k in range(1200)] + [-(2**63), 2**63 - 1, 5] + [10**15 + 77] * 600
    rows = [(i, f"{r.random()} text {k}") for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "id long, t string").withColumn("tie", F.xxhash64("t"))
    b = winnow.with_bucket(df, 20).select("id", "tie", "b").collect()
    order = sorted(b, key=lambda x: (-x.id, x.tie))
    assert all(x.b >= y.b for x, y in zip(order, order[1:], strict=False))
    sizes = Counter(x.b for x in b)
    assert max(sizes.values()) <= 100 and len(sizes) > 50
    got = winnow.compare_with_next(df.withColumnsRenamed({"id": "doc_id", "t": "text"}), per_bucket=20).select("doc_id", "edited", "n_chars").collect()
    texts = {x.tie: x.t for x in df.collect()}
    want = []
    for k, x in enumerate(order):
        t, nxt = texts[x.tie], texts[order[(k + 1) % len(order)].tie]
        third = len(t) // 3
        want.append((x.id, t[: len(t) - third] + nxt[:third], len(t)))
    assert sorted(map(tuple, got)) == sorted(want)


def test_nulls_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "abc"), (None, None), (1, "abc"), (1, "abc")], "doc_id long, text string")
    assert winnow.compare_with_next(df).count() == 4
    assert winnow.compare_with_next(df.where(F.lit(False))).count() == 0
    one = winnow.compare_with_next(df.where("doc_id = 1").limit(1)).first()
    assert one.near_next == 1.0
