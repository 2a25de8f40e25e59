import random

import numpy as np
import pyarrow as pa
from oddities import odd_rows, prose

from wayloom.llm import icws as x
from wayloom.llm.textkit import buffers


def sets(texts, idf=None):
    first, shingle, count = x.weighted(*buffers(pa.array(texts)))
    idf = np.ones(1 << x.DF_BITS) if idf is None else idf
    w = x._weights(shingle, count, idf)
    return first, shingle, count, w


def test_samples_agree_as_often_as_weighted_jaccard_says():
    r = random.Random(1)
    words = prose(r, 400).split()
    pairs = []
    for cut in (20, 60, 120, 200):
        for _ in range(25):
            r.shuffle(words)
            pairs += [" ".join(words), " ".join(words[:-cut] + prose(r, cut).split())]
    first, shingle, _, w = sets(pairs)
    sig = x.samples(first, shingle, w * np.where(shingle % np.uint64(3) == 0, 2.0, 1.0))
    agree, like = [], []
    for k in range(0, len(pairs), 2):
        part = [(shingle[first[i] : first[i + 1]], (w * np.where(shingle % np.uint64(3) == 0, 2.0, 1.0))[first[i] : first[i + 1]]) for i in (k, k + 1)]
        like.append(x.similarity(*part))
        agree.append((sig[k] == sig[k + 1]).mean())
    for g in range(0, 100, 25):
        assert abs(np.mean(agree[g : g + 25]) - np.mean(like[g : g + 25])) < 0.05


def test_block_similarities_are_exact():
    r = random.Random(2)
    base = prose(r, 60)
    texts = [base, base + " " + prose(r, 8), base + " " + base, prose(r, 30), "one", "", base.upper()]
    idf = np.random.default_rng(0).random(1 << x.DF_BITS) + 0.5
    first, shingle, count, w = sets(texts, idf)
    rows = [0, 1, 2, 3, 4, 6]
    got = x._alike(first, shingle, count, rows, idf)
    for a, i in enumerate(rows):
        for b, j in enumerate(rows):
            want = x.similarity((shingle[first[i] : first[i + 1]], w[first[i] : first[i + 1]]), (shingle[first[j] : first[j + 1]], w[first[j] : first[j + 1]]))
            assert abs(got[a, b] - want) < 1e-5


def test_spanning_links_join_what_is_alike():
    like = np.array([[1, 0.9, 0, 0], [0.9, 1, 0.85, 0], [0, 0.85, 1, 0.1], [0, 0, 0.1, 1]])
    assert len(x.spanning(like, np.arange(4), 0.8)) == 2
    assert x.spanning(like, np.array([5, 5, 5, 9]), 0.8) == []


def brute_classes(rows, threshold=0.8):
    docs = {}
    for i, t in rows:
        if i is not None:
            docs.setdefault(i, []).append(t or "")
    ids = sorted(docs)
    texts = [t or "" for _, t in rows]
    first, shingle, _, _ = sets(texts)
    df = np.bincount(shingle >> np.uint64(64 - x.DF_BITS), minlength=1 << x.DF_BITS)
    idf = x.idf_table(df, len(rows))
    flat = [(i, t) for i in ids for t in docs[i]]
    first, shingle, _, w = sets([t for _, t in flat], idf)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(flat)):
        for b in range(a):
            one, two = ((shingle[first[k] : first[k + 1]], w[first[k] : first[k + 1]]) for k in (a, b))
            if flat[a][1] == flat[b][1] or x.similarity(one, two) >= threshold:
                p, q = sorted((find(flat[a][0]), find(flat[b][0])))
                parent[q] = p
    return {i: find(i) for i in ids}


def test_classes_match_brute_force(spark):
    r = random.Random(6)
    rows = []
    for k in range(40):
        base = prose(r, r.randint(30, 120)).split()
        rows.append((k * 10, " ".join(base)))
        for c in range(r.randint(0, 5)):
            own = list(base)
            for _ in range(r.randint(0, 4)):
                own[r.randrange(len(own))] = prose(r, 1)
            rows.append((k * 10 + c + 1, " ".join(own)))
    rows += [(9000, ""), (9001, ""), (9002, "one two"), (9003, "one two")]
    got = {a.doc_id: a.class_id for a in x.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_large_groups_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(x, "BLOCK", 8)
    r = random.Random(8)
    base = prose(r, 100).split()
    rows = [(k, " ".join([*base[: 99 - k % 3], prose(r, 1)])) for k in range(60)]
    got = {a.class_id for a in x.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0}


def test_pairs_inside_a_large_unlike_group_are_found(spark, monkeypatch):
    monkeypatch.setattr(x, "BLOCK", 8)
    r = random.Random(1)
    base = prose(r, 150).split()
    rows = []
    for k in range(180):
        rows.append((k, " ".join(base + prose(r, 16).split())))
    for k in range(60):
        rows.append((180 + k, " ".join(rows[k][1].split()[:154] + prose(r, 12).split())))
    want = brute_classes(rows)
    assert len(set(want.values())) == 180
    got = {a.doc_id: a.class_id for a in x.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_pairs_on_one_template_are_joined_at_any_block_size(spark, monkeypatch):
    r = random.Random(13)
    template = prose(r, 200).split()
    rows = []
    for k in range(150):
        own = prose(r, 22).split()
        for c in range(2):
            rows.append((2 * k + c, " ".join(template + own + prose(r, 6).split())))
    want = brute_classes(rows)
    assert len(set(want.values())) == 150  # alike in pairs, not across them
    for block in (1024, 32):
        monkeypatch.setattr(x, "BLOCK", block)
        got = {a.doc_id: a.class_id for a in x.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        found = sum(got[2 * k] == got[2 * k + 1] for k in range(150))
        assert found >= 0.98 * 150 and all(want[i] == c for i, c in got.items() if c != i)


def test_chance_counts_are_taken_off():
    r = np.random.default_rng(5)
    noise = r.poisson(80, 1 << x.DF_BITS).astype(float)
    real = np.zeros(1 << x.DF_BITS)
    real[:100] = np.geomspace(2_000, 100_000, 100)
    got, want = (x.idf_table(df, 250_000) for df in (noise + real, real))
    assert np.abs(got[:100] / want[:100] - 1).max() < 0.02
    # Without it every rare shingle would count as one of 80 documents.
    assert np.median(np.abs(got / want - 1)) < np.median(np.abs((1 + np.log(250_001 / (1 + noise))) ** x.DAMP / want - 1))


def test_odd_rows_and_empty_tables(spark, odd):
    rows = odd_rows()
    found = x.classes(odd).collect()
    assert len(found) == len(rows)
    by = {}
    for f in found:
        by.setdefault(f.doc_id, set()).add(f.class_id)
    assert by[None] == {None} and by[1] == by[0] == {0} and by[2] == by[3] == {2} and by[4] == {4}
    assert x.classes(odd.limit(0)).count() == 0
    kept = x.dedupe(odd)
    assert kept.columns == odd.columns
    # Rows 1 (twice) and 3 are copies; rows without an id stay.
    assert kept.count() == len(rows) - 3
    assert kept.where("doc_id is null").count() == 2
