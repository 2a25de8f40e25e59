import random

from oddities import odd_rows

from wayloom.llm import decontaminate as d


def brute(text, items, window):
    toks = d.normalise(text)
    hit, found = set(), set()
    for name, words in items:
        m = min(window, len(words))
        wins = {tuple(words[k : k + m]) for k in range(len(words) - m + 1)} if words else set()
        for k in range(len(toks) - m + 1 if m else 0):
            if tuple(toks[k : k + m]) in wins:
                hit |= set(range(k, k + m))
                found.add(name)
    return len(toks), len(hit), sorted(found)


def tables():
    r = random.Random(5)
    word = lambda: r.choice("abcd")
    items = [(k, " ".join(word() for _ in range(r.choice([1, 2, 3, 4, 6, 9])))) for k in range(12)] + [(50, ""), (51, None), (52, "A b, A b"), (53, "a b")]
    docs = [(k, " ".join(word().upper() if r.random() < 0.2 else word() for _ in range(r.randint(0, 60)))) for k in range(60)]
    return items, docs


def test_hits_match_brute_force(spark):
    items, docs = tables()
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = docs + [(100, None), (101, ""), (102, "zz yy"), (103, "a b c d"), (103, "a b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plain = [(str(k), d.normalise(t)) for k, t in items]
    for window in (3, 5):
        for block in (1 << 20, 10):
            got = sorted((r.doc_id, r.n_words, r.n_hit, tuple(r.hit_items)) for r in d.find_hits(df, bench, window=window, block_bytes=block).withColumn("n_hit", d.n_hit()).collect())
            want = sorted((i, *brute(t, plain, window)[:2], tuple(brute(t, plain, window)[2])) for i, t in rows)
            assert got == want


def test_clean_removes_spans_and_mostly_benchmark_rows(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "Keep this. One two, three four five six seven eight nine TEN eleven! and é keep that too, all of these words here stay"), (2, "one two three four five six seven eight nine ten eleven"), (3, "untouched text"), (4, None)],
        "doc_id long, text string",
    )
    got = {r.doc_id: r.text for r in d.clean(docs, bench).collect()}
    assert got == {1: "Keep this. ! and é keep that too, all of these words here stay", 3: "untouched text", 4: None}
    assert d.clean(docs, bench, max_span=11, max_coverage=1.0).count() == 4


def test_odd_rows_and_empty_tables(spark, odd):
    bench = spark.createDataFrame([(1, odd_rows()[0][1])], "item_id long, text string")
    got = d.find_hits(odd, bench)
    assert got.count() == odd.count() and got.where("size(hit_items) > 0").count() == 5
    assert d.find_hits(odd, bench.limit(0)).where("size(hit_items) > 0").count() == 0
    assert d.find_hits(odd.limit(0), bench).count() == 0
    assert d.clean(odd, bench).columns == odd.columns
