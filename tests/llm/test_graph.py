import random

from wayloom.llm.graph import components


def test_components_small_and_large_paths(spark):
    r = random.Random(4)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1100)] + [(5, 5), (-7, 2)]
    label = {}

    def find(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            label[b] = a
    want = {x: find(x) for x in label}
    df = spark.createDataFrame(edges, "a long, b long")
    for small in (1 << 20, 0):
        assert {row.node: row.component for row in components(df, small=small).collect()} == want
    assert components(df.limit(0)).count() == 0
