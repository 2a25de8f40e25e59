import numpy as np
from oddities import odd_rows

from wayloom.llm import quality_fm as q
from wayloom.llm import toxicity_chain as x
from wayloom.llm.features import held_out, sample

SF = "/root/testdata/sf0.1"


def test_linear_time_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = q.FactorMachine(3, np.zeros((18, 9)), 0.3, rng.normal(size=40).astype(np.float32), rng.normal(size=(40, 4)).astype(np.float32))
    first = np.array([0, 3, 8])
    index, value = np.array([1, 5, 9, 0, 2, 4, 30, 39]), rng.random(8).astype(np.float32)
    for r, got in enumerate(m.margins(first, index, value)):
        i, z = index[first[r] : first[r + 1]], value[first[r] : first[r + 1]]
        want = 0.3 + (m.w[i] * z).sum() + sum(z[a] * z[b] * (m.v[i[a]] @ m.v[i[b]]) for a in range(len(i)) for b in range(a))
        assert abs(got - want) < 1e-4


def held_rates(spark, scored, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.where(held_out()).join(labels, "doc_id").select("doc_id", "s", label).collect()
    return np.array([r.s for r in rows]), np.array([r[label] for r in rows])


def test_quality_of_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    s, y = held_rates(spark, q.score(docs, q.train(docs, labels)).withColumnRenamed("score", "s"), "quality")
    assert ((s >= 0.7) == y).mean() > 0.96 and ((s >= 0) & (s <= 1)).all()


def test_toxicity_of_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    s, y = held_rates(spark, x.score(docs, x.train(docs, labels)).withColumnRenamed("p_toxic", "s"), "toxic")
    hit = s >= 0.5
    assert (hit == y).mean() > 0.96 and (hit & (y == 0)).sum() / (y == 0).sum() < 0.02


def test_terms_and_chain_order():
    rng = np.random.default_rng(1)
    rows = []
    for k in range(300):
        own = set(rng.integers(100, 4000, 30).tolist())
        if k % 3 == 0:
            own |= {7, 8} if k % 2 else {7, 8, 9, 10, 11}
        rows.append(sorted(own))
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    y = np.array([k % 3 == 0 for k in range(300)], float)
    chain = x.fit_chain(first, np.concatenate(rows), y, np.arange(300) % x.FOLDS)
    assert [len(link.earlier) for link in chain.links] == [0, 1, 2]
    p = chain.predict(first, np.concatenate(rows))
    assert ((p[:, 2] >= 0.5) == y).all() and p[:, 0][y == 1].max() > p[:, 0][y == 0].max()


def test_odd_rows_and_tables_without_labels(spark, odd, odd_labels):
    n = len(odd_rows())
    for labels in (odd_labels, odd_labels.limit(0)):
        got = q.score(odd, q.train(odd, labels)).collect()
        assert len(got) == n and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
        got = x.score(odd, x.train(odd, labels)).collect()
        assert len(got) == n and all(0 <= r.p_toxic <= 1 for r in got)
    assert q.score(odd.limit(0), q.train(odd, odd_labels)).count() == 0
    assert x.score(odd.limit(0), x.train(odd, odd_labels)).count() == 0


def test_samples_are_bounded_and_the_same(spark):
    df = spark.range(2000).selectExpr("id", "id % 7 = 0 as y")
    a, b = (sorted(r.id for r in sample(df.repartition(n), "y", 50, "id").collect()) for n in (1, 6))
    assert a == b and len(a) == 100
