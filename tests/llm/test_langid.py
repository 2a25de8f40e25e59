import numpy as np
import pyarrow as pa
from oddities import odd_rows

from wayloom.llm import langid_crf as c
from wayloom.llm.textkit import buffers, words

SF = "/root/testdata/sf0.01"


def plain_posteriors(scores, move):
    e, step = np.exp(scores), np.exp(move)
    n = len(scores)
    alpha, beta = np.zeros(scores.shape), np.ones(scores.shape)
    alpha[0] = e[0] / e[0].sum()
    for t in range(1, n):
        alpha[t] = (alpha[t - 1] @ step) * e[t]
        alpha[t] /= alpha[t].sum()
    for t in range(n - 2, -1, -1):
        beta[t] = step @ (beta[t + 1] * e[t + 1])
        beta[t] /= beta[t].sum()
    out = alpha * beta
    return out / out.sum(1, keepdims=True)


def test_block_recursion_is_the_plain_one():
    rng = np.random.default_rng(4)
    sizes = [1, 2, 63, 64, 65, 128, 129, 500, 3]
    scores = rng.normal(0, 2, (sum(sizes), 3)).astype(np.float32)
    move = rng.normal(0, 1.5, (3, 3))
    first = np.concatenate([[0], np.cumsum(sizes)])
    got = c.Crf(["a", "b", "c"], None, move).posteriors(scores, first)
    for a, b in zip(first, first[1:], strict=False):
        assert np.allclose(got[a:b], plain_posteriors(scores[a:b].astype(float), move), atol=1e-8)


def test_word_features_do_not_depend_on_the_neighbours():
    one = words(*buffers(pa.array(["Straße x"])))
    two = words(*buffers(pa.array(["y", "zz straße"])))
    f1, b1 = c.word_features(one, np.array([0]))
    f2, b2 = c.word_features(two, np.array([2]))
    assert sorted(b1) != [] and one.hash[0] == two.hash[2] and sorted(b1) == sorted(b2)


def test_languages_of_held_out_documents_and_of_mixed_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = c.train(docs)
    assert model.labels == ["de", "en", "es", "fr"]
    held = docs.where("crc32(cast(doc_id as string)) % 4 = 2")
    rows = c.identify(held, model).select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97 and all(0 <= r.score <= 1 for r in rows)
    parts = {r.lang: r.text for r in held.where("n_chars > 600").dropDuplicates(["lang"]).collect()}
    w = words(*buffers(pa.array([" ".join(parts["de"].split()[:40] + parts["es"].split()[:40])])))
    tags = [model.labels[k] for k in model.posteriors(model.emissions(w), w.first).argmax(1)]
    assert tags[:35].count("de") >= 33 and tags[-35:].count("es") >= 33


def test_odd_rows_and_empty_tables(spark, odd):
    model = c.train(odd)
    got = c.identify(odd, model)
    assert got.count() == len(odd_rows())
    by = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert by[2] == by[3] == by[4] == by[9] == ("und", 0.0) and by[8][0] == "en"
    empty = c.train(odd.limit(0))
    assert empty.labels == [] and {r.lang_pred for r in c.identify(odd, empty).collect()} == {"und"}
    assert c.identify(odd.limit(0), model).count() == 0


def test_too_many_languages_are_refused(spark):
    import pytest

    from wayloom.llm import langid_crf

    rows = [(k, "one two three", f"l{k % 3}") for k in range(60)]
    with pytest.raises(ValueError, match="languages"):
        langid_crf.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_languages=2)
