import random

import corpus_pipeline as c
from oddities import CLASH, odd_rows, prose

from wayloom.llm import queries


def fixture(spark, tmp_path):
    r = random.Random(21)
    english = ["the", "and", "of", "to", "with", "from", "this", "that"]
    german = ["der", "die", "und", "mit", "von", "nicht", "eine", "auf"]
    line = lambda words, n: " ".join(r.choice(words) + "".join(r.choice("abcdefgh") for _ in range(3)) for _ in range(n))
    texts = [(k, line(english if k % 2 else german, 80), "en" if k % 2 else "de") for k in range(40)]
    item = line(english, 30)
    shared = line(english, 60)
    texts += [(100, texts[3][1], "en"), (101, texts[3][1] + " end", "en"), (102, line(english, 60) + " " + item + " " + line(english, 60), "en"), (103, item, "en"), (104, line(english, 90) + " " + shared, "en"), (105, shared + " " + line(english, 90), None), (106, "!!!", None), (107, None, None)]
    rows = [(i, t, g, "s", None if t is None else len(t)) for i, t, g in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return texts, shared


def test_stages_do_what_they_say(spark, tmp_path):
    texts, shared = fixture(spark, tmp_path)
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in c.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if name != c.STAGES[-1][0]:
            assert docs.columns == columns
    clean = set(range(40)) - {3}
    assert all(clean <= set(x) for x in seen.values())
    assert {106, 107} & set(seen["language_id"]) == set() and seen["language_id"][105].lang == "en"
    assert 3 in seen["near_dedup"] and not {100, 101} & set(seen["near_dedup"])
    kept = seen["substring_dedup"]
    assert kept[104].text.endswith(shared) and shared[:50] not in kept[105].text and kept[105].n_chars == len(kept[105].text)
    after = seen["decontamination"]
    assert 103 not in after and len(after[102].text) < len(kept[102].text) and after[102].text[:100] == kept[102].text[:100]
    assert all(r.round_trip for r in seen["segmentation"].values())
    for k in clean:
        assert after[k].text == dict((i, t) for i, t, _ in texts)[k]


def test_run_is_the_stages_in_order(spark, tmp_path):
    fixture(spark, tmp_path)
    rows = c.run(spark, str(tmp_path)).collect()
    assert {r.rank for r in rows} == {1, 2} and all(r.round_trip for r in rows)
    assert not {100, 101, 103, 106, 107} & {r.doc_id for r in rows}


def test_stages_bear_odd_rows(spark, odd, tmp_path):
    spark.createDataFrame([(1, prose(random.Random(1), 20))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, many = odd, len(odd_rows())
    for _, stage in c.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == odd.columns and set(CLASH) <= set(docs.columns)
        many, before = docs.count(), many
        assert 0 < many <= before
    assert c.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= many


def test_stages_are_of_the_queries():
    assert len(c.STAGES) == 5 and len(queries.QUERIES) == 10
