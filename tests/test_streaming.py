"""Continuous variants give what the batch operators give."""

import datetime

from wayloom.streaming import republish


def test_follow_manifests(spark, tmp_path):
    src, schema = tmp_path / "in", "slice string, i int, j int, sha string"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
    write([("a", 1, 1, "x"), ("a", 1, 2, "y"), ("b", 5, 5, "z")])
    run = lambda: republish.follow_manifests(spark.readStream.schema(schema).parquet(str(src)), str(tmp_path / "state"), str(tmp_path / "changes"), str(tmp_path / "cp")).awaitTermination()
    run()
    write([("a", 1, 1, "x2"), ("a", 3, 3, "n")])
    run()
    got = {(r.batch, r.slice, r.i, r.j, r.change) for r in spark.read.parquet(str(tmp_path / "changes")).collect()}
    assert got == {(0, "a", 1, 1, "new"), (0, "a", 1, 2, "new"), (0, "b", 5, 5, "new"), (1, "a", 1, 1, "changed"), (1, "a", 1, 2, "removed"), (1, "a", 3, 3, "new")}
    assert {(r.slice, r.i, r.j) for r in spark.read.parquet(str(tmp_path / "state/1")).collect()} == {("a", 1, 1), ("a", 3, 3), ("b", 5, 5)}


def test_answers_and_windows(spark, tmp_path):
    at = datetime.datetime(2026, 1, 1, 12, 0)
    spark.createDataFrame([(1, 12, 15, at), (2, 13, 16, at), (3, 900, 900, at)], "request int, i int, j int, fetched_at timestamp").write.parquet(str(tmp_path / "in"))
    cover = spark.createDataFrame([("s", 1, 1)], "slice string, bi long, bj long")
    tiles = spark.createDataFrame([("s", 12, 15)], "slice string, i int, j int")
    stream = spark.readStream.schema("request int, i int, j int, fetched_at timestamp").parquet(str(tmp_path / "in"))
    q = republish.answer_cells(stream, cover, tiles).writeStream.format("memory").queryName("answers").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.request: (r.kind, (r.expires_at - at).total_seconds()) for r in spark.table("answers").collect()}
    assert got == {1: ("tile", 3600), 2: ("hole", 30 * 86400), 3: ("uncovered", 300)}
    batch = republish.answer_cells(spark.read.parquet(str(tmp_path / "in")), cover, tiles).withColumnRenamed("expires_at", "t")
    assert republish.daily_lookups(batch, "t").count() == 3
