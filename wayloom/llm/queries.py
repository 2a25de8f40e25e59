"""One query for each operator of this subpackage, with SQL where it can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a factorisation machine."""
    from . import quality_fm as q
    from .features import held_out

    docs = _table(spark, sf_dir, "documents")
    model = q.train(docs, _table(spark, sf_dir, "labels"))
    return q.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a benchmark window of 10 words, and the items concerned."""
    from . import decontaminate as d

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = d.find_hits(docs, _table(spark, sf_dir, "benchmark"), window=10)
    return hits.select(
        "doc_id",
        F.col(d.COUNT).alias("n_words"),
        d.n_hit().alias("n_hit"),
        F.size(d.ITEMS).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(d.ITEMS, ","), 256).alias("items_sha256"),
        (d.n_hit() > 0).alias("contaminated"),
    )


OP2_SQL = r"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as t, row_number() over () as r from documents),
b as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as t from benchmark),
iw as (select distinct item, least(10, len(t)) as m, array_to_string(t[i:i+least(10, len(t))-1], ' ') as win
  from (select item, t, unnest(range(1, greatest(1, len(t) - 9) + 1)) as i from b where len(t) > 0)),
ms as (select distinct m from iw),
dw as (select r, m, i, array_to_string(t[i:i+m-1], ' ') as win
  from (select r, t, m, unnest(range(1, len(t) - m + 2)) as i from w, ms where len(t) >= m)),
h as (select dw.r, dw.i, dw.m, iw.item from dw join iw on dw.win = iw.win and dw.m = iw.m),
p as (select r, count(distinct j) as n from (select r, unnest(range(i, i + m)) as j from h) group by r),
q as (select r, count(*) as n, string_agg(item, ',' order by item) as s from (select distinct r, item from h) group by r)
select w.doc_id, cast(len(w.t) as bigint) as n_words, cast(coalesce(p.n, 0) as bigint) as n_hit, cast(coalesce(q.n, 0) as bigint) as n_items,
  sha256(coalesce(q.s, '')) as items_sha256, coalesce(p.n, 0) > 0 as contaminated
from w left join p on w.r = p.r left join q on w.r = q.r
"""


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, of its edited text, and their likenesses."""
    from .winnow import compare_with_next

    found = compare_with_next(_table(spark, sf_dir, "documents"))
    text = lambda c: F.array_join(F.transform(c, lambda x: F.hex(x)), ",")
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), text("grams").alias("fingerprint"), text("edited_grams").alias("edited_fingerprint"), "near_edited", "near_next"
    )


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by wrappers induced for its host."""
    from .wrapper import extract

    return extract(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, by a conditional random field over its words."""
    from . import langid_crf as c
    from .features import held_out

    docs = _table(spark, sf_dir, "documents")
    model = c.train(docs)
    return c.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_switches")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a chain of classifiers."""
    from . import toxicity_chain as x
    from .features import held_out

    docs = _table(spark, sf_dir, "documents")
    chain = x.train(docs, _table(spark, sf_dir, "labels"))
    return x.score(docs, chain).select(
        "doc_id", held_out().alias("held_out"), F.col("p_toxic").alias("score"), (F.col("p_toxic") >= 0.5).cast("int").alias("predicted"), *(f"p_{c}" for c in x.CATEGORIES)
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document, by weighted sampling of its shingles."""
    from .icws import classes

    found = classes(_table(spark, sf_dir, "documents"))
    return found.withColumn("is_kept", F.col("doc_id") == F.col("class_id"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document under a 50k byte-level vocabulary."""
    import public_tokenizers

    from .tokencount import count_tokens

    docs = _table(spark, sf_dir, "documents")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumn("over_limit", F.col("n_tokens") > 1024)


def op9_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document, with their scores."""
    import public_tokenizers

    from .segment import digests

    return digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), k=2)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document when 50-byte strings of earlier documents are removed."""
    from .suffix_dedup import spans

    found = spans(_table(spark, sf_dir, "documents"), width=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_decontaminate": op2_decontaminate,
    "op3_fingerprints": op3_fingerprints,
    "op4_main_text": op4_main_text,
    "op5_language": op5_language,
    "op6_toxicity": op6_toxicity,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_token_counts": op8_token_counts,
    "op9_segmentations": op9_segmentations,
    "op10_suffix_dedup": op10_suffix_dedup,
}
ORACLES = {"op2_decontaminate": OP2_SQL}
