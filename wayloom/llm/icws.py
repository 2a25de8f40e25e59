"""Near-duplicate documents by improved consistent weighted sampling.

A text is the weighted set of its five-word shingles; a shingle's weight is its count
times its inverse document frequency to the power DAMP. (Undamped, the few shingles an
edit makes would outweigh the many that a large group of copies shares, and the copies
would come out unlike.) Document frequencies are counted over all documents, in a
fixed number of hash buckets, so what is broadcast has a bound. A bucket also counts the
rare shingles that fall into it by chance, as many as into any other; the median
bucket's count is therefore taken off, which leaves a frequent shingle its own frequency
up to the scatter of that noise (the root of the median) and a rare one about none.

Improved consistent weighted sampling draws, for each of BANDS x ROWS samples, the
shingle and the quantised weight of least ln a = ln c - r (t - b + 1), t = floor(ln w / r
+ b), with r, c ~ Gamma(2, 1) and b uniform, looked up by the shingle's hash in fixed
tables; two texts agree in a sample with the probability of their weighted Jaccard
similarity. Texts that agree in all rows of a band are candidates.

Equal texts are one node. Buckets are verified in rounds, a few bands first, and only
those that still hold several components: the members' whole texts are compared by
their exact weighted Jaccard similarity, and the bucket returns links that span what is
alike, at most one for each member. A bucket of over BLOCK members is dealt into blocks,
each with the bucket's least member in it, which joins most of a group of copies. What
still holds several components after the last round is compared in full, part against
part, in blocks of two parts. So no task's work grows with a group, and a link is lost
only where sampling misses it; the number of blocks grows with the square of a bucket
whose members are not alike. Counts of buckets are written down before they are
joined with the members, so a join with a bucket that holds much of the corpus has two
plain exchanges below it, which adaptive execution splits.

As the weight of a shingle is its count times a number of its own, a count c is the same
as c different shingles (the first occurrence, the second and so on) of that number, and
the common weight of all pairs of a block is one matrix product.

Edge cases: null and empty texts, and texts without words, are classed with their
equals only; a text of one to four words is one shingle; rows without an id have no
class; rows that share an id count as one document, of which `dedupe` keeps the row of
the least text; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .storage import Kept, checkpoint, forget, lean, release, small_batches
from .textkit import U64, buffers, byte_slices, mix, shingles, words

SHINGLE = 5
BANDS, ROWS = 12, 4
SAMPLES = BANDS * ROWS
DAMP = 0.25
DF_BITS = 20
DF_PARTS = 64
ROW_BITS = 20
TABLE_BITS = 16
SLICE = 1 << 21
CHUNK = 1 << 15
BLOCK = 1024
ROUNDS = ((0, 2), (0, BANDS - 1))  # first and last band


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    n = 1 << TABLE_BITS
    r = rng.gamma(2.0, 1.0, n).astype(np.float32)
    ln_c = np.log(rng.gamma(2.0, 1.0, n)).astype(np.float32)
    b = rng.random(n).astype(np.float32)
    odd = rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * U64(2) + U64(1)
    return r, (1 / r).astype(np.float32), ln_c, b, odd


_R, _INV_R, _LN_C, _B, _ODD = _tables()


def weighted(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, shingle, count): distinct shingles of each row by rising hash (its top 44 bits)."""
    if len(offsets) - 1 > 1 << ROW_BITS:
        raise ValueError("too many rows in a slice")
    h, start = shingles(words(data, offsets), SHINGLE)
    n = len(offsets) - 1
    key = (np.repeat(np.arange(n, dtype=U64), np.diff(start)) << U64(64 - ROW_BITS)) | (h >> U64(ROW_BITS))
    key.sort()
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(at, len(key)))
    key = key[at]
    first = np.searchsorted(key, np.arange(n, dtype=U64) << U64(64 - ROW_BITS))
    return np.append(first, len(key)), key << U64(ROW_BITS), count


def samples(first: np.ndarray, shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """rows x SAMPLES of 32-bit sample codes; rows without shingles have zeros."""
    rows = len(first) - 1
    out = np.zeros((rows, SAMPLES), np.uint32)
    filled = np.flatnonzero(np.diff(first))
    ln_w = np.log(weight).astype(np.float32)
    begin = first[filled]
    stop = np.append(begin[1:], first[-1]) if len(filled) else begin
    a = 0
    while a < len(filled):
        b = max(a + 1, int(np.searchsorted(stop, begin[a] + CHUNK, "right")))
        x, y = begin[a], stop[b - 1]
        s, w = shingle[x:y], ln_w[x:y]
        own = begin[a:b] - x
        size = np.diff(np.append(own, y - x))
        for k in range(SAMPLES):
            at = ((s * _ODD[k]) >> U64(64 - TABLE_BITS)).astype(np.int32)
            r, u = _R[at], _B[at]
            t = np.floor(w * _INV_R[at] + u)
            ln_a = _LN_C[at] - r * (t - u + np.float32(1))
            least = np.minimum.reduceat(ln_a, own)
            hit = np.flatnonzero(ln_a == np.repeat(least, size))
            hit = hit[np.searchsorted(hit, own)]
            out[filled[a:b], k] = (mix(s[hit] + t[hit].astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15)) >> U64(32)).astype(np.uint32)
        a = b
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """rows x BANDS of bucket keys."""
    out = np.empty((len(sig), BANDS), np.int64)
    for j in range(BANDS):
        h = np.full(len(sig), j + 1, U64)
        for x in range(ROWS):
            h = mix(h * U64(0x9E3779B97F4A7C15) + sig[:, j * ROWS + x].astype(U64))
        out[:, j] = h.view(np.int64)
    return out


def frequencies(docs: DataFrame, text: str = "t") -> tuple[np.ndarray, int]:
    """(documents with a shingle of each hash bucket, documents): a table of fixed size, summed in parts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(1 << DF_BITS, np.uint32), 0
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            rows += len(batch)
            for a, b in byte_slices(offsets, SLICE):
                _, s, _ = weighted(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                total += np.bincount(s >> U64(64 - DF_BITS), minlength=1 << DF_BITS).astype(np.uint32)
        if rows:
            parts = np.split(total, DF_PARTS)
            yield pa.RecordBatch.from_arrays([pa.array(range(DF_PARTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([rows] + [0] * (DF_PARTS - 1), pa.int64())], names=["part", "counts", "rows"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros((1 << DF_BITS) // DF_PARTS, np.uint64)
        for chunk in table["counts"].chunks:
            for x in chunk:
                total += np.frombuffer(x.as_buffer(), np.uint32)
        return pa.table({"part": table["part"][:1], "counts": pa.array([total.tobytes()], pa.binary()), "rows": pa.array([sum(table["rows"].to_pylist())], pa.int64())})

    schema = "part int, counts binary, rows bigint"
    got = docs.select(text).mapInArrow(lean(count), schema).groupBy("part").applyInArrow(add, schema).collect()
    out = np.zeros(1 << DF_BITS, np.float64)
    for r in got:
        n = len(out) // DF_PARTS
        out[r.part * n : (r.part + 1) * n] = np.frombuffer(r.counts, np.uint64)
    return out, sum(r.rows for r in got)


def idf_table(df: np.ndarray, documents: int) -> np.ndarray:
    """Damped inverse document frequency of each hash bucket, 1 for a shingle in all documents."""
    own = np.clip(df - np.median(df), 0, documents)
    return (1 + np.log((1 + documents) / (1 + own))).astype(np.float64) ** DAMP


def _weights(shingle: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return count * idf[shingle >> U64(64 - DF_BITS)]


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (rising shingles, weights)."""
    total = x[1].sum() + y[1].sum()
    if not total:
        return 0.0
    at = np.searchsorted(y[0], x[0])
    at[at == len(y[0])] = 0
    same = y[0][at] == x[0] if len(y[0]) else np.zeros(len(x[0]), bool)
    common = np.minimum(x[1][same], y[1][at[same]]).sum()
    return float(common / (total - common))


KEYS = [f"k{j}" for j in range(BANDS)]


def buckets_of(docs: DataFrame, idf, slice_bytes: int = SLICE) -> DataFrame:
    """(id, digest, a key for each band) of rows (id, t); keys are null without words. idf: a broadcast table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            keys, bare = [np.zeros((0, BANDS), np.int64)], [np.zeros(0, bool)]
            for a, b in byte_slices(offsets, slice_bytes):
                first, s, n = weighted(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                bare.append(np.diff(first) == 0)
                keys.append(band_keys(samples(first, s, _weights(s, n, idf.value))))
            k, none = np.concatenate(keys), np.concatenate(bare)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(k[:, j], pa.int64(), mask=none) for j in range(BANDS))], names=["id", "digest", *KEYS])

    return docs.select("id", F.unhex(F.md5("t")).alias("digest"), "t").mapInArrow(lean(run), "id bigint, digest binary, " + ", ".join(f"{k} bigint" for k in KEYS))


def _alike(first: np.ndarray, shingle: np.ndarray, count: np.ndarray, rows: list[int], idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarities of some rows, all with all."""
    m = len(rows)
    size = first[np.array(rows) + 1] - first[rows]
    take = np.repeat(first[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    row, s, c = np.repeat(np.arange(m), size), shingle[take], count[take]
    weight = idf[s >> U64(64 - DF_BITS)]
    total = np.bincount(row, weight * c, m)
    # One feature for each occurrence; those of a single row add nothing in common.
    nth = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
    row, weight = np.repeat(row, c), np.repeat(weight, c)
    _, feature, times = np.unique(mix(np.repeat(s, c) + nth.astype(U64) * U64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    keep = times[feature] > 1
    row, weight, feature = row[keep], weight[keep], feature[keep]
    _, feature = np.unique(feature, return_inverse=True)
    order = np.argsort(feature, kind="stable")
    row, weight, feature = row[order], weight[order], feature[order]
    common = np.zeros((m, m))
    a, columns = 0, 4096
    while a < len(feature):
        b = int(np.searchsorted(feature, feature[a] + columns))
        x = np.zeros((m, columns), np.float32)
        x[row[a:b], feature[a:b] - feature[a]] = np.sqrt(weight[a:b])
        common += x @ x.T
        a = b
    np.fill_diagonal(common, total)
    both = total[:, None] + total[None, :] - common
    return np.divide(common, both, out=np.zeros((m, m)), where=both > 0)


def spanning(like: np.ndarray, component: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links of at least the threshold that join members of different components, without cycles."""
    m = len(component)
    label = np.unique(component, return_inverse=True)[1]
    out = []
    for i in range(m):
        while True:
            other = np.flatnonzero((like[i] >= threshold) & (label != label[i]))
            if not len(other):
                break
            j = int(other[np.argmax(like[i, other])])
            out.append((i, j))
            label[label == label[j]] = label[i]
    return out


def _linked(members: DataFrame, texts: DataFrame, idf, threshold: float, shards: int) -> DataFrame:
    """(a, b): verified links that join the components inside each block. members: key, block, id, component."""

    def run(table: pa.Table) -> pa.Table:
        ids, t = table["id"].to_numpy(), table["t"].combine_chunks()
        own, one, number = np.unique(ids, return_index=True, return_inverse=True)
        data, offsets = buffers(t.take(pa.array(one)) if not isinstance(t, pa.ChunkedArray) else t.combine_chunks().take(pa.array(one)))
        first, shingle, count = weighted(data, offsets)
        component = table["component"].to_numpy()
        key, block = table["key"].to_numpy(), table["block"].to_numpy()
        order = np.lexsort((number, block, key))
        cut = np.flatnonzero(np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (block[order][1:] != block[order][:-1])]))
        links = []
        for group in np.split(order, cut[1:]):
            rows, at = np.unique(number[group], return_index=True)
            if len(rows) > 1 and len(set(component[group[at]].tolist())) > 1:
                like = _alike(first, shingle, count, rows.tolist(), idf.value)
                links += [(own[rows[i]], own[rows[j]]) for i, j in spanning(like, component[group[at]], threshold)]
        release()
        return pa.table({"a": pa.array([int(x) for x, _ in links], pa.int64()), "b": pa.array([int(x) for _, x in links], pa.int64())})

    shard = F.pmod(F.xxhash64("key", "block"), F.lit(shards))
    return members.join(texts, "id").select(shard.alias("shard"), "key", "block", "id", "component", "t").groupBy("shard").applyInArrow(run, "a bigint, b bigint")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, broadcast_ids: int = 1 << 20) -> DataFrame:
    """(id, class_id): the least id of the document's group of near copies."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    small_batches(docs.sparkSession)
    counts, n = frequencies(rows)
    kept = Kept(n * BANDS)
    idf = docs.sparkSession.sparkContext.broadcast(idf_table(counts, n))
    keyed = kept(buckets_of(rows.where("id is not null"), idf))
    # Equal texts have equal keys: the row of the least id stands for all.
    nodes = keyed.groupBy("digest").agg(F.min("id").alias("id"), *(F.any_value(k).alias(k) for k in KEYS))
    banded = nodes.where(F.col(KEYS[0]).isNotNull()).select("id", F.posexplode(F.array(*KEYS)).alias("band", "key"))
    several = kept(banded.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("n")).where("least <> most").drop("most"))
    shared = kept(banded.join(several, "key").select("key", "band", "id", "n", "least"))
    links = labels = None
    forget(docs.sparkSession)
    for number, (least, most) in enumerate((*ROUNDS, ROUNDS[-1])):
        here = shared.where(F.col("band").between(least, most))
        if number < len(ROUNDS):
            members = kept(_dealt(_mixed(here, labels, kept), number))
        else:
            here = here.where(F.col("n") > BLOCK)
            if here.isEmpty():
                break
            members = checkpoint(_paired_members(_mixed(here, labels, kept)))
        many = members.count()
        if not many:
            if labels is None:
                break
            continue
        ids = members.select("id").distinct()
        if ids.count() <= broadcast_ids:
            ids = F.broadcast(ids)
        texts = rows.join(ids, "id", "left_semi")
        found = kept(_linked(members, texts, idf, threshold, max(64, many // 1000)))
        links = found if links is None else links.unionByName(found)
        labels = kept(components(links, kept=kept).select(F.col("node").alias("id"), "component"))
        forget(docs.sparkSession)
    first = nodes.select("digest", "id")
    if labels is None:
        by_text = first.select("digest", F.col("id").alias("class_id"))
    else:
        by_text = first.join(labels, "id", "left").select("digest", F.coalesce("component", "id").alias("class_id"))
    known = keyed.select("id", "digest").join(by_text, "digest").select(F.col("id").alias(id_col), "class_id")
    unknown = rows.where("id is null").select(F.col("id").alias(id_col), F.lit(None).cast("bigint").alias("class_id"))
    return kept(known.unionByName(unknown))


def _mixed(shared: DataFrame, labels: DataFrame | None, kept: Kept) -> DataFrame:
    """(key, id, component, n, least) of buckets with several components. labels: id, component."""
    if labels is None:
        return shared.select("key", "id", F.col("id").alias("component"), "n", "least")
    labelled = shared.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"), "n", "least")
    mixed = kept(labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key"))
    return labelled.join(mixed, "key", "left_semi")


def _dealt(mixed: DataFrame, number: int) -> DataFrame:
    """(key, block, id, component): members of mixed buckets, in blocks of bounded size."""
    blocks = F.ceil(F.col("n") / BLOCK)
    block = F.pmod(F.xxhash64("id", F.lit(number)), blocks)
    # The least member of a large bucket goes to all its blocks, so they share one.
    every = F.when((F.col("n") > BLOCK) & (F.col("id") == F.col("least")), F.sequence(F.lit(0).cast("bigint"), blocks - 1)).otherwise(F.array(block))
    return mixed.select("key", F.explode(every).alias("block"), "id", "component")


def _paired_members(mixed: DataFrame) -> DataFrame:
    """(key, block, id, component): members of mixed buckets, each two of which meet in a block.

    A bucket is dealt into parts of half a block, and a block is two of its parts; blocks of one component are left out.
    """
    own = mixed.withColumn("parts", F.ceil(F.col("n") / max(1, BLOCK // 2)))
    own = own.withColumn("part", F.pmod(F.xxhash64("id", F.lit(len(ROUNDS))), F.col("parts")))
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1), lambda x: x != F.col("part"))
    paired = own.select("key", "part", "parts", F.explode(others).alias("other"), "id", "component")
    paired = paired.select("key", (F.least("part", "other") * F.col("parts") + F.greatest("part", "other")).alias("block"), "id", "component")
    several = paired.groupBy("key", "block").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key", "block")
    return paired.join(several, ["key", "block"])


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_ids: int = 1 << 20, **options) -> DataFrame:
    """Rows of docs without the near copies of documents with smaller ids: one document of each class stays.

    Rows without an id stay; of rows that share an id one stays.
    """
    found = classes(docs, id_col, text_col, broadcast_ids=broadcast_ids, **options)
    gone = found.where(F.col(id_col) != F.col("class_id")).select(id_col).distinct()
    if gone.count() <= broadcast_ids:
        gone = F.broadcast(gone)
    out = docs.join(gone, id_col, "left_anti")
    twice = found.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col)
    if not twice.isEmpty():
        order = Window.partitionBy(id_col).orderBy(text_col, F.xxhash64(*docs.columns))
        one = out.join(twice, id_col, "left_semi").withColumn("__wl_nth", F.row_number().over(order)).where("__wl_nth = 1").drop("__wl_nth")
        out = out.join(twice, id_col, "left_anti").unionByName(one)
    return out.select(*docs.columns)
