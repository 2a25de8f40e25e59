"""Hashed words and structure statistics of texts, and bounded training samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textkit import Words, words

#: Byte classes counted for each text, in this order (fixed values).
CLASSES = ["lower", "upper", "digit", "space", "newline", "bang", "bar", "symbol", "stop", "bracket", "lead", "tail", "other"]


def _class_table() -> np.ndarray:
    out = np.full(256, CLASSES.index("other"), np.uint8)
    for name, chars in {
        "lower": bytes(range(0x61, 0x7B)),
        "upper": bytes(range(0x41, 0x5B)),
        "digit": b"0123456789",
        "space": b" \t",
        "newline": b"\n\r",
        "bang": b"!",
        "bar": b"|",
        "symbol": b"#$%&*@=<>~^+_\\/",
        "stop": b".,;:?",
        "bracket": b"\"'()[]{}-`",
        "lead": bytes(range(0xC0, 0x100)),
        "tail": bytes(range(0x80, 0xC0)),
    }.items():
        out[list(chars)] = CLASSES.index(name)
    return out


_CLASS = _class_table()
#: Statistics of a text: the share of each byte class among its characters, then these (fixed values).
STATS = [f"share_{c}" for c in CLASSES if c != "tail"] + ["distinct", "word_bytes", "log_words", "line_words", "upper_words", "top_word"]


@dataclass
class Features:
    """Distinct hashed words of each row with their counts, and the row's statistics."""

    first: np.ndarray  # rows + 1
    bucket: np.ndarray
    count: np.ndarray
    n_words: np.ndarray
    stats: np.ndarray  # rows x len(STATS)


def extract(data: np.ndarray, offsets: np.ndarray, bits: int) -> Features:
    """Features of the rows of a batch; a row without words has none of the hashed kind and zero statistics."""
    w = words(data, offsets)
    n = len(offsets) - 1
    first, bucket, count = tally(w, bits)
    n_words = w.counts()
    size = np.diff(offsets)
    hist = np.bincount(np.repeat(np.arange(n, dtype=np.int64) * 16, size) + _CLASS[data], minlength=16 * n).reshape(n, 16)[:, : len(CLASSES)]
    chars = np.maximum(1, hist.sum(1) - hist[:, CLASSES.index("tail")])
    shares = np.delete(hist / chars[:, None], CLASSES.index("tail"), 1)
    some = np.maximum(n_words, 1)
    distinct = np.diff(first)
    top = np.zeros(n)
    filled = distinct > 0
    if len(count):
        top[filled] = np.maximum.reduceat(count, first[:-1][filled])
    length = np.concatenate([[0], np.cumsum(w.end - w.start)])
    upper = np.concatenate([[0], np.cumsum((data[w.start] >= 0x41) & (data[w.start] <= 0x5A))]) if len(w.start) else np.zeros(1)
    lines = hist[:, CLASSES.index("newline")] + 1
    more = [
        distinct / some,
        (length[w.first[1:]] - length[w.first[:-1]]) / some,
        np.log1p(n_words),
        n_words / lines,
        (upper[w.first[1:]] - upper[w.first[:-1]]) / some,
        top / some,
    ]
    return Features(first, bucket, count, n_words, np.column_stack([shares, *more]))


def tally(w: Words, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, bucket, count): distinct hash buckets of each row, ordered by bucket."""
    n = len(w.first) - 1
    key = (w.rows() << bits) | (w.hash >> np.uint64(64 - bits)).astype(np.int64)
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(key)))
    key = key[at]
    return np.searchsorted(key, np.arange(n + 1, dtype=np.int64) << bits), key & ((1 << bits) - 1), count


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def sample(rows: DataFrame, by: str, per_class: int, key: str | list[str], most: int = 256, what: str = "classes") -> DataFrame:
    """At most `per_class` rows for each value of `by`, the first by hash of the `key` columns: the same rows whatever the partitioning.

    One scan counts the classes, of which there may be `most`; another takes of each class
    the expected share of its rows and a margin, which are then ranked, so no class meets
    in one task whole.
    """
    key = [key] if isinstance(key, str) else key
    rows = rows.where(F.col(by).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(by).count().limit(most + 1).collect()}
    if len(sizes) > most:
        raise ValueError(f"over {most} {what}; at most {most} are supported")
    if not sizes:
        return rows.where(F.lit(False))
    scale = 1 << 20
    hashed = F.xxhash64(*key, F.lit(7))
    share = F.lit(0)
    for value, n in sorted(sizes.items(), key=str):
        share = F.when(F.col(by) == F.lit(value), F.lit(int(scale * min(1.0, (1.2 * per_class + 50) / n)))).otherwise(share)
    few = rows.where(F.pmod(hashed, F.lit(scale)) < share)
    order = Window.partitionBy(by).orderBy(hashed, *key)
    return few.withColumn("__wl_rank", F.row_number().over(order)).where(F.col("__wl_rank") <= per_class).drop("__wl_rank")


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, per_class: int) -> DataFrame:
    """(id, __wl_y, text): a bounded sample of the labelled texts that are not held out, one for each id.

    An id with contradictory labels teaches nothing and is left out; of different texts
    with one id the least is taken.
    """
    own = labels.select(id_col, F.col(label_col).cast("int").alias("y")).where(F.col(id_col).isNotNull() & F.col("y").isNotNull() & ~held_out(id_col))
    agreed = own.groupBy(id_col).agg(F.min("y").alias("__wl_y"), F.max("y").alias("__wl_z")).where("__wl_y = __wl_z").drop("__wl_z")
    chosen = F.broadcast(sample(agreed, "__wl_y", per_class, [id_col]))
    return docs.select(id_col, text_col).join(chosen, id_col).groupBy(id_col, "__wl_y").agg(F.min(text_col).alias(text_col))
