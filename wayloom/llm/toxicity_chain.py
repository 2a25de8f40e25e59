"""Toxicity: a chain of linear classifiers, one for each category, in a fixed order.

Categories: `blunt` and `suspect` are rows that hold a term of that kind, whatever their
label; `toxic` is the label itself and comes last. The kinds are learnt: of the terms that
set toxic rows apart, a blunt one has log-odds over BLUNT (clean rows hardly ever have it), a
suspect one over SUSPECT. The model of each category is a logistic regression over hashed
terms (words and their 4- to 6-byte beginnings, which catch inflected forms) plus the
probabilities of all earlier categories. In training those probabilities are
out-of-fold: each row gets them from models that did not see it, whose terms and kinds were
chosen without it too, so a later model can't lean on an earlier one's memory of the labels.

Terms are chosen by likelihood ratio on the training rows, so the model is a few thousand
weights whatever the corpus. It is fitted on the driver from the hashed terms of at
most `per_class` labelled rows of each class.

Edge cases: null and empty texts hold no terms and get the bias alone; repeated
rows get equal scores; extra columns are ignored; an id with contradictory labels isn't
learnt from, and of rows that share an id one text is; without labels of both classes
every probability is the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import labelled
from .storage import lean, release, small_batches
from .textkit import U64, Words, buffers, byte_slices, mix, words

CATEGORIES = ("blunt", "suspect", "toxic")
BLUNT, SUSPECT = 5.0, 1.0
BITS = 22
FOLDS = 3
BEGINNINGS = (4, 5, 6)


def terms(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(first, bucket): distinct hashed terms of each row, ordered."""
    rows = w.rows()
    keys = [(rows << BITS) | (w.hash >> U64(64 - BITS)).astype(np.int64)]
    size = w.end - w.start
    # A beginning is hashed from its bytes as one integer, so equal beginnings meet whatever follows.
    for k in BEGINNINGS:
        own = np.flatnonzero(size > k)
        code = np.full(len(own), k, U64)
        for j in range(k):
            code = code * U64(257) + w.lower[w.start[own] + j].astype(U64)
        keys.append((rows[own] << BITS) | (mix(code * U64(0x9E3779B97F4A7C15)) >> U64(64 - BITS)).astype(np.int64))
    key = np.concatenate(keys)
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    n = len(w.first) - 1
    return np.searchsorted(key, np.arange(n + 1, dtype=np.int64) << BITS), key & ((1 << BITS) - 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Link:
    """Logistic regression over chosen terms and the probabilities of earlier categories."""

    bias: float
    weight: np.ndarray
    earlier: np.ndarray

    def prob(self, first: np.ndarray, slot: np.ndarray, before: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(self.weight[slot])])
        return _sigmoid(self.bias + total[first[1:]] - total[first[:-1]] + before @ self.earlier)


def _fit(first: np.ndarray, slot: np.ndarray, before: np.ndarray, y: np.ndarray, n: int, steps: int = 500) -> Link:
    """Full-batch Adagrad with weight decay; both classes weigh alike."""
    link = Link(0.0, np.zeros(n), np.zeros(before.shape[1]))
    if not len(y) or y.min() == y.max():
        p = min(max((y.sum() + 0.5) / (len(y) + 1), 1e-4), 1 - 1e-4)
        link.bias = float(np.log(p / (1 - p)))
        return link
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    row = np.repeat(np.arange(len(y)), np.diff(first))
    gb, gw, ge = 1e-8, np.full(n, 1e-8), np.full(before.shape[1], 1e-8)
    for _ in range(steps):
        err = (link.prob(first, slot, before) - y) * weight
        db, dw = err.sum(), np.bincount(slot, err[row], n) + 1e-5 * link.weight
        de = before.T @ err + 1e-5 * link.earlier
        gb, gw, ge = gb + db**2, gw + dw**2, ge + de**2
        link.bias -= 0.3 * db / np.sqrt(gb)
        link.weight -= 0.3 * dw / np.sqrt(gw)
        link.earlier -= 0.3 * de / np.sqrt(ge)
    return link


@dataclass
class Chain:
    slots: np.ndarray  # 2**BITS: number of the chosen term, or -1
    links: list[Link] = field(default_factory=list)

    def choose(self, first: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = self.slots[bucket]
        kept = np.concatenate([[0], np.cumsum(slot >= 0)])
        return kept[first], slot[slot >= 0]

    def predict(self, first: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        first, slot = self.choose(first, bucket)
        out = np.zeros((len(first) - 1, 0))
        for link in self.links:
            out = np.column_stack([out, link.prob(first, slot, out)])
        return out


class _Terms:
    """Terms chosen on some rows, the chosen ones of every row, and every row's categories."""

    def __init__(self, first: np.ndarray, term: np.ndarray, toxic: np.ndarray, seen: np.ndarray, max_terms: int, evidence: float):
        """term: numbers of the terms of all rows; seen: whether a row may be learnt from."""
        n = int(term.max(initial=-1)) + 1
        row = np.repeat(np.arange(len(toxic)), np.diff(first))
        use = seen[row]
        pos, neg = (np.bincount(term[use], y[row][use], n) for y in (toxic, 1 - toxic))
        n1, n0 = max(toxic[seen].sum(), 1), max((1 - toxic)[seen].sum(), 1)
        odds = np.log((pos + 0.5) / (n1 + 1)) - np.log((neg + 0.5) / (n0 + 1))
        gain = _likelihood_ratio(pos, neg, n1, n0)
        gain[gain < evidence] = 0
        self.chosen = np.argsort(-gain, kind="stable")[:max_terms]
        self.chosen = self.chosen[gain[self.chosen] > 0]
        slots = np.full(n, -1, np.int64)
        slots[self.chosen] = np.arange(len(self.chosen))
        slot = slots[term]
        self.first, self.slot = np.concatenate([[0], np.cumsum(slot >= 0)])[first], slot[slot >= 0]
        odds = odds[self.chosen][self.slot]
        self.target = np.column_stack([self._holds(odds > BLUNT), self._holds((odds > SUSPECT) & (odds <= BLUNT)), toxic])

    def _holds(self, kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind)])
        return (total[self.first[1:]] > total[self.first[:-1]]).astype(float)

    def fit(self, category: int, rows: np.ndarray, before: np.ndarray) -> Link:
        return _fit(*_rows(self.first, self.slot, rows), before[rows], self.target[rows, category], len(self.chosen))


def fit_chain(first: np.ndarray, bucket: np.ndarray, toxic: np.ndarray, fold: np.ndarray, max_terms: int = 4096, evidence: float = 20.0) -> Chain:
    """Choose terms, derive the categories, and fit the links in order with out-of-fold probabilities.

    A term is chosen if the log-likelihood ratio of its presence against the label is
    at least `evidence`, which chance reaches once in some 100,000 terms.
    """
    buckets, term = np.unique(bucket, return_inverse=True)
    every = np.arange(len(toxic))
    whole = _Terms(first, term, toxic, every >= 0, max_terms, evidence)
    parts = [_Terms(first, term, toxic, fold != k, max_terms, evidence) for k in range(FOLDS)]
    chain = Chain(np.full(1 << BITS, -1, np.int16))
    chain.slots[buckets[whole.chosen]] = np.arange(len(whole.chosen))
    before = np.zeros((len(toxic), 0))
    for category in range(len(CATEGORIES)):
        chain.links.append(whole.fit(category, every, before))
        held = np.zeros(len(toxic))
        for k, part in enumerate(parts):
            own = np.flatnonzero(fold == k)
            held[own] = part.fit(category, np.flatnonzero(fold != k), before).prob(*_rows(part.first, part.slot, own), before[own])
        before = np.column_stack([before, held])
    return chain


def _likelihood_ratio(pos: np.ndarray, neg: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """G-squared of the 2x2 tables (with the term, without) x (positive, negative)."""
    out = np.zeros(len(pos))
    for seen, size in ((pos, n1), (neg, n0)):
        for part, whole in ((seen, pos + neg), (size - seen, n1 + n0 - pos - neg)):
            expected = whole * size / (n1 + n0)
            some = (part > 0) & (expected > 0)
            out[some] += 2 * part[some] * np.log(part[some] / expected[some])
    return out


def _rows(first: np.ndarray, slot: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = first[rows + 1] - first[rows]
    start = np.concatenate([[0], np.cumsum(size)])
    return start, slot[np.arange(start[-1]) + np.repeat(first[rows] - start[:-1], size)]


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = 2500) -> Chain:
    """Fit on labelled rows that are not held out, at most `per_class` of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for a, b in byte_slices(offsets, 1 << 21):
                first, bucket = terms(words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(bucket, pa.int32()))
                yield pa.RecordBatch.from_arrays([lists, batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a)], names=["t", "y", "h"])

    rows = labelled(docs, labels, label_col, id_col, text_col, per_class).select(text_col, "__wl_y", F.xxhash64(id_col).alias("h"))
    got = rows.mapInArrow(lean(run), "t array<int>, y int, h bigint").toArrow().sort_by("h")
    lists = got["t"].combine_chunks()
    bucket = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    toxic = got["y"].to_numpy().astype(float)
    del got, lists
    chain = fit_chain(first, bucket, toxic, np.arange(len(toxic)) % FOLDS)
    release()
    return chain


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 1 << 21) -> DataFrame:
    """(id, one probability for each category) of every row; the model has a fixed size and is broadcast."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            out = [np.zeros((0, len(CATEGORIES)))]
            for a, b in byte_slices(offsets, slice_bytes):
                out.append(shared.value.predict(*terms(words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))))
            p = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, k]) for k in range(len(CATEGORIES)))], names=[id_col, *(f"p_{c}" for c in CATEGORIES)])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {kind}, " + ", ".join(f"p_{c} double" for c in CATEGORIES))
