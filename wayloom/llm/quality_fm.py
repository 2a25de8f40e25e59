"""Quality classifier: a factorisation machine over hashed words and structure statistics.

A text is a sparse vector x: its distinct hashed words, weighted by the square
root of their share, and one indicator for the quantile bin of each structure
statistic and of its length. Its score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2],

all pairwise interactions in time linear in the number of non-zero x_i.

The model is fitted on the driver from at most `per_class` labelled rows of each
class (features, not texts, are collected); its size is fixed by `bits`.

Edge cases: null and empty texts are scored from their (zero) statistics; repeated
rows get equal scores; rows with a null id are scored and never held out; extra
columns are ignored; an id with contradictory labels isn't learnt from, and of rows that
share an id one text is; without any labelled row of both classes the prior is used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import STATS, Features, extract, labelled
from .storage import lean, release, small_batches
from .textkit import buffers, byte_slices

BINS = 10
STAT_VALUE = 0.3
BATCH = 64
MIN_STEPS = 400
#: Weight of the positive class in the loss; a text as likely good as bad under it scores so.
PRIOR = 0.7


@dataclass
class FactorMachine:
    bits: int
    edges: np.ndarray  # len(STATS) x (BINS - 1)
    w0: float
    w: np.ndarray
    v: np.ndarray

    def vectors(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sparse rows (first, index, value): hashed words, then one bin for each statistic."""
        n, s = len(f.first) - 1, len(STATS)
        bins = np.stack([np.searchsorted(self.edges[j], f.stats[:, j], "right") for j in range(s)], 1)
        stat = (1 << self.bits) + np.arange(s) * BINS + bins
        counts = np.diff(f.first)
        first = f.first + s * np.arange(n + 1)
        index, value = np.empty(first[-1], np.int64), np.empty(first[-1], np.float32)
        at = np.arange(len(f.bucket)) + s * np.repeat(np.arange(n), counts)
        index[at] = f.bucket
        value[at] = np.sqrt(f.count / np.repeat(np.maximum(f.n_words, 1), counts))
        at = (first[1:] - s)[:, None] + np.arange(s)
        index[at], value[at] = stat, STAT_VALUE
        return first, index, value

    def margins(self, first: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Scores before the logistic; every row has at least its statistics, so none is empty."""
        vx = self.v[index] * value[:, None]
        linear = np.add.reduceat(self.w[index] * value, first[:-1])
        total = np.add.reduceat(vx, first[:-1])
        return self.w0 + linear + 0.5 * ((total**2).sum(1) - np.add.reduceat((vx**2).sum(1), first[:-1]))

    def fit(self, first: np.ndarray, index: np.ndarray, value: np.ndarray, y: np.ndarray, epochs: int, rate: float, decay: float, seed: int = 1) -> None:
        """Adagrad on the log loss, updating only the rows a batch touches.

        The classes are weighed so that the positive one has the mass PRIOR, whatever their numbers.
        """
        rng = np.random.default_rng(seed)
        gw, gv, g0 = np.full(self.w.shape, 1e-2, np.float32), np.full(self.v.shape, 1e-2, np.float32), 1e-2
        weight = np.where(y == 1, PRIOR / max(y.mean(), 1e-6), (1 - PRIOR) / max(1 - y.mean(), 1e-6))
        for _ in range(max(epochs, MIN_STEPS * BATCH // len(y))):
            for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // BATCH)):
                size = first[rows + 1] - first[rows]
                start = np.concatenate([[0], np.cumsum(size)])
                take = np.arange(start[-1]) + np.repeat(first[rows] - start[:-1], size)
                i, x = index[take], value[take]
                p = 1 / (1 + np.exp(-np.clip(self.margins(start, i, x), -30, 30)))
                err = ((p - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
                seg = np.repeat(np.arange(len(rows)), size)
                vx = self.v[i] * x[:, None]
                total = np.add.reduceat(vx, start[:-1])
                gi = err[seg] * x
                order = np.argsort(i, kind="stable")
                cut = np.flatnonzero(np.concatenate([[True], np.diff(i[order]) != 0]))
                u = i[order][cut]
                dw = np.add.reduceat(gi[order], cut) + decay * self.w[u]
                dv = np.add.reduceat((gi[:, None] * (total[seg] - vx))[order], cut) + decay * self.v[u]
                gw[u] += dw**2
                gv[u] += dv**2
                self.w[u] -= rate * dw / np.sqrt(gw[u])
                self.v[u] -= rate * dv / np.sqrt(gv[u])
                g0 += err.sum() ** 2
                self.w0 -= rate * err.sum() / np.sqrt(g0)


def collect_features(rows: DataFrame, text_col: str, label_col: str, bits: int) -> tuple[Features, np.ndarray]:
    """Features and labels of a bounded set of training rows, on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = extract(*buffers(batch.column(0)), bits)
            lists = lambda v, t: pa.ListArray.from_arrays(pa.array(f.first, pa.int32()), pa.array(v, t))
            stats = pa.ListArray.from_arrays(pa.array(np.arange(len(f.stats) + 1) * len(STATS), pa.int32()), pa.array(f.stats.ravel()))
            yield pa.RecordBatch.from_arrays([lists(f.bucket, pa.int32()), lists(f.count, pa.int32()), stats, pa.array(f.n_words, pa.int64()), batch.column(1)], names=["b", "c", "s", "n", "y"])

    out = rows.select(text_col, F.col(label_col).cast("int")).mapInArrow(lean(run), "b array<int>, c array<int>, s array<double>, n bigint, y int").toArrow().sort_by([("n", "ascending"), ("y", "ascending")])
    flat = lambda k: out[k].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sizes = np.array([len(x) for x in out["b"]], np.int64)
    f = Features(np.concatenate([[0], np.cumsum(sizes)]), flat("b").astype(np.int64), flat("c"), out["n"].to_numpy(), flat("s").reshape(len(sizes), len(STATS)))
    return f, out["y"].to_numpy().astype(float)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = 4000, bits: int = 16, factors: int = 6, epochs: int = 8) -> FactorMachine:
    """Fit on labelled rows that are not held out, at most `per_class` of each class."""
    rows = labelled(docs, labels, label_col, id_col, text_col, per_class)
    f, y = collect_features(rows, text_col, "__wl_y", bits)
    size = (1 << bits) + len(STATS) * BINS
    rng = np.random.default_rng(0)
    edges = np.quantile(f.stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T if len(y) else np.zeros((len(STATS), BINS - 1))
    m = FactorMachine(bits, np.ascontiguousarray(edges), 0.0, np.zeros(size, np.float32), rng.normal(0, 0.05, (size, factors)).astype(np.float32))
    if len(set(y.tolist())) == 2:
        m.fit(*m.vectors(f), y, epochs, 0.1, 1e-5)
    release()
    return m


def score(docs: DataFrame, model: FactorMachine, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 1 << 21) -> DataFrame:
    """(id, score) of every row; the model has a fixed size and is broadcast."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            out = [np.zeros(0)]
            for a, b in byte_slices(offsets, slice_bytes):
                f = extract(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], m.bits)
                out.append(1 / (1 + np.exp(-np.clip(m.margins(*m.vectors(f)).astype(float), -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out))], names=[id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {kind}, score double")
