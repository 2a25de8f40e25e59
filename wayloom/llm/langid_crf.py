"""Language identification of words by a linear-chain conditional random field.

The emission score of a word sums learnt weights of its affixes (first and last 1
to 4 bytes), its byte 2- and 3-grams and its entry in a hashed lexicon; learnt
transitions join neighbouring words. Forward-backward gives each word a posterior
over the languages, so code-switched text is labelled word by word; a document's
language has the largest posterior mass.

The recursions are vectorised over blocks of BLOCK words: one pass finds the
transfer matrix of each block, a short scan over the blocks of a document passes
the messages on, and one pass each way yields the posteriors. The result is that
of the plain recursion over the whole document.

Training sequences are runs of words of different documents put together, so the
transitions see switches. The model is trained on a bounded sample of rows: at most
`per_language` documents of each language, whole, of at most `max_bytes` each. More than
`max_languages` languages are refused with an error, as the model grows with their number
(its transitions with the square) and no text of one left out could be labelled right.

Edge cases: null texts and texts without a letter are `und` with score 0; a text
with letters always gets a learnt language; repeated rows are labelled alike; extra
columns are ignored; with no labelled rows everything is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import held_out, sample
from .storage import lean, release, small_batches
from .textkit import U64, Words, _powers, buffers, byte_slices, mix, words

BITS = 17
BLOCK = 64
AFFIX = (1, 2, 3, 4)
GRAMS = (2, 3)
UNKNOWN = "und"


def word_features(w: Words, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, bucket): hashed features of the picked words; every word has its lexicon entry at least."""
    power, inverse = _powers(len(w.lower) + 1)
    total = np.empty(len(w.lower) + 1, U64)
    total[0] = 0
    np.cumsum((w.lower.astype(U64) + U64(1)) * power[: len(w.lower)], out=total[1:])
    start, end = w.start[pick], w.end[pick]
    size = end - start
    own = np.arange(len(pick))
    rows, codes = [own], [mix(w.hash[pick] + U64(11))]

    def piece(kind: int, who: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        rows.append(who)
        codes.append(mix((total[b] - total[a]) * inverse[a] + U64(kind * 7919)))

    for k in AFFIX:
        fit = np.flatnonzero(size >= k)
        piece(20 + k, fit, start[fit], start[fit] + k)
        piece(40 + k, fit, end[fit] - k, end[fit])
    for k in GRAMS:
        n = np.maximum(size - k + 1, 0)
        who = np.repeat(own, n)
        at = start[who] + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
        piece(60 + k, who, at, at + k)
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    bucket = (np.concatenate(codes)[order] >> U64(64 - BITS)).astype(np.int64)
    return np.searchsorted(row[order], np.arange(len(pick) + 1)), bucket


@dataclass
class Crf:
    labels: list[str]
    emit: np.ndarray  # 2**BITS x labels
    move: np.ndarray  # labels x labels

    def emissions(self, w: Words) -> np.ndarray:
        """Emission scores of all words; features are summed once for each distinct word."""
        _, pick, back = np.unique(w.hash, return_index=True, return_inverse=True)
        first, bucket = word_features(w, pick)
        return np.add.reduceat(self.emit[bucket], first[:-1]).astype(np.float32)[back]

    def posteriors(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Posterior of each word; `first` bounds the sequences."""
        n, k = scores.shape
        if n == 0:
            return np.zeros((0, k))
        counts = np.diff(first)
        blocks = -(-counts // BLOCK)
        seq = np.repeat(np.arange(len(counts)), blocks)
        nth = np.arange(len(seq)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = first[seq] + nth * BLOCK
        size = np.minimum(BLOCK, first[seq + 1] - begin)
        order = np.argsort(-size, kind="stable")  # full blocks first: step t concerns a prefix
        begin, size, seq, nth = begin[order], size[order], seq[order], nth[order]
        alive = [int(np.searchsorted(-size, -t, "left")) for t in range(BLOCK)]  # blocks of more than t words
        e = np.exp(scores - scores.max(1, keepdims=True)).astype(np.float64)
        step = np.exp(self.move - self.move.max())
        # Transfer matrices: row a is the forward message after the block when a preceded it.
        carry = np.broadcast_to(np.eye(k), (len(seq), k, k)).copy()
        for t in range(BLOCK):
            m = alive[t]
            if not m:
                break
            x = (carry[:m].reshape(-1, k) @ step).reshape(m, k, k) * e[begin[:m] + t][:, None, :]
            carry[:m] = x / x.sum((1, 2), keepdims=True)
        came, goes = np.ones((len(seq), k)), np.ones((len(seq), k))
        where = np.full((len(counts), int(blocks.max())), -1)
        where[seq, nth] = np.arange(len(seq))
        long = np.argsort(-blocks, kind="stable")
        deep = int(blocks.max())
        for j in range(1, deep):
            own = long[: int(np.searchsorted(-blocks[long], -j, "left"))]
            prev, cur = where[own, j - 1], where[own, j]
            x = np.einsum("ij,ijk->ik", came[prev], carry[prev])
            came[cur] = x / x.sum(1, keepdims=True)
        for j in range(deep - 1, 0, -1):
            own = long[: int(np.searchsorted(-blocks[long], -j, "left"))]
            prev, cur = where[own, j - 1], where[own, j]
            x = np.einsum("ijk,ik->ij", carry[cur], goes[cur])
            goes[prev] = x / x.sum(1, keepdims=True)
        # The first word has no transition into it: a message that any transition turns into ones is not needed,
        # as `came` of a first block is replaced by the bare emission below.
        alpha = np.empty((n, k))
        state = came
        for t in range(BLOCK):
            m = alive[t]
            if not m:
                break
            x = state[:m] @ step
            if t == 0:
                x[nth[:m] == 0] = 1.0
            x *= e[begin[:m] + t]
            x /= x.sum(1, keepdims=True)
            alpha[begin[:m] + t] = x
            state = state.copy() if t == 0 else state
            state[:m] = x
        beta = goes.copy()
        out = np.empty((n, k))
        for t in range(BLOCK - 1, -1, -1):
            m = alive[t]
            if not m:
                continue
            at = begin[:m] + t
            x = alpha[at] * beta[:m]
            out[at] = x / x.sum(1, keepdims=True)
            x = (beta[:m] * e[at]) @ step.T
            beta[:m] = x / x.sum(1, keepdims=True)
        return out


def fit(seqs: np.ndarray, first: np.ndarray, bucket: np.ndarray, gold: np.ndarray, labels: list[str], epochs: int, rate: float = 0.3, decay: float = 1e-6, seed: int = 3) -> Crf:
    """Maximum likelihood by Adagrad. seqs: sequences x length of word numbers; first, bucket: features of the words; gold: sequences x length."""
    k = len(labels)
    crf = Crf(labels, np.zeros((1 << BITS, k), np.float32), np.zeros((k, k)))
    g_emit, g_move = np.full(crf.emit.shape, 1e-3, np.float32), np.full((k, k), 1e-3)
    rng = np.random.default_rng(seed)
    length = seqs.shape[1]
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(seqs)), max(1, len(seqs) // 32)):
            flat, y = seqs[rows].ravel(), gold[rows]
            size = first[flat + 1] - first[flat]
            start = np.cumsum(size) - size
            take = np.arange(size.sum()) + np.repeat(first[flat] - start, size)
            b = bucket[take]
            e = np.add.reduceat(crf.emit[b], start).reshape(len(rows), length, k).astype(float)
            e = np.exp(e - e.max(2, keepdims=True))
            step = np.exp(crf.move)
            alpha, beta = np.empty(e.shape), np.ones(e.shape)
            alpha[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
            for t in range(1, length):
                x = (alpha[:, t - 1] @ step) * e[:, t]
                alpha[:, t] = x / x.sum(1, keepdims=True)
            for t in range(length - 2, -1, -1):
                x = (beta[:, t + 1] * e[:, t + 1]) @ step.T
                beta[:, t] = x / x.sum(1, keepdims=True)
            post = alpha * beta
            post /= post.sum(2, keepdims=True)
            pair = alpha[:, :-1, :, None] * step * (beta[:, 1:] * e[:, 1:])[:, :, None, :]
            pair /= pair.sum((2, 3), keepdims=True)
            d_move = pair.sum((0, 1))
            np.add.at(d_move, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1.0)
            d_move = d_move / len(rows) + 1e-3 * crf.move
            err = post.copy()
            np.put_along_axis(err, y[:, :, None], np.take_along_axis(err, y[:, :, None], 2) - 1, 2)
            err = np.repeat((err.reshape(-1, k) / len(rows)).astype(np.float32), size, 0)
            order = np.argsort(b, kind="stable")
            cut = np.flatnonzero(np.concatenate([[True], np.diff(b[order]) != 0]))
            u = b[order][cut]
            d = np.add.reduceat(err[order], cut) + decay * crf.emit[u]
            g_emit[u] += d**2
            g_move += d_move**2
            crf.emit[u] -= rate * d / np.sqrt(g_emit[u])
            crf.move -= rate * d_move / np.sqrt(g_move)
    return crf


def _sequences(lang: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and languages of training sequences: shuffled runs of 8 to 40 words, joined and cut to `length`."""
    rng = np.random.default_rng(seed)
    pieces = []
    for y, a, b in zip(lang, starts, ends, strict=True):
        while a < b:
            m = min(int(rng.integers(8, 41)), b - a)
            pieces.append((y, a, m))
            a += m
    order = rng.permutation(len(pieces))
    at = np.concatenate([np.arange(pieces[i][1], pieces[i][1] + pieces[i][2]) for i in order])
    y = np.concatenate([np.full(pieces[i][2], pieces[i][0]) for i in order])
    n = max(1, len(at) // length)
    at, y = np.resize(at, n * length), np.resize(y, n * length)
    return at.reshape(n, length), y.reshape(n, length)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 500, max_bytes: int = 1 << 16, max_languages: int = 256, epochs: int = 4, length: int = 50) -> Crf:
    """Fit on rows with a language that are not held out."""
    own = docs.select(F.col(id_col).alias("i"), F.col(lang_col).alias("y"), F.col(text_col).alias("t"))
    own = own.where(F.col("i").isNotNull() & ~held_out("i") & (F.octet_length("t") <= max_bytes))
    chosen = sample(own, "y", per_language, ["i", "t"], max_languages, "languages")
    got = chosen.select("y", "t", F.xxhash64("i", "t").alias("h")).toArrow().sort_by([("h", "ascending"), ("y", "ascending")])
    names = got["y"].to_pylist()
    labels = sorted(set(names))
    data, offsets = buffers(got["t"])
    # Texts are cut into words a slice at a time, and features are kept for distinct words only, so the driver holds little.
    known = np.zeros(0, U64)
    hashes, counts, sizes, buckets, fresh_names = [known], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [known]
    for a, b in byte_slices(offsets, 1 << 18):
        w = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        own_names, pick = np.unique(w.hash, return_index=True)
        fresh = ~np.isin(own_names, known)
        first, bucket = word_features(w, pick[fresh])
        hashes.append(w.hash)
        counts.append(w.counts())
        sizes.append(np.diff(first))
        buckets.append(bucket.astype(np.int32))
        fresh_names.append(own_names[fresh])
        known = np.union1d(known, own_names)
    words_of = np.concatenate(hashes)
    if not len(words_of):
        return Crf([], np.zeros((1 << BITS, 0), np.float32), np.zeros((0, 0)))
    order = np.argsort(np.concatenate(fresh_names))
    word = order[np.searchsorted(known, words_of)]
    first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    begin = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    lang = np.array([labels.index(x) for x in names])
    seqs, gold = _sequences(lang, begin[:-1], begin[1:], length)
    crf = fit(word[seqs], first, np.concatenate(buckets), gold, labels, epochs)
    del got, data, words_of, word, seqs, gold
    release()
    return crf


def has_letter(raw: bytes) -> bool:
    """Whether a UTF-8 text has a letter of any script."""
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def identify(docs: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 1 << 19) -> DataFrame:
    """docs with lang_pred, score (posterior share of that language) and n_switches (words labelled unlike the word before)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(crf)
    docs = docs.drop("lang_pred", "score", "n_switches")
    position = docs.columns.index(text_col)

    def one(model: Crf, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        n = len(offsets) - 1
        w = words(data, offsets)
        counts = w.counts()
        if not model.labels:
            return [UNKNOWN] * n, np.zeros(n), np.zeros(n, np.int64)
        some = np.flatnonzero(counts)
        best, share, switches = np.full(n, -1), np.zeros(n), np.zeros(n, np.int64)
        if len(some):
            bounds = np.append(w.first[some], w.first[-1])
            post = model.posteriors(model.emissions(w), bounds)
            mass = np.add.reduceat(post, bounds[:-1]) / counts[some][:, None]
            best[some], share[some] = mass.argmax(1), mass.max(1)
            tag = post.argmax(1)
            turn = np.concatenate([[0], tag[1:] != tag[:-1]])
            turn[bounds[:-1]] = 0
            switches[some] = np.add.reduceat(turn, bounds[:-1])
        ascii_letter = np.zeros(len(data) + 1, np.int64)
        np.cumsum((w.lower >= 0x61) & (w.lower <= 0x7A), out=ascii_letter[1:])
        lettered = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
        for i in np.flatnonzero(~lettered):
            lettered[i] = has_letter(data[offsets[i] : offsets[i + 1]].tobytes())
        best[~lettered] = -1
        share[best < 0] = 0
        return [model.labels[k] if k >= 0 else UNKNOWN for k in best], np.clip(share, 0, 1), switches

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(position))
            tags: list[str] = []
            share, turns = [np.zeros(0)], [np.zeros(0, np.int64)]
            for a, b in byte_slices(offsets, slice_bytes):
                x, y, z = one(shared.value, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                tags += x
                share.append(y)
                turns.append(z)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tags, pa.string()), pa.array(np.concatenate(share)), pa.array(np.concatenate(turns))], names=[*batch.schema.names, "lang_pred", "score", "n_switches"])

    out = docs.withColumns({"lang_pred": F.lit(None).cast("string"), "score": F.lit(None).cast("double"), "n_switches": F.lit(None).cast("bigint")}).schema
    return docs.mapInArrow(lean(run), out)
