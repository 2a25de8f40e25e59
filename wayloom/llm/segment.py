"""Distinct sampled segmentations of texts into SentencePiece pieces, and their decoding.

A text, with a space before it, is a lattice: its nodes are character boundaries, its
edges the pieces of the model that spell the bytes between two nodes, and, for a
character that is no piece, its bytes. A piece of rank r has the log-probability
-ln(r + SHIFT) - ln Z (the model stores merge ranks, so the usual rank law stands in for
frequencies), a byte that of the last rank. Backward sums turn the lattice into a Markov
chain: q(edge) is the probability of an edge given its first node.

Sampling without replacement is a perturbed A-star search. A queue holds sets of
segmentations: those that begin with given edges and don't go on with some others. Each
has the perturbed score of its best member, a Gumbel variable of the set's mass that is
truncated at its parent's. The best set is popped; its best member, drawn by following
q from where the set is free, is the next sample; the rest of the set splits, at each
edge of the sample, into sets that leave it there. The k samples are the top k of all
segmentations under Gumbel noise. A sample's inclusion score is the probability that
its perturbed score passes the (k+1)-th.

The lattices of a batch are built once for each distinct chunk (the parts of a text that
no piece spans), and all rows take their steps together. Random numbers are hashes of
the row key, the sample and the place, so a rerun gives the same samples.

Edge cases: null and empty texts have one segmentation, the empty one; a text with fewer
than k segmentations returns all it has; U+2581 in a text is spelled in bytes, so it
survives the round trip; rows without a key share one seed; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import lean, small_batches
from .textkit import U64, _powers, buffers, byte_slices, mix, ranges

SPACE = "▁"
SHIFT = 2.7
#: Gumbel variables of 53-bit uniforms differ by less than SPREAD: sets that much below NEAR don't matter where enough lie above it.
NEAR, SPREAD = 20.0, 41.0
NEVER = -np.inf
#: Numbers in a table of all edges of the trie, at most; beyond that they are looked up by hash.
DENSE = 1 << 24

_loaded: dict[str, Pieces] = {}


class Pieces:
    """Trie, scores and bytes of a model's pieces, with the space sign as a space."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.byte_id = np.zeros(256, np.int32)
        self.raw: list[bytes] = [b""] * n
        plain = []
        for i in range(n):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(text[1:-1], 16)
                self.byte_id[value] = i
                self.raw[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.raw[i] = text.replace(SPACE, " ").encode()
                plain.append(i)
        rank = np.arange(len(plain))
        cost = np.log(rank + SHIFT) + np.log((1 / (rank + SHIFT)).sum())
        self.score = np.zeros(n)
        self.score[plain] = -cost
        self.byte_score = float(-cost[-1])
        used = sorted({b for i in plain for b in self.raw[i]})
        self.column = np.zeros(256, np.int64)  # 0: in no piece
        self.column[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        edges: dict[int, int] = {}
        ends: dict[int, int] = {}
        nodes = 1
        self.inside = np.zeros((256, 256), bool)
        for i in plain:
            at = 0
            piece = self.raw[i]
            for b in piece:
                key = at * width + int(self.column[b])
                if key not in edges:
                    edges[key] = nodes
                    nodes += 1
                at = edges[key]
            ends[at] = i
            if len(piece) > 1:
                two = np.frombuffer(piece, np.uint8)
                self.inside[two[:-1], two[1:]] = True
        self.width = width
        self._fill(np.array(list(edges), np.int64), np.array(list(edges.values()), np.int32))
        # Up to DENSE numbers: the edges of all nodes that have some, a row of the table each; row 0 is of those without.
        inner, keys = np.unique(self.keys[self.keys >= 0] // width), self.keys[self.keys >= 0]
        self.row = np.zeros(nodes, np.int32)
        self.row[inner] = np.arange(1, len(inner) + 1)
        self.next = None
        if (len(inner) + 1) * width <= DENSE:
            self.next = np.zeros((len(inner) + 1) * width, np.int32)
            self.next[self.row[keys // width].astype(np.int64) * width + keys % width] = self.values[self.keys >= 0]
        self.end = np.full(nodes, -1, np.int32)
        self.end[list(ends)] = list(ends.values())

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Trie edges in an open-addressed table, at most a quarter full."""
        self.bits = int(4 * len(keys)).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int32)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            at, first = np.unique(slot[free], return_index=True)
            self.keys[at], self.values[at] = keys[free[first]], values[free[first]]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def step(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Next trie states, 0 where there is no edge."""
        if self.next is not None:
            return self.next[self.row[state].astype(np.int64) * self.width + column]
        keys = state * self.width + column
        slot = self._slot(keys)
        out = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        while len(left):
            here = self.keys[slot]
            same = here == keys[left]
            out[left[same]] = self.values[slot[same]]
            more = ~same & (here >= 0)
            left, slot = left[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return out

    @classmethod
    def load(cls, path: str) -> Pieces:
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the pieces, without the space put before the text."""
        return b"".join([self.raw[i] for i in ids.tolist()])[1:]


def _order(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Order by major, then minor (both not negative): one sort of packed numbers where they fit in 64 bits."""
    n = len(major)
    bits = [max(1, int(x.max(initial=0)).bit_length()) for x in (major, minor)] + [max(1, n.bit_length())]
    if sum(bits) > 64:
        return np.lexsort((minor, major))
    key = (major.astype(U64) << U64(bits[1] + bits[2])) | (minor.astype(U64) << U64(bits[2])) | np.arange(n, dtype=U64)
    key.sort()
    return (key & U64((1 << bits[2]) - 1)).astype(np.int64)


class Lattice:
    """Lattices of the distinct chunks of a batch, side by side, with transition probabilities."""

    def __init__(self, p: Pieces, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """start, end: byte ranges of all chunks in data."""
        power, inverse = _powers(len(data) + 1)
        total = np.empty(len(data) + 1, U64)
        total[0] = 0
        np.cumsum((data.astype(U64) + U64(1)) * power[: len(data)], out=total[1:])
        code = mix((total[end] - total[start]) * inverse[start])
        _, pick, self.of = np.unique(code, return_index=True, return_inverse=True)
        size = (end - start)[pick]
        self.node = np.cumsum(size + 1) - (size + 1)  # first node of each distinct chunk
        n = int((size + 1).sum())
        text = np.full(n, 0xFF, np.uint8)  # no UTF-8 byte: it ends a chunk
        text[ranges(self.node, size)] = data[ranges(start[pick], size)]
        self.text = text
        self.last = np.zeros(n, bool)
        self.last[self.node + size] = True
        first = np.flatnonzero((text & 0xC0) != 0x80)
        first = first[~self.last[first]]
        a, b, ids = [], [], []
        at, state, length = first, np.zeros(len(first), np.int64), 0
        column = p.column[text]
        while len(at):
            state = p.step(state, column[at + length])
            length += 1
            alive = state > 0
            at, state = at[alive], state[alive]
            piece = p.end[state]
            got = piece >= 0
            a.append(at[got])
            b.append(at[got] + length)
            ids.append(piece[got])
        a, b, ids = np.concatenate(a or [first]), np.concatenate(b or [first]), np.concatenate(ids or [np.zeros(0, np.int32)])
        # Characters that are no piece are spelled in bytes.
        step = np.ones(len(first), np.int64)
        for bound, k in ((0xC0, 2), (0xE0, 3), (0xF0, 4)):
            step[text[first] >= bound] = k
        follow = first + step
        whole = np.zeros(n, bool)
        # Pieces of one character: as long as the lead byte says.
        lead = np.ones(n, np.int64)
        lead[first] = step
        whole[a[b - a == lead[a]]] = True
        bare = ~whole[first]
        a, b = np.concatenate([a, first[bare]]), np.concatenate([b, follow[bare]])
        score = np.concatenate([p.score[ids], step[bare] * p.byte_score])
        ids = np.concatenate([ids, np.full(bare.sum(), -1, np.int32)])
        chunk_end = np.repeat(self.node + size, size + 1)
        back = chunk_end[a] - a
        order = _order(back, a)
        a, b, score, ids, back = a[order], b[order], score[order], ids[order], back[order]
        mass = np.full(n, NEVER)
        mass[self.last] = 0.0
        cut = np.flatnonzero(np.concatenate([[True], back[1:] != back[:-1]])) if len(back) else np.zeros(0, np.int64)
        for x, y in zip(cut, np.append(cut[1:], len(back)), strict=True):
            own = a[x:y]
            group = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            mass[own[group]] = np.logaddexp.reduceat(score[x:y] + mass[b[x:y]], group)
        log_q = score + mass[b] - mass[a]
        # Edges of a node, likeliest first: few steps find the one that a random number picks.
        order = _order(a, np.minimum(-log_q * 1024, 1 << 16).astype(np.int64).clip(0))
        self.a, self.b, self.id, self.log_q = a[order], b[order], ids[order], np.minimum(log_q[order], 0.0)
        q = np.exp(self.log_q)
        fan = np.bincount(self.a, minlength=n)
        self.first = np.concatenate([[0], np.cumsum(fan)])
        head = self.first[:-1][fan > 0]
        fan = fan[fan > 0]
        run = np.cumsum(q)
        run -= np.repeat((run - q)[head], fan)
        self.upto = run
        self.q = q
        self.upto[head + fan - 1] = 2.0  # whatever rounding left
        # Log-probability of the other edges of an edge's node; of the likeliest by their sum, as 1 - q has no digits left near 1.
        with np.errstate(divide="ignore"):
            self.rest = np.log1p(-q)
        other = self.log_q.copy()
        other[head] = NEVER
        if len(head):
            self.rest[head] = np.logaddexp.reduceat(other, head)

    def without(self, edges: tuple[int, ...]) -> float:
        """Log-probability of all edges of a node but the given ones."""
        a = self.a[edges[0]]
        left = [e for e in range(int(self.first[a]), int(self.first[a + 1])) if e not in edges]
        return float(np.logaddexp.reduce(self.log_q[left])) if left else NEVER

    def walk(self, node: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges from each given node to the end of its chunk, drawn by q: (flat edges, number for each walk)."""
        n = len(node)
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        live = np.flatnonzero(~self.last[node])
        cur, key, step = node[live], seed[live], 0
        count = np.zeros(n, np.int64)
        while len(live):
            u = (mix(key + U64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> U64(11)).astype(np.float64) * 2.0**-53
            e = self.first[cur]
            more = np.flatnonzero(self.upto[e] <= u)
            while len(more):
                e[more] += 1
                more = more[self.upto[e[more]] <= u[more]]
            taken.append((live, e))
            cur = self.b[e]
            going = ~self.last[cur]
            count[live] += 1
            live, cur, key = live[going], cur[going], key[going]
            step += 1
        offset = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int64)
        for t, (who, e) in enumerate(taken):
            out[offset[who] + t] = e
        return out, count

    def ids(self, p: Pieces, paths: list[np.ndarray]) -> list[np.ndarray]:
        """Piece ids along the edges of each path; a spelled character gives the ids of its bytes."""
        edges = np.concatenate(paths)
        ends = np.cumsum([len(x) for x in paths])
        ids = self.id[edges]
        bare = np.flatnonzero(ids < 0)
        if len(bare):
            more = self.b[edges[bare]] - self.a[edges[bare]]
            n = np.ones(len(ids), np.int64)
            n[bare] = more
            total = np.cumsum(n)
            ids = np.repeat(ids, n)
            ids[ranges(total[bare] - more, more)] = p.byte_id[self.text[ranges(self.a[edges[bare]], more)]]
            ends = total[ends - 1]
        return np.split(ids, ends[:-1])


def _uniform(seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    return ((mix(seed + place.astype(U64) * U64(0xD6E8FEB86659FD93)) >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _truncated(mass: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables of the log-masses, below `top`."""
    with np.errstate(divide="ignore"):
        return -np.logaddexp(-top, np.log(-np.log(u)) - mass)


def _best_splits(log_q: np.ndarray, rest: np.ndarray, before: np.ndarray, top: np.ndarray, seed: np.ndarray, first: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """For each row, the k best sets that leave its sample: (perturbed score, number of the edge left).

    log_q: of the sample's edges; rest: log of what the sets at each edge keep of the
    node's mass; before: log-mass before the first of these edges.
    """
    size = np.diff(first)
    rows = len(size)
    run = np.cumsum(log_q)
    some = np.flatnonzero(size)
    out: list[list[tuple[float, int]]] = [[] for _ in range(rows)]
    if not len(some):
        return out
    base = np.zeros(rows)
    base[some] = run[first[:-1][some]] - log_q[first[:-1][some]]
    row = np.repeat(np.arange(rows), size)
    mass = run - log_q - base[row] + before[row] + rest
    peak = np.full(rows, NEVER)
    peak[some] = np.maximum.reduceat(mass, first[:-1][some])
    near = np.zeros(rows, np.int64)
    near[some] = np.add.reduceat(mass > peak[row] - NEAR, first[:-1][some], dtype=np.int64)
    at = np.flatnonzero((mass > NEVER) & (mass > np.where(near >= k, peak - NEAR - SPREAD, NEVER)[row]))
    row, mass = row[at], mass[at]
    nth = at - first[row]
    g = _truncated(mass, top[row], _uniform(seed[row], nth))
    for _ in range(k):
        if not len(row):
            break
        cut = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        best = np.maximum.reduceat(g, cut)
        hit = np.flatnonzero(g == np.repeat(best, np.diff(np.append(cut, len(row)))))
        hit = hit[np.searchsorted(hit, cut)]
        for r, x, j in zip(row[hit].tolist(), g[hit].tolist(), nth[hit].tolist(), strict=True):
            out[r].append((x, j))
        keep = np.ones(len(row), bool)
        keep[hit] = False
        row, g, nth = row[keep], g[keep], nth[keep]
    return out


def sample_batch(p: Pieces, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, k: int) -> Iterator[list[tuple[np.ndarray, float, float, float]]]:
    """For each row of texts, its samples: (piece ids, log-probability, perturbed score, inclusion score).

    data, offsets: texts with a space put before each but the empty ones. keys: a 64-bit number for each row.
    """
    rows = len(offsets) - 1
    n = len(data)
    new = np.zeros(n + 1, bool)
    new[offsets] = True
    if n:
        new[1:-1] |= ((data[1:] & 0xC0) != 0x80) & ~p.inside[data[:-1], data[1:]]
    start = np.flatnonzero(new[:-1])
    end = np.append(start[1:], n) if len(start) else start
    chunk_of = np.searchsorted(start, offsets)  # first chunk of each row
    lattice = Lattice(p, data, start, end) if n else None
    seeds = [mix(keys + U64((r + 1) * 0xA0761D6478BD642F & (1 << 64) - 1)) for r in range(k + 1)]
    top = -np.log(-np.log(_uniform(seeds[0], np.zeros(rows, np.int64))))  # of all segmentations: mass 1
    paths: list[list[np.ndarray]] = [[] for _ in range(rows)]
    found: list[list[tuple[float, float]]] = [[] for _ in range(rows)]  # (log-probability, perturbed score)
    queue: list[list[tuple[float, int, int, tuple[int, ...]]]] = [[] for _ in range(rows)]  # (score, sample, edge, excluded)
    active = np.arange(rows)
    head: list[np.ndarray] = [np.zeros(0, np.int64)] * rows  # edges fixed for the next sample
    out_of: list[tuple[int, ...]] = [()] * rows  # edges excluded where it becomes free
    resume = np.full(rows, -1)  # node to go on from inside a chunk, or -1
    fresh = chunk_of[:-1].copy()  # first chunk drawn anew
    bound = top.copy()
    for r in range(k):
        if not len(active) or lattice is None:
            break
        partial = active[resume[active] >= 0]
        spans = chunk_of[active + 1] - fresh[active]
        chunks = ranges(fresh[active], spans)
        owner = np.concatenate([partial, np.repeat(active, spans)])
        node = np.concatenate([resume[partial], lattice.node[lattice.of[chunks]]])
        place = np.concatenate([np.full(len(partial), -1), chunks - chunk_of[np.repeat(active, spans)]])
        flat, count = lattice.walk(node, mix(seeds[r][owner] + (place + 2).astype(U64) * U64(0xE7037ED1A0B428DB)))
        offset = np.cumsum(count) - count
        pieces_of: dict[int, list[np.ndarray]] = {}
        for i, row in enumerate(partial.tolist()):
            pieces_of[row] = [flat[offset[i] : offset[i] + count[i]]]
        at = len(partial)
        for row, m in zip(active.tolist(), spans.tolist(), strict=True):
            if m:
                pieces_of.setdefault(row, []).append(flat[offset[at] : offset[at + m - 1] + count[at + m - 1]])
            at += m
        parts, rest_first = [], []
        for row in active.tolist():
            path = np.concatenate([head[row], *pieces_of.get(row, [])])
            paths[row].append(path)
            free = max(len(head[row]) - 1, 0) if r else 0  # the set's own edge may be split again
            parts.append(path[free:])
            rest_first.append((free, float(lattice.log_q[path[:free]].sum())))
        size = np.array([len(x) for x in parts])
        edges = np.concatenate(parts)
        log_q = lattice.log_q[edges]
        rest = lattice.rest[edges]
        first = np.concatenate([[0], np.cumsum(size)])
        for i, row in enumerate(active.tolist()):
            if out_of[row] and size[i]:
                rest[first[i]] = lattice.without((*out_of[row], int(edges[first[i]])))
        before = np.array([x for _, x in rest_first])
        total = np.concatenate([[0], np.cumsum(log_q)])
        splits = _best_splits(log_q, rest, before, bound[active], mix(seeds[r][active] + U64(0x8EBC6AF09C88C6E3)), first, k - r)
        going = []
        for i, row in enumerate(active.tolist()):
            free = rest_first[i][0]
            found[row].append((before[i] + float(total[first[i + 1]] - total[first[i]]), float(bound[row])))
            for g, j in splits[i]:
                edge = int(edges[first[i] + j])
                queue[row].append((g, r, free + j, ((*out_of[row], edge) if j == 0 else (edge,))))
            if not queue[row] or r == k - 1:
                continue
            best = max(queue[row])
            queue[row].remove(best)
            g, s, j, excluded = best
            base = paths[row][s]
            node_at = int(lattice.a[excluded[-1]])
            options = [e for e in range(int(lattice.first[node_at]), int(lattice.first[node_at + 1])) if e not in excluded]
            if not options:
                continue
            weight = np.cumsum(np.exp(lattice.log_q[options] - lattice.log_q[options].max()))
            u = float(_uniform(seeds[r + 1][row : row + 1] + U64(1), np.array([j]))[0]) * weight[-1]
            edge = options[min(int(np.searchsorted(weight, u, "right")), len(options) - 1)]
            head[row] = np.append(base[:j], edge)
            out_of[row] = excluded
            to = int(lattice.b[edge])
            # The chunk that the edge lies in: chunks before it are whole in the fixed edges.
            done = int(np.count_nonzero(lattice.last[lattice.b[base[:j]]]))
            resume[row] = -1 if lattice.last[to] else to
            fresh[row] = chunk_of[row] + done + 1
            bound[row] = g
            going.append(row)
        active = np.array(going, np.int64)
    walked = [x for row in range(rows) if chunk_of[row + 1] > chunk_of[row] for x in paths[row]]
    spelled = iter(lattice.ids(p, walked) if walked else ())
    for row in range(rows):
        if lattice is None or chunk_of[row + 1] == chunk_of[row]:
            yield [(np.zeros(0, np.int32), 0.0, float(top[row]), 1.0)]
            continue
        line = max((x[0] for x in queue[row]), default=NEVER)
        yield [(next(spelled), lp, g, 1.0 if line == NEVER else float(-np.expm1(-np.exp(min(lp - line, 700.0))))) for lp, g in found[row]]


def _batches(batches: Iterator[pa.RecordBatch], path: str, k: int, slice_bytes: int):
    p = Pieces.load(path)
    for batch in batches:
        text = pc.fill_null(batch.column(2), "")
        spaced = pc.if_else(pc.equal(pc.binary_length(text), 0), "", pc.binary_join_element_wise("", text, " "))
        data, offsets = buffers(spaced)
        keys = batch.column(1).to_numpy(zero_copy_only=False).view(U64)
        for a, b in byte_slices(offsets, slice_bytes):
            part = data[offsets[a] : offsets[b]]
            off = offsets[a : b + 1] - offsets[a]
            yield p, batch.column(0).slice(a, b - a), part, off, sample_batch(p, part, off, keys[a:b], k)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col), F.xxhash64(F.col(id_col).cast("string")).alias("__wl_key"), F.col(text_col).alias("__wl_text"))


def segmentations(docs: DataFrame, model_path: str, k: int = 2, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 1 << 19) -> DataFrame:
    """(id, rank, ids, log_prob, perturbed, inclusion): up to k distinct segmentations of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, names, _, _, found in _batches(batches, model_path, k, slice_bytes):
            cols: list[list] = [[], [], [], [], [], []]
            for i, samples in enumerate(found):
                for rank, (ids, *scores) in enumerate(samples, 1):
                    for c, v in zip(cols, (i, rank, ids, *scores), strict=True):
                        c.append(v)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in cols[2]])]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *cols[2]]), pa.int32()))
            yield pa.RecordBatch.from_arrays([names.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), lists, *(pa.array(c, pa.float64()) for c in cols[3:])], names=[id_col, "rank", "ids", "log_prob", "perturbed", "inclusion"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _source(docs, id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {kind}, rank int, ids array<int>, log_prob double, perturbed double, inclusion double")


def digests(docs: DataFrame, model_path: str, k: int = 2, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 1 << 19) -> DataFrame:
    """As `segmentations`, with n_pieces, a digest of the ids and whether they decode to the text in place of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, names, data, off, found in _batches(batches, model_path, k, slice_bytes):
            cols: list[list] = [[] for _ in range(8)]
            for i, samples in enumerate(found):
                text = data[off[i] : off[i + 1]].tobytes()[1:]
                for rank, (ids, *scores) in enumerate(samples, 1):
                    digest = hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()
                    for c, v in zip(cols, (i, rank, len(ids), digest, p.decode(ids) == text, *scores), strict=True):
                        c.append(v)
            kinds = [pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(cols[0], pa.int64())), *(pa.array(c, t) for c, t in zip(cols[1:], kinds, strict=True))],
                names=[id_col, "rank", "n_pieces", "ids_sha256", "round_trip", "log_prob", "perturbed", "inclusion"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return _source(docs, id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {kind}, rank int, n_pieces bigint, ids_sha256 string, round_trip boolean, log_prob double, perturbed double, inclusion double")


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """(id, ids) of every text, as the library encodes it; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            ids = [model.encode(x or "") for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, out_col])

    kind = docs.schema[id_col].dataType.simpleString()
    return _source(docs, id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {kind}, `{out_col}` array<int>")


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """rows with the text that the ids spell; ids that spell no UTF-8 give replacement signs."""
    place = rows.columns.index(ids_col)
    rows_out = rows.drop(out_col)
    place = rows_out.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces.load(model_path)
        for batch in batches:
            text = [None if x is None else p.decode(np.array(x, np.int64)).decode("utf-8", "replace") for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=[*batch.schema.names, out_col])

    return rows_out.mapInArrow(lean(run), rows_out.withColumn(out_col, F.lit("")).schema)
