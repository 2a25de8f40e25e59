"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every word substring of all normalised test items. Training
words are streamed through it; at each word it gives the longest suffix of the
stream that occurs in an item. Where that length reaches the window, the words of
the window are hit, and the state's item set names the items holding it. An item
shorter than the window, but not empty, is a window of its own.

The stream is first thinned without loss: only words inside a window whose hash is
that of some item's window can be hit, and runs of such words go through the automaton.

A benchmark of at most `block_bytes` is one automaton, which is broadcast. A larger one
is dealt into blocks of about that size and never leaves the executors: what
is broadcast is a table of bits of the items' window hashes, of a fixed size. Texts are thinned by it, and only the
runs that are left, with the text's digest, are sent to every block's automaton, in parts of bounded
size; hits come back by the digest. Spans longer than `max_span` words, or all
spans of a text with more than `max_coverage` of its words hit, are decided upon in `clean`.

Edge cases: null and empty texts have no words and are clean; empty or null items
are ignored; an empty benchmark leaves all clean; repeated rows are each decided
alike; input columns named like an output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import checkpoint, lean, release, small_batches
from .textkit import U64, Words, _powers, buffers, byte_slices, mix, words

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SPANS, ITEMS, COUNT, BYTES = "hit_spans", "hit_items", "n_words", "hit_bytes"


def normalise(text: str | None) -> list[bytes]:
    """Words of a text after lower-casing A-Z."""
    return WORD.findall(re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[set[str]] = [set()]
        ends: list[list[int]] = []
        for name, toks in items:
            last = 0
            path = []
            for tok in toks:
                last = self._extend(last, tok, own)
                path.append(last)
            ends.append(path)
        # Item names of a state: of all prefixes that pass through it, gathered up the suffix links.
        self.names: list[frozenset[str]] = [frozenset()] * len(self.length)
        at: list[set[str]] = [set() for _ in self.length]
        for (name, _), path in zip(items, ends, strict=True):
            for state in path:
                at[state].add(name)
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True)
        for s in order:
            if self.link[s] > 0:
                at[self.link[s]] |= at[s]
        self.names = [frozenset(x) for x in at]
        # Windows: states by the length of the windows that end in them.
        self.marked: list[tuple[int, ...]] = [()] * len(self.length)
        for name, toks in items:
            if 0 < len(toks) < window:
                s = 0
                for tok in toks:
                    s = self.next[s][tok]
                if len(toks) not in self.marked[s]:
                    self.marked[s] = (*self.marked[s], len(toks))
        self.short = {(tuple(t)): set() for _, t in items if 0 < len(t) < window}
        for name, toks in items:
            if tuple(toks) in self.short:
                self.short[tuple(toks)].add(name)
        self.any_short = bool(self.short)

    def _extend(self, last: int, tok: bytes, own: list[set[str]]) -> int:
        nxt, link, length = self.next, self.link, self.length
        if tok in nxt[last]:
            q = nxt[last][tok]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, tok, q)
        cur = self._new(length[last] + 1, {})
        p = last
        while p >= 0 and tok not in nxt[p]:
            nxt[p][tok] = cur
            p = link[p]
        if p < 0:
            link[cur] = 0
        else:
            q = nxt[p][tok]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, tok, q)
        return cur

    def _new(self, length: int, edges: dict[bytes, int]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _clone(self, p: int, tok: bytes, q: int) -> int:
        c = self._new(self.length[p] + 1, dict(self.next[q]))
        self.link[c] = self.link[q]
        self.link[q] = c
        while p >= 0 and self.next[p].get(tok) == q:
            self.next[p][tok] = c
            p = self.link[p]
        return c

    def scan(self, toks: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Hit word ranges (merged), items with an occurring window, and the longest match."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        s, n, longest = 0, 0, 0
        spans: list[tuple[int, int]] = []
        found: set[str] = set()

        def hit(a: int, b: int) -> None:
            while spans and spans[-1][1] >= a:
                p, q = spans.pop()
                a, b = min(a, p), max(b, q)
            spans.append((a, b))

        for i, tok in enumerate(toks):
            while s and tok not in nxt[s]:
                s = link[s]
                n = length[s]
            if tok in nxt[s]:
                s, n = nxt[s][tok], n + 1
            longest = max(longest, n)
            if n >= window:
                # The state of the window itself: the longest suffix of that many words.
                t = s
                while length[link[t]] >= window:
                    t = link[t]
                found |= self.names[t]
                hit(i + 1 - n, i + 1)
            if self.any_short:
                t = s
                while t > 0:
                    for m in self.marked[t]:
                        if m <= n:
                            found |= self.short[tuple(toks[i + 1 - m : i + 1])]
                            hit(i + 1 - m, i + 1)
                    t = link[t]
        return spans, found, longest


class Windows:
    """Bits of the hashes of items' windows, by length, to thin a batch of words."""

    def __init__(self, bits: int):
        self.bits = bits
        self.seen: dict[int, np.ndarray] = {}

    @classmethod
    def of(cls, items: list[tuple[str, list[bytes]]], window: int, bits: int) -> Windows:
        out = cls(bits)
        for _, toks in items:
            if toks:
                data = np.frombuffer(b" ".join(toks), np.uint8)
                out.add(words(data, np.array([0, len(data)])), min(window, len(toks)))
        return out

    def add(self, w: Words, length: int) -> None:
        self.seen.setdefault(length, np.zeros(1 << self.bits, bool))[self.hashes(w, length)[0]] = True

    def hashes(self, w: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first word) of all windows of a length that lie in one row."""
        n = len(w.hash) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        power, inverse = _powers(len(w.hash) + 1)
        total = np.zeros(len(w.hash) + 1, U64)
        np.cumsum(w.hash * power[: len(w.hash)], out=total[1:])
        at = np.arange(n)
        at = at[np.repeat(w.first[1:], w.counts())[:n] - at >= length]
        return (mix((total[at + length] - total[at]) * inverse[at]) >> U64(64 - self.bits)).astype(np.int64), at

    def runs(self, w: Words) -> Iterator[tuple[int, int, int]]:
        """(row, first word, end word) of maximal runs of words inside windows that may be an item's."""
        cover = np.zeros(len(w.hash) + 1, np.int32)
        for length, seen in self.seen.items():
            h, at = self.hashes(w, length)
            at = at[seen[h]]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + length, -1)
        inside = np.cumsum(cover[:-1]) > 0
        if not inside.any():
            return
        new = np.ones(len(inside), bool)
        new[1:] = ~inside[:-1]
        new[w.first[w.first < len(inside)]] = True
        last = np.append(new[1:] | ~inside[1:], True)
        begin, end = np.flatnonzero(inside & new), np.flatnonzero(inside & last) + 1
        rows = np.searchsorted(w.first, begin, "right") - 1
        yield from zip(rows.tolist(), begin.tolist(), end.tolist(), strict=True)


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    block_bytes: int = 1 << 20,
    slice_bytes: int = 1 << 22,
) -> DataFrame:
    """docs with n_words, hit_spans (merged word ranges), hit_bytes (byte range of each span) and hit_items (sorted ids)."""
    small_batches(docs.sparkSession)
    docs = docs.drop(COUNT, SPANS, BYTES, ITEMS)
    own = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("t")).where("item is not null and t is not null").distinct()
    size = own.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if size > block_bytes:
        return _through_blocks(docs, own, text_col, window, -(-size // block_bytes), slice_bytes)
    block = [(r.item, normalise(r.t)) for r in own.orderBy("item", "t").collect()]
    schema = docs.withColumns({k: F.lit(None).cast(v) for k, v in KINDS.items()}).schema
    return docs.mapInArrow(lean(_scanner([x for x in block if x[1]], docs.columns.index(text_col), window, slice_bytes)), schema)


KINDS = {COUNT: "bigint", SPANS: "array<struct<a:int,b:int>>", BYTES: "array<struct<a:int,b:int>>", ITEMS: "array<string>"}
_SPAN = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
#: Of a whole benchmark that is one block, and of one of many blocks: bits of the table of windows, 2 MB a length at most.
BLOCK_BITS, TABLE_BITS = 18, 24


def _hits(data: np.ndarray, offsets: np.ndarray, w: Words, windows: Windows) -> Iterator[tuple[int, list[bytes], list[tuple[int, int, int]]]]:
    """(row, words, (number in the text, begin, end) of each) of the runs of a batch."""
    for row, i, j in windows.runs(w):
        first, base = int(w.first[row]), int(offsets[row])
        yield row, [w.text(x) for x in range(i, j)], [(x - first, int(w.start[x]) - base, int(w.end[x]) - base) for x in range(i, j)]


def _spans(sam: SuffixAutomaton, toks: list[bytes], places: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int, int]], set[str]]:
    """Hit ranges of words and of bytes, and the items concerned."""
    spans, found, _ = sam.scan(toks)
    return [(places[p][0], places[q - 1][0] + 1, places[p][1], places[q - 1][2]) for p, q in spans], found


def _columns(spans: list[list[tuple[int, int, int, int]]], found: list[list[str]]) -> list[pa.Array]:
    pairs = lambda k: pa.array([[{"a": x[k], "b": x[k + 1]} for x in row] for row in spans], _SPAN)
    return [pairs(0), pairs(2), pa.array(found, pa.list_(pa.string()))]


def _scanner(block: list, place: int, window: int, slice_bytes: int):
    """Arrow function: rows with their hits in the one block."""
    cache: dict[str, object] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not cache:
            cache["sam"], cache["windows"] = SuffixAutomaton(block, window), Windows.of(block, window, BLOCK_BITS)
        for batch in batches:
            data, offsets = buffers(batch.column(place))
            counts, spans, found = [], [[] for _ in range(len(batch))], [[] for _ in range(len(batch))]
            for a, b in byte_slices(offsets, slice_bytes):
                off = offsets[a : b + 1] - offsets[a]
                w = words(data[offsets[a] : offsets[b]], off)
                counts += w.counts().tolist()
                for row, toks, places in _hits(data, off, w, cache["windows"]):
                    here, names = _spans(cache["sam"], toks, places)
                    spans[a + row] = _merge(spans[a + row] + here)
                    found[a + row] = sorted({*found[a + row], *names})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64()), *_columns(spans, found)], names=[*batch.schema.names, *KINDS])

    return run


def window_table(items: DataFrame, window: int, bits: int = TABLE_BITS, parts: int = 64) -> Windows:
    """Bits of all items' windows, put together on the executors in parts; what reaches the driver has a fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Windows(bits)
        for batch in batches:
            for text in batch.column(1).to_pylist():
                own = normalise(text)
                for _ in own[:1]:
                    data = np.frombuffer(b" ".join(own), np.uint8)
                    out.add(words(data, np.array([0, len(data)])), min(window, len(own)))
        for length, seen in out.seen.items():
            packed = [np.packbits(x).tobytes() for x in np.split(seen, parts)]
            yield pa.RecordBatch.from_arrays([pa.array([length] * parts, pa.int32()), pa.array(range(parts), pa.int32()), pa.array(packed, pa.binary())], names=["length", "part", "seen"])

    def add(table: pa.Table) -> pa.Table:
        total = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table["seen"].to_pylist()])
        return pa.table({"length": table["length"][:1], "part": table["part"][:1], "seen": pa.array([total.tobytes()], pa.binary())})

    schema = "length int, part int, seen binary"
    out = Windows(bits)
    size = (1 << bits) // parts
    for r in items.select("item", "t").mapInArrow(lean(count), schema).groupBy("length", "part").applyInArrow(add, schema).collect():
        seen = out.seen.setdefault(r.length, np.zeros(1 << bits, bool))
        seen[r.part * size : (r.part + 1) * size] = np.unpackbits(np.frombuffer(r.seen, np.uint8)).astype(bool)
    return out


def _through_blocks(docs: DataFrame, items: DataFrame, text_col: str, window: int, blocks: int, slice_bytes: int, part_bytes: int = 1 << 25) -> DataFrame:
    """docs with their hits in a benchmark of many blocks."""
    shared = docs.sparkSession.sparkContext.broadcast(window_table(items, window))
    digest = F.sha2(F.col(text_col), 256)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            out: list[tuple] = []
            for a, b in byte_slices(offsets, slice_bytes):
                off = offsets[a : b + 1] - offsets[a]
                w = words(data[offsets[a] : offsets[b]], off)
                for row, toks, places in _hits(data, off, w, shared.value):
                    out.append((a + row, b" ".join(toks).decode("utf-8", "surrogateescape"), *zip(*places, strict=True)))
            rows, toks, nth, begin, end = zip(*out, strict=True) if out else ([],) * 5
            lists = [pa.array([list(x) for x in v], pa.list_(pa.int32())) for v in (nth, begin, end)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array([x.encode("utf-8", "surrogateescape") for x in toks], pa.binary()), *lists], names=["digest", "toks", "nth", "begin", "end"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(place))
            counts = [words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]).counts() for a, b in byte_slices(offsets, slice_bytes)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0, np.int64), *counts]), pa.int64())], names=[*batch.schema.names, COUNT])

    def scan(table: pa.Table, own: pa.Table) -> pa.Table:
        release()
        block = [(k, normalise(t)) for k, t in zip(own["item"].to_pylist(), own["t"].to_pylist(), strict=True)]
        sam, out = SuffixAutomaton([x for x in block if x[1]], window), []
        for r in table.to_pylist() if block else []:
            spans, found = _spans(sam, r["toks"].split(b" "), list(zip(r["nth"], r["begin"], r["end"], strict=True)))
            if spans:
                out.append((r["digest"], spans, sorted(found)))
        digests, spans, found = zip(*out, strict=True) if out else ([],) * 3
        return pa.table([pa.array(digests, pa.string()), *_columns(list(spans), list(found))], names=["digest", SPANS, BYTES, ITEMS])

    def join(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        spans = _merge([(x["a"], x["b"], y["a"], y["b"]) for r in rows for x, y in zip(r[SPANS], r[BYTES], strict=True)])
        return pa.table([table["digest"][:1], *_columns([spans], [sorted({k for r in rows for k in r[ITEMS]})])], names=["digest", SPANS, BYTES, ITEMS])

    kinds = "digest string, " + ", ".join(f"{k} {v}" for k, v in KINDS.items() if k != COUNT)
    source = docs.select(digest.alias("digest"), F.col(text_col).alias("t")).where("t is not null")
    runs = checkpoint(source.mapInArrow(lean(thin), "digest string, toks binary, nth array<int>, begin array<int>, end array<int>").dropDuplicates(["digest", "nth"]))
    parts = max(1, -(-(runs.agg(F.sum(F.octet_length("toks"))).first()[0] or 0) // part_bytes))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = runs.withColumn("part", F.pmod(F.xxhash64("digest", "nth"), F.lit(parts)).cast("int")).select("*", every(blocks).alias("block"))
    owned = items.withColumn("block", F.pmod(F.xxhash64("item", "t"), F.lit(blocks)).cast("int")).select("*", every(parts).alias("part"))
    hits = dealt.groupBy("block", "part").cogroup(owned.groupBy("block", "part")).applyInArrow(scan, kinds).groupBy("digest").applyInArrow(join, kinds)
    place = docs.columns.index(text_col)
    counted = docs.mapInArrow(lean(count), docs.withColumn(COUNT, F.lit(None).cast("bigint")).schema)
    hits = checkpoint(hits).withColumnRenamed("digest", "__wl_digest")
    out = counted.withColumn("__wl_digest", digest).join(hits, "__wl_digest", "left")
    return out.select(*docs.columns, COUNT, *(F.coalesce(k, F.array().cast(v)).alias(k) for k, v in KINDS.items() if k != COUNT))


def _merge(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    out: list[tuple[int, int, int, int]] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            p = out.pop()
            s = (p[0], max(p[1], s[1]), p[2], max(p[3], s[3]))
        out.append(s)
    return out


def n_hit() -> Column:
    """Words inside any hit span."""
    return F.aggregate(F.col(SPANS), F.lit(0).cast("bigint"), lambda s, x: s + (x["b"] - x["a"]))


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", max_span: int = 0, max_coverage: float = 0.5, **options) -> DataFrame:
    """Rows with their hit spans removed from the text.

    Spans of more than `max_span` words go; a row with more than `max_coverage` of
    its words hit goes whole. A row without hits is returned unchanged.
    """
    hits = find_hits(docs, items, text_col, **options)
    kept = hits.where(F.coalesce(n_hit() <= max_coverage * F.col(COUNT), F.lit(True)))
    raw = F.encode(F.col(text_col), "UTF-8")
    long = F.filter(F.arrays_zip(F.col(SPANS).alias("w"), F.col(BYTES).alias("y")), lambda x: x["w"]["b"] - x["w"]["a"] > max_span)
    # Text between consecutive spans: each ends where the next span begins.
    cuts = F.concat(F.array(F.lit(0)), F.transform(long, lambda x: x["y"]["b"]))
    ends = F.concat(F.transform(long, lambda x: x["y"]["a"]), F.array(F.octet_length(F.col(text_col))))
    parts = F.zip_with(cuts, ends, lambda a, b: F.decode(F.substring(raw, a + 1, b - a), "UTF-8"))
    text = F.when(F.size(long) > 0, F.array_join(parts, "")).otherwise(F.col(text_col))
    return kept.withColumn(text_col, text).select(*docs.columns)
