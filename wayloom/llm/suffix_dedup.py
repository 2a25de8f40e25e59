"""Exact substring dedup across documents by suffix arrays of shards.

A byte goes if a string of `width` bytes that covers it also starts in a document
with a smaller id. All are judged on the input.

1. Documents are dealt into slices by a hash of the id and the text. In a slice every
   window of `width` bytes gets an anchor, the least hashed GRAM-byte string inside it.
   Equal windows have equal anchors, wherever they occur. Neighbouring windows with the
   same anchor make a segment. A slice asks the bucket of each of its anchors, with the
   least and greatest id that has it, whether several documents have it. The others end here: this
   is all that the hashes decide, and one that collides only sends more.
2. A slice sends the bytes of its distinct segments around shared anchors to the shards
   of the anchors. A shard finds equal segments by their bytes, and makes a suffix array
   of the distinct ones by induced sorting (`suffix_array`): neighbours in it with a common
   prefix of `width` bytes or more hold equal windows, and the least id among them owns these.
3. Back in its slice, each document compares the owners of its windows with its own id.

Slices, buckets and shards grow with the root of the input; a shard's segments are
sorted in suffix arrays of about ARRAY bytes, between which no anchor is split.
An anchor that over `hot_rows` slices have is sharded by whole windows, so that no shard
grows with the different texts around it. Beyond `fan` slices, buckets and shards are
asked through groups of that many slices, which send on what is distinct among them and
deal out the answers; so a passage that all slices hold reaches its shard once from each
group. The text is shuffled once (all three uses read the same exchange). Anchors of a text are found
CHUNK bytes at a time; a single text longer than `slice_bytes` makes a longer slice.

Edge cases: null and empty texts keep all; rows without an id keep all and own nothing;
rows with equal ids don't remove from each other; texts shorter than `width` keep all;
extra columns are ignored by `spans` and kept by `dedupe`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import release
from .suffix_array import earliest_windows
from .textkit import U64, buffers, eights, ranges

GRAM = 16
#: Small enough for a core's caches: at 1 MB and 4 MB both steps took twice as long a byte.
CHUNK = 1 << 16
ARRAY = 1 << 19
#: Slices have SLICE bytes for up to a gigabyte, then as many more as the root of the input grows, up to SLICE_MOST.
SLICE, SLICE_MOST = 1 << 20, 1 << 25
_ORDER = U64(0xFFFFFFFF00000000)
_FACTORS = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)]
SHARED, HOT = 1, 2
FAR = np.iinfo(np.int64).max


def _anchors(data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Position of the anchor of each window, and the hash of the GRAM bytes at each position."""
    eight = eights(data)
    n = len(data) - GRAM + 1
    gram = eight[:n] * _FACTORS[0]
    gram += eight[8 : n + 8] * _FACTORS[1]
    gram ^= gram >> U64(32)
    gram *= _FACTORS[2]
    low = gram & _ORDER  # of equal hashes the leftmost
    low |= np.arange(n, dtype=U64)
    span, reach = width - GRAM + 1, 1
    while reach * 2 <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if span > reach:
        low = np.minimum(low[: len(low) - (span - reach)], low[span - reach :])
    return low.astype(np.uint32), gram


class Runs:
    """Segments of a slice: first window, number of windows, row, and the anchor's position and hash, of which the top `bits` bits are kept."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, bits: int = 64):
        self.data, self.offsets, self.width = data, offsets, width
        windows = len(data) - width + 1
        # A segment begins where the anchor changes, where a row begins, and where a row's last window was.
        marks = np.unique(np.concatenate([offsets[:-1], np.maximum(offsets[1:] - width + 1, offsets[:-1])]))
        empty = np.zeros(0, np.int64)
        first, at, anchor = [empty], [empty], [np.zeros(0, U64)]
        for a in range(0, max(windows, 0), CHUNK):
            b = min(a + CHUNK, windows)
            where, gram = _anchors(data[a : b + width - 1], width)
            new = np.empty(b - a, bool)
            new[0], new[1:] = True, where[1:] != where[:-1]
            new[marks[np.searchsorted(marks, a) : np.searchsorted(marks, b)] - a] = True
            begin = np.flatnonzero(new)
            place = where[begin].astype(np.int64)
            first.append(begin + a)
            at.append(place + a)
            anchor.append(gram[place] >> U64(64 - bits))
        begin = np.concatenate(first)
        count = np.diff(np.append(begin, max(windows, 0)))
        row = np.searchsorted(offsets, begin, "right") - 1
        inside = begin + width <= offsets[row + 1]
        self.first, self.count, self.row = begin[inside], count[inside], row[inside]
        self.at, self.anchor = np.concatenate(at)[inside], np.concatenate(anchor)[inside]

    def ends(self) -> np.ndarray:
        return self.first + self.count + self.width - 1


def _slice(table: pa.Table, width: int, bits: int) -> tuple[pa.Table, Runs, np.ndarray, np.ndarray]:
    """The rows of a slice in a fixed order, their runs, ids, and whether each has an id."""
    release()
    table = table.sort_by([("id", "ascending"), ("t", "ascending")]).combine_chunks()
    data, offsets = buffers(table["t"])
    return table, Runs(data, offsets, width, bits), table["id"].fill_null(0).to_numpy(), table["id"].is_valid().to_numpy()


def anchor_bits(size: int) -> int:
    """Bits of an anchor's hash for so many bytes: some thousand values for each segment."""
    return min(56, max(32, (size // 16 + 1).bit_length() + 10))


def pack(x: np.ndarray) -> bytes:
    """Integers as their number, their least one, and byte planes of what exceeds it."""
    if not len(x):
        return b""
    least = int(x.min())
    rest = x.astype(np.int64).view(U64) - U64(least % (1 << 64))
    width = (int(rest.max()).bit_length() + 7) // 8
    planes = rest.view(np.uint8).reshape(-1, 8)[:, :width].T
    return len(x).to_bytes(4, "little") + least.to_bytes(8, "little", signed=True) + bytes([width]) + planes.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    """The integers of `pack`."""
    if not raw:
        return np.zeros(0, np.int64)
    n, least, width = int.from_bytes(raw[:4], "little"), int.from_bytes(raw[4:12], "little", signed=True), raw[12]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, offset=13).reshape(width, n).T
    return (out.view(U64).ravel() + U64(least % (1 << 64))).view(np.int64)


def _packets(groups: np.ndarray, columns: dict[str, np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], dict[str, list[bytes]]]:
    """(group, its members, packed columns) for each value of groups, rising."""
    order = np.argsort(groups, kind="stable")
    own, cut = np.unique(groups[order], return_index=True)
    members = np.split(order, cut[1:]) if len(own) else []
    return own, members, {k: [pack(v[m]) for m in members] for k, v in columns.items()}


def _open(table: pa.Table, *names: str) -> list[np.ndarray]:
    """Unpacked columns of packets, and last the number of the packet of each entry."""
    parts = {k: [unpack(x) for x in table[k].to_pylist()] for k in names}
    sizes = [len(x) for x in parts[names[0]]]
    return [np.concatenate([np.zeros(0, np.int64), *parts[k]]) for k in names] + [np.repeat(np.arange(len(sizes)), sizes)]


def _table(numbers: dict[str, np.ndarray | list], **raw: list[bytes]) -> pa.Table:
    return pa.table({k: pa.array(v, pa.int64()) for k, v in numbers.items()} | {k: pa.array(v, pa.binary()) for k, v in raw.items()})


def _schema(*numbers: str, raw: tuple[str, ...]) -> str:
    return ", ".join([*(f"{k} bigint" for k in numbers), *(f"{k} binary" for k in raw)])


#: Packets between slices and buckets (of anchors) or shards (of segments), and their answers.
ASK = ("anchor", "low", "more", "many")
SEND = ("run", "nth", "at", "low", "more", "size", "blob")
ANSWER = ("run", "nth", "size", "own")


def own_anchors(runs: Runs, ids: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, least id, greatest id) of a slice's distinct anchors in rows with an id, rising."""
    use = np.flatnonzero(known[runs.row])
    anchor, own = runs.anchor[use], ids[runs.row[use]]
    order = np.argsort(anchor)
    anchor, own = anchor[order], own[order]
    begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
    if not len(begin):
        return anchor, own, own
    return anchor[begin], np.minimum.reduceat(own, begin), np.maximum.reduceat(own, begin)


class Meeting:
    """The distinct anchors of several packets: least and greatest id, and how many slices have each."""

    def __init__(self, table: pa.Table):
        self.table = table.sort_by("slice").combine_chunks()
        step, low, more, many, self.packet = _open(self.table, *ASK)
        begin = np.flatnonzero(np.concatenate([[True], self.packet[1:] != self.packet[:-1]])) if len(step) else np.zeros(0, np.int64)
        total = np.cumsum(step)
        anchor = total - np.repeat((total - step)[begin], np.diff(np.append(begin, len(step))))
        self.anchor, self.number = np.unique(anchor, return_inverse=True)
        self.low, self.high, self.many = np.full(len(self.anchor), FAR), np.full(len(self.anchor), -FAR - 1), np.zeros(len(self.anchor), np.int64)
        np.minimum.at(self.low, self.number, low)
        np.maximum.at(self.high, self.number, low + more)
        np.add.at(self.many, self.number, many)

    def merged(self) -> list[bytes]:
        return [pack(x) for x in (np.diff(self.anchor, prepend=0), self.low, self.high - self.low, self.many)]

    def state(self, hot_rows: int) -> np.ndarray:
        return np.where(self.low < self.high, np.where(self.many > hot_rows, HOT, SHARED), 0)

    def answers(self, state: np.ndarray, **fixed: int) -> pa.Table:
        """The state of each packet's anchors, for the slice that asked."""
        bounds = np.searchsorted(self.packet, np.arange(len(self.table) + 1))
        raw = [pack(state[self.number[a:b]]) for a, b in zip(bounds, bounds[1:], strict=False)]
        own = self.table["slice"].to_numpy()
        return _table({"slice": own} | {k: np.full(len(own), v) for k, v in fixed.items()}, state=raw)


class Shard:
    """The distinct segments of several packets, by their bytes, with the least and greatest id that has each."""

    def __init__(self, table: pa.Table):
        self.table = table.sort_by("slice").combine_chunks()
        self.run, self.nth, at, low, more, size, self.packet = _open(self.table, *SEND[:-1])
        blob = b"".join(self.table["blob"].to_pylist())
        ends = np.cumsum(size)
        numbers: dict[bytes, int] = {}
        self.number = np.array([numbers.setdefault(blob[a:b], len(numbers)) for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True)], np.int64)
        self.segments = list(numbers)
        self.entry_high = low + more
        many = len(self.segments)
        self.low, self.high = np.full(many, FAR), np.full(many, -FAR - 1)
        np.minimum.at(self.low, self.number, low)
        np.maximum.at(self.high, self.number, self.entry_high)
        self.at, self.piece = np.zeros(many, np.int64), np.zeros(many, bool)
        self.at[self.number], self.piece[self.number] = at, self.nth > 0

    def merged(self) -> tuple[list[bytes], bytes]:
        """One packet of what is distinct; a segment is known by its number here."""
        size = np.array([len(x) for x in self.segments], np.int64)
        columns = (np.arange(len(size)), self.piece.astype(np.int64), self.at, self.low, self.high - self.low, size)
        return [pack(x) for x in columns], b"".join(self.segments)

    def owners(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, owners): of each segment the owner of each window, or one owner of all, in a flat array."""
        grams = [x[a : a + GRAM] for x, a in zip(self.segments, self.at.tolist(), strict=True)]
        # A window of a hot anchor is the same as its equals only, which are one piece here.
        whole = sorted(np.flatnonzero(~self.piece).tolist(), key=grams.__getitem__)
        size, start = np.ones(len(grams), np.int64), np.arange(len(grams))
        flat, used = [self.low], len(grams)
        for part in self._arrays(whole, grams):
            own, many = earliest_windows([self.segments[k] for k in part], self.low[part], width)
            begin = np.cumsum(many) - many
            one = np.minimum.reduceat(own, begin) == np.maximum.reduceat(own, begin)
            size[part], start[part] = np.where(one, 1, many), used + begin
            flat.append(own)
            used += len(own)
        return start, size, np.concatenate(flat)

    def _arrays(self, whole: list[int], grams: list[bytes]) -> Iterator[list[int]]:
        """Segments in parts of about ARRAY bytes, each a suffix array: those of one anchor stay together, others share no window."""
        part: list[int] = []
        held = 0
        for k in whole:
            if held > ARRAY and grams[k] != grams[part[-1]]:
                yield part
                part, held = [], 0
            part.append(k)
            held += len(self.segments[k])
        if part:
            yield part

    def answers(self, start: np.ndarray, size: np.ndarray, own: np.ndarray, **fixed: int) -> pa.Table:
        """For each packet the owners of its segments, where a document with a later id has one."""
        nth = ranges(start, size)
        least = np.minimum.reduceat(own[nth], np.cumsum(size) - size) if len(start) else start
        told = np.flatnonzero(least[self.number] < self.entry_high)
        number = self.number[told]
        slices = self.table["slice"].to_numpy()[self.packet[told]]
        to, _, raw = _packets(slices, {"run": self.run[told], "nth": self.nth[told], "size": size[number]})
        _, _, values = _packets(np.repeat(slices, size[number]), {"own": own[ranges(start[number], size[number])]})
        return _table({"slice": to} | {k: np.full(len(to), v) for k, v in fixed.items()}, **raw, **values)


def _through(asked: DataFrame, key: str, salts: int, meet, decide, split, packet: str, answer: str) -> DataFrame:
    """Answers to packets (slice, key, ...) from the groups of the key, beyond one salt through groups of slices.

    decide: from all packets of a key to answers (slice, key, ...). meet: from those of a
    group of slices to one packet in their name. split: from both to the slices' answers.
    """
    if salts == 1:
        return asked.groupBy(key).applyInArrow(decide, answer)
    salted = asked.withColumn("salt", F.pmod("slice", F.lit(salts)))
    merged = salted.groupBy(key, "salt").applyInArrow(meet, packet)
    told = merged.groupBy(key).applyInArrow(decide, answer).withColumnRenamed("slice", "salt")
    return salted.groupBy(key, "salt").cogroup(told.groupBy(key, "salt")).applyInArrow(split, answer)


def fitting_slice(size: int) -> int:
    """Bytes of a slice for so many of all: as every slice writes to every bucket, both their number and their size grow."""
    return int(min(SLICE_MOST, SLICE * max(1.0, (size / 1e9) ** 0.5)))


def owners(docs: DataFrame, width: int, slice_bytes: int | None, hot_rows: int, fan: int, bits: int | None) -> tuple[DataFrame, DataFrame, int]:
    """(dealt, found, bits): rows (id, t, slice), and for each slice the owners of its segments that a smaller id may own.

    found: slice, and packed: run, nth, size, own: the owners of the windows of the segment
    that run first has (one for all if size is 1), or of its window nth, counted from 1, alone.
    """
    if width < 2 * GRAM:
        raise ValueError(f"width must be {2 * GRAM} at least")
    if docs.schema["id"].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("the id must be an integer")
    size = docs.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    slice_bytes = slice_bytes or fitting_slice(size)
    slices, shards = max(1, -(-size // slice_bytes)), max(64, -(-size // (4 * slice_bytes)))
    bits, buckets, salts = bits or anchor_bits(size), max(64, -(-size // (6 * slice_bytes))), -(-slices // fan)
    dealt = docs.withColumn("slice", F.pmod(F.xxhash64("id", "t"), F.lit(slices)))

    def name(table: pa.Table) -> int:
        return table["slice"][0].as_py()

    def ask(table: pa.Table) -> pa.Table:
        number = name(table)
        _, runs, ids, known = _slice(table, width, bits)
        anchor, low, high = own_anchors(runs, ids, known)
        group, members, raw = _packets((anchor % U64(buckets)).astype(np.int64), {"low": low, "more": high - low, "many": np.ones(len(low), np.int64)})
        steps = [pack(np.diff((anchor[m] // U64(buckets)).astype(np.int64), prepend=0)) for m in members]
        return _table({"slice": np.full(len(group), number), "bucket": group}, anchor=steps, **raw)

    asked = dealt.groupBy("slice").applyInArrow(ask, _schema("slice", "bucket", raw=ASK))

    def meet_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        raw = Meeting(table).merged()
        return _table({"slice": [key[1].as_py()], "bucket": [key[0].as_py()]}, **{k: [v] for k, v in zip(ASK, raw, strict=True)})

    def decide_anchors(table: pa.Table) -> pa.Table:
        m = Meeting(table)
        return m.answers(m.state(hot_rows), bucket=table["bucket"][0].as_py())

    def split_anchors(key, table: pa.Table, told: pa.Table) -> pa.Table:
        return Meeting(table).answers(unpack(told["state"][0].as_py()), bucket=key[0].as_py())

    heard = _through(asked, "bucket", salts, meet_anchors, decide_anchors, split_anchors, _schema("slice", "bucket", raw=ASK), _schema("slice", "bucket", raw=("state",)))

    def send(key, table: pa.Table, heard: pa.Table) -> pa.Table:
        """Bytes of the distinct segments of shared anchors, or of their windows around a hot one, to the shards that decide them."""
        columns: dict[str, np.ndarray] = {k: np.zeros(0, np.int64) for k in SEND[:-1]}
        shard, pieces = np.zeros(0, np.int64), []
        if len(table) and len(heard):
            _, runs, ids, known = _slice(table, width, bits)
            anchor, _, _ = own_anchors(runs, ids, known)
            _, members, _ = _packets((anchor % U64(buckets)).astype(np.int64), {})
            state = np.zeros(len(anchor), np.int64)
            state[np.concatenate(members)] = _open(heard.sort_by("bucket"), "state")[0]
            shared, state = anchor[state > 0], state[state > 0]
            pos = np.minimum(np.searchsorted(shared, runs.anchor), max(len(shared) - 1, 0))
            own = np.flatnonzero((shared[pos] == runs.anchor) & known[runs.row]) if len(shared) else np.zeros(0, np.int64)
            raw = runs.data.tobytes()
            numbers: dict[bytes, int] = {}
            number = np.array([numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(runs.first[own].tolist(), runs.ends()[own].tolist(), strict=True)], np.int64)
            _, one = np.unique(number, return_index=True)
            low, high = np.full(len(one), FAR), np.full(len(one), -FAR - 1)
            np.minimum.at(low, number, ids[runs.row[own]])
            np.maximum.at(high, number, ids[runs.row[own]])
            run = own[one]
            hot = state[pos[run]] == HOT
            pieces = list(numbers)
            columns = {"run": run, "nth": np.zeros(len(run), np.int64), "at": runs.at[run] - runs.first[run], "low": low, "more": high - low, "size": runs.count[run] + width - 1}
            shard = (runs.anchor[run] % U64(shards)).astype(np.int64)
            if hot.any():
                more = [(k, n) for k in np.flatnonzero(hot).tolist() for n in range(1, int(runs.count[run[k]]) + 1)]
                of, nth = np.array([k for k, _ in more]), np.array([n for _, n in more])
                cut = [pieces[k][n - 1 : n - 1 + width] for k, n in more]
                dealt_to = np.array([int.from_bytes(hashlib.blake2b(x, digest_size=7).digest()) % shards for x in cut], np.int64)
                windows = {k: v[of] for k, v in columns.items()} | {"nth": nth, "at": columns["at"][of] - nth + 1, "size": np.full(len(nth), width)}
                keep = np.flatnonzero(~hot)
                pieces = [pieces[k] for k in keep.tolist()] + cut
                columns = {k: np.concatenate([v[keep], windows[k]]) for k, v in columns.items()}
                shard = np.concatenate([shard[keep], dealt_to])
        group, members, packed = _packets(shard, columns)
        blob = [b"".join(pieces[k] for k in m.tolist()) for m in members]
        return _table({"slice": np.full(len(group), key[0].as_py() or 0), "shard": group}, **packed, blob=blob)

    sent = dealt.groupBy("slice").cogroup(heard.groupBy("slice")).applyInArrow(send, _schema("slice", "shard", raw=SEND))

    def meet_segments(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        raw, blob = Shard(table).merged()
        return _table({"slice": [key[1].as_py()], "shard": [key[0].as_py()]}, **{k: [v] for k, v in zip(SEND, raw, strict=False)}, blob=[blob])

    def decide_segments(table: pa.Table) -> pa.Table:
        release()
        s = Shard(table)
        return s.answers(*s.owners(width), shard=table["shard"][0].as_py())

    def split_segments(key, table: pa.Table, told: pa.Table) -> pa.Table:
        s = Shard(table)
        # What no answer names is owned by no smaller id: its own least id does for it.
        lists = [s.low[k : k + 1] for k in range(len(s.segments))]
        if len(told):
            number, _, sizes, _ = _open(told, "run", "nth", "size")
            own, _ = _open(told, "own")
            for k, v in zip(number.tolist(), np.split(own, np.cumsum(sizes)[:-1]), strict=True):
                lists[k] = v
        size = np.array([len(x) for x in lists], np.int64)
        return s.answers(np.cumsum(size) - size, size, np.concatenate([np.zeros(0, np.int64), *lists]), shard=key[0].as_py())

    found = _through(sent, "shard", salts, meet_segments, decide_segments, split_segments, _schema("slice", "shard", raw=SEND), _schema("slice", "shard", raw=ANSWER))
    return dealt, found, bits


def removed(runs: Runs, ids: np.ndarray, known: np.ndarray, found: pa.Table) -> np.ndarray:
    """Whether each byte of a slice goes. found: answers, as packets (run, nth, size, own)."""
    n, width = len(runs.data), runs.width
    gone = np.zeros(n + 1, np.int32)
    if len(found) and len(runs.first):
        run, nth, size, _ = _open(found, "run", "nth", "size")
        own, _ = _open(found, "own")
        start = np.cumsum(size) - size
        raw, ends = runs.data.tobytes(), runs.ends()
        whole, part = np.flatnonzero(nth == 0), np.flatnonzero(nth > 0)
        # All runs with the anchor of an answered one whose bytes are the same.
        named = lambda which: np.flatnonzero(np.isin(runs.anchor, runs.anchor[run[which]]) & known[runs.row])
        by_bytes = {raw[a:b]: k for a, b, k in zip(runs.first[run[whole]].tolist(), ends[run[whole]].tolist(), whole.tolist(), strict=True)}
        like = named(whole)
        answer = np.array([by_bytes.get(raw[a:b], -1) for a, b in zip(runs.first[like].tolist(), ends[like].tolist(), strict=True)], np.int64)
        like, answer = like[answer >= 0], answer[answer >= 0]
        count = runs.count[like]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        owner = own[np.repeat(start[answer], count) + np.where(np.repeat(size[answer], count) == 1, 0, step)]
        hits = [(np.repeat(runs.first[like], count) + step)[owner < np.repeat(ids[runs.row[like]], count)]]
        if len(part):
            begin = runs.first[run[part]] + nth[part] - 1
            of_window = {raw[a : a + width]: v for a, v in zip(begin.tolist(), own[start[part]].tolist(), strict=True)}
            like = named(part)
            window = ranges(runs.first[like], runs.count[like])
            owner = np.array([of_window.get(raw[a : a + width], FAR) for a in window.tolist()], np.int64)
            hits.append(window[owner < np.repeat(ids[runs.row[like]], runs.count[like])])
        for hit in hits:
            np.add.at(gone, hit, 1)
            np.add.at(gone, hit + width, -1)
    return np.cumsum(gone, dtype=np.int32)[:-1] > 0


def _cut(docs: DataFrame, id_col: str, text_col: str, carry: list[str], width: int, slice_bytes: int | None, hot_rows: int, fan: int, bits: int | None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) and the carried columns, as c0, c1 and so on."""
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)))
    extra = [f"c{i}" for i in range(len(carry))]
    dealt, found, bits = owners(source, width, slice_bytes, hot_rows, fan, bits)

    def cut(key, table: pa.Table, told: pa.Table) -> pa.Table:
        table, runs, ids, known = _slice(table, width, bits)
        gone = removed(runs, ids, known, told)
        total = np.concatenate([[0], np.cumsum(gone, dtype=np.int32)])
        off = runs.offsets
        n_removed = total[off[1:]] - total[off[:-1]]
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = off[off < len(gone)]
        begins[inner] = gone[inner]
        at = np.concatenate([[0], np.cumsum(begins, dtype=np.int32)])
        kept = [runs.data[a:b][~gone[a:b]].tobytes() if r else runs.data[a:b].tobytes() for a, b, r in zip(off[:-1], off[1:], n_removed, strict=True)]
        own = {
            "id": table["id"],
            "n_bytes": pa.array(np.diff(off), pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(at[off[1:]] - at[off[:-1]], pa.int64()),
            "kept": pa.array(kept, pa.binary()),
        }
        return pa.table(own | {c: table[c] for c in extra})

    kinds = "".join(f", {c} {source.schema[c].dataType.simpleString()}" for c in extra)
    return dealt.groupBy("slice").cogroup(found.groupBy("slice")).applyInArrow(cut, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary" + kinds)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, slice_bytes: int | None = None, hot_rows: int = 20_000, fan: int = 2048, bits: int | None = None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every row; kept: the remaining bytes. bits: of the anchors' hashes, by the input's size if not given."""
    return _cut(docs, id_col, text_col, [], width, slice_bytes, hot_rows, fan, bits).withColumnRenamed("id", id_col)


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, slice_bytes: int | None = None, hot_rows: int = 20_000, fan: int = 2048, bits: int | None = None) -> DataFrame:
    """Rows with the remaining text, less bytes of characters that lost some; a row that lost all its text goes."""
    carry = [c for c in docs.columns if c not in (id_col, text_col)]
    out = _cut(docs, id_col, text_col, carry, width, slice_bytes, hot_rows, fan, bits).where("n_removed = 0 or n_removed < n_bytes")
    whole = F.try_validate_utf8(F.col("kept").cast("string"))
    text = F.coalesce(whole, F.make_valid_utf8(F.col("kept").cast("string")))
    back = {id_col: F.col("id"), text_col: text} | {c: F.col(f"c{i}") for i, c in enumerate(carry)}
    return out.select(*(back[c].alias(c) for c in docs.columns))
