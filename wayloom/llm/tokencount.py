"""Token counts: batch encoding inside Arrow functions, returning lengths only.

Rows are packed into slices of about `batch_bytes`, so a call costs the same
whatever mix of short and long texts it holds. The byte-level pre-tokenizer always
starts a new piece at white space behind a character that is none (only a piece's
first character can be white space, or all of them) and at a sign behind an ASCII letter
(no piece holds both in this order). Texts are cut there, and the
counts of the parts add up to the count of the whole, so the library encodes each
distinct part once and a worker keeps the counts of up to KNOWN short ones. Where added
tokens may hold such a place or take in white space, texts stay whole, but one over `split_bytes` is
cut before spaces that stand between two ASCII letters; under other pre-tokenizers
all stay whole.

Edge cases: null and empty texts have 0 bytes and 0 tokens; equal rows get equal
counts; an empty table gives an empty result. Input columns other than the id and
the text are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import lean, small_batches
from .textkit import byte_slices, buffers

SAFE = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
BLANK = np.zeros(256, bool)
BLANK[[0x09, 0x0A, 0x0D, 0x20]] = True
SIGNS = b"!\"'(),.:;?"
SIGN, SOLID, LETTER = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
SIGN[list(SIGNS)] = SOLID[0x21:0x7F] = LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True
CUT = re.compile(r"\s|[A-Za-z][" + re.escape(SIGNS.decode()) + "]")
#: Parts that a worker keeps the counts of, their longest, and how many parts are looked up at once.
KNOWN, LONGEST, AT_ONCE = 1 << 19, 64, 1 << 16

_loaded: dict[str, object] = {}


def safe_parts(text: str, limit: int) -> list[str]:
    """Cut a text into parts of about `limit` characters at safe boundaries; without any it stays whole."""
    parts, a = [], 0
    while len(text) - a > limit:
        m = SAFE.search(text, a + limit)
        if not m:
            break
        parts.append(text[a : m.start()])
        a = m.start()
    parts.append(text[a:])
    return parts


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the parts of texts begin: at their ends, at ASCII white space behind a character that is surely none, and at SIGNS behind ASCII letters."""
    new = np.zeros(len(data) + 1, bool)
    blank = BLANK[data]
    new[1:-1] = blank[1:] & SOLID[data[:-1]] | SIGN[data[1:]] & LETTER[data[:-1]]
    at = np.flatnonzero(blank[1:] & (data[:-1] >= 0x80)) + 1
    two, three = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    # Other white space is U+0085, U+00A0 and some of U+1000 to U+2FFF and U+3000 to U+303F.
    new[at] = ~((two == 0xC2) | (three == 0xE1) | (three == 0xE2) | ((three == 0xE3) & (two == 0x80)))
    new[offsets] = True
    new[-1] = False
    return np.flatnonzero(new)


class _Json:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.encoder.no_truncation()
        self.encoder.no_padding()
        spec = json.loads(open(path, encoding="utf-8").read())
        pre = spec.get("pre_tokenizer") or {}
        #: Only this pre-tokenizer is known to start a piece at every safe boundary.
        self.splits = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
        added = spec.get("added_tokens") or []
        #: Added tokens are found before the pre-tokenizer runs; these must not reach over a cut.
        self.parts = self.splits and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or CUT.search(x["content"]) for x in added)
        self.known: dict[bytes, int] = {}

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]


class _Pieces:
    splits = parts = False

    def __init__(self, path: str):
        import sentencepiece

        self.encoder = sentencepiece.SentencePieceProcessor(model_file=path)

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.encoder.encode(texts, num_threads=1)]


def load(path: str):
    if path not in _loaded:
        _loaded[path] = _Pieces(path) if path.endswith(".model") else _Json(path)
    return _loaded[path]


def lengths(encoder, texts: list[str], split_bytes: int) -> list[int]:
    """Token counts of texts in one encoder call."""
    if not encoder.splits or all(len(t) <= split_bytes for t in texts):
        return encoder.lengths(texts)
    parts = [safe_parts(t, split_bytes) for t in texts]
    flat = iter(encoder.lengths([p for x in parts for p in x]))
    return [sum(next(flat) for _ in x) for x in parts]


def summed(encoder, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Token counts of texts by their parts, of which each distinct one is encoded once."""
    starts = part_starts(data, offsets)
    raw, bounds = data.tobytes(), [*starts.tolist(), len(data)]
    known, counts = encoder.known, np.zeros(len(starts) + 1, np.int64)
    for a in range(0, len(starts), AT_ONCE):
        b = min(a + AT_ONCE, len(starts))
        parts = [raw[x:y] for x, y in zip(bounds[a:b], bounds[a + 1 : b + 1], strict=True)]
        found = list(map(known.get, parts))
        new = list({x for x, n in zip(parts, found, strict=True) if n is None})
        if new:
            known.update(zip(new, encoder.lengths([x.decode() for x in new]), strict=True))
            found = [known[x] if n is None else n for x, n in zip(parts, found, strict=True)]
        counts[a + 1 : b + 1] = found
        for x in new:
            if len(x) > LONGEST:
                del known[x]
        if len(known) > KNOWN:
            known.clear()
    return np.diff(np.cumsum(counts)[np.searchsorted(starts, offsets)])


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = 1 << 20,
    split_bytes: int = 1 << 16,
) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row; texts never leave the Arrow worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer_path)
        for batch in batches:
            text = pc.fill_null(batch.column(1), "")
            data, offsets = buffers(text)
            counts: list[int] = []
            for a, b in byte_slices(offsets, batch_bytes):
                if encoder.parts:
                    counts += summed(encoder, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]).tolist()
                else:
                    counts += lengths(encoder, text.slice(a, b - a).to_pylist(), split_bytes)
            size = pc.cast(pc.binary_length(text), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(counts, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).alias("__wl_text")).mapInArrow(lean(run), f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")
