import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from wayloom.llm import textkit as tk

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
texts = st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aAbB é0-_ ", max_size=40)), max_size=12)


def plain(t):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))


@given(texts)
def test_words_are_those_of_the_pattern(rows):
    w = tk.words(*tk.buffers(pa.array(rows, pa.string())))
    assert [[w.text(k) for k in range(w.first[i], w.first[i + 1])] for i in range(len(rows))] == [plain(t) for t in rows]


def test_equal_words_have_equal_hashes_anywhere():
    w = tk.words(*tk.buffers(pa.array(["xx Word yy", "", "word", "WORD words"])))
    assert w.hash[1] == w.hash[3] == w.hash[4] and w.hash[5] != w.hash[4]


@given(texts)
def test_shingles(rows):
    data, offsets = tk.buffers(pa.array(rows, pa.string()))
    w = tk.words(data, offsets)
    h, first = tk.shingles(w, 3)
    seen = {}
    for i, t in enumerate(rows):
        words = plain(t)
        want = [tuple(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
        got = h[first[i] : first[i + 1]].tolist()
        assert len(got) == len(want)
        for x, y in zip(want, got, strict=True):
            assert seen.setdefault(x, y) == y
    assert len(set(seen.values())) == len(seen)


def test_slices_cover_all_rows():
    offsets = np.cumsum([0, 5, 0, 1000, 3, 3, 0])
    got = list(tk.byte_slices(offsets, 70))
    assert got[0][0] == 0 and got[-1][1] == 6 and all(x[1] == y[0] for x, y in zip(got, got[1:], strict=False))
