"""Odd rows that every operator has to bear."""

import random

CLASH = ["score", "n_words", "hit_spans", "hit_items", "lang_pred", "class_id", "kept", "id", "t", "slice", "key", "sig", "grams", "n_tokens", "rank", "ids", "b", "h"]


def prose(r, n, alphabet="abcdefgh"):
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(2, 7))) for _ in range(n))


def odd_rows():
    """Nulls, empty, long, repeated and tied rows."""
    r = random.Random(11)
    long = prose(r, 30_000)
    base = prose(r, 120)
    rows = [(0, base), (1, base), (1, base), (2, None), (3, ""), (4, "!!! ... ???"), (5, "one"), (6, long), (7, long[: len(long) // 2] + " " + base), (None, base), (None, None), (8, "日本語 テキスト と 絵文字 😀"), (9, "—")]
    return rows + [(10 + k, prose(r, 40)) for k in range(10)]
