import math
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from oddities import odd_rows

from wayloom.llm import segment as s
from wayloom.llm.textkit import buffers

PATH = public_tokenizers.path("piece_bpe_32k.model")


def sampled(texts, k, keys=None):
    p = s.Pieces.load(PATH)
    data, offsets = buffers(pa.array([f" {t}" if t else "" for t in texts]))
    keys = np.arange(len(texts), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) if keys is None else keys
    return p, list(s.sample_batch(p, data, offsets, keys, k))


def every_segmentation(p, raw):
    own = {b: i for i, b in enumerate(p.raw) if b and p.score[i] < 0}
    out = []

    def go(at, ids, score):
        if at == len(raw):
            out.append((tuple(ids), score))
        for end in range(at + 1, len(raw) + 1):
            if raw[at:end] in own:
                i = own[raw[at:end]]
                go(end, [*ids, i], score + p.score[i])

    go(0, [], 0.0)
    total = np.logaddexp.reduce([x for _, x in out])
    return {ids: math.exp(x - total) for ids, x in out}


def test_samples_are_the_distribution_without_replacement():
    n = 40_000
    p, got = sampled(["anthe"] * n, 3)
    prob = every_segmentation(p, b" anthe")
    firsts = Counter(tuple(x[0][0].tolist()) for x in got)
    pairs = Counter((tuple(x[0][0].tolist()), tuple(x[1][0].tolist())) for x in got)
    for ids, q in prob.items():
        assert abs(firsts[ids] / n - q) < 5 * math.sqrt(q * (1 - q) / n) + 1e-3
    for (a, b), m in pairs.items():
        q = prob[a] * prob[b] / (1 - prob[a])
        assert abs(m / n - q) < 5 * math.sqrt(q / n) + 1e-3
    for x in got[:200]:
        assert len({tuple(y[0].tolist()) for y in x}) == 3
        assert [y[2] for y in x] == sorted((y[2] for y in x), reverse=True)
        for ids, log_prob, _, inclusion in x:
            assert abs(log_prob - math.log(prob[tuple(ids.tolist())])) < 1e-9 and 0 <= inclusion <= 1


def test_inclusion_scores_weigh_to_one():
    # Horvitz-Thompson: the sum over samples of probability by inclusion is one on average.
    _, got = sampled(["anthe inthe"] * 4000, 3)
    total = np.mean([sum(math.exp(y[1]) / max(y[3], 1e-300) for y in x) for x in got])
    assert abs(total - 1) < 0.05


def test_all_segmentations_of_a_short_text_are_found():
    p, (got,) = sampled(["the"], 500)
    prob = every_segmentation(p, b" the")
    assert {tuple(x[0].tolist()) for x in got} == set(prob)
    assert all(x[3] == 1.0 for x in got)


def test_unlikely_segmentations_are_found_too():
    # Nearly all the probability is on one piece; the rest lies below the digits of 1 - q.
    for word in ("который", "Становништво", "the"):
        p, (got,) = sampled([word], 400)
        prob = every_segmentation(p, f" {word}".encode())
        assert {tuple(x[0].tolist()) for x in got} == set(prob)
        p, (got,) = sampled([word], 5)
        assert len({tuple(x[0].tolist()) for x in got}) == min(5, len(prob))


def test_distant_sets_are_left_out_only_where_they_cannot_win():
    r = np.random.default_rng(3)
    size = r.integers(0, 30, 200)
    first = np.concatenate([[0], np.cumsum(size)])
    log_q = -r.random(first[-1]) * r.choice([0.01, 20.0], first[-1])
    rest = np.where(r.random(first[-1]) < 0.2, -np.inf, -r.random(first[-1]) * 300)
    before, top, seed = -r.random(200) * 50, r.normal(size=200) * 20, r.integers(0, 1 << 63, 200).astype(np.uint64)
    got = s._best_splits(log_q, rest, before, top, seed, first, 3)
    for i in range(200):
        own = slice(first[i], first[i + 1])
        mass = np.concatenate([[0], np.cumsum(log_q[own])[:-1]])[: size[i]] + before[i] + rest[own]
        alive = np.flatnonzero(mass > -np.inf)
        g = s._truncated(mass[alive], np.full(len(alive), top[i]), s._uniform(np.full(len(alive), seed[i]), alive))
        want = sorted(zip(g.tolist(), alive.tolist(), strict=True), reverse=True)[:3]
        assert [j for _, j in got[i]] == [j for _, j in want] and np.allclose([x for x, _ in got[i]], [x for x, _ in want])


def test_plain_encoding_is_the_library_s(spark, odd):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = sorted((str(i), tuple(model.encode(t or ""))) for i, t in odd_rows())
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in s.encode(odd, PATH).collect()) == want


def test_round_trip_and_determinism(spark, odd):
    rows = s.segmentations(odd, PATH, k=2)
    back = s.decode(rows, PATH).collect()
    texts = {}
    for i, t in odd_rows():
        texts.setdefault(i, set()).add(t or "")
    assert all(r.text in texts[r.doc_id] for r in back)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert all(model.decode(r.ids) == r.text for r in back)
    a, b = (sorted(map(tuple, s.digests(odd.repartition(n), PATH, k=2).select("doc_id", "rank", "ids_sha256").fillna(-1).collect())) for n in (1, 5))
    assert a == b and all(r.round_trip for r in s.digests(odd, PATH).collect())
    assert s.digests(odd.limit(0), PATH).count() == 0


def test_space_sign_in_a_text_survives():
    p, got = sampled(["a▁b ▁"], 2)
    assert all(p.decode(x[0]) == "a▁b ▁".encode() for x in got[0])


def test_steps_by_table_and_by_hash_are_the_same(monkeypatch):
    p = s.Pieces.load(PATH)
    assert p.next is not None
    r = np.random.default_rng(4)
    keys = p.keys[p.keys >= 0]
    state = np.concatenate([keys // p.width, r.integers(0, len(p.end), 5000), np.zeros(p.width, np.int64)])
    column = np.concatenate([keys % p.width, r.integers(0, p.width, 5000), np.arange(p.width)])
    got = p.step(state, column)
    assert got[: len(keys)].tolist() == p.values[p.keys >= 0].tolist()
    monkeypatch.setattr(s, "DENSE", 0)
    hashed = s.Pieces(PATH)
    assert hashed.next is None and hashed.step(state, column).tolist() == got.tolist()


def test_rows_of_a_slice_are_spelled_as_alone():
    texts = ["", "a▁b", "", "the \x00\U0001f642▁▁", "", "▁", "word", ""]
    keys = np.arange(len(texts), dtype=np.uint64) * np.uint64(977)
    p, got = sampled(texts, 3, keys)
    for i, (text, own) in enumerate(zip(texts, got, strict=True)):
        _, (alone,) = sampled([text], 3, keys[i : i + 1])
        assert [x[0].tolist() for x in own] == [x[0].tolist() for x in alone]
        assert all(p.decode(x[0]) == text.encode() for x in own) and bool(text) == any(len(x[0]) for x in own)
    assert list(s.sample_batch(p, np.zeros(0, np.uint8), np.zeros(3, np.int64), keys[:2], 2))[1][0][0].tolist() == []
