"""Fitted models applied by slow plain Python give the scores of the queries' operators on every row."""

import math
import os
import re

import numpy as np
import pytest
from test_langid import plain_posteriors

from wayloom.llm import features, langid_crf, quality_fm, textkit, toxicity_chain

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")
ONES = (1 << 64) - 1
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def lower(raw):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in raw)


def tokens(text):
    return [lower(x) for x in WORD.findall((text or "").encode())]


def mix(h):
    h ^= h >> 32
    h = h * 0xFF51AFD7ED558CCD & ONES
    return h ^ (h >> 29)


def plain_hash(raw):
    return sum((b + 1) * pow(textkit.BASE, k, 1 << 64) for k, b in enumerate(raw)) & ONES


def sigmoid(x):
    return 1 / (1 + math.exp(-min(max(x, -30), 30)))


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    docs = read("documents").select("doc_id", "text", "lang").cache()
    return docs, read("labels"), {r.doc_id: r.text for r in docs.collect()}


def statistics(text):
    """The structure statistics of a text, one after another."""
    raw, toks = (text or "").encode(), tokens(text)
    kinds = [features.CLASSES[features._CLASS[b]] for b in raw]
    chars = max(1, len(raw) - kinds.count("tail"))
    out = [kinds.count(c) / chars for c in features.CLASSES if c != "tail"]
    whole = WORD.findall(raw)
    n = max(1, len(toks))
    buckets = [mix(plain_hash(t)) >> 48 for t in toks]
    most = max((buckets.count(b) for b in set(buckets)), default=0)
    lines = kinds.count("newline") + 1
    return out + [len(set(buckets)) / n, sum(map(len, toks)) / n, math.log1p(len(toks)), len(toks) / lines, sum(65 <= t[0] <= 90 for t in whole) / n, most / n], buckets


def test_quality(tables):
    docs, labels, texts = tables
    m = quality_fm.train(docs, labels)
    got = {r.doc_id: r.score for r in quality_fm.score(docs, m).collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        stats, buckets = statistics(text)
        x = {b: math.sqrt(buckets.count(b) / len(buckets)) for b in set(buckets)}
        for j, v in enumerate(stats):
            x[(1 << m.bits) + j * quality_fm.BINS + sum(v >= e for e in m.edges[j])] = quality_fm.STAT_VALUE
        at, value = np.array(list(x)), np.array(list(x.values()))
        pairs = (m.v[at].astype(float) @ m.v[at].T.astype(float)) * np.outer(value, value)
        want = m.w0 + (m.w[at] * value).sum() + np.triu(pairs, 1).sum()
        assert abs(got[i] - sigmoid(want)) < 1e-3, i


def test_toxicity(tables):
    docs, labels, texts = tables
    chain = toxicity_chain.train(docs, labels)
    got = {r.doc_id: r for r in toxicity_chain.score(docs, chain).collect()}
    top = 64 - toxicity_chain.BITS
    for i, text in texts.items():
        buckets = set()
        for t in tokens(text):
            buckets.add(mix(plain_hash(t)) >> top)
            for k in toxicity_chain.BEGINNINGS:
                if len(t) > k:
                    code = k
                    for b in t[:k]:
                        code = (code * 257 + b) & ONES
                    buckets.add(mix(code * 0x9E3779B97F4A7C15 & ONES) >> top)
        slots = [int(chain.slots[b]) for b in buckets if chain.slots[b] >= 0]
        before = []
        for link, name in zip(chain.links, toxicity_chain.CATEGORIES, strict=True):
            before.append(sigmoid(link.bias + sum(link.weight[s] for s in slots) + sum(a * b for a, b in zip(link.earlier, before, strict=True))))
            assert abs(got[i][f"p_{name}"] - before[-1]) < 1e-9, (i, name)


def test_language(tables):
    docs, _, texts = tables
    crf = langid_crf.train(docs)
    got = {r.doc_id: r for r in langid_crf.identify(docs, crf).collect()}
    known = {}

    def emission(t):
        if t not in known:
            codes = [mix((mix(plain_hash(t)) + 11) & ONES)]
            piece = lambda kind, part: codes.append(mix((plain_hash(part) + kind * 7919) & ONES))
            for k in langid_crf.AFFIX:
                if len(t) >= k:
                    piece(20 + k, t[:k])
                    piece(40 + k, t[-k:])
            for k in langid_crf.GRAMS:
                for a in range(len(t) - k + 1):
                    piece(60 + k, t[a : a + k])
            known[t] = crf.emit[[c >> (64 - langid_crf.BITS) for c in codes]].astype(float).sum(0)
        return known[t]

    for i, text in texts.items():
        toks = tokens(text)
        if not toks or not any(c.isalpha() for c in text):
            assert got[i].lang_pred == "und" and got[i].score == 0
            continue
        mass = plain_posteriors(np.array([emission(t) for t in toks]), crf.move).mean(0)
        assert got[i].lang_pred == crf.labels[mass.argmax()] and abs(got[i].score - mass.max()) < 1e-4, i
