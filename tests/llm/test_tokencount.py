import os

import public_tokenizers
import sentencepiece
from oddities import odd_rows
from tokenizers import Tokenizer

from wayloom.llm import tokencount as t

os.environ["TOKENIZERS_PARALLELISM"] = "false"
MORE = ["a<|endoftext|>b", "<|endoftext|>", "don't  stop \n\n now", " lead", "trail ", "x" * 300, "ab cd " * 40, "é à ü", "1234 5678 90ab"]


def test_counts_are_the_libraries(spark):
    rows = list(enumerate([x for _, x in odd_rows()] + MORE))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"):
        path = public_tokenizers.path(name)
        if name.endswith(".json"):
            whole = Tokenizer.from_file(path)
            want = [len(whole.encode(x or "", add_special_tokens=False).ids) for _, x in rows]
        else:
            want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode([x or "" for _, x in rows])]
        got = {r.doc_id: r for r in t.count_tokens(df, path, batch_bytes=500, split_bytes=64).collect()}
        assert [got[i].n_tokens for i, _ in rows] == want
        assert [got[i].n_bytes for i, _ in rows] == [len((x or "").encode()) for _, x in rows]


def test_safe_parts_put_together_are_the_text():
    for x in MORE + [x or "" for _, x in odd_rows()]:
        assert "".join(t.safe_parts(x, 50)) == x


def test_odd_columns_and_empty_table(spark, odd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = t.count_tokens(odd, path)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"] and got.count() == odd.count()
    assert t.count_tokens(odd.limit(0), path).count() == 0


def test_parts_are_encoded_once_and_add_up():
    encoder = t.load(public_tokenizers.path("byte_bpe_50k.json"))
    assert encoder.parts
    blanks = [" ", "  ", "\t", "\n", "\r\n", "\v", "\f", *map(chr, (0x1C, 0x1F, 0x7F, 0x85, 0xA0, 0x1680, 0x180E, 0x2003, 0x2028, 0x202F, 0x205F, 0x3000, 0x200B))]
    others = ["a", "'s", "x'll", "7", "b.", "'", "\u00e9", "\u044f", "\u8a9e", "\u3005", "\u3001", "\u20ac", "\U0001f642", "<|endoftext|>", "e\u0301", ""]
    texts = [x + u + y + v + z for x in others for u in blanks for y in ("a", "'re", "a'", "!", "a,\u00e9", "\u20ac", "<|endoftext|>", "") for v in blanks for z in ("b", "5", "")]
    texts += ["", "the same words " * 2000]
    data, offsets = t.buffers(t.pa.array(texts))
    want, encoded = encoder.lengths(texts), []
    encoder.known.clear()
    own = encoder.lengths
    encoder.lengths = lambda parts: encoded.extend(parts) or own(parts)
    usual = t.AT_ONCE, t.KNOWN, t.LONGEST
    try:
        assert t.summed(encoder, data, offsets).tolist() == want
        first = len(encoded)
        t.AT_ONCE, t.KNOWN, t.LONGEST = 50, 20, 3
        assert t.summed(encoder, data, offsets).tolist() == want
    finally:
        encoder.lengths = own
        t.AT_ONCE, t.KNOWN, t.LONGEST = usual
    assert len(set(encoded[:first])) == first and encoded[:first].count(" words") == 1
