"""Token counts and packing against the library and against piece-by-piece best-fit decreasing."""

import random
import zlib

import numpy as np
import pytest

from lendscope.llm import packing, tokens
from lendscope.llm.queries import tokenizer_path
from tests.conftest import SF001

ODD = ["", None, " ", "\n\t", "word", "A  b\x0bC\r\n", "<|endoftext|> inside<|startoftext|>x", "é ́a naïve Å̊",
       "x" * 3000, "1234 5 67!!", "don't we'll I'd", "  thin spaces", "日本語 \U0001f600‍\U0001f600", "\x1c\x1d\x85 İΣ Σ."]


def library_count(text):
    tokenizer, _ = tokens.load(tokenizer_path())
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_words_give_the_whole_texts_ids():
    tokenizer, _ = tokens.load(tokenizer_path())
    for text, ids in zip(ODD, tokens.document_ids(tokenizer_path(), ODD), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_counts_match_the_library(spark):
    rng = random.Random(4)
    words = ["Alpha", "béta", "it's", "<|endoftext|>", "x1y2", " ", "...", "zz"]
    texts = ODD + ["".join(rng.choice(words) + rng.choice([" ", "\n", "  ", ""]) for _ in range(rng.randrange(5, 400))) for _ in range(40)]
    texts += ["ab" * 700, "ab" * 300 + " " + "cd" * 400]  # no boundary in any small overlap
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "x"), (3, texts[3], "x"), (900, texts[-1], "x")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = tokens.count_tokens(df, tokenizer_path(), limit=20, chunk=128, overlap=16).collect()
    want = sorted((i if i is not None else -1, len((t or "").encode()), library_count(t), library_count(t) > 20) for i, t, _ in rows)
    assert sorted((r[0] if r[0] is not None else -1, r[1], r[2], r[3]) for r in got) == want


def test_counts_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.count_tokens(df, tokenizer_path()).collect() == []


def brute_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= length]
        if fits:
            rooms[min(fits)[1]] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100])
    lengths = [rng.randint(1, capacity) if rng.random() < 0.7 else rng.choice([3, 7]) for _ in range(rng.randrange(1, 400))]
    counts = {x: lengths.count(x) for x in set(lengths)}
    plan = packing.best_fit_decreasing(counts, capacity)
    windows = {}
    for length, n in counts.items():
        own = [p for p in plan if p[0] == length]
        for rank in range(n):
            _, r0, first, each, offset = max(p for p in own if p[1] <= rank)
            windows.setdefault(first + (rank - r0) // each, []).append((offset + (rank - r0) % each * length, length))
    rooms = []
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        rooms.append(capacity - at)
    assert sorted(rooms) == brute_best_fit(lengths, capacity)


def check_packed(rows, texts, capacity):
    tokenizer, _ = tokens.load(tokenizer_path())
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for spans in sequences.values():
        at = 0
        for r in sorted(spans, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(docs[(doc_id, len(ids))], key=lambda r: r.start)
        at = 0
        for r in own:
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return len(sequences)


def test_pack_small(spark):
    texts = dict(enumerate([*ODD, "a b c d e f g h " * 20]))
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, length int")
    check_packed(packing.pack(df, tokenizer_path(), capacity=16, rank_rows=4).collect(), texts, 16)
    assert packing.pack(df.limit(0), tokenizer_path()).collect() == []


def test_pack_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = packing.pack(docs, tokenizer_path()).collect()
    n = check_packed(rows, texts, packing.WINDOW_TOKENS)
    total = sum(r.length for r in rows)
    assert n * packing.WINDOW_TOKENS <= total * 1.02 + packing.WINDOW_TOKENS


def test_words_encoded_together_are_cut_where_they_were_joined():
    tokenizer, _ = tokens.load(tokenizer_path())
    calls = []

    class Counting:
        encode = staticmethod(tokenizer.encode)

        @staticmethod
        def encode_batch_fast(texts, **kwargs):
            calls.append(len(texts))
            return tokenizer.encode_batch_fast(texts, **kwargs)

    words = [w.encode() for w in ("a", "|", "b|c", "<|endoftext|>", "%%%", "́x", "K", "café", "你好", " ", "\U0001f600", "A" * 300, "'s", "x's")]
    alone = [np.array(tokenizer.encode(w.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes() for w in words]
    assert tokens._ids_of(Counting, words) == alone and calls == [1, 3]
    assert [tokens._ids_of(tokenizer, [w]) for w in words] == [[i] for i in alone] and tokens._ids_of(tokenizer, []) == []
