"""Substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.llm import substring_dedup as sd
from tests.conftest import SF001


def brute(texts, k):
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    seen = Counter(tuple(w[i:i + k]) for w in split for i in range(len(w) - k + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i:i + k])] > 1:
                gone[i:i + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "x,", "Ü"]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    passages = [text(rng.randrange(8, 60)) for _ in range(6)]
    docs = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += rng.choice(passages) if rng.random() < 0.5 else text(rng.randrange(0, 40))
        docs.append(rng.choice([" ", "\n", "  "]).join(parts))
    docs += [docs[0]] * 4 + ["same " * 50, "a b " * 30, "", None, "short one", " \t\n"]
    return docs


def check(spark, texts, k, **sizes):
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, windows int")
    got = {r.doc_id: r for r in sd.substring_dedup(df, k, with_text=True, **sizes).collect()}
    assert len(got) == len(texts)
    for i, want in enumerate(brute(texts, k)):
        r = got[i]
        assert (r.n_words, r.n_removed, r.kept_sha256) == want
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == want[2]
        assert sum(s.end - s.begin for s in r.removed) == r.n_removed


@pytest.mark.parametrize(("k", "sizes"), [(10, {}), (10, {"group_pieces": 1, "group_words": 50}), (3, {"group_pieces": 3}), (35, {}), (80, {})])
def test_matches_brute_force(spark, k, sizes):
    check(spark, corpus(k), k, **sizes)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    want = dict(zip([i for i, _ in texts], brute([t for _, t in texts], 35), strict=True))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in sd.substring_dedup(docs).collect()}
    assert got == want


def test_repeated_rows_null_ids_and_empty_tables(spark):
    long = " ".join(f"t{i}" for i in range(20))
    df = spark.createDataFrame([(None, long), (None, long), (1, long + " tail"), (2, "other " + long[:9])], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in sd.substring_dedup(df, 10).collect())
    assert got == [(0, 20, 20), (0, 20, 20), (1, 21, 20), (2, 4, 0)]
    assert sd.substring_dedup(df.where(F.lit(False)), 10).collect() == []


def test_sliding_least():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1000, 200).astype(np.uint64)
    for width in (1, 2, 3, 28, 35):
        want = [values[i:i + width].min() for i in range(200 - width + 1)]
        assert sd.sliding_least(values, width).tolist() == want
