"""Importance resampling against a plain rendering of its definition."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.llm import resampling
from lendscope.llm.queries import QUERIES
from lendscope.sources.tables import read_table
from tests.conftest import SF001

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall((text or "").encode().lower())
    return words, words + [a + b" " + b for a, b in zip(words, words[1:])]


def brute(docs, target, buckets=10000, min_words=20, percent=25, seed=7):
    """Rows (doc_id, n_features, weight, score, rank) of (doc_id, text) rows."""
    def count(texts):
        out = {}
        for t in texts:
            for f in features(t)[1]:
                b = zlib.crc32(f) % buckets
                out[b] = out.get(b, 0) + 1
        return out
    s, t = count(d[1] for d in docs), count(target)
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t.get(b, 0) + 1) * all_s / ((s.get(b, 0) + 1) * all_t))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        words, feats = features(text)
        weight = sum(gain[zlib.crc32(f) % buckets] for f in feats) // len(feats) if feats else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:len(able) * percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in read_table(spark, SF001, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in read_table(spark, SF001, "benchmark").collect()]
    assert got(QUERIES["op13_importance_resample"](spark, SF001)) == brute(docs, target)


def corpus(rng, n):
    words = ["Alpha", "béta", "x1", "42", "日本", "straße", "w" * 80, "a", "ÀB", "z_z", "it's"]
    return [(i, "".join(rng.choice(words) + rng.choice([" ", "\n", "-", ".. ", "\x00"]) for _ in range(rng.randrange(0, 120)))) for i in range(n)]


@pytest.mark.parametrize("finish", [1, 7, 1 << 14])
def test_odd_texts_nulls_and_clashing_columns(spark, finish):
    docs = corpus(random.Random(13), 150) + [(200, None), (201, ""), (202, " .,-"), (None, "one two " * 30), (5000, "one two " * 30)]
    rows = [(i, t, 1, 2, "x", 4, 5) for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, rank int, score int, row string, ka int, n_words int").repartition(5)
    target = spark.createDataFrame([("béta x1 42 béta",), (None,)], "text string")
    out = resampling.resample(frame, target, buckets=300, percent=40, finish_rows=finish)
    assert got(out) == brute(docs, ["béta x1 42 béta", None], 300, percent=40)


def test_repeated_rows_keep_one_row_each(spark):
    docs = [(i % 3, "same words here " * 9) for i in range(30)]
    out = got(resampling.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("words",)], "text string"), finish_rows=2))
    want = brute(docs, ["words"])
    assert [r[:4] for r in out] == [r[:4] for r in want]
    assert sorted(r[4] for r in out if r[4]) == list(range(1, 8))
    assert sorted((r[4], r[0], r[3]) for r in out if r[4]) == sorted((r[4], r[0], r[3]) for r in want if r[4])


def test_empty_tables(spark):
    none, target = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(none, target).collect() == []
    some = spark.createDataFrame([(1, "w " * 25), (2, "v " * 25), (3, "u " * 25), (4, "t " * 25)], "doc_id long, text string")
    assert got(resampling.resample(some, target.where(F.lit(False)))) == brute([(1, "w " * 25), (2, "v " * 25), (3, "u " * 25), (4, "t " * 25)], [])


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice(["abc", "De", "é" * 40, "7"]) + rng.choice([" ", "  ", "---"]) for _ in range(900)).encode().lower()
    raw = np.frombuffer(text, np.uint8)
    whole = resampling.word_buckets(raw, np.array([0, len(raw)]))
    for size in (5, 64, 1000):
        monkeypatch.setattr(resampling, "_PIECE_BYTES", size)
        one, two = [], []
        for piece, shared in resampling._pieces(raw):
            a, b, same, _ = resampling.word_buckets(piece, np.array([0, len(piece)]))
            one += a[1:].tolist() if shared else a.tolist()
            two += b[:-1][same[:-1]].tolist()
        assert one == whole[0].tolist()
        assert two == whole[1][:-1].tolist()


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_cutoff_key_is_exact(spark, parts):
    rng = random.Random(parts)
    keys = [(rng.randrange(20), rng.randrange(20), i) for i in range(700)]
    frame = spark.createDataFrame(keys, "ka long, kb long, kc long").repartition(parts)
    ordered = sorted(keys)
    for k in (1, 2, 350, 699, 700):
        assert resampling.cutoff_key(frame, k, finish_rows=3) == ordered[k - 1]
    assert resampling.cutoff_key(frame, 0) is None and resampling.cutoff_key(frame, 701) is None
