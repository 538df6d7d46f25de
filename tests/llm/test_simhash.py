"""Fingerprints, bit-sliced comparison and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lendscope.llm import simhash
from tests.conftest import SF001


def brute_fingerprint(text, k=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    label = list(range(len(prints)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 7, 10])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    rows = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    rows[100:] = rows[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100, dtype=np.uint64)) ^ rng.integers(0, 1 << 12, 100, dtype=np.uint64)
    at = np.arange(200)
    planes = simhash.bit_planes(rows, at // 64, (at % 64).astype(np.uint64), 4)
    words, values = np.tile(np.arange(4), 200), np.repeat(rows, 4)
    masks = simhash.within_radius(planes, words, values, radius)
    for w, v, m in zip(words.tolist(), values.tolist(), masks.tolist(), strict=True):
        for lane in range(64):
            row = w * 64 + lane
            if row < 200:
                assert (m >> lane & 1) == (bin(int(rows[row]) ^ v).count("1") <= radius)


@pytest.mark.parametrize("bucket_rows", [1 << 15, 8, 2])
def test_components_match_brute_force(spark, bucket_rows):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(30)]
    prints = []
    for _ in range(300):
        p = rng.choice(centres)
        for _ in range(rng.randrange(0, 6)):
            p ^= 1 << rng.randrange(64)
        prints.append(p)
    prints = sorted(set(prints) | {0, (1 << 64) - 1})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.fingerprint_links(df, 4, bucket_rows)).collect()}
    groups = {}
    for p, g in zip(signed, brute_components(prints, 4), strict=True):
        groups.setdefault(g, set()).add(p)
    got = {}
    for p in signed:
        got.setdefault(found.get(p, p), set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_rows_and_odd_texts(spark):
    texts = ["", None, " \n", "one", "One", "a b c d e", "A\tb  c d\ne", "x " * 500, "É é b c"]
    rows = [(i, t, "c") for i, t in enumerate(texts)] + [(None, "one", "c"), (3, "one", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, t in enumerate(texts):
        assert by_id[i].fingerprint == f"{brute_fingerprint(t):016x}"
    assert {by_id[i].component_id for i in (0, 1, 2)} == {0}
    assert [r.component_id for r in got if r.doc_id is None] == [3]
    assert simhash.near_duplicates(df.where(F.lit(False))).collect() == []


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    prints = [brute_fingerprint(t) for _, t in texts]
    want = {i: (f"{p:016x}", texts[g][0]) for (i, _), p, g in zip(texts, prints, brute_components(prints, 4), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()} == want


def test_keep_first_tells_components_apart_that_share_an_id(spark):
    rows = [(1, "a b c d e"), (1, "quite another text of words"), (2, "A b c d E"), (None, "only null"), (None, "x y z"), (None, "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in simhash.keep_first(df).collect()]
    assert sorted(got, key=repr) == sorted({rows[0], rows[1], rows[3], rows[4]}, key=repr)
