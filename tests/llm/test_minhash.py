"""MinHash components against all pairs of full sets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.llm import minhash
from lendscope.llm.queries import QUERIES
from lendscope.sources.tables import read_table
from tests.conftest import SF001


def shingle_set(text, size=5):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(docs, percent=85):
    """Rows (doc_id, n_shingles, component_id, kept) of (doc_id, text) rows."""
    sets = [shingle_set(t) for _, t in docs]
    label = list(range(len(docs)))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                label[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i)), d == low.get(find(i))) for i, (d, _) in enumerate(docs)), key=repr)


def got(frame):
    assert frame.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in read_table(spark, SF001, "documents").select("doc_id", "text").collect()]
    assert got(QUERIES["op11_minhash_dedup"](spark, SF001)) == brute(docs)


def test_shingle_hashes_in_parts(monkeypatch):
    rng = random.Random(3)
    texts = ["", "a", "a b c d", "A  b\nc d  E", " x\ty z w v ", *["".join(rng.choice(["ab", "é", "q" * 20]) + rng.choice([" ", " \n"]) for _ in range(50)) for _ in range(9)]]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    whole, counts = minhash.shingle_hashes(minhash._LOWER[raw], offsets)
    values, sizes = minhash.distinct_by_text(whole, counts)
    assert sizes.tolist() == [len(shingle_set(t)) for t in texts]
    assert len(set(values.tolist())) == len(frozenset().union(*map(shingle_set, texts)))
    for part in (1, 7):
        monkeypatch.setattr(minhash, "_AT_ONCE", part)
        assert minhash.shingle_hashes(minhash._LOWER[raw], offsets)[0].tolist() == whole.tolist()


@pytest.mark.parametrize("size,shared", [(7, 6), (20, 17), (100, 86), (1000, 860)])
def test_bins_agree_as_often_as_sets_are_similar(size, shared):
    """Sets of ``size`` in all, ``shared`` of them in both; no pair may lose all of its bands."""
    rng = np.random.default_rng(size)
    share, missed = [], 0
    for _ in range(300):
        all_ = np.sort(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        out = rng.choice(size, size - shared, replace=False)
        a, b = np.delete(all_, out[::2]), np.delete(all_, out[1::2])
        sig = minhash.signatures(np.r_[a, b], np.array([len(a), len(b)]))
        share.append((sig[0] == sig[1]).mean())
        bands = minhash.band_hashes(sig)
        missed += not (bands[0] == bands[1]).any()
    assert abs(np.mean(share) - shared / size) < 0.02 and missed == 0
    assert min(share) * minhash.BINS >= int(minhash.BINS * (0.85 - 6 * (0.85 * 0.15 / minhash.BINS) ** 0.5))


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10 ** 9)}"
    return words


def corpus(seed):
    """Copies of hubs (similar to the hub, hardly to each other), chains, a passage in many documents."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    docs = []
    for size, edits in ((300, 5), (300, 9), (120, 2), (60, 1)):
        hub = fresh(size)
        docs += [hub] + [edited(rng, hub, edits) for _ in range(25)]
    step = fresh(200)
    for _ in range(20):
        docs.append(step)
        step = edited(rng, step, 3)
    passage = fresh(60)
    docs += [fresh(rng.randrange(5, 60)) + passage + fresh(rng.randrange(5, 60)) for _ in range(80)]
    docs += [fresh(rng.randrange(0, 12)) for _ in range(40)]
    small = fresh(11)
    docs += [small, small[:10], small[1:], small + ["end"], small[:9]]
    docs += [rng.choice(docs) for _ in range(30)]
    rng.shuffle(docs)
    ids = rng.sample(range(10 ** 6), len(docs))
    return [(i, rng.choice([" ", "\n ", "\t"]).join(w.upper() if rng.random() < 0.2 else w for w in d)) for i, d in zip(ids, docs, strict=True)]


@pytest.mark.parametrize("seed,tile_rows", [(0, 2048), (1, 4), (2, 2048)])
def test_components_match_brute_force(spark, seed, tile_rows):
    docs = corpus(seed) + [(-5, None), (-6, ""), (-7, " \n"), (None, "one two three four"), (-8, "One  two three FOUR")]
    frame = spark.createDataFrame([(i, t, 1, 2, "x", 4) for i, t in docs], "doc_id long, text string, key int, n int, bands string, bucket int")
    assert got(minhash.minhash_components(frame.repartition(4), tile_rows=tile_rows)) == brute(docs)


def test_null_and_repeated_ids_and_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(100))
    docs = [(None, "only nulls here " * 3), (None, "only nulls here " * 3), (4, long), (4, long), (4, "other"), (2, long + " x"), (9, "other")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = [(d, n, c, True if d is None else k) for d, n, c, k in brute(docs)]
    assert got(minhash.minhash_components(frame)) == sorted(want, key=repr)
    assert got(minhash.minhash_components(frame.where(F.lit(False)))) == []


def test_a_long_text(spark):
    rng = random.Random(2)
    words = [f"v{rng.randrange(10 ** 6)}" for _ in range(300_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:-40_000])), (3, " ".join(words[:150_000])), (4, " ".join(words[100:]))]
    assert got(minhash.minhash_components(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_common_counts():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(20)]
    got_counts = minhash.common_counts(np.concatenate(sets), np.array([len(s) for s in sets]), at_once=7)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got_counts[i, j] == len(np.intersect1d(a, b))


def test_a_group_of_near_copies_that_hardly_link(spark):
    """Copies of a lost original: similar enough to share buckets, but most pairs are below the threshold."""
    rng = random.Random(8)
    original = [f"w{rng.randrange(5000)}" for _ in range(150)]
    docs = [(i, " ".join(edited(rng, original, rng.choice([2, 3, 3, 3])))) for i in range(120)]
    for rows in (docs, docs[:3]):
        assert got(minhash.minhash_components(spark.createDataFrame(rows, "doc_id long, text string"), tile_rows=40)) == brute(rows)
