"""Vector codes: the search against all distances, the codes against a plain rendering and DuckDB."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.llm import vector_codes
from lendscope.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF001
from tools.oracle_check import duck_connect, normalise


@pytest.mark.parametrize("n,width,spread", [(256, 16, 1000), (256, 16, 3), (1, 4, 10), (70, 1, 5), (200, 3, 1 << 24), (5, 0, 1), (64, 2, 2)])
def test_nearest_is_exact_with_ties_to_the_lower_entry(n, width, spread):
    rng = np.random.default_rng(n + width)
    book = rng.integers(-spread, spread + 1, (n, width))
    book[n // 2:] = book[:n - n // 2]  # repeated entries
    rows = np.r_[rng.integers(-spread, spread + 1, (300, width)), book[::3], np.full((2, width), 1 << 24), np.full((1, width), -(1 << 24))]
    entry, distance = vector_codes.Slicer(book).nearest(rows)
    every = ((rows[:, None, :] - book[None]) ** 2).sum(2)
    assert distance.tolist() == every.min(1).tolist()
    assert entry.tolist() == every.argmin(1).tolist()


def brute(rows, entries=256, parts=4, rounds=4):
    """(vec_id, code, error, label_error, digest) of (vec_id, vector, label) rows."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1])
    cut = [i * width // parts for i in range(parts + 1)]
    books = [[r[1][cut[p]:cut[p + 1]] for r in kept[:entries]] for p in range(parts)]

    def assign(p, q):
        x = q[cut[p]:cut[p + 1]]
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for _, q, _ in kept:
                groups.setdefault(assign(p, q)[1], []).append(q[cut[p]:cut[p + 1]])
            new.append([[sum(col) // len(groups[e]) for col in zip(*groups[e])] if e in groups else c for e, c in enumerate(books[p])])
        books = new
    digest = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    out, by_label = [], {}
    for i, q, lab in kept:
        found = [assign(p, q) for p in range(parts)]
        err = sum(d for d, _ in found)
        by_label[lab] = by_label.get(lab, 0) + err
        out.append((i, "".join(f"{e:02x}" for _, e in found), err, lab))
    return sorted(((i, code, err, by_label[lab], digest) for i, code, err, lab in out), key=repr)


def got(frame):
    assert frame.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_codes_match_brute_force_with_odd_rows(spark):
    rng = random.Random(12)
    rows = [(rng.randrange(1 << 40), [rng.choice([-1.5, 0.0, 0.25, 3.0, rng.gauss(0, 1)]) for _ in range(8)], rng.choice([None, 1, 2])) for _ in range(400)]
    rows += [rows[0], rows[1], (None, rows[2][1], 7), (None, [0.5] * 8, None), (5, [1e-9] * 8, None)]
    bad = [(-1, None, 1), (-2, [None] + [0.0] * 7, 1), (-3, [float("nan")] * 8, 1), (-4, [0.0] * 7 + [float("-inf")], None), (-5, [0.0] * 9, 1), (-6, [], 1)]
    clash = [(*r, 1, "x", 3, 4, 5) for r in rows + bad]
    frame = spark.createDataFrame(clash, "vec_id long, embedding array<double>, label int, code int, q string, error int, slot int, of int").repartition(6)
    assert got(vector_codes.encode(frame, entries=40)) == brute(rows, entries=40)


def test_few_vectors_uneven_parts_and_huge_components(spark):
    rows = [(i, [float(i % 3), -0.3, 2.5, 1.0, 0.1 * i], "l") for i in range(7)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert got(vector_codes.encode(frame)) == brute(rows)
    huge = spark.createDataFrame([(1, [1e300, -1e300, 0.0, 1.0], None), (2, [1e300, 0.0, 0.0, 1.0], None)], "vec_id long, embedding array<double>, label int")
    assert [(r.vec_id, r.code, r.error) for r in vector_codes.encode(huge).orderBy("vec_id").collect()] == [(1, "00000000", 0), (2, "00010000", 0)]


def test_empty_tables(spark):
    frame = spark.createDataFrame([(1, None, 2)], "vec_id long, embedding array<float>, label int")
    assert got(vector_codes.encode(frame)) == [] and got(vector_codes.encode(frame.where(F.lit(False)))) == []


@pytest.mark.parametrize("sf_dir", [SF001, "/root/testdata/sf0.1"])
def test_query_matches_sql(spark, sf_dir):
    result = QUERIES["op12_vector_codes"](spark, sf_dir)
    answer = duck_connect(sf_dir).sql(ORACLE_SQL["op12_vector_codes"])
    assert normalise(result.columns, [tuple(r) for r in result.collect()]) == normalise(list(answer.columns), answer.fetchall())
