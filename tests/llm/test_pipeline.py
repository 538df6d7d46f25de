"""The pipeline's stages against brute force, each on its own input."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from lendscope.llm import packing
from tests.conftest import SF001
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_tokens_packing import check_packed


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, out[-1], SF001).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    for df in stages[:-1]:
        assert df.dtypes == stages[0].dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert all(after[i] == before[i] for i in after)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    clean = [i for i in before if labels.get(i) == 0]
    toxic = [i for i in before if labels.get(i) == 1]
    assert sum(i in after for i in clean) >= 0.99 * len(clean)
    assert sum(i not in after for i in toxic) >= 0.6 * len(toxic)  # from 45 toxic training documents


def test_exact_duplicates(stages):
    before, after = rows(stages[1]), rows(stages[2])
    best = {}
    for i, r in before.items():
        norm = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[norm] = min(best.get(norm, (1, 0)), (-len(r.text or ""), i))
    assert after == {i: before[i] for _, i in best.values()}


def test_near_duplicates(stages):
    before, after = rows(stages[2]), rows(stages[3])
    ids = sorted(before)
    groups = brute_components([brute_fingerprint(before[i].text) for i in ids], 4)
    assert after == {ids[g]: before[ids[g]] for g in set(groups)}


def test_mix_takes_effect(spark, stages):
    from lendscope.llm import mixing
    before, taken = rows(stages[3]), {r.doc_id: r for r in mixing.mix_sources(stages[3]).collect()}
    words = Counter()
    for r in stages[4].collect():
        words[r.doc_id] += len((r.text or "").encode().split())
        full = before[r.doc_id].text
        of = full.encode().split()
        assert r.text == full or r.text.encode() in [b" ".join(of[p.start:p.start + p.length]) for p in taken[r.doc_id].ranges]
        assert r.n_chars == len(r.text)
    assert words == {i: r.taken for i, r in taken.items() if r.taken}


def test_pack(stages):
    got = stages[5].collect()
    texts = [r.text for r in stages[4].collect()]
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0)
    assert sum(r.start == 0 for r in got) == len(texts)
    once = Counter(r.doc_id for r in stages[4].select("doc_id").collect())
    single = {r.doc_id: r.text for r in stages[4].collect() if once[r.doc_id] == 1}
    check_packed(got, single, packing.WINDOW_TOKENS)


def test_run_gives_the_last_stage(spark, stages):
    key = ["doc_id", "start", "length", "ids_crc32"]
    got = queries()["pipeline"](spark, SF001)
    assert sorted(got.select(key).collect()) == sorted(stages[5].select(key).collect())


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e", None, "s", 9), (1, "a b c d e", None, "s", 9), (None, "a  b c d e", "x", None, 1), (None, None, None, None, None),
         (2, "", "y", "s", 0), (3, "q w e r t y", "y", "t", 11)], "doc_id long, text string, lang string, source string, n_chars long")
    exact = corpus_pipeline.drop_exact_duplicates(spark, docs, SF001)
    assert sorted(map(tuple, exact.collect()), key=repr) == sorted(
        [(None, "a  b c d e", "x", None, 1), (2, "", "y", "s", 0), (3, "q w e r t y", "y", "t", 11)], key=repr)
    near = corpus_pipeline.drop_near_duplicates(spark, docs, SF001)
    assert sorted(r.doc_id or 0 for r in near.collect()) == [1, 2, 3]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where(F.lit(False)), SF001).collect() == []
