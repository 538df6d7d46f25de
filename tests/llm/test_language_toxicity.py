"""Language identification and toxicity: brute-force parsing, exact marginals, held-out accuracy."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendscope.llm import language_id, queries, toxicity
from tests.conftest import SF001


def test_automaton_accepts_exactly_the_substrings():
    rng = random.Random(1)
    for _ in range(30):
        text = [rng.randrange(3) for _ in range(rng.randrange(1, 25))]
        edges = language_id.suffix_automaton(text)

        def accepts(word, edges=edges):
            state = 0
            for c in word:
                if c not in edges[state]:
                    return False
                state = edges[state][c]
            return True
        substrings = {tuple(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)}
        for n in range(1, 5):
            for word in itertools.product(range(3), repeat=n):
                assert accepts(word) == (word in substrings)


def test_phrases_are_longest_matches():
    samples = {"a": "the cat sat on the mat", "b": "die katze sass auf der matte"}
    model = language_id.Model(samples)
    texts = ["the mat on the cat", "die matte!! 12 auf", "xyz", "c" * 1200, "the"]
    bits, known = model.rates(texts)
    assert known.all()
    for text, row in zip(texts, bits, strict=True):
        seq = "".join(map(chr, language_id.symbols(text)))
        for lang, got, per in zip(model.languages, row, model.bits, strict=True):
            train = "".join(map(chr, language_id.symbols(samples[lang])))
            phrases = 0
            for block in (seq[i:i + language_id.BLOCK] for i in range(0, len(seq), language_id.BLOCK)):
                at = 0
                while at < len(block):
                    n = 1
                    while at + n < len(block) and block[at:at + n + 1] in train and block[at:at + n] in train:
                        n += 1
                    if block[at:at + n] not in train:
                        n = 1
                    phrases += 1
                    at += n
            assert got == pytest.approx(phrases * per / len(seq))


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    found = queries.QUERIES["op2_language_id"](spark, SF001)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out and r.lang and r.lang_pred != "und"]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "12 !! 34"), (4, "the cat"), (None, "die katze"), (4, "the cat"), (5, "Ω")]
    df = spark.createDataFrame([(i, t, 0.0) for i, t in rows], "doc_id long, text string, score double")
    samples = {"a": "the cat sat on the mat", "b": "die katze sass auf der matte"}
    got = sorted((r.doc_id or 0, r.lang_pred) for r in language_id.identify(df, samples).collect())
    assert got[:-1] == [(0, "b"), (1, "und"), (2, "und"), (3, "und"), (4, "a"), (4, "a")]
    assert {r.lang_pred for r in language_id.identify(df, {}).collect()} == {"und"}
    assert language_id.identify(df.where(F.lit(False)), samples).collect() == []


def test_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    model = toxicity.Field(np.zeros(1, np.uint64), np.zeros(1), moves=rng.normal(size=(2, 2)))
    first = np.array([0, 5, 5, 12])
    emissions = rng.normal(size=12)
    got = model.marginals(emissions, toxicity.segments_of(first))
    for a, b in itertools.pairwise(first):
        n = b - a
        if not n:
            continue
        weight = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            total, before = 0.0, 0
            for i, y in enumerate(labels):
                total += emissions[a + i] * y + model.moves[before, y]
                before = y
            weight[labels] = np.exp(total)
        for i in range(n):
            one = sum(w for k, w in weight.items() if k[i])
            assert got[a + i] == pytest.approx(np.log(one / (sum(weight.values()) - one)))


def synthetic(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lor", "min", "tas", "ven")]
    texts, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 150))]
        bad = i % 3 == 0
        for _ in range(rng.randrange(1, 4) if bad else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["Zorgul", "zorguza", "QUAXO", "quaxi"]))
        texts.append(rng.choice([" ", ", ", "\n"]).join(words))
        labels.append(int(bad))
    return texts, labels


def test_toxic_documents_and_spans(spark):
    model = toxicity.fit(*synthetic(400, 1))
    texts, labels = synthetic(300, 2)
    texts += [None, "", "!!", "é zorgulux clean, quaxo quaxi"]
    df = spark.createDataFrame([(i, t, 9.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert np.mean([got[i].predicted == y for i, y in enumerate(labels)]) > 0.98
    assert [got[300 + i].predicted for i in range(4)] == [0, 0, 0, 1]
    assert [texts[303][s.start:s.start + s.length] for s in got[303].spans] == ["zorgulux", "quaxo quaxi"]
    assert {r.score for r in toxicity.score(df, None).collect()} == {0.0}
    assert toxicity.score(df.where(F.lit(False)), model).collect() == []
    assert toxicity.fit(["a", "b"], [1, 1]) is None and toxicity.fit([], []) is None


def test_a_passage_in_all_documents_does_not_make_them_copies():
    texts, labels = synthetic(400, 1)
    passage = " ".join(f"passage{i}" for i in range(40))
    shared = [f"{passage} {t}" for t in texts]
    more, more_labels = synthetic(300, 2)
    model = toxicity.fit(shared, labels)
    assert model is not None
    scores, _ = toxicity.score_texts(pa.array([f"{passage} {t}" for t in more]), model)
    assert np.mean((scores >= 0.5) == np.array(more_labels, dtype=bool)) > 0.95
    long = [t for t in texts if len(t.split()) > 40]

    def groups(texts):
        features, _, _, first = toxicity.token_features(*toxicity.text_buffer(pa.array(texts)))
        return toxicity._copy_groups(features[:, 0], first).tolist()
    assert groups([f"{passage} {t}" for t in long]) == list(range(len(long)))
    # Copies, near copies and documents of few words; what follows a document doesn't count.
    near = [long[0], "a b", long[1], long[0] + " more", "a b", "", "a c", long[1], "a"]
    assert groups(near) == [0, 1, 2, 0, 1, 5, 6, 2, 8]


def test_fit_is_repeatable_and_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    train = language_id.fold("doc_id", 5) != 0
    flipped = labels.withColumn("toxic", F.when(train, F.col("toxic")).otherwise(1 - F.col("toxic")))
    one = toxicity.training_documents(docs, labels, train)
    assert one == toxicity.training_documents(docs, flipped, train)
    assert toxicity.fit(*one).layer == toxicity.fit(*one).layer


def test_toxicity_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = queries.QUERIES["op3_toxicity"](spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == y] for y in (1, 0))
    assert len(toxic) > 50 and np.mean(toxic) > 0.85 and np.mean(clean) < 0.02
