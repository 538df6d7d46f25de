"""Large ids beside null ones, labels without letters, columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lendscope.llm import exact_dedup, language_id, minhash, mixing, packing, resampling, simhash, substring_dedup, tokens, toxicity
from lendscope.llm.queries import tokenizer_path
from lendscope.sources.tables import read_table
from tests.conftest import SF001

BIG = 1 << 60


def test_mix_keeps_large_ids_beside_null_ones(spark):
    docs = spark.createDataFrame([(BIG + 1, "a b c d e f", "s"), (None, "g h i", "s"), (BIG + 2, "j k l m", "s"), (BIG + 3, "", "s"), (BIG + 4, None, None)],
                                 "doc_id long, text string, source string")
    mixed = mixing.mix_sources(docs).collect()
    assert sorted(r.doc_id or 0 for r in mixed) == [0, BIG + 1, BIG + 2, BIG + 3, BIG + 4]
    taken = {r.doc_id: r.taken for r in mixed}
    assert sum(taken.values()) == round(1.5 * 13) and all(r.taken <= 2 * r.size for r in mixed)
    words = {}
    for r in mixing.apply_mix(docs, mixing.mix_sources(docs)).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {i: n for i, n in taken.items() if n}


def test_a_label_without_letters_takes_no_text(spark):
    docs = read_table(spark, SF001, "documents").select("doc_id", "text", "lang")
    junk = [(10 ** 7 + i, f"12 34 -- 99 {i} ...", "zz") for i in range(8)] + [(10 ** 7 + 20 + i, "ab ba", "yy") for i in range(8)]
    both = docs.unionByName(spark.createDataFrame(junk, "doc_id long, text string, lang string"))

    def predict(frame):
        samples = language_id.training_samples(frame, language_id.fold("doc_id", 4) != 2, "doc_id", "text", "lang")
        return {r.doc_id: r.lang_pred for r in language_id.identify(docs, samples).collect()}
    plain, mixed = predict(docs), predict(both)
    true = {r.doc_id: r.lang for r in docs.collect()}
    right = lambda p: sum(p[i] == t for i, t in true.items() if t) / sum(t is not None for t in true.values())
    assert right(mixed) >= right(plain) - 0.002 and "zz" not in mixed.values()
    assert language_id.identify(docs.limit(3), {"zz": "12 34"}).first().lang_pred == "und"


#: Names that operators use for columns of their own.
CLASHING = ["_id", "_sha", "_cp", "_text", "id", "rank", "label", "of", "its_lang", "key", "key_id", "key_text", "n", "bands", "sig", "bucket", "root",
            "component_id", "mix_id", "mix_source", "mix_size", "mix_pieces", "mix_words", "mix_piece", "shard", "size", "taken", "ranges", "score",
            "predicted", "spans", "piece", "hot", "h", "norm", "part", "row", "ka", "length", "place"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = read_table(spark, SF001, "documents").limit(250).cache()
    return docs, docs.withColumns({c: F.lit("mine") for c in CLASHING}), read_table(spark, SF001, "labels")


def plain(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


OPERATORS = {
    "substring": lambda d, labels: substring_dedup.substring_dedup(d),
    "language": lambda d, labels: language_id.identify(d, language_id.training_samples(d, F.lit(True), "doc_id", "text", "lang")),
    "toxicity": lambda d, labels: toxicity.score(d, toxicity.fit(*toxicity.training_documents(d, labels, F.lit(True)))),
    "tokens": lambda d, labels: tokens.count_tokens(d, tokenizer_path()),
    "simhash": lambda d, labels: simhash.near_duplicates(d),
    "packing": lambda d, labels: packing.pack(d, tokenizer_path()),
    "mixing": lambda d, labels: mixing.mix_sources(d),
    "exact": lambda d, labels: exact_dedup.exact_dedup(d),
    "minhash": lambda d, labels: minhash.minhash_components(d),
    "resampling": lambda d, labels: resampling.resample(d, d.limit(5)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_ignore_columns_of_any_name(tables, name):
    docs, more, labels = tables
    assert plain(OPERATORS[name](more, labels)) == plain(OPERATORS[name](docs, labels))


def test_labels_with_clashing_columns(tables):
    docs, _, labels = tables
    more = labels.withColumns({"id": F.lit("mine"), "label": F.lit(7), "of": F.lit(1)})
    assert toxicity.training_documents(docs, more, F.lit(True)) == toxicity.training_documents(docs, labels, F.lit(True))


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_leave_columns_of_any_name_alone(spark, tables, stage):
    docs, more, _ = tables
    run = dict(corpus_pipeline.STAGES)[stage]
    got = run(spark, more, SF001)
    assert got.columns == more.columns
    assert plain(got.select(*docs.columns)) == plain(run(spark, docs, SF001))
    assert got.select(*CLASHING).distinct().collect() == [tuple(["mine"] * len(CLASHING))]
