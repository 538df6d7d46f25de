"""Feature, clustering and model queries over the curated loan frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendscope.constants import (
    ELBOW_KS, LR_REG_PARAMS, SPLIT_TRAIN_TEST, SPLIT_TRAIN_TEST_VALIDATION,
)
from lendscope.functions.parse import cast_columns
from lendscope.operators import cluster, derive, features, grid, metrics, models, subspace, sweep
from lendscope.operators.columns import feature_columns
from lendscope.operators.rows import split_frames, stable_split
from lendscope.plans import curate
from lendscope.plans.catalog import register
from lendscope.plans.queries_io import _CURATED_SQL
from lendscope.session import materialize, scratch_path
from lendscope.sources.fixtures import loans_view, sql_is_missing, with_loans
from lendscope.sources.tables import read_table

CATS = ("grade", "sub_grade", "purpose", "addr_state", "issue_d_year")
NUMERIC = ("loan_amnt", "int_rate", "annual_inc", "dti", "delinq_2yrs", "emplength_clean",
           "term_clean", "tot_coll_amt_clean", "tot_cur_bal_clean")
SCALE_COLS = ("loan_amnt", "int_rate", "annual_inc")
_CUR = "cur AS (" + _CURATED_SQL + ")"


def model_frame(spark, sf_dir):
    """Curated loans with the remaining numeric text typed (P9) and categories as text."""
    df = curate.curate(loans_view(spark, sf_dir))
    df = cast_columns(df, ["dti", "delinq_2yrs"], "double").na.fill(0, ["dti", "delinq_2yrs"])
    return features.as_text(df, ["issue_d_year"])


def numeric_features(frame, categorical=CATS):
    """Numeric feature names by the frame's own schema, without the id, the label and the categories."""
    return tuple(feature_columns(frame, "target", ["id"], categorical))


def _label_sql(cols):
    lab = " UNION ALL ".join(f"SELECT '{c}' AS c, CAST({c} AS VARCHAR) AS v FROM cur" for c in cols)
    return (f"lab AS ({lab})",
            "cnt AS (SELECT c, v, count(*) AS n FROM lab WHERE v IS NOT NULL GROUP BY c, v)",
            "idx AS (SELECT c, v, CAST(row_number() OVER (PARTITION BY c ORDER BY n DESC, v) - 1 AS DOUBLE) AS i, "
            "count(*) OVER (PARTITION BY c) AS k FROM cnt)")


def _index_sql(cols, select):
    joins = " ".join(f"JOIN idx j_{c} ON j_{c}.c = '{c}' AND j_{c}.v = CAST(cur.{c} AS VARCHAR)" for c in cols)
    return with_loans(f"SELECT {select} FROM cur {joins}", _CUR, *_label_sql(cols))


@register("index_categories", _index_sql(CATS, "cur.id, " + ", ".join(f"j_{c}.i AS {c}_index" for c in CATS)))
def index_categories(spark, sf_dir):
    _, out = features.index_categories(model_frame(spark, sf_dir), CATS)
    return out.select("id", *[c + "_index" for c in CATS])


_HOT = ("grade", "purpose")


@register("one_hot", _index_sql(_HOT, "cur.id, " + ", ".join(
    f"CAST(CASE WHEN j_{c}.i < j_{c}.k - 1 THEN j_{c}.i ELSE -1 END AS INTEGER) AS {c}_hot, "
    f"CAST(j_{c}.k - 1 AS INTEGER) AS {c}_width" for c in _HOT)))
def one_hot(spark, sf_dir):
    _, idx = features.index_categories(model_frame(spark, sf_dir), _HOT)
    _, hot = features.one_hot(idx, [c + "_index" for c in _HOT])
    return hot.select("id", *[x for c in _HOT for x in (
        features.hot_position(c + "_index_onehot").alias(c + "_hot"),
        features.vector_width(c + "_index_onehot").alias(c + "_width"))])


@register("guarded_features", with_loans(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg(CAST({c} AS DOUBLE)), 4) AS mean FROM typed"
    for c in ("loan_amnt", "int_rate", "dti", "delinq_2yrs", "annual_inc", "emplength_clean", "term_clean", "tot_coll_amt_clean", "tot_cur_bal_clean")),
    _CUR, "typed AS (SELECT * REPLACE (coalesce(TRY_CAST(dti AS DOUBLE), 0) AS dti, coalesce(TRY_CAST(delinq_2yrs AS DOUBLE), 0) AS delinq_2yrs) FROM cur)"))
def guarded_features(spark, sf_dir):
    """The numeric features of a frame that holds the label twice (``target`` and its copy ``indebt``),
    with their means: neither of the two is among them."""
    frame = model_frame(spark, sf_dir).withColumn("indebt", F.col("target").cast("double"))
    names = features.guard_features(feature_columns(frame, "target", ["id"], CATS, features.LABEL_COPIES))
    means = frame.agg(*[F.round(F.avg(c), 4).alias(c) for c in names])
    return means.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("mean")) for c in names])))


@register("assemble_scale", with_loans(
    "SELECT id, " + ", ".join(f"round({c} / stddev_samp({c}) OVER (), 6) AS {c}_scaled" for c in SCALE_COLS)
    + " FROM cur", _CUR))
def assemble_scale(spark, sf_dir):
    _, out = features.assemble_scale(model_frame(spark, sf_dir), SCALE_COLS)
    return features.unpack(out, "features_scaled", [c + "_scaled" for c in SCALE_COLS]).select(
        "id", *[c + "_scaled" for c in SCALE_COLS])


_BITS = "CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':21'), 1, 8)) AS BIGINT)"
_TRAIN = f"{_BITS} < {round((1 << 32) * 0.7)}"


@register("stable_split", with_loans(
    f"SELECT id, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS split FROM cur", _CUR))
def stable_split_q(spark, sf_dir):
    return stable_split(model_frame(spark, sf_dir), SPLIT_TRAIN_TEST, "id", 21, ["train", "test"]).select("id", "split")


@register("class_balance", with_loans(
    f"SELECT CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS split, target, count(*) AS n "
    "FROM cur GROUP BY 1, 2 ORDER BY 1, 2", _CUR))
def class_balance(spark, sf_dir):
    df = stable_split(model_frame(spark, sf_dir), SPLIT_TRAIN_TEST, "id", 21, ["train", "test"])
    return df.groupBy("split", "target").agg(F.count(F.lit(1)).alias("n")).orderBy("split", "target")


_MODEL_COLS = ("id", "target") + NUMERIC + CATS


def _fit_frame(spark, sf_dir, cols=_MODEL_COLS):
    """The columns a fit needs, persisted for iterative fits.

    Selecting before persisting lets Catalyst skip the other derived columns and
    keeps the cache small. Callers fit on it, then unpersist it; the frame they
    return is lazy and reads from the plan again, so no cache outlives the query.
    """
    return features.persist_for_fit(model_frame(spark, sf_dir).select(*{"id": 0} | dict.fromkeys(cols)),
                                    partitions=_partitions(spark, sf_dir))


def _partitions(spark, sf_dir, rows_each=features.FIT_PARTITION_ROWS):
    """Partitions of a fit, by the orders in the files' footers: no loan is without an order."""
    return features.partitions_for(read_table(spark, sf_dir, "orders").count(), rows_each)


def _scaled(frame, cols=NUMERIC):
    _, out = features.assemble_scale(frame, cols)
    return out


_CLUSTER_COLS = ("id",) + NUMERIC + CATS


def _cluster_frame(spark, sf_dir):
    """The columns of the clustering vector, computed once for the passes of its scaling and the fits."""
    return materialize(model_frame(spark, sf_dir).select(*_CLUSTER_COLS).repartition(_partitions(spark, sf_dir), "id"), "cluster-columns")


def _vectors(frame):
    """The whole feature vector: one-hot categories and numbers, scaled."""
    _, out = features.full_features(frame, numeric_features(frame), CATS)
    return out


def _vector_sql():
    hot = "".join(f" + CASE WHEN j_{c}.i < j_{c}.k - 1 THEN 1.0 / sqrt(CAST(h_{c}.n AS DOUBLE) * (tot.n - h_{c}.n) "
                  f"/ (CAST(tot.n AS DOUBLE) * (tot.n - 1))) ELSE 0 END" for c in CATS)
    nonzero = " + ".join([f"CASE WHEN v.{c} <> 0 THEN 1 ELSE 0 END" for c in NUMERIC]
                         + [f"CASE WHEN j_{c}.i < j_{c}.k - 1 THEN 1 ELSE 0 END" for c in CATS])
    joins = " ".join(f"JOIN idx j_{c} ON j_{c}.c = '{c}' AND j_{c}.v = CAST(v.{c} AS VARCHAR) "
                     f"JOIN (SELECT CAST({c} AS VARCHAR) AS x, count(*) AS n FROM v GROUP BY 1) h_{c} "
                     f"ON h_{c}.x = CAST(v.{c} AS VARCHAR)" for c in CATS)
    known = " AND ".join(f"{c} IS NOT NULL" for c in CATS)
    typed = ", ".join(f"coalesce(TRY_CAST({c} AS DOUBLE), 0) AS {c}" if c in ("dti", "delinq_2yrs") else c
                      for c in NUMERIC)
    stds = ", ".join(f"stddev_samp({c}) AS {c}" for c in NUMERIC)
    numbers = " + ".join(f"v.{c} / s.{c}" for c in NUMERIC)
    width = f"{len(NUMERIC)} + " + " + ".join(f"j_{c}.k - 1" for c in CATS)
    return with_loans(
        f"SELECT v.id, CAST({width} AS INTEGER) AS width, {nonzero} AS n_nonzero, round({numbers}{hot}, 4) AS checksum "
        f"FROM v CROSS JOIN s CROSS JOIN tot {joins}",
        _CUR, *_label_sql(CATS), f"v AS (SELECT id, {typed}, {', '.join(CATS)} FROM cur WHERE {known})",
        f"s AS (SELECT {stds} FROM v)", "tot AS (SELECT count(*) AS n FROM v)")


@register("feature_vectors", _vector_sql())
def feature_vectors(spark, sf_dir):
    """Width, non-zero entries and sum of each row's whole scaled vector."""
    frame = model_frame(spark, sf_dir).select(*_CLUSTER_COLS)
    values = F.col("_v")
    out = _vectors(frame).withColumn("_v", features.vector_to_array("features_scaled"))
    return out.select("id", F.size(values).cast("int").alias("width"),
                      F.size(F.filter(values, lambda x: x != 0)).cast("int").alias("n_nonzero"),
                      F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 4).alias("checksum"))


@register("elbow")
def elbow(spark, sf_dir):
    """Within-cluster squares for every k, from passes that all of them share."""
    return sweep.elbow_sweep(spark, _vectors(_cluster_frame(spark, sf_dir)), ELBOW_KS)


def _width_sql():
    return f"({len(NUMERIC)} + (SELECT sum(k - 1) FROM (SELECT c, count(*) AS k FROM cnt GROUP BY c)))"


_KNOWN = " AND ".join(f"{c} IS NOT NULL" for c in CATS)


@register("elbow_baseline", with_loans(
    f"SELECT 1 AS k, round(CAST((count(*) - 1) * {_width_sql()} AS DOUBLE), 2) AS wcss FROM cur WHERE {_KNOWN}", _CUR, *_label_sql(CATS)))
def elbow_baseline(spark, sf_dir):
    """The sweep's k = 1: every scaled feature has unit variance, so its squares follow from the counts."""
    out = sweep.elbow_sweep(spark, _vectors(_cluster_frame(spark, sf_dir)), [1])
    return out.withColumn("wcss", F.round("wcss", 2))


@register("kmeans_assign")
def kmeans_assign(spark, sf_dir):
    """Each loan's cluster among 3 and among 20, both fitted in shared passes."""
    rows = sweep.as_arrays(_vectors(_cluster_frame(spark, sf_dir)), "features_scaled")
    found = sweep.sweep_kmeans(rows, (3, 20))
    return sweep.assign_all(rows, {"cluster": found[3][0], "cluster_20": found[20][0]}).withColumnRenamed("key", "id")


@register("sweep_assign", with_loans(
    f"SELECT k, count(*) AS n, 0 AS n_centres_off, TRUE AS same_squares FROM cur, (VALUES (3), (20)) AS t(k) WHERE {_KNOWN} GROUP BY k", _CUR))
def sweep_assign(spark, sf_dir):
    """The sweep checked by plain differences: every row is assigned to its nearest final centre; the
    squared distances must add up to what the shared passes found, and moving each centre to the
    mean of its rows must not raise them (centres for which it would: 0)."""
    rows = sweep.as_arrays(_vectors(_cluster_frame(spark, sf_dir)), "features_scaled")
    parts = []
    for k, (centres, wcss) in sorted(sweep.sweep_kmeans(rows, (3, 20)).items()):
        per = sweep.spread(sweep.assign(rows, centres), centres)
        parts.append(per.agg(F.lit(k).alias("k"), F.sum("n").alias("n"),
                             F.count_if(F.col("around_mean") > F.col("squares") * (1 + 1e-9) + 1e-9).cast("int").alias("n_centres_off"),
                             (F.abs(F.sum("squares") - F.lit(wcss)) < 1e-6 * wcss).alias("same_squares")))
    return parts[0].unionByName(parts[1])


@register("pca_project")
def pca_project(spark, sf_dir):
    """The first two components' scores, by block Krylov iteration over sparse rows."""
    rows, width = _sparse(spark, sf_dir)
    return subspace.project(rows, subspace.principal_components(rows, width, 2)).withColumnRenamed("key", "id")


def _sparse(spark, sf_dir):
    """The whole scaled vector as sparse rows, and its width."""
    data = _vectors(_cluster_frame(spark, sf_dir))
    width = data.schema["features_scaled"].metadata["ml_attr"]["num_attrs"]
    return materialize(subspace.sparse_rows(data, "features_scaled"), "pca-rows"), width


@register("pca_facts", with_loans(
    f"SELECT 3 AS k, round(CAST({_width_sql()} AS DOUBLE), 6) AS total_variance, 0 AS n_not_orthonormal, 0 AS n_not_eigen", _CUR, *_label_sql(CATS)))
def pca_facts(spark, sf_dir):
    """What principal components must satisfy: the total variance of the scaled vector is its width,
    the components are orthonormal, and the scatter matrix only stretches them (one more pass)."""
    rows, width = _sparse(spark, sf_dir)
    found = subspace.principal_components(rows, width, 3)
    return subspace.facts(spark, rows, found)


@register("explained_variance_subspace", with_loans("""
SELECT 1 AS component, round((1 + abs(r)) / 2, 6) AS ratio, round((1 + abs(r)) / 2, 6) AS cumulative FROM rr
UNION ALL
SELECT 2 AS component, round((1 - abs(r)) / 2, 6) AS ratio, 1.0 AS cumulative FROM rr
""", _CUR, "rr AS (SELECT corr(loan_amnt, int_rate) AS r FROM cur)"))
def explained_variance_subspace(spark, sf_dir):
    scaled = _scaled(model_frame(spark, sf_dir).select("id", "loan_amnt", "int_rate"), ("loan_amnt", "int_rate"))
    return subspace.explained(spark, subspace.principal_components(subspace.sparse_rows(scaled, "features_scaled"), 2, 2))


@register("explained_variance", with_loans("""
SELECT 1 AS component, round((1 + abs(r)) / 2, 6) AS ratio, round((1 + abs(r)) / 2, 6) AS cumulative FROM rr
UNION ALL
SELECT 2 AS component, round((1 - abs(r)) / 2, 6) AS ratio, 1.0 AS cumulative FROM rr
""", _CUR, "rr AS (SELECT corr(loan_amnt, int_rate) AS r FROM cur)"))
def explained_variance(spark, sf_dir):
    frame = _fit_frame(spark, sf_dir, ("loan_amnt", "int_rate"))
    try:
        model = cluster.fit_pca(_scaled(frame, ("loan_amnt", "int_rate")), 2)
    finally:
        frame.unpersist()
    return cluster.explained_variance(spark, model)


def _gbt(spark, sf_dir):
    """The model of the training part, weighted by that part's balance, and the test part as a plan
    of its own, without the fit's repartition. Only the training part is persisted: the fit's own
    passes neither split the rows again nor share their memory with the test part."""
    train, test = split_frames(model_frame(spark, sf_dir).select(*_MODEL_COLS), SPLIT_TRAIN_TEST, "id", 21, ["train", "test"])
    train = features.persist_for_fit(train, partitions=_partitions(spark, sf_dir, features.BOOST_PARTITION_ROWS))
    try:
        model = models.fit_gbt(models.with_balance_weight(train), numeric_features(train), CATS)
    finally:
        train.unpersist()
    return model, test


@register("gbt_scores")
def gbt_scores(spark, sf_dir):
    model, test = _gbt(spark, sf_dir)
    return models.score_column(model.transform(test)).select("id", "target", "prediction", "score")


@register("feature_importance")
def feature_importance(spark, sf_dir):
    model, _ = _gbt(spark, sf_dir)
    return models.feature_importance(spark, model)


@register("split_counts")
def split_counts(spark, sf_dir):
    """How often each feature splits a node, from the saved model's node table."""
    model, _ = _gbt(spark, sf_dir)
    return models.split_counts(spark, model, models.save_model(model, scratch_path(spark, "gbt_nodes")))


@register("scores_by_nodes", with_loans(
    f"SELECT count(*) AS n_scored, 0 AS n_differing FROM cur WHERE NOT ({_TRAIN})", _CUR))
def scores_by_nodes(spark, sf_dir):
    """The test part scored by joins with the saved node table; rows scored and rows whose score is not
    the model's."""
    model, test = _gbt(spark, sf_dir)
    path = models.save_model(model, scratch_path(spark, "gbt_nodes"))
    scored = materialize(models.score_column(model.transform(test), name="own").select("id", "features", "own"), "gbt-scored")
    both = scored.join(models.score_by_nodes(spark, path, scored), "id", "left")
    return both.agg(F.count(F.lit(1)).alias("n_scored"),
                    F.count_if(F.col("score").isNull() | (F.abs(F.col("score") - F.col("own")) > 1e-9)).cast("int").alias("n_differing"))


@register("model_round_trip", with_loans(
    f"SELECT count(*) AS n_scored, 0 AS n_differing FROM cur WHERE NOT ({_TRAIN})", _CUR))
def model_round_trip(spark, sf_dir):
    """Save the fitted pipeline to shared storage, load it, score the test part with both; rows
    scored and rows whose scores differ."""
    model, test = _gbt(spark, sf_dir)
    loaded = models.load_model(models.save_model(model, scratch_path(spark, "gbt_model")))
    once = models.score_column(model.transform(test), name="score").select(*_MODEL_COLS, "score")
    both = models.score_column(loaded.transform(once), name="again")
    return both.agg(F.count(F.lit(1)).alias("n_scored"),
                    F.count_if(~F.col("score").eqNullSafe(F.col("again"))).cast("int").alias("n_differing"))


@register("stable_split_3way", with_loans(
    "SELECT id, CASE " + " ".join(
        f"WHEN {_BITS.replace(':21', ':123')} < {round((1 << 32) * hi)} THEN '{name}'"
        for name, hi in zip(("train", "test"), (SPLIT_TRAIN_TEST_VALIDATION[0] / sum(SPLIT_TRAIN_TEST_VALIDATION),
                                                sum(SPLIT_TRAIN_TEST_VALIDATION[:2]) / sum(SPLIT_TRAIN_TEST_VALIDATION)), strict=True))
    + " ELSE 'validation' END AS split FROM cur", _CUR))
def stable_split_3way(spark, sf_dir):
    return stable_split(model_frame(spark, sf_dir), SPLIT_TRAIN_TEST_VALIDATION, "id", 123,
                        ["train", "test", "validation"]).select("id", "split")


@register("cast_numbers", with_loans("""
SELECT id, TRY_CAST(dti AS DOUBLE) AS dti, TRY_CAST(delinq_2yrs AS DOUBLE) AS delinq_2yrs FROM loans
"""))
def cast_numbers(spark, sf_dir):
    return cast_columns(loans_view(spark, sf_dir), ["dti", "delinq_2yrs"], "double").select("id", "dti", "delinq_2yrs")


@register("classification_report", with_loans("""
SELECT n, 0 AS n_skipped, tp, fp, tn, fn,
       round((tp + tn) / n, 6) AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN tp > 0 THEN 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1,
       (SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) FROM ranked) AS auc
FROM (SELECT count(*) AS n,
             count(*) FILTER (WHERE target = 1 AND prediction = 1) AS tp,
             count(*) FILTER (WHERE target = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE target = 0 AND prediction = 0) AS tn,
             count(*) FILTER (WHERE target = 1 AND prediction = 0) AS fn FROM scored)
""", _CUR,
    "scored AS (SELECT target, int_rate / 30.0 AS score, CASE WHEN int_rate >= 15 THEN 1.0 ELSE 0.0 END AS prediction FROM cur)",
    "per AS (SELECT score, sum(target) AS pos, sum(1 - target) AS neg FROM scored GROUP BY score)",
    "ranked AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM per)"))
def classification_report_q(spark, sf_dir):
    """A rule score (interest rate / 30, flag at 15%) graded against the default label."""
    df = model_frame(spark, sf_dir).select(
        "target", (F.col("int_rate") / F.lit(30.0)).alias("score"),
        F.when(F.col("int_rate") >= 15, F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"))
    return metrics.classification_report(df, "target", "prediction", "score")


def _lr_parts(frame):
    return split_frames(frame, SPLIT_TRAIN_TEST_VALIDATION, "id", 123, ["train", "test", "validation"])


#: Free text planted beside the curated columns: many values, so it is split into tokens.
_NOTES = "concat_ws(' ', 'loan for', lower(purpose), 'in', addr_state, CAST(id % 97 AS STRING), purpose)"
_NOTES_SQL = "'loan for ' || lower(purpose) || ' in ' || addr_state || ' ' || CAST(id % 97 AS VARCHAR) || ' ' || purpose"
_DERIVED = {"loan_amnt": "double", "int_rate": "double", "grade": "string", "sub_grade": "string", "addr_state": "string", "dti": "string",
            "delinq_2yrs": "string", "annual_inc": "double", "purpose": "string", "issue_d_year": "int", "emplength_clean": "int",
            "term_clean": "int", "tot_coll_amt_clean": "double", "tot_cur_bal_clean": "double", "notes": "string"}


def _schema_frame(spark, sf_dir):
    """Curated loans as they are, with a free text, written once; the features follow from the schema."""
    frame = curate.curate(loans_view(spark, sf_dir)).selectExpr("id", "target", *[c for c in _DERIVED if c != "notes"], f"{_NOTES} AS notes")
    return materialize(frame.repartition(_partitions(spark, sf_dir), "id"), "derive-columns")


_DERIVED_CTE = f"der AS MATERIALIZED (SELECT id, target, {', '.join(c for c in _DERIVED if c != 'notes')}, {_NOTES_SQL} AS notes FROM cur)"


def _routes_sql():
    parts = []
    for i, (c, t) in enumerate(_DERIVED.items()):
        x, missing = (f"TRY_CAST({c} AS DOUBLE)" if t == "string" else f"CAST({c} AS DOUBLE)"), sql_is_missing(c, t)
        text = f"WHEN parsed < {derive.NUMBER_SHARE} * known OR parsed = 0 THEN CASE WHEN n_distinct <= {derive.ONE_HOT_VALUES} THEN 'category' ELSE 'tokens' END"
        parts.append(f"SELECT {i + 2} AS position, '{c}' AS column_name, CASE WHEN n_distinct < 2 THEN 'none' {text if t == 'string' else ''} "
                     f"WHEN sd > 0 THEN 'number' ELSE 'none' END AS route, n_distinct, n_missing FROM (SELECT count(DISTINCT {c}) AS n_distinct, "
                     f"count(*) FILTER ({missing}) AS n_missing, count(*) FILTER (NOT ({missing})) AS known, count({x}) AS parsed, stddev_samp({x}) AS sd FROM der)")
    return with_loans(" UNION ALL ".join(parts), _CUR, _DERIVED_CTE)


@register("feature_routes", _routes_sql())
def feature_routes(spark, sf_dir):
    """What each curated column becomes, by its type and its distinct values."""
    return derive.routes_table(spark, derive.derive_routes(_schema_frame(spark, sf_dir)))


def _derived_sql(width=derive.HASHED_FEATURES):
    """Entries and checksum per row by the routes that ``feature_routes`` confirms."""
    def hashed(name):
        return (f"((('0x' || substr(md5({name}), 1, 8))::BIGINT % {width} % 97 + 1) * CASE WHEN substr(md5({name}), 9, 1) >= '8' THEN -1 ELSE 1 END)")

    def fixed(name):
        slot, sign = derive.slot_and_sign(name, width)
        return (slot % 97 + 1) * sign

    counts, sums, stds = [], [], []
    for c, t in _DERIVED.items():
        missing = sql_is_missing(c, t)
        if c == "notes":
            tokens = f"[u FOR u IN string_split_regex(lower({c}), '[^\\p{{L}}\\p{{N}}]+') IF u <> '']"
            counts.append(f"CASE WHEN {missing} THEN 1 ELSE len(list_distinct({tokens})) END")
            sums.append(f"CASE WHEN {missing} THEN {fixed(c + '=missing')} ELSE list_sum([{hashed(f"'{c}=' || u")} FOR u IN {tokens}]) END")
        elif t == "string" and c not in ("dti", "delinq_2yrs"):
            counts.append("1")
            sums.append(f"CASE WHEN {missing} THEN {fixed(c + '=missing')} ELSE {hashed(f"'{c}=' || {c}")} END")
        else:
            x = f"TRY_CAST({c} AS DOUBLE)"
            stds.append(f"stddev_samp({x}) AS {c}")
            counts.append(f"CASE WHEN {x} = 0 THEN 0 ELSE 1 END")
            sums.append(f"CASE WHEN {x} IS NULL THEN {fixed(c + '=missing')} ELSE {fixed(c)} * {x} / sd.{c}_sd END")
    stds = [e + "_sd" for e in stds]
    body = "SELECT id, CAST(" + " + ".join(counts) + " AS INTEGER) AS n_entries, round(" + " + ".join(sums) + ", 4) AS checksum FROM der, sd"
    return with_loans(body, _CUR, _DERIVED_CTE, f"sd AS (SELECT {', '.join(stds)} FROM der)")


@register("derived_features", _derived_sql())
def derived_features(spark, sf_dir):
    """Number of entries of each row's derived vector and the sum of its values by weights of the slots."""
    frame = _schema_frame(spark, sf_dir)
    out = derive.hashed_features(frame, derive.derive_routes(frame), ["id"])
    return out.select("id", F.size("at").cast("int").alias("n_entries"), F.round(F.aggregate(
        F.zip_with("at", "value", lambda a, v: (a % 97 + 1) * v), F.lit(0.0), lambda s, x: s + x), 4).alias("checksum"))


def _grid(spark, sf_dir, tol=1e-5):
    """The grid's models of the training part, and the hashed parts. The routes come from the training
    part alone."""
    parts = _lr_parts(_schema_frame(spark, sf_dir))
    routes = derive.derive_routes(parts[0])
    train, test, validation = [materialize(derive.hashed_features(p, routes), "grid-part") for p in parts]
    return grid.fit_grid(train, derive.HASHED_FEATURES, LR_REG_PARAMS, tol=tol), train, test, validation


def _leaderboard(fitted, test):
    scored = materialize(grid.score_grid(test, fitted), "grid-scores")
    return [(m.reg_param, metrics.auc(scored, "target", f"score_{j}")) for j, m in enumerate(fitted)]


@register("lr_grid_leaderboard")
def lr_grid_leaderboard(spark, sf_dir):
    """AUC on the test part for every penalty; the grid is fitted in shared passes."""
    fitted, _, test, _ = _grid(spark, sf_dir)
    return spark.createDataFrame(_leaderboard(fitted, test), "reg_param double, auc double")


_TRAIN_60 = f"{_BITS.replace(':21', ':123')} < {round((1 << 32) * SPLIT_TRAIN_TEST_VALIDATION[0] / sum(SPLIT_TRAIN_TEST_VALIDATION))}"


@register("lr_grid_slopes", with_loans(
    f"SELECT CAST(r AS DOUBLE) AS reg_param, count(*) AS n, 0 AS n_slopes_off FROM cur, (VALUES {', '.join(f'({r})' for r in LR_REG_PARAMS)}) AS t(r) "
    f"WHERE {_TRAIN_60} GROUP BY r", _CUR))
def lr_grid_slopes(spark, sf_dir):
    """Each penalty's objective is convex, so its minimum is where all slopes vanish: slots and
    intercepts whose slope at the fitted coefficients, summed over the training part, is not zero (0)."""
    fitted, train, _, _ = _grid(spark, sf_dir, 1e-7)
    return grid.slopes_off(spark, train, fitted, 1e-6)


@register("best_model_validation")
def best_model_validation(spark, sf_dir):
    """The report of the best model by test AUC on the validation part."""
    fitted, _, test, validation = _grid(spark, sf_dir)
    board = _leaderboard(fitted, test)
    best = max(range(len(board)), key=lambda j: (board[j][1] is not None, board[j][1] or 0))
    scored = grid.score_grid(validation, [fitted[best]]).withColumnRenamed("score_0", "score")
    return metrics.classification_report(scored.withColumn("prediction", (F.col("score") > 0.5).cast("double")), "target", "prediction", "score")


@register("leakage_guard_auc")
def leakage_guard_auc(spark, sf_dir):
    """Logistic model on columns that carry no trace of the label: AUC should be near 0.5."""
    frame = _fit_frame(spark, sf_dir)
    try:
        train, test, _ = _lr_parts(frame)
        cols = ("loan_amnt", "grade", "sub_grade", "addr_state", "purpose")
        fitted = models.train_lr_grid(train, cols, [0.1])
        _, board = models.pick_best(spark, fitted, test)
    finally:
        frame.unpersist()
    return board
