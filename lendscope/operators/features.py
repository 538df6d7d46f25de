"""Feature preparation with ``pyspark.ml``: category indexes, one-hot, assembly, scaling.

Estimators are multi-column and fitted once (the notebook fitted eleven
indexers one after another, each seeing rows the previous one had skipped).
Label columns never enter a feature list (see :func:`guard_features`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
import warnings
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABEL_COPIES = ("target", "indebt")


def guard_features(features: Sequence[str], label: str = "target",
                   copies: Sequence[str] = LABEL_COPIES) -> list[str]:
    """Raise if the label or a copy of it is among the features."""
    leaked = [c for c in features if c == label or c in copies]
    if leaked:
        raise ValueError(f"label leakage: {leaked} in feature list")
    return list(features)


#: Partitions of a fit's input: at least so many, and one for every so many rows. Part of the fit; it
#: follows from the data, never from the cluster's cores.
FIT_PARTITIONS = 8
FIT_PARTITION_ROWS = 1 << 18
#: Rows of a partition of the boosted trees. Every round stores two new columns, and measuring a stored
#: partition costs Spark as much as a quarter of the work on 2^18 rows, however many rows it holds.
BOOST_PARTITION_ROWS = 1 << 20


def partitions_for(rows: int, rows_each: int = FIT_PARTITION_ROWS) -> int:
    """Partitions of a fit over ``rows`` rows."""
    return max(FIT_PARTITIONS, -(-rows // rows_each))


def persist_for_fit(df: DataFrame, key: str = "id", partitions: int = FIT_PARTITIONS,
                    level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Persist the input of an iterative fit in ``partitions`` parts by a hash of ``key``, each in
    key order.

    Iterative estimators pass over their input many times, one task per partition, and seeded
    ones sample by partition and position. The explicit count and order make the model follow
    from the data and this parameter alone, whatever the cluster; take it from
    :func:`partitions_for` the number of rows. Nothing runs before the first action; lost cached
    blocks are recomputed from the plan.
    """
    return df.repartition(partitions, key).sortWithinPartitions(key).persist(level)


def fit_concurrently(spark, tasks: Sequence[Callable], parallelism: int = 4) -> list:
    """Run independent fits from a thread pool and return their results in order.

    Each fit is a chain of small distributed jobs whose time is mostly per-job
    overhead, so several fits at once keep the executors busy; this is what
    ``CrossValidator(parallelism=n)`` does. Fits must not depend on each other
    (seeded estimators give the same models in any order).
    """
    tasks = list(tasks)
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    pool = ThreadPool(processes=min(parallelism, len(tasks)))
    try:
        return pool.map(lambda t: t(), [_own_local_properties(t) for t in tasks])
    finally:
        pool.close()


def _own_local_properties(task: Callable) -> Callable:
    """Run ``task`` in a pool thread with its own copy of the caller's local properties.

    Wrapping each task separately gives each its own copy; one copy shared by all
    threads (what the session form of ``inheritable_thread_target`` installs) lets
    one fit's SQL execution id change under another's. No job tags are set here,
    so the warning that tags are not inherited does not apply.
    """
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        return inheritable_thread_target(task)


def as_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Category columns as text (a year is a category, not a magnitude)."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def index_categories(df: DataFrame, cols: Sequence[str], suffix: str = "_index",
                     handle_invalid: str = "skip", order: str = "frequencyDesc"):
    """Fit one multi-column StringIndexer; return (model, transformed frame).

    Indexes follow label frequency (most frequent = 0), ties alphabetical.
    With ``skip``, rows whose value is NULL or unseen in any column are dropped.
    The fit gathers one (label, count) table per column on the driver, so it is
    meant for category columns (bounded distinct values), not free text.
    """
    idx = StringIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols],
                        handleInvalid=handle_invalid, stringOrderType=order)
    model = idx.fit(df)
    return model, model.transform(df)


def one_hot(df: DataFrame, index_cols: Sequence[str], suffix: str = "_onehot",
            drop_last: bool = True):
    enc = OneHotEncoder(inputCols=list(index_cols), outputCols=[c + suffix for c in index_cols],
                        dropLast=drop_last)
    model = enc.fit(df)
    return model, model.transform(df)


def hot_position(vec_col: str) -> F.Column:
    """Position of the 1 in a one-hot vector, or -1 when it is all zeros (the dropped last level)."""
    return (F.array_position(vector_to_array(F.col(vec_col)), 1.0) - 1).cast("int")


def vector_width(vec_col: str) -> F.Column:
    return F.size(vector_to_array(F.col(vec_col))).cast("int")


def assemble_scale(df: DataFrame, cols: Sequence[str], raw_col: str = "features_raw",
                   scaled_col: str = "features_scaled", with_mean: bool = False,
                   handle_invalid: str = "error") -> tuple[PipelineModel, DataFrame]:
    """VectorAssembler + StandardScaler (unit sample std; no centring by default).

    Input and output names differ (the notebook's ``Features``/``features`` only
    differed by case, and the scaler replaced its own input).
    """
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(cols), outputCol=raw_col, handleInvalid=handle_invalid),
        StandardScaler(inputCol=raw_col, outputCol=scaled_col, withStd=True, withMean=with_mean),
    ])
    model = pipe.fit(df)
    return model, model.transform(df)


def unpack(df: DataFrame, vec_col: str, names: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Vector elements as named double columns."""
    arr = vector_to_array(F.col(vec_col))
    cols = {}
    for i, n in enumerate(names):
        v = arr[i]
        cols[n] = F.round(v, digits) if digits is not None else v
    return df.withColumns(cols)


def full_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], scaled_col: str = "features_scaled",
                  raw_col: str = "features_raw") -> tuple[PipelineModel, DataFrame]:
    """The whole feature vector: categories indexed and one-hot encoded, joined with the numeric
    columns, scaled to unit deviation. Rows with a NULL category are dropped before the fit of
    the later stages, as the indexer skips them. An empty text is a category of its own, named
    ``(empty)`` (an encoded category must have a name)."""
    named = [c + "_named" for c in categorical]
    indexed = [c + "_index" for c in named]
    hot = [c + "_onehot" for c in indexed]
    texts = {n: F.when(F.col(c).cast("string") == "", F.lit("(empty)")).otherwise(F.col(c).cast("string")) for n, c in zip(named, categorical, strict=True)}
    indexer, known = index_categories(df.withColumns(texts), named)
    pipe = Pipeline(stages=[
        OneHotEncoder(inputCols=indexed, outputCols=hot),
        VectorAssembler(inputCols=[*numeric, *hot], outputCol=raw_col),
        StandardScaler(inputCol=raw_col, outputCol=scaled_col, withStd=True, withMean=False)])
    model = pipe.fit(known)
    return PipelineModel(stages=[indexer, *model.stages]), model.transform(known).drop(*named)
