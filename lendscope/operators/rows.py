"""Row selection by a stable hash: development subsets and train/test splits.

``randomSplit`` and ``sample`` depend on how the input happens to be partitioned,
so a recomputed partition (after a lost executor) or a re-run on another
cluster can move rows between parts. A bucket computed from the row key and a
seed is the same everywhere (and the same in DuckDB), needs no shuffle, and
keeps every part whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bits(key: str | Column, seed: int) -> Column:
    """0..2^32-1: the first 32 bits of md5(key || ':' || seed)."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: str | Column, seed: int, buckets: int = 100) -> Column:
    """0..buckets-1 from :func:`hash_bits`."""
    return (hash_bits(key, seed) % buckets).cast("int")


def dev_subset(df: DataFrame, key: str = "id", percent: int = 10, seed: int = 0) -> DataFrame:
    """A reproducible ~``percent``% sample for development runs (no shuffle, no driver)."""
    return df.where(hash_bucket(key, seed) < percent)


def stable_split(df: DataFrame, weights: Sequence[float], key: str = "id", seed: int = 21,
                 names: Sequence[str] | None = None, split_col: str = "split") -> DataFrame:
    """Tag each row with the name of its part. The 2^32 hash values are cut at the running shares
    of the weights, so a part with a positive weight, however small, is not rounded away."""
    names = list(names or [f"part{i}" for i in range(len(weights))])
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        acc += w
        bounds.append(int(round((1 << 32) * acc / total)))
    b = hash_bits(key, seed)
    part = F.lit(names[-1])
    for name, hi in reversed(list(zip(names[:-1], bounds[:-1]))):
        part = F.when(b < hi, F.lit(name)).otherwise(part)
    return df.withColumn(split_col, part)


def split_frames(df: DataFrame, weights: Sequence[float], key: str = "id", seed: int = 21,
                 names: Sequence[str] | None = None, method: str = "hash") -> list[DataFrame]:
    """The parts of :func:`stable_split` as frames. ``method="random"`` is Spark's ``randomSplit``
    instead: parts of the same expected sizes that depend on how ``df`` is partitioned."""
    if method == "random":
        return df.randomSplit([float(w) for w in weights], seed)
    if method != "hash":
        raise ValueError(f"unknown split method {method!r}")
    tagged = stable_split(df, weights, key, seed, names, "_split")
    names = list(names or [f"part{i}" for i in range(len(weights))])
    return [tagged.where(F.col("_split") == n).drop("_split") for n in names]


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows (by ``order_by`` when given: a top-n, one partial sort per task).

    A preview is where a limit is the feature; it never stands in for a whole result.
    """
    return (df.orderBy(*order_by) if order_by else df).limit(n)
