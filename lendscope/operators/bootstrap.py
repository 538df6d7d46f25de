"""Bootstrap intervals in one aggregate, the same on any partitioning.

A Poisson bootstrap: in each replicate every row counts 0, 1, 2, ... times, an independent Poisson
draw of mean one, which is what sampling with replacement tends to for many rows. The draw is read
from the bits of an md5 of the row's key and the seed, so no row has to know of another, a
recomputed task draws the same again, and the same draw can be made in any SQL engine.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A draw takes 15 bits; one md5 gives two words of 60 bits, hence eight draws.
DRAW_BITS = 15
DRAWS_PER_HASH = 8


def poisson_thresholds(bits: int = DRAW_BITS) -> list[int]:
    """A draw counts as many times as there are thresholds at or below it: the distribution function
    of a Poisson variable of mean one, in units of ``2^-bits``."""
    out, below, k = [], 0.0, 0
    while True:
        below += math.exp(-1) / math.factorial(k)
        if (limit := round(below * (1 << bits))) >= 1 << bits:
            return out
        out.append(limit)
        k += 1


def replicate_means(df: DataFrame, value: str, by: Sequence[str], key: str = "id", replicates: int = 200, seed: int = 0) -> DataFrame:
    """(``by``, replicate, weight, mean): one row per group and replicate that has rows; replicate -1
    is the sample itself. NULL and NaN values are left out; a NULL key draws as the text ``null``."""
    x = F.col(value).cast("double")
    hashes = -(-replicates // DRAWS_PER_HASH)
    rows = (df.where(x.isNotNull() & ~F.isnan(x))
            .select(*by, x.alias("_x"), F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("_key"),
                    F.explode(F.sequence(F.lit(0), F.lit(hashes - 1))).alias("_c")))
    digest = F.md5(F.concat_ws(":", "_key", F.lit(str(seed)), F.col("_c").cast("string")))
    words = rows.withColumn("_h", digest).withColumns({
        f"_w{i}": F.conv(F.substring("_h", 1 + 15 * i, 15), 16, 10).cast("bigint") for i in (0, 1)})
    per_word = DRAWS_PER_HASH // 2
    draws = [F.struct((F.col("_c") * DRAWS_PER_HASH + i * per_word + j).alias("replicate"),
                      F.shiftright(f"_w{i}", DRAW_BITS * j).bitwiseAND(F.lit((1 << DRAW_BITS) - 1)).cast("int").alias("u"))
             for i in (0, 1) for j in range(per_word)]
    # The row as it is: a draw of exactly one, with the row's first hash.
    limits = poisson_thresholds()
    itself = F.when(F.col("_c") == 0, F.struct(F.lit(-1).alias("replicate"), F.lit(limits[0]).alias("u")))
    drawn = words.select(*by, "_x", F.inline(F.array(itself, *draws))).where(F.col("replicate") < replicates)
    weight = sum((F.when(F.col("u") >= t, F.lit(1)).otherwise(F.lit(0)) for t in limits), F.lit(0))
    return (drawn.withColumn("_n", weight).where("_n > 0").groupBy(*by, "replicate")
            .agg(F.sum("_n").alias("weight"), (F.sum(F.col("_n") * F.col("_x")) / F.sum("_n")).alias("mean")))


def bootstrap_ci(df: DataFrame, value: str, by: Sequence[str] = (), key: str = "id", replicates: int = 200, level: float = 0.95,
                 seed: int = 0, digits: int = 6) -> DataFrame:
    """Mean and percentile bootstrap interval per group: (``by``, n, mean, ci_lo, ci_hi), in order.

    All replicates are one aggregate of at most ``replicates + 1`` rows per group, combined inside
    each task before the shuffle, so a hot group costs no more than any other; the percentiles then
    interpolate between a group's ``replicates`` means. Replicates that draw no row of a group don't
    count for it. ``key`` tells rows apart; rows of equal keys are drawn together.
    """
    means = replicate_means(df, value, by, key, replicates, seed)
    drawn = F.when(F.col("replicate") >= 0, F.col("mean"))
    tail = (1 - level) / 2
    own = F.col("replicate") == -1
    return (means.groupBy(*by).agg(
        F.max(F.when(own, F.col("weight"))).alias("n"), F.round(F.max(F.when(own, F.col("mean"))), digits).alias("mean"),
        F.round(F.percentile(drawn, F.lit(tail)), digits).alias("ci_lo"), F.round(F.percentile(drawn, F.lit(1 - tail)), digits).alias("ci_hi"))
        .orderBy(*(by or ["n"])))
