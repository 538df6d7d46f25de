"""Classification statistics on a scored frame, fully distributed.

The scored rows are grouped once by (score, prediction, label); confusion counts, the derived
rates and the AUC all come from that table of counts. The AUC is exact (Mann-Whitney with half
credit for ties):

    AUC = sum over distinct scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P * N)

``neg(< s)`` is a running sum in score order, taken in two levels: the distinct scores are cut into
``ranges`` at approximate quantiles (a hot score is one row; the cuts come from sketches merged in
two levels), a window runs per range, and a window over the range totals gives the offsets.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.operators import quantiles
from lendscope.session import materialize

RANGES = 256


def score_counts(df: DataFrame, label: str = "target", prediction: str | None = "prediction",
                 score: str | None = "score") -> DataFrame:
    """(s, p, y, c): rows by score, prediction and label, written once; a NaN score is NULL."""
    s = F.lit(None).cast("double") if score is None else F.col(score).cast("double")
    p = F.lit(None).cast("double") if prediction is None else F.col(prediction).cast("double")
    rows = df.select(F.when(~F.isnan(s), s).alias("s"), p.alias("p"), F.col(label).cast("double").alias("y"))
    return materialize(rows.groupBy("s", "p", "y").agg(F.count(F.lit(1)).alias("c")), "scores")


def _auc_frame(counts: DataFrame, ranges: int = RANGES) -> DataFrame:
    """One row: auc; NULL if a class is absent."""
    per_score = (counts.where("s IS NOT NULL AND y IS NOT NULL").groupBy("s")
                 .agg(F.sum(F.col("y") * F.col("c")).alias("pos"), F.sum((1.0 - F.col("y")) * F.col("c")).alias("neg")))
    cuts = quantiles.two_level(per_score, [], [quantiles.kll("s").alias("k")], [quantiles.kll_merge("k").alias("k")]) \
        .select(quantiles.kll_quantiles("k", [i / ranges for i in range(1, ranges)]).alias("c")).first()["c"]
    splits = [-float("inf"), *sorted({float(c) for c in cuts or (0.0,)}), float("inf")]
    tagged = Bucketizer(splits=splits, inputCol="s", outputCol="b", handleInvalid="keep").transform(per_score)
    totals = tagged.groupBy("b").agg(F.sum("neg").alias("range_neg"))  # at most ``ranges`` rows
    offsets = totals.select("b", (F.sum("range_neg").over(Window.orderBy("b")) - F.col("range_neg")).alias("offset"))
    before = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(before), F.lit(0.0)) + F.col("offset")
    return (tagged.join(offsets, "b")
            .select("pos", "neg", (F.col("pos") * (below + F.col("neg") / 2.0)).alias("t"))
            .agg(F.sum("t").alias("t"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
            .select(F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("t") / (F.col("p") * F.col("n"))).alias("auc")))


def auc(df: DataFrame, label: str = "target", score: str = "score", ranges: int = RANGES,
        digits: int | None = 6) -> float | None:
    """Exact area under the ROC curve (ties count one half); ``None`` if a class is absent."""
    value = _auc_frame(score_counts(df, label, None, score), ranges).first()["auc"]
    return value if value is None or digits is None else round(value, digits)


def _safe_ratio(num, den):
    return F.when(den > 0, num / den)


def classification_report(df: DataFrame, label: str = "target", prediction: str = "prediction",
                          score: str | None = "score", digits: int = 6) -> DataFrame:
    """One row: n, n_skipped, tp, fp, tn, fn, accuracy, precision, recall, f1 (+ auc when a score is given).

    ``n`` counts rows with both a label and a prediction; ``n_skipped`` counts the others.
    """
    counts = score_counts(df, label, prediction, score)
    known = F.col("y").isNotNull() & F.col("p").isNotNull()
    of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("c"))), F.lit(0))
    y, p = F.col("y"), F.col("p")
    c = counts.agg(of(known).alias("n"), of(~known).alias("n_skipped"), of((y == 1) & (p == 1)).alias("tp"),
                   of((y == 0) & (p == 1)).alias("fp"), of((y == 0) & (p == 0)).alias("tn"), of((y == 1) & (p == 0)).alias("fn"))
    tp, fp, tn, fn, n = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn", "n"))
    precision = _safe_ratio(tp, tp + fp)
    recall = _safe_ratio(tp, tp + fn)
    out = c.select(
        "n", "n_skipped", "tp", "fp", "tn", "fn",
        F.round(_safe_ratio(tp + tn, n), digits).alias("accuracy"),
        F.round(precision, digits).alias("precision"),
        F.round(recall, digits).alias("recall"),
        F.round(_safe_ratio(2 * precision * recall, precision + recall), digits).alias("f1"),
    )
    if score is not None:
        area = _auc_frame(counts).first()["auc"]
        out = out.withColumn("auc", F.round(F.lit(area).cast("double"), digits))
    return out
