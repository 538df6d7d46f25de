"""URL filters: host and path rules, and gradient-boosted trees on lexical features for the rest.

DataFrame functions and ``pyspark.ml`` only. The trees are trained from labelled URLs: those a
rule decides, its verdict being the label.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import materialize

#: The rules of the registered query, (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("url_length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "n_params", "query_length",
            "n_labels", "longest_label", "n_hyphens", "has_fragment", "suffix_rate", "suffix_seen")
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits host (or a parent domain) and path
    prefix; null without one. Of equally long rules the first listed wins."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        domain, slash, prefix = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + prefix)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` (with ``host`` and ``path``) and the features that need the URL alone."""
    text = F.coalesce(F.col(url), F.lit(""))
    n = F.char_length(text)
    query = F.regexp_extract(text, r"(?s)^[^?#]*\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    share = lambda c: (n - F.char_length(F.replace(text, c))) / n
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))
    return df.withColumns({
        "url_length": n.cast("double"), "host_length": F.char_length("host").cast("double"),
        "path_length": F.char_length("path").cast("double"),
        "depth": F.regexp_count("path", F.lit("/[^/]")).cast("double"),
        "digit_ratio": F.when(n > 0, F.regexp_count(text, F.lit("[0-9]")) / n).otherwise(0.0),
        "entropy": entropy,
        "n_params": F.when(query == "", 0.0).otherwise(1.0 + F.regexp_count(query, F.lit("&"))),
        "query_length": F.char_length(query).cast("double"),
        "n_labels": F.size(labels).cast("double"),
        "longest_label": F.aggregate(labels, F.lit(0), lambda acc, x: F.greatest(acc, F.char_length(x))).cast("double"),
        "n_hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
        "has_fragment": F.contains(text, F.lit("#")).cast("double"),
        "suffix": F.substring_index("host", ".", -1)})


def judge_urls(df: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", fit_rows: int = 20000,
               rounds: int = 20, depth: int = 4, seed: int = 9) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, score``.

    ``verdict`` is the longest fitting rule's, else block if the trees' probability ``score`` of
    block is at least 0.5. The trees are fitted on distinct labelled URLs, of each verdict all or a
    hash sample of about half of ``fit_rows`` (the documented bound of the fit), weighted by the share
    of their verdict that the sample holds; suffix statistics
    (smoothed block rate and log count of labelled URLs) cover all labelled rows. If the labels
    show one verdict only, that is the method's verdict; without any labelled URL it is allow. A
    null URL, or one without ``://``, has an empty host and path and is judged by the trees;
    repeated rows and null ids keep one row each; an empty table gives no rows.
    """
    pages = df.select(df[id_col].cast("long").alias("page_id"), df[url_col].cast("string").alias("url"))
    pages = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    pages = pages.withColumn("by_rule", rule_for(F.col("host"), F.col("path"), rules))
    pages = pages.select("page_id", "url", "host", "path", F.col("by_rule.rule").alias("rule"),
                         F.col("by_rule.verdict").alias("rule_verdict"))
    rows = materialize(lexical(pages), "url-features")
    blocked = (F.col("rule_verdict") == "block").cast("double")
    seen = rows.where("rule IS NOT NULL").groupBy("suffix").agg(F.count("*").alias("n"), F.sum(blocked).alias("bad"))
    seen = materialize(seen, "url-suffixes")
    n_labelled, n_bad = seen.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0.0))).first()
    rate = n_bad / n_labelled if n_labelled else 0.0
    stats = seen.select("suffix", ((F.col("bad") + 5 * rate) / (F.col("n") + 5)).alias("suffix_rate"),
                        F.log1p(F.col("n").cast("double")).alias("suffix_seen"))
    full = (rows.join(stats, "suffix", "left")
            .withColumns({"suffix_rate": F.coalesce("suffix_rate", F.lit(rate)), "suffix_seen": F.coalesce("suffix_seen", F.lit(0.0))}))
    verdict = lambda p: F.coalesce("rule_verdict", F.when(p >= 0.5, "block").otherwise("allow"))
    if rate in (0.0, 1.0):
        return full.select("page_id", "host", "path", "rule", verdict(F.lit(rate)).alias("verdict"), F.lit(rate).alias("score"))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    labelled = full.where("rule IS NOT NULL").dropDuplicates(["url"]).withColumn("label", blocked)
    labelled = materialize(labelled.select("url", "label", *FEATURES), "url-labelled")
    parts = 1 << 20
    keep = {r["label"]: math.ceil(parts * min(1.0, fit_rows / 2 / r["count"])) for r in labelled.groupBy("label").count().collect()}
    below = F.element_at(F.create_map(*[F.lit(x) for label, n in keep.items() for x in (label, n)]), F.col("label"))
    sample = (labelled.where(F.pmod(F.xxhash64(F.lit(seed), "url"), F.lit(parts)) < below)
              .withColumn("weight", F.lit(float(parts)) / below).repartition(8, "url").sortWithinPartitions("url"))
    train = materialize(assembler.transform(sample).select("features", "label", "weight"), "url-train")
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if len(counts) < 2:
        rate = float(bool(counts.get(1.0)))
        return full.select("page_id", "host", "path", "rule", verdict(F.lit(rate)).alias("verdict"), F.lit(rate).alias("score"))
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=seed, subsamplingRate=1.0, weightCol="weight").fit(train)
    scored = model.transform(assembler.transform(full)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("page_id", "host", "path", "rule", verdict(F.col("score")).alias("verdict"), "score")
