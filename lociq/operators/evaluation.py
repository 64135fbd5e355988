"""Evaluation: precision-recall and ROC curves, recall with unseen negatives, concordance, tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociq.operators.intervals import cumulated


def running_counts(df: DataFrame, truth: Column, score: str) -> DataFrame:
    """Numbers of either class at each distinct threshold, true and false positives from the highest threshold down, and totals."""
    by = df.groupBy(F.col(score).alias("threshold")).agg(F.count(F.when(truth, 1)).alias("pos"), F.count(F.when(~truth, 1)).alias("neg"))
    upwards = cumulated(by, [F.desc("threshold")], {"tp": F.col("pos"), "fp": F.col("neg")})
    return upwards.crossJoin(F.broadcast(upwards.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))))  # one row


def pr_curve(df: DataFrame, truth: Column, score: str, extra_fn: int = 0) -> DataFrame:
    """Precision and recall at each threshold, the recall's denominator widened by positives that were never scored, and the end point (1, 0)."""
    c = running_counts(df, truth, score)
    curve = c.select("threshold", F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"), F.try_divide("tp", F.col("p") + extra_fn).alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return curve.unionByName(end)


def roc_curve(df: DataFrame, truth: Column, score: str) -> DataFrame:
    c = running_counts(df, truth, score)
    return c.select("threshold", F.try_divide("tp", "p").alias("tpr"), F.try_divide("fp", "n").alias("fpr"))


def areas(df: DataFrame, truth: Column, score: str) -> DataFrame:
    """ROC AUC by trapezoids and average precision, as one row."""
    c = running_counts(df, truth, score)
    step = c.select((F.col("neg") * (2 * F.col("tp") - F.col("pos")) / 2).alias("area"), (F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("gain"), "p", "n")
    return step.agg(F.try_divide(F.sum("area"), F.max(F.col("p") * F.col("n"))).alias("auc"), F.try_divide(F.sum("gain"), F.max("p")).alias("average_precision"))


def recall(truth: Column, predicted: Column, extra_fn: int = 0) -> Column:
    return F.try_divide(F.count(F.when(truth & predicted, 1)), F.count(F.when(truth, 1)) + extra_fn)


def at_thresholds(df: DataFrame, thresholds: list[float], truth: Column, score: str, by: list[str]) -> DataFrame:
    """Calls, precision, recall and expected number (calls * precision / recall) for each group and threshold."""
    t = df.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    call = F.col(score) >= F.col("threshold")
    n = lambda c: F.count(F.when(c, 1))
    out = t.groupBy(*by, "threshold").agg(n(call).alias("calls"), n(call & truth).alias("tp"), n(truth).alias("p"))
    out = out.withColumns({"precision": F.try_divide("tp", "calls"), "recall": F.try_divide("tp", "p")})
    return out.withColumn("expected", F.try_divide(F.col("calls") * F.col("precision"), F.col("recall")))


def concordance(df: DataFrame, key: str, group: str, value: str, least: float) -> DataFrame:
    """Share of the loci of group d1 whose value in group d2 reaches ``least``, for all pairs of groups that share loci."""
    mine = df.select(key, F.col(group).alias("d1")).distinct()
    other = df.groupBy(key, F.col(group).alias("d2")).agg(F.max(value).alias("v"))
    total = mine.groupBy("d1").agg(F.count("*").alias("n"))
    hit = mine.join(other.where(F.col("v") >= least), key).groupBy("d1", "d2").agg(F.count("*").alias("hits"))
    return hit.join(total, "d1").select("d1", "d2", (F.col("hits") / F.col("n")).alias("share"))


def welch_t(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """Two-sample t statistic with unequal variances, and its degrees of freedom."""
    s = lambda f, g, name: f(F.when(F.col(group) == g, F.col(value))).alias(name)
    m = df.agg(s(F.avg, a, "ma"), s(F.var_samp, a, "va"), s(F.count, a, "na"), s(F.avg, b, "mb"), s(F.var_samp, b, "vb"), s(F.count, b, "nb"))
    ea, eb = F.col("va") / F.col("na"), F.col("vb") / F.col("nb")
    return m.select(F.try_divide(F.col("ma") - F.col("mb"), F.sqrt(ea + eb)).alias("t"), F.try_divide((ea + eb) ** 2, ea**2 / (F.col("na") - 1) + eb**2 / (F.col("nb") - 1)).alias("df"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation of average ranks. Ranks come from the counts of distinct values, so ties cost nothing."""

    def ranked(c: str) -> DataFrame:
        n = df.groupBy(c).agg(F.count("*").alias("n"))
        upto = cumulated(n, [c], {"upto": F.col("n")})
        return upto.select(c, (F.col("upto") - (F.col("n") - 1) / 2).alias(f"rank_{c}"))

    return df.join(ranked(x), x).join(ranked(y), y).agg(F.corr(f"rank_{x}", f"rank_{y}").alias("rho"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X >= k) for X binomial, each term from the one before, as logarithms so that none runs to zero where n is large."""
    return F.expr(f"1 - aggregate(sequence(0, {k} - 1), named_struct('t', {n} * ln(1 - {p}D), 's', 0D), (a, i) -> named_struct('t', a.t + ln({n} - i) - ln(i + 1D) + ln({p / (1 - p)}D), 's', a.s + exp(a.t)), a -> a.s)")
