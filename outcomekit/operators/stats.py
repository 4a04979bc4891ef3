"""Two-group statistics and feature ranking.

Everything starts from the long form ``(label, feature, value)``.  One
``groupBy(feature)`` with FILTER-style conditional aggregates yields n, mean,
variance per label group and the covariance with the label; map-side partial
aggregation keeps the shuffle at (features x partitions) rows however many
stays there are, and every later test (pooled / Welch t, ANOVA F, Cohen's d,
correlation) is a projection of that one small table.  Only Levene needs a
second pass (medians joined back).  p-values run as a pandas UDF on the
per-feature table, never on data rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outcomekit.functions.dist import t_two_sided_p
from outcomekit.functions.expr import safe_div
from outcomekit.functions.quantiles import exact_quantiles
from outcomekit.operators.prep import to_long
from outcomekit.operators.wide import pairwise_corr


def long_form(df: DataFrame, features: list[str], label: str, ids: list[str] | None = None) -> DataFrame:
    """(ids.., label, feature, value) with NULL values removed."""
    ids = list(ids or [])
    return to_long(df, ids + [label], features).where(F.col("value").isNotNull())


def _g(label: str, g: int, c: Column) -> Column:
    return F.when(F.col(label) == g, c)


def feature_moments(long: DataFrame, label: str = "label") -> DataFrame:
    """One row per feature: overall and per-label-group n / mean / variance,
    min / max, and the sample covariance with the label."""
    v = F.col("value")
    y = F.col(label).cast("double")
    return long.groupBy("feature").agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.count(_g(label, 0, v)).alias("n_0"),
        F.avg(_g(label, 0, v)).alias("mean_0"),
        F.var_samp(_g(label, 0, v)).alias("var_0"),
        F.count(_g(label, 1, v)).alias("n_1"),
        F.avg(_g(label, 1, v)).alias("mean_1"),
        F.var_samp(_g(label, 1, v)).alias("var_1"),
        F.covar_samp(v, y).alias("cov_xy"),
        F.stddev_samp(y).alias("std_y"),
    )


# ------------------------------------------------------------------ T2
def group_statistics(moments: DataFrame) -> DataFrame:
    """Overall mean / std, mean per label group and mean_1 - mean_0."""
    return moments.select("feature", "mean", "std", "mean_0", "mean_1",
                          (F.col("mean_1") - F.col("mean_0")).alias("diff"))


# ------------------------------------------------------------------ T3-T4
def feature_label_corr(moments: DataFrame) -> DataFrame:
    """Pearson r with the label; constant features (min = max) skipped.
    ANSI-safe: r = covar / (sd_x * sd_y) via try_divide, never bare ``corr``."""
    r = safe_div(F.col("cov_xy"), F.col("std") * F.col("std_y"))
    return (moments.where(F.col("min") < F.col("max"))
            .select("feature", r.alias("r"))
            .where(F.col("r").isNotNull())
            .withColumn("abs_r", F.abs("r")))


def top_k(df: DataFrame, by: str, k: int = 10, desc: bool = True, tie: str = "feature") -> DataFrame:
    """Ordered limit with a total order (ties by name)."""
    order = [F.col(by).desc() if desc else F.col(by).asc(), F.col(tie).asc()]
    return df.orderBy(*order).limit(k)


# ------------------------------------------------------------------ T5-T7
def corr_matrix_long(df: DataFrame, features: list[str]) -> DataFrame:
    """T5: pairwise Pearson r (pairwise-complete rows) in matrix order, as rows
    (``i``, ``j``, ``feature_a``, ``feature_b``, ``n``, ``r``) with i < j; one
    pass of block-wise matrix products (``wide.pairwise_corr``)."""
    return pairwise_corr(df, features)


def corr_matrix_mean(pairs: DataFrame) -> DataFrame:
    """Mean of the upper triangle."""
    return pairs.agg(F.avg("r").alias("mean_r"), F.count("r").alias("n_pairs"))


def strong_pairs(pairs: DataFrame, threshold: float = 0.8, k: int = 5) -> DataFrame:
    """|r| > threshold, first k in matrix order."""
    return pairs.where(F.abs("r") > threshold).orderBy("i", "j").limit(k).select("feature_a", "feature_b", "r")


# ------------------------------------------------------------------ T8-T15
def levene(long: DataFrame, label: str = "label") -> DataFrame:
    """Brown-Forsythe / median-centred Levene W and p for two groups.

    Group medians are exact (``exact_quantiles``), broadcast back as a
    (features x 2)-row table; W is the one-way F on |x - median|."""
    med = exact_quantiles(long, ["feature", label], "value", [0.5]).select(
        "feature", label, F.col("quantile").alias("_med"))
    z = long.join(F.broadcast(med), ["feature", label]).select(
        "feature", label, F.abs(F.col("value") - F.col("_med")).alias("z"))
    zm = z.groupBy("feature").agg(
        F.count("z").alias("n"),
        F.avg("z").alias("zbar"),
        F.count(_g(label, 0, F.col("z"))).alias("n_0"),
        F.avg(_g(label, 0, F.col("z"))).alias("z_0"),
        F.var_samp(_g(label, 0, F.col("z"))).alias("v_0"),
        F.count(_g(label, 1, F.col("z"))).alias("n_1"),
        F.avg(_g(label, 1, F.col("z"))).alias("z_1"),
        F.var_samp(_g(label, 1, F.col("z"))).alias("v_1"),
    )
    between = F.col("n_0") * (F.col("z_0") - F.col("zbar")) ** 2 + F.col("n_1") * (F.col("z_1") - F.col("zbar")) ** 2
    within = (F.col("n_0") - 1) * F.col("v_0") + (F.col("n_1") - 1) * F.col("v_1")
    w = safe_div((F.col("n") - 2) * between, within)
    out = zm.select("feature", w.alias("levene_w"), (F.col("n") - 2).cast("double").alias("levene_df"))
    return out.withColumn("levene_p", t_two_sided_p(F.sqrt("levene_w"), F.col("levene_df")))


def _pooled(m: DataFrame) -> tuple[Column, Column]:
    n0, n1, v0, v1 = F.col("n_0"), F.col("n_1"), F.col("var_0"), F.col("var_1")
    nu = (n0 + n1 - 2).cast("double")
    sp2 = safe_div((n0 - 1) * v0 + (n1 - 1) * v1, nu)
    t = safe_div(F.col("mean_0") - F.col("mean_1"), F.sqrt(sp2 * (1.0 / n0 + 1.0 / n1)))
    return t, nu


def _welch(m: DataFrame) -> tuple[Column, Column]:
    a = safe_div(F.col("var_0"), F.col("n_0").cast("double"))
    b = safe_div(F.col("var_1"), F.col("n_1").cast("double"))
    t = safe_div(F.col("mean_0") - F.col("mean_1"), F.sqrt(a + b))
    nu = safe_div((a + b) ** 2, a * a / (F.col("n_0") - 1) + b * b / (F.col("n_1") - 1))
    return t, nu


def t_tests(moments: DataFrame) -> DataFrame:
    """Pooled and Welch t (group 0 minus group 1) with p-values."""
    tp, nup = _pooled(moments)
    tw, nuw = _welch(moments)
    out = moments.select("feature", tp.alias("t_pooled"), nup.alias("df_pooled"),
                         tw.alias("t_welch"), nuw.alias("df_welch"))
    return (out.withColumn("p_pooled", t_two_sided_p(F.col("t_pooled"), F.col("df_pooled")))
               .withColumn("p_welch", t_two_sided_p(F.col("t_welch"), F.col("df_welch"))))


def cohens_d(moments: DataFrame) -> DataFrame:
    """d = (mean_1 - mean_0) / sqrt((s0^2 + s1^2) / 2); 0 when the
    denominator is 0.  Note the sign is opposite to the t statistics."""
    den = F.sqrt((F.col("var_0") + F.col("var_1")) / 2)
    d = F.when(den == 0, F.lit(0.0)).otherwise(F.try_divide(F.col("mean_1") - F.col("mean_0"), den))
    return moments.select("feature", d.alias("cohens_d"))


def gated_tests(moments: DataFrame, long: DataFrame, label: str = "label",
                alpha_levene: float = 0.05) -> DataFrame:
    """T11 + T13 + T14: Levene decides pooled vs Welch; Cohen's d; flags."""
    t = t_tests(moments).join(levene(long, label), "feature").join(cohens_d(moments), "feature")
    pooled = F.col("levene_p") > alpha_levene
    out = t.select(
        "feature", "levene_w", "levene_p",
        F.when(pooled, F.lit("pooled")).otherwise(F.lit("welch")).alias("test"),
        F.when(pooled, F.col("t_pooled")).otherwise(F.col("t_welch")).alias("t_0_minus_1"),
        F.when(pooled, F.col("p_pooled")).otherwise(F.col("p_welch")).alias("p_value"),
        F.col("cohens_d").alias("d_1_minus_0"),
    )
    return out.withColumns({
        "sig_05": F.coalesce(F.col("p_value") < 0.05, F.lit(False)),
        "sig_01": F.coalesce(F.col("p_value") < 0.01, F.lit(False)),
        "sig_001": F.coalesce(F.col("p_value") < 0.001, F.lit(False)),
    })


def significance_summary(tests: DataFrame) -> DataFrame:
    """How many features pass each level."""
    return tests.agg(F.count(F.lit(1)).alias("n_tested"),
                     F.count_if("sig_05").alias("n_sig_05"),
                     F.count_if("sig_01").alias("n_sig_01"),
                     F.count_if("sig_001").alias("n_sig_001"))


def anova_f(moments: DataFrame) -> DataFrame:
    """One-way ANOVA F over the two label groups (= pooled t squared),
    p from the F(1, n-2) tail = two-sided t tail at sqrt(F)."""
    n0, n1 = F.col("n_0"), F.col("n_1")
    n = n0 + n1
    grand = (n0 * F.col("mean_0") + n1 * F.col("mean_1")) / n
    ssb = n0 * (F.col("mean_0") - grand) ** 2 + n1 * (F.col("mean_1") - grand) ** 2
    ssw = (n0 - 1) * F.col("var_0") + (n1 - 1) * F.col("var_1")
    f = safe_div(ssb, safe_div(ssw, (n - 2).cast("double")))
    out = moments.select("feature", f.alias("f_value"), (n - 2).cast("double").alias("df_within"))
    return out.withColumn("p_value", t_two_sided_p(F.sqrt("f_value"), F.col("df_within"))).drop("df_within")


def combined_importance(f_scores: DataFrame, second: DataFrame, second_col: str,
                        features: DataFrame, w_f: float = 0.5) -> DataFrame:
    """W * F/max(F) + (1-w) * s/max(s); features without a score get 0.

    The score tables have one row per feature; ``max over ()`` runs on them,
    never on data rows."""
    f = features.join(f_scores.select("feature", "f_value"), "feature", "left") \
        .withColumn("f_value", F.coalesce("f_value", F.lit(0.0)))
    f = f.withColumn("f_scaled", safe_div(F.col("f_value"), F.max("f_value").over(Window.partitionBy())))
    s = features.join(second.select("feature", F.col(second_col).alias("_s")), "feature", "left") \
        .withColumn("_s", F.coalesce("_s", F.lit(0.0)))
    s = s.withColumn("s_scaled", safe_div(F.col("_s"), F.max("_s").over(Window.partitionBy())))
    out = f.join(s.select("feature", "s_scaled"), "feature", "left")
    return out.select("feature", "f_scaled", "s_scaled",
                      (F.lit(w_f) * F.col("f_scaled") + F.lit(1 - w_f) * F.col("s_scaled")).alias("score"))


# ------------------------------------------------------------------ T18-T19
def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max]; the max lands in the last bin.

    min / max come from one aggregate row (pulled as two literals); binning
    is a projection and the counts a (bins)-group aggregate."""
    lo, hi = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n bigint")
    x = F.col(col).cast("double")
    width = hi - lo
    if width == 0:
        b = F.lit(1)
    else:
        b = F.least(F.floor((x - F.lit(lo)) / F.lit(width) * bins) + 1, F.lit(bins))
    b = b.cast("int")
    return (df.where(F.col(col).isNotNull())
            .select(b.alias("bin"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
            .select("bin",
                    (F.lit(lo) + (F.col("bin") - 1) * F.lit(width) / bins).alias("bin_lo"),
                    (F.lit(lo) + F.col("bin") * F.lit(width) / bins).alias("bin_hi"),
                    "n"))


def histogram_of_p(tests: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """T18 over a table of p-values: ``histogram`` and, per bin, whether it
    lies below 0.05 and 0.01 (its upper edge does)."""
    h = histogram(tests.select(F.col(col).alias("p")), "p", bins)
    return h.withColumn("below_05", F.col("bin_hi") <= 0.05).withColumn("below_01", F.col("bin_hi") <= 0.01)


def box_stats(long: DataFrame, label: str = "label") -> DataFrame:
    """Quartiles and 1.5 IQR whiskers per (feature, label group)."""
    q = exact_quantiles(long, ["feature", label], "value", [0.25, 0.5, 0.75])
    wide = q.groupBy("feature", label).agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"),
    ).withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - 1.5 * F.col("iqr")
    hi = F.col("q3") + 1.5 * F.col("iqr")
    wh = long.join(F.broadcast(wide), ["feature", label]).groupBy("feature", label).agg(
        F.min(F.when(F.col("value") >= lo, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(F.col("value") <= hi, F.col("value"))).alias("whisker_hi"),
        F.count_if((F.col("value") < lo) | (F.col("value") > hi)).alias("n_outliers"),
    )
    return wide.join(wh, ["feature", label])
