"""Two-group statistics queries (T*) on the imputed training split."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomekit.operators import stats
from outcomekit.plans.catalog import register, rounded
from outcomekit.plans.prepared import prepare
from outcomekit.plans.sql import with_cohort


def train_long(spark, sf):
    p = prepare(spark, sf)
    return stats.long_form(p.train, p.features, "label"), p


@register("group_statistics", with_cohort("""
SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std, round(mean_0, 6) AS mean_0,
       round(mean_1, 6) AS mean_1, round(mean_1 - mean_0, 6) AS diff FROM moments"""))
def q_group_statistics(spark, sf):
    long, _ = train_long(spark, sf)
    return rounded(stats.group_statistics(stats.feature_moments(long)))


def _moments(spark, sf):
    long, p = train_long(spark, sf)
    return stats.feature_moments(long), long, p


CORR_CTE = """
, corr AS (SELECT feature, cov_xy / (std * std_y) AS r, abs(cov_xy / (std * std_y)) AS abs_r
          FROM moments WHERE min < max AND std * std_y <> 0)"""


def _sql(ctes: str, body: str) -> str:
    return with_cohort(ctes.replace("\n, ", ",\n", 1) + "\n" + body) if ctes.startswith("\n, ") else with_cohort(body)


@register("feature_label_corr", _sql(CORR_CTE, "SELECT feature, round(r, 6) AS r, round(abs_r, 6) AS abs_r FROM corr"))
def q_corr(spark, sf):
    m, _, _ = _moments(spark, sf)
    return rounded(stats.feature_label_corr(m))


@register("topk_corr", _sql(CORR_CTE, """
SELECT feature, round(r, 6) AS r, round(abs_r, 6) AS abs_r FROM corr ORDER BY abs_r DESC, feature LIMIT 10"""))
def q_topk(spark, sf):
    m, _, _ = _moments(spark, sf)
    return rounded(stats.top_k(stats.feature_label_corr(m), "abs_r", 10))


@register("bottomk_corr", _sql(CORR_CTE, """
SELECT feature, round(r, 6) AS r, round(abs_r, 6) AS abs_r FROM corr ORDER BY abs_r ASC, feature LIMIT 10"""))
def q_bottomk(spark, sf):
    m, _, _ = _moments(spark, sf)
    return rounded(stats.top_k(stats.feature_label_corr(m), "abs_r", 10, desc=False))


PAIRS_CTE = CORR_CTE + """
, top AS (SELECT feature, row_number() OVER (ORDER BY abs_r DESC, feature) AS rk FROM corr ORDER BY rk LIMIT 30)
, pairs AS (
  SELECT ta.feature AS feature_a, tb.feature AS feature_b, any_value(ta.rk) AS rk_a, any_value(tb.rk) AS rk_b,
         covar_samp(a.value, b.value) / (stddev_samp(a.value) * stddev_samp(b.value)) AS r
  FROM top ta JOIN top tb ON ta.rk < tb.rk
  JOIN train a ON a.feature = ta.feature
  JOIN train b ON b.feature = tb.feature AND a.stay_id = b.stay_id
  GROUP BY ta.feature, tb.feature)"""


def _pairs(spark, sf, k=30):
    m, _, p = _moments(spark, sf)
    top = [r.feature for r in stats.top_k(stats.feature_label_corr(m), "abs_r", k).select("feature").collect()]
    return stats.corr_matrix_long(p.train, top)


@register("corr_matrix_long", _sql(PAIRS_CTE, "SELECT feature_a, feature_b, round(r, 6) AS r FROM pairs"))
def q_corr_matrix(spark, sf):
    return rounded(_pairs(spark, sf).select("feature_a", "feature_b", "r"))


@register("corr_matrix_mean", _sql(PAIRS_CTE, "SELECT round(avg(r), 6) AS mean_r, count(r) AS n_pairs FROM pairs"))
def q_corr_matrix_mean(spark, sf):
    return rounded(stats.corr_matrix_mean(_pairs(spark, sf)))


@register("strong_pairs", _sql(PAIRS_CTE, """
SELECT feature_a, feature_b, round(r, 6) AS r FROM pairs WHERE abs(r) > 0.8
ORDER BY rk_a, rk_b LIMIT 5"""))
def q_strong_pairs(spark, sf):
    return rounded(stats.strong_pairs(_pairs(spark, sf)))


@register("strong_pairs_half", _sql(PAIRS_CTE, """
SELECT feature_a, feature_b, round(r, 6) AS r FROM pairs WHERE abs(r) > 0.5
ORDER BY rk_a, rk_b LIMIT 5"""))
def q_strong_pairs_half(spark, sf):
    """T7 at a threshold that pairs of this cohort pass."""
    return rounded(stats.strong_pairs(_pairs(spark, sf), threshold=0.5))


@register("corr_matrix_masked", with_cohort("""
SELECT a.feature AS feature_a, b.feature AS feature_b, count(*) AS n,
       round(covar_samp(a.value, b.value) / nullif(stddev_samp(a.value) * stddev_samp(b.value), 0), 6) AS r
FROM long_all a JOIN long_all b ON a.stay_id = b.stay_id AND a.feature < b.feature
WHERE a.value IS NOT NULL AND b.value IS NOT NULL GROUP BY a.feature, b.feature"""))
def q_corr_masked(spark, sf):
    """T5 before imputation: every pair over the rows in which both are present."""
    from outcomekit.operators.wide import pairwise_corr
    from outcomekit.plans.prepared import CANDIDATE_FEATURES, prepared_cohort
    pairs = pairwise_corr(prepared_cohort(spark, sf), sorted(CANDIDATE_FEATURES)).where("n > 0")
    return rounded(pairs.select("feature_a", "feature_b", "n", "r"))


@register("group_statistics_wide", with_cohort("""
SELECT feature, n, round(mean, 5) AS mean, round(std, 5) AS std, min, max, round(mean_0, 5) AS mean_0, round(sqrt(var_0), 5) AS std_0,
       round(mean_1, 5) AS mean_1, round(sqrt(var_1), 5) AS std_1, round(cov_xy, 5) AS cov_xy, round(std_y, 5) AS std_y FROM moments"""))
def q_group_statistics_wide(spark, sf):
    """T2 / T3 by the columnar pass for tables of many columns."""
    from outcomekit.operators.wide import group_moments
    p = prepare(spark, sf)
    m = group_moments(p.train, p.features).withColumns({f"std_{c}": F.sqrt(f"var_{c}") for c in (0, 1)})
    return rounded(m.drop("n_0", "n_1", "var_0", "var_1"), 5, keep=("min", "max"))


@register("missing_by_column_wide", with_cohort("""
SELECT feature, count(*) FILTER (WHERE value IS NULL) AS missing, count(value) AS n, round(avg(value), 6) AS mean,
       min(value) AS min, max(value) AS max FROM long_all GROUP BY feature"""))
def q_missing_wide(spark, sf):
    """P5 / C10 / C15 by the columnar pass, before imputation."""
    from outcomekit.operators.wide import wide_moments
    from outcomekit.plans.prepared import CANDIDATE_FEATURES, prepared_cohort
    out = wide_moments(prepared_cohort(spark, sf), CANDIDATE_FEATURES)
    return rounded(out.select("feature", "missing", "n", "mean", "min", "max"), keep=("min", "max"))


from outcomekit.plans.sql import t_pvalue_ctes  # noqa: E402

LEVENE_CTE = """
, med AS (SELECT feature, label, quantile_cont(value, 0.5) AS m FROM train GROUP BY feature, label)
, z AS (SELECT t.feature, t.label, abs(t.value - med.m) AS z FROM train t JOIN med ON t.feature = med.feature AND t.label = med.label)
, zm AS (SELECT feature, count(z) AS n, avg(z) AS zbar,
               count(z) FILTER (WHERE label = 0) AS n_0, avg(z) FILTER (WHERE label = 0) AS z_0,
               var_samp(z) FILTER (WHERE label = 0) AS v_0,
               count(z) FILTER (WHERE label = 1) AS n_1, avg(z) FILTER (WHERE label = 1) AS z_1,
               var_samp(z) FILTER (WHERE label = 1) AS v_1 FROM z GROUP BY feature)
, lev AS (SELECT feature,
                CASE WHEN (n_0 - 1) * v_0 + (n_1 - 1) * v_1 = 0 THEN NULL
                     ELSE (n - 2) * (n_0 * (z_0 - zbar) ^ 2 + n_1 * (z_1 - zbar) ^ 2) / ((n_0 - 1) * v_0 + (n_1 - 1) * v_1) END AS w,
                CAST(n - 2 AS DOUBLE) AS nu FROM zm)
, levt AS (SELECT feature, sqrt(w) AS t, nu FROM lev)""" + "\n, " + t_pvalue_ctes("levt", "t", "nu", "levp").strip()


@register("levene_f", _sql(LEVENE_CTE, """
SELECT l.feature, round(l.w, 6) AS levene_w, round(l.nu, 6) AS levene_df, round(p.p, 6) AS levene_p
FROM lev l JOIN levp p ON l.feature = p.feature"""))
def q_levene(spark, sf):
    long, _ = train_long(spark, sf)
    return rounded(stats.levene(long))


TT_CTE = """
, tt AS (SELECT feature,
   CASE WHEN ((n_0 - 1) * var_0 + (n_1 - 1) * var_1) / (n_0 + n_1 - 2) * (1.0 / n_0 + 1.0 / n_1) = 0 THEN NULL
        ELSE (mean_0 - mean_1) / sqrt(((n_0 - 1) * var_0 + (n_1 - 1) * var_1) / (n_0 + n_1 - 2) * (1.0 / n_0 + 1.0 / n_1)) END AS t_pooled,
   CAST(n_0 + n_1 - 2 AS DOUBLE) AS df_pooled,
   CASE WHEN var_0 / n_0 + var_1 / n_1 = 0 THEN NULL
        ELSE (mean_0 - mean_1) / sqrt(var_0 / n_0 + var_1 / n_1) END AS t_welch,
   CASE WHEN (var_0 / n_0) ^ 2 / (n_0 - 1) + (var_1 / n_1) ^ 2 / (n_1 - 1) = 0 THEN NULL
        ELSE (var_0 / n_0 + var_1 / n_1) ^ 2 / ((var_0 / n_0) ^ 2 / (n_0 - 1) + (var_1 / n_1) ^ 2 / (n_1 - 1)) END AS df_welch
   FROM moments)""" + "\n, " + t_pvalue_ctes("tt", "t_pooled", "df_pooled", "pp").strip() \
    + ",\n" + t_pvalue_ctes("tt", "t_welch", "df_welch", "pw").strip()


@register("t_pooled", _sql(TT_CTE, """
SELECT tt.feature, round(t_pooled, 6) AS t_pooled, round(df_pooled, 6) AS df_pooled, round(pp.p, 6) AS p_pooled
FROM tt JOIN pp ON tt.feature = pp.feature"""))
def q_t_pooled(spark, sf):
    m, _, _ = _moments(spark, sf)
    return rounded(stats.t_tests(m).select("feature", "t_pooled", "df_pooled", "p_pooled"))


@register("t_welch", _sql(TT_CTE, """
SELECT tt.feature, round(t_welch, 6) AS t_welch, round(df_welch, 6) AS df_welch, round(pw.p, 6) AS p_welch
FROM tt JOIN pw ON tt.feature = pw.feature"""))
def q_t_welch(spark, sf):
    m, _, _ = _moments(spark, sf)
    return rounded(stats.t_tests(m).select("feature", "t_welch", "df_welch", "p_welch"))


D_SQL = """CASE WHEN sqrt((var_0 + var_1) / 2) = 0 THEN 0.0
     ELSE (mean_1 - mean_0) / sqrt((var_0 + var_1) / 2) END"""

GATED_CTE = TT_CTE + LEVENE_CTE + f"""
, gated AS (
  SELECT tt.feature, lev.w AS levene_w, levp.p AS levene_p,
         CASE WHEN levp.p > 0.05 THEN 'pooled' ELSE 'welch' END AS test,
         CASE WHEN levp.p > 0.05 THEN tt.t_pooled ELSE tt.t_welch END AS t_0_minus_1,
         CASE WHEN levp.p > 0.05 THEN pp.p ELSE pw.p END AS p_value,
         {D_SQL} AS d_1_minus_0
  FROM tt JOIN pp ON tt.feature = pp.feature JOIN pw ON tt.feature = pw.feature
  JOIN lev ON tt.feature = lev.feature JOIN levp ON tt.feature = levp.feature
  JOIN moments m ON tt.feature = m.feature)"""


@register("t_gated", _sql(GATED_CTE, """
SELECT feature, round(levene_w, 6) AS levene_w, round(levene_p, 6) AS levene_p, test,
       round(t_0_minus_1, 6) AS t_0_minus_1, round(p_value, 6) AS p_value, round(d_1_minus_0, 6) AS d_1_minus_0,
       coalesce(p_value < 0.05, false) AS sig_05, coalesce(p_value < 0.01, false) AS sig_01,
       coalesce(p_value < 0.001, false) AS sig_001
FROM gated"""))
def q_t_gated(spark, sf):
    m, long, _ = _moments(spark, sf)
    return rounded(stats.gated_tests(m, long))


@register("cohens_d", with_cohort(f"SELECT feature, round({D_SQL}, 6) AS cohens_d FROM moments"))
def q_cohens_d(spark, sf):
    m, _, _ = _moments(spark, sf)
    return rounded(stats.cohens_d(m))


@register("significance_summary", _sql(GATED_CTE, """
SELECT count(*) AS n_tested, count(*) FILTER (WHERE p_value < 0.05) AS n_sig_05,
       count(*) FILTER (WHERE p_value < 0.01) AS n_sig_01, count(*) FILTER (WHERE p_value < 0.001) AS n_sig_001
FROM gated"""))
def q_significance(spark, sf):
    m, long, _ = _moments(spark, sf)
    return stats.significance_summary(stats.gated_tests(m, long))


ANOVA_CTE = """
, an AS (SELECT feature,
   CASE WHEN ((n_0 - 1) * var_0 + (n_1 - 1) * var_1) = 0 THEN NULL
        ELSE (n_0 * (mean_0 - (n_0 * mean_0 + n_1 * mean_1) / (n_0 + n_1)) ^ 2
              + n_1 * (mean_1 - (n_0 * mean_0 + n_1 * mean_1) / (n_0 + n_1)) ^ 2)
             / (((n_0 - 1) * var_0 + (n_1 - 1) * var_1) / (n_0 + n_1 - 2)) END AS f_value,
   CAST(n_0 + n_1 - 2 AS DOUBLE) AS nu FROM moments)
, ant AS (SELECT feature, sqrt(f_value) AS t, nu FROM an)""" + "\n, " + t_pvalue_ctes("ant", "t", "nu", "anp").strip()


@register("anova_f", _sql(ANOVA_CTE, """
SELECT an.feature, round(f_value, 6) AS f_value, round(anp.p, 6) AS p_value FROM an JOIN anp ON an.feature = anp.feature"""))
def q_anova(spark, sf):
    m, _, _ = _moments(spark, sf)
    return rounded(stats.anova_f(m))


@register("combined_importance", _sql(ANOVA_CTE + CORR_CTE, """
, base AS (SELECT k.feature, coalesce(an.f_value, 0.0) AS f, coalesce(c.abs_r, 0.0) AS s
           FROM kept k LEFT JOIN an ON k.feature = an.feature LEFT JOIN corr c ON k.feature = c.feature)
, sc AS (SELECT feature, CASE WHEN max(f) OVER () = 0 THEN NULL ELSE f / max(f) OVER () END AS f_scaled,
                CASE WHEN max(s) OVER () = 0 THEN NULL ELSE s / max(s) OVER () END AS s_scaled FROM base)
SELECT feature, round(f_scaled, 6) AS f_scaled, round(s_scaled, 6) AS s_scaled,
       round(0.5 * f_scaled + 0.5 * s_scaled, 6) AS score FROM sc""".replace("\n, base AS", ", base AS", 1)))
def q_combined(spark, sf):
    m, _, p = _moments(spark, sf)
    feats = spark.createDataFrame([(f,) for f in p.features], "feature string")
    return rounded(stats.combined_importance(stats.anova_f(m), stats.feature_label_corr(m), "abs_r", feats))


@register("histogram_50", with_cohort("""
, mm AS (SELECT min(total) AS lo, max(total) AS hi FROM prepared)
, b AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((total - lo) / (hi - lo) * 50) + 1, 50) END AS INTEGER) AS bin,
               lo, hi FROM prepared, mm WHERE total IS NOT NULL)
SELECT bin, round(any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 50, 6) AS bin_lo,
       round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 50, 6) AS bin_hi, count(*) AS n
FROM b GROUP BY bin""".replace("\n, mm AS", ",\nmm AS", 1)))
def q_histogram(spark, sf):
    from outcomekit.plans.prepared import prepared_cohort
    return rounded(stats.histogram(prepared_cohort(spark, sf), "total", 50))


@register("box_stats", _sql(CORR_CTE, """
, top4 AS (SELECT feature FROM corr ORDER BY abs_r DESC, feature LIMIT 4)
, q AS (SELECT feature, label, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
               quantile_cont(value, 0.75) AS q3 FROM train WHERE feature IN (SELECT feature FROM top4) GROUP BY feature, label)
SELECT q.feature, q.label, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(min(t.value) FILTER (WHERE t.value >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_lo,
       round(max(t.value) FILTER (WHERE t.value <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
       count(*) FILTER (WHERE t.value < q1 - 1.5 * (q3 - q1) OR t.value > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM q JOIN train t ON q.feature = t.feature AND q.label = t.label
GROUP BY q.feature, q.label, q1, median, q3""".replace("\n, top4 AS", ", top4 AS", 1)))
def q_box(spark, sf):
    m, long, _ = _moments(spark, sf)
    top = [r.feature for r in stats.top_k(stats.feature_label_corr(m), "abs_r", 4).select("feature").collect()]
    return rounded(stats.box_stats(long.where(F.col("feature").isin(top))))


@register("pvalue_histogram", _sql(GATED_CTE, """
, mm AS (SELECT min(p_value) AS lo, max(p_value) AS hi FROM gated)
, hb AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((p_value - lo) / (hi - lo) * 50) + 1, 50) END AS INTEGER) AS bin, lo, hi
         FROM gated, mm WHERE p_value IS NOT NULL)
, hh AS (SELECT bin, any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 50 AS bin_lo,
                any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 50 AS bin_hi, count(*) AS n FROM hb GROUP BY bin)
SELECT bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, n, bin_hi <= 0.05 AS below_05, bin_hi <= 0.01 AS below_01 FROM hh"""))
def q_pvalue_histogram(spark, sf):
    """The p-values of the gated tests in 50 bins."""
    m, long, _ = _moments(spark, sf)
    return rounded(stats.histogram_of_p(stats.gated_tests(m, long), "p_value", 50))


@register("box_stats_ttest", _sql(GATED_CTE, """
, top4 AS (SELECT feature FROM gated ORDER BY p_value, feature LIMIT 4)
, q AS (SELECT feature, label, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
               quantile_cont(value, 0.75) AS q3 FROM train WHERE feature IN (SELECT feature FROM top4) GROUP BY feature, label)
SELECT q.feature, q.label, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(min(t.value) FILTER (WHERE t.value >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_lo,
       round(max(t.value) FILTER (WHERE t.value <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
       count(*) FILTER (WHERE t.value < q1 - 1.5 * (q3 - q1) OR t.value > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM q JOIN train t ON q.feature = t.feature AND q.label = t.label
GROUP BY q.feature, q.label, q1, median, q3"""))
def q_box_ttest(spark, sf):
    """Boxes of the four features with the smallest p-values."""
    m, long, _ = _moments(spark, sf)
    tests = stats.gated_tests(m, long).where("p_value is not null")
    top = [r.feature for r in stats.top_k(tests, "p_value", 4, desc=False).select("feature").collect()]
    return rounded(stats.box_stats(long.where(F.col("feature").isin(top))))


@register("analysis_summary", with_cohort("""
SELECT (SELECT count(*) FROM prepared WHERE split = 'train') AS n_train_rows,
       (SELECT count(*) FROM prepared WHERE split = 'test') AS n_test_rows,
       (SELECT count(*) FROM kept) AS n_features,
       (SELECT round(avg(label), 6) FROM prepared WHERE split = 'train') AS train_positive_rate,
       (SELECT round(avg(label), 6) FROM prepared WHERE split = 'test') AS test_positive_rate,
       (SELECT count(DISTINCT subject_id) FROM prepared) AS n_subjects"""))
def q_summary(spark, sf):
    p = prepare(spark, sf)
    d = p.data
    return rounded(d.agg(
        F.count_if(F.col("split") == "train").alias("n_train_rows"),
        F.count_if(F.col("split") == "test").alias("n_test_rows"),
        F.avg(F.when(F.col("split") == "train", F.col("label"))).alias("train_positive_rate"),
        F.avg(F.when(F.col("split") == "test", F.col("label"))).alias("test_positive_rate"),
        F.count_distinct("subject_id").alias("n_subjects"),
    ).withColumn("n_features", F.lit(len(p.features)).cast("bigint")))


@register("left_join_scores", _sql(ANOVA_CTE + CORR_CTE, """
SELECT k.feature, round(coalesce(an.f_value, 0.0), 6) AS f_value, round(coalesce(c.abs_r, 0.0), 6) AS abs_r
FROM kept k LEFT JOIN an ON k.feature = an.feature LEFT JOIN corr c ON k.feature = c.feature"""))
def q_left_join_scores(spark, sf):
    """J1 + J2: per-feature score tables left-joined on the feature name, gaps -> 0."""
    m, _, p = _moments(spark, sf)
    feats = spark.createDataFrame([(f,) for f in p.features], "feature string")
    out = feats.join(stats.anova_f(m).select("feature", "f_value"), "feature", "left") \
        .join(stats.feature_label_corr(m).select("feature", "abs_r"), "feature", "left")
    return rounded(out.select("feature", F.coalesce("f_value", F.lit(0.0)).alias("f_value"),
                              F.coalesce("abs_r", F.lit(0.0)).alias("abs_r")))


@register("t_pvalues", _sql(TT_CTE + ANOVA_CTE, """
SELECT tt.feature, round(pp.p, 6) AS p_pooled, round(pw.p, 6) AS p_welch, round(anp.p, 6) AS p_anova
FROM tt JOIN pp ON tt.feature = pp.feature JOIN pw ON tt.feature = pw.feature JOIN anp ON tt.feature = anp.feature"""))
def q_t_pvalues(spark, sf):
    """Every p-value of the per-feature tests side by side."""
    m, _, _ = _moments(spark, sf)
    t = stats.t_tests(m).select("feature", "p_pooled", "p_welch")
    a = stats.anova_f(m).select("feature", F.col("p_value").alias("p_anova"))
    return rounded(t.join(a, "feature"))
