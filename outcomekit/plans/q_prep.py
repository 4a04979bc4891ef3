"""Cleaning / imputation / split queries (C*, J3-J5, M12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomekit.operators import prep, split
from outcomekit.plans.catalog import register, rounded
from outcomekit.plans.prepared import CANDIDATE_FEATURES, prepare, prepared_cohort
from outcomekit.plans.sql import with_cohort
from outcomekit.sources.cohort import build_cohort, driver_table

H13 = "CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 13)) AS BIGINT)"


@register("drop_constant_columns", with_cohort("""
SELECT feature AS column_name FROM long_all GROUP BY feature
HAVING min(value) IS NOT DISTINCT FROM max(value)"""))
def q_drop_constant(spark, sf):
    c = prepared_cohort(spark, sf)
    _, dropped = prep.drop_constant_columns(c, CANDIDATE_FEATURES)
    return spark.createDataFrame([(d,) for d in dropped], "column_name string")


@register("label_report", with_cohort("""
SELECT round(avg(label), 6) AS positive_rate, CAST(sum(label) AS BIGINT) AS n_positive,
       count(*) FILTER (WHERE label = 0) AS n_negative FROM cohort"""))
def q_label_report(spark, sf):
    return rounded(prep.label_report(build_cohort(spark, sf), "label"))


@register("clamp_negative", with_cohort("""
SELECT stay_id, round(balance, 6) AS balance_raw,
       round(CASE WHEN balance < 0 THEN 0.0 ELSE balance END, 6) AS balance FROM cohort"""))
def q_clamp(spark, sf):
    c = build_cohort(spark, sf).select("stay_id", F.col("balance").alias("balance_raw"), "balance")
    return rounded(prep.clamp_columns(c, ["balance"]))


@register("zero_share", with_cohort("""
SELECT feature, count(*) FILTER (WHERE value = 0) AS n_zero, count(value) AS n_present,
       round(count(*) FILTER (WHERE value = 0) / count(value), 6) AS zero_share
FROM long_all GROUP BY feature"""))
def q_zero_share(spark, sf):
    return rounded(prep.zero_share(prepared_cohort(spark, sf), CANDIDATE_FEATURES))


@register("parse_time_lenient", """
SELECT event_id, epoch_us(TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP)) AS parsed_us,
       TRY_CAST(event_type AS TIMESTAMP) IS NULL AS bad_is_null FROM events""")
def q_parse_time(spark, sf):
    ev = driver_table(spark, sf, "events")
    return ev.select("event_id",
                     F.unix_micros(prep.parse_time_lenient(F.col("ts").cast("string"))).alias("parsed_us"),
                     prep.parse_time_lenient(F.col("event_type")).isNull().alias("bad_is_null"))


@register("time_parts", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS admit_year, CAST(month(ts) AS INTEGER) AS admit_month,
       CAST(day(ts) AS INTEGER) AS admit_day, CAST(hour(ts) AS INTEGER) AS admit_hour,
       CAST(isodow(ts) - 1 AS INTEGER) AS admit_dayofweek,
       CAST(floor((month(ts) % 12) / 3) + 1 AS INTEGER) AS admit_season
FROM events""")
def q_time_parts(spark, sf):
    ev = driver_table(spark, sf, "events").select("event_id", "ts")
    return prep.add_time_parts(ev, "ts").drop("ts")


@register("time_range", with_cohort("""
SELECT count(DISTINCT year(admit_time)) AS n_years, CAST(min(admit_time) AS VARCHAR) AS min_time,
       CAST(max(admit_time) AS VARCHAR) AS max_time FROM cohort"""))
def q_time_range(spark, sf):
    c = build_cohort(spark, sf)
    return c.agg(F.count_distinct(F.year("admit_time")).alias("n_years"),
                 F.min("admit_time").cast("string").alias("min_time"),
                 F.max("admit_time").cast("string").alias("max_time"))


@register("select_by_missingness", with_cohort("""
SELECT feature AS column_name, n_missing, n_rows, round(missing_rate, 6) AS missing_rate,
       missing_rate < 0.5 AS keep FROM miss"""))
def q_select_missing(spark, sf):
    train = prepared_cohort(spark, sf).where(F.col("split") == "train")
    return rounded(prep.fit_missingness(train, CANDIDATE_FEATURES, 0.5))


@register("removed_features", with_cohort("SELECT feature AS column_name FROM miss WHERE NOT (missing_rate < 0.5)"))
def q_removed(spark, sf):
    train = prepared_cohort(spark, sf).where(F.col("split") == "train")
    return prep.fit_missingness(train, CANDIDATE_FEATURES, 0.5).where(~F.col("keep")).select("column_name")


@register("impute_median", with_cohort("SELECT feature, round(fill, 6) AS fill FROM fills"))
def q_impute_median(spark, sf):
    return rounded(prepare(spark, sf).fills)


@register("impute_mean", with_cohort("""
SELECT feature, round(avg(value), 6) AS fill FROM long_all
WHERE split = 'train' AND feature IN (SELECT feature FROM kept) GROUP BY feature"""))
def q_impute_mean(spark, sf):
    p = prepare(spark, sf)
    c = prepared_cohort(spark, sf).where(F.col("split") == "train")
    return rounded(prep.fit_impute(c, p.features, "mean"))


@register("impute_zero", with_cohort("""
SELECT feature, count(*) AS n_rows, count(*) FILTER (WHERE coalesce(value, 0.0) = 0) AS n_zero,
       round(sum(coalesce(value, 0.0)), 4) AS total
FROM long_all WHERE feature IN (SELECT feature FROM kept) GROUP BY feature"""))
def q_impute_zero(spark, sf):
    p = prepare(spark, sf)
    c = prepared_cohort(spark, sf)
    fills = prep.fit_impute(c, p.features, "zero")
    long = prep.to_long(prep.apply_impute(c, fills), [], p.features)
    return long.groupBy("feature").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count_if(F.col("value") == 0).alias("n_zero"),
                                       F.round(F.sum("value"), 4).alias("total"))


@register("impute_applied", with_cohort("SELECT stay_id, feature, round(value, 6) AS value FROM ready"))
def q_impute_applied(spark, sf):
    p = prepare(spark, sf)
    return rounded(prep.to_long(p.data, ["stay_id"], p.features))


@register("impute_audit", with_cohort("""
SELECT count(*) FILTER (WHERE l.value IS NULL) AS missing_before,
       count(*) FILTER (WHERE coalesce(l.value, f.fill) IS NULL) AS missing_after,
       count(*) AS total_cells
FROM long_all l JOIN fills f ON l.feature = f.feature"""))
def q_impute_audit(spark, sf):
    p = prepare(spark, sf)
    c = prepared_cohort(spark, sf)
    # raw and imputed copies side by side in one projection, then one aggregate
    both = prep.apply_impute(
        c.select(*p.features, *[F.col(f).alias(f"raw__{f}") for f in p.features]), p.fills)
    return both.agg(
        sum(F.count_if(F.col(f"raw__{f}").isNull()) for f in p.features).alias("missing_before"),
        sum(F.count_if(F.col(f).isNull()) for f in p.features).alias("missing_after"),
        (F.count(F.lit(1)) * len(p.features)).alias("total_cells"))


@register("impute_mode", with_cohort("""
SELECT 'segment' AS feature, coalesce((
  SELECT segment FROM (SELECT segment, count(*) AS n FROM prepared
                       WHERE split = 'train' AND segment IS NOT NULL GROUP BY segment)
  ORDER BY n DESC, segment ASC LIMIT 1), 'Unknown') AS fill"""))
def q_impute_mode(spark, sf):
    train = prepared_cohort(spark, sf).where(F.col("split") == "train")
    return prep.fit_mode(train, ["segment"])


@register("standardise_train", with_cohort("""
SELECT feature, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
       round(CASE WHEN stddev_pop(value) = 0 OR stddev_pop(value) IS NULL THEN 1.0 ELSE stddev_pop(value) END, 6) AS scale
FROM train GROUP BY feature"""))
def q_standardise_train(spark, sf):
    p = prepare(spark, sf)
    return rounded(prep.fit_standardiser(p.train, p.features))


@register("standardise_test", with_cohort("""
, st AS (SELECT feature, avg(value) AS mean,
               CASE WHEN stddev_pop(value) = 0 OR stddev_pop(value) IS NULL THEN 1.0 ELSE stddev_pop(value) END AS scale
        FROM train GROUP BY feature)
SELECT t.stay_id, t.feature, round((t.value - s.mean) / s.scale, 6) AS value
FROM test t JOIN st s ON t.feature = s.feature""").replace("\n, st AS", ",\nst AS"))
def q_standardise_test(spark, sf):
    p = prepare(spark, sf)
    fitted = prep.fit_standardiser(p.train, p.features)
    return rounded(prep.to_long(prep.apply_standardiser(p.test, fitted), ["stay_id"], p.features))


@register("semi_join_subjects", with_cohort("""
SELECT stay_id, subject_id FROM cohort
WHERE subject_id IN (SELECT subject_id FROM cohort WHERE label = 1 AND segment = 'BUILDING')"""))
def q_semi(spark, sf):
    c = build_cohort(spark, sf)
    keys = c.where((F.col("label") == 1) & (F.col("segment") == "BUILDING")).select("subject_id")
    return split.semi_join_keys(c, keys, "subject_id").select("stay_id", "subject_id")


@register("anti_join_subjects", with_cohort("""
SELECT stay_id, subject_id FROM cohort
WHERE subject_id NOT IN (SELECT subject_id FROM cohort WHERE label = 1 AND segment = 'BUILDING')"""))
def q_anti(spark, sf):
    c = build_cohort(spark, sf)
    keys = c.where((F.col("label") == 1) & (F.col("segment") == "BUILDING")).select("subject_id")
    return split.anti_join_keys(c, keys, "subject_id").select("stay_id", "subject_id")


@register("group_split", with_cohort("SELECT stay_id, subject_id, split FROM prepared"))
def q_group_split(spark, sf):
    return split.group_split(build_cohort(spark, sf), "subject_id").select("stay_id", "subject_id", "split")


@register("group_split_exact", with_cohort(f"""
, s AS (SELECT subject_id, row_number() OVER (ORDER BY {H13.format(k='subject_id')}, subject_id) AS r,
               count(*) OVER () AS n
        FROM (SELECT DISTINCT subject_id FROM cohort))
SELECT c.stay_id, c.subject_id, CASE WHEN s.r <= ceil(0.2 * s.n) THEN 'test' ELSE 'train' END AS split
FROM cohort c JOIN s ON c.subject_id = s.subject_id""").replace("\n, s AS", ",\ns AS"))
def q_group_split_exact(spark, sf):
    c = build_cohort(spark, sf)
    return split.split_exact(c, "subject_id", 0.2).select("stay_id", "subject_id", "split")


@register("split_leak_check", with_cohort("""
SELECT count(DISTINCT subject_id) FILTER (WHERE split = 'train') AS n_train_subjects,
       count(DISTINCT subject_id) FILTER (WHERE split = 'test') AS n_test_subjects,
       count(*) FILTER (WHERE split = 'train') AS n_train_rows,
       count(*) FILTER (WHERE split = 'test') AS n_test_rows,
       (SELECT count(*) FROM (SELECT subject_id FROM prepared GROUP BY subject_id
                              HAVING count(DISTINCT split) > 1)) AS n_shared_subjects
FROM prepared"""))
def q_split_leak(spark, sf):
    s = split.group_split(build_cohort(spark, sf), "subject_id")
    # one row per subject (pre-aggregated per task), then one global aggregate
    per_subject = s.groupBy("subject_id").agg(
        F.count_distinct("split").alias("_k"),
        F.count_if(F.col("split") == "train").alias("_tr"),
        F.count_if(F.col("split") == "test").alias("_te"))
    return per_subject.agg(
        F.count_if(F.col("_tr") > 0).alias("n_train_subjects"),
        F.count_if(F.col("_te") > 0).alias("n_test_subjects"),
        F.sum("_tr").cast("bigint").alias("n_train_rows"),
        F.sum("_te").cast("bigint").alias("n_test_rows"),
        F.count_if(F.col("_k") > 1).alias("n_shared_subjects"))


@register("stratified_folds", with_cohort(f"""
SELECT stay_id, label,
       CAST((row_number() OVER (PARTITION BY label ORDER BY {H13.format(k='stay_id')}, stay_id) - 1) % 3 AS INTEGER) AS fold
FROM prepared WHERE split = 'train'"""))
def q_folds(spark, sf):
    train = prepared_cohort(spark, sf).where(F.col("split") == "train").select("stay_id", "label")
    return split.stratified_folds(train, "stay_id", "label", 3)
