"""Profiling and source queries (S1, P1-P14) over the raw cohort."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomekit.operators import profile
from outcomekit.plans.catalog import register, rounded
from outcomekit.plans.sql import with_cohort
from outcomekit.sources.cohort import COHORT_FEATURES, build_cohort, driver_table
from outcomekit.sources.tables import normalise_nulls

RAW_COLS = ["stay_id", "subject_id", "admit_time", "label", "segment", *COHORT_FEATURES]


@register("scan_normalised", """
SELECT event_id, CASE WHEN isnan(value) THEN NULL ELSE round(value, 6) END AS value,
       CASE WHEN trim(event_type) IN ('', 'NA', 'N/A', 'NaN', 'nan', 'null', 'NULL', 'None', '#N/A', 'n/a', '-NaN', '-nan')
            THEN NULL ELSE event_type END AS event_type
FROM events""")
def q_scan_normalised(spark, sf):
    ev = driver_table(spark, sf, "events").select("event_id", "value", "event_type")
    return rounded(normalise_nulls(ev))


@register("profile_shape", with_cohort("SELECT count(*) AS n_rows, 15 AS n_columns FROM cohort"))
def q_shape(spark, sf):
    return profile.shape(build_cohort(spark, sf))


@register("preview_topn", with_cohort("""
SELECT stay_id, subject_id, CAST(admit_time AS VARCHAR) AS admit_time, label, segment,
       round(total, 6) AS total, round(qty_max, 6) AS qty_max
FROM cohort ORDER BY stay_id LIMIT 5"""))
def q_preview(spark, sf):
    c = build_cohort(spark, sf).select("stay_id", "subject_id", F.col("admit_time").cast("string").alias("admit_time"),
                                       "label", "segment", "total", "qty_max")
    return rounded(profile.preview(c, ["stay_id"], 5))


def _miss_sql():
    parts = [f"SELECT {i} AS column_pos, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
             f"count(*) AS n_rows FROM cohort" for i, c in enumerate(RAW_COLS)]
    return "m AS (" + " UNION ALL ".join(parts) + ")"


@register("missing_by_column", with_cohort(f""", {_miss_sql()}
SELECT column_pos, column_name, n_missing, round(n_missing / n_rows, 6) AS missing_rate
FROM m WHERE n_missing > 0 ORDER BY column_pos LIMIT 10""").replace("\n, m AS", ",\nm AS"))
def q_missing_by_column(spark, sf):
    return rounded(profile.missing_by_column(build_cohort(spark, sf), 10))


@register("missing_total", with_cohort(f""", {_miss_sql()}
SELECT CAST(sum(n_missing) AS BIGINT) AS total_missing, CAST(max(n_rows) * count(*) AS BIGINT) AS total_cells,
       round(sum(n_missing) / (max(n_rows) * count(*)), 6) AS missing_share FROM m""").replace("\n, m AS", ",\nm AS"))
def q_missing_total(spark, sf):
    return rounded(profile.missing_total(build_cohort(spark, sf)))


@register("label_distribution", with_cohort("""
SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM cohort WHERE label IS NOT NULL GROUP BY label"""))
def q_label_distribution(spark, sf):
    return rounded(profile.label_distribution(build_cohort(spark, sf), "label"))


def _describe_sql(src: str) -> str:
    return f"""
SELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
       round(max(value), 6) AS max
FROM {src} WHERE value IS NOT NULL GROUP BY feature"""


@register("describe_numeric", with_cohort(_describe_sql("long_all")))
def q_describe(spark, sf):
    from outcomekit.plans.prepared import CANDIDATE_FEATURES, prepared_cohort
    return rounded(profile.describe(prepared_cohort(spark, sf), CANDIDATE_FEATURES))


@register("duplicate_rows", """
WITH g AS (SELECT text, lang, source, count(*) AS c FROM documents GROUP BY text, lang, source)
SELECT CAST(sum(c - 1) AS BIGINT) AS n_duplicates, count(*) FILTER (WHERE c > 1) AS n_duplicate_groups,
       CAST(sum(c) AS BIGINT) AS n_rows FROM g""")
def q_duplicates(spark, sf):
    return profile.duplicate_rows(driver_table(spark, sf, "documents"), ["text", "lang", "source"])


@register("key_column_card", with_cohort("""
SELECT 'subject_id' AS column_name, 'bigint' AS dtype, count(DISTINCT subject_id) AS n_unique,
       min(CAST(subject_id AS VARCHAR)) AS sample FROM cohort
UNION ALL
SELECT 'stay_id', 'bigint', count(DISTINCT stay_id), min(CAST(stay_id AS VARCHAR)) FROM cohort"""))
def q_key_card(spark, sf):
    return profile.key_card(build_cohort(spark, sf), ["subject_id", "stay_id"])


@register("distinct_values", with_cohort("SELECT DISTINCT segment FROM cohort"))
def q_distinct(spark, sf):
    return profile.distinct_values(build_cohort(spark, sf), "segment")


@register("conditional_counts", with_cohort("""
SELECT count(*) FILTER (WHERE balance < 0) AS n_negative_balance,
       count(*) FILTER (WHERE qty_range = 0) AS n_zero_qty_range,
       count(*) FILTER (WHERE rare_qty IS NULL) AS n_null_rare_qty
FROM cohort"""))
def q_conditional(spark, sf):
    return profile.conditional_counts(build_cohort(spark, sf), {
        "n_negative_balance": "balance < 0",
        "n_zero_qty_range": "qty_range = 0",
        "n_null_rare_qty": "rare_qty IS NULL",
    })


@register("range_scaled", with_cohort("""
SELECT round(min(total), 6) AS min_value, round(max(total), 6) AS max_value,
       round(min(total) / 12.0, 6) AS min_scaled, round(max(total) / 12.0, 6) AS max_scaled FROM cohort"""))
def q_range(spark, sf):
    return rounded(profile.value_range(build_cohort(spark, sf), "total", 12.0))
