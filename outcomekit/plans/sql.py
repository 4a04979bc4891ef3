"""Reference SQL (DuckDB dialect) for every checked query.

The same cohort, split and fitted steps as the Spark flows, written as plain
CTEs over the driver tables.  Long form replaces dynamic column lists: the
missingness cut becomes a semi-join on the kept feature names.
"""

from __future__ import annotations

from outcomekit.plans.prepared import CANDIDATE_FEATURES
from outcomekit.sources.cohort import MANY_LINES

SPLIT_SQL = ("CASE WHEN CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20 "
             "THEN 'test' ELSE 'train' END")


def _long_all() -> str:
    parts = [f"SELECT stay_id, subject_id, label, split, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM prepared"
             for f in CANDIDATE_FEATURES]
    return "\n  UNION ALL ".join(parts)


COHORT_CTES = f"""
li AS (
  SELECT l_orderkey,
         min(l_quantity) AS qty_min, max(l_quantity) AS qty_max,
         min(l_extendedprice) AS price_min, max(l_extendedprice) AS price_max,
         avg(l_discount) AS disc_mean,
         max(CASE WHEN l_returnflag = 'A' AND l_discount >= 0.09 THEN l_quantity END) AS rare_qty,
         count(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey),
cohort AS (
  SELECT o.o_orderkey AS stay_id, o.o_custkey AS subject_id, o.o_orderdate AS admit_time,
         CAST(o.o_orderpriority = '1-URGENT' AS INTEGER) AS label,
         c.c_mktsegment AS segment,
         c.c_acctbal AS balance, o.o_totalprice AS total,
         li.qty_min, li.qty_max, li.qty_max - li.qty_min AS qty_range,
         li.price_min, li.price_max, li.price_max - li.price_min AS price_range,
         li.disc_mean, li.rare_qty
  FROM orders o
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
prepared AS (
  SELECT stay_id, subject_id, admit_time, label, segment,
         CASE WHEN balance < 0 THEN 0.0 ELSE balance END AS balance,
         total, qty_min, qty_max, qty_range, price_min, price_max, price_range, disc_mean, rare_qty,
         CAST(year(admit_time) AS DOUBLE) AS admit_year,
         CAST(month(admit_time) AS DOUBLE) AS admit_month,
         CAST(day(admit_time) AS DOUBLE) AS admit_day,
         CAST(hour(admit_time) AS DOUBLE) AS admit_hour,
         CAST(isodow(admit_time) - 1 AS DOUBLE) AS admit_dayofweek,
         CAST(floor((month(admit_time) % 12) / 3) + 1 AS DOUBLE) AS admit_season,
         {SPLIT_SQL.format(k='subject_id')} AS split
  FROM cohort),
long_all AS (
  {_long_all()}),
miss AS (
  SELECT feature, count(*) FILTER (WHERE value IS NULL) AS n_missing, count(*) AS n_rows,
         count(*) FILTER (WHERE value IS NULL) / count(*) AS missing_rate
  FROM long_all WHERE split = 'train' GROUP BY feature),
kept AS (SELECT feature FROM miss WHERE missing_rate < 0.5),
fills AS (
  SELECT feature, quantile_cont(value, 0.5) AS fill
  FROM long_all WHERE split = 'train' AND feature IN (SELECT feature FROM kept) GROUP BY feature),
ready AS (
  SELECT l.stay_id, l.subject_id, l.label, l.split, l.feature, coalesce(l.value, f.fill) AS value
  FROM long_all l JOIN fills f ON l.feature = f.feature),
train AS (SELECT * FROM ready WHERE split = 'train'),
test AS (SELECT * FROM ready WHERE split = 'test'),
moments AS (
  SELECT feature,
         count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std,
         min(value) AS min, max(value) AS max,
         count(value) FILTER (WHERE label = 0) AS n_0,
         avg(value) FILTER (WHERE label = 0) AS mean_0,
         var_samp(value) FILTER (WHERE label = 0) AS var_0,
         count(value) FILTER (WHERE label = 1) AS n_1,
         avg(value) FILTER (WHERE label = 1) AS mean_1,
         var_samp(value) FILTER (WHERE label = 1) AS var_1,
         covar_samp(value, CAST(label AS DOUBLE)) AS cov_xy,
         stddev_samp(CAST(label AS DOUBLE)) AS std_y
  FROM train GROUP BY feature)
"""


URGENT_SQL = "CAST(o.o_orderpriority = '1-URGENT' AS INTEGER) AS label"
MANY_LINES_SQL = f"CAST(coalesce(li.n_lines, 0) > {MANY_LINES} AS INTEGER) AS label"


def with_cohort(body: str) -> str:
    return "WITH " + COHORT_CTES.strip() + "\n" + body.strip()


def many_lines(sql: str) -> str:
    """``sql`` for the cohort whose label is an order of many lines."""
    if URGENT_SQL not in sql:
        raise ValueError("no cohort in this SQL")
    return sql.replace(URGENT_SQL, MANY_LINES_SQL)


def r6(expr: str, alias: str, places: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {places}) AS {alias}"


def t_pvalue_ctes(src: str, t_col: str, nu_col: str, name: str, steps: int = 20000) -> str:
    """CTE ``name`` (feature, p) = two-sided Student-t tail by Simpson's rule on
    p = 2 G((v+1)/2) / (sqrt(pi) G(v/2)) * int_{atan(|t|/sqrt v)}^{pi/2} cos^(v-1) u du."""
    return f"""
{name}_in AS (
  SELECT feature, CAST({t_col} AS DOUBLE) AS t, CAST({nu_col} AS DOUBLE) AS nu FROM {src}),
{name}_grid AS (
  SELECT i.i, p.feature, p.t, p.nu,
         atan(abs(p.t) / sqrt(p.nu)) AS th0,
         (pi() / 2 - atan(abs(p.t) / sqrt(p.nu))) / {steps} AS h
  FROM {name}_in p, (SELECT range AS i FROM range(0, {steps} + 1)) i
  WHERE p.t IS NOT NULL AND p.nu > 0 AND isfinite(p.t)),
{name}_int AS (
  SELECT feature, any_value(nu) AS nu,
         sum(CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
             * pow(greatest(cos(th0 + i * h), 0.0), nu - 1)) * any_value(h) / 3 AS integral
  FROM {name}_grid GROUP BY feature),
{name} AS (
  SELECT p.feature,
         CASE WHEN p.t IS NULL OR NOT (p.nu > 0) THEN NULL
              WHEN NOT isfinite(p.t) THEN 0.0
              ELSE least(1.0, 2 * exp(lgamma((q.nu + 1) / 2) - lgamma(q.nu / 2)) / sqrt(pi()) * q.integral) END AS p
  FROM {name}_in p LEFT JOIN {name}_int q ON p.feature = q.feature)"""
