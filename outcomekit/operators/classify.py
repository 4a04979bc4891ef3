"""Closed-form classifiers whose fit is an aggregate and whose scoring is a
projection: Gaussian naive Bayes (M8) and nearest centroid.

``fit_*`` returns one row per (class, feature) — bounded by the schema, so
it is pulled once and applied as literals inside a single projection (no
join, no shuffle, stream-safe).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomekit.operators.prep import fitted_rows

PER_PASS = 100               # features of one aggregate


def _moments(df: DataFrame, features: list[str], by: list[str]) -> DataFrame:
    """(by.., feature, mu, var): mean and population variance, ``PER_PASS``
    features a pass over the rows as they are, not one row per feature."""
    out = None
    for lo in range(0, len(features), PER_PASS):
        some = features[lo:lo + PER_PASS]
        values = [F.col(f"`{f}`").cast("double") for f in some]
        agg = df.groupBy(*by).agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)],
                                  *[F.var_pop(v).alias(f"v{i}") for i, v in enumerate(values)])
        rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"m{i}").alias("mu"), F.col(f"v{i}").alias("var"))
                         for i, f in enumerate(some)])
        part = agg.select(*by, F.inline(rows))
        out = part if out is None else out.unionByName(part)
    return out


def fit_gaussian_nb(train: DataFrame, features: list[str], label: str = "label",
                    var_smoothing: float = 1e-9) -> DataFrame:
    """(label, feature, mu, var, prior): population variance per class plus
    var_smoothing * the largest overall feature variance (scikit-learn rule)."""
    per = _moments(train, features, [label])
    eps = _moments(train, features, []).agg((F.lit(var_smoothing) * F.max("var")).alias("eps"))
    priors = train.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    priors = priors.select(label, (F.col("_n") / F.sum("_n").over(_all())).alias("prior"))
    e = eps.first()["eps"]
    return per.join(priors, label).select(
        label, "feature", "mu", (F.col("var") + F.lit(e)).alias("var"), "prior")


def _all():
    from pyspark.sql import Window
    return Window.partitionBy()


def _jll(rows, label_value, features) -> Column:
    stats = {r.feature: r for r in rows if r[0] == label_value}
    prior = next(iter(stats.values())).prior
    terms = [F.lit(math.log(prior))]
    for f in features:
        s = stats[f]
        terms.append(F.lit(-0.5 * math.log(2 * math.pi * s.var)))
        terms.append(F.lit(-0.5) * (F.col(f"`{f}`") - F.lit(s.mu)) ** 2 / F.lit(s.var))
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def apply_gaussian_nb(df: DataFrame, fitted: DataFrame, features: list[str],
                      out: str = "score", margin: str = "margin") -> DataFrame:
    """P(class 1 | x) as ``score`` and its log-odds as ``margin`` — a projection
    with literal class stats.  Rank by the margin: probabilities near 0 and 1
    run together."""
    rows = fitted_rows(fitted)
    j0, j1 = _jll(rows, 0, features), _jll(rows, 1, features)
    return df.withColumns({margin: j1 - j0, out: F.lit(1.0) / (F.lit(1.0) + F.exp(j0 - j1))})


def fit_centroids(train: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """(label, feature, mu, scale): class means of features standardised by the
    overall population std (zero std -> 1)."""
    per = _moments(train, features, [label]).drop("var")
    sc = _moments(train, features, []).withColumn("s", F.sqrt("var")).select(
        "feature", F.when((F.col("s") == 0) | F.col("s").isNull(), F.lit(1.0)).otherwise(F.col("s")).alias("scale"))
    return per.join(sc, "feature").select(label, "feature", "mu", "scale")


def apply_centroids(df: DataFrame, fitted: DataFrame, features: list[str], out: str = "score",
                    margin: str = "margin") -> DataFrame:
    """margin = d0^2 - d1^2 over standardised squared distances, score = its logistic."""
    rows = fitted_rows(fitted)
    by ={(r[0], r.feature): r for r in rows}

    def d2(c):
        acc = None
        for f in features:
            r = by[(c, f)]
            t = ((F.col(f"`{f}`") - F.lit(r.mu)) / F.lit(r.scale)) ** 2
            acc = t if acc is None else acc + t
        return acc
    return df.withColumns({margin: d2(0) - d2(1), out: F.lit(1.0) / (F.lit(1.0) + F.exp(d2(1) - d2(0)))})
