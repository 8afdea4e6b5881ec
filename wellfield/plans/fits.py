"""Queries over cleaned series, breaks and fits; none is a matter of SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import fits as T
from ..operators import header as H
from ..operators import production as P
from ..operators.chunks import in_chunks
from ..session import shared_dir
from ..sources import fixtures as X


def series(spark, d):
    """Production rates of the preferred source, one row per month."""
    rows = P.months_producing(P.preferred(X.production(spark, d)))
    rows = rows.groupBy("wellid", "measure", "months").agg(F.sum("value").alias("value"))
    method = X.well_header(spark, d).select("wellid", H.fit_method(F.col("fitmethod")).alias("fitmethod"))
    return rows.join(method, "wellid").select("wellid", "measure", F.col("months").cast("int").alias("months"), "value", "fitmethod")


def declining(spark, d):
    """Series that follow a known curve, with a ripple of two in a hundred."""
    t = F.explode(F.sequence(F.lit(0), F.lit(59)))
    wells = X.well_header(spark, d).withColumn("months", t)
    first = (F.pow(F.lit(0.4), F.lit(-0.9)) - 1) / 0.9 / 12
    value = 900 * F.pow(1 + 0.9 * first * F.col("months"), F.lit(-1 / 0.9)) * (1 + F.sin(F.col("months") * 7.0 + X.well()) / 50)
    return wells.select("wellid", F.lit("OIL").alias("measure"), F.col("months").cast("int").alias("months"), value.alias("value"), F.lit("curve_fit").alias("fitmethod"))


def b3_outliers(spark, d):
    return T.months_cleaned(series(spark, d)).select("wellid", "measure", "months", "value")


def b4_changepoints(spark, d):
    return T.with_segments(series(spark, d)).select("wellid", "measure", "months", "segment")


def _fitted(frame):
    return frame.select("wellid", "measure", "n", "analyst", *(F.round(c, 4).alias(c) for c in ("qi", "dei", "b", "r2")))


def b5_segment_choice(spark, d):
    rows = T.with_segments(series(spark, d))
    return _fitted(T.fit(rows, T.FitConfig(segment="first")))


def b6_head_outliers(spark, d):
    rows = declining(spark, d).withColumn("value", F.when(F.col("months") == 1, F.col("value") * 5).otherwise(F.col("value"))).withColumn("segment", F.lit(1))
    return _fitted(T.fit(rows, T.FitConfig(segment="all")))


def b8_curve_fit(spark, d):
    return _fitted(T.fit(declining(spark, d).withColumn("segment", F.lit(1))))


def b9_evolution(spark, d):
    return _fitted(T.fit(declining(spark, d).withColumn("segment", F.lit(1)).withColumn("fitmethod", F.lit("differential_evolution"))))


def b10_monte_carlo(spark, d):
    return _fitted(T.fit(declining(spark, d).withColumn("segment", F.lit(1)).withColumn("fitmethod", F.lit("monte_carlo"))))


def b11_fit_driver(spark, d):
    return _fitted(T.fit(T.with_segments(series(spark, d))))


def b12_auto_forecast(spark, d):
    return _fitted(T.auto_forecast(series(spark, d)))


def b12_chunked_fits(spark, d):
    """Fits chunk by chunk, each committed before the next; a run that breaks off goes on after the last one."""
    folder = f"{shared_dir(spark)}/fits-{uuid.uuid4().hex[:12]}"
    return _fitted(in_chunks(declining(spark, d), ["wellid", "measure"], T.auto_forecast, folder, chunks=4))


def b10_diagnostics(spark, d):
    """How far a sampled fit can be trusted, well by well, and how near the approximation comes."""
    rows = declining(spark, d).withColumn("segment", F.lit(1)).withColumn("fitmethod", F.lit("monte_carlo"))
    fitted = lambda sampler: T.fit(rows, T.FitConfig(sampler=sampler))
    near = fitted("mean_field").select("wellid", "measure", *(F.col(c).alias(f"near_{c}") for c in ("qi", "dei", "b")))
    return fitted("hamiltonian").join(near, ["wellid", "measure"]).select("wellid", "measure", F.round("ess", 1).alias("ess"), F.round("rhat", 3).alias("rhat"), *(F.round(F.col(f"near_{c}") / F.col(c), 3).alias(f"{c}_ratio") for c in ("qi", "dei", "b")))


def b14_draws(spark, d):
    fitted = T.fit(declining(spark, d).withColumn("segment", F.lit(1)).withColumn("fitmethod", F.lit("monte_carlo")))
    return fitted.select("wellid", "measure", F.posexplode("draws").alias("draw", "p")).select("wellid", "measure", "draw", *(F.round(F.col("p")[c], 4).alias(c) for c in ("qi", "dei", "b")))


QUERIES = {f.__name__: f for f in (b3_outliers, b4_changepoints, b5_segment_choice, b6_head_outliers, b8_curve_fit, b9_evolution, b10_monte_carlo, b11_fit_driver, b12_auto_forecast, b10_diagnostics, b12_chunked_fits, b14_draws)}
ORACLES: dict[str, str] = {}
