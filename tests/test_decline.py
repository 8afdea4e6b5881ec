"""Decline curves, fits and properties against closed forms."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wellfield.functions import fluids as L
from wellfield.functions import kernels as K
from wellfield.functions.decline import Curve, decline_for
from wellfield.operators import fits as T
from wellfield.operators import forecast as Q

#: qi, dei, def, b, t, q, de, np: hand-checked.
CASES = [
    (1000, 0.50, 0.08, 0.8, 12, 500.000000, 0.35807611, 255020.7668), (1000, 0.50, 0.08, 0.8, 120, 69.813551, 0.10017390, 813228.0857), (1000, 0.50, 0.08, 0.8, 360, 12.603575, 0.08, 1051620.8741),
    (1000, 0.50, 0.08, 1.0, 12, 500.000000, 0.33333333, 252998.7209), (1000, 0.50, 0.08, 1.0, 120, 90.909091, 0.08333333, 875231.7746), (1000, 0.50, 0.08, 1.0, 360, 17.091784, 0.08, 1196960.8695),
    (1000, 0.70, 0.06, 1.2, 120, 53.717713, 0.07425314, 536971.9820), (1000, 0.70, 0.06, 1.2, 360, 15.164261, 0.06, 756369.1423), (1000, 0.08, 0.08, 1.0, 12, 920.000000, 0.08, 350197.1283),
]


def test_curve_cases(spark):
    rows = spark.createDataFrame([tuple(map(float, c)) for c in CASES], "qi double, dei double, deff double, b double, t double, q double, d double, np double")
    c = Curve(F.col("qi"), F.col("dei"), F.col("deff"), F.col("b"))
    for r in rows.select("*", c.rate(F.col("t")).alias("q1"), c.decline(F.col("t")).alias("d1"), c.cumulative(F.col("t")).alias("n1"), c.daily_rate(F.col("t")).alias("q2")).collect():
        assert r.q1 == pytest.approx(r.q, abs=1e-5) and r.d1 == pytest.approx(r.d, abs=1e-7) and r.n1 == pytest.approx(r.np, abs=1e-2) and r.q2 == pytest.approx(r.q, abs=1e-5)
        assert K.rate(np.array([r.t]), r.qi, r.dei, r.deff, r.b)[0] == pytest.approx(r.q, abs=1e-5)


def test_volume_is_the_integral_of_rate(spark):
    rows = spark.range(0, 361).select(F.col("id").cast("double").alias("t"))
    for dei, deff, b in ((0.6, 0.08, 0.9), (0.6, 0.08, 1.0), (0.08, 0.08, 1.0), (0.5, 0.3, 1.3)):
        c = Curve.of(F.lit(500.0), F.lit(dei), F.lit(deff), F.lit(b))
        got = rows.select("t", c.rate(F.col("t")).alias("q"), c.cumulative(F.col("t")).alias("n")).orderBy("t").toPandas()
        assert got.q[0] == pytest.approx(500) and got.n[0] == pytest.approx(0, abs=1e-6) and (np.diff(got.q) < 0).all()
        slope, q = np.diff(got.n) / (365 / 12), got.q.to_numpy()
        between = (slope <= q[:-1] + 1e-6) & (slope >= q[1:] - 1e-6)
        assert (~between).sum() <= 1  # the month in which the decline reaches the terminal one


def test_decline_for_reaches_the_end_rate(spark):
    d = decline_for(F.lit(100.0), F.lit(200.0), F.lit(6))
    r = spark.range(1).select(d.alias("d"), Curve.of(F.lit(100.0), d, d, 1.0).rate(F.lit(6)).alias("q")).first()
    assert r.d == pytest.approx(-3.0) and r.q == pytest.approx(200.0)


def segment_rows(spark, **changes):
    base = {"id": 1, "q1": 900.0, "q2": 700.0, "q3": 400.0, "dei": 0.6, "def": 0.08, "b_factor": 0.9, "qabn": 1.0, "t1": 0, "t2": 0}
    return spark.createDataFrame(pd.DataFrame([base | changes]))


@pytest.mark.parametrize("t1, t2, count", [(0, 0, 120), (6, 0, 120), (6, 12, 120)])
def test_segments_are_gapless(spark, t1, t2, count):
    got = Q.segments(segment_rows(spark, t1=t1, t2=t2), ["id"], duration=120, prior_cum=10.0).orderBy("month").toPandas()
    assert got.month.tolist() == list(range(1, count + 1)) and (got.volume > 0).all()
    assert got.cumulative.iloc[0] - got.volume.iloc[0] == pytest.approx(10.0)
    assert np.allclose(np.diff(got.cumulative), got.volume.iloc[1:])


def test_segments_quirks(spark):
    assert Q.segments(segment_rows(spark, q3=0.0), ["id"], duration=5).agg(F.sum("cumulative"), F.count("*")).first() == (0.0, 5)
    rolled = lambda compat: Q.segments(segment_rows(spark, t1=6), ["id"], duration=60, prior_t=10, compat=compat).agg(F.max("month")).first()[0]
    assert rolled(True) == 50 and rolled(False) == 60
    cut = Q.segments(segment_rows(spark, qabn=100.0), ["id"]).agg(F.min("q")).first()[0]
    assert cut >= 100.0


@pytest.mark.parametrize("noise, within", [(0.0, 0.01), (0.05, 0.15)])
def test_fits_recover_a_curve(noise, within):
    rng, t = np.random.default_rng(7), np.arange(80.0)
    q = K.rate(t, 800.0, 0.65, 0.08, 0.9) * np.exp(rng.normal(0, noise, 80))
    start, bounds = {"qi": 750.0, "dei": 0.5, "b": 1.0}, {"qi": (600.0, 900.0), "dei": (0.1, 0.98), "b": (0.5, 1.4)}
    for method in T.METHODS:
        found, draws = T.fit_curve(t, q, start, bounds, {"deff": 0.08}, method, 400, 400, 3)
        fitted = K.rate(t, deff=0.08, **found)
        truth = K.rate(t, 800.0, 0.65, 0.08, 0.9)
        assert np.abs(fitted / truth - 1).mean() < max(within, 0.12 if method == "monte_carlo" else 0)
        assert (draws is not None) == (method == "monte_carlo")


@pytest.mark.parametrize("change", [{"method": "x"}, {"start": {"z": 1.0}}, {"fixed": {"qi": 1.0}}, {"bounds": {}}])
def test_fit_arguments_are_checked(change):
    given = {"start": {"qi": 1.0}, "bounds": {"qi": (0.5, 2.0)}, "fixed": {"deff": 0.1, "dei": 0.5, "b": 1.0}, "method": "curve_fit"} | change
    with pytest.raises(ValueError):
        T.fit_curve(np.arange(5.0), np.ones(5), given["start"], given["bounds"], given["fixed"], given["method"], 10, 10, 1)


def test_breaks_find_a_level_change():
    signal = np.r_[np.full(30, 10.0), np.full(30, 50.0)] + np.random.default_rng(1).normal(0, 1, 60)
    ends = K.breaks(signal, 3.0)
    assert ends[-1] == 60 and 30 in ends
    numbers = K.segment_numbers(60, [30, 60])
    assert [(numbers == k).sum() for k in (1, 2, 3)] == [29, 30, 1]
    assert K.breaks(signal[:10], 1.0) == []


def test_outliers_and_heads():
    q = K.rate(np.arange(40.0), 500.0, 0.5, 0.08, 1.0)
    q[20] *= 8
    keep = K.typical_points(q, np.arange(40.0))
    assert not keep[19] and not keep[21] and keep[5:15].all()  # a spike shows in its neighbours' derivatives
    assert T.head_outliers(np.array([9000.0, 100.0, 99.0, 98.0, 97.0, 96.0, 95.0])) == 1


def test_short_and_low_series_take_guesses():
    frame = lambda v: pd.DataFrame({"wellid": 1, "measure": "OIL", "months": range(len(v)), "value": v, "segment": 1, "fitmethod": "curve_fit"})
    assert T.fit_group(frame([5.0, 4.0]), T.FitConfig())["analyst"] == "auto_fit_3"
    assert T.fit_group(frame([0.5] * 20), T.FitConfig())["analyst"] == "auto_fit_3"
    assert T.fit_group(frame([50.0, 45, 40, 36, 33, 30]), T.FitConfig())["analyst"] == "auto_fit_2"


def test_z_factor(spark):
    row = spark.createDataFrame([(6000.0, 100.0, 0.6, 0.0, 0.0), (0.01, 100.0, 0.6, 0.0, 0.0)], "p double, t double, sg double, co2 double, h2s double")
    z = [r.z for r in row.select(L.z_factor(*(F.col(c) for c in ("p", "t", "sg", "co2", "h2s"))).alias("z")).collect()]
    assert z[0] == pytest.approx(1.054119, abs=1e-5) and z[1] == pytest.approx(1.0, abs=1e-4)
    swinging = row.limit(1).select(L.z_factor(*(F.col(c) for c in ("p", "t", "sg", "co2", "h2s")), compat=True).alias("z")).first().z
    assert min(abs(swinging - 0.833952), abs(swinging - 1.591384)) < 1e-3


def test_gas_residue_is_whole(spark):
    rows = spark.createDataFrame([(1, c, 100.0, 0.0, m, 20.0, 1000.0, r, None) for c, m, r in (("a", 0.5, 0.0), ("b", 0.3, 0.4), ("c", 0.2, 1.0))], "stream_id int, component string, volume_mcf double, shrink double, mol_pct double, liquid double, btu double, recovery double, pop double")
    got = L.processing(rows, base_psi=14.696).agg(F.sum("residue_btu")).first()[0]
    assert got == pytest.approx(1000.0)


def test_npv_closed_form(spark):
    from wellfield.operators.economics import present_value

    months = spark.range(0, 12).select(F.col("id").alias("month"), F.lit(100.0).alias("net_cf"))
    assert months.agg(present_value(F.lit(0.1))).first()[0] == pytest.approx(1144.585212, abs=1e-5)
    assert months.agg(present_value(F.lit(0.0))).first()[0] == pytest.approx(1200.0) and math.isfinite(1.0)
