"""The automatic fit's parts against plain versions: b's limits, breaks, head outliers, samplers, resumed runs."""

import itertools

import numpy as np
import pandas as pd
import pyspark.sql.functions as F
import pytest

from wellfield.functions import batches as B
from wellfield.functions import kernels as K
from wellfield.functions import posterior as P
from wellfield.operators import fits as T
from wellfield.operators import forecast as Q
from wellfield.operators.chunks import finished, in_chunks
from wellfield.plans import fits as plans

SF = "/root/testdata/sf0.001"


def series(seed, n=70, gaps=False, peak=0):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.choice(np.arange(1, 2 * n), n, replace=False)) if gaps else np.arange(1, n + 1)
    q = K.rate(t - 1.0, 900.0, 0.6, 0.08, 0.9 + seed % 3 / 10) * np.exp(rng.normal(0, 0.004 * (seed % 4), n))
    q[:peak] = np.linspace(100, 800, peak)
    return t.astype(float), q


def plain_line(t, q):
    """Every limit with a regression of its own."""
    t, q = t[q > 0], q[q > 0]
    at = max(k for k in range(len(q)) if q[k] == q.max())
    t, q = t[at:], pd.Series(q[at:])
    if len(q) < 24:
        return None
    for _ in range(2):
        q = q.rolling(3, min_periods=1).mean()
    best = None
    for limit in range(24, 61):
        x, y = [], []
        for k in range(1, len(t)):
            d = np.log(q[k - 1] / q[k]) / (t[k] - t[k - 1])
            if t[k] <= limit and d and 0.001 * t[k] < (1 - d) / d < 3 * t[k]:
                x.append(t[k])
                y.append((1 - d) / d)
        if len(set(x)) < 2:
            continue
        slope, start = np.polyfit(x, y, 1)
        rest = np.array(y) - slope * np.array(x) - start
        r2 = 1 - rest @ rest / ((y - np.mean(y)) ** 2).sum()
        if best is None or round(r2, 9) > round(best[0], 9):
            wide = K.t_quantile(len(x) - 2) * np.sqrt(rest @ rest / (len(x) - 2) / ((x - np.mean(x)) ** 2).sum()) if len(x) > 2 else np.nan
            best = (r2, slope, slope - wide, slope + wide, limit)
    return best and best[1:]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("gaps, peak", [(False, 0), (True, 0), (False, 9), (True, 30)])
def test_line_of_b(seed, gaps, peak):
    t, q = series(seed, gaps=gaps, peak=peak)
    got, want = K.b_line(t, q), plain_line(t, q)
    assert (got is None) == (want is None)
    if want:
        assert got == pytest.approx(want, rel=1e-5, nan_ok=True)


def test_no_line_of_b():
    assert K.b_line(np.arange(30.0), np.zeros(30)) is None
    assert K.b_line(np.arange(10.0), np.ones(10)) is None
    assert K.b_line(np.arange(40.0), np.ones(40)) is None  # a flat series has no decline
    assert K.b_line(np.arange(40.0), np.arange(1.0, 41)) is None


def test_quantiles_of_t():
    for degrees, value in ((1, 6.31375), (2, 2.91999), (3, 2.35336), (10, 1.81246), (29, 1.69913), (58, 1.67155)):
        assert K.t_quantile(degrees) == pytest.approx(value, abs=1e-5)


@pytest.mark.parametrize("low, middle, high", list(itertools.product([None, 0.2, 1.39, 2.0], [None, 0.1, 1.0], [None, 0.95, 1.2, 9.0])))
def test_limits_of_b(spark, low, middle, high):
    """By hand: max and min as stated; the column version gives the same."""
    lo = max(low if low is not None else 0.5, 0.5)
    hi = min(max(high if high is not None else 1.4, lo * 1.1), 1.4)
    start = middle if middle is not None and lo <= middle <= hi else (lo + hi) / 2
    nan = lambda v: float("nan") if v is None else v
    assert K.b_limits(nan(low), nan(middle), nan(high)) == (round(lo, 4), round(start, 4), round(hi, 4))
    if middle in (None, 1.0) and high is None:
        row = spark.createDataFrame([(low, middle, high)], "a double, b double, c double").select(*Q.b_bounds(F.col("a"), F.col("b"), F.col("c"))).first()
        assert tuple(row) == pytest.approx((lo, start, hi), abs=1e-4)


def test_automatic_fits_take_the_limits_of_their_own_line(spark):
    """Each group's limits are those of the column version of the line, over the cleaned series."""
    frames = []
    for well in range(12):
        t, q = series(well, gaps=well % 2 == 1)
        frames.append(pd.DataFrame({"wellid": well, "measure": "OIL", "months": t.astype("int32"), "value": q, "fitmethod": "curve_fit"}))
    frames.append(pd.DataFrame({"wellid": 99, "measure": "OIL", "months": np.arange(8, dtype="int32"), "value": 50.0 - np.arange(8), "fitmethod": "curve_fit"}))
    rows = spark.createDataFrame(pd.concat(frames), "wellid long, measure string, months int, value double, fitmethod string")
    fitted = {r["wellid"]: r for r in T.auto_forecast(rows).collect()}
    clean = T.months_cleaned(rows)
    lines = Q.b_diagnostics(clean.select("wellid", "measure", F.col("months").alias("t"), F.col("value").alias("q")), ["wellid", "measure"])
    limits = {r["wellid"]: tuple(r)[1:] for r in lines.select("wellid", *Q.b_bounds(F.col("low"), F.col("slope"), F.col("high"))).collect()}
    assert len(limits) >= 10
    for well, row in fitted.items():
        assert (row["b_low"], row["b_start"], row["b_high"]) == pytest.approx(limits.get(well, (0.5, 1.0, 1.4)), abs=2e-4)
        if row["analyst"] == "auto_fit_1" and row["b_low"] <= row["b_high"]:
            assert row["b_low"] - 1e-9 <= row["b"] <= row["b_high"] + 1e-9
    assert {r["b_low"] for r in T.auto_forecast(rows, T.FitConfig(estimate_b=False)).collect()} == {0.5}


def test_limits_out_of_order_leave_b_alone():
    t, q = series(1)
    frame = pd.DataFrame({"wellid": 1, "measure": "OIL", "months": t, "value": q, "segment": 1, "fitmethod": "curve_fit", "b_low": 1.8, "b_start": 1.6, "b_high": 1.4})
    got = T.fit_group(frame, T.FitConfig())
    assert got["analyst"] == "auto_fit_2" and got["b"] == 1.6


def plain_heads(q, window=4, limit=3.0, most=2):
    for k in range(most + 1):
        if k == most or k + window + 1 >= len(q):
            return k
        near = sorted(q[k + 1 : k + 1 + window])
        middle = (near[1] + near[2]) / 2
        off = sorted(abs(x - middle) for x in near)
        if not abs(q[k] - middle) > limit * 1.4826 * ((off[1] + off[2]) / 2 + 1e-12):
            return k


def test_head_outliers_match_the_plain_rule():
    rng = np.random.default_rng(3)
    seen = set()
    for _ in range(400):
        q = rng.choice([1.0, 5.0, 6.0, 7.0, 40.0, 90.0], rng.integers(1, 12))
        assert T.head_outliers(q) == plain_heads(list(q))
        seen.add(T.head_outliers(q))
    assert seen == {0, 1, 2}


def plain_breaks(signal, penalty, least=6, jump=5):
    """Every set of break places, by full search; the kernel as one matrix."""
    n = len(signal)
    gaps = (signal[:, None] - signal[None, :]) ** 2
    kernel = np.exp(-np.clip(gaps / np.median(gaps[np.triu_indices(n, 1)]), 1e-2, 1e2))
    np.fill_diagonal(kernel, 1.0)
    cost = lambda a, b: (b - a) - kernel[a:b, a:b].sum() / (b - a)
    places = range(jump, n, jump)
    found = []
    for k in range(n // least + 1):
        for inner in itertools.combinations(places, k):
            ends = [0, *inner, n]
            if all(b - a >= least for a, b in zip(ends, ends[1:])):
                found.append((sum(cost(a, b) for a, b in zip(ends, ends[1:])) + penalty * (k + 1), ends[1:]))
    return min(found) if found else (0.0, [])


@pytest.mark.parametrize("seed", range(12))
def test_breaks_match_a_search_of_all_partitions(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(11, 56))
    signal = np.repeat(rng.normal(0, 6, 8), 7)[:n] + rng.normal(0, 0.7, n)
    worth, ends = plain_breaks(signal, 1.0)
    assert K.breaks(signal, 1.0) == ends


def test_breaks_of_long_series_stay_small():
    """20,000 points: one matrix over all pairs would take 3 GB."""
    import tracemalloc

    signal = np.repeat(np.random.default_rng(1).normal(0, 9, 200), 100) + np.random.default_rng(2).normal(0, 1, 20_000)
    tracemalloc.start()
    ends = K.breaks(signal[:6000], 3.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6 and 40 <= len(ends) <= 80


@pytest.mark.parametrize("n", [2, 3, 10, 51, 300])
def test_middle_gap_is_the_median_of_all_pairs(n):
    values = np.random.default_rng(n).integers(0, 20, n) / 7
    i, j = np.triu_indices(n, 1)
    assert K.middle_gap(values) == pytest.approx(np.median((values[i] - values[j]) ** 2), rel=1e-12, abs=0)


def model(learned=True, names=("qi", "dei", "b")):
    t = np.arange(60.0)
    logs = np.log(K.rate(t, 900.0, 0.6, 0.08, 0.9)) + np.random.default_rng(1).normal(0, 0.05, 60)
    low, high, centre = {"qi": 700.0, "dei": 0.1, "b": 0.5}, {"qi": 1000.0, "dei": 0.98, "b": 1.4}, {"qi": 880.0, "dei": 0.6, "b": 1.0}
    pick = lambda d: np.array([d[n] for n in names])
    fixed = {"deff": 0.08} | {n: centre[n] for n in centre if n not in names}
    return P.Model(t, logs, tuple(names), pick(low), pick(high), pick(centre), fixed, learned)


@pytest.mark.parametrize("learned", [True, False])
@pytest.mark.parametrize("names", [("qi", "dei", "b"), ("dei",)])
def test_gradients(learned, names):
    m = model(learned, names)
    x = m.coordinates(m.centre, 0.1) + np.random.default_rng(2).normal(0, 0.4, (5, m.size))
    slope = np.stack([(m.density(x + 1e-5 * e)[0] - m.density(x - 1e-5 * e)[0]) / 2e-5 for e in np.eye(m.size)], 1)
    assert m.density(x)[1] == pytest.approx(slope, rel=1e-5, abs=1e-4)


def test_log_rates_are_those_of_the_curve():
    t = np.arange(0.0, 400)
    value, _ = P.log_rate(t, [900.0, 50.0], [0.6, 0.9], [0.9, 1.3], 0.08)
    assert np.exp(value) == pytest.approx(np.stack([K.rate(t, 900.0, 0.6, 0.08, 0.9), K.rate(t, 50.0, 0.9, 0.08, 1.3)]), rel=1e-10)


def test_sampler_on_a_conjugate_density():
    """A normal mean under a normal prior, with a correlated partner: moments are known."""
    data = np.array([1.2, 0.7, 1.9, 1.4, 0.3])
    precision = 1 / 4 + len(data)
    middle = data.sum() / precision
    cov = np.array([[1 / precision, 0.3], [0.3, 1.0]])
    inverse = np.linalg.inv(cov)
    at = np.array([middle, -2.0])
    density = lambda x: (-0.5 * np.einsum("ci,ij,cj->c", x - at, inverse, x - at), -(x - at) @ inverse)
    draws = P.hamiltonian(density, np.zeros(2), np.eye(2), 1500, 300, 5)
    assert draws.mean((0, 1)) == pytest.approx(at, abs=0.06)
    assert np.cov(draws.reshape(-1, 2).T) == pytest.approx(cov, abs=0.08)
    assert all(P.split_rhat(draws[..., k]) < 1.02 and P.effective_size(draws[..., k]) > 1000 for k in (0, 1))
    means, wide, _ = P.mean_field(density, np.zeros(2), np.ones(2), 600, 10, 5)
    assert means == pytest.approx(at, abs=0.05)
    assert wide == pytest.approx(1 / np.sqrt(np.diag(inverse)), rel=0.1)  # independent normals are as narrow as that


def test_diagnostics_tell_good_draws_from_bad():
    rng = np.random.default_rng(1)
    good = rng.normal(size=(4, 500))
    slow = np.array([np.convolve(rng.normal(size=540), np.ones(40) / 40, "valid")[:500] for _ in range(4)])
    assert P.split_rhat(good) < 1.02 and 1200 < P.effective_size(good) < 3500
    assert P.effective_size(slow) < 250
    assert P.split_rhat(good + np.arange(4)[:, None]) > 1.5


def test_sampled_fits_agree(spark):
    """Chains agree on the fixture, and the approximation's means lie within the draws' spread."""
    rows = plans.declining(spark, SF).where("wellid <= 6").withColumn("segment", F.lit(1)).withColumn("fitmethod", F.lit("monte_carlo"))
    drawn = {r["wellid"]: r for r in T.fit(rows).collect()}
    near = {r["wellid"]: r for r in T.fit(rows, T.FitConfig(sampler="mean_field")).collect()}
    for well, row in drawn.items():
        assert row["rhat"] < 1.05 and row["ess"] > 60, row
        for name in ("qi", "dei", "b"):
            spread = np.std([d[name] for d in row["draws"]])
            assert abs(near[well][name] - row[name]) < 2 * spread + 1e-6


def test_learned_degrees_follow_the_errors():
    """Errors with heavy tails give few degrees, normal ones many."""
    t, rng = np.arange(200.0), np.random.default_rng(4)
    curve, degrees = np.log(K.rate(t, 900.0, 0.6, 0.08, 0.9)), []
    for errors in (rng.standard_t(2.1, 200) * 0.05, rng.normal(0, 0.05, 200)):
        m = P.Model(t, curve + errors, ("qi", "dei", "b"), np.array([700.0, 0.1, 0.5]), np.array([1000.0, 0.98, 1.4]), np.array([900.0, 0.6, 0.9]), {"deff": 0.08})
        peak, cov = m.peak(m.coordinates(m.centre, 0.05))
        degrees.append(2 + np.exp(P.hamiltonian(m.density, peak, cov, 200, 150, 1)[..., -1]).mean())
    assert degrees[0] < 4.5 < degrees[1]


def test_runs_go_on_where_they_broke_off(spark, tmp_path):
    rows, folder, calls = plans.declining(spark, SF).where("wellid <= 12"), f"file://{tmp_path}/fits", []

    def work(part, fail_at=None):
        calls.append(sorted(r[0] for r in part.select("wellid").distinct().collect()))
        if len(calls) == fail_at:
            raise RuntimeError("lost")
        return T.auto_forecast(part)

    with pytest.raises(RuntimeError):
        in_chunks(rows, ["wellid", "measure"], lambda p: work(p, 3), folder, chunks=5)
    before = finished(spark, folder)
    assert len(before) == 2
    got = in_chunks(rows, ["wellid", "measure"], work, folder, chunks=5)
    assert calls[3:] and not [c for c in calls[3:] if c in calls[:2]] and calls[2] == calls[3]
    columns = ["wellid", "measure", "analyst", "qi", "dei", "b"]
    want = T.auto_forecast(rows).select(*columns).orderBy("wellid").collect()
    assert got.select(*columns).orderBy("wellid").collect() == want
    n = len(calls)
    in_chunks(rows, ["wellid", "measure"], work, folder, chunks=5)
    assert len(calls) == n  # all was done
    changed = rows.withColumn("value", F.when(F.col("wellid") == 5, F.col("value") * 2).otherwise(F.col("value")))
    again = in_chunks(changed, ["wellid", "measure"], work, folder, chunks=5)
    assert len(calls) == n + 1 and 5 in calls[-1] and again.count() == len(want)
    assert in_chunks(rows.limit(0), ["wellid", "measure"], T.auto_forecast, f"file://{tmp_path}/none").count() == 0


def some_tasks(config, method=None, wells=24):
    tasks = []
    for well in range(wells):
        t, q = series(well, gaps=well % 2 == 1)
        q = q[: len(q) - well % 5 * 3]
        tasks.append(T._task(well, "OIL", np.asarray(t, float)[: len(q)], q, np.ones(len(q), int), method or "curve_fit", config.b, config))
    return tasks


@pytest.mark.parametrize("method, sampler", [("curve_fit", "hamiltonian"), ("differential_evolution", "hamiltonian"), ("monte_carlo", "hamiltonian"), ("monte_carlo", "mean_field")])
def test_fits_of_many_are_those_of_each(method, sampler):
    """What a series gives does not depend on those beside it, and is what it gives by itself."""
    config = T.FitConfig(trials=60, draws=80, sampler=sampler)
    tasks = some_tasks(config, method)
    found = T.fit_tasks(tasks, config)
    assert {f["analyst"] for f in found} == {"auto_fit_1"}
    noisy = [k for k in range(len(tasks)) if k % 4][:6]  # without noise a posterior has no width, and rounding decides
    for task, got in [(tasks[k], found[k]) for k in noisy]:
        want = T._alone(task, config)
        assert [got[c] for c in ("qi", "dei", "b", "r2")] == pytest.approx([want[c] for c in ("qi", "dei", "b", "r2")], rel=1e-4)
    halves = T.fit_tasks(tasks[:7], config) + T.fit_tasks(tasks[7:], config)
    assert [[f[c] for c in ("qi", "dei", "b")] for f in halves] == [[f[c] for c in ("qi", "dei", "b")] for f in found]


def test_fits_of_many_take_few_operations(monkeypatch):
    """A hundred series of a length share the calls that one needs."""
    calls, plain = [], B.rates
    monkeypatch.setattr(B, "rates", lambda *a, **k: calls.append(1) or plain(*a, **k))
    config = T.FitConfig()
    tasks = [T._task(k, "OIL", np.arange(60.0), K.rate(np.arange(60.0), 900.0 + k, 0.6, 0.08, 0.9), np.ones(60, int), "curve_fit", config.b, config) for k in range(100)]
    found = T.fit_tasks(tasks, config)
    assert len(found) == 100 and len(calls) < 27 + 2 * 200 + 2


def test_overflowing_and_unknown_series_go_alone():
    config = T.FitConfig()
    good, bad = some_tasks(config, wells=2)
    bad.q[:] = 1e200
    got = T.fit_tasks([good, bad], config)
    assert got[0]["analyst"] == "auto_fit_1" and got[1]["analyst"] == T._alone(bad, config)["analyst"]
    good.method = "guess"
    with pytest.raises(ValueError, match="unknown method"):
        T.fit_tasks([good], config)


def test_breaks_of_many_are_those_of_each():
    rng = np.random.default_rng(8)
    signals = [np.concatenate([rng.normal(level, 1, rng.integers(4, 40)) for level in rng.choice([0, 5, 20], 3)]) for _ in range(60)]
    signals += [np.full(30, 7.0), np.arange(5.0), np.empty(0), rng.normal(0, 1, 450)]
    assert B.breaks(signals, 1.0) == [K.breaks(s, 1.0) for s in signals]


def test_few_rows_still_spread_over_the_cores(spark):
    """Groups cost seconds, not bytes: a table of a few kB is worked on by every core."""
    rows = plans.declining(spark, SF).withColumn("segment", F.lit(1))
    for got in (T.fit(rows), T.with_segments(rows.drop("segment")), T.auto_forecast(rows)):
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() >= 4


def test_groups_longer_than_a_batch_stay_whole(spark):
    rows = spark.range(150_000).select(F.floor(F.col("id") / 70_000).alias("wellid"), F.when(F.col("id") < 140_000, "OIL").alias("measure"), (F.col("id") % 70_000).cast("int").alias("months"), (F.lit(5.0) + F.col("id") % 7).alias("value"))
    limits = T.b_limits(rows).collect()
    assert sorted((r["wellid"], r["measure"] or "") for r in limits) == [(0, "OIL"), (1, "OIL"), (2, "")]
    assert T.b_limits(rows.limit(0)).count() == 0
