"""Queries over forecasts, decline curves and fit diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.decline import Curve, decline_for
from ..functions.kernels import t_quantile
from ..operators import fits
from ..operators import forecast as Q
from ..operators import production as P
from ..sources import fixtures as X

W = f"with {X.SQL}"
#: One well-measure series per well: months and rates.
RANKED = f"""{W}, pref as (select * from (select *, dense_rank() over (partition by wellid, measure, cadence, dt order by case datasource when 'PRIMARY' then 1 else 2 end) as sr from production) where sr = 1),
  ranked as (select *, dense_rank() over (partition by wellid, measure, cadence order by dt) as daterank from pref)"""
BEST = f"{RANKED}, best as (select * from forecast qualify row_number() over (partition by wellid, measure order by case analyst when 'manual' then 1 when 'auto_fit_1' then 2 when 'auto_fit_2' then 3 when 'auto_fit_3' then 4 else 5 end, analyst) = 1)"


def arps(source: str, c: str = "c") -> str:
    """SQL of the decline curve over a relation with qi, dei, def, b, t."""
    return f"""
      {c}1 as (select *, abs(dei - def) <= 1e-8 + 1e-5 * abs(def) as is_exp, b = 1 and dei > def as is_har, -ln(1 - def) as a from {source}),
      {c}2 as (select *, case when is_har then dei / (1 - dei) when not is_exp then (power(1 - dei, -b) - 1) / b end as dn from {c}1),
      {c}3 as (select *, qi * power(a / dn, 1 / b) as ql, dn / (1 + b * dn * t / 12) as dt_ from {c}2),
      {c}4 as (select *, (power(qi / ql, b) - 1) / (b * dn) * 12 as tl, 1 - power(1 / (b * dt_ + 1), 1 / b) as de_ from {c}3),
      {c}5 as (select *, case when is_exp then dei when de_ > def then de_ else def end as de,
        case when is_exp then qi * exp(ln(1 - dei) * t / 12) when de_ > def then qi * power(1 + b * dn * t / 12, -1 / b) else ql * exp(ln(1 - def) * (t - tl) / 12) end as q from {c}4),
      {c}6 as (select *, case when is_exp then (qi - q) / -ln(1 - dei) * 365
        when de_ > def then case when is_har then qi / dn * ln(qi / q) else power(qi, b) / (dn * (1 - b)) * (power(qi, 1 - b) - power(q, 1 - b)) end * 365
        else (ql - q) / a * 365 + case when is_har then qi / dn * ln(qi / ql) else power(qi, b) / (dn * (1 - b)) * (power(qi, 1 - b) - power(ql, 1 - b)) end * 365 end as np from {c}5)"""


def ranked(spark, d):
    return P.date_rank(P.preferred(X.production(spark, d)))


def best(spark, d):
    return Q.best(X.forecast(spark, d))


def curve():
    return Curve.of(F.col("q3"), F.col("dei"), F.col("def"), F.col("b_factor"))


def w8_best_forecast(spark, d):
    return best(spark, d).select("wellid", "measure", "analyst")


def jn10_history(spark, d):
    return Q.history(ranked(spark, d)).select("wellid", "measure", "mindate", "maxdate", "total")


def jn11_cumulative_at_start(spark, d):
    rows = Q.view(_started(X.forecast(spark, d)), ranked(spark, d))
    return rows.select("wellid", "measure", "startcumulative")


def _started(forecast):
    """Starts moved into, and for every third well past, the history."""
    return forecast.withColumn("startdate", F.last_day(F.add_months("startdate", F.when(X.well() % 3 == 0, 90).otherwise((X.well() % 50).cast("int")))))


STARTED = f"{BEST}, s as (select * replace (last_day(startdate + case when wellid % 3 = 0 then interval 90 month else to_months(cast(wellid % 50 as int)) end) as startdate) from best)"


def jn14_rank_at_start(spark, d):
    rows = Q.view(_started(X.forecast(spark, d)), ranked(spark, d))
    return rows.select("wellid", "measure", F.col("startmonth").cast("long").alias("startmonth"))


def flt5_population(spark, d):
    """Wells whose forecast is not manual, with production in the last months before a date."""
    past = Q.history(ranked(spark, d))
    rows = best(spark, d).join(past, ["wellid", "measure"]).where("total > 0 and (analyst <> 'manual' or analyst is null)")
    return rows.where(F.col("maxdate") >= F.add_months(F.lit("2001-10-31").cast("date"), -12)).select("wellid", "measure", "maxdate")


def flt6_fit_window(spark, d):
    rows = ranked(spark, d).where("value > 0")
    last = F.max("dt").over(Window.partitionBy("wellid", "measure"))
    return rows.withColumn("last", last).where(F.col("dt") >= F.add_months("last", -24)).select("wellid", "measure", "dt", "datasource", "value")


def d1_month_diff(spark, d):
    return best(spark, d).select("wellid", "measure", P.month_diff(F.col("startdate"), F.lit("2002-03-01").cast("date")).cast("long").alias("months"))


def d2_arps(spark, d):
    rows, c = curve().staged(best(spark, d))
    rows = rows.withColumn("t", F.explode(F.array(*map(F.lit, (1, 12, 60, 120, 240, 360)))))
    return rows.select("wellid", "measure", "t", *(F.round(x, 4).alias(n) for n, x in (("q", c.rate(F.col("t"))), ("de", c.decline(F.col("t"))), ("np", c.cumulative(F.col("t"))))))


def d3_rate_only(spark, d):
    rows = best(spark, d).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(360), F.lit(30))))
    return rows.select("wellid", "measure", "t", F.round(curve().daily_rate(F.col("t")), 4).alias("q"))


def d4_exp_dei(spark, d):
    return best(spark, d).select("wellid", "measure", F.round(decline_for(F.col("q3"), F.col("q3") * (0.5 + X.well() % 3 * 0.5), F.lit(12.0)), 4).alias("dei1"))


def d5_roll_forward(spark, d):
    t = F.greatest(P.month_diff(F.col("startdate"), F.lit("2001-06-30").cast("date")), F.lit(0))
    rows, c = curve().staged(best(spark, d).withColumn("t", t))
    return rows.select("wellid", "measure", F.round(c.rate(F.col("t")), 4).alias("q"), F.round(c.decline(F.col("t")), 4).alias("de"))


def _parts(spark, d):
    """Forecasts of one, two and three segments, and some without a last rate."""
    rows = best(spark, d).withColumn("q1", F.col("q3") * 1.5).withColumn("q2", F.col("q3") * 1.2).withColumn("t1", (X.well() % 3 * 6).cast("int")).withColumn("t2", F.when(X.well() % 3 == 2, 12).otherwise(0))
    return rows.withColumn("q3", F.when((X.well() % 3 == 0) & (X.well() % 7 == 1), 0.0).otherwise(F.col("q3")))


def d6_segments(spark, d):
    rows = Q.segments(_parts(spark, d), ["wellid", "measure"], duration=120)
    return rows.select("wellid", "measure", F.col("month").cast("long").alias("month"), *(F.round(c, 4).alias(c) for c in ("q", "de", "cumulative", "volume")))


def d7_eur(spark, d):
    return Q.eur(X.forecast(spark, d), ranked(spark, d)).select("wellid", "measure", F.round("eur", 4).alias("eur"))


def d8_volumes(spark, d):
    view = Q.view(X.forecast(spark, d), ranked(spark, d)).withColumn("q1", F.lit(0.0)).withColumn("q2", F.lit(0.0))
    return Q.volumes(view).select("wellid", "measure", F.col("month").cast("long").alias("month"), "dt", *(F.round(c, 4).alias(c) for c in ("q", "cumulative", "volume")))


def d9_type_curve(spark, d):
    rows = Q.segments(_parts(spark, d).where("q3 > 0").withColumn("qabn", F.lit(0.0)), ["wellid", "measure"])
    return rows.groupBy("wellid", "measure").agg(F.round(F.max("cumulative"), 4).alias("eur"))


def d10_scaling(spark, d):
    rows = ranked(spark, d).join(X.well_header(spark, d).select("wellid", "laterallength_ft"), "wellid")
    value = Q.scaled(F.col("value"), length=F.when(X.well() % 6 != 0, F.col("laterallength_ft")), fluid=(X.well() % 40 + 10).cast("double"), left=(X.well() % 9 * 200 + 300).cast("double"), right=(X.well() % 7 * 250 + 400).cast("double"), target_length=10000.0, target_fluid=30.0, target_distance=880.0, most=1500.0)
    wide = rows.withColumn("value", value).groupBy("wellid").pivot("measure", list(P.PHASES)).agg(F.max("value"))
    return wide.select("wellid", *(F.round(F.coalesce(F.col(p), F.lit(0.0)), 4).alias(p.lower()) for p in P.PHASES))


def _series(spark, d):
    """A curve per well and phase with a small ripple, over 72 months."""
    rows, c = curve().staged(best(spark, d))
    rows = rows.withColumn("t", F.explode(F.sequence(F.lit(1), F.lit(72)))).withColumn("t", F.col("t").cast("double"))
    return rows.select("wellid", "measure", "t", (c.rate(F.col("t")) * (1 + (F.col("t") % 3) / 500)).alias("q"))


SERIES = f"{BEST}, src as (select wellid, measure, q3 as qi, dei, def, b_factor as b, t from best, (select unnest(generate_series(1, 72))::double as t)), {arps('src')}, series as (select wellid, measure, t, q * (1 + (t % 3) / 500) as q from c6)"


def b1_b_factor(spark, d):
    found = Q.b_diagnostics(_series(spark, d), ["wellid", "measure"])
    return found.select("wellid", "measure", "months", F.round("slope", 4).alias("slope"), F.round("r2", 4).alias("r2"))


def b12_b_limits(spark, d):
    """What the automatic fit lets b be, from each well's own line."""
    rows = _series(spark, d).select("wellid", "measure", F.col("t").alias("months"), F.col("q").alias("value"))
    return fits.b_limits(rows).select("wellid", "measure", *(F.round(c, 3).alias(c) for c in ("b_low", "b_start", "b_high")))


def b2_bounds(spark, d):
    rows = X.well_header(spark, d).select("wellid", (X.well() % 13 / 10).alias("lo"), F.when(X.well() % 5 != 0, X.well() % 17 / 10).alias("mid"), (X.well() % 19 / 10).alias("hi"))
    return rows.select("wellid", *Q.b_bounds(F.col("lo"), F.col("mid"), F.col("hi")))


def b7_thinning(spark, d):
    return Q.thinned(_series(spark, d), ["wellid", "measure"], "t").select("wellid", "measure", "t")


def b13_goodness(spark, d):
    rows = _series(spark, d).withColumn("fit", F.when(X.well() % 4 == 0, 5.0).otherwise(F.col("q") + F.col("t") % 5))
    return Q.goodness(rows, ["wellid", "measure"], "q", "fit").select("wellid", "measure", *(F.round(c, 4).alias(c) for c in ("r2", "rmse", "mae")))


def b15_bands(spark, d):
    """Quantiles of the rate over draws of the initial decline."""
    draws = best(spark, d).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(9)))).withColumn("dei", F.col("dei") + F.col("draw") * 0.01).withColumn("t", F.explode(F.array(F.lit(12), F.lit(60))))
    draws, c = curve().staged(draws)
    rates = draws.select("wellid", "measure", "t", c.rate(F.col("t")).alias("q"))
    return rates.groupBy("wellid", "measure", "t").agg(*(F.round(F.percentile("q", p), 4).alias(n) for n, p in (("p90", 0.1), ("p50", 0.5), ("p10", 0.9))))


def w18_smoothing(spark, d):
    return Q.smoothed(_series(spark, d), "q", ["wellid", "measure"], "t", 2).select("wellid", "measure", "t", F.round("q", 4).alias("q"))


def w19_log_difference(spark, d):
    by = Window.partitionBy("wellid", "measure").orderBy("t")
    step = F.ln(F.lag("q").over(by) / F.col("q")) / (F.col("t") - F.lag("t").over(by))
    return _series(spark, d).select("wellid", "measure", "t", F.round(step, 4).alias("d"))


def ag14_regression(spark, d):
    rows = ranked(spark, d).withColumn("x", F.col("daterank").cast("double"))
    sums = rows.groupBy("wellid", "measure").agg(F.regr_slope("value", "x").alias("slope"), F.regr_r2("value", "x").alias("r2"), F.regr_sxx("value", "x").alias("sxx"))
    return sums.select("wellid", "measure", *(F.round(c, 4).alias(c) for c in ("slope", "r2", "sxx")))


def ag15_errors(spark, d):
    rows = ranked(spark, d).withColumn("fit", F.col("value") * 0.9 + F.col("daterank"))
    return Q.goodness(rows, ["measure"], "value", "fit").select("measure", *(F.round(c, 4).alias(c) for c in ("r2", "rmse", "mae")))


QUERIES = {f.__name__: f for f in (
    w8_best_forecast, jn10_history, jn11_cumulative_at_start, jn14_rank_at_start, flt5_population, flt6_fit_window, d1_month_diff, d2_arps, d3_rate_only, d4_exp_dei, d5_roll_forward, d6_segments, d7_eur, d8_volumes,
    d9_type_curve, d10_scaling, b1_b_factor, b2_bounds, b12_b_limits, b7_thinning, b13_goodness, b15_bands, w18_smoothing, w19_log_difference, ag14_regression, ag15_errors,
)}

#: The best of the straight lines of all limits, with the sums of its squares.
_LINES = f"""{SERIES}, top as (select wellid, measure, max(q) as m from series where q > 0 group by 1, 2),
      f as (select s.wellid, s.measure, max(t) as f from series s join top on top.wellid = s.wellid and top.measure = s.measure and s.q = top.m group by 1, 2),
      r as (select s.* from series s join f on f.wellid = s.wellid and f.measure = s.measure where t >= f),
      s1 as (select wellid, measure, t, avg(q) over (partition by wellid, measure order by t rows 2 preceding) as q from r), s2 as (select wellid, measure, t, avg(q) over (partition by wellid, measure order by t rows 2 preceding) as q from s1),
      n as (select *, count(*) over (partition by wellid, measure) as n, ln(lag(q) over w / q) / (t - lag(t) over w) as dd from s2 window w as (partition by wellid, measure order by t)),
      y as (select wellid, measure, t, (1 - dd) / dd as y from n where n >= 24 and dd <> 0), z as (select * from y where y > 0.001 * t and y < 3 * t),
      l as (select wellid, measure, m::int as months, regr_slope(y, t) as slope, regr_r2(y, t) as r2, count(*) as n, regr_sxx(y, t) as xx, regr_syy(y, t) as yy, regr_sxy(y, t) as xy from z, (select unnest(generate_series(24, 60)) as m) where t <= m group by 1, 2, 3),
      line as (select * from l where r2 is not null qualify row_number() over (partition by wellid, measure order by round(r2, 10) desc, months) = 1)"""

#: One row per well, phase and month of each segment; exponential segments have equal declines.
_PARTS = f"""{BEST}, p0 as (select wellid, measure, case when wellid % 3 = 0 and wellid % 7 = 1 then 0 else q3 end as q3, q3 * 1.5 as q1, case when wellid % 3 = 2 then q3 * 1.2 else q3 end as q2, dei, def, b_factor, qabn, wellid % 3 * 6 as t1, case when wellid % 3 = 2 then 12 else 0 end as t2 from best),
  p1 as (select *, 1 - power(q2 / q1, 12.0 / nullif(t1, 0)) as d1, 1 - power(q3 / q2, 12.0 / nullif(t2, 0)) as d2 from p0),
  ends as (select *, coalesce((q1 - q2) / -ln(1 - d1) * 365, 0) as e1, coalesce((q1 - q2) / -ln(1 - d1) * 365, 0) + coalesce((q2 - q3) / -ln(1 - d2) * 365, 0) as e2 from p1),
  seg as (select wellid, measure, qabn, 1 as part, q1 as qi, d1 as dei, d1 as def, 1.0::double as b, t1 as n, 0 as off, 0::double as cum from ends where t1 > 0
    union all select wellid, measure, qabn, 2, q2, d2, d2, 1, t2, t1, e1 from ends where t2 > 0
    union all select wellid, measure, qabn, 3, q3, dei, def, b_factor, {{0}} - t1 - t2, t1 + t2, e2 from ends where q3 > 0),
  src as (select *, unnest(generate_series(0, n))::double as t from seg), {arps('src')},
  steps as (select *, case when t = 0 then 0 else np end as np0 from c6),
  vol as (select *, np0 - lag(np0) over (partition by wellid, measure, part order by t) as volume from steps)"""
MONTHS = f"""{BEST}, h as (select wellid, measure, max(daterank) as mm from ranked group by 1, 2),
  v as (select b.*, r.daterank as sm, coalesce((select sum(value) from ranked x where x.wellid = b.wellid and x.measure = b.measure and x.dt <= b.startdate), 0) as sc from best b left join (select distinct wellid, measure, dt, daterank from ranked) r on r.wellid = b.wellid and r.measure = b.measure and r.dt = b.startdate),
  src as (select wellid, measure, startdate, coalesce(sm, 0) as sm, sc, q3 as qi, dei, def, round(b_factor, 4) as b, qabn, unnest(generate_series(0, 360 - coalesce(sm, 0)))::double as t from v where q3 > qabn), {arps('src')},
  vol as (select *, case when t = 0 then 0 else np end as n0 from c6),
  w as (select *, n0 - lag(n0) over (partition by wellid, measure order by t) as volume from vol)"""
ORACLES = {
    "w8_best_forecast": f"{BEST} select wellid, measure, analyst from best",
    "jn10_history": f"{RANKED} select wellid, measure, min(dt) as mindate, max(dt) as maxdate, sum(value) as total from ranked group by 1, 2",
    "jn11_cumulative_at_start": f"{STARTED} select wellid, measure, coalesce((select sum(value) from ranked r where r.wellid = s.wellid and r.measure = s.measure and r.dt <= s.startdate), 0) as startcumulative from s",
    "jn14_rank_at_start": f"""{STARTED}, h as (select wellid, measure, max(dt) as maxdate, max(daterank) as mm from ranked group by 1, 2)
      select s.wellid, s.measure, case when startdate > maxdate then mm + datediff('month', maxdate, startdate) else (select max(daterank) from ranked r where r.wellid = s.wellid and r.measure = s.measure and r.dt = s.startdate) end as startmonth from s join h on h.wellid = s.wellid and h.measure = s.measure""",
    "flt5_population": f"{BEST} select b.wellid, b.measure, max(dt) as maxdate from best b join ranked r on r.wellid = b.wellid and r.measure = b.measure where b.analyst <> 'manual' group by 1, 2 having sum(value) > 0 and max(dt) >= date '2000-10-31'",
    "flt6_fit_window": f"{RANKED} select wellid, measure, dt, datasource, value from ranked qualify dt >= max(dt) over (partition by wellid, measure) - interval 24 month",
    "d1_month_diff": f"{BEST} select wellid, measure, datediff('month', startdate, date '2002-03-01') as months from best",
    "d2_arps": f"{BEST}, src as (select wellid, measure, q3 as qi, dei, def, b_factor as b, t from best, (values (1), (12), (60), (120), (240), (360)) v(t)), {arps('src')} select wellid, measure, t, round(q, 4) as q, round(de, 4) as de, round(np, 4) as np from c6",
    "d3_rate_only": f"""{BEST}, s as (select wellid, measure, q3, dei, def, b_factor as b, unnest(generate_series(0, 360, 30))::int as t, (power(1 - dei, -b_factor) - 1) / b_factor / 365 as di, -ln(1 - def) / 365 as dm from best),
      x as (select *, greatest((1 / dm - 1 / di) / b, 0) as tx, t * 365 / 12 as d from s)
      select wellid, measure, t, round(case when d <= tx then q3 / power(1 + b * di * d, 1 / b) else q3 / power(1 + b * di * tx, 1 / b) * exp(dm * (tx - d)) end, 4) as q from x""",
    "d4_exp_dei": f"{BEST} select wellid, measure, round(1 - power(0.5 + wellid % 3 * 0.5, 1.0), 4) as dei1 from best",
    "d5_roll_forward": f"{BEST}, src as (select wellid, measure, q3 as qi, dei, def, b_factor as b, greatest(datediff('month', startdate, date '2001-06-30'), 0)::double as t from best), {arps('src')} select wellid, measure, round(q, 4) as q, round(de, 4) as de from c6",
    "d6_segments": f"""{_PARTS.replace('{0}', '120')} select wellid, measure, (t + off)::bigint as month, round(q, 4) as q, round(de, 4) as de, round(cum + np0, 4) as cumulative, round(greatest(volume, 0), 4) as volume from vol where t > 0 and (part <> 3 or q >= qabn)
      union all select wellid, measure, m, 0, 0, 0, 0 from p0, (select unnest(generate_series(1, 120)) as m) where q3 = 0""",
    "d7_eur": f"""{BEST}, h as (select wellid, measure, max(dt) as last, sum(value) as produced from ranked group by 1, 2),
      src as (select b.wellid, b.measure, q3 as qi, dei, def, b_factor as b, produced, greatest(datediff('month', startdate, last), 0)::double as t from best b join h on h.wellid = b.wellid and h.measure = b.measure), {arps('src')},
      src2 as (select wellid, measure, q as qi, de as dei, def, b, produced, 360::double as t from c6), {arps('src2', 'e')}
      select wellid, measure, round(produced + np, 4) as eur from e6""",
    "d8_volumes": f"""{MONTHS} select wellid, measure, (t + sm)::bigint as month, last_day(startdate + to_months(t::int)) as dt, round(q, 4) as q, round(sc + n0, 4) as cumulative, round(greatest(volume, 0), 4) as volume from w where t > 0 and q >= qabn
      union all select wellid, measure, coalesce(sm, 0), last_day(startdate), null, round(sc, 4), null from v where q3 <= qabn""",
    "d9_type_curve": f"{_PARTS.replace('{0}', '360')} select wellid, measure, round(max(cum + np0), 4) as eur from vol where wellid in (select wellid from p0 where q3 > 0) and t > 0 group by 1, 2",
    "d10_scaling": f"""{RANKED}, v as (select r.wellid, measure, value * case when r.wellid % 6 = 0 then 1 else 10000 / laterallength_ft end * sqrt(30.0 / (r.wellid % 40 + 10)) * power(880.0 / least(r.wellid % 9 * 200 + 300, 1500), 0.25) * power(880.0 / least(r.wellid % 7 * 250 + 400, 1500), 0.25) as value from ranked r join well_header h on h.wellid = r.wellid)
      select wellid, round(coalesce(max(value) filter (measure = 'OIL'), 0), 4) as oil, round(coalesce(max(value) filter (measure = 'GAS'), 0), 4) as gas, round(coalesce(max(value) filter (measure = 'WATER'), 0), 4) as water from v group by 1""",
    "b1_b_factor": f"{_LINES} select wellid, measure, months, round(slope, 4) as slope, round(r2, 4) as r2 from line",
    "b12_b_limits": f"""{_LINES}, quantile as (select unnest(range(1, 61)) as degrees, unnest({[t_quantile(k) for k in range(1, 61)]}) as v),
      ends as (select wellid, measure, slope, v * sqrt((yy - xy * xy / xx) / (n - 2) / xx) as wide from line left join quantile on degrees = n - 2),
      lo as (select *, greatest(coalesce(slope - wide, 0.5::double), 0.5::double) as lo from ends), hi as (select *, least(greatest(coalesce(slope + wide, 1.4::double), lo * 1.1::double), 1.4::double) as hi from lo)
      select s.wellid, s.measure, coalesce(round(round(lo, 4), 3), 0.5) as b_low, coalesce(round(round(case when slope between lo and hi then slope else (lo + hi) / 2 end, 4), 3), 1.0) as b_start, coalesce(round(round(hi, 4), 3), 1.4) as b_high
      from (select distinct wellid, measure from series) s left join hi on hi.wellid = s.wellid and hi.measure = s.measure""",
    "b2_bounds": f"""{W}, c as (select wellid, greatest((wellid % 13) / 10, 0.5::double) as lo, case when wellid % 5 <> 0 then (wellid % 17) / 10 end as mid, (wellid % 19) / 10 as hi0 from well_header), e as (select *, least(greatest(hi0, lo * 1.1::double), 1.4::double) as hi from c)
      select wellid, round(lo, 4) as low, round(case when mid between lo and hi then mid else (lo + hi) / 2 end, 4) as start, round(hi, 4) as high from e""",
    "b7_thinning": f"{SERIES} select wellid, measure, t from series where t <= 36 or t % 2 = 1 or t = 72",
    "b13_goodness": f"{SERIES}, f as (select *, case when wellid % 4 = 0 then 5.0::double else q + t % 5 end as fit from series) select wellid, measure, round(case when wellid % 4 = 0 then 0 else power(corr(q, fit), 2) end, 4) as r2, round(sqrt(avg(power(q - fit, 2))), 4) as rmse, round(avg(abs(q - fit)), 4) as mae from f group by 1, 2",
    "b15_bands": f"{BEST}, src as (select wellid, measure, q3 as qi, dei + n * 0.01::double as dei, def, b_factor as b, t from best, (select unnest(generate_series(1, 9)) as n), (values (12), (60)) v(t)), {arps('src')} select wellid, measure, t, round(quantile_cont(q, 0.1), 4) as p90, round(quantile_cont(q, 0.5), 4) as p50, round(quantile_cont(q, 0.9), 4) as p10 from c6 group by 1, 2, 3",
    "w18_smoothing": f"{SERIES}, s1 as (select wellid, measure, t, avg(q) over (partition by wellid, measure order by t rows 2 preceding) as q from series) select wellid, measure, t, round(avg(q) over (partition by wellid, measure order by t rows 2 preceding), 4) as q from s1",
    "w19_log_difference": f"{SERIES} select wellid, measure, t, round(ln(lag(q) over w / q), 4) as d from series window w as (partition by wellid, measure order by t)",
    "ag14_regression": f"{RANKED} select wellid, measure, round(regr_slope(value, daterank), 4) as slope, round(regr_r2(value, daterank), 4) as r2, round(regr_sxx(value, daterank), 4) as sxx from ranked group by 1, 2",
    "ag15_errors": f"{RANKED}, f as (select measure, value, value * 0.9::double + daterank as fit from ranked) select measure, round(power(corr(value, fit), 2), 4) as r2, round(sqrt(avg(power(value - fit, 2))), 4) as rmse, round(avg(abs(value - fit)), 4) as mae from f group by 1",
}
