"""Queries over cash flow, prices and economic-data lines."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import economics as E
from ..operators import production as P
from ..sources import fixtures as X
from .forecasts import BEST, _started, best
from .production import BOTH, months

W = f"with {X.SQL}"


def volumes(spark, d):
    """Gap-free months from 0 per well."""
    number = F.row_number().over(Window.partitionBy("wellid").orderBy("dt")).cast("long") - 1
    return months(spark, d).select(X.well().alias("uid"), number.alias("month"), *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("oil", "gas", "water")))


def inputs(spark, d):
    """Economic inputs by arithmetic on the well's id: some wells without interest, some with more than their share."""
    n = lambda x: x.cast("double")
    c = dict(
        wi=n(F.when(X.well() % 11 == 0, 0).otherwise(80 + X.well() % 3 * 10)) / 100, nri=n(60 + X.well() % 4 * 5) / 100, roy=F.lit(0.2), weight=F.lit(1.0), prod_wt=F.lit(0.9), inv_wt=F.lit(1.0), shrink=F.lit(0.85), btu=F.lit(1.1),
        ngl_yield=F.lit(0.05), pri_oil=n(50 + X.well() % 5 * 5), pri_gas=F.lit(3.0), paj_oil=F.lit(-2.0), paj_gas=F.lit(-0.25), paj_ngl=F.lit(0.3), stx_oil=F.lit(0.046), stx_gas=F.lit(0.075), stx_ngl=F.lit(0.075),
        adval=F.lit(0.025), opc_fix=n(500 + X.well() % 7 * 300), opc_oil=F.lit(5.0), opc_gas=F.lit(0.5), opc_wtr=F.lit(2.0), capex=n(F.when(X.well() % 13 == 0, 0).otherwise(20000 + X.well() % 9 * 5000)), aban=F.lit(1000.0), eloss=(X.well() % 3).cast("int"),
    )
    return X.well_header(spark, d).select(X.well().alias("uid"), *(x.alias(name) for name, x in c.items()))


FLOW = f"""{BOTH},
  v as (select wellid as uid, row_number() over (partition by wellid order by dt) - 1 as month, coalesce(oil, 0) as oil, coalesce(gas, 0) as gas, coalesce(water, 0) as water from w),
  i as (select wellid as uid, case when wellid % 11 = 0 then 0 else 80 + wellid % 3 * 10 end::double / 100 as wi, (60 + wellid % 4 * 5)::double / 100 as nri, (50 + wellid % 5 * 5)::double as po, (500 + wellid % 7 * 300)::double as fix,
    case when wellid % 13 = 0 then 0 else 20000 + wellid % 9 * 5000 end::double as capex, (wellid % 3)::int as eloss from well_header),
  j as (select v.*, i.* exclude (uid), min(case when oil + gas > 0 then month end) over (partition by v.uid) as fm, (wi = 0 or nri / nullif(wi, 0) > 0.8::double) as is_full from v join i using (uid)),
  r as (select *, oil * nri * 0.9::double as os, gas * nri * 0.85::double * 0.9::double as gs, 0.05::double * gas * nri * 0.9::double as ns,
    0.9::double * (oil * 5 + gas * 0.85::double * 0.5::double + water * 2) + fix as cost from j),
  s as (select *, os * (po - 2) as orv, gs * 1.1::double * 2.75::double as grv, ns * po * 0.3::double as nrv from r),
  t as (select *, orv + grv + nrv as rev, orv * 0.046::double + (grv + nrv) * 0.075::double + (orv + grv + nrv) * 0.025::double as tax, case when month >= fm then wi * cost else 0 end as opex from s),
  f as (select *, rev - tax - opex as op, rev - tax - opex - case when month = fm then capex * wi else 0 end as net,
    (rev - tax) / nri * case when is_full then 0.8::double else nri end - case when month >= fm then case when is_full then 1 else wi end * cost else 0 end as bas from t),
  c as (select *, sum(op) over o as cum_op, sum(net) over o as cum_net, sum(bas) over o as cum_bas from f window o as (partition by uid order by month))"""
ECON = f"""{FLOW}, l as (select uid, arg_min(month, struct_pack(a := -cum_bas, b := month)) as life, count(*) as n from c group by 1),
  e0 as (select c.*, life, n, least(life + eloss, n) - 1 as am from c join l using (uid)),
  e1 as (select * replace (case when month = am then net - 1000 * wi else net end as net) from e0),
  e2 as (select * replace (sum(net) over (partition by uid order by month) as cum_net) from e1),
  e as (select uid, month, am, life, n, eloss, capex, wi, nri, case when month <= am then os else 0 end as os, case when month <= am then gs else 0 end as gs, case when month <= am then rev else 0 end as rev,
    case when month <= am then op else 0 end as op, case when month <= am then net else 0 end as net, case when month <= am then cum_net else 0 end as cum_net from e2)"""


def flows(spark, d):
    return E.cash_flow(volumes(spark, d), inputs(spark, d))


def econ(spark, d):
    return E.economic(flows(spark, d))


def rounded(*names, shift=0.0):
    """Rounded for comparison; a small shift keeps exact halves off the edge where engines differ."""
    return [F.round(F.col(c) + shift, 4).alias(c) for c in names]


def e1_cash_flow(spark, d):
    return flows(spark, d).select("uid", "month", *rounded("oil_sales", "gas_sales", "ngl_sales", "total_rev", "tax", "opex", "op_cf", "net_cf", "cum_op", "cum_net", shift=1e-7))


def e2_economic_limit(spark, d):
    return econ(spark, d).select("uid", "month", "aban_month", *rounded("total_rev", "op_cf", "net_cf", "cum_net", shift=1e-7))


def e3_npv(spark, d):
    return econ(spark, d).groupBy("uid").agg(F.round(E.present_value(F.lit(0.1)), 4).alias("npv"))


def e4_npv_profile(spark, d):
    return E.profile(econ(spark, d)).select("uid", "rate", F.round("npv", 4).alias("npv"))


def e5_irr(spark, d):
    return E.irr(econ(spark, d)).select("uid", F.round("irr", 4).alias("irr"))


def e6_summary(spark, d):
    return E.summary(econ(spark, d)).select("uid", *rounded("life", "payout", "roi", "droi"))


def e7_gross_eur(spark, d):
    return E.summary(econ(spark, d)).select("uid", *rounded("oil_eur", "gas_eur"))


def e8_breakeven(spark, d):
    return E.breakeven(volumes(spark, d), inputs(spark, d))


def e9_dates(spark, d):
    start = F.add_months(F.trunc(F.lit("2024-05-17").cast("date"), "month"), 1)
    rows = econ(spark, d).where("total_rev <> 0").select("uid", "month", F.add_months(start, F.col("month").cast("int")).alias("dt"))
    return rows


def e10_volumes(spark, d):
    v = volumes(spark, d).select("uid", (F.col("month") - 1).alias("month"), *(F.round(F.col(c) / 3, 4).alias(c) for c in ("oil", "gas", "water")))
    return v.where("month >= 0")


def e11_strip(spark, d):
    dates = X.well_header(spark, d).select("wellid", "firstproddate", F.explode(E.strip(F.col("firstproddate"), 12, "CL")).alias("c"))
    return dates.select("wellid", "c.contract_month", "c.ticker")


def _calendar(spark, d):
    """Trading days: the weekdays on which orders came, but for holidays."""
    days = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    holidays = days.where(((F.month("day") == 7) & (F.dayofmonth("day") == 4)) | ((F.month("day") == 12) & (F.dayofmonth("day") == 25)) | ((F.month("day") == 1) & (F.dayofmonth("day") == 1)))
    return E.business_days(days, holidays)


def _contracts(spark, d):
    """The months in which orders came."""
    return spark.read.parquet(f"{d}/orders.parquet").select(F.trunc("o_orderdate", "month").alias("contract_month")).distinct()


def e12_expiry_oil(spark, d):
    return E.expiry(_contracts(spark, d), _calendar(spark, d), "oil")


def e12_expiry_gas(spark, d):
    return E.expiry(_contracts(spark, d), _calendar(spark, d), "gas")


def src9_prices(spark, d):
    """The contract's own close, else the front month's, else nothing."""
    dates = e11_strip(spark, d).withColumn("n", X.well() % 3)
    own = dates.where("n = 0").select("contract_month", "ticker", F.lit(71.5).alias("close")).distinct()
    front = dates.where("n <> 2").select("contract_month", F.lit(68.25).alias("front")).distinct()
    return dates.select("contract_month", "ticker").distinct().join(own, ["contract_month", "ticker"], "left").join(front, "contract_month", "left").select("contract_month", "ticker", F.coalesce("close", "front").alias("close"))


def _forecast(spark, d):
    f = _started(best(spark, d))
    return f.withColumn("q1", F.floor(F.col("q3") * 2)).withColumn("q2", F.floor(F.col("q3") * 1.5)).withColumn("q3", F.floor("q3")).withColumn("t1", (X.well() % 4 * 5).cast("int")).withColumn("t2", F.when(X.well() % 4 == 3, 6).otherwise(0))


def e13_expressions(spark, d):
    return E.expressions(_forecast(spark, d)).select("wellid", "measure", F.col("line").cast("long").alias("line"), "expression")


def e14_live_lines(spark, d):
    return E.live_lines(E.expressions(_forecast(spark, d))).select("wellid", "measure", F.col("line").cast("long").alias("line"))


def e14_live_lines_compat(spark, d):
    return E.live_lines(E.expressions(_forecast(spark, d)), compat=True).select("wellid", "measure", F.col("line").cast("long").alias("line"))


def e15_assembly(spark, d):
    lines = E.live_lines(E.expressions(_forecast(spark, d)))
    numbered = lines.withColumn("place", F.dense_rank().over(Window.partitionBy("wellid", "measure").orderBy("line")))
    keyword = F.when(F.col("place") > 1, '"').when(F.col("measure") == "WATER", "WTR").otherwise(F.col("measure"))
    start = _forecast(spark, d).select("wellid", "measure", F.lit(0).alias("place"), F.lit("START").alias("keyword"), F.date_format("startdate", "MM/yyyy").alias("expression"))
    all_lines = start.unionByName(numbered.select("wellid", "measure", "place", keyword.alias("keyword"), "expression"))
    order = Window.partitionBy("wellid").orderBy(P.priority("measure", ("OIL", "GAS", "WATER")), "place")
    return all_lines.select("wellid", F.row_number().over(order).cast("long").alias("sequence"), "keyword", "expression")


def e16_parse(spark, d):
    rows = E.parse_expressions(E.expressions(_forecast(spark, d)).where("line = 3"))
    return rows.select("wellid", "measure", "start", "end", "unit", "b", F.round("decline", 6).alias("decline"))


def w12_stream_order(spark, d):
    oil_first, gas_first = P.priority("measure", ("OIL", "GAS")), P.priority("measure", ("GAS", "OIL"))
    order = F.when(X.well() % 2 == 0, oil_first).otherwise(gas_first)
    return best(spark, d).select("wellid", "measure", F.rank().over(Window.partitionBy("wellid").orderBy(order)).cast("long").alias("streamorder"))


def w13_redensify(spark, d):
    lines = E.live_lines(E.expressions(_forecast(spark, d)))
    by = Window.partitionBy("wellid", "measure").orderBy("line")
    return lines.select("wellid", "measure", F.col("line").cast("long").alias("line"), F.dense_rank().over(by).cast("long").alias("exp_order"))


def w16_shift(spark, d):
    by = Window.partitionBy("wellid").orderBy("measure")
    return best(spark, d).select("wellid", "measure", F.lag("measure").over(by).alias("before"), F.lead("measure").over(by).alias("after"))


def w17_reverse_count(spark, d):
    return best(spark, d).select("wellid", "measure", (F.row_number().over(Window.partitionBy("wellid").orderBy(F.desc("measure"))).cast("long") - 1).alias("from_end"))


def w20_running_cash(spark, d):
    by = Window.partitionBy("uid").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return volumes(spark, d).select("uid", "month", F.sum(F.col("oil") * 2 - F.col("water")).over(by).alias("total"))


def ag13_grouped_max(spark, d):
    return X.forecast(spark, d).groupBy("wellid", "measure").agg(*(F.max(c).alias(c) for c in ("analyst", "dei", "b_factor", "t1")))


def up13_replace_section(spark, d):
    old = X.well_header(spark, d).select("wellid", F.explode(F.array(F.lit(2), F.lit(4), F.lit(7))).alias("section")).withColumn("expression", F.lit("old"))
    return old.where("section <> 4").unionByName(_forecast(spark, d).select("wellid", F.lit(4).alias("section"), F.col("measure").alias("expression")))


def up14_replace_template(spark, d):
    old = X.well_header(spark, d).select("wellid", F.explode(F.array(F.lit(2), F.lit(4), F.lit(7))).alias("section")).withColumn("keyword", F.when(X.well() % 2 == 0, "OP/MIN").otherwise("X"))
    gone = (~F.col("section").isin(4, 7)) | ((F.col("section") == 7) & (F.col("keyword") == "OP/MIN"))
    lines = spark.createDataFrame([(2, "PRI/OIL"), (5, "CAP"), (7, "OP/MIN")], "section int, keyword string")
    return old.where(~gone).unionByName(X.well_header(spark, d).select("wellid").crossJoin(F.broadcast(lines)))


QUERIES = {f.__name__: f for f in (
    e1_cash_flow, e2_economic_limit, e3_npv, e4_npv_profile, e5_irr, e6_summary, e7_gross_eur, e8_breakeven, e9_dates, e10_volumes, e11_strip, e12_expiry_oil, e12_expiry_gas, src9_prices, e13_expressions, e14_live_lines,
    e14_live_lines_compat, e15_assembly, e16_parse, w12_stream_order, w13_redensify, w16_shift, w17_reverse_count, w20_running_cash, ag13_grouped_max, up13_replace_section, up14_replace_template,
)}

_NPV = "sum(net / power(1 + {r}, (month + 0.5) / 12))"
_STRIP = f"{W}, st as (select wellid, (date_trunc('month', firstproddate) + to_months(n::int))::date as contract_month from well_header, (select unnest(generate_series(1, 12)) as n)), sp as (select *, 'CL' || substring('FGHJKMNQUVXZ', month(contract_month)::int, 1) || strftime(contract_month, '%y') as ticker from st)"
_CAL = """with dd as (select distinct cast(o_orderdate as date) as day from orders),
  bd as (select day from dd where isodow(day) < 6 and strftime(day, '%m-%d') not in ('07-04', '12-25', '01-01')),
  cm as (select distinct date_trunc('month', o_orderdate)::date as contract_month from orders)"""
_LINES = f"""{BEST}, st as (select *, last_day(startdate + case when wellid % 3 = 0 then interval 90 month else to_months(cast(wellid % 50 as int)) end) as sd, floor(q3 * 2) as a1, floor(q3 * 1.5::double) as a2, floor(q3) as a3, wellid % 4 * 5 as n1, case when wellid % 4 = 3 then 6 else 0 end as n2, case when measure = 'GAS' then 'M/D' else 'B/D' end as un from best),
  li as (select wellid, measure, sd, n1, n2, 1::bigint as line, printf('%.6f', a1) || ' ' || printf('%.6f', case when n2 = 0 then a3 else a2 end) || ' ' || un || ' ' || n1 || ' MO EXP X' as expression from st
    union all select wellid, measure, sd, n1, n2, 2, printf('%.6f', a2) || ' ' || printf('%.6f', a3) || ' ' || un || ' ' || n2 || ' IMO EXP X' from st
    union all select wellid, measure, sd, n1, n2, 3, printf('%.6f', a3) || ' X ' || un || ' ' || printf('%.6f', round(def * 100, 6)) || ' EXP B/' || printf('%.4f', b_factor) || ' ' || printf('%.6f', round(dei * 100, 6)) from st
    union all select wellid, measure, sd, n1, n2, 4, 'X ' || printf('%.6f', qabn) || ' ' || un || ' X YRS EXP ' || printf('%.6f', round(def * 100, 6)) from st),
  lv as (select * from li where not (line = 1 and n1 = 0) and not (line = 2 and n2 = 0))"""
_AT = "list_sum(list_transform(nets, lambda x, i: x / power(1 + {r}, (i - 0.5) / 12)))"
#: Halving of the bracket between nothing and the first power of two at which the value is not positive.
_IRR = f"""{ECON.replace('with', 'with recursive', 1)}, g as (select uid, max(wi * capex) as spent, list(net order by month) as nets from e group by 1),
  k as (select *, list_sum(nets) as f0, list_filter(range(0, 40), lambda n: {_AT.format(r='power(2, n)')} <= 0)[1] as k0 from g),
  b as (select uid, nets, 0::double as lo, power(2, k0)::double as hi, 0 as step from k where spent <> 0 and f0 > 0 and k0 is not null
    union all select uid, nets, case when v > 0 then (lo + hi) / 2 else lo end, case when v > 0 then hi else (lo + hi) / 2 end, step + 1 from (select *, {_AT.format(r='(lo + hi) / 2')} as v from b where step < 60))"""
ORACLES = {
    "e5_irr": f"{_IRR} select k.uid, round(case when spent = 0 then 1 when f0 <= 0 then 0 else (lo + hi) / 2 end, 4) as irr from k left join b on b.uid = k.uid and step = 60",
    "e1_cash_flow": f"{FLOW} select uid, month, round(os + 1e-7, 4) as oil_sales, round(gs + 1e-7, 4) as gas_sales, round(ns + 1e-7, 4) as ngl_sales, round(rev + 1e-7, 4) as total_rev, round(tax + 1e-7, 4) as tax, round(opex + 1e-7, 4) as opex, round(op + 1e-7, 4) as op_cf, round(net + 1e-7, 4) as net_cf, round(cum_op + 1e-7, 4) as cum_op, round(cum_net + 1e-7, 4) as cum_net from c",
    "e2_economic_limit": f"{ECON} select uid, month, am as aban_month, round(rev + 1e-7, 4) as total_rev, round(op + 1e-7, 4) as op_cf, round(net + 1e-7, 4) as net_cf, round(cum_net + 1e-7, 4) as cum_net from e",
    "e3_npv": f"{ECON} select uid, round({_NPV.format(r='0.1::double')}, 4) as npv from e group by 1",
    "e4_npv_profile": f"{ECON} select uid, rate, round({_NPV.format(r='rate')}, 4) as npv from e, (select unnest([0.05, 0.08, 0.09, 0.1, 0.12, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])::double as rate) group by 1, 2",
    "e6_summary": f"""{ECON}, g as (select *, lag(cum_net) over (partition by uid order by month) as b from e),
      h as (select uid, max(life) as life, max(eloss) as el, max(n) as n, min(case when cum_net >= 0 and b < 0 then month - 1 - b / (cum_net - b) end) as crossing, arg_min(cum_net, month) as f, max(month) as last, sum(net) as net, {_NPV.format(r='0.1::double')} as pv, max(capex * wi) as spent from g group by 1)
      select uid, round(least(life + el, n) / 12, 4) as life, round(case when f >= 0 then 0 else coalesce(crossing, last) end / 12, 4) as payout, round(case when spent = 0 then 0 else (spent + net) / spent end, 4) as roi, round(case when spent = 0 then 0 else (spent + pv) / spent end, 4) as droi from h""",
    "e7_gross_eur": f"{ECON} select uid, round(sum(os) / max(nri), 4) as oil_eur, round(sum(gs) / (max(nri) * 0.85::double), 4) as gas_eur from e group by 1",
    "e9_dates": f"{ECON} select uid, month, (date '2024-06-01' + to_months(month::int))::date as dt from e where rev <> 0",
    "e10_volumes": f"{FLOW} select uid, month - 1 as month, round(oil / 3, 4) as oil, round(gas / 3, 4) as gas, round(water / 3, 4) as water from v where month >= 1",
    "e11_strip": f"{_STRIP} select wellid, contract_month, ticker from sp",
    "e12_expiry_oil": f"{_CAL} select * from (select contract_month, (select day from bd where day <= (contract_month - interval 1 month)::date + 24 order by day desc limit 1 offset 3) as expiry from cm) where expiry is not null",
    "e12_expiry_gas": f"{_CAL} select * from (select contract_month, (select day from bd where day < contract_month order by day desc limit 1 offset 2) as expiry from cm) where expiry is not null",
    "src9_prices": f"{_STRIP} select contract_month, ticker, case when bool_or(wellid % 3 = 0) then 71.5::double when bool_or(wellid % 3 <> 2) then 68.25 end as close from sp group by 1, 2",
    "e13_expressions": f"{_LINES} select wellid, measure, line, expression from li",
    "e14_live_lines": f"{_LINES} select wellid, measure, line from lv",
    "e14_live_lines_compat": f"{_LINES} select wellid, measure, line from li where not (line = 1 and n1 % 10 = 0) and not (line = 2 and n2 % 10 = 0)",
    "e15_assembly": f"""{_LINES}, al as (select wellid, measure, 0 as place, 'START' as keyword, strftime(sd, '%m/%Y') as expression from st
        union all select wellid, measure, row_number() over (partition by wellid, measure order by line), case when row_number() over (partition by wellid, measure order by line) > 1 then '"' when measure = 'WATER' then 'WTR' else measure end, expression from lv)
      select wellid, row_number() over (partition by wellid order by list_position(['OIL', 'GAS', 'WATER'], measure), place) as sequence, keyword, expression from al""",
    "e16_parse": f"{_LINES} select wellid, measure, a3 as start, null::double as end, un as unit, b_factor as b, round(dei, 6) as decline from st",
    "w12_stream_order": f"{BEST} select wellid, measure, rank() over (partition by wellid order by list_position(case when wellid % 2 = 0 then ['OIL', 'GAS', 'WATER'] else ['GAS', 'OIL', 'WATER'] end, measure)) as streamorder from best",
    "w13_redensify": f"{_LINES} select wellid, measure, line, dense_rank() over (partition by wellid, measure order by line) as exp_order from lv",
    "w16_shift": f"{BEST} select wellid, measure, lag(measure) over (partition by wellid order by measure) as before, lead(measure) over (partition by wellid order by measure) as after from best",
    "w17_reverse_count": f"{BEST} select wellid, measure, (select count(*) from best b where b.wellid = best.wellid and b.measure > best.measure) as from_end from best",
    "w20_running_cash": f"{FLOW} select a.uid, a.month, sum(b.oil * 2 - b.water) as total from v a join v b on a.uid = b.uid and b.month <= a.month group by 1, 2",
    "ag13_grouped_max": f"{W} select wellid, measure, max(analyst) as analyst, max(dei) as dei, max(b_factor) as b_factor, max(t1) as t1 from forecast group by 1, 2",
    "up13_replace_section": f"{BEST} select wellid, s::int as section, 'old' as expression from well_header, (values (2), (7)) v(s) union all select wellid, 4, measure from best",
    "up14_replace_template": f"{W} select wellid, s::int as section, kw as keyword from well_header, (values (2, 'PRI/OIL'), (5, 'CAP'), (7, 'OP/MIN')) v(s, kw) union all select wellid, 4, case when wellid % 2 = 0 then 'OP/MIN' else 'X' end from well_header union all select wellid, 7, 'X' from well_header where wellid % 2 <> 0",
}
