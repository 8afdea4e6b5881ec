"""Queries over fluid properties and gas processing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fluids as L
from ..sources import fixtures as X

c = F.col
#: Inputs by arithmetic on the well's id; pressures stay where plain substitution converges too.
INPUTS = f"""with {X.SQL}, f as (select wellid, (500 + (wellid * 23) % 2500)::double as p, (100 + wellid % 150)::double as t, (60 + wellid % 30)::double / 100 as sg, (wellid % 3)::double / 100 as co2, (wellid % 2)::double / 200 as h2s,
  (30 + wellid % 20)::double as api, (300 + wellid % 500)::double as rsb, (wellid % 5)::double as salt, (wellid % 20)::double as rsw, (20 + wellid % 20)::double / 100 as sw from well_header)"""


def inputs(spark, d):
    n = lambda x: x.cast("double")
    return X.well_header(spark, d).select(
        "wellid", n(500 + (X.well() * 23) % 2500).alias("p"), n(100 + X.well() % 150).alias("t"), (n(60 + X.well() % 30) / 100).alias("sg"), (n(X.well() % 3) / 100).alias("co2"), (n(X.well() % 2) / 200).alias("h2s"), n(30 + X.well() % 20).alias("api"), n(300 + X.well() % 500).alias("rsb"),
        n(X.well() % 5).alias("salt"), n(X.well() % 20).alias("rsw"), (n(20 + X.well() % 20) / 100).alias("sw"),
    )


def with_z(spark, d):
    return inputs(spark, d).withColumn("z", L.z_factor(c("p"), c("t"), c("sg"), c("co2"), c("h2s")))


def f1_to_float(spark, d):
    text = F.when(X.well() % 4 == 0, "bad").when(X.well() % 4 == 1, "NaN").when(X.well() % 4 == 2, X.well().cast("string"))
    return X.well_header(spark, d).select("wellid", L.to_float(text, 7.5).alias("x"))


def f2_critical_temperature(spark, d):
    return inputs(spark, d).select("wellid", F.round(L.critical_temperature(c("sg"), c("co2"), c("h2s")), 4).alias("tpc"))


def f3_critical_pressure(spark, d):
    return inputs(spark, d).select("wellid", F.round(L.critical_pressure(c("sg"), c("co2"), c("h2s")), 4).alias("ppc"))


def f4_z_factor(spark, d):
    return with_z(spark, d).select("wellid", F.round("z", 4).alias("z"))


def f4_z_factor_compat(spark, d):
    return inputs(spark, d).select("wellid", F.round(L.z_factor(c("p"), c("t"), c("sg"), c("co2"), c("h2s"), compat=True), 3).alias("z"))


def f5_gas_compressibility(spark, d):
    return with_z(spark, d).select("wellid", F.round(L.gas_compressibility(c("p"), c("t"), c("sg"), c("co2"), c("h2s"), c("z")) * 1e6, 3).alias("cg"))


def f6_gas_viscosity(spark, d):
    return with_z(spark, d).select("wellid", F.round(L.gas_viscosity(c("p"), c("t"), c("sg"), c("z")) * 1000, 4).alias("mu_g"))


def f7_gas_volume_factor(spark, d):
    return with_z(spark, d).select("wellid", F.round(L.gas_volume_factor(c("p"), c("t"), c("z")) * 1000, 4).alias("bg"))


def f8_pseudo_pressure(spark, d):
    return L.pseudo_pressure(inputs(spark, d).select("wellid", "p", "t", "sg", "co2", "h2s")).select("wellid", F.round("m", 2).alias("m"))


def _oil(name, f, digits=4):
    def query(spark, d):
        return inputs(spark, d).select("wellid", F.round(f(), digits).alias("x"))

    query.__name__ = name
    return query


f9_bubble_point = _oil("f9_bubble_point", lambda: L.bubble_point(c("t"), c("rsb"), c("api"), c("sg")))
f10_solution_gas = _oil("f10_solution_gas", lambda: L.solution_gas(c("p"), c("t"), c("rsb"), c("api"), c("sg")))
f11_oil_volume_factor = _oil("f11_oil_volume_factor", lambda: L.oil_volume_factor(c("p"), c("t"), c("rsb"), c("api"), c("sg")))
f12_oil_viscosity = _oil("f12_oil_viscosity", lambda: L.oil_viscosity(c("p"), c("t"), c("rsb"), c("api"), c("sg")))
f13_water_compressibility = _oil("f13_water_compressibility", lambda: L.water_compressibility(c("p"), c("t"), c("rsw"), c("salt")) * 1e6)
f14_water_volume_factor = _oil("f14_water_volume_factor", lambda: L.water_volume_factor(c("p"), c("t"), c("salt")))
f15_water_viscosity = _oil("f15_water_viscosity", lambda: L.water_viscosity(c("p"), c("t"), c("salt")))
f16_water_gas = _oil("f16_water_gas", lambda: L.water_gas(c("p"), c("t"), c("salt")), 7)


def f17_free_gas(spark, d):
    rows = L.free_gas(inputs(spark, d).withColumnRenamed("rsb", "gor"))
    return rows.select("wellid", *(F.round(x, 4).alias(x) for x in ("gas_sat", "oil_sat", "rsb", "pb", "bo", "bg", "mu_o", "mu_g")))


def components(spark, d):
    part = X.table(spark, d, "part")
    return part.select(
        (c("p_partkey") % 50).alias("stream_id"), c("p_partkey").alias("component"), F.lit(1000.0).alias("volume_mcf"), F.lit(0.05).alias("shrink"), ((c("p_size") + 1) / 1000).alias("mol_pct"),
        F.when(c("p_partkey") % 5 != 0, c("p_size") / 2.0).alias("liquid"), F.col("p_retailprice").alias("btu"), F.when(c("p_partkey") % 7 != 0, (c("p_partkey") % 12) / 10).alias("recovery"), F.when(c("p_partkey") % 3 == 0, 0.9).alias("pop"),
    )


def f18_gas_processing(spark, d):
    return L.processing(components(spark, d)).select("component", *(F.round(x, 4).alias(x) for x in ("recovered_gals", "wet_btu", "extracted_btu", "reduced_mol")))


def f19_gas_batch(spark, d):
    return L.processing(components(spark, d)).select("stream_id", "component", *(F.round(x, 4).alias(x) for x in ("settlement_gals", "residue_btu")))


QUERIES = {f.__name__: f for f in (
    f1_to_float, f2_critical_temperature, f3_critical_pressure, f4_z_factor, f4_z_factor_compat, f5_gas_compressibility, f6_gas_viscosity, f7_gas_volume_factor, f8_pseudo_pressure, f9_bubble_point, f10_solution_gas,
    f11_oil_volume_factor, f12_oil_viscosity, f13_water_compressibility, f14_water_volume_factor, f15_water_viscosity, f16_water_gas, f17_free_gas, f18_gas_processing, f19_gas_batch,
)}

_CRITICAL = f"""{INPUTS}, g as (select *, 120 * (power(co2 + h2s, 0.9) - power(co2 + h2s, 1.6)) + 15 * power(h2s, 4.5) as adj, 169.2 + 349.5 * sg - 74 * sg * sg as t1 from f),
  h as (select *, t1 - adj as tpc, (756.8 - 131 * sg - 3.6 * sg * sg) * (t1 - adj) / (t1 + h2s * (1 - h2s) * adj) as ppc from g)"""
_Z = f"""{_CRITICAL.replace('with ', 'with recursive ', 1)}, q as (select *, (t + 460) / tpc as tr, p / ppc as pr from h),
  s as (select *, 0.3265 - 1.07 / tr - 0.5339 / tr ** 3 + 0.01569 / tr ** 4 - 0.05165 / tr ** 5 as ka, 0.5475 - 0.7361 / tr + 0.1844 / tr ** 2 as kb, 0.1056 * (-0.7361 / tr + 0.1844 / tr ** 2) as kc from q),
  it as (select wellid, 0 as n, 1.0::double as z, 0.27 * pr / tr as k, tr, ka, kb, kc from s
    union all select wellid, n + 1, (z + 1 + ka * (k / z) + kb * (k / z) ** 2 - kc * (k / z) ** 5 + 0.6134 * (1 + 0.721 * (k / z) ** 2) * (k / z) ** 2 / tr ** 3 * exp(-0.721 * (k / z) ** 2)) / 2, k, tr, ka, kb, kc from it where n < 150),
  zz as (select s.*, it.z from s join it using (wellid) where n = 150)"""
_PB = "1091.47 * power(power(rsb, 0.081465) * power(sg, -0.161488) * power(10, 0.013098 * power(t, 0.282372) - 8.2e-6 * power(api, 2.176124)) - 0.740152, 5.354891) - 14.7"
_OIL = f"{INPUTS}, b as (select *, {_PB} as pb from f)"
_GAS = """with g as (select p_partkey % 50 as stream_id, p_partkey as component, (p_size + 1) / 1000 as mol, case when p_partkey % 5 <> 0 then p_size / 2 else 0 end as liq, p_retailprice as btu,
    case when p_partkey % 7 <> 0 then least((p_partkey % 12) / 10, 1) else 0 end as rec, case when p_partkey % 3 = 0 then 0.9 else 1 end as pop from part),
  r as (select *, case when liq > 0 then mol / (liq * 14.696::double / 14.65) * rec * 950000 else 0 end as gals, mol * btu * 14.65::double / 14.696 as wet, mol * (1 - rec) as red from g)"""
ORACLES = {
    "f1_to_float": f"with {X.SQL} select wellid, case when wellid % 4 = 2 then wellid::double else 7.5::double end as x from well_header",
    "f2_critical_temperature": f"{_CRITICAL} select wellid, round(tpc, 4) as tpc from h",
    "f3_critical_pressure": f"{_CRITICAL} select wellid, round(ppc, 4) as ppc from h",
    "f4_z_factor": f"{_Z} select wellid, round(z, 4) as z from zz",
    "f4_z_factor_compat": f"{_Z} select wellid, round(z, 3) as z from zz",
    "f5_gas_compressibility": f"""{_Z}, r as (select *, 0.27 * pr / (z * tr) as r from zz), e as (select *, ka + 2 * r * kb - 5 * r ** 4 * kc + 2 * 0.6134 * r / tr ** 3 * (1 + 0.721 * r ** 2 - 0.721::double ** 2 * r ** 4) * exp(-0.721 * r ** 2) as de from r)
      select wellid, round((1 / pr - 0.27 / (z * z * tr) * de / (1 + r / z * de)) / ppc * 1e6, 3) as cg from e""",
    "f6_gas_viscosity": f"""{_Z}, m as (select *, 28.97 * sg as mw, t + 460 as tt from zz), n as (select *, p * mw / (z * 10.732::double * tt) / 62.427962 as rho, 3.448 + 986.4 / tt + 0.01009 * mw as bb from m)
      select wellid, round((9.379 + 0.01607 * mw) * power(tt, 1.5) / (209.2 + 19.26 * mw + tt) / 10 * exp(bb * power(rho, 2.447 - 0.2224 * bb)), 4) as mu_g from n""",
    "f7_gas_volume_factor": f"{_Z} select wellid, round(28.29 * z * (t + 460) / p, 4) as bg from zz",
    "f9_bubble_point": f"{_OIL} select wellid, round(pb, 4) as x from b",
    "f10_solution_gas": f"""{_OIL}, k as (select *, 9.7e-7 * power(sg, 1.672608) * power(api, 0.92987) * power(t, 0.247235) * power(pb, 1.056052) as ka, 0.022339 * power(sg, -1.00475) * power(api, 0.337711) * power(t, 0.132795) * power(pb, 0.302065) as kb,
      0.725167 * power(sg, -1.48548) * power(api, -0.164741) * power(t, -0.09133) * power(pb, 0.047094) as kc from b) select wellid, round(rsb * (ka * power(p / pb, kb) + (1 - ka) * power(p / pb, kc)), 4) as x from k""",
    "f11_oil_volume_factor": f"""{_OIL}, o as (select *, 1.023761 + 0.000122 * power(power(rsb, 0.413179) * power(sg, 0.210293) * power(api, 0.127123) + 0.019073 * t, 2.465976) as bob, (-1433 + 5 * rsb + 17.2 * t - 1180 * sg + 12.61 * api) / (100000 * (p + 14.7)) as co from b)
      select wellid, round(case when p > pb then bob * exp(co * (p - pb)) else bob end, 4) as x from o""",
    "f12_oil_viscosity": f"""{_OIL}, o as (select *, power(10, power(10, 3.0324 - 0.02023 * api) * power(t, -1.163)) - 1 as dead from b), l as (select *, 10.715 * power(rsb + 100, -0.515) * power(dead, 5.44 * power(rsb + 150, -0.338)) as live from o)
      select wellid, round(case when p < pb then live else live * power(p / pb, 2.6 * power(p + 14.7, 1.187) * exp(-0.0000898 * (p + 14.7) - 11.513)) end, 4) as x from l""",
    "f13_water_compressibility": f"""{INPUTS} select wellid, round((3.8546 - 0.000134 * p + (-0.01052 + 0.000000477 * p) * t + (0.000039267 - 0.00000000088 * p) * t * t) * (1 + 0.0089 * rsw)
      * ((-0.052 + 0.00027 * t - 0.00000114 * t * t + 0.000000001121 * t * t * t) * power(salt, 0.7) + 1), 4) as x from f""",
    "f14_water_volume_factor": f"""{INPUTS} select wellid, round((0.9911 + 0.0000635 * t + 0.00000085 * t * t + (-0.000001093 - 0.000000003497 * t + 0.00000000000457 * t * t) * p + (-0.00000000005 + 6.429e-13 * t - 1.43e-15 * t * t) * p * p)
      * ((0.000000051 * p + (0.00000547 - 0.000000000195 * p) * (t - 60) + (-0.0000000323 + 0.00000000000085 * p) * (t - 60) * (t - 60)) * salt + 1), 4) as x from f""",
    "f15_water_viscosity": f"""{INPUTS}, w as (select *, (t - 32) * 5 / 9 as tc, (t - 32) * 5 / 9 + 273.15 as tk, 0.65 - 0.01 * ((t - 32) * 5 / 9) as x from f),
      v as (select *, 22088 * exp((374.136 - tc) * (-7.419242 - 0.29721 * x - 0.1155286 * x ** 2 - 0.008685635 * x ** 3 + 0.001094098 * x ** 4 + 0.00439993 * x ** 5 + 0.002520658 * x ** 6 + 0.0005218684 * x ** 7) / tk) as ps from w)
      select wellid, round(0.02414 * power(10, 247.8 / (tk - 140)) * (1 + (p / 14.504 - ps) * 0.0000010467 * (tk - 305)) * (1 - 0.00187 * sqrt(salt) + 0.000218 * power(salt, 2.5) + (sqrt(t) - 0.0135 * t) * (0.00276 * salt - 0.000344 * power(salt, 1.5))), 4) as x from v""",
    "f16_water_gas": f"""{INPUTS} select wellid, round((2.12 + 0.00345 * t - 0.0000359 * t * t + (0.0107 - 0.0000526 * t + 0.000000148 * t * t) * p + (-0.000000875 + 0.0000000039 * t - 0.0000000000102 * t * t) * p * p) * (1 - (0.0753 - 0.000173 * t) * salt), 7) as x from f""",
    "f18_gas_processing": f"{_GAS} select component, round(gals, 4) as recovered_gals, round(wet, 4) as wet_btu, round(wet * rec, 4) as extracted_btu, round(red, 4) as reduced_mol from r",
    "f19_gas_batch": f"{_GAS} select stream_id, component, round(gals * pop, 4) as settlement_gals, round(red / case when sum(red) over w > 0 then sum(red) over w else 1 end * btu * (14.65::double / 14.696), 4) as residue_btu from r window w as (partition by stream_id)",
}
