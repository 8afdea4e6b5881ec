"""Reservoir fluid properties and gas processing as column expressions (field units: psi, deg F, API, scf, bbl)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Coefficients of published correlations.
#: Compressibility equation of state, a1 to a11.
STATE = (0.3265, -1.07, -0.5339, 0.01569, -0.05165, 0.5475, -0.7361, 0.1844, 0.1056, 0.6134, 0.7210)
#: Solution gas below the bubble point: a0 to a4, b0 to b4, c0 to c4.
SOLUTION_GAS = ((9.7e-7, 1.672608, 0.92987, 0.247235, 1.056052), (0.022339, -1.00475, 0.337711, 0.132795, 0.302065), (0.725167, -1.48548, -0.164741, -0.09133, 0.047094))
#: Saturation pressure of water, powers 0 to 7.
SATURATION = (-7.419242, -0.29721, -0.1155286, -0.008685635, 0.001094098, 0.00439993, 0.002520658, 0.0005218684)
RANKINE, STANDARD_PSI, BASE_PSI, ATMOSPHERE = 460.0, 14.696, 14.65, 14.7


def polynomial(x: Column, coefficients) -> Column:
    """Coefficients from the constant on, which may be columns."""
    out = None
    for c in reversed(tuple(coefficients)):
        c = c if isinstance(c, Column) else F.lit(float(c))
        out = c if out is None else out * x + c
    return out


def to_float(x: Column, default: float) -> Column:
    return F.coalesce(F.nanvl(x.try_cast("double"), F.lit(None).cast("double")), F.lit(default))


def _sour(co2: Column, h2s: Column) -> Column:
    a = co2 + h2s
    return 120 * (F.pow(a, F.lit(0.9)) - F.pow(a, F.lit(1.6))) + 15 * F.sqrt(h2s) * F.pow(h2s, F.lit(4.0))


def _sweet_temperature(sg: Column) -> Column:
    return polynomial(sg, (169.2, 349.5, -74.0))


def critical_temperature(sg: Column, co2: Column, h2s: Column) -> Column:
    return _sweet_temperature(sg) - _sour(co2, h2s)


def critical_pressure(sg: Column, co2: Column, h2s: Column) -> Column:
    sweet = polynomial(sg, (756.8, -131.0, -3.6))
    return sweet * critical_temperature(sg, co2, h2s) / (_sweet_temperature(sg) + h2s * (1 - h2s) * _sour(co2, h2s))


def _state(tr: Column) -> tuple[Column, Column, Column, Column]:
    """Density coefficients of the equation of state at a reduced temperature."""
    a = STATE
    return (
        a[0] + a[1] / tr + a[2] / F.pow(tr, F.lit(3.0)) + a[3] / F.pow(tr, F.lit(4.0)) + a[4] / F.pow(tr, F.lit(5.0)), a[5] + a[6] / tr + a[7] / (tr * tr),
        a[8] * (a[6] / tr + a[7] / (tr * tr)), a[9] / F.pow(tr, F.lit(3.0)),
    )


def _z_of(density, s):
    """Of columns, or of arrays in a dict."""
    square = density * density
    exp = F.exp if isinstance(square, Column) else np.exp
    return 1 + s["a"] * density + s["b"] * square - s["c"] * square * square * density + s["d"] * (1 + STATE[10] * square) * square * exp(-STATE[10] * square)


def z_factor(p: Column, t: Column, sg: Column, co2: Column, h2s: Column, *, compat: bool = False, steps: int = 60) -> Column:
    """Gas compressibility factor: the root of the equation of state between 0.2 and 3, by halving. With compat the
    plain substitution instead, up to 1000 steps, which swings between values at very high pressure."""
    tr, pr = (t + RANKINE) / critical_temperature(sg, co2, h2s), p / critical_pressure(sg, co2, h2s)
    a, b, c, d = _state(tr)
    parts = F.struct(a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"), (0.27 * pr / tr).alias("k"))
    if compat:
        start = F.struct(parts.alias("s"), parts["k"].alias("density"), F.lit(1.0).alias("z"), F.lit(False).alias("done"))

        def swap(x: Column, _: Column) -> Column:
            z = _z_of(x["density"], x["s"])
            new = x["s"]["k"] / z
            done = x["done"] | (F.abs((new - x["density"]) / new) <= 1e-5)
            return F.struct(x["s"].alias("s"), F.when(x["done"], x["density"]).otherwise(new).alias("density"), F.when(x["done"], x["z"]).otherwise(z).alias("z"), done.alias("done"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(1000)), start, swap, lambda x: x["z"])
    start = F.struct(parts.alias("s"), F.lit(0.2).alias("lo"), F.lit(3.0).alias("hi"))

    def halve(x: Column, _: Column) -> Column:
        mid = (x["lo"] + x["hi"]) / 2
        above = _z_of(x["s"]["k"] / mid, x["s"]) - mid > 0
        return F.struct(x["s"].alias("s"), F.when(above, mid).otherwise(x["lo"]).alias("lo"), F.when(above, x["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda x: (x["lo"] + x["hi"]) / 2)


def gas_compressibility(p: Column, t: Column, sg: Column, co2: Column, h2s: Column, z: Column) -> Column:
    critical = critical_pressure(sg, co2, h2s)
    tr, pr = (t + RANKINE) / critical_temperature(sg, co2, h2s), p / critical
    a, b, c, d = _state(tr)
    r = 0.27 * pr / (z * tr)
    square = r * r
    k = STATE[10]
    slope = a + 2 * r * b - 5 * square * square * c + 2 * r * d * (1 + k * square - k * k * square * square) * F.exp(-k * square)
    return (1 / pr - 0.27 / (z * z * tr) * (slope / (1 + r / z * slope))) / critical


def gas_viscosity(p: Column, t: Column, sg: Column, z: Column) -> Column:
    weight, kelvin = 28.97 * sg, t + RANKINE
    density = p * weight / (z * 10.732 * kelvin) / 62.427962
    scale = (9.379 + 0.01607 * weight) * F.pow(kelvin, F.lit(1.5)) / (209.2 + 19.26 * weight + kelvin)
    b = 3.448 + 986.4 / kelvin + 0.01009 * weight
    return scale / 10000 * F.exp(b * F.pow(density, 2.447 - 0.2224 * b))


def gas_volume_factor(p: Column, t: Column, z: Column) -> Column:
    return 0.02829 * z * (t + RANKINE) / p


def bubble_point(t: Column, rsb: Column, api: Column, sg: Column, atmosphere: float = ATMOSPHERE) -> Column:
    x = 0.013098 * F.pow(t, F.lit(0.282372)) - 8.2e-6 * F.pow(api, F.lit(2.176124))
    inner = F.pow(rsb, F.lit(0.081465)) * F.pow(sg, F.lit(-0.161488)) * F.pow(F.lit(10.0), x) - 0.740152
    return 1091.47 * F.pow(inner, F.lit(5.354891)) - atmosphere


def solution_gas(p: Column, t: Column, rsb: Column, api: Column, sg: Column) -> Column:
    pb = bubble_point(t, rsb, api, sg)

    def power(c: tuple[float, ...]) -> Column:
        out = F.lit(c[0])
        for base, exponent in zip((sg, api, t, pb), c[1:]):
            out = out * F.pow(base, F.lit(exponent))
        return out

    a, b, c = map(power, SOLUTION_GAS)
    return rsb * (a * F.pow(p / pb, b) + (1 - a) * F.pow(p / pb, c))


def oil_volume_factor(p: Column, t: Column, rsb: Column, api: Column, sg: Column, p_sep: float = 100.0, t_sep: float = 100.0) -> Column:
    pb = bubble_point(t, rsb, api, sg)
    at_bubble = 1.023761 + 0.000122 * F.pow(F.pow(rsb, F.lit(0.413179)) * F.pow(sg, F.lit(0.210293)) * F.pow(api, F.lit(0.127123)) + 0.019073 * t, F.lit(2.465976))
    separator = sg * (1 + 5.912e-5 * api * t_sep * float(np.log((p_sep + ATMOSPHERE) / (100 + ATMOSPHERE))))
    squeeze = (-1433 + 5 * rsb + 17.2 * t - 1180 * separator + 12.61 * api) / (100000 * (p + ATMOSPHERE))
    return F.when(p > pb, at_bubble * F.exp(squeeze * (p - pb))).otherwise(at_bubble)


def oil_viscosity(p: Column, t: Column, rsb: Column, api: Column, sg: Column) -> Column:
    pb = bubble_point(t, rsb, api, sg)
    dead = F.pow(F.lit(10.0), F.pow(F.lit(10.0), 3.0324 - 0.02023 * api) * F.pow(t, F.lit(-1.163))) - 1
    live = 10.715 * F.pow(rsb + 100, F.lit(-0.515)) * F.pow(dead, 5.44 * F.pow(rsb + 150, F.lit(-0.338)))
    absolute = p + ATMOSPHERE
    power = 2.6 * F.pow(absolute, F.lit(1.187)) * F.exp(-0.0000898 * absolute - 11.513)
    return F.when(p < pb, live).otherwise(live * F.pow(p / pb, power))


def water_compressibility(p: Column, t: Column, rsw: Column, salt: Column) -> Column:
    base = polynomial(t, (3.8546 - 0.000134 * p, -0.01052 + 4.77e-7 * p, 3.9267e-5 - 8.8e-10 * p)) / 1e6
    return base * (1 + 0.0089 * rsw) * (polynomial(t, (-0.052, 0.00027, -0.00000114, 1.121e-9)) * F.pow(salt, F.lit(0.7)) + 1)


def water_volume_factor(p: Column, t: Column, salt: Column) -> Column:
    base = polynomial(p, (polynomial(t, (0.9911, 6.35e-5, 8.5e-7)), polynomial(t, (-1.093e-6, -3.497e-9, 4.57e-12)), polynomial(t, (-5e-11, 6.429e-13, -1.43e-15))))
    return base * (polynomial(t - 60, (5.1e-8 * p, 5.47e-6 - 1.95e-10 * p, -3.23e-8 + 8.5e-13 * p)) * salt + 1)


def water_viscosity(p: Column, t: Column, salt: Column) -> Column:
    celsius = 5 / 9 * (t - 32)
    kelvin = celsius + 273.15
    saturation = 22088 * F.exp((374.136 - celsius) * polynomial(0.65 - 0.01 * celsius, SATURATION) / kelvin)
    fresh = 0.02414 * F.pow(F.lit(10.0), 247.8 / (kelvin - 140)) * (1 + (p / 14.504 - saturation) * 1.0467e-6 * (kelvin - 305))
    return fresh * (1 - 0.00187 * F.sqrt(salt) + 0.000218 * F.pow(salt, F.lit(2.5)) + (F.sqrt(t) - 0.0135 * t) * (0.00276 * salt - 0.000344 * F.pow(salt, F.lit(1.5))))


def water_gas(p: Column, t: Column, salt: Column) -> Column:
    base = polynomial(p, (polynomial(t, (2.12, 0.00345, -3.59e-5)), polynomial(t, (0.0107, -5.26e-5, 1.48e-7)), polynomial(t, (-8.75e-7, 3.9e-9, -1.02e-11))))
    return base * (1 - (0.0753 - 0.000173 * t) * salt)


def pseudo_pressure(rows: DataFrame, *, nodes: int = 24) -> DataFrame:
    """rows (p, t, sg, co2, h2s and any others) with m, the integral of p / (viscosity z) from 0 to p, by Gauss-Legendre
    nodes. Each row sums its own nodes, so nothing is shuffled and rows that repeat stay apart."""
    x, w = np.polynomial.legendre.leggauss(nodes)
    points = F.array(*(F.struct(F.lit(float((a + 1) / 2)).alias("x"), F.lit(float(b / 2)).alias("w")) for a, b in zip(x, w)))
    tr = (F.col("t") + RANKINE) / critical_temperature(F.col("sg"), F.col("co2"), F.col("h2s"))
    k = 0.27 * (F.col("p") / critical_pressure(F.col("sg"), F.col("co2"), F.col("h2s"))) / tr
    z = _z_factors(*(v.cast("double") for v in _state(tr)), F.transform(points, lambda node: k * node["x"]))

    def part(total: Column, node: Column) -> Column:
        at = F.col("p") * node["n"]["x"]
        return total + at / (gas_viscosity(at, F.col("t"), F.col("sg"), node["z"]) * node["z"]) * node["n"]["w"] * F.col("p")

    staged = rows.withColumn("z__", z)
    return staged.withColumn("m", F.aggregate(F.arrays_zip(points.alias("n"), F.col("z__").alias("z")), F.lit(0.0), part)).drop("z__")


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _z_factors(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array, k: pa.Array) -> pa.Array:
    """z_factor's root for every k of a row by the same halving, a batch of rows at once: as nested higher-order functions,
    which Spark interprets, each of its steps took microseconds."""
    counts = np.diff(k.offsets.to_numpy())
    at = k.flatten()
    given = {n: np.repeat(v.to_numpy(zero_copy_only=False).astype(float), counts) for n, v in zip("abcd", (a, b, c, d))}
    unknown = at.is_null().to_numpy(zero_copy_only=False)
    at = at.to_numpy(zero_copy_only=False).astype(float)
    out = np.empty(len(at))
    for first in range(0, len(at), 8192):  # what stays in a core's cache
        part = slice(first, first + 8192)
        own, s = at[part], {n: v[part] for n, v in given.items()}
        low, high = np.full(len(own), 0.2), np.full(len(own), 3.0)
        with np.errstate(all="ignore"):
            for _ in range(60):
                middle = (low + high) / 2
                above = ~(_z_of(own / middle, s) - middle <= 0)  # NaN is above all numbers, as in Spark
                low, high = np.where(above, middle, low), np.where(above, high, middle)
        out[part] = (low + high) / 2
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(out, mask=unknown))


def halved(lo: Column, hi: Column, f, steps: int = 80) -> Column:
    """Where f, rising over the interval, crosses zero."""
    start = F.struct(lo.cast("double").alias("lo"), hi.cast("double").alias("hi"))

    def halve(x: Column, _: Column) -> Column:
        mid = (x["lo"] + x["hi"]) / 2
        below = f(mid) < 0
        return F.struct(F.when(below, mid).otherwise(x["lo"]).alias("lo"), F.when(below, x["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda x: (x["lo"] + x["hi"]) / 2)


def free_gas(rows: DataFrame, *, sro: float = 0.3, srg: float = 0.0, gas_end: float = 0.8, oil_end: float = 0.7, gas_power: float = 3.0, oil_power: float = 3.0) -> DataFrame:
    """rows (p, t, gor, api, sg, sw, co2, h2s) with saturations of free gas and oil, solution gas, bubble point, volume
    factors and viscosities. Below the bubble point of the produced ratio, the solution gas is that whose bubble point
    is p; the oil saturation is where Corey's fractional flow of gas meets the produced one."""
    c = F.col
    below = c("p") < bubble_point(c("t"), c("gor"), c("api"), c("sg"))
    rows = rows.withColumn("pb", F.when(below, c("p")).otherwise(bubble_point(c("t"), c("gor"), c("api"), c("sg"))))
    # The bubble point rises with the gas in solution; below its least argument the power is of a negative number.
    matching = halved(F.lit(0.0), c("gor"), lambda r: F.coalesce(F.nanvl(bubble_point(c("t"), r, c("api"), c("sg")), F.lit(-1e9)), F.lit(-1e9)) - c("p"))
    rows = rows.withColumn("rsb", F.when(below, matching).otherwise(c("gor")))
    rows = rows.withColumn("z", z_factor(c("p"), c("t"), c("sg"), c("co2"), c("h2s")))
    rows = rows.withColumn("bo", oil_volume_factor(c("p"), c("t"), c("rsb"), c("api"), c("sg"))).withColumn("bg", gas_volume_factor(c("p"), c("t"), c("z")))
    rows = rows.withColumn("mu_o", oil_viscosity(c("p"), c("t"), c("rsb"), c("api"), c("sg"))).withColumn("mu_g", gas_viscosity(c("p"), c("t"), c("sg"), c("z")))
    gas = (c("gor") - c("rsb")) * c("bg") / 5.615
    rows = rows.withColumn("flow", gas / (c("bo") + gas))

    def excess(gas_sat: Column) -> Column:
        oil_sat = 1 - c("sw") - gas_sat
        kro = oil_end * F.pow((oil_sat - sro) / (1 - sro - c("sw")), F.lit(oil_power))
        krg = gas_end * F.pow((gas_sat - srg) / (1 - sro - c("sw") - srg), F.lit(gas_power))
        return krg / c("mu_g") / (krg / c("mu_g") + kro / c("mu_o")) - c("flow")

    gas_sat = F.when(c("rsb") < c("gor"), halved(F.lit(srg), 1 - c("sw") - sro, excess)).otherwise(0.0)
    return rows.withColumn("gas_sat", gas_sat).withColumn("oil_sat", 1 - c("sw") - c("gas_sat")).drop("z", "flow")


def processing(components: DataFrame, *, base_psi: float = BASE_PSI) -> DataFrame:
    """Rows (stream_id, component, volume_mcf, shrink, mol_pct, liquid, btu, recovery, pop) with gallons recovered and
    settled, wet, extracted and residue heat. Missing numbers count as 0, a missing share of proceeds as 1."""
    n = lambda c, lo, hi=None, default=0.0: F.greatest(F.lit(lo), to_float(F.col(c), default)) if hi is None else F.least(F.lit(hi), F.greatest(F.lit(lo), to_float(F.col(c), default)))
    base = base_psi if np.isfinite(base_psi) and base_psi > 0 else STANDARD_PSI
    processed = F.greatest(F.lit(0.0), to_float(F.col("volume_mcf"), 0.0) * 1000 * (1 - n("shrink", 0.0, 0.999999)))
    mol, liquid, heat, recovery = n("mol_pct", 0.0), n("liquid", 0.0), n("btu", 0.0), n("recovery", 0.0, 1.0)
    gallons = F.when(liquid > 0, mol / F.nullif(liquid * (STANDARD_PSI / base), F.lit(0.0)) * recovery * processed).otherwise(0.0)
    wet = mol * heat * base / STANDARD_PSI
    rows = components.select("*", gallons.alias("recovered_gals"), wet.alias("wet_btu"), (wet * recovery).alias("extracted_btu"), (mol * (1 - recovery)).alias("reduced_mol"))
    total = F.sum("reduced_mol").over(Window.partitionBy("stream_id"))
    residue = F.col("reduced_mol") / F.when(total > 0, total).otherwise(1.0) * heat * (base / STANDARD_PSI)
    return rows.select("*", (F.col("recovered_gals") * to_float(F.col("pop"), 1.0)).alias("settlement_gals"), residue.alias("residue_btu"))
