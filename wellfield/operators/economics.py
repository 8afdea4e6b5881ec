"""Monthly cash flow, economic limits, present values, futures strips and economic-data lines."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Discount rates of a present-value profile.
RATES = (0.05, 0.08, 0.09, 0.1, 0.12, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
#: Letters of the delivery months January to December.
MONTH_LETTERS = "FGHJKMNQUVXZ"
FLOWS = ("oil_sales", "gas_sales", "ngl_sales", "oil_rev", "gas_rev", "ngl_rev", "total_rev", "tax", "opex", "op_cf", "net_cf")


def _cents(x: Column, on: bool) -> Column:
    return F.floor(x * 100 + 0.5) / 100 if on else x


def _flows(wi: Column, nri: Column, cents: bool) -> dict[str, Column]:
    c = F.col
    produced, invested = c("weight") * c("prod_wt"), c("weight") * c("inv_wt")
    oil, gas = c("oil") * nri * produced, c("gas") * nri * c("shrink") * produced
    ngl = c("ngl_yield") * c("gas") * nri * produced
    oil_rev, gas_rev = _cents(oil * (c("pri_oil") + c("paj_oil")), cents), _cents(gas * c("btu") * (c("pri_gas") + c("paj_gas")), cents)
    ngl_rev = _cents(ngl * c("pri_oil") * c("paj_ngl"), cents)
    total = oil_rev + gas_rev + ngl_rev
    tax = oil_rev * c("stx_oil") + gas_rev * c("stx_gas") + ngl_rev * c("stx_ngl") + total * c("adval")
    variable = c("prod_wt") * (c("oil") * c("opc_oil") + c("gas") * c("shrink") * c("opc_gas") + c("water") * c("opc_wtr"))
    opex = F.when(c("month") >= c("first_month"), wi * invested * (variable + c("opc_fix"))).otherwise(0.0)
    op_cf = total - tax - opex
    net = op_cf - F.when(c("month") == c("first_month"), c("capex") * invested * wi).otherwise(0.0)
    return dict(zip(FLOWS, (oil, gas, ngl, oil_rev, gas_rev, ngl_rev, total, tax, opex, op_cf, net)))


def cash_flow(volumes: DataFrame, inputs: DataFrame, *, cents: bool = False) -> DataFrame:
    """Per well and month: net volumes, revenues, tax, operating cost from the first producing month on, operating and
    net cash flow and their running totals, and the running operating total of the basis that the life is judged on.

    That basis is full working interest with 1 - royalty where there is no working interest or the net share is more
    than that of it; otherwise it is the well's own."""
    by = Window.partitionBy("uid")
    first = F.min(F.when(F.col("oil") + F.col("gas") > 0, F.col("month"))).over(by)
    rows = volumes.join(inputs, "uid").withColumn("first_month", first)
    own = _flows(F.col("wi"), F.col("nri"), cents)
    full = (F.col("wi") == 0) | (F.col("nri") / F.nullif(F.col("wi"), F.lit(0.0)) > 1 - F.col("roy"))
    basis = _flows(F.when(full, F.lit(1.0)).otherwise(F.col("wi")), F.when(full, 1 - F.col("roy")).otherwise(F.col("nri")), cents)["op_cf"]
    rows = rows.select("*", *(x.alias(n) for n, x in own.items()), basis.alias("basis_cf"))
    so_far = by.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("*", *(F.sum(a).over(so_far).alias(b) for a, b in (("op_cf", "cum_op"), ("net_cf", "cum_net"), ("basis_cf", "cum_basis"))))


def economic(flows: DataFrame) -> DataFrame:
    """Cash flow to the economic limit: life is the place of the first largest running total of the basis. In the month
    before life + eloss (the last one at most) the well is abandoned at a cost; later months are zero."""
    by = Window.partitionBy("uid")
    so_far = by.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    rows = flows.withColumn("place", F.row_number().over(by.orderBy("month")) - 1)
    best = F.max(F.struct("cum_basis", -F.col("place"))).over(by)
    rows = rows.withColumn("life", -best["col2"]).withColumn("n_months", F.count("*").over(by))
    rows = rows.withColumn("aban_month", F.least(F.col("life") + F.col("eloss"), F.col("n_months")) - 1)
    cost = F.when(F.col("month") == F.col("aban_month"), F.col("aban") * F.col("weight") * F.col("inv_wt") * F.col("wi")).otherwise(0.0)
    rows = rows.withColumn("net_cf", F.col("net_cf") - cost).withColumn("cum_net", F.sum("net_cf").over(so_far))
    shown = ["oil", "gas", "water", *FLOWS, "cum_op", "cum_net"]
    live = F.col("month") <= F.col("aban_month")
    return rows.select(*(F.when(live, F.col(c)).otherwise(0.0).alias(c) if c in shown else F.col(c) for c in rows.columns))


def present_value(rate: Column, flow: str = "net_cf", month: str = "month") -> Column:
    """Sum of flows discounted to mid month."""
    return F.sum(F.col(flow) / F.pow(1 + rate, (F.col(month) + 0.5) / 12))


def profile(flows: DataFrame, rates: tuple[float, ...] = RATES) -> DataFrame:
    """Present values at all rates, in one pass over the months."""
    wide = flows.groupBy("uid").agg(*(present_value(F.lit(r)).alias(str(k)) for k, r in enumerate(rates)))
    pairs = F.array(*(F.struct(F.lit(r).alias("rate"), F.col(str(k)).alias("npv")) for k, r in enumerate(rates)))
    return wide.select("uid", F.explode(pairs).alias("p")).select("uid", "p.rate", "p.npv")


def summary(flows: DataFrame, rate: float = 0.1) -> DataFrame:
    """Life in years, payout in years (where the running net total crosses zero), return on investment plain and
    discounted, and gross recoveries."""
    by = Window.partitionBy("uid").orderBy("month")
    rows = flows.withColumn("before", F.lag("cum_net").over(by)).withColumn("last_month", F.max("month").over(Window.partitionBy("uid")))
    part = -F.col("before") / F.nullif(F.col("cum_net") - F.col("before"), F.lit(0.0))
    crossing = F.when((F.col("cum_net") >= 0) & (F.col("before") < 0), F.col("month") - 1 + part)
    sums = rows.groupBy("uid").agg(
        F.max("life").alias("life"), F.max("eloss").alias("eloss"), F.max("n_months").alias("n"), F.min(crossing).alias("cross"), F.min_by("cum_net", "month").alias("at_first"), F.max("last_month").alias("last"),
        F.sum("net_cf").alias("net"), present_value(F.lit(rate)).alias("pv"), F.max(F.col("capex") * F.col("weight") * F.col("inv_wt") * F.col("wi")).alias("spent"),
        (F.sum("oil_sales") / F.nullif(F.max("nri"), F.lit(0.0))).alias("oil_eur"), (F.sum("gas_sales") / F.nullif(F.max("nri") * F.max("shrink"), F.lit(0.0))).alias("gas_eur"),
    )
    roi = lambda x: F.when(F.col("spent") == 0, 0.0).otherwise((F.col("spent") + x) / F.nullif(F.col("spent"), F.lit(0.0)))
    months = F.when(F.col("at_first") >= 0, 0.0).otherwise(F.coalesce("cross", F.col("last").cast("double")))
    life = F.least(F.greatest(F.col("life") + F.col("eloss"), F.lit(0)), F.col("n"))
    return sums.select("uid", (life / 12).alias("life"), (months / 12).alias("payout"), roi(F.col("net")).alias("roi"), roi(F.col("pv")).alias("droi"), "oil_eur", "gas_eur")


#: Brackets of roots double up to this power of two; where f has no change of sign by then, there is no root.
DOUBLINGS = 40


#: Wells solved together.
TOGETHER = 512


def _roots(f, count: int, lo: float, hi: float) -> np.ndarray:
    """For each of `count` functions, positive below and not above, where it changes sign: brackets grow on both sides until
    it does; NaN where it never does. f maps an array of arguments, one a function, to their values."""
    width = hi - lo
    low, high, none = np.full(count, lo), np.full(count, hi), np.zeros(count, bool)
    for step in (-1, 1):
        for k in range(DOUBLINGS):
            wrong = ~none & ((f(low) <= 0) if step < 0 else (f(high) > 0))
            if not wrong.any():
                break
            low, high = np.where(wrong, low - width * 2.0**k if step < 0 else high, low), np.where(wrong, low if step < 0 else high + width * 2.0**k, high)
        else:
            none |= wrong
    while True:
        middle = (low + high) / 2
        if not ((low < middle) & (middle < high) & ~none).any():
            return np.where(none, np.nan, middle)
        below = f(middle) > 0
        low, high = np.where(below, middle, low), np.where(below, high, middle)


def _padded(columns: list, length: int) -> np.ndarray:
    """Arrays of several wells as rows of one, filled up with zeros."""
    out = np.zeros((len(columns), length))
    for k, values in enumerate(columns):
        out[k, : len(values)] = values
    return out


def _together(frames, columns: list[str]):
    """Slices of a batch: the other columns, and for each of `columns` (arrays by month) one row a well; which are months."""
    for frame in frames:
        for at in range(0, len(frame), TOGETHER):
            part = frame.iloc[at : at + TOGETHER]
            lengths = part[columns[0]].map(len).to_numpy()
            yield part, {c: _padded(list(part[c]), int(lengths.max(initial=1))) for c in columns}, np.arange(int(lengths.max(initial=1))) < lengths[:, None]


def irr(flows: DataFrame) -> DataFrame:
    """The yearly rate at which the net present value is zero, 0 at least; 1 without interest or investment, null where
    the value is positive at every rate. A well's months come together as one array, and many wells are solved at once."""
    rows = flows.select("uid", "month", "net_cf", (F.col("wi") * F.col("capex")).alias("spent"))
    ordered = F.sort_array(F.collect_list(F.struct("month", "net_cf", "spent")))
    months = rows.groupBy("uid").agg(ordered.alias("m")).select("uid", F.col("m")[0]["spent"].alias("spent"), F.col("m.month").alias("month"), F.col("m.net_cf").alias("net_cf"))

    def solve(frames):
        for part, own, there in _together(frames, ["month", "net_cf"]):
            years = (own["month"] + 0.5) / 12
            value = lambda r: (np.where(there, own["net_cf"], 0.0) / (1 + r[:, None]) ** years).sum(1)  # noqa: E731, B023
            start = value(np.zeros(len(part)))
            found = np.where(start <= 0, 0.0, _roots(lambda r: np.where(start <= 0, 0.5 - r, value(r)), len(part), 0.0, 1.0))  # noqa: B023
            rate = np.where(np.nan_to_num(part["spent"].to_numpy(float)) == 0, 1.0, found)
            yield pd.DataFrame({"uid": part["uid"], "irr": pd.Series(rate, index=part.index).astype(object).where(~np.isnan(rate), None)})

    return months.mapInPandas(solve, f"uid {flows.schema['uid'].dataType.simpleString()}, irr double")


def breakeven(volumes: DataFrame, inputs: DataFrame, *, rate: float = 0.1, ratio: float = 20.0) -> DataFrame:
    """The oil price, to cents, above which the present value is positive, the gas price being a fixed share of it; it
    may be negative, and is null where the value is positive at all prices or at none. A well's months come together as
    one array, and many wells are solved at once."""
    ordered = F.sort_array(F.collect_list(F.struct("month", "oil", "gas", "water")))
    months = volumes.groupBy("uid").agg(ordered.alias("m")).select("uid", *(F.col(f"m.{c}").cast("array<double>").alias(c) for c in ("month", "oil", "gas", "water")))

    def solve(frames):
        for part, own, there in _together(frames, ["month", "oil", "gas", "water"]):
            price = _roots(lambda p: 0.5 - (_values(own, there, part, p, rate, ratio) > 0), len(part), 0.0, 50.0).round(2)  # noqa: B023
            yield pd.DataFrame({"uid": part["uid"], "price": pd.Series(price, index=part.index).astype(object).where(~np.isnan(price), None)})

    return months.join(inputs, "uid").mapInPandas(solve, f"uid {inputs.schema['uid'].dataType.simpleString()}, price double")


def _values(t: dict[str, np.ndarray], there: np.ndarray, inputs: pd.DataFrame, price: np.ndarray, rate: float, ratio: float) -> np.ndarray:
    """Present value of each well's months (rows of t; `there` where it has a month) to its economic limit at its oil price."""
    i = {c: inputs[c].to_numpy(float)[:, None] for c in inputs.columns if c not in ("uid", "month", "oil", "gas", "water") and pd.api.types.is_numeric_dtype(inputs[c])}
    oil, gas, water, month, price = t["oil"], t["gas"], t["water"], t["month"], price[:, None]
    first = np.where(there & (oil + gas > 0), month, np.inf).min(axis=1, keepdims=True)
    produced, invested = i["weight"] * i["prod_wt"], i["weight"] * i["inv_wt"]

    def flow(wi: np.ndarray, nri: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        revenue = [oil * nri * produced * (price + i["paj_oil"]), gas * nri * i["shrink"] * produced * i["btu"] * (price / ratio + i["paj_gas"]), i["ngl_yield"] * gas * nri * produced * price * i["paj_ngl"]]
        total = sum(revenue)
        tax = sum(r * i[s] for r, s in zip(revenue, ("stx_oil", "stx_gas", "stx_ngl"))) + total * i["adval"]
        cost = wi * invested * (i["prod_wt"] * (oil * i["opc_oil"] + gas * i["shrink"] * i["opc_gas"] + water * i["opc_wtr"]) + i["opc_fix"])
        op = total - tax - np.where(month >= first, cost, 0.0)
        return op, op - np.where(month == first, i["capex"] * invested * wi, 0.0)

    with np.errstate(all="ignore"):
        full = (i["wi"] == 0) | (i["nri"] / i["wi"] > 1 - i["roy"])
    basis = flow(np.where(full, 1.0, i["wi"]), np.where(full, 1 - i["roy"], i["nri"]))[0]
    life = np.argmax(np.where(there, np.cumsum(np.where(there, basis, 0.0), axis=1), -np.inf), axis=1)[:, None]
    end = np.minimum(life + i["eloss"].astype(np.int64), there.sum(1, keepdims=True)) - 1
    net = flow(i["wi"], i["nri"])[1] - np.where(month == end, i["aban"] * invested * i["wi"], 0.0)
    return np.where(there & (month <= end), net / (1 + rate) ** ((month + 0.5) / 12), 0.0).sum(axis=1)


def strip(start: Column, months: int, symbol: str) -> Column:
    """The futures of the next months: struct of contract month and ticker code."""
    first = F.trunc(start, "month")
    letters = F.array(*map(F.lit, MONTH_LETTERS))
    return F.transform(
        F.sequence(F.lit(1), F.lit(months)),
        lambda k: F.struct(F.add_months(first, k).alias("contract_month"), F.concat(F.lit(symbol), F.element_at(letters, F.month(F.add_months(first, k))), F.date_format(F.add_months(first, k), "yy")).alias("ticker")),
    )


def business_days(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Weekdays that are no holidays, numbered in order. days has one row per date; a calendar is bounded by its span."""
    open_days = days.where(~F.dayofweek("day").isin(1, 7)).join(F.broadcast(holidays), "day", "left_anti")
    return open_days.withColumn("number", F.row_number().over(Window.orderBy("day")))


def expiry(contracts: DataFrame, calendar: DataFrame, kind: str) -> DataFrame:
    """Last trading day of each contract month. Oil: three business days before the 25th of the month before, or before
    the last business day ahead of it where it is none. Gas: three business days before the first of the month."""
    anchor = F.date_add(F.add_months("contract_month", -1), 24) if kind == "oil" else F.col("contract_month")
    within = F.col("day") <= F.col("anchor") if kind == "oil" else F.col("day") < F.col("anchor")
    back = 3 if kind == "oil" else 2
    near = F.col("day") > F.date_sub("anchor", 15)
    last = contracts.withColumn("anchor", anchor).join(F.broadcast(calendar), within & near).groupBy("contract_month").agg(F.max("number").alias("last"))
    days = calendar.select(F.col("number").alias("last"), F.col("day").alias("expiry"))
    return last.select("contract_month", (F.col("last") - back).alias("last")).join(F.broadcast(days), "last").select("contract_month", "expiry")


def expressions(forecast: DataFrame) -> DataFrame:
    """The four lines of each forecast as text, in their order."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0.0)).cast("double")
    text = lambda x: F.format_string("%.6f", x.cast("double"))
    unit = F.when(F.col("measure") == "GAS", "M/D").otherwise("B/D")
    months = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int").cast("string")
    next_rate = F.when(F.coalesce("t2", F.lit(0)) == 0, n("q3")).otherwise(n("q2"))
    percent = lambda c: text(F.round(n(c) * 100, 6))
    lines = F.array(
        F.concat_ws(" ", text(n("q1")), text(next_rate), unit, months("t1"), F.lit("MO EXP X")),
        F.concat_ws(" ", text(n("q2")), text(n("q3")), unit, months("t2"), F.lit("IMO EXP X")),
        F.concat_ws(" ", text(n("q3")), F.lit("X"), unit, percent("def"), F.lit("EXP"), F.concat(F.lit("B/"), F.format_string("%.4f", F.round(F.coalesce("b_factor", F.lit(1.0)), 4))), percent("dei")),
        F.concat_ws(" ", F.lit("X"), text(n("qabn")), unit, F.lit("X YRS EXP"), percent("def")),
    )
    return forecast.select("*", F.posexplode(lines).alias("line", "expression")).withColumn("line", F.col("line") + 1)


def live_lines(lines: DataFrame, *, compat: bool = False) -> DataFrame:
    """Without lines of zero-length segments. With compat also those of ten, twenty and so on months go."""
    if compat:
        return lines.where((F.instr("expression", "0 MO") == 0) & (F.instr("expression", "0 IMO") == 0))
    return lines.where(~F.col("expression").rlike(r"(^| )0 I?MO( |$)"))


def parse_expressions(lines: DataFrame) -> DataFrame:
    """Fields of a rate line: start, end, unit, limit, limit unit, b, decline as a fraction; X is nothing."""
    f = F.split("expression", " ")
    field = lambda k: F.nullif(F.element_at(f, k), F.lit("X"))
    rate = lambda k: field(k).try_cast("double") / F.when(field(3).isin("B/M", "M/M"), 30.42).otherwise(1.0)
    return lines.select("*", rate(1).alias("start"), rate(2).alias("end"), field(3).alias("unit"), F.nullif(F.regexp_extract("expression", r"B/([0-9.]+)", 1), F.lit("")).try_cast("double").alias("b"), (F.try_element_at(f, F.lit(7)).try_cast("double") / 100).alias("decline"))
