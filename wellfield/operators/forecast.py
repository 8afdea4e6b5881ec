"""Forecasts: the best per well and phase, its place in history, monthly volumes, reserves and type curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.decline import YEAR, Curve, decline_for, number
from ..functions.kernels import t_quantile
from .production import month_diff, priority

ANALYSTS = ("manual", "auto_fit_1", "auto_fit_2", "auto_fit_3")
HORIZON = 360


def best(forecast: DataFrame, order: tuple[str, ...] = ANALYSTS) -> DataFrame:
    """One forecast per well and phase: by analyst, then by name where two are not in the list."""
    by = Window.partitionBy("wellid", "measure").orderBy(priority("analyst", order), "analyst")
    return forecast.withColumn("place", F.row_number().over(by)).where("place = 1").drop("place")


def history(production: DataFrame) -> DataFrame:
    """First, last and total of each well and phase, and its number of months."""
    return production.groupBy("wellid", "measure").agg(F.min("dt").alias("mindate"), F.max("dt").alias("maxdate"), F.sum("value").alias("total"), F.max("daterank").alias("maxmonth"))


def view(forecast: DataFrame, production: DataFrame) -> DataFrame:
    """The best forecasts with start month and cumulative volume at the start.

    The start month counts on from the last month where the start lies after history; otherwise it is the month's rank,
    null if there is none. production has a daterank and one row per month. One shuffle by well and phase serves all."""
    keys, chosen = ["wellid", "measure"], best(forecast)
    own = [c for c in chosen.columns if c not in keys]
    rows = chosen.select(*keys, F.struct(*own).alias("own")).join(production.select(*keys, "dt", "value", "daterank"), keys, "left")
    start = F.col("own.startdate")
    sums = rows.groupBy(*keys).agg(
        F.any_value("own").alias("own"), F.min("dt").alias("mindate"), F.max("dt").alias("maxdate"), F.sum("value").alias("total"), F.max("daterank").alias("maxmonth"),
        F.coalesce(F.sum(F.when(F.col("dt") <= start, F.col("value"))), F.lit(0.0)).alias("startcumulative"), F.max(F.when(F.col("dt") == start, F.col("daterank"))).alias("rank_there"),
    )
    after = start > F.col("maxdate")
    month = F.when(after, F.col("maxmonth") + month_diff(F.col("maxdate"), start)).otherwise(F.col("rank_there"))
    return sums.select(*keys, "own.*", "mindate", "maxdate", "total", "maxmonth", "startcumulative", month.alias("startmonth"))


def segments(rows: DataFrame, keys: list[str], *, duration: int = HORIZON, prior_cum: Column | float = 0.0, prior_t: Column | int = 0, compat: bool = True) -> DataFrame:
    """keys, month, q, de, cumulative, volume: forecasts of one to three segments from q1, q2, q3, dei, def, b_factor,
    qabn, t1, t2.

    The first segments are exponential between two rates, the last follows the curve. A last-segment month below qabn
    is left out. Every month's volume is the difference of two closed forms, so no window and no shuffle is needed.
    With compat, later segments number their months from t1 (and t2) alone, without prior_t. Without a last rate all is
    zero for all months."""
    n1, n2 = F.coalesce("t1", F.lit(0)), F.coalesce("t2", F.lit(0))
    start, left = number(prior_cum), F.lit(duration) - prior_t
    three, two = (n1 > 0) & (n2 > 0), (n1 > 0) & (n2 <= 0)
    q1, q3 = number(F.col("q1")), number(F.col("q3"))
    q2 = F.when(three, F.when(F.col("q2") == F.col("q3"), F.col("q2") * 1.0001).otherwise(F.col("q2"))).otherwise(q3).cast("double")
    d1, d2 = decline_for(q1, q2, n1), decline_for(q2, q3, n2)
    drained = lambda qa, qb, d: (qa - qb) / F.nullif(-F.ln(1 - d), F.lit(0.0)) * YEAR
    end1 = start + drained(q1, q2, d1)
    end2 = end1 + drained(q2, q3, d2)
    shift = F.lit(0) if compat else F.lit(0) + prior_t

    def part(order, on, q, de, deff, b, months, offset, cum):
        return F.when(on, F.struct(F.lit(order).alias("part"), q.alias("qi"), de.alias("d"), deff.alias("f"), b.alias("b"), months.cast("int").alias("months"), offset.cast("int").alias("offset"), cum.alias("cum")))

    one = F.lit(1.0)
    dei, deff, b = (number(F.col(c)) for c in ("dei", "def", "b_factor"))
    nothing = ~three & ~two & (F.coalesce(q3, F.lit(0.0)) == 0)
    last = left - F.when(three, n1 + n2).when(two, n1).otherwise(0)
    parts = F.array(
        part(1, three | two, q1, d1, d1, one, n1, F.lit(0) + prior_t, start), part(2, three, q2, d2, d2, one, n2, n1 + shift, end1),
        part(3, ~nothing, q3, dei, deff, b, last, F.when(three, n1 + n2 + shift).when(two, n1 + shift).otherwise(F.lit(0) + prior_t), F.when(three, end2).when(two, end1).otherwise(start)),
        part(0, nothing, F.lit(0.0), F.lit(0.0), F.lit(0.0), one, left, F.lit(0), F.lit(0.0)),
    )
    cut = F.coalesce("qabn", F.lit(0.0)).alias("qabn")
    flat = rows.select(*keys, cut, F.explode(F.filter(parts, lambda s: s.isNotNull())).alias("s")).select(*keys, "qabn", "s.*").where("months > 0")
    flat, curve = Curve(F.col("qi"), F.col("d"), F.col("f"), F.col("b")).staged(flat)
    flat = flat.withColumn("t", F.explode(F.sequence(F.lit(1), F.col("months"))))
    idle, zero = F.col("part") == 0, F.lit(0.0)
    flat = flat.select("*", curve.cumulative(F.col("t")).alias("now"), curve.cumulative(F.col("t") - 1).alias("before"), curve.rate(F.col("t")).alias("q"), curve.decline(F.col("t")).alias("de"))
    shown = lambda x, n: F.when(idle, zero).otherwise(x).alias(n)
    gain = F.col("now") - F.when(F.col("t") == 1, zero).otherwise(F.col("before"))
    out = flat.select(
        *keys, "part", "qabn", (F.col("t") + F.col("offset")).alias("month"), shown(F.col("q"), "q"), shown(F.col("de"), "de"),
        shown(F.col("cum") + F.col("now"), "cumulative"), shown(F.greatest(zero, gain), "volume"),
    )
    return out.where((F.col("part") != 3) | (F.col("qabn") <= 0) | (F.col("q") >= F.col("qabn"))).drop("part", "qabn")


def volumes(view: DataFrame) -> DataFrame:
    """Monthly forecast volumes of the view's rows up to month 360, dated to month ends. A forecast that starts too late
    or below its last rate gives one row with its cumulative volume and nulls."""
    rows = view.select("wellid", "measure", "startdate", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("q1", "q2", "q3", "dei", "def", "qabn")), F.round("b_factor", 4).alias("b_factor"), "t1", "t2", F.coalesce("startmonth", F.lit(0)).alias("startmonth"), "startcumulative")
    over = (F.col("startmonth") >= HORIZON) | (F.col("q3") <= F.col("qabn"))
    keys = ["wellid", "measure", "startdate", "startmonth"]
    live = segments(rows.where(~over), keys, prior_cum=F.col("startcumulative"), prior_t=F.col("startmonth"))
    live = live.withColumn("dt", F.last_day(F.add_months("startdate", F.col("month") - F.col("startmonth"))))
    done = rows.where(over).select(*keys, F.col("startmonth").alias("month"), *(F.lit(None).cast("double").alias(c) for c in ("q", "de")), F.col("startcumulative").alias("cumulative"), F.lit(None).cast("double").alias("volume"), F.last_day("startdate").alias("dt"))
    return live.unionByName(done)


def eur(forecast: DataFrame, production: DataFrame) -> DataFrame:
    """Recovery: the curve from its rate and decline at the last month on, to month 360, and what has been produced."""
    past = production.groupBy("wellid", "measure").agg(F.max("dt").alias("last"), F.sum("value").alias("produced"))
    rows = best(forecast).join(past, ["wellid", "measure"])
    rows, curve = Curve.of(F.col("q3"), F.col("dei"), F.col("def"), F.col("b_factor")).staged(rows)
    rows = rows.withColumn("t", F.greatest(month_diff(F.col("startdate"), F.col("last")), F.lit(0)))
    rows = rows.select("wellid", "measure", "produced", "def", "b_factor", curve.rate(F.col("t")).alias("q"), curve.decline(F.col("t")).alias("d"))
    rows, curve = Curve.of(F.col("q"), F.col("d"), F.col("def"), F.col("b_factor")).staged(rows)
    rest = curve.cumulative(F.lit(HORIZON))
    return rows.select("wellid", "measure", "produced", (F.col("produced") + rest).alias("eur"))


def scaled(value: Column, *, length: Column, fluid: Column, left: Column, right: Column, target_length: float, target_fluid: float, target_distance: float, most: float, f: float = 1.0, e: float = 0.5, x: float = 0.5, switches: tuple[bool, bool, bool] = (True, True, True)) -> Column:
    """A value carried over to another lateral length, fluid intensity and spacing on both sides."""
    factor = lambda target, own, power: F.pow(F.lit(target) / F.nullif(F.coalesce(own, F.lit(target)), F.lit(0.0)), F.lit(power))
    out = value
    if switches[0]:
        out = out * factor(target_length, length, f)
    if switches[1]:
        out = out * factor(target_fluid, fluid, e)
    if switches[2]:
        for side in (left, right):
            out = out * F.pow(F.lit(target_distance) / F.least(side, F.lit(most)), F.lit(x / 2))
    return out


def smoothed(rows: DataFrame, column: str, keys: list[str], order: str, passes: int) -> DataFrame:
    """A mean of up to three points up to each one, taken `passes` times."""
    by = Window.partitionBy(*keys).orderBy(order).rowsBetween(-2, 0)
    for _ in range(passes):
        rows = rows.withColumn(column, F.avg(column).over(by))
    return rows


def b_diagnostics(rows: DataFrame, keys: list[str], *, rate: str = "q", time: str = "t", passes: int = 2, least: int = 24, most: int = 60) -> DataFrame:
    """keys, months, slope, low, high, r2, points: for each group the straight line of (1 - D) / D over time with the best
    fit, and the ends of the slope's 90% interval (null for a line through two points).

    Rates of zero go; a group starts at the last place of its largest rate and needs `least` points. D is the log of the
    last rate over this one per time; only values between 0.001 t and 3 t count. Every limit of time (a whole number)
    from `least` to `most` is tried, and the first with the largest r2 stays. Running sums up to a point give the line of every limit
    from its place to the next point's, so one pass over the group serves them all."""
    group = Window.partitionBy(*keys)
    rows = rows.where(F.col(rate) > 0).withColumn("top", F.max(rate).over(group))
    rows = rows.withColumn("from", F.max(F.when(F.col(rate) == F.col("top"), F.col(time))).over(group)).where(F.col(time) >= F.col("from"))
    rows = smoothed(rows, rate, keys, time, passes)
    order = group.orderBy(time)
    rows = rows.withColumn("n", F.count("*").over(group)).where(F.col("n") >= least)
    step = F.nullif(F.col(time) - F.lag(time).over(order), F.lit(0))
    rows = rows.withColumn("d", F.ln(F.lag(rate).over(order) / F.col(rate)) / step)
    rows = rows.withColumn("y", (1 - F.col("d")) / F.nullif(F.col("d"), F.lit(0.0))).where(f"y > 0.001 * {time} and y < 3 * {time}")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    x, y = F.col(time) - F.col("from"), F.col("y")
    sums = {"points": F.lit(1), "sx": x, "sy": y, "sxx": x * x, "sxy": x * y, "syy": y * y}
    limit = F.col(time).cast("int")
    rows = rows.select(*keys, limit.alias("at"), *(F.sum(v).over(so_far).alias(n) for n, v in sums.items()), F.coalesce(F.lead(limit).over(order) - 1, F.lit(most)).alias("upto"))
    rows = rows.withColumn("months", F.greatest("at", F.lit(least))).where((F.col("months") <= F.col("upto")) & (F.col("months") <= most))
    spread = lambda a, b, ab: F.col(ab) * F.col("points") - F.col(a) * F.col(b)
    rows = rows.select(*keys, "months", "points", spread("sx", "sx", "sxx").alias("xx"), spread("sx", "sy", "sxy").alias("xy"), spread("sy", "sy", "syy").alias("yy"))
    flat = F.when(F.col("yy") <= 1e-12 * F.col("points"), 1.0)
    slope, degrees = F.col("xy") / F.col("xx"), F.col("points") - 2
    quantile = F.element_at(F.array(*(F.lit(t_quantile(k)) for k in range(1, most + 1))), degrees.cast("int"))
    wide = F.when(degrees > 0, quantile * F.sqrt(F.greatest(F.col("yy") - F.col("xy") * slope, F.lit(0.0)) / degrees / F.col("xx")))
    lines = rows.where("xx > 0").select(*keys, "months", slope.alias("slope"), (slope - wide).alias("low"), (slope + wide).alias("high"), F.coalesce(flat, F.col("xy") * F.col("xy") / (F.col("xx") * F.col("yy"))).alias("r2"), "points")
    by = Window.partitionBy(*keys).orderBy(F.desc(F.round("r2", 10)), "months")
    return lines.withColumn("place", F.row_number().over(by)).where("place = 1").drop("place")


def b_bounds(low: Column, average: Column, high: Column, least: float = 0.5, most: float = 1.4) -> list[Column]:
    """Lower limit, start and upper limit of a b factor: the lower is `least` or more, the upper a tenth above it but
    `most` or less, the start between them, or else half way. Null limits are `least` and `most`. A lower limit above
    `most` leaves no room for b; fits then take the start as it is."""
    lo = F.greatest(F.coalesce(low, F.lit(least)), F.lit(least))
    hi = F.least(F.greatest(F.coalesce(high, F.lit(most)), lo * 1.1), F.lit(most))
    start = F.when((average >= lo) & (average <= hi), average).otherwise((lo + hi) / 2)
    return [F.round(c, 4).alias(n) for c, n in ((lo, "low"), (start, "start"), (hi, "high"))]


def thinned(rows: DataFrame, keys: list[str], order: str, head: int = 36) -> DataFrame:
    """The first points, then every second one, and always the last."""
    by = Window.partitionBy(*keys)
    numbered = rows.withColumn("k", F.row_number().over(by.orderBy(order))).withColumn("n", F.count("*").over(by))
    return numbered.where((F.col("k") <= head) | ((F.col("k") - head) % 2 == 1) | (F.col("k") == F.col("n"))).drop("k", "n")


def goodness(rows: DataFrame, keys: list[str], q: str, fitted: str) -> DataFrame:
    """r2 (0 for fewer than two points or a constant series), rmse and mae."""
    error = F.col(q) - F.col(fitted)
    flat = (F.count(q) < 2) | (F.max(q) == F.min(q)) | (F.max(fitted) == F.min(fitted))
    spread = F.nullif(F.var_pop(q) * F.var_pop(fitted), F.lit(0.0))
    r2 = F.pow(F.covar_pop(q, fitted), F.lit(2.0)) / spread
    return rows.groupBy(*keys).agg(F.when(flat, 0.0).otherwise(r2).alias("r2"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))
