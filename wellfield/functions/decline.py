"""Decline curves as column expressions: annual effective declines, t in months, volumes over 365 days a year."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import ClassVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEAR = 365.0


def _over(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0.0))


def number(x: Column | float) -> Column:
    return x.cast("double") if isinstance(x, Column) else F.lit(float(x))


def decline_for(q_start: Column, q_end: Column, months: Column) -> Column:
    """Annual effective decline that leads from one rate to another in so many months; negative where the rate rises."""
    return 1 - F.exp(-_over(F.ln(_over(q_start, q_end)), months / 12))


def _stage(f):
    """A property that reads the column of its name where a frame has it."""

    def get(self):
        known = self._known(f.__name__)
        return f(self) if known is None else known

    return property(get, doc=f.__doc__)


@dataclass(frozen=True)
class Curve:
    """A curve from rate `qi`: exponential where both declines agree, else hyperbolic (harmonic for b = 1) until the
    decline has fallen to the terminal one, and exponential from there. `known` holds columns of a frame that staged()
    has computed, so that each is worked out once a row however often it is used."""

    qi: Column
    dei: Column
    deff: Column
    b: Column
    known: str = ""

    @classmethod
    def of(cls, qi, dei, deff, b) -> "Curve":
        return cls(*map(number, (qi, dei, deff, b)))

    STAGES: ClassVar = (("exponential", "harmonic"), ("nominal", "terminal"), ("q_switch",), ("t_switch",))

    def staged(self, df: DataFrame, prefix: str = "__") -> tuple[DataFrame, "Curve"]:
        """df with the curve's fixed terms as columns, and the curve that reads them."""
        inputs = {n: getattr(self, n).alias(f"{prefix}{n}") for n in ("qi", "dei", "deff", "b")}
        df, done = df.select("*", *inputs.values()), list(inputs)
        for names in self.STAGES:
            curve = replace(self, **{n: F.col(f"{prefix}{n}") for n in inputs}, known=f"{prefix}:{','.join(done)}")
            df = df.select("*", *(getattr(curve, n).alias(f"{prefix}{n}") for n in names))
            done += names
        return df, replace(self, **{n: F.col(f"{prefix}{n}") for n in inputs}, known=f"{prefix}:{','.join(done)}")

    def _known(self, name: str) -> Column | None:
        prefix, _, names = self.known.partition(":")
        return F.col(prefix + name) if name in names.split(",") else None

    @_stage
    def exponential(self) -> Column:
        return F.abs(self.dei - self.deff) <= 1e-8 + 1e-5 * F.abs(self.deff)

    @_stage
    def harmonic(self) -> Column:
        return (self.b == 1) & (self.dei > self.deff)

    @_stage
    def nominal(self) -> Column:
        """Nominal annual decline at the start."""
        return F.when(self.harmonic, _over(self.dei, 1 - self.dei)).otherwise(_over(F.pow(1 - self.dei, -self.b) - 1, self.b))

    @_stage
    def terminal(self) -> Column:
        return -F.ln(1 - self.deff)

    @_stage
    def q_switch(self) -> Column:
        return self.qi * F.pow(_over(self.terminal, self.nominal), _over(F.lit(1.0), self.b))

    @_stage
    def t_switch(self) -> Column:
        return _over(F.pow(_over(self.qi, self.q_switch), self.b) - 1, self.b * self.nominal) * 12

    def _growth(self, t: Column) -> Column:
        return 1 + self.b * self.nominal * t / 12

    def hyperbolic_decline(self, t: Column) -> Column:
        return 1 - F.pow(_over(F.lit(1.0), self.b * _over(self.nominal, self._growth(t)) + 1), _over(F.lit(1.0), self.b))

    def early(self, t: Column) -> Column:
        return self.hyperbolic_decline(t) > self.deff

    def decline(self, t) -> Column:
        t = number(t)
        return F.when(self.exponential, self.dei).when(self.early(t), self.hyperbolic_decline(t)).otherwise(self.deff)

    def rate(self, t) -> Column:
        t = number(t)
        tail = self.q_switch * F.exp(-self.terminal * (t - self.t_switch) / 12)
        hyperbolic = self.qi * F.pow(self._growth(t), -_over(F.lit(1.0), self.b))
        return F.when(self.exponential, self.qi * F.exp(F.ln(1 - self.dei) * t / 12)).when(self.early(t), hyperbolic).otherwise(tail)

    def _until(self, q: Column) -> Column:
        """Volume of the hyperbolic part down to rate q."""
        harmonic = _over(self.qi, self.nominal) * F.ln(_over(self.qi, q))
        general = _over(F.pow(self.qi, self.b), self.nominal * (1 - self.b)) * (F.pow(self.qi, 1 - self.b) - F.pow(q, 1 - self.b))
        return F.when(self.harmonic, harmonic).otherwise(general) * YEAR

    def cumulative(self, t) -> Column:
        q = self.rate(t)
        pure = _over(self.qi - q, -F.ln(1 - self.dei)) * YEAR
        tail = _over(self.q_switch - q, self.terminal) * YEAR + self._until(self.q_switch)
        return F.when(self.exponential, pure).when(self.early(number(t)), self._until(q)).otherwise(tail)

    def daily_rate(self, t) -> Column:
        """The rate alone, as fits use it: b at least 1e-8, and no switch before the start."""
        b = F.greatest(self.b, F.lit(1e-8))
        first, last = _over(F.pow(1 - self.dei, -b) - 1, b) / YEAR, self.terminal / YEAR
        day = number(t) * (YEAR / 12)
        switch = F.greatest(_over(_over(F.lit(1.0), last) - _over(F.lit(1.0), first), b), F.lit(0.0))
        at = lambda d: self.qi * F.pow(1 + b * first * d, -1 / b)
        piecewise = F.when(day <= switch, at(day)).otherwise(at(switch) * F.exp(-last * (day - switch)))
        return F.when(self.exponential, self.qi * F.exp(F.ln(1 - self.dei) / YEAR * day)).otherwise(piecewise)
