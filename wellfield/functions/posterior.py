"""Posterior of a decline curve: analytic gradients, Hamiltonian draws of several chains at once, a mean-field
approximation, and how far to trust the draws. All of it is array work on one well's few hundred points."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: The tails' degrees of freedom where they are not learned.
FIXED_DEGREES = 4.0


def log_rate(t: np.ndarray, qi: np.ndarray, dei: np.ndarray, b: np.ndarray, deff: float) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Log rates at months t for several curves (rows), and their derivatives by qi, dei and b.

    At the switch to the terminal decline both stretches fall alike, so moving the switch itself changes nothing."""
    qi, dei, b = (np.asarray(v, float)[:, None] for v in (qi, dei, b))
    days, last, b = np.asarray(t, float) * (365 / 12), -np.log1p(-deff) / 365, np.maximum(b, 1e-8)
    power = (1 - dei) ** -b
    first = (power - 1) / b / 365
    switch = np.maximum((1 / last - 1 / first) / b, 0.0)
    early = np.minimum(days, switch)
    growth = 1 + b * first * early
    value = np.log(qi) - np.log(growth) / b - last * np.maximum(days - switch, 0.0)
    by_first = -early / growth
    by_b = np.log(growth) / b**2 - first * early / (b * growth)
    first_by_b = (-np.log1p(-dei) * power * b - (power - 1)) / b**2 / 365
    return value, {"qi": np.broadcast_to(1 / qi, value.shape), "dei": by_first * power / (1 - dei) / 365, "b": by_b + by_first * first_by_b}


def _digamma(x: np.ndarray) -> np.ndarray:
    """Raised by 6 by its recurrence, then the asymptotic series."""
    out, x = -(1 / (x[:, None] + np.arange(6))).sum(1), x + 6
    inverse = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - inverse * (1 / 12 - inverse * (1 / 120 - inverse / 252))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(v) if v < 1e300 else math.inf for v in x.tolist()])


@dataclass(frozen=True)
class Model:
    """Log rates with Student-t errors around the curve.

    Free numbers lie between their bounds: qi by a beta prior of weight 6 around `centre`, dei by Beta(2, 2), b by a
    triangle with its top at `centre`. The scale is half-normal (0.5); the degrees of freedom are FIXED_DEGREES or, if
    `learned`, 2 plus an exponential with mean 5. Coordinates are unbounded: logits of the numbers' places between their
    bounds, then the logs of scale and of degrees less 2."""

    t: np.ndarray
    logs: np.ndarray
    names: tuple[str, ...]
    low: np.ndarray
    high: np.ndarray
    centre: np.ndarray
    fixed: dict
    learned: bool = True

    @property
    def size(self) -> int:
        return len(self.names) + 1 + self.learned

    def numbers(self, x: np.ndarray) -> np.ndarray:
        return self.low + (self.high - self.low) / (1 + np.exp(-x[..., : len(self.names)]))

    def coordinates(self, numbers: np.ndarray, scale: float) -> np.ndarray:
        u = np.clip((numbers - self.low) / np.maximum(self.high - self.low, 1e-12), 0.02, 0.98)
        return np.concatenate([np.log(u / (1 - u)), [math.log(scale)], [math.log(3.0)] * self.learned])

    def density(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log density (up to a constant) and gradient at each row of x."""
        k, n, width = len(self.names), len(self.logs), np.maximum(self.high - self.low, 1e-12)
        u = 1 / (1 + np.exp(-x[:, :k]))
        given = {name: np.full(len(x), float(v)) for name, v in self.fixed.items()}
        given |= {name: self.low[j] + width[j] * u[:, j] for j, name in enumerate(self.names)}
        value, slopes = log_rate(self.t, given["qi"], given["dei"], given["b"], self.fixed["deff"])
        log_scale = x[:, k]
        scale = np.exp(log_scale)
        raw = np.exp(x[:, k + 1]) if self.learned else np.full(len(x), FIXED_DEGREES - 2)
        degrees = 2 + raw
        z = (value - self.logs) / scale[:, None]
        tail = z * z / degrees[:, None]
        pull = (degrees[:, None] + 1) * z / degrees[:, None] / (1 + tail)
        out = n * (_log_gamma((degrees + 1) / 2) - _log_gamma(degrees / 2) - 0.5 * np.log(degrees) - log_scale) - (degrees + 1) / 2 * np.log1p(tail).sum(1)
        out = out - 2 * scale**2 + log_scale
        gradient = np.zeros_like(x)
        gradient[:, k] = (pull * z).sum(1) - n - 4 * scale**2 + 1
        if self.learned:
            by_degrees = n / 2 * (_digamma((degrees + 1) / 2) - _digamma(degrees / 2) - 1 / degrees) - 0.5 * np.log1p(tail).sum(1) + ((degrees[:, None] + 1) / 2 * tail / degrees[:, None] / (1 + tail)).sum(1)
            out = out - raw / 5 + x[:, k + 1]
            gradient[:, k + 1] = (by_degrees - 0.2) * raw + 1
        for j, name in enumerate(self.names):
            v, place = u[:, j], (self.centre[j] - self.low[j]) / width[j]
            if name == "b":
                top = float(np.clip(place, 1e-6, 1 - 1e-6))
                out = out + np.where(v < top, np.log(v / top), np.log((1 - v) / (1 - top)))
                prior = np.where(v < top, 1 / v, -1 / (1 - v))
            else:
                top = float(np.clip(place, 1e-3, 1 - 1e-3))
                a, c = (2.0, 2.0) if name == "dei" else (6 * top, 6 * (1 - top))
                out = out + (a - 1) * np.log(v) + (c - 1) * np.log(1 - v)
                prior = (a - 1) / v - (c - 1) / (1 - v)
            out = out + np.log(v) + np.log(1 - v)
            by_number = -(pull * slopes[name]).sum(1) / scale
            gradient[:, j] = (by_number * width[j] + prior) * v * (1 - v) + 1 - 2 * v
        return out, gradient

    def peak(self, x: np.ndarray, rounds: int = 12, step: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
        """A place of high density from x on by damped Newton steps, and the covariance that its curvature gives."""
        reaches = 0.5 ** np.arange(8)[:, None]
        with np.errstate(all="ignore"):
            for _ in range(rounds):
                values, vectors = self._curvature(x, step)
                move = vectors @ ((vectors.T @ self.density(x[None])[1][0]) / values)
                tried = x + np.vstack([reaches * np.clip(move, -3, 3), np.zeros(len(x))])
                worth = np.nan_to_num(self.density(tried)[0], nan=-np.inf)
                best = int(np.argmax(worth))
                if worth[best] - worth[-1] < 1e-6:
                    break
                x = tried[best]
            values, vectors = self._curvature(x, step)
        return x, (vectors / values) @ vectors.T

    def _curvature(self, x: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
        """Eigenvalues (at least 0.1) and vectors of the curvature, by differences of gradients."""
        moved = self.density(np.concatenate([x + step * np.eye(len(x)), x - step * np.eye(len(x))]))[1]
        matrix = (moved[len(x) :] - moved[: len(x)]) / (2 * step)
        values, vectors = np.linalg.eigh(np.nan_to_num((matrix + matrix.T) / 2))
        return np.maximum(values, 0.1), vectors


def hamiltonian(density, start: np.ndarray, covariance: np.ndarray, draws: int, tune: int, seed: int, chains: int = 4, target: float = 0.9) -> np.ndarray:
    """Draws (chains, draws, numbers): leapfrog paths in coordinates in which `covariance` is round, with a step that dual
    averaging brings to the wanted acceptance while tuning. All chains move together, one array operation a step."""
    rng, shape = np.random.default_rng(seed), np.linalg.cholesky(covariance)

    def at(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value, gradient = density(start + z @ shape.T)
        bad = ~(np.isfinite(value) & np.isfinite(gradient).all(axis=1))
        return np.where(bad, -np.inf, value), np.where(bad[:, None], 0.0, gradient @ shape)

    out, z = np.empty((chains, draws, len(start))), rng.normal(size=(chains, len(start)))
    with np.errstate(all="ignore"):
        value, slope = at(z)
        z[~np.isfinite(value)] = 0.0
        value, slope = at(z)
        step, anchor, error, smooth = 0.5, math.log(2.5), 0.0, math.log(0.5)
        for k in range(tune + draws):
            momentum = rng.normal(size=z.shape)
            size = step if k < tune else math.exp(smooth)
            paths = int(np.clip(round(rng.uniform(0.6, 1.6) * 1.5 / size), 1, 8))
            to, push, pull = z, momentum + size / 2 * slope, slope
            for leap in range(paths):
                to = to + size * push
                worth, pull = at(to)
                push = push + (size if leap < paths - 1 else size / 2) * pull
            gain = np.nan_to_num(worth - value + 0.5 * (momentum**2 - push**2).sum(1), nan=-np.inf)
            chance = np.exp(np.minimum(gain, 0.0))
            won = rng.random(chains) < chance
            z, value, slope = np.where(won[:, None], to, z), np.where(won, worth, value), np.where(won[:, None], pull, slope)
            if k < tune:
                error += (target - chance.mean() - error) / (k + 11)
                log_step = anchor - math.sqrt(k + 1) / 0.05 * error
                step = math.exp(float(np.clip(log_step, -7, 1)))
                share = (k + 1) ** -0.75
                smooth = share * math.log(step) + (1 - share) * smooth
            else:
                out[:, k - tune] = start + z @ shape.T
    return out


def mean_field(density, start: np.ndarray, spread: np.ndarray, rounds: int, draws: int, seed: int, rate: float = 0.05, tolerance: float = 5e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means and deviations of the independent normal closest to the density, and draws from it.

    Gradients are taken through mirrored standard draws; steps have the size that their own past gradients give, and
    shrink as rounds go by. It ends when means and deviations settle, or after `rounds`."""
    rng, n = np.random.default_rng(seed), len(start)
    at = np.concatenate([start, np.log(spread)])
    mean, square, past = np.zeros(2 * n), np.zeros(2 * n), at.copy()
    with np.errstate(all="ignore"):
        for k in range(1, rounds + 1):
            noise = rng.normal(size=(8, n))
            noise = np.concatenate([noise, -noise])
            wide = np.exp(at[n:])
            slope = np.nan_to_num(density(at[:n] + noise * wide)[1])
            gradient = np.concatenate([slope.mean(0), (slope * noise * wide).mean(0) + 1])
            mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
            at = at + rate / math.sqrt(1 + k / 30) * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
            if not k % 50:
                if np.abs(at - past).max() <= tolerance * max(1.0, np.abs(past).max()):
                    break
                past = at.copy()
    return at[:n], np.exp(at[n:]), at[:n] + rng.normal(size=(draws, n)) * np.exp(at[n:])


def split_rhat(draws: np.ndarray) -> float:
    """How much wider all draws (chains, n) lie than each half chain: 1 where they agree."""
    half = draws.shape[1] // 2
    if half < 2:
        return float("nan")
    parts = np.concatenate([draws[:, :half], draws[:, -half:]])
    within, between = parts.var(axis=1, ddof=1).mean(), half * parts.mean(axis=1).var(ddof=1)
    return float(np.sqrt(((half - 1) / half * within + between / half) / within)) if within > 0 else 1.0


def effective_size(draws: np.ndarray) -> float:
    """How many independent draws are worth these (chains, n): by autocorrelations, summed in pairs while they are
    positive and falling."""
    chains, n = draws.shape
    centred = draws - draws.mean(axis=1, keepdims=True)
    size = 1 << (2 * n - 1).bit_length()
    power = np.abs(np.fft.rfft(centred, size, axis=1)) ** 2
    lags = np.fft.irfft(power, size, axis=1)[:, :n] / n
    within = (lags[:, 0] * n / (n - 1)).mean()
    total = within * (n - 1) / n + (draws.mean(axis=1).var(ddof=1) if chains > 1 else 0.0)
    if not total > 0:
        return float(chains * n)
    rho = 1 - (within - lags.mean(axis=0) * n / (n - 1)) / total
    pairs = rho[: n // 2 * 2].reshape(-1, 2).sum(axis=1)
    falling = np.minimum.accumulate(pairs)
    count = int(np.argmax(falling <= 0)) if (falling <= 0).any() else len(falling)
    return float(chains * n / max(2 * falling[:count].sum() - 1, 1 / math.log10(chains * n + 10)))
