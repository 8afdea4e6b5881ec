"""posterior.py for many series at once: the same densities, draws and steps, one array operation for a batch."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from . import posterior as P


@dataclass(frozen=True)
class Models:
    """posterior.Model for series as rows: months, log rates and weights (0 in the padding) are (series, months), bounds and
    centres (series, numbers), and what is not free is one number a series."""

    t: np.ndarray
    logs: np.ndarray
    weight: np.ndarray
    names: tuple[str, ...]
    low: np.ndarray
    high: np.ndarray
    centre: np.ndarray
    fixed: dict[str, np.ndarray]
    learned: bool = True

    def numbers(self, x: np.ndarray) -> np.ndarray:
        """Numbers at coordinates x (series, places, coordinates)."""
        return self.low[:, None] + (self.high - self.low)[:, None] / (1 + np.exp(-x[..., : len(self.names)]))

    def coordinates(self, numbers: np.ndarray, scale: np.ndarray) -> np.ndarray:
        u = np.clip((numbers - self.low) / np.maximum(self.high - self.low, 1e-12), 0.02, 0.98)
        return np.concatenate([np.log(u / (1 - u)), np.log(scale)[:, None], *[np.full((len(u), 1), math.log(3.0))] * self.learned], 1)

    def density(self, at: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log density (up to a constant) and gradient of the series `at` at each place of x (series, places, coordinates)."""
        k, width, low = len(self.names), np.maximum(self.high - self.low, 1e-12)[at][:, None], self.low[at][:, None]
        weight, t, logs = self.weight[at][:, None], self.t[at][:, None], self.logs[at][:, None]
        n, shape = weight.sum(2), x.shape[:2]
        u = 1 / (1 + np.exp(-x[..., :k]))
        given = {name: np.broadcast_to(v[at][:, None], shape) for name, v in self.fixed.items()}
        given |= {name: low[..., j] + width[..., j] * u[..., j] for j, name in enumerate(self.names)}
        qi, dei, b, last = given["qi"], given["dei"], np.maximum(given["b"], 1e-8), -np.log1p(-given["deff"]) / 365
        power = (1 - dei) ** -b
        first = (power - 1) / b / 365
        days = t * (365 / 12)
        early = np.minimum(days, np.maximum((1 / last - 1 / first) / b, 0.0)[..., None])
        growth = (b * first)[..., None] * early
        growth += 1
        grown = np.log(growth)
        scale = np.exp(x[..., k])
        raw = np.exp(x[..., k + 1]) if self.learned else np.full(shape, P.FIXED_DEGREES - 2)
        degrees = 2 + raw
        z = days - early
        z *= -last[..., None]
        z -= grown / b[..., None]
        z += np.log(qi)[..., None] - logs
        z *= weight
        z /= scale[..., None]
        tail = z * z
        tail /= degrees[..., None]
        spread = np.log1p(tail).sum(2)
        outer = tail + 1
        pull = z
        pull /= outer
        tail /= outer
        early /= growth
        share = tail.sum(2)
        factor = (degrees + 1) / degrees
        by_value, by_early, by_grown = pull.sum(2) * factor, np.einsum("acm,acm->ac", pull, early) * factor, np.einsum("acm,acm->ac", pull, grown) * factor
        log_gammas = P._log_gamma(np.stack([(degrees + 1) / 2, degrees / 2]).ravel()).reshape(2, *shape) if self.learned else np.zeros((2, *shape))
        if not self.learned:
            log_gammas += np.array([math.lgamma((P.FIXED_DEGREES + 1) / 2), math.lgamma(P.FIXED_DEGREES / 2)])[:, None, None]
        out = n * (log_gammas[0] - log_gammas[1] - 0.5 * np.log(degrees) - x[..., k]) - (degrees + 1) / 2 * spread
        out = out - 2 * scale**2 + x[..., k]
        gradient = np.zeros(x.shape)
        gradient[..., k] = (degrees + 1) * share - n - 4 * scale**2 + 1
        if self.learned:
            above, below = P._digamma(np.stack([(degrees + 1) / 2, degrees / 2]).ravel()).reshape(2, *shape)
            by_degrees = n / 2 * (above - below - 1 / degrees) - 0.5 * spread + (degrees + 1) / 2 / degrees * share
            out = out - raw / 5 + x[..., k + 1]
            gradient[..., k + 1] = (by_degrees - 0.2) * raw + 1
        first_by_b = (-np.log1p(-dei) * power * b - (power - 1)) / b**2 / 365
        slopes = {"qi": by_value / qi, "dei": -by_early * power / (1 - dei) / 365, "b": by_grown / b**2 - by_early * (first / b + first_by_b)}
        for j, name in enumerate(self.names):
            v, place = u[..., j], (self.centre[at][:, j] - self.low[at][:, j])[:, None] / width[..., j]
            if name == "b":
                top = np.clip(place, 1e-6, 1 - 1e-6)
                out = out + np.where(v < top, np.log(v / top), np.log((1 - v) / (1 - top)))
                prior = np.where(v < top, 1 / v, -1 / (1 - v))
            else:
                top = np.clip(place, 1e-3, 1 - 1e-3)
                a, c = (2.0, 2.0) if name == "dei" else (6 * top, 6 * (1 - top))
                out = out + (a - 1) * np.log(v) + (c - 1) * np.log(1 - v)
                prior = (a - 1) / v - (c - 1) / (1 - v)
            out = out + np.log(v) + np.log(1 - v)
            gradient[..., j] = (-slopes[name] / scale * width[..., j] + prior) * v * (1 - v) + 1 - 2 * v
        return out, gradient

    def peak(self, x: np.ndarray, rounds: int = 12, step: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
        """posterior.Model.peak for each row of x."""
        x, live, reaches = x.copy(), np.arange(len(x)), 0.5 ** np.arange(8)[:, None]
        with np.errstate(all="ignore"):
            for _ in range(rounds):
                if not len(live):
                    break
                at = x[live]
                values, vectors = self._curvature(live, at, step)
                slope = self.density(live, at[:, None])[1][:, 0]
                move = np.einsum("aij,aj->ai", vectors, np.einsum("aji,aj->ai", vectors, slope) / values)
                tried = at[:, None] + np.concatenate([reaches * np.clip(move, -3, 3)[:, None], np.zeros((len(at), 1, x.shape[1]))], 1)
                worth = np.nan_to_num(self.density(live, tried)[0], nan=-np.inf)
                best, rows = worth.argmax(1), np.arange(len(at))
                going = ~(worth[rows, best] - worth[:, -1] < 1e-6)
                x[live[going]] = tried[rows, best][going]
                live = live[going]
            values, vectors = self._curvature(np.arange(len(x)), x, step)
        return x, (vectors / values[:, None]) @ vectors.transpose(0, 2, 1)

    def _curvature(self, at: np.ndarray, x: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
        size = x.shape[1]
        moved = self.density(at, x[:, None] + step * np.concatenate([np.eye(size), -np.eye(size)]))[1]
        matrix = (moved[:, size:] - moved[:, :size]) / (2 * step)
        values, vectors = np.linalg.eigh(np.nan_to_num((matrix + matrix.transpose(0, 2, 1)) / 2))
        return np.maximum(values, 0.1), vectors


def hamiltonian(density: Callable, start: np.ndarray, covariance: np.ndarray, draws: int, tune: int, seeds: list[int], chains: int = 4, target: float = 0.9) -> np.ndarray:
    """posterior.hamiltonian for each row of start: draws (series, chains, draws, numbers). Paths of a round differ in length;
    those that have ended wait."""
    n, k = start.shape
    shape, everyone, rounds = np.linalg.cholesky(covariance), np.arange(n), tune + draws
    z, momenta, lengths, luck = np.empty((n, chains, k)), np.empty((rounds, n, chains, k)), np.empty((rounds, n)), np.empty((rounds, n, chains))
    for i, seed in enumerate(seeds):
        rng = np.random.default_rng(seed)
        z[i] = rng.normal(size=(chains, k))
        for r in range(rounds):
            momenta[r, i] = rng.normal(size=(chains, k))
            lengths[r, i], luck[r, i] = rng.uniform(0.6, 1.6), rng.random(chains)

    def at(live: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value, gradient = density(live, start[live][:, None] + z @ shape[live].transpose(0, 2, 1))
        bad = ~(np.isfinite(value) & np.isfinite(gradient).all(axis=2))
        return np.where(bad, -np.inf, value), np.where(bad[..., None], 0.0, gradient @ shape[live])

    out = np.empty((n, chains, draws, k))
    with np.errstate(all="ignore"):
        value, slope = at(everyone, z)
        z[~np.isfinite(value)] = 0.0
        value, slope = at(everyone, z)
        step, error, smooth = np.full(n, 0.5), np.zeros(n), np.full(n, math.log(0.5))
        for r in range(rounds):
            size = step if r < tune else np.exp(smooth)
            paths = np.clip(np.rint(lengths[r] * 1.5 / size), 1, 8).astype(int)
            size, momentum = size[:, None, None], momenta[r]
            to, push, pull, worth = z.copy(), momentum + size / 2 * slope, slope.copy(), value.copy()
            for leap in range(paths.max()):
                live = np.flatnonzero(paths > leap)
                to[live] += size[live] * push[live]
                worth[live], pull[live] = at(live, to[live])
                last = (leap == paths[live] - 1)[:, None, None]
                push[live] += np.where(last, size[live] / 2, size[live]) * pull[live]
            gain = np.nan_to_num(worth - value + 0.5 * (momentum**2 - push**2).sum(2), nan=-np.inf)
            chance = np.exp(np.minimum(gain, 0.0))
            won = luck[r] < chance
            z, value, slope = np.where(won[..., None], to, z), np.where(won, worth, value), np.where(won[..., None], pull, slope)
            if r < tune:
                error += (target - chance.mean(1) - error) / (r + 11)
                step = np.exp(np.clip(math.log(2.5) - math.sqrt(r + 1) / 0.05 * error, -7, 1))
                share = (r + 1) ** -0.75
                smooth = share * np.log(step) + (1 - share) * smooth
            else:
                out[:, :, r - tune] = start[:, None] + z @ shape.transpose(0, 2, 1)
    return out


def mean_field(density: Callable, start: np.ndarray, spread: np.ndarray, rounds: int, draws: int, seeds: list[int], rate: float = 0.05, tolerance: float = 5e-4) -> np.ndarray:
    """Draws (series, draws, numbers) of posterior.mean_field for each row of start."""
    rngs, (count, n) = [np.random.default_rng(s) for s in seeds], start.shape
    at, live = np.concatenate([start, np.log(spread)], 1), np.arange(count)
    mean, square, past = np.zeros(at.shape), np.zeros(at.shape), at.copy()
    with np.errstate(all="ignore"):
        for k in range(1, rounds + 1):
            if not len(live):
                break
            noise = np.stack([rngs[i].normal(size=(8, n)) for i in live.tolist()])
            noise = np.concatenate([noise, -noise], 1)
            wide = np.exp(at[live, n:])[:, None]
            slope = np.nan_to_num(density(live, at[live, :n][:, None] + noise * wide)[1])
            gradient = np.concatenate([slope.mean(1), (slope * noise * wide).mean(1) + 1], 1)
            mean[live], square[live] = 0.9 * mean[live] + 0.1 * gradient, 0.99 * square[live] + 0.01 * gradient**2
            at[live] += rate / math.sqrt(1 + k / 30) * (mean[live] / (1 - 0.9**k)) / (np.sqrt(square[live] / (1 - 0.99**k)) + 1e-8)
            if not k % 50:
                settled = np.abs(at[live] - past[live]).max(1) <= tolerance * np.maximum(1.0, np.abs(past[live]).max(1))
                past[live] = at[live]
                live = live[~settled]
    return np.stack([a[:n] + g.normal(size=(draws, n)) * np.exp(a[n:]) for a, g in zip(at, rngs)])
