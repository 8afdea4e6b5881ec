"""The kernels' fits and breaks for many series at once: one array operation serves a batch, each series keeps its own draws.

Series are rows of padded arrays, `weight` being 0 in the padding. Functions that take `miss` call it as miss(at, x) with the
places of some series and points x (series, points, numbers); it gives residuals (series, points, months)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from . import kernels as K


def padded(parts: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(parts), width))
    for row, part in zip(out, parts):
        row[: len(part)] = part
    return out


def rates(t: np.ndarray, qi: np.ndarray, dei: np.ndarray, deff: np.ndarray, b: np.ndarray) -> np.ndarray:
    """kernels.rate at months t (series, months) for curves (series, curves)."""
    qi, dei, deff, b = (v[..., None] for v in np.broadcast_arrays(qi, dei, deff, b))
    days, b = t[:, None, :] * (365 / 12), np.maximum(b, 1e-8)
    flat = np.abs(dei - deff) <= 1e-8 + 1e-5 * np.abs(deff)
    with np.errstate(all="ignore"):
        first, last = ((1 - dei) ** -b - 1) / b / 365, -np.log1p(-deff) / 365
        early = np.minimum(days, np.maximum((1 / last - 1 / first) / b, 0.0))
        fall = np.log(1 + b * first * early) / b + last * (days - early)
        if flat.any():
            fall = np.where(flat, -np.log1p(-dei) / 365 * days, fall)
        return qi * np.exp(-fall)


def coarse_start(miss: Callable, start: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """kernels.coarse_start for each row."""
    n, k = start.shape
    axes = np.sort(np.stack([low, np.clip(start, low, high), high]), axis=0)
    grid = np.stack([axes[list(pick), :, range(k)].T for pick in np.ndindex(*[3] * k)], 1)
    worth = np.stack([(miss(np.arange(n), grid[:, j : j + 1]) ** 2).sum((1, 2)) for j in range(grid.shape[1])], 1)
    return grid[np.arange(n), np.argmin(worth, 1)]


def least_squares(miss: Callable, start: np.ndarray, low: np.ndarray, high: np.ndarray, rounds: int = 200) -> np.ndarray:
    """kernels.least_squares for each row; NaN where numbers overflow."""
    n, k = start.shape
    x, damp, live = np.clip(start, low, high), np.full(n, 1e-2), np.arange(n)
    r = miss(live, x[:, None])[:, 0]
    for _ in range(rounds):
        if not len(live):
            break
        at, lo, hi, rest, d = x[live], low[live], high[live], r[live], damp[live]
        step = 1e-6 * np.maximum(hi - lo, 1e-9)
        step = np.where(at + step > hi, -step, step)
        jacobian = (miss(live, at[:, None] + step[:, None] * np.eye(k)) - rest[:, None]) / step[:, :, None]
        gradient, square = (jacobian @ rest[:, :, None])[..., 0], jacobian @ jacobian.transpose(0, 2, 1)
        free = ~(((at <= lo) & (gradient > 0)) | ((at >= hi) & (gradient < 0)))
        going, odd = free.any(1), ~(np.isfinite(square).all((1, 2)) & np.isfinite(gradient).all(1))
        x[live[odd]] = np.nan
        inner = np.where((free[:, :, None] & free[:, None, :]) & ~odd[:, None, None], square, 0.0)
        diagonal = np.where(free, np.maximum(np.einsum("akk->ak", inner), 1e-12), 0.0)
        u, s, v = np.linalg.svd(inner + (d[:, None] * diagonal)[:, None] * np.eye(k))
        useful = s > np.finfo(float).eps * free.sum(1)[:, None] * s[:, :1]
        turned = np.einsum("aij,ai->aj", u, np.where(free & ~odd[:, None], gradient, 0.0))
        move = -np.einsum("aij,ai->aj", v, np.where(useful, turned / np.where(useful, s, 1.0), 0.0))
        new = np.clip(at + np.where(free, move, 0.0), lo, hi)
        other = miss(live, new[:, None])[:, 0]
        was, now = (rest * rest).sum(1), (other * other).sum(1)
        better = going & ~odd & (now < was)
        x[live[better]], r[live[better]] = new[better], other[better]
        damp[live] = np.where(better, np.maximum(d / 5, 1e-12), d * 5)
        done = np.where(better, was - now <= 1e-14 * was, damp[live] > 1e10)
        live = live[going & ~odd & ~done]
    return x


def evolve(miss: Callable, low: np.ndarray, high: np.ndarray, rounds: int, seeds: list[int], size: int = 24, tolerance: float = 1e-4) -> np.ndarray:
    """kernels.evolve for each row, with the same draws."""
    n, k = low.shape
    draw, live = [np.random.default_rng(s) for s in seeds], np.arange(n)
    pool = low[:, None] + np.stack([g.random((size, k)) for g in draw]) * (high - low)[:, None]
    worth = (miss(live, pool) ** 2).sum(2)
    for _ in range(rounds):
        if not len(live):
            break
        picks, reach, cross = np.empty((len(live), size, 2), int), np.empty((len(live), 1, 1)), np.empty((len(live), size, k))
        for j, i in enumerate(live.tolist()):
            g = draw[i]
            picks[j] = [g.permutation(size)[:2] for _ in range(size)]
            reach[j], cross[j] = g.uniform(0.5, 1.0), g.random((size, k))
        at, value = pool[live], worth[live]
        rows = np.arange(len(live))[:, None]
        trial = at[rows, value.argmin(1)[:, None]] + reach * (at[rows, picks[..., 0]] - at[rows, picks[..., 1]])
        trial = np.where(cross < 0.7, np.clip(trial, low[live][:, None], high[live][:, None]), at)
        tried = (miss(live, trial) ** 2).sum(2)
        better = tried < value
        pool[live], worth[live] = np.where(better[..., None], trial, at), np.where(better, tried, value)
        live = live[~(worth[live].std(1) <= tolerance * np.abs(worth[live].mean(1)))]
    return pool[np.arange(n), worth.argmin(1)]


def breaks(signals: list[np.ndarray], penalty: float, least: int = 6, jump: int = 5, most: int = 400) -> list[list[int]]:
    """kernels.breaks for each series. Series of one length share the kernel's sums over blocks between places; those longer
    than `most` go one by one, as there memory grows with the square of the length."""
    out: list[list[int]] = [[] for _ in signals]
    by_length: dict[int, list[int]] = {}
    for i, s in enumerate(signals):
        by_length.setdefault(len(s), []).append(i)
    for n, members in by_length.items():
        if -(-least // jump) * jump + least > n:
            continue
        if n > most:
            for i in members:
                out[i] = K.breaks(signals[i], penalty, least, jump)
            continue
        room = max(200_000 // (n * n), 1)
        for first in range(0, len(members), room):
            part = members[first : first + room]
            for i, ends in zip(part, _breaks(np.stack([signals[i] for i in part]).astype(float), penalty, least, jump)):
                out[i] = ends
    return out


def _breaks(signals: np.ndarray, penalty: float, least: int, jump: int) -> list[list[int]]:
    count, n = signals.shape
    middle = np.array([K.middle_gap(s) for s in signals])
    kernel = signals[:, :, None] - signals[:, None, :]
    kernel *= kernel
    kernel /= np.where(middle != 0, middle, 1.0)[:, None, None]
    np.clip(kernel, 1e-2, 1e2, out=kernel)
    np.negative(kernel, out=kernel)
    np.exp(kernel, out=kernel)
    kernel[:, np.arange(n), np.arange(n)] = 1.0
    places = np.array([*range(0, n, jump), n])
    blocks = np.add.reduceat(np.add.reduceat(kernel, places[:-1], axis=1), places[:-1], axis=2)
    total = np.zeros((count, len(places), len(places)))
    total[:, 1:, 1:] = blocks.cumsum(1).cumsum(2)
    best, come = np.full((count, len(places)), np.inf), np.zeros((count, len(places)), int)
    best[:, 0] = 0.0
    for e in range(1, len(places)):
        starts = np.flatnonzero(places[e] - places[:e] >= least)
        if not len(starts):
            continue
        size = places[e] - places[starts]
        sums = total[:, e, e][:, None] - 2 * total[:, starts, e] + total[:, starts, starts]
        worth = best[:, starts] + size - sums / size
        k = worth.argmin(1)
        best[:, e], come[:, e] = worth[np.arange(count), k] + penalty, starts[k]
    out = []
    for row in come:
        at, ends = len(places) - 1, []
        while at:
            ends.append(int(places[at]))
            at = int(row[at])
        out.append(ends[::-1])
    return out
