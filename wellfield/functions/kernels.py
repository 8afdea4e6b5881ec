"""Small numeric kernels for one well's series: rate curve, outliers, breaks, and bounded fits of up to three numbers."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def rate(t: np.ndarray, qi: float, dei: float, deff: float, b: float) -> np.ndarray:
    """Rate at months t: hyperbolic until the decline is down to the terminal one, then exponential."""
    days = np.asarray(t, float) * (365 / 12)
    if np.isclose(dei, deff):
        return qi * np.exp(np.log1p(-dei) / 365 * days)
    b = max(b, 1e-8)
    first, last = ((1 - dei) ** -b - 1) / b / 365, -np.log1p(-deff) / 365
    switch = max((1 / last - 1 / first) / b, 0.0)
    early = qi * (1 + b * first * np.minimum(days, switch)) ** (-1 / b)
    return early * np.exp(-last * np.maximum(days - switch, 0.0))


def weighted_derivative(y: np.ndarray, x: np.ndarray, apart: float) -> np.ndarray:
    """Three-point derivative of y over rising x with neighbours at least `apart` away, weighted by the other side's distance;
    nothing at the ends."""
    out, gap = np.full(len(x), np.nan), max(apart, 1e-12)
    left, right = np.searchsorted(x, x - gap, "right") - 1, np.searchsorted(x, x + gap, "left")
    i = np.flatnonzero((left >= 0) & (right < len(x)))
    l, r = left[i], right[i]
    dl, dr = x[i] - x[l], x[r] - x[i]
    out[i] = ((y[i] - y[l]) / dl * dr + (y[r] - y[i]) / dr * dl) / (dl + dr)
    return out


def typical_points(y: np.ndarray, x: np.ndarray, apart: float = 0.05, limit: float = 2.0, least: int = 6) -> np.ndarray:
    """Which points stay: those whose log derivative, forward and of the reversed series, lies within `limit` deviations
    of its mean in both. Short series stay whole."""
    if len(y) < least:
        return np.ones(len(y), bool)
    logs = np.log(y)
    both = np.stack([weighted_derivative(logs, x, apart), weighted_derivative(logs[::-1], x, apart)[::-1]])
    if np.isnan(both).all(axis=1).any():
        return ~np.isnan(both).all(axis=0)
    with np.errstate(all="ignore"):
        z = (both - np.nanmean(both, axis=1, keepdims=True)) / np.nanstd(both, axis=1, keepdims=True)
    return ~(np.abs(z) >= limit).any(axis=0) & ~np.isnan(both).all(axis=0)


@functools.lru_cache(maxsize=64)
def _pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def middle_gap(values: np.ndarray, few: int = 200) -> float:
    """The median of the squared differences of all pairs. Of more than `few` values it is found by counting: memory stays
    linear in their number."""
    ranked = np.sort(np.asarray(values, float))
    n, pairs = len(ranked), len(ranked) * (len(ranked) - 1) // 2

    def upto(gap: float) -> tuple[int, float]:
        """How many differences are at most `gap`, and the largest of them."""
        ends = np.maximum(np.searchsorted(ranked, ranked + gap, "right"), np.arange(n) + 1)
        return int((ends - np.arange(n) - 1).sum()), float((ranked[ends - 1] - ranked).max())

    def smallest(k: int) -> float:
        """The k-th smallest difference, from 0: bisection until no number lies between the bounds."""
        low, high = 0.0, float(ranked[-1] - ranked[0])
        if upto(low)[0] > k:
            return 0.0
        while low < (middle := low + (high - low) / 2) < high:
            low, high = (low, middle) if upto(middle)[0] > k else (middle, high)
        return upto(high)[1]

    if not pairs:
        return float("nan")
    if n <= few:
        left, right = _pairs(n)
        gaps, k = ranked[right] - ranked[left], [(pairs - 1) // 2, pairs // 2]
        one, two = np.partition(gaps, k)[k].tolist()
        return (one * one + two * two) / 2
    one, two = smallest((pairs - 1) // 2), smallest(pairs // 2)
    return (one * one + two * two) / 2


def breaks(signal: np.ndarray, penalty: float, least: int = 6, jump: int = 5) -> list[int]:
    """Ends of the segments with the least kernel cost plus penalty per break, by pruned dynamic programming over every
    `jump`-th place. Empty where the series is too short for one break.

    For each place that a segment may still start at, the kernel's sum over the square from there to the current end is
    kept and grown by the new rows; so memory is a few rows of the kernel, however long the series."""
    n = len(signal)
    if -(-least // jump) * jump + least > n:
        return []
    signal = np.asarray(signal, float)
    middle = middle_gap(signal)
    best, come, live, sums, before = {0: 0.0}, {}, np.array([0]), np.array([0.0]), 0
    for end in [*range(jump, n, jump), n]:
        first = int(live.min())
        gaps = (signal[before:end, None] - signal[None, first:end]) ** 2
        kernel = np.exp(-np.clip(gaps / middle if middle else gaps, 1e-2, 1e2))
        kernel[np.arange(end - before), np.arange(before - first, end - first)] = 1.0
        aside = np.append(np.cumsum(kernel[:, : before - first].sum(0)[::-1])[::-1], 0.0)
        sums = sums + 2 * aside[live - first] + kernel[:, before - first :].sum()
        before = end
        cost = (end - live) - sums / (end - live)
        worth = np.array([best.get(int(x), np.inf) for x in live]) + cost
        ready = (end - live >= least) & np.isfinite(worth)
        if ready.any():
            k = int(np.flatnonzero(ready)[np.argmin(worth[ready])])
            best[end], come[end] = float(worth[k]) + penalty, int(live[k])
            stay = (end - live < least) | (worth <= best[end])
            live, sums = np.append(live[stay], end), np.append(sums[stay], 0.0)
    ends, at = [], n
    while at:
        ends.append(at)
        at = come[at]
    return ends[::-1]


def segment_numbers(n: int, ends: list[int]) -> np.ndarray:
    """Numbers from 1 that rise at the last point of each segment."""
    steps = np.zeros(n, int)
    steps[[e - 1 for e in ends]] = 1
    return 1 + np.cumsum(steps)


def least_squares(f: Callable, start: np.ndarray, low: np.ndarray, high: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Damped Gauss-Newton steps, cut off at the bounds; f gives the residuals."""
    x, damp = np.clip(start, low, high), 1e-2
    r = f(x)
    for _ in range(rounds):
        step = 1e-6 * np.maximum(high - low, 1e-9)
        signs = np.where(x + step > high, -1.0, 1.0)
        jacobian = np.stack([(f(x + s * d * e) - r) / (s * d) for s, d, e in zip(signs, step, np.eye(len(x)))], 1)
        gradient, square = jacobian.T @ r, jacobian.T @ jacobian
        free = ~(((x <= low) & (gradient > 0)) | ((x >= high) & (gradient < 0)))
        if not free.any():
            break
        move = np.zeros(len(x))
        inner = square[np.ix_(free, free)]
        move[free] = -np.linalg.lstsq(inner + damp * np.diag(np.maximum(np.diag(inner), 1e-12)), gradient[free], rcond=None)[0]
        new = np.clip(x + move, low, high)
        other = f(new)
        if other @ other < r @ r:
            done = r @ r - other @ other <= 1e-14 * (r @ r)
            x, r, damp = new, other, max(damp / 5, 1e-12)
            if done:
                break
        elif (damp := damp * 5) > 1e10:
            break
    return x


def coarse_start(f: Callable, start: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The best of a grid of three values for each number."""
    axes = [np.unique(np.clip([a, s, b], a, b)) for a, s, b in zip(low, start, high)]
    grid = np.stack(np.meshgrid(*axes, indexing="ij"), -1).reshape(-1, len(start))
    return grid[np.argmin([r @ r for r in map(f, grid)])]


def evolve(f: Callable, low: np.ndarray, high: np.ndarray, rounds: int, seed: int, size: int = 24, tolerance: float = 1e-4) -> np.ndarray:
    """Differential evolution between the bounds, with a drawn best-based step and crossover."""
    rng = np.random.default_rng(seed)
    pool = low + rng.random((size, len(low))) * (high - low)
    worth = np.array([r @ r for r in map(f, pool)])
    for _ in range(rounds):
        best = pool[worth.argmin()]
        picks = np.stack([rng.permutation(size)[:2] for _ in range(size)])
        trial = best + rng.uniform(0.5, 1.0) * (pool[picks[:, 0]] - pool[picks[:, 1]])
        trial = np.where(rng.random(pool.shape) < 0.7, np.clip(trial, low, high), pool)
        value = np.array([r @ r for r in map(f, trial)])
        better = value < worth
        pool[better], worth[better] = trial[better], value[better]
        if worth.std() <= tolerance * abs(worth.mean()):
            break
    return pool[worth.argmin()]


@functools.cache
def t_quantile(degrees: int, both_sides: float = 0.9) -> float:
    """The t up to which Student's distribution with so many degrees holds a share of `both_sides` around 0: bisection on
    the finite series of its distribution function in the angle atan(t / sqrt(degrees))."""

    def share(angle: float) -> float:
        odd, total, term = degrees % 2, 0.0, math.cos(angle) if degrees % 2 else 1.0
        for k in range((degrees - odd) // 2):
            total += term
            term *= (2 * k + 1 + odd) / (2 * k + 2 + odd) * math.cos(angle) ** 2
        return (angle + math.sin(angle) * total) * 2 / math.pi if odd else math.sin(angle) * total

    low, high = 0.0, math.pi / 2
    for _ in range(60):
        low, high = ((low + high) / 2, high) if share((low + high) / 2) < both_sides else (low, (low + high) / 2)
    return math.sqrt(degrees) * math.tan(low)


def smoothed(q: np.ndarray, passes: int) -> np.ndarray:
    """The mean of up to three points up to each one, `passes` times."""
    for _ in range(passes):
        so_far = np.append(0.0, np.cumsum(q))
        at = np.arange(1, len(q) + 1)
        q = (so_far[at] - so_far[np.maximum(at - 3, 0)]) / np.minimum(at, 3)
    return q


def b_line(t: np.ndarray, q: np.ndarray, passes: int = 2, least: int = 24, most: int = 60) -> tuple[float, float, float, int] | None:
    """Slope of (1 - D) / D over time, the ends of its 90% interval (NaN for two points), and the limit in months that
    fits best; None where there is no line. Times rise.

    What counts is as in forecast.b_diagnostics: rates from the last place of the largest on, smoothed, of which `least`
    are needed. Running sums give the lines of all limits at once; of equally good ones the first limit stays."""
    t, q = t[q > 0], q[q > 0]
    if not len(q):
        return None
    last = len(q) - 1 - int(np.argmax(q[::-1]))
    t, q = np.asarray(t[last:], float), smoothed(np.asarray(q[last:], float), passes)
    if len(q) < least:
        return None
    with np.errstate(all="ignore"):
        decline = np.log(q[:-1] / q[1:]) / np.diff(t)
        y = (1 - decline) / decline
    fine = np.isfinite(y) & (y > 0.001 * t[1:]) & (y < 3 * t[1:])
    x, y = t[1:][fine], y[fine]
    limits = np.arange(least, most + 1)
    upto = np.searchsorted(x, limits, "right")
    centred = x - t[0]
    n, sx, sy, sxx, sxy, syy = (np.append(0.0, np.cumsum(v))[upto] for v in (np.ones(len(x)), centred, y, centred**2, centred * y, y**2))
    xx, xy, yy = n * sxx - sx * sx, n * sxy - sx * sy, n * syy - sy * sy
    with np.errstate(all="ignore"):
        r2 = np.where(xx > 0, np.where(yy <= 1e-12 * n, 1.0, xy * xy / (xx * yy)), -np.inf)
    k = int(np.argmax(np.round(r2, 10)))
    if not np.isfinite(r2[k]):
        return None
    slope, wide = xy[k] / xx[k], float("nan")
    if n[k] > 2:
        wide = t_quantile(int(n[k]) - 2) * math.sqrt(max(yy[k] - xy[k] * slope, 0.0) / (n[k] - 2) / xx[k])
    return float(slope), float(slope - wide), float(slope + wide), int(limits[k])


def b_limits(low: float, middle: float, high: float, least: float = 0.5, most: float = 1.4) -> tuple[float, float, float]:
    """Lower limit, start and upper limit of a fit's b; NaN stands for unknown. As forecast.b_bounds has them."""
    low = max(low if low == low else least, least)
    high = min(max(high if high == high else most, 1.1 * low), most)
    start = middle if low <= middle <= high else (low + high) / 2
    return round(low, 4), round(start, 4), round(high, 4)


def simplified(xy: np.ndarray, tolerance: float) -> np.ndarray:
    """Which places of a line stay, so that none of the others lies further than `tolerance` from the line through those that
    stay: between two kept places the furthest one is kept while it is too far (Douglas and Peucker)."""
    keep = np.zeros(len(xy), bool)
    keep[[0, -1]] = True
    waiting = [(0, len(xy) - 1)]
    while waiting:
        a, b = waiting.pop()
        if b - a < 2:
            continue
        inner, along = xy[a + 1 : b] - xy[a], xy[b] - xy[a]
        square = along @ along
        share = np.clip(inner @ along / square, 0, 1) if square else np.zeros(len(inner))
        away = np.hypot(*(inner - share[:, None] * along).T)
        k = int(np.argmax(away))
        if away[k] > tolerance:
            keep[a + 1 + k] = True
            waiting += [(a, a + 1 + k), (a + 1 + k, b)]
    return keep


def hull(xy: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of places (rows of x, y), counterclockwise from the least; all places where there are
    fewer than three corners.

    Only the lowest and the highest place of each x can be corners. Places that lie on or above the line between their
    neighbours (for the lower half) go, all such at once with every second one staying, until none is left."""
    ranked = np.unique(np.asarray(xy, float).reshape(-1, 2), axis=0)
    if len(ranked) < 3:
        return ranked
    first = np.flatnonzero(np.append(True, ranked[1:, 0] != ranked[:-1, 0]))
    last = np.append(first[1:], len(ranked)) - 1
    lower, upper = _chain(ranked[first]), _chain(-ranked[last][::-1])
    ring = np.vstack([lower, -upper])
    keep = np.append(True, (ring[1:] != ring[:-1]).any(axis=1)) & np.append((ring[0] != ring[-1]).any(), np.ones(len(ring) - 1, bool))
    return ring[keep] if keep.sum() > 2 else ranked[[0, -1]]


def _chain(line: np.ndarray) -> np.ndarray:
    """The lower hull of places with rising x."""
    while len(line) > 2:
        a, b, c = line[:-2], line[1:-1], line[2:]
        turn = (b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])
        out = turn <= 0
        if not out.any():
            break
        run = np.arange(len(out)) - np.maximum.accumulate(np.where(~out, np.arange(len(out)), -1)) - 1
        line = np.delete(line, np.flatnonzero(out & (run % 2 == 0)) + 1, axis=0)
    return line


def covered(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray) -> np.ndarray:
    """(r, s, t): which places px (r, s) by py (r, t) lie in rings x, y (r, n) or on an edge, as geometry.covers() has it.
    An edge with a corner that is NaN holds nothing."""
    at_x, at_y = px[:, :, None], py[:, None, :]
    inside = np.zeros((len(x), px.shape[1], py.shape[1]), bool)
    edge = inside.copy()
    with np.errstate(all="ignore"):
        for k in range(x.shape[1]):
            ax, ay, bx, by = (v[:, i, None, None] for i in (k, (k + 1) % x.shape[1]) for v in (x, y))
            dx, dy = bx - ax, by - ay
            crosses = (ay > at_y) != (by > at_y)
            inside ^= crosses & (at_x < ax + (at_y - ay) / np.where(dy == 0, np.nan, dy) * dx)
            square = dx * dx + dy * dy
            along = ((at_x - ax) * dx + (at_y - ay) * dy) / np.where(square == 0, 1.0, square)
            t = np.minimum(np.maximum(along, 0.0), 1.0)
            edge |= np.hypot(at_x - ax - t * dx, at_y - ay - t * dy) < 1e-9
    return inside | edge


def meshes(rings: pa.Array, side: int, most: int = 1 << 20) -> pa.Array:
    """The places (x, y) of a square mesh of side * side over each ring's envelope that the ring covers, by x and then y; the
    mean of its corners where it covers none. Rings of one size go together, with `most` places at a time or so."""
    lengths = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False)
    starts, columns = np.append(0, np.cumsum(lengths))[:-1], rings.flatten().flatten()
    lost = [c.is_null().to_numpy(zero_copy_only=False) for c in columns]
    value = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns]
    counts, done = np.ones(len(lengths), np.int64), []
    steps = np.arange(side) + 0.5
    for n in np.unique(lengths[lengths > 0]):
        alike = np.flatnonzero(lengths == n)
        for rows in np.array_split(alike, max(1, len(alike) * side * side // most)):
            at = starts[rows, None] + np.arange(n)
            own, gone = [v[at] for v in value], [m[at] for m in lost]
            low, high = ([f(np.where(g, fill, v), axis=1)[:, None] for v, g in zip(own, gone)] for f, fill in ((np.min, np.inf), (np.max, -np.inf)))
            with np.errstate(all="ignore"):
                px, py = (a + (b - a) * steps / side for a, b in zip(low, high))
            kept = covered(*own, px, py)
            counts[rows] = np.maximum(kept.sum(axis=(1, 2)), 1)
            bare = ~kept.any(axis=(1, 2))
            r, i, j = np.nonzero(kept)
            means = [np.where(g.any(axis=1), np.nan, np.cumsum(v, axis=1)[:, -1] / n)[bare] for v, g in zip(own, gone)]
            done.append((rows, r, (px[r, i], py[r, j]), rows[bare], means, [g.any(axis=1)[bare] for g in gone]))
    ends = np.cumsum(counts)
    first = ends - counts
    out = [np.full(counts.sum(), np.nan) for _ in "xy"]
    empty = [np.zeros(counts.sum(), bool) for _ in "xy"]
    for rows, r, places, bare, means, without in done:
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        for k in (0, 1):
            out[k][first[rows[r]] + rank] = places[k]
            out[k][first[bare]] = means[k]
            empty[k][first[bare]] = without[k]
    for k in (0, 1):
        empty[k][first[lengths == 0]] = True
    found = pa.StructArray.from_arrays([pa.array(v, mask=m) for v, m in zip(out, empty)], ["x", "y"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), found)
