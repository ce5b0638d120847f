"""Series of arcs in a network of interferograms: look-angle slopes, smoothing in time, and annealing of the noisy ones.

A row is an arc, a column an interferogram between two acquisitions (``pairs``, counted from 0 in the order of ``days``).
"""

from __future__ import annotations

import math

import numpy as np

#: Forms of the smoothing.
METHODS = ("3D", "3D_NEW", "3D_SMALL_DEF", "3D_QUICK", "3D_NO_DEF", "2D")
#: A second peak must be so much lower, and a fit so coherent, for a slope to count; noise (radians) from which an arc is
#: annealed, and from which a quick method gives it up.
MARGIN, COHERENT, ANNEAL, GIVE_UP = 0.1, 0.31, 1.0, 1.3


def network(pairs: np.ndarray, n: int) -> np.ndarray:
    """-1 at the first, +1 at the second acquisition of each interferogram."""
    g, rows = np.zeros((len(pairs), n)), np.arange(len(pairs))
    g[rows, pairs[:, 0]], g[rows, pairs[:, 1]] = -1, 1
    return g


def slope_sample(z: np.ndarray, pairs: np.ndarray, days: np.ndarray, bperp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phasors and baselines that a slope is searched on, where deformation has least say: interferograms of neighbouring
    acquisitions, if they are enough to join all; else differences along time of an acquisition's that meets nearly all
    others; else all."""
    near = np.flatnonzero(np.abs(np.diff(pairs, axis=1).ravel()) == 1)
    if len(near) >= len(days) - 1:
        return z[:, near], bperp[near]
    met = np.bincount(pairs.ravel(), minlength=len(days))
    hub = int(met.argmax())
    if met[hub] < len(days) - 2:
        return z, bperp
    rows = np.flatnonzero((pairs == hub).any(axis=1))
    forward = pairs[rows, 0] == hub  # from the hub to the other
    from_hub = np.where(forward, z[:, rows], np.conj(z[:, rows]))
    order = np.argsort(days[np.r_[pairs[rows].sum(axis=1) - hub, hub]], kind="stable")
    states = np.c_[from_hub, np.ones(len(z))][:, order]
    steps = states[:, 1:] * np.conj(states[:, :-1])
    size = np.abs(steps)
    return np.divide(steps, size, out=np.zeros_like(steps), where=size > 0), np.diff(np.r_[np.where(forward, 1, -1) * bperp[rows], 0.0][order])


def slopes(z: np.ndarray, pairs: np.ndarray, days: np.ndarray, bperp: np.ndarray, wraps: float) -> np.ndarray:
    """The slope of each arc's phase over the baselines, by trials an eighth of a wrap apart and one step of least squares; 0
    where another peak of the trials is nearly as high, or the fit is not coherent."""
    z, out, whole = np.asarray(z, complex), np.zeros(len(z)), float(np.ptp(bperp))
    if whole <= np.finfo(float).eps:
        return out
    sample, b = slope_sample(z, np.asarray(pairs), np.asarray(days), np.asarray(bperp, float))
    span = float(np.ptp(b)) if b.size else 0.0
    if span <= np.finfo(float).eps:
        return out
    n = max(1, math.ceil(8 * wraps * span / whole))
    trials = np.arange(-n, n + 1) * (math.pi / 4 / span)
    total = np.abs(sample).sum(axis=1)
    height = np.abs(sample @ np.exp(-1j * np.outer(b, trials))) / np.where(total > 0, total, 1)[:, None]
    for arc, row in enumerate(height):
        left = right = top = int(row.argmax())
        while left and row[left - 1] <= row[left]:
            left -= 1
        while right + 1 < len(row) and row[right + 1] <= row[right]:
            right += 1
        others = np.r_[row[:left], row[right + 1 :], 0.0]
        if row[top] - others.max() <= MARGIN:
            continue
        turned = sample[arc] * np.exp(-1j * trials[top] * b)
        rest, w = np.angle(turned * np.conj(turned.sum())), np.abs(sample[arc])
        slope = trials[top] + (w * b * rest).sum() / max((w * b * b).sum(), 1e-300)
        if np.abs((sample[arc] * np.exp(-1j * slope * b)).sum()) / max(total[arc], 1e-12) >= COHERENT:
            out[arc] = slope
    return out


def whitener(count: float, total: np.ndarray, products: np.ndarray) -> np.ndarray:
    """What makes noise of the covariance that the sums of differences over arcs give white: the transposed Cholesky factor of
    its inverse; where there is none, each interferogram by its own deviation; unity with less than two arcs."""
    n = len(total)
    if count <= 1:
        return np.eye(n)
    covariance = (products - np.outer(total, total) / count) / (count - 1)
    try:
        return np.linalg.cholesky(np.linalg.pinv((covariance + covariance.T) / 2, hermitian=True)).T
    except np.linalg.LinAlgError:
        own = np.diag(covariance)
        return np.diag(np.divide(1.0, np.sqrt(np.maximum(own, 0)), out=np.ones(n), where=own > 0))


def _waves(models: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A trend and two waves over the whole time: series of the rows (trend, size, shift, size, shift)."""
    trend, size, shift, size2, shift2 = (models[:, [k]] for k in range(5))
    turn, n = 2 * math.pi / len(x) * x, len(x)
    return trend * x + size * n / 2 * np.sin(turn - shift) + size2 * n / 2 * np.sin(2 * turn - shift2)


def _costs(models: np.ndarray, g: np.ndarray, w: np.ndarray, phase: np.ndarray, x: np.ndarray) -> np.ndarray:
    series = _waves(models, x)
    cycles = (phase - series @ g.T) / (2 * math.pi)
    return 2 * math.pi * np.abs((cycles - np.rint(cycles)) @ w.T).sum(axis=1) + np.abs(np.diff(series, axis=1)).sum(axis=1) / 5


#: Ranges of the five parameters in half turns, and how often each of nine temperatures is held (fixed values).
_BOUNDS = math.pi * np.array([[-0.5, 0.5], [-0.25, 0.25], [-1, 1], [-0.25, 0.25], [-1, 1]])
_HELD = (1, 2, 4, 6, 10, 6, 4, 2, 1)
STARTS, SEED = 100, 104729


def anneal(g: np.ndarray, w: np.ndarray, phase: np.ndarray, x: np.ndarray, key: int, runs: int = 15) -> np.ndarray:
    """The series over the acquisitions of a trend and two waves that fits one arc's wrapped phases best: from the best of
    random starts, parameters are drawn in turn from a grid around them with odds by cost and temperature. The arc's key seeds
    the generator, so the result depends on nothing else."""
    draw, best, model = np.random.default_rng(SEED + key), math.inf, np.zeros(5)
    powers = 0.5 ** np.arange(1, 5)
    steps = np.r_[powers, 0.0, -powers]
    for cooling in np.linspace(2, 3, max(1, runs)):
        starts = draw.uniform(_BOUNDS[:, 0], _BOUNDS[:, 1], (STARTS, 5))
        costs = _costs(starts, g, w, phase, x)
        at = starts[costs.argmin()].copy()
        if costs.min() < best:
            best, model = float(costs.min()), at.copy()
        critical = math.log10(max(float(costs.mean()), 1e-12)) - cooling
        for temperature in np.repeat(np.logspace(critical + 1, critical - 1, len(_HELD)), _HELD):
            for k, (low, high) in enumerate(_BOUNDS):
                values = at[k] + steps * (high - low) / 2
                values = values[(values >= low) & (values <= high)]
                near = np.repeat(at[None], len(values), axis=0)
                near[:, k] = values
                costs = _costs(near, g, w, phase, x)
                odds = np.exp(-(costs - costs.min()) / max(temperature, 1e-12))
                chosen = int(draw.choice(len(odds), p=odds / odds.sum()))
                at = near[chosen].copy()
                if costs[chosen] < best:
                    best, model = float(costs[chosen]), at.copy()
    return _waves(model[None], x)[0]


def space_time(z: np.ndarray, keys: np.ndarray, pairs: np.ndarray, days: np.ndarray, bperp: np.ndarray, window: float, method: str = "3D", k: np.ndarray | None = None, w: np.ndarray | None = None, runs: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """(noise, unwrapped) of each arc and interferogram: phases, less slopes `k` over the baselines, are inverted to a series,
    smoothed by a Gaussian `window` (days) wide and predicted back; noise is the wrapped rest. Methods 2D and 3D_NO_DEF smooth
    nothing; 3D_SMALL_DEF and 3D_QUICK give arcs up (NaN) whose noise is beyond GIVE_UP; 3D and 3D_NEW anneal those beyond
    ANNEAL with the whitener `w`, if one is given."""
    if method not in METHODS:
        raise ValueError(f"methods are {', '.join(METHODS)}")
    slope = np.zeros(len(z)) if k is None else k
    pairs, days, bperp = np.asarray(pairs), np.asarray(days, float), np.asarray(bperp, float)
    flat = np.asarray(z, complex) * np.exp(-1j * slope[:, None] * bperp)
    phase, smooth = np.angle(flat), np.zeros(flat.shape)
    if method not in ("2D", "3D_NO_DEF"):
        g = network(pairs, len(days))
        weights = np.exp(-((days[:, None] - days) ** 2) / (2 * max(window, 1e-6) ** 2))
        weights /= weights.sum(axis=1, keepdims=True)
        series = np.c_[np.zeros(len(z)), phase @ np.linalg.pinv(g[:, 1:]).T]
        smooth = series @ weights.T @ g.T
        deviation = np.angle(flat * np.exp(-1j * smooth)).std(axis=1, ddof=1)
        if method in ("3D_SMALL_DEF", "3D_QUICK"):
            smooth[deviation > GIVE_UP] = np.nan
        elif w is not None:
            span = days[-1] - days[0]
            x = (days - days[0]) * (len(days) - 1) / span if span else np.arange(len(days), dtype=float)
            for arc in np.flatnonzero(deviation > ANNEAL):
                smooth[arc] = g @ anneal(g, w, phase[arc], x, int(keys[arc]), runs)
    noise = np.angle(flat * np.exp(-1j * smooth))
    return noise, smooth + noise + slope[:, None] * bperp


def beside_master(days: np.ndarray) -> list[int]:
    """The epochs next to the master's day, which is 0: the last one before it and the first one after; the last of all if none
    is after it."""
    after = np.flatnonzero(days > 0)
    if not len(after):
        return [len(days) - 1] if len(days) else []
    first = int(after[days[after].argmin()])
    return [first - 1, first] if first else [first]


def smooth_single_master(z: np.ndarray, days: np.ndarray, window: float) -> tuple[np.ndarray, np.ndarray]:
    """(smoothed and unwrapped along time, noise) of arcs over a single master's epochs, whose days count from the master's: at
    each epoch a Gaussian-weighted line through the phases about their weighted mean; the steps from epoch to epoch are summed, and
    whole turns are taken off so that the epochs beside the master are within half a turn of nought."""
    z, days = np.asarray(z, complex), np.asarray(days, float)
    phase, smooth = np.angle(z), np.empty(z.shape, complex)
    for k, day in enumerate(days):
        apart = day - days
        w = np.exp(-(apart**2) / (2 * max(window, 1e-6) ** 2))
        w /= max(w.sum(), 1e-12)
        mean = z @ w
        rest = np.mod(phase - np.angle(mean)[:, None] + np.pi, 2 * np.pi) - np.pi
        rest = np.where((np.abs(rest + np.pi) < 1e-6) & (apart > 0), np.pi, rest)
        sx, sxx, sy, sxy = w @ apart, w @ apart**2, rest @ w, rest @ (w * apart)
        spread = sxx - sx * sx
        smooth[:, k] = mean * np.exp(1j * ((sxx * sy - sx * sxy) / spread if spread > 1e-12 else sy))
    steps = np.angle(np.c_[smooth[:, :1], smooth[:, 1:] * np.conj(smooth[:, :-1])])
    series = np.cumsum(steps, axis=1)
    near = series[:, beside_master(days)].mean(axis=1)
    return series - (near - np.angle(np.exp(1j * near)))[:, None], np.angle(z * np.conj(smooth))
