"""Dense numpy kernels: what runs inside an Arrow function for one point, arc or interferogram at a time."""

from __future__ import annotations

import math

import numpy as np


def topofit(phase: np.ndarray, bperp: np.ndarray, wraps: float, tolerance: float = 2e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """K, C, coherence and residual phasors of each row of complex `phase` over the baselines.

    Trial slopes are spaced an eighth of a wrap apart; every local maximum within `tolerance` of the best is refined by one
    weighted least-squares step, and the best refined one stays. Zero samples do not count; a row of zeros is NaN.
    """
    z = np.asarray(phase, complex)
    b = np.broadcast_to(np.asarray(bperp, float), z.shape)
    weight = np.abs(z)
    span = b.max() - b.min() if b.size else 1.0
    n = math.ceil(8 * wraps)
    slopes = np.arange(-n, n + 1) * (np.pi / 4) / span
    total = weight.sum(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        trials = np.abs(np.einsum("pi,pit->pt", z, np.exp(-1j * b[:, :, None] * slopes))) / total[:, None]
    k, c = np.full(len(z), np.nan), np.full(len(z), np.nan)
    coherence, residual = np.full(len(z), np.nan), np.zeros_like(z)
    for row in range(len(z)):
        if not total[row] > 0:
            continue
        t = trials[row]
        peaks = [j for j in range(len(t)) if t[j] >= t.max() - tolerance and t[j] >= t[max(j - 1, 0)] and t[j] >= t[min(j + 1, len(t) - 1)]]
        for j in peaks:
            turned = z[row] * np.exp(-1j * slopes[j] * b[row])
            offset = turned.sum()
            rest = np.angle(turned * np.conj(offset))
            w = weight[row] * b[row]
            size = (w * w).sum()
            slope = slopes[j] + ((w * weight[row] * rest).sum() / size if size > 0 else 0.0)
            fitted = z[row] * np.exp(-1j * slope * b[row])
            value = abs(fitted.sum()) / total[row]
            if not value <= coherence[row]:
                k[row], c[row], coherence[row], residual[row] = slope, np.angle(fitted.sum()), value, fitted
    return k, c, coherence, residual


def gaussian_window(n: int, alpha: float = 2.5) -> np.ndarray:
    at = np.arange(n) - (n - 1) / 2
    return np.exp(-0.5 * (alpha * at / ((n - 1) / 2)) ** 2)


def butterworth(n: int, cutoff: float, pixel: float, order: int = 5) -> np.ndarray:
    """Low-pass response over the frequencies of an n by n transform of `pixel`-sized cells."""
    f = np.fft.fftfreq(n, pixel)
    response = 1 / (1 + (f * cutoff) ** (2 * order))
    return np.outer(response, response)


def lowpass_taps(n: int, cutoff: float) -> np.ndarray:
    """Hamming-windowed taps of a low-pass filter, `cutoff` as a share of half the sampling rate; their sum is one."""
    at = np.arange(n) - (n - 1) / 2
    taps = cutoff * np.sinc(cutoff * at) * np.hamming(n)
    return taps / taps.sum()


def interpolated(x: np.ndarray, times: int, reach: int = 4) -> np.ndarray:
    """x at `times` as many places: zeros are put between its values and a filter over `reach` values on each side fills them."""
    spread = np.zeros((len(x) + reach) * times + 1)
    spread[: len(x) * times : times] = x
    taps = lowpass_taps(2 * times * reach + 2, 0.5 / times)
    return times * np.convolve(spread, taps)[: len(spread)][times * reach + 1 :]


def chance_curve(random: np.ndarray, observed: np.ndarray, low: int, last: int) -> np.ndarray:
    """The probability that a coherence is by chance, at every thousandth from 0: the ratio of the histograms of hundredths
    (one below bin `low`, nought from bin `last` on, never above one), smoothed by the seven values before, interpolated."""
    p = random / np.where(observed == 0, 1, observed)
    p[:low], p[last:] = 1, 0
    window = gaussian_window(7)
    smooth = np.convolve(np.r_[np.ones(7), np.minimum(p, 1)], window)[: 7 + len(p)][7:] / window.sum()
    return interpolated(np.r_[1.0, smooth], 10)[:-9]


def square_weights(coherence: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """Squared probability that a point's coherence is not by chance; NaN counts as chance."""
    at = np.floor(np.nan_to_num(coherence) * 1000 + 0.5).astype(int)
    return (1 - curve[np.clip(at, 0, len(curve) - 1)]) ** 2


def bootstrap_deviation(residual: np.ndarray, ids: np.ndarray, draws: int = 100, seed: int = 0) -> np.ndarray:
    """Standard deviation of the coherence of each row of residual phases over resamples of its samples. Each row's generator
    is seeded by its id, so that a row's result does not depend on the rows beside it."""
    z, out = np.exp(1j * np.asarray(residual, float)), np.full(len(residual), np.inf)
    n = z.shape[1]
    for row, key in enumerate(ids):
        if n:
            picked = np.random.default_rng([seed, int(key)]).integers(0, n, (draws, n))
            out[row] = np.abs(z[row][picked].sum(axis=1) / n).std()
    return out


def _spectrum_smoothed(magnitude: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Smoothed along both axes with the zero frequency in the middle and zeros outside."""
    x = np.fft.fftshift(magnitude)
    for axis in (0, 1):
        x = np.apply_along_axis(np.convolve, axis, x, kernel, "same")
    return np.fft.ifftshift(x)


def _windows(n: int, size: int, step: int, fewer: int) -> list[tuple[int, int]]:
    """(first cell, cells by which it was moved back to end with the grid) of the windows along an axis."""
    return [(min(k * step, n - size), max(0, k * step + size - n)) for k in range(max(1, -(-n // step) - fewer))]


def _filtered(grid: np.ndarray, size: int, pad: int, step: int, fewer: int, ramp: np.ndarray, responses) -> list[np.ndarray]:
    """For each response the weighted sum of the windows' transforms back. `ramp` rises to the middle of a window along one
    axis and falls again; a weight is the sum of the two axes' ramps. The weights of a window that was moved back to end with
    the grid stay where it began. A grid smaller than a window is filled up with zeros."""
    rows, cols = grid.shape
    whole = np.zeros((max(rows, size), max(cols, size)), complex)
    whole[:rows, :cols] = np.nan_to_num(grid)
    weight = ramp[:, None] + ramp[None, :]
    out = None
    for i, down in _windows(whole.shape[0], size, step, fewer):
        for j, right in _windows(whole.shape[1], size, step, fewer):
            part = np.zeros((size + pad, size + pad), complex)
            part[:size, :size] = whole[i : i + size, j : j + size]
            spectrum = np.fft.fft2(part)
            w = np.zeros((size, size))
            w[down:, right:] = weight[: size - down, : size - right]
            made = [np.fft.ifft2(spectrum * by)[:size, :size] * w for by in responses(np.abs(spectrum))]
            out = [np.zeros_like(whole) for _ in made] if out is None else out
            for total, x in zip(out, made):
                total[i : i + size, j : j + size] += x
    return [total[:rows, :cols] for total in out]


def adaptive_filter(grid: np.ndarray, size: int = 24, pad: int = 8, alpha: float = 1.0, beta: float = 0.3, low_pass: np.ndarray | None = None) -> np.ndarray:
    """Combined low-pass and adaptive phase filter of a complex grid: in windows a quarter of their size apart, the smoothed
    magnitude of the spectrum over its median, to the power alpha, less one and not below zero, times beta, plus the low-pass
    response, is the filter. Windows are summed with their weights, not averaged: angles are what counts."""
    kernel = gaussian_window(7)
    low = 0.0 if low_pass is None else low_pass

    def responses(magnitude):
        power = _spectrum_smoothed(magnitude, kernel)
        middle = np.median(power)
        yield np.maximum((power / middle if middle else power) ** alpha - 1, 0) * beta + low

    half = np.arange(size // 2) + 0.5e-6
    return _filtered(grid, size, pad, max(1, size // 4), 3, np.r_[half, half[::-1]], responses)[0]


def goldstein(grid: np.ndarray, size: int = 32, alpha: float = 0.8) -> tuple[np.ndarray, np.ndarray]:
    """(filtered, low-passed): spectral-power filter in windows half their size apart, magnitudes as they were; the low-pass is
    a Gaussian of width 16 in the same windows."""
    pad = size // 4
    kernel, g = gaussian_window(7), np.fft.ifftshift(gaussian_window(size + pad, 16))

    def responses(magnitude):
        power = _spectrum_smoothed(magnitude, kernel)
        middle = np.median(power)
        yield (power / middle if middle else power) ** alpha
        yield np.outer(g, g)

    half = np.arange(1, size // 2 + 1, dtype=float)
    made = _filtered(grid, size, pad, max(1, size // 2), 1, np.r_[half, half[::-1]], responses)
    return tuple(np.abs(grid) * np.exp(1j * np.angle(x)) for x in made)


def own_cell_filter(grid: np.ndarray, row: int, col: int, size: int = 32, alpha: float = 1.0, beta: float = 0.3, low_pass: np.ndarray | None = None) -> complex:
    """The adaptive filter's value at one cell from the window around it, its own cell left out: what the surroundings say of
    a point. At the border the window is moved inside."""
    rows, cols = grid.shape
    whole = np.zeros((max(rows, size), max(cols, size)), complex)
    whole[:rows, :cols] = np.nan_to_num(grid)
    i, j = (min(max(at - size // 2, 0), n - size) for at, n in zip((row, col), whole.shape))
    part = whole[i : i + size, j : j + size].copy()
    part[row - i, col - j] = 0
    spectrum = np.fft.fft2(part)
    power = _spectrum_smoothed(np.abs(spectrum), gaussian_window(7))
    middle = np.median(power)
    gain = np.maximum((power / middle if middle else power) ** alpha - 1, 0) * beta
    return complex(np.fft.ifft2(spectrum * (gain + (0.0 if low_pass is None else low_pass)))[row - i, col - j])


def spanning_order(n: int, arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, parent) of a breadth-first walk from the first node of each connected part; a root is its own parent."""
    near: list[list[int]] = [[] for _ in range(n)]
    for a, b in arcs:
        near[a].append(int(b)), near[b].append(int(a))
    parent, order = np.full(n, -1), []
    for root in range(n):
        if parent[root] >= 0:
            continue
        parent[root], front = root, [root]
        while front:
            order += front
            after = []
            for p in front:
                for q in sorted(near[p]):
                    if parent[q] < 0:
                        parent[q] = p
                        after.append(q)
            front = after
    return np.array(order, int), parent


def unwrap(phase: np.ndarray, order: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Rows of wrapped phase, integrated along the tree: each node is its parent plus the wrapped difference. All nodes that are
    equally far from their root go together."""
    out, n = np.array(phase, float), len(parent)
    step = out - out[parent]
    step = np.arctan2(np.sin(step), np.cos(step))
    children = np.argsort(parent, kind="stable")
    children = children[parent[children] != children]
    starts = np.searchsorted(parent[children], np.arange(n + 1))
    front = np.flatnonzero(parent == np.arange(n))
    while len(front):
        many = starts[front + 1] - starts[front]
        place = np.repeat(starts[front] - np.cumsum(many) + many, many) + np.arange(many.sum())
        front = children[place]
        out[front] = out[parent[front]] + step[front]
    return out


def delaunay(xy: np.ndarray) -> np.ndarray:
    """Edges (a < b) of the Delaunay triangulation by incremental insertion (Bowyer and Watson)."""
    n = len(xy)
    if n < 3:
        return np.array([(a, b) for a in range(n) for b in range(a + 1, n)], int).reshape(-1, 2)
    middle, span = xy.mean(axis=0), max(np.ptp(xy, axis=0).max(), 1e-9)
    # A tiny fixed displacement breaks ties of points on one circle, as on a lattice.
    shake = np.random.default_rng(0).uniform(-1e-7, 1e-7, xy.shape) * span
    p = np.vstack([xy + shake, middle + 50 * span * np.array([[-1, -1], [0, 2], [1, -1]])])

    def circle(t):
        a, b, c = p[list(t)]
        d = 2 * ((b - a)[0] * (c - a)[1] - (b - a)[1] * (c - a)[0])
        e, f = ((b - a) ** 2).sum(), ((c - a) ** 2).sum()
        centre = a + np.array([(c - a)[1] * e - (b - a)[1] * f, (b - a)[0] * f - (c - a)[0] * e]) / d
        return centre[0], centre[1], ((a - centre) ** 2).sum()

    # Points come from left to right, so a triangle whose circle lies left of the point in hand is finished and not looked at again.
    triangles, finished = {(n, n + 1, n + 2): circle((n, n + 1, n + 2))}, []
    for step, k in enumerate(np.argsort(p[:n, 0], kind="stable")):
        x, y = p[k]
        if step % 64 == 0:
            passed = [t for t, (cx, _, r) in triangles.items() if x > cx and (x - cx) ** 2 > r]
            for t in passed:
                del triangles[t]
            finished += passed
        bad = [t for t, (cx, cy, r) in triangles.items() if (x - cx) ** 2 + (y - cy) ** 2 < r]
        sides: dict[tuple[int, int], int] = {}
        for t in bad:
            del triangles[t]
            for s in ((t[0], t[1]), (t[1], t[2]), (t[0], t[2])):
                s = (min(s), max(s))
                sides[s] = sides.get(s, 0) + 1
        for (a, b), count in sides.items():
            if count == 1:
                t = (a, b, int(k))
                triangles[t] = circle(t)
    edges = {(min(s), max(s)) for t in [*finished, *triangles] for s in ((t[0], t[1]), (t[1], t[2]), (t[0], t[2])) if max(s) < n}
    return np.array(sorted(edges), int).reshape(-1, 2)


#: Points that a plane needs.
PLANE_POINTS = 10


def _weighted_plane(design: np.ndarray, v: np.ndarray, weight: np.ndarray) -> np.ndarray:
    ok = np.isfinite(design).all(axis=1) & np.isfinite(v) & np.isfinite(weight) & (weight > 0)
    if ok.sum() < PLANE_POINTS:
        return np.full(3, np.nan)
    root = np.sqrt(weight[ok])
    return np.linalg.lstsq(design[ok] * root[:, None], v[ok] * root, rcond=None)[0]


def huber_plane(x: np.ndarray, y: np.ndarray, v: np.ndarray, q: np.ndarray, delta: float = 1.345, rounds: int = 5) -> np.ndarray:
    """Coefficients (a, b, c) of v = a x/1000 + b y/1000 + c with weights q^2: one fit, then at most `rounds` more with weights
    by Huber's rule. Rows that are not finite or have no weight don't count; NaN with fewer than ten that do."""
    design, weight = np.c_[x / 1000, y / 1000, np.ones(len(x))], np.asarray(q, float) ** 2
    fit = _weighted_plane(design, v, weight)
    for _ in range(rounds):
        rest = v - design @ fit
        counts = rest[np.isfinite(rest) & np.isfinite(weight) & (weight > 0)]
        if len(counts) < PLANE_POINTS:
            break
        scale = 1.4826 * np.median(np.abs(counts - np.median(counts)))
        if not scale > 1e-8:
            break
        after = _weighted_plane(design, v, weight / np.maximum(np.abs(rest) / (delta * scale), 1))
        if np.isnan(after).any():
            break
        moved, fit = np.abs(after - fit).max(), after
        if moved < 1e-8:
            break
    return fit


def threshold_from_random(observed: np.ndarray, random: np.ndarray, target: float, low: int = 31, share: bool = True) -> float:
    """The coherence above which `target` per cent of the points kept are expected to be random (with `share` false: that many
    points). Histograms are by hundredths and leave out coherences of nought. The random one is scaled to the observed one in
    the first `low` bins, where all points are taken for random; a cubic through the six bins around the first that passes gives
    the threshold, bin k standing for k / 100. 1 if no bin passes; NaN if the six bins would begin before the first."""
    base = random[:low].sum()
    scaled = random * (observed[:low].sum() / base if base > 0 else 1.0)
    chance = np.cumsum(scaled[::-1])[::-1]
    if share:
        chance = 100 * chance / np.cumsum(np.where(observed == 0, 1, observed)[::-1])[::-1]
    passing = np.flatnonzero(chance < target)
    if not len(passing):
        return 1.0
    first, last = int(passing[0]) - 2, min(int(passing[0]) + 3, 100)  # bins counted from one
    if first <= 0 or last - first < 3:
        return float("nan")
    x, y = chance[first - 1 : last], np.arange(first, last + 1) / 100
    deviation = x.std(ddof=1)
    deviation = deviation if np.isfinite(deviation) and deviation > 0 else 1.0
    return float(np.polyval(np.polyfit((x - x.mean()) / deviation, y, 3), (target - x.mean()) / deviation))


def threshold_line(dispersions: np.ndarray, thresholds: np.ndarray) -> tuple[float, float]:
    """(slope, intercept) of threshold against dispersion over the bins that have both; a line that doesn't rise is its value at
    0.35, one bin alone its threshold, none 0.3."""
    ok = ~np.isnan(thresholds) & ~np.isnan(dispersions)
    if ok.sum() < 2:
        return 0.0, float(thresholds[ok][0]) if ok.any() else 0.3
    slope, intercept = np.polyfit(dispersions[ok], thresholds[ok], 1)
    return (float(slope), float(intercept)) if slope > 0 else (0.0, float(slope * 0.35 + intercept))


def smoothed_arc(phase: np.ndarray, day: np.ndarray, window: float) -> tuple[float, float, np.ndarray]:
    """(deviation, largest, noise) of an arc's phasors against a Gaussian-weighted local line in time: the local mean phase
    is removed, a weighted line is fitted to the rest, and what is left at the epoch itself is noise."""
    z, noise = np.exp(1j * phase), np.empty(len(phase))
    for k in range(len(day)):
        apart = day - day[k]
        w = np.exp(-(apart**2) / (2 * window**2))
        w /= w.sum()
        mean = np.angle((w * z).sum())
        rest = np.angle(z * np.exp(-1j * mean))
        s, sx, sxx, sy, sxy = w.sum(), (w * apart).sum(), (w * apart**2).sum(), (w * rest).sum(), (w * apart * rest).sum()
        det = s * sxx - sx * sx
        at = (sxx * sy - sx * sxy) / det if det > 1e-12 else sy
        noise[k] = np.angle(np.exp(1j * (rest[k] - at)))
    return float(noise.std(ddof=1)) if len(noise) > 1 else 0.0, float(np.abs(noise).max()), noise


def random_coherence(n_rows: int, bperp: np.ndarray, wraps: float, bins: int = 100, seed: int = 2005, differences: np.ndarray | None = None) -> np.ndarray:
    """Histogram of the coherence that phases without signal reach; with `differences` (pairs of image indices) random image
    phases are differenced as a network does."""
    draw, counts = np.random.default_rng(seed), np.zeros(bins)
    for start in range(0, n_rows, 2000):
        n = min(2000, n_rows - start)
        if differences is None:
            phi = draw.uniform(-np.pi, np.pi, (n, len(bperp)))
        else:
            images = draw.uniform(-np.pi, np.pi, (n, differences.max() + 1))
            phi = images[:, differences[:, 1]] - images[:, differences[:, 0]]
        coherence = topofit(np.exp(1j * phi), bperp, wraps)[2]
        counts += np.histogram(coherence, bins, (0, 1))[0]
    return counts
