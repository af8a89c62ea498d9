"""The variable-span smoother point by point, to compare the window form with."""

from __future__ import annotations

import numpy as np


def fill_gaps(y: np.ndarray) -> np.ndarray:
    """Linear interpolation with constant ends; an all-missing series stays so."""
    known = np.flatnonzero(~np.isnan(y))
    return np.interp(np.arange(len(y)), known, y[known]) if len(known) else y


def running_line(y: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares lines over the 2*half+1 nearest points, and leave-one-out errors."""
    n = len(y)
    x = np.arange(n, dtype=float)
    width = min(2 * half + 1, n)
    first = np.clip(np.arange(n) - half, 0, n - width)

    def windowed(v):
        total = np.concatenate([[0.0], np.cumsum(v)])
        return total[first + width] - total[first]

    # centred values keep the running sums small
    centre = y.mean()
    mx, my = windowed(x) / width, windowed(y - centre) / width
    sxx = np.maximum(windowed(x * x) / width - mx**2, 1e-12)
    slope = (windowed(x * (y - centre)) / width - mx * my) / sxx
    fit = centre + my + slope * (x - mx)
    leverage = np.clip(1 / width + (x - mx) ** 2 / (width * sxx), 0, 0.999)
    return fit, np.abs(y - fit) / (1 - leverage)


def super_smoother(y: np.ndarray, spans=(0.05, 0.2, 0.5)) -> np.ndarray:
    """Variable-span smoother of Friedman (1984) on an equally spaced grid."""
    n = len(y)
    halves = [max(int(0.5 * span * n + 0.5), 2) for span in spans]
    fits, errors = zip(*(running_line(y, half) for half in halves))
    errors = np.array([running_line(e, halves[1])[0] for e in errors])
    best = np.array(spans)[errors.argmin(axis=0)]
    span = np.clip(running_line(best, halves[1])[0], spans[0], spans[-1])
    # interpolate between the two fits whose spans enclose the chosen one
    fits = np.array(fits)
    right = np.clip(np.searchsorted(spans, span), 1, len(spans) - 1)
    s = np.array(spans)
    share = (span - s[right - 1]) / (s[right] - s[right - 1])
    at = np.arange(n)
    mixed = fits[right - 1, at] * (1 - share) + fits[right, at] * share
    return running_line(mixed, halves[0])[0]


def replace_outliers(y: np.ndarray, passes: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Points outside the residual quartiles by 3 IQR are replaced by interpolation."""
    flagged = np.zeros(len(y), bool)
    fixed = fill_gaps(y)
    for _ in range(passes):
        if len(y) < 5 or np.isnan(fixed).any() or np.ptp(fixed) == 0:
            break
        rest = fixed - super_smoother(fixed)
        q1, q3 = np.quantile(rest, [0.25, 0.75])
        reach = 3 * (q3 - q1)
        far = (rest < q1 - reach) | (rest > q3 + reach)
        if reach < 1e-14 or not far.any() or (flagged | far).all():
            break
        flagged |= far
        fixed = fill_gaps(np.where(flagged, np.nan, fixed))
    return fixed, flagged
