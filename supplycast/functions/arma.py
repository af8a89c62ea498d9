"""Exact Gaussian likelihood of one seasonal ARIMA candidate (numpy).

The differenced series is taken as it is for the first block and filtered by the autoregressive
polynomial after it.  The covariance of these values is block tridiagonal and constant from the third
block row on, so its Cholesky factor comes block by block, for any length of series, and gives the
one-step prediction errors, their scales and the forecasts.  Several parameter vectors run side by side.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# Ship these helpers with the tasks, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: blocks hold at least so many values
BLOCK = 16


def _seasonal(coef, period: int) -> np.ndarray:
    """Lag polynomial 1 + c1 B^period + c2 B^(2 period) ..."""
    poly = np.zeros(len(coef) * period + 1)
    poly[0] = 1.0
    poly[period::period] = coef
    return poly


def _polynomials(params, order, period):
    """Autoregressive and moving-average lag polynomials, and the mean."""
    p, q, sp, sq, _ = order
    cuts = np.cumsum([p, q, sp, sq])
    ar, ma, sar, sma, mean = np.split(params, cuts)
    ar_poly = np.convolve(_seasonal(-ar, 1), _seasonal(-sar, period))
    ma_poly = np.convolve(_seasonal(ma, 1), _seasonal(sma, period))
    return ar_poly, ma_poly, float(mean[0]) if len(mean) else 0.0


def _admissible(poly) -> bool:
    """All roots outside the unit circle."""
    poly = np.trim_zeros(poly, "b")
    return len(poly) <= 1 or bool(np.all(np.abs(np.roots(poly[::-1])) > 1.001))


def autocovariances(ar, ma, size):
    """Three arrays (vectors, lags) for unit errors: of the process, of its filtered values with
    earlier plain ones, and of the filtered values; lags 0 to ``size`` - 1."""
    many, p, q = len(ar), ar.shape[1] - 1, ma.shape[1] - 1
    psi = np.zeros((many, q + 1))
    for k in range(q + 1):
        known = min(k, p)
        psi[:, k] = ma[:, k] - (ar[:, 1 : known + 1] * psi[:, k - known : k][:, ::-1]).sum(axis=1)
    mixed, filtered = np.zeros((2, many, max(size, p + 1, q + 1)))
    for h in range(q + 1):
        mixed[:, h] = (ma[:, h:] * psi[:, : q + 1 - h]).sum(axis=1)
        filtered[:, h] = (ma[:, h:] * ma[:, : q + 1 - h]).sum(axis=1)
    lags = np.arange(p + 1)
    system = np.zeros((many, p + 1, p + 1))
    for j in range(p + 1):
        system[:, lags, np.abs(lags - j)] += ar[:, j, None]
    plain = np.zeros_like(mixed)
    plain[:, : p + 1] = np.linalg.solve(system, mixed[:, : p + 1, None])[..., 0]
    for k in range(p + 1, size):
        plain[:, k] = mixed[:, k] - (ar[:, 1:] * plain[:, k - p : k][:, ::-1]).sum(axis=1)
    return plain[:, :size], mixed[:, :size], filtered[:, :size]


def innovations(x, ar, ma, horizon=0):
    """Standardised one-step errors, logs of their scales and forecasts of mean-zero ``x``.

    ``x``, ``ar``, ``ma`` have one row per parameter vector.
    """
    many, n = x.shape
    size = max(ar.shape[1], ma.shape[1], BLOCK)
    plain, mixed, filtered = autocovariances(ar, ma, 2 * size)
    gap = np.subtract.outer(np.arange(size), np.arange(size))
    within, across = np.abs(gap), gap + size
    blocks = -(-(n + horizon) // size)
    total = blocks * size
    values = np.zeros((many, total))
    values[:, :n] = x
    z = values.copy()
    for j in range(1, ar.shape[1]):
        z[:, size:] += ar[:, j, None] * values[:, size - j : total - j]
    errors, logs = np.zeros((2, many, total))
    root = np.linalg.cholesky(plain[:, within])
    link, settled = mixed[:, across], False
    error = None
    for b in range(blocks):
        rows = slice(b * size, (b + 1) * size)
        known = min(max(n - b * size, 0), size)
        carried = 0.0
        if b:
            if not settled:
                step = np.linalg.solve(root, link.swapaxes(1, 2)).swapaxes(1, 2)
                before = root
                root = np.linalg.cholesky(
                    filtered[:, within] - step @ step.swapaxes(1, 2)
                )
                settled = b > 2 and float(np.abs(root - before).max()) < 1e-13
                inverse = np.linalg.inv(root) if settled else None
            carried = (step @ error[..., None])[..., 0]
            link = filtered[:, across]
        error = np.zeros((many, size))
        if known:
            given = (z[:, rows] - carried)[:, :known, None]
            lead = inverse[:, :known, :known] @ given if settled else np.linalg.solve(
                root[:, :known, :known], given
            )
            error[:, :known] = lead[..., 0]
        errors[:, rows] = error
        logs[:, rows] = np.log(np.diagonal(root, axis1=1, axis2=2))
        if known < size:
            expected = carried + (root @ error[..., None])[..., 0]
            for t in range(b * size + known, min((b + 1) * size, n + horizon)):
                back = ar.shape[1] - 1 if b else 0
                past = values[:, t - back : t][:, ::-1]
                values[:, t] = expected[:, t - b * size] - (ar[:, 1 : back + 1] * past).sum(axis=1)
    return errors[:, :n], logs[:, :n], values[:, n : n + horizon]


def _scaled(w, vectors, order, period):
    """Errors whose sum of squares falls exactly where the likelihood rises, one row per vector."""
    ar, ma, mean = zip(*(_polynomials(v, order, period) for v in vectors))
    x = w[None, :] - np.array(mean)[:, None]
    errors, logs, _ = innovations(x, np.array(ar), np.array(ma))
    return errors * np.exp(logs.mean(axis=1, keepdims=True))


def _slopes(w, params, order, period):
    """Central differences of the scaled errors by the parameters, all at once."""
    shift = 1e-5 * np.maximum(1.0, np.abs(params))
    both = np.concatenate([params + np.diag(shift), params - np.diag(shift)])
    e = _scaled(w, both, order, period)
    half = len(params)
    return ((e[:half] - e[half:]) / (2 * shift[:, None])).T


def _maximise(w, order, period, rounds: int = 60) -> np.ndarray:
    """Damped Gauss-Newton; steps to inadmissible parameters or lower likelihoods are refused."""
    params = np.full(sum(order), 0.05)
    if order[-1]:
        params[-1] = w.mean()
    e = _scaled(w, [params], order, period)[0]
    damping, flat = 1e-2, 0
    for _ in range(rounds):
        jac = _slopes(w, params, order, period)
        normal, grad = jac.T @ jac, jac.T @ e
        step = None
        while damping < 1e8:
            scale = damping * np.diag(np.maximum(np.diag(normal), 1e-12))
            trial = params - np.linalg.solve(normal + scale, grad)
            ar_poly, ma_poly, _ = _polynomials(trial, order, period)
            if _admissible(ar_poly) and _admissible(ma_poly):
                e_trial = _scaled(w, [trial], order, period)[0]
                if e_trial @ e_trial <= e @ e:
                    step = np.abs(trial - params).max() / max(1.0, np.abs(params).max())
                    flat = flat + 1 if e @ e - e_trial @ e_trial <= 1e-10 * (e @ e) else 0
                    params, e, damping = trial, e_trial, max(damping / 5, 1e-12)
                    break
            damping *= 4
        # on a ridge of equal likelihoods the steps need not shrink
        if step is None or step < 1e-11 or flat == 3:
            break
    return params


def _integration(d, sd, period):
    """Lag polynomial of the differences."""
    poly = np.ones(1)
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    for _ in range(sd):
        poly = np.convolve(poly, _seasonal([-1.0], period))
    return poly


def fit(y, p, d, q, sp, sd, sq, period, constant):
    """Maximum likelihood of one candidate: criteria, coefficients and their standard errors.

    Coefficients come as AR, MA, seasonal AR, seasonal MA, mean of the differenced series; their
    errors from the information matrix of the scaled errors.  A candidate that cannot be fitted has
    a ``reason`` instead.
    """
    y = np.asarray(y, float)
    order = (p, q, sp, sq, int(constant))
    k = sum(order) + 1
    integration = _integration(d, sd, period)
    lost = len(integration) - 1
    if np.isnan(y).any():
        return {"reason": "series has gaps"}
    n = len(y) - lost
    if n < max(k + 2, p + q + (sp + sq) * period + 2):
        return {"reason": "series too short"}
    w = np.convolve(y, integration)[lost : len(y)]
    # an exact fit is as good as rounding allows, so the one with the fewest parameters wins
    least = n * (1e-10 * max(np.abs(y).max(), 1e-100)) ** 2
    try:
        params = _maximise(w, order, period) if k > 1 else np.zeros(0)
        jac = _slopes(w, params, order, period) if k > 1 else np.zeros((n, 0))
        ar_poly, ma_poly, mean = _polynomials(params, order, period)
        errors, logs, _ = innovations(w[None, :] - mean, ar_poly[None, :], ma_poly[None, :])
        growth = np.exp(logs.mean())
        sse = float(errors[0] @ errors[0])
        if not np.isfinite(sse):
            return {"reason": "diverged"}
        scaled = max(sse * growth**2, least)
        covariance = scaled / n * np.linalg.pinv(jac.T @ jac)
    except np.linalg.LinAlgError:
        return {"reason": "singular"}
    minus_two = n * (np.log(2 * np.pi * scaled / n) + 1)
    return {
        "coefficients": params.tolist(),
        "std_errors": np.sqrt(np.diag(covariance)).tolist(),
        "sigma2": max(sse, least) / max(n - k + 1, 1),
        "loglik": -minus_two / 2,
        "aic": minus_two + 2 * k,
        "aicc": minus_two + 2 * k + 2 * k * (k + 1) / max(n - k - 1, 1e-9),
        "bic": minus_two + k * np.log(n),
    }


def predict(y, p, d, q, sp, sd, sq, period, constant, coefficients, sigma2, horizon):
    """Standardised errors of the differenced values, forecasts and their standard errors."""
    y = np.asarray(y, float)
    order = (p, q, sp, sq, int(constant))
    ar_poly, ma_poly, mean = _polynomials(np.asarray(coefficients, float), order, period)
    integration = _integration(d, sd, period)
    lost = len(integration) - 1
    w = np.convolve(y, integration)[lost : len(y)]
    errors, _, ahead = innovations(
        w[None, :] - mean, ar_poly[None, :], ma_poly[None, :], horizon
    )
    path = list(y)
    for value in ahead[0] + mean:
        path.append(value - sum(c * path[-j] for j, c in enumerate(integration) if j))
    full = np.convolve(ar_poly, integration)
    psi: list[float] = []
    for h in range(horizon):
        weight = ma_poly[h] if h < len(ma_poly) else 0.0
        weight -= sum(full[j] * psi[h - j] for j in range(1, min(h, len(full) - 1) + 1))
        psi.append(weight)
    return {
        "residuals": errors[0].tolist(),
        "mean": path[len(y) :],
        "se": np.sqrt(sigma2 * np.cumsum(np.square(psi))).tolist(),
    }
