"""Tails of discrete distributions as Arrow-batched column functions; the rows of a batch are summed together."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _log_gamma(x: np.ndarray) -> np.ndarray:
    return np.fromiter((math.lgamma(v) for v in x), float, len(x))


def _tail(k: np.ndarray, low: np.ndarray, high: np.ndarray, mean: np.ndarray, log_term, rise, patient: np.ndarray | None = None) -> np.ndarray:
    """P(X >= k) of distributions on ``low`` to ``high``, all rows at once.

    ``log_term(i)`` is the log of P(X = i), ``rise(i)`` is P(X = i + 1) / P(X = i). The shorter side is summed: upwards from k, or
    downwards from k - 1 below the mean, until terms no longer count (rows of ``patient``: to the end, as they may rise again).
    """
    up = k > mean
    i = np.where(up, k, k - 1)
    term = np.exp(log_term(i))
    total, live = term.copy(), np.where(up, i < high, i > low)
    while live.any():
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(up, rise(i), 1 / rise(i - 1))
        term = np.where(live, term * step, 0.0)
        i = np.where(live, i + np.where(up, 1, -1), i)
        total += term
        counts = term > 1e-17 * total if patient is None else patient | (term > 1e-17 * total)
        live &= counts & np.where(up, i < high, i > low)
    return np.clip(np.where(up, total, 1 - total), 0, 1)


def binomial_tail(k: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """P(X >= k): 1 for k <= 0, 0 for k > n or p <= 0 (k > 0); null where an argument is."""
    out = np.full(len(k), np.nan)
    known = ~(np.isnan(k) | np.isnan(n) | np.isnan(p))
    out[known & (k <= 0)] = 1.0
    out[known & (k > 0) & ((k > n) | (p <= 0))] = 0.0
    out[known & (k > 0) & (k <= n) & (p >= 1)] = 1.0
    at = np.flatnonzero(known & (k > 0) & (k <= n) & (p > 0) & (p < 1))
    if not len(at):
        return out
    k, n, p = k[at], n[at], p[at]
    term = lambda i: _log_gamma(n + 1) - _log_gamma(i + 1) - _log_gamma(n - i + 1) + i * np.log(p) + (n - i) * np.log1p(-p)
    out[at] = _tail(k, np.zeros(len(k)), n, n * p, term, lambda i: (n - i) / (i + 1) * p / (1 - p))
    return out


def beta_binomial_tail(k: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """P(X >= k) of a beta-binomial with a, b > 0; as ``binomial_tail`` at the ends."""
    out = np.full(len(k), np.nan)
    known = ~(np.isnan(k) | np.isnan(n) | np.isnan(a) | np.isnan(b))
    out[known & (k <= 0)] = 1.0
    out[known & (k > 0) & (k > n)] = 0.0
    at = np.flatnonzero(known & (k > 0) & (k <= n) & (a > 0) & (b > 0))
    if not len(at):
        return out
    k, n, a, b = k[at], n[at], a[at], b[at]
    term = lambda i: (
        _log_gamma(n + 1) - _log_gamma(i + 1) - _log_gamma(n - i + 1) + _log_gamma(i + a) + _log_gamma(n - i + b) - _log_gamma(n + a + b)
        + _log_gamma(a + b) - _log_gamma(a) - _log_gamma(b)
    )
    rise = lambda i: (n - i) * (a + i) / ((i + 1) * (b + n - i - 1))
    out[at] = _tail(k, np.zeros(len(k)), n, n * a / (a + b), term, rise, (a < 1) | (b < 1))
    return out


def fisher_tail(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """One-sided Fisher test of a / (a + b) > c / (c + d); 1 where a margin is empty."""
    out = np.full(len(a), np.nan)
    known = ~(np.isnan(a) | np.isnan(b) | np.isnan(c) | np.isnan(d))
    filled = (a + b > 0) & (c + d > 0) & (a + c > 0) & (b + d > 0)
    out[known & ~filled] = 1.0
    at = np.flatnonzero(known & filled)
    if not len(at):
        return out
    w, row, col, n = a[at], (a + b)[at], (a + c)[at], (a + b + c + d)[at]
    low, high = np.maximum(0, row + col - n), np.minimum(row, col)
    term = lambda i: (
        _log_gamma(row + 1) - _log_gamma(i + 1) - _log_gamma(row - i + 1) + _log_gamma(n - row + 1) - _log_gamma(col - i + 1)
        - _log_gamma(n - row - col + i + 1) - _log_gamma(n + 1) + _log_gamma(col + 1) + _log_gamma(n - col + 1)
    )
    tail = np.ones(len(w))
    # at the low end the tail is everything
    above = np.flatnonzero(w > low)
    if len(above):
        w, row, col, n, low, high = (x[above] for x in (w, row, col, n, low, high))
        tail[above] = _tail(w, low, high, row * col / n, term, lambda i: (row - i) * (col - i) / ((i + 1) * (n - row - col + i + 1)))
    out[at] = tail
    return out


def normal_cdf(x: np.ndarray) -> np.ndarray:
    return np.fromiter((0.5 * math.erfc(-v / math.sqrt(2)) if not np.isnan(v) else np.nan for v in x), float, len(x))


def _column(function, *columns: Column) -> Column:
    # scalar Arrow functions are typed by their signature, so each number of arguments has its own
    def one(x: pd.Series) -> pd.Series:
        return pd.Series(function(x.to_numpy(float)))

    def three(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        return pd.Series(function(x.to_numpy(float), y.to_numpy(float), z.to_numpy(float)))

    def four(w: pd.Series, x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        return pd.Series(function(w.to_numpy(float), x.to_numpy(float), y.to_numpy(float), z.to_numpy(float)))

    result = F.pandas_udf({1: one, 3: three, 4: four}[len(columns)], "double")(*(c.cast("double") for c in columns))
    return F.when(~F.isnan(result), result)


def binom_tail(k: Column, n: Column, p: Column) -> Column:
    return _column(binomial_tail, k, n, p)


def betabinom_tail(k: Column, n: Column, a: Column, b: Column) -> Column:
    return _column(beta_binomial_tail, k, n, a, b)


def fisher_right(a: Column, b: Column, c: Column, d: Column) -> Column:
    return _column(fisher_tail, a, b, c, d)


def percentile_of(z: Column) -> Column:
    return _column(normal_cdf, z)


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson interval of a share; (0, 1) for n = 0."""
    p, n1 = k / F.when(n > 0, n), n.cast("double")
    scale = 1 + z * z / n1
    middle, spread = p + z * z / (2 * n1), z * F.sqrt(p * (1 - p) / n1 + z * z / (4 * n1 * n1))
    low, high = F.greatest((middle - spread) / scale, F.lit(0.0)), F.least((middle + spread) / scale, F.lit(1.0))
    return F.when(n == 0, 0.0).otherwise(low), F.when(n == 0, 1.0).otherwise(high)


def posterior(k: Column, n: Column, prior: float, d: float, f: Column | float) -> Column:
    """Posterior of a share ``d`` against ``f``, binomial likelihood."""
    f = F.lit(f) if isinstance(f, float) else f
    log_ratio = k * F.log(F.lit(d) / f) + (n - k) * F.log(F.lit(1 - d) / (1 - f)) + math.log(prior / (1 - prior))
    bounded = F.least(F.greatest(log_ratio, F.lit(-700.0)), F.lit(700.0))
    return 1 / (1 + F.exp(-bounded))
