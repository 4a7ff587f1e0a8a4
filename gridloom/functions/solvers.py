"""Functions that iterate: rates of return, loan rates, the normal distribution. Arrow batches, solved as arrays."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


#: Rates at which a function is looked at first; rows that are solved at a time, so that arrays stay small.
GRID = np.unique(np.concatenate([-1 + np.logspace(-8, -0.3, 200), np.linspace(-0.5, 1.0, 601), np.logspace(0, 5, 200)]))
ROWS = 256


def roots(f: Callable, n: int, guess: float = 0.1) -> np.ndarray:
    """f: of an array of rates with a row for each of n problems, or one row for all. For each problem the root above -1 that is
    nearest to guess: sign changes on a grid, then bisection of all problems at once; NaN where there is none."""
    with np.errstate(all="ignore"):
        v = f(GRID[None, :])
        ok = np.isfinite(v)
        turns = ok[:, :-1] & ok[:, 1:] & (v[:, :-1] * v[:, 1:] < 0)
        below = GRID[:-1] <= guess
        best = np.full(n, np.nan)
        zero = v == 0
        if zero.any():
            far = np.where(zero, np.abs(GRID - guess), np.inf)
            best = np.where(zero.any(1), GRID[far.argmin(1)], np.nan)
        # roots lie in disjoint intervals, so the nearest is in the last one from the guess down or the first above
        for side, last in ((turns & below, True), (turns & ~below, False)):
            there = side.any(1)
            at = side.shape[1] - 1 - side[:, ::-1].argmax(1) if last else side.argmax(1)
            lo, hi = GRID[at].copy(), GRID[np.minimum(at + 1, len(GRID) - 1)].copy()
            sign = v[np.arange(n), at] > 0
            for _ in range(80):
                mid = (lo + hi) / 2
                if not (there & (hi - lo >= 1e-15 * np.maximum(1.0, np.abs(mid)))).any():
                    break
                now = f(mid[:, None])[:, 0]
                up = (now > 0) == sign
                exact = now == 0
                lo, hi = np.where(exact | up, mid, lo), np.where(exact | ~up, mid, hi)
            found = np.where(there, (lo + hi) / 2, np.nan)
            best = np.where(np.isnan(best) | (np.abs(found - guess) < np.abs(best - guess)), found, best)
    return best


def _flows(rows: list) -> np.ndarray:
    """Series of unlike length as rows that end in zeros."""
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def discounted(flows: list, years: list) -> np.ndarray:
    """The rate at which each series of flows, paid after so many years, is worth nothing; NaN where there is none."""
    out = np.full(len(flows), np.nan)
    able = [i for i, (v, t) in enumerate(zip(flows, years, strict=True)) if v is not None and t is not None and len(v) == len(t) and min(v, default=0) < 0 < max(v, default=0)]
    for k in range(0, len(able), ROWS):
        some = able[k : k + ROWS]
        v, t = _flows([flows[i] for i in some]), _flows([years[i] for i in some])
        # a payment after another: sums over payments, so no array of all three sides
        out[some] = roots(lambda r, v=v, t=t: sum(v[:, [j]] * (1 + r) ** -t[:, [j]] for j in range(v.shape[1])), len(some))
    return out


def loan_rates(nper: np.ndarray, pmt: np.ndarray, pv: np.ndarray, fv: float = 0.0, due: int = 0, guess: float = 0.1) -> np.ndarray:
    out = np.full(len(nper), np.nan)
    able = np.flatnonzero(nper > 0)
    for k in range(0, len(able), ROWS):
        some = able[k : k + ROWS]
        n, p, v = nper[some, None], pmt[some, None], pv[some, None]

        def balance(r: np.ndarray, n=n, p=p, v=v) -> np.ndarray:
            growth, still = (1 + r) ** n, np.where(r == 0, 1.0, r)
            return np.where(r == 0, v + p * n + fv, v * growth + p * (1 + r * due) * (growth - 1) / still + fv)

        out[some] = roots(balance, len(some), guess)
    return out


def _one(x: np.ndarray) -> float | None:
    return None if np.isnan(x[0]) else float(x[0])


def irr_of(flows) -> float | None:
    v = [float(x) for x in flows]
    return _one(discounted([v], [list(range(len(v)))]))


def xirr_of(flows, days) -> float | None:
    d = [float(x) for x in days]
    return _one(discounted([[float(x) for x in flows]], [[(x - d[0]) / 365 for x in d]]))


def rate_of(nper: float, pmt: float, pv: float, fv: float = 0.0, due: int = 0, guess: float = 0.1) -> float | None:
    return _one(loan_rates(np.array([float(nper)]), np.array([float(pmt)]), np.array([float(pv)]), fv, due, guess))


def cdf_of(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def inv_of(p: float) -> float | None:
    """The z with cdf_of(z) = p; None outside (0, 1)."""
    return _one(normal_places(np.array([float(p)])))


_erfc = np.frompyfunc(math.erfc, 1, 1)


def normal_shares(z: np.ndarray) -> np.ndarray:
    return 0.5 * _erfc(-z / math.sqrt(2)).astype(float)


def normal_places(p: np.ndarray) -> np.ndarray:
    """The z below which a share p of the normal distribution lies, by bisection and Newton steps of a whole batch; NaN
    outside (0, 1)."""
    p = np.asarray(p, float)
    able = (p > 0) & (p < 1)
    q = np.where(able, p, 0.5)
    lo, hi = np.full(len(p), -40.0), np.full(len(p), 40.0)
    for _ in range(60):
        at = (lo + hi) / 2
        low = normal_shares(at) < q
        lo, hi = np.where(low, at, lo), np.where(low, hi, at)
    z = (lo + hi) / 2
    for _ in range(2):
        slope = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
        z = np.where(slope > 1e-300, z - (normal_shares(z) - q) / np.where(slope > 1e-300, slope, 1), z)
    return np.where(able, z, np.nan)


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(float(x))


def irr(flows) -> Column:
    @F.pandas_udf("double")
    def run(v: pd.Series) -> pd.Series:
        return pd.Series(discounted(list(v), [None if x is None else np.arange(len(x), dtype=float) for x in v]), index=v.index)

    return F.nanvl(run(_c(flows)), F.lit(None).cast("double"))


def xirr(flows, days) -> Column:
    @F.pandas_udf("double")
    def run(v: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(discounted(list(v), [None if x is None or not len(x) else (np.asarray(x, float) - x[0]) / 365 for x in d]), index=v.index)

    return F.nanvl(run(_c(flows), _c(days)), F.lit(None).cast("double"))


def rate(nper, pmt, pv) -> Column:
    @F.pandas_udf("double")
    def run(n: pd.Series, p: pd.Series, v: pd.Series) -> pd.Series:
        return pd.Series(loan_rates(n.to_numpy(float), p.to_numpy(float), v.to_numpy(float)), index=n.index)

    return F.nanvl(run(_c(nper), _c(pmt), _c(pv)), F.lit(None).cast("double"))


def norm_cdf(z) -> Column:
    @F.pandas_udf("double")
    def run(v: pd.Series) -> pd.Series:
        return pd.Series(normal_shares(v.to_numpy(float)), index=v.index)

    return F.nanvl(run(_c(z)), F.lit(None).cast("double"))


def norm_inv(p) -> Column:
    @F.pandas_udf("double")
    def run(v: pd.Series) -> pd.Series:
        return pd.Series(normal_places(v.to_numpy(float)), index=v.index)

    return F.nanvl(run(_c(p)), F.lit(None).cast("double"))
