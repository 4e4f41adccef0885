"""The per-series fit of the trend-and-season model (numpy only, runs inside tasks).

The logarithm of 1 + y is regressed on a bent trend, weekly, yearly and monthly cycles and the
public holidays, so the components multiply. Each group of regressors has a Gaussian prior.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

# (period in days, number of sine/cosine pairs): weekly, yearly, monthly (fixed values).
CYCLES = ((7.0, 3), (365.25, 10), (30.5, 5))
HOLIDAYS = 16
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8   # bends lie in the first 80 % of the training span
NOISE = 0.1               # scale of log residuals, sets the weight of the priors
SEASON_SCALE = 10.0
INTERVAL = (0.1, 0.9)     # residual quantiles of the prediction interval


BENDS = np.linspace(0, CHANGEPOINT_RANGE, CHANGEPOINTS + 1)[1:]


def seasons(days: np.ndarray, holiday: np.ndarray) -> np.ndarray:
    """Cycles and holidays for each day; they do not depend on the training span."""
    angles = np.hstack([2 * np.pi * np.arange(1, pairs + 1)[None, :] * days[:, None] / period
                        for period, pairs in CYCLES])
    one_hot = holiday[:, None] == np.arange(1, HOLIDAYS + 1)[None, :]
    return np.hstack([np.sin(angles), np.cos(angles), one_hot])


def design(days: np.ndarray, holiday: np.ndarray, first: float, last: float) -> np.ndarray:
    """Intercept, slope, bends, cycles and holidays for each day."""
    t = ((days - first) / max(last - first, 1.0))[:, None]
    return np.hstack([np.ones_like(t), t, np.maximum(t - BENDS[None], 0.0), seasons(days, holiday)])


def penalties(columns: int, flexibility: float) -> np.ndarray:
    penalty = np.full(columns, (NOISE / SEASON_SCALE) ** 2)
    penalty[2:2 + CHANGEPOINTS] = (NOISE / flexibility) ** 2
    return penalty


def to_units(log_values: np.ndarray) -> np.ndarray:
    """Units, not a number where the trend leaves the range of a double."""
    with np.errstate(over="ignore"):
        units = np.maximum(np.expm1(log_values), 0.0)
    return np.where(np.isfinite(units), units, np.nan)


def predict(pdf: pd.DataFrame, grid: list[float], keys: list[str]) -> pd.DataFrame:
    """Fit the rows with ``is_train``, predict the others, once per flexibility in ``grid``."""
    pdf = pdf.sort_values("ds", ignore_index=True)
    train = pdf["is_train"].to_numpy(dtype=bool)
    if not train.any():  # nothing to learn from: no prediction; forecast_series_status names such series
        return pd.DataFrame(columns=[*keys, "ds", "y", "flexibility", "yhat", "yhat_lower", "yhat_upper"])
    days = pdf["day"].to_numpy(dtype=float)
    x = design(days, pdf["us_holiday"].to_numpy(), days[train].min(), days[train].max())
    target = np.log1p(pdf["y"].to_numpy(dtype=float)[train])
    gram, moment = x[train].T @ x[train], x[train].T @ target
    frames = []
    for flexibility in grid:
        fitted = x @ np.linalg.solve(gram + np.diag(penalties(x.shape[1], flexibility)), moment)
        low, high = np.quantile(target - fitted[train], INTERVAL)
        ahead = fitted[~train]
        frame = pdf.loc[~train, [*keys, "ds", "y"]].copy()
        frame["flexibility"] = flexibility
        frame["yhat"] = to_units(ahead)
        frame["yhat_lower"], frame["yhat_upper"] = to_units(ahead + low), to_units(ahead + high)
        frames.append(frame)
    return pd.concat(frames, ignore_index=True)


class Folds:
    """Normal equations of every training span that starts with the first day of a series, from running sums.

    The trend bends at fractions of the span, so its columns differ from span to span; but a bend is a straight line
    from some day on, and sums of straight lines times anything follow from the running sums of 1, d and d squared times it. The
    other columns are the same for all spans: their Gram matrix grows by the days between two spans.
    """

    def __init__(self, days: np.ndarray, holiday: np.ndarray, target: np.ndarray):
        self.days, self.holiday = days, holiday
        self.age = days - days[0]
        fixed = np.hstack([np.ones((len(days), 1)), seasons(days, holiday)])  # intercept first
        self.fixed = np.hstack([fixed, target[:, None]])                      # the target is one more column: moments come along
        running = lambda a: np.concatenate([np.zeros((1, *a.shape[1:])), np.cumsum(a, axis=0)])
        self.plain, self.aged = running(self.fixed), running(self.age[:, None] * self.fixed)
        self.powers = running(np.stack([np.ones_like(self.age), self.age, self.age ** 2], axis=1))
        self.done, self.gram = 0, np.zeros((self.fixed.shape[1],) * 2)

    def equations(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Gram matrix and moments of the first ``n`` days; to be asked for ascending ``n``."""
        new = self.fixed[self.done:n]
        self.gram, self.done = self.gram + new.T @ new, n
        length = max(self.age[n - 1], 1.0)
        starts = np.concatenate([[0.0], BENDS]) * length                       # the slope bends at the first day
        at = np.searchsorted(self.age[:n], starts, side="right")
        at[0] = 0
        with_fixed = ((self.aged[n] - self.aged[at]) - starts[:, None] * (self.plain[n] - self.plain[at])) / length
        later = np.maximum(at[:, None], at[None])
        count, sums, squares = np.moveaxis(self.powers[n] - self.powers[later], 2, 0)
        among = (squares - (starts[:, None] + starts[None]) * sums + starts[:, None] * starts[None] * count) / length ** 2
        size = 1 + len(starts) + self.fixed.shape[1] - 2
        gram, trend, rest = np.empty((size, size)), slice(1, 1 + len(starts)), slice(1 + len(starts), size)
        gram[0, 0], gram[trend, trend], gram[rest, rest] = n, among, self.gram[1:-1, 1:-1]
        gram[0, trend] = gram[trend, 0] = with_fixed[:, 0]
        gram[0, rest] = gram[rest, 0] = self.gram[0, 1:-1]
        gram[trend, rest] = with_fixed[:, 1:-1]
        gram[rest, trend] = gram[trend, rest].T
        return gram, np.concatenate([self.gram[:1, -1], with_fixed[:, -1], self.gram[1:-1, -1]])


def cross_validate(pdf: pd.DataFrame, origins: pd.DataFrame, grid: list[float], horizon: int, series: str) -> pd.DataFrame:
    """Predictions for the ``horizon`` days behind each origin of one series, once per flexibility; a fold costs a solve."""
    columns = [series, "cutoff", "ds", "y", "flexibility", "yhat"]
    if pdf.empty or origins.empty:
        return pd.DataFrame(columns=columns)
    pdf = pdf.sort_values("day", ignore_index=True)
    days, holiday = pdf["day"].to_numpy(dtype=float), pdf["us_holiday"].to_numpy()
    folds = Folds(days, holiday, np.log1p(pdf["y"].to_numpy(dtype=float)))
    frames = []
    for cutoff, last in origins.sort_values("last").loc[:, ["cutoff", "last"]].itertuples(index=False):
        n, stop = np.searchsorted(days, [last, last + horizon], side="right")
        if not n:
            continue
        gram, moment = folds.equations(int(n))
        ahead = design(days[n:stop], holiday[n:stop], days[0], days[n - 1])
        for flexibility in grid:
            frame = pdf.loc[n:stop - 1, [series, "ds", "y"]].copy()
            frame["cutoff"], frame["flexibility"] = cutoff, flexibility
            frame["yhat"] = to_units(ahead @ np.linalg.solve(gram + np.diag(penalties(len(moment), flexibility)), moment))
            frames.append(frame[columns])
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(columns=columns)
