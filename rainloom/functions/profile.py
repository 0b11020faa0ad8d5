"""Robust principal components of one block of readings, and its runs of equal values."""

from __future__ import annotations

import numpy as np

RANK, ROUNDS = 2, 5
#: The components stay below the CLIP quantile of the positive readings.
CLIP = 0.75
#: A cell is sparse when its remainder lies so many robust standard deviations above the median remainder of the wet cells.
DEVIATIONS = 1.0
_MAD_TO_SD = 1.4826


def sparse_part(row: np.ndarray, col: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which readings stand out of the low-rank part of their profile matrix (rows x columns, largest reading per cell).

    The matrix of log(1 + value / median) is parted into a low-rank and a sparse part in turn; empty cells take the low-rank
    value. The sparse part starts with all that lies above the CLIP quantile, so a spike can't enter the components. What
    counts as sparse is told by the median remainder of the wet cells and its median deviation, which bear any share of
    spikes below a half. Without a positive reading nothing stands out.
    """
    positive = value[value > 0]
    if not len(positive):
        return np.zeros(len(value), bool)
    middle = float(np.median(positive))
    y = np.log1p(np.maximum(value, 0.0) / middle)
    cells = np.full((int(row.max()) + 1, int(col.max()) + 1), -1.0)
    np.maximum.at(cells, (row, col), y)
    seen, wet = cells >= 0, cells > 0
    top = float(np.quantile(y[value > 0], CLIP))
    sparse = np.where(seen, np.maximum(0.0, cells - top), 0.0)
    low = np.full(cells.shape, float(np.minimum(y, top).mean()))
    tau = 0.0
    for _ in range(ROUNDS):
        u, s, vt = np.linalg.svd(np.where(seen, cells - sparse, low), full_matrices=False)
        k = min(RANK, len(s))
        low = np.clip((u[:, :k] * s[:k]) @ vt[:k], 0.0, top)
        rest = cells - low
        centre = float(np.median(rest[wet]))
        tau = centre + DEVIATIONS * _MAD_TO_SD * float(np.median(np.abs(rest[wet] - centre)))
        sparse = np.where(seen & (rest > tau), rest, 0.0)
    return (y - low[row, col] > tau) & (value > middle)


def runs(series: np.ndarray, order: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, length, equal): the run of each reading, the number of different (order, value) entries of each run, and the rounded values.

    Successive readings of a series with the same value to two decimals form a run; entries of one time and value count once.
    """
    rounded = np.round(value, 2)
    at = np.lexsort((rounded, order, series))
    s, o, r = series[at], order[at], rounded[at]
    new_run = np.ones(len(at), bool)
    new_run[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
    new_entry = new_run.copy()
    new_entry[1:] |= o[1:] != o[:-1]
    number = np.cumsum(new_run) - 1
    length = np.bincount(number, weights=new_entry).astype(np.int64)
    run = np.empty(len(at), np.int64)
    run[at] = number
    return run, length, rounded
