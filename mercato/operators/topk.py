"""Best-n lists of many rows at once, kept in arrays inside Arrow batches."""

from __future__ import annotations

import numpy as np


def empty_lists(rows: int, n: int, dtype=np.float64) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of ``rows`` empty lists of at most ``n`` entries."""
    return np.full((rows, n), np.iinfo(np.int64).max, np.int64), np.full((rows, n), -np.inf, dtype)


def merge_best(best_id: np.ndarray, best: np.ndarray, rows: np.ndarray, ids: np.ndarray, s: np.ndarray) -> None:
    """Put the scores ``s`` (rows x ids; -inf: excluded) into the best lists of
    ``rows``, in order of score and, for equal scores, id."""
    n = best.shape[1]
    least = best[rows, -1]
    enter = s >= least[:, None]
    if s.shape[1] > n and np.count_nonzero(enter) > 2 * n * len(rows):
        # only what reaches the own n-th best of this slice can enter
        enter &= s >= -np.partition(-s, n - 1, axis=1)[:, n - 1, None]
    r, c = np.nonzero(enter)
    value = s[r, c]
    ok = np.isfinite(value)
    r, c, value = r[ok], c[ok], value[ok]
    if len(r) == 0:
        return
    if len(rows) > 2 * n:  # rows that nothing enters stay as they are
        met, r = np.unique(r, return_inverse=True)
        rows = rows[met]
    old_r, old_c = np.nonzero(np.isfinite(best[rows]))
    row = np.concatenate([old_r, r])
    id_ = np.concatenate([best_id[rows[old_r], old_c], ids[c]])
    score = np.concatenate([best[rows[old_r], old_c], value])
    order = np.lexsort((id_, -score, row))
    row, id_, score = row[order], id_[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    ok = place < n
    best[rows] = -np.inf
    best_id[rows[row[ok]], place[ok]], best[rows[row[ok]], place[ok]] = id_[ok], score[ok]
